"""Quality scores by regularised quadratic discriminant analysis.

1. Statistics: one pass over all texts counts characters, words and lines of several kinds
   (``COUNTS``); written once, all later work reads these few numbers per row.
2. Transform: each share is drawn towards the share of all labelled rows by a fixed number of
   pseudo-counts (short texts say little), then arcsine of its square root; lengths by their logarithm.
3. Fit, over all labelled rows that are not held out (no sample): class sizes, sums and sums of
   products are added up on the executors. Each class covariance is shrunk towards the pooled one
   and towards its own mean variance. Their Cholesky factors are inverted once and kept
   with the model.
4. Score: difference of the two log densities (Mahalanobis distances by the kept factors),
   turned into a probability by a logistic curve that is fitted to a histogram of the labelled differences.

Only the text is an input of a score. Defined results: null and empty texts get the score
of a text that says nothing (all shares at their prior); rows with repeated ids are scored
one by one and count as often as label rows meet them; without any label every score is
0.5; with one class only, every score is that class; a null doc_id is never held out; extra columns
pass by unread.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import Words, read_table, text_slices

# Raw counts of a text.
COUNTS = ("chars", "upper", "digits", "symbols", "marks", "words", "distinct", "repeats", "top", "bare",
          "lines", "distinct_lines", "closed_lines")
# Shares: count, of which total.
SHARES = (("upper", "chars"), ("digits", "chars"), ("symbols", "chars"), ("marks", "chars"), ("distinct", "words"),
          ("repeats", "words"), ("top", "words"), ("bare", "words"), ("distinct_lines", "lines"),
          ("closed_lines", "lines"))
# Pseudo-counts of each total.
PRIOR = {"chars": 60.0, "words": 12.0, "lines": 2.0}
THRESHOLD = 0.3
TO_POOLED, TO_ROUND = 0.1, 0.02

_ASCII = np.arange(256) < 128
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_LETTER = _UPPER | ((np.arange(256) >= 97) & (np.arange(256) <= 122)) | ~_ASCII
_MARK = np.isin(np.arange(256), [ord(c) for c in ".,;:!?'\"()-"])
_SYMBOL = _ASCII & ~_LETTER & ~_DIGIT & ~_SPACE & ~_MARK & (np.arange(256) > 32)
_CLOSE = np.isin(np.arange(256), [ord(c) for c in ".!?:\")"]) | ~_ASCII
_HEAD = (np.arange(256) & 0xC0) != 0x80  # first byte of a character


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    run = np.r_[0, np.cumsum(flags)]
    return run[offsets[1:]] - run[offsets[:-1]]


def _repeats(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: distinct words, words equal to the one before, uses of the most used one."""
    n = len(words.first) - 1
    distinct, again, top = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    if words.n:
        h, owner = words.hashes(), np.repeat(np.arange(n), words.counts())
        same = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
        again += np.bincount(owner[1:][same], minlength=n)
        order = np.lexsort((h, owner))
        h, owner = h[order], owner[order]
        new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])
        distinct += np.bincount(owner[new], minlength=n)
        np.maximum.at(top, owner[new], np.diff(np.r_[new, len(h)]))
    return distinct, again, top


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Texts x COUNTS of a slice."""
    words = Words(data, offsets, ~_SPACE)
    distinct, again, top = _repeats(words)
    letters = np.r_[0, np.cumsum(_LETTER[data] | _DIGIT[data])]
    bare = letters[words.ends] == letters[words.starts]
    # A line is a run without line feeds that holds a word; its end is the end of its last word.
    lines = Words(data, offsets, np.arange(256) != 10)
    last = np.searchsorted(words.ends, lines.ends, side="right") - 1
    full = (last >= 0) & (words.ends[last] > lines.starts) if words.n else np.zeros(lines.n, bool)
    owner = np.repeat(np.arange(len(offsets) - 1), lines.counts())
    n = len(offsets) - 1
    closed = np.zeros(lines.n, bool)
    if words.n:
        closed[full] = _CLOSE[data[words.ends[last[full]] - 1]]
    line_kinds = np.zeros(n, np.int64)
    if full.any():
        h = lines.hashes()[full]
        pairs = np.unique(np.stack([owner[full].astype(np.uint64), h], axis=1), axis=0)
        line_kinds += np.bincount(pairs[:, 0].astype(np.int64), minlength=n)
    count = lambda table: _per_text(table[data], offsets)
    word_owner = np.repeat(np.arange(n), words.counts())
    return np.stack([count(_HEAD), count(_UPPER), count(_DIGIT), count(_SYMBOL), count(_MARK), words.counts(),
                     distinct, again, top, np.bincount(word_owner[bare], minlength=n),
                     np.bincount(owner[full], minlength=n), line_kinds, np.bincount(owner[closed], minlength=n)], axis=1)


def add_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, COUNTS...) of every row."""

    def run(batches):
        for part, data, offs in text_slices(batches):
            c = statistics(data, offs)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c[:, j], pa.int64())
                                                                               for j in range(c.shape[1]))],
                                             names=["doc_id", "held_out", *COUNTS])

    held = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % 5 == 0, F.lit(False))
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return cols.mapInArrow(run, "doc_id long, held_out boolean, " + ", ".join(f"{c} long" for c in COUNTS))


@dataclass
class QualityModel:
    prior: np.ndarray | None = None  # of each share
    means: tuple = ()
    factors: tuple = ()  # inverses of the Cholesky factors
    offset: float = 0.0  # of the log density difference: determinants and class sizes
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = 0.5

    def difference(self, x: np.ndarray) -> np.ndarray:
        """log density of class 1 minus that of class 0, with class sizes."""
        d = []
        for mean, factor in zip(self.means, self.factors):
            z = ((x - mean)[:, None, :] * factor[None]).sum(axis=2)
            d.append((z * z).sum(axis=1))
        return 0.5 * (d[0] - d[1]) + self.offset

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.slope * self.difference(x) + self.shift, -500, 500)))


def transform(counts: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Rows x (shares, log of words, log of mean word length)."""
    at = {c: counts[:, i].astype(float) for i, c in enumerate(COUNTS)}
    out = []
    for (part, total), p in zip(SHARES, prior):
        share = (at[part] + PRIOR[total] * p) / (at[total] + PRIOR[total])
        out.append(np.arcsin(np.sqrt(np.clip(share, 0, 1))))
    size = (at["chars"] + 6 * PRIOR["words"]) / (at["words"] + PRIOR["words"])
    return np.stack([*out, np.log1p(at["words"]) / 4, np.log(size)], axis=1)


def _batch_counts(b: pa.RecordBatch) -> np.ndarray:
    return np.stack([b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in COUNTS], axis=1)


def fit_quality(stats: DataFrame, labels: DataFrame) -> QualityModel:
    """Learn from the rows of ``stats`` that are not held out and have a quality label 0 or 1."""
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    rows = stats.where(~F.col("held_out")).join(y.where("quality IN (0, 1)"), "doc_id")
    known = materialize(rows.select("quality", *COUNTS), "labelled")
    sums = known.agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in COUNTS],
                     F.sum("quality").alias("ones")).first()
    if not sums.n:
        return QualityModel()
    prior = np.array([sums[a] / max(1, sums[b]) for a, b in SHARES])
    if sums.ones in (0, sums.n):
        return QualityModel(prior=prior, constant=float(sums.ones > 0))
    d = len(SHARES) + 2

    def moments(batches):
        total = np.zeros((2, 1 + d + d * d))
        for b in batches:
            q = b.column(0).to_numpy(zero_copy_only=False)
            x = transform(_batch_counts(b), prior)
            for k in (0, 1):
                own = x[q == k]
                total[k] += np.r_[len(own), own.sum(axis=0), (own[:, :, None] * own[:, None, :]).sum(axis=0).ravel()]
        for k in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(total.shape[1], k, np.int32)),
                                              pa.array(np.arange(total.shape[1], dtype=np.int32)),
                                              pa.array(total[k])], names=["quality", "at", "sum"])

    added = known.mapInArrow(moments, "quality int, at int, sum double").groupBy("quality", "at").agg(F.sum("sum").alias("s"))
    total = np.zeros((2, 1 + d + d * d))
    for r in added.collect():  # 2 x (1 + d + d * d) numbers
        total[r.quality, r["at"]] = r.s
    sizes, means, scatter = total[:, 0], [], []
    for k in (0, 1):
        mean = total[k, 1:1 + d] / sizes[k]
        means.append(mean)
        scatter.append(total[k, 1 + d:].reshape(d, d) - sizes[k] * np.outer(mean, mean))
    pooled = (scatter[0] + scatter[1]) / max(1.0, sizes.sum() - 2)
    factors, logdet = [], []
    for k in (0, 1):
        own = scatter[k] / max(1.0, sizes[k] - 1)
        # Fewer rows than a few per dimension lean on the pooled covariance.
        lean = max(TO_POOLED, d / (d + sizes[k]))
        c = (1 - lean) * own + lean * pooled
        c = (1 - TO_ROUND) * c + TO_ROUND * (np.trace(c) / d + 1e-6) * np.eye(d)
        lower = np.linalg.cholesky(c)
        factors.append(np.linalg.inv(lower))
        logdet.append(2 * np.log(np.diag(lower)).sum())
    offset = 0.5 * (logdet[0] - logdet[1]) + np.log(sizes[1] / sizes[0])
    model = QualityModel(prior, tuple(means), tuple(factors), float(offset), constant=None)
    _calibrate(model, known)
    return model


def _calibrate(model: QualityModel, known: DataFrame) -> None:
    """Slope and shift of the logistic curve, from a histogram of the differences."""
    width, last = 0.5, 200

    def bins(batches):
        for b in batches:
            diff = model.difference(transform(_batch_counts(b), model.prior))
            at = np.clip(np.round(diff / width), -last, last).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at)], names=["quality", "at"])

    rows = known.mapInArrow(bins, "quality int, at int").groupBy("quality", "at").agg(F.count("*").alias("n")).collect()
    x = np.array([r["at"] * width for r in rows])
    y = np.array([float(r.quality) for r in rows])
    n = np.array([float(r.n) for r in rows])
    ones = (n * y).sum()
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (n.sum() - ones + 2))  # never quite certain
    best = None
    for slope in np.geomspace(0.02, 1, 40):
        for shift in np.linspace(-4, 4, 41):
            z = slope * x + shift
            loss = (n * (np.logaddexp(0, z) - target * z)).sum()
            if best is None or loss < best[0]:
                best = (loss, slope, shift)
    model.slope, model.shift = float(best[1]), float(best[2])


def score_quality(stats: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``stats``."""

    def run(batches):
        for b in batches:
            s = model.score(transform(_batch_counts(b), model.prior) if model.prior is not None
                            else np.zeros((b.num_rows, 1)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s),
                                              pa.array((s >= threshold).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return stats.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = materialize(add_statistics(read_table(spark, sf_dir, "documents")), "statistics")
    return score_quality(stats, fit_quality(stats, read_table(spark, sf_dir, "labels")))
