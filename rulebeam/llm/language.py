"""Language identification: averaged hashed subword embeddings with a linear
softmax, trained by stochastic gradient descent in numpy, with calibrated rejection.

Subwords are the 3- and 4-byte runs of a lower-cased word and its borders, hashed
to ``BUCKETS`` rows of an embedding table. A text's vector is the mean of its
subwords' embeddings; a linear layer and softmax give a probability per language.

Fit: about ``SAMPLE`` labelled rows in all, as many of each language (all of a rarer one, and
``LEAST`` at least), of the ``MOST_LANGUAGES`` most frequent languages and of about ``SAMPLE_BYTES`` of text at
most (fewer rows where texts are long, never parts of texts), taken by a hash of doc_id and text over the whole table (never by
position), whole texts. Rows of one doc_id and equal text are drawn together and collected once with their
number; where these make more than twice the rows meant for a language, all its numbers are cut in
proportion, to one at least. Their subword counts (at most BUCKETS numbers a row) are made on the
executors; the driver gets them as Arrow batches of narrow integers, 3 bytes a subword as a rule, and trains on
these in place. Every fifth
row of the sample is kept out of training and fixes two numbers: the temperature that
makes the probabilities fit, and the rejection threshold, below which ``REJECT_SHARE``
of these rows of known languages lie (0.5 at most).

Prediction: one pass over all texts with a table of BUCKETS x languages numbers.
Only the text is an input. A null text or one without letters is ``und`` with score
0 and is rejected; so is every text if no language was learned. Rows pass through
one by one; ties between languages go to the first in name order; a null doc_id is
never held out; extra columns pass by unread.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_name, read_table, text_slices

BUCKETS_BITS = 15
BUCKETS = 1 << BUCKETS_BITS
DIMENSION = 16
SAMPLE, LEAST = 6000, 50
# Bounds of what the driver gets: bytes of the texts whose subwords it learns from, and languages.
SAMPLE_BYTES, MOST_LANGUAGES = 32 << 20, 256
EPOCHS = 6
RATE = 0.5
REJECT_SHARE = 0.001
UNKNOWN = "und"

_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 256)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_MULTIPLY = np.uint32(2654435761)
# Subwords and their counts on their way to the driver. A row's counts have the first type that holds them all.
_IDS, _COUNTS = np.dtype("<u2"), [np.dtype(t) for t in ("<u1", "<u2", "<u4")]


def subwords(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For 3- and 4-byte runs: (buckets of all texts of a slice in order,
    bounds per text, one more than texts)."""
    n = len(offsets) - 1
    buf = np.full(len(data) + n + 1, 0x20, np.uint8)
    buf[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = _FOLD[data]
    heads = offsets + np.arange(n + 1)  # a border before each text, one behind the last
    letter = buf != 0x20
    wide = buf.astype(np.uint32)
    out = []
    key = wide[:-1] | (wide[1:] << np.uint32(8))
    inside = letter[1:]
    for size in (3, 4):
        key = key[:-1] | (wide[size - 1:] << np.uint32(8 * (size - 1)))
        valid = inside[:len(key)] if size == 3 else inside[:len(key)] & letter[2:2 + len(key)]
        at = np.flatnonzero(valid)
        k = key[at] * _MULTIPLY + np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF)
        out.append(((k >> np.uint32(32 - BUCKETS_BITS)).astype(np.int32), np.searchsorted(at, heads)))
    return out


def has_letters(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text: whether it holds a letter of any script."""
    plain = np.r_[0, np.cumsum((_FOLD[data] != 0x20) & (data < 0x80))]
    found = plain[offsets[1:]] > plain[offsets[:-1]]
    other = np.r_[0, np.cumsum(data >= 0x80)]
    for i in np.flatnonzero(~found & (other[offsets[1:]] > other[offsets[:-1]])).tolist():
        text = data[offsets[i]:offsets[i + 1]].tobytes().decode("utf-8", "replace")
        found[i] = any(c.isalpha() for c in text)
    return found


@dataclass
class LanguageModel:
    languages: list[str] = field(default_factory=list)
    table: np.ndarray | None = None  # BUCKETS x languages, embedding times linear layer
    bias: np.ndarray | None = None
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, grams: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        n = len(grams[0][1]) - 1
        total, count = np.zeros((n, len(self.languages))), np.zeros(n)
        for buckets, bounds in grams:
            count += np.diff(bounds)
            for j in range(len(self.languages)):
                run = np.r_[0.0, np.cumsum(self.table[:, j][buckets])]
                total[:, j] += run[bounds[1:]] - run[bounds[:-1]]
        return total / np.maximum(count, 1)[:, None] + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        return _softmax(logits / self.temperature)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 11) -> LanguageModel:
    """rows: (language, buckets, counts) in a fixed order."""
    languages = sorted({r[0] for r in rows})
    if not languages:
        return LanguageModel()
    code = {x: i for i, x in enumerate(languages)}
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 0.1, (BUCKETS, DIMENSION))
    linear, bias = np.zeros((DIMENSION, len(languages))), np.zeros(len(languages))
    kept, checks = [r for i, r in enumerate(rows) if i % 5], [r for i, r in enumerate(rows) if i % 5 == 0]
    steps, done = EPOCHS * max(1, len(kept)), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(kept)).tolist():
            name, buckets, counts = kept[i]
            share = counts / counts.sum()
            hidden = (embed[buckets] * share[:, None]).sum(axis=0)
            error = _softmax(((hidden[:, None] * linear).sum(axis=0) + bias)[None])[0]
            error[code[name]] -= 1
            rate = RATE * (1 - done / steps)
            back = (linear * error).sum(axis=1)
            linear -= rate * hidden[:, None] * error
            bias -= rate * 0.01 * error
            embed[buckets] -= (rate * 20 * share)[:, None] * back
            done += 1
    table = np.stack([(embed * linear[:, j]).sum(axis=1) for j in range(len(languages))], axis=1)
    model = LanguageModel(languages, table, bias)
    if checks:
        logits = np.stack([(table[b] * (c / c.sum())[:, None]).sum(axis=0) + bias for _, b, c in checks])
        truth = np.array([code[r[0]] for r in checks])
        at = np.arange(len(truth))

        def loss(t):
            return -np.log(np.maximum(_softmax(logits / t)[at, truth], 1e-12)).mean()

        model.temperature = float(min(np.geomspace(0.5, 10, 40), key=loss))
        sure = np.sort(model.probabilities(logits).max(axis=1))
        model.threshold = float(min(0.5, sure[int(REJECT_SHARE * len(sure))]))
    return model


def _packed(counts: np.ndarray) -> bytes:
    return counts.astype(next(t for t in _COUNTS if counts.max(initial=0) <= np.iinfo(t).max)).tobytes()


def _unpacked(ids: memoryview, counts: memoryview) -> tuple[np.ndarray, np.ndarray]:
    """The subwords and counts of a row, over the memory given."""
    buckets = np.frombuffer(ids, _IDS)
    return buckets, np.frombuffer(counts, next(t for t in _COUNTS if t.itemsize * len(buckets) == counts.nbytes))


def _held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def _spread() -> F.Column:
    """A number from 0 to 1 by which a row is drawn."""
    return F.shiftrightunsigned(F.xxhash64("doc_id", "text", F.lit("language sample")), 11) / F.lit(float(1 << 53))


def fit_language(docs: DataFrame, sample_rows: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES,
                 most_languages: int = MOST_LANGUAGES) -> LanguageModel:
    """Learn from rows of ``docs`` (doc_id, text, lang) that are not held out, of the ``most_languages`` most
    frequent languages: about ``sample_rows`` whole texts of about ``sample_bytes`` together at most."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    rows = rows.where(~_held_out())
    # The languages are the model's classes; the driver needs their names and sizes anyway.
    sizes = {r.lang: r for r in rows.groupBy("lang").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("size"))
             .orderBy(F.desc("n"), "lang").limit(most_languages).collect()}
    if not sizes:
        return LanguageModel()
    per_language, bytes_each = max(LEAST, sample_rows // len(sizes)), sample_bytes / len(sizes)
    share = F.create_map(*[F.lit(x) for lang, r in sorted(sizes.items())
                           for x in (lang, min(per_language / r.n, bytes_each / max(1, r.size)))])
    sample = (rows.withColumn("spread", _spread()).where(F.col("spread") < F.try_element_at(share, F.col("lang")))
              .groupBy("spread", "lang").agg(F.count("*").alias("copies"), F.min("text").alias("text")))

    def features(batches):
        for part, data, offs in text_slices(batches):
            grams, ok = subwords(data, offs), has_letters(data, offs)
            ids, cnt = [], []
            for i in range(part.num_rows):
                both = np.concatenate([b[at[i]:at[i + 1]] for b, at in grams])
                u, c = np.unique(both, return_counts=True)
                ids.append(u.astype(_IDS).tobytes() if ok[i] else b"")
                cnt.append(_packed(c) if ok[i] else b"")
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(3)), pa.array(ids, pa.binary()),
                                              pa.array(cnt, pa.binary())],
                                             names=["spread", "lang", "copies", "ids", "counts"])

    got = sample.mapInArrow(features, "spread double, lang string, copies long, ids binary, counts binary").toArrow()
    spread, langs, numbers = (got.column(c).to_pylist() for c in ("spread", "lang", "copies"))
    ids, cnt = ([x.as_buffer() for x in got.column(c)] for c in ("ids", "counts"))
    order = sorted((i for i in range(got.num_rows) if ids[i].size), key=lambda i: (spread[i], langs[i]))
    drawn = Counter()
    for i in order:
        drawn[langs[i]] += numbers[i]
    learned = []
    for i in order:
        copies = numbers[i]
        if drawn[langs[i]] > 2 * per_language:
            copies = max(1, copies * per_language // drawn[langs[i]])
        learned += [(langs[i], *_unpacked(memoryview(ids[i]), memoryview(cnt[i])))] * copies
    return train(learned)


def identify(docs: DataFrame, model: LanguageModel, keep: list[str] | None = None) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, rejected; with ``keep`` (text among them), these
    columns of ``docs`` and the last three, with underscores before names that are taken."""
    extra = docs.select(*(keep or [F.col("doc_id").cast("long").alias("doc_id"), _held_out().alias("held_out"),
                                   F.col("text").cast("string").alias("text")]))
    place = extra.columns.index("text")
    names = [c for c in extra.columns if c != "text" or keep]
    fields = [f for f in extra.schema.fields if f.name in names]
    found = [fresh_name(c, names) for c in ("lang_pred", "score", "rejected")]
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields),
                     *(f"`{c}` {kind}" for c, kind in zip(found, ("string", "double", "boolean")))])

    def run(batches):
        for part, data, offs in text_slices(batches):
            letters = has_letters(data, offs)
            n = part.num_rows
            if model.languages:
                p = model.probabilities(model.logits(subwords(data, offs)))
                best = p.argmax(axis=1)
                score = np.where(letters, p[np.arange(n), best], 0.0)
                pred = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters.tolist())]
            else:
                score, pred = np.zeros(n), [UNKNOWN] * n
            rejected = ~letters | (score < model.threshold) | (not model.languages)
            cols = [part.column(i) for i in range(part.num_columns) if keep or i != place]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(pred, pa.string()), pa.array(np.clip(score, 0, 1)),
                                              pa.array(rejected)], names=[*names, *found])

    return extra.mapInArrow(run, ddl)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, fit_language(docs))
