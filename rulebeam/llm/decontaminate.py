"""Benchmark decontamination by winnowing.

Words are hashed to 64 bits; a text's k-grams are hashed from these. In every run
of ``w`` consecutive k-grams (k + w - 1 = the window length) the smallest hash is
kept as a fingerprint, on both sides. Equal windows keep the same k-gram, so every
span of a window's length that a document shares with an item gives a common
fingerprint at the same place: none is missed. Items shorter than a
window are one window of their own length n; for each such length (at most
window - 1 of them) all n-grams are fingerprints.

A fingerprint carries the word hashes around it, up to the end of the last window that holds it
on either side. Document and item fingerprints are joined on their hash, and a hit is extended
to the left and right as far as the words agree; windows inside the agreeing run are hits.

A document emits only fingerprints whose slot is set in a filter of fixed
size (2^23 bits, whatever the benchmark's size) made from the item fingerprints. It
lets through every fingerprint that an item has, so it only saves work.
The join is left to Spark: it broadcasts the item side only below the
session's size limit, and splits frequent fingerprints otherwise.

Defined results: null and empty texts have no words; rows with repeated
or null doc_id are counted row by row; items with a null id or no
words take no part; repeated items count once by id; extra columns pass by unread.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import LOWER, Words, mix, read_table, text_slices

WINDOW = 10
GRAM = 5
FILTER_BITS = 23

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = True
_WORD[0x61:0x7B] = True
_WORD[0x80:] = True
_ODD = np.uint64(0xD6E8FEB86659FD93)
_HIT = "array<struct<n:int,fp:long,at:int,left:int,words:array<long>>>"


def _gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive words (salted by n)."""
    g = np.full(max(0, len(h) - n + 1), np.uint64(n))
    for j in range(n):
        g = g * _ODD + h[j:j + len(g)]
    return mix(g)


def _inside(owner: np.ndarray, n: int) -> np.ndarray:
    """For each start of n consecutive words: whether they are of one text."""
    return owner[:len(owner) - n + 1] == owner[n - 1:]


def _winnow(h, owner, window: int, gram: int):
    """Fingerprints of a slice: (positions, hashes); position of the leftmost
    smallest gram of each window."""
    if len(h) < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = _gram_hashes(h, gram)
    starts = np.flatnonzero(_inside(owner, window))
    best, where = g[starts].copy(), starts.copy()
    for j in range(1, window - gram + 1):
        other = g[starts + j]
        less = other < best
        best[less] = other[less]
        where[less] = starts[less] + j
    at = np.unique(where)
    return at, g[at]


def _fingerprints(words: Words, window: int, gram: int, short: list[int]):
    """Lists over the slice: kind n (window for long ones), word position, hash."""
    h = words.hashes()
    owner = np.repeat(np.arange(len(words.first) - 1), words.counts())
    at, fp = _winnow(h, owner, window, gram)
    kinds, ats, fps = [np.full(len(at), window)], [at], [fp]
    for n in short:
        if len(h) >= n:
            s = np.flatnonzero(_inside(owner, n))
            kinds.append(np.full(len(s), n))
            ats.append(s)
            fps.append(_gram_hashes(h, n)[s])
    return h, owner, np.concatenate(kinds), np.concatenate(ats), np.concatenate(fps)


def _slots(fp: np.ndarray) -> np.ndarray:
    return (fp >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _hits_array(words, h, owner, kinds, ats, fps, window, gram):
    """Per text of the slice: its fingerprints with the words around them."""
    n_texts = len(words.first) - 1
    order = np.lexsort((ats, owner[ats])) if len(ats) else np.zeros(0, np.int64)
    kinds, ats, fps = kinds[order], ats[order], fps[order]
    who = owner[ats] if len(ats) else np.zeros(0, np.int64)
    first, stop = words.first[:-1][who], words.first[1:][who]
    long = kinds == window
    reach = window - gram
    lo = np.where(long, np.maximum(ats - reach, first), ats)
    hi = np.where(long, np.minimum(ats + gram + reach, stop), ats + kinds)
    sizes = hi - lo
    offs = np.r_[0, np.cumsum(sizes)].astype(np.int32)
    take = np.arange(int(offs[-1])) - np.repeat(offs[:-1], sizes) + np.repeat(lo, sizes)
    around = pa.ListArray.from_arrays(pa.array(offs), pa.array(h[take].view(np.int64) if len(take) else
                                                               np.zeros(0, np.int64)))
    items = pa.StructArray.from_arrays(
        [pa.array(kinds.astype(np.int32)), pa.array(fps.astype(np.uint64).view(np.int64)),
         pa.array((ats - first).astype(np.int32)), pa.array((ats - lo).astype(np.int32)), around],
        names=["n", "fp", "at", "left", "words"])
    bounds = np.searchsorted(who, np.arange(n_texts + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), items)


def fingerprint_rows(df: DataFrame, key: str, window: int, gram: int, short: list[int],
                     passing: np.ndarray | None = None, whole_short: bool = False) -> DataFrame:
    """(key, n_words, hits) of each row of ``df`` (key, text). ``passing``: the
    filter's bits; ``whole_short``: a text shorter than a window is one window (items)."""

    def run(batches):
        for part, data, offs in text_slices(batches, "text"):
            words = Words(LOWER[data], offs, _WORD)
            n_words = words.counts()
            h, owner, kinds, ats, fps = _fingerprints(words, window, gram, range(1, window) if whole_short else short)
            if whole_short:  # of short grams only those that are a whole item
                keep = (kinds == window) | (n_words[owner[ats]] == kinds)
                kinds, ats, fps = kinds[keep], ats[keep], fps[keep]
            if passing is not None:
                s = _slots(fps)
                keep = (passing[s >> 3] >> (s & 7).astype(np.uint8)) & 1 == 1
                kinds, ats, fps = kinds[keep], ats[keep], fps[keep]
            hits = _hits_array(words, h, owner, kinds, ats, fps, window, gram)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words, pa.int64()), hits],
                                             names=["key", "n_words", "hits"])

    kind = dict(df.dtypes)[key]
    cols = df.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text"))
    return cols.mapInArrow(run, f"key {kind}, n_words long, hits {_HIT}")


def _filter_bits(items: DataFrame) -> np.ndarray:
    """The filter of the items' fingerprints: 2^FILTER_BITS bits, gathered as at
    most 2^(FILTER_BITS - 6) words of 64 bits."""
    slot = F.shiftrightunsigned("fp", 64 - FILTER_BITS)
    rows = (items.select(F.shiftright(slot, 6).alias("word"), slot.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
            .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toPandas())
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    out[rows["word"].to_numpy(np.int64)] = rows["bits"].to_numpy(np.int64)
    return out.view(np.uint8)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM,
                  scratch: str = "contamination") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, item_ids (sorted
    strings), contaminated."""
    if not 1 <= gram <= window:
        raise ValueError("a gram is at most a window")
    items = materialize(fingerprint_rows(benchmark.where("item_id IS NOT NULL").select("item_id", "text"), "item_id",
                                         window, gram, [], whole_short=True)
                        .select(F.col("key").cast("string").alias("item_id"), F.explode("hits").alias("i"))
                        .select("item_id", "i.*").distinct(), f"{scratch}-items")
    short = sorted(r.n for r in items.where(F.col("n") < window).select("n").distinct().collect())
    marked = materialize(fingerprint_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id",
                                          window, gram, short, _filter_bits(items))
                         .select(F.monotonically_increasing_id().alias("row"), F.col("key").alias("doc_id"),
                                 "n_words", "hits"), f"{scratch}-docs")
    d = marked.where(F.size("hits") > 0).select("row", F.explode("hits").alias("d"))
    met = (d.select("row", "d.n", "d.fp", "d.at", "d.left", "d.words")
           .join(items.select("item_id", "n", "fp", F.col("left").alias("i_left"), F.col("words").alias("i_words")),
                 ["n", "fp"]))
    # Extend the hit: words that agree to the left and right of the gram's start.
    size = F.when(F.col("n") == window, gram).otherwise(F.col("n"))

    def agree(length, at_d, at_i):
        steps = F.sequence(F.lit(0), length - 1)
        same = F.transform(steps, lambda j: F.get("words", at_d(j)) != F.get("i_words", at_i(j)))
        return F.when(length <= 0, 0).otherwise(F.coalesce(F.nullif(F.array_position(same, True), F.lit(0)) - 1, length))

    right_room = F.least(F.size("words") - F.col("left"), F.size("i_words") - F.col("i_left"))
    left_room = F.least("left", "i_left")
    run = (met.withColumn("right", agree(right_room, lambda j: F.col("left") + j, lambda j: F.col("i_left") + j).cast("int"))
           .withColumn("back", agree(left_room, lambda j: F.col("left") - 1 - j,
                                     lambda j: F.col("i_left") - 1 - j).cast("int"))
           .where((F.col("right") >= size) & (F.col("right") + F.col("back") >= F.col("n"))))
    spans = run.select("row", "item_id", (F.col("at") - F.col("back")).alias("lo"),
                       (F.col("at") + F.col("right")).alias("hi"))
    # Join overlapping spans of a row by one pass in order of their starts.
    hit = spans.groupBy("row").agg(F.collect_set("item_id").alias("ids"),
                                   F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("spans"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate("spans", zero, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["hi"] - F.greatest(acc["end"], s["lo"]))).alias("n"),
        F.greatest(acc["end"], s["hi"]).alias("end")))
    hit = hit.select("row", F.array_sort("ids").alias("item_ids"), covered["n"].cast("long").alias("n_hit"))
    none = F.array().cast("array<string>")
    return (marked.drop("hits").join(hit, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("item_ids", none).alias("item_ids"))
            .withColumn("contaminated", F.col("n_hit") > 0))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return r.select("doc_id", "n_words", "n_hit", "n_items",
                    F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
i AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
iw AS (
  SELECT DISTINCT item_id, n, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s
        FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT r, n, s, array_to_string(list_slice(w, s, s + n - 1), ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, s, n, item_id FROM dw JOIN iw USING (n, g)),
words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT r, s, n FROM hits)) GROUP BY r),
ids AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(words.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(ids.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids.ids, '')) AS items_sha256,
       coalesce(words.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN ids USING (r)
"""
