import hashlib
import random
import re

from pyspark.sql import Row
from pyspark.sql import functions as F

from rulebeam.llm.decontaminate import decontaminate, op4_benchmark_decontamination

SF001 = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute(docs, items, size=10):
    grams = {}
    for i, t in items:
        w = words(t)
        n = min(len(w), size)
        if i is not None and n:
            for s in range(len(w) - n + 1):
                grams.setdefault(tuple(w[s:s + n]), set()).add(str(i))
    lengths = {len(g) for g in grams}
    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if (g := tuple(w[s:s + n])) in grams:
                    hit.update(range(s, s + n))
                    ids |= grams[g]
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(df):
    if "items_sha256" not in df.columns:
        df = df.withColumn("items_sha256", F.sha2(F.array_join("item_ids", ","), 256))
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r[n] for n in names) for r in df.select(*names).collect()), key=str)


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF001}/benchmark.parquet").select("item_id", "text").collect()
    want = brute(docs, items)
    assert any(r[5] for r in want)
    assert rows(op4_benchmark_decontamination(spark, SF001)) == want


def test_small_alphabet_has_every_kind_of_overlap(spark):
    """Few words, so windows repeat and overlap; items of 0 to 25 words."""
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["A", "b", "é", "7"]) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([0, 7, 8, 9, 9, 10, 11, 14, 25])] + [(None, text(10)), (5, text(12)), (3, None)]
    docs = [(i % 150, text(rng.randint(0, 400))) for i in range(160)] + [(None, text(300)), (200, None), (201, "")]
    d = spark.createDataFrame([Row(doc_id=a, text=b, n="x", row="y") for a, b in docs],
                              "doc_id long, text string, n string, row string")
    b = spark.createDataFrame([Row(item_id=a, text=b, hits="x") for a, b in items], "item_id long, text string, hits string")
    want = brute(docs, items)
    assert 0 < sum(r[5] for r in want) < len(want)
    assert rows(decontaminate(d, b)) == want


def test_long_text_and_empty_tables(spark):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, "pad " * 300_000 + item + " pad" * 300_000), (2, item.upper()), (3, item[:-4])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([("k", item)], "item_id string, text string")
    assert rows(decontaminate(d, b)) == brute(docs, [("k", item)])
    assert rows(decontaminate(d, b.limit(0))) == brute(docs, [])
    assert decontaminate(d.limit(0), b).count() == 0
