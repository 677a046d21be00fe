import zlib
from collections import Counter

import numpy as np
from pyspark.sql import Row
from pyspark.sql import functions as F

from rulebeam.llm.language import (LanguageModel, fit_language, has_letters, identify, op6_language_id, subwords,
                                   train)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def slice_of(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])


def brute_grams(text, size):
    b = (" " + "".join(c.lower() if c.isascii() and c.isalpha() else c if ord(c) > 127 else " " for c in text) + " ").encode()
    return [b[i:i + size] for i in range(len(b) - size + 1) if b" " not in b[i + 1:i + size - 1]]


def test_subwords_are_the_grams_of_each_text_alone():
    texts = ["Ab, c", "", "é1", "x", "  ", "The end", "z"]
    found = subwords(*slice_of(texts))
    for size, (buckets, bounds) in zip((3, 4), found):
        for i, t in enumerate(texts):
            key = [int.from_bytes(g, "little") for g in brute_grams(t, size)]
            want = [((k * 2654435761 + (size * 0x9E3779B1)) & 0xFFFFFFFF) >> 17 for k in key]
            assert buckets[bounds[i]:bounds[i + 1]].tolist() == want


def test_letters_of_any_script():
    texts = ["", "12 .", "a", "é", "—…", "中", "  Я1", "½"]
    assert has_letters(*slice_of(texts)).tolist() == [any(c.isalpha() for c in t) for t in texts]


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = op6_language_id(spark, SF01).collect()
    assert len(got) == len(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    out = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.99 * len(out)
    assert sum(r.rejected for r in got) <= 0.005 * len(got)


def test_only_text_is_an_input_and_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    other = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit("xx"))
                            .otherwise(F.col("lang"))).withColumn("source", F.lit("zz"))
    a, b = fit_language(docs), fit_language(other)
    assert a.languages == b.languages and (a.table == b.table).all()
    blank = identify(docs.withColumn("lang", F.lit(None).cast("string")), a)
    assert sorted(map(tuple, blank.collect())) == sorted(map(tuple, identify(docs, a).collect()))


def test_edge_cases(spark):
    model = fit_language(spark.read.parquet(f"{SF001}/documents.parquet"))
    long = "the and " * 200_000
    data = [(1, None), (2, ""), (3, "123 !!"), (None, "the and of that"), (5, long), (5, long), (6, "中文")]
    df = spark.createDataFrame([Row(doc_id=d, text=t, score="x", lang_pred=3) for d, t in data],
                               "doc_id long, text string, score string, lang_pred long")
    got = {(r.doc_id, i): r for i, r in enumerate(identify(df, model).collect())}
    by = {k[0]: r for k, r in got.items()}
    assert len(got) == 7
    for i in (1, 2, 3):
        assert by[i].lang_pred == "und" and by[i].score == 0 and by[i].rejected
    assert by[None].held_out is False and by[None].lang_pred == by[5].lang_pred == "en"
    assert by[6].lang_pred in model.languages
    assert identify(df.limit(0), model).count() == 0


def test_no_labels_rejects_all(spark):
    df = spark.createDataFrame([(1, "the", None)], "doc_id long, text string, lang string")
    model = fit_language(df)
    assert model.languages == [] and train([]).languages == []
    r = identify(df, model).first()
    assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
    assert LanguageModel().threshold == 0


def test_kept_columns_come_back_as_they_were(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = fit_language(docs)
    back = identify(docs, model, keep=docs.columns)
    assert sorted(map(tuple, back.select(*docs.columns).collect())) == sorted(map(tuple, docs.collect()))


def test_a_frequent_id_is_sampled_like_other_rows(spark, monkeypatch):
    """A third of the rows under one doc_id, of different or of equal texts: the sample keeps its size."""
    from pyspark.sql import functions as F

    from rulebeam.llm import language

    sizes = []
    monkeypatch.setattr(language, "train", lambda rows: sizes.append(len(rows)))
    ids = spark.range(1, 400).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"))
    ids = ids.where("crc32(cast(doc_id AS string)) % 5 <> 0")
    old = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("language sample")), 11) / F.lit(float(1 << 53))
    inside, outside = (ids.where(c).first().doc_id for c in (old < 0.05, old > 0.5))
    copied = ids.where(language._spread() < 0.05).first().doc_id
    base = spark.range(4000).select((F.col("id") + 1000).alias("doc_id"), F.concat(F.lit("some text "), "id").alias("text"))
    for hot, text in ((inside, "concat('hot text ', id)"), (outside, "concat('hot text ', id)"), (None, "concat('hot text ', id)"),
                      (copied, "'the same text'")):
        more = spark.range(2000).select(F.lit(hot).cast("long").alias("doc_id"), F.expr(text).alias("text"))
        language.fit_language(base.unionByName(more).withColumn("lang", F.lit("en")), sample_rows=300)
    print(sizes)
    assert all(220 <= n <= 400 for n in sizes[:3]) and 150 <= sizes[3] <= 600


def test_sample_is_bounded_by_bytes_and_languages(spark, monkeypatch):
    """500 language values, and texts longer than the bound allows for all rows."""
    from pyspark.sql import functions as F

    from rulebeam.llm import language

    seen = []
    monkeypatch.setattr(language, "train", seen.append)
    dirty = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("words of text "), "id").alias("text"),
                                       F.concat(F.lit("l"), F.least(F.col("id") % 1000, F.lit(499))).alias("lang"))
    language.fit_language(dirty)
    drawn = {lang for lang, _, _ in seen[0]}
    assert len(drawn) == language.MOST_LANGUAGES and "l499" in drawn
    assert len(seen[0]) <= 2 * language.LEAST * language.MOST_LANGUAGES
    long = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"),
                                    F.concat(F.expr("repeat('long text ', 1000)"), "id").alias("text"))
    language.fit_language(long, sample_bytes=1 << 20)
    assert 50 <= len(seen[1]) <= 170  # 105 texts of 10 kB are expected


def test_the_driver_gets_narrow_numbers(spark, monkeypatch):
    """Three bytes a subword as a rule; counts of any size come back as they were."""
    from rulebeam.llm import language
    got = []
    monkeypatch.setattr(language, "train", got.extend)
    text = "abc " * 70_000 + "xyz " * 300 + "once"
    fit_language(spark.createDataFrame([(i, t, "en") for i, t in enumerate(["plain words here", text] * 5)],
                                       "doc_id long, text string, lang string"))
    assert got and {len(b) == len(c) for _, b, c in got} == {True}
    small = [r for r in got if r[2].max() < 256]
    assert small and all(b.nbytes + c.nbytes <= 3 * len(b) for _, b, c in small)
    grams = Counter(np.concatenate([b for b, _ in subwords(*slice_of([text]))]).tolist())
    assert any(dict(zip(b.tolist(), c.tolist())) == grams for _, b, c in got)
