import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from rulebeam.llm.quality import (COUNTS, QualityModel, add_statistics, fit_quality, op10_quality_classifier,
                                  score_quality, statistics)

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def brute(text):
    low = lambda c: ord(c) < 128
    words = [w for w in text.replace("\v", " ").replace("\f", " ").replace("\r", " ").replace("\t", " ")
             .replace("\n", " ").split(" ") if w]
    uses = Counter(words)
    lines = [x for x in text.split("\n") if x.strip(" \t\r\v\f")]
    marks = ".,;:!?'\"()-"
    return [len(text), sum("A" <= c <= "Z" for c in text), sum("0" <= c <= "9" for c in text),
            sum(low(c) and not c.isalnum() and 32 < ord(c) and c not in marks for c in text),
            sum(c in marks for c in text), len(words), len(uses), sum(a == b for a, b in zip(words, words[1:])),
            max(uses.values(), default=0), sum(all(low(c) and not c.isalnum() for c in w) for w in words),
            len(lines), len(set(lines)), sum(x.rstrip(" \t\r\v\f")[-1] in '.!?:")' or ord(x.rstrip()[-1]) > 127 for x in lines)]


def slice_of(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(r) for r in raw])


@pytest.mark.parametrize("texts", [
    ["", "a", "The the cat. Cat!\n\n \nx | y\nx | y\n", "", "é ##$ 12 É…", "\n", "A A A B\tB"], [""], ["", ""], ["|"]])
def test_statistics_match_plain_counts(texts):
    got = statistics(*slice_of(texts))
    assert [dict(zip(COUNTS, r)) for r in got.tolist()] == [dict(zip(COUNTS, brute(t))) for t in texts]


def test_held_out_rows_are_told_apart(spark):
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    got = op10_quality_classifier(spark, SF01).collect()
    assert len(got) == spark.read.parquet(f"{SF01}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    out = [(r.score, label[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in label]
    good, bad = [s for s, y, _ in out if y == 1], [s for s, y, _ in out if y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])
    assert auc > 0.97 and sum(p == y for _, y, p in out) >= 0.95 * len(out)


def test_only_the_text_is_an_input_and_held_out_labels_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    stats = add_statistics(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("q")))
    a, b = fit_quality(stats, labels), fit_quality(add_statistics(docs), flipped)
    assert np.allclose(a.means, b.means) and np.allclose(a.factors, b.factors)


def test_log_density_difference_is_that_of_two_gaussians():
    rng = np.random.default_rng(1)
    covs = [np.eye(3) * 2 + 0.3, np.diag([1.0, 2.0, 0.5])]
    means = [np.zeros(3), np.ones(3)]
    factors = [np.linalg.inv(np.linalg.cholesky(c)) for c in covs]
    offset = 0.5 * (np.log(np.linalg.det(covs[0])) - np.log(np.linalg.det(covs[1])))
    model = QualityModel(None, tuple(means), tuple(factors), offset, constant=None)
    x = rng.normal(size=(5, 3))
    want = [-0.5 * (v - means[1]) @ np.linalg.inv(covs[1]) @ (v - means[1]) - 0.5 * np.log(np.linalg.det(covs[1]))
            + 0.5 * (v - means[0]) @ np.linalg.inv(covs[0]) @ (v - means[0]) + 0.5 * np.log(np.linalg.det(covs[0]))
            for v in x]
    assert np.allclose(model.difference(x), want)


def test_edge_cases(spark):
    docs, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_quality(add_statistics(docs), labels)
    data = [(1, None), (2, ""), (None, "The and of."), (3, "word " * 400_000), (3, "word " * 400_000), (4, "## $$ || %%")]
    df = spark.createDataFrame([Row(doc_id=d, text=t, words="x", score="y") for d, t in data],
                               "doc_id long, text string, words string, score string")
    got = score_quality(add_statistics(df), model).collect()
    by = {r.doc_id: r.score for r in got}
    assert len(got) == 6 and by[1] == by[2] and by[3] < 0.3 and by[4] < 0.5 and all(0 <= s <= 1 for s in by.values())
    assert not [r for r in got if r.doc_id is None][0].held_out
    assert score_quality(add_statistics(df.limit(0)), model).count() == 0
    none = fit_quality(add_statistics(docs), labels.limit(0))
    assert {r.score for r in score_quality(add_statistics(df), none).collect()} == {0.5}
    one = fit_quality(add_statistics(docs), labels.where("quality = 1"))
    assert {r.score for r in score_quality(add_statistics(df), one).collect()} == {1.0}
