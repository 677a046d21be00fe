import re
from collections import Counter

import pytest
from pyspark.sql import Row

from rulebeam.llm.license_texts import NOTICES
from rulebeam.llm.licenses import _bounds, _prefix, op8_license_scan, scan_licenses, templates

SF001 = "/root/testdata/sf0.001"
KNOWN = templates()


def brute(docs, threshold=0.8):
    out = []
    for d, t in docs:
        found = []
        for part in {*(t or "").split("\n"), *re.split("\n[ \t\r]*\n", t or ""), t or ""}:
            w = re.findall("[a-z0-9]+", part.translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))
            unit = Counter(zip(w, w[1:]))
            scores = []
            for _, name, bigrams in KNOWN:
                common = sum((unit & Counter(tuple(b.split()) for b in bigrams)).values())
                dice = 2.0 * common / max(1, len(w) - 1 + len(bigrams))
                if dice >= threshold:
                    scores.append((-dice, name))
            if scores:
                found.append(min(scores))
        names = sorted({n for _, n in found})
        out.append((d, len(found), ",".join(names), min(found)[1] if found else None, -min(found)[0] if found else None))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.doc_id, r.n_units, r.licenses, r.best_license, r.best_dice) for r in df.collect()), key=str)


def test_query_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    want = brute(docs)
    assert any(r[1] for r in want)
    assert rows(op8_license_scan(spark, SF001)) == want


def test_edge_cases(spark):
    mit = NOTICES[0][1]
    wrapped = re.sub(r"(.{60}\S*) ", r"\1\n", mit)
    data = [(1, None), (1, ""), (None, "Licensed under CC BY 4.0"), (None, "Licensed under CC BY 4.0"), (2, mit),
            (3, "my file\n \n" + wrapped + "\n\ncode here"), (4, mit.upper().replace("AUTHORS", "writers")),
            (5, "word " * 300_000 + "\nReleased under the MIT License."), (6, "mit"), (7, mit + " " + mit),
            (8, "Released under the BSD 3-Clause License!\nreleased under the bsd 3 clause license\nLicensed under MIT"),
            (8, "licensed UNDER the gnu general public license version 2"), (9, "é " * 50)]
    df = spark.createDataFrame([Row(doc_id=d, text=t, row=1, licenses="x", words="y") for d, t in data],
                               "doc_id long, text string, row int, licenses string, words string")
    assert rows(scan_licenses(df)) == brute(data)
    assert scan_licenses(df.limit(0)).count() == 0


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.95, 1.0])
def test_prefix_and_bounds_lose_no_unit(threshold):
    """The smallest overlap that reaches the threshold can't avoid the prefix."""
    for _, _, bigrams in KNOWN:
        least, most = _bounds(len(bigrams), threshold)
        assert 2 * (least - 1) / (least - 1 + len(bigrams)) < threshold <= 2 * least / (least + len(bigrams)) + 1e-9
        assert 2 * len(bigrams) / (most + 1 + len(bigrams)) < threshold
        outside = sorted((Counter(bigrams) - Counter()).elements())
        kept = [b for b in outside if b not in _prefix(bigrams, threshold)]
        assert len(kept) < least


def test_no_python_in_the_plan(spark):
    plan = scan_licenses(spark.read.parquet(f"{SF001}/documents.parquet"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)
