"""Licence scans with DataFrame operations only: text units compared with licence templates by
the Dice coefficient over word bigrams.

Units of a document are its lines, its paragraphs (split at blank lines) and the whole
text, each different text once. A unit is normalised: A-Z in lower case, every run of other
characters than a-z and 0-9 one space. Dice is 2 * common / (bigrams of the unit + bigrams of the
template), counted with repeats.

Candidates: a Dice of t needs sizes within the factor t / (2 - t) of each other, and at
least t / (2 - t) of a template's bigrams in common. So a unit must hold one of the first
few bigrams of the template in any fixed order (all but that share, plus one); the order puts long
bigrams first, which are rare. Only units with such a bigram and a
fitting size are scored. The template tables are fixed lists of this package and are broadcast; their size
does not depend on the input.

Defined results: null and empty texts, and units of fewer than two words, match nothing; a
unit takes its best template (ties: the first license in name order); each row has
one result row, also for repeated or null doc_ids; extra columns pass by unread.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table
from .license_texts import NAMES, NOTICES, PHRASES

THRESHOLD = 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def templates() -> list[tuple[int, str, list[str]]]:
    """(number, license, bigrams) of every template."""
    texts = NOTICES + [(name, phrase.format(words)) for name, words in NAMES for phrase in PHRASES]
    out = []
    for number, (name, text) in enumerate(texts):
        words = re.findall("[a-z0-9]+", text.lower())
        out.append((number, name, [f"{a} {b}" for a, b in zip(words, words[1:])]))
    return out


def _bounds(n: int, threshold: float) -> tuple[int, int]:
    """Sizes of units that can reach the threshold with a template of n bigrams."""
    share = threshold / (2 - threshold)
    return math.ceil(n * share - 1e-9), math.floor(n / share + 1e-9)


def _prefix(bigrams: list[str], threshold: float) -> list[str]:
    """Bigrams of which a unit that reaches the threshold has one at least."""
    order = sorted(bigrams, key=lambda b: (-len(b), b))
    return sorted(set(order[:len(order) - _bounds(len(order), threshold)[0] + 1]))


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, _UPPER, _LOWER), "[^a-z0-9]+", " "))


def scan_licenses(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of ``docs``: doc_id, n_units (units that match), licenses (their best licenses,
    sorted), best_license, best_dice."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold is over 0 and at most 1")
    spark, known = docs.sparkSession, templates()
    prefix = F.broadcast(spark.createDataFrame(
        [(b, number, *_bounds(len(bigrams), threshold)) for number, _, bigrams in known
         for b in _prefix(bigrams, threshold)], "bigram string, template int, least int, most int"))
    counted = F.broadcast(spark.createDataFrame(
        [(number, b, k) for number, _, bigrams in known for b, k in sorted(Counter(bigrams).items())],
        "template int, bigram string, there int"))
    named = F.broadcast(spark.createDataFrame([(number, name, len(b)) for number, name, b in known],
                                              "template int, license string, size int"))
    low = min(_bounds(len(b), threshold)[0] for _, _, b in known)
    high = max(_bounds(len(b), threshold)[1] for _, _, b in known)

    # Rows of equal doc_id and text have the same result, so these two name a row.
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .withColumn("row", F.struct("doc_id", F.xxhash64("text").alias("h"))))
    every = F.array_union(F.array_union(F.split("text", "\n"), F.split("text", "\n[ \t\r]*\n")), F.array("text"))
    units = (rows.where("text <> ''").select("row", F.posexplode(every).alias("unit", "part"))
             .select("row", "unit", F.split(_normal(F.col("part")), " ").alias("words"))
             .withColumn("n", F.size("words") - 1).where(F.col("n").between(low, high)))
    bigram = F.concat_ws(" ", "word", F.get("words", F.col("at") + 1))
    each = (units.select("row", "unit", "n", "words", F.posexplode("words").alias("at", "word"))
            .where("at < n").withColumn("bigram", bigram))
    candidates = (each.join(prefix, "bigram").where("n BETWEEN least AND most")
                  .select("row", "unit", "n", "words", "template").distinct())
    # Exact scores of the candidates.
    held = (candidates.select("row", "unit", "n", "template", "words", F.posexplode("words").alias("at", "word"))
            .where("at < n").withColumn("bigram", bigram)
            .groupBy("row", "unit", "n", "template", "bigram").agg(F.count("*").alias("here")))
    common = (held.join(counted, ["template", "bigram"])
              .groupBy("row", "unit", "n", "template").agg(F.sum(F.least("here", "there")).alias("common")))
    dice = F.lit(2.0) * F.col("common") / (F.col("n") + F.col("size"))
    scored = common.join(named, "template").withColumn("dice", dice).where(F.col("dice") >= threshold)
    best = scored.groupBy("row", "unit").agg(F.min(F.struct(-F.col("dice"), "license")).alias("b"))
    per_row = best.groupBy("row").agg(F.count("*").alias("n_units"), F.sort_array(F.collect_set("b.license")).alias("l"),
                                      F.min("b").alias("b"))
    return (rows.select("row").join(per_row, "row", "left")
            .select(F.col("row.doc_id").alias("doc_id"), F.coalesce("n_units", F.lit(0)).alias("n_units"),
                    F.coalesce(F.array_join("l", ","), F.lit("")).alias("licenses"),
                    F.col("b.license").alias("best_license"), (-F.col("b.col1")).alias("best_dice")))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op8_sql(threshold: float = THRESHOLD) -> str:
    """The same result in DuckDB SQL, every unit against every template."""
    quoted = ", ".join("({}, '{}', [{}])".format(n, name, ", ".join(f"'{b}'" for b in bigrams))
                       for n, name, bigrams in templates())
    return rf"""
WITH t(template, license, b) AS (VALUES {quoted}),
tb AS (SELECT template, bigram, count(*) AS there FROM (SELECT template, unnest(b) AS bigram FROM t) GROUP BY ALL),
d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
u AS (
  SELECT r, part, string_split(trim(regexp_replace(translate(part, '{_UPPER}', '{_LOWER}'), '[^a-z0-9]+', ' ', 'g')),
                               ' ') AS w
  FROM (SELECT DISTINCT r, unnest(list_concat(string_split(text, chr(10)),
                                              regexp_split_to_array(text, '\n[ \t\r]*\n'), [text])) AS part
        FROM d WHERE text <> '')),
ub AS (
  SELECT r, part, bigram, count(*) AS here
  FROM (SELECT r, part, w[i] || ' ' || w[i + 1] AS bigram
        FROM (SELECT r, part, w, unnest(range(1, len(w))) AS i FROM u))
  GROUP BY ALL),
s AS (
  SELECT ub.r, ub.part, t.license, 2.0::DOUBLE * sum(least(here, there)) / (any_value(len(u.w)) - 1 + any_value(len(t.b))) AS dice
  FROM ub JOIN tb USING (bigram) JOIN t USING (template) JOIN u ON u.r = ub.r AND u.part = ub.part
  GROUP BY ub.r, ub.part, template, t.license),
best AS (
  SELECT r, part, first(license ORDER BY dice DESC, license) AS license, max(dice) AS dice
  FROM s WHERE dice >= {threshold} GROUP BY r, part),
per AS (
  SELECT r, count(*) AS n_units, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
         first(license ORDER BY dice DESC, license) AS best_license, max(dice) AS best_dice
  FROM best GROUP BY r)
SELECT doc_id, CAST(coalesce(n_units, 0) AS BIGINT) AS n_units, coalesce(licenses, '') AS licenses, best_license, best_dice
FROM d LEFT JOIN per USING (r)
"""
