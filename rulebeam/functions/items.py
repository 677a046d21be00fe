"""Pattern items and their text forms.

A pattern is ``array<struct<feature string, value string>>`` in discovery
order. Its label is ``feature=value AND feature=value ...``.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import spec as S

ITEM_TYPE = T.StructType([T.StructField("feature", T.StringType()), T.StructField("value", T.StringType())])
ITEMS_TYPE = T.ArrayType(ITEM_TYPE)


def quoted(name: str) -> str:
    """A column name as one identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def cell_items(features: Sequence[str]) -> Column:
    """The (feature, value) items of a row, one per feature, with the
    feature's index in generation order."""
    return F.array(*[F.struct(F.lit(i).alias("fidx"), F.lit(f).alias("feature"),
                              F.col(quoted(f)).cast("string").alias("value")) for i, f in enumerate(features)])


def escaped(text: Column, feature: bool = False) -> Column:
    """``text`` as it stands in a label, so that ``parse_pattern_label`` reads it back. Text without the escape
    sign, a word AND or a space at an end is left as it is."""
    out = F.replace(text, F.lit(S.ESCAPE), F.lit(2 * S.ESCAPE))
    if feature:
        out = F.replace(out, F.lit(S.KV_SEP), F.lit(S.ESCAPE + S.KV_SEP))
    word = S.ITEM_SEP.strip()
    out = F.regexp_replace(out, rf"(^| ){word}(?= |\z)", rf"$1\\{word}")
    return F.regexp_replace(F.regexp_replace(out, r" \z", r"\\ "), "^ ", r"\\ ")


def pattern_label(items: Column) -> Column:
    """``f=v AND f=v`` in item order, with the escapes of ``escaped``."""
    return F.array_join(
        F.transform(items, lambda it: F.concat(escaped(it["feature"], True), F.lit(S.KV_SEP), escaped(it["value"]))),
        S.ITEM_SEP)


def pattern_type(items: Column) -> Column:
    """``<k>-Feature``."""
    return F.concat(F.size(items).cast("string"), F.lit(S.PATTERN_TYPE_SUFFIX))


def itemset_key(items: Column) -> Column:
    """Order-free key of a pattern (for optional de-duplication)."""
    return pattern_label(F.array_sort(items))


# Signs of a label: an escaped sign, a separator, or any one character.
_SIGNS = rf"(?s)\\(?:[\\{S.KV_SEP} ]|{S.ITEM_SEP.strip()}(?=[ \\{S.KV_SEP}]|\z))|{S.ITEM_SEP}|."


def parse_pattern_label(label: Column) -> Column:
    """Label text -> struct(items, ok, reason).

    One state machine over the signs of the label: `` AND `` ends an item, the first ``=`` of an item
    ends its feature, spaces around both are dropped unless escaped, an escaped sign
    stands for itself. A part without ``=`` makes the pattern invalid with reason
    ``Invalid pattern part: <part>``. A null label gives a struct of nulls.
    """
    # text, kept: what the current feature or value holds, and its length without spaces at its end.
    zero = F.struct(F.array().cast(ITEMS_TYPE).alias("items"), F.lit(None).cast("string").alias("bad"),
                    F.lit(None).cast("string").alias("feature"), F.lit("").alias("text"), F.lit(0).alias("kept"),
                    F.lit("").alias("raw"))

    def state(**fields: Column) -> Column:
        return F.struct(*[fields[f].alias(f) for f in ("items", "bad", "feature", "text", "kept", "raw")])

    def closed(s: Column) -> Column:
        """The state after the current item."""
        item = F.struct(s["feature"].alias("feature"), F.substring(s["text"], F.lit(1), s["kept"]).alias("value"))
        open_part = s["feature"].isNull()
        return state(items=F.when(open_part, s["items"]).otherwise(F.concat(s["items"], F.array(item))),
                     bad=F.when(open_part, F.coalesce(s["bad"], s["raw"])).otherwise(s["bad"]),
                     feature=F.lit(None).cast("string"), text=F.lit(""), kept=F.lit(0), raw=F.lit(""))

    def step(s: Column, sign: Column) -> Column:
        raw = F.concat(s["raw"], sign)
        named = state(items=s["items"], bad=s["bad"], feature=F.substring(s["text"], F.lit(1), s["kept"]),
                      text=F.lit(""), kept=F.lit(0), raw=raw)
        space = state(items=s["items"], bad=s["bad"], feature=s["feature"], kept=s["kept"], raw=raw,
                      text=F.when(s["text"] == "", s["text"]).otherwise(F.concat(s["text"], sign)))
        more = F.concat(s["text"], F.when(F.length(sign) > 1, F.substring(sign, F.lit(2), F.length(sign))).otherwise(sign))
        plain = state(items=s["items"], bad=s["bad"], feature=s["feature"], text=more, kept=F.length(more), raw=raw)
        return (F.when(sign == S.ITEM_SEP, closed(s)).when((sign == S.KV_SEP) & s["feature"].isNull(), named)
                .when(sign == " ", space).otherwise(plain))

    found = F.aggregate(F.regexp_extract_all(label, F.lit(_SIGNS), F.lit(0)), zero, step, closed)
    ok = found["bad"].isNull()
    return F.when(label.isNotNull(), F.struct(
        F.when(ok, found["items"]).alias("items"),
        ok.alias("ok"),
        F.when(~ok, F.concat(F.lit(S.REASON_BAD_PART), found["bad"])).alias("reason")))


def readable_label(label: Column, width: int = S.READABLE_WIDTH, keep: int = S.READABLE_KEEP) -> Column:
    """`` AND `` -> `` & ``, ``=`` -> ``: ``, cut to ``keep`` + ``...``
    when longer than ``width``."""
    clean = F.replace(F.replace(label, F.lit(S.ITEM_SEP), F.lit(S.READABLE_ITEM_SEP)),
                      F.lit(S.KV_SEP), F.lit(S.READABLE_KV_SEP))
    return F.when(F.length(clean) > width, F.concat(F.substring(clean, 1, keep), F.lit("..."))).otherwise(clean)


def truncate(col: Column, width: int) -> Column:
    """P20: plain cut to ``width`` characters."""
    return F.substring(col, 1, width)


def as_percent(col: Column, scale_max: Column) -> Column:
    """Values on a 0-1 scale become percent. The scale is decided once
    for the whole column (on its max), not per value."""
    return F.when(scale_max <= 1.0, col * 100).otherwise(col)


def order_by_list(col: Column, order: Iterable[str]) -> Column:
    """Position of ``col`` in a fixed order (0 when absent)."""
    return F.array_position(F.array(*[F.lit(v) for v in order]), col)


def confidence_column(df: DataFrame) -> str | None:
    """``Confidence`` else ``Fraud_Rate_Percent`` else none."""
    for name in ("Confidence", "Fraud_Rate_Percent"):
        if name in df.columns:
            return name
    return None


def items_to_predicate(items: Sequence[tuple[str, str]], schema: T.StructType) -> Column:
    """Conjunction of typed equality tests for a literal pattern.

    Each value is cast to the column's own type (so ``is_weekend=01`` tests an int). A
    value that is none of that type matches no row; an unknown column is an error.
    """
    types = {f.name: f.dataType for f in schema.fields}
    cond = F.lit(True)
    for feature, value in items:
        feature, value = feature.strip(), value.strip()
        if feature not in types:
            raise ValueError(f"unknown column {feature}")
        cond = cond & F.coalesce(F.col(quoted(feature)) == F.lit(value).try_cast(types[feature]), F.lit(False))
    return cond
