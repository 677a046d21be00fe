"""Transaction sources: files, train/test holdout, and views over the
benchmark tables shaped like card transactions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import spec as S
from ..functions.items import quoted

# Columns the analysis reads; any others pass through untouched.
TRANSACTION_SCHEMA = T.StructType([
    T.StructField("trans_date_trans_time", T.TimestampType()),
    T.StructField("dob", T.DateType()),
    T.StructField("amt", T.DoubleType()),
    T.StructField("category", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
    T.StructField("merch_lat", T.DoubleType()),
    T.StructField("merch_long", T.DoubleType()),
    T.StructField("is_fraud", T.IntegerType()),
])

INDEX_COLUMN = "_c0"


def read_transactions(spark: SparkSession, path: str, fmt: str = "csv",
                      schema: T.StructType | None = None, infer_schema: bool = False) -> DataFrame:
    """Read a transaction file and drop the unnamed index column.

    CSV with a header row; pass ``schema`` (recommended: no inference pass,
    same types for train and test; columns matched by name, unknown columns
    kept as text) or ``infer_schema=True``.
    """
    if fmt == "csv":
        reader = spark.read.option("header", "true")
        if schema is not None:
            # Columns are matched by header name (a CSV schema would be
            # positional): read text, cast the known columns, keep the rest.
            df = reader.option("inferSchema", "false").csv(path)
            typed = {f.name: f.dataType for f in schema.fields}
            df = df.select(*[F.col(f"`{c}`").cast(typed[c]).alias(c) if c in typed else F.col(f"`{c}`")
                             for c in df.columns])
        else:
            df = reader.option("inferSchema", str(bool(infer_schema)).lower()).csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    return df.drop(INDEX_COLUMN) if INDEX_COLUMN in df.columns else df


@dataclass(frozen=True)
class Checked:
    """S1 with its bad records apart: ``rows`` (typed, without bad records), ``rejects`` (file, row, column, text,
    reason, record: one row per fault) and ``counts`` (one row: n_rows, n_rejected records)."""

    rows: DataFrame
    rejects: DataFrame
    counts: DataFrame

    def within(self, max_share: float) -> "Checked":
        """Itself, if at most ``max_share`` of all records are rejected; else an error."""
        total, bad = self.counts.first()
        if bad > max_share * total:
            raise ValueError(f"{bad} of {total} records are rejected, more than a share of {max_share}")
        return self


# Columns that are added while records are checked; a file may not have them.
_RECORD, _FILE, _FAULTS = "_corrupt_record", "_source_file", "_faults"


def read_checked(spark: SparkSession, path: str, schema: T.StructType = TRANSACTION_SCHEMA,
                 options: dict | None = None) -> Checked:
    """S1/S2 for files that may hold bad records: a value that is not of its column's type (a number, a date)
    or a record with too few or too many fields does not fail the job; its record goes to ``rejects`` with the
    reason, and all other records are typed as ``read_transactions`` types them.

    Columns are matched by header name and unknown columns stay text; ``row`` is the unnamed index column, where there
    is one. An empty field is null, which is no fault."""
    options = {"header": True, **(options or {})}
    names = spark.read.options(**options).csv(path).columns
    taken = {_RECORD, _FILE, _FAULTS} & {n.lower() for n in names}
    if taken:
        raise ValueError(f"the file has columns named {', '.join(sorted(taken))}")
    text = T.StructType([T.StructField(n, T.StringType()) for n in (*names, _RECORD)])
    # Without column pruning the parser sees all fields of a record and so their number.
    raw = (spark.read.schema(text).options(**options, mode="PERMISSIVE", columnNameOfCorruptRecord=_RECORD, columnPruning=False)
           .csv(path).withColumn(_FILE, F.col("_metadata.file_path")))
    typed = {f.name: f.dataType for f in schema.fields}

    def fault(column: Column, value: Column, reason: Column | str) -> Column:
        return F.struct(column.alias("column"), value.alias("text"), F.lit(reason).alias("reason"))

    def read(c: str) -> Column:
        return F.col(quoted(c)).try_cast(typed[c]) if c in typed else F.col(quoted(c))

    faults = [F.when(F.col(_RECORD).isNotNull(), fault(F.lit(None).cast("string"), F.lit(None).cast("string"), S.REJECT_FIELDS))]
    faults += [F.when(F.col(_RECORD).isNull() & F.col(quoted(c)).isNotNull() & read(c).isNull(),
                      fault(F.lit(c), F.col(quoted(c)), S.REJECT_VALUE + typed[c].simpleString())) for c in names if c in typed]
    raw = raw.withColumn(_FAULTS, F.array_compact(F.array(*faults)))
    good = raw.where(F.size(_FAULTS) == 0).select(*[read(c).alias(c) for c in names if c != INDEX_COLUMN])
    index = F.col(INDEX_COLUMN) if INDEX_COLUMN in names else F.lit(None).cast("string")
    record = F.coalesce(F.col(_RECORD), F.to_csv(F.struct(*[F.col(quoted(c)) for c in names])))
    rejects = (raw.where(F.size(_FAULTS) > 0)
               .select(F.col(_FILE).alias("file"), index.alias("row"), F.explode(_FAULTS).alias("fault"), record.alias("record"))
               .select("file", "row", "fault.column", "fault.text", "fault.reason", "record"))
    counts = raw.agg(F.count("*").alias("n_rows"), F.count_if(F.size(_FAULTS) > 0).alias("n_rejected"))
    return Checked(good, rejects, counts)


@dataclass(frozen=True)
class Holdout:
    """Train and test side by side, or one table with a ``split`` column."""

    train: DataFrame
    test: DataFrame

    def stacked(self, split_col: str = "split") -> DataFrame:
        return (self.train.withColumn(split_col, F.lit("train"))
                .unionByName(self.test.withColumn(split_col, F.lit("test")), allowMissingColumns=True))

    @staticmethod
    def from_split(df: DataFrame, split_col: str = "split") -> "Holdout":
        return Holdout(df.filter(F.col(split_col) == "train"), df.filter(F.col(split_col) == "test"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one Parquet table (a file or a folder of files)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction-shaped view over the ``events`` table of ``sf_dir``."""
    return events_as_transactions(read_table(spark, sf_dir, "events"))


def events_as_transactions(ev: DataFrame) -> DataFrame:
    """Transaction-shaped view over ``events`` (one row per event; works on
    a batch or a streaming DataFrame).

    Birth date, coordinates, gender and the label are integer functions of
    the ids, so any engine derives the same values; the label plants a
    night + large-amount signal. ``split``: 70 % train / 30 % test by id,
    every row in exactly one side.
    """
    eid, uid, ts = F.col("event_id"), F.col("user_id"), F.col("ts")
    lat = F.lit(25.0) + (uid * 37 % 2400) / F.lit(100.0)
    lon = F.lit(-120.0) + (uid * 53 % 5000) / F.lit(100.0)
    dlat = (F.when(eid % 50 == 0, 0).when(eid % 25 == 1, 8)
            .otherwise(((eid * 31 % 200) - 100) / F.lit(100.0)))
    dlon = F.when(eid % 50 == 0, 0).otherwise(((eid * 47 % 200) - 100) / F.lit(100.0))
    hour = F.hour(ts)
    fraud = (F.when(((hour >= 22) | (hour < 6)) & (F.col("value") * 2 >= 200) & (eid % 3 != 0), 1)
             .when(eid % 200 == 0, 1).otherwise(0))
    return ev.select(
        eid.alias("event_id"),
        F.when(eid % 10 < 7, "train").otherwise("test").alias("split"),
        ts.alias("trans_date_trans_time"),
        F.date_add(F.lit("1940-01-01").cast("date"), (uid * 7919 % 23000).cast("int")).alias("dob"),
        (F.col("value") * 2).alias("amt"),
        F.col("event_type").alias("category"),
        F.when(uid % 2 == 0, "F").otherwise("M").alias("gender"),
        lat.alias("lat"),
        lon.alias("long"),
        (lat + dlat).alias("merch_lat"),
        (lon + dlon).alias("merch_long"),
        fraud.alias("is_fraud"),
    )


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as labelled transactions: ``is_returned`` = return flag R,
    categorical features from the order, customer and part of each line,
    70/30 train/test split by order key (all lines of an order on one side).

    The joins are declared plainly: each side is pruned to the columns it
    contributes, and the optimizer (with AQE's runtime sizes) picks broadcast
    or shuffle per join, so no side is broadcast without a size check.
    """
    from .. import spec as S
    from ..functions.features import bucketize

    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
        "l_returnflag", "l_linestatus")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    rows = (li.join(orders, li["l_orderkey"] == orders["o_orderkey"])
              .join(cust, orders["o_custkey"] == cust["c_custkey"])
              .join(part, li["l_partkey"] == part["p_partkey"]))
    return rows.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 10 < 7, "train").otherwise("test").alias("split"),
        F.col("o_orderpriority").alias("order_priority"),
        F.col("c_mktsegment").alias("segment"),
        F.split(F.col("p_type"), " ").getItem(0).alias("part_class"),
        F.col("l_linestatus").alias("line_status"),
        F.col("o_orderstatus").alias("order_status"),
        bucketize(F.col("l_quantity"), S.QUANTITY_EDGES, S.QUANTITY_LABELS).alias("quantity_band"),
        bucketize(F.col("l_extendedprice"), S.PRICE_EDGES, S.PRICE_LABELS).alias("price_band"),
        bucketize(F.col("l_discount"), S.DISCOUNT_EDGES, S.DISCOUNT_LABELS).alias("discount_band"),
        F.when(F.col("l_returnflag") == S.RETURNED_FLAG, 1).otherwise(0).alias("is_returned"),
    )
