"""Typed ingest: declared-schema CSV -> zstd Parquet.

* S1: CSV read with a declared schema and ``mode=FAILFAST``: a value that does not fit
  its type (300 in a byte column) fails the job instead of wrapping or turning null.
* S2: integer columns may not be null (an empty cell parses as null even under FAILFAST).  Rows and nulls per
  column are observed by the write itself, so the text is parsed once; a load with nulls where none may be is
  refused with its counts and leaves no finished output.
* S3: idempotent: a finished output (it has ``_SUCCESS``, written after the checks, which holds the load's report)
  is left alone; what a crashed or refused load left is overwritten.
* S6: the report has rows, nulls per column and bytes of the load.
* S5: source preference by existence, checked through the Hadoop FileSystem.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapse.sources.files import path_exists, read_text, stored_bytes, write_text

# ---- fixed values: raw table schemas ---------------------------------------------------------
_B, _S, _I, _F, _STR = T.ByteType(), T.ShortType(), T.IntegerType(), T.FloatType(), T.StringType()
RAW_SCHEMAS: dict[str, list[tuple[str, T.DataType]]] = {
    "members": [("msno", _STR), ("city", _B), ("bd", _S), ("gender", _STR), ("registered_via", _B),
                ("registration_init_time", _I)],
    "train": [("msno", _STR), ("is_churn", _B)],
    "transactions": [("msno", _STR), ("payment_method_id", _B), ("payment_plan_days", _S), ("plan_list_price", _S),
                     ("actual_amount_paid", _I), ("is_auto_renew", _B), ("transaction_date", _I),
                     ("membership_expire_date", _I), ("is_cancel", _B)],
    "user_logs": [("msno", _STR), ("date", _I), ("num_25", _I), ("num_50", _I), ("num_75", _I), ("num_985", _I),
                  ("num_100", _I), ("num_unq", _I), ("total_secs", _F)],
}
NULLABLE = {("members", "gender")}
# later snapshots share the shape of their base table
SHAPE_OF = {"train_v2": "train", "transactions_v2": "transactions", "user_logs_v2": "user_logs"}
# -------------------------------------------------------------------------------------------------


def schema_of(table: str) -> T.StructType:
    shape = SHAPE_OF.get(table, table)
    return T.StructType([T.StructField(n, t, (shape, n) in NULLABLE) for n, t in RAW_SCHEMAS[shape]])


def pick_source(spark: SparkSession, root: str, names: list[str]) -> str:
    """The first table name whose Parquet path exists under ``root``."""
    for n in names:
        if path_exists(spark, f"{root.rstrip('/')}/{n}.parquet"):
            return n
    raise FileNotFoundError(f"none of {names} under {root}")


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """schema'd, header'd CSV; malformed or out-of-range values fail the job."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    """The same rows; evaluating a null in one of ``cols`` fails the job."""
    return df.withColumns({
        c: F.coalesce(F.col(c), F.raise_error(F.lit(f"null value in non-nullable column {c}")).cast(df.schema[c].dataType)) for c in cols
    })


@dataclass(frozen=True)
class LoadReport:
    """What a load has read and written."""

    table: str
    n_rows: int
    nulls: dict[str, int]
    n_bytes: int


def load(spark: SparkSession, table: str, csv_path: str, out_path: str) -> tuple[LoadReport, bool]:
    """CSV -> zstd Parquet under the declared schema; its report and whether it ran now.

    A finished output is left alone and its report read back."""
    done = f"{out_path.rstrip('/')}/_SUCCESS"
    if (known := read_text(spark, done)) is not None:
        return (LoadReport(**json.loads(known)) if known else _counted(spark, table, out_path)), False
    schema = schema_of(table)
    seen = Observation(f"load {table}")
    # a session that has observed something is no longer serialisable, and MLlib models carry their session's summary
    # into tasks (Spark 4.1): so the load observes in a session of its own
    df = read_typed_csv(spark.newSession(), csv_path, schema).observe(
        seen, F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in schema.fields])
    (df.write.mode("overwrite").option("compression", "zstd")
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(out_path))
    got = seen.get
    nulls = {f.name: got[f.name] for f in schema.fields}
    bad = {f.name: nulls[f.name] for f in schema.fields if nulls[f.name] and not f.nullable}
    if bad:
        raise ValueError(f"{table}: null values in non-nullable columns, of {got['n_rows']} rows: {bad}")
    report = LoadReport(table, got["n_rows"], nulls, stored_bytes(spark, out_path))
    write_text(spark, done, json.dumps(asdict(report)))
    return report, True


def _counted(spark: SparkSession, table: str, out_path: str) -> LoadReport:
    """The report of an output that has none (another writer made it): counted from its rows."""
    schema = schema_of(table)
    r = spark.read.schema(schema).parquet(out_path).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in schema.fields]).first()
    return LoadReport(table, r.n_rows, {f.name: r[f.name] for f in schema.fields}, stored_bytes(spark, out_path))


def convert(spark: SparkSession, table: str, csv_path: str, out_path: str) -> bool:
    """``load`` without its report.  Returns False when skipped."""
    return load(spark, table, csv_path, out_path)[1]


def load_all(spark: SparkSession, csv_root: str, out_root: str, tables: list[str]) -> list[LoadReport]:
    """Load ``<csv_root>/<table>`` (a CSV file or folder) to ``<out_root>/<table>.parquet`` for every
    table, skipping outputs that exist."""
    return [load(spark, t, f"{csv_root.rstrip('/')}/{t}", f"{out_root.rstrip('/')}/{t}.parquet")[0] for t in tables]


def ingest_all(spark: SparkSession, csv_root: str, out_root: str, tables: list[str]) -> DataFrame:
    """``load_all``, then rows and bytes per table as a reader sees them."""
    from lapse.sources.tables import dataset_inventory

    load_all(spark, csv_root, out_root, tables)
    return dataset_inventory(spark, out_root, tables)


def report_rows(spark: SparkSession, reports: list[LoadReport]) -> DataFrame:
    """(table_name, column_name, n_rows, n_nulls, n_bytes): one row per column of every load."""
    rows = [(r.table, c, r.n_rows, n, r.n_bytes) for r in reports for c, n in r.nulls.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, n_rows bigint, n_nulls bigint, n_bytes bigint")


def transactions_csv_from_orders(spark: SparkSession, root: str, out_csv: str) -> None:
    """Write the driver ``orders`` as a raw transactions CSV (test input for the ingest path)."""
    from lapse.sources.tables import read_table

    o = read_table(spark, root, "orders")
    d = F.to_date("o_orderdate")
    plan_days = (30 * (1 + F.col("o_orderkey") % 4)).cast("int")
    o.select(
        F.col("o_custkey").cast("string").alias("msno"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_method_id"),
        plan_days.alias("payment_plan_days"),
        F.floor(F.col("o_totalprice") / 100).cast("int").alias("plan_list_price"),
        F.floor(F.col("o_totalprice")).cast("int").alias("actual_amount_paid"),
        F.when(F.col("o_orderstatus") != "O", 1).otherwise(0).alias("is_auto_renew"),
        F.date_format(d, "yyyyMMdd").cast("int").alias("transaction_date"),
        F.date_format(F.date_add(d, plan_days), "yyyyMMdd").cast("int").alias("membership_expire_date"),
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(0).alias("is_cancel"),
    ).write.option("header", True).csv(out_csv)


def members_csv_from_customer(spark: SparkSession, root: str, out_csv: str) -> None:
    """Write the driver ``customer`` as a raw members CSV: genders are empty where unknown."""
    from lapse.sources.roles import members

    m = members(spark, root)
    m.select(F.col("user_key").cast("string").alias("msno"), "city", "bd", "gender", "registered_via", "registration_init_time").write.option(
        "header", True).csv(out_csv)


def user_logs_csv_from_events(spark: SparkSession, root: str, out_csv: str) -> None:
    """Write the driver ``events`` as a raw user_logs CSV, one row per event."""
    from lapse.sources.roles import logs

    e = logs(spark, root)
    e.select(
        F.col("user_key").cast("string").alias("msno"), F.date_format("log_date", "yyyyMMdd").cast("int").alias("date"),
        "num_25", "num_50", "num_75", "num_985", "num_100", F.lit(1).alias("num_unq"), F.col("total_secs").cast("float").alias("total_secs"),
    ).write.option("header", True).csv(out_csv)
