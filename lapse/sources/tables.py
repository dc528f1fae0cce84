"""Parquet scan by name with declared schemas (S4), SQL views and the dataset inventory."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values: columns and types of the driver tables ----------------------------------------
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
              "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
SHAPE_OF = {"events_v2": "events"}  # a later snapshot has the columns of its base table
# -----------------------------------------------------------------------------------------------------
DRIVER_TABLES = tuple(SCHEMAS)

#: reads a table by (session, root, name): ``read_table`` or, for bucketed copies, ``buckets.read_bucketed``
Reader = Callable[[SparkSession, str, str], DataFrame]


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One table by name, listed anew on every call; Catalyst prunes columns and pushes filters
    into this scan.  A declared schema saves the job that would read footers to infer it; a file of
    another type fails when it is read.  Tables without a declared schema are inferred."""
    schema = SCHEMAS.get(SHAPE_OF.get(name, name))
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(table_path(root, name))


def register_views(spark: SparkSession, root: str, names=DRIVER_TABLES, read: Reader = read_table, prefix: str = "") -> None:
    """Temp view per table, so operators can also be written in SQL; no job is run for it."""
    for name in names:
        read(spark, root, name).createOrReplaceTempView(prefix + name)


def dataset_inventory(spark: SparkSession, root: str, names=DRIVER_TABLES) -> DataFrame:
    """Rows and on-disk bytes per table, one row per table.

    Row counts come from a global count per table (answered from Parquet footers where the
    reader can); bytes come from the hidden ``_metadata.file_size`` column summed over
    distinct files, so no file is listed on the driver.
    """
    parts = []
    for name in names:
        df = read_table(spark, root, name)
        rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
        files = (
            df.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s"))
            .groupBy("p").agg(F.max("s").alias("s"))
            .agg(F.sum("s").cast("bigint").alias("n_bytes"))
        )
        parts.append(rows.withColumn("n_bytes", files.scalar()).select(F.lit(name).alias("table_name"), "n_rows", "n_bytes"))
    return reduce(DataFrame.unionByName, parts)
