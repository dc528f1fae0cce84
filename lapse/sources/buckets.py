"""Fact and member tables stored co-partitioned on the user key.

A bucketed copy holds the rows of a table in ``buckets`` files by the hash of its key, sorted by it.  Copies with
the same number of buckets meet in joins and per-key aggregates without an exchange: the facts are shuffled once,
when the copy is written, and by no run after that.

A bucket is read by one task, which nothing can split afterwards.  So every copy records its rows and those of
its largest bucket when it is written, and the reader uses the buckets only while the largest is within ``max_skew``
times the mean: a table where one user holds a third of all rows is read as plain Parquet instead and shuffled
after the map-side combine, like before.

The layout (key, buckets, schema, sizes) is kept beside the rows; a table name is registered in the session's
catalog when the copy is opened, so any later session can use it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.sources.files import stored_bytes
from lapse.sources.tables import read_table, table_path

# fixed values: the user key of each table
USER_KEY = {"customer": "c_custkey", "orders": "o_custkey", "events": "user_id"}
MAX_SKEW = 8.0
LAYOUT_SCHEMA = "key string, buckets int, ddl string, n_rows bigint, largest bigint"


@dataclass(frozen=True)
class Layout:
    key: str
    buckets: int
    ddl: str
    n_rows: int
    largest: int

    @property
    def skew(self) -> float:
        """Rows of the largest bucket over the mean."""
        return self.largest * self.buckets / self.n_rows if self.n_rows else 1.0


def bucket_count(input_bytes: int, at_least: int = 1, bucket_bytes: int = 256 << 20) -> int:
    """Buckets of about ``bucket_bytes`` each, a power of two, so that copies of other sizes still divide."""
    n = max(at_least, 1, -(-input_bytes // bucket_bytes))
    return 1 << (n - 1).bit_length()


def _layout_path(path: str) -> str:
    return f"{path.rstrip('/')}/_layout"


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> Layout:
    """Write ``df`` to ``path`` in ``buckets`` files by the hash of ``key`` and record the layout."""
    spark = df.sparkSession
    name = f"lapse_bucketed_{uuid.uuid4().hex}"
    sized = df.repartition(buckets, F.col(key))  # one file a bucket: the same hash deals rows to tasks and buckets
    (sized.write.format("parquet").mode("error").option("compression", "zstd").option("path", path)
        .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    rows = spark.read.schema(_ddl(df)).parquet(path)
    per_bucket = rows.groupBy(F.pmod(F.hash(key), F.lit(buckets)).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    sizes = per_bucket.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.coalesce(F.max("n"), F.lit(0)).alias("largest"))
    record = sizes.select(F.lit(key).alias("key"), F.lit(buckets).alias("buckets"), F.lit(_ddl(df)).alias("ddl"), "n_rows", "largest")
    record.write.mode("error").json(_layout_path(path))
    return layout_of(spark, path)


def layout_of(spark: SparkSession, path: str) -> Layout:
    return Layout(**spark.read.schema(LAYOUT_SCHEMA).json(_layout_path(path)).first().asDict())  # one row


def open_bucketed(spark: SparkSession, path: str, max_skew: float = MAX_SKEW) -> DataFrame:
    """A bucketed copy as a table whose buckets Spark knows; plain Parquet where a bucket is too large."""
    layout = layout_of(spark, path)
    if layout.skew > max_skew:
        return spark.read.schema(layout.ddl).parquet(path)
    name = f"lapse_bucketed_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({layout.ddl}) USING parquet CLUSTERED BY (`{layout.key}`) SORTED BY (`{layout.key}`) "
        f"INTO {layout.buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def bucket_roles(spark: SparkSession, root: str, out_root: str, buckets: int | None = None) -> dict[str, Layout]:
    """Bucketed copies of the tables that hold a user key, under ``out_root``, all in the same number of buckets:
    by the bytes of the largest table and the cores of the session, unless it is given."""
    if buckets is None:
        largest = max(stored_bytes(spark, table_path(root, name)) for name in USER_KEY)
        buckets = bucket_count(largest, spark.sparkContext.defaultParallelism)
    return {
        name: write_bucketed(read_table(spark, root, name), table_path(out_root, name), key, buckets)
        for name, key in USER_KEY.items()
    }


def read_bucketed(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A ``Reader``: the bucketed copy of a table under ``root``."""
    return open_bucketed(spark, table_path(root, name))
