"""Small files and facts of the shared file system, through Spark's own Hadoop configuration."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a table's data files, from the file system's listing."""
    fs, p = _at(spark, path)
    it, total = fs.listFiles(p, True), 0
    while it.hasNext():
        f = it.next()
        if not f.getPath().getName().startswith(("_", ".")):
            total += f.getLen()
    return total


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _at(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None where there is none."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return None
    return "\n".join(r.value for r in spark.read.text(path).collect())


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.delete(p, True)
