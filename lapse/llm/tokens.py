"""Operator 10: token counts by scanning flat, unindexed token files for separators.

Writing: documents are encoded and written one after the other as big-endian 16-bit ids, each
followed by the end-of-document id and nothing else - no index, no lengths, no document ids.  The files
come from Spark's text sink: a document's bytes are the line and the two bytes of the
end-of-document id are the line separator, so writes are distributed, committed by Spark and work on
any file system it can write.  The end id must therefore be two bytes of UTF-8 and lie above the
vocabulary: ``END`` is 0xC491.  After ``FILE_BYTES`` a task begins a new file.

Counting: every file is read in blocks of ``BLOCK`` ids and one vectorised comparison per block finds the
end ids.  A document may cross any number of blocks, so the blocks are stitched by a prefix scan over
their small summaries: running sums of ids and of ends, and the running maximum of the last end,
give each document its ordinal, its first id and its length.

Defined cases: null and empty texts are documents of no ids; ids after a file's last end id are a
document cut off, reported with ``complete`` false; a last odd byte is ignored; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapse.llm import bpe
from lapse.llm.words import slices
from lapse.session import ensure_checkpoint_dir

END_TEXT = "đ"
END = int.from_bytes(END_TEXT.encode(), "big")
BLOCK = 1 << 20
FILE_BYTES = 64 << 20


def write_flat(docs: DataFrame, path: str, text_col: str = "text", vocabulary: tuple[str, str] | None = None,
               file_bytes: int = FILE_BYTES, compression: str = "gzip") -> None:
    """Encode the texts into flat token files below ``path``."""
    file, pattern = vocabulary or bpe.default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe.load(file, pattern)
        if codec.size > END:
            raise ValueError("the end-of-document id lies inside the vocabulary")
        full, k = 0, 0
        for b in slices(batches):
            ids, edges = codec.encode(b.column("text").to_pylist())
            flat = np.ascontiguousarray(ids.astype(">u2"))
            at = np.zeros(b.num_rows, np.int32)
            for i, n in enumerate((2 * np.diff(edges)).tolist()):
                if full and full + n > file_bytes:
                    full, k = 0, k + 1
                full += n + 2
                at[i] = k
            lines = pa.Array.from_buffers(
                pa.large_binary(), b.num_rows, [None, pa.py_buffer(2 * edges.astype(np.int64)), pa.py_buffer(flat)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([lines, pa.array(at)], names=["line", "file"])

    lines = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "line binary, file int")
    lines.select(F.col("line").cast("string").alias("value"), "file").write.mode("error").partitionBy("file").option(
        "lineSep", END_TEXT).option("compression", compression).text(path)


def blocks(content: bytes, packed: bool, block: int = BLOCK) -> Iterator[np.ndarray]:
    """The ids of a file, ``block`` at a time; gzip content is inflated piece by piece."""
    if not packed:
        ids = np.frombuffer(content, ">u2", len(content) // 2)
        for at in range(0, len(ids), block):
            yield ids[at : at + block]
        return
    held, rest = bytearray(), content
    while rest:  # one gzip member after another
        inflate = zlib.decompressobj(31)
        while not inflate.eof and rest:
            held += inflate.decompress(rest, 2 * block)
            rest = inflate.unconsumed_tail or inflate.unused_data
            while len(held) >= 2 * block:
                yield np.frombuffer(bytes(held[: 2 * block]), ">u2")
                del held[: 2 * block]
        held += inflate.flush()
    for at in range(0, len(held) - len(held) % 2, 2 * block):
        piece = bytes(held[at : at + 2 * block])
        yield np.frombuffer(piece, ">u2", len(piece) // 2)


def scan(spark: SparkSession, path: str, end: int = END, block: int = BLOCK) -> DataFrame:
    """(file, block, n, ends): number of ids and places of the end ids of every block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path_, content in zip(b.column(0), b.column(1)):
                name = path_.as_py()
                for k, ids in enumerate(blocks(content.as_buffer().to_pybytes(), name.endswith(".gz"), block)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([k], pa.int64()), pa.array([len(ids)], pa.int64()),
                         pa.array([np.flatnonzero(ids == end)], pa.list_(pa.int64()))],
                        names=["file", "block", "n", "ends"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, block long, n long, ends array<long>")


def token_counts(spark: SparkSession, path: str, end: int = END, block: int = BLOCK) -> DataFrame:
    """(file, ordinal, first_token, n_tokens, complete): one row per document of the flat files."""
    found = scan(spark, path, end, block)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = Window.partitionBy("file")
    n_ends = F.size("ends").cast("long")
    stitched = found.withColumns({
        "base": F.coalesce(F.sum("n").over(before), F.lit(0)), "total": F.sum("n").over(last), "ordinal0": F.coalesce(F.sum(n_ends).over(before), F.lit(0)),
        "is_last": F.col("block") == F.max("block").over(last)})
    # the last end before a block: the running maximum over the earlier blocks that have one
    tail = F.when(F.size("ends") > 0, F.col("base") + F.element_at("ends", -1))
    stitched = stitched.withColumn("tail", tail).withColumn("open", F.coalesce(F.max("tail").over(before), F.lit(-1)) + 1)
    # what follows the file's last end is a cut-off document that ends with the file
    left = F.when(F.col("is_last") & (F.col("total") > F.coalesce(F.col("tail") + 1, F.col("open"))), F.array(F.col("n")))
    stitched = stitched.withColumn("stops", F.concat(F.col("ends"), F.coalesce(left, F.array().cast("array<long>"))))
    one = stitched.select("file", "base", "ordinal0", "open", "stops", n_ends.alias("n_ends"), F.posexplode("stops").alias("j", "stop"))
    first = F.when(F.col("j") == 0, F.col("open")).otherwise(F.col("base") + F.get("stops", F.col("j") - 1) + 1)
    return one.select(
        "file", (F.col("ordinal0") + F.col("j")).alias("ordinal"), first.alias("first_token"),
        (F.col("base") + F.col("stop") - first).alias("n_tokens"), (F.col("j") < F.col("n_ends")).alias("complete"))


def new_flat_path(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/flat-{uuid.uuid4().hex}"
