"""Training-data pipeline over ``documents``: five stages, each one operator of ``lapse.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``.  All but the last return the columns of ``documents``; where a
stage changes the text, ``n_chars`` follows it.

Defined cases, for every stage: a null text counts as an empty one; quality rules reject texts of fewer than
ten words, so null and empty ones end there; a null lang or source is a group of its own.  Of texts that are
equal or near to each other the row with the smallest id stays; of rows repeated with their id one stays; rows
without an id stay unless their text's class has one.  Substring dedup judges all windows on its input, so
passages go from all their places.  Very long texts are processed whole.  An empty table gives an empty
result with the same columns.  Further columns are carried through under their names, whatever these are (dots
and names that an operator uses itself included); only columns named like the last stage's results are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.llm import bpe, decontam, minhash, quality, substring
from lapse.sources.store import new_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie inside their group's fences."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8 or more)."""
    return minhash.dedup(docs, shingle=5)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that repeat; a text that is nothing else stays as an empty one."""
    out = substring.remove_repeats(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontam.remove_contaminated(docs, benchmark)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with the digest of the text they decode to."""
    return bpe.encode_checked(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", bpe_encoding),
]

#: MinHash buckets, SimHash windows and byte-pair merges are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    root = new_folder(spark, "corpus")  # goes with the open scope
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}")
        docs = spark.read.parquet(f"{root}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
