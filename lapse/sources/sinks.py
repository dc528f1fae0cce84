"""Writers and readers of results."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.config import Windows

MANIFEST_SCHEMA = (
    "feature string, column string, cardinality int, embedding_dim int, unknown_index int, feature_cutoff date, "
    "value_window array<date>, engagement_window array<date>, numerical_scaled array<string>, numerical_unscaled array<string>"
)


def write_model_table(df: DataFrame, path: str, mode: str = "error") -> None:
    """One Parquet dataset partitioned by ``split`` (zstd)."""
    df.write.mode(mode).option("compression", "zstd").partitionBy("split").parquet(path)


def read_model_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """Read one split back; the filter on the partition column prunes directories."""
    return spark.read.parquet(path).filter(F.col("split") == split)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The feature manifest as written, one row per categorical feature."""
    return spark.read.schema(MANIFEST_SCHEMA).json(path)


@dataclass(frozen=True)
class Manifest:
    """What a model table was built with - the sizes of its codes, its numeric columns and its time windows."""

    cardinality: dict[str, int]
    scaled: tuple[str, ...]
    unscaled: tuple[str, ...]
    windows: Windows

    @classmethod
    def of(cls, df: DataFrame) -> Manifest:
        """From manifest rows (one per categorical feature, all with the same windows and lists)."""
        rows = df.select(*[f.split()[0] for f in MANIFEST_SCHEMA.split(", ")]).collect()
        shared = {(r.feature_cutoff, *_pair(r.value_window), *_pair(r.engagement_window), tuple(r.numerical_scaled or ()),
                   tuple(r.numerical_unscaled or ())) for r in rows}
        if len(shared) != 1:
            raise ValueError(f"a manifest needs one set of windows and columns, not {len(shared)}")
        *dates, scaled, unscaled = shared.pop()
        if None in dates or not scaled + unscaled:
            raise ValueError("the manifest lacks its windows or its numeric columns")
        return cls({r.column: r.cardinality for r in rows}, scaled, unscaled, Windows(*dates))

    def check(self, windows: Windows) -> Manifest:
        """Refuse a model table that was built for other windows."""
        if self.windows != windows:
            raise ValueError(f"the model table was built for {self.windows}, not for {windows}")
        return self

    def require(self, table: DataFrame) -> Manifest:
        """Refuse a model table that lacks a column of the manifest."""
        missing = sorted({*self.cardinality, *self.scaled, *self.unscaled} - set(table.columns))
        if missing:
            raise ValueError(f"the model table lacks {missing}")
        return self


def _pair(window: list[dt.date] | None) -> tuple[dt.date | None, dt.date | None]:
    return tuple(window) if window and len(window) == 2 else (None, None)


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """Small result tables (manifest, metrics) as JSON lines."""
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    """Result tables (priority scores, ablation) as CSV with a header."""
    df.write.mode(mode).option("header", True).csv(path)
