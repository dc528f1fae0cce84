"""Global positions without an unpartitioned window.

``ordered_running`` gives every row its exact 1-based position in a total order, and
inclusive running sums of chosen columns, optionally restarting per group.  Steps:

1. the input is written once to the checkpoint folder and counted from the file footers;
   the number of buckets follows the rows, without an upper limit;
2. with more than one bucket, a single aggregate over the stored rows gives approximate
   quantiles of the leading value ``v`` and of the secondary value ``k``;
3. a binary search over these bounds puts each row into a range bucket.  A value of ``v`` that
   spans several quantiles (a hot value: say a third of all rows share one score) has buckets of
   its own, cut further by ``k``;
4. positions inside a bucket come from a window over (group, bucket); the sizes of the buckets
   before it come from a window over the small totals table, joined back on (group, bucket).

Positions are exact for any bounds; the bounds only steer the balance.  Order of ``v`` in either
direction: numbers, then NaN, then null - whatever the number of buckets.
"""

from __future__ import annotations

import math
import os
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapse.sources.store import materialize

ROWS_PER_BUCKET = 2_000_000
QUANTILE_ACCURACY = 10_000


@dataclass(frozen=True)
class RankPlan:
    """Tuning knob; tests shrink ``rows_per_bucket`` to force many buckets."""

    rows_per_bucket: int = ROWS_PER_BUCKET


# LAPSE_ROWS_PER_BUCKET overrides the default (tests use it to force many buckets on real data).
DEFAULT_PLAN = RankPlan(rows_per_bucket=int(os.environ.get("LAPSE_ROWS_PER_BUCKET", ROWS_PER_BUCKET)))


def join_null_safe(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``cols`` where null matches null (group keys may be null); keeps one
    copy of each key column."""
    cols = list(cols)
    if not cols:
        raise ValueError("join_null_safe needs at least one key column")
    r = right.select(*[F.col(c).alias(f"_r_{c}") for c in cols], *[c for c in right.columns if c not in cols])
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(r[f"_r_{c}"])
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in cols])


def _proxy(df: DataFrame, v: str, descending: bool) -> Column:
    """Monotone (not strict) double of the leading value, ascending in the wanted order: a string's
    first 6 UTF-8 bytes, a number as a double.  Rows of equal proxies share a bucket."""
    if isinstance(df.schema[v].dataType, T.StringType):
        x = F.conv(F.rpad(F.substring(F.hex(F.col(v)), 1, 12), 12, "0"), 16, 10).cast("double")
    else:
        x = F.col(v).cast("double")
    return -x if descending else x


def _splits(quantiles: list[float]) -> tuple[list[float], list[int]]:
    """(bucket borders, parts of each bucket): every distinct quantile begins a bucket, and a value
    met several times has one of its own, in as many parts."""
    times = Counter(quantiles)
    borders: dict[float, int] = {}
    for x in sorted(times):
        borders[x] = times[x]
        if times[x] > 1:
            borders.setdefault(math.nextafter(x, math.inf), 1)
    xs = sorted(x for x in borders if math.isfinite(x))
    return [-math.inf, *xs, math.inf], [1, *[borders[x] for x in xs]]


def _search(df: DataFrame, borders: list[float], src: str, out: str) -> DataFrame:
    """Bucket number by binary search over the borders."""
    return Bucketizer(splits=borders, inputCol=src, outputCol=out, handleInvalid="keep").transform(df).withColumn(
        out, F.col(out).cast("int"))


def _with_buckets(stored: DataFrame, k: str | None, n_buckets: int) -> DataFrame:
    """Add ``_b1`` (range of v) and ``_b2`` (range of k inside a hot value)."""
    qs = [(i + 0.5) / n_buckets for i in range(n_buckets)]
    accuracy = max(QUANTILE_ACCURACY, 10 * n_buckets)
    cols = [F.percentile_approx(F.when(F.col("_class") == 0, F.col("_proxy")), qs, accuracy).alias("v")]
    if k is not None:
        cols.append(F.percentile_approx(F.col(k).cast("double"), qs, accuracy).alias("k"))
    st = stored.agg(*cols).first()  # n_buckets numbers each
    borders, parts = _splits([x for x in st["v"] or []])
    d = stored.withColumn("_proxy", F.when(F.col("_class") == 0, F.col("_proxy")).otherwise(F.lit(0.0)))
    d = _search(d, borders, "_proxy", "_b1")
    d = d.withColumn("_b1", F.when(F.col("_class") == 0, F.col("_b1")).otherwise(F.lit(len(parts)) + F.col("_class") - 1))
    if k is None or not st["k"]:
        return d.withColumn("_b2", F.lit(0))
    k_borders = [-math.inf, *sorted({x for x in st["k"] if math.isfinite(x)}), math.inf]
    d = d.withColumn("_k", F.coalesce(F.col(k).cast("double"), F.lit(math.inf)))
    d = _search(d, k_borders, "_k", "_b2")
    # the k ranges of all rows, folded into as many parts as the bucket needs
    of_bucket = F.element_at(F.array(*[F.lit(x) for x in [*parts, n_buckets, n_buckets]]), F.col("_b1") + 1)
    return d.withColumn("_b2", F.floor(F.col("_b2") * of_bucket / (len(k_borders) - 1)).cast("int")).drop("_k")


def ordered_running(
    df: DataFrame,
    v: str,
    *,
    descending: bool = False,
    k: str | None = None,
    tiebreak: Sequence[str] = (),
    group: Sequence[str] = (),
    sums: Sequence[str] = (),
    pos_col: str = "pos",
    totals: bool = False,
    plan: RankPlan = DEFAULT_PLAN,
) -> DataFrame:
    """Add ``pos_col`` (1-based position) and ``<s>_cum`` (inclusive running sums) per group.

    Order: ``v`` (desc if ``descending``; NaN, then null last), then ``k`` ascending, then
    ``tiebreak`` ascending.  The order must be total within a group for ``pos`` to be unique.
    With ``totals``, also ``_rows_total`` and ``<s>_total`` per group.
    """
    group = list(group)
    number = isinstance(df.schema[v].dataType, (T.FloatType, T.DoubleType))
    nan = F.isnan(F.col(v)) if number else F.lit(False)
    cls = F.when(F.col(v).isNull(), 2).when(nan, 1).otherwise(0)
    stored = materialize(df.withColumns({"_proxy": _proxy(df, v, descending), "_class": cls}), "ordered")
    n_buckets = max(1, math.ceil(stored.count() / max(1, plan.rows_per_bucket)))
    order = [F.asc("_class"), F.desc(v) if descending else F.asc(v)]
    order += [F.asc_nulls_last(c) for c in ([k] if k is not None else [])] + [F.asc(c) for c in tiebreak]

    def positions(d: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return d.withColumns({pos_col: F.row_number().over(w).cast("long"), **{f"{s}_cum": F.sum(s).over(run) for s in sums}})

    if n_buckets == 1:
        out = positions(stored, group)
        if totals:
            whole = Window.partitionBy(*group)
            out = out.withColumns({"_rows_total": F.count(F.lit(1)).over(whole), **{f"{s}_total": F.sum(s).over(whole) for s in sums}})
        return out.drop("_proxy", "_class")

    keys = [*group, "_b1", "_b2"]
    bucketed = _with_buckets(stored, k, n_buckets)
    # one row per (group, bucket): what lies before each bucket, and the group's totals
    sizes = bucketed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(s).alias(f"_t_{s}") for s in sums])
    before = Window.partitionBy(*group).orderBy("_b1", "_b2").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = sizes.select(
        *keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off_n"), F.sum("_n").over(whole).alias("_rows_total"),
        *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_off_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(whole).alias(f"{s}_total") for s in sums],
    )
    j = join_null_safe(positions(bucketed, keys), offsets, keys)
    j = j.withColumns({pos_col: F.col(pos_col) + F.col("_off_n"), **{f"{s}_cum": F.col(f"{s}_cum") + F.col(f"_off_{s}") for s in sums}})
    drop = ["_proxy", "_class", "_b1", "_b2", "_off_n", *[f"_off_{s}" for s in sums]]
    if not totals:
        drop += ["_rows_total", *[f"{s}_total" for s in sums]]
    return j.drop(*drop)


def average_rank_by_value(df: DataFrame, v: str, *, group: Sequence[str] = (), out: str = "avg_rank",
                          descending: bool = True, plan: RankPlan = DEFAULT_PLAN) -> DataFrame:
    """Table (group, v, avg_rank) with tied values sharing the mean of their ranks.

    Works on the distinct-value table (one row per value: hot values were combined
    map-side), then ``avg_rank = rows before + (ties + 1) / 2``.
    """
    dv = df.groupBy(*group, v).agg(F.count(F.lit(1)).alias("_c"))
    r = ordered_running(dv, v, descending=descending, group=group, sums=["_c"], pos_col="_vpos", plan=plan)
    return r.select(
        *group, v, (F.col("_c_cum") - F.col("_c") + (F.col("_c") + 1) / 2.0).cast("double").alias(out)
    )
