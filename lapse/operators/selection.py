"""Exact quantiles by bracket and count, and distributed selection of k rows.

Quantiles.  One aggregate gives each group's row count and approximate quantiles a little below and above each
wanted one.  One more pass counts the rows below such a bracket and aggregates the values inside it; the order
statistics are then picked by running counts over the few distinct values inside.  Two passes, nothing
stored, nothing sorted but the bracket; a group of a third of all rows is combined in the tasks.

Selection.  The k first rows in the order of a hash are those below a threshold, found digit by digit: a
histogram of the leading digits (65,536 rows at most) shows which digit holds the k-th row, the next
histogram looks at rows of that prefix only.  The k rows with the largest value are those above the k-th value (a
bracket again), and of the rows that tie with it those with the smallest keys.  Either way the result is a
filter: no row is ordered and no task merges k rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000
HASH_DIGITS = 4
HASH_LENGTH = 32


def _picked(values: DataFrame, group: list[str], stats: DataFrame, targets: list[tuple[float, Column, Column]]) -> DataFrame:
    """(group, q, _lo, _hi, _n): values at the 0-based positions (low, high) of each target."""
    below_all = F.col("_n") <= F.lit(ACCURACY)  # few rows: every value is inside
    at = lambda i: F.col("_a")[i]
    cut = F.array(*[
        F.struct(F.lit(q).alias("q"), F.when(~below_all, at(2 * i)).alias("lo"), F.when(~below_all, at(2 * i + 1)).alias("hi"))
        for i, (q, _, _) in enumerate(targets)])
    if group:
        r = stats.select(*[F.col(f"`{g}`").alias(f"_g{i}") for i, g in enumerate(group)], "_n", "_a")
        cond = None
        for i, g in enumerate(group):
            e = values[g].eqNullSafe(r[f"_g{i}"])
            cond = e if cond is None else cond & e
        rows = values.join(F.broadcast(r), cond).drop(*[f"_g{i}" for i in range(len(group))])  # one row per group
    else:
        s = stats.select(F.struct("_n", "_a").alias("s")).scalar()
        rows = values.select("_x", s.getField("_n").alias("_n"), s.getField("_a").alias("_a"))
    one = rows.select(*group, "_x", "_n", F.explode(cut).alias("_c"))
    one = one.filter(F.col("_c.hi").isNull() | (F.col("_x") <= F.col("_c.hi")))
    inside = F.when(F.col("_c.lo").isNull() | (F.col("_x") >= F.col("_c.lo")), F.col("_x"))
    counts = one.groupBy(*group, F.col("_c.q").alias("q"), inside.alias("_v")).agg(F.count(F.lit(1)).alias("_c"), F.max("_n").alias("_n"))
    run = Window.partitionBy(*group, "q").orderBy(F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("_last", F.sum("_c").over(run) - 1).withColumn("_first", F.col("_last") - F.col("_c") + 1)
    low = high = F.lit(None).cast("bigint")
    for q, lo, hi in targets:
        low, high = F.when(F.col("q") == q, lo).otherwise(low), F.when(F.col("q") == q, hi).otherwise(high)
    holds = lambda p: F.max(F.when((F.col("_first") <= p) & (p <= F.col("_last")), F.col("_v")))
    return counts.groupBy(*group, "q").agg(holds(low).alias("_lo"), holds(high).alias("_hi"), F.max("_n").alias("_n"))


def _bracketed(values: DataFrame, group: list[str], qs: Sequence[float]) -> DataFrame:
    """(group, _n, _a): rows and, for every q, approximate values 3 errors below and above it."""
    margin = 3.0 / ACCURACY
    probes = [p for q in qs for p in (max(0.0, q - margin), min(1.0, q + margin))]
    return values.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_x", probes, ACCURACY).alias("_a"))


def exact_quantiles(df: DataFrame, col: str, qs: Sequence[float], *, group: Sequence[str] = ()) -> DataFrame:
    """Linear-interpolated quantiles (numpy's default), nulls skipped, NaN above all numbers.

    One row (group, q, value) per group and q; ``group`` takes few values (features, splits, segments), whose
    statistics are broadcast.  A bracket that misses its order statistic fails the job.
    """
    group = list(group)
    values = df.select(*group, F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull())
    qs = [float(q) for q in qs]
    at = lambda q: (F.col("_n") - 1) * (q if isinstance(q, Column) else F.lit(q))
    targets = [(q, F.floor(at(q)), F.ceil(at(q))) for q in qs]
    got = _picked(values, group, _bracketed(values, group, qs), targets)
    place = at(F.col("q"))
    part = place - F.floor(place)
    value = F.when(part == 0, F.col("_lo")).otherwise(F.col("_lo") + (F.col("_hi") - F.col("_lo")) * part)
    missed = F.raise_error(F.lit("quantile bracket missed its value")).cast("double")
    return got.select(*group, "q", F.when(F.col("_lo").isNull() | F.col("_hi").isNull(), missed).otherwise(value).alias("value"))


def kth_value(df: DataFrame, col: str, k: int, descending: bool = False) -> tuple[float | int | None, int, int]:
    """(k-th smallest or largest value, rows strictly before it, rows equal to it); nulls are left out.

    The value is None when there are fewer than k rows, which are then all before it."""
    rows = df.select(F.col(col).alias("_x")).filter(F.col("_x").isNotNull())
    n = rows.count()
    if n < k:
        return None, n, 0
    place = n - k if descending else k - 1
    q = place / max(1, n - 1)
    got = _picked(rows, [], _bracketed(rows, [], [q]), [(q, F.lit(place), F.lit(place))])
    value = got.select(F.when(F.col("_lo").isNull(), F.raise_error(F.lit("selection bracket missed its value"))).otherwise(F.col("_lo"))).first()[0]
    before = (F.col("_x") > F.lit(value)) if descending else (F.col("_x") < F.lit(value))
    c = rows.agg(F.count_if(before).alias("b"), F.count_if(F.col("_x") == F.lit(value)).alias("e")).first()
    return value, c.b, c.e


def top_k(df: DataFrame, col: str, k: int, key: str) -> DataFrame:
    """The k rows of the largest ``col``, ties to the smallest ``key`` (unique), nulls and then NaN last, as a filter."""
    floating = df.schema[col].dataType.simpleString() in ("double", "float")
    number = F.when(~F.isnan(F.col(col)), F.col(col)) if floating else F.col(col)
    d = df.withColumn("_x", number)
    value, before, ties = kth_value(d, "_x", k, descending=True)
    if value is None:  # every number is in; NaN before null, by key
        out, rest = d.filter(F.col("_x").isNotNull()), k - before
        for odd in (F.col(col).isNotNull() & F.col("_x").isNull(), F.col(col).isNull()):
            if rest > 0:
                bound, n, _ = kth_value(d.filter(odd), key, rest)
                out = out.unionByName(d.filter(odd) if bound is None else d.filter(odd & (F.col(key) <= F.lit(bound))))
                rest = rest - n if bound is None else 0
        return out.drop("_x")
    at = F.col("_x") == F.lit(value)
    if before + ties > k:
        bound, _, _ = kth_value(d.filter(at), key, k - before)
        at = at & (F.col(key) <= F.lit(bound))
    return d.filter((F.col("_x") > F.lit(value)) | at).drop("_x")


def hash_order_key(seed: int, key: str) -> Column:
    """md5(seed|key): a reproducible pseudo-random order shared with the SQL oracle."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string")))


def hash_bound(hashes: DataFrame, k: int) -> str | None:
    """The largest leading digits of ``_h`` (hexadecimal) up to which exactly k rows lie; None: all rows.

    One histogram per ``HASH_DIGITS`` digits, each over the rows of the prefix found so far.  Rows that share a
    whole hash cannot be told apart: the bound then holds the first k and their twins.
    """
    prefix, need = "", k
    while len(prefix) < HASH_LENGTH:
        rows = hashes.filter(F.startswith("_h", F.lit(prefix))) if prefix else hashes
        digit = F.substring("_h", len(prefix) + 1, HASH_DIGITS)
        counts = rows.groupBy(digit.alias("d")).agg(F.count(F.lit(1)).alias("n"))
        upto = counts.withColumn("upto", F.sum("n").over(Window.orderBy("d")))  # 65,536 rows at most
        hit = upto.filter(F.col("upto") >= need).orderBy("upto").limit(1).first()
        if hit is None:
            return None  # fewer than k rows
        prefix += hit.d
        if hit.upto == need:
            return prefix
        need -= hit.upto - hit.n
    return prefix


def hash_sample(df: DataFrame, k: int, seed: int, key: str) -> DataFrame:
    """T4: k rows without replacement, reproducible: smallest md5(seed|key); ``key`` is unique, and rows that repeat
    a key are sampled together."""
    if k <= 0:
        return df.filter(F.lit(False))
    d = df.withColumn("_h", hash_order_key(seed, key))
    bound = hash_bound(d.select("_h"), k)
    return (d if bound is None else d.filter(F.substring("_h", 1, len(bound)) <= F.lit(bound))).drop("_h")
