"""Operator 1: uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

1. The input is written once to the checkpoint folder with each row's partition and place in it,
   so that a recomputed task sees the same rows in the same places.
2. How many rows of each partition go to each shard is drawn exactly: rows of partitions times
   shards with given margins, as a uniform random permutation would deal them.  The matrix is kept as
   narrow cells: the places of a partition are cut into as many stretches as there are shards (or
   places), and a stretch lists only the shards that end in it.  The partitions
   are halved as a tree; at every node the left half's row of shard counts is drawn from a
   multivariate hypergeometric law.  The driver splits at most ``BLOCKS`` blocks of partitions, the
   tasks split the partitions of a block, each node with a seed of its own.
3. A local permutation orders the rows of a partition; the first go to shard 0, the next to
   shard 1 and so on, as drawn: a row meets the one cell that its place falls in.  After the exchange the rows of a shard are permuted again: a
   random 64-bit key cuts a shard into buckets, and a row's slot is its rank in the bucket plus
   the sizes of the buckets before, so no task holds a whole shard.

Shard sizes differ by one at most (law ``rows``).  Defined cases: null texts and ids are rows like
others; repeated rows are shuffled one by one; fewer rows than shards leave the last shards
empty; an empty table gives an empty result; all columns are carried through, but columns named
``shard`` or ``slot`` are replaced.  Texts are never looked at, so very long ones are carried like any column.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.names import quoted
from lapse.sources.store import materialize

BLOCKS = 1024
BUCKET_ROWS = 200_000
PLACE_BITS = 33  # monotonically_increasing_id: partition above, place below


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of n draws without replacement are good: inverse of the cumulative law, whose terms
    follow from the mode by their ratios; exact at any size, about sqrt(n) terms matter."""
    lo, hi = max(0, n - bad), min(n, good)
    u = rng.random()
    if lo >= hi:
        return lo
    total = good + bad
    mode = min(hi, max(lo, (n + 1) * (good + 1) // (total + 2)))
    spread = int(14 * math.sqrt(n * (good / total) * (bad / total)) + 32)
    a, z = max(lo, mode - spread), min(hi, mode + spread)
    k = np.arange(a, z, dtype=np.float64)
    step = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    log = np.concatenate([[0.0], np.cumsum(step)])
    p = np.cumsum(np.exp(log - log.max()))
    return a + int(np.searchsorted(p, u * p[-1], side="right"))


def split_counts(rng: np.random.Generator, capacity: list[int], n: int) -> list[int]:
    """Shard counts of n rows dealt uniformly into places of the given capacities."""
    out, rest = [], sum(capacity)
    for c in capacity:
        got = hypergeometric(rng, c, rest - c, n)
        out.append(got)
        rest, n = rest - c, n - got
    return out


def deal(seed: int, first: int, sizes: list[int], capacity: list[int]) -> list[list[int]]:
    """Shard counts of each of the partitions ``first`` .. with the given sizes; ``capacity`` adds up
    to all their rows.  Every node of the halving has its own seed, so parts can be redone alone."""
    if len(sizes) == 1:
        return [capacity]
    half = len(sizes) // 2
    rng = np.random.default_rng([seed, first, first + len(sizes)])
    left = split_counts(rng, capacity, sum(sizes[:half]))
    right = [c - x for c, x in zip(capacity, left)]
    return deal(seed, first, sizes[:half], left) + deal(seed, first + half, sizes[half:], right)


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (i < rows % shards) for i in range(shards)]


def stretches(n: int, shards: int) -> int:
    """Into how many stretches the n places of a partition are cut; place p lies in stretch p * stretches // n."""
    return max(1, min(n, shards))


def cells(part: int, counts: list[int]) -> pd.DataFrame:
    """(part, stretch, ends, shards) of a partition: the shards with rows in a stretch, each with the place it ends before."""
    counts = np.asarray(counts, np.int64)
    n, used = int(counts.sum()), np.flatnonzero(counts)
    ends = np.cumsum(counts[used])
    k = np.arange(stretches(n, len(counts)), dtype=np.int64)
    first = -(-k * n // len(k))  # the first place of each stretch
    last = np.append(first[1:], n) - 1
    lo, hi = np.searchsorted(ends, first, side="right"), np.searchsorted(ends, last, side="right")
    return pd.DataFrame({"part": part, "stretch": k, "ends": [ends[a : b + 1].tolist() for a, b in zip(lo, hi)],
                         "shards": [used[a : b + 1].tolist() for a, b in zip(lo, hi)]})


def communication_matrix(parts: DataFrame, shards: int, seed: int) -> DataFrame:
    """(part, stretch, ends, shards): the cells of every partition, from (part, n)."""
    n_parts = (parts.agg(F.max("part")).first()[0] or 0) + 1
    width = -(-n_parts // BLOCKS)
    block = F.floor(F.col("part") / width).cast("int")
    sums = {r.b: r.n for r in parts.groupBy(block.alias("b")).agg(F.sum("n").alias("n")).collect()}  # BLOCKS at most
    blocks = sorted(sums)
    schema = "part int, stretch long, ends array<long>, shards array<int>"
    if not blocks:
        return parts.sparkSession.createDataFrame([], schema)
    dealt = dict(zip(blocks, deal(seed, 0, [sums[b] for b in blocks], shard_sizes(sum(sums.values()), shards))))

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        b = int(pdf["b"].iloc[0])
        rows = deal(seed + 1, b * width, pdf["n"].tolist(), dealt[b])
        return pd.concat([cells(int(p), r) for p, r in zip(pdf["part"], rows)], ignore_index=True)

    return parts.withColumn("b", block).groupBy("b").applyInPandas(inside, schema)


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 7, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``df`` plus ``shard`` (0 ..) and ``slot`` (0 .. without gaps in each shard)."""
    df = df.drop("shard", "slot")
    named = [quoted(c).alias(f"_c{i}") for i, c in enumerate(df.columns)]
    rows = materialize(df.select(*named, F.monotonically_increasing_id().alias("_at")), "shards-input")
    rows = rows.withColumns({"part": F.shiftright("_at", PLACE_BITS).cast("int"),
                             "place": F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))})
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    parts = materialize(parts, "shards-parts")
    total = parts.agg(F.sum("n")).first()[0] or 0
    matrix = materialize(communication_matrix(parts, shards, seed), "shards-matrix")

    @F.pandas_udf("long")
    def permuted(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        kept: tuple[int, np.ndarray] = (-1, np.zeros(0, np.int64))  # the last partition's permutation
        for part, place, n in batches:
            out = np.zeros(len(part), np.int64)
            for p, at in part.groupby(part).indices.items():
                if kept[0] != p:
                    kept = (p, np.random.default_rng([seed, 2, int(p)]).permutation(int(n.iloc[at[0]])))
                out[at] = kept[1][place.to_numpy()[at]]
            yield pd.Series(out)

    cut = F.greatest(F.lit(1), F.least(F.col("n"), F.lit(shards)))  # stretches()
    dealt = rows.join(parts, "part").withColumn("place", permuted("part", "place", "n"))
    dealt = dealt.withColumn("cut", cut).withColumn("stretch", F.expr("place * cut div n"))
    dealt = dealt.join(matrix, ["part", "stretch"])
    dealt = dealt.withColumn("shard", F.get("shards", F.size(F.filter("ends", lambda e: e <= F.col("place")))))
    key = F.xxhash64(F.lit(seed), F.col("_at"))
    bits = max(0, math.ceil(math.log2(max(1, total / shards / bucket_rows))))
    dealt = dealt.withColumns({"_key": key, "_bucket": F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")})
    dealt = dealt.drop("ends", "shards", "part", "place", "n", "cut", "stretch")
    rank = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy("_key", "_at")).cast("long")
    ranked = dealt.withColumn("slot", rank - 1)
    if bits:
        sizes = dealt.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("n"))
        before = F.sum("n").over(Window.partitionBy("shard").orderBy("_bucket")) - F.col("n")
        offsets = sizes.select(F.col("shard").alias("_s"), F.col("_bucket").alias("_b"), before.alias("_before"))
        ranked = ranked.join(offsets, (F.col("shard") == F.col("_s")) & (F.col("_bucket") == F.col("_b")))
        ranked = ranked.withColumn("slot", F.col("slot") + F.col("_before"))
    return ranked.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(df.columns)], "shard", "slot")
