"""Order, prefix sums and list ranking of whole tables, none of which gathers a key or the table in one task.

``global_order`` numbers rows by a total order, ``prefix`` runs an aggregate over gapless positions
and ``list_ranks`` gives the place of every element of a linked list.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapse.sources.store import materialize

BUCKET = 1 << 16


def global_order(df: DataFrame, order: list[Column], name: str, out: str = "g") -> DataFrame:
    """``df`` with gapless positions from 0 in the total order: one range shuffle, stored, then the rows of
    the partitions before are added.  A key of many rows is split by the later columns of the order."""
    placed = materialize(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), name)
    placed = placed.withColumn("_part", F.shiftright("_at", 33).cast("int"))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    j = placed.join(sizes, "_part")
    return j.withColumn(out, F.col("_off") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).drop("_at", "_part", "_off")


def prefix(df: DataFrame, at: str, runs: dict[str, tuple[str, str]], bucket: int = BUCKET) -> DataFrame:
    """``df`` with inclusive running aggregates in the order of the gapless positions ``at``.

    ``runs`` maps a new column to (aggregate, column), the aggregate "sum", "max" or "bit_xor".  Buckets of positions are
    run apart; a window over one row per bucket gives what lies before each."""
    d = df.withColumn("_b", F.floor(F.col(at) / F.lit(bucket)).cast("long"))
    call = lambda fn, c: getattr(F, fn)(c)
    inside = Window.partitionBy("_b").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d2 = d.withColumns({out: call(fn, c).over(inside) for out, (fn, c) in runs.items()})
    totals = d.groupBy("_b").agg(*[call(fn, c).alias(f"_t_{out}") for out, (fn, c) in runs.items()])
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("_b", *[call(fn, f"_t_{out}").over(before).alias(f"_o_{out}") for out, (fn, c) in runs.items()])
    j = d2.join(totals, "_b")
    add = {
        "sum": lambda x, o: x + F.coalesce(o, F.lit(0)),
        "bit_xor": lambda x, o: x.bitwiseXOR(F.coalesce(o, F.lit(0))),
        "max": lambda x, o: F.when(x.isNull() | (o > x), o).otherwise(x),
    }
    return j.withColumns({out: add[fn](F.col(out), F.col(f"_o_{out}")) for out, (fn, _) in runs.items()}).drop(
        "_b", *[f"_o_{out}" for out in runs])


def _taken(r: int) -> Column:
    """An element with both neighbours whose hash of this round is above theirs (so no two adjacent)."""
    h = lambda c: F.xxhash64(F.col(c), F.lit(r))
    return F.col("prv").isNotNull() & F.col("nxt").isNotNull() & (h("id") > h("prv")) & (h("id") > h("nxt"))


def _contract(links: DataFrame, r: int) -> DataFrame:
    """One round: a third of the living elements leave; the one before and the one after are linked."""
    live = F.col("gone").isNull()
    none = F.lit(None).cast("long")
    row = lambda i, p, n, d, gone: F.struct(i.alias("id"), p.alias("prv"), n.alias("nxt"), d.alias("d"), gone.alias("gone"))
    zero, no_round = F.lit(0).cast("long"), F.lit(None).cast("int")
    prv, nxt, d, i = F.col("prv"), F.col("nxt"), F.col("d"), F.col("id")
    rows = F.when(live & _taken(r), F.array(
        row(i, prv, nxt, d, F.lit(r)), row(prv, none, nxt, zero, no_round), row(nxt, prv, none, d, no_round)
    )).otherwise(F.array(row(i, prv, nxt, d, F.col("gone"))))
    # own links of an element are replaced by those told: they come with the smaller flag
    told = links.select(F.posexplode(rows).alias("k", "m")).select("m.*", (F.col("k") > 0).alias("told"))
    pick = lambda c: F.coalesce(F.max(F.when(F.col("told"), F.col(c))), F.max(F.when(~F.col("told"), F.col(c))))
    return told.groupBy("id").agg(pick("prv").alias("prv"), pick("nxt").alias("nxt"), F.sum("d").alias("d"), F.max("gone").alias("gone"))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the few elements left, by their distances from the one before."""
    table = pa.Table.from_batches(list(batches), pa.schema([("id", pa.int64()), ("prv", pa.int64()), ("d", pa.int64())]))
    after = {p: (i, d) for i, p, d in zip(*(table[c].to_pylist() for c in ("id", "prv", "d")))}
    ids, places, at = [], [], 0
    step = after.get(None)
    while step is not None:
        at += step[1]
        ids.append(step[0])
        places.append(at)
        step = after.get(step[0])
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(places, pa.int64())], ["id", "place"])


def list_ranks(links: DataFrame, base: int = 4096, rounds: int = 3) -> DataFrame:
    """(id, place): the place from 0 of every element of one linked list (id, prv, nxt; null at the ends).

    Rounds take out an independent third of the list, chosen by hashes that each element knows of itself
    and its neighbours, until ``base`` elements at most are left; their places are walked, then the rounds
    are undone, latest first: the place of an element is that of its predecessor at the time plus its
    distance.  Every join is on keys that occur once, so there is nothing to skew; the work is three
    times that of the first round, and tables are stored after every ``rounds`` rounds.
    """
    cur = materialize(links.select(
        "id", "prv", "nxt", F.when(F.col("prv").isNull(), 0).otherwise(1).cast("long").alias("d"), F.lit(None).cast("int").alias("gone")), "list-0")
    left, r, undone = cur.count(), 0, []
    while left > base:
        nxt = cur
        for _ in range(rounds):
            nxt = _contract(nxt, r)
            r += 1
        nxt = materialize(nxt, f"list-{r}")
        undone.append((nxt, range(r - rounds, r)))
        cur = nxt.filter("gone is null")
        left = cur.count()
    places = cur.select("id", "prv", "d").coalesce(1).mapInArrow(_walk, "id long, place long")
    for table, taken in reversed(undone):
        for k in reversed(taken):
            back = table.filter(F.col("gone") == k).select(F.col("id").alias("_id"), F.col("prv").alias("_prv"), F.col("d").alias("_d"))
            found = back.join(places, F.col("_prv") == F.col("id")).select(F.col("_id").alias("id"), (F.col("place") + F.col("_d")).alias("place"))
            places = places.unionByName(found)
        places = materialize(places, "list-places")
    return places
