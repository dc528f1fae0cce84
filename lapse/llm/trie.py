"""Operator 12: prefix trie of conversations, summed over subtrees by the Euler-tour technique.

A node is a distinct sequence of the first d turns (role, text); its id is its smallest member and d.
Prefixes are keyed by the 256-bit exclusive-or of SHA-256 digests of (position, role, text), a running
aggregate, so texts are read once and never moved.  Nodes are numbered by one global order of
(parent key, smallest member): the children of a node are a range of numbers, so each node knows
its next sibling, and a parent needs its first and last child only.  Every node then has an enter
and an exit arc; the tour (enter -> first child or own exit, exit -> next sibling or the parent's exit) is one
linked list, ranked by ``scans.list_ranks``; leaves and savings are prefix sums at the arcs' places, and a
subtree's sum is that at its exit less that before its enter.

Nothing is gathered per conversation, node or parent: positions, running keys, parents and sums come from
global positions cut into buckets, so a conversation, first turn or parent with a third of all rows is spread.
The digest of a node's members must run over them in order: members are joined to strings of 4,096 ids at most in
parallel, and one task streams a node's strings through SHA-256.

Defined cases: a null role or text is empty; turns go by turn (null first), equal turns by role, then by
the digest of the text; repeated rows are turns of their own; rows with a null conversation id belong to no
conversation; a conversation without turns (after rebuilding) ends at the root; very long texts
are read in slices by their digest and words only; further columns, whatever their names, are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapse.llm.scans import global_order, list_ranks, prefix
from lapse.sources.store import materialize

LANES = ("k0", "k1", "k2", "k3")
IDS_PER_CHUNK_BITS = 12
WORD = r"[^\x20\x09-\x0D]+"


def _lanes(digest: Column) -> list[Column]:
    """A hex SHA-256 digest as four longs."""
    return [F.conv(F.substring(digest, 1 + 16 * i, 16), 16, -10).cast("long").alias(k) for i, k in enumerate(LANES)]


def ordered_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, digest, words): the turns of every conversation by position from 0, without their texts."""
    c = lambda x: F.col(f"`{x}`")
    say = lambda x: F.coalesce(c(x).cast("string"), F.lit(""))
    rows = conversations.filter(c(conv).isNotNull()).select(
        c(conv).cast("long").alias("conv"), c(turn).alias("turn"), say(role).alias("role"),
        F.sha2(F.concat(F.octet_length(say(role)).cast("string"), F.lit(":"), say(role), say(text)), 256).alias("digest"),
        F.regexp_count(say(text), F.lit(WORD)).cast("long").alias("words"))
    # repeated rows are alike: the last column only lets a range cut fall between them
    placed = global_order(rows, [F.asc("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest"), F.rand(7)], "trie-turns")
    first = placed.groupBy("conv").agg(F.min("g").alias("first"))
    return placed.join(first, "conv").select("conv", (F.col("g") - F.col("first")).alias("pos"), "digest", "words")


def rebuilt(turns: DataFrame, every: int = 20, share: int = 4) -> DataFrame:
    """(conv, pos, digest, words) after rebuilding: the first h turns of conversation c - c % every, then the own
    turns after the first h, h = crc32(c) % share; conversations that lose all turns have none here."""
    h = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(share)).cast("long")
    sizes = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).withColumns({"h": h, "donor": F.col("conv") - F.col("conv") % every})
    heads = turns.filter(F.col("pos") < share - 1)
    donors = sizes.select(F.col("conv").alias("donor"), F.col("n").alias("donor_n"))
    plan = sizes.join(donors, "donor", "left").withColumn("given", F.least("h", F.coalesce("donor_n", F.lit(0))))
    plan = materialize(plan.select("conv", "donor", "h", "given"), "trie-rebuild")
    taken = plan.select(F.col("conv").alias("to"), "donor", "given").join(heads, F.col("donor") == F.col("conv")).filter(
        F.col("pos") < F.col("given")).select(F.col("to").alias("conv"), "pos", "digest", "words")
    own = turns.join(plan.select("conv", "h", "given"), "conv").filter(F.col("pos") >= F.col("h")).select(
        "conv", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "digest", "words")
    return taken.unionByName(own)


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv, depth, own key, parent's key, words): one row per conversation and prefix of one turn or more."""
    at = F.sha2(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("digest")), 256)
    rows = turns.select("conv", "pos", "words", *_lanes(at))
    placed = global_order(rows, [F.asc("conv"), F.asc("pos")], "trie-prefixes")
    # the running exclusive-or over all rows; that before a conversation's first turn takes it back to the conversation
    run = _xor_before(placed)
    start = run.filter(F.col("pos") == 0).select("conv", *[F.col(f"b{k}").alias(f"s{k}") for k in LANES])
    run = run.join(start, "conv")
    parent = [F.col(f"b{k}").bitwiseXOR(F.col(f"s{k}")).alias(f"p{k}") for k in LANES]
    own = [F.col(f"b{k}").bitwiseXOR(F.col(f"s{k}")).bitwiseXOR(F.col(k)).alias(k) for k in LANES]
    return run.select("conv", (F.col("pos") + 1).alias("depth"), *own, *parent, "words")


def _xor_before(placed: DataFrame) -> DataFrame:
    """Add b<lane>: the exclusive-or of the lane over all rows before, in the order of ``g``."""
    out = prefix(placed, "g", {f"x{k}": ("bit_xor", k) for k in LANES})
    return out.withColumns({f"b{k}": F.col(f"x{k}").bitwiseXOR(F.col(k)) for k in LANES}).drop(*[f"x{k}" for k in LANES])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's chunks, which come in order; a node goes on from one batch to the next."""
    key, h = None, None
    for batch in batches:
        done: list[tuple] = []
        for *k, ids in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            if k != key:
                if key is not None:
                    done.append((*key, h.hexdigest()))
                key, h = k, hashlib.sha256()
            else:
                h.update(b",")
            h.update(ids.encode())
        yield _digest_batch(done)
    if key is not None:
        yield _digest_batch([(*key, h.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays(
        [*[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.string())], [*LANES, "ends"])


def _ends(members: DataFrame) -> DataFrame:
    """(key, ends): digest of the ascending ids of the members (key, conv) that end at each node."""
    chunk = F.shiftright("conv", IDS_PER_CHUNK_BITS).alias("chunk")  # 4,096 ids at most
    chunks = members.groupBy(*LANES, chunk).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids"))
    ordered = chunks.repartition(*LANES).sortWithinPartitions(*LANES, "chunk").select(*LANES, "ids")
    return ordered.mapInArrow(_digests, "k0 long, k1 long, k2 long, k3 long, ends string")


def trie(turns: DataFrame, conversations: DataFrame, rank_base: int = 4096) -> DataFrame:
    """One row per trie node of ``turns`` (conv, pos, digest, words), members being all of ``conversations``
    (conv): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    members = materialize(_prefixes(turns), "trie-members")
    zeros = [F.lit(0).cast("long").alias(k) for k in LANES]
    nulls = [F.lit(None).cast("long").alias(f"p{k}") for k in LANES]
    root = conversations.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0").select(
        *zeros, F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("words"), *nulls)
    nodes = members.groupBy(*LANES).agg(
        F.max("depth").alias("depth"), F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"), *[F.max(f"p{k}").alias(f"p{k}") for k in LANES])
    order = [*[F.asc_nulls_first(f"p{k}") for k in LANES], F.asc("conv_id")]
    nodes = materialize(global_order(nodes.unionByName(root), order, "trie-nodes", "nid"), "trie-numbered")

    # children of a node: numbers first..last; the root, which sorts before all, is number 0
    kids = nodes.filter("depth > 0").groupBy(*[F.col(f"p{k}").alias(k) for k in LANES]).agg(
        F.min("nid").alias("first"), F.max("nid").alias("last"), F.count(F.lit(1)).alias("n_children"))
    shape = materialize(nodes.join(kids, list(LANES), "left").select(
        *LANES, "nid", "depth", "conv_id", "n_convs", "words", "first", "last", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children")),
        "trie-shape")

    places = list_ranks(tour(shape), rank_base)
    sums = subtree_sums(shape, places)

    # a node's parent is that of the first sibling: the last one told in the order of numbers
    told = shape.filter("first is not null").select(F.col("first").alias("nid"), F.struct(F.col("first").alias("at"), F.col("conv_id").alias("id")).alias("told"))
    named = prefix(shape.select("nid").join(told, "nid", "left"), "nid", {"parent": ("max", "told")}).select(
        "nid", F.col("parent.id").alias("parent_conv_id"))

    depth = members.groupBy("conv").agg(F.max("depth").alias("depth"))
    last = members.join(depth, ["conv", "depth"]).select(*LANES, "conv")
    turnless = conversations.select("conv").join(depth, "conv", "left_anti").select(*zeros, "conv")
    ends = _ends(last.unionByName(turnless))

    nothing = hashlib.sha256(b"").hexdigest()
    return (
        shape.join(sums, "nid").join(named, "nid").join(ends, list(LANES), "left")
        .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"))
    )


def tour(shape: DataFrame) -> DataFrame:
    """(id, prv, nxt) of the Euler tour: arc 2 * nid enters a node, 2 * nid + 1 leaves it."""
    nid = F.col("nid")
    enter, leave = lambda x: 2 * x, lambda x: 2 * x + 1
    inner = F.col("first").isNotNull()
    none = F.lit(None).cast("long")
    arc = lambda i, p, n, told: F.struct(i.alias("id"), p.alias("prv"), n.alias("nxt"), F.lit(told).alias("told"))
    own = [
        arc(enter(nid), F.when(nid > 0, leave(nid - 1)), F.when(inner, enter(F.col("first"))).otherwise(leave(nid)), False),
        arc(leave(nid), F.when(inner, leave(F.col("last"))).otherwise(enter(nid)), F.when(nid > 0, enter(nid + 1)), False),
    ]
    # a parent tells its first child what comes before it and its last what comes after it
    said = [arc(enter(F.col("first")), enter(nid), none, True), arc(leave(F.col("last")), none, leave(nid), True)]
    rows = shape.select(F.explode(F.when(inner, F.array(*own, *said)).otherwise(F.array(*own))).alias("m")).select("m.*")
    pick = lambda c: F.coalesce(F.max(F.when(F.col("told"), F.col(c))), F.max(F.when(~F.col("told"), F.col(c)))).alias(c)
    return rows.groupBy("id").agg(pick("prv"), pick("nxt"))


def subtree_sums(shape: DataFrame, places: DataFrame) -> DataFrame:
    """(nid, n_leaves, saved_tokens) summed over each subtree: prefix sums of the enter arcs' weights."""
    weight = shape.select(
        (2 * F.col("nid")).alias("id"), (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    arcs = places.join(weight, "id", "left").select("id", "place", zero("leaf"), zero("saved"))
    run = prefix(arcs, "place", {"leaves": ("sum", "leaf"), "saving": ("sum", "saved")})
    # at the exit all of the subtree is in; before the enter none of it
    leaving = F.col("id") % 2 == 1
    signed = lambda total, own: F.when(leaving, F.col(total)).otherwise(F.col(own) - F.col(total))
    return run.groupBy(F.shiftright("id", 1).alias("nid")).agg(
        F.sum(signed("leaves", "leaf")).alias("n_leaves"), F.sum(signed("saving", "saved")).alias("saved_tokens"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of a table (conv_id, turn, role, text)."""
    turns = materialize(ordered_turns(conversations), "trie-ordered")
    ids = turns.select("conv").distinct()
    return trie(rebuilt(turns), ids)
