"""Operator 11: divergence of sources, over a K-squared quadtree of the group-term count matrix.

Rows of the matrix are the sources of one language, columns the terms that at least ``min_docs`` of
its documents hold; a term's share of a group is ``p = 1 + floor(10^9 (count + 5) / (N + 5 V))``.
Counts are combined per slice in the tasks, then by Spark.  Columns are dealt by hash into tiles of about
``TILE_TERMS``, rows into blocks of ``BLOCK_ROWS`` (a tile of a language holds two blocks at most), and
each (tile, block, block) is one small task-side matrix with its own tree: sides shrink by ``K`` = 4
per level, a level is a bitmap of its nonzero quadrants, and leaves are one row by 64 terms.  Two
quadrants of the same columns are traversed jointly: if both are all zero, nothing below is visited and
their terms are priced at ``width * |p_g(0) - p_h(0)|``, which the last step does for all of them at once
(terms of the language minus terms visited); nonzero leaves are compared cell by cell.  Columns are
ordered by the number of groups that have them, so zeros meet.

Everything is integer arithmetic.  Memory of a task: a tile of 2 * 64 groups by about 4,096 terms, whatever
the number of groups, terms or documents; a hot source is combined before each shuffle.

Defined cases: null text, language and source are read as ''; a group without terms is compared like
any other (all its counts are 0); a language without kept terms has pairs of value 0 and no term rows; ties
rank by item in UTF-8 order; repeated rows count as often as they occur; very long texts are one slice;
further columns, whatever their names, are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapse.llm.runs import byte_runs
from lapse.llm.words import slices
from lapse.sources.store import materialize

SCALE = 1_000_000_000
PRIOR = 5
MIN_DOCS = 30
TOP_TERMS = 50
K = 4
LEAF_TERMS = 64
BLOCK_ROWS = 64      # K^3
TILE_TERMS = 4096    # LEAF_TERMS * K^3
SLICE_BYTES = 4 << 20
PAIRS_AT_ONCE = 1 << 15

_TERM = np.zeros(256, bool)
_TERM[0x41:0x5B] = _TERM[0x61:0x7B] = _TERM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20

_COUNTS = "lang string, source string, term string, n long, docs long"
_TILE_OUT = "lang string, a int, b int, term string, width long, value long"


def _text_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents) of each slice."""
    for batch in slices(batches, "text", SLICE_BYTES):
        runs = byte_runs(batch.column("text"), _TERM)
        if not len(runs.start):
            continue
        term = runs.values(_LOWER).dictionary_encode()
        size = len(term.dictionary)
        lang, source = batch.column("lang").dictionary_encode(), batch.column("source").dictionary_encode()
        group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        in_doc, n = np.unique(runs.text * size + term.indices.to_numpy(), return_counts=True)
        cell, at = np.unique(group[in_doc // size] * size + in_doc % size, return_inverse=True)
        g = cell // size
        yield pa.RecordBatch.from_arrays([
            lang.dictionary.take(pa.array(g // len(source.dictionary))),
            source.dictionary.take(pa.array(g % len(source.dictionary))),
            term.dictionary.take(pa.array(cell % size)).cast(pa.large_string()).cast(pa.string()),
            pa.array(np.bincount(at, weights=n).astype(np.int64)),
            pa.array(np.bincount(at).astype(np.int64)),
        ], ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, text_col: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term of every group."""
    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = docs.select(empty(text_col).alias("text"), empty(lang).alias("lang"), empty(source).alias("source"))
    return rows.mapInArrow(_text_counts, _COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n, total, v):
    """p of a count: exact, in decimals."""
    top = (n + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    bottom = (total + PRIOR * v).cast("decimal(20,0)")
    return F.when(v > 0, 1 + F.call_function("div", top, bottom)).otherwise(F.lit(0)).cast("long")


class Quadtree:
    """Bitmaps of the nonzero quadrants of a small matrix of leaves (rows x strips of terms), top level first."""

    def __init__(self, leaves: np.ndarray):
        self.levels = [leaves]
        while self.levels[0].shape[0] > 1:
            low = self.levels[0]
            rows, cols = -(-low.shape[0] // K), -(-low.shape[1] // K)
            padded = np.zeros((rows * K, cols * K), bool)
            padded[: low.shape[0], : low.shape[1]] = low
            self.levels.insert(0, padded.reshape(rows, K, cols, K).any(axis=(1, 3)))


def joint_leaves(one: Quadtree, two: Quadtree, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of one, row of two, strip) of every pair of leaves that is not zero on both sides; with
    ``same`` each unordered pair of rows once.  Both trees have the same levels."""
    top = one.levels[0] | two.levels[0]
    c = np.flatnonzero(top[0])
    a = b = np.zeros(len(c), np.int64)
    for x, y in zip(one.levels[1:], two.levels[1:]):
        step = np.arange(K)
        a, b, c = (
            v[:, None, None, None] * K + s
            for v, s in ((a, step[:, None, None]), (b, step[None, :, None]), (c, step[None, None, :])))
        a, b, c = (v.ravel() for v in np.broadcast_arrays(a, b, c))
        inside = (a < x.shape[0]) & (b < y.shape[0]) & (c < x.shape[1])
        if same:
            inside &= a <= b
        a, b, c = a[inside], b[inside], c[inside]
        live = x[a, c] | y[b, c]
        a, b, c = a[live], b[live], c[live]
    if same:
        other = a != b
        a, b, c = a[other], b[other], c[other]
    return a, b, c


def _tile(top: int):
    """One (language, tile, row block, row block): visited width and distance of each pair of groups that
    meets a nonzero leaf, and (of a block with itself) the groups' best terms."""

    def run(key, table):
        lang, tile, rb_a, rb_b = (k.as_py() for k in key)
        same = rb_a == rb_b
        row, zero = table["row"].to_numpy(), table["zero"].to_numpy()
        cell = ~table["term"].is_null().to_numpy()
        terms = table["term"].combine_chunks().dictionary_encode()
        col = pc.fill_null(terms.indices, 0).to_numpy().astype(np.int64)
        p = table["p"].to_numpy()
        width = len(terms.dictionary)
        strips = max(1, -(-width // LEAF_TERMS))
        # columns by the number of groups that have them, most first
        place = np.empty(max(width, 1), np.int64)
        if width:
            place[np.lexsort((np.arange(width), -np.bincount(col[cell], minlength=width)))] = np.arange(width)
        col = place[col]
        sides = []
        for rb in (rb_a, rb_b):
            mine = row // BLOCK_ROWS == rb
            ids = np.unique(row[mine])
            base = np.zeros(len(ids), np.int64)
            base[np.searchsorted(ids, row[mine])] = zero[mine]
            m = mine & cell
            r = np.searchsorted(ids, row[m])
            # all leaves of the block: zero cells hold the price of a zero count
            shares = np.repeat(base, strips * LEAF_TERMS).reshape(len(ids), strips, LEAF_TERMS)
            shares[r, col[m] // LEAF_TERMS, col[m] % LEAF_TERMS] = p[m]
            leaves = np.zeros((BLOCK_ROWS, strips), bool)
            leaves[r, col[m] // LEAF_TERMS] = True
            sides.append((ids, shares, Quadtree(leaves)))
            if same:
                sides.append(sides[0])
                break
        (ids_a, of_a, tree_a), (ids_b, of_b, tree_b) = sides
        a, b, c = joint_leaves(tree_a, tree_b, same)
        real = (a < len(ids_a)) & (b < len(ids_b))
        a, b, c = a[real], b[real], c[real]
        n_pairs = len(ids_a) * len(ids_b)
        far, seen = np.zeros(n_pairs, np.int64), np.zeros(n_pairs, np.int64)
        wide = np.minimum(LEAF_TERMS, width - np.arange(strips) * LEAF_TERMS)
        for i in range(0, len(a), PAIRS_AT_ONCE):
            x, y, z = (v[i : i + PAIRS_AT_ONCE] for v in (a, b, c))
            gap = np.abs(of_a[x, z] - of_b[y, z])
            gap *= np.arange(LEAF_TERMS) < wide[z][:, None]
            np.add.at(far, x * len(ids_b) + y, gap.sum(axis=1))
            np.add.at(seen, x * len(ids_b) + y, wide[z])
        out_a, out_b = np.repeat(ids_a, len(ids_b)), np.tile(ids_b, len(ids_a))
        keep = (seen > 0) | (tile == 0)
        keep &= (out_a < out_b) if same else True
        parts = [pa.table({
            "a": pa.array(out_a[keep], pa.int32()), "b": pa.array(out_b[keep], pa.int32()),
            "term": pa.nulls(int(keep.sum()), pa.string()), "width": seen[keep], "value": far[keep]})]
        if same:
            over = table.filter(pc.and_(pc.is_valid(table["term"]), pc.greater(table["p"], table["q"])))
            over = over.append_column("f", pc.subtract(over["p"], over["q"]))
            over = over.take(pc.sort_indices(over, [("row", "ascending"), ("f", "descending"), ("term", "ascending")]))
            r = over["row"].to_numpy()
            over = over.filter(pa.array(np.arange(len(r)) - np.searchsorted(r, r) < top))
            parts.append(pa.table({
                "a": over["row"].cast(pa.int32()), "b": pa.nulls(len(over), pa.int32()), "term": over["term"].cast(pa.string()),
                "width": pa.nulls(len(over), pa.int64()), "value": over["f"]}))
        out = pa.concat_tables(parts)
        return out.add_column(0, "lang", pa.array([lang] * len(out), pa.string()))

    return run


def divergence(docs: DataFrame, text_col: str = "text", lang: str = "lang", source: str = "source", min_docs: int = MIN_DOCS,
               top_terms: int = TOP_TERMS, tile_terms: int = TILE_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` ranks the other sources of the language by the
    distance of their term shares, part ``term`` the terms a source uses more than its language does."""
    counts = materialize(term_counts(docs, text_col, lang, source), "divergence-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n")).filter(
        F.col("docs") >= min_docs).drop("docs")
    cells = materialize(counts.drop("docs").join(kept, ["lang", "term"]), "divergence-cells")

    empty = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    groups = docs.select(empty(lang).alias("lang"), empty(source).alias("source")).distinct()
    of_group = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = cells.groupBy("lang", "term").agg(F.max("lang_n").alias("n")).groupBy("lang").agg(
        F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_total"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    groups = groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").select(
        "lang", "source", zero("total"), zero("lang_total"), zero("v"))
    w = Window.partitionBy("lang")
    groups = groups.withColumns({
        "row": (F.row_number().over(w.orderBy("source")) - 1).cast("int"),
        "blocks": F.ceil(F.count(F.lit(1)).over(w) / F.lit(BLOCK_ROWS)).cast("int"),
        "tiles": F.greatest(F.ceil(F.col("v") / F.lit(tile_terms)), F.lit(1)).cast("int"),
        "zero": share(F.lit(0), F.col("total"), F.col("v")),
    })
    groups = materialize(groups, "divergence-groups")

    # every cell goes to its tile, once per block of rows it is compared with; a row without a term brings
    # each group, also one without a cell there, to each tile
    block, other = F.floor(F.col("row") / BLOCK_ROWS).cast("int"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = cells.join(groups, ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), F.col("tiles")).cast("int").alias("tile"), "row", "zero", "term",
        share(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"), block.alias("rb"), other.alias("other"))
    marks = groups.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile")).select(
        "lang", "tile", "row", "zero", F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("p"),
        F.lit(None).cast("long").alias("q"), block.alias("rb"), other.alias("other"))
    tiles = placed.unionByName(marks).select(
        "lang", "tile", F.least("rb", "other").alias("rb_a"), F.greatest("rb", "other").alias("rb_b"), "row", "zero", "term", "p", "q")
    found = materialize(tiles.groupBy("lang", "tile", "rb_a", "rb_b").applyInArrow(_tile(top_terms), _TILE_OUT), "divergence-tiles")

    names = groups.select("lang", "row", "source", "zero", "v")
    one = names.select("lang", F.col("row").alias("a"), F.col("source").alias("source_a"), F.col("zero").alias("zero_a"), "v")
    two = names.select("lang", F.col("row").alias("b"), F.col("source").alias("source_b"), F.col("zero").alias("zero_b"))
    pairs = found.filter("term is null").groupBy("lang", "a", "b").agg(F.sum("width").alias("seen"), F.sum("value").alias("value"))
    pairs = pairs.join(one, ["lang", "a"]).join(two, ["lang", "b"])
    pairs = pairs.withColumn("value", F.col("value") + (F.col("v") - F.col("seen")) * F.abs(F.col("zero_a") - F.col("zero_b")))
    both = F.explode(F.array(F.struct(F.col("source_a").alias("source"), F.col("source_b").alias("item")),
                             F.struct(F.col("source_b").alias("source"), F.col("source_a").alias("item"))))
    pairs = pairs.select("lang", "value", both.alias("e")).select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    terms = found.filter("term is not null").join(one, ["lang", "a"]).select(
        "lang", F.col("source_a").alias("source"), F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    out = pairs.unionByName(terms).withColumn("rank", F.row_number().over(order))
    return out.filter((F.col("part") == "pair") | (F.col("rank") <= top_terms))
