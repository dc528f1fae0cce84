"""Operator 6: exact substring dedup over fixed-length word windows.

Every window of ``window`` consecutive words gets a Rabin-Karp hash.  So that equal windows meet
without moving each one as a row, consecutive windows that share their anchor (the smallest hash
of a ``GRAM``-word run inside the window, a function of the window's words alone) travel
together as one row keyed by the anchor: equal windows have equal anchors.  After that single
exchange Spark counts every (anchor, window hash); a window counted twice or more is repeated, at
either of its places.  An anchor met once only, whose row holds no hash twice, has no repeats
and is dropped before the rows are unfolded.  Equal rows of one slice of the input are combined before
the exchange, with a list of their owners, so a group of copies sends a row per slice.  Repeated windows return per document as bit
masks, and overlapping or touching ones merge into maximal removal intervals.

Anchor and window hash together are 128 bits of the window's words.

Defined cases: null and empty texts have no words, lose nothing and keep the empty text; texts
of fewer than ``window`` words keep all; repeated rows are each other's copies, so all their
windows go; null ids are told apart by their texts; columns beside the id and the text are
carried through by ``remove_repeats``; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapse.llm.names import quoted
from lapse.llm.words import Words, ranges, slices, split_words

WINDOW = 35
GRAM = 8
COMBINED_BYTES = 2 << 20  # text within which equal rows are combined
RUN = 32  # windows in one row at most; a bit mask of a row fits a long


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def window_runs(w: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first word within it, anchor, edges into hashes) of each run, and all hashes."""
    h = w.hashes()
    at, full = w.windows(h, window)
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint64)
    every = np.full(len(h), np.iinfo(np.uint64).max, np.uint64)
    gram_at, gram_hash = w.windows(h, gram)
    every[gram_at] = gram_hash
    anchor = sliding_min(every, window - gram + 1)[at]
    doc = w.doc[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    run_start = np.flatnonzero(fresh)
    inside = np.arange(len(at)) - np.repeat(run_start, np.diff(np.append(run_start, len(at))))
    head = np.flatnonzero(inside % min(RUN, window) == 0)
    return doc[head], at[head] - w.first[doc[head]], anchor[head], np.append(head, len(at)), full


OWNER = pa.struct([("kid", pa.int64()), ("khash", pa.int32()), ("first", pa.int32())])


def _emit(window: int, gram: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, size=COMBINED_BYTES):
            doc, first, anchor, edges, full = window_runs(split_words(b.column("text")), window, gram)
            if not len(doc):
                continue
            # a run has at most as many windows as a window has words: its first and its last window
            # cover all its words, and with their number they name it
            n = np.diff(edges)
            ends = (n, full[edges[1:] - 1], full[edges[:-1]], anchor)
            order = np.lexsort(ends)
            head = np.ones(len(order), bool)
            head[1:] = np.any([x[order[1:]] != x[order[:-1]] for x in ends], axis=0)
            lead = order[head]
            many = np.diff(np.append(np.flatnonzero(head), len(order)))
            kid, khash = b.column("kid").take(pa.array(doc)), b.column("khash").take(pa.array(doc))
            firsts = pa.array(first.astype(np.int32))
            rest = pa.array(order[~head])  # the owners beside the first, group by group
            more = pa.StructArray.from_arrays([kid.take(rest), khash.take(rest), firsts.take(rest)], fields=list(OWNER))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(many - 1)]).astype(np.int32)), more)
            hashes = full[ranges(edges[lead], n[lead])]
            at = pa.array(lead)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor[lead].view(np.int64)), kid.take(at), khash.take(at), firsts.take(at),
                 pc.if_else(pa.array(many > 1), lists, pa.scalar(None, lists.type)),
                 pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n[lead])]).astype(np.int32)), pa.array(hashes.view(np.int64)))],
                names=["anchor", "kid", "khash", "first", "more", "hashes"],
            )

    return run


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and text as ``kid``, ``khash`` and ``text``.  Equal keys mean equal id and text, so
    repeated rows share their (equal) result; a null id is replaced by its text's hash."""
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(quoted(id_col).cast("long"), F.xxhash64(text)).alias("kid"), F.hash(text).alias("khash"), text.alias("text")
    )


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     gram: int = GRAM) -> DataFrame:
    """(kid, khash, spans): per text that has repeated windows, an array of (first, mask), where bit
    i of mask says that the window that starts at word ``first + i`` occurs elsewhere too."""
    src = keyed(docs, id_col, text_col)
    rows = src.mapInArrow(_emit(window, gram), "anchor long, kid long, khash int, first int, "
                          "more array<struct<kid:long,khash:int,first:int>>, hashes array<long>")
    rows = rows.withColumn("owners", F.lit(1) + F.coalesce(F.size("more"), F.lit(0)))
    met = F.sum("owners").over(Window.partitionBy("anchor"))
    rows = rows.withColumn("met", met).filter("met > 1 or size(array_distinct(hashes)) < size(hashes)")
    one = rows.select("anchor", "kid", "khash", "first", "more", "owners", F.size("hashes").alias("n"), F.posexplode("hashes").alias("i", "hash"))
    one = one.withColumn("more", F.when(F.col("i") == 0, F.col("more")))
    times = F.sum("owners").over(Window.partitionBy("anchor", "hash"))
    again = one.withColumn("times", times).filter("times > 1")
    # a row of one owner has its repeated windows; of a row of several all windows are, once for each owner
    own = F.array(F.struct("kid", "khash", "first", F.expr("shiftleft(1L, i)").alias("mask")))
    whole = F.expr("shiftrightunsigned(-1L, 64 - n)")
    each = F.transform(F.concat(F.array(F.struct("kid", "khash", "first")), F.col("more")),
                       lambda o: F.struct(o.kid.alias("kid"), o.khash.alias("khash"), o.first.alias("first"), whole.alias("mask")))
    flags = F.when(F.col("owners") == 1, own).when(F.col("i") == 0, each)
    masks = again.select("anchor", F.explode(flags).alias("f")).select("anchor", "f.*").groupBy("anchor", "kid", "khash", "first").agg(
        F.bit_or("mask").alias("mask")
    )
    return masks.groupBy("kid", "khash").agg(F.collect_list(F.struct("first", "mask")).alias("spans"))


def covered_words(first: np.ndarray, mask: np.ndarray, n_words: int, window: int) -> np.ndarray:
    """Whether each word lies in a repeated window: the union of all windows as maximal intervals."""
    bits = (mask.view(np.uint64)[:, None] >> np.arange(RUN, dtype=np.uint64)) & np.uint64(1)
    row, i = np.nonzero(bits)
    start = first[row] + i
    depth = np.zeros(n_words + 1, np.int64)
    np.add.at(depth, start, 1)
    np.add.at(depth, start + window, -1)
    return np.cumsum(depth[:-1]) > 0


def cut(batch: pa.RecordBatch, window: int) -> Iterator[tuple[int, Words, np.ndarray, int, int]]:
    """Per row of a batch with ``text`` and ``spans``: (row, words, kept mask, first and last word)."""
    w = split_words(batch.column("text"))
    spans = batch.column("spans")
    for i in range(batch.num_rows):
        lo, hi = int(w.first[i]), int(w.first[i + 1])
        kept = np.ones(hi - lo, bool)
        if spans[i].is_valid:
            values = spans[i].values
            kept = ~covered_words(
                values.field("first").to_numpy(zero_copy_only=False).astype(np.int64),
                values.field("mask").to_numpy(zero_copy_only=False), hi - lo, window,
            )
        yield i, w, kept, lo, hi


def _with_spans(docs: DataFrame, id_col: str, text_col: str, window: int, gram: int) -> DataFrame:
    """``docs`` as (row struct, text, spans)."""
    spans = repeated_windows(docs, id_col, text_col, window, gram)
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    left = docs.select(
        F.struct(*[quoted(c) for c in docs.columns if c != text_col]).alias("row"), text.alias("text"),
        F.coalesce(quoted(id_col).cast("long"), F.xxhash64(text)).alias("kid"), F.hash(text).alias("khash"),
    )
    return left.join(spans, ["kid", "khash"], "left").select("row", "text", "spans")


def kept_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row: the words left, joined by one space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            words, removed, digests = [], [], []
            for _, w, kept, lo, hi in cut(b, window):
                left = np.flatnonzero(kept) + lo
                text = b" ".join(w.data[s:e].tobytes() for s, e in zip(w.start[left], w.end[left]))
                words.append(hi - lo)
                removed.append(hi - lo - len(left))
                digests.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("row").field(0), pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests)],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )

    ids = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).alias("text"))
    return _with_spans(ids, "doc_id", "text", window, gram).mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated windows cut out of the text: each maximal interval goes with the
    white space before it; texts without repeats stay byte for byte."""
    rest = T.StructType([f for f in docs.schema.fields if f.name != text_col])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            texts = []
            for i, w, kept, lo, hi in cut(b, window):
                if kept.all():
                    texts.append(b.column("text")[i].as_py())
                    continue
                left = np.flatnonzero(kept) + lo
                join = np.flatnonzero(np.diff(left) > 1) + 1
                parts = [
                    w.data[w.start[run[0]] : w.end[run[-1]]].tobytes().decode()
                    for run in np.split(left, join) if len(run)
                ]
                texts.append(" ".join(parts))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    out = _with_spans(docs, id_col, text_col, window, gram).mapInArrow(
        run, T.StructType([T.StructField("row", rest), T.StructField("text", T.StringType())]))
    return out.select(*[F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
