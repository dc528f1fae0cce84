"""Operator 7: byte-level BPE encoding and decoding.

A text is cut into the matches of a pattern and each match is merged on its own.  Over the byte
positions of a match stands a segment tree whose leaves hold the rank of the pair that starts
there (with its position, so that the smallest key is the leftmost pair of minimal rank); the
root names the next merge.  A merge rewrites three leaves - its own, that of the live neighbour
before it, and that of the position it swallowed - and each climbs the tree in log n steps.  Matches
of up to ``WIDE`` bytes are merged many at a time, one numpy row per match; longer ones one by
one over plain lists.

The stretches between two word ends (white space and the word after it) are independent of
each other, since no match runs from a word into white space, so their ids are remembered in a
table of at most ``REMEMBERED`` stretches per worker, emptied when full.

Defined cases: null texts are encoded as empty; an empty text has no ids and decodes to empty
bytes; texts are taken whole; strings of special tokens are ordinary text; further columns are
carried through; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapse.llm.names import quoted
from lapse.llm.words import ranges, slices

WIDE = 64
REMEMBERED = 300_000
#: Unicode White_Space, as the pattern's \s reads it
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
STRETCH = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")


def default_vocabulary() -> tuple[str, str]:
    """(path, pattern) of the public multi-language byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


class Bpe:
    """Merge ranks of one vocabulary, with the tables for encoding and decoding."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.size = max(self.ranks.values()) + 1
        self.pattern = regex.compile(pattern)
        token = [b""] * self.size
        for t, r in self.ranks.items():
            token[r] = t
        self.width = np.array([len(t) for t in token], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.width)[:-1]])
        self.bytes = np.frombuffer(b"".join(token), np.uint8)
        self.single = np.array([self.ranks[bytes([i])] for i in range(256)], np.int64)
        pair = {
            self.ranks[t[:i]] * self.size + self.ranks[t[i:]]: r
            for t, r in self.ranks.items() for i in range(1, len(t)) if t[:i] in self.ranks and t[i:] in self.ranks
        }
        self.pair = pair
        self.pair_key = np.array(sorted(pair), np.int64)
        self.pair_rank = np.array([pair[k] for k in self.pair_key.tolist()], np.int64)
        text = [f"{i},".encode() for i in range(self.size)]
        self.decimal_width = np.array([len(t) for t in text], np.int64)
        self.decimal = np.array([list(t.ljust(8, b" ")) for t in text], np.uint8)
        self.forget()

    def forget(self) -> None:
        self.code: dict[str, int] = {}
        self.flat = np.zeros(0, np.int32)
        self.edges = np.zeros(1, np.int64)

    # ---- merging -------------------------------------------------------------------
    def _rank_of(self, left: np.ndarray, right: np.ndarray, none: int) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_key, key), len(self.pair_key) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.pair_key[at] == key), self.pair_rank[at], none)

    def merge_rows(self, data: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Token ids (or -1) by position, for rows of bytes (rows x n, n a power of two)."""
        rows, n = data.shape
        bits = n.bit_length() - 1
        none = self.size  # a rank above all
        far = (none << bits) | (n - 1)
        place = np.arange(n)
        live = place < length[:, None]
        # one column more at the end: "no neighbour", always token -1
        token = np.full((rows, n + 1), -1, np.int64)
        token[:, :n][live] = self.single[data[live]]
        nxt = np.tile(np.minimum(np.arange(1, n + 2), n), (rows, 1))
        prv = np.tile(np.concatenate([[n], np.arange(n)]), (rows, 1))
        nxt[:, :n][place + 1 >= length[:, None]] = n
        tree = np.full((rows, 2 * n), far, np.int64)
        first = self._rank_of(token[:, :n], token[:, 1:], none)
        tree[:, n:] = np.where(first < none, (first << bits) | place, far)
        for low in (1 << k for k in range(bits - 1, -1, -1)):
            tree[:, low : 2 * low] = np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2])
        alive = np.flatnonzero(tree[:, 1] < far)
        while len(alive):
            root = tree[alive, 1]
            at, rank = root & (n - 1), root >> bits
            gone = nxt[alive, at]
            after = nxt[alive, gone]
            before = prv[alive, at]
            token[alive, at], token[alive, gone] = rank, -1
            token[alive, n] = -1
            nxt[alive, at], prv[alive, after] = after, at
            own = self._rank_of(rank, token[alive, after], none)
            back = self._rank_of(np.where(before < n, token[alive, before], -1), rank, none)
            leaves = (
                (gone, np.full(len(alive), far)),
                (at, np.where(own < none, (own << bits) | at, far)),
                (np.where(before < n, before, gone), np.where((before < n) & (back < none), (back << bits) | before, far)),
            )
            for leaf, key in leaves:
                node = leaf + n
                tree[alive, node] = key
                for _ in range(bits):
                    node = node >> 1
                    tree[alive, node] = np.minimum(tree[alive, 2 * node], tree[alive, 2 * node + 1])
            alive = alive[tree[alive, 1] < far]
        return token[:, :n]

    def merge_long(self, piece: bytes) -> list[int]:
        """Token ids of one match of any length: the same tree over plain lists."""
        n = 1 << max(0, (len(piece) - 1).bit_length())
        none, far = self.size, self.size * n + n
        token = [int(self.single[b]) for b in piece]
        nxt, prv = list(range(1, len(piece) + 1)), list(range(-1, len(piece) - 1))

        def key(i: int) -> int:
            if i < 0 or nxt[i] >= len(piece):
                return far
            rank = self.pair.get(token[i] * self.size + token[nxt[i]], none)
            return rank * n + i if rank < none else far

        tree = [far] * (2 * n)
        for i in range(len(piece)):
            tree[n + i] = key(i)
        for node in range(n - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] < far:
            rank, at = divmod(tree[1], n)
            gone = nxt[at]
            token[at], token[gone] = rank, -1
            nxt[at] = nxt[gone]
            if nxt[at] < len(piece):
                prv[nxt[at]] = at
            for leaf in (gone, at, prv[at]):
                if leaf < 0:
                    continue
                node = n + leaf
                tree[node] = far if leaf == gone else key(leaf)
                while node > 1:
                    node >>= 1
                    tree[node] = min(tree[2 * node], tree[2 * node + 1])
        return [t for t in token if t >= 0]

    def merge_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all matches, edges): a match that is itself in the vocabulary is one id."""
        size = np.array([len(p) for p in pieces], np.int64)
        begin = np.cumsum(size) - size
        data = np.frombuffer(b"".join(pieces), np.uint8)
        whole = np.array([self.ranks.get(p, -1) for p in pieces], np.int64)
        count = np.ones(len(pieces), np.int64)
        found = []  # (match, its ids) in blocks
        one = np.flatnonzero(whole >= 0)
        found.append((one, np.ones(len(one), np.int64), whole[one]))
        for i in np.flatnonzero((whole < 0) & (size > WIDE)).tolist():
            ids = self.merge_long(pieces[i])
            found.append((np.array([i]), np.array([len(ids)]), np.array(ids)))
        low = 1
        while low < WIDE:
            n = 2 * low
            members = np.flatnonzero((whole < 0) & (size > low) & (size <= n))
            step = max(1, (1 << 18) // n)
            for lo in range(0, len(members), step):
                part = members[lo : lo + step]
                grid = np.zeros((len(part), n), np.uint8)
                grid[np.arange(n) < size[part][:, None]] = data[ranges(begin[part], size[part])]
                token = self.merge_rows(grid, size[part])
                live = token >= 0
                found.append((part, live.sum(1), token[live]))
            low = n
        for part, n_ids, _ in found:
            count[part] = n_ids
        edges = np.concatenate([[0], np.cumsum(count)])
        out = np.zeros(edges[-1], np.int32)
        for part, n_ids, ids in found:
            out[ranges(edges[part], n_ids)] = ids
        return out, edges

    # ---- texts ---------------------------------------------------------------------
    def _learn(self, stretches: set[str]) -> None:
        split = [self.pattern.findall(u) for u in stretches]
        number = {p: i for i, p in enumerate(set().union(*split))}
        ids, edges = self.merge_all([p.encode() for p in number])
        at = np.array([number[p] for ps in split for p in ps], np.int64)
        n = edges[at + 1] - edges[at]
        ends = np.cumsum([len(ps) for ps in split])
        self.code.update(zip(stretches, range(len(self.code), len(self.code) + len(stretches))))
        self.flat = np.concatenate([self.flat, ids[ranges(edges[at], n)]])
        self.edges = np.concatenate([self.edges, self.edges[-1] + np.cumsum(n)[ends - 1]])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, edges: n + 1 offsets)."""
        units = [STRETCH.findall(t) if t else [] for t in texts]
        seen = set().union(*units)
        fresh = seen.difference(self.code)
        if len(self.code) + len(fresh) > REMEMBERED:
            self.forget()
            fresh = seen
        if fresh:
            self._learn(fresh)
        code = self.code
        codes = np.array([code[u] for us in units for u in us], np.int64)
        n_units = np.array([len(us) for us in units], np.int64)
        lo = self.edges[codes]
        n = self.edges[codes + 1] - lo if len(codes) else np.zeros(0, np.int64)
        ids = self.flat[ranges(lo, n)]
        total = np.concatenate([[0], np.cumsum(n)])
        return ids, total[np.concatenate([[0], np.cumsum(n_units)])]

    def decode(self, ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts, edges) of ids in ``[edges[i], edges[i + 1])``."""
        n = self.width[ids]
        total = np.concatenate([[0], np.cumsum(n)])
        return self.bytes[ranges(self.begin[ids], n)], total[edges]

    def decimals(self, ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(decimal ids, each followed by a comma, as bytes; edges)."""
        n = self.decimal_width[ids]
        total = np.concatenate([[0], np.cumsum(n)])
        return self.decimal[ids][np.arange(8) < n[:, None]], total[edges]


@functools.lru_cache(maxsize=2)
def load(path: str, pattern: str) -> Bpe:
    return Bpe(path, pattern)


def encode_text(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with the ids of the text as array<int> instead of the text."""
    path, pattern = vocabulary or default_vocabulary()
    rest = T.StructType([f for f in docs.schema.fields if f.name not in (text_col, ids_col)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for b in slices(batches):
            ids, edges = bpe.encode(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids))], names=["row", "ids"])

    src = docs.select(F.struct(*rest.names).alias("row") if rest.names else F.struct(F.lit(0).alias("_")).alias("row"),
                      F.col(text_col).cast("string").alias("text"))
    row_type = rest if rest.names else T.StructType([T.StructField("_", T.IntegerType())])
    out = src.mapInArrow(run, T.StructType([T.StructField("row", row_type), T.StructField("ids", T.ArrayType(T.IntegerType()))]))
    return out.select(*[F.col("row")[c].alias(c) for c in rest.names], F.col("ids").alias(ids_col))


def decode_ids(df: DataFrame, ids_col: str = "ids", text_col: str = "text", vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """``df`` with the decoded bytes (binary) instead of the ids; a null array decodes to empty bytes."""
    path, pattern = vocabulary or default_vocabulary()
    rest = [f for f in df.schema.fields if f.name not in (text_col, ids_col)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for b in batches:
            lists = b.column("ids")
            values, edges = _flat(lists)
            data, to = bpe.decode(values, edges)
            yield pa.RecordBatch.from_arrays([b.column("row"), _binary(data, to)], names=["row", "text"])

    row_type = T.StructType([T.StructField("_", T.IntegerType()), *rest])
    src = df.select(F.struct(F.lit(0).alias("_"), *[f.name for f in rest]).alias("row"),
                    F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    out = src.mapInArrow(run, T.StructType([T.StructField("row", row_type), T.StructField("text", T.BinaryType())]))
    return out.select(*[F.col("row")[f.name].alias(f.name) for f in rest], F.col("text").alias(text_col))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    edges = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False)[edges[0] : edges[-1]]
    return values, edges - edges[0]


def _binary(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    ).cast(pa.binary())


def round_trip_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encodes, then decodes the ids, per row."""
    path, pattern = vocabulary or default_vocabulary()

    def digests(data: np.ndarray, edges: np.ndarray, less: int = 0) -> list[str]:
        view = memoryview(np.ascontiguousarray(data))
        return [hashlib.sha256(view[a : max(a, z - less)]).hexdigest() for a, z in zip(edges[:-1].tolist(), edges[1:].tolist())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for b in slices(batches):
            ids, edges = bpe.encode(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.diff(edges)), pa.array(digests(*bpe.decimals(ids, edges), less=1), pa.string()),
                 pa.array(digests(*bpe.decode(ids, edges)), pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_checked(docs: DataFrame, text_col: str = "text", vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and ``decoded_sha256`` instead of the text; the ids are
    decoded at once, and a text that they do not give back stops the job."""
    path, pattern = vocabulary or default_vocabulary()
    rest = [f for f in docs.schema.fields if f.name not in (text_col, "ids", "n_tokens", "decoded_sha256")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, pattern)
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            ids, edges = bpe.encode(texts)
            data, to = bpe.decode(ids, edges)
            parts = [data[a:z].tobytes() for a, z in zip(to[:-1].tolist(), to[1:].tolist())]
            if any(p != (t or "").encode() for p, t in zip(parts, texts)):
                raise ValueError("decoded ids differ from the text")
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids)), pa.array(np.diff(edges)),
                 pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string())],
                names=["row", "ids", "n_tokens", "decoded_sha256"])

    row = T.StructType([T.StructField("_", T.IntegerType()), *rest])
    schema = T.StructType([T.StructField("row", row), T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.LongType()), T.StructField("decoded_sha256", T.StringType())])
    src = docs.select(F.struct(F.lit(0).alias("_"), *[quoted(f.name) for f in rest]).alias("row"), quoted(text_col).cast("string").alias("text"))
    out = src.mapInArrow(run, schema)
    return out.select(*[F.col("row")[f.name].alias(f.name) for f in rest], "ids", "n_tokens", "decoded_sha256")
