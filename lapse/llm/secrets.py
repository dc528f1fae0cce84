"""Operator 13: secrets by fixed patterns and by automata inferred from labelled credentials.

Base spans are the matches of three fixed patterns.  Their values are the labelled credentials.  The distinct ones of
each kind, and the distinct ordinary candidates, are all read into one probabilistic automaton per kind, by merging the
states of their prefix tree (``grammar``), in rounds: every value is walked through the states settled so far, what
goes on from them is counted as a tree by Spark, and one task per kind merges the tree's nodes that hold at least one in
``grammar.RESOLUTION`` of the values that went on.  Rounds end when every value is read to its end, so that all have
their part in the counts.  Every candidate of every text - a run of credential
characters, 8 or more - is then scored by the log-likelihood under the best credential automaton less that under the
automaton of ordinary candidates.  A candidate outside the base spans whose score passes a threshold, the exact
``QUANTILE`` of all ordinary candidates, each under the counts of the others, and ``MIN_SCORE`` at least, is a
span ``like_<kind>``.  Ordinary candidates that score like the labelled values of their kind (above their lower quartile,
``LIKE``) are unlabelled credentials; they do not raise the threshold above themselves.  Base spans always stay.

No values are sampled or cut.  Automata and the trees of a round are bounded by the resolution of the merge test, not by the
number of values (some tens of states, in practice).

Defined cases: a null text is empty and has no spans; a kind of fewer than ``MIN_LABELS`` labels
has no automaton, without any there are no added spans; equal scores take the kind listed first; repeated rows each
have their spans; very long texts and runs are scanned whole; further columns are carried (one named like
the result is replaced); an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapse.llm import grammar
from lapse.llm.runs import Runs, byte_runs, raw_bytes
from lapse.llm.words import slices
from lapse.sources.store import materialize

MIN_LABELS = 20
QUANTILE = 0.999
MIN_SCORE = 10.0
LIKE = 0.25
DEPTH = 32  # levels of a round's tree
BINS = 1000

KINDS = ("assign", "access", "hex")
ORDINARY = "ordinary"
LISTED = (*KINDS, *[f"like_{k}" for k in KINDS])

# ---- fixed values: the base patterns --------------------------------------------------------------
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_VALUE, ACCESS_MATCH, HEX_MATCH, CANDIDATE = 8, 16, 32, 8
# ---------------------------------------------------------------------------------------------------
_STEMS = (b"pass", b"secret", b"token", b"api")  # one of them is in every assign match
_HEX = np.zeros(256, bool)
_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True
_CANDIDATE = np.zeros(256, bool)
_CANDIDATE[np.frombuffer(grammar.SYMBOLS, np.uint8)] = True


def _texts_with(body: bytes, offsets: np.ndarray, needles: tuple[bytes, ...]) -> list[int]:
    """Texts that hold one of the needles."""
    hits = [m.start() for x in needles for m in re.finditer(re.escape(x), body)]
    return np.unique(np.searchsorted(offsets, hits, side="right") - 1).tolist() if hits else []


def base_spans(texts: pa.Array) -> dict[str, np.ndarray]:
    """kind -> (span, column): text, first byte, end, first and end byte of the value, within all texts' bytes."""
    data, off = raw_bytes(texts)
    body = data.tobytes()
    rows: dict[str, list] = {k: [] for k in KINDS}
    for i in _texts_with(body.lower(), off, _STEMS):
        for m in ASSIGN.finditer(body, off[i], off[i + 1]):
            if m.end(2) - m.start(2) >= ASSIGN_VALUE:
                rows["assign"].append((i, m.start(), m.end(), m.start(2), m.end(2)))
    for i in _texts_with(body, off, (b"AKIA",)):
        for m in ACCESS.finditer(body, off[i], off[i + 1]):
            if m.end() - m.start() >= ACCESS_MATCH:
                rows["access"].append((i, m.start(), m.end(), m.start(), m.end()))
    out = {k: np.array(v, np.int64).reshape(-1, 5) for k, v in rows.items()}
    r = byte_runs(texts, _HEX, HEX_MATCH)
    out["hex"] = np.stack([r.text, r.start, r.end, r.start, r.end], axis=1).astype(np.int64)
    return out


def candidates(texts: pa.Array, base: dict[str, np.ndarray]) -> Runs:
    """Runs of credential characters that meet no base span."""
    r = byte_runs(texts, _CANDIDATE, CANDIDATE)
    taken = np.zeros(len(r.data) + 1, np.int64)
    for spans in base.values():
        np.add.at(taken, spans[:, 1], 1)
        np.add.at(taken, spans[:, 2], -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(taken)[:-1] > 0)])
    free = covered[r.end] == covered[r.start]
    return Runs(r.data, r.offsets, r.start[free], r.end[free], r.text[free])


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice: the distinct values of each kind (kind, value)."""
    for batch in slices(batches, "text"):
        texts = batch.column("text")
        base = base_spans(texts)
        c = candidates(texts, base)
        ranges = {k: (s[:, 3], s[:, 4]) for k, s in base.items()} | {ORDINARY: (c.start, c.end)}
        for kind, (start, end) in ranges.items():
            values = Runs(c.data, c.offsets, start, end, c.text).values().unique()
            yield pa.RecordBatch.from_arrays([pa.array([kind] * len(values), pa.string()), values.cast(pa.binary())], ["kind", "value"])


def labelled_values(docs: DataFrame) -> DataFrame:
    """(kind, value): all distinct values of each kind."""
    return materialize(docs.select("text").mapInArrow(_labelled, "kind string, value binary").distinct(), "secret-labels")


def labelled_sample(docs: DataFrame, sample: int) -> DataFrame:
    """(kind, value): ``sample`` distinct values per kind at most, those of the smallest hashes, to look at; the fit
    takes all."""
    found = labelled_values(docs)
    least = [found.filter(F.col("kind") == k).orderBy(F.xxhash64("value"), "value").limit(sample) for k in (*KINDS, ORDINARY)]
    return reduce(DataFrame.unionAll, least)


def _cells(to: dict[str, np.ndarray]):
    """Per batch: how often each state of each kind is left by each symbol, the end included (kind, cell, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, values in _by_kind(batches, to):
            data, off = raw_bytes(values)
            states, steps = grammar.walk(to[kind], data, off[:-1], off[1:])
            n = np.bincount(grammar.symbols_after(states, steps, data, off[:-1], off[1:]) + states * (grammar.END + 1))
            cell = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(cell), pa.string()), pa.array(cell, pa.int64()), pa.array(n[cell], pa.int64())], ["kind", "cell", "n"])

    return run


def _leaving(to: dict[str, np.ndarray]):
    """Per batch: the values that come to a symbol their state does not follow (kind, at, tail): state and symbol as one
    number, and the bytes after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, values in _by_kind(batches, to):
            data, off = raw_bytes(values)
            states, steps = grammar.walk(to[kind], data, off[:-1], off[1:])
            left = np.flatnonzero(steps < off[1:] - off[:-1])
            at = off[left] + steps[left]
            number = states[np.cumsum(steps + 1) - 1][left] * grammar.END + grammar.CODE[data[at]]
            tail = Runs(data, off, at + 1, np.minimum(off[left + 1], at + 2 + DEPTH), left).values()
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(left), pa.string()), pa.array(number, pa.int64()), tail.cast(pa.binary())], ["kind", "at", "tail"])

    return run


def _by_kind(batches: Iterator[pa.RecordBatch], kinds) -> Iterator[tuple[str, pa.Array]]:
    for batch in slices(batches, "value"):
        for kind in kinds:
            values = batch.column("value").filter(pc.equal(batch.column("kind"), kind))
            if len(values):
                yield kind, values


def _count(values: DataFrame, to: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Counts of every kind's states by symbol and end, over all values; a row per cell in use is read back."""
    times = {k: np.zeros((len(t), grammar.END + 1), np.int64) for k, t in to.items()}
    for r in values.mapInArrow(_cells(to), "kind string, cell long, n long").groupBy("kind", "cell").agg(F.sum("n").alias("n")).collect():
        times[r.kind].reshape(-1)[r.cell] = r.n
    return times


def _grow(values: DataFrame, to: dict[str, np.ndarray], times: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Next states of the kinds with values that leave their automaton, after the tree of what follows is merged into it."""
    left = {k: int(times[k][:, :-1][to[k] < 0].sum()) for k in to}
    left = {k: n for k, n in left.items() if n}
    tails = values.filter(F.col("kind").isin(list(left))).mapInArrow(_leaving({k: to[k] for k in left}), "kind string, at long, tail binary")
    tails = tails.withColumn("depth", F.explode(F.sequence(F.lit(0), F.least(F.length("tail"), F.lit(DEPTH)))))
    node = ["kind", "at", F.expr("substring(tail, 1, depth)").alias("path")]
    cells = tails.groupBy(*node, F.expr("substring(tail, depth + 1, 1)").alias("symbol")).agg(F.count(F.lit(1)).alias("n"))
    # nodes of the settled states' own symbols always, those below them from one in RESOLUTION on
    floor = F.create_map(*[F.lit(x) for k, n in left.items() for x in (k, n)])
    nodes = cells.groupBy("kind", "at", "path").agg(F.sum("n").alias("visits"), F.collect_list("symbol").alias("symbols"),
                                                   F.collect_list("n").alias("ns"))
    nodes = nodes.filter((F.length("path") == 0) | (F.col("visits") * grammar.RESOLUTION >= floor[F.col("kind")]))

    def merge(key, table):
        kind = key[0].as_py()
        tree = [(at, path, {int(grammar.CODE[s[0]]) if s else grammar.END: n for s, n in zip(symbols, ns)}) for at, path, symbols, ns in zip(
            *[table[c].to_pylist() for c in ("at", "path", "symbols", "ns")])]
        after = grammar.resume(times[kind], to[kind], tree)
        return pa.table({"kind": [kind] * len(after), "state": pa.array(range(len(after)), pa.int32()),
                         "next": pa.array(after.tolist(), pa.list_(pa.int32()))})

    rows = nodes.select("kind", "at", "path", "symbols", "ns").groupBy("kind").applyInArrow(
        merge, "kind string, state int, next array<int>").orderBy("kind", "state").collect()
    return {k: np.array([r.next for r in rows if r.kind == k], np.int64) for k in left}


def fit_automata(values: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per kind of ``MIN_LABELS`` values or more: (counts by state and symbol, next states) over all values."""
    to = {r.kind: np.full((1, grammar.END), -1, np.int64) for r in values.groupBy("kind").count().collect() if r["count"] >= MIN_LABELS}
    done: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    while to:
        times = _count(values, to)
        for kind in [k for k in to if not times[k][:, :-1][to[k] < 0].any()]:
            done[kind] = times[kind], to.pop(kind)
        if to:
            to |= _grow(values, to, times)
    return done


def scores(automata: dict, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(score, number of the best kind) of byte ranges."""
    kinds = [k for k in KINDS if k in automata]
    by_kind = np.stack([grammar.log_likelihood(automata[k], data, start, end) for k in kinds])
    plain = grammar.log_likelihood(automata[ORDINARY], data, start, end)
    best = by_kind.argmax(axis=0)
    return by_kind[best, np.arange(len(start))] - plain, np.array([KINDS.index(k) for k in kinds])[best]


def _score_values(automata: dict, counts: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kind, values in _by_kind(batches, counts):
            data, off = raw_bytes(values)
            ranges = data, off[:-1], off[1:]
            plain, own = grammar.log_likelihood(automata[ORDINARY], *ranges), grammar.left_out_likelihood(*counts[kind], *ranges)
            if kind == ORDINARY:
                score, best = scores(automata, *ranges)
                score, like = score + plain - own, np.array(KINDS)[best]
            else:
                score, like = own - plain, np.full(len(values), kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array([kind] * len(values), pa.string()), pa.array(like, pa.string()), pa.array(score)], ["kind", "like", "score"])

    return run


def value_scores(values: DataFrame, automata: dict, counts: dict) -> DataFrame:
    """(kind, like, score) of every value, under the counts of the others; ``like`` is the credential kind it is scored by."""
    return values.mapInArrow(_score_values(automata, counts), "kind string, like string, score double")


def quantile(rows: DataFrame, column: str, q: float) -> float | None:
    """The exact quantile of a column (interpolated between ranks), by counts in ever narrower bins."""
    low, high, n = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n:
        return None

    def ranked(rank: int) -> float:
        a, z, below = low, high, 0
        x = F.col(column)
        while a < z:
            inside = rows.filter((x >= a) & (x <= z))
            bins = inside.groupBy(F.least(F.floor((x - a) / (z - a) * BINS), F.lit(BINS - 1)).alias("bin")).agg(
                F.count(F.lit(1)).alias("n"), F.min(x).alias("a"), F.max(x).alias("z")).orderBy("bin").collect()
            for b in bins:
                if below + b.n > rank:
                    a, z = b.a, b.z
                    break
                below += b.n
        return a

    place = (n - 1) * q
    lower = ranked(int(place))
    return lower if place == int(place) else lower + (ranked(int(place) + 1) - lower) * (place - int(place))


def fit(docs: DataFrame, text_col: str = "text") -> tuple[dict, float]:
    """(automata, threshold) of a corpus, from all its values; no automata if there are too few labels or ordinary
    candidates."""
    values = labelled_values(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")))
    counts = fit_automata(values)
    if ORDINARY not in counts or len(counts) < 2:
        return {}, MIN_SCORE
    automata = {k: grammar.tables(*c) for k, c in counts.items()}
    scored = materialize(value_scores(values, automata, counts), "secret-scores")
    of = lambda k: scored.filter(F.col("kind") == k)
    below = [(F.col("like") == k) & (F.col("score") < quantile(of(k), "score", LIKE)) for k in KINDS if k in automata]
    top = quantile(of(ORDINARY).filter(reduce(lambda x, y: x | y, below)), "score", QUANTILE)
    return automata, max(MIN_SCORE, top if top is not None else MIN_SCORE)


def _find(automata: dict, threshold: float):
    """Per batch: the other columns and the spans of ``_text``."""

    def spans_of(texts: pa.Array) -> pa.Array:
        base = base_spans(texts)
        data, off = raw_bytes(texts)
        rows = [np.column_stack([s[:, :3], np.full(len(s), KINDS.index(k))]) for k, s in base.items()]
        score = [np.full(len(r), np.nan) for r in rows]
        if automata:
            c = candidates(texts, base)
            values = c.values().dictionary_encode()
            body, at = raw_bytes(values.dictionary)
            s, kind = scores(automata, body, at[:-1], at[1:])
            which = values.indices.to_numpy()
            over = s[which] > threshold
            which = which[over]
            rows.append(np.column_stack([c.text[over], c.start[over], c.end[over], kind[which] + len(KINDS)]))
            score.append(s[which])
        found, score = np.concatenate(rows), np.concatenate(score)
        order = np.lexsort((found[:, 3], found[:, 1], found[:, 0]))
        found, score = found[order], score[order]
        # bytes to code points
        before = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        place = lambda x: before[x] - before[off[found[:, 0]]]
        each = pa.StructArray.from_arrays([
            pa.array(np.array(LISTED)[found[:, 3]], pa.string()), pa.array(place(found[:, 1]), pa.int64()),
            pa.array(place(found[:, 2]), pa.int64()), pa.array(score, pa.float64(), from_pandas=True)], ["kind", "start", "end", "score"])
        edge = np.searchsorted(found[:, 0], np.arange(len(off)))
        return pa.ListArray.from_arrays(pa.array(edge, pa.int32()), each)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            spans = spans_of(batch.column("_text"))
            kept = [i for i, n in enumerate(batch.schema.names) if n != "_text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], spans], names=[*[batch.schema.names[i] for i in kept], "_spans"])

    return run


_SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("score", T.DoubleType())]))


def find_secrets(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, out: str = "secrets",
                 model: tuple[dict, float] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all) and ``out``: array of (kind, start, end, score), by start,
    then kind, in code points, end exclusive; base spans have no score.  ``model`` as ``fit`` gives it."""
    automata, threshold = model if model is not None else fit(docs, text_col)
    carry = [c for c in (docs.columns if carry is None else carry) if c != out]
    named = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)]
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("_text"), *named)
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in rows.schema.fields[1:]], T.StructField("_spans", _SPANS)])
    found = rows.mapInArrow(_find(automata, threshold), schema)
    return found.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], F.col("_spans").alias(out))


def scan_digest(docs: DataFrame, model: tuple[dict, float] | None = None) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    found = find_secrets(docs, carry=["doc_id"], model=model)
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(joined(of(*KINDS)), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"))
