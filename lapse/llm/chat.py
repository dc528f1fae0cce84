"""Operator 8: chat formatting with offset-aligned loss masks.

A conversation is rendered whole: ``<|turn|>role<|text|>text<|end|>`` for every turn.  Inside roles and
texts a backslash is doubled and ``<|`` becomes ``<\\|``, so no control string can occur there and
unescaping restores them.  The rendered string is encoded once, with the character offsets of
every token; the control strings are tokens of their own.  The spans of the turns to learn are
sorted, as the tokens are, and two binary searches per span find the tokens that meet it.

Defined cases: a null text or role is empty; turns are ordered by turn, equal turns by role and
text, a null turn comes first; repeated rows are turns of their own; rows with a null
conv_id form one conversation; a conversation of no learnt role has an empty mask; an empty table
gives no conversations; further columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNT = "assistant"


def escape(s: str) -> str:
    return s.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(s: str) -> str:
    return re.sub(r"\\(.)", r"\1", s, flags=re.S)


def render(turns: list[tuple[str, str]], learnt: str = LEARNT) -> tuple[str, list[tuple[int, int]]]:
    """(formatted text, sorted character spans of the learnt texts)."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        parts += [head, body, END]
        at += len(head)
        if role == learnt:
            spans.append((at, at + len(body)))
        at += len(body) + len(END)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    out = []
    for part in formatted.split(TURN)[1:]:
        role, _, text = part.partition(TEXT)
        out.append((unescape(role), unescape(text.removesuffix(END))))
    return out


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer, processors

    t = Tokenizer.from_file(path)
    t.post_processor = processors.ByteLevel(trim_offsets=False)  # offsets keep leading spaces
    t.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in (TURN, TEXT, END)])
    return t


def mask_of(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Tokens that meet a span; offsets are (tokens x 2) and ascend, spans are sorted and disjoint."""
    mask = np.zeros(len(offsets), bool)
    if len(offsets) and spans:
        begin, end = np.array(spans, np.int64).T
        first = np.searchsorted(offsets[:, 1], begin, side="right")
        last = np.searchsorted(offsets[:, 0], end, side="left")
        for a, z in zip(first.tolist(), last.tolist()):
            mask[a:z] = True
    return mask


def masked_text(formatted: str, offsets: np.ndarray, mask: np.ndarray) -> str:
    """The text under the mask, unescaped: the union of the masked tokens' spans, in order."""
    spans: list[list[int]] = []
    for a, z in offsets[mask].tolist():
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], z)
        else:
            spans.append([a, z])
    return "".join(unescape(formatted[a:z]) for a, z in spans)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def grouped(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): one row per conversation, its turns in order.  A conversation is one
    training example and is held whole by its task; nothing larger is."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def format_chats(conversations: DataFrame, learnt: str = LEARNT, vocabulary: str | None = None) -> DataFrame:
    """(conv_id, formatted, ids, offsets, loss): offsets holds begin and end of each token in turn
    (code points of ``formatted``), loss is 1 for the tokens to learn."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        for whole in batches:
            for lo in range(0, whole.num_rows, 64):
                b = whole.slice(lo, 64)
                made = [render([(t["role"], t["text"]) for t in turns], learnt) for turns in b.column("turns").to_pylist()]
                out: list[list] = [[], [], []]
                for (text, spans), enc in zip(made, tok.encode_batch([m[0] for m in made], add_special_tokens=False)):
                    offsets = np.array(enc.offsets, np.int64).reshape(-1, 2)
                    out[0].append(np.array(enc.ids, np.int32))
                    out[1].append(offsets.reshape(-1).astype(np.int32))
                    out[2].append(mask_of(offsets, spans).astype(np.int8))
                yield pa.RecordBatch.from_arrays(
                    [b.column("conv_id"), pa.array([m[0] for m in made], pa.string()), pa.array(out[0], pa.list_(pa.int32())),
                     pa.array(out[1], pa.list_(pa.int32())), pa.array(out[2], pa.list_(pa.int8()))],
                    names=["conv_id", "formatted", "ids", "offsets", "loss"])

    return grouped(conversations).mapInArrow(
        run, "conv_id long, formatted string, ids array<int>, offsets array<int>, loss array<tinyint>")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from what
    ``format_chats`` returned."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                text = b.column("formatted")[i].as_py()
                turns = parse(text)
                offsets = b.column("offsets")[i].values.to_numpy(zero_copy_only=False).reshape(-1, 2)
                loss = masked_text(text, offsets, b.column("loss")[i].values.to_numpy(zero_copy_only=False).astype(bool))
                rows.append((b.column("conv_id")[i].as_py(), len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)),
                             len(loss), sha(loss), len(text)))
            if rows:
                names = [x.split()[0] for x in schema.split(", ")]
                kinds = [pa.string() if x.endswith("string") else pa.int64() for x in schema.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return formatted.select("conv_id", "formatted", "offsets", "loss").mapInArrow(run, schema)
