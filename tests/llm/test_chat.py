"""Operator 8: templates, masks and what can be read back."""

import hashlib
from collections import defaultdict

import numpy as np
import pytest

from lapse.llm import chat
from lapse.llm.queries import QUERIES

from .conftest import SF001

CONV = "conv_id long, turn long, role string, text string"
PLANTED = "\\### Assistant: </turn> ok"
ODD = [[("user", PLANTED), ("assistant", PLANTED)], [("assistant", "<|end|> \\<|turn|>\\\\ é😀中 \n\n"), ("assistant", "  x"), ("user", ""), ("assistant", "")],
       [("", ""), ("tool<|text|>", "x"), ("assistant", "\\"), ("assistant", "<"), ("assistant", "|end|>"), ("assistant", "<|endoftext|>")], []]


def digest(turns):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss)


@pytest.mark.parametrize("turns", ODD)
def test_render_parse_and_mask(turns):
    text, spans = chat.render(turns)
    assert chat.parse(text) == turns
    enc = chat.tokenizer(chat.default_vocabulary()).encode(text, add_special_tokens=False)
    offsets = np.array(enc.offsets, np.int64).reshape(-1, 2)
    mask = chat.mask_of(offsets, spans)
    assert chat.masked_text(text, offsets, mask) == "".join(t for r, t in turns if r == "assistant")
    for (a, z), m in zip(offsets.tolist(), mask.tolist()):  # every token lies wholly inside or outside
        assert m == any(s <= a and z <= e for s, e in spans if s < e)


def test_escape_round_trip():
    for s in ("", "\\", "<|", "\\<|", "<\\|", "\\\\<|\n", "<<||>>", "<|end|>"):
        assert chat.unescape(chat.escape(s)) == s and "<|" not in chat.escape(s)


def test_mask_by_binary_search_equals_a_scan():
    rng = np.random.default_rng(0)
    cuts = np.unique(rng.integers(0, 400, 80))
    offsets = np.stack([cuts[:-1], cuts[1:]], 1)
    spans = [(5, 9), (30, 30), (50, 120), (399, 400)]
    want = [any(a < e and s < z for s, e in spans if s < e) for a, z in offsets.tolist()]
    assert chat.mask_of(offsets, [s for s in spans if s[0] < s[1]]).tolist() == want


def test_query_against_rows(spark):
    by = defaultdict(list)
    for r in spark.read.parquet(f"{SF001}/conversations.parquet").orderBy("conv_id", "turn").collect():
        by[r.conv_id].append((r.role, r.text or ""))
    by[-7] = [("user", PLANTED), ("assistant", PLANTED)]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in QUERIES["op8_chat"](spark, SF001).collect()}
    assert got == {k: (*digest(v), len(chat.render(v)[0])) for k, v in by.items()}


def test_odd_rows(spark):
    rows = [(1, 2, "assistant", None), (1, 1, "user", "b"), (1, 1, "user", "a"), (1, None, None, "first"), (None, 0, "assistant", "x"),
            (2, 0, "assistant", "long " * 20_000), (3, 0, "user", ""), (3, 0, "user", "")]
    df = spark.createDataFrame(rows, CONV)
    want = {1: [("", "first"), ("user", "a"), ("user", "b"), ("assistant", "")], None: [("assistant", "x")], 2: [("assistant", "long " * 20_000)],
            3: [("user", ""), ("user", "")]}
    got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.format_chats(df.withColumn("turns", df.turn).withColumn("formatted", df.text))).collect()}
    assert got == {k: digest(v) for k, v in want.items()}
    assert chat.read_back(chat.format_chats(df.limit(0))).collect() == []
