import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from lapse.llm import trie
from lapse.llm.queries import QUERIES, SQL
from tests.llm.conftest import SF001, WORD

CONV = "conv_id long, turn long, role string, text string"
COLS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def built(rows):
    """conversation -> rebuilt turns."""
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((t is not None, t, role, tie, text))
    turns = {c: [(r, x) for _, _, r, _, x in sorted(v, key=lambda y: (y[0], y[1] or 0, y[2], y[3]))] for c, v in own.items()}
    out = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        donor = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        out[c] = turns.get(donor, [])[:h] + mine[h:]
    return out


def brute(rows):
    members = defaultdict(list)
    for c, turns in built(rows).items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append((c, len(turns) == d))
    kids = defaultdict(list)
    for seq in members:
        if seq:
            kids[seq[:-1]].append(seq)

    def sums(seq):
        words = len(WORD.findall(seq[-1][1])) if seq else 0
        own = (len(members[seq]) - 1) * words
        below = [sums(k) for k in kids[seq]]
        return (sum(b[0] for b in below) or not below and 1), own + sum(b[1] for b in below)

    out = []
    for seq, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, e in m if e))
        leaves, saved = sums(seq)
        out.append((min(c for c, _ in m), len(seq), min(c for c, _ in members[seq[:-1]]) if seq else None, len(m), len(kids[seq]),
                    int(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select(*COLS).collect())


def table(spark, rows):
    return spark.createDataFrame(rows, CONV)


def test_equals_brute_force_and_sql(spark):
    df = spark.read.parquet(f"{SF001}/conversations.parquet")
    want = brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert got(QUERIES["op12_trie"](spark, SF001)) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF001}/conversations.parquet')")
    assert sorted(con.sql(SQL["op12_trie"]).project(", ".join(COLS)).fetchall()) == want


def crowd():
    """Shared first turns, a third of all rows in one conversation, copies, turnless and odd rows."""
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"say {t if t < 2 else (c * 7 + t) % 5} now") for c in range(-30, 90) for t in range(c % 5 + 1)]
    rows += [(1000, t, "user", f"long {t % 3}") for t in range(250)]
    rows += [(2000 + c, t, "user", "copy of all") for c in range(40) for t in range(3)]
    rows += [(500, None, None, None), (500, 1, None, "x"), (500, 1, "user", None), (500, 1, "user", None), (None, 1, "user", "lost"),
             (501, 0, "user", ""), (503, 7, "", "é😀 \x00 a\tb" * 2000), (503, 7, "", "é😀")]
    return rows


@pytest.mark.parametrize("base", [16, 100_000])
def test_hot_and_odd_rows(spark, base):
    rows = crowd()
    turns = trie.ordered_turns(table(spark, rows))
    out = trie.trie(trie.rebuilt(turns), turns.select("conv").distinct(), rank_base=base)
    assert got(out) == brute(rows)


def test_clashing_columns_and_empty_table(spark):
    rows = crowd()[:60]
    more = table(spark, rows).withColumns({"conv": F.lit(3), "pos": F.lit("p"), "digest": F.lit(None), "g": F.lit(1), "a.b": F.lit(0)})
    assert got(trie.conversation_trie(more)) == brute(rows)
    assert trie.conversation_trie(table(spark, [])).collect() == []


def test_all_conversations_lose_their_turns(spark):
    """Only conversations of fewer turns than h, donors included: one node, the root."""
    ids = [c for c in range(1, 400) if c % 20 and zlib.crc32(str(c).encode()) % 4 >= 1][:5]
    rows = [(c, 0, "user", "gone") for c in ids]
    out = got(trie.conversation_trie(table(spark, rows)))
    assert out == brute(rows) and len(out) == 1 and out[0][3] == 5


def test_word_pattern_is_the_contracts():
    assert re.fullmatch(r"\[\^\\x20\\x09-\\x0D\]\+", trie.WORD)
