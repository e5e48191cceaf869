"""The burst trie against a dictionary of all prefixes."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from dimstack.llm import queries, trie

TURNS = "conv_id long, turn long, role string, text string, depth int, unit string"


def sha(ids):
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def brute_trie(convs):
    """``{conv_id: [(role, text)]}`` -> sorted rows."""
    low = lambda ids: min((c for c in ids if c is not None), default=None)
    nodes, kids = {}, {}
    for c, said in convs.items():
        for d in range(len(said) + 1):
            nodes.setdefault(tuple(said[:d]), []).append(c)
    for k in nodes:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    total = {}
    for k in sorted(nodes, key=len, reverse=True):
        own = (len(nodes[k]) - 1) * (len(k[-1][1].encode()) if k else 0)
        below = [total[x] for x in kids.get(k, [])]
        total[k] = (sum(x for x, _ in below) or 1, own + sum(y for _, y in below))
    return sorted(((low(ids), len(k), low(nodes[k[:-1]]) if k else None, len(ids), len(kids.get(k, [])), *total[k],
                    sha(sorted(c for c in ids if len(convs[c]) == len(k) and c is not None)))
                   for k, ids in nodes.items()), key=str)


def said_by(rows):
    convs = {}
    for c, turn, role, text, *_ in rows:
        convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in convs.items()}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    out = []
    for c in range(120):
        turn = 0
        for _ in range(rng.randint(1, 6)):
            out.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["é", "bb", "ccc"]), 1, "x"))
            turn += 1
    # a hot conversation, its beginnings, and long ones that differ at the end
    hot = [(k, "user", f"turn {k}") for k in range(12)]
    for c in range(200, 260):
        out += [(c, k, r, t, 1, "x") for k, r, t in hot[: 12 if c < 240 else c - 240]]
        out.append((c, 50, None if c % 7 else "user", None if c < 230 else f"end {c}", 1, "x"))
    return out + [(None, 0, "user", "bb", 1, "x"), (None, None, "user", "é", 1, "x"),
                  (500, 3, "user", "a:b", 1, "x"), (501, 3, "use", "ra:b", 1, "x")]


@pytest.mark.parametrize("container,piece", [(4096, 1000), (16, 7)])
def test_trie(spark, rows, monkeypatch, container, piece):
    monkeypatch.setattr(trie, "PIECE", piece)
    got = trie.conversation_trie(spark.createDataFrame(rows, TURNS), container)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_bytes",
                           "ends_sha256"]
    assert rows_of(got) == brute_trie(said_by(rows))


def test_empty_table(spark):
    assert trie.conversation_trie(spark.createDataFrame([], TURNS)).collect() == []


def test_turnless_conversations_end_at_the_root(spark):
    units = spark.createDataFrame([(2, 0, None), (1, 0, None)], "conv_id long, order int, unit string")
    assert rows_of(trie.build_trie(units)) == [(1, 0, None, 2, 0, 1, 0, sha([1, 2]))]


def test_shared_starts(spark, rows):
    conv = F.col("conv_id")
    units = trie.turn_units(spark.createDataFrame(rows, TURNS))
    rebuilt = trie.with_shared_starts(units, conv - conv % 5, (F.crc32(conv.cast("string")) % 9).cast("int"))
    convs = said_by(rows)
    want = {}
    for c, said in convs.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 9
        want[c] = (convs.get(c - c % 5, []) if c is not None else [])[:h] + said[h:]
    assert rows_of(trie.build_trie(rebuilt, container=16)) == brute_trie(want)

