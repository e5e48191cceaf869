"""Suffix-array dedup against windows counted in plain Python."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from dimstack.llm import queries, suffix_dedup as sd

SF = "/root/testdata/sf0.001"


def brute(texts, n=400):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + n] for r in raws for i in range(len(r) - n + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, bool)
        for i in range(len(r) - n + 1):
            if seen[r[i:i + n]] > 1:
                gone[i:i + n] = True
        left = bytes(b for b, g in zip(r, gone) if not g)
        spans = int((gone[1:] > gone[:-1]).sum() + gone[0])
        out.append((len(r), len(r) - len(left), spans, hashlib.sha256(left).hexdigest()))
    return out


def test_classes_and_prefixes():
    rng = random.Random(4)
    base = bytes(rng.choice(b"ab") for _ in range(300))
    for buf in (base * 3 + b"x" + base[5:] * 2, b"a" * 900, bytes(rng.choice(b"abcd") for _ in range(2000)), b"abc" * 400):
        got = sd.window_classes(np.frombuffer(buf, np.uint8), 40)
        want = {}
        pairs = {(int(c), buf[i:i + 40]) for i, c in enumerate(got) if i + 40 <= len(buf)}
        assert len({c for c, _ in pairs}) == len(pairs) == len({w for _, w in pairs}), want
        order, same, words = sd.suffix_array(np.frombuffer(buf, np.uint8), 64)
        lcp = sd.common_prefixes(words, order, same, 64)
        for r in np.flatnonzero(same)[:400]:
            a, b = buf[order[r - 1]:], buf[order[r]:]
            k = next((k for k in range(64) if a[k:k + 1] != b[k:k + 1] or not a[k:k + 1]), 64)
            assert lcp[r] == k or order[r] + 72 > len(buf) or order[r - 1] + 72 > len(buf)


def test_equal_windows_have_equal_anchors():
    rng = random.Random(9)
    one = bytes(rng.choice(b"abc ") for _ in range(900))
    at = {}
    for raw in (one, b"zz" + one[100:] + b"qq", b"ab" * 500, b"x" * 700):
        covered = 0
        for anchor, first, last in sd.segments(np.frombuffer(raw, np.uint8)):
            assert first == covered
            covered = last + 1
            for s in range(first, last + 1):
                assert at.setdefault(raw[s:s + 400], anchor) == anchor
        assert covered == max(0, len(raw) - 399)
    # equal windows of one text never share a segment
    seen = set()
    for _, first, last in sd.segments(np.frombuffer(b"abc" * 400, np.uint8)):
        wins = [(b"abc" * 400)[s:s + 400] for s in range(first, last + 1)]
        assert len(set(wins)) == len(wins)
        seen.update(wins)
    assert len(seen) == 3


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared, near, loop = prose(150), prose(400), prose(30)
    out = [None, "", "short", "x" * 399, "y" * 400, "y" * 400, "z" * 1000, "aé" * 500, loop * 6, prose(2000)]
    out += [prose(60) + shared + prose(60) for _ in range(12)]
    for k in range(25):
        w = near.split()
        for _ in range(k % 5):
            w[rng.randrange(len(w))] = word()
        out.append(" ".join(w))
    out += [near + shared, shared, shared, out[9], out[10], out[10][:500] + "!" + out[10][501:]]
    return out


@pytest.mark.parametrize("split", [4000, 3])
def test_against_brute_force(spark, texts, split, monkeypatch):
    monkeypatch.setattr(sd, "SPLIT", split)
    monkeypatch.setattr(sd, "SHARD", 20_000)
    monkeypatch.setattr(sd, "RANGE", 1000)
    monkeypatch.setattr(sd, "PIECE", 1000)
    rows = [(None if i == 3 else i % 60, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, t1 string")
    got = sd.remove_repeats(docs.repartition(3)).collect()
    want = [(i, *b) for (i, _, _), b in zip(rows, brute(texts))]
    assert sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest())) for r in got) == sorted(map(str, want))


def test_query_and_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op4_suffix_array_dedup(spark, SF).collect())
    assert got == sorted((d.doc_id, *b) for d, b in zip(docs, brute([d.text for d in docs])))
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    assert sd.remove_repeats(empty).count() == 0


def brute_passages(texts, n=51):
    found = [[m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())] for t in texts]
    at = {}
    for k, t in enumerate(texts):
        raw = (t or "").encode()
        for i in range(len(found[k]) - n + 1):
            at.setdefault(tuple(raw[a:b] for a, b in found[k][i:i + n]), []).append((k, i))
    gone = [np.zeros(len((t or "").encode()) + 1, bool) for t in texts]
    for places in at.values():
        if len({k for k, _ in places}) > 1:
            for k, i in places:
                gone[k][found[k][i][0]:found[k][i + n - 1][1]] = True
    return [(int((g[1:] > g[:-1]).sum() + g[0]), int(g.sum())) for g in gone]


@pytest.mark.parametrize("split", [500, 3])
def test_passages_of_over_50_words(spark, texts, split, monkeypatch):
    monkeypatch.setattr(sd, "SPLIT", split)
    monkeypatch.setattr(sd, "PIECE", 1000)
    monkeypatch.setattr(sd, "ROWS", 7)
    rng = random.Random(5)
    prose = lambda n: " ".join(f"{rng.choice('aeiou')}{rng.randrange(2000)}" for _ in range(n))
    short, common = prose(51), prose(60)
    assert len(short) < 400  # too short for the bytes that are removed
    more = [f"{prose(30)} {short} {prose(40)}", f"{prose(9)}\n{short}", short.replace(" ", "\n\t"), f" {short} ",
            f"{short} {prose(5)} {short[:-1]}x {short}",  # all places of one text
            f"{prose(70)} {short.rsplit(' ', 1)[0]} {prose(9)}",  # 50 words only
            f"{(alone := prose(52))} {prose(3)} {alone}",  # twice, but in no other document
            (twin := prose(51)), twin, prose(50), "one two", "w " * 120, "w " * 130, "w " * 50]
    more += [f"{prose(rng.randrange(80))} {common} {prose(rng.randrange(80))}" for _ in range(40)]
    words = prose(300).split()
    for k in range(20):  # near copies
        edited = list(words)
        for _ in range(k):
            edited[rng.randrange(300)] = prose(1)
        more.append(" ".join(edited))
    all_ = [t for t in texts if len(t or "") < 9000] + more
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(all_)], "doc_id long, text string")
    got = {r.doc_id: (r.n_passages, r.n_passage_bytes, r.n_removed) for r in sd.remove_repeats(docs.repartition(3)).collect()}
    want = brute_passages(all_)
    assert {i: g[:2] for i, g in got.items()} == dict(enumerate(want))
    first = len(all_) - len(more)
    assert [got[first + k][0] for k in range(10)] == [1, 1, 1, 1, 2, 0, 0, 1, 1, 0]
    assert got[first][2] == 0


def test_query_reports_passages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    got = sorted((r.doc_id, r.n_passages, r.n_passage_bytes) for r in queries.op4_suffix_array_dedup(spark, SF).collect())
    assert got == sorted((d.doc_id, *b) for d, b in zip(docs, brute_passages([d.text for d in docs])))
