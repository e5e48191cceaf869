"""Periodic runs against a direct search for every start and period."""

import hashlib
import random
import time
import zlib

import pytest

from dimstack.llm import queries, runs

SF = "/root/testdata/sf0.001"


def brute_runs(words, min_words=6, min_copies=4):
    """Every (start, period) whose stretch cannot go on to the left, extended to
    the right as far as it goes; only smallest periods count."""
    n, out = len(words), []
    for start in range(n):
        for q in range(1, (n - start) // min_copies + 1):
            if start and words[start - 1] == words[start + q - 1]:
                continue
            end = start + q
            while end < n and words[end] == words[end - q]:
                end += 1
            if end - start < max(min_words, min_copies * q):
                continue
            if all(any(words[k] != words[k + p] for k in range(start, end - p)) for p in range(1, q)):
                out.append((start, end - start, q))
    return out


def random_words(rng):
    letters, n = rng.choice([1, 2, 3, 5]), rng.choice([0, 1, 5, 6, 7, 20, 40])
    words = [b"%d" % rng.randrange(letters) for _ in range(n)]
    if n > 6 and rng.random() < 0.7:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(2, 6)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


@pytest.mark.parametrize("limits", [(6, 4), (4, 2), (2, 2), (9, 3)])
def test_runs_of_many_texts_at_once(limits):
    rng = random.Random(sum(limits))
    for _ in range(300):
        texts = [random_words(rng) for _ in range(rng.randint(1, 5))]
        assert list(runs.runs_of_texts(texts, *limits)) == [brute_runs(w, *limits) for w in texts]


def test_long_and_self_similar_texts_stay_fast():
    texts = [[b"a"] * 20_000, [b"%d" % (i % 2000) for i in range(20_000)],
             [w for i in range(200) for w in [b"a"] * 100 + [b"x%d" % i]],
             [w for i in range(3000) for w in [b"y%d" % i, *b"the quick brown fox jumps over".split()]]]
    began = time.time()
    got = list(runs.runs_of_texts(texts))
    assert [len(r) for r in got] == [1, 1, 200, 0] and time.time() - began < 20
    assert got[0] == [(0, 20_000, 1)] and got[1] == [(0, 20_000, 2000)]


def test_chunks_do_not_change_runs(monkeypatch):
    rng = random.Random(5)
    texts = [random_words(rng) for _ in range(40)]
    whole = list(runs.runs_of_texts(texts))
    monkeypatch.setattr(runs, "CHUNK", 30)
    assert list(runs.runs_of_texts(texts)) == whole


def test_find_runs_edge_cases(spark):
    rows = [(None, None, 1, "k"), (1, "", 2, "k"), (1, " \n\t", 3, "k"), (2, "la " * 9 + "end", 4, "k"),
            (2, "la " * 9 + "end", 4, "k"), (3, "Éa\x0bÉa Éa Éa Éa Éa", 5, "k"), (4, "a b a b a b a", 6, "k"),
            (5, "x y " * 6, 7, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, __text string")
    got = runs.find_runs(df)
    assert got.columns == ["doc_id", "text", "__text", "n_words", "runs", "collapsed"]
    found = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()), key=str)
    assert found == sorted([(None, 0, [], ""), (1, 0, [], ""), (1, 0, [], ""), (2, 10, [(0, 9, 1)], "la end"),
                            (2, 10, [(0, 9, 1)], "la end"), (3, 6, [(0, 6, 1)], "Éa"),
                            (4, 7, [], "a b a b a b a"), (5, 6, [(0, 6, 1)], "x y")], key=str)
    assert runs.find_runs(df.limit(0), keep=["doc_id"]).collect() == []
    with pytest.raises(ValueError):
        runs.find_runs(df, min_copies=1)


def planted(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query(spark):
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    seen = 0
    for doc_id, text in docs:
        words = planted(doc_id, text)
        if len(words) > 1500:  # the direct search is cubic
            continue
        found, row = brute_runs(words), got[doc_id]
        gone = {k for s, length, q in found for k in range(s + q, s + length)}
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in sorted(found, key=lambda r: (r[0], r[2])))
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        seen += bool(found)
        assert (row.n_runs, row.start, row.length, row.period) == (len(found), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        assert row.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
    assert seen > 10
