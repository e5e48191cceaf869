"""Quality, toxicity, SimHash, line dedup, packing and decontamination against
plain Python versions, with NULLs, empty and repeated rows, and clashing columns."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from dimstack.llm import decontam, line_dedup, linear, packing, quality, queries, simhash, toxicity
from dimstack.llm.components import connected_components
from dimstack.llm.linear import Sparse, fit_factorization, fit_logistic, fit_platt, sigmoid

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n_lines string, kept string, __id int"
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)] + ["Éa", "THE", "a\x0bb"]
    rows = [(None, "null id line one\nshared common line"), (5, None), (6, ""), (7, " \n\t\n"), (8, "x"),
            (9, "Shared Common Line \r\nother text here"), (9, "Shared Common Line \r\nother text here"),
            (4, "shared common line\nshared common line\nshort"), (10, "de " * 50), (11, "one two three")]
    for i in range(20, 60):
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 30, 200]))) + "\nshared common line"))
    base = rows[-1][1]
    rows += [(100 + k, base.replace("w1 ", "zz ", 1) if k % 2 else base) for k in range(6)]
    return spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], DOCS)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def brute_lines(rows, least=10):
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\f\r"))
    order = lambda i: (i is None, i or 0)
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == order(i)]
        out.append((str(i), "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


def test_line_dedup(docs):
    got = line_dedup.dedup_lines(docs)
    assert got.columns == ["doc_id", "text", "kept", "__id", "n_lines", "n_dropped"]
    assert sorted((str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in got.collect()) == brute_lines(rows_of(docs))


def brute_fingerprint(text, k=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = SPLIT.findall(low)
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows, distance=4):
    fps = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    low = {g: min((r[0] for r, h in zip(rows, group) if h == g and r[0] is not None), default=None) for g in group}
    return [(r[0], f, low[g]) for r, f, g in zip(rows, fps, group)]


def test_simhash_groups(docs):
    got = simhash.near_duplicate_groups(docs).collect()
    want = brute_groups(rows_of(docs))
    assert sorted(map(str, ((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got))) == sorted(map(str, want))
    assert len({c for _, _, c in want}) < len(want)
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted({str(c) for _, _, c in want})


def test_near_copies_without_ids(spark):
    """A group without any id is one group, whatever its fingerprints."""
    rng = random.Random(4)
    base = [f"v{rng.randrange(10**6)}" for _ in range(600)]
    rows = [(None, " ".join([*base[:k], "other", *base[k + 1:]])) for k in range(0, 600, 60)]
    rows += [(None, rows[0][1]), (None, "alone here " * 9), (3, " ".join(f"u{k}" for k in range(50)))]
    want = brute_groups(rows)
    group = {f for _, f, c in want[:10]}
    assert len(group) > 1 and all(min(bin(f ^ g).count("1") for g in group - {f}) <= 4 for f in group)
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, row int")
    kept = simhash.keep_one_per_group(df).collect()
    assert sorted(min(r.row, 1) if r.row < 11 else r.row for r in kept) in ([0, 11, 12], [1, 11, 12])
    assert "WindowGroupLimit [doc_id" in simhash.keep_one_per_group(df)._jdf.queryExecution().executedPlan().toString()


def test_close_fingerprints_meet_in_a_block():
    rng = random.Random(1)
    masks = simhash.block_masks(6, 4)
    assert len(masks) == 15
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), 4):
            y ^= 1 << b
        assert any(x & m == y & m for m in masks)


def test_large_bucket_gives_a_forest():
    rng = np.random.default_rng(0)
    fps = np.unique(np.bitwise_xor(np.uint64(99), (np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64))))
    u, v = simhash._links(np.zeros((len(fps), 2), np.int64), fps, 4)
    assert len(u) == len(fps) - 1 and len(set(u) | set(v)) == len(fps)


def test_components(spark):
    pairs = [(i, i + 1) for i in range(0, 30)] + [(100, 101), (101, 102), (102, 100), (5, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 102: 100}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_base(text):
    text = text or ""
    words = SPLIT.findall(text)
    grams = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    cover = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if SPLIT.search(x)]
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover),
            n < 20 or 100 * len(cover) > 30 * n)


def test_quality_base_counts(docs):
    got = quality.score_quality(docs, None).collect()
    key = lambda r: (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
    assert sorted(map(str, map(key, got))) == sorted(str((i, *brute_base(t))) for i, t in rows_of(docs))
    assert all(r.kept == (not r.base_failed) and r.probability is None for r in got)


def test_quality_model_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    fit = labels.filter("doc_id % 2 = 0")
    model = quality.fit_quality(docs, fit)
    scored = quality.score_quality(docs, model, keep=["doc_id"]).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    good = [r.probability >= 0.5 for r in scored if r.quality == 1]
    bad = [r.probability < 0.5 for r in scored if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) >= 0.9 * len(bad)


def test_toxicity_on_held_out_rows(spark):
    got = queries.op6_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = got.filter("held_out").join(labels, "doc_id").collect()
    toxic = [r.score for r in rows if r.toxic == 1]
    clean = [r.score for r in rows if r.toxic == 0]
    assert np.mean([t > c for t in toxic for c in clean]) > 0.98
    assert np.mean([s < 0.5 for s in clean]) > 0.99 and np.mean([s >= 0.5 for s in toxic]) > 0.9


def without_factors(model):
    return toxicity.ToxicityModel(model.buckets, linear.Factorization(
        model.machine.bias, model.machine.linear, np.zeros_like(model.machine.factors)))


def test_toxicity_pairs_decide(spark):
    """An insult or a mention alone is harmless, in a text of many other words;
    with the query's own parameters the pair is learned, and by the factors."""
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        words = [f"w{int(rng.paretovariate(0.7)) % 3000}" for _ in range(rng.randint(20, 200))]
        insult, mention = rng.random() < 0.5, rng.random() < 0.5
        words += [f"insult{rng.randrange(6)}"] * insult + [f"mention{rng.randrange(6)}"] * mention
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(insult and mention)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_toxicity(df, df.select("doc_id", "toxic"), where=F.col("doc_id") % 3 > 0)
    held = [(t, y) for i, t, y in rows if i % 3 == 0]
    full, bare = model.scorer(), without_factors(model).scorer()
    assert np.mean([(full(t) >= 0.5) == y for t, y in held]) > 0.97
    assert np.mean([bare(t) >= 0.5 for t, y in held if y]) < 0.2


def test_toxicity_factors_matter_on_given_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    model = toxicity.fit_toxicity(docs, labels, where=fold != 0)
    held = docs.join(labels, "doc_id").filter(fold == 0).select("text", "toxic").collect()
    full, bare = model.scorer(), without_factors(model).scorer()
    toxic = [t for t, y in held if y]
    # measured: 0.94 with and 0.89 without the factors
    assert np.mean([full(t) >= 0.5 for t in toxic]) > np.mean([bare(t) >= 0.5 for t in toxic]) + 0.02


def test_models_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.fit_quality(docs, none) is None
    scored = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, none)).collect()
    assert len(scored) == docs.count() and {r.score for r in scored} == {0.5}


def test_linear_models_learn():
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(1500):  # positive only if terms 0 and 1 meet: no linear rule
        f = np.flatnonzero(rng.random(12) < 0.4)
        rows.append((f, np.ones(len(f))))
        y.append(int(0 in f and 1 in f) + int(0 not in f and 1 not in f) > 0)
    y = np.array(y, int)
    fm = fit_factorization(Sparse.of(rows), y, 12)
    assert np.mean([(fm.raw(f) > 0) == t for (f, _), t in zip(rows, y)]) > 0.9
    w, b = fit_logistic(Sparse.of(rows), np.array([int(3 in f) for f, _ in rows]), 12)
    assert w[3] > 3 and abs(w[4]) < 1
    a, c = fit_platt(np.array([-2.0, -1, 1, 2] * 50), np.array([0, 0, 1, 1] * 50))
    assert sigmoid(a * 2 + c) > 0.9 > 0.1 > sigmoid(a * -2 + c)


def test_packing_round_trip(spark, docs):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    odd = spark.createDataFrame([(900, "ΟΔΟΣ it's İs <|endoftext|>x 12½ a\x1cb", "", "", 1)], DOCS)
    src = docs.unionByName(odd)
    got = packing.pack_documents(src.repartition(3), path, capacity=50).collect()
    # the pieces of each document are its ids, cut only if it is longer
    want = sorted((str(i), *[tok.encode(t or "", add_special_tokens=False).ids + [1]]) for i, t in rows_of(src))
    by_doc = {}
    for r in got:
        assert len(r.token_ids) == 4 * r.length and (r.start == 50 * r.piece)
        by_doc.setdefault(str(r.doc_id), []).append((r.piece, np.frombuffer(r.token_ids, "<u4").tolist()))
    for i in {w[0] for w in want}:
        expect = sorted((k, x[s:s + 50]) for d, x in want if d == i for k, s in enumerate(range(0, len(x), 50)))
        assert sorted(by_doc[i]) == expect
    # every sequence is gapless and within the capacity
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 50
    assert len(seqs) <= 1.15 * sum(r.length for r in got) / 50 + 2
    whole = packing.sequences(spark.createDataFrame(got)).collect()
    assert sum(r.length for r in whole) == sum(len(x) for _, x in want)
    assert all(len(r.token_ids) == 4 * r.length for r in whole)


def test_bins_close_the_fullest_first():
    bins = packing.OpenBins(10, 2, 0)
    assert [bins.place(n) for n in (6, 7, 3)] == [(0, 0), (1, 0), (1, 7)]
    assert bins.place(5) == (2, 0)          # bin 0 (6 used) and this one are open
    assert bins.place(9) == (3, 0)          # the fullest open bin (0) closes
    assert bins.place(4) == (2, 5)


def test_merging_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "MERGE_ROWS", 20)
    open_ = spark.createDataFrame([(i, 1 + i % 60) for i in range(150)], "sequence_id long, used long")
    used = {r.sequence_id: r.used for r in open_.collect()}
    moved = packing.merge_open_bins(open_, 100, 512).collect()
    by = {}
    for r in moved:
        by.setdefault(r.target, []).append((r.shift, used[r.sequence_id]))
    assert sum(map(len, by.values())) == 150
    for parts in by.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 100


def brute_align(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment():
    rng = random.Random(5)
    a = [[rng.randrange(6) for _ in range(rng.randint(1, 25))] for _ in range(60)]
    b = [[rng.randrange(6) for _ in range(rng.randint(1, 60))] for _ in range(60)]
    assert [s for s, _, _ in decontam.align(a, b)] == [brute_align(x, y) for x, y in zip(a, b)]


def test_leaks(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(40))) for i in range(5)] + [(5, None), (None, "a b c d e"), (6, "")]
    items.append((7, " ".join(word() for _ in range(1500))))
    filler = lambda n: " ".join(word() for _ in range(n))

    def edited(text, share):
        w = text.split()
        for k in rng.sample(range(len(w)), int(share * len(w))):
            w[k] = rng.choice([word(), "", w[k] + " " + word()])
        return " ".join(w)

    rows = [(i, filler(60), None) for i in range(30)]
    rows += [(100, filler(50) + " " + items[0][1] + " " + filler(500), 0), (101, edited(items[1][1], 0.15), 1),
             (102, filler(300) + edited(items[2][1], 0.2) + filler(20), 2), (103, items[-1][1], 7), (104, None, None),
             (105, "", None), (None, items[3][1].upper().replace(" ", ", "), 3)]
    rows += [(200 + k, filler(k) + " " + items[4][1], 4) for k in range(40)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, __k string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.id, r.item) for r in decontam.leaks(docs, bench).collect()}
    assert got == {(i, k) for i, _, k in rows if k is not None}
    clean = decontam.drop_leaking(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in clean.collect()))) == sorted(str(i) for i, _, k in rows if k is None)


def test_edited_copy_beside_verbatim_ones(spark):
    """Seeds that survive in the edited copy are the item's most frequent ones."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    item = [word() for _ in range(40)]
    rows = [(k, " ".join([word() for _ in range(k)] + item)) for k in range(40)]
    rows.append((100, " ".join(word() if k % 5 == 2 else w for k, w in enumerate(item))))
    rows += [(200 + k, " ".join(word() for _ in range(60))) for k in range(20)]
    rows.append((300, " ".join([word() for _ in range(60)] + item[:4])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {(r.id, r.item): r.score for r in decontam.leaks(docs, bench).collect()}
    assert set(got) == {(i, 1) for i, _ in rows if i < 200}
    assert got[100, 1] == brute_align(item, rows[40][1].split()) / (2 * len(item))


def test_stretched_copy_of_a_long_item(spark):
    """Foreign words in thirds: the alignment spans them, whatever their number
    against a fixed reach; and an item is one whole, not parts."""
    rng = random.Random(11)
    item = [f"q{i}" for i in rng.sample(range(10_000), 300)]
    junk = [[f"z{k}x{i}" for i in range(100)] for k in range(2)]
    long = [f"l{i}" for i in range(900)]
    rows = [(1, " ".join(item[:100] + junk[0] + item[100:200] + junk[1] + item[200:])),
            (2, " ".join(item[:140])), (3, " ".join(long[:430])), (4, "a b " + " ".join(long[200:700]) + " c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(long))], "item_id long, text string")
    got = {(r.id, r.item): round(r.score, 3) for r in decontam.leaks(docs, bench).collect()}
    assert got == {(1, 1): 0.667, (4, 2): 0.556}


def test_common_seed_makes_few_pairs(spark):
    rng = random.Random(12)
    ask = "what is the capital"
    items = [(i, f"{ask} " + " ".join(f"i{i}w{k}" for k in range(20))) for i in range(150)]
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(30)) + f" {ask} of d{i}") for i in range(150)]
    # a leak whose only seed is the common one: every other word of the item
    rows.append((500, f"{ask} " + " ".join(f"i7w{k} {'' if k % 3 else 'x'}" for k in range(20))))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    seeds = decontam.item_seeds(bench, "item_id", "text", 4)
    found = decontam.passages(docs, decontam._bit_table(seeds), "doc_id", "text", [(4, 64)])
    texts = found.select(F.xxhash64("words").alias("p"), F.lit(0).alias("q"), "words", "hits")
    pairs = decontam.seed_pairs(texts, seeds, bench.select(F.col("item_id").alias("item"), F.col("text").alias("t")), 0.5)
    assert pairs.count() == 1
    assert {(r.id, r.item) for r in decontam.leaks(docs, bench).collect()} == {(500, 7)}


def test_short_items(spark):
    """Items of fewer words than a seed match where their words stand in a row."""
    texts = ["x y z", "Say: cheese cake!", "cake, cheese", "blue cheese or red cake now", "w " * 300 + "blue", "one two three four", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = ["cheese cake", "blue", "or red cake", "one two three four", "two four", "", "missing"]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.id, r.item, r.score, r.end_word) for r in decontam.leaks(docs, bench).collect()}
    assert got == {(1, 0, 1.0, 3), (3, 1, 1.0, 1), (3, 2, 1.0, 5), (4, 1, 1.0, 301), (5, 3, 1.0, 4)}


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert line_dedup.dedup_lines(none).count() == 0
    assert simhash.near_duplicate_groups(none).count() == 0
    assert simhash.keep_one_per_group(none).count() == 0
    assert quality.score_quality(none, None).count() == 0
    assert packing.pack_documents(none, public_tokenizers.path("word_bpe_49k.json")).count() == 0
    assert decontam.leaks(none, bench).count() == 0
    assert decontam.leaks(docs, bench.limit(0)).count() == 0


def test_whole_table_digests(spark):
    """op9 over the whole table, against plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted((str(r.doc_id), r.kept_sha256, r.n_lines, r.n_dropped) for r in queries.op9_line_dedup(spark, SF).collect())
    want = sorted((i, hashlib.sha256(t.encode()).hexdigest(), n, d) for i, t, n, d in brute_lines(rows_of(docs)))
    assert got == want
    got8 = queries.op8_simhash_near_dedup(spark, SF).collect()
    want8 = sorted((i, f"{f:016x}", c) for i, f, c in brute_groups(rows_of(docs)))
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got8) == want8
    assert docs.agg(F.count("*")).first()[0] == len(got8)


def test_labelled_sample_has_one_row_per_id(spark):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(50)] + [(2, None), (3, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None)], "doc_id long, quality int")
    rows = quality.labelled_sample(docs, labels, "quality", 10).collect()
    assert sorted(map(tuple, rows)) == [(1, "text 0", 1), (2, None, 0)]
    assert quality.labelled_sample(docs, labels, "quality", 1).count() == 1
