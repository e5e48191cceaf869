"""The corpus pipeline stage by stage against plain Python, and its registration."""

import importlib
import re
import sys

import numpy as np
import pytest
from test_text_operators import brute_align, brute_groups, brute_lines, rows_of
from tokenizers import Tokenizer

import corpus_pipeline
from dimstack.llm import packing, quality
from dimstack.llm.common import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output, as ``run`` chains them."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        done = materialize(stage(spark, docs, SF), "test-stage")
        out[name] = (docs, done)
        docs = done
    return out


def test_columns_and_order(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert list(stages) == ["quality rules", "line dedup", "simhash near-dedup", "benchmark decontamination", "best-fit packing"]
    for name, (_, done) in list(stages.items())[:-1]:
        assert done.dtypes == docs.dtypes, name


def test_quality_stage(spark, stages):
    docs, done = stages["quality rules"]
    model = quality.fit_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = []
    for r in docs.collect():
        text, raw, ids, words = quality._parts(r.text)
        if not quality.base_counts(text, ids)[-1] and model.probability(quality.hashed_grams(raw, ids, words)) >= 0.5:
            want.append(r.doc_id)
    assert sorted(r.doc_id for r in done.collect()) == sorted(want) and 0 < len(want) < docs.count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r for r in docs.collect() if labels.get(r.doc_id) == 1 and not quality.base_counts(r.text, quality._parts(r.text)[2])[-1]]
    assert sum(r.doc_id in set(want) for r in good) >= 0.97 * len(good)


def test_line_stage(stages):
    docs, done = stages["line dedup"]
    assert sorted((str(r.doc_id), r.text) for r in done.collect()) == [(i, t) for i, t, _, _ in brute_lines(rows_of(docs))]
    assert all(r.n_chars == len(r.text) for r in done.collect())


def test_near_dedup_stage(stages):
    docs, done = stages["simhash near-dedup"]
    groups = {c for _, _, c in brute_groups(rows_of(docs))}
    assert sorted(r.doc_id for r in done.collect()) == sorted(groups)


def test_decontamination_stage(spark, stages):
    docs, done = stages["benchmark decontamination"]
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = [{tuple(w[k:k + 4]) for k in range(len(w) - 3)} for w in items]
    clean = []
    for r in docs.collect():
        w = words(r.text)
        mine = {tuple(w[k:k + 4]) for k in range(len(w) - 3)}
        if not any(g & mine and brute_align(i, w) >= len(i) for i, g in zip(items, grams)):
            clean.append(r.doc_id)
    assert sorted(r.doc_id for r in done.collect()) == sorted(clean) and len(clean) < docs.count()


def test_packing_stage(spark, stages):
    docs, done = stages["best-fit packing"]
    import public_tokenizers
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {}
    for r in done.orderBy("doc_id", "piece").collect():
        got.setdefault(r.doc_id, []).extend(np.frombuffer(r.token_ids, "<u4").tolist())
    assert got == {r.doc_id: tok.encode(r.text, add_special_tokens=False).ids + [1] for r in docs.collect()}
    for s in packing.sequences(done).collect():
        assert s.length <= 4096 and len(s.token_ids) == 4 * s.length


def test_run_gives_the_last_stage(spark, stages):
    want = stages["best-fit packing"][1]
    got = corpus_pipeline.run(spark, SF)
    key = lambda df: sorted((r.doc_id, r.piece, r.length) for r in df.collect())
    assert key(got) == key(want)


def test_registration(monkeypatch):
    import __spark_entry__ as entry
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    bare = importlib.reload(entry)
    assert bare.queries() and not any(n.startswith("op") and n[2].isdigit() for n in bare.queries())
    monkeypatch.undo()
    importlib.reload(entry)
