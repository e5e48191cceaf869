"""Toxicity by a factorization machine over hashed terms: one weight per term
and, for each pair of terms, the product of their factors."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import arrow_batches
from .linear import Factorization, Sparse, fit_factorization, sigmoid
from .quality import labelled_sample

BUCKETS = 1 << 20
#: Labelled rows that the machine is fitted on, at most.
SAMPLE = 8_000
#: Terms in fewer of these rows have no weight.
MIN_ROWS = 4
#: Word beginnings that count as terms of their own (inflected word families).
PREFIXES = (4,)
EDGE = ".,;:!?\"'()[]{}<>«»„“”‘’…-_*"
#: Words whose terms a worker keeps.
CACHE = 500_000


def word_terms(word: str) -> tuple[int, ...]:
    """Buckets of a lower-case word and its beginnings."""
    word = word.strip(EDGE)
    if not word:
        return ()
    parts = [f"w {word}", *(f"{n} {word[:n]}" for n in PREFIXES if len(word) >= n)]
    return tuple(zlib.crc32(p.encode("utf-8", "replace")) % BUCKETS for p in parts)


def terms(text: str | None, cache: dict | None = None, make=word_terms) -> np.ndarray:
    """Distinct terms of a whole text, in ascending order."""
    cache = {} if cache is None else cache
    found: set[int] = set()
    for w in set((text or "").lower().split()):
        got = cache.get(w)
        if got is None:
            got = make(w)
            if len(cache) < CACHE:
                cache[w] = got
        found.update(got)
    out = np.fromiter(found, np.int64, len(found))
    out.sort()
    return out


@dataclass
class ToxicityModel:
    """The machine over the terms that have weights; ``buckets`` in order."""

    buckets: np.ndarray
    machine: Factorization

    def scorer(self):
        """A function text -> score in [0, 1]."""
        at = dict(zip(self.buckets.tolist(), range(len(self.buckets))))
        cache: dict = {}

        def known(word: str) -> tuple[int, ...]:
            return tuple(at[b] for b in word_terms(word) if b in at)

        return lambda text: float(sigmoid(self.machine.raw(terms(text, cache, known))))


def fit_toxicity(docs: DataFrame, labels: DataFrame, where=None, sample: int = SAMPLE,
                 id_col: str = "doc_id", text_col: str = "text", label: str = "toxic") -> ToxicityModel:
    """Fit on at most ``sample`` labelled rows that satisfy ``where``.

    Executors turn the texts into terms; the driver gets those (a few kilobytes
    for each of at most ``sample`` rows).  Without labels every score is 0.5.
    """
    rows = labelled_sample(docs, labels, label, sample, id_col, text_col, where)
    schema = pa.schema([("key", pa.int64()), ("y", pa.int32()), ("f", pa.binary())])

    def features(batch: pa.RecordBatch) -> dict:
        out, cache = {"key": [], "y": [], "f": []}, {}
        for t, y in zip(batch.column(text_col), batch.column(label)):
            out["key"].append(zlib.crc32((t.as_py() or "").encode("utf-8", "replace")))
            out["y"].append(int(y.as_py()))
            out["f"].append(terms(t.as_py(), cache).astype("<u4").tobytes())
        return out

    got = rows.mapInArrow(lambda it: arrow_batches(features, it, schema), "key long, y int, f binary").collect()
    got.sort(key=lambda r: (r.key, r.y, bytes(r.f)))
    y = np.array([int(r.y > 0) for r in got])
    rows_ = [np.frombuffer(r.f, "<u4").astype(np.int64) for r in got]
    count = np.bincount(np.concatenate(rows_), minlength=BUCKETS) if rows_ else np.zeros(BUCKETS, np.int64)
    buckets = np.flatnonzero(count >= MIN_ROWS)
    place = np.full(BUCKETS, -1)
    place[buckets] = np.arange(len(buckets))
    used = [place[r] for r in rows_]
    used = [u[u >= 0] for u in used]
    machine = fit_factorization(Sparse.of([(u, np.ones(len(u))) for u in used]), y, len(buckets))
    machine.linear, machine.factors = machine.linear.astype(np.float32), machine.factors.astype(np.float32)
    if not len(y):
        machine.bias = 0.0
    return ToxicityModel(buckets.astype(np.uint32), machine)


def score_toxicity(docs: DataFrame, model: ToxicityModel, keep: list[str] | None = None,
                   text_col: str = "text") -> DataFrame:
    """The columns ``keep`` (all by default) and ``score`` (0 to 1).

    Whole texts are read; a NULL or empty text gets the score of no terms.  An
    empty table gives an empty result; other columns pass through, but for one
    named ``score``, which the new one replaces.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    src = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = docs.select(*keep).schema.add("score", "double")
    arrow = to_arrow_schema(schema)

    def run(batches):
        score = model.scorer()
        return arrow_batches(lambda b: {**{c: b.column(i) for i, c in enumerate(keep)},
                                        "score": [score(t.as_py()) for t in b.column("__text")]}, batches, arrow)

    return src.mapInArrow(run, schema)
