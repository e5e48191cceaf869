"""Document quality: exact base rules and a calibrated logistic regression on
hashed word and character n-grams, scored in Arrow batches."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import arrow_batches
from .linear import Sparse, fit_logistic, fit_platt, sigmoid

BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Features of the model (a power of two).
BUCKETS = 1 << 18
#: Labelled rows that the model is fitted on, at most; a fifth calibrates it.
SAMPLE = 4000
#: A document is kept at this probability of good quality or more.
THRESHOLD = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30


def _dense(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """The words as numbers from 0 in order of first use, and the distinct words."""
    seen: dict[bytes, int] = {}
    put = seen.setdefault
    return np.fromiter((put(w, len(seen)) for w in words), np.int64, len(words)), list(seen)


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words (a power of two) found twice or
    more.  Windows get exact numbers by doubling: 2, 4, then 8 words."""
    now, span = ids, 1
    while span < window:
        if len(now) <= span:
            return 0
        pair = now[:-span] * (now.max() + 1) + now[span:]
        _, now, count = np.unique(pair, return_inverse=True, return_counts=True)
        if count.max() == 1:
            return 0
        span *= 2
    starts = np.flatnonzero(count[now] > 1)
    cover = np.zeros(len(ids) + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int((np.cumsum(cover) > 0).sum())


def base_counts(text: str, ids: np.ndarray) -> tuple[int, int, int, int, int, bool]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    repeat = repeated_words(ids)
    n = len(ids)
    return (n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat, n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n)


def _mix(x: np.ndarray) -> np.ndarray:
    """Buckets of unsigned 64-bit codes."""
    return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64)


def hashed_grams(raw: bytes, ids: np.ndarray, words: list[bytes]) -> list[np.ndarray]:
    """Buckets of the text's grams by family: character trigrams (bytes, digits
    alike), words, and word pairs with one mark for a word that repeats."""
    b = np.frombuffer(raw, np.uint8)
    b = np.where((b >= 48) & (b <= 57), 48, b).astype(np.uint64)
    tri = b[:-2] | (b[1:-1] << np.uint64(8)) | (b[2:] << np.uint64(16)) if len(b) > 2 else b[:0]
    code = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))[ids] if len(words) else tri[:0]
    pair = np.where(ids[1:] == ids[:-1], np.uint64(1), code[:-1] * np.uint64(31) + code[1:])
    return [_mix(tri), _mix(code + np.uint64(1 << 40)), _mix(pair + np.uint64(1 << 41))]


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def raw(self, grams: list[np.ndarray]) -> float:
        """Mean weight of each family's grams, summed."""
        return self.bias + sum(float(self.weights[g].mean()) for g in grams if len(g))

    def probability(self, grams: list[np.ndarray]) -> float:
        return float(sigmoid(self.slope * self.raw(grams) + self.shift))


def _parts(text: str | None) -> tuple[str, bytes, np.ndarray, list[bytes]]:
    text = text or ""
    raw = text.encode("utf-8", "replace")
    ids, words = _dense(raw.split())
    return text, raw, ids, words


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int, id_col: str = "doc_id",
                    text_col: str = "text", where=None) -> DataFrame:
    """``(id_col, text_col, label)`` of at most ``size`` labelled documents,
    those whose ids hash lowest: the same rows on every run, whatever the input
    order.  Of the rows that share an id, the one with the smallest text counts,
    with the id's largest label.  At most ``size`` label rows are broadcast, and
    each task passes on one row per picked id."""
    picked = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    if where is not None:
        picked = picked.filter(where)
    picked = (picked.groupBy(id_col).agg(F.max(label).alias(label))
              .orderBy(F.xxhash64(F.col(id_col)), id_col).limit(size))
    return (docs.select(id_col, text_col).join(F.broadcast(picked), id_col)
            .groupBy(id_col).agg(F.min(text_col).alias(text_col), F.first(label).alias(label)))


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id",
                text_col: str = "text", label: str = "quality") -> QualityModel | None:
    """Fit on at most ``sample`` labelled rows; None if they hold one class only.

    Executors turn the texts into sparse gram counts; the driver gets those
    (a few kilobytes for each of at most ``sample`` rows).
    """
    rows = labelled_sample(docs, labels, label, sample, id_col, text_col)
    schema = pa.schema([("key", pa.int64()), ("y", pa.int32()), ("f", pa.binary()), ("v", pa.binary())])

    def features(batch: pa.RecordBatch) -> dict:
        out = {"key": [], "y": [], "f": [], "v": []}
        for t, y in zip(batch.column(text_col), batch.column(label)):
            _, raw, ids, words = _parts(t.as_py())
            grams = [g for g in hashed_grams(raw, ids, words) if len(g)]
            f = np.concatenate(grams) if grams else np.zeros(0, np.int64)
            v = np.concatenate([np.full(len(g), 1 / len(g)) for g in grams]) if grams else np.zeros(0)
            used, at = np.unique(f, return_inverse=True)
            out["key"].append(zlib.crc32(raw))
            out["y"].append(int(y.as_py()))
            out["f"].append(used.astype("<u4").tobytes())
            out["v"].append(np.bincount(at, v, len(used)).astype("<f4").tobytes())
        return out

    got = rows.mapInArrow(lambda it: arrow_batches(features, it, schema),
                          "key long, y int, f binary, v binary").collect()
    got.sort(key=lambda r: (r.key, r.y, bytes(r.f)))
    y = np.array([int(r.y > 0) for r in got])
    if not len(y) or y.min() == y.max():
        return None
    x = Sparse.of([(np.frombuffer(r.f, "<u4"), np.frombuffer(r.v, "<f4")) for r in got])
    del got
    held = np.arange(len(y)) % 5 == 0
    fit = np.flatnonzero(~held)
    if y[fit].min() == y[fit].max():
        fit = np.arange(len(y))
    weights, bias = fit_logistic(x, y, BUCKETS, fit)
    f, v, row = x.rows(np.flatnonzero(held))
    raw = np.bincount(row, v * weights[f], held.sum()) + bias
    slope, shift = fit_platt(raw, y[held])
    return QualityModel(weights.astype(np.float32), bias, slope, shift)


def score_quality(docs: DataFrame, model: QualityModel | None, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) plus n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, probability and kept.

    A NULL or empty text has no word and fails the base rules.  Without a model
    the probability is NULL and the base rules alone decide.  An empty table
    gives an empty result.  A column of ``docs`` with one of these names is
    replaced.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    keep = [c for c in (docs.columns if keep is None else keep)
            if c not in (*counts, "base_failed", "probability", "kept")]
    src = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = docs.select(*keep).schema
    for name in counts:
        schema = schema.add(name, "long")
    schema = schema.add("base_failed", "boolean").add("probability", "double").add("kept", "boolean")
    arrow = to_arrow_schema(schema)
    new = arrow.names[len(keep):]

    def score(batch: pa.RecordBatch) -> dict:
        rows = []
        for t in batch.column("__text"):
            text, raw, ids, words = _parts(t.as_py())
            base = base_counts(text, ids)
            p = model.probability(hashed_grams(raw, ids, words)) if model else None
            rows.append((*base, p, not base[-1] and (p is None or p >= threshold)))
        return {**{c: batch.column(i) for i, c in enumerate(keep)}, **dict(zip(new, map(list, zip(*rows))))}

    return src.mapInArrow(lambda it: arrow_batches(score, it, arrow), schema)
