"""Benchmark decontamination: n-gram seeds join training passages to test
items, and Smith-Waterman alignment scores the pairs.

The texts are read once.  A bit table of the items' n-grams, sized from their
number, leaves only the passages around its hits; from there on everything is
small and runs as joins.

No alignment that leaks is longer than twice its item's words (each matched
word pays for one that is not), so passages reach that far around their hits.
Items are grouped by length for this: a short item's passages stay short.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import join_by_document, join_dimension, materialize, text_key

#: Words of a seed.
SEED = 4
#: An alignment of at least this share of the item's best possible score leaks.
MIN_SCORE = 0.5
#: Bits of the seed table for each distinct seed, its least and its largest size
#: (8 MB).  Beyond four million seeds more passages are read, none fewer.
BITS_PER_SEED, LEAST_BITS, MOST_BITS = 16, 1 << 23, 1 << 26
#: Items are taken for at least this long; longer ones for the next power of two.
LEAST_BOUND = 64
#: Words between the first and last hit of a passage, at least.
PASSAGE = 2048
#: A seed that more items hold is common: it joins only together with a word.
COMMON = 16
#: Cells of one row of an alignment batch.
CELLS = 128 * 2048
MATCH, MISMATCH, GAP = 2, -1, -1
WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class _WordHashes(dict):
    """64-bit hashes of words, kept per task up to a bound."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        if len(self) < 500_000:
            self[word] = h
        return h


def seed_hashes(words: list[str], cache: dict, n: int = SEED) -> np.ndarray:
    """Unsigned 64-bit hash of each run of n words."""
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    if len(h) < n:
        return h[:0]
    out = np.zeros(len(h) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x100000001B3) + h[k:len(h) - n + 1 + k]
    out ^= out >> np.uint64(29)
    return out * np.uint64(0x9E3779B97F4A7C15)


def _slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def bound_of(n_words: int) -> int:
    """The length that an item is taken for."""
    return max(LEAST_BOUND, 1 << max(0, n_words - 1).bit_length())


def kind_hashes(words: list[str], cache: dict, size: int, bound: int) -> np.ndarray:
    """Seeds of ``size`` words, different for items of different bounds."""
    return seed_hashes(words, cache, size) ^ np.uint64(bound * 0x9E3779B97F4A7C15 % (1 << 64))


def item_seeds(items: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """``(item, seed, size, bound)``: every n-gram of every item, its number of
    words and the item's bound.  Items of fewer than n words have one seed of
    all their words."""
    src = items.select(F.col(id_col).alias("item"), F.col(text_col).alias("t")).filter("item IS NOT NULL")
    schema = src.select("item").schema.add("seed", "long").add("size", "integer").add("bound", "integer")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _WordHashes()
        for b in batches:
            rows, seeds, sizes, bounds = [], [], [], []
            for i, t in enumerate(b.column("t")):
                words = words_of(t.as_py())
                size, bound = max(1, min(n, len(words))), bound_of(len(words))
                h = kind_hashes(words, cache, size, bound)
                rows += [i] * len(h)
                seeds.append(h.view(np.int64))
                sizes.append(np.full(len(h), size, np.int32))
                bounds.append(np.full(len(h), bound, np.int32))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [b.column("item").take(pa.array(rows)),
                     *(pa.array(np.concatenate(x)) for x in (seeds, sizes, bounds))], schema=arrow)

    return src.mapInArrow(run, schema)


def _bit_table(seeds: DataFrame) -> bytes:
    """The seeds' bits.  Spark combines them into 64-bit words, so the driver
    gets at most MOST_BITS / 64 rows, as Arrow columns."""
    wanted = BITS_PER_SEED * seeds.select("seed").distinct().count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << max(0, wanted - 1).bit_length()))
    slots = seeds.select(F.explode(F.array(F.col("seed").bitwiseAND(F.lit(bits - 1)),
                                           F.shiftrightunsigned("seed", 32).bitwiseAND(F.lit(bits - 1)))).alias("s"))
    words = (slots.select(F.shiftright("s", 6).alias("w"),
                          F.expr("shiftleft(1L, CAST(s & 63 AS INT))").alias("b"))
             .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
    table = np.zeros(bits // 64, np.int64)
    table[words["w"].to_numpy()] = words["b"].to_numpy()
    return table.tobytes()


def passages(docs: DataFrame, table: bytes, id_col: str, text_col: str, kinds: list[tuple[int, int]]) -> DataFrame:
    """``(id, text_key, start, words, hits)``: the parts of each text around
    words that may be seeds of one of the ``kinds`` (size, bound); hits are their
    hashes.  Hits within two bounds of each other share a passage, which reaches
    as far beyond them."""
    n = max((size for size, _ in kinds), default=0)
    by_bound = {bound: sorted({s for s, b in kinds if b == bound}) for _, bound in kinds}
    src = docs.select(F.col(id_col).alias("id"), text_key(text_col).alias("text_key"), F.col(text_col).alias("t"))
    schema = (src.select("id", "text_key").schema.add("start", "integer").add("words", "string")
              .add("hits", T.ArrayType(T.LongType())))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(table, np.uint8), bitorder="little").view(bool)
        cache = _WordHashes()
        for b in batches:
            rows, starts, texts, hits = [], [], [], []
            for i, t in enumerate(b.column("t")):
                words = words_of(t.as_py())
                for bound, sizes in by_bound.items():
                    at, h = _hits(words, cache, bits, sizes, bound)
                    for lo, hi in _runs(at, bound):
                        first = max(0, int(at[lo]) - 2 * bound)
                        rows.append(i)
                        starts.append(first)
                        texts.append(" ".join(words[first:int(at[hi - 1]) + n + 2 * bound]))
                        hits.append(h[lo:hi].view(np.int64))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(rows)), b.column("text_key").take(pa.array(rows)),
                     pa.array(starts, pa.int32()), pa.array(texts), pa.array(hits, arrow.field("hits").type)],
                    schema=arrow)

    return src.mapInArrow(run, schema)


def _hits(words: list[str], cache: dict, bits: np.ndarray, sizes: list[int], bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions, in order, and hashes of the runs of words that may be seeds."""
    at, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for n in sizes:
        h = kind_hashes(words, cache, n, bound)
        one, two = _slots(h, len(bits))
        hit = np.flatnonzero(bits[one] & bits[two])
        at.append(hit)
        found.append(h[hit])
    places = np.concatenate(at)
    order = np.argsort(places, kind="stable")
    return places[order], np.concatenate(found)[order]


def _runs(at: np.ndarray, bound: int) -> Iterator[tuple[int, int]]:
    """Slices of hit positions that share a passage.  Long runs are cut into
    passages that overlap by four bounds, twice what an alignment spans."""
    if not len(at):
        return
    longest = max(PASSAGE, 8 * bound)
    cuts = np.r_[0, np.flatnonzero(np.diff(at) > 2 * bound) + 1, len(at)]
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        while at[hi - 1] - at[lo] > longest:
            yield lo, int(np.searchsorted(at, at[lo] + longest))
            lo = int(np.searchsorted(at, at[lo] + longest - 4 * bound))
        yield lo, hi


def align(items: list[list[int]], texts: list[list[int]]) -> list[tuple[int, int, int]]:
    """Smith-Waterman of many word sequences at once: (score, item end, text end)
    per pair, the end of the best local alignment (leftmost on ties).

    One step per item word over all pairs.  Within a row, gaps in the text chain
    as a running maximum, since each costs the same.
    """
    rows, width = max(map(len, items)), max(map(len, texts))
    a = np.full((len(items), rows), -1, np.int64)
    b = np.full((len(items), width), -2, np.int64)
    for k, (x, y) in enumerate(zip(items, texts)):
        a[k, :len(x)] = x
        b[k, :len(y)] = y
    climb = -GAP * np.arange(1, width + 1, dtype=np.int32)
    prev = np.zeros((len(items), width + 1), np.int32)
    best = np.zeros(len(items), np.int32)
    end_i, end_j = np.zeros(len(items), np.int32), np.zeros(len(items), np.int32)
    for i in range(rows):
        step = np.where(a[:, i:i + 1] == b, MATCH, MISMATCH).astype(np.int32)
        cell = np.maximum(np.maximum(prev[:, :-1] + step, prev[:, 1:] + GAP), 0)
        cell = np.maximum.accumulate(cell + climb, axis=1) - climb
        top = cell.max(axis=1)
        better = top > best
        if better.any():
            best = np.where(better, top, best)
            end_i = np.where(better, i + 1, end_i)
            end_j = np.where(better, cell.argmax(axis=1) + 1, end_j)
        prev[:, 1:] = cell
    return list(zip(best.tolist(), end_i.tolist(), end_j.tolist()))


def _can_reach(item: list[int], text: list[int], least: float) -> bool:
    """Whether an alignment could score ``least``: no more words can match than
    both hold, each counted as often as it occurs in both."""
    have = Counter(text)
    return MATCH * sum(min(n, have[w]) for w, n in Counter(item).items()) >= least


def _score(batches: Iterator[pd.DataFrame], min_score: float) -> Iterator[pd.DataFrame]:
    for frame in batches:
        keep = []
        frame = frame.reset_index(drop=True)
        seen: dict[str, int] = {}
        number = lambda text: [seen.setdefault(w, len(seen)) for w in text.split(" ")]
        sizes = frame.words.str.count(" ") + 1
        order = sizes.sort_values(kind="stable").index.to_numpy()
        lo = 0
        while lo < len(order):
            # sizes ascend: as many pairs as fill a row of cells with the widest of them
            hi = lo + 1
            while hi < len(order) and (hi + 1 - lo) * sizes[order[hi]] <= CELLS and hi - lo < 128:
                hi += 1
            at, lo = order[lo:hi], hi
            pairs = []
            for k in at:
                text = number(frame.words[k])
                item = number(" ".join(words_of(frame.item_text[k])))
                if _can_reach(item, text, min_score * MATCH * len(item)):
                    pairs.append((k, item, text))
            if not pairs:
                continue
            for (k, item, _), (score, _, end) in zip(pairs, align([p[1] for p in pairs], [p[2] for p in pairs])):
                keep.append((k, score / (MATCH * len(item)), int(frame.start[k]) + end))
        if not keep:
            continue
        got = pd.DataFrame(keep, columns=["k", "score", "end_word"])
        got = got[got.score >= min_score].sort_values(["k", "score"]).drop_duplicates("k", keep="last")
        out = frame.loc[got.k, ["id", "text_key", "item"]].reset_index(drop=True)
        out["score"], out["end_word"] = got.score.to_numpy(), got.end_word.to_numpy()
        yield out


def leaks(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE, seed: int = SEED,
          id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """Documents that hold a copy of a test item, verbatim or edited: one row per
    document and item, ``(id, text_key, item, score, end_word, n_passages)``.

    score is the best local alignment of the item's words with a passage, as a
    share of the score of a perfect copy; end_word is where it ends.  Seeds are
    the items' n-grams: a passage and an item that share one are a pair.  A
    passage's rare seeds, held by at most COMMON items, name its pairs directly.
    A common seed names a pair only together with a word that the passage shares
    with the rarer half of the item's words: a copy that scores half of the item
    has half of its words, so it has one of those, and no leak is lost.

    Items of fewer than n words have one seed of all their words, so they match
    where these stand in a row.  Items without words, NULL texts and NULL item
    ids match nothing; rows that share an id and a text count once; empty tables
    give an empty result.
    """
    spark = docs.sparkSession
    seeds = materialize(item_seeds(items, item_col, item_text, seed), "seeds")
    # at most `seed` sizes times the powers of two up to the longest item
    kinds = sorted((r.size, r.bound) for r in seeds.select("size", "bound").distinct().collect())
    found = materialize(passages(docs, _bit_table(seeds), id_col, text_col, kinds), "passages")
    # passages with equal words have equal scores: the pairs are few even if a
    # passage is in a third of all documents
    texts = materialize(found.groupBy(F.xxhash64("words").alias("p"), F.xxhash64(F.lit("second"), "words").alias("q"))
                        .agg(F.first("words").alias("words"), F.array_distinct(F.flatten(F.collect_set("hits"))).alias("hits"),
                             F.count("*").alias("n")), "passage-texts")
    pairs = seed_pairs(texts, seeds, items.select(F.col(item_col).alias("item"), F.col(item_text).alias("t")), min_score)
    named = items.select(F.col(item_col).alias("item"), F.col(item_text).alias("item_text")).dropDuplicates(["item"])
    ready = (pairs.join(texts.select("p", "q", "words"), ["p", "q"]).join(named, "item")
             .select(F.col("p").alias("id"), F.col("q").alias("text_key"), "item", "item_text", "words",
                     F.lit(0).alias("start")))
    kind = dict(items.dtypes)[item_col]
    scored = materialize(ready.repartition("id", "item").mapInPandas(
        lambda it: _score(it, min_score), f"id long, text_key long, item {kind}, score double, end_word long")
        .select(F.col("id").alias("p"), F.col("text_key").alias("q"), "item", "score", "end_word"), "scored")
    return _by_document(spark, found, texts, scored)


def seed_pairs(texts: DataFrame, seeds: DataFrame, items: DataFrame, min_score: float) -> DataFrame:
    """``(p, q, item)``: distinct passages and the items that they share a seed
    with, the common seeds with a word (see ``leaks``)."""
    grams = seeds.select("seed", "item").distinct()
    held = materialize(grams.join(grams.groupBy("seed").agg(F.count("*").alias("items")).hint("merge"), "seed"), "grams")
    hits = texts.select("p", "q", F.explode("hits").alias("seed"))
    rare = hits.join(held.filter(F.col("items") <= COMMON).hint("merge"), "seed").select("p", "q", "item")
    common = held.filter(F.col("items") > COMMON)
    kind = dict(items.dtypes)["item"]

    def rarer_words(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for r in frame.itertuples():
                words = sorted(r.w, key=lambda x: (x["items"], x["word"]))
                left = (1 - min_score) * sum(x["times"] for x in words)
                for x in words:  # words that a leaking copy may all lack, and the next one
                    rows.append((r.item, x["word"]))
                    left -= x["times"]
                    if left < 0:
                        break
            yield pd.DataFrame(rows, columns=["item", "word"])

    # only of items that hold a common seed; an item's words are one value, as its text is
    bare = items.dropDuplicates(["item"]).join(common.select("item").distinct().hint("merge"), "item")
    split = F.pandas_udf(lambda t: t.map(words_of), "array<string>")
    word_rows = bare.select("item", F.explode(split("t")).alias("word")).groupBy("item", "word").agg(F.count("*").alias("times"))
    spread = word_rows.groupBy("word").agg(F.count("*").alias("items"))
    listed = word_rows.join(spread.hint("merge"), "word").groupBy("item").agg(
        F.collect_list(F.struct("word", "items", "times")).alias("w"))
    needed = listed.mapInPandas(rarer_words, f"item {kind}, word string")
    wanted = materialize(common.select("seed", "item").join(needed.hint("merge"), "item"), "common-seeds")
    said = (hits.join(wanted.select("seed").distinct().hint("merge"), "seed")
            .join(texts.select("p", "q", F.array_distinct(F.split("words", " ")).alias("ws")).hint("merge"), ["p", "q"])
            .select("p", "q", "seed", F.explode("ws").alias("word")))
    both = said.join(wanted.hint("merge"), ["seed", "word"]).select("p", "q", "item")
    return rare.unionByName(both).distinct()


def _by_document(spark, found: DataFrame, texts: DataFrame, scored: DataFrame) -> DataFrame:
    rows = found.select("id", "text_key", "start", F.xxhash64("words").alias("p"),
                        F.xxhash64(F.lit("second"), "words").alias("q"))
    per_text = (scored.groupBy("p", "q").agg(F.collect_list(F.struct("item", "score", "end_word")).alias("found"))
                .join(texts.select("p", "q", "n"), ["p", "q"]))
    per_text = materialize(per_text, "leak-texts")
    total = (texts.agg(F.sum("n")).first()[0] or 0)
    hit = join_dimension(rows, per_text, ["p", "q"], "n", total).filter("found IS NOT NULL")
    each = hit.select("id", "text_key", "start", F.explode("found").alias("f"))
    best = F.max(F.struct(F.col("f.score").alias("score"), (F.col("start") + F.col("f.end_word")).alias("end_word")))
    return (each.groupBy("id", "text_key", F.col("f.item").alias("item"))
            .agg(best.alias("b"), F.countDistinct("start").alias("n_passages"))
            .select("id", "text_key", "item", F.col("b.score").alias("score"),
                    F.col("b.end_word").alias("end_word"), "n_passages"))


def drop_leaking(docs: DataFrame, items: DataFrame, min_score: float = MIN_SCORE, id_col: str = "doc_id",
                 text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that hold no copy of a test item."""
    bad = leaks(docs, items, min_score, id_col=id_col, text_col=text_col, **options)
    bad = materialize(bad.select("id", "text_key").distinct(), "leaking")
    return join_by_document(docs, bad, "left_anti", id_col, text_col)
