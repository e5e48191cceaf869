"""Exact substring dedup with suffix arrays.

A byte goes if a string of LENGTH bytes that covers it also starts elsewhere.

1. Every window of LENGTH bytes is assigned to the smallest hash among its
   GRAM-byte grams (its anchor); equal windows have equal anchors.  The windows
   of one anchor occurrence lie side by side and make a segment.
2. Spark groups the segments by anchor.  An anchor that occurs once holds no
   repeated window.  A segment whose bytes occur twice is repeated as a whole.
   Only segments that share an anchor but not all bytes remain open.
3. Shards of open segments build suffix arrays (Larsson-Sadakane refinement)
   and common prefixes (Kasai).  Windows with a common prefix of LENGTH form a
   class; each shard sends one fingerprint per class, in sorted ranges, and the
   ranges of all shards are merged by binary search.

Passages of PASSAGE words that another document has too may be shorter than
LENGTH bytes.  They are reported, not removed: steps 1 and 2 on words instead of
bytes, then the windows of what remains open are counted by fingerprint, in the
task of their anchor or, for anchors that are split, by one more shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import join_dimension, materialize

LENGTH = 400
GRAM = 64
#: Words of a reported passage, and of the grams that anchor it.
PASSAGE = 51
WORD_GRAM = 13
#: Bytes of a text that are hashed at once.
PIECE = 1 << 19
#: Bytes of open segments in one suffix array.
SHARD = 1 << 20
#: Fingerprints that one merging task holds, about.
RANGE = 2_000_000
#: Longest run of text positions that one Kasai lane walks.
LANE = 1024

_rng = np.random.default_rng(20240229)
_CODES = _rng.integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = [_powers(b, PIECE + LENGTH) for b in _BASES]
_INVERSE = [_powers(pow(b, -1, 1 << 64), PIECE + LENGTH) for b in _BASES]


def rolling(data: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Hash of every ``width`` bytes (or 64-bit codes) of at most PIECE + LENGTH."""
    codes = _CODES[which][data] if data.dtype == np.uint8 else data
    terms = codes * _POWERS[which][:len(data)]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
    out = (total[width:] - total[:-width]) * _INVERSE[which][:len(data) - width + 1]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours, by doubling."""
    out, span = x, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def segments(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int]]:
    """(anchor hash, first window, last window) of a text's segments, in order.

    The anchor is the leftmost of the smallest grams: the hash in the high bits
    of a key, the position in the low ones.
    """
    for lo in range(0, max(0, len(data) - length + 1), PIECE):
        part = data[lo:lo + PIECE + length - 1]
        h = rolling(part, gram)
        key = (h & ~np.uint64((1 << 20) - 1)) | np.arange(len(h), dtype=np.uint64)
        least = _sliding_min(key, length - gram + 1)
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        last = np.concatenate([first[1:], [len(least)]]) - 1
        anchors = h[(least[first] & np.uint64((1 << 20) - 1)).astype(np.int64)].view(np.int64)
        yield from zip(anchors.tolist(), (first + lo).tolist(), (last + lo).tolist())


def words(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit codes of the words, their first bytes and the bytes after them."""
    inside = np.concatenate([[False], ~_SPACE[np.frombuffer(raw, np.uint8)], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, raw.split()), np.uint64, len(edge) // 2)
    return codes, edge[::2], edge[1::2]


def byte_segments(raw: pa.BinaryScalar) -> Iterator[tuple[int, int, int, int]]:
    """(anchor, hash of the bytes, first window, last window)."""
    data = raw.as_buffer()
    view = memoryview(data)
    for a, first, last in segments(np.frombuffer(data, np.uint8)):
        yield a, xxhash.xxh3_64_intdigest(view[first:last + LENGTH]), first, last


def word_segments(raw: pa.BinaryScalar) -> Iterator[tuple[int, int, int, int]]:
    """The same for windows of PASSAGE words: hash of the words, first byte and,
    as if a window of LENGTH bytes began there, last byte less LENGTH."""
    codes, start, end = words(raw.as_py())
    view = memoryview(codes.view(np.uint8))
    for a, first, last in segments(codes, PASSAGE, WORD_GRAM):
        stop = last + PASSAGE
        yield a, xxhash.xxh3_64_intdigest(view[8 * first:8 * stop]), int(start[first]), int(end[stop - 1]) - LENGTH


# -- suffix arrays ------------------------------------------------------------

def _group_starts(new: np.ndarray) -> np.ndarray:
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def suffix_array(buf: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, same, words): the suffixes sorted by at least ``depth`` bytes;
    whether each shares half of them with its predecessor; 8 bytes per position.

    Larsson-Sadakane: groups of equal prefixes are split by the rank of the
    suffix one prefix length later, which doubles the prefix; suffixes alone in
    their group are settled and leave the work.
    """
    n = len(buf)
    wide = np.concatenate([buf, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = np.zeros(n, np.uint64)
    for k in range(8):
        words |= wide[k:n + k] << np.uint64(56 - 8 * k)
    order = np.argsort(words, kind="stable")
    key = words[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = _group_starts(new), -1
    at = np.flatnonzero(~(new & np.concatenate([new[1:], [True]])))
    half, h = None, 8
    while h < depth:
        if 2 * h >= depth and half is None:
            half = rank[:n].copy()
        if len(at):
            sub = order[at]
            pair = rank[sub] * (n + 2) + rank[np.minimum(sub + h, n)] + 1
            o = np.argsort(pair, kind="stable")
            sub, pair = sub[o], pair[o]
            order[at] = sub
            new = np.concatenate([[True], pair[1:] != pair[:-1]])
            rank[sub] = at[_group_starts(new)]
            at = at[~(new & np.concatenate([new[1:], [True]]))]
        h *= 2
    same = np.concatenate([[False], half[order[1:]] == half[order[:-1]]])
    return order, same, words


def common_prefixes(buf_words: np.ndarray, order: np.ndarray, same: np.ndarray, most: int) -> np.ndarray:
    """Kasai: for each suffix in ``order`` that is marked in ``same`` the prefix
    it shares with its predecessor, up to ``most`` bytes; zero for the others.

    The next text position shares at most one byte less with its predecessor,
    if the predecessor's own next suffix comes before it.
    Runs of positions are walked in step, as lanes, eight bytes at a time.
    """
    n = len(order)
    place = np.empty(n + 1, np.int64)
    place[order], place[n] = np.arange(n), n
    lcp = np.zeros(n, np.int32)
    need = np.flatnonzero(same[place[:n]])
    if not len(need):
        return lcp
    words = np.concatenate([buf_words, np.zeros(most + 16, np.uint64)])
    run = np.cumsum(np.concatenate([[0], np.diff(need) > 1]))
    first = np.flatnonzero(np.concatenate([[True], np.diff(run) > 0]))
    size = np.diff(np.concatenate([first, [len(need)]]))
    lanes = [(s + k, min(LANE, m - k)) for s, m in zip(need[first].tolist(), size.tolist()) for k in range(0, m, LANE)]
    lanes.sort(key=lambda x: -x[1])
    start, length = (np.array(x, np.int64) for x in zip(*lanes))
    shared = np.zeros(len(lanes), np.int64)
    steps = np.uint64(1) << np.arange(8, 64, 8, dtype=np.uint64)
    for t in range(int(length[0])):
        m = int(np.searchsorted(-length, -t, side="left"))
        i = start[:m] + t
        r = place[i]
        j = order[r - 1]
        h = shared[:m]
        if t:  # suffixes equal beyond the sorted depth may stand in any order
            h[place[before[:m] + 1] > r] = 0
        before = j
        go = np.flatnonzero(h < most)
        while len(go):
            x = words[i[go] + h[go]] ^ words[j[go] + h[go]]
            equal = x == 0
            apart = go[~equal]
            h[apart] += 7 - np.searchsorted(steps, x[~equal], side="right")
            go = go[equal]
            h[go] += 8
            go = go[h[go] < most]
        lcp[r] = np.minimum(h, most)
        shared[:m] = np.maximum(lcp[r] - 1, 0)
    return lcp


def window_classes(buf: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """A class per position: equal for positions whose next ``length`` bytes are."""
    order, same, words = suffix_array(buf, length)
    lcp = common_prefixes(words, order, same, length)
    out = np.empty(len(buf), np.int64)
    out[order] = np.cumsum(lcp < length)
    return out


# -- Spark --------------------------------------------------------------------

#: Distinct segments of one anchor beyond which it is split over shards.
SPLIT = 500


def _text_keys(text: Column) -> list:
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2")]


def all_segments(docs: DataFrame, text_col: str, split=byte_segments) -> DataFrame:
    """``(anchor, bytes_hash, t1, t2, first, last)``: every segment of every text.
    t1, t2 name the text by its content, so equal texts share all results."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(*_text_keys(text), F.encode(text, "utf-8").alias("raw"))
    schema = T.StructType().add("anchor", "long").add("bytes_hash", "long").add("t1", "long").add("t2", "long") \
        .add("first", "integer").add("last", "integer")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, anchors, firsts, lasts, hashes = [], [], [], [], []
            for i, raw in enumerate(b.column("raw")):
                for a, h, first, last in split(raw):
                    rows.append(i)
                    anchors.append(a)
                    hashes.append(h)
                    firsts.append(first)
                    lasts.append(last)
            if rows:
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors, pa.int64()), pa.array(np.array(hashes, np.uint64).view(np.int64)),
                     b.column("t1").take(at), b.column("t2").take(at), pa.array(firsts, pa.int32()),
                     pa.array(lasts, pa.int32())], schema=arrow)

    return src.mapInArrow(run, schema)


def _runs(starts: np.ndarray) -> list[dict]:
    """Ascending numbers as runs {a, b} (both included)."""
    cut = np.flatnonzero(np.diff(starts) > 1)
    return [{"a": int(a), "b": int(b)} for a, b in zip(starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])])]


RUNS = T.ArrayType(T.StructType().add("a", "integer").add("b", "integer"))
#: What a shard emits: repeated windows of a text (t1, t2, runs), or a range of
#: its class fingerprints of split anchors, sorted, with the windows they stand for.
SHARD_ROWS = (T.StructType().add("t1", "long").add("t2", "long").add("runs", RUNS).add("range", "integer")
              .add("high", "binary").add("low", "binary").add("w1", "binary").add("w2", "binary").add("at", "binary"))


def shard_rows(rows: list[tuple], ranges: int) -> Iterator[dict]:
    """One suffix array over open segments: rows of (t1, t2, first, last, lone,
    split, raw)."""
    buf = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
    classes = window_classes(buf)
    size = np.array([len(r[6]) for r in rows])
    offset = np.cumsum(size) - size
    n = size - LENGTH + 1
    row = np.repeat(np.arange(len(rows)), n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = offset[row] + within
    _, cls, count = np.unique(classes[at], return_inverse=True, return_counts=True)
    again = count[cls] > 1
    edge = np.concatenate([[0], np.cumsum(n)])
    for k in np.unique(row[again]).tolist():
        if rows[k][4]:
            cut = slice(int(edge[k]), int(edge[k + 1]))
            yield {"t1": rows[k][0], "t2": rows[k][1], "runs": _runs(within[cut][again[cut]] + rows[k][2])}
    split = np.array([r[5] for r in rows])[row]
    if not split.any():
        return
    # one window stands for its class; the others are repeated already
    lead = np.zeros(len(count), np.int64)
    lead[cls[::-1]] = np.arange(len(cls))[::-1]
    lead = lead[split[lead]]
    high = np.empty(len(lead), np.uint64)
    low = np.empty(len(lead), np.uint64)
    view = memoryview(buf)
    for i, p in enumerate(at[lead].tolist()):
        h = xxhash.xxh3_128_intdigest(view[p:p + LENGTH])
        high[i], low[i] = h >> 64, h & ((1 << 64) - 1)
    order = np.lexsort((low, high))
    high, low, lead = high[order], low[order], lead[order]
    t1 = np.array([r[0] for r in rows], np.int64)[row[lead]]
    t2 = np.array([r[1] for r in rows], np.int64)[row[lead]]
    first = np.array([r[2] for r in rows], np.int64)[row[lead]]
    lone = np.array([r[4] for r in rows])[row[lead]]
    start = np.where(lone, within[lead] + first, -1).astype(np.int32)
    bounds = [int(k * (1 << 64) // ranges) for k in range(1, ranges)]
    cuts = [0, *np.searchsorted(high, np.array(bounds, np.uint64)).tolist(), len(high)]
    for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        if hi > lo:
            yield {"range": k, "high": high[lo:hi].tobytes(), "low": low[lo:hi].tobytes(), "w1": t1[lo:hi].tobytes(),
                   "w2": t2[lo:hi].tobytes(), "at": start[lo:hi].tobytes()}


def merge_range(frame: pd.DataFrame) -> pd.DataFrame:
    """Windows of one fingerprint range that more than one shard holds, found by
    binary search of each shard's sorted list in all of them."""
    parts = [[np.frombuffer(x, t) for x, t in zip((r.high, r.low, r.w1, r.w2, r.at), (np.uint64, np.uint64, np.int64, np.int64, np.int32))]
             for r in frame.itertuples()]
    every = np.sort(np.concatenate([p[0] for p in parts]))
    values = every[np.concatenate([[True], every[1:] != every[:-1]])]
    # 96 bits in one sortable number: the rank of the high half, 32 bits of the low
    joined = [(np.searchsorted(values, p[0]).astype(np.uint64) << np.uint64(32)) | (p[1] >> np.uint64(32)) for p in parts]
    all_ = np.sort(np.concatenate(joined))
    out = []
    for p, key in zip(parts, joined):
        times = np.searchsorted(all_, key, "right") - np.searchsorted(all_, key, "left")
        hit = (times > 1) & (p[4] >= 0)
        out.append(pd.DataFrame({"t1": p[2][hit], "t2": p[3][hit], "at": p[4][hit]}))
    return pd.concat(out)


def _shards(open_: DataFrame, ranges: int) -> DataFrame:
    """Rows of (anchor, salt, t1, t2, first, last, lone, split, raw), dealt by
    anchor and salt, through suffix arrays of about SHARD bytes."""
    arrow = to_arrow_schema(SHARD_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("anchor", "salt", "t1", "t2", "first", "last", "lone", "split", "raw")]
            for anchor, salt, *r in zip(*cols):
                if size >= SHARD and (anchor, salt) != last:
                    yield pa.RecordBatch.from_pylist(list(shard_rows(held, ranges)), schema=arrow)
                    held, size = [], 0
                held.append(tuple(r))
                size += len(r[-1])
                last = (anchor, salt)
        if held:
            yield pa.RecordBatch.from_pylist(list(shard_rows(held, ranges)), schema=arrow)

    return open_.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt").mapInArrow(run, SHARD_ROWS)


def _shared(segs: DataFrame) -> tuple[DataFrame, int]:
    """Segments whose anchor occurs again, and their number."""
    anchors = materialize(segs.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
                          .withColumn("shared", F.lit(True)), "anchors")
    total = anchors.agg(F.sum("n")).first()[0] or 0
    return join_dimension(segs, anchors, ["anchor"], "n", total).filter("shared").drop("shared"), total


def _cut(docs: DataFrame, open_: DataFrame, text_col: str) -> DataFrame:
    """The rows of ``open_`` with ``raw``, their bytes ``first`` to ``last`` +
    LENGTH of the text t1, t2."""
    rest = [c for c in open_.columns if c not in ("t1", "t2")]
    wanted = open_.groupBy("t1", "t2").agg(F.collect_list(F.struct(*rest)).alias("s"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(*_text_keys(text), text.alias("text")).join(materialize(wanted, "wanted").hint("merge"), ["t1", "t2"])
    # a segment open for one text is open once, however many rows hold the text
    return (texts.select("t1", "t2", "text", "s").dropDuplicates(["t1", "t2"])
            .select("t1", "t2", F.encode("text", "utf-8").alias("raw"), F.explode("s").alias("s"))
            .select("t1", "t2", "s.*", F.substring("raw", F.col("s.first") + 1, F.col("s.last") - F.col("s.first") + LENGTH).alias("raw")))


def repeated_windows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(t1, t2, runs)`` per text with repeats: runs of window starts whose
    LENGTH bytes also start elsewhere."""
    segs = materialize(all_segments(docs, text_col), "segments")
    shared, total = _shared(segs)
    shared = materialize(shared, "shared")
    rep = F.min(F.struct("t1", "t2", "first", "last")).alias("rep")
    kinds = materialize(shared.groupBy("anchor", "bytes_hash").agg(F.count("*").alias("n"), rep), "segment-kinds")
    whole = join_dimension(shared, kinds.filter("n > 1").select("anchor", "bytes_hash", "n", F.lit(True).alias("whole")),
                           ["anchor", "bytes_hash"], "n", total).filter("whole")
    several = materialize(kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).filter("kinds > 1"), "open-anchors")
    open_ = (kinds.join(several.hint("merge"), "anchor")
             .select("anchor", F.pmod("bytes_hash", F.ceil(F.col("kinds") / SPLIT)).alias("salt"), "rep.*",
                     (F.col("n") == 1).alias("lone"), (F.col("kinds") > SPLIT).alias("split")))
    split = several.filter(F.col("kinds") > SPLIT).agg(F.sum("kinds")).first()[0] or 0
    ranges = int(split * 150 // RANGE) + 1
    done = materialize(_shards(_cut(docs, open_, text_col), ranges), "shards")
    found = [whole.select("t1", "t2", F.array(F.struct(F.col("first").alias("a"), F.col("last").alias("b"))).alias("runs")),
             done.filter("range IS NULL").select("t1", "t2", "runs")]
    if split:
        merged = done.filter("range IS NOT NULL").groupBy("range").applyInPandas(
            merge_range, "t1 long, t2 long, at int")
        found.append(merged.select("t1", "t2", F.array(F.struct(F.col("at").alias("a"), F.col("at").alias("b"))).alias("runs")))
    union = found[0]
    for f in found[1:]:
        union = union.unionByName(f)
    # equal texts have equal rows here: a set keeps one of each
    return union.select("t1", "t2", F.explode("runs").alias("r")).groupBy("t1", "t2").agg(F.collect_set("r").alias("runs"))


#: Repeated runs of a text, or (with h1, h2) one window of a split anchor.
PASSAGE_ROWS = T.StructType([T.StructField(c, T.LongType()) for c in ("h1", "h2", "t1", "t2")]) \
    .add("first", "integer").add("last", "integer").add("lone", "boolean")
#: Segments whose words are hashed at once, about: under PIECE words.
ROWS = 2000


def passage_rows(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (t1, t2, first, lone, split, raw): whole anchors, or shares of
    split ones, whose windows are left to be counted over all shares."""
    texts1, texts2, firsts, lones, splits = (np.array(x) for x in list(zip(*rows))[:5])
    raws = [r[5] for r in rows]
    codes, start, end = words(b" ".join(raws))
    edge = np.cumsum([0, *(len(r) + 1 for r in raws[:-1])])
    row = np.searchsorted(edge, start, "right") - 1
    at = np.flatnonzero(row[:1 - PASSAGE] == row[PASSAGE - 1:])
    row = row[at]
    h1, h2 = (rolling(codes, PASSAGE, w)[at] for w in (0, 1))
    t1, t2, lone, split = texts1[row], texts2[row], lones[row], splits[row]
    shift = firsts[row] - edge[row]
    first, last = start[at] + shift, end[at + PASSAGE - 1] + shift - LENGTH
    order = np.lexsort((h2, h1))
    new = np.concatenate([[True], (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)])
    group = np.flatnonzero(new)
    across = ~np.logical_and.reduceat(lone[order], group)
    for t in (t1, t2):
        across |= np.minimum.reduceat(t[order], group) != np.maximum.reduceat(t[order], group)
    hit = np.empty(len(order), bool)
    hit[order] = across[np.cumsum(new) - 1]
    hit &= lone & ~split
    # neighbouring windows of one segment make a run
    begin = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1] & (row[1:] == row[:-1])]))
    stop = np.flatnonzero(hit & ~np.concatenate([hit[1:] & (row[1:] == row[:-1]), [False]]))
    left = np.flatnonzero(split)
    x, y = np.concatenate([begin, left]), np.concatenate([stop, left])
    settled = np.arange(len(x)) < len(begin)
    return pa.RecordBatch.from_arrays(
        [pa.array(h1[x].view(np.int64), mask=settled), pa.array(h2[x].view(np.int64), mask=settled), pa.array(t1[x]), pa.array(t2[x]),
         pa.array(first[x].astype(np.int32)), pa.array(last[y].astype(np.int32)), pa.array(lone[x])],
        schema=to_arrow_schema(PASSAGE_ROWS))


def _passages(cut: DataFrame) -> DataFrame:
    """Rows of (anchor, salt, t1, t2, first, lone, split, raw), dealt by anchor
    and salt."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("anchor", "salt", "t1", "t2", "first", "lone", "split", "raw")]
            for anchor, salt, *r in zip(*cols):
                if len(held) >= ROWS and (anchor, salt) != last:
                    yield passage_rows(held)
                    held = []
                held.append(r)
                last = (anchor, salt)
        if held:
            yield passage_rows(held)

    return cut.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt").mapInArrow(run, PASSAGE_ROWS)


def shared_passages(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(t1, t2, passages)`` per text with windows of PASSAGE words that another
    document has too, white space aside: runs of first byte to last byte less
    LENGTH.  Documents with equal texts are others of each other."""
    segs = materialize(all_segments(docs, text_col, word_segments), "passage-segments")
    shared, total = _shared(segs)
    places = materialize(shared.groupBy("anchor", "bytes_hash", "t1", "t2", "first", "last")
                         .agg(F.count("*").alias("rows")), "passage-places")
    apart = (F.min("t1") < F.max("t1")) | (F.min("t2") < F.max("t2"))
    kinds = materialize(places.groupBy("anchor", "bytes_hash").agg(
        F.count("*").alias("n"), (apart | (F.max("rows") > 1)).alias("across"),
        F.min(F.struct("t1", "t2", "first", "last")).alias("rep")), "passage-kinds")
    # a kind of several documents is settled; one of its places stands for it
    several = materialize(kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum(F.when(F.col("across"), 1).otherwise(F.col("n"))).alias("open"))
                          .filter("kinds > 1"), "open-passages")
    kinds = join_dimension(kinds, several, ["anchor"], "kinds", total)
    found = materialize(join_dimension(places, kinds, ["anchor", "bytes_hash"], "n", total), "passages-found")
    place = F.struct("t1", "t2", "first", "last")
    open_ = found.filter(F.col("open").isNotNull() & (~F.col("across") | (F.col("rep") == place))) \
        .select("anchor", F.pmod(F.xxhash64(place), F.ceil(F.col("open") / SPLIT)).alias("salt"), "t1", "t2", "first", "last",
                (~F.col("across")).alias("lone"), (F.col("open") > SPLIT).alias("split"))
    done = materialize(_passages(_cut(docs, open_, text_col)), "passage-rows")
    wins = done.filter("h1 IS NOT NULL")
    again = wins.groupBy("h1", "h2").agg(F.count("*").alias("n"), (apart | ~F.bool_and("lone")).alias("across")).filter("across")
    hit = join_dimension(wins.filter("lone"), materialize(again, "passages-again"), ["h1", "h2"], "n", wins.count()).filter("across")
    runs = [f.select("t1", "t2", F.struct(F.col("first").alias("a"), F.col("last").alias("b")).alias("r"))
            for f in (found.filter("across"), done.filter("h1 IS NULL"), hit)]
    return runs[0].unionByName(runs[1]).unionByName(runs[2]).groupBy("t1", "t2").agg(F.collect_set("r").alias("passages"))


def remove_repeats(docs: DataFrame, keep: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` (all by default) and ``kept`` (the remaining bytes),
    ``n_bytes``, ``n_removed`` and ``n_spans`` (maximal removed runs).
    ``n_passages`` and ``n_passage_bytes`` count the stretches of PASSAGE words
    or more that another document has too; they are removed only as far as the
    bytes repeat.

    Texts are UTF-8 bytes, NULL and empty ones none.  Repeated rows repeat each
    other and ids play no part, so NULL ids are fine.  A column of ``docs``
    named like a new one is replaced; an empty table gives an empty result.
    """
    new = ("kept", "n_bytes", "n_removed", "n_spans", "n_passages", "n_passage_bytes")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    runs = materialize(repeated_windows(docs, text_col), "repeats")
    passages = materialize(shared_passages(docs, text_col), "passages")
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.struct(*keep).alias("row"), *_text_keys(text), F.encode(text, "utf-8").alias("raw"))
    joined = (src.join(runs.hint("merge"), ["t1", "t2"], "left").join(passages.hint("merge"), ["t1", "t2"], "left")
              .select("row", "raw", "runs", "passages"))
    schema = docs.select(F.struct(*keep).alias("row")).schema.add("kept", "binary").add("n_bytes", "long") \
        .add("n_removed", "long").add("n_spans", "long").add("n_passages", "long").add("n_passage_bytes", "long")
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, size, gone, spans, parts, within = [], [], [], [], [], []
            for raw, runs, passages in zip(b.column("raw"), b.column("runs"), b.column("passages")):
                raw = raw.as_py()
                left, at, n = [], 0, 0
                for a, e in covered(runs.as_py() or []):
                    left.append(raw[at:a])
                    at, n = e, n + 1
                left.append(raw[at:])
                kept.append(b"".join(left))
                size.append(len(raw))
                gone.append(len(raw) - len(kept[-1]))
                spans.append(n)
                sizes = [e - a for a, e in covered(passages.as_py() or [])]
                parts.append(len(sizes))
                within.append(sum(sizes))
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(kept, pa.binary()), pa.array(size, pa.int64()),
                                              pa.array(gone, pa.int64()), pa.array(spans, pa.int64()),
                                              pa.array(parts, pa.int64()), pa.array(within, pa.int64())], schema=arrow)

    return joined.mapInArrow(cut, schema).select("row.*", *new)


def covered(runs: list[dict]) -> Iterator[tuple[int, int]]:
    """Maximal byte ranges that windows starting in the runs cover."""
    start = end = -1
    for r in sorted(runs, key=lambda r: r["a"]):
        if r["a"] > end:
            if end > start:
                yield start, end
            start = r["a"]
        end = max(end, r["b"] + LENGTH)
    if end > start:
        yield start, end
