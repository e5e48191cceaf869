"""Periodic runs of words: the maximal pairs of a text whose distance is small
against their length are exactly its runs.

A task builds one suffix array over the words of many texts (words of different
texts never agree) and walks its LCP-interval tree bottom-up.  Every node keeps
its positions, in lists by the word on their left; two positions below
different children whose left words differ are a maximal pair.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import fresh_name, ship_package

#: A run has at least so many words, and so many periods.
MIN_WORDS, MIN_COPIES = 6, 4
#: Words whose texts share one suffix array (a longer text has one of its own).
CHUNK = 200_000


def least_common(min_words: int, min_copies: int) -> int:
    """The shortest common prefix that a pair of any distance needs."""
    return min(max(min_words, min_copies * p) - p for p in range(1, min_words + 2))


class Suffixes:
    """Suffix array of ``codes`` by prefix doubling of the groups that are not
    yet single (Larsson and Sadakane), and the common prefixes of neighbours.

    ``levels[k]`` ranks all positions by their first ``2**k`` codes, equal for
    equal ones.  Memory: four bytes a word and level, one level for each
    doubling up to the longest repeat.
    """

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        order = np.argsort(codes, kind="stable").astype(np.int64)
        active, group = order, codes[order]
        rank = np.full(n + 1, -1, np.int32)
        base, old = np.arange(n), None
        self.levels: list[np.ndarray] = []
        span = 1
        while True:
            # base: the slot of the first suffix of the old group; group: the key that splits it
            new = np.r_[True, group[1:] != group[:-1]] if len(active) else np.zeros(0, bool)
            if old is not None and len(active):
                new |= np.r_[True, old[1:] != old[:-1]]
            first = np.maximum.accumulate(np.where(new, np.arange(len(active)), 0)) if len(active) else base[:0]
            rank = rank.copy()
            rank[active] = base[first]
            self.levels.append(rank)
            single = new & np.r_[new[1:], True] if len(active) else new
            keep = ~single
            active, base = active[keep], base[keep]
            if not len(active):
                break
            old = rank[active]
            after = rank[np.minimum(active + span, n)]
            by = np.lexsort((after, old))
            active, group, old = active[by], after[by], old[by]
            span *= 2
        self.sa = np.empty(n, np.int64)
        self.sa[rank[:n]] = np.arange(n)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Lengths of the common prefixes of positions ``a`` and ``b`` (a != b)."""
        done = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            done += (self.levels[k][a + done] == self.levels[k][b + done]).astype(np.int64) << k
        return done


class Bag:
    """Positions below a node, in order, and in lists by left word."""

    __slots__ = ("at", "by_left")

    def __init__(self, pos: int, left: int):
        self.at, self.by_left = [pos], {left: [pos]}

    def pairs(self, pos: int, left: int, reach: int) -> Iterator[int]:
        """Positions at most ``reach`` away with another left word: read from
        the window or from the lists of the other words, whichever is shorter."""
        lo, hi = bisect_left(self.at, pos - reach), bisect_right(self.at, pos + reach)
        if hi <= lo:
            return
        own = self.by_left.get(left, ())
        if hi - lo <= len(self.by_left):
            same = set(own[bisect_left(own, pos - reach):bisect_right(own, pos + reach)])
            yield from (x for x in self.at[lo:hi] if x not in same)
            return
        for word, places in self.by_left.items():
            if word != left:
                yield from places[bisect_left(places, pos - reach):bisect_right(places, pos + reach)]

    def add(self, pos: int, left: int) -> None:
        insort(self.at, pos)
        insort(self.by_left.setdefault(left, []), pos)

    def items(self) -> Iterator[tuple[int, int]]:
        return ((x, word) for word, places in self.by_left.items() for x in places)


def maximal_pairs(at: list[int], common: list[int], left: list[int], min_words: int,
                  min_copies: int) -> Iterator[tuple[int, int, int]]:
    """``(start, length, distance)`` of the maximal pairs of one subtree that
    satisfy the length constraints.

    ``at``: positions in suffix order; ``common[k]``: prefix that at[k - 1] and
    at[k] share; ``left[k]``: the word before at[k].  The smaller side of each
    merge looks up its partners in the larger one.
    """
    found: list[tuple[int, int, int]] = []

    def join(a: Bag, b: Bag, depth: int) -> Bag:
        big, small = (a, b) if len(a.at) >= len(b.at) else (b, a)
        reach = depth // (min_copies - 1)
        moved = list(small.items())
        for x, word in moved:
            for y in big.pairs(x, word, reach):
                p = abs(x - y)
                if p + depth >= min_words:
                    found.append((min(x, y), p + depth, p))
        for x, word in moved:
            big.add(x, word)
        return big

    stack: list[tuple[int, Bag]] = []
    now = Bag(at[0], left[0])
    for k in range(1, len(at)):
        depth = common[k]
        while stack and stack[-1][0] >= depth:
            d, bag = stack.pop()
            now = join(bag, now, d)
        stack.append((depth, now))
        now = Bag(at[k], left[k])
    while stack:
        d, bag = stack.pop()
        now = join(bag, now, d)
    yield from found


def word_runs(codes: np.ndarray, starts: np.ndarray, min_words: int = MIN_WORDS,
              min_copies: int = MIN_COPIES) -> dict[tuple[int, int], int]:
    """``(start, length) -> smallest period`` of all runs of ``codes``.

    ``starts`` are the first positions of texts; codes of different texts must
    differ.  The smallest distance of the pairs with one extent is its period:
    with four (or two) copies a longer one is a multiple of it.
    """
    least = least_common(min_words, min_copies)
    runs: dict[tuple[int, int], int] = {}
    if len(codes) < min_words:
        return runs
    tree = Suffixes(codes)
    k = max(x for x in range(len(tree.levels)) if 1 << x <= least)
    near = tree.levels[k]
    a, b = tree.sa[:-1], tree.sa[1:]
    slots = np.flatnonzero(near[a] == near[b]) + 1
    common = np.zeros(len(codes) + 1, np.int64)
    common[slots] = tree.common(tree.sa[slots - 1], tree.sa[slots])
    common[common < least] = 0
    slots = np.flatnonzero(common)
    if not len(slots):
        return runs
    # subtrees below depth `least`: slots first..last of consecutive shared prefixes
    cut = np.r_[True, np.diff(slots) > 1]
    first = slots[cut] - 1
    last = slots[np.r_[cut[1:], True]]
    left_word = np.r_[-1, codes[:-1]].astype(np.int64)
    left_word[starts[starts < len(codes)]] = -1
    size = last - first + 1
    member = np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    tree_of = np.repeat(np.arange(len(first)), size)
    pos = tree.sa[member]
    heads = np.cumsum(size) - size
    lefts = left_word[pos]
    # without two left words, or two positions as near as its deepest node asks, a subtree has no such pair
    mixed = np.minimum.reduceat(lefts, heads) != np.maximum.reduceat(lefts, heads)
    deepest = np.maximum.reduceat(np.where(np.isin(member, first), 0, common[member]), heads)
    by = np.lexsort((pos, tree_of))
    gap = np.r_[np.iinfo(np.int64).max, np.diff(pos[by])]
    gap[heads] = np.iinfo(np.int64).max
    close = np.minimum.reduceat(gap, heads) <= deepest // (min_copies - 1)
    for t in np.flatnonzero(mixed & close):
        here = slice(heads[t], heads[t] + size[t])
        for start, length, period in maximal_pairs(pos[here].tolist(), common[member[here]].tolist(),
                                                   lefts[here].tolist(), min_words, min_copies):
            key = (start, length)
            if period < runs.get(key, length):
                runs[key] = period
    return runs


def _chunks(words: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about CHUNK words together."""
    lo = total = 0
    for k, w in enumerate(words):
        if total and total + len(w) > CHUNK:
            yield lo, k
            lo, total = k, 0
        total += len(w)
    if words:
        yield lo, len(words)


def runs_of_texts(words: list[list[bytes]], min_words: int = MIN_WORDS,
                  min_copies: int = MIN_COPIES) -> Iterator[list[tuple[int, int, int]]]:
    """For each text, ``(start, length, period)`` of its runs, by start, then period."""
    for lo, hi in _chunks(words):
        codes, base = [], 0
        for w in words[lo:hi]:
            seen: dict[bytes, int] = {}
            put = seen.setdefault
            codes.append(np.fromiter((put(x, len(seen)) for x in w), np.int64, len(w)) + base)
            base += len(seen)
        ends = np.cumsum([len(c) for c in codes])
        starts = ends - np.array([len(c) for c in codes])
        out: list[list[tuple[int, int, int]]] = [[] for _ in codes]
        found = word_runs(np.concatenate(codes), starts, min_words, min_copies)
        for (start, length), period in found.items():
            # texts without words share their start with the next one, which comes last
            t = int(np.searchsorted(starts, start, "right")) - 1
            out[t].append((start - int(starts[t]), length, period))
        for runs in out:
            runs.sort(key=lambda r: (r[0], r[2]))
            yield runs


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words outside of runs or in a run's first period only."""
    if not runs:
        return words
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return [words[k] for k in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]


def find_runs(docs: DataFrame, keep: list[str] | None = None, min_words: int = MIN_WORDS,
              min_copies: int = MIN_COPIES, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` (all by default) plus ``n_words``, ``runs`` (array of
    start, length and period in words, by start, then period) and ``collapsed``
    (the text's words joined by one space, without what follows the first period
    of a run).

    Words are what ASCII white space separates.  A run is a stretch with
    smallest period q, at least ``min_words`` words and ``min_copies`` (two or
    more) times q, that no neighbouring word extends.  A NULL or empty text has
    no words and no runs; texts of any length are read whole, each in one task;
    repeated rows are rows of their own; an empty table gives an empty result;
    columns of ``docs`` with one of the three names are replaced.
    """
    if min_copies < 2:
        raise ValueError("a run needs two copies or more")
    ship_package(docs.sparkSession)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_words", "runs", "collapsed")]
    src = docs.select(*keep, F.col(text_col).cast("binary").alias(fresh_name(docs)))
    new = "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    schema = StructType([*docs.select(*keep).schema.fields, *StructType.fromDDL(new).fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [(t.as_py() or b"").split() for t in batch.column(len(keep))]
            runs = list(runs_of_texts(words, min_words, min_copies))
            flat = [r for rs in runs for r in rs]
            item = pa.StructArray.from_arrays(
                [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)], ["start", "length", "period"])
            ends = np.r_[0, np.cumsum([len(rs) for rs in runs])].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), item)
            new = [pa.array([len(w) for w in words], pa.int64()), lists.cast(arrow.types[-2]),
                   pa.array([b" ".join(collapse(w, r)).decode("utf-8", "replace") for w, r in zip(words, runs)],
                            arrow.types[-1])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *new], schema=arrow)

    return src.mapInArrow(run, schema)
