"""Best-fit packing of tokenised documents into sequences of bounded length.

Each task packs its own rows online with a fixed number of open bins.  The
bins still open at its end are short lists of used lengths; these are packed
again, as items, over ever fewer tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .tokens import word_ids

#: Bins that one task keeps open; when all are taken the fullest closes first.
OPEN_BINS = 512
#: Left-over bins that one task packs in a merging round.
MERGE_ROWS = 20_000
#: Texts that are encoded together.
GROUP = 256


class OpenBins:
    """Open bins by free space: one bit per free space that some bin has, so
    the tightest bin that fits is the lowest set bit at or above a length."""

    def __init__(self, capacity: int, limit: int, first_id: int, step: int = 1):
        self.capacity, self.limit, self.step = capacity, limit, step
        self.bits, self.n, self.next_id = 0, 0, first_id
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        stack = self.at[free]
        found = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.n -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) for an item: the fullest open bin with room, else a new
        one, for which the fullest open bin closes if the limit is reached."""
        room = self.bits >> length
        if room:
            free = length + (room & -room).bit_length() - 1
            found = self._take(free)
        else:
            if self.n >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
            found, free = self.next_id, self.capacity
            self.next_id += self.step
        if free > length:
            self.at[free - length].append(found)
            self.bits |= 1 << (free - length)
            self.n += 1
        return found, self.capacity - free

    def left(self) -> list[tuple[int, int]]:
        """(bin, used) of the bins that are still open."""
        return [(b, self.capacity - free) for free, stack in enumerate(self.at) for b in stack]


def pieces_of(length: int, capacity: int) -> Iterator[tuple[int, int, int]]:
    """(piece, start, length): whole if it fits, else cut every ``capacity``."""
    for i, start in enumerate(range(0, length, capacity)):
        yield i, start, min(capacity, length - start)


def _id_base() -> int:
    """First sequence id of this task: its partition in the high bits."""
    return TaskContext.get().partitionId() << 40


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 4096, end_id: int = 1,
                   open_bins: int = OPEN_BINS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``(id_col, piece, start, length, token_ids,
    sequence_id, offset)``, token_ids as little-endian unsigned 32-bit binary.

    A document is its ids (no special tokens added) and ``end_id``; a NULL or
    empty text is ``end_id`` alone.  Only documents over ``capacity`` are cut.
    Full pieces are sequences of their own.  NULL or repeated ids are documents
    like any other.  An empty table gives an empty result.
    """
    src = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    out = (docs.select(id_col).schema.add("piece", "integer").add("start", "long").add("length", "long")
           .add("token_ids", "binary").add("sequence_id", "long").add("offset", "long").add("used", "long"))
    from pyspark.sql.pandas.types import to_arrow_schema
    schema = to_arrow_schema(out)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, bins = word_ids(tokenizer_path), OpenBins(capacity, open_bins, _id_base())
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            ids = batch.column(id_col)
            for lo in range(0, batch.num_rows, GROUP):
                texts = batch.column("_t").slice(lo, GROUP).to_pylist()
                rows, cols = [], [[] for _ in range(6)]
                for k, raw in enumerate(encoder.ids(texts)):
                    raw += end
                    for i, start, n in pieces_of(len(raw) // 4, capacity):
                        seq, off = bins.place(n)
                        rows.append(lo + k)
                        for c, x in zip(cols, (i, start, n, raw[4 * start:4 * (start + n)], seq, off)):
                            c.append(x)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(rows)), *[pa.array(c, t) for c, t in zip(cols, schema.types[1:])],
                     pa.nulls(len(rows), pa.int64())], schema=schema)
        left = bins.left()
        # the task's open bins: rows without a piece
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(left), schema.types[0]), *[pa.nulls(len(left), t) for t in schema.types[1:5]],
             pa.array([b for b, _ in left], pa.int64()), pa.nulls(len(left), pa.int64()),
             pa.array([u for _, u in left], pa.int64())], schema=schema)

    packed = materialize(src.mapInArrow(pack, out), "packing")
    open_ = packed.filter(F.col("used").isNotNull()).select("sequence_id", "used")
    moved = merge_open_bins(open_, capacity, open_bins)
    placed = packed.filter(F.col("used").isNull()).drop("used")
    # one bin holds at most `capacity` pieces, so no key of this join is hot
    return (placed.join(moved.hint("merge"), "sequence_id", "left")
            .withColumn("offset", F.col("offset") + F.coalesce("shift", F.lit(0)))
            .withColumn("sequence_id", F.coalesce("target", "sequence_id"))
            .select(*out.names[:-1]))


def merge_open_bins(open_: DataFrame, capacity: int, open_bins: int) -> DataFrame:
    """``(sequence_id, used)`` of left-over bins -> ``(sequence_id, target,
    shift)`` for those that move behind another one's content.

    Rounds over ever fewer tasks: each task packs up to MERGE_ROWS bins, fullest
    first, and passes on the bins it leaves open.  It ends with a round of one
    task (at most MERGE_ROWS rows) or when a round hardly joins any bins.
    """
    now, moves = open_, []
    while True:
        n = now.count()
        parts = max(1, -(-n // MERGE_ROWS))

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            frame = pd.concat([pd.DataFrame({"sequence_id": [], "used": []}, dtype="int64"), *batches])
            frame = frame.sort_values(["used", "sequence_id"], ascending=[False, True])
            bins, first = OpenBins(capacity, max(open_bins, len(frame)), 0), {}
            rows = []
            for seq, used in zip(frame.sequence_id, frame.used):
                b, off = bins.place(int(used))
                target = first.setdefault(b, seq)
                rows.append((seq, target, off))
            total: dict = {}
            for (seq, target, off), used in zip(rows, frame.used):
                total[target] = max(total.get(target, 0), off + int(used))
            yield pd.DataFrame([(s, t, o, total[t] if s == t else None) for s, t, o in rows],
                               columns=["sequence_id", "target", "shift", "used"]).astype(
                {"sequence_id": "int64", "target": "int64", "shift": "int64", "used": "Int64"})

        dealt = now.repartition(parts, F.xxhash64("sequence_id")) if parts > 1 else now.coalesce(1)
        done = materialize(dealt.mapInPandas(
            pack, "sequence_id long, target long, shift long, used long"), "packing-merge")
        moves.append(done.select("sequence_id", "target", "shift"))
        if parts == 1 or done.filter("sequence_id = target").count() > 0.9 * n:
            break
        now = done.filter("sequence_id = target").select("sequence_id", "used")
    result = moves[0]
    for later in moves[1:]:
        nxt = later.select(F.col("sequence_id").alias("target"), F.col("target").alias("t2"), F.col("shift").alias("s2"))
        result = result.join(nxt, "target", "left").select(
            "sequence_id", F.coalesce("t2", "target").alias("target"),
            (F.col("shift") + F.coalesce("s2", F.lit(0))).alias("shift"))
    return result


def sequences(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per packed sequence: ``(sequence_id, length, n_pieces, doc_ids,
    token_ids)``, the pieces in the order of their offsets.  A sequence is
    bounded by its capacity, so the lists are too."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.col(id_col).alias("d"), "token_ids")))
    return (pieces.groupBy("sequence_id").agg(parts.alias("p"), F.sum("length").alias("length"))
            .select("sequence_id", "length", F.size("p").alias("n_pieces"),
                    F.col("p.d").alias("doc_ids"),
                    F.aggregate("p.token_ids", F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b)).alias("token_ids")))
