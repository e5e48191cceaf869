"""Prefix trie of conversations by bursting.

All conversations start in one container below the root.  A container with too
many distinct turn sequences bursts: the turns that all of them share become
nodes of their own, and the sequences move to one container for each next turn.
Containers that are small enough are dealt out, sorted and swept into nodes.
The totals of the burst nodes are summed up from the last round to the first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .common import join_dimension, materialize, ship_package

#: Bytes that stand for a turn: 16 of a digest of role and text, 4 for the text's length.
UNIT = 20
#: Distinct sequences that a container holds before it bursts.
CONTAINER = 4096
#: Ids of equal conversations that are joined into one piece of text.
PIECE = 1000
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_units(turns: DataFrame, id_col: str = "conv_id", order_col: str = "turn", role_col: str = "role",
               text_col: str = "text") -> DataFrame:
    """``(id_col, order, unit)``: each turn as UNIT bytes in hex.  A NULL role or
    text is empty; equal (role, text) have equal units."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    size = F.lpad(F.hex(F.octet_length(text)), 8, "0")
    return turns.select(id_col, F.col(order_col).alias("order"), F.concat(F.substring(digest, 1, 32), size).alias("unit"))


def sequences(units: DataFrame, id_col: str = "conv_id", order: str = "order") -> DataFrame:
    """``(id_col, seq)``: the units of each conversation end to end, by ``order``
    (NULL first), then unit.  Rows without a unit only name a conversation."""
    said = F.sort_array(F.collect_list(F.when(F.col("unit").isNotNull(), F.struct(order, "unit"))))
    return units.groupBy(id_col).agg(F.unhex(F.array_join(F.transform(said, lambda t: t["unit"]), "")).alias("seq"))


def _same_sequences(convs: DataFrame, id_col: str) -> DataFrame:
    """``(seq, n, low, ends)``: conversations with equal sequences as one row;
    ends is the digest of their ids, ascending and comma-joined.

    The ids of a hot sequence are spread by range over tasks that join up to
    PIECE of them; its pieces are then digested as a stream, in order.  A NULL
    id counts in n but has no name.
    """
    id_type = convs.schema[id_col].dataType
    spread = (convs.select("seq", F.col(id_col).alias("id")).repartitionByRange("seq", "id")
              .sortWithinPartitions("seq", "id").select("seq", "id", F.col("id").cast("string").alias("name")))
    piece_schema = spread.select("seq", "id").schema.add("n", "long").add("names", "string")
    piece_arrow = to_arrow_schema(piece_schema)

    def join_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, first, n, names = None, None, 0, []
        for batch in batches:
            out: list[list] = [[], [], [], []]

            def put() -> None:
                for col, value in zip(out, (seq, first, n, ",".join(names))):
                    col.append(value)

            for s, i, name in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if n and (s != seq or n >= PIECE):
                    put()
                    n, names = 0, []
                if not n:
                    seq, first = s, None
                n += 1
                if name is not None:
                    names.append(name)
                    first = i if first is None else first
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, piece_arrow.types)], schema=piece_arrow)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip((seq, first, n, ",".join(names)), piece_arrow.types)], schema=piece_arrow)

    pieces = (spread.mapInArrow(join_names, piece_schema)
              .withColumn("key", F.sha2("seq", 256)).repartition("key")
              .sortWithinPartitions("key", F.col("id").asc_nulls_first()).drop("key"))
    schema = StructType(piece_schema.fields[:1]).add("n", "long").add("low", id_type).add("ends", "string")
    arrow = to_arrow_schema(schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, low, n, sha, told = None, None, 0, hashlib.sha256(), False
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for s, i, count, names in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if n and s != seq:
                    for col, value in zip(out, (seq, n, low, sha.hexdigest())):
                        col.append(value)
                    low, n, sha, told = None, 0, hashlib.sha256(), False
                seq, n = s, n + count
                low = i if low is None else low
                if names:
                    sha.update((("," if told else "") + names).encode())
                    told = True
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, arrow.types)], schema=arrow)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip((seq, n, low, sha.hexdigest()), arrow.types)], schema=arrow)

    return pieces.mapInArrow(digest, schema)


def _shared_units(a: bytes, b: bytes, start: int = 0) -> int:
    """Units that two sequences have in common at their beginning, of which
    ``start`` are known."""
    at, end = start * UNIT, min(len(a), len(b))
    while at < end and a[at:at + UNIT] == b[at:at + UNIT]:
        at += UNIT
    return at // UNIT


def _text_bytes(seq: bytes, depth: int) -> int:
    """Bytes of the text of turn ``depth`` (from 1); the root has none."""
    return int.from_bytes(seq[depth * UNIT - 4:depth * UNIT], "big") if depth else 0


def _node_schema(id_type) -> StructType:
    schema = StructType().add("conv_id", id_type).add("depth", LongType()).add("parent_conv_id", id_type)
    for name in ("n_convs", "n_children", "n_leaves", "saved_bytes"):
        schema = schema.add(name, LongType())
    # parent: the burst container that a container's top node hangs from
    return schema.add("ends_sha256", StringType()).add("parent", StringType()).add("top", "boolean")


class _Node:
    __slots__ = ("depth", "n", "low", "leaves", "saved", "ends", "below")

    def __init__(self, depth: int):
        self.depth, self.n, self.low = depth, 0, None
        self.leaves, self.saved, self.ends = 0, 0, NO_ENDS
        self.below: list[tuple] = []


def _sweep(batches: Iterator[pa.RecordBatch], arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose rows come side by side, sequences ascending.

    The open nodes are those on the path of the last sequence; a closed node
    waits for its parent's smallest id, so at most one container is held.
    """
    ready: list[tuple] = []
    path: list[_Node] = []
    head = seq = parent = above = None

    def close() -> None:
        node = path.pop()
        node.leaves = node.leaves or 1
        node.saved += (node.n - 1) * _text_bytes(seq, node.depth)
        # below: (low, depth, n, children, leaves, saved, ends) of closed children
        ready.extend((c[0], c[1], node.low, *c[2:], None, False) for c in node.below)
        mine = (node.low, node.depth, node.n, len(node.below), node.leaves, node.saved, node.ends)
        if path:
            up = path[-1]
            up.n, up.leaves, up.saved = up.n + node.n, up.leaves + node.leaves, up.saved + node.saved
            up.low = _least(up.low, node.low)
            up.below.append(mine)
        else:
            ready.append((mine[0], mine[1], above, *mine[2:], parent, True))

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ready), arrow.types)], schema=arrow)
        ready.clear()
        return batch

    for batch in batches:
        for h, cut, s, n, low, ends, up, up_low in zip(*(c.to_pylist() for c in batch.columns)):
            if h != head:
                while path:
                    close()
                head, parent, above = h, up, up_low
                path.append(_Node(cut))
            else:
                common = _shared_units(seq, s, cut)
                while path[-1].depth > common:
                    close()
            seq = s
            for depth in range(path[-1].depth + 1, len(s) // UNIT + 1):
                path.append(_Node(depth))
            end = path[-1]
            end.n, end.ends, end.low = end.n + n, ends, _least(end.low, low)
        if len(ready) > 10_000:
            yield flush()
    while path:
        close()
    if ready:
        yield flush()


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


def _head(cut: Column) -> Column:
    """Name of the container of a sequence below its first ``cut`` turns."""
    return F.concat(cut.cast("string"), F.lit(":"), F.sha2(F.substring("seq", F.lit(1), cut * UNIT), 256))


def _burst(work: DataFrame, limit: int) -> tuple[DataFrame, DataFrame, DataFrame] | None:
    """One round over ``work(head, cut, seq, n, low, ends, parent, above)``:
    (burst containers, rows of the others, rows for the next round), or None if
    no container is over ``limit``."""
    heads = (work.groupBy("head").agg(
        F.count("*").alias("rows"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("seq").alias("last"),
        F.min(F.struct("seq", "ends")).alias("first"), F.first("cut").alias("cut"),
        F.first("parent").alias("parent"), F.first("above").alias("above")).filter(F.col("rows") > limit))

    def depths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first, last = b.column("seq").to_pylist(), b.column("last").to_pylist()
            depth = [_shared_units(x, y) for x, y in zip(first, last)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(depth, pa.int32())],
                                             names=[*b.schema.names, "depth"])

    flat = heads.select("head", "rows", "n", "low", "cut", "parent", "above", F.col("first.seq").alias("seq"),
                        F.col("first.ends").alias("ends"), "last")
    heads = materialize(flat.mapInArrow(depths, StructType([*flat.schema.fields, StructField("depth", IntegerType())])), "trie-heads").drop("last")
    total = heads.agg(F.sum("rows")).first()[0]
    if total is None:
        return None
    side = heads.select("head", "rows", F.col("depth").alias("to"), F.col("low").alias("to_low"))
    joined = materialize(join_dimension(work, side, ["head"], "rows", total), "trie-burst")
    rest = joined.filter("to IS NULL").drop("to", "to_low")
    below = joined.filter((F.col("to").isNotNull()) & (F.octet_length("seq") > F.col("to") * UNIT))
    after = below.select(_head(F.col("to") + 1).alias("head"), (F.col("to") + 1).alias("cut"), "seq", "n", "low", "ends",
                         F.col("head").alias("parent"), F.col("to_low").alias("above"))
    return heads, rest, after


def _chains(heads: DataFrame, totals: DataFrame, schema) -> DataFrame:
    """Nodes of burst containers: the turns that all their sequences share.
    ``totals``: sums over the containers that hang from each."""
    arrow = to_arrow_schema(schema)
    src = (heads.join(totals.withColumnRenamed("parent", "head").hint("merge"), "head", "left")
           .select("cut", "depth", "seq", "n", "low", "ends", "parent", "above", "children", "leaves", "saved"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for cut, depth, seq, n, low, ends, parent, above, children, leaves, saved in zip(
                    *(c.to_pylist() for c in b.columns)):
                ended = len(seq) == depth * UNIT
                for d in range(depth, cut - 1, -1):
                    saved += (n - 1) * _text_bytes(seq, d)
                    out.append((low, d, above if d == cut else low, n, children if d == depth else 1, leaves, saved,
                                ends if ended and d == depth else NO_ENDS, parent if d == cut else None, d == cut))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), arrow.types)], schema=arrow)

    return src.mapInArrow(run, schema)


def build_trie(units: DataFrame, id_col: str = "conv_id", order: str = "order", container: int = CONTAINER) -> DataFrame:
    """One row per node of the trie over ``units(id_col, order, unit)`` (see
    ``turn_units`` and ``sequences``): ``(conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_bytes, ends_sha256)``.

    A node is a distinct beginning of conversations, the root the empty one;
    conv_id is the smallest id that starts with it and, with depth, names it;
    n_leaves counts the nodes without children at or below it; saved_bytes sums,
    over the nodes at or below it, the text bytes of the node's last turn times
    one less than its conversations; ends_sha256 digests the ids (ascending,
    comma-joined) of the conversations that end there, whose number no row could
    be sure to hold.  Turnless conversations end at the root.  Rows with a NULL
    id are one conversation, which counts but has no name.  Repeated rows are
    turns like any other; other columns are ignored; an empty table gives an
    empty result.  A conversation's units are one value, UNIT bytes a turn.
    """
    ship_package(units.sparkSession)
    convs = materialize(sequences(units, id_col, order), "trie-sequences")
    id_type = convs.schema[id_col].dataType
    none = F.lit(None).cast("string")
    work = _same_sequences(convs, id_col).select(
        _head(F.lit(0)).alias("head"), F.lit(0).alias("cut"), "seq", "n", "low", "ends", none.alias("parent"),
        F.lit(None).cast(id_type).alias("above"))
    work = materialize(work, "trie-work")
    rounds, settled = [], []
    while (burst := _burst(work, container)) is not None:
        heads, rest, after = burst
        rounds.append(heads)
        settled.append(rest)
        work = materialize(after, "trie-work")
    settled.append(work)
    rows = settled[0]
    for more in settled[1:]:
        rows = rows.unionByName(more)
    schema = _node_schema(id_type)
    arrow = to_arrow_schema(schema)
    dealt = (rows.select("head", "cut", "seq", "n", "low", "ends", "parent", "above")
             .repartition("head").sortWithinPartitions("head", "seq"))
    nodes = materialize(dealt.mapInArrow(lambda it: _sweep(it, arrow), schema), "trie-nodes")
    hanging = nodes.filter("top AND parent IS NOT NULL").select("parent", "n_leaves", "saved_bytes")
    later = None
    for heads in reversed(rounds):
        tops = hanging if later is None else hanging.unionByName(
            later.filter("top AND parent IS NOT NULL").select("parent", "n_leaves", "saved_bytes"))
        totals = tops.groupBy("parent").agg(F.count("*").alias("children"), F.sum("n_leaves").alias("leaves"),
                                            F.sum("saved_bytes").alias("saved"))
        later = materialize(_chains(heads, totals, schema), "trie-chains")
        nodes = nodes.unionByName(later)
    return nodes.drop("parent", "top")


def conversation_trie(turns: DataFrame, container: int = CONTAINER, id_col: str = "conv_id", order_col: str = "turn",
                      role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``build_trie`` of a table of turns as they are."""
    return build_trie(turn_units(turns, id_col, order_col, role_col, text_col), id_col, "order", container)


def with_shared_starts(units: DataFrame, donor: Column, turns: Column, id_col: str = "conv_id",
                       most: int = 8) -> DataFrame:
    """``(id_col, order, unit)`` of conversations whose first ``turns`` turns (at
    most ``most``) are replaced by those of the conversation ``donor``: all that it
    has if fewer, none if it is absent.  Both are expressions over ``id_col``; a
    NULL donor gives none, NULL turns replace none.  Each conversation also has
    a row without a unit, so that turnless ones stay.
    """
    place = Window.partitionBy(id_col).orderBy(F.col("order").asc_nulls_first(), "unit")
    turns = F.when(turns > most, most).otherwise(turns)
    own = materialize(units.select(id_col, F.row_number().over(place).alias("number"), "unit"), "trie-units")
    ids = own.filter("number = 1").select(F.col(id_col), donor.alias("donor"), turns.alias("turns"))
    # at most `most` rows of a donor, one of each heir: the heirs are what may be many
    first = own.filter(F.col("number") <= most).select(F.col(id_col).alias("donor"), "number", "unit")
    given = first.join(ids.hint("merge"), "donor").filter("number <= turns").select(
        id_col, F.struct(F.lit(0).alias("part"), "number").alias("order"), "unit")
    kept = own.filter(F.col("number") > F.coalesce(turns, F.lit(0))).select(
        id_col, F.struct(F.lit(1).alias("part"), "number").alias("order"), "unit")
    names = ids.select(id_col, F.struct(F.lit(2).alias("part"), F.lit(0).alias("number")).alias("order"),
                       F.lit(None).cast("string").alias("unit"))
    return given.unionByName(kept).unionByName(names)
