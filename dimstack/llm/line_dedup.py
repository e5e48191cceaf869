"""Line dedup across documents, native: explode the lines, hash their keys,
find the smallest document per key, drop the other documents' copies and put
the remaining lines back together by position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HEAVY, join_by_document, materialize, text_key

BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line):
    """The line without ASCII white space at its ends, A-Z lower-cased."""
    trimmed = F.btrim(line, F.lit(BLANKS))
    return F.translate(trimmed, UPPER, LOWER)


def _lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``(id, text_key, pos, h1, h2)`` of the lines whose key is long enough."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).alias("__id"), text_key(text_col).alias("__tk"),
                        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
            .select("__id", "__tk", "pos", line_key(F.col("line")).alias("k"))
            .filter(F.length("k") >= min_chars)
            # 128 bits: two hashes chained from different first values
            .select("__id", "__tk", "pos", F.xxhash64("k").alias("h1"),
                    F.xxhash64(F.lit("second"), "k").alias("h2")))


def _lost(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``(__id, __tk, drop)``: per document with losses, the line positions that go.

    A key found in two documents or more stays only in the smallest id that
    holds it.  The keys are counted with partial sums before the shuffle.  Those
    that hold over a thousandth of the shared lines (fewer than HEAVY exist) are
    matched by broadcast, all others by a shuffle join.
    """
    # split and hashed once; what is read again are ids, positions and hashes
    lines = materialize(_lines(docs, id_col, text_col, min_chars), "line-hashes")
    # NULL ids are one document, after all others
    order = F.struct(F.col("__id").isNull().alias("n"), F.col("__id").alias("i"))
    shared = materialize(
        lines.groupBy("h1", "h2").agg(F.min(order).alias("low"), F.max(order).alias("high"),
                                      F.count("*").alias("n"))
        .filter("low <> high").select("h1", "h2", F.col("low.i").alias("keeper"), "n"), "line-keys")
    limit = max(1, (shared.agg(F.sum("n")).first()[0] or 0) // HEAVY)
    heavy = F.broadcast(shared.filter(F.col("n") > limit))
    light = shared.filter(F.col("n") <= limit)
    lost = ~F.col("__id").eqNullSafe(F.col("keeper"))
    hot = lines.join(heavy, ["h1", "h2"])
    cold = lines.join(heavy.select("h1", "h2"), ["h1", "h2"], "left_anti").join(
        light.hint("merge"), ["h1", "h2"])
    cols = ["__id", "__tk", "pos"]
    return (hot.filter(lost).select(cols).unionByName(cold.filter(lost).select(cols))
            .groupBy("__id", "__tk").agg(F.collect_set("pos").alias("drop")))


def dedup_lines(docs: DataFrame, min_chars: int = 10, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with the text reduced, plus ``n_lines`` (before)
    and ``n_dropped``.

    A NULL or empty text is one empty line.  Rows that share an id count as one
    document (each keeps the lines that the id keeps); NULL ids count as one
    document that comes last.  Line ends other than \\n are white space at a
    line's end: part of the kept line, not of its key.  Empty tables give empty
    results; other columns pass through, but for ones named ``n_lines`` or
    ``n_dropped``, which the new ones replace.
    """
    joined = join_by_document(docs, _lost(docs, id_col, text_col, min_chars), "left", id_col, text_col)
    drop = F.col(joined.columns[-1])["drop"]
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
    left = F.when(drop.isNull(), text).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    n_dropped = F.when(drop.isNull(), 0).otherwise(F.size(drop))
    kept_cols = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(*[left.alias(c) if c == text_col else F.col(c) for c in kept_cols],
                         F.size(lines).cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"))
