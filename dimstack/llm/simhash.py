"""SimHash near-duplicate groups by pigeonhole blocks.

Fingerprints that differ in at most ``d`` of 64 bits agree on at least
``b - d`` of ``b`` blocks, so each pair of that kind meets in one of the
C(b, b - d) block combinations.  Only distinct fingerprints are compared, and
a bucket yields a spanning forest of its links instead of all its pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, arrow_schema, join_by_document, materialize, text_key
from .components import connected_components

SEED = 42
#: Shingles whose bits are unpacked at a time (64 bytes each).
CHUNK = 65_536


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of a whole text.

    Words are runs of other than ASCII white space, A-Z lower-cased (what
    ``bytes.lower`` and ``bytes.split`` do); repeats count.  No word: zero.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams: Iterator = iter([tuple(words)])
        n = 1
    else:
        grams = zip(*(words[k:] for k in range(shingle)))
        n = len(words) - shingle + 1
    digest, join = xxhash.xxh64_intdigest, b" ".join
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, CHUNK):
        part = itertools.islice(grams, CHUNK)
        h = np.fromiter((digest(join(g), SEED) for g in part), np.uint64, min(CHUNK, n - lo))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id_col, text_key, fp)`` per row; fp is the fingerprint as a signed long."""
    src = docs.select(id_col, text_key(text_col).alias("text_key"), F.col(text_col).alias("__t"))
    schema = arrow_schema(src, [id_col, "text_key"], [("fp", pa.int64())])

    def build(batch: pa.RecordBatch) -> dict:
        fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column("__t")),
                         np.uint64, batch.num_rows)
        return {id_col: batch.column(id_col), "text_key": batch.column("text_key"),
                "fp": pa.array(fp.view(np.int64))}

    out = src.select(id_col, "text_key").schema.add("fp", "long")
    return src.mapInArrow(lambda it: arrow_batches(build, it, schema), out)


def block_masks(blocks: int, distance: int, bits: int = 64) -> list[int]:
    """One mask per choice of ``blocks - distance`` blocks."""
    edges = [round(i * bits / blocks) for i in range(blocks + 1)]
    parts = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(edges, edges[1:])]
    return [sum(c) for c in itertools.combinations(parts, blocks - distance)]


def _forest(fps: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """The groups that links form within one bucket of distinct fingerprints,
    each as a star around its first one.

    Breadth first: each reached fingerprint leaves the list of open ones, so
    at most n - 1 pairs come out and memory is linear in the bucket.
    """
    open_, left, right = fps, [], []
    while len(open_) > 1:
        first, queue, open_ = int(open_[0]), [open_[0]], open_[1:]
        while queue and len(open_):
            at = queue.pop()
            near = np.bitwise_count(open_ ^ at) <= distance
            if near.any():
                found = open_[near]
                left += [first] * len(found)
                right += found.tolist()
                queue += list(found)
                open_ = open_[~near]
    return left, right


def _links(keys: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal keys (rows sorted by key)."""
    u, v = [], []
    start = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
    size = np.diff(np.r_[start, len(keys)])
    small = 32
    # short runs: compare every row with its k-th successor, all runs at once
    run = np.repeat(np.arange(len(start)), size)
    short = (size <= small)[run]
    rows = np.flatnonzero(short)
    f, r = fps[rows], run[rows]
    for k in range(1, int(size[size <= small].max(initial=1))):
        near = np.flatnonzero((r[k:] == r[:-k]) & (np.bitwise_count(f[k:] ^ f[:-k]) <= distance))
        u.append(f[near])
        v.append(f[near + k])
    for i in np.flatnonzero(size > small):
        a, b = _forest(fps[start[i]:start[i] + size[i]], distance)
        u.append(np.array(a, np.uint64))
        v.append(np.array(b, np.uint64))
    return (np.concatenate(u), np.concatenate(v)) if u else (np.zeros(0, np.uint64),) * 2


def similar_pairs(fps: DataFrame, distance: int = 4, blocks: int = 6) -> DataFrame:
    """Pairs ``(u, v)`` that connect the distinct fingerprints ``fp`` as links
    within ``distance`` bits do: short buckets give their close pairs, a long
    bucket a star for each of its groups.

    A bucket holds distinct fingerprints that agree on its blocks.  Unrelated
    ones thin out by 2^-(block bits); a group of near copies of any size has
    only as many distinct fingerprints as lie within a few bits of each other.
    """
    masks = block_masks(blocks, distance)
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    keyed = fps.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(m).cast("long")) for m in signed])).alias("t", "key"))
    dealt = keyed.repartition("t", "key").sortWithinPartitions("t", "key")
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_f = np.zeros((0, 2), np.int64), np.zeros(0, np.uint64)

        def out(keys, values):
            u, v = _links(keys, values, distance)
            return pa.RecordBatch.from_arrays(
                [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], schema=schema)

        for b in batches:
            if not b.num_rows:
                continue
            k = np.stack([b.column("t").to_numpy().astype(np.int64), b.column("key").to_numpy()], axis=1)
            held_k = np.concatenate([held_k, k])
            held_f = np.concatenate([held_f, b.column("fp").to_numpy().view(np.uint64)])
            # the last run may go on in the next batch
            cut = len(held_k) - int(np.argmax((held_k[::-1] != held_k[-1]).any(axis=1))) \
                if (held_k[0] != held_k[-1]).any() else 0
            if cut:
                yield out(held_k[:cut], held_f[:cut])
                held_k, held_f = held_k[cut:], held_f[cut:]
        if len(held_k):
            yield out(held_k, held_f)

    return dealt.mapInArrow(link, "u long, v long").distinct()


def near_duplicate_groups(docs: DataFrame, shingle: int = 4, distance: int = 4, blocks: int = 6,
                          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``(id_col, text_key, fp, component_id, root)``.

    component_id is the smallest id reachable over links of at most
    ``distance`` bits.  NULL and empty texts have fingerprint zero and link
    like any other; repeated rows keep their own output rows; a group whose
    ids are all NULL has a NULL component; an empty table gives an empty one.
    root is a fingerprint that names the group, also one without ids.
    """
    rows = materialize(fingerprints(docs, shingle, id_col, text_col), "simhash-fp")
    distinct = materialize(rows.groupBy("fp").agg(F.min(id_col).alias("low")), "simhash-distinct")
    roots = connected_components(similar_pairs(distinct.select("fp"), distance, blocks))
    by_fp = materialize(distinct.join(roots, distinct.fp == roots.node, "left")
                        .select("fp", "low", F.coalesce("root", "fp").alias("root")), "simhash-root")
    # components of one fingerprint need no second look-up
    lone = by_fp.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = materialize(by_fp.select("fp", "root").join(materialize(lone, "simhash-id").hint("merge"), "root")
                      .select("fp", "component_id", "root"), "simhash-component")
    return rows.join(ids.hint("merge"), "fp").select(id_col, "text_key", "fp", "component_id", "root")


def keep_one_per_group(docs: DataFrame, shingle: int = 4, distance: int = 4, blocks: int = 6,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that represent their near-duplicate group: the one
    with the smallest id (NULL ids last; then the smallest text key).  Of
    identical repeated rows one stays."""
    groups = near_duplicate_groups(docs, shingle, distance, blocks, id_col, text_col)
    order = F.struct(F.col(id_col).isNull().alias("n"), F.col(id_col).alias("i"), F.col("text_key").alias("k"))
    keep = groups.groupBy("root").agg(F.min(order).alias("o")).select("o.i", "o.k")
    kept = join_by_document(docs, keep, "left_semi", id_col, text_col)
    # identical repeated rows are all still here; each task passes on one of them
    copy = F.row_number().over(Window.partitionBy(id_col, text_key(text_col)).orderBy(F.lit(1)))
    return kept.select("*", copy.alias("copy number")).filter("`copy number` = 1").select(*docs.columns)
