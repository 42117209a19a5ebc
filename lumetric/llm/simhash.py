"""SimHash near-duplicates by vantage-point trees over the two halves of a fingerprint."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumetric.llm.common import forget, relieve, sampled
from lumetric.session import settle


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits, each 1 if it is 1 in over half of the text's shingle hashes; 0 without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for a in range(0, len(starts), 1 << 15):
        part = zip(starts[a : a + (1 << 15)].tolist(), ends[a : a + (1 << 15)].tolist())
        hashes = np.array([digest(joined[s:e], 42) for s, e in part], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = 3, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, hash of the text, fp: the fingerprint of each whole text, its 64 bits as a signed long."""

    def batches_of(batches):
        forget()
        for batch in batches:
            found = [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            columns = [batch.column("doc_id"), batch.column("hash"), fps]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "hash", "fp"])
        relieve()

    text = F.col(text_column)
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text")
    )
    return rows.mapInArrow(batches_of, "doc_id long, hash long, fp long")


# --- vantage-point trees ---------------------------------------------------------------------
#
# Two fingerprints within `bits` differ by at most bits // 2 in one half. So there is a tree for
# each half: its nodes measure the Hamming distance of that half to a vantage point, where a pair
# sought differs by at most bits // 2, or of the other half, where it differs by at most bits.
# Points up to the radius live on the left, the others on the right. By the triangle inequality
# only those on the left close to the radius can have partners on the right: they visit there.
# Visitors follow every branch that the triangle bound doesn't exclude. So every pair meets in
# the leaf where one of them lives.


def distance(fps: np.ndarray, vantage: int, high: bool) -> np.ndarray:
    """Hamming distance in the upper or lower 32 bits."""
    half = (fps >> np.uint64(32)) if high else (fps & np.uint64(0xFFFFFFFF))
    return np.bitwise_count(half ^ np.uint64(vantage)).astype(np.int16)


def vantage_of(fp: int, high: bool) -> int:
    return fp >> 32 if high else fp & 0xFFFFFFFF


def best_split(fps: np.ndarray, half: bool, bits: int, tries: int = 5) -> dict | None:
    """The split with the fewest points near the radius, among some vantage points; None if none splits."""
    best, least = None, np.inf
    step = max(1, len(fps) // tries)
    for high in (half, not half):
        reach = bits // 2 if high == half else bits
        for fp in fps[::step][:tries].tolist():
            vantage = vantage_of(fp, high)
            apart = distance(fps, vantage, high)
            radius = int(np.median(apart))
            for r in (radius, radius - 1):
                left = np.count_nonzero(apart <= r)
                if min(left, len(fps) - left) < len(fps) // 8 or not 0 < left < len(fps):
                    continue
                near = np.count_nonzero((apart > r - reach) & (apart <= r + reach))
                cost = (near + 1) / min(left, len(fps) - left)
                if cost < least:
                    least = cost
                    best = {"high": high, "vantage": vantage, "radius": r, "reach": reach}
        if best:  # the other half only where this one can't split
            break
    return best


def build_tree(fps: np.ndarray, half: bool, bits: int, leaf: int, first: int) -> tuple[dict, int]:
    """A tree over a sample, leaves of at most ``leaf`` sample points numbered from ``first``."""
    split = best_split(fps, half, bits) if len(fps) > leaf else None
    if split is None:
        return {"leaf": first}, first + 1
    left = distance(fps, split["vantage"], split["high"]) <= split["radius"]
    split["left"], first = build_tree(fps[left], half, bits, leaf, first)
    split["right"], first = build_tree(fps[~left], half, bits, leaf, first)
    return split, first


def branch(node: dict, homes: np.ndarray, visitors: np.ndarray):
    """(homes, visitors) of the left and of the right side, as indices into the given arrays."""
    r, reach = node["radius"], node["reach"]
    at, seen = (distance(x, node["vantage"], node["high"]) for x in (homes, visitors))
    left = at <= r
    crossing = left & (at > r - reach)
    return (
        (np.flatnonzero(left), np.flatnonzero(seen <= r + reach)),
        (np.flatnonzero(~left), np.flatnonzero(seen > r - reach), np.flatnonzero(crossing)),
    )


def route(node: dict, homes: np.ndarray, visitors: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The points that live in, and that visit, each leaf."""
    if not len(homes) and not len(visitors):
        return
    if "leaf" in node:
        yield node["leaf"], homes, visitors
        return
    (lh, lv), (rh, rv, crossing) = branch(node, homes, visitors)
    yield from route(node["left"], homes[lh], visitors[lv])
    yield from route(node["right"], homes[rh], np.concatenate([visitors[rv], homes[crossing]]))


class Forest:
    """Groups of points joined so far; keeps no pairs."""

    def __init__(self, size: int):
        self.label = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            parent = np.arange(len(self.label))
            np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
            self.label = parent[self.label]


def join_leaf(fps: np.ndarray, homes: np.ndarray, visitors: np.ndarray, half: bool, bits: int, forest: Forest) -> None:
    """Join points within ``bits`` of each other, at least one of them at home; homes and visitors are indices."""
    if len(homes) > 512:
        split = best_split(fps[homes], half, bits, 3)
        if split is not None:
            (lh, lv), (rh, rv, crossing) = branch(split, fps[homes], fps[visitors])
            join_leaf(fps, homes[lh], visitors[lv], half, bits, forest)
            join_leaf(fps, homes[rh], np.concatenate([visitors[rv], homes[crossing]]), half, bits, forest)
            return
    others = np.concatenate([homes, visitors])
    for a in range(0, len(homes), 128):
        mine = homes[a : a + 128]
        for b in range(a, len(others), 1 << 15):
            theirs = others[b : b + (1 << 15)]
            i, j = np.nonzero(np.bitwise_count(fps[mine][:, None] ^ fps[theirs][None, :]) <= bits)
            # The first chunk holds mine themselves; in later ones every hit is a pair.
            if len(i) > (len(mine) if b == a else 0):
                forest.join(mine[i], theirs[j])


def links(distinct: DataFrame, bits: int = 3, leaf: int = 2048, sample_rows: int = 50_000) -> DataFrame:
    """a, b: links that join exactly the fingerprints connected by steps of at most ``bits``.

    ``distinct`` holds each fingerprint once, as ``fp``. The upper levels of both
    trees come from a bounded sample of ``sample_rows`` fingerprints and deal all
    fingerprints out to shards of about ``leaf``; every shard finishes its tree by
    itself. A shard returns one link per connected point at most, never its pairs.
    """
    total = distinct.count()
    sample = np.array([r.fp for r in sampled(distinct, sample_rows, F.col("fp")).collect()], np.int64)
    sample = np.sort(sample.view(np.uint64))
    per_leaf = max(8, int(leaf * len(sample) / max(total, 1)))
    low, first = build_tree(sample, False, bits, per_leaf, 0)
    high, _ = build_tree(sample, True, bits, per_leaf, first)
    trees = distinct.sparkSession.sparkContext.broadcast((low, high))

    def deal(batches):
        for batch in batches:
            fps = batch.column("fp").to_numpy().view(np.uint64)
            for tree in trees.value:
                for shard, homes, visitors in route(tree, fps, fps[:0]):
                    both = np.concatenate([homes, visitors]).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(both), shard, np.int32)),
                            pa.array(both),
                            pa.array(np.arange(len(both)) < len(homes)),
                        ],
                        ["shard", "fp", "home"],
                    )

    def search(key, rows: pd.DataFrame) -> pd.DataFrame:
        fps = rows["fp"].to_numpy().view(np.uint64)
        home = rows["home"].to_numpy()
        forest = Forest(len(fps))
        join_leaf(fps, np.flatnonzero(home), np.flatnonzero(~home), key[0] >= first, bits, forest)
        joined = np.flatnonzero(forest.label != np.arange(len(fps)))
        ends = fps.view(np.int64)
        return pd.DataFrame({"a": ends[forest.label[joined]], "b": ends[joined]})

    dealt = distinct.mapInArrow(deal, "shard int, fp long, home boolean")
    return dealt.groupBy("shard").applyInPandas(search, "a long, b long")


def connected(edges: DataFrame) -> DataFrame:
    """node, root of every node in ``edges`` (a, b), root being the least node of its component.

    Alternates the large-star and the small-star step until all links point to
    a root: each node joins its larger neighbours, then its smaller ones, to the
    least node it sees. Every round is written to the shared folder.
    """
    current = settle(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(),
        "links",
    )
    state = None
    while True:
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        both = current.union(current.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        current = settle(small.select("e.*").where("u != v").distinct(), "links")


def near_duplicates(
    docs: DataFrame, shingle: int = 3, bits: int = 3, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id, fp, component_id, hash and first of every row.

    ``component_id`` is the least id reachable over links of at most ``bits``.
    ``hash`` is one of the text, ``first`` the (id, hash) of the one document to
    keep of the component: the least id, null last, then hash. Equal fingerprints
    are one point, however many documents share them; only distinct ones are
    searched. Null and empty texts have fingerprint 0 and are linked like any
    other. A component of null ids only has a null id. Repeated rows share
    everything; other columns are ignored; no rows give no rows.
    """
    fps = settle(fingerprints(docs, shingle, id_column=id_column, text_column=text_column), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "hash")
    points = settle(fps.groupBy("fp").agg(F.min(row).alias("least")), "points")
    stars = connected(links(points.select("fp"), bits))
    rooted = points.join(stars, points.fp == stars.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("first"))
    of = rooted.join(named, "root").select("fp", "first")
    return fps.join(of, "fp").select(
        "doc_id", "fp", F.col("first.doc_id").alias("component_id"), "hash",
        F.struct("first.doc_id", "first.hash").alias("first"),
    )


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = 3, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents without their near-duplicates: one row of each component, all columns.

    See ``near_duplicates`` for which one stays; of rows equal in id and text, one does.
    """
    found = near_duplicates(docs, shingle, bits, id_column=id_column, text_column=text_column)
    kept = found.where(
        F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("hash") == F.col("first.hash"))
    ).select(F.to_json(F.struct("doc_id", "hash")).alias("key")).distinct()
    own = F.to_json(F.struct(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.xxhash64(f"`{text_column}`").alias("hash")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), own.alias("key"))
    once = Window.partitionBy("key").orderBy("key")
    return (
        rows.join(kept, "key", "left_semi")
        .withColumn("nth", F.row_number().over(once))
        .where("nth = 1")
        .select("row.*")
    )


def hex_digits(fp: str) -> Column:
    """A fingerprint column as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
