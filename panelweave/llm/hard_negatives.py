"""Hard negatives for anchors, from exact integer inner products by subset-sum tables.

1. Components become whole numbers. A row is stored as its bit planes in two's
   complement: for each plane and each eight dimensions one byte.
2. For each anchor and each eight dimensions a table holds the sums of all 256 subsets
   of its components. A plane's share of a score is one lookup a byte; planes are added
   up shifted, the highest one negative. Scores are exact, nothing is estimated.
3. Anchors are the queries, all rows the index: blocks of anchors go over the rows where
   they lie. A task keeps the best few rows of each anchor, and Spark the best of those.
   The first pass finds positives, the second the negatives between their bounds.

Rows are read in pieces and anchors in blocks, so a task holds one piece of scores and
the best rows of the anchors of a pass; the driver holds the anchors of a pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.session import stage, staged

#: Anchors of one pass over the rows (fewer if their components are beyond so many bytes), anchors with tables at a time,
#: and rows scored at a time.
PASS, PASS_BYTES, BLOCK, PIECE = 16_384, 16 << 20, 512, 4_096
POSITIVES, NEGATIVES = 5, 10
#: A negative scores between these per cents of the positive's score.
LOW, HIGH = 30, 90
NONE = np.iinfo(np.int64).min


def whole_components(vector: Column, scale: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    """False for a null vector or one with a component that is null, infinite or no number."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, bad), F.lit(False))


def bit_planes(vectors: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes: bit ``d`` of byte ``g`` of plane ``p`` is bit ``p`` of component 8 g + d."""
    shifted = (vectors[:, None, :] >> np.arange(planes, dtype=np.int64)[None, :, None]) & 1
    return np.packbits(shifted.astype(np.uint8), axis=2, bitorder="little")


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): the sum of the components picked by each byte, for every eight dimensions."""
    n, dims = anchors.shape
    groups = -(-dims // 8)
    padded = np.zeros((n, groups * 8), dtype=np.int64)
    padded[:, :dims] = anchors
    tables = np.zeros((groups, 256, n), dtype=np.int64)
    for d in range(8):
        tables[:, 1 << d:2 << d] = tables[:, :1 << d] + padded[:, d::8].T[:, None, :]
    return tables


def scores(tables: np.ndarray, bits: np.ndarray, most: int) -> np.ndarray:
    """(rows, anchors) inner products; ``most`` bounds the size of any score.

    Sums of one plane are at most as large as a score, so both fit the same type.
    """
    total = np.zeros((len(bits), tables.shape[2]), dtype=np.int32 if most < 1 << 31 else np.int64)
    narrow = tables.astype(np.int16) if np.abs(tables).max(axis=(1, 2)).sum() < 1 << 15 else tables.astype(total.dtype)
    planes = bits.shape[1]
    for p in range(planes):
        share = narrow[0].take(bits[:, p, 0], axis=0)
        for g in range(1, bits.shape[2]):
            share += narrow[g].take(bits[:, p, g], axis=0)
        wide = share.astype(total.dtype) << p
        total = total - wide if p == planes - 1 else total + wide
    return total


class Best:
    """The first ``k`` rows of each of ``n`` lists, by descending score, then id, then key."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score, self.id, self.key = (np.full((n, k), NONE, dtype=np.int64) for _ in range(3))

    def add(self, at: slice, ranked: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        """``ranked`` (lists, rows): score x rows + (rows - 1 - place) where the row counts, else NONE; rows lie in order of (id, key)."""
        n = ranked.shape[1]
        if n > self.k:
            ranked = np.partition(ranked, n - self.k, axis=1)[:, n - self.k:]
        there = ranked != NONE
        place = np.where(there, n - 1 - ranked % n, 0)
        found = [np.where(there, ranked // n, NONE), np.where(there, ids[place], NONE), np.where(there, keys[place], NONE)]
        score, id_, key = (np.concatenate([old[at], new], axis=1)
                           for old, new in zip((self.score, self.id, self.key), found, strict=True))
        # the least number has no negative: turn the order round by its complement
        order = np.lexsort((key, id_, ~score), axis=1)[:, :self.k]
        for mine, new in zip((self.score, self.id, self.key), (score, id_, key), strict=True):
            mine[at] = np.take_along_axis(new, order, axis=1)


class Anchors:
    """The anchors of one pass: ids, keys, labels and whole components, and the bounds of each positive's negatives."""

    def __init__(self, rows: list, dims: int):
        self.id = np.array([r.vec_id for r in rows], dtype=np.int64)
        self.key = np.array([r.row_key for r in rows], dtype=np.int64)
        self.label = np.array([r.label for r in rows], dtype=np.int64)
        self.vector = np.zeros((len(rows), dims), dtype=np.int64)
        for i, r in enumerate(rows):
            self.vector[i, :len(r.vector)] = r.vector


def _batches(batches: Iterator[pa.RecordBatch], planes: int, groups: int):
    """Pieces of rows in order of (id, key): ids, keys, labels, bits."""
    for batch in batches:
        for start in range(0, batch.num_rows, PIECE):
            piece = batch.slice(start, PIECE)
            ids, keys, labels = (piece.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("vec_id", "row_key", "label"))
            bits = np.frombuffer(b"".join(piece.column("bits").to_pylist()), dtype=np.uint8).reshape(-1, planes, groups)
            order = np.lexsort((keys, ids))
            yield ids[order], keys[order], labels[order], bits[order]


def _positives(anchors: Anchors, planes: int, groups: int, most: int, k: int):
    def run(batches):
        best = Best(len(anchors.id), k)
        for ids, keys, labels, bits in _batches(batches, planes, groups):
            n = len(ids)
            for a in range(0, len(anchors.id), BLOCK):
                at = slice(a, a + BLOCK)
                score = scores(subset_sums(anchors.vector[at]), bits, most).T.astype(np.int64)
                mine = (anchors.id[at, None] == ids[None, :]) & (anchors.key[at, None] == keys[None, :])
                counts = (anchors.label[at, None] == labels[None, :]) & ~mine
                best.add(at, np.where(counts, score * n + np.arange(n - 1, -1, -1), NONE), ids, keys)
        i, j = np.nonzero(best.score != NONE)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (anchors.id[i], anchors.key[i], best.id[i, j], best.key[i, j], best.score[i, j])],
            ["anchor_id", "anchor_key", "positive_id", "positive_key", "positive_score"])

    return run


def _negatives(anchors: Anchors, places: np.ndarray, positives: np.ndarray, planes: int, groups: int, most: int, k: int, low: int, high: int):
    """``places`` (anchors, j): number of the anchor's j-th positive among ``positives`` (id, key, score), -1 for none."""
    def run(batches):
        owner = np.zeros(len(positives), dtype=np.int64)
        for j in range(places.shape[1]):
            owner[places[places[:, j] >= 0, j]] = np.flatnonzero(places[:, j] >= 0)
        best = Best(len(positives), k)
        for ids, keys, labels, bits in _batches(batches, planes, groups):
            n = len(ids)
            back = np.arange(n - 1, -1, -1)
            for a in range(0, len(anchors.id), BLOCK):
                at = slice(a, a + BLOCK)
                score = scores(subset_sums(anchors.vector[at]), bits, most).T.astype(np.int64)
                other = anchors.label[at, None] != labels[None, :]
                ranked = score * n + back
                for j in range(places.shape[1]):
                    has = np.flatnonzero(places[at, j] >= 0)
                    place = places[at, j][has]
                    bound, hundred = positives[place, 2][:, None], 100 * score[has]
                    counts = other[has] & (low * bound <= hundred) & (hundred <= high * bound)
                    best.add(place, np.where(counts, ranked[has], NONE), ids, keys)
        i, j = np.nonzero(best.score != NONE)
        mine = owner[i]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (anchors.id[mine], anchors.key[mine], positives[i, 0], positives[i, 1], positives[i, 2],
                                   best.id[i, j], best.key[i, j], best.score[i, j])],
            ["anchor_id", "anchor_key", "positive_id", "positive_key", "positive_score", "negative_id", "negative_key", "negative_score"])

    return run


def _first(df: DataFrame, of: list[str], score: str, ids: list[str], k: int) -> DataFrame:
    """The first k rows of each group, with their rank. Spark cuts groups to k rows before it shuffles them."""
    rank = F.row_number().over(Window.partitionBy(*of).orderBy(F.col(score).desc(), *ids))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def coded(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Rows (vec_id, label, vector, row_key) that take part, equal ones once; ``vector`` holds whole numbers."""
    kept = rows.select(rows[key].cast("long").alias("vec_id"), rows[label].cast("long").alias("label"), rows[vector].alias("vector"))
    kept = kept.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vector")))
    kept = kept.withColumn("vector", whole_components(F.col("vector"))).distinct()
    return kept.withColumn("row_key", F.xxhash64("label", "vector"))


def mine(rows: DataFrame, is_anchor: Column, *, key: str = "vec_id", vector: str = "embedding", label: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, anchors_a_pass: int = PASS,
         name: str = "negatives") -> DataFrame:
    """Hard negatives (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is an expression over the column ``vec_id``. Of each anchor the first ``positives`` other rows of its label are its
    positives; of each of those, the first ``negatives`` rows of another label are returned whose score lies between ``low`` and
    ``high`` per cent of the positive's. Scores are inner products of floor(256 x); ties go by id.

    Rows without id, label or vector, or with a component that is null or not finite, take no part. Equal rows (id, label and whole
    components) count once; rows that share only the id are rows of their own. A vector that is shorter than the longest one is
    taken as zero beyond its end. An anchor without positives or negatives gives no row, an empty table none. Components so large that a score
    could pass 63 bits raise an error. Other columns are not looked at.
    """
    spark = rows.sparkSession
    # the distinct rows are read by several jobs, so they are written
    with staged(coded(rows, key=key, vector=vector, label=label), f"{name}-coded") as whole:
        size = whole.agg(F.max(F.greatest(F.abs(F.array_max("vector")), F.abs(F.array_min("vector")))), F.max(F.size("vector"))).first()
        largest, dims = size[0] or 0, max(size[1] or 0, 1)
        planes, groups = int(largest).bit_length() + 1, -(-dims // 8)
        most = dims * (int(largest) + 1) ** 2
        if most * max(PIECE, 100, high, low) >= 1 << 63:
            raise ValueError(f"components up to {largest} in {dims} dimensions: scores do not fit 63 bits")

        def pack(batches):
            for batch in batches:
                lists = batch.column("vector")
                lengths = np.diff(lists.offsets.to_numpy())
                dense = np.zeros((batch.num_rows, groups * 8), dtype=np.int64)
                dense[np.repeat(np.arange(batch.num_rows), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = (
                    lists.flatten().to_numpy())
                packed = bit_planes(dense, planes).reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("row_key"), batch.column("label"), pa.array([r.tobytes() for r in packed], pa.binary())],
                    ["vec_id", "row_key", "label", "bits"])

        index_type = "vec_id long, row_key long, label long, bits binary"
        with staged(whole.select("vec_id", "row_key", "label", "vector").mapInArrow(pack, index_type), f"{name}-index") as index:
            # anchors are dealt to passes by hash: a pass has about so many of them
            anchors = whole.where(is_anchor)
            passes = -(-anchors.count() // max(1, min(anchors_a_pass, PASS_BYTES // (8 * dims))))
            found = []
            for p in range(passes):
                rows_of = anchors.where(F.pmod(F.xxhash64("row_key", "vec_id"), F.lit(passes)) == p).collect()
                if rows_of:
                    found.append(_one_pass(spark, Anchors(rows_of, dims), index, planes, groups, most, positives, negatives, low, high, f"{name}-pass"))
    out = found[0] if found else spark.createDataFrame([], RESULT)
    for more in found[1:]:
        out = out.unionByName(more)
    return out


RESULT = T.StructType([
    T.StructField("anchor_id", T.LongType()), T.StructField("positive_id", T.LongType()), T.StructField("rank", T.IntegerType()),
    T.StructField("negative_id", T.LongType()), T.StructField("positive_score", T.LongType()), T.StructField("negative_score", T.LongType())])


def _one_pass(spark: SparkSession, anchors: Anchors, index: DataFrame, planes, groups, most, k_pos, k_neg, low, high, name) -> DataFrame:
    near = index.mapInArrow(_positives(anchors, planes, groups, most, k_pos),
                            "anchor_id long, anchor_key long, positive_id long, positive_key long, positive_score long")
    # at most k_pos rows an anchor of the pass
    chosen = _first(near, ["anchor_id", "anchor_key"], "positive_score", ["positive_id", "positive_key"], k_pos).collect()
    place_of = {(i, k): n for n, (i, k) in enumerate(zip(anchors.id.tolist(), anchors.key.tolist(), strict=True))}
    places = np.full((len(anchors.id), k_pos), -1, dtype=np.int64)
    for n, r in enumerate(chosen):
        places[place_of[r.anchor_id, r.anchor_key], r["rank"] - 1] = n
    positives = np.array([(r.positive_id, r.positive_key, r.positive_score) for r in chosen], dtype=np.int64).reshape(-1, 3)
    far = index.mapInArrow(
        _negatives(anchors, places, positives, planes, groups, most, k_neg, low, high),
        "anchor_id long, anchor_key long, positive_id long, positive_key long, positive_score long, negative_id long, negative_key long, "
        "negative_score long")
    best = _first(far, ["anchor_id", "anchor_key", "positive_id", "positive_key", "positive_score"], "negative_score",
                  ["negative_id", "negative_key"], k_neg)
    return stage(best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"), name)
