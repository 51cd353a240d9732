"""Near-duplicate join on word shingles by a MinHash LSH forest, verified exactly.

1. Each document is reduced to the fingerprint of its set of shingles and a MinHash
   signature. Documents with equal sets are one class from here on.
2. The signature is cut into trees. The parts of all classes are sorted over the cluster,
   tree by tree, which lays out the prefix tries: classes under a node lie next to each other,
   and what a class shares with its neighbours is the longest prefix it shares with any.
   Whoever shares too short a prefix in a tree leaves it there, before anything is joined.
3. Classes that share a prefix are a candidate group. Prefixes begin at full depth and are
   shortened for those classes only that have found no partner yet, until a pair at the
   threshold shares one in some tree with the target probability.
4. Within a group pairs are compared by whole signatures, with a margin of many
   standard errors, and only the links of a spanning tree leave the task. Their
   components are near-duplicate families.
5. A large family is held against one of its members first: if all are within half the
   greatest distance of it, all pairs are linked, since Jaccard distance is a metric. The shingle
   sets of every other family are compared exactly, pair by pair. What leaves the task is
   a count of links for each class and again a spanning tree.

Groups and families beyond a block are cut into blocks, bounded in members and bytes, and each pair of blocks
is one bounded piece of work, so no pair is left out and none is written as a row. A pair of blocks
hands out links between the components of the two, not between members, and a task one count for each class.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.llm import shingles as S
from panelweave.llm.common import packed, small_side
from panelweave.llm.components import components
from panelweave.session import stage

TREES, DEPTH = 16, 6
HASHES = TREES * DEPTH
THRESHOLD, TARGET = 0.8, 0.9995
#: Standard errors that a signature's estimate may stay below the threshold.
MARGIN = 6
#: Members and bytes of a block; rows of a piece compared at a time.
BLOCK, BLOCK_BYTES, TILE = 2048, 16 << 20, 256
_FACTORS = np.random.default_rng(11).integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def recall(similarity: float, depth: int, trees: int = TREES) -> float:
    """Probability that a pair shares a prefix of ``depth`` values in at least one tree."""
    return 1 - (1 - similarity ** depth) ** trees


def prefix_depth(threshold: float = THRESHOLD, target: float = TARGET) -> int:
    depth = DEPTH
    while depth > 1 and recall(threshold, depth) < target:
        depth -= 1
    return depth


def signatures(sets: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints (n, 2) and MinHash signatures (n, HASHES) of documents that all have shingles."""
    fingerprint = np.stack([np.add.reduceat(S.mixed(sets, salt), begin[:-1]) for salt in (2, 3)], axis=1)
    signature = np.empty((len(begin) - 1, HASHES), dtype=np.uint32)
    product = np.empty_like(sets)
    for k, factor in enumerate(_FACTORS):
        np.multiply(sets, factor, out=product)
        signature[:, k] = np.minimum.reduceat(product, begin[:-1]) >> np.uint64(32)
    return fingerprint, signature


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.dtype.itemsize * rows.shape[1]
    offsets = pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, offsets, pa.py_buffer(np.ascontiguousarray(rows))])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in S.chunks(batches, "text"):
        sets, begin = S.distinct(*S.word_hashes(texts).shingles())
        worded = np.flatnonzero(np.diff(begin))
        keys = batch.drop_columns(["text"])
        empty = keys.take(pa.array(np.flatnonzero(np.diff(begin) == 0)))
        if len(worded):
            fingerprint, signature = signatures(sets, np.append(begin[worded], begin[-1]))
            yield pa.RecordBatch.from_arrays(
                [*keys.take(pa.array(worded)).columns, _binary(fingerprint), _binary(signature)], [*keys.schema.names, "fp", "signature"])
        if empty.num_rows:
            nothing = pa.nulls(empty.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([*empty.columns, nothing, nothing], [*keys.schema.names, "fp", "signature"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in S.chunks(batches, "text"):
        sets, begin = S.distinct(*S.word_hashes(texts).shingles())
        whole = [sets[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("fp"), pa.array(whole, pa.binary())], ["fp", "shingles"])


def _matched(shortest: int):
    """Kernel: of sorted rows (tree, slice, fp) those that share at least ``shortest`` values with a neighbour, and how many.

    The first and the last row of a task have a neighbour elsewhere and count as sharing everything.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, DEPTH  # the last row, whose next neighbour is not known yet, and what it shares with the one before

        def out(rows: pa.RecordBatch, shared: np.ndarray):
            keep = np.flatnonzero(shared >= shortest)
            return pa.RecordBatch.from_arrays(
                [*rows.take(pa.array(keep)).columns, pa.array(shared[keep].astype(np.int32))], [*rows.schema.names, "shared"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = pa.Table.from_batches([held, batch] if held is not None else [batch]).combine_chunks().to_batches()[0]
            values = np.frombuffer(b"".join(rows.column("slice").to_pylist()), dtype=np.uint32).reshape(-1, DEPTH)
            tree = rows.column("tree").to_numpy()
            equal = (values[1:] == values[:-1]) & (tree[1:] == tree[:-1])[:, None]
            common = np.append(before, np.cumprod(equal, axis=1).sum(1))
            yield out(rows.slice(0, len(rows) - 1), np.maximum(common[:-1], common[1:]))
            held, before = rows.slice(len(rows) - 1), common[-1]
        if held is not None:
            yield out(held, np.array([DEPTH]))

    return run


def _spanning(pairs: np.ndarray, n: int) -> np.ndarray:
    """For each of n nodes the least node it is linked with, directly or not."""
    root = np.arange(n)
    if len(pairs) == 0:
        return root
    while True:
        low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        new = root.copy()
        np.minimum.at(new, pairs[:, 0], low)
        np.minimum.at(new, pairs[:, 1], low)
        np.minimum.at(new, root[pairs[:, 0]], low)
        np.minimum.at(new, root[pairs[:, 1]], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _blocks(group: pa.RecordBatch) -> Iterator[tuple[np.ndarray, list[bytes], list[bytes], bool]]:
    for at in range(group.num_rows):
        row = group.slice(at, 1).to_pylist()[0]
        members = sorted(row["members"], key=lambda m: m["fp"])
        yield (np.array([m["mine"] for m in members]), [m["fp"] for m in members], [m["value"] for m in members],
               row["i"] == row["j"])


class _Forest:
    """Spanning tree of the links of one piece: of all members for one block; between the components of the two blocks else.

    Links within a block are those of the piece that has the block alone.
    """

    def __init__(self, mine: np.ndarray, same: bool):
        self.n, self.mine, self.same = len(mine), mine, same
        self.within = self.across = np.arange(self.n)

    def add(self, start: int, found: np.ndarray) -> None:
        """``found`` (rows from ``start``, members) tells which are linked."""
        pairs = np.argwhere(found)
        pairs[:, 0] += start
        if not self.same:
            apart = self.mine[pairs[:, 0]] != self.mine[pairs[:, 1]]
            self.within = _joined(self.within, pairs[~apart])
            self.across = _joined(self.across, pairs[apart])
        else:
            self.across = _joined(self.across, pairs)

    def edges(self) -> Iterator[tuple[int, int]]:
        nodes = np.arange(self.n)
        if self.same:
            yield from ((i, self.across[i]) for i in np.flatnonzero(self.across != nodes))
            return
        # one member of each component of either block answers for it
        pairs = np.unique(np.stack([self.within, self.within[self.across]], axis=1), axis=0)
        root = _spanning(pairs, self.n)
        yield from ((i, root[i]) for i in np.flatnonzero((self.within == nodes) & (root != nodes)))


def _joined(root: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    if len(pairs) == 0:
        return root
    return _spanning(np.vstack([pairs, np.stack([np.arange(len(root)), root], axis=1)]), len(root))


def _likely(least: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for mine, fps, values, same in _blocks(batch):
                signature = np.frombuffer(b"".join(values), dtype=np.uint32).reshape(len(fps), HASHES).T.copy()
                forest = _Forest(mine, same)
                for start in range(0, len(fps), TILE):
                    tile = signature[:, start:start + TILE]
                    equal = np.zeros((tile.shape[1], len(fps) - start), dtype=np.uint8)
                    for k in range(HASHES):
                        equal += tile[k][:, None] == signature[k, start:][None, :]
                    found = np.zeros((tile.shape[1], len(fps)), dtype=bool)
                    found[:, start:] = equal >= least * HASHES
                    forest.add(start, found)
                for i, j in forest.edges():
                    a.append(fps[i])
                    b.append(fps[j])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return compare


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, from the shingles that at least two sets hold; exact below 2^24 shingles."""
    n = len(sets)
    if n == 2:
        shared = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), shared], [shared, len(sets[1])]], dtype=np.float32)
    values, place, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    column = np.cumsum(counts > 1) - 1
    keep = counts[place] > 1
    columns, owner, out = column[place[keep]], owner[keep], np.zeros((n, n), dtype=np.float32)
    order = np.argsort(columns, kind="stable")
    columns, owner = columns[order], owner[order]
    for low in range(0, int((counts > 1).sum()), 2048):
        a, b = np.searchsorted(columns, (low, low + 2048))
        held = np.zeros((n, 2048), dtype=np.float32)
        held[owner[a:b], columns[a:b] - low] = 1
        out += held @ held.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _verified(threshold: float):
    """Kernel: rows (a, b, null) of a spanning tree of links, and (a, null, links), one for each class that has any in this task."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            a, b = [], []
            for mine, fps, values, same in _blocks(batch):
                sets = [np.frombuffer(v, dtype=np.uint64) for v in values]
                size = np.array([len(s) for s in sets], dtype=np.float32)
                shared = intersections(sets) if len(sets) > 1 else size[:, None]
                forest, links = _Forest(mine, same), np.zeros(len(fps), dtype=np.int64)
                for start in range(0, len(fps), TILE):
                    rows = slice(start, start + TILE)
                    close = shared[rows] >= np.float64(threshold) * (size[rows, None] + size[None, :] - shared[rows]) - 1e-9
                    close[np.arange(len(close)), start + np.arange(len(close))] = False
                    forest.add(start, close)
                    links[rows] = (close if same else close & (mine[rows, None] != mine[None, :])).sum(1)
                for i, j in forest.edges():
                    a.append(fps[i])
                    b.append(fps[j])
                counts.update({fps[i]: int(links[i]) for i in np.flatnonzero(links)})
            yield _links(a, b, [None] * len(a))
        yield _links(list(counts), [None] * len(counts), list(counts.values()))

    return compare


def _links(a: list, b: list, links: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(links, pa.int64())], ["a", "b", "links"])


def _far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kernel: shingles that a member shares with the pivot of its family, and those of either."""
    for batch in batches:
        shared, either = [], []
        for at in range(batch.num_rows):
            one, pivot = (np.frombuffer(batch.column(c)[at].as_buffer(), dtype=np.uint64) for c in ("value", "pivot"))
            shared.append(len(np.intersect1d(one, pivot, assume_unique=True)))
            either.append(len(one) + len(pivot) - shared[-1])
        yield pa.RecordBatch.from_arrays([batch.column("group"), pa.array(shared, pa.int64()), pa.array(either, pa.int64())], ["group", "shared", "either"])


def tight_families(members: DataFrame, threshold: float) -> DataFrame:
    """Groups (group) of members (group, blocks, mine, fp, value) in which every pair is linked, by one comparison a member.

    All members are within (1 - threshold) / 2 of the one with the least fp. Its set goes to every block of the group.
    """
    first = members.groupBy("group").agg(F.min("fp").alias("fp"), F.first("blocks").alias("all"))
    pivots = members.select("group", "fp", "value").join(first, ["group", "fp"]).select(
        "group", F.col("value").alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("all") - 1)).alias("mine"))
    compared = members.join(pivots, ["group", "mine"]).select("group", "value", "pivot").mapInArrow(
        _far, f"group {members.schema['group'].dataType.simpleString()}, shared long, either long")
    near = F.col("shared") >= (1 + threshold) / 2 * F.col("either")
    return compared.groupBy("group").agg(F.min(near.cast("int")).alias("tight")).where("tight = 1").select("group")


def dealt(rows: DataFrame, size: str | None = None) -> DataFrame:
    """Rows (group, n, ...) with the number of blocks of their group and the block that each belongs to.

    A group of up to BLOCK members and (``size``: bytes of the group) BLOCK_BYTES is one block. Else members are dealt by hash.
    """
    blocks = F.ceil(F.col("n") / BLOCK)
    if size is not None:
        blocks = F.greatest(blocks, F.least(F.col("n"), F.ceil(F.col(size) / BLOCK_BYTES)))
    return rows.withColumn("blocks", blocks.cast("int")).withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))


def in_blocks(rows: DataFrame) -> DataFrame:
    """Rows (group, blocks, mine, fp, value) as one row for each pair of blocks of a group, with the members of both."""
    paired = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return paired.groupBy(
        "group", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j")
    ).agg(F.collect_list(F.struct("fp", "mine", "value")).alias("members")).where(F.size("members") > 1)


def candidate_links(classes: DataFrame, threshold: float, target: float, name: str) -> DataFrame:
    """Edges (a, b) between classes (fp, signature) that are likely to be linked, from the forest."""
    shortest = prefix_depth(threshold, target)
    trees = F.posexplode(F.array(*(F.substring("signature", 4 * DEPTH * t + 1, 4 * DEPTH) for t in range(TREES))))
    entries = classes.select("fp", trees.alias("tree", "slice")).select("tree", "slice", "fp")
    order = ["tree", "slice", "fp"]
    live = stage(entries.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _matched(shortest), "tree int, slice binary, fp binary, shared int"), f"{name}-live")
    error = math.sqrt(threshold * (1 - threshold) / HASHES)
    same = ["n", "members", "least_fp"]
    links = done = None
    for depth in range(DEPTH, shortest - 1, -1):
        node = F.xxhash64("tree", F.substring("slice", 1, 4 * depth))
        at = live.where(F.col("shared") >= depth).select("fp", node.alias("group"), F.lit(True).alias("alone"))
        if links is not None:
            found = links.select(F.explode(F.array("a", "b")).alias("fp")).distinct().withColumn("linked", F.lit(True))
            at = at.join(found, "fp", "left").select("fp", "group", F.col("linked").isNull().alias("alone"))
        groups = at.groupBy("group").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("fp")).alias("members"),
                                         F.min("fp").alias("least_fp"), F.max("alone").alias("alone"))
        groups = groups.where("n > 1 and alone").groupBy(*same).agg(F.min("group").alias("group"))
        if done is not None:  # a node with the members of a longer prefix has been compared
            groups = groups.join(done, same, "left_anti")
        groups = stage(groups, f"{name}-groups")
        done = groups.select(*same) if done is None else done.unionByName(groups.select(*same))
        members = dealt(at.select("fp", "group").join(groups.select("group", "n"), "group"))
        values = members.join(classes.select("fp", F.col("signature").alias("value")), "fp")
        edges = stage(in_blocks(values).mapInArrow(_likely(threshold - MARGIN * error), "a binary, b binary"), f"{name}-likely")
        links = edges if links is None else links.unionByName(edges)
    return links


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                    name: str = "near") -> DataFrame:
    """One row for each document: (key, text_hash, class_id, copies, n_links, family).

    ``class_id`` is the least key of the family, that is of the documents connected by
    links of similarity ``threshold`` or more; ``copies`` counts the documents with the same
    shingles, itself included; ``n_links`` counts the other shingle sets linked with its
    own. A text with one to four words has one shingle, all of it. Texts without words
    (null, empty, signs only) are a class of their own each, without links. Equal rows
    each get a row. Null keys come last: a family has class_id null only if all its keys
    are null. ``family`` names the family even where keys are null or repeat; it is null
    for texts without words. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    key_type = docs.schema[key].dataType
    body = docs.select(docs[key].alias("key"), F.xxhash64(docs[text]).alias("text_hash"), F.lower(docs[text]).alias("text"))
    ids = [T.StructField("key", key_type), T.StructField("text_hash", T.LongType())]
    sketch = T.StructType([*ids, T.StructField("fp", T.BinaryType()), T.StructField("signature", T.BinaryType())])
    sketched = stage(body.mapInArrow(_sketch, sketch), f"{name}-sketch")
    classes = stage(sketched.where("fp is not null").groupBy("fp").agg(
        F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "text_hash")).alias("sample"), F.min("key").alias("least"),
        F.count("*").alias("copies"), F.min("signature").alias("signature")), f"{name}-classes")

    families = components(candidate_links(classes, threshold, TARGET, name), f"{name}-families")

    sizes = families.groupBy("label").agg(F.count("*").alias("n"))
    members = stage(families.join(sizes, "label").join(classes.withColumnRenamed("fp", "node"), "node").select(
        F.col("label").alias("group"), "n", F.col("node").alias("fp"), "sample"), f"{name}-members")
    wanted = small_side(members.select("fp", "sample.key", "sample.text_hash"), f"{name}-wanted")
    bodies = body.join(wanted, body["key"].eqNullSafe(wanted["key"]) & body["text_hash"].eqNullSafe(wanted["text_hash"])).select(
        "fp", "text")
    sets = stage(bodies.mapInArrow(_sets, "fp binary, shingles binary").groupBy("fp").agg(F.min("shingles").alias("value")), f"{name}-sets")
    weights = members.join(sets.select("fp", F.length("value").cast("long").alias("bytes")), "fp")
    weights = weights.join(weights.groupBy("group").agg(F.sum("bytes").alias("size")), "group")
    placed = stage(dealt(weights.select("group", "n", "size", "fp"), "size").select("group", "n", "blocks", "mine", "fp"), f"{name}-placed")
    tight = stage(tight_families(placed.where("blocks > 1").join(sets, "fp"), threshold), f"{name}-tight")
    loose = placed.join(tight, "group", "left_anti").join(sets, "fp")
    compared = in_blocks(loose).mapInArrow(_verified(threshold), "a binary, b binary, links long")
    # all pairs of a tight family are linked: a star around its label says so
    stars = placed.join(tight, "group", "left_semi").select(
        F.col("fp").alias("a"), F.inline(F.array(F.struct(F.col("group").alias("b"), F.lit(None).cast("long").alias("links")),
                                                 F.struct(F.lit(None).cast("binary").alias("b"), (F.col("n") - 1).alias("links")))))
    verified = stage(compared.unionByName(stars.where("b is null or a <> b")), f"{name}-verified")
    links = verified.where("links is not null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("n_links"))
    labels = components(verified.where("b is not null").select("a", "b"), f"{name}-classes-of").join(links, "node")
    linked = labels.join(classes.select(F.col("fp").alias("node"), "least", "copies"), "node")
    of_family = linked.groupBy("label").agg(F.min("least").alias("class_id"))
    known = linked.join(of_family, "label").select(F.col("node").alias("fp"), "label", "class_id", "n_links")
    by_class = classes.select("fp", "least", "copies").join(known, "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("family"), F.coalesce("class_id", "least").alias("class_id"), "copies",
        F.coalesce("n_links", F.lit(0)).alias("n_links"))
    by_class = stage(by_class, f"{name}-by-class")
    documents = sketched.select("key", "text_hash", "fp")
    return documents.join(by_class, "fp", "left").select(
        F.col("key").alias(key), "text_hash", F.when(F.col("fp").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.hex("family").alias("family"))


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                name: str = "near") -> DataFrame:
    """The documents without near duplicates: of each family the row with the least key (then text hash) stays.

    Documents without words all stay: nothing says that they are copies of one another.
    Of rows that agree in key and text one stays.
    """
    found = near_duplicates(docs, key=key, text=text, threshold=threshold, name=name)
    found = stage(found.select(F.col(key).alias("key"), "text_hash", "family"), f"{name}-found")
    counts = found.groupBy("key", "text_hash", "family").agg(F.count("*").alias("rows"))
    first = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "text_hash", "rows")).alias("first")
    worded = counts.where("family is not null").groupBy("family").agg(first).select(
        "first.key", "first.text_hash", (F.col("first.rows") > 1).alias("again"))
    bare = counts.where("family is null").select("key", "text_hash", F.lit(False).alias("again"))
    kept = worded.unionByName(bare).select(
        F.col("key").alias("key_"), F.col("text_hash").alias("hash_"), F.col("again").alias("again_"))
    kept = stage(kept, f"{name}-kept")
    whole = docs.select(packed(docs).alias("row"), docs[key].alias("k_"), F.xxhash64(docs[text]).alias("h_"))
    left = whole.join(kept, F.col("k_").eqNullSafe(F.col("key_")) & F.col("h_").eqNullSafe(F.col("hash_")))
    once = left.where("again_").groupBy("key_", "hash_").agg(F.min("row").alias("row")).select("row.*")
    return left.where("not again_").select("row.*").unionByName(once)
