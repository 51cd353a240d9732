"""Allow and block lists over URLs, kept as a sorted digest array that tasks map into memory.

1. The list is sorted by the 64-bit xxhash of its entries over the cluster and written as
   segments: digests, offsets and the full entries one after the other, each a block of plain
   bytes. Spark hands every executor a copy of the files.
2. A URL asks for every entry that could fit it: its host and each parent domain, with each
   beginning of its path that is as long as some path of the list.
3. Tasks map the segments and look up all digests of a batch by binary search. Where a
   digest is found, the stored entry is compared with the key itself, so a collision fits nothing.

URLs are never shuffled. The array is not read as a whole: a lookup touches the pages of
memory that the search goes through, and all workers of a machine share them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelweave.llm.common import packed
from panelweave.session import stage_folder

#: Entries of one segment.
SEGMENT = 1 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to the next of / ? # or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ? or # or the end."""
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _images(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (digest, entry, number) as images of up to SEGMENT rows: count, digests, numbers, offsets, entries."""
    def image(digests, numbers, entries):
        lengths = np.array([len(e) for e in entries], dtype=np.int64)
        return b"".join([np.array([len(entries)], dtype="<i8").tobytes(), np.concatenate(digests).astype("<i8").tobytes(),
                         np.concatenate(numbers).astype("<i8").tobytes(),
                         np.concatenate(([0], np.cumsum(lengths))).astype("<i8").tobytes(), *entries])

    digests, numbers, entries = [], [], []
    for batch in batches:
        for start in range(0, batch.num_rows, SEGMENT):
            part = batch.slice(start, SEGMENT)
            if entries and len(entries) + part.num_rows > SEGMENT:
                yield pa.RecordBatch.from_arrays([pa.array([image(digests, numbers, entries)], pa.binary())], ["image"])
                digests, numbers, entries = [], [], []
            digests.append(part.column("digest").to_numpy())
            numbers.append(part.column("number").to_numpy())
            entries += part.column("entry").cast(pa.binary()).to_pylist()
    if entries:
        yield pa.RecordBatch.from_arrays([pa.array([image(digests, numbers, entries)], pa.binary())], ["image"])


class DigestArray:
    """Names of the files that hold the array; ``lengths`` are those of the paths of its entries, none for a bare host."""

    def __init__(self, files: list[str], lengths: list[int]):
        self.files, self.lengths = files, lengths

    def segments(self) -> list[tuple]:
        """(digests, numbers, offsets, bytes) of each segment, mapped from the executor's copy of the files."""
        out = []
        for name in self.files:
            data = np.memmap(SparkFiles.get(name), dtype=np.uint8, mode="r")
            at = 0
            while at < len(data):
                n = int(data[at:at + 8].view("<i8")[0])
                digests, numbers = (data[at + 8 + 8 * n * i:at + 8 + 8 * n * (i + 1)].view("<i8") for i in (0, 1))
                begin = at + 8 + 16 * n
                offsets = data[begin:begin + 8 * (n + 1)].view("<i8")
                body = begin + 8 * (n + 1)
                out.append((digests, numbers, offsets, data[body:body + int(offsets[-1])]))
                at = body + int(offsets[-1]) + 1  # a line feed ends the row
        return out


def digest_array(entries: DataFrame, name: str = "url-list") -> DigestArray:
    """The array of ``entries`` (entry string, number long): host or host and path of an entry, and what a match returns.

    Null entries are left out; of equal ones the least number counts. The files stay with the session.
    """
    spark = entries.sparkSession
    whole = entries.where(F.col("entry").isNotNull()).groupBy("entry").agg(F.min(F.col("number").cast("long")).alias("number"))
    rows = whole.select(F.xxhash64("entry").alias("digest"), "entry", "number")
    slash = F.instr("entry", "/")
    lengths = whole.select(F.when(slash > 0, F.length("entry") - slash + 1).otherwise(0).alias("n")).distinct().collect()
    images = rows.repartitionByRange("digest", "entry").sortWithinPartitions("digest", "entry").mapInArrow(_images, "image binary")
    folder = f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"
    # the bytes of an image are written as they are
    images.select(F.col("image").cast("string")).write.text(folder)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop)
    files = [s.getPath() for s in found if s.getPath().getName().startswith("part-") and s.getLen() > 0]
    for path in files:
        spark.sparkContext.addFile(path.toString())
    return DigestArray([path.getName() for path in files], sorted(r.n for r in lengths))


def keys_of(host: Column, path: Column, lengths: list[int]) -> Column:
    """Every key that an entry fitting (host, path) can have, the longest host first and the longest path first within it."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*(F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(lengths, reverse=True))),
                      lambda p: p.isNotNull())
    return F.flatten(F.transform(suffixes, lambda s: F.transform(starts, lambda p: F.concat(s, p))))


def _probe(array: DigestArray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = array.segments()
        for batch in batches:
            keys, digests = batch.column("keys").flatten(), batch.column("digests").flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("keys").offsets.to_numpy()))
            hits, numbers = [], []
            for held, number, offsets, body in segments:
                mine = np.flatnonzero((digests >= held[0]) & (digests <= held[-1]))
                at = np.searchsorted(held, digests[mine])
                # entries of one digest lie next to each other: step through them until none is left to compare
                while len(mine):
                    same = (at < len(held)) & (held[np.minimum(at, len(held) - 1)] == digests[mine])
                    mine, at = mine[same], at[same]
                    stored = [body[offsets[i]:offsets[i + 1]].tobytes() for i in at]
                    asked = keys.take(pa.array(mine)).cast(pa.binary()).to_pylist()
                    equal = np.array([a == b for a, b in zip(stored, asked, strict=True)], dtype=bool)
                    hits.append(mine[equal])
                    numbers.append(number[at[equal]])
                    mine, at = mine[~equal], at[~equal] + 1
            hit, number = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (hits, numbers))
            order = np.argsort(hit, kind="stable")
            hit, number = hit[order], number[order]
            texts = keys.take(pa.array(hit)).to_pylist()
            fits = [[] for _ in range(batch.num_rows)]
            for r, key, n in zip(row[hit].tolist(), texts, number.tolist(), strict=True):
                fits[r].append({"entry": key, "number": n})
            kind = pa.list_(pa.struct([("entry", pa.string()), ("number", pa.int64())]))
            kept = [batch.column(c) for c in batch.schema.names if c not in ("keys", "digests")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(fits, kind)], [*(c for c in batch.schema.names if c not in ("keys", "digests")), "fits"])

    return run


def match(pages: DataFrame, array: DigestArray, *, url: str = "url", carry: tuple[str, ...] | None = None) -> DataFrame:
    """Rows (row, host, path, fits): the caller's columns as one struct, and all entries that fit, each with its number.

    An entry ``host`` fits the host and its subdomains, an entry ``host/path`` those whose path begins with its path.
    A null or empty URL, or one without ``://``, has an empty host and path and fits nothing but an entry that is empty itself.
    Equal rows each get a row; an empty table or list gives no rows or no fits. Columns of the caller cannot clash with these.
    """
    parts = pages.select(packed(pages, *(carry or ())).alias("row"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"))
    asked = parts.withColumn("keys", keys_of(F.col("host"), F.col("path"), array.lengths or [0]))
    asked = asked.withColumn("digests", F.transform("keys", lambda k: F.xxhash64(k)))
    fit = T.StructType([T.StructField("entry", T.StringType()), T.StructField("number", T.LongType())])
    return asked.mapInArrow(_probe(array), T.StructType([*parts.schema, T.StructField("fits", T.ArrayType(fit))]))


def longest(fits: Column) -> Column:
    """The longest entry that fits, of equally long ones that with the longer host; null where none does."""
    host_length = lambda e: F.when(F.instr(e, "/") > 0, F.instr(e, "/") - 1).otherwise(F.length(e))
    ranked = F.transform(fits, lambda f: F.struct(
        F.length(f["entry"]).alias("length"), host_length(f["entry"]).alias("host"), f["entry"].alias("entry"), f["number"].alias("number")))
    return F.array_max(ranked)


#: Numbers of entries: rules before the block list.
ALLOW, BLOCK, LISTED = 0, 1, 2


def judge(pages: DataFrame, rules: dict[str, str], listed: DataFrame, *, url: str = "url", carry: tuple[str, ...] | None = None,
          name: str = "url-list") -> DataFrame:
    """Rows (row, host, path, rule, verdict, listed).

    ``rules`` are entries with ``allow`` or ``block``; the longest that fits decides. Where none does, a URL is blocked if an
    entry of the column ``entry`` of ``listed`` fits it, and allowed otherwise. ``listed`` tells the longest such entry. An entry
    that is both a rule and listed counts as a rule.
    """
    spark = pages.sparkSession
    own = spark.createDataFrame([(r, ALLOW if v == "allow" else BLOCK) for r, v in rules.items()], "entry string, number long")
    array = digest_array(own.unionByName(listed.select("entry", F.lit(LISTED).cast("long").alias("number"))), name)
    found = match(pages, array, url=url, carry=carry)
    rule = longest(F.filter("fits", lambda f: f["number"] != LISTED))
    other = longest(F.filter("fits", lambda f: f["number"] == LISTED))
    verdict = F.when(rule["number"].isNotNull(), F.when(rule["number"] == ALLOW, "allow").otherwise("block")).otherwise(
        F.when(other.isNotNull(), "block").otherwise("allow"))
    return found.select("row", "host", "path", rule["entry"].alias("rule"), verdict.alias("verdict"), other["entry"].alias("listed"))
