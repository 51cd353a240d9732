"""Records of CSV files whose quoted fields hold line breaks, read by many tasks a file.

Whether a line break ends a record depends on the quotes before it in the whole file. Every
split is read as plain lines and reports whether it holds an odd number of quotes; from the splits before it
follows whether a split begins inside a quoted field. Then each split puts its records together on its
own. Only records cut by the end of a split, two pieces a split at most, are put together after; they are
looked for in the splits that begin or end inside quotes, and nowhere else.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

PIECES = "split long, inside boolean, row long, piece int, text string"
#: Of a record that lies in one split, of one that ends in it (or goes through), and of one that goes on in the next.
WHOLE, HEAD, TAIL = 0, 1, 2


def _pieces(cut: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Kernel: lines (split, inside, value) of splits one after the other, as pieces of records: the cut ones or the whole ones."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = kind = None
        # the record that is not over yet, which may have begun batches ago
        lines, inside, quoted, row = [], False, False, 0

        def rest() -> list[pa.RecordBatch]:
            return [_batch(key, inside, row, kind if kind == HEAD else TAIL, ["\n".join(lines)])] if lines and cut else []

        for batch in batches:
            if not batch.num_rows:
                continue
            split, values = batch.column("split").to_numpy(), batch.column("value")
            odd = pc.bit_wise_and(pc.count_substring(values, '"'), 1).to_numpy()
            for begin, end in pairwise([0, *(np.flatnonzero(np.diff(split)) + 1).tolist(), len(split)]):
                if split[begin] != key:
                    yield from rest()
                    key, inside, lines, row = int(split[begin]), batch.column("inside")[begin].as_py(), [], 0
                    quoted, kind = inside, HEAD if inside else WHOLE
                open_after = (np.cumsum(odd[begin:end]) + quoted) % 2
                quoted = bool(open_after[-1])
                ends = begin + 1 + np.flatnonzero(open_after == 0)
                if len(ends) and (lines or kind == HEAD):
                    lines += values[begin : ends[0]].to_pylist()
                    if cut == (kind == HEAD):
                        yield _batch(key, inside, row, kind, ["\n".join(lines)])
                    lines, kind, row, begin, ends = [], WHOLE, row + 1, int(ends[0]), ends[1:]
                if len(ends):
                    if not cut:
                        records = pa.ListArray.from_arrays(pa.array([begin, *ends.tolist()], pa.int32()), values)
                        yield _batch(key, inside, row, WHOLE, pc.binary_join(records, "\n"))
                    row, begin = row + len(ends), int(ends[-1])
                lines += values[begin:end].to_pylist()
        yield from rest()

    return kernel


def _batch(split: int, inside: bool, row: int, piece: int, texts: list[str] | pa.Array) -> pa.RecordBatch:
    n = len(texts)
    rows, pieces = pa.array(np.arange(row, row + n)), pa.array(np.full(n, piece, np.int32))
    columns = [pa.array(np.full(n, split)), pa.array(np.full(n, inside)), rows, pieces, pa.array(texts, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["split", "inside", "row", "piece", "text"])


# workers need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def quoted_records(spark: SparkSession, paths: str) -> DataFrame:
    """Rows (file, position, text): the records of all files as they stand, without the line break that ends them.

    A record ends with a line feed outside quotes, or one after a carriage return; empty records are left out. A quote within
    quotes is doubled, and fields without quotes hold none. ``position`` orders the records of a file. A last record
    whose quotes are not closed goes to the end of its file.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    parity = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("odd"))
    in_file = Window.partitionBy("file").orderBy("block")
    before = F.sum("odd").over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    # one row a split, of which the driver plans each anyway; lines and records carry its number, not the path
    splits = parity.select(
        "file", "block", "odd", (F.coalesce(before % 2, F.lit(0)) == 1).alias("inside"),
        F.row_number().over(Window.orderBy("file", "block")).cast("long").alias("split"))

    def pieces(of: DataFrame, how: str, cut: bool) -> DataFrame:
        numbered = lines.join(F.broadcast(of.select("file", "block", "inside", "split")), ["file", "block"], how)
        known = F.coalesce("split", F.raise_error(F.lit("files were split anew while they were read")).cast("long"))
        found = numbered.select(known.alias("split"), "inside", "value").mapInArrow(_pieces(cut), PIECES)
        # with inside among the keys, both joins read the same counts of quotes
        return found.join(F.broadcast(splits.select("split", "inside", "file", "block")), ["split", "inside"], "left")

    whole = pieces(splits, "left", False).select("file", "block", "row", "text")
    cut = pieces(splits.where("inside OR odd = 1"), "inner", True)
    # a tail opens a record that all heads up to the next tail belong to
    so_far = Window.partitionBy("file").orderBy("block", "row", "piece")
    numbered = cut.withColumn("number", F.sum((F.col("piece") == TAIL).cast("int")).over(so_far))
    parts = numbered.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("block", "row", "piece", "text"))).alias("parts"))
    joined = parts.select("file", F.get("parts", F.lit(0))["block"].alias("block"), F.get("parts", F.lit(0))["row"].alias("row"),
                          F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))
    records = whole.unionByName(joined)
    text = F.when(F.contains("text", F.lit("\r")), F.regexp_replace("text", "\r$", "")).otherwise(F.col("text"))
    return records.select("file", F.struct("file", "block", "row").alias("position"), text.alias("text")).where("text <> ''")
