"""Delimited text files, read the way Python's ``csv`` module reads them, split over tasks.

A file is read as lines. A line without a quote character is a record on its own, and Spark splits it. Lines with quotes
are parsed by ``csv`` inside tasks (doubled quotes, separators and backslashes in cells, quotes inside bare cells). A cell
with a line break makes a record of several lines: one scan of the lines with quotes finds the files that have any line
ending inside a quoted cell (read on its own, each line of a file without such a line is a whole record, by induction from
the first), and only these files are read in order, each by one task that streams its lines. All other files are split.

Every record keeps where it starts (file, block of the file, number of the line within the scan), from which
``line_numbers`` makes numbers of lines in files.
"""

from __future__ import annotations

import csv
import itertools
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_RECORD = "file string, block long, id long, cells array<string>"
#: Records, and characters, sent on at once.
_ROWS, _CHARS = 2_000, 4_000_000


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block (its first byte), id (ascending within a block), line."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))


def header(spark: SparkSession, path: str, sep: str) -> tuple[str, list[str]]:
    """The first line and its cells."""
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"{path} has no header")
    return first.value, next(csv.reader([first.value], delimiter=sep))


def _batches(records: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    types = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string())]
    held, size = [], 0
    for record in records:
        held.append(record)
        size += sum(map(len, record[3]))
        if len(held) >= _ROWS or size >= _CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=["file", "block", "id", "cells"])
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=["file", "block", "id", "cells"])


def _rows(batches) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _files_with_open_lines(lines: DataFrame, sep: str) -> list[str]:
    """Files with a line that ends inside a quoted cell (as many as files at most)."""

    def run(batches):
        csv.field_size_limit(sys.maxsize)
        found = set()
        for file, _, _, line in _rows(batches):
            if file not in found and sum(1 for _ in csv.reader([line + "\n", "end\n"], delimiter=sep)) < 2:
                found.add(file)
        yield pa.RecordBatch.from_pydict({"file": pa.array(sorted(found), pa.string())})

    quoted = lines.where(F.col("line").contains('"'))
    return sorted(r.file for r in quoted.mapInArrow(run, "file string").distinct().collect())


def read_records(spark: SparkSession, path: str, sep: str, skip: str | None = None) -> DataFrame:
    """file, block, id, cells of every record; empty lines and lines that equal ``skip`` (the header) are none."""
    lines = text_lines(spark, path)
    files = _files_with_open_lines(lines, sep)
    quoted = F.col("line").contains('"')
    whole = lines.where((F.col("line") != "") & (F.lit(True) if skip is None else F.col("line") != skip))
    if files:
        whole = whole.where(~F.col("file").isin(*files))

    def parse(batches):
        csv.field_size_limit(sys.maxsize)
        yield from _batches((file, block, id_, next(csv.reader([line], delimiter=sep))) for file, block, id_, line in _rows(batches))

    def stream(batches):
        csv.field_size_limit(sys.maxsize)

        def records():
            for _, own in itertools.groupby(_rows(batches), key=lambda r: r[0]):
                start: list[tuple] = []

                def text(own=own, start=start):
                    for row in own:
                        if not start:
                            if row[3] == skip:
                                continue
                            start.append(row)
                        yield row[3] + "\n"

                for cells in csv.reader(text(), delimiter=sep):
                    if cells:
                        yield (*start[0][:3], cells)
                    start.clear()

        yield from _batches(records())

    out = whole.where(~quoted).select("file", "block", "id", F.split("line", "\\" + sep if sep in "|.$^*+?()[]{}" else sep, -1).alias("cells"))
    out = out.unionByName(whole.where(quoted).mapInArrow(parse, _RECORD))
    if files:
        ordered = lines.where(F.col("file").isin(*files)).repartition("file").sortWithinPartitions("file", "block", "id")
        out = out.unionByName(ordered.mapInArrow(stream, _RECORD))
    return out


def line_numbers(records: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """``records`` (file, block, id, ...) with ``line``, the number of the first line of each in its file, from 1."""
    blocks = text_lines(spark, path).groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    joined = records.join(blocks.drop("n"), ["file", "block"])
    return joined.withColumn("line", F.col("before") + F.col("id") - F.col("first") + 1).drop("before", "first")
