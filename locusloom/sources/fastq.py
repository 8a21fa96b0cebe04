"""Sequencing reads in 4-line records.

Records are put together where their lines are read: a split knows how many lines of its file come before it, so which of its lines
begins a record, and a task strings its lines together by fours. Only lines at the edges of splits, at most three at each,
meet those of the neighbouring split by a shuffle. What comes before a split is known from a count of lines per split; that
first pass leaves out compressed files, which aren't split and so have neither lines before them nor edges.

(The pattern of the lines alone would not do: a line of qualities may begin with ``@`` or ``+``, and records are numbered.)
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import div
from .lines import MAX_BROADCAST_SPLITS, split_lines, split_runs

RECORD = 4
RECORDS = "file string, _rec bigint, name string, seq string, qual string"


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split its number of lines, its first three and its last three."""
    key, n, heads, tails = None, 0, [], []

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"file": key[0], "block": key[1], "n": n, "heads": heads, "tails": tails}], _EDGE_SCHEMA)

    for batch in batches:
        for found, begin, end in split_runs(batch):
            if found != key:
                if key is not None:
                    yield row()
                key, n, heads, tails = found, 0, [], []
            lines = batch.column("line")
            heads = (heads + lines.slice(begin, min(3, end - begin)).to_pylist())[:3]
            tails = (tails + lines.slice(max(begin, end - 3), min(3, end - begin)).to_pylist())[-3:]
            n += end - begin
    if key is not None:
        yield row()


_EDGE_SCHEMA = pa.schema([("file", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("heads", pa.list_(pa.string())), ("tails", pa.list_(pa.string()))])


def _whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records whose lines are all in one split; of a file in one split also a last record that lacks lines."""
    key, skip, rec, alone, held = None, 0, 0, False, pa.array([], pa.string())

    def records(lines: pa.Array) -> pa.RecordBatch:
        n = -(-len(lines) // RECORD)
        place = np.arange(n) * RECORD
        part = lambda k: lines.take(pa.array(np.where(place + k < len(lines), place + k, 0), mask=place + k >= len(lines)))
        columns = [pa.array([key[0]] * n, pa.string()), pa.array(rec + np.arange(n)), part(0), part(1), part(3)]
        return pa.RecordBatch.from_arrays(columns, ["file", "_rec", "name", "seq", "qual"])

    for batch in batches:
        for found, begin, end in split_runs(batch):
            if found != key:
                if alone and len(held):
                    yield records(held)
                before = batch.column("before")[begin].as_py() or 0
                key, alone = found, batch.column("alone")[begin].as_py()
                skip = -before % RECORD
                rec, held = (before + skip) // RECORD, pa.array([], pa.string())
            left_out = min(skip, end - begin)
            skip -= left_out
            lines = pa.concat_arrays([held, batch.column("line").slice(begin + left_out, end - begin - left_out)])
            full = len(lines) // RECORD * RECORD
            if full:
                yield records(lines.slice(0, full))
                rec += full // RECORD
            held = lines.slice(full)
    if alone and len(held):
        yield records(held)


def _split_edges(splits: DataFrame) -> DataFrame:
    """Records over several splits, from the lines at edges."""
    # Lines of a record that began before the split, and those of one that goes on behind it.
    skip = F.least(F.col("n"), F.pmod(-F.col("before"), F.lit(RECORD))).cast("int")
    rest = ((F.col("n") - skip) % RECORD).cast("int")
    first = F.transform(F.slice("heads", F.lit(1), skip), lambda x, i: F.struct((F.col("before") + i).alias("line_no"), x.alias("line")))
    begin = F.col("before") + F.col("n") - rest
    last = F.transform(F.slice("tails", F.size("tails") - rest + 1, rest), lambda x, i: F.struct((begin + i).alias("line_no"), x.alias("line")))
    lines = splits.select("file", F.inline(F.concat(first, last)))
    part = lambda k: F.max(F.when(F.col("line_no") % RECORD == k, F.col("line")))
    return lines.groupBy("file", div(F.col("line_no"), RECORD).alias("_rec")).agg(part(0).alias("name"), part(1).alias("seq"), part(3).alias("qual"))


def scan_fastq(spark: SparkSession, folder: str, interleaved: bool = True) -> DataFrame:
    """Chunks of a folder: every entry with ``.fq`` in its name, gzip by ending.

    Returns (chunk, file, rec_no, mate, name, seq, qual). ``rec_no`` counts records of a file from 0;
    with ``interleaved`` two records in a row are the mates 1 and 2 of one ``rec_no``. A last record that lacks lines has nulls.
    """
    path = os.path.join(folder, "*.fq*")
    lines, cut = split_lines(spark, path, recursiveFileLookup="true")
    splits = cut.mapInArrow(_edges, "file string, block bigint, n bigint, heads array<string>, tails array<string>")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    splits = splits.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))

    before = splits.select("file", "block", "before")
    if lines.rdd.getNumPartitions() <= MAX_BROADCAST_SPLITS:
        before = F.broadcast(before)
    inside = lines.join(before, ["file", "block"], "left").mapInArrow(_whole_records, RECORDS)
    records = (
        inside.unionByName(_split_edges(splits))
        .withColumn("chunk", F.regexp_extract("file", r"([^/=]*)\.fq[^/]*", 1))
        .withColumn("name", F.regexp_replace("name", "^@", ""))
    )
    if interleaved:
        records = records.withColumn("rec_no", div(F.col("_rec"), 2)).withColumn("mate", (F.col("_rec") % 2 + 1).cast("int"))
    else:
        records = records.withColumn("rec_no", F.col("_rec")).withColumn("mate", F.lit(1))
    return records.select("chunk", "file", "rec_no", "mate", "name", "seq", "qual")
