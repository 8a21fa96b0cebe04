"""Queries that write files of the supported formats from the views and read them back, and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import sinks
from ..operators import filters, histogram, lookups, ordering
from ..session import materialize, scratch_dir
from ..sources import dictionary, fastq, intervals, lines, read_index, sam, vcf
from ..streaming import chunks
from .fixtures import Inputs
from .interval_queries import KEYED_LINES
from .read_queries import (
    BINS,
    HISTOGRAM,
    MAPPED_KEYED,
    N_LB_REGIONS,
    REGION_MAP,
    SAM_FIELDS,
    keyed_reads,
    mapped_reads,
    region_reads,
    stored_regions,
)
from .registry import query

LB_REGION = 3


# --- dictionary and lists ----------------------------------------------------------------------


@query(
    """SELECT CAST(contig_index AS INT) AS contig_index, contig, CAST(length AS BIGINT) AS length, ignored
    FROM {contigs}"""
)
def scan_dict(inp: Inputs) -> DataFrame:
    spark, folder = inp.spark, scratch_dir(inp.spark, "dict")
    text = (
        F.when(F.col("contig_index") < 0, F.lit("@HD\tVN:1.0"))
        .otherwise(F.format_string("@SQ\tSN:%s\tLN:%d", "contig", "length"))
    )
    header = inp["contigs"].groupBy().agg(F.lit(-1).alias("contig_index"), F.lit("").alias("contig"),
                                          F.lit(0).alias("length"))
    rows = inp["contigs"].select("contig_index", "contig", "length").unionByName(header)
    # Dictionary-sized, and one file by definition.
    rows.repartition(1).sortWithinPartitions("contig_index").select(text.alias("value")).write.text(folder)
    return dictionary.scan_dict(spark, folder, inp["ignore_list"])


@query("SELECT contig FROM {ignore_list}")
def scan_ignore_list(inp: Inputs) -> DataFrame:
    folder = scratch_dir(inp.spark, "ignore")
    listed = inp["ignore_list"].select(F.concat(F.lit(" "), F.col("contig"), F.lit(" ,, ")).alias("value"))
    listed.write.text(folder)
    return dictionary.scan_ignore_list(inp.spark, folder)


# --- reads -------------------------------------------------------------------------------------


@query("SELECT CAST(rec_no % 8 AS STRING) AS chunk, mate, name, seq, qual FROM {fastq}")
def scan_fastq(inp: Inputs) -> DataFrame:
    folder = scratch_dir(inp.spark, "fastq")
    sinks.sink_fastq(inp["fastq"].withColumn("chunk", F.col("rec_no") % 8), folder)
    return fastq.scan_fastq(inp.spark, folder).select("chunk", "mate", "name", "seq", "qual")


@query(f"SELECT chunk, qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, seq, qual FROM ({SAM_FIELDS}) t")
def scan_sam(inp: Inputs) -> DataFrame:
    folder = scratch_dir(inp.spark, "sam")
    inp["sam_lines"].write.partitionBy("chunk").text(folder)
    records = sam.scan_sam(inp.spark, folder).withColumn("chunk", F.col("chunk").cast("bigint"))
    return records.drop("tags", "line")


@query("SELECT chunk, line FROM {sam_lines} WHERE line LIKE '@%'")
def sam_header(inp: Inputs) -> DataFrame:
    return sam.sam_header(inp["sam_lines"])


@query("SELECT contig, bed_start, bed_end FROM {targets}")
def scan_bed(inp: Inputs) -> DataFrame:
    folder = scratch_dir(inp.spark, "targets")
    header = inp["contigs"].select(F.format_string("@SQ\tSN:%s\tLN:%d", "contig", "length").alias("value"))
    rows = inp["targets"].select(F.concat_ws("\t", "contig", F.col("bed_start"), F.col("bed_end")).alias("value"))
    header.unionByName(rows).write.text(folder)
    return intervals.scan_bed(inp.spark, folder)


@query("SELECT contig, bed_start, bed_end FROM {targets}")
def sink_bed(inp: Inputs) -> DataFrame:
    folder = scratch_dir(inp.spark, "bed")
    sinks.sink_bed(inp["targets"], folder)
    return intervals.scan_bed(inp.spark, folder)


# --- histogram and region map ------------------------------------------------------------------


@query(f"WITH {HISTOGRAM} SELECT key, n FROM hist")
def scan_histogram(inp: Inputs) -> DataFrame:
    folder = scratch_dir(inp.spark, "positions")
    sinks.sink_histogram(histogram.chunk_histogram(keyed_reads(inp)), folder)
    return histogram.combine_histograms(intervals.scan_histogram(inp.spark, folder))


@query(
    f"""WITH keyed AS ({MAPPED_KEYED}) SELECT concat(key, ':', count(*)) AS line FROM keyed GROUP BY chunk, key"""
)
def sink_histogram(inp: Inputs) -> DataFrame:
    folder = scratch_dir(inp.spark, "positions")
    sinks.sink_histogram(histogram.chunk_histogram(keyed_reads(inp)), folder)
    return inp.spark.read.text(folder).withColumnRenamed("value", "line")


@query(f"WITH RECURSIVE {REGION_MAP} SELECT key, region FROM map")
def sink_region_map(inp: Inputs) -> DataFrame:
    folder = scratch_dir(inp.spark, "regionmap")
    sinks.sink_region_map(stored_regions(inp), folder)
    return intervals.scan_region_map(inp.spark, folder)


# --- partitioned reads -------------------------------------------------------------------------

LB_READS = f"""{BINS},
    tagged AS (SELECT m.qname, CAST(m.contig_index AS BIGINT) * 1000000000000 + m.pos // 5000 AS key,
      CAST(least((n.first_bin + least(m.pos // 1000000, n.n_bins - 1))
                 // greatest(1, n.total_bins // {N_LB_REGIONS}), {N_LB_REGIONS - 1}) AS INT) AS lb_region
      FROM {{mapped}} m JOIN numbered n ON n.contig_index = m.contig_index)"""


def written_lb_regions(inp: Inputs) -> str:
    folder = scratch_dir(inp.spark, "lb")
    tagged = lookups.join_lb_bin(keyed_reads(inp), inp["contigs"], N_LB_REGIONS)
    sinks.sink_by_lb_region(tagged.select("qname", "key", "lb_region"), folder)
    return folder


@query(f"WITH {LB_READS} SELECT qname, key, lb_region FROM tagged")
def sink_by_lb_region(inp: Inputs) -> DataFrame:
    return inp.spark.read.parquet(written_lb_regions(inp))


@query(f"WITH {LB_READS} SELECT qname, key, lb_region FROM tagged WHERE lb_region = {LB_REGION}")
def scan_partition(inp: Inputs) -> DataFrame:
    return intervals.scan_partition(inp.spark, written_lb_regions(inp), LB_REGION)


@query(
    f"""WITH RECURSIVE {REGION_MAP}
    SELECT m.region, k.contig_index, k.pos, k.qname FROM keyed k JOIN map m ON m.key = k.key"""
)
def sink_sorted_reads(inp: Inputs) -> DataFrame:
    folder = scratch_dir(inp.spark, "sorted")
    sinks.sink_sorted_reads(region_reads(inp).select("region", "contig_index", "pos", "qname"), folder)
    return inp.spark.read.parquet(folder)


def stored_sorted_reads(inp: Inputs) -> str:
    folder = scratch_dir(inp.spark, "sorted")
    sinks.sink_sorted_reads(region_reads(inp).select("region", "contig_index", "pos", "qname", "flag", "cigar"), folder)
    return folder


ALIGNED_END = """pos - 1 + CAST(list_sum(list_transform(regexp_extract_all(cigar, '(\\d+)[MDN=X]', 1), lambda x: CAST(x AS BIGINT))) AS BIGINT)"""
INTERVAL = (7, 300_000, 420_000)  # contig, start, end


@query(
    f"""WITH ends AS (SELECT contig_index, pos, {ALIGNED_END} AS aend FROM {{mapped}}),
    windows AS (SELECT contig_index, pos, unnest(range((pos - 1) // {read_index.WINDOW}, (aend - 1) // {read_index.WINDOW} + 1)) AS w FROM ends)
    SELECT CAST(contig_index AS INT) AS contig_index, w AS "window", min(pos) AS first_pos, max(pos) AS last_pos, count(*) AS n FROM windows GROUP BY contig_index, w"""
)
def read_index_windows(inp: Inputs) -> DataFrame:
    index = read_index.build_read_index(inp.spark, stored_sorted_reads(inp))
    per_window = index.groupBy(F.col("contig_index").cast("int").alias("contig_index"), "window")
    return per_window.agg(F.min("first_pos").alias("first_pos"), F.max("last_pos").alias("last_pos"), F.sum("n").alias("n"))


@query(
    f"""SELECT contig_index, pos, qname FROM (SELECT *, {ALIGNED_END} AS aend FROM {{mapped}}) m
    WHERE contig_index = {INTERVAL[0]} AND pos - 1 < {INTERVAL[2]} AND aend > {INTERVAL[1]}"""
)
def scan_interval(inp: Inputs) -> DataFrame:
    folder = stored_sorted_reads(inp)
    index = materialize(read_index.build_read_index(inp.spark, folder), "read-index")
    return read_index.scan_interval(inp.spark, folder, index, *INTERVAL).select("contig_index", "pos", "qname")


# --- variant files -----------------------------------------------------------------------------


def written_vcf(inp: Inputs) -> str:
    """The lines of every file, written in file order under ``file_no=<n>`` (a large one in several parts)."""
    folder = scratch_dir(inp.spark, "vcf")
    rows = inp["vcf_lines"].repartitionByRange("file_no", "line_no").sortWithinPartitions("file_no", "line_no")
    rows.select("file_no", F.col("line").alias("value")).write.partitionBy("file_no").text(folder)
    return folder


@query(f"WITH {KEYED_LINES} SELECT file_no, contig_index, pos, line FROM keyed")
def scan_vcf(inp: Inputs) -> DataFrame:
    keyed = vcf.scan_vcf(inp.spark, written_vcf(inp), inp["contigs"])
    return keyed.select(
        F.regexp_extract("file_no", r"file_no=(\d+)", 1).cast("bigint").alias("file_no"), "contig_index", "pos", "line"
    )


@query(
    f"""WITH {KEYED_LINES}, merged AS (SELECT DISTINCT contig_index, pos, line FROM keyed)
    SELECT row_number() OVER (ORDER BY contig_index, pos, line) - 1 AS line_no, line FROM merged"""
)
def sink_vcf_single(inp: Inputs) -> DataFrame:
    folder = scratch_dir(inp.spark, "merged")
    sinks.sink_vcf_single(materialize(ordering.vcf_key(inp["vcf_lines"], inp["contigs"]), "vcf"), folder)
    return lines.read_numbered_lines(inp.spark, folder, continued=True).select("line_no", "line")


# --- streams -----------------------------------------------------------------------------------


def published_chunks(inp: Inputs, reads: DataFrame) -> tuple[str, DataFrame]:
    """Reads as files in one folder per chunk, and the stream over them."""
    folder = scratch_dir(inp.spark, "arrivals")
    ranged = reads.withColumn("file_chunk", F.col("chunk")).repartitionByRange("file_chunk", "qname")
    ranged.write.partitionBy("file_chunk").parquet(folder)
    return folder, chunks.stream_chunks(inp.spark, folder, reads.schema, chunks_per_batch=4)


@query(f"WITH keyed AS ({MAPPED_KEYED}) SELECT chunk, key, count(*) AS n FROM keyed GROUP BY chunk, key")
def stream_chunks(inp: Inputs) -> DataFrame:
    _, stream = published_chunks(inp, mapped_reads(inp).select("chunk", "qname", "contig_index", "pos"))
    out = scratch_dir(inp.spark, "streamed")
    job = chunks.write_chunks(stream, out, scratch_dir(inp.spark, "state"), lookups.with_bucket_key)
    job.awaitTermination()
    return histogram.chunk_histogram(inp.spark.read.parquet(out))


# A compressed file is read by one task, so a chunk that is large is written as several; there are never more.
PIECES = 64


@query(f"WITH keyed AS ({MAPPED_KEYED}) SELECT chunk, key, count(*) AS n FROM keyed GROUP BY chunk, key")
def stream_text_chunks(inp: Inputs) -> DataFrame:
    """Alignment lines that arrive as compressed text: parsed, validated, keyed and counted."""
    folder = scratch_dir(inp.spark, "arriving-text")
    # Dealt by a hash, since ranges would work all lines out once more to sample them; a chunk has up to PIECES files.
    dealt = inp["sam_lines"].select(F.col("chunk").alias("file_chunk"), F.col("line").alias("value")).repartition(
        "file_chunk", F.pmod(F.xxhash64("value"), F.lit(PIECES))
    )
    dealt.write.partitionBy("file_chunk").option("compression", "gzip").text(folder)
    # Four chunks a batch, whatever number of files they were written as.
    pattern = r"file_chunk=(\d+)"
    per_batch = 4 * chunks.files_per_chunk(inp.spark, folder, pattern)
    stream = chunks.stream_lines(inp.spark, folder, pattern, chunks_per_batch=per_batch)
    keyed = lookups.with_bucket_key(filters.good_reads(stream, inp["contigs"])).select("chunk", "qname", "key")
    out = scratch_dir(inp.spark, "streamed-text")
    chunks.write_chunks(keyed, out, scratch_dir(inp.spark, "state")).awaitTermination()
    return histogram.chunk_histogram(inp.spark.read.parquet(out))


@query(
    """SELECT e.chunk, count(m.qname) AS n FROM (SELECT unnest(range(20)) AS chunk) e
    LEFT JOIN {mapped} m ON m.chunk = e.chunk GROUP BY e.chunk"""
)
def stream_end(inp: Inputs) -> DataFrame:
    """Twenty chunks are expected, sixteen come, some at each look of the live query, then the sentinel; the others count nothing."""
    spark, reads = inp.spark, mapped_reads(inp).select("chunk", "qname")
    staged, folder = scratch_dir(spark, "staged"), scratch_dir(spark, "arrivals")
    out, state = scratch_dir(spark, "streamed"), scratch_dir(spark, "state")
    reads.withColumn("file_chunk", F.col("chunk")).repartitionByRange("file_chunk", "qname").write.partitionBy("file_chunk").parquet(staged)
    waiting = [r.file_chunk for r in spark.read.parquet(staged).select("file_chunk").distinct().orderBy("file_chunk").collect()]  # as many as folders
    chunks.publish(spark, "", f"{folder}/begin.txt")
    sentinel = f"{folder}/end.txt"

    def arrive() -> None:
        for k in waiting[:4]:
            chunks.publish(spark, f"{staged}/file_chunk={k}", f"{folder}/file_chunk={k}")
        del waiting[:4]
        if not waiting:
            chunks.publish(spark, "", sentinel)

    def start(available_now: bool) -> StreamingQuery:
        stream = chunks.stream_chunks(spark, folder, reads.schema, chunks_per_batch=4)
        return chunks.write_chunks(stream, out, state, available_now=available_now, poll="100 milliseconds")

    chunks.run_until_end(spark, start, sentinel, 0.5, arrive)
    counts = spark.read.schema(reads.schema).parquet(out).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))
    expected = spark.range(20).select(F.col("id").alias("chunk"))
    return expected.join(counts, "chunk", "left").select("chunk", F.coalesce("n", F.lit(0)).alias("n"))


@query(f"WITH {HISTOGRAM} SELECT key, n FROM hist")
def stream_histogram(inp: Inputs) -> DataFrame:
    _, stream = published_chunks(inp, mapped_reads(inp).select("chunk", "qname", "contig_index", "pos"))
    out = scratch_dir(inp.spark, "live")
    keyed = lookups.with_bucket_key(stream)
    chunks.stream_histogram(keyed, out, scratch_dir(inp.spark, "state")).awaitTermination()
    return chunks.latest_histogram(inp.spark, out)
