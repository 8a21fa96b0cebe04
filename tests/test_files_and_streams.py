from __future__ import annotations

import gzip
import os
import threading
import time

import pytest
from helpers import read, reads, rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from locusloom import sinks
from locusloom.operators import histogram as H
from locusloom.operators import lookups, ordering
from locusloom.sources import dictionary, fastq, intervals, sam, vcf
from locusloom.sources.lines import read_numbered_lines
from locusloom.streaming import chunks


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_numbered_lines_of_split_files(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(4_000)]
    write(tmp_path / "t" / "a.txt", "\n".join(lines) + "\n")
    write(tmp_path / "t" / "b.txt", "\n".join(lines[:10]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = read_numbered_lines(spark, str(tmp_path / "t"))
        assert spark.read.text(str(tmp_path / "t")).rdd.getNumPartitions() > 4
        got = {(os.path.basename(r.file), r.line_no): r.line for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {("a.txt", i): t for i, t in enumerate(lines)} | {("b.txt", i): t for i, t in enumerate(lines[:10])}


def test_dictionary_and_ignore_list(spark, tmp_path):
    ignore = dictionary.scan_ignore_list(spark, write(tmp_path / "i.txt", " chrX , ,chrM\nchrM,\n\n"))
    assert rows(ignore) == [("chrM",), ("chrX",)]
    # No line end after the last contig; an ignored contig takes its number all the same.
    path = write(tmp_path / "g.dict", "@HD\tVN:1.0\n@SQ\tSN:chr1\tLN:100\tM5:x\n@SQ\tSN:chrX\tLN:50\n@SQ\tSN:HLA:1\tLN:7")
    assert rows(dictionary.scan_dict(spark, path, ignore)) == [
        (0, "chr1", 100, False), (1, "chrX", 50, True), (2, "HLA:1", 7, False),
    ]


def test_fastq_reads_gzip_and_plain_chunks(spark, tmp_path):
    def record(name, seq, qual):
        return f"@{name}\n{seq}\n+\n{qual}\n"

    text = record("p1", "ACGT", "@III") + record("p1", "TTTT", "IIII") + record("p2", "GG", "++") + record("p2", "CC", "II")
    folder = tmp_path / "in"
    write(folder / "1.fq", text)
    with gzip.open(folder / "0.fq.gz", "wt") as f:
        f.write(text)
    write(folder / "notes.txt", "not reads\n")
    got = rows(fastq.scan_fastq(spark, str(folder)), "chunk", "rec_no", "mate", "name", "seq", "qual")
    expected = [(0, 1, "p1", "ACGT", "@III"), (0, 2, "p1", "TTTT", "IIII"), (1, 1, "p2", "GG", "++"), (1, 2, "p2", "CC", "II")]
    assert got == [(c, *r) for c in ("0", "1") for r in expected]
    single = fastq.scan_fastq(spark, str(folder), interleaved=False).where("chunk = '1'")
    assert rows(single, "rec_no", "mate") == [(0, 1), (1, 1), (2, 1), (3, 1)]


def test_fastq_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(c, r, m, f"n{c}_{r}", "ACGT"[m:] * 2, "I" * (8 - 2 * m)) for c in (0, 1) for r in range(20) for m in (1, 2)],
        "chunk int, rec_no int, mate int, name string, seq string, qual string",
    )
    sinks.sink_fastq(df, str(tmp_path / "out"))
    assert all(".gz" in f for _, _, fs in os.walk(tmp_path / "out") for f in fs if f.endswith("gz") or f.startswith("part"))
    back = fastq.scan_fastq(spark, str(tmp_path / "out"))
    columns = ["chunk", "mate", "name", "seq", "qual"]
    assert rows(back, *columns) == rows(df.withColumn("chunk", F.col("chunk").cast("string")), *columns)


def test_sam_text(spark, tmp_path):
    path = write(tmp_path / "a.sam", "@HD\tVN:1\nr1\t0\tchr1\t5\t60\t1M\t=\t1\t0\tA\tI\n")
    assert rows(sam.scan_sam(spark, path), "qname", "pos") == [("r1", 5)]
    assert sam.sam_header(sam.scan_sam_lines(spark, path)).count() == 1


def test_bed_histogram_and_region_map(spark, tmp_path):
    bed = write(tmp_path / "t.bed", "@HD\tx\n@SQ\ty\nchr1\t5\t9\n")
    assert rows(intervals.scan_bed(spark, bed)) == [("chr1", 5, 9)]
    sinks.sink_bed(intervals.scan_bed(spark, bed), str(tmp_path / "bed"))
    assert rows(intervals.scan_bed(spark, str(tmp_path / "bed"))) == [("chr1", 5, 9)]
    part = spark.createDataFrame([(0, 7, 2), (1, 7, 3), (1, 10**12, 1)], "chunk int, key bigint, n bigint")
    sinks.sink_histogram(part, str(tmp_path / "h"))
    assert rows(H.combine_histograms(intervals.scan_histogram(spark, str(tmp_path / "h")))) == [(7, 5), (10**12, 1)]
    region_map = spark.createDataFrame([(7, 0), (10**12, 1)], "key bigint, region int")
    sinks.sink_region_map(region_map, str(tmp_path / "m"))
    assert rows(intervals.scan_region_map(spark, str(tmp_path / "m"))) == rows(region_map)


def test_bed_lines_that_are_no_intervals(spark, tmp_path):
    text = '#c\n@HD\ntrack name=x\nbrowser position\n\nchr1\t5\t9\textra\ntrackless\t1\t1\nchr1\tx\t9\nchr1\t9\t5\nchr1\t5\n"chr2\t1\t2\n'
    bed = write(tmp_path / "dirty.bed", text)
    assert rows(intervals.scan_bed(spark, bed)) == [('"chr2', 1, 2), ("chr1", 5, 9), ("trackless", 1, 1)]
    assert rows(intervals.bad_bed_lines(spark, bed)) == [("chr1\t5",), ("chr1\t9\t5",), ("chr1\tx\t9",)]


def some_reads(spark):
    df = reads(spark, [read(f"r{i:03d}", pos=(i * 7_919) % 50_000 + 1, chunk=i % 5) for i in range(200)])
    return lookups.with_bucket_key(df.withColumn("contig_index", F.lit(0)))


def test_lb_regions_are_folders_and_pruned(spark, tmp_path):
    df = some_reads(spark).withColumn("lb_region", (F.col("key") % 3).cast("int"))
    sinks.sink_by_lb_region(df, str(tmp_path / "lb"))
    one = intervals.scan_partition(spark, str(tmp_path / "lb"), 1)
    assert rows(one, "qname") == rows(df.where("lb_region = 1"), "qname")
    assert "PartitionFilters: [isnotnull(lb_region" in one._jdf.queryExecution().executedPlan().toString()


def test_sorted_regions(spark, tmp_path):
    df = some_reads(spark).withColumn("region", F.when(F.col("pos") < 9_000, 0).otherwise(1))
    sinks.sink_sorted_reads(df, str(tmp_path / "s"))
    for region in (0, 1):
        folder = tmp_path / "s" / f"region={region}"
        positions = []
        for name in sorted(f for f in os.listdir(folder) if f.endswith(".parquet")):
            positions += [(r.pos, r.qname) for r in spark.read.parquet(str(folder / name)).collect()]
        assert positions == sorted(positions)
        assert len(positions) == df.where(F.col("region") == region).count()


def test_single_vcf(spark, tmp_path, contigs):
    for n, extra in ((0, "chr2\t4\tA\n"), (1, "chr1\t99\tB\n")):
        write(tmp_path / "v" / f"{n}.vcf", "##v\n#CHROM\n" + extra + "chr3\t1\tC\n")
    keyed = vcf.scan_vcf(spark, str(tmp_path / "v"), contigs)
    sinks.sink_vcf_single(keyed, str(tmp_path / "out"))
    names = sorted(f for f in os.listdir(tmp_path / "out") if f.startswith("part-"))
    text = "".join((tmp_path / "out" / f).read_text() for f in names)
    assert text.splitlines() == ["##v", "#CHROM", "chr1\t99\tB", "chr2\t4\tA", "chr3\t1\tC"]
    assert rows(ordering.merge_vcf(keyed)) == rows(ordering.distinct_variants(keyed))


def test_single_vcf_numbers_on_over_many_parts(spark, tmp_path, contigs):
    lines = [("f", i, f"chr1\t{1 + i * 7 % 5_000}\tx{i}") for i in range(3_000)] + [("f", -1, "##v")]
    keyed = ordering.vcf_key(spark.createDataFrame(lines, "file_no string, line_no long, line string"), contigs)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.sink_vcf_single(keyed, str(tmp_path / "out"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len([f for f in os.listdir(tmp_path / "out") if f.startswith("part-")]) > 5
    back = [r.line for r in read_numbered_lines(spark, str(tmp_path / "out"), continued=True).orderBy("line_no").collect()]
    assert back == [r.line for r in ordering.merge_vcf(keyed).collect()]
    numbers = [r.line_no for r in read_numbered_lines(spark, str(tmp_path / "out"), continued=True).collect()]
    assert sorted(numbers) == list(range(3_001))


def test_variants_without_a_place_are_set_aside(spark, contigs):
    lines = [("a", 0, "##h"), ("a", 1, "chr1\t5\tA"), ("a", 2, "chrUn\t5\tA"), ("a", 3, "chr1\t5.x\tA"), ("a", 4, "chr1")]
    df = spark.createDataFrame(lines, "file_no string, line_no long, line string")
    assert [r.line for r in ordering.merge_vcf(ordering.vcf_key(df, contigs)).collect()] == ["##h", "chr1\t5\tA"]
    assert rows(ordering.bad_variants(df, contigs), "line_no") == [(2,), (3,), (4,)]


def folders(path, kind):
    return sorted(f for f in os.listdir(path) if f.startswith(f"{kind}="))


def test_only_finished_batches_are_seen_and_old_ones_go(spark, tmp_path):
    df = some_reads(spark).drop("key")
    arrivals, live = str(tmp_path / "in"), str(tmp_path / "live")
    df.withColumn("file_chunk", F.col("chunk")).write.partitionBy("file_chunk").parquet(arrivals)
    stream = lookups.with_bucket_key(chunks.stream_chunks(spark, arrivals, df.schema))
    chunks.stream_histogram(stream, live, str(tmp_path / "state"), compact_every=2).awaitTermination()
    n = len([f for _, _, found in os.walk(arrivals) for f in found if f.endswith(".parquet")])  # a batch each
    last = (n // 2) * 2 - 1
    assert folders(live, "base") == [f"base={b:012d}" for b in (last - 2, last)]
    assert folders(live, "delta") == [f"delta={b:012d}" for b in range(last - 1, n)]
    want = rows(chunks.latest_histogram(spark, live))
    assert want == rows(H.bucket_histogram(lookups.with_bucket_key(df)))
    write(tmp_path / "live" / "delta=000000009999" / "part-0.parquet", "half")
    write(tmp_path / "live" / "base=000000009998" / "part-0.parquet", "half")
    assert rows(chunks.latest_histogram(spark, live)) == want


def test_idle_buckets_are_not_written_again_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    def reads_at(*positions):
        return reads(spark, [read(f"r{p}", pos=p) for p in positions]).withColumn("contig_index", F.lit(0))

    arrivals, state, live = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "live")

    def run(part):
        part.coalesce(1).write.mode("append").parquet(arrivals)
        stream = lookups.with_bucket_key(chunks.stream_chunks(spark, arrivals, part.schema))
        chunks.stream_histogram(stream, live, state, compact_every=3).awaitTermination()

    delta = lambda b: rows(spark.read.parquet(f"{live}/delta={b:012d}"))
    run(reads_at(1, 2, 5_001, 20_001))
    run(reads_at(5_002, 30_001))
    assert delta(0) == [(0, 2), (1, 1), (4, 1)]
    assert delta(1) == [(1, 2), (6, 1)]  # not buckets 0 and 4
    run(reads_at(3))
    assert folders(live, "base") == ["base=000000000002"]
    want = [(0, 3), (1, 2), (4, 1), (6, 1)]
    assert rows(chunks.latest_histogram(spark, live)) == want

    # The driver is lost after batch 2 was published, before it was committed: it is done again.
    os.remove(f"{state}/commits/2")
    if os.path.exists(f"{state}/commits/.2.crc"):
        os.remove(f"{state}/commits/.2.crc")
    stream = lookups.with_bucket_key(chunks.stream_chunks(spark, arrivals, reads_at(1).schema))
    chunks.stream_histogram(stream, live, state, compact_every=3).awaitTermination()
    assert rows(chunks.latest_histogram(spark, live)) == want
    assert rows(spark.read.parquet(f"{live}/base=000000000002")) == want


def publisher(spark, df, staged, arrivals, pauses):
    """Chunks are written aside and renamed into the watched folder, one after the other, then the sentinel is."""
    df.withColumn("file_chunk", F.col("chunk")).write.partitionBy("file_chunk").parquet(str(staged))
    os.makedirs(arrivals, exist_ok=True)

    def work():
        for k in sorted(os.listdir(staged)):
            if k.startswith("file_chunk="):
                time.sleep(pauses)
                os.rename(staged / k, arrivals / k)
        (arrivals / "end.txt").write_text("")

    return threading.Thread(target=work)


def test_live_stream_ends_with_the_sentinel(spark, tmp_path):
    df = some_reads(spark).drop("key")
    arrivals = tmp_path / "in"
    writer = publisher(spark, df, tmp_path / "staged", arrivals, 0.7)
    starts, looks = [], []

    def start(available_now):
        starts.append(available_now)
        stream = chunks.stream_chunks(spark, str(arrivals), df.schema, 2)
        return chunks.write_chunks(stream, str(tmp_path / "out"), str(tmp_path / "state"), lookups.with_bucket_key, available_now, "200 milliseconds")

    writer.start()
    last = chunks.run_until_end(spark, start, str(arrivals / "end.txt"), 0.3, lambda: looks.append(1))
    writer.join()
    assert starts == [False, True] and len(looks) > 2 and not last.isActive
    want = rows(lookups.with_bucket_key(df), "qname", "key")
    assert rows(spark.read.parquet(str(tmp_path / "out")), "qname", "key") == want
    # A driver that was lost calls it again: the sentinel is there, nothing is left to do.
    chunks.run_until_end(spark, start, str(arrivals / "end.txt"))
    assert starts == [False, True, True] and rows(spark.read.parquet(str(tmp_path / "out")), "qname", "key") == want


def test_live_stream_that_fails_raises(spark, tmp_path):
    df = some_reads(spark).drop("key")
    arrivals = str(tmp_path / "in")
    df.write.parquet(arrivals)

    def start(available_now):
        stream = chunks.stream_chunks(spark, arrivals, df.schema)
        broken = lambda d: d.withColumn("x", F.raise_error(F.lit("broken")).cast("string"))
        return chunks.write_chunks(stream, str(tmp_path / "out"), str(tmp_path / "state"), broken, available_now)

    with pytest.raises(StreamingQueryException):
        chunks.run_until_end(spark, start, f"{arrivals}/end.txt", 30)


def test_stream_follows_arriving_chunks(spark, tmp_path):
    df = some_reads(spark).drop("key")
    arrivals, state, live = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "live")

    def publish(low, high):
        part = df.where(F.col("chunk").between(low, high)).withColumn("file_chunk", F.col("chunk"))
        part.write.mode("append").partitionBy("file_chunk").parquet(arrivals)

    def run():
        stream = lookups.with_bucket_key(chunks.stream_chunks(spark, arrivals, df.schema))
        chunks.stream_histogram(stream, live, state).awaitTermination()
        return rows(chunks.latest_histogram(spark, live))

    def batch(high):
        return rows(H.bucket_histogram(lookups.with_bucket_key(df.where(F.col("chunk") <= high))))

    publish(0, 1)
    assert run() == batch(1)
    publish(2, 4)
    assert run() == batch(4)  # goes on from the checkpoint
    assert run() == batch(4)  # nothing new


def test_stream_writes_each_read_once(spark, tmp_path):
    df = some_reads(spark).drop("key")
    df.withColumn("file_chunk", F.col("chunk")).write.partitionBy("file_chunk").parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = chunks.stream_chunks(spark, str(tmp_path / "in"), df.schema, 2)
        job = chunks.write_chunks(stream, str(tmp_path / "out"), str(tmp_path / "state"), lookups.with_bucket_key)
        job.awaitTermination()
    back = spark.read.parquet(str(tmp_path / "out"))
    assert rows(back, "qname", "key") == rows(lookups.with_bucket_key(df), "qname", "key")


def test_a_chunk_of_many_files_is_one_chunk(spark, tmp_path):
    """Batches grow with the files of a chunk, so their number doesn't."""
    lines = spark.range(90).select((F.col("id") % 3).alias("file_chunk"), F.col("id").cast("string").alias("value"))
    lines.repartition(5).write.partitionBy("file_chunk").text(str(tmp_path / "in"))
    n = chunks.files_per_chunk(spark, str(tmp_path / "in"), r"file_chunk=(\d+)")
    assert n == 5 and chunks.files_per_chunk(spark, str(tmp_path / "in" / "file_chunk=1"), r"file_chunk=(\d+)") == 5
    stream = chunks.stream_lines(spark, str(tmp_path / "in"), r"file_chunk=(\d+)", chunks_per_batch=n)
    query = chunks.write_chunks(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    assert query.lastProgress["batchId"] <= 3 and spark.read.parquet(str(tmp_path / "out")).count() == 90
