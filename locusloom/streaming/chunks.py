"""Reads that arrive chunk by chunk.

A chunk is a file that its writer publishes by renaming it into the watched folder, so a file that is visible is complete.
A stream ends in one of two ways: with ``available_now`` everything present is read in batches and the query ends by itself;
a live query follows the writer until a sentinel file says that no more will come (``run_until_end``). Chunks that never
came are simply not there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def stream_chunks(spark: SparkSession, folder: str, schema: StructType, chunks_per_batch: int = 1) -> DataFrame:
    """Streaming DataFrame over the chunk files of a folder; other files there, such as a sentinel, are not chunks."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", chunks_per_batch)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .parquet(folder)
    )


def stream_lines(spark: SparkSession, folder: str, chunk_pattern: str, chunks_per_batch: int = 1, files: str = "*") -> DataFrame:
    """Streaming (chunk, line) over text chunks, also compressed ones; ``chunk_pattern`` finds the number in a file's path.

    ``files`` is a pattern of the names of chunks, which a sentinel in the same folder must not match.
    """
    lines = (
        spark.readStream.option("maxFilesPerTrigger", chunks_per_batch)
        .option("pathGlobFilter", files)
        .option("recursiveFileLookup", "true")
        .text(folder)
    )
    chunk = F.regexp_extract(F.col("_metadata.file_path"), chunk_pattern, 1).cast("bigint")
    return lines.select(chunk.alias("chunk"), F.col("value").alias("line"))


def files_per_chunk(spark: SparkSession, folder: str, chunk_pattern: str) -> int:
    """Files of the chunk that has the most, where large chunks come as several; the files aren't opened.

    Batches count files: with so many times the chunks of a batch, a larger input makes larger batches and not more of them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    counts = files.groupBy(F.regexp_extract("path", chunk_pattern, 1)).count()
    return counts.agg(F.max("count")).first()[0] or 1


def _start(stream: DataFrame, checkpoint: str, available_now: bool, poll: str) -> object:
    trigger = {"availableNow": True} if available_now else {"processingTime": poll}
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger)


def write_chunks(
    reads: DataFrame,
    path: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    available_now: bool = True,
    poll: str = "1 second",
) -> StreamingQuery:
    """Transform chunks as they come and append the rows to Parquet, each exactly once."""
    return _start(transform(reads), checkpoint, available_now, poll).format("parquet").start(path)


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Rename a finished file or folder of chunks, or write an empty file (``staged`` empty), so that it appears at once."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(target.getParent())
    if not staged:
        files.create(target).close()
    elif not files.rename(hadoop.Path(staged), target):
        raise OSError(f"{staged} could not be renamed to {path}")


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def run_until_end(
    spark: SparkSession,
    start: Callable[[bool], StreamingQuery],
    sentinel: str,
    poll_seconds: float = 1.0,
    arrived: Callable[[], None] = lambda: None,
) -> StreamingQuery:
    """Follow a folder with a live query until the file ``sentinel`` is there and all that came before it is committed.

    ``start(available_now)`` starts the query; both calls must use the same checkpoint. While the sentinel is missing, the
    live query runs and the path is looked up every ``poll_seconds``; a query that fails raises its error here. Once the sentinel
    is seen, the live query is stopped and the same query is run to the end of what is present, from the same checkpoint: a
    batch that was under way is done again under its number, so sinks see every chunk exactly once. A driver that is lost can
    call this again: committed batches aren't repeated, and where the sentinel is there already, only the rest is done.
    ``arrived`` is called at every look (a progress report, say). Returns the last query, which has ended.
    """
    if not path_exists(spark, sentinel):
        live = start(False)
        try:
            while not path_exists(spark, sentinel):
                arrived()
                if live.awaitTermination(poll_seconds):  # stopped by someone else; a failure raises
                    break
        finally:
            live.stop()
    last = start(True)
    last.awaitTermination()
    return last


# A compacted histogram takes the place of so many deltas.
COMPACT_EVERY = 10


def stream_histogram(
    keyed_reads: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = True,
    poll: str = "1 second",
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Keep the bucket histogram current; every batch adds the buckets it changed, with their new counts.

    The state has one row per bucket, however many reads come. A batch writes a delta of its changed buckets only, under its
    number, so a repeated batch overwrites its own delta with the same rows. Every ``compact_every`` batches the last base and
    the deltas since become a new base; the base before it and what it was made from stay for those who are reading them, older
    ones go. Read it with ``latest_histogram``, which takes of each bucket the count of the latest batch.
    """

    def publish(changed: DataFrame, batch: int) -> None:
        spark = changed.sparkSession
        changed.write.mode("overwrite").parquet(f"{path}/delta={batch:012d}")
        if (batch + 1) % compact_every == 0:
            _merged_histogram(spark, path, batch).write.mode("overwrite").parquet(f"{path}/base={batch:012d}")
            _forget(spark, path)

    counts = keyed_reads.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return _start(counts, checkpoint, available_now, poll).outputMode("update").foreachBatch(publish).start()


def latest_histogram(spark: SparkSession, path: str) -> DataFrame:
    """The histogram of all finished batches: those whose folder has the writer's success marker."""
    return _merged_histogram(spark, path)


def _merged_histogram(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """The last base and the deltas after it, of each bucket the latest row; of batches up to ``upto`` only."""
    known = {kind: [(b, f) for b, f in _finished(spark, path, kind) if upto is None or b <= upto] for kind in ("base", "delta")}
    # A base that replaces itself (its batch is repeated) must not be read.
    bases = [(b, f) for b, f in known["base"] if b != upto]
    first = bases[-1][0] if bases else -1
    parts = bases[-1:] + [(b, f) for b, f in known["delta"] if b > first]
    if not parts:
        raise FileNotFoundError(f"no finished batch in {path}")
    # One reader for all: the number of the batch comes from the folder.
    batch = F.regexp_extract(F.col("_metadata.file_path"), r"(?:base|delta)=(\d+)/[^/]*$", 1).cast("bigint")
    rows = spark.read.schema("key bigint, n bigint").parquet(*[f for _, f in parts]).select("key", "n", batch.alias("_batch"))
    return rows.groupBy("key").agg(F.max_by("n", "_batch").alias("n"))


def _forget(spark: SparkSession, path: str) -> None:
    """Delete what neither the last base nor the one before it needs."""
    bases = _finished(spark, path, "base")
    if len(bases) < 2:
        return
    previous = bases[-2][0]
    files = _files(spark, path)[0]
    old = [f for b, f in _finished(spark, path, "delta") if b <= previous] + [f for b, f in bases[:-2]]
    for folder in old:
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)


def _files(spark: SparkSession, path: str) -> tuple:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), root


def _finished(spark: SparkSession, path: str, kind: str) -> list[tuple[int, str]]:
    """(batch, folder) of the finished folders of a kind, oldest first."""
    files, root = _files(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    folders = [s.getPath() for s in files.listStatus(root)] if files.exists(root) else []
    named = [f for f in folders if f.getName().startswith(f"{kind}=") and files.exists(hadoop.Path(f, "_SUCCESS"))]
    return sorted((int(f.getName().split("=")[1]), f.toString()) for f in named)
