"""What the operators share: reading a table, ASCII-whitespace words, spans of regular expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII whitespace; words are maximal runs of everything else.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows of texts that a Python worker gets at once; the session's default of 10,000 would be some 50 MB a time.
TEXT_ROWS = 2_500


def small_batches(spark: SparkSession) -> None:
    """From now on the session sends texts to Python workers in batches of at most ``TEXT_ROWS`` rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXT_ROWS:
        spark.conf.set(key, str(TEXT_ROWS))


def documents(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only (other columns may be called anything), null texts as empty ones."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text as an array."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_CLASS + "++"))


def n_words(text: Column) -> Column:
    """Number of words, without building them: runs of non-space shrink to one letter each."""
    return F.length(F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]++", "x"), SPACE_CLASS + "++", "")).cast("long")


def matches(text: Column, pattern: str, guard: Column | None = None) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, value): code points, end exclusive.

    The gaps between matches come from a split by the same pattern, so that positions are running sums of
    lengths. ``guard`` is a cheap test that every text with a match passes.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    kind = "array<struct<start:int,end:int,value:string>>"
    empty = F.array().cast(kind)

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        item = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(item)).alias("spans"))

    # One gap follows the last match; zip pads the matches with a null there, which the filter drops.
    pairs = F.filter(F.zip_with(gaps, found, lambda g, v: F.struct(g.alias("gap"), v.alias("value"))), lambda p: p["value"].isNotNull())
    spans = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])
    test = text.rlike(pattern) if guard is None else guard & text.rlike(pattern)
    return F.when(test, spans).otherwise(empty)


def spans_text(spans: Column, names: list[str]) -> Column:
    """``kind:start:end`` joined by commas, of an array of (start, kind, end) sorted by these fields."""
    known = F.array(*[F.lit(n) for n in names])
    one = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(known, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", one)
