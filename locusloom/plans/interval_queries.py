"""Queries on intervals, duplicates, bases, variants and mate pairs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import sinks
from ..operators import bases, duplicates, filters, intervals, lookups, ordering, overlaps, pairs, pileup, recal
from ..session import materialize, scratch_dir
from . import pipeline
from .fixtures import FORMULA_BASE_SQL, Inputs, formula_base
from .read_queries import REGION_MAP, mapped_reads, region_reads
from .registry import query

PADDING = 600

SPAN = """CAST(list_sum(list_transform(regexp_extract_all(cigar, '(\\d+)[MDN=X]', 1), lambda x: CAST(x AS BIGINT))) AS BIGINT)"""

SPANS = f"""spans AS (SELECT *, rname AS contig, pos AS s, pos - 1 + {SPAN} AS e FROM {{mapped}})"""


def islands(source: str, gap: int) -> str:
    """Gaps and islands over ``source`` (contig, s, e) with one total order in both windows."""
    return f"""
  marked AS (SELECT contig, s, e, max(e) OVER (PARTITION BY contig ORDER BY s, e
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
             row_number() OVER (PARTITION BY contig ORDER BY s, e) AS rn FROM {source}),
  flagged AS (SELECT *, CASE WHEN prev IS NULL OR s > prev + {gap} THEN 1 ELSE 0 END AS opens FROM marked),
  grouped AS (SELECT contig, s, e, sum(opens) OVER (PARTITION BY contig ORDER BY rn) AS island FROM flagged),
  merged AS (SELECT contig, min(s) AS s, max(e) AS e, count(*) AS n FROM grouped GROUP BY contig, island)"""


def target_list(inp: Inputs) -> DataFrame:
    return inp["targets"].select("target_id", "contig", F.col("bed_start").alias("start"), F.col("bed_end").alias("end"))


# --- merging -----------------------------------------------------------------------------------


@query(f'WITH {SPANS}, {islands("spans", 51)} SELECT contig, s AS "start", e AS "end", n AS n_reads FROM merged')
def merge_intervals(inp: Inputs) -> DataFrame:
    return intervals.merge_intervals(mapped_reads(inp))


@query(
    f"""WITH closed AS (SELECT lower(contig) AS contig, bed_start + 1 AS s, bed_end AS e FROM {{targets}}),
    {islands("closed", PADDING - 1)}
    SELECT upper(contig) AS contig, greatest(s - {PADDING}, 1) AS "start", e AS "end", n AS n_merged FROM merged"""
)
def merge_intervals_padded(inp: Inputs) -> DataFrame:
    closed = target_list(inp).select("contig", (F.col("start") + 1).alias("start"), "end")
    return intervals.merge_intervals_padded(closed, PADDING)


@query(f"WITH {SPANS}, {islands('spans', 51)} SELECT contig, s - 1 AS bed_start, e AS bed_end FROM merged")
def bed_convert(inp: Inputs) -> DataFrame:
    return intervals.bed_convert(intervals.merge_intervals(mapped_reads(inp)))


@query(f"WITH {SPANS}, {islands('spans', 51)} SELECT concat(contig, ':', s, '-', e) AS region_string FROM merged")
def region_string(inp: Inputs) -> DataFrame:
    return intervals.with_region_string(intervals.merge_intervals(mapped_reads(inp))).select("region_string")


@query(
    """SELECT p[1] AS contig, CAST(p[2] AS BIGINT) AS bed_start,
      CASE WHEN CAST(p[2] AS BIGINT) = CAST(p[3] AS BIGINT) THEN CAST(p[3] AS BIGINT) + 1
           ELSE CAST(p[3] AS BIGINT) END AS bed_end
    FROM (SELECT string_split(line, chr(9)) AS p FROM {bed_lines}) t WHERE len(p) >= 3"""
)
def fix_empty_interval(inp: Inputs) -> DataFrame:
    return intervals.fix_empty_interval(inp["bed_lines"])


@query(
    f"""WITH {SPANS}, {islands('spans', 51)}
    SELECT contig, min(s) AS first_start, arg_max(e, s) AS last_end, count(*) AS n_intervals FROM merged GROUP BY contig"""
)
def interval_summary(inp: Inputs) -> DataFrame:
    return intervals.interval_summary(intervals.merge_intervals(mapped_reads(inp)))


INDEL_SPANS = """
  indels AS (
    SELECT rname AS contig, pos + 10 AS s, pos + 11 AS e FROM {reads} WHERE cigar = '10M2D22M'
    UNION ALL
    SELECT rname AS contig, pos + 19 AS s, pos + 20 AS e FROM {reads} WHERE cigar = '20M3I9M')"""


@query(f'WITH {INDEL_SPANS}, {islands("indels", 51)} SELECT contig, s AS "start", e AS "end", n AS n_indels FROM merged')
def indel_targets(inp: Inputs) -> DataFrame:
    return intervals.indel_targets(inp["reads"])


REGION_SPANS = f"""spans AS (SELECT concat(m.region, '/', k.rname) AS contig, pos AS s, pos - 1 + {SPAN} AS e
  FROM keyed k JOIN map m ON m.key = k.key)"""


@query(
    f"""WITH RECURSIVE {REGION_MAP}, {REGION_SPANS}, {islands("spans", 51)},
    cut AS (SELECT m.contig, greatest(t.bed_start, m.s - 1) AS s, least(t.bed_end, m.e) AS e FROM merged m
            JOIN {{targets}} t ON t.contig = split_part(m.contig, '/', 2) AND t.bed_start < m.e AND m.s - 1 < t.bed_end)
    SELECT CAST(split_part(contig, '/', 1) AS BIGINT) AS region, split_part(contig, '/', 2) AS contig, s AS bed_start,
           CASE WHEN s = e THEN e + 1 ELSE e END AS bed_end FROM cut"""
)
def region_intervals(inp: Inputs) -> DataFrame:
    made = pipeline.region_intervals(region_reads(inp), target_list(inp))
    return made.withColumn("region", F.col("region").cast("bigint"))


# --- overlaps ----------------------------------------------------------------------------------


@query(
    f"""WITH {SPANS}
    SELECT t.target_id, r.qname, r.contig, greatest(t.bed_start, r.s - 1) AS "start", least(t.bed_end, r.e) AS "end"
    FROM spans r JOIN {{targets}} t ON t.contig = r.contig AND t.bed_start < r.e AND r.s - 1 < t.bed_end"""
)
def interval_intersect(inp: Inputs) -> DataFrame:
    reads = overlaps.read_intervals(mapped_reads(inp)).select("qname", "contig", "start", "end")
    return overlaps.interval_intersect(reads, target_list(inp)).select("target_id", "qname", "contig", "start", "end")


@query(
    f"""WITH {SPANS}
    SELECT r.qname, r.contig AS rname, r.pos FROM spans r SEMI JOIN {{targets}} t
      ON t.contig = r.contig AND t.bed_start < r.e AND r.s - 1 < t.bed_end"""
)
def interval_semi(inp: Inputs) -> DataFrame:
    reads = mapped_reads(inp).select("qname", "rname", "pos", "flag", "cigar")
    return overlaps.interval_semi(reads, target_list(inp)).select("qname", "rname", "pos")


# --- duplicates --------------------------------------------------------------------------------

DEDUP_LINES = 3


@query(
    f"""WITH dup AS (SELECT r.*, CAST(c.contig_index AS BIGINT) * 1000000000000 + r.pos // 5000 AS key
      FROM {{reads_dup}} r JOIN {{contigs}} c ON c.contig = r.rname
      WHERE (r.flag & 4) = 0 AND NOT c.ignored),
    counted AS (SELECT *, count(*) OVER (PARTITION BY chunk, key) AS n,
      row_number() OVER (PARTITION BY chunk, key, pos, mapq, cigar, rnext, pnext ORDER BY qname) AS copy FROM dup)
    SELECT chunk, key, qname, pos, mapq, cigar, pnext FROM counted WHERE n <= {DEDUP_LINES} OR copy = 1"""
)
def dedup_bucket(inp: Inputs) -> DataFrame:
    kept = lookups.anti_ignore_list(filters.filter_mapped(inp["reads_dup"]), inp["ignore_list"])
    keyed = lookups.with_bucket_key(lookups.join_contig_index(kept, inp["contigs"]))
    columns = ["chunk", "key", "qname", "pos", "mapq", "cigar", "rnext", "pnext"]
    return duplicates.dedup_bucket(keyed.select(*columns), DEDUP_LINES).drop("rnext")


# Qualities from 15 on of the fixture's alphabet; a score is the sum of these.
SCORE = " + ".join(f"{ord(c) - 33} * (length(qual) - length(replace(qual, '{c}', '')))" for c in "37;=?ACEGI")

MARKED = f"""scored AS (
      SELECT qname, flag, concat('LIB', chunk % 4) AS library, rname, (flag & 16) <> 0 AS reverse, {SCORE} AS score,
        CASE WHEN (flag & 4) <> 0 THEN NULL WHEN (flag & 16) <> 0
             THEN pos - 1 + {SPAN} + coalesce(TRY_CAST(regexp_extract(cigar, '(\\d+)[SH]$', 1) AS BIGINT), 0)
             ELSE pos - coalesce(TRY_CAST(regexp_extract(cigar, '^(\\d+)[SH]', 1) AS BIGINT), 0) END AS five_prime
      FROM {{reads_dup}}),
    best AS (SELECT library, rname, reverse, five_prime, min(struct_pack(worse := -score, qname := qname)) AS best FROM scored
             WHERE five_prime IS NOT NULL GROUP BY library, rname, reverse, five_prime),
    marked AS (SELECT s.qname, s.library, CASE WHEN s.qname <> b.best.qname THEN s.flag | 1024 ELSE s.flag END AS flag
               FROM scored s LEFT JOIN best b ON b.library = s.library AND b.rname = s.rname AND b.reverse = s.reverse
                 AND b.five_prime = s.five_prime)"""


def marked_reads(inp: Inputs) -> DataFrame:
    reads = inp["reads_dup"].withColumn("library", F.concat(F.lit("LIB"), F.col("chunk") % 4))
    return duplicates.mark_duplicates(reads.select("qname", "flag", "library", "rname", "pos", "cigar", "qual"))


@query(f"WITH {MARKED} SELECT qname, library, flag FROM marked")
def mark_duplicates(inp: Inputs) -> DataFrame:
    return marked_reads(inp).select("qname", "library", "flag")


@query(
    f"""WITH scored AS (
      SELECT qname, flag, library, rname, pos, cigar, {SCORE} AS score, (flag & 4) = 0 AND (flag & 2304) = 0 AS counts,
        (flag & 16) <> 0 AS reverse,
        CASE WHEN (flag & 16) <> 0
             THEN pos - 1 + {SPAN} + coalesce(TRY_CAST(regexp_extract(cigar, '(\\d+)[SH]$', 1) AS BIGINT), 0)
             ELSE pos - coalesce(TRY_CAST(regexp_extract(cigar, '^(\\d+)[SH]', 1) AS BIGINT), 0) END AS five
      FROM {{paired_reads}}),
    e AS (SELECT *, struct_pack(c := rname, f := five, r := reverse) AS e FROM scored WHERE counts),
    pairs AS (SELECT library, qname, min(e) AS low, max(e) AS high, sum(score) AS score FROM e GROUP BY library, qname
              HAVING count(*) = 2 AND count(*) FILTER ((flag & 192) = 64) = 1 AND count(*) FILTER ((flag & 192) = 128) = 1),
    pair_place AS (SELECT library, qname, row_number() OVER (PARTITION BY library, low, high ORDER BY score DESC, qname) > 1 AS copy FROM pairs),
    at_pair AS (SELECT library, low AS e FROM pairs UNION SELECT library, high FROM pairs),
    single AS (SELECT e.library, e.qname, e.e, row_number() OVER (PARTITION BY e.library, e.e ORDER BY e.score DESC, e.qname) > 1 AS copy
               FROM e ANTI JOIN pairs p ON p.library = e.library AND p.qname = e.qname),
    single_copy AS (SELECT s.library, s.qname, s.e FROM single s WHERE s.copy
                    UNION SELECT s.library, s.qname, s.e FROM single s JOIN at_pair a ON a.library = s.library AND a.e = s.e)
    SELECT r.qname, r.library, r.rname, r.pos,
      CASE WHEN r.counts AND (coalesce(p.copy, false) OR s.qname IS NOT NULL) THEN r.flag | 1024 ELSE r.flag END AS flag
    FROM scored r LEFT JOIN pair_place p ON p.library = r.library AND p.qname = r.qname
    LEFT JOIN single_copy s ON s.library = r.library AND s.qname = r.qname AND s.e = struct_pack(c := r.rname, f := r.five, r := r.reverse)"""
)
def mark_duplicate_pairs(inp: Inputs) -> DataFrame:
    return duplicates.mark_duplicate_pairs(inp["paired_reads"], columns=["qname", "library", "rname", "pos", "flag"])


@query(
    f"""WITH {MARKED} SELECT library, count(*) AS n_examined, count(*) FILTER ((flag & 1024) <> 0) AS n_duplicates,
      round(count(*) FILTER ((flag & 1024) <> 0) / count(*), 4) AS duplicate_rate
    FROM marked WHERE (flag & 4) = 0 GROUP BY library"""
)
def duplicate_metrics(inp: Inputs) -> DataFrame:
    metrics = duplicates.duplicate_metrics(marked_reads(inp))
    return metrics.withColumn("duplicate_rate", F.round("duplicate_rate", 4))


# --- bases -------------------------------------------------------------------------------------

# Aligned items of the four CIGAR strings of the fixture: reference offset, read offset, length.
ALIGNED = """aligned(cigar, ref_off, read_off, len) AS (VALUES
      ('32M', 0, 0, 32), ('4S28M', 0, 4, 28), ('10M2D22M', 0, 0, 10), ('10M2D22M', 12, 10, 22),
      ('20M3I9M', 0, 0, 20), ('20M3I9M', 20, 23, 9))"""

BASES = f"""{ALIGNED},
    bases AS (
      SELECT r.qname, r.flag, r.rname, r.contig_index, r.seq, r.qual,
             r.pos + a.ref_off + i AS ref_pos, a.read_off + i + 1 AS read_pos
      FROM {{mapped}} r JOIN aligned a ON a.cigar = r.cigar, LATERAL (SELECT unnest(range(a.len)) AS i) u),
    unmasked AS (SELECT b.* FROM bases b ANTI JOIN {{known_sites}} k ON k.contig = b.rname AND k.pos = b.ref_pos)"""

RECAL = f"""{BASES},
    covered AS (
      SELECT 'GROUP1' AS read_group, ascii(substr(qual, read_pos, 1)) - 33 AS quality,
        CASE WHEN (flag & 16) <> 0 THEN length(seq) - read_pos + 1 ELSE read_pos END AS cycle,
        CASE WHEN (flag & 16) <> 0 THEN
               CASE WHEN read_pos < length(seq) THEN translate(substr(seq, read_pos + 1, 1), 'ACGT', 'TGCA')
                                                  || translate(substr(seq, read_pos, 1), 'ACGT', 'TGCA') END
             WHEN read_pos > 1 THEN substr(seq, read_pos - 1, 2) END AS context,
        substr(seq, read_pos, 1) <> {FORMULA_BASE_SQL.format(i="contig_index", p="ref_pos")} AS mismatch
      FROM unmasked),
    cells AS (SELECT read_group, quality, cycle, context, count(*) AS observations,
                     count(*) FILTER (mismatch) AS mismatches
              FROM covered GROUP BY read_group, quality, cycle, context)"""


def recal_input(inp: Inputs) -> DataFrame:
    columns = ["qname", "flag", "rname", "contig_index", "pos", "cigar", "seq", "qual"]
    return filters.set_read_group(mapped_reads(inp)).select(*columns, "read_group")


@query(f"WITH {BASES} SELECT qname, count(*) AS n_bases FROM unmasked GROUP BY qname")
def mask_known_sites(inp: Inputs) -> DataFrame:
    unmasked = bases.mask_known_sites(recal_input(inp).select("qname", "rname", "flag", "pos", "cigar", "seq"),
                                      inp["known_sites"])
    return unmasked.groupBy("qname").agg(F.count(F.lit(1)).alias("n_bases"))


@query(
    f"""WITH {RECAL} SELECT read_group, quality, CAST(cycle AS INT) AS cycle, context, observations, mismatches,
      round(-10 * log10((mismatches + 1) / (observations + 2)), 4) AS empirical_quality FROM cells"""
)
def recal_table(inp: Inputs) -> DataFrame:
    table = recal.recal_table(recal_input(inp), inp["known_sites"], formula_base)
    return table.withColumn("empirical_quality", F.round("empirical_quality", 4))


LEVEL = "sum(observations) AS observations, sum(mismatches) AS mismatches, grouping_id(quality, cycle, context) AS left_out"


@query(
    f"""WITH {RECAL},
    sets AS (SELECT read_group, quality, CAST(cycle AS INT) AS cycle, context, {LEVEL} FROM cells
             GROUP BY GROUPING SETS ((read_group, quality), (read_group, quality, cycle), (read_group, quality, context)))
    SELECT CASE left_out WHEN 3 THEN 'quality' WHEN 1 THEN 'cycle' ELSE 'context' END AS level, read_group, quality, cycle, context,
      CAST(observations AS BIGINT) AS observations, CAST(mismatches AS BIGINT) AS mismatches,
      round(-10 * log10((mismatches + 1) / (observations + 2)), 4) AS empirical_quality
    FROM sets WHERE left_out <> 2 OR context IS NOT NULL"""
)
def recal_levels(inp: Inputs) -> DataFrame:
    levels = recal.recal_levels(recal.recal_counts(recal_input(inp), inp["known_sites"], formula_base))
    return levels.withColumn("empirical_quality", F.round("empirical_quality", 4))


E = "-10 * log10((sum(mismatches) + 1) / (sum(observations) + 2))"


@query(
    f"""WITH {RECAL},
    by_quality AS (SELECT quality, {E} AS e FROM cells GROUP BY quality),
    by_cycle AS (SELECT quality, cycle, {E} AS e FROM cells GROUP BY quality, cycle),
    by_context AS (SELECT quality, context, {E} AS e FROM cells WHERE context IS NOT NULL GROUP BY quality, context),
    every AS (
      SELECT qname, i, ascii(substr(qual, i, 1)) - 33 AS quality,
        CASE WHEN (flag & 16) <> 0 THEN length(seq) - i + 1 ELSE i END AS cycle,
        CASE WHEN (flag & 16) <> 0 THEN
               CASE WHEN i < length(seq) THEN translate(substr(seq, i + 1, 1), 'ACGT', 'TGCA')
                                           || translate(substr(seq, i, 1), 'ACGT', 'TGCA') END
             WHEN i > 1 THEN substr(seq, i - 1, 2) END AS context
      FROM (SELECT qname, flag, seq, qual, CAST(unnest(range(1, 33)) AS BIGINT) AS i FROM {{mapped}}) m),
    renewed AS (
      SELECT v.qname, v.i, CASE WHEN q.e IS NULL THEN v.quality ELSE greatest(1, least(60, floor(
               q.e + coalesce(c.e - q.e, 0) + coalesce(x.e - q.e, 0) + 0.5))) END AS new_quality
      FROM every v LEFT JOIN by_quality q ON q.quality = v.quality
      LEFT JOIN by_cycle c ON c.quality = v.quality AND c.cycle = v.cycle
      LEFT JOIN by_context x ON x.quality = v.quality AND x.context = v.context)
    SELECT qname, string_agg(chr(CAST(new_quality AS INT) + 33), '' ORDER BY i) AS new_qual FROM renewed GROUP BY qname"""
)
def apply_recal(inp: Inputs) -> DataFrame:
    reads = recal_input(inp)
    table = materialize(recal.recal_counts(reads, inp["known_sites"], formula_base), "recal")
    return recal.apply_recal(reads, table).select("qname", "new_qual")


PILEUP = f"""{BASES},
    targeted AS (SELECT b.rname AS contig, b.contig_index, b.ref_pos AS pos, substr(b.seq, b.read_pos, 1) AS base
      FROM bases b SEMI JOIN {{targets}} t ON t.contig = b.rname AND t.bed_start < b.ref_pos AND b.ref_pos <= t.bed_end),
    pile AS (SELECT contig, contig_index, pos, count(*) AS depth, count(*) FILTER (base = 'A') AS n_a,
        count(*) FILTER (base = 'C') AS n_c, count(*) FILTER (base = 'G') AS n_g, count(*) FILTER (base = 'T') AS n_t
      FROM targeted GROUP BY contig, contig_index, pos)"""


def pileup_of(inp: Inputs) -> DataFrame:
    reads = mapped_reads(inp).select("flag", "rname", "pos", "cigar", "seq")
    return pileup.pileup_counts(reads, target_list(inp))


@query(f"WITH {PILEUP} SELECT contig, pos, depth, n_a, n_c, n_g, n_t FROM pile")
def pileup_counts(inp: Inputs) -> DataFrame:
    return pileup_of(inp)


@query(
    f"""WITH {PILEUP},
    refs AS (SELECT *, {FORMULA_BASE_SQL.format(i="contig_index", p="pos")} AS ref FROM pile),
    longer AS (
      SELECT *, unnest(['A', 'C', 'G', 'T']) AS base, unnest([n_a, n_c, n_g, n_t]) AS n FROM refs),
    alts AS (SELECT *, row_number() OVER (PARTITION BY contig, pos ORDER BY n DESC, base) AS place
             FROM longer WHERE base <> ref),
    chosen AS (SELECT contig, contig_index, pos, ref, base AS alt, depth, n AS alt_count,
        CASE ref WHEN 'A' THEN n_a WHEN 'C' THEN n_c WHEN 'G' THEN n_g ELSE n_t END AS ref_count
      FROM alts WHERE place = 1),
    liked AS (SELECT *, ref_count * log10(0.99) + alt_count * log10(0.01) AS rr,
        (ref_count + alt_count) * log10(0.5) AS ra, ref_count * log10(0.01) + alt_count * log10(0.99) AS aa FROM chosen),
    called AS (SELECT *, 10 * (greatest(rr, ra, aa) - rr) AS confidence,
        CASE WHEN greatest(rr, ra, aa) = rr THEN '0/0' WHEN greatest(rr, ra, aa) = ra THEN '0/1' ELSE '1/1' END AS genotype
      FROM liked)
    SELECT contig, pos, ref, alt, depth, ref_count, alt_count, genotype, round(confidence, 4) AS confidence
    FROM called WHERE genotype <> '0/0' AND confidence >= 15"""
)
def variant_calls(inp: Inputs) -> DataFrame:
    calls = pileup.variant_calls(pileup_of(inp), inp["contigs"], formula_base, min_confidence=15.0)
    return calls.withColumn("confidence", F.round("confidence", 4)).drop("contig_index")


# --- variant lines -----------------------------------------------------------------------------

HEADERS = """headers AS (
      SELECT file_no, line_no, line, CAST(row_number() OVER (PARTITION BY file_no ORDER BY line_no) - 1 AS INT) AS ordinal
      FROM {vcf_lines} WHERE line LIKE '#%')"""

KEYED_LINES = f"""{HEADERS},
    keyed AS (
      SELECT file_no, line_no, CAST(-1 AS INT) AS contig_index, CAST(ordinal AS BIGINT) AS pos, line FROM headers
      UNION ALL
      SELECT v.file_no, v.line_no, CAST(c.contig_index AS INT), CAST(split_part(v.line, chr(9), 2) AS BIGINT), v.line
      FROM {{vcf_lines}} v LEFT JOIN {{contigs}} c ON c.contig = split_part(v.line, chr(9), 1)
      WHERE v.line NOT LIKE '#%')"""


@query(f"WITH {HEADERS} SELECT file_no, line_no, line, ordinal FROM headers")
def header_ordinals(inp: Inputs) -> DataFrame:
    return ordering.header_ordinals(inp["vcf_lines"])


@query(f"WITH {KEYED_LINES} SELECT file_no, line_no, contig_index, pos, line FROM keyed")
def vcf_key(inp: Inputs) -> DataFrame:
    return ordering.vcf_key(inp["vcf_lines"], inp["contigs"])


@query(f"WITH {KEYED_LINES} SELECT DISTINCT contig_index, pos, line FROM keyed ORDER BY contig_index, pos, line")
def merge_vcf(inp: Inputs) -> DataFrame:
    return ordering.merge_vcf(ordering.vcf_key(inp["vcf_lines"], inp["contigs"]))


# --- mates -------------------------------------------------------------------------------------


PAIRED = """SELECT a.rec_no, b.mate, b.name, b.seq, b.qual FROM
      (SELECT rec_no FROM {fastq} WHERE mate = 1 INTERSECT SELECT rec_no FROM {fastq} WHERE mate = 2) a
      JOIN {fastq} b ON b.rec_no = a.rec_no"""


@query(PAIRED)
def interleave_pairs(inp: Inputs) -> DataFrame:
    fastq = inp["fastq"]
    return pairs.interleave_pairs(fastq.where("mate = 1"), fastq.where("mate = 2")).orderBy("rec_no", "mate")


@query(PAIRED)
def interleave_stored(inp: Inputs) -> DataFrame:
    fastq, names = inp["fastq"], [f"mates_{uuid.uuid4().hex}" for _ in range(2)]
    n_buckets = max(4, pairs.buckets_for(fastq.where("mate = 1").count()))
    for mate, name in enumerate(names, 1):
        sinks.sink_mates(fastq.where(F.col("mate") == mate), name, scratch_dir(inp.spark, "mates"), n_buckets)
    return pairs.interleave_stored(inp.spark, *names)
