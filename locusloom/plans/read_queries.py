"""Queries on lines, reads, buckets and regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import read_group_id as read_group_id_of
from ..functions.text import region_base_name
from ..functions.text import region_name_parts as name_parts
from ..operators import filters, histogram, lookups, ordering, regions
from ..session import materialize
from .fixtures import Inputs
from .registry import query

N_REGIONS = 16
N_LB_REGIONS = 8

MAPPED_KEYED = """SELECT m.*, CAST(m.contig_index AS BIGINT) * 1000000000000 + m.pos // 5000 AS key FROM {mapped} m"""

HISTOGRAM = f"""keyed AS ({MAPPED_KEYED}),
hist AS (SELECT key, count(*) AS n FROM keyed GROUP BY key)"""

# The plain walk: from each region start to the next, by running sums.
REGION_MAP = f"""{HISTOGRAM},
sums AS (SELECT key, n, row_number() OVER (ORDER BY key) AS rn,
                CAST(sum(n) OVER (ORDER BY key) AS BIGINT) AS upto FROM hist),
goal AS (SELECT CAST(sum(n) AS BIGINT) // {N_REGIONS} AS target FROM hist),
walk AS (
  SELECT CAST(0 AS INT) AS region, CAST(0 AS BIGINT) AS base, CAST(0 AS BIGINT) AS rn
  UNION ALL
  SELECT region, base, rn FROM (
    SELECT w.region + 1 AS region, s.upto - s.n AS base, s.rn,
           row_number() OVER (PARTITION BY w.region ORDER BY s.rn) AS place
    FROM walk w CROSS JOIN goal g JOIN sums s ON s.upto > w.base + g.target AND s.rn > w.rn) t
  WHERE place = 1),
map AS (SELECT s.key, s.n, CAST(max(w.region) AS INT) AS region
        FROM sums s JOIN walk w ON w.rn <= s.rn GROUP BY s.key, s.n)"""


def mapped_reads(inp: Inputs) -> DataFrame:
    """Reads that count: mapped, on a contig in use, with their contig index."""
    kept = lookups.anti_ignore_list(filters.filter_mapped(inp["reads"]), inp["ignore_list"])
    return lookups.join_contig_index(kept, inp["contigs"])


def keyed_reads(inp: Inputs) -> DataFrame:
    return lookups.with_bucket_key(mapped_reads(inp))


def stored_histogram(inp: Inputs) -> DataFrame:
    """The bucket histogram, computed once."""
    return materialize(histogram.bucket_histogram(keyed_reads(inp)), "histogram")


def stored_regions(inp: Inputs) -> DataFrame:
    """The region map, computed once; it is small and looked up by every read."""
    return materialize(regions.balanced_regions(stored_histogram(inp), N_REGIONS), "regions")


def region_reads(inp: Inputs) -> DataFrame:
    return regions.join_region_map(keyed_reads(inp), stored_regions(inp))


# --- lines and scalar fields -------------------------------------------------------------------

SAM_FIELDS = """
SELECT chunk, p[1] AS qname, CASE WHEN regexp_matches(p[2], '^[+-]?[0-9]+$') THEN TRY_CAST(p[2] AS INT) END AS flag,
       p[3] AS rname, CASE WHEN regexp_matches(p[4], '^[+-]?[0-9]+$') THEN TRY_CAST(p[4] AS BIGINT) END AS pos,
       TRY_CAST(p[5] AS INT) AS mapq, p[6] AS cigar, p[7] AS rnext, TRY_CAST(p[8] AS BIGINT) AS pnext,
       TRY_CAST(p[9] AS BIGINT) AS tlen, p[10] AS seq, p[11] AS qual, line
FROM (SELECT chunk, line, string_split(line, chr(9)) AS p FROM {sam_lines} WHERE line NOT LIKE '@%') t"""

BAD_RECORD = """(f.flag IS NULL OR ((f.flag & 4) = 0 AND (f.rname IS NULL OR (f.rname <> '*'
  AND NOT coalesce(c.ignored, false) AND (c.contig_index IS NULL OR f.pos IS NULL)))))"""


@query(f"SELECT chunk, qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, seq, qual FROM ({SAM_FIELDS}) t")
def sam_fields(inp: Inputs) -> DataFrame:
    return filters.sam_fields(inp["sam_lines"]).drop("tags", "line")


@query("SELECT qname, flag, rname, pos FROM {reads} WHERE (flag & 4) = 0 AND rname <> '*'")
def filter_mapped(inp: Inputs) -> DataFrame:
    return filters.filter_mapped(inp["reads"]).select("qname", "flag", "rname", "pos")


@query(
    f"""SELECT f.chunk, f.line FROM ({SAM_FIELDS}) f LEFT JOIN {{contigs}} c ON c.contig = f.rname
    WHERE {BAD_RECORD}"""
)
def bad_lines(inp: Inputs) -> DataFrame:
    return filters.bad_lines(inp["sam_lines"], inp["contigs"]).select("chunk", "line")


@query(f"WITH keyed AS ({MAPPED_KEYED}) SELECT qname, key FROM keyed")
def bucket_key(inp: Inputs) -> DataFrame:
    return keyed_reads(inp).select("qname", "key")


@query(
    f"""WITH {HISTOGRAM}
    SELECT key, CAST(key // 1000000000000 AS INT) AS contig_index, key % 1000000000000 AS bucket, n FROM hist"""
)
def bucket_decode(inp: Inputs) -> DataFrame:
    return lookups.decode_bucket_key(histogram.bucket_histogram(keyed_reads(inp)))


@query(
    """SELECT qname, pos, cigar, CASE WHEN (flag & 4) = 0 AND cigar <> '*' THEN pos - 1 + CAST(list_sum(
         list_transform(regexp_extract_all(cigar, '(\\d+)[MDN=X]', 1), lambda x: CAST(x AS BIGINT))) AS BIGINT) END AS aend
    FROM {reads}"""
)
def alignment_end(inp: Inputs) -> DataFrame:
    return filters.with_alignment_end(inp["reads"]).select("qname", "pos", "cigar", "aend")


QUALS = "list_transform(string_split(qual, ''), lambda x: ascii(x) - 33)"


@query(
    f"""SELECT qname, m AS max_quality, CASE WHEN m <= 60 THEN 'SANGER' ELSE 'ILLUMINA' END AS encoding
    FROM (SELECT qname, list_max({QUALS}) AS m FROM {{reads}}) t"""
)
def quality_encoding(inp: Inputs) -> DataFrame:
    return filters.with_quality_encoding(inp["reads"]).select("qname", "max_quality", "encoding")


@query(
    f"""SELECT qname, bad_quality,
      CASE WHEN bad_quality IS NULL THEN array_to_string(q, ',') END AS fixed_quals
    FROM (SELECT qname, q, list_filter(q, lambda x: x < 0)[1] AS bad_quality
          FROM (SELECT qname, list_transform({QUALS}, lambda x: x + mapq - 31) AS q FROM {{reads}}) s) t"""
)
def fix_quality(inp: Inputs) -> DataFrame:
    # The fixture's qualities all lie below the shift; raise each read's by its MAPQ to see both outcomes.
    raised = inp["reads"].withColumn(
        "qual",
        F.array_join(F.transform(F.split("qual", ""), lambda c: F.chr(F.ascii(c) + F.col("mapq"))), ""),
    )
    return filters.fix_quality(raised).select(
        "qname", "bad_quality", F.array_join(F.col("fixed_quals").cast("array<string>"), ",").alias("fixed_quals")
    )


@query("SELECT qname, 'GROUP1' AS read_group, 'LIB1' AS library FROM {reads}")
def set_read_group(inp: Inputs) -> DataFrame:
    return filters.set_read_group(inp["reads"]).select("qname", "read_group", "library")


@query("SELECT sample_id, regexp_extract(rg, 'ID:([^\\\\]*)\\\\', 1) AS read_group_id FROM {read_group_strings}")
def read_group_id(inp: Inputs) -> DataFrame:
    return inp["read_group_strings"].select("sample_id", read_group_id_of(F.col("rg")).alias("read_group_id"))


@query(
    f"""WITH RECURSIVE {REGION_MAP}, names AS (SELECT DISTINCT concat(key % 8, '_', region, '.bed') AS name FROM map)
    SELECT name, replace(name, '.bed', '') AS base_name, CAST(split_part(name, '_', 1) AS INT) AS lb_region,
           CAST(split_part(replace(name, '.bed', ''), '_', 2) AS INT) AS region FROM names"""
)
def region_name_parts(inp: Inputs) -> DataFrame:
    names = (
        stored_regions(inp)
        .select(F.concat(F.col("key") % 8, F.lit("_"), F.col("region"), F.lit(".bed")).alias("name"))
        .distinct()
    )
    lb_region, region = name_parts(F.col("name"))
    return names.select(
        "name",
        region_base_name(F.col("name")).alias("base_name"),
        lb_region.alias("lb_region"),
        region.alias("region"),
    )


@query(
    """WITH ends AS (SELECT r.*, c.length // 2 AS len,
        CASE WHEN (flag & 4) = 0 AND cigar <> '*' THEN pos - 1 + CAST(list_sum(list_transform(
          regexp_extract_all(cigar, '(\\d+)[MDN=X]', 1), lambda x: CAST(x AS BIGINT))) AS BIGINT) END AS aend
      FROM {reads} r LEFT JOIN {contigs} c ON c.contig = r.rname)
    SELECT qname, flag, CASE WHEN (flag & 4) <> 0 THEN 0 ELSE mapq END AS mapq,
           CASE WHEN aend > len THEN len ELSE aend END AS aend, coalesce(aend > len, false) AS past_end FROM ends"""
)
def clean_reads(inp: Inputs) -> DataFrame:
    # Contigs of half their length, so that some reads do reach over the end.
    halved = inp["contigs"].withColumn("length", F.expr("length div 2"))
    return filters.clean_reads(inp["reads"], halved).select("qname", "flag", "mapq", "aend", "past_end")


# --- lookups -----------------------------------------------------------------------------------


@query("SELECT r.qname, r.rname, c.contig_index FROM {reads} r LEFT JOIN {contigs} c ON c.contig = r.rname")
def join_contig_index(inp: Inputs) -> DataFrame:
    return lookups.join_contig_index(inp["reads"], inp["contigs"], "left").select("qname", "rname", "contig_index")


@query(
    """SELECT qname, rname FROM {reads} r
    WHERE NOT EXISTS (SELECT 1 FROM {ignore_list} i WHERE i.contig = r.rname)"""
)
def anti_ignore_list(inp: Inputs) -> DataFrame:
    return lookups.anti_ignore_list(inp["reads"], inp["ignore_list"]).select("qname", "rname")


@query(f"WITH RECURSIVE {REGION_MAP} SELECT k.qname, k.key, m.region FROM keyed k JOIN map m ON m.key = k.key")
def join_region_map(inp: Inputs) -> DataFrame:
    return region_reads(inp).select("qname", "key", "region")


BINS = """bins AS (
  SELECT c.contig_index, c.contig, greatest(1, c.length // 1000000) AS n_bins, c.length FROM {contigs} c WHERE NOT ignored),
numbered AS (
  SELECT contig_index, contig, CAST(n_bins AS BIGINT) AS n_bins,
         CAST(coalesce(sum(n_bins) OVER (ORDER BY contig_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS BIGINT) AS first_bin,
         CAST(sum(n_bins) OVER () AS BIGINT) AS total_bins, CAST(sum(length) OVER () AS BIGINT) AS total_length
  FROM bins)"""


@query(
    f"""WITH {BINS},
    placed AS (SELECT r.qname, r.pos, n.first_bin + least(r.pos // 1000000, n.n_bins - 1) AS bin_no,
                      greatest(1, (SELECT max(total_bins) FROM numbered) // {N_LB_REGIONS}) AS per_region
               FROM {{reads}} r JOIN {{contigs}} c ON c.contig = r.rname
               LEFT JOIN numbered n ON n.contig_index = c.contig_index WHERE (r.flag & 4) = 0)
    SELECT qname, pos, bin_no,
           CAST(coalesce(least(bin_no // per_region, {N_LB_REGIONS - 1}), {N_LB_REGIONS - 1}) AS INT) AS lb_region
    FROM placed"""
)
def join_lb_bin(inp: Inputs) -> DataFrame:
    # Ignored contigs have no bins and show the fallback to the last region.
    reads = lookups.join_contig_index(filters.filter_mapped(inp["reads"]), inp["contigs"])
    return lookups.join_lb_bin(reads, inp["contigs"], N_LB_REGIONS).select("qname", "pos", "bin_no", "lb_region")


@query(f"WITH {BINS} SELECT contig_index, contig, n_bins, first_bin, total_bins, total_length FROM numbered")
def genome_bins(inp: Inputs) -> DataFrame:
    return lookups.genome_bins(inp["contigs"]).select(
        "contig_index", "contig", "n_bins", "first_bin", "total_bins", "total_length"
    )


@query(
    f"""WITH {BINS} SELECT contig_index, contig, CAST(b AS BIGINT) AS bin, first_bin + b AS bin_no
    FROM (SELECT *, unnest(range(n_bins)) AS b FROM numbered) t"""
)
def bin_numbers(inp: Inputs) -> DataFrame:
    return lookups.bin_numbers(inp["contigs"]).select("contig_index", "contig", "bin", "bin_no")


@query(
    """SELECT contig_index, contig, CAST(row_number() OVER (ORDER BY contig_index) - 1 AS INT) AS array_index
    FROM {contigs} WHERE NOT ignored"""
)
def contig_array_index(inp: Inputs) -> DataFrame:
    return lookups.contig_array_index(inp["contigs"]).select("contig_index", "contig", "array_index")


# --- histograms and regions --------------------------------------------------------------------


@query(f"WITH keyed AS ({MAPPED_KEYED}) SELECT chunk, key, count(*) AS n FROM keyed GROUP BY chunk, key")
def chunk_histogram(inp: Inputs) -> DataFrame:
    return histogram.chunk_histogram(keyed_reads(inp))


@query(f"WITH {HISTOGRAM} SELECT key, n FROM hist ORDER BY key")
def bucket_histogram(inp: Inputs) -> DataFrame:
    return histogram.bucket_histogram(keyed_reads(inp)).orderBy("key")


@query(
    f"""WITH {HISTOGRAM} SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(n) AS BIGINT) // {N_REGIONS} AS target
    FROM hist"""
)
def reads_per_region_target(inp: Inputs) -> DataFrame:
    return histogram.region_target(histogram.bucket_histogram(keyed_reads(inp)), N_REGIONS)


@query(
    f"""WITH {HISTOGRAM} SELECT key, n, (SELECT CAST(sum(n) AS BIGINT) // 4000 FROM hist) AS target FROM hist
    WHERE n > (SELECT CAST(sum(n) AS BIGINT) // 4000 FROM hist)"""
)
def hot_buckets(inp: Inputs) -> DataFrame:
    # As many regions as buckets, so that some buckets are above the target.
    return histogram.hot_buckets(histogram.bucket_histogram(keyed_reads(inp)), 4000)


@query(
    f"""WITH classified AS (
      SELECT f.chunk, CASE WHEN {BAD_RECORD} THEN 'bad'
               WHEN (f.flag & 4) = 0 AND f.rname <> '*' AND NOT c.ignored THEN 'mapped' ELSE 'other' END AS status,
             CAST(c.contig_index AS BIGINT) * 1000000000000 + f.pos // 5000 AS key
      FROM ({SAM_FIELDS}) f LEFT JOIN {{contigs}} c ON c.contig = f.rname)
    SELECT chunk, count(DISTINCT CASE WHEN status = 'mapped' THEN key END) AS n_keys,
           count(*) FILTER (status = 'mapped') AS n_reads, count(*) FILTER (status = 'bad') AS n_bad_lines
    FROM classified GROUP BY chunk"""
)
def chunk_qc(inp: Inputs) -> DataFrame:
    classified = filters.classify_records(filters.sam_fields(inp["sam_lines"]), inp["contigs"])
    return histogram.chunk_qc(lookups.with_bucket_key(classified))


@query(f"WITH RECURSIVE {REGION_MAP} SELECT key, n, region FROM map")
def balanced_regions(inp: Inputs) -> DataFrame:
    return regions.balanced_regions(stored_histogram(inp), N_REGIONS)


@query(
    f"""WITH RECURSIVE {REGION_MAP}
    SELECT m.region, count(DISTINCT (k.chunk, k.key)) AS n_blocks, count(*) AS n_reads,
           min(k.key) AS first_key, max(k.key) AS last_key
    FROM keyed k JOIN map m ON m.key = k.key GROUP BY m.region"""
)
def group_by_region(inp: Inputs) -> DataFrame:
    blocks = materialize(histogram.chunk_histogram(keyed_reads(inp)), "blocks")
    totals = materialize(histogram.combine_histograms(blocks), "histogram")
    region_map = materialize(regions.balanced_regions(totals, N_REGIONS), "regions")
    return regions.group_by_region(blocks, region_map)


@query(
    f"""WITH RECURSIVE {REGION_MAP} SELECT CAST(max(region) + 1 AS BIGINT) AS n_regions,
    count(DISTINCT region) AS n_used_regions FROM map"""
)
def region_count(inp: Inputs) -> DataFrame:
    return regions.region_count(stored_regions(inp))


@query(
    f"""WITH RECURSIVE {REGION_MAP}
    SELECT m.region, count(*) AS n_records, count(*) AS n_sorted, CAST(0 AS BIGINT) AS n_bad
    FROM keyed k JOIN map m ON m.key = k.key GROUP BY m.region"""
)
def region_qc(inp: Inputs) -> DataFrame:
    return histogram.region_qc(region_reads(inp))


@query(f"WITH RECURSIVE {REGION_MAP} SELECT region, CAST(sum(n) AS BIGINT) AS n_reads FROM map GROUP BY region")
def regions_by_size(inp: Inputs) -> DataFrame:
    return regions.regions_by_size(stored_regions(inp))


N_PARTITIONS = 5

PLACED = f"""{REGION_MAP},
    sizes AS (SELECT region, CAST(sum(n) AS BIGINT) AS n_reads, row_number() OVER (ORDER BY sum(n) DESC, region) AS place FROM map GROUP BY region),
    fill AS (
      SELECT CAST(0 AS BIGINT) AS place, CAST(-1 AS INT) AS region, CAST(0 AS BIGINT) AS n_reads, CAST(-1 AS INT) AS part,
             list_transform(range({N_PARTITIONS}), lambda x: CAST(0 AS BIGINT)) AS loads
      UNION ALL
      SELECT s.place, s.region, s.n_reads, CAST(list_position(f.loads, list_min(f.loads)) - 1 AS INT),
             list_transform(f.loads, lambda x, i: x + CASE WHEN i = list_position(f.loads, list_min(f.loads)) THEN s.n_reads ELSE 0 END)
      FROM fill f JOIN sizes s ON s.place = f.place + 1),
    placed AS (SELECT region, n_reads, part AS partition, CAST(sum(n_reads) OVER (PARTITION BY part) AS BIGINT) AS load FROM fill WHERE place > 0)"""


@query(f"""WITH RECURSIVE {PLACED} SELECT region, n_reads, "partition", load FROM placed""")
def region_placement(inp: Inputs) -> DataFrame:
    return regions.place_regions(stored_regions(inp), N_PARTITIONS)


@query(
    f"""WITH RECURSIVE {PLACED}
    SELECT p."partition", k.qname, p.region FROM keyed k JOIN map m ON m.key = k.key JOIN placed p ON p.region = m.region"""
)
def placed_reads(inp: Inputs) -> DataFrame:
    tagged = region_reads(inp).select("region", "contig_index", "pos", "qname")
    placed = regions.placed_reads(tagged, materialize(region_placement(inp), "placement"), N_PARTITIONS)
    return placed.select("partition", "qname", "region")


@query(
    f"""WITH RECURSIVE {REGION_MAP}
    SELECT m.region, k.chunk, k.key, count(*) AS n FROM keyed k JOIN map m ON m.key = k.key GROUP BY m.region, k.chunk, k.key"""
)
def region_blocks(inp: Inputs) -> DataFrame:
    blocks = materialize(histogram.chunk_histogram(keyed_reads(inp)), "blocks")
    totals = materialize(histogram.combine_histograms(blocks), "histogram")
    return regions.region_blocks(blocks, materialize(regions.balanced_regions(totals, N_REGIONS), "regions"))


# --- order and union ---------------------------------------------------------------------------


@query("SELECT contig_index, pos, qname, flag, cigar FROM {mapped} ORDER BY contig_index, pos, qname")
def sort_reads(inp: Inputs) -> DataFrame:
    return ordering.sort_reads(mapped_reads(inp)).select("contig_index", "pos", "qname", "flag", "cigar")


@query("SELECT contig_index, pos, qname FROM {mapped}")
def union_regions(inp: Inputs) -> DataFrame:
    reads = mapped_reads(inp).select("contig_index", "pos", "qname")
    forward, reverse = reads.where(F.col("contig_index") < 8), reads.where(F.col("contig_index") >= 8)
    return ordering.union_regions(forward, reverse)
