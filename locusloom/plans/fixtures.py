"""Genomic inputs derived from the driver tables.

The tables hold no genome data. Each view is one SQL text that means the same in Spark and in DuckDB;
names in braces are the tables and views it reads.
"""

from __future__ import annotations

import os
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

VIEWS = {
    "contigs": """
SELECT n_nationkey AS contig_index, n_name AS contig,
       1000000 + n_nationkey * 40000 AS length, n_regionkey = 4 AS ignored
FROM {nation}
""",
    "reads": """
SELECT concat('r', l_orderkey, '_', l_linenumber, '_', l_partkey, '_', l_suppkey, '_',
              CAST(round(l_extendedprice * 100) AS BIGINT)) AS qname,
  (CASE WHEN l_linestatus = 'O' THEN 16 ELSE 0 END)
    + (CASE WHEN l_linenumber = 7 THEN 4 ELSE 0 END) AS flag,
  CASE WHEN l_linenumber = 7 THEN '*' ELSE concat('NATION_', l_suppkey % 25) END AS rname,
  CASE WHEN l_linenumber = 7 THEN 0
       ELSE 1 + (l_partkey % 997) * 1000 + (l_orderkey % 13) * 20 END AS pos,
  CAST(l_quantity AS INT) AS mapq,
  CASE WHEN l_linenumber = 7 THEN '*' WHEN l_linenumber % 4 = 0 THEN '32M'
       WHEN l_linenumber % 4 = 1 THEN '4S28M' WHEN l_linenumber % 4 = 2 THEN '10M2D22M'
       ELSE '20M3I9M' END AS cigar,
  '=' AS rnext,
  1 + (l_partkey % 997) * 1000 + (l_orderkey % 7) * 50 AS pnext,
  0 AS tlen,
  translate(md5(concat(l_orderkey, '-', l_linenumber, '-', l_partkey)),
            '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq,
  translate(md5(concat('q', l_orderkey, '-', l_linenumber, '-', l_partkey)),
            '0123456789abcdef', '!#%)+/37;=?ACEGI') AS qual,
  l_orderkey % 16 AS chunk
FROM {lineitem}
""",
    "sam_lines": """
SELECT chunk, concat_ws(chr(9), qname, CAST(flag AS STRING), rname, CAST(pos AS STRING),
       CAST(mapq AS STRING), cigar, rnext, CAST(pnext AS STRING), CAST(tlen AS STRING), seq, qual) AS line
FROM {reads}
UNION ALL
SELECT CAST(0 AS BIGINT) AS chunk, concat_ws(chr(9), '@SQ', concat('SN:', contig), concat('LN:', length)) AS line
FROM {contigs}
UNION ALL
SELECT chunk, concat_ws(chr(9), qname, 'x', rname, 'y') AS line FROM {reads} WHERE mapq = 13 AND flag = 0
UNION ALL
SELECT chunk, concat_ws(chr(9), qname, '0', 'NATION_99', '7', '9', '32M', '=', '7', '0', seq, qual) AS line
FROM {reads} WHERE mapq = 17 AND flag = 0
""",
    "reads_dup": """
SELECT qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, seq, qual, chunk FROM {reads}
UNION ALL
SELECT concat(qname, '_d') AS qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, seq, qual, chunk
FROM {reads} WHERE mapq % 5 = 0
""",
    "targets": """
SELECT p_partkey AS target_id, concat('NATION_', p_partkey % 25) AS contig,
       (p_partkey % 997) * 1000 AS bed_start, (p_partkey % 997) * 1000 + p_size * 10 AS bed_end
FROM {part}
""",
    "known_sites": """
SELECT o_orderkey AS site_id, concat('NATION_', o_custkey % 25) AS contig,
       1 + (o_orderkey % 997) * 1000 + o_custkey % 300 AS pos
FROM {orders}
""",
    "vcf_lines": """
SELECT f.file_no, h.line_no, h.line
FROM (SELECT DISTINCT o_orderkey % 16 AS file_no FROM {orders}) f
CROSS JOIN (SELECT CAST(0 AS BIGINT) AS line_no, '##fileformat=VCFv4.2' AS line
            UNION ALL SELECT CAST(1 AS BIGINT), '#CHROM POS ID REF ALT QUAL') h
UNION ALL
SELECT site_id % 16 AS file_no, 2 + site_id AS line_no,
       concat_ws(chr(9), contig, CAST(pos AS STRING), '.', 'A', 'G', '50') AS line FROM {known_sites}
UNION ALL
SELECT (site_id + 1) % 16 AS file_no, 2 + site_id AS line_no,
       concat_ws(chr(9), contig, CAST(pos AS STRING), '.', 'A', 'G', '50') AS line
FROM {known_sites} WHERE site_id % 10 = 0
""",
    "fastq": """
SELECT doc_id AS rec_no, 1 AS mate, concat('d', doc_id) AS name,
       translate(md5(text), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq,
       translate(md5(concat('q', text)), '0123456789abcdef', '!#%)+/37;=?ACEGI') AS qual FROM {documents}
UNION ALL
SELECT doc_id AS rec_no, 2 AS mate, concat('d', doc_id) AS name,
       translate(md5(concat('m2', text)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq,
       translate(md5(concat('q2', text)), '0123456789abcdef', '!#%)+/37;=?ACEGI') AS qual FROM {documents}
""",
}

# Views that only the registered queries need.
VIEWS["paired_reads"] = """
SELECT qname, flag | 65 AS flag, concat('LIB', chunk % 4) AS library, rname, pos, cigar, qual FROM {reads}
UNION ALL
SELECT qname, (CASE WHEN (flag & 16) <> 0 THEN 0 ELSE 16 END) | 129 | (CASE WHEN mapq % 11 = 0 THEN 256 ELSE 0 END) AS flag,
  concat('LIB', chunk % 4) AS library, CASE WHEN rname = '*' THEN concat('NATION_', mapq % 25) ELSE rname END AS rname,
  pnext + mapq % 2 AS pos, CASE WHEN mapq % 3 = 0 THEN '30M2S' ELSE '32M' END AS cigar, qual
FROM {reads} WHERE mapq % 7 <> 0
"""
VIEWS["ignore_list"] = "SELECT contig FROM {contigs} WHERE ignored"
VIEWS["mapped"] = """
SELECT r.*, c.contig_index FROM {reads} r JOIN {contigs} c ON c.contig = r.rname
WHERE (r.flag & 4) = 0 AND r.rname <> '*' AND NOT c.ignored
"""
VIEWS["bed_lines"] = """
SELECT CASE WHEN p_partkey % 10 = 0 THEN concat('NATION_', p_partkey % 25)
       ELSE concat_ws(chr(9), concat('NATION_', p_partkey % 25), CAST((p_partkey % 997) * 1000 AS STRING),
                      CAST((p_partkey % 997) * 1000 + p_size % 3 AS STRING), 'x') END AS line
FROM {part}
"""
VIEWS["read_group_strings"] = """
SELECT c_custkey AS sample_id, concat('@RG', chr(92), 'tID:G', c_custkey, chr(92), 'tLB:LIB', c_nationkey) AS rg
FROM {customer}
"""

# Tables that become reads, sites and sequences, with a column to spread them by where SPREAD asks for it.
LARGE_TABLES = {"lineitem": "l_orderkey", "orders": "o_orderkey", "documents": "doc_id"}
# A session setting: the number of partitions into which these tables are dealt. The test tables have one row group
# each, which one task reads; by default they are taken as they lie.
SPREAD = "spark.locusloom.spread"


def needs(sql: str) -> list[str]:
    """Names in braces, in order of appearance."""
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


def _reads_dup(inp: Inputs) -> DataFrame:
    """The view of that name from one scan: a read with a planted copy becomes two rows."""
    reads = inp["reads"]
    names = F.when(F.col("mapq") % 5 == 0, F.array("qname", F.concat("qname", F.lit("_d")))).otherwise(F.array("qname"))
    return reads.withColumn("qname", F.explode_outer(names)).select(*reads.columns)


def _sam_lines(inp: Inputs) -> DataFrame:
    """The view of that name from one scan: a read becomes its line and, for some, a bad line as well."""

    def text(*fields: Column | str) -> Column:
        return F.concat_ws("\t", *[F.col(f).cast("string") if isinstance(f, str) else f for f in fields])

    line = text("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")
    malformed = text("qname", F.lit("x"), "rname", F.lit("y"))
    unknown = text(
        "qname", F.lit("0"), F.lit("NATION_99"), F.lit("7"), F.lit("9"), F.lit("32M"), F.lit("="), F.lit("7"),
        F.lit("0"), "seq", "qual",
    )
    forward = F.col("flag") == 0
    lines = (
        F.when(forward & (F.col("mapq") == 13), F.array(line, malformed))
        .when(forward & (F.col("mapq") == 17), F.array(line, unknown))
        .otherwise(F.array(line))
    )
    header = F.concat_ws("\t", F.lit("@SQ"), F.concat(F.lit("SN:"), F.col("contig")), F.concat(F.lit("LN:"), F.col("length")))
    return (
        inp["reads"]
        .select("chunk", F.explode_outer(lines).alias("line"))
        .unionByName(inp["contigs"].select(F.lit(0).cast("bigint").alias("chunk"), header.alias("line")))
    )


# Views whose SQL reads the reads several times; Spark gets the same rows from one scan.
SINGLE_SCAN = {"reads_dup": _reads_dup, "sam_lines": _sam_lines}


class Inputs:
    """Tables and views of one data folder as DataFrames, e.g. ``Inputs(spark, path)["reads"]``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._known: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._known:
            if name in SINGLE_SCAN:
                self._known[name] = SINGLE_SCAN[name](self)
            elif name in VIEWS:
                sql = VIEWS[name]
                self._known[name] = self.spark.sql(sql, **{n: self[n] for n in needs(sql)})
            else:
                self._known[name] = self._table(name)
        return self._known[name]

    def _table(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(os.path.join(self.folder, f"{name}.parquet"))
        spread = int(self.spark.conf.get(SPREAD, "0"))
        return table.repartition(spread, LARGE_TABLES[name]) if spread and name in LARGE_TABLES else table


def with_views(sql: str) -> str:
    """DuckDB text of an oracle: the views it names in braces (and theirs) become leading CTEs."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in needs(text):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                ordered.append(name)

    visit(sql)
    body = re.sub(r"\{(\w+)\}", r"\1", sql).strip()
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS ({re.sub(r'\{(\w+)\}', r'\1', VIEWS[n]).strip()})" for n in ordered)
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{body[len('WITH RECURSIVE'):].strip()}"
    if body.upper().startswith("WITH"):
        return f"WITH {ctes},\n{body[len('WITH'):].strip()}"
    return f"WITH {ctes}\n{body}"


def formula_base(contig_index: Column, position: Column) -> Column:
    """Stand-in for a reference genome: the base at a position by formula."""
    place = (position * 7 + contig_index) % 4 + 1
    return F.substr(F.lit("ACGT"), place.cast("int"), F.lit(1))


# The same formula for DuckDB; ``{i}`` is the contig index and ``{p}`` the position.
FORMULA_BASE_SQL = "substr('ACGT', CAST(1 + ({p} * 7 + {i}) % 4 AS INT), 1)"
