"""Small builders and plain-Python counterparts used by several tests."""

from __future__ import annotations

READ_SCHEMA = (
    "qname string, flag int, rname string, pos bigint, mapq int, cigar string, rnext string, pnext bigint, "
    "tlen bigint, seq string, qual string, chunk bigint"
)


def read(qname, rname="chr1", pos=100, cigar="10M", flag=0, mapq=30, pnext=0, seq=None, qual=None, chunk=0):
    seq = seq if seq is not None else "ACGTACGTAC"
    qual = qual if qual is not None else "I" * len(seq)
    return (qname, flag, rname, pos, mapq, cigar, "=", pnext, 0, seq, qual, chunk)


def reads(spark, rows):
    return spark.createDataFrame(rows, READ_SCHEMA)


def rows(df, *columns):
    """Rows as sorted tuples; ``None`` sorts first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, v) for v in t))


def walk_regions(histogram, n_regions):
    """The reference rule, one bucket after the other."""
    target = sum(n for _, n in histogram) // n_regions
    count = region = 0
    out = []
    for key, n in sorted(histogram):
        count += n
        if count > target:
            count, region = n, region + 1
        out.append((key, n, region))
    return out


def merge_plain(spans, gap):
    """Merged (contig, start, end, n) by one pass in start order."""
    out = []
    for contig, start, end in sorted(spans):
        if out and out[-1][0] == contig and start <= out[-1][2] + gap:
            out[-1][2] = max(out[-1][2], end)
            out[-1][3] += 1
        else:
            out.append([contig, start, end, 1])
    return sorted(tuple(r) for r in out)
