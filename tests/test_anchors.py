"""Known numbers of the smallest data folder."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from locusloom.operators import histogram as H
from locusloom.operators import regions as R
from locusloom.plans import fixtures, read_queries
from locusloom.plans.fixtures import VIEWS, Inputs, needs

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def inp(spark):
    return Inputs(spark, FOLDER)


@pytest.mark.parametrize(
    ("view", "rows"),
    [("reads", 6000), ("sam_lines", 6125), ("reads_dup", 7160), ("targets", 200), ("known_sites", 1500),
     ("vcf_lines", 1682), ("fastq", 400)],
)
def test_view_sizes(inp, view, rows):
    assert inp[view].count() == rows


@pytest.mark.parametrize("view", sorted(fixtures.SINGLE_SCAN))
def test_single_scan_views_have_the_rows_of_their_sql(spark, inp, view):
    from_sql = spark.sql(VIEWS[view], **{n: inp[n] for n in needs(VIEWS[view])})
    assert inp[view].columns == from_sql.columns
    assert inp[view].exceptAll(from_sql).count() == 0
    assert from_sql.exceptAll(inp[view]).count() == 0


@pytest.mark.parametrize(
    ("n_regions", "target", "distinct", "largest", "id_sum"), [(16, 254, 17, 16, 2457), (128, 31, 169, 168, 26672)]
)
def test_balanced_regions(inp, n_regions, target, distinct, largest, id_sum):
    histogram = read_queries.stored_histogram(inp)
    assert H.region_target(histogram, n_regions).first().target == target
    got = R.balanced_regions(histogram, n_regions).agg(
        F.count_distinct("region"), F.max("region"), F.sum("region")
    ).first()
    assert tuple(got) == (distinct, largest, id_sum)


def test_bad_records(inp):
    from locusloom.operators import filters

    assert filters.bad_lines(inp["sam_lines"], inp["contigs"]).count() == 100
