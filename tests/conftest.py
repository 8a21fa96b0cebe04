from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from locusloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def contigs(spark):
    return spark.createDataFrame(
        [(0, "chr1", 2_500_000, False), (1, "chr2", 400_000, False), (2, "chrX", 900_000, True), (3, "chr3", 3_000_000, False)],
        "contig_index int, contig string, length bigint, ignored boolean",
    )
