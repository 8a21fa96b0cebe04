"""Base qualities held as Phred strings."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    DUPLICATE_MIN_QUALITY,
    ILLUMINA_SHIFT,
    PHRED_OFFSET,
    SANGER_MAX_QUALITY,
)

# ``_scores`` travels to executors whole, so those need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def qualities(qual: Column) -> Column:
    """ARRAY<INT> of base qualities."""
    return F.transform(F.split(qual, ""), lambda c: F.ascii(c) - F.lit(PHRED_OFFSET))


def max_quality(qual: Column) -> Column:
    return F.array_max(qualities(qual))


def quality_encoding(qual: Column) -> Column:
    """``SANGER`` or ``ILLUMINA``, guessed from the largest base quality of the read."""
    return F.when(max_quality(qual) <= SANGER_MAX_QUALITY, F.lit("SANGER")).otherwise(F.lit("ILLUMINA"))


def shifted_qualities(qual: Column) -> Column:
    """Qualities after taking off the shift of the older encoding; values can be negative."""
    return F.transform(qualities(qual), lambda q: q - F.lit(ILLUMINA_SHIFT))


def first_negative(quals: Column) -> Column:
    """First negative quality, null when there is none: a read with one cannot be converted."""
    return F.get(F.filter(quals, lambda q: q < 0), F.lit(0))


def _scores(qual: pa.Array) -> pa.Array:
    known = pc.fill_null(qual, "").cast(pa.large_string())
    ends = np.frombuffer(known.buffers()[1], np.int64)[known.offset : known.offset + len(known) + 1]
    letters = np.frombuffer(known.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    if len(letters) and letters.max() > 127:  # several bytes a letter
        letters = np.frombuffer("".join(known.to_pylist()).encode("utf-32-le"), np.uint32)
        ends = np.append(0, np.cumsum(pc.utf8_length(known).to_numpy()))
    counted = letters.astype(np.int64) - PHRED_OFFSET
    counted[counted < DUPLICATE_MIN_QUALITY] = 0
    upto = np.append(0, np.cumsum(counted))
    return pa.array(np.diff(upto[ends - ends[0]]), pa.int64(), mask=qual.is_null().to_numpy(zero_copy_only=False))


def duplicate_score(qual: Column) -> Column:
    """Sum of the qualities that count when the best read of a duplicate group is chosen.

    (Added up over the letters of a batch of reads, as they lie in its buffer; a lambda over the letters of each costs several times as much.)
    """
    return F.arrow_udf(_scores, "bigint")(qual)
