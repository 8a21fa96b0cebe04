"""Default parameters.

Fixed values: results depend on them, so they are stated once, here.
"""

# Position buckets: key = contig_index * KEY_SCALE + pos div BUCKET_WIDTH.
BUCKET_WIDTH = 5_000
KEY_SCALE = 1_000_000_000_000

# Coordinate-sorted reads whose starts lie at most this far past the running end are one interval.
MERGE_GAP = 51

# Load-balancing bins are one megabase wide.
BIN_WIDTH = 1_000_000

# Copies are dropped only in (chunk, bucket) groups with more lines than this.
DEDUP_MIN_LINES = 500

# Highest base quality that still looks like Sanger encoding, and the shift of the older encoding.
SANGER_MAX_QUALITY = 60
ILLUMINA_SHIFT = 31

# ASCII offset of Phred strings in alignment text.
PHRED_OFFSET = 33

# SAM flag bits.
FLAG_UNMAPPED = 4
FLAG_REVERSE = 16
FLAG_FIRST_MATE = 64
FLAG_SECOND_MATE = 128
FLAG_NOT_PRIMARY = 256
FLAG_SUPPLEMENTARY = 2048
FLAG_DUPLICATE = 1024

# Read group written on every read.
READ_GROUP = "GROUP1"
LIBRARY = "LIB1"

# Base qualities below this do not count towards the duplicate score.
DUPLICATE_MIN_QUALITY = 15

# Recalibrated qualities are limited to this range.
RECAL_MIN_QUALITY = 1
RECAL_MAX_QUALITY = 60

# Per-base error used by the genotype likelihoods.
BASE_ERROR = 0.01
