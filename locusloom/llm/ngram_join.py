"""Similarity join on word shingles: a blocked sparse product of the document by shingle incidence matrix.

Two documents link when their sets' overlap is at least ``LIKE`` percent of the union. The product of the incidence
matrix with its transpose has the overlaps; it is computed only where a link is possible:

1. Equal sets become one row of the matrix (by a 128-bit signature of the set).
2. Columns are ordered from rare to frequent. In a set of n, at least m = ceil(LIKE * n / 100) columns take part in
   any link, so the first MEETINGS columns that two linked rows have in common are among the first
   n - m + MEETINGS of both (the prefix). In a column with few rows, all pairs whose sizes allow a link are counted; a
   pair that meets in fewer than MEETINGS columns is dropped. In a column with more rows, each row is tied
   to the next by size instead. Pairs and ties that are left make blocks, their connected components.
3. A block is cut into tiles of up to ``TILE`` rows by size. A pair of tiles is multiplied in one task if its sizes allow
   a link; overlaps are accumulated over bands of columns, and pairs are discarded whose overlap so far and columns
   left can't reach the bound that follows from both sizes. Links that join nothing new within a tile pair
   aren't returned, so a block of n like rows gives about n links for each tile it meets, not n * n.
4. A large block of near copies is first compared with one of its rows, the pivot. Rows that link with it need no
   comparison with one another; a row too far from the pivot (Jaccard distance is a metric) needs none with
   them. What is left is tiled.

The order of columns is a matter of speed only: any fixed one gives the same links. Occurrences are counted exactly for a
quarter of all columns, chosen by hash; the others by cells of hashes, and exactly within texts of fewer than ``SHORT`` words, which
need most of their columns for their prefix. Rare columns come first, those counted before the others; then frequent ones
by their counts. Tasks get two tables with a byte per cell of hashes, the level of the most frequent column in it, 20 MB at any
size of the corpus: every frequent column is known as one, and a rare one that shares its cell passes for frequent.
Prefixes hold 40 bits of each column, so two columns may pass for one there: that adds candidates and loses no link. Rows that
stand for no class, and texts of rows that are in no block, are told by a table of bits (``marks``) and aren't shuffled.

Defined cases: null or empty text, or one without words, has the empty set and is linked with nothing; a row with a null
``doc_id`` is no vertex: linked with nothing, its component is null; rows with equal ``doc_id`` are one vertex; an empty
table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored by ``join``, and kept by
``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import small_batches
from .components import components
from .marks import is_marked, mark_table
from .sorted_groups import list_offsets, long_lists
from .wordhash import hash_windows, hash_words, mix, slices

WIDTH, LIKE = 4, 85
MEETINGS = 6
# Columns with more rows than this tie their rows instead of pairing all; a matter of speed only.
PAIRED = 32
TILE = 512  # rows of a tile at most; fewer where they are long
TILE_KEYS = 500 * TILE
# Blocks with more rows than this are compared with a pivot first; a matter of speed only.
PIVOT_FROM = 4 * TILE
# Columns with a hash below this, a quarter of all, are counted: a prefix is about a sixth of a row.
COUNTED = np.uint64(1 << 62)
# Texts with fewer words than this count all their columns.
SHORT = 128
# Cells of the two tables of levels: of columns below ``COUNTED``, by their upper bits, and of the others.
LEVEL_BITS = (24, 22)
# Cells of a part of a table.
PART_BITS = 16
# Bytes of a column in a prefix, and the bits beside them that have the size of a row.
COLUMN_BYTES, SIZE_BITS = 5, 24
# A task reports a cell with so many columns more than its mean one.
STANDS_OUT = 6
SLACK = 1e-9


def least_overlap(n: np.ndarray, like: int) -> np.ndarray:
    """The smallest overlap of a set of n with any set that it links with."""
    return -(-like * n // 100)


def meetings(n: np.ndarray, like: int) -> np.ndarray:
    """In how many prefix columns a set of n meets every set that it links with, at least (MEETINGS where it is that large)."""
    return np.minimum(MEETINGS, least_overlap(n, like))


def shingle_sets(raw: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and how many each has; short texts are one shingle."""
    hashes, _, _, _, counts = hash_words(raw, lower=True)
    text = np.repeat(np.arange(len(raw)), counts)
    windows = hash_windows(hashes, width)
    inside = text[: len(windows)] == text[width - 1 : width - 1 + len(windows)]
    keys, owner = [windows[inside]], [text[: len(windows)][inside]]
    for n in range(1, width):  # texts of n words
        short = np.flatnonzero(counts == n)
        if len(short):
            starts = np.concatenate(([0], np.cumsum(counts)[:-1]))[short]
            keys.append(hash_windows(hashes, n)[starts])
            owner.append(short)
    key, own = np.concatenate(keys), np.concatenate(owner)
    order = np.lexsort((key, own))
    key, own = key[order], own[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
    return key[new], np.bincount(own[new], minlength=len(raw))


def _cells(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each column in either table; that in the first means nothing for columns from ``COUNTED`` on."""
    return (keys >> np.uint64(62 - LEVEL_BITS[0])) & np.uint64((1 << LEVEL_BITS[0]) - 1), keys >> np.uint64(64 - LEVEL_BITS[1])


def frequent_columns(docs: DataFrame, width: int) -> list[np.ndarray]:
    """The two tables of levels: 0 for cells without a frequent column, else eight levels for each doubling of the count.

    Columns are counted by the upper 40 bits of their hash. Cells are counted in each task, which reports those well above
    its mean one.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, total = np.zeros(1 << LEVEL_BITS[1], np.int32), 0
        for batch in batches:
            for _, raw in slices(batch.column("text").to_pylist()):
                hashes, _, _, _, counts = hash_words(raw, lower=True)
                windows = hash_windows(hashes, width)
                below = windows < COUNTED
                yield counted(0, *np.unique(windows[below] >> np.uint64(22), return_counts=True))
                short = np.repeat(counts < SHORT, counts)[: len(windows)]
                yield counted(2, *np.unique(windows[~below & short] >> np.uint64(24), return_counts=True))
                found = _cells(windows[~below])[1].astype(np.int64)
                cells += np.bincount(found, minlength=len(cells)).astype(np.int32)
                total += len(found)
        found = np.flatnonzero(cells >= total / len(cells) + STANDS_OUT)
        yield counted(1, found, cells[found])

    def counted(kind: int, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        # One number, as a fifth of all columns are dealt; kinds are 0: below ``COUNTED``, 1: cells, 2: of short texts.
        return pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64) | kind << 40), pa.array(n.astype(np.int64))], ["key", "n"])

    def part(group: pa.Table) -> pa.Table:
        levels = np.zeros(1 << PART_BITS, np.uint8)
        levels[group.column("cell").to_numpy() & (len(levels) - 1)] = group.column("level").to_numpy()
        return group.slice(0, 1).select(["table", "part"]).append_column("levels", pa.array([levels.tobytes()], pa.binary()))

    sums = docs.select("text").mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > PAIRED)
    kind, key = F.shiftright("key", 40), F.col("key").bitwiseAND(F.lit((1 << 40) - 1))
    cell = F.when(kind == 0, F.shiftright(key, 40 - LEVEL_BITS[0])).when(kind == 1, key).otherwise(F.shiftright(key, 40 - LEVEL_BITS[1]))
    level = F.least(F.lit(255), 1 + F.floor(8 * F.log2(F.col("n") / PAIRED))).cast("int")
    cells = sums.groupBy(F.when(kind == 0, 0).otherwise(1).alias("table"), cell.alias("cell")).agg(F.max(level).alias("level"))
    parts = cells.withColumn("part", F.shiftright("cell", PART_BITS)).groupBy("table", "part").applyInArrow(part, "table int, part bigint, levels binary")
    found = materialize(parts, "frequent").toArrow()
    out = [np.zeros(1 << bits, np.uint8) for bits in LEVEL_BITS]
    for table, k, levels in zip(found["table"].to_pylist(), found["part"].to_pylist(), found["levels"].to_pylist(), strict=True):
        out[table][k << PART_BITS : (k + 1) << PART_BITS] = np.frombuffer(levels, np.uint8)
    return out


def _rank(keys: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    """0 counted and rare, 1 rare as far as it is known, more: frequent."""
    first, second = _cells(keys)
    counted = tables[0][first].astype(np.int64)
    return np.where(keys < COUNTED, counted + (counted > 0), 1 + tables[1][second].astype(np.int64))


def _packed(columns: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The lower bits of so many columns a row, ``COLUMN_BYTES`` each, as a binary value."""
    raw = columns.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :COLUMN_BYTES].tobytes()
    ends = np.concatenate(([0], np.cumsum(counts))) * COLUMN_BYTES
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(raw)])


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Columns end to end, and how many each row has."""
    rows = column.to_pylist()
    raw = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, COLUMN_BYTES)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :COLUMN_BYTES] = raw
    return out.view("<i8").ravel(), np.array([len(r) // COLUMN_BYTES for r in rows], np.int64)


def prefixes(docs: DataFrame, width: int, like: int) -> DataFrame:
    """Per row: ``doc``, set size ``n``, signature (``s1``, ``s2``) and ``prefix``, its rarest columns."""
    known = docs.sparkSession.sparkContext.broadcast(frequent_columns(docs, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = known.value
        for batch in batches:
            docs = batch.column("doc")
            for first, raw in slices(batch.column("text").to_pylist()):
                keys, n = shingle_sets(raw, width)
                own = np.repeat(np.arange(len(raw)), n)
                begin = np.concatenate(([0], np.cumsum(n)[:-1]))
                full = n > 0
                s1, s2 = np.zeros(len(raw), np.uint64), np.zeros(len(raw), np.uint64)
                if len(keys):
                    s1[full] = np.add.reduceat(mix(keys + np.uint64(1)), begin[full])
                    s2[full] = np.add.reduceat(mix(keys ^ np.uint64(0x5851F42D4C957F2D)), begin[full])
                order = np.lexsort((keys, _rank(keys, tables), own))
                length = np.where(full, n - least_overlap(n, like) + meetings(n, like), 0)
                place = np.arange(len(keys)) - np.repeat(begin, n)
                prefix = _packed(keys[order][place < np.repeat(length, n)], length)
                yield pa.RecordBatch.from_arrays(
                    [docs.slice(first, len(raw)), pa.array(n.astype(np.int64)), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), prefix], ["doc", "n", "s1", "s2", "prefix"]
                )

    return docs.mapInArrow(run, "doc bigint, n bigint, s1 bigint, s2 bigint, prefix binary")


def _size_class(n: np.ndarray, like: int) -> np.ndarray:
    """Sizes that allow a link lie at most ``CLASSES_APART`` classes apart."""
    return np.floor(np.log(np.maximum(n, 1)) / (np.log(100 / like) / (CLASSES_APART - 1))).astype(np.int64)


def _columns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefix entries by column and size; rows of a batch that agree in both become one row."""
    for batch in batches:
        keys, counts = _unpacked(batch.column("prefix"))
        doc, size = np.repeat(batch.column("doc").to_numpy(), counts), np.repeat(batch.column("n").to_numpy(), counts)
        order = np.lexsort((doc, size, keys))
        keys, size, doc = keys[order], size[order], doc[order]
        head = np.ones(len(keys), bool)
        head[1:] = (keys[1:] != keys[:-1]) | (size[1:] != size[:-1])
        more = np.diff(np.append(np.flatnonzero(head), len(keys))) - 1
        # One number of column and size, since all rows are dealt. A size too large for its bits allows more pairs, not fewer.
        at = keys[head] << SIZE_BITS | np.minimum(size[head], (1 << SIZE_BITS) - 1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(doc[head]), long_lists(doc[~head], more, more == 0)], ["at", "doc", "doc_more"])


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Column and size as columns of their own."""
    for batch in batches:
        at = batch.column("at").to_numpy()
        arrays = [pa.array(at >> SIZE_BITS), pa.array(at & ((1 << SIZE_BITS) - 1)), batch.column("doc"), batch.column("doc_more")]
        yield pa.RecordBatch.from_arrays(arrays, ["column", "n", "doc", "doc_more"])


def _pairs(like: int):
    """Pairs of rows (a, b) that meet in columns of a partition, sorted by column and size: in how many, of how many asked.

    Kept between batches: the rows of the open column, or, once these are many, the last of them.
    """

    def paired(n: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
        i, j = np.triu_indices(len(n), 1)
        return [doc[i], doc[j], n[i], n[j], np.ones(len(i), np.int64)]

    def tied(n: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
        return [doc[:-1], doc[1:], n[:-1], n[1:], np.full(len(n) - 1, MEETINGS, np.int64)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column, n, doc, many = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), False
        for batch in _with_end(batches):
            if batch is not None:
                more, n_more = list_offsets(batch.column("doc_more"))
                first = [batch.column(c).to_numpy() for c in ("column", "n", "doc")]
                rows = [np.repeat(x, n_more + 1) for x in first]
                if len(more):
                    head = np.zeros(len(rows[2]), bool)
                    head[np.concatenate(([0], np.cumsum(n_more + 1)[:-1]))] = True
                    rows[2] = rows[2].copy()
                    rows[2][~head] = more
                column, n, doc = (np.concatenate(x) for x in zip((column, n, doc), rows, strict=True))
            if len(column) == 0:
                continue
            begin = np.flatnonzero(np.concatenate(([True], column[1:] != column[:-1])))
            end = np.append(begin[1:], len(column))
            # The last column may go on in the next batch.
            closed = len(begin) if batch is None else len(begin) - 1
            out = []
            sizes = end - begin
            two = begin[:closed][sizes[:closed] == 2]
            two = two[1:] if many and len(two) and two[0] == 0 else two
            out.append([doc[two], doc[two + 1], n[two], n[two + 1], np.ones(len(two), np.int64)])
            for k in np.flatnonzero((sizes[:closed] > 2) | ((np.arange(closed) == 0) & many)).tolist():
                part = slice(begin[k], end[k])
                out.append((tied if sizes[k] > PAIRED or (many and k == 0) else paired)(n[part], doc[part]))
            if closed:
                many = False
            if closed < len(begin):
                part = slice(begin[-1], None)
                column, n, doc = column[part], n[part], doc[part]
                if len(column) > PAIRED:
                    out.append(tied(n, doc))
                    column, n, doc, many = column[-1:], n[-1:], doc[-1:], True
            else:
                column, n, doc = column[:0], n[:0], doc[:0]
            a, b, n_a, n_b, met = (np.concatenate(x) for x in zip(*out, strict=True))
            able = (100 * n_a >= like * n_b) & (100 * n_b >= like * n_a) & (a != b)
            a, b, met = a[able], b[able], met[able]
            asked = np.minimum(meetings(n_a, like), meetings(n_b, like))[able]
            arrays = [pa.array(x) for x in (np.maximum(a, b), np.minimum(a, b), met, asked)]
            yield pa.RecordBatch.from_arrays(arrays, ["a", "b", "met", "asked"])

    return run


def _with_end(batches: Iterator) -> Iterator:
    """The batches, and None after the last."""
    yield from (b for b in batches if b.num_rows)
    yield None


def _sets(width: int):
    """Set of each row with the places it is asked for: a row per place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_now, seen = None, set()  # rows come sorted by doc; equal rows are one
        for batch in batches:
            docs, sizes, places = batch.column("doc").to_pylist(), batch.column("n").to_pylist(), batch.column("places").to_pylist()
            for first, raw in slices(batch.column("text").to_pylist()):
                keys, n = shingle_sets(raw, width)
                ends = np.concatenate(([0], np.cumsum(n)))
                rows: list[tuple] = []
                parts, counts = [], []
                for i in range(len(raw)):
                    doc = docs[first + i]
                    if doc != doc_now:
                        doc_now, seen = doc, set()
                    mine = keys[ends[i] : ends[i + 1]]
                    mark = (len(mine), int(mine.sum()) if len(mine) else 0)
                    if n[i] != sizes[first + i] or mark in seen:
                        continue
                    seen.add(mark)
                    for p in places[first + i]:
                        rows.append((p["block"], p["tile"], p["tile_2"], p["side"], doc))
                        parts.append(mine)
                        counts.append(len(mine))
                columns = list(zip(*rows, strict=True)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                lists = long_lists(np.concatenate(parts).view(np.int64) if parts else np.zeros(0), np.array(counts, np.int64), np.zeros(len(counts), bool))
                yield pa.RecordBatch.from_arrays([*[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], lists], ["block", "tile", "tile_2", "side", "doc", "keys"])

    return run


PLACE = "array<struct<block:bigint,tile:bigint,tile_2:bigint,side:int>>"


def _placed_sets(texts: DataFrame, places: DataFrame, width: int) -> DataFrame:
    """Sets of the rows (doc, n) of ``places`` at each of their places. Only texts that can be asked for are shuffled."""
    texts = texts.where(is_marked(mark_table(places.select("doc")), "doc"))
    asked = places.groupBy("doc", "n").agg(F.collect_list(F.struct("block", "tile", "tile_2", "side")).cast(PLACE).alias("places"))
    rows = texts.join(asked.hint("merge"), "doc").select("doc", "text", "n", "places")
    return rows.mapInArrow(_sets(width), "block bigint, tile bigint, tile_2 bigint, side int, doc bigint, keys array<bigint>")


def _links(n: np.ndarray, m: np.ndarray, overlap: np.ndarray, like: int) -> np.ndarray:
    return 100 * overlap >= like * (n + m - overlap)


def multiply(left: list[np.ndarray], right: list[np.ndarray], like: int, band: int = 4096) -> np.ndarray:
    """Overlaps of the rows of two tiles; 0 where a link is out of reach.

    Columns that both tiles have (or, of a tile with itself, two rows) are taken in bands; a band is a small dense
    block of each tile. Pairs that can't reach the overlap asked by their sizes are dropped before each
    band; when none is left, so are further bands.
    """
    n, m = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    keys = [np.concatenate(left), np.concatenate(right)]
    if left is right:
        found, count = np.unique(keys[0], return_counts=True)
        both = found[count > 1]
    else:
        both = np.intersect1d(*keys)
    need = -(-like * (n[:, None] + m[None, :]) // (100 + like))
    total = np.zeros((len(left), len(right)), np.float32)
    alive = (100 * n[:, None] >= like * m[None, :]) & (100 * m[None, :] >= like * n[:, None])
    if len(both) == 0:
        return np.zeros(total.shape, np.int64)
    sides = []
    for all_keys, sizes in zip(keys, (n, m), strict=True):
        column = np.minimum(np.searchsorted(both, all_keys), len(both) - 1)
        mine = both[column] == all_keys
        row, column = np.repeat(np.arange(len(sizes)), sizes)[mine], column[mine]
        order = np.argsort(column, kind="stable")
        sides.append((row[order], column[order], np.bincount(row, minlength=len(sizes))))
    (row_a, col_a, rest_a), (row_b, col_b, rest_b) = sides
    for start in range(0, len(both), band):
        alive &= total + np.minimum(rest_a[:, None], rest_b[None, :]) >= need
        if not alive.any():
            break
        blocks = []
        for row, col, rest in ((row_a, col_a, rest_a), (row_b, col_b, rest_b)):
            part = slice(np.searchsorted(col, start), np.searchsorted(col, start + band))
            block = np.zeros((len(rest), min(band, len(both) - start)), np.float32)
            block[row[part], col[part] - start] = 1
            rest -= np.bincount(row[part], minlength=len(rest))
            blocks.append(block)
        total += blocks[0] @ blocks[1].T
    return np.where(alive, total, 0).astype(np.int64)


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the links join something that earlier ones didn't."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    keep = np.zeros(len(a), bool)
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = root(x), root(y)
        if x != y:
            parent[x] = y
            keep[k] = True
    return keep


def _tile_links(like: int):
    """Links of a tile pair: rows of one tile (``side`` 0) and another, or of one tile with itself (no side 1)."""

    def run(group: pa.Table) -> pa.Table:
        keys, counts = list_offsets(group.column("keys"))
        ends = np.concatenate(([0], np.cumsum(counts)))
        sets = [keys[a:b].view(np.uint64) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        docs, side = group.column("doc").to_numpy(), group.column("side").to_numpy()
        first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        left = [sets[i] for i in first]
        right = [sets[i] for i in second] if len(second) else left
        second = second if len(second) else first
        overlap = multiply(left, right, like)
        hit = _links(counts[first][:, None], counts[second][None, :], overlap, like) & (docs[first][:, None] != docs[second][None, :])
        i, j = np.nonzero(hit)
        a, b = docs[first][i], docs[second][j]
        keep = spanning(a, b)
        return pa.table({"a": pa.array(a[keep], pa.int64()), "b": pa.array(b[keep], pa.int64())})

    return run


def _near_pivot(texts: DataFrame, large: DataFrame, width: int, like: int) -> DataFrame:
    """Rows (doc, n, block) of large blocks with ``pivot``, ``linked`` and ``distance``, their Jaccard distance from it.

    The pivot is the block's row with the smallest doc. Its set is joined to each member's.
    """
    spot = [F.lit(0).cast("long").alias("tile"), F.lit(0).cast("long").alias("tile_2"), F.lit(0).alias("side")]
    first = materialize(large.groupBy("block").agg(F.min(F.struct("doc", "n")).alias("p")).select("block", "p.doc", "p.n"), "pivots")
    pivots = materialize(_placed_sets(texts, first.select("doc", "n", "block", *spot), width).select("block", F.col("doc").alias("pivot"), F.col("keys").alias("pivot_keys")), "pivot-sets")
    members = _placed_sets(texts, large.select("doc", "n", "block", *spot), width).select("block", "doc", "keys")
    n, m, common = F.size("keys").cast("long"), F.size("pivot_keys").cast("long"), F.size(F.array_intersect("keys", "pivot_keys"))
    measured = members.join(pivots, "block").select("doc", n.alias("n"), "block", "pivot", common.alias("o"), m.alias("m"))
    union = F.col("n") + F.col("m") - F.col("o")
    return measured.select("doc", "n", "block", "pivot", (1 - F.col("o") / union).alias("distance"), (100 * F.col("o") >= like * union).alias("linked"))


def _tile_places(rows: DataFrame, like: int) -> DataFrame:
    """Places (block, tile, tile_2, side) of rows (doc, n, block): in each pair of tiles whose sizes allow a link."""
    w = Window.partitionBy("block").orderBy("n", "doc").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.greatest("n", F.lit(TILE_KEYS // TILE))).over(w), F.lit(0))
    tiles = materialize(rows.withColumn("tile", F.floor(before / TILE_KEYS).cast("long")), "tiled")
    span = tiles.groupBy("block", "tile").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    other = span.select("block", F.col("tile").alias("tile_2"), F.col("lo").alias("lo_2"))
    pairs = span.join(other, "block").where((F.col("tile") <= F.col("tile_2")) & (100 * F.col("hi") >= like * F.col("lo_2")))
    pairs = materialize(pairs.select("block", "tile", "tile_2"), "tile-pairs")
    first = tiles.join(pairs, ["block", "tile"]).withColumn("side", F.lit(0))
    second = tiles.withColumnRenamed("tile", "tile_2").join(pairs.where("tile != tile_2"), ["block", "tile_2"]).withColumn("side", F.lit(1))
    return first.unionByName(second)


def block_links(texts: DataFrame, rows: DataFrame, width: int, like: int) -> DataFrame:
    """Links (a, b) that connect all rows (doc, n, block) of a block that are connected by any."""
    sizes = materialize(rows.groupBy("block").agg(F.count("*").alias("_n")).where(F.col("_n") > PIVOT_FROM), "large-blocks")
    links = []
    if not sizes.isEmpty():
        limit = (100 - like) / 100
        measured = materialize(_near_pivot(texts, rows.join(sizes, "block"), width, like), "near-pivot")
        links.append(measured.where("linked and doc != pivot").select(F.col("doc").alias("a"), F.col("pivot").alias("b")))
        # Near rows are needed again only by rows that don't link with the pivot, but are close enough to one that does.
        mid = measured.where(~F.col("linked") & (F.col("distance") <= 2 * limit + SLACK))
        reach = mid.groupBy("block").agg((F.min("distance") - limit - SLACK).alias("_from"))
        asked = measured.where("linked").join(reach, "block").where(F.col("distance") >= F.col("_from"))
        rest = measured.where(~F.col("linked"))
        small = rows.join(sizes, "block", "left_anti")
        rows = reduce(DataFrame.unionByName, [x.select("doc", "n", "block") for x in (small, rest, asked)])
    placed = _placed_sets(texts, _tile_places(rows, like), width)
    links.append(placed.groupBy("block", "tile", "tile_2").applyInArrow(_tile_links(like), "a bigint, b bigint"))
    return reduce(DataFrame.unionByName, links)


def join(docs: DataFrame, width: int = WIDTH, like: int = LIKE) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` per document."""
    small_batches(docs.sparkSession)
    own = docs.select(F.col("doc_id").cast("long").alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    rows = materialize(prefixes(own, width, like), "prefixes")
    vertices = rows.where("n > 0 and doc is not null")
    classes = materialize(vertices.groupBy("s1", "s2").agg(F.min("doc").alias("doc"), F.first("n").alias("n")), "classes")
    # A row stands for its class; a doc with rows of several classes ties these.
    # Some others may pass, which adds candidates among equal sets: only rows that stand for a class become members of a block.
    stands = is_marked(mark_table(classes.select("doc", "s1", "s2")), "doc", "s1", "s2")
    first = rows.where("n > 0 and doc is not null").where(stands).select("doc", "n", "prefix")
    columns = first.mapInArrow(_columns, "at bigint, doc bigint, doc_more array<bigint>")
    sorted_columns = columns.repartition(F.shiftright("at", SIZE_BITS)).sortWithinPartitions("at", "doc")
    met = sorted_columns.mapInArrow(lambda batches: _pairs(like)(_opened(batches)), "a bigint, b bigint, met bigint, asked bigint")
    pairs = met.groupBy("a", "b").agg(F.sum("met").alias("met"), F.min("asked").alias("asked")).where("met >= asked").select("a", "b")
    blocks = components(pairs).select(F.col("node").alias("doc"), F.col("component").alias("block"))
    members = materialize(blocks.join(classes.select("doc", "n"), "doc"), "blocks")
    several = vertices.groupBy("doc").agg(F.min(F.struct("s1", "s2")).alias("x"), F.max(F.struct("s1", "s2")).alias("y")).where("x != y").select("doc")
    tied = vertices.join(several, "doc").select("doc", "s1", "s2").join(classes.select("s1", "s2", F.col("doc").alias("_class")), ["s1", "s2"]).select(F.col("doc").alias("a"), F.col("_class").alias("b"))
    groups = materialize(components(block_links(own, members, width, like).unionByName(tied)), "components")
    # Members of a class: their class's first doc, then that one's component.
    of_class = classes.join(groups.withColumnRenamed("node", "doc"), "doc", "left").select("s1", "s2", F.coalesce("component", "doc").alias("_component"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = rows.select("doc", "n", "s1", "s2").join(of_class, ["s1", "s2"], "left")
    component = F.when(F.col("doc").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("doc")).otherwise(F.col("_component"))
    return named.select(F.col("doc").cast(kind).alias("doc_id"), F.col("n").alias("n_shingles"), component.cast(kind).alias("component_id"))


def keep_one(docs: DataFrame, width: int = WIDTH, like: int = LIKE) -> DataFrame:
    """``docs`` with one document of each component, that with the smallest id; rows with a null id all stay.

    Here rows with one id are documents of their own if their texts differ: each stays unless it is linked with an earlier one,
    by id, then by text. Rows with equal id and text are one; of these the one whose other columns come first in order stays.
    """
    known = docs.where(F.col("doc_id").isNotNull())
    text = F.sha2(F.coalesce("text", F.lit("")), 256)
    repeated = known.select("doc_id", text.alias("_sha")).groupBy("doc_id").agg((F.min("_sha") != F.max("_sha")).alias("_several"), F.count(F.lit(1)).alias("_n"))
    repeated = materialize(repeated.where("_n > 1").select("doc_id", "_several"), "repeated-ids")
    several = repeated.where("_several").select("doc_id")
    once = repeated.where("not _several").select("doc_id")
    if several.isEmpty():
        ids = materialize(join(known, width, like).select("doc_id", (F.col("doc_id") == F.col("component_id")).alias("_stays")).distinct(), "kept-ids")
        stay, gone = ids.where("_stays").select("doc_id"), ids.where("not _stays").select("doc_id")
        return _first_rows(known, stay, gone.unionByName(once), docs.columns).unionByName(docs.where(F.col("doc_id").isNull()))
    # Documents of a repeated id get ids below all others, and their own id back where it is asked which comes first.
    kind = docs.schema["doc_id"].dataType
    low = known.agg(F.min(F.col("doc_id").cast("long")).alias("_low"))  # one row
    apart = known.join(several, "doc_id", "left_semi")
    named = apart.select("doc_id", text.alias("_sha")).distinct().withColumn("_n", F.monotonically_increasing_id())
    named = materialize(named.crossJoin(F.broadcast(low)).select("doc_id", "_sha", (F.col("_low") - 1 - F.col("_n")).alias("_vertex")), "named-texts")
    apart = apart.withColumn("_sha", text).join(named, ["doc_id", "_sha"])
    alone = known.join(several, "doc_id", "left_anti")
    vertices = alone.select(F.col("doc_id").cast("long").alias("doc_id"), "text").unionByName(apart.select(F.col("_vertex").alias("doc_id"), "text"))
    components = materialize(join(vertices, width, like).select(F.col("doc_id").alias("_vertex"), "component_id").distinct(), "named-components")
    placed = components.join(named.select("_vertex", F.col("doc_id").cast("long").alias("_id"), "_sha"), "_vertex", "left")
    order = F.struct(F.coalesce("_id", "_vertex").alias("id"), F.coalesce("_sha", F.lit("")).alias("sha"), F.col("_vertex").alias("vertex"))
    stay = materialize(placed.groupBy("component_id").agg(F.min(order)["vertex"].alias("_vertex")).select("_vertex"), "kept-ids")
    gone = components.select("_vertex").join(stay.hint("merge"), "_vertex", "left_anti")
    own_id = F.col("_vertex").cast(kind).alias("doc_id")
    kept = _first_rows(alone, stay.select(own_id), gone.select(own_id).unionByName(once), docs.columns)
    kept_apart = _least_rows(apart.drop("_sha"), stay, docs.columns, "_vertex")
    return kept.unionByName(kept_apart).unionByName(docs.where(F.col("doc_id").isNull()))


def _first_rows(docs: DataFrame, stay: DataFrame, doubtful: DataFrame, columns: list[str]) -> DataFrame:
    """Of the rows of each id that stays, the first in the order of its columns.

    ``doubtful`` has all ids that don't stay or that several rows have. Rows whose id isn't marked as one of them stay as they
    lie; only the others are shuffled.
    """
    marked = is_marked(mark_table(doubtful), "doc_id")
    return docs.where(~marked).select(*columns).unionByName(_least_rows(docs.where(marked), stay.where(marked), columns, "doc_id"))


def _least_rows(docs: DataFrame, stay: DataFrame, columns: list[str], key: str) -> DataFrame:
    """Of the rows of each key that stays, the first in the order of its columns (those that can be ordered)."""
    ordered = [c for c, kind in docs.select(*columns).dtypes if "map<" not in kind and kind != "variant"]
    rest = [c for c in columns if c not in ordered]
    own = docs.join(stay.hint("merge"), key, "left_semi")
    row = F.struct(*ordered, *rest)
    least = F.min(F.struct(*ordered)) if not rest else F.min_by(row, F.struct(*ordered))
    return own.groupBy(F.col(key).alias("_key")).agg(least.alias("_row")).select("_row.*").select(*columns)
