"""Sharding: minimax contiguous partition of the corpus into shards of near-equal bytes.

Groups of equal texts are atomic. They are ordered by the hash of their text and first cut into 2**ATOM_BITS ranges
of that order, the leaves. A leaf with more bytes than an even share gets a shard of its own, once it is a single group (no cut can do better). The others, in
order, are cut by minimax: a binary search over the shard capacity, each step a greedy filling of shards up to it, finds the
smallest capacity that works. The cuts are made within it, as evenly as it allows.

A leaf is a stretch of groups, and a cut may be needed inside of one. So the leaves where a cut falls, or where the greedy filling stops with one byte less
capacity, are split by the next bits of the hash, and the search is done again, until all of these are single groups. Then no capacity that is a byte
smaller works for the groups themselves. Each pass splits a few leaves for each shard, LEAVES parts in all at most, so what the driver sees is bounded by parameters (and the number of
shards), whatever the number of groups.

Slots count up from 0 in each shard. A stretch of a shard is numbered in cells of at most about the mean number of rows, split
by a hash of the id, so a group of copies with a third of all rows is spread over many tasks.

Defined results: a null text counts as an empty one; equal ids or rows are rows of their own; ties in a cell are
broken by text hash and id; an empty table gives an empty result, and there may be empty shards when
there are fewer groups than shards, or very uneven ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, spare, with_columns, written

#: Bytes that a row takes besides its text.
ROW_BYTES = 8
#: Hash ranges that the driver sees at first: this many sums and counts, whatever the data.
ATOM_BITS = 16
#: Parts into which the leaves of one pass are split, together (two for each leaf at least).
LEAVES = 1 << 20
_U = np.uint64


def fits(ends: np.ndarray, capacity: int, shards: int) -> bool:
    """Whether shards that are filled one by one up to ``capacity`` hold all; ``ends``: running sums of the sizes."""
    at = before = 0
    for _ in range(shards):
        at = int(np.searchsorted(ends, before + capacity, side="right"))
        before = int(ends[at - 1]) if at else 0
    return at == len(ends)


def cuts_within(ends: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Where the shards end (as indexes after their last) within a feasible ``capacity``: each cut as near as possible to an even share
    of what is left, such that what comes after it still fits."""
    before = np.concatenate(([0], ends))
    starts = [len(ends)]  # the first index from which the last 0, 1, 2, ... shards hold all the rest
    for _ in range(shards - 1):
        starts.append(int(np.searchsorted(before, before[starts[-1]] - capacity, side="left")))
    cuts, at = [], 0
    for left in range(shards, 0, -1):
        high = int(np.searchsorted(ends, before[at] + capacity, side="right"))
        even = before[at] + (int(ends[-1]) - before[at]) / left
        nearest = int(np.searchsorted(before, even))
        if nearest and even - before[nearest - 1] < before[min(nearest, len(ends))] - even:
            nearest -= 1
        at = min(max(nearest, starts[left - 1], at), high)
        cuts.append(at)
    return cuts


def minimax_cuts(sizes: np.ndarray, shards: int) -> tuple[int, list[int]]:
    """Smallest capacity with which ``sizes``, in order, go into ``shards`` contiguous shards, and the shards' ends."""
    ends = np.cumsum(sizes)
    if not len(sizes):
        return 0, [0] * shards
    low, high = max(int(sizes.max()), -(-int(ends[-1]) // shards)), int(ends[-1])
    while low < high:
        middle = (low + high) // 2
        if fits(ends, middle, shards):
            high = middle
        else:
            low = middle + 1
    return low, cuts_within(ends, low, shards)


def heavy_leaves(sizes: np.ndarray, shards: int) -> list[int]:
    """Leaves that get a shard of their own: over an even share of what larger ones leave."""
    found, left = [], int(sizes.sum())
    for i in np.argsort(-sizes, kind="stable"):
        if shards - len(found) <= 1 or int(sizes[i]) * (shards - len(found)) <= left:
            break
        found.append(int(i))
        left -= int(sizes[i])
    return found


def place_leaves(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each leaf: own shards for heavy ones, minimax for the others."""
    heavy = heavy_leaves(sizes, shards)
    shard, rest = np.zeros(len(sizes), dtype=np.int64), np.ones(len(sizes), dtype=bool)
    shard[heavy], rest[heavy] = np.arange(len(heavy)), False
    _, ends = minimax_cuts(sizes[rest], shards - len(heavy))
    shard[rest] = len(heavy) + np.searchsorted(np.asarray(ends), np.arange(int(rest.sum())), side="right")
    return shard


def decisive(sizes: np.ndarray, shards: int) -> np.ndarray:
    """Leaves that may decide the capacity: heavy ones, those at the cuts, and those where a filling with a byte less capacity stops."""
    heavy = heavy_leaves(sizes, shards)
    rest = np.delete(np.arange(len(sizes)), heavy)
    ends, left = np.cumsum(sizes[rest]), shards - len(heavy)
    capacity, cuts = minimax_cuts(sizes[rest], left)
    stops, before = [], 0
    for _ in range(left):
        at = int(np.searchsorted(ends, before + capacity - 1, side="right"))
        stops.append(at)
        before = int(ends[at - 1]) if at else 0
        if at >= len(rest):
            break
    at = np.unique(np.clip(np.concatenate((cuts, np.asarray(cuts) - 1, stops)).astype(np.int64), 0, max(0, len(rest) - 1)))
    return np.unique(np.concatenate((np.asarray(heavy, dtype=np.int64), rest[at] if len(rest) else rest)))


class Leaves:
    """Ranges of the (unsigned) hash order: where each begins, its bytes and rows, how many leading bits tell it, and whether it is one group."""

    def __init__(self, start: np.ndarray, size: np.ndarray, rows: np.ndarray, single: np.ndarray, bits: np.ndarray):
        order = np.argsort(start, kind="stable")
        self.start, self.size, self.rows, self.single, self.bits = (x[order] for x in (start, size, rows, single, bits))

    def replaced(self, gone: np.ndarray, by: list[Leaves]) -> Leaves:
        """Without those at the places ``gone``, and with those of ``by``."""
        return Leaves(*[np.concatenate((np.delete(getattr(self, n), gone), *[getattr(x, n) for x in by])) for n in ("start", "size", "rows", "single", "bits")])


def prefix(bits: int):
    """The first ``bits`` of a hash column, as a hash of which all others are 0."""
    return F.shiftleft(F.shiftrightunsigned(F.col("key"), 64 - bits), 64 - bits) if bits < 64 else F.col("key")


def summed(keys: DataFrame, bits: int) -> Leaves:
    """Leaves of the first ``bits`` among ``keys`` (key, size), a row for each of at most 2**bits that occur."""
    sums = keys.groupBy(prefix(bits).alias("start")).agg(F.sum("size"), F.count(F.lit(1)), (F.min("key") == F.max("key")).cast("int"))
    found = np.array(sums.collect(), dtype=np.int64).reshape(-1, 4)
    return Leaves(found[:, 0].view(_U), found[:, 1], found[:, 2], found[:, 3].astype(bool), np.full(len(found), bits))


def range_of(starts: np.ndarray, values: np.ndarray):
    """A column function: the value of the range (of those that begin at ``starts``) that a hash is in."""
    @F.arrow_udf("bigint")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(values[np.searchsorted(starts, batch.to_numpy(zero_copy_only=False).view(_U), side="right") - 1])

    return find


def find_leaves(keys: DataFrame, shards: int) -> Leaves:
    """Leaves that are fine enough: all that may decide the capacity are single groups."""
    leaves = summed(keys, ATOM_BITS)
    while len(leaves.size):
        coarse = decisive(leaves.size, shards)
        coarse = coarse[~leaves.single[coarse]]
        if not len(coarse):
            break
        wanted = np.full(len(leaves.size), -1)
        wanted[coarse] = leaves.bits[coarse]
        more = max(1, (LEAVES // len(coarse)).bit_length() - 1)
        parts = keys.withColumn("bits", range_of(leaves.start, wanted.astype(np.int64))("key")).where("bits >= 0")
        leaves = leaves.replaced(coarse, [summed(parts.where(F.col("bits") == int(b)), min(64, int(b) + more)) for b in np.unique(leaves.bits[coarse])])
    return leaves


class Cells:
    """Stretches of leaves of one shard, each numbered in one or more cells."""

    def __init__(self, leaves: Leaves, placed: np.ndarray):
        rows = max(1, -(-int(leaves.rows.sum()) // 2 ** ATOM_BITS))  # of a cell, about
        before = np.cumsum(leaves.rows) - leaves.rows
        new = np.ones(len(placed), dtype=bool)
        new[1:] = (placed[1:] != placed[:-1]) | (before[1:] // rows != before[:-1] // rows) | (leaves.rows[1:] > rows) | (leaves.rows[:-1] > rows)
        first = np.flatnonzero(new)
        self.start, self.shard = leaves.start[first], placed[first]
        held = np.add.reduceat(leaves.rows, first) if len(first) else leaves.rows
        self.parts = -(-held // rows)
        self.first = np.cumsum(self.parts) - self.parts  # number of a stretch's first cell

    def cell(self):
        """A column function (hash of the text, hash of the id) -> number of the cell."""
        start, first, parts = self.start, self.first, self.parts.astype(_U)

        @F.arrow_udf("bigint")
        def find(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for keys, salts in batches:
                at = np.searchsorted(start, keys.to_numpy(zero_copy_only=False).view(_U), side="right") - 1
                yield pa.array(first[at] + (salts.to_numpy(zero_copy_only=False).view(_U) % parts[at]).astype(np.int64))

        return find

    def places(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shard of each cell, and the slot of its first row, from the cells' numbers of rows."""
        shard = np.repeat(self.shard, self.parts)
        order = np.argsort(shard, kind="stable")
        before = np.cumsum(counts[order]) - counts[order]
        at = before - before[np.searchsorted(shard[order], shard[order], side="left")] if len(order) else before
        first = np.zeros(len(shard), dtype=np.int64)
        first[order] = at
        return shard, first


def value_at(values: np.ndarray):
    """A column function: the value at a number."""
    @F.arrow_udf("bigint")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(values[batch.to_numpy(zero_copy_only=False)])

    return find


def assign_shards(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``size`` (bytes), ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` (null under this law)."""
    ship(docs.sparkSession)
    names = {k: spare(docs, f"shard_{k}") for k in ("size", "crc", "key", "cell", "salt")}
    text = F.coalesce(F.col(text_col), F.lit(""))
    size, key, salt = (F.octet_length(text) + ROW_BYTES).cast("bigint"), F.xxhash64(text), F.xxhash64(F.col(id_col))
    # What the passes read: three numbers for each row.
    keys = written(docs.select(key.alias("key"), size.alias("size"), salt.alias("salt")), "shard-keys")
    leaves = find_leaves(keys.select("key", "size"), shards)
    cells = Cells(leaves, place_leaves(leaves.size, shards))
    counted = keys.groupBy(cells.cell()("key", "salt").alias("cell")).agg(F.count(F.lit(1))).collect()  # some 2**ATOM_BITS and the shards
    counts = np.zeros(int(cells.parts.sum()), dtype=np.int64)
    for cell, n in counted:
        counts[cell] = n
    shard_of, first = cells.places(counts)
    keyed = docs.withColumns({names["size"]: size, names["crc"]: F.crc32(text), names["key"]: key, names["salt"]: salt})
    dealt = keyed.withColumn(names["cell"], cells.cell()(names["key"], names["salt"]))
    within = Window.partitionBy(names["cell"]).orderBy(names["key"], id_col)
    slot = F.row_number().over(within) - 1 + value_at(first)(names["cell"])
    return with_columns(dealt, {
        "size": F.col(names["size"]), "text_crc32": F.col(names["crc"]), "law": F.lit("bytes"), "shard": value_at(shard_of)(names["cell"]).cast("int"),
        "slot": slot.cast("bigint"), "grown_shard": F.lit(None).cast("int")}).drop(*names.values())
