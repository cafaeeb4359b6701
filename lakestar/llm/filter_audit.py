"""Filter interaction audit: what each of five filters removes in every order of the filters.

Filters (a document fails one when): A under MIN_WORDS words; B fewer than half of the words distinct; C more than 3 in 100 characters A-Z;
D any of ``#$%&*|``; E the same text in a document with a smaller id, anywhere in the table.

E by a counting-Bloom prepass:

1. Each text's 64-bit hash names HASHES counters. A task emits its sketch as the counters it has hit once and more than once, by
   slices of SLICE counters (after every FLUSH texts, so its memory is bounded); the sketches of a slice are merged by a saturating sum. A merged slice is
   a bit for each counter: hit twice or more. A text with a counter that isn't is unique for certain. There are about PER_TEXT counters
   for each row, at most MAX_COUNTERS (their bits, 128 MB then, are what is broadcast). Beyond that more unique texts go on to step 2; results are the same.
2. Only the other rows keep their text. It is grouped by the full text (a partial minimum before the shuffle, so a text that a third of all rows have
   moves once for each task) to its smallest id.
3. A row passes E if it has its text's smallest id: a join on text digest and id, which no group of copies makes hot.

Each row is then a mask of the filters it fails. Counts of (part, mask, labels) are additive: all orders, steps and shares follow from at most 128 counts a part.

Defined results: a null text is empty, a null part is the empty string; rows of one id and text are no copies of one another; a row without an
id is no copy and makes none; labels of one id are taken together (1 if any is 1); a document without a label is neither good nor toxic; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, written

FILTERS = "ABCDE"
MIN_WORDS = 200
HASHES, PER_TEXT = 2, 8
SLICE = 1 << 16
MAX_COUNTERS = 1 << 30
#: Texts after which a task emits what it has gathered.
FLUSH = 1 << 18

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SYMBOL = re.compile(rb"[#$%&*|]")


def counters_for(rows: int) -> int:
    """Counters of the sketch of so many rows: a power of two."""
    return min(MAX_COUNTERS, max(SLICE, 1 << (PER_TEXT * rows - 1).bit_length()))


def places(hashes: np.ndarray, counters: int) -> np.ndarray:
    """The counters of each 64-bit hash (a row for each of HASHES)."""
    unsigned = hashes.view(np.uint64)
    return np.stack([(unsigned >> np.uint64(32 * i)) & np.uint64(counters - 1) for i in range(HASHES)]).astype(np.int64)


def _sketch(counters: int) -> Callable:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """h -> slice, once, again: the counters of a slice that were hit once, and more than once."""
        held, size = [], 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch.column(0).to_numpy(zero_copy_only=False))
                size += batch.num_rows
            if size and (batch is None or size >= FLUSH):
                at, hits = np.unique(places(np.concatenate(held), counters), return_counts=True)
                cut = np.flatnonzero(np.diff(at // SLICE)) + 1
                parts = list(zip(np.split(at, cut), np.split(hits, cut)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(a[0]) // SLICE for a, _ in parts], pa.int32()),
                     pa.array([(a[n == 1] % SLICE).astype(np.uint16).tobytes() for a, n in parts], pa.binary()),
                     pa.array([(a[n > 1] % SLICE).astype(np.uint16).tobytes() for a, n in parts], pa.binary())], names=["slice", "once", "again"])
                held, size = [], 0

    return sketch


def _merge(rows: pa.Table) -> pa.Table:
    """Saturating sum of the sketches of one slice: a bit for each counter that was hit twice or more."""
    hits = np.zeros(SLICE, dtype=np.uint8)
    for once, again in zip(rows["once"], rows["again"]):
        at = np.frombuffer(once.as_py(), dtype=np.uint16)
        hits[at] = np.minimum(hits[at] + 1, 2)
        hits[np.frombuffer(again.as_py(), dtype=np.uint16)] = 2
    return pa.table([rows["slice"].slice(0, 1), pa.array([np.packbits(hits > 1).tobytes()], pa.binary())], names=["slice", "bits"])


def repeated_counters(hashes: DataFrame, rows: int) -> tuple[int, np.ndarray]:
    """Number of counters, and the bits of those that two texts or more of ``hashes`` (h) hit: the merged sketch."""
    counters = counters_for(rows)
    sketches = hashes.mapInArrow(_sketch(counters), "slice int, once binary, again binary")
    merged = sketches.groupBy("slice").applyInArrow(_merge, "slice int, bits binary")
    bits = np.zeros(counters // 8, dtype=np.uint8)
    for row in merged.toLocalIterator():  # counters / 8 bytes in all
        at = row["slice"] * SLICE // 8
        bits[at:at + SLICE // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return counters, bits


def failed(text: str) -> int:
    """Filters A to D that a text fails, as bits 1, 2, 4 and 8."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    return ((len(words) < MIN_WORDS) | (100 * len(set(words)) < 50 * len(words)) << 1
            | (100 * capitals > 3 * len(text)) << 2 | (_SYMBOL.search(raw) is not None) << 3)


def marks(counters: int, bits) -> Callable:
    """A column function (text, hash) -> struct(mask of A to D, whether the text may occur again); ``bits``: a broadcast variable."""
    @F.arrow_udf("struct<mask: int, again: boolean>")
    def mark(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known = np.unpackbits(np.frombuffer(bits.value, dtype=np.uint8)).view(bool) if counters <= 1 << 24 else None
        packed = np.frombuffer(bits.value, dtype=np.uint8)
        for texts, hashes in batches:
            at = places(hashes.to_numpy(zero_copy_only=False), counters)
            hit = known[at] if known is not None else (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
            yield pa.StructArray.from_arrays([pa.array([failed(x.as_py()) for x in texts], pa.int32()), pa.array(hit.all(axis=0))], names=["mask", "again"])

    return mark


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """id, part, mask (bits 1 to 16 for A to E): a row for each row."""
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    h = F.xxhash64("text")
    counters, bits = repeated_counters(rows.select(h.alias("h")), rows.count())
    marked = rows.withColumn("m", marks(counters, spark.sparkContext.broadcast(bits.tobytes()))("text", h))
    repeat = F.col("m.again")
    marked = written(marked.select("id", "part", "m.mask", "m.again", F.when(repeat, F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
                                   F.when(repeat, F.col("text")).alias("text")), "audit-rows")
    first = marked.where("again and id is not null").groupBy("text").agg(F.min("id").alias("first"))
    first = first.select("first", F.sha2(F.col("text").cast("binary"), 256).alias("first_digest"))
    of_text = marked.where("again").select("id", "part", "mask", "digest")
    joined = of_text.join(first, (F.col("id") == F.col("first")) & (F.col("digest") == F.col("first_digest")), "left")
    copy = F.when(F.col("id").isNotNull() & F.col("first").isNull(), 16).otherwise(0)
    unique = marked.where("not again").select("id", "part", "mask")
    return joined.select("id", "part", F.col("mask").bitwiseOR(copy).alias("mask")).unionByName(unique)


def mask_counts(marked: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """part, mask, n, good, toxic: documents of each part by the filters they fail."""
    told = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("quality"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    joined = marked.join(told, F.col("id") == F.col("label_id"), "left")
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return joined.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), count("quality").alias("good"), count("toxic").alias("bad"))


def _total(which: str, condition: Callable[[Column], Column]) -> Column:
    """Sum of the field ``which`` over the masks of a part that meet a condition."""
    return F.aggregate("masks", F.lit(0).cast("bigint"), lambda n, m: n + F.when(condition(m["mask"]), m[which]).otherwise(0))


def audit(counts: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley from ``mask_counts``."""
    of_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "bad")).alias("masks"))  # 32 at most
    each = of_part.select("part", "masks", F.explode(F.split(F.lit(" ".join(map("".join, itertools.permutations(FILTERS)))), " ")).alias("filter_order"))
    each = each.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    holds = lambda letters: sum(F.when(F.contains(letters, F.lit(x)), 1 << i).otherwise(0) for i, x in enumerate(FILTERS))
    each = each.withColumns({"before": holds(F.expr("substring(filter_order, 1, step - 1)")), "own": holds(F.expr("substring(filter_order, step, 1)"))})
    met = lambda m, bits: m.bitwiseAND(bits) != 0
    before, own = F.col("before"), F.col("own")
    here = lambda m: met(m, own) & ~met(m, before)
    # Of all orders, a filter comes first among the r filters that a document fails in one of r.
    share = F.aggregate("masks", F.lit(0).cast("bigint"), lambda n, m: n + F.when(
        met(m["mask"], own), m["n"] * F.element_at(F.array(*[F.lit(120 // r) for r in range(1, 6)]), F.bit_count(m["mask"]))).otherwise(0))
    return each.select(
        "part", "filter_order", "step",
        _total("n", lambda m: ~met(m, before.bitwiseOR(own))).alias("kept"), _total("n", here).alias("removed"),
        _total("n", lambda m: met(m, own) & met(m, before)).alias("redundant"), _total("n", lambda m: m == own).alias("unique_fails"),
        _total("good", here).alias("good_lost"), _total("bad", here).alias("toxic_lost"), share.alias("shapley"))


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of all documents."""
    return audit(mask_counts(failures(docs), labels))
