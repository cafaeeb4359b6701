"""Near-duplicate groups: MinHash signatures and a multi-index Hamming join.

A document's set is its distinct shingles: runs of ``SHINGLE_WORDS`` words (runs of bytes other than space and 0x09-0x0D; A-Z
lower-cased); with fewer words the whole sequence is one shingle. Documents whose Jaccard similarity reaches the threshold are linked.

1. Documents with equal sets are one representative, the smallest id.
2. A signature has CHUNKS * SLOTS MinHash values of BITS bits. By the pigeonhole principle two signatures that differ in no more than
   CHUNKS * (ERRORS + 1) - 1 = 23 of their 72 values agree in some chunk but for ERRORS = 1 values. The allowed errors are enumerated: each chunk gives a
   key for each of its values left out, so all pairs under that distance share a key. Pairs at a similarity of 0.85 differ in 10.8
   values on average and share no key with a chance of 2e-8 (at 0.8: 3e-6); pairs over the distance may share one too, and are treated alike.
3. A key's representatives are linked without listing their pairs. First each representative is compared with the smallest one of all its keys,
   then, where a key still holds several groups, with the pivot that a hash draws for each key. A pivot's rows stream by its own text, in salted
   parts, so a pivot that a third of all documents share is many tasks and its text is there once for each.
4. What then remains in mixed keys of three or more is narrowed by prefixes before it is compared, as a key alone doesn't tell documents of one template
   (well under the threshold, but close) apart. A shingle is useful if documents of several groups have it. Two documents with a link share
   2t / (1 + t) of the smaller one's shingles at least, so, with useful shingles ordered by how many documents have them, the larger one's first
   u - t * n + 1 and the smaller one's first u - 2t / (1 + t) * n + 1 (of u useful ones among n) have one in common. What a template has in common
   comes last in that order, and a document with fewer useful shingles than a link takes has no partner at all.
   Documents that meet at such a shingle, share a key and have signatures near enough are compared block by block inside tasks, on the full sets. Only
   links leave a task, one for each document at most. Blocks are bounded by documents and by shingles.
   So no link is lost. Work can grow with the square of a family only if its members have as much in common as links do without being links.
5. Every link is confirmed on the full sets (exact Jaccard, in whole numbers) before it counts.
6. Groups are connected components, by joins (``components``).

Defined results: null and blank texts have an empty set and are linked with nothing; rows with the same id are one document, whose text
is the one with words that has the smallest hash; rows without an id give no row here; ties don't arise, as a group keeps its smallest id; an empty table gives an empty result.
``keep_one_of_each`` judges every row by its own text instead, with or without an id.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alone, ship, spare, written
from .components import components
from .shingles import mix, shingle_set

SHINGLE_WORDS = 5
CHUNKS, SLOTS, ERRORS = 12, 6, 1
VALUES, BITS = CHUNKS * SLOTS, 16
#: Within what remains after both rounds, signatures that differ in more values than links do with this chance aren't compared in full.
MISS = 1e-7
#: Documents, and about as many of their shingles, that are compared with as many others in one step there.
BLOCK, BLOCK_GRAMS = 512, 1 << 19
#: Rows of a pivot that are compared in one stream.
STREAM = 1024

_U = np.uint64
_MULTIPLY = np.random.RandomState(23).randint(0, 1 << 63, VALUES).astype(_U) * _U(2) + _U(1)
_SLOT = np.random.RandomState(29).randint(0, 1 << 63, VALUES).astype(_U) * _U(2) + _U(1)


def signature(grams: np.ndarray) -> np.ndarray:
    """The b-bit MinHash values of a non-empty set."""
    low = np.full(VALUES, np.iinfo(np.uint64).max, dtype=_U)
    for at in range(0, len(grams), 2048):
        low = np.minimum(low, (grams[at:at + 2048, None] * _MULTIPLY).min(axis=0))
    return (mix(low) >> _U(64 - BITS)).astype(np.uint16)


def keys(signatures: np.ndarray) -> np.ndarray:
    """For each signature (a row) a key for each value left out: the hash of the other values of its chunk, and of its place."""
    slots = mix(signatures.astype(_U) + _SLOT)
    chunks = slots.reshape(-1, CHUNKS, SLOTS).sum(axis=2, dtype=_U)
    return mix(np.repeat(chunks, SLOTS, axis=1) - slots + _SLOT)


def far(percent: int) -> int:
    """The most values in which the signatures of a link differ, but for a chance of MISS: the tail of a binomial distribution."""
    differ = 1 - percent / 100
    tail = 0.0
    for d in range(VALUES, 0, -1):
        tail += math.comb(VALUES, d) * differ ** d * (1 - differ) ** (VALUES - d)
        if tail > MISS:
            return d
    return 0


def first_shared(differs: np.ndarray) -> np.ndarray:
    """For pairs of signatures (rows: which values differ) the number of the first key that both have; VALUES if none."""
    chunks = differs.reshape(-1, CHUNKS, SLOTS)
    errors = chunks.sum(axis=2)
    chunk = (errors <= 1).argmax(axis=1)
    rows = np.arange(len(differs))
    slot = np.where(errors[rows, chunk] == 1, chunks[rows, chunk].argmax(axis=1), 0)
    return np.where((errors <= 1).any(axis=1), chunk * SLOTS + slot, VALUES)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, prints, signatures = [], [], []
        for text in batch.column(1):
            grams = shingle_set(text.as_py(), SHINGLE_WORDS)
            sizes.append(len(grams))
            prints.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
            signatures.append(signature(grams).tobytes() if len(grams) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                                          pa.array(signatures, pa.binary())], names=["id", "version", "n", "print", "signature"])


def _post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rep, n, signature -> key, place (of the key among a signature's), rep, n."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            found = keys(np.frombuffer(b"".join(batch.column(2).to_pylist()), dtype=np.uint16).reshape(-1, VALUES))
            reps, sizes = (np.repeat(batch.column(i).to_numpy(), VALUES) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(found.ravel().view(np.int64)), pa.array(np.tile(np.arange(VALUES, dtype=np.int16), len(found))),
                                              pa.array(reps), pa.array(sizes)], names=["key", "place", "rep", "n"])


def _against_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """pivot, part, member, text, sorted: the pivot's own text (member null) before those of its members in each part -> a, b, shared, united."""
    pivot, known = None, None
    for batch in batches:
        out = []
        for a, b, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
            grams = shingle_set(text.as_py(), SHINGLE_WORDS)
            if b is None:
                pivot, known = a, grams
            elif a == pivot:
                both = len(np.intersect1d(known, grams, assume_unique=True))
                out.append((a, b, both, len(known) + len(grams) - both))
        columns = list(zip(*out)) if out else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "shared", "united"])


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rep, n, label, text -> h, rep, n, label: a row for each shingle."""
    for whole in batches:
        for at in range(0, whole.num_rows, 64):
            batch = whole.slice(at, 64)
            sets = [shingle_set(x.as_py(), SHINGLE_WORDS) for x in batch.column(3)]
            times = [len(x) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(sets).view(np.int64)), *[pa.array(np.repeat(batch.column(i).to_numpy(), times)) for i in range(3)]],
                names=["h", "rep", "n", "label"])


_CELL = "bundle bigint, h bigint, one int, two int, side int, indexed boolean, rep bigint, n bigint, label bigint, signature binary"


class _Cell:
    """Two blocks of a shingle's documents (or one with itself), by ascending set size: the rows ``at`` of a group's columns."""

    def __init__(self, columns: dict[str, np.ndarray], at: np.ndarray, percent: int):
        self.rows = at[np.argsort(columns["n"][at], kind="stable")]
        side, self.indexed, self.rep, self.n, self.label, self.values = (columns[x][self.rows] for x in ("side", "indexed", "rep", "n", "label", "values"))
        self.percent, self.most = percent, far(percent)
        self.left = np.flatnonzero(side == 0)
        self.right = self.left if columns["one"][at[0]] == columns["two"][at[0]] else np.flatnonzero(side == 1)

    def partners(self, i: int) -> np.ndarray:
        """Those of the right block that may be links of the left one's ``i``: another label, sizes, prefixes and signatures that allow it, and
        a key that both have."""
        sizes = self.n[self.right]
        low = np.searchsorted(sizes, -(-self.n[i] * self.percent // 100))
        high = np.searchsorted(sizes, self.n[i] * 100 // self.percent, side="right")
        near = self.right[low:high]
        smaller = (self.indexed[i] & (self.n[near] >= self.n[i])) | (self.indexed[near] & (self.n[near] <= self.n[i]))
        near = near[smaller & (self.label[near] != self.label[i])]
        if not len(near):
            return near
        differs = self.values[near] != self.values[i]
        few = differs.sum(axis=1) <= self.most
        return near[few][first_shared(differs[few]) < VALUES]


def _cells(rows: pa.Table, percent: int) -> Iterator[_Cell]:
    """The cells of a group: one of a large shingle, or those of a bundle of small ones."""
    columns = {x: rows[x].to_numpy() for x in ("h", "one", "two", "side", "indexed", "rep", "n", "label")}
    columns["values"] = np.frombuffer(b"".join(rows["signature"].to_pylist()), dtype=np.uint16).reshape(-1, VALUES)
    order = np.argsort(columns["h"], kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(columns["h"][order])) + 1):
        yield _Cell(columns, at, percent)


def _with_partners(percent: int):
    def keep(rows: pa.Table) -> pa.Table:
        """The rows that have a partner in their cell."""
        has = np.zeros(rows.num_rows, dtype=bool)
        for cell in _cells(rows, percent):
            for i in cell.left:
                near = cell.partners(i)
                has[cell.rows[near]] = True
                has[cell.rows[i]] |= len(near) > 0
        return rows.select([x.split()[0] for x in _CELL.split(", ")]).filter(pa.array(has))

    return keep


def _links_of_group(percent: int):
    def link(rows: pa.Table) -> pa.Table:
        """Confirmed links of the cells' pairs, as (a, b): a the first of those that are connected here. Exact, on the full sets."""
        texts, sets, parent = rows["text"], {}, {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        def grams(cell: _Cell, i: int) -> np.ndarray:
            if cell.rep[i] not in sets:
                sets[cell.rep[i]] = shingle_set(texts[int(cell.rows[i])].as_py(), SHINGLE_WORDS)
            return sets[cell.rep[i]]

        for cell in _cells(rows, percent):
            for i in cell.left:
                near = np.array([j for j in cell.partners(i) if root(cell.rep[j]) != root(cell.rep[i])], dtype=np.int64)
                if not len(near):
                    continue
                own, others = grams(cell, i), [grams(cell, j) for j in near]
                lengths = np.array([len(x) for x in others])
                common = np.isin(np.concatenate(others), own)
                shared = np.add.reduceat(common.astype(np.int64), np.cumsum(lengths) - lengths)
                for j in near[shared * 100 >= (lengths + len(own) - shared) * percent]:
                    a, b = sorted((root(cell.rep[i]), root(cell.rep[j])))
                    parent[b] = a
        pairs = [(root(x), x) for x in list(parent) if root(x) != x]
        return pa.table([pa.array([x[0] for x in pairs], pa.int64()), pa.array([x[1] for x in pairs], pa.int64())], names=["a", "b"])

    return link


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a: the pivot, b, members: of the key they met at) whose full sets have 100 * intersection >= percent * union. Each
    row's text is fetched once, the pivot's once for each part of its rows."""
    parts = F.ceil(F.col("members") / STREAM).cast("int")
    placed = pairs.select(F.col("a").alias("pivot"), F.pmod(F.xxhash64("b"), parts).cast("int").alias("part"), F.col("b").alias("member"))
    heads = placed.select("pivot", "part", F.lit(None).cast("bigint").alias("member")).distinct()
    wanted = placed.unionByName(heads).withColumn("id", F.coalesce("member", "pivot"))
    found = wanted.join(texts, "id").select("pivot", "part", "member", "text")
    streams = found.repartition("pivot", "part").sortWithinPartitions("pivot", "part", F.asc_nulls_first("member"))
    counted = streams.mapInArrow(_against_pivot, "a bigint, b bigint, shared bigint, united bigint")
    return counted.where(F.col("shared") * 100 >= F.col("united") * percent).select("a", "b")


def links_of_rest(rest: DataFrame, reps: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between documents of different labels among ``rest`` (rep, n, label)."""
    grams = rest.join(texts, F.col("rep") == F.col("id")).select("rep", "n", "label", "text").mapInArrow(_grams, "h bigint, rep bigint, n bigint, label bigint")
    grams = written(grams, "near-grams")
    useful = grams.groupBy("h").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.count(F.lit(1)).alias("documents"))
    useful = useful.where("least <> most").select("h", "documents")
    ranked = grams.join(useful, "h").groupBy("rep", "n", "label").agg(F.sort_array(F.collect_list(F.struct("documents", "h"))).alias("useful"))
    # A share of n rounded up, in whole numbers; see point 4.
    share = lambda num, den: F.call_function("div", F.col("n") * num + den - 1, F.lit(den))
    prefix = lambda least: F.greatest(F.lit(0), F.size("useful") - least + 1).cast("int")
    probes, indexed = prefix(share(percent, 100)), prefix(share(2 * percent, 100 + percent))
    entries = ranked.select("rep", "n", "label", F.posexplode(F.slice("useful", F.lit(1), probes)).alias("place", "gram"), indexed.alias("indexed"))
    entries = written(entries.select(F.col("gram.h").alias("h"), "rep", "n", "label", (F.col("place") < F.col("indexed")).alias("indexed")), "near-prefixes")
    met = entries.groupBy("h").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.max("indexed").alias("any"),
                                   F.count(F.lit(1)).alias("members"), F.sum("n").alias("size"))
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("size") / BLOCK_GRAMS)).cast("int")
    met = written(met.where("least <> most AND any").select("h", blocks.alias("blocks"), "members", "size"), "near-met")
    # Shingles of one block are compared in bundles of about a block's size, as most have a few documents only.
    small = met.where("blocks = 1").agg(F.sum("members").alias("members"), F.sum("size").alias("size")).first()
    bundles = max(1, -(-(small["members"] or 0) // (4 * BLOCK)), -(-(small["size"] or 0) // BLOCK_GRAMS))
    placed = entries.join(met.select("h", "blocks"), "h").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    placed = placed.join(reps.select("rep", "signature"), "rep")
    paired = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.select(F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("h"), F.lit(bundles))).otherwise(-1).cast("bigint").alias("bundle"),
                           "h", F.least("block", "with").alias("one"), F.greatest("block", "with").alias("two"),
                           F.when(F.col("block") <= F.col("with"), 0).otherwise(1).alias("side"), "indexed", "rep", "n", "label", "signature")
    large = F.when(F.col("bundle") < 0, F.col("h")).alias("large")
    able = written(paired.groupBy("bundle", large, "one", "two").applyInArrow(_with_partners(percent), _CELL), "near-able")
    able = able.join(texts, F.col("rep") == F.col("id")).select(*[x.split()[0] for x in _CELL.split(", ")], "text")
    return able.groupBy("bundle", large, "one", "two").applyInArrow(_links_of_group(percent), "a bigint, b bigint")


def labelled(rows: DataFrame, labels: DataFrame, by: str, name: str) -> DataFrame:
    """``rows`` with the label of the node in column ``by``; a node without one is its own."""
    of = labels.select(F.col("node").alias(by), F.col("label").alias(name))
    return rows.join(of, by, "left").withColumn(name, F.coalesce(name, by))


def merged(links: DataFrame, labels: DataFrame | None) -> DataFrame:
    """node, label after ``links`` (a, b) have joined groups: components of the graph of the labels so far."""
    links = written(links, "near-links")
    if labels is None:
        return components(links)
    at = labelled(labelled(links, labels, "a", "la"), labels, "b", "lb")
    new = components(at.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")))
    step = new.select(F.col("node").alias("label"), F.col("label").alias("to"))
    moved = labels.join(step, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    fresh = new.join(labels.select("node"), "node", "left_anti")  # nodes that had been their own
    return written(moved.unionByName(fresh), "near-labels")


def near_duplicate_groups(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id: a row for each document. ``percent``: the least Jaccard similarity of a link, in hundredths."""
    ship(docs.sparkSession)
    return alone(docs.sparkSession, "near-groups", lambda: _groups(docs, percent, id_col, text_col))


def _groups(docs: DataFrame, percent: int, id_col: str, text_col: str) -> DataFrame:
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where("id is not null")
    texts = texts.withColumn("version", F.xxhash64("text"))
    signed = texts.mapInArrow(_sign, "id bigint, version bigint, n bigint, print binary, signature binary")
    own = F.min(F.struct((F.col("n") == 0).alias("blank"), "version", "print", "n", "signature"))
    signed = written(signed.groupBy("id").agg(own.alias("own")).select("id", "own.version", "own.print", "own.n", "own.signature"), "near-documents")
    found = signed.where("n > 0").groupBy("print").agg(F.min(F.struct("id", "version", "n", "signature")).alias("r"))
    reps = written(found.select("print", F.col("r.id").alias("rep"), "r.version", "r.n", "r.signature"), "near-representatives")

    posts = reps.select("rep", "n", "signature").mapInArrow(_post, "key bigint, place smallint, rep bigint, n bigint")
    drawn = F.struct(F.xxhash64("rep", "key"), F.col("rep"))
    shared = posts.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.count(F.lit(1)).alias("members"), F.min(drawn).alias("drawn"))
    shared = written(shared.where("low <> high").select("key", "low", "members", F.col("drawn.rep").alias("pivot")), "near-keys")
    members = written(posts.join(shared, "key"), "near-members")
    sizes = reps.select(F.col("rep").alias("other"), F.col("n").alias("other_n"))
    needed = members.select("rep").distinct().join(reps.select("rep", "version"), "rep").withColumnRenamed("rep", "id")
    texts = written(texts.join(needed, ["id", "version"], "left_semi").groupBy("id", "version").agg(F.min("text").alias("text")), "near-texts")
    fits = F.least("n", "other_n") * 100 >= F.greatest("n", "other_n") * percent

    best = F.min(F.struct(F.col("low"), (-F.col("members")).alias("fewer")))
    first = members.groupBy("rep", "n").agg(best.alias("best")).select("rep", "n", F.col("best.low").alias("other"), (-F.col("best.fewer")).alias("members"))
    first = first.where("rep <> other").join(sizes, "other").where(fits)
    tested = written(first.select(F.col("other").alias("a"), F.col("rep").alias("b"), "members"), "near-pairs")
    labels = merged(confirmed(tested, texts, percent), None)

    def still_mixed() -> DataFrame:
        """Members of the keys that hold several groups."""
        rows = labelled(members, labels, "rep", "label")
        mixed = rows.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most").select("key")
        return written(rows.join(mixed, "key", "left_semi"), "near-mixed")

    second = still_mixed().select("rep", "n", "label", "members", F.explode(F.array("low", "pivot")).alias("other")).where("rep <> other")
    second = second.groupBy("rep", "n", "label", "other").agg(F.max("members").alias("members"))
    second = labelled(second.join(sizes, "other").where(fits), labels, "other", "other_label").where("label <> other_label")
    second = second.select(F.col("other").alias("a"), F.col("rep").alias("b"), "members").join(tested.select("a", "b"), ["a", "b"], "left_anti")
    labels = merged(confirmed(written(second, "near-pairs"), texts, percent), labels)

    rest = written(still_mixed().where("members > 2").select("rep", "n", "label").distinct(), "near-rest")
    if rest.limit(1).count():
        labels = merged(links_of_rest(rest, reps, texts, percent), labels)

    of_print = labelled(reps, labels, "rep", "component_id").select("print", "component_id")
    return (signed.join(of_print, "print", "left")
            .select("id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")))


def keep_one_of_each(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest id (rows without one come last). Each row is judged by its own
    text, so rows that share an id, or have none, are compared like others; rows without words are no one's copies and stay. All columns stay."""
    row = spare(docs, "row")
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "near-rows")
    groups = near_duplicate_groups(numbered, percent, row, text_col).select(F.col("id").alias("own"), "component_id")
    ids = numbered.select(F.col(row).alias("own"), F.col(id_col).alias("name")).join(groups, "own")
    first = F.min(F.struct(F.col("name").isNull().alias("unnamed"), F.col("name"), F.col("own")))
    several = ids.groupBy("component_id").agg(first.alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = ids.join(several.select("component_id", F.col("first.own").alias("kept")), "component_id").where("own <> kept")
    gone = written(gone.select(F.col("own").alias(row)), "near-gone")
    return numbered.join(gone, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
