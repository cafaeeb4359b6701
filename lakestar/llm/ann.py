"""Approximate nearest neighbours by inner product: a permutation index.

Objects in nearly the same direction see the same reference points in the same order. PIVOTS vectors, a bounded sample of the table (those with the
smallest hash), scaled to length 1, are the reference points. Each object is represented by its PREFIX nearest pivots (largest inner product), in order; that is the index, a
row for each object. In a block, objects are posted to their pivots' inverted files with their place. For a query, the files of
its own PREFIX nearest pivots are read and give the Spearman footrule distance of the two orders: a pivot that only one
of them has counts as place PREFIX, so footrule = PREFIX * (PREFIX + 1) - 2 * sum over common pivots of (PREFIX - the later place).
The footrule tells the angle only, so an object's inner product with the query is estimated by its length times a cosine: a line through the
pivots' own pairs gives the cosine of a footrule, and DEVIATIONS standard deviations of these pairs are added, so that long objects aren't lost
by an error of the angle. With equal lengths this is the order of the footrule. The CANDIDATES share of a block with the largest
estimates (LEAST at least) is reranked by the exact inner product of the original vectors.

Cells: objects are dealt by a hash of their id into TASKS stripes, whatever their number, and queries into blocks of about QUERIES. A stripe and a block are a
cell: its queries are kept, its objects streamed past them in blocks of OBJECTS at most, and what a cell returns are a query's best k of the whole stripe. So a task's memory is bounded,
a query moves TASKS times and gives TASKS * k rows at most to rank, however large the table is; an object moves once for each block of queries.

Defined results: vectors that are null, zero, empty, or hold null or non-finite components take no part, nor do rows without an id or
those of another length than the most common one (the smaller of equally common ones); rows with the same id are one, with the smallest vector; ties
go to the smaller id, also among candidates; with k or fewer others, all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_sample, ship, written

PIVOTS, PREFIX = 256, 128
CANDIDATES, LEAST = 0.1, 200
DEVIATIONS = 2
OBJECTS, QUERIES, TASKS = 1 << 16, 1 << 15, 24


def valid_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, vector (array of double): the rows that take part."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    found = rows.select(F.col(id_col).cast("bigint").alias("id"), vector.alias("vector")).where("id is not null and vector is not null")
    found = found.where(finite & F.exists("vector", lambda x: x != 0)).groupBy("id").agg(F.min("vector").alias("vector"))
    found = written(found, "ann-vectors")
    common = found.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return found.where(F.size("vector") == (common["n"] if common else 0))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1).astype(np.float64)


def lengths(vectors: np.ndarray) -> np.ndarray:
    """Euclidean length of each non-zero vector; scaled, so that no square overflows."""
    largest = np.abs(vectors).max(axis=1)
    return largest * np.sqrt(((vectors / largest[:, None]) ** 2).sum(axis=1))


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Numbers of each vector's PREFIX nearest pivots, nearest first."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :PREFIX].astype(np.uint16)


def order_of(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` (id, vector) with ``near``, the ordered nearest pivots as 16-bit numbers."""
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = nearest_pivots(matrix(batch.column(1)), pivots) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([x.tobytes() for x in near], pa.binary())],
                                             names=["id", "vector", "near"])

    return rows.select("id", "vector").mapInArrow(number, "id bigint, vector array<double>, near binary")


def inverted_files(near: np.ndarray, pivots: int) -> np.ndarray:
    """A row for each pivot: PREFIX less the pivot's place with each object, 0 for those that don't have it. With PREFIX / PIVOTS of all
    objects in a file, such a row is smaller than a list of them, and reading it is one pass over bytes."""
    files = np.zeros((pivots, len(near)), dtype=np.uint8)
    weights = np.arange(near.shape[1], 0, -1, dtype=np.uint8)
    files[near.ravel(), np.repeat(np.arange(len(near)), near.shape[1])] = np.tile(weights, len(near))
    return files


def common_places(files: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each object the sum over the pivots that it has in common with a query of PREFIX less the later place."""
    weights = np.arange(len(order), 0, -1, dtype=np.uint8)
    read = files[order]
    return np.minimum(read, weights[:, None], out=read).sum(axis=0, dtype=np.uint16)


def cosine_line(pivots: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a line that gives the cosine of two vectors, DEVIATIONS above the mean, from ``common_places`` of
    their orders; learned from the pairs of pivots. Where these don't tell, it gives 0 to 1."""
    near = nearest_pivots(pivots, pivots)
    files = inverted_files(near, len(pivots))
    pairs = ~np.eye(len(pivots), dtype=bool)
    common = np.array([common_places(files, order) for order in near], dtype=np.float64)[pairs]
    cosine = (pivots @ pivots.T)[pairs]
    spread = common.var() if len(common) else 0.0
    slope = ((common - common.mean()) * (cosine - cosine.mean())).mean() / spread if spread else 0.0
    if slope <= 0:
        return 2 / (near.shape[1] * (near.shape[1] + 1)), 0.0
    base = cosine.mean() - slope * common.mean()
    return slope, base + DEVIATIONS * (cosine - base - slope * common).std()


def rerank(k: int, line: tuple[float, float], least: int, objects: pa.Table, pivots: int, queries: np.ndarray, vectors: np.ndarray,
           orders: np.ndarray, best: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Bring each query's ``best`` (ids, scores) up to date with a block of objects, of which ``least`` are reranked at least."""
    objects = objects.sort_by("id")
    ids, of = objects["id"].to_numpy(), matrix(objects["vector"])
    files, length = inverted_files(places(objects["near"]), pivots), lengths(of)
    take = min(len(ids), max(least, k + 1, int(np.ceil(CANDIDATES * len(ids)))))
    for i, (query, vector, order) in enumerate(zip(queries, vectors, orders)):
        estimate = length * (line[0] * common_places(files, order) + line[1])
        # The largest estimates; of equal ones the smaller ids, which come first.
        lowest = np.partition(estimate, len(ids) - take)[len(ids) - take]
        over = np.flatnonzero(estimate > lowest)
        chosen = np.concatenate((over, np.flatnonzero(estimate == lowest)[:take - len(over)]))
        chosen = np.sort(chosen[ids[chosen] != query])
        known = np.concatenate((best[i][0], ids[chosen]))
        scores = np.concatenate((best[i][1], (of[chosen] * vector).sum(axis=1)))
        first = np.lexsort((known, -scores))[:k]
        best[i] = known[first], scores[first]


def places(near: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(near.to_pylist()), dtype=np.uint16).reshape(len(near), -1)


def by_cell(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, bool, pa.Table]]:
    """cell, whether these are objects, and rows: a cell's queries in one piece, then its objects in blocks of ``size`` (the last may be smaller), of rows ordered
    by cell, queries first."""
    key, held, n = None, [], 0
    for batch in batches:
        part = pa.Table.from_batches([batch])
        cells, kinds = part["cell"].to_numpy(), part["is_object"].to_numpy()
        cuts = np.flatnonzero((cells[1:] != cells[:-1]) | (kinds[1:] != kinds[:-1])) + 1
        for start, end in zip([0, *cuts], [*cuts, len(cells)]):
            if start == end:
                continue
            if held and key != (cells[start], kinds[start]):
                yield *key, pa.concat_tables(held)
                held, n = [], 0
            key = cells[start], kinds[start]
            while start < end:
                some = min(end - start, size - n) if key[1] else end - start
                held.append(part.slice(start, some))
                start, n = start + some, n + some
                if key[1] and n == size:
                    yield *key, pa.concat_tables(held)
                    held, n = [], 0
    if held:
        yield *key, pa.concat_tables(held)


def _search(k: int, pivots: int, line: tuple[float, float], least: int, size: int):
    def told(asked: tuple | None) -> Iterator[pa.RecordBatch]:
        if asked:
            counts = [len(ids) for ids, _ in asked[3]]
            columns = [np.repeat(asked[0], counts), np.concatenate([ids for ids, _ in asked[3]]), np.concatenate([scores for _, scores in asked[3]])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, asked = None, None
        for at, is_object, rows in by_cell(batches, size):
            if at != cell:
                yield from told(asked)
                cell, asked = at, None
            if not is_object:
                none = np.zeros(0, dtype=np.int64), np.zeros(0)
                asked = rows["id"].to_numpy(), matrix(rows["vector"]), places(rows["near"]), [none] * len(rows)
            elif asked:
                rerank(k, line, least, rows, pivots, *asked)
        yield from told(asked)

    return search


def nearest(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found of each row for which ``is_query`` holds (a condition on the id, as ``id``)."""
    ship(rows.sparkSession)
    vectors = valid_vectors(rows, id_col, vector_col)
    sample = hash_sample(vectors, "vector", PIVOTS)
    pivots = np.array(sample, dtype=np.float64) if sample else np.zeros((0, 1))
    if sample:
        pivots /= lengths(pivots)[:, None]
    index = written(order_of(vectors, pivots), "ann-index")
    queries = index.where(is_query)
    parts = lambda n, size: max(1, -(-n // size))
    # With LEAST rows or fewer, all are reranked in one place.
    stripes, query_blocks = TASKS if index.count() > LEAST else 1, parts(queries.count(), QUERIES)
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    objects = index.withColumn("query_block", every(query_blocks)).withColumn("stripe", dealt(stripes)).withColumn("is_object", F.lit(True))
    asked = queries.withColumn("stripe", every(stripes)).withColumn("query_block", dealt(query_blocks)).withColumn("is_object", F.lit(False))
    cell = (F.col("query_block") * stripes + F.col("stripe")).cast("int").alias("cell")
    rows = objects.unionByName(asked).select(cell, "is_object", "id", "vector", "near").repartitionById(stripes * query_blocks, "cell")
    # In the order of another hash, so that the blocks of a stripe don't follow the ids.
    ordered = rows.sortWithinPartitions("cell", "is_object", F.xxhash64("id", F.lit(1)), "id")
    line = cosine_line(pivots) if sample else (0.0, 0.0)
    best = ordered.mapInArrow(_search(k, len(pivots), line, -(-LEAST // stripes), OBJECTS), "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
