"""Exact top-k inner products of integer vectors over buckets of vectors of like length.

Vectors are sorted by length over the cluster and cut into buckets of a bounded number of rows, so a
length that many vectors share fills several buckets. A query's best scores within the longest
bucket bound its k-th score from below. In every other bucket that bound, divided by the query's and
the bucket's largest length, is a local cosine threshold: above one the bucket is skipped; else
vectors are pruned by one coordinate of the query, whose feasible interval the threshold gives, or
by their length, whichever leaves fewer. What remains is verified by exact integer products.

Defined results: vectors that are null or hold null or non-finite components take no part; a missing
component of a shorter vector counts as zero; rows of one vec_id are candidates each for itself, and
none of them for their own vec_id, which is one query (of its smallest vector); a row without vec_id
takes no part; products are exact integers of any size, but a scaled component of 2^62 and more, or
a score among the k best that does not fit 64 bits, fails the job; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baleflow.llm.common import ready
from baleflow.session import written

#: Rows of a bucket and of a block of queries: what one task works on at a time.
BUCKET_ROWS = 4096
QUERY_ROWS = 1024
#: Coordinates of a query, its largest ones, that are tried for pruning.
FOCUS = 4
#: Floating bounds are widened by this, relative to one.
SLACK = 1e-9

BLOCK = "rows int, dims int, ids binary, vectors binary"
FOUND = "query_id long, vec_id long, score long"


def integer_vectors(table: DataFrame, column: str, scale: float) -> DataFrame:
    """vec_id and floor(scale * component), with the vectors that can take part."""
    vector = F.col(column).cast("array<double>")
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    message = F.lit("a scaled component is too large for exact products")
    scaled = F.transform(
        vector,
        lambda x: F.when(F.abs(x * F.lit(scale)) < 2.0**62, F.floor(x * F.lit(scale)).cast("long"))
        .otherwise(F.raise_error(message).cast("long")),
    )
    return (
        table.where(F.col("vec_id").isNotNull() & vector.isNotNull() & finite)
        .select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("vector"))
    )


def length() -> Column:
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") ** 2)
    return F.sqrt(square)


def block_of(held: list[tuple[int, list[int]]], **columns: int) -> pa.RecordBatch:
    """Vectors as one row of binary arrays, shorter ones filled up with zeros."""
    dims = max((len(vector) for _, vector in held), default=0)
    vectors = np.zeros((len(held), dims), np.int64)
    for place, (_, vector) in enumerate(held):
        vectors[place, : len(vector)] = vector
    ids = np.array([number for number, _ in held], np.int64)
    row = {
        "rows": pa.array([len(held)], pa.int32()),
        "dims": pa.array([dims], pa.int32()),
        "ids": pa.array([ids.tobytes()], pa.binary()),
        "vectors": pa.array([vectors.tobytes()], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(
        row | {name: pa.array([value], pa.int64()) for name, value in columns.items()}
    )


def buckets_of(rows: DataFrame, bucket_rows: int) -> DataFrame:
    """The rows of every partition, one after another, in buckets."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, list[int]]] = []
        for batch in batches:
            for number, vector in zip(batch["vec_id"].to_pylist(), batch["vector"].to_pylist()):
                held.append((number, vector))
                if len(held) == bucket_rows:
                    yield block_of(held)
                    held = []
        if held:
            yield block_of(held)

    blocks = rows.select("vec_id", "vector").mapInArrow(pack, BLOCK)
    return written(blocks.withColumn("block", F.monotonically_increasing_id()), "buckets")


def query_blocks(asked: DataFrame, blocks: int) -> DataFrame:
    """The queries dealt into so many blocks, numbered from 0, of about the same size."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held = [(one["vec_id"], one["vector"]) for one in row["held"]]
                yield block_of(held, block=row["block"])

    dealt = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    grouped = dealt.groupBy("block").agg(F.collect_list(F.struct("vec_id", "vector")).alias("held"))
    return written(grouped.mapInArrow(pack, f"{BLOCK}, block long"), "queries")


def matrix(row: dict, prefix: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[f"{prefix}_ids"], np.int64)
    vectors = np.frombuffer(row[f"{prefix}_vectors"], np.int64)
    return ids, vectors.reshape(row[f"{prefix}_rows"], row[f"{prefix}_dims"])


def widened(vectors: np.ndarray, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    out[:, : vectors.shape[1]] = vectors
    return out


class Bucket:
    """Vectors of like length, their coordinates sorted, and exact products with them."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        largest = float(np.abs(vectors).max(initial=0))
        self.largest = largest
        self.floats = vectors.astype(np.float64)
        self.lengths = np.sqrt((self.floats**2).sum(1))
        self.longest = float(self.lengths.max(initial=0.0))
        unit = self.floats / np.maximum(self.lengths, 1e-300)[:, None]
        self.by_coordinate = np.argsort(unit, axis=0)
        self.sorted_units = np.take_along_axis(unit, self.by_coordinate, 0)
        self.by_length = np.argsort(-self.lengths, kind="stable")
        self.sorted_lengths = -self.lengths[self.by_length]

    def products(self, query: np.ndarray, places: np.ndarray) -> np.ndarray:
        bound = self.largest * float(np.abs(query).max(initial=0)) * max(len(query), 1)
        if bound < 2**53:
            return (self.floats[places] @ query.astype(np.float64)).astype(np.int64)
        if bound >= 2**63:  # Python integers hold every product
            out = np.empty(len(places), object)
            numbers = query.tolist()
            for row, vector in enumerate(self.vectors[places].tolist()):
                out[row] = sum(a * b for a, b in zip(vector, numbers))
            return out
        return self.vectors[places] @ query

    def candidates(self, query: np.ndarray, least: float) -> np.ndarray:
        """Places of all vectors whose product with `query` may reach `least`."""
        everything = np.arange(len(self.ids))
        size = float(np.sqrt((query.astype(np.float64) ** 2).sum()))
        if least <= 0 or not size:
            return everything
        if size * self.longest * (1 + SLACK) < least:
            return everything[:0]
        # Pruning by length: only vectors that are long enough.
        long_enough = int(
            np.searchsorted(self.sorted_lengths, -least / size * (1 - SLACK), side="right")
        )
        best, best_places = long_enough, None
        # Pruning by a coordinate: its feasible interval, from the local cosine threshold.
        cosine = min(least / (size * self.longest), 1.0)
        unit = query / size
        for focus in np.argsort(-np.abs(unit))[:FOCUS].tolist():
            middle = unit[focus] * cosine
            spread = np.sqrt(max(0.0, (1 - unit[focus] ** 2) * (1 - cosine**2)))
            low, high = middle - spread, middle + spread
            # Beyond the angle the interval reaches the pole of that coordinate.
            if unit[focus] >= cosine:
                high = 1.0
            if -unit[focus] >= cosine:
                low = -1.0
            column = self.sorted_units[:, focus]
            first = int(np.searchsorted(column, low - SLACK, side="left"))
            last = int(np.searchsorted(column, high + SLACK, side="right"))
            if last - first < best:
                best, best_places = last - first, self.by_coordinate[first:last, focus]
        return self.by_length[:best] if best_places is None else best_places


def best_in_bucket(bucket: Bucket, number: int, query: np.ndarray, least: float, k: int):
    """The k best (vec_id, score) of a bucket that reach `least`, ties to smaller vec_ids."""
    places = bucket.candidates(query, least)
    places = places[bucket.ids[places] != number]
    scores = bucket.products(query, places)
    keep = scores >= least
    places, scores = places[keep], scores[keep]
    if len(scores) > k:
        border = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= border
        places, scores = places[keep], scores[keep]
    ids = bucket.ids[places]
    if scores.dtype == object:
        order = sorted(range(len(ids)), key=lambda place: (-scores[place], ids[place]))[:k]
    else:
        order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The best of each pair of a query block and a bucket."""
    for batch in batches:
        for row in batch.to_pylist():
            query_ids, queries = matrix(row, "q")
            ids, vectors = matrix(row, "p")
            dims = max(queries.shape[1], vectors.shape[1])
            bucket, queries = Bucket(ids, widened(vectors, dims)), widened(queries, dims)
            known = dict(zip(row["known_ids"] or [], row["known_scores"] or []))
            found_queries, found_ids, found_scores = [], [], []
            for number, query in zip(query_ids.tolist(), queries):
                least = known.get(number, float("-inf"))
                best_ids, scores = best_in_bucket(bucket, number, query, least, k)
                found_queries.append(np.full(len(best_ids), number))
                found_ids.append(best_ids)
                found_scores.append(scores)
            yield pa.RecordBatch.from_pydict(
                {
                    "query_id": np.concatenate(found_queries).astype(np.int64),
                    "vec_id": np.concatenate(found_ids).astype(np.int64),
                    "score": np.concatenate(found_scores).astype(np.int64),
                }
            )


def named(blocks: DataFrame, prefix: str) -> DataFrame:
    return blocks.select([F.col(name).alias(f"{prefix}_{name}") for name in blocks.columns])


def top_k(
    table: DataFrame,
    is_query: Column,
    k: int,
    column: str = "embedding",
    scale: float = 256.0,
    bucket_rows: int = BUCKET_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The k best of all other vectors for each vector that `is_query` chooses by vec_id."""
    ready(table.sparkSession)
    vectors = integer_vectors(table, column, scale)
    measured = vectors.withColumn("length", length())
    count = measured.count()
    buckets = buckets_of(
        measured.repartitionByRange(
            max(1, -(-count // bucket_rows)), F.desc("length"), F.col("vec_id")
        ).sortWithinPartitions(F.desc("length"), "vec_id"),
        bucket_rows,
    )
    asked = vectors.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    blocks = max(1, -(-asked.count() // query_rows))
    queries = query_blocks(asked, blocks)

    # The longest bucket comes first in the order of blocks.
    first = buckets.agg(F.min("block")).first()[0]
    none = F.lit(None).cast("array<long>")

    def pairs(some: DataFrame, known: DataFrame) -> DataFrame:
        """Every block of queries with every bucket: the stated queries against all rows."""
        spread = named(some, "p").withColumn(
            "q_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
        )
        return spread.join(named(queries, "q"), "q_block").join(known, "q_block", "left")

    nothing = queries.select(F.col("block").alias("q_block")).select(
        "q_block", none.alias("known_ids"), none.alias("known_scores")
    )
    start = pairs(buckets.where(F.col("block") == F.lit(first)), nothing)
    ranked = start.select("*").mapInArrow(lambda batches: search(batches, k), FOUND)
    lower = ranked.groupBy("query_id").agg(
        F.count("*").alias("n"), F.min("score").alias("score")
    ).where(F.col("n") == k)
    numbered = queries.select("block", "ids").mapInArrow(query_numbers, "q_block long, query_id long")
    known = (
        numbered.join(lower, "query_id")
        .groupBy("q_block")
        .agg(
            F.collect_list("query_id").alias("known_ids"),
            F.collect_list("score").alias("known_scores"),
        )
    )
    known = written(known, "lower-bounds")
    found = pairs(buckets, known).mapInArrow(lambda batches: search(batches, k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def query_numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["ids"], np.int64)
            yield pa.RecordBatch.from_pydict(
                {"q_block": np.full(len(ids), row["block"], np.int64), "query_id": ids}
            )
