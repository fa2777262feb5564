"""Hard negatives by the threshold algorithm: rows of another label that score near an anchor's positives.

Vectors are kept in blocks of one range of labels, with a list of the block's rows for each dimension,
sorted by that component. For an anchor the lists are read from their high end where its own component is
positive, from the low end where it is negative. A row met in any list is scored at once as a whole, by
the integer product. What a list shows last, times the anchor's component and summed over all
dimensions, is the threshold: no row that was not met scores more. Reading stops when the threshold is
strictly below the k-th score of every window that is asked for, or below its lower end; strictly, since
a row that was not met may tie and have the smaller id.

First the positives are found, in the blocks that hold the anchor's label, with one window without ends.
Each positive then gives the window of scores its negatives must be in. Anchors are dealt into groups and
blocks into spans; a task reads one span for one group, block after block, and takes what the blocks
before have found along. So what is written is at most k rows for each window and span, never a row for
each pair. The anchors are a stated query set that must meet all rows.

Products are taken in floating point as long as every partial sum is a whole number it can hold, else
in integers of any length.

Defined results: rows with a null id, label or vector, or with a null or non-finite component take no
part; a missing component of a shorter vector counts as zero; rows of one id are candidates each for
itself, and none of them for an anchor of their id, which is one anchor (of its smallest label and
vector); a score that does not fit 64 bits, or a component that does not fit a double once it is scaled,
fails the job; an empty table gives no rows; columns other
than id, vector and label are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baleflow.llm.common import ready
from baleflow.operators.long_keys import number_by
from baleflow.session import broadcast_if_small, written

#: Rows of a block, whose sorted lists are held together; blocks of a span; anchors of a group.
BLOCK_ROWS = 8192
SPAN_BLOCKS = 4
GROUP_ROWS = 1024
#: Entries read from each list in the first round; every further round reads GROWTH times as many.
FIRST = 16
GROWTH = 4

BLOCK = "rows int, dims int, low_label long, high_label long, ids binary, labels binary, vectors binary, kind string"
FOUND = "anchor_id long, place int, vec_id long, score long"
EVERY = (float("-inf"), float("inf"))


def usable(table: DataFrame, column: str, label: Column) -> DataFrame:
    """vec_id, label and vector (doubles) of the rows that take part."""
    vector = F.col(column).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = table.select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), vector.alias("vector"),
        F.coalesce(finite, F.lit(False)).alias("finite"),
    )
    return rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND finite").drop("finite")


def stored(vectors: np.ndarray) -> tuple[bytes, str]:
    """Whole numbers in the smallest of three kinds that holds them."""
    largest = np.abs(vectors).max(initial=0)
    kind = "<i2" if largest < 2**15 else "<i4" if largest < 2**31 else "<f8"
    return vectors.astype(kind).tobytes(), kind


def blocks_of(rows: DataFrame, scale: float, most: int) -> DataFrame:
    """The rows of every partition, one after another, in blocks of whole-number vectors."""

    def block(held: list[tuple]) -> dict:
        dims = max((len(vector) for _, _, vector in held), default=0)
        vectors = np.zeros((len(held), dims))
        for place, (_, _, vector) in enumerate(held):
            vectors[place, : len(vector)] = vector
        scaled = np.floor(vectors * scale)
        if not np.isfinite(scaled).all():
            raise OverflowError("a scaled component does not fit a double")
        data, kind = stored(scaled)
        labels = np.array([label for _, label, _ in held], np.int64)
        return {
            "rows": len(held), "dims": dims, "low_label": int(labels.min()), "high_label": int(labels.max()),
            "ids": np.array([number for number, _, _ in held], np.int64).tobytes(), "labels": labels.tobytes(),
            "vectors": data, "kind": kind,
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            columns = [batch[name].to_pylist() for name in ("vec_id", "label", "vector")]
            for row in zip(*columns):
                held.append(row)
                if len(held) == most:
                    yield as_batch(block(held))
                    held = []
        if held:
            yield as_batch(block(held))

    return rows.select("vec_id", "label", "vector").mapInArrow(run, BLOCK)


def numbered_blocks(
    rows: DataFrame, scale: float, count: int, most: int, name: str, to_one: int = 1
) -> DataFrame:
    """Blocks of `most` rows at most in the order of their labels, numbered 0, 1, ..., `to_one` to a number."""
    parts = max(1, ceil(count / most))
    dealt = rows.repartitionByRange(parts, "label", F.xxhash64("vec_id"), "vec_id")
    packed = blocks_of(dealt.sortWithinPartitions("label"), scale, most)
    packed = written(packed.withColumn("block", F.monotonically_increasing_id()), "blocks")
    places = number_by(packed.select(F.lit(0).alias("all"), "block"), "all", ["block"])
    number = F.expr(f"(seq - 1) div {to_one}").alias(name)
    return packed.join(broadcast_if_small(written(places.select("block", number), "places")), "block").drop("block")


def as_batch(row: dict) -> pa.RecordBatch:
    kinds = {"rows": pa.int32(), "dims": pa.int32(), "low_label": pa.int64(), "high_label": pa.int64()}
    kinds |= {"ids": pa.binary(), "labels": pa.binary(), "vectors": pa.binary(), "kind": pa.string()}
    return pa.RecordBatch.from_pydict({name: pa.array([row[name]], kind) for name, kind in kinds.items()})


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(row["rows"], row["dims"])
    return np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64), vectors


def integers(vectors: np.ndarray) -> np.ndarray:
    """As Python integers, which products of any size fit into."""
    out = np.empty(vectors.shape, object)
    for place, value in np.ndenumerate(vectors):
        out[place] = int(value)
    return out


class Lists:
    """The rows of a block in a list for each dimension, and their products with a vector."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels = ids, labels
        self.largest = float(np.abs(vectors.astype(np.float64)).max(initial=0))
        self.order = np.argsort(vectors, axis=0, kind="stable").T  # by dimension, ascending
        self.plain, self.kinds = vectors, {}

    def vectors(self, query: np.ndarray) -> np.ndarray:
        """The vectors in the cheapest numbers that hold every product with `query` exactly."""
        bound = self.largest * float(np.abs(query.astype(np.float64)).max(initial=0)) * max(len(query), 1)
        kind = "f4" if bound < 2**24 else "f8" if bound < 2**53 else "integers"
        if kind not in self.kinds:
            exact = integers(self.plain) if kind == "integers" else self.plain.astype(kind)
            self.kinds[kind] = exact
        return self.kinds[kind]

    def search(self, query: np.ndarray, allowed: np.ndarray, windows: Windows) -> None:
        """Show `windows` the scores of allowed rows until it needs no more."""
        vectors = self.vectors(query)
        query = integers(query) if vectors.dtype == object else query.astype(vectors.dtype)
        n, dims = len(self.ids), min(len(query), vectors.shape[1])
        vectors, query = vectors[:, :dims], query[:dims]
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        if not len(up) and not len(down):
            windows.show(self.ids[allowed], np.zeros(int(allowed.sum()), np.int64))
            return

        def threshold(depth: int):
            """What a row that no list has shown down to `depth` can score at most."""
            last = np.concatenate([self.order[up, n - 1 - depth], self.order[down, depth]])
            at = np.concatenate([up, down])
            shown = vectors[last, at]
            if vectors.dtype == object:
                return sum(shown * query[at])
            return float(shown.astype(np.float64) @ query[at].astype(np.float64))

        if windows.settled(threshold(0)):
            return
        unseen = allowed.copy()
        depth, stop = 0, min(FIRST, n)
        while True:
            met = np.zeros(n, bool)
            met[self.order[up, n - stop : n - depth]] = True
            met[self.order[down, depth:stop]] = True
            fresh = np.flatnonzero(met & unseen)
            unseen[fresh] = False
            if len(fresh):
                # Many rows at once are cheaper to score where they lie.
                many = len(fresh) > n // 4
                scores = (vectors @ query)[fresh] if many else vectors[fresh] @ query
                windows.show(self.ids[fresh], scores)
            if stop == n or not unseen.any() or windows.settled(threshold(stop - 1)):
                return
            depth, stop = stop, min(stop * GROWTH, n)


class Windows:
    """The k best rows within each of some ranges of scores, ties to smaller ids."""

    def __init__(self, ranges: list[tuple], k: int):
        self.ranges, self.k = ranges, k
        self.found: list[list[tuple]] = [[] for _ in ranges]  # (-score, id), in order
        self.tally()

    def tally(self) -> None:
        #: What a row must score to matter to a window (none does if it is empty), and to any of them.
        self.needed = [
            float("inf") if low > high else -found[-1][0] if len(found) == self.k else low
            for found, (low, high) in zip(self.found, self.ranges)
        ]
        self.least = min(self.needed, default=float("inf"))

    def settled(self, threshold) -> bool:
        """Can no row of at most this score change a window?"""
        return all(threshold < needed for needed in self.needed)

    def show(self, ids: np.ndarray, scores: np.ndarray) -> None:
        keep = scores >= self.least
        if not keep.any():
            return
        ids, scores = ids[keep], scores[keep]
        order = np.lexsort((ids, -scores)) if scores.dtype != object else sorted(
            range(len(ids)), key=lambda place: (-scores[place], ids[place])
        )
        falling = -scores[order]
        ids = ids[order]
        for place, (low, high) in enumerate(self.ranges):
            first = int(np.searchsorted(falling, -high, side="left"))
            stop = min(int(np.searchsorted(falling, -low, side="right")), first + self.k)
            if first < stop:
                best = zip(map(int, falling[first:stop]), ids[first:stop].tolist())
                self.found[place] = sorted([*self.found[place], *best])[: self.k]
        self.tally()


def found_batch(anchors: list[tuple[int, Windows]]) -> pa.Table:
    rows = [
        (number, place, vec_id, -negated)
        for number, windows in anchors
        for place, found in enumerate(windows.found)
        for negated, vec_id in found
    ]
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    kinds = {"anchor_id": pa.int64(), "place": pa.int32(), "vec_id": pa.int64(), "score": pa.int64()}
    return pa.table({name: pa.array(column, kind) for (name, kind), column in zip(kinds.items(), columns)})


def searcher(k: int, same_label: bool, ranges_of):
    """Search the blocks of a span for the anchors of a group."""

    def run(blocks: pa.Table, groups: pa.Table) -> pa.Table:
        anchors = []
        for row in groups.to_pylist():
            ids, labels, vectors = unpacked(row)
            asked = ranges_of(row, ids)
            anchors += [
                (int(ids[place]), int(labels[place]), vectors[place], Windows(ranges, k))
                for place, ranges in asked
            ]
        for number in range(blocks.num_rows):
            lists = Lists(*unpacked(blocks.slice(number, 1).to_pylist()[0]))
            for vec_id, label, query, windows in anchors:
                allowed = (lists.labels == label) == same_label
                allowed &= lists.ids != vec_id
                if allowed.any():
                    lists.search(query, allowed, windows)
        return found_batch([(vec_id, windows) for vec_id, _, _, windows in anchors])

    return run


def met(blocks: DataFrame, groups: DataFrame, pairs: DataFrame, run) -> DataFrame:
    """Each span with the groups of anchors it is paired with."""
    pairs = broadcast_if_small(written(pairs, "pairs"))
    left = blocks.join(pairs, "span").groupBy("group", "span")
    return left.cogroup(groups.join(pairs, "group").groupBy("group", "span")).applyInArrow(run, FOUND)


def labels_of(blocks: DataFrame, name: str) -> DataFrame:
    """The labels of each span or group, once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, labels in zip(batch[name].to_pylist(), batch["labels"].to_pylist()):
                own = np.unique(np.frombuffer(labels, np.int64))
                yield pa.RecordBatch.from_pydict({name: np.full(len(own), number, np.int64), "label": own})

    return blocks.select(name, "labels").mapInArrow(run, f"{name} long, label long").distinct()


def best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def window_of(score: int, window: tuple[int, int]) -> tuple[int, int]:
    """The whole scores s with low * score <= 100 * s <= high * score; none if the first is larger."""
    low, high = window
    return -(-low * score // 100), high * score // 100


def hard_negatives(
    table: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    column: str = "embedding",
    scale: float = 256.0,
    block_rows: int = BLOCK_ROWS,
    span_blocks: int = SPAN_BLOCKS,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `is_anchor` chooses anchors by vec_id; `label` is the label of a row, made of its columns; a
    negative scores between the two percentages of `window` of the positive.
    """
    ready(table.sparkSession)
    rows = usable(table, column, label)

    blocks = numbered_blocks(rows, scale, rows.count(), block_rows, "span", span_blocks)
    smallest = F.min(F.struct("label", "vector")).alias("first")
    asked = rows.where(is_anchor).groupBy("vec_id").agg(smallest).select("vec_id", "first.*")
    groups = numbered_blocks(asked, scale, asked.count(), group_rows, "group")

    by_label = labels_of(blocks, "span").join(labels_of(groups, "group"), "label")
    near = by_label.select("group", "span").distinct()
    everything = searcher(positives, True, lambda row, ids: [(place, [EVERY]) for place in range(len(ids))])
    nearest = best(met(blocks, groups, near, everything), ["anchor_id"], positives)
    nearest = written(
        nearest.select("anchor_id", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )

    # The positives' scores stand beside the block of their anchors.
    scores = nearest.groupBy("anchor_id").agg(
        F.sort_array(F.collect_list(F.struct("rank", "positive_score"))).alias("asked")
    )
    members = groups.select("group", "ids").mapInArrow(members_of, "group long, anchor_id long")
    told = members.join(scores, "anchor_id").groupBy("group").agg(
        F.collect_list(F.struct("anchor_id", F.col("asked.positive_score").alias("scores"))).alias("asked")
    )
    asked_groups = written(groups.join(told, "group"), "asked")

    def ranges(row: dict, ids: np.ndarray) -> list[tuple]:
        scores = {one["anchor_id"]: one["scores"] for one in row["asked"]}
        wanted = [(place, scores[number]) for place, number in enumerate(ids.tolist()) if number in scores]
        return [(place, [window_of(score, window) for score in own]) for place, own in wanted]

    # Spans that hold the group's label only have no negatives for it.
    held = blocks.groupBy("span").agg(F.min("low_label").alias("low"), F.max("high_label").alias("high"))
    last = groups.agg(F.max("group")).first()[0]
    every = F.array(*[]).cast("array<long>")
    if last is not None:
        every = F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))
    spread = held.withColumn("group", F.explode(every))
    own = asked_groups.select("group", "low_label", "high_label")
    one = (F.col("low") == F.col("high")) & (F.col("low_label") == F.col("high_label"))
    far = spread.join(own, "group").where(~(one & (F.col("low") == F.col("low_label")))).select("group", "span")
    found = best(met(blocks, asked_groups, far, searcher(negatives, False, ranges)), ["anchor_id", "place"], negatives)
    found = found.select(
        "anchor_id", (F.col("place") + 1).alias("of"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("score").alias("negative_score"),
    )
    nearest = nearest.withColumnRenamed("rank", "of")
    return nearest.join(found, ["anchor_id", "of"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def members_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for number, ids in zip(batch["group"].to_pylist(), batch["ids"].to_pylist()):
            own = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_pydict({"group": np.full(len(own), number, np.int64), "anchor_id": own})
