"""Near duplicates by an inverted join over the coordinates of MinHash signatures.

Documents of equal shingle sets are one node. A node has a signature of COORDINATES minima, and is
posted under every coordinate-value pair that another node shares. Two sets of the asked similarity
agree in at least `matches` coordinates but for a chance of MISS, so that:

- a node with fewer shared pairs than `matches` has no partner (skipped);
- of a node's shared pairs, rarest first, only all but `matches` - 1 are posted: the longest lists
  are skipped, and still every two nodes that agree often enough meet in a list (prefix).

Each list is joined with one hub, its most connected node, and the pairs are confirmed: collisions
of the signatures counted, then the full sets intersected. Lists whose nodes are then in several
components go on: their nodes are dealt into blocks, and every pair of blocks is one task that
confirms the pairs of different components, each in one list only, and returns the links of a
spanning forest. So no link between components is lost, and never are all pairs of a group written.

Defined results: a text without words has no set and is linked with nothing; a text of fewer words
than a shingle is one shingle; a row without doc_id is linked with nothing, has no component and is
kept; rows that repeat are in one component; an empty table gives no rows; columns other than doc_id
and text are not read.
"""

from __future__ import annotations

import dataclasses
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baleflow.llm.common import (
    GOLDEN,
    by_slice,
    give_back,
    ids_and_texts,
    mixed,
    one_array,
    ready,
    shingle_hashes,
    to_batches,
)
from baleflow.session import broadcast_if_small, written

#: Coordinates of a signature, and the chance at which a pair may agree in too few of them.
COORDINATES = 32
MISS = 1e-6
#: A block of a list holds about so many nodes, and so many shingles.
BLOCK_NODES = 1024
BLOCK_SHINGLES = 2_000_000
#: Sets take several times the bytes of their texts, which are read in slices of so many.
SET_BYTES = 2_000_000

SIGNED = "doc_id long, n_shingles long, node binary, signature binary"


@dataclasses.dataclass(frozen=True)
class Similarity:
    """Words in a shingle, and the similarity from which on two sets are linked, in percent."""

    width: int = 5
    percent: int = 80

    @property
    def matches(self) -> int:
        """Coordinates in which a linked pair agrees, but for a chance of MISS."""
        p, missed = self.percent / 100, 0.0
        for k in range(COORDINATES + 1):
            missed += math.comb(COORDINATES, k) * p**k * (1 - p) ** (COORDINATES - k)
            if missed > MISS:
                return max(k, 1)
        return COORDINATES

    def linked(self, common: int, size: int, other: int) -> bool:
        return 100 * common >= self.percent * (size + other - common)


def sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, counts = shingle_hashes(texts, width)
    ends = np.cumsum(counts)
    return [np.unique(hashes[end - n : end]) for end, n in zip(ends, counts)]


def node_of(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(groups: list[np.ndarray]) -> np.ndarray:
    """COORDINATES minima of each set; no set may be empty."""
    flat = np.concatenate(groups)
    sizes = np.array([len(group) for group in groups])
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(groups), COORDINATES), np.uint64)
    for k in range(COORDINATES):
        factor = mixed(np.array([k + 1], np.uint64) * GOLDEN)[0] | np.uint64(1)
        hashed = flat * factor
        hashed ^= hashed >> np.uint64(32)
        out[:, k] = np.minimum.reduceat(hashed, starts)
    return out


def signed(docs: DataFrame, width: int) -> DataFrame:
    def sign(part: pa.Table) -> list[pa.RecordBatch]:
        groups = sets(one_array(part, "text"), width)
        full = [group for group in groups if len(group)]
        minima = iter(signatures(full) if full else [])
        return to_batches(
            {
                "doc_id": one_array(part, "doc_id"),
                "n_shingles": np.array([len(group) for group in groups], np.int64),
                "node": pa.array([node_of(g) if len(g) else None for g in groups], pa.binary()),
                "signature": pa.array(
                    [next(minima).tobytes() if len(g) else None for g in groups], pa.binary()
                ),
            }
        )

    return ids_and_texts(docs).mapInArrow(by_slice(sign, SET_BYTES), SIGNED)


def tokens_of(signature: np.ndarray) -> np.ndarray:
    """One number for each coordinate-value pair of signatures."""
    salt = mixed(np.arange(1, COORDINATES + 1, dtype=np.uint64) * GOLDEN)
    return mixed(signature ^ salt).view(np.int64)


def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            joined = b"".join(batch["signature"].to_pylist())
            tokens = tokens_of(np.frombuffer(joined, np.uint64).reshape(-1, COORDINATES))
            places = pa.array(np.repeat(np.arange(batch.num_rows), COORDINATES))
            yield from to_batches({"node": batch["node"].take(places), "token": tokens.ravel()})


def postings(nodes: DataFrame, matches: int) -> DataFrame:
    """node, posted tokens and popularity of the nodes that may have a partner."""
    tokens = nodes.select("node", "signature").mapInArrow(exploded, "node binary, token long")
    # Written, so that the nodes of a frequent pair are split over tasks when they are joined.
    shared = written(tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"), "shared")
    per_node = (
        tokens.join(shared, "token")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("shared"))
        .where(F.size("shared") >= matches)
    )
    return per_node.select(
        "node",
        F.expr(f"slice(shared, 1, size(shared) - {matches - 1}).token").alias("tokens"),
        F.expr("aggregate(shared.n, 0L, (total, n) -> total + n)").alias("popularity"),
    )


def lists(posted: DataFrame) -> DataFrame:
    """One row per node and token it is posted under, of tokens with more than one node."""
    flat = posted.select("node", "popularity", F.explode("tokens").alias("token"))
    hubs = (
        flat.groupBy("token")
        .agg(F.max(F.struct("popularity", "node")).alias("hub"), F.count("*").alias("n"))
        .where("n > 1")
        .select("token", F.col("hub.node").alias("hub"))
    )
    hubs = written(hubs, "hubs")
    return flat.join(hubs, "token").select("token", "node", "hub")


def shingle_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """node and sorted shingles of the wanted nodes, read from one document each."""

    def with_shingles(part: pa.Table) -> list[pa.RecordBatch]:
        groups = sets(one_array(part, "text"), width)
        return to_batches(
            {
                "node": pa.array([node_of(group) for group in groups], pa.binary()),
                "shingles": pa.array([group.tobytes() for group in groups], pa.binary()),
            },
            rows=256,
        )

    ids = broadcast_if_small(wanted.select("doc_id"))
    texts = ids_and_texts(docs).join(ids, "doc_id", "left_semi")
    found = texts.mapInArrow(by_slice(with_shingles, SET_BYTES), "node binary, shingles binary")
    return found


def confirmed(pairs: DataFrame, full: DataFrame, similarity: Similarity) -> DataFrame:
    """The pairs (node, other) whose signatures collide often enough and whose sets are alike.

    full: node, signature and shingles.
    """
    matches, percent = similarity.matches, similarity.percent

    def collide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                one, two = (
                    np.frombuffer(b"".join(batch[name].to_pylist()), np.uint64)
                    for name in ("signature", "other_signature")
                )
                same = (one == two).reshape(-1, COORDINATES).sum(1) >= matches
                yield batch.filter(pa.array(same)).select(["node", "other"])

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = Similarity(similarity.width, percent)
        for batch in batches:
            keep = []
            for one, two in zip(batch["shingles"].to_pylist(), batch["other_shingles"].to_pylist()):
                a, b = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                keep.append(rule.linked(common_count(a, b), len(a), len(b)))
            if batch.num_rows:
                yield batch.filter(pa.array(keep, pa.bool_())).select(["node", "other"])

    signs = full.select("node", "signature")
    others = signs.withColumnsRenamed({"node": "other", "signature": "other_signature"})
    colliding = pairs.join(signs, "node").join(others, "other").mapInArrow(
        collide, "node binary, other binary"
    )
    content = full.select("node", "shingles")
    other_content = content.withColumnsRenamed({"node": "other", "shingles": "other_shingles"})
    return colliding.join(content, "node").join(other_content, "other").mapInArrow(
        alike, "node binary, other binary"
    )


def common_count(one: np.ndarray, two: np.ndarray) -> int:
    """The number of common members of two sorted arrays of distinct values."""
    if len(one) > len(two):
        one, two = two, one
    places = np.searchsorted(two, one)
    places[places == len(two)] = 0
    return int((two[places] == one).sum()) if len(two) else 0


def components(links: DataFrame) -> DataFrame:
    """node and label, the smallest node it is linked with by any chain; nodes of links only.

    Each round takes the smallest label among the neighbours, then the label of that label, so
    rounds grow with the logarithm of the longest chain. Tables of the rounds are in the shared
    folder.
    """
    edges = written(
        links.select("node", "other")
        .union(links.select(F.col("other"), F.col("node")))
        .distinct(),
        "edges",
    )
    labels = written(
        edges.groupBy("node").agg(F.min("other").alias("label")).select(
            "node", F.least("node", "label").alias("label")
        ),
        "labels",
    )
    while True:
        near = edges.join(labels.withColumnsRenamed({"node": "other"}), "other")
        lowest = near.groupBy("node").agg(F.min("label").alias("near"))
        stepped = labels.join(lowest, "node").select(
            "node", F.col("label").alias("before"), F.least("label", "near").alias("label")
        )
        ahead = labels.select(F.col("node").alias("label"), F.col("label").alias("ahead"))
        jumped = stepped.join(ahead, "label").select(
            "node", "before", F.least("label", "ahead").alias("label")
        )
        jumped = written(jumped, "labels")
        changed = jumped.where(F.col("before") != F.col("label")).limit(1).count()
        labels = jumped.select("node", "label")
        if not changed:
            return labels


def links_of_group(rows: pa.Table, similarity: Similarity) -> list[tuple[bytes, bytes]]:
    """Links between components among the nodes of one pair of blocks of one list, by node."""
    names = rows["label"].to_pylist()
    numbers = {name: number for number, name in enumerate(dict.fromkeys(names))}
    if len(numbers) == 1:
        return []
    token, first, second = (rows[name][0].as_py() for name in ("token", "i", "j"))
    labels = np.array([numbers[name] for name in names])
    block = rows["block"].to_numpy()
    nodes = rows["node"].to_pylist()
    signature = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint64)
    signature = signature.reshape(-1, COORDINATES)
    shingles = rows["shingles"]
    # Of the lists two nodes share, only that of the smallest token compares them.
    earlier = [{one for one in tokens if one < token} for tokens in rows["tokens"].to_pylist()]
    parent = list(range(len(numbers)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def own_set(place: int) -> np.ndarray:
        return np.frombuffer(shingles[place].as_py(), np.uint64)

    left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
    found = []
    for x in left.tolist():
        others = right[right > x] if first == second else right
        others = others[labels[others] != labels[x]]
        others = others[(signature[others] == signature[x]).sum(1) >= similarity.matches]
        mine = own_set(x) if len(others) else None
        for y in others.tolist():
            a, b = root(int(labels[x])), root(int(labels[y]))
            if a == b or not earlier[x].isdisjoint(earlier[y]):
                continue
            other = own_set(y)
            if similarity.linked(common_count(mine, other), len(mine), len(other)):
                parent[max(a, b)] = min(a, b)
                found.append((nodes[x], nodes[y]))
    return found


def links_of_groups(
    batches: Iterator[pa.RecordBatch], similarity: Similarity
) -> Iterator[pa.RecordBatch]:
    """The links of all groups of a partition, whose rows come group by group."""
    held: list[pa.RecordBatch] = []

    def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        found = links_of_group(pa.Table.from_batches(parts).combine_chunks(), similarity)
        return pa.RecordBatch.from_pydict(
            {
                "node": pa.array([one for one, _ in found], pa.binary()),
                "other": pa.array([two for _, two in found], pa.binary()),
            }
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch[name].to_numpy() for name in ("token", "i", "j")])
        if held:
            last = [held[-1][name][-1].as_py() for name in ("token", "i", "j")]
            if (keys[0] != last).any():
                yield links(held)
                held = []
        starts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        borders = [0, *starts.tolist(), batch.num_rows]
        for begin, end in zip(borders, borders[1:]):
            if begin and held:
                yield links(held)
                held = []
            held.append(batch.slice(begin, end - begin))
    if held:
        yield links(held)
        held.clear()
    give_back()


def between_components(
    listed: DataFrame, posted: DataFrame, full: DataFrame, labels: DataFrame, similarity: Similarity
) -> DataFrame:
    """Links that join components, out of the lists whose nodes are in several."""
    own = F.coalesce("label", "node").alias("label")
    marked = (
        listed.select("token", "node")
        .join(labels, "node", "left")
        .join(full.select("node", "n_shingles"), "node")
        .select("token", "node", own, "n_shingles")
    )
    open_lists = (
        marked.groupBy("token")
        .agg(
            F.min("label").alias("low"),
            F.max("label").alias("high"),
            F.count("*").alias("n"),
            F.sum("n_shingles").alias("size"),
        )
        .where(F.col("low") != F.col("high"))
        .select(
            "token",
            F.greatest(
                F.ceil(F.col("n") / BLOCK_NODES), F.ceil(F.col("size") / BLOCK_SHINGLES)
            ).cast("int").alias("blocks"),
        )
    )
    open_lists = written(open_lists, "open-lists")
    dealt = marked.join(open_lists, "token").withColumn(
        "block", F.pmod(F.xxhash64("node", "token"), F.col("blocks")).cast("int")
    )
    spread = dealt.select(
        "token", "node", "label", "block",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with"),
    )
    sides = spread.select(
        "token", "node", "label", "block",
        F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"),
    )
    complete = sides.join(posted.select("node", "tokens"), "node").join(
        full.select("node", "signature", "shingles"), "node"
    )
    # Group by group, one after another: most lists are of a few nodes.
    grouped = complete.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "node")
    return grouped.mapInArrow(
        lambda batches: links_of_groups(batches, similarity), "node binary, other binary"
    )


def near_duplicates(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row for each row of the documents."""
    spark = ready(docs.sparkSession)
    signs = written(signed(docs, similarity.width), "signatures")
    nodes = (
        signs.where(F.col("node").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("node")
        .agg(
            F.min("doc_id").alias("doc_id"),
            F.max("n_shingles").alias("n_shingles"),
            F.min("signature").alias("signature"),
        )
    )
    posted = written(postings(nodes, similarity.matches), "postings")
    listed = written(lists(posted), "lists")
    wanted = nodes.join(listed.select("node").distinct(), "node", "left_semi")
    wanted = written(wanted, "wanted")
    content = shingle_sets(docs, wanted, similarity.width).dropDuplicates(["node"])
    full = written(wanted.join(content, "node"), "sets")

    pairs = listed.where(F.col("node") != F.col("hub")).select(
        "node", F.col("hub").alias("other")
    ).distinct()
    links = written(confirmed(pairs, full, similarity), "links")
    labels = components(links)
    more = written(between_components(listed, posted, full, labels, similarity), "more-links")
    if not more.isEmpty():
        labels = components(links.union(more))

    lowest = (
        labels.join(wanted.select("node", "doc_id"), "node")
        .groupBy("label")
        .agg(F.min("doc_id").alias("lowest"))
    )
    linked = labels.join(lowest, "label").select("node", "lowest")
    alone = nodes.join(labels, "node", "left_anti").select("node", F.col("doc_id").alias("lowest"))
    by_node = linked.union(alone)
    with_ids = signs.where(F.col("doc_id").isNotNull()).select("doc_id", "n_shingles", "node")
    found = with_ids.join(by_node, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("lowest", "doc_id").alias("component_id")
    )
    without_ids = signs.where(F.col("doc_id").isNull()).select(
        "doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id")
    )
    return found.union(without_ids).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def one_of_each(docs: DataFrame, similarity: Similarity) -> DataFrame:
    """The documents without near duplicates of others, with all their columns.

    Of each component the document of the smallest doc_id stays, and of rows that share a doc_id one.
    """
    found = near_duplicates(docs, similarity)
    dropped = found.where(~F.col("kept")).select("doc_id").distinct()
    dropped = broadcast_if_small(written(dropped, "near-duplicates"))
    twice = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    twice = written(twice.select("doc_id"), "repeated-ids")
    rest = docs.join(dropped, "doc_id", "left_anti").select(docs.columns)
    if twice.isEmpty():
        return rest
    once = rest.join(twice, "doc_id", "left_anti").select(docs.columns)
    first = rest.join(twice, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return once.union(first.select(docs.columns))
