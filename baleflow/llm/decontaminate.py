"""Benchmark decontamination by SimHash over item-sized windows, in DataFrame functions only.

Words are runs of letters and digits, in lower case. A document is contaminated by an item if one of
its windows of as many words as the item has at least `percent` percent weighted similarity with it:
both are bags of five-word shingles, of weight equal to their number, and the similarity is the sum
of the smaller weights over the sum of the larger ones.

1. Windows: one that is alike has nearly all of the item's shingles. Of an item's shingles, rarest
   first, it has one of the first few (prefix); documents that do have their hits on the item's
   shingles listed, and every window with enough of them is kept. No alike window is lost.
2. Each window gets the 64-bit SimHash of all its shingles, as each item has one. Fingerprints are cut
   into RADIUS + 1 blocks, and windows join items of their size on equal blocks, so every pair
   within RADIUS bits meets.
3. The pairs within RADIUS are verified by their exact weighted similarity.

A document of fewer shingles than the item has no such window. `clean` takes the whole of it for one, of
its own size, and compares it exactly; `matches` does so with `short`, and without it is what the SQL
of its query defines.

Two bags of similarity 0.8 differ in 10 of 64 bits on average; more than RADIUS bits differ in less
than one of a thousand such pairs, and in fewer of pairs that are more alike.

Defined results: a null or empty text is clean; items without words match nothing; items of fewer
words than a shingle are one shingle; rows that repeat or have no doc_id are checked each for itself,
and give one result for each doc_id and item; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baleflow.llm.common import ready
from baleflow.session import broadcast_if_small, written

WIDTH = 5
BITS = 64
RADIUS = 19
#: Stands for the doc_id of rows that have none.
NO_KEY = -(1 << 63)


def words(text: str) -> Column:
    pieces = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_remove(pieces, "")


def shingle(words: str, place: str, width: int) -> Column:
    """The hash of the `width` words from a place (counted from 0) on."""
    return F.expr(
        "xxhash64(" + ", ".join(f"get({words}, {place} + {k})" for k in range(width)) + ")"
    )


def shingles(words: str, width: int) -> Column:
    """The hashes of all runs of `width` words."""
    hashed = ", ".join(f"get({words}, i + {k})" for k in range(width))
    return F.expr(
        f"CASE WHEN size({words}) >= {width} THEN "
        f"transform(sequence(0, size({words}) - {width}), i -> xxhash64({hashed})) "
        f"ELSE cast(array() AS array<bigint>) END"
    )


def needed(size: str, percent: int) -> Column:
    """Common shingles of two bags of `size` shingles that are alike: I / (2 m - I) >= percent."""
    return F.expr(f"cast(ceil(2 * {percent} * {size} / {100 + percent}) AS int)")


def fingerprint(bag: str) -> Column:
    """The SimHash of an array of hashes: each bit as most of them have it."""
    bits = (
        f"transform(sequence(0, {BITS - 1}), b -> "
        f"CASE WHEN 2 * aggregate({bag}, 0, (n, x) -> n + cast(shiftright(x, b) & 1 AS int))"
        f" > size({bag}) THEN shiftleft(1L, b) ELSE 0L END)"
    )
    return F.expr(f"aggregate({bits}, 0L, (all, bit) -> all | bit)")


def blocks(value: str) -> Column:
    """RADIUS + 1 pieces of a fingerprint, as (number, bits): within RADIUS bits one is equal."""
    count = RADIUS + 1
    borders = [BITS * k // count for k in range(count + 1)]
    pieces = ", ".join(
        f"struct({k} AS number, shiftrightunsigned({value}, {low}) & {(1 << (high - low)) - 1}L AS bits)"
        for k, (low, high) in enumerate(zip(borders, borders[1:]))
    )
    return F.expr(f"array({pieces})")


def common_weight(bag: str, other: str) -> Column:
    """The number of common members of two bags, by multiplicity."""
    each = f"least(size(filter({bag}, x -> x = h)), size(filter({other}, x -> x = h)))"
    return F.expr(f"aggregate(array_distinct({other}), 0, (n, h) -> n + {each})")


def items(benchmark: DataFrame, width: int, percent: int) -> DataFrame:
    """Item numbers of equal texts, their shingles and how many of them a window must have."""
    worded = benchmark.where(F.col("item_id").isNotNull()).select("item_id", words("text").alias("words"))
    # Items of fewer words than WIDTH are one shingle of all their words.
    chosen = worded.where(F.least(F.size("words"), F.lit(WIDTH)) == width)
    return (
        chosen.select("item_id", shingles("words", width).alias("bag"))
        .withColumn("size", F.size("bag"))
        .withColumn("needed", needed("size", percent))
    )


def hits(rows: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Places in the documents of shingles that some item has, and the documents' number of shingles."""
    placed = rows.where(F.size("words") >= width).select(
        "key", "twin", "words", F.explode(F.expr(f"sequence(0, size(words) - {width})")).alias("place")
    )
    total = (F.size("words") - (width - 1)).alias("total")
    hashed = placed.select("key", "twin", total, "place", shingle("words", "place", width).alias("hash"))
    return hashed.join(wanted, "hash", "left_semi").distinct()


def counted_shingles(bags: DataFrame) -> DataFrame:
    """The distinct shingles of each item, and how often it has them."""
    of_item = bags.select("item_id", "size", "needed", F.explode("bag").alias("hash"))
    return of_item.groupBy("item_id", "size", "needed", "hash").agg(F.count("*").alias("n"))


def first_shingles(counted: DataFrame) -> DataFrame:
    """The rarest shingles of each item: with none of them, fewer than `needed` of all are left."""
    spread = counted.groupBy("hash").agg(F.count("*").alias("items"))
    order = Window.partitionBy("item_id").orderBy("items", "hash")
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return (
        counted.join(spread, "hash")
        .withColumn("before", F.coalesce(before, F.lit(0)))
        .where(F.col("before") <= F.col("size") - F.col("needed"))
        .select("item_id", "size", "hash")
    )


def short_documents(found: DataFrame, bags: DataFrame, percent: int) -> DataFrame:
    """Documents of fewer shingles than an item that are alike to it as a whole, as `verified` has them."""
    # Of n < m shingles at most n are common, so at least `percent` of the item's are.
    least = F.expr(f"cast(ceil({percent} * size / 100) AS int)")
    counted = counted_shingles(bags.withColumn("needed", least))
    fits = (F.col("total") < F.col("size")) & (100 * F.col("total") >= percent * F.col("size"))
    pairs = found.join(first_shingles(counted), "hash").where(fits)
    pairs = pairs.select("key", "twin", "item_id").distinct()
    own = found.groupBy("key", "twin", "total", "hash").agg(F.count("*").alias("times"))
    common = (
        pairs.join(counted, "item_id")
        .join(own, ["key", "twin", "hash"])
        .groupBy("key", "twin", "item_id", "size", "total")
        .agg(F.sum(F.least("n", "times")).cast("int").alias("common"))
    )
    return common.where(
        (100 + percent) * F.col("common") >= percent * (F.col("total") + F.col("size"))
    ).select("key", "twin", "item_id", "common", F.lit(0).alias("start"), "size")


def windows(found: DataFrame, bags: DataFrame) -> DataFrame:
    """key, twin, size and start of all windows with as many hits as an alike one must have."""
    counted = counted_shingles(bags)
    prefix = first_shingles(counted)
    pairs = found.join(prefix, "hash").select("key", "twin", "item_id").distinct()
    listed = (
        pairs.join(counted, "item_id")
        .join(found, ["key", "twin", "hash"])
        .groupBy("key", "twin", "item_id", "size", "needed")
        .agg(F.sort_array(F.collect_set("place")).alias("at"))
        .where(F.size("at") >= F.col("needed"))
    )
    # Between two hits a window may start where it still holds the hit that completes it.
    starts = F.expr(
        "flatten(transform(sequence(0, size(at) - needed), i -> CASE"
        " WHEN get(at, i + needed - 1) - size + 1 <= get(at, i) THEN"
        " sequence(greatest(get(at, i + needed - 1) - size + 1, coalesce(get(at, i - 1), -1) + 1),"
        " get(at, i)) ELSE cast(array() AS array<int>) END))"
    )
    return listed.select("key", "twin", "size", F.explode(starts).alias("start")).distinct()


def contaminated(
    docs: DataFrame, benchmark: DataFrame, percent: int, short: bool
) -> DataFrame | None:
    """key (of rows without doc_id: NO_KEY), twin, item_id, common, start and size of alike windows."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("key"), F.xxhash64(text).alias("twin"), words("text").alias("words")
    ).withColumn("key", F.coalesce("key", F.lit(NO_KEY)))
    least = F.least(F.size("words"), F.lit(WIDTH))
    widths = benchmark.select(words("text").alias("words")).select(least.alias("width")).distinct()
    out = None
    for width in sorted(row["width"] for row in widths.collect() if row["width"]):
        bags = written(items(benchmark, width, percent), "items")
        wanted = written(bags.select(F.explode("bag").alias("hash")).distinct(), "item-shingles")
        found = written(hits(rows, broadcast_if_small(wanted), width), "hits")
        chosen = written(windows(found, bags), "windows")
        alike = verified(rows, chosen, bags, width, percent)
        # Items of fewer words than WIDTH are one shingle: no document has fewer.
        if short and width == WIDTH:
            alike = alike.union(short_documents(found, bags, percent))
        out = alike if out is None else out.union(alike)
    return out


def matches(
    docs: DataFrame, benchmark: DataFrame, percent: int = 80, short: bool = False
) -> DataFrame:
    """doc_id, item_id, n_common, n_shingles and start_word of each item's best window in a document.

    One row for each document and item that contaminates it; `short` adds those of fewer shingles.
    """
    spark = ready(docs.sparkSession)
    out = contaminated(docs, benchmark, percent, short)
    if out is None:
        schema = "doc_id long, item_id long, n_common int, n_shingles int, start_word int"
        return spark.createDataFrame([], schema)
    best = F.max(F.struct("common", -F.col("start"), "size"))
    key = F.when(F.col("key") != F.lit(NO_KEY), F.col("key"))
    return out.groupBy("key", "item_id").agg(best.alias("best")).select(
        key.alias("doc_id"), "item_id", F.col("best.common").alias("n_common"),
        F.col("best.size").alias("n_shingles"), (-F.col("best.col2")).alias("start_word"),
    )


def verified(
    rows: DataFrame, chosen: DataFrame, bags: DataFrame, width: int, percent: int
) -> DataFrame:
    """Pairs of windows and items within RADIUS bits whose exact similarity is large enough."""
    keys = written(chosen.select("key", "twin").distinct(), "window-keys")
    some = rows.join(broadcast_if_small(keys), ["key", "twin"], "left_semi").dropDuplicates(["key", "twin"])
    bagged = some.select("key", "twin", shingles("words", width).alias("all"))
    # A window may begin before the first word or run over the last by its missing shingles.
    inside = (F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.size("all"))
    cut = (
        chosen.join(bagged, ["key", "twin"])
        .where(inside)
        .select("key", "twin", "size", "start", F.expr("slice(all, start + 1, size)").alias("window"))
    )
    signed = written(cut.withColumn("print", fingerprint("window")), "signed")
    prints = bags.withColumn("item_print", fingerprint("bag"))
    left = signed.select(
        "key", "twin", "size", "start", "print", F.explode(blocks("print")).alias("block")
    )
    right = prints.select("item_id", "size", "item_print", F.explode(blocks("item_print")).alias("block"))
    near = (
        left.join(right, ["size", "block"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select("key", "twin", "size", "start", "item_id")
        .distinct()
    )
    return (
        near.join(signed.select("key", "twin", "size", "start", "window"), ["key", "twin", "size", "start"])
        .join(bags.select("item_id", "bag"), "item_id")
        .withColumn("common", common_weight("window", "bag"))
        .where((100 + percent) * F.col("common") >= 2 * percent * F.col("size"))
        .select("key", "twin", "item_id", "common", "start", "size")
    )


def clean(docs: DataFrame, benchmark: DataFrame, percent: int = 80) -> DataFrame:
    """The documents that no item contaminates, also not a short one as a whole, with all their columns.

    Rows without doc_id are dropped each by its text.
    """
    ready(docs.sparkSession)
    out = contaminated(docs, benchmark, percent, True)
    if out is None:
        return docs
    found = written(out.select("key", "twin").distinct(), "contaminated")
    ids = found.where(F.col("key") != NO_KEY).select(F.col("key").alias("doc_id")).distinct()
    left = docs.join(broadcast_if_small(written(ids, "contaminated-ids")), "doc_id", "left_anti")
    texts = written(found.where(F.col("key") == NO_KEY).select("twin"), "contaminated-texts")
    # Of null for rows with a doc_id, which so meet none.
    twin = F.when(docs["doc_id"].isNull(), F.xxhash64(F.coalesce(docs["text"], F.lit(""))))
    left = left.join(broadcast_if_small(texts), twin == texts["twin"], "left_anti")
    return left.select(docs.columns)
