"""Mixing sources to target weights by entropy balancing.

The sources, in code point order with the missing one last, get weights that repeat, and share a part
of all words by weight; a source stops at `most` times its own words, and what it leaves is shared by
the others. A document is then taken at a rate: of all rates that give its source the target, and
are at most `most`, those nearest to one for every document in relative entropy. They are

    rate = min(most, exp(tilt * size / mean size of the source))

and the tilts solve a convex dual, which is one equation for each source. Newton steps for all sources
at once are an aggregation over the cells (source, size), since a rate depends on nothing else; a
step that leaves the bracket of a source, or betters it too little, is halved into it instead.

Rates become whole copies cell by cell, the largest documents first: a cell takes over what the cells
before it have left of the words the rates ask for, so a source ends within half of one of its
smallest documents of its target, unless a cell runs out. Which documents of a cell get a further copy
goes by a hash of the document.

Sums are taken over whole numbers and do not depend on the order of rows, so reruns agree. What one
task holds of a source is its cells, at most the root of twice its words. Cells of any number of
documents are numbered over many tasks (`number_by`).

Defined results: a null text has no words, and documents without words are never taken; rows that
repeat are documents each for itself; a null doc_id is kept; a table without words has targets of
zero; an empty table gives no rows; further columns, also with clashing names, are kept by `mixed`.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baleflow.llm.common import ready
from baleflow.operators.long_keys import number_by
from baleflow.session import broadcast_if_small, written

WEIGHTS = (5, 2, 1)
#: Words are runs of anything but ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
#: Words of a cell are summed in whole parts of one by this.
PARTS = 1 << 36
#: Newton steps end when every source is this near to its target, relative to it, or its bracket is
#: this narrow.
NEAR = 1e-9
#: A bound that is never reached: a bracket of 2e6 is halved to nothing in fewer.
STEPS = 200
WIDEST = 1e6

CELLS = "source string, size long, base int, more long"


def size_of(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(cells: DataFrame, weights: Sequence[int], share: tuple[int, int], most: int) -> DataFrame:
    """source, source_size, documents with words, target (double), full (it stops at `most` times).

    `share` is the part of all words that is shared, as a fraction of whole numbers.
    """
    summed = cells.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"),
        F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("held"),
    )
    named = written(summed, "sources")
    keyed = named.withColumns({"all": F.lit(0), "missing": F.col("source").isNull()})
    place = (F.col("seq") - 1) % len(weights) + 1
    weighed = F.element_at(F.array(*map(F.lit, weights)), place.cast("int"))
    sources = written(
        number_by(keyed, "all", ["missing", "source"])
        .withColumn("weight", weighed.cast("long"))
        .select("source", "source_size", "held", "weight"),
        "weights",
    )

    whole = lambda value, digits: F.lit(Decimal(value)).cast(f"decimal({digits},0)")
    cap = F.col("source_size").cast("decimal(20,0)") * F.lit(most).cast("decimal(3,0)")
    weight = F.col("weight").cast("decimal(9,0)")
    upper, lower = share
    full, level, count = F.lit(False), (0, 1), -1
    while True:
        row = sources.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(full, F.col("source_size"))).alias("full_words"),
            F.sum(F.when(~full, F.col("weight"))).alias("weights"),
            F.sum(full.cast("long")).alias("full"),
        ).first()
        # The level is words for a weight of one, as a fraction; it rises, and sources stay full.
        if not row.weights or row.full == count:
            break
        count = row.full
        left = upper * row.words - lower * most * (row.full_words or 0)
        level = (left, lower * row.weights)
        full = weight * whole(level[0], 25) > cap * whole(level[1], 15)
    shared = F.col("weight").cast("double") * float(level[0]) / float(level[1])
    target = F.when(full, most * F.col("source_size").cast("double")).otherwise(shared)
    return written(sources.withColumns({"target": target, "full": full}), "targets")


def rate(tilt: Column, most: int) -> Column:
    mean = F.col("source_size") / F.col("held")
    return F.least(F.lit(float(most)), F.exp(tilt * F.col("size") / mean))


def tilts(cells: DataFrame, sources: DataFrame, most: int) -> DataFrame:
    """source, tilt: where the rates give every source that is not full its target."""
    cells = cells.where("size > 0").withColumnRenamed("source", "own")
    start = F.log(F.col("target") / F.col("source_size"))
    state = written(
        sources.where("NOT full AND source_size > 0").select(
            "source", "source_size", "held", "target", start.alias("tilt"),
            F.lit(-WIDEST).alias("low"), F.lit(WIDEST).alias("high"), F.lit(1e300).alias("last"),
        ),
        "tilts",
    )
    names = state.columns

    def exact(words: Column) -> Column:
        """Words summed in whole parts: the same sum in any order."""
        return F.sum(F.round(words * PARTS).cast("decimal(38,0)")).cast("double") / PARTS

    for _ in range(STEPS):
        joined = broadcast_if_small(state).join(cells, F.col("source").eqNullSafe(F.col("own")))
        now = rate(F.col("tilt"), most)
        words = F.col("n") * F.col("size") * now
        bends = F.when(now < most, words * F.col("size") * F.col("held") / F.col("source_size"))
        summed = joined.groupBy(*names).agg(
            (exact(words) - F.col("target")).alias("off"), exact(F.coalesce(bends, F.lit(0.0))).alias("slope")
        )
        low = F.when(F.col("off") < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("off") > 0, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - F.col("off") / F.when(F.col("slope") > 0, F.col("slope"))
        good = (step > low) & (step < high) & (F.abs("off") <= F.col("last") / 2)
        narrow = high - low <= NEAR * 1e-3
        settled = (F.abs("off") <= NEAR * F.col("target")) | narrow
        new = F.when(settled, F.col("tilt")).when(good, step).otherwise((low + high) / 2)
        state = written(
            summed.select(
                "source", "source_size", "held", "target", new.alias("tilt"), low.alias("low"),
                high.alias("high"), F.abs("off").alias("last"), settled.alias("settled"),
            ),
            "tilts",
        )
        if state.where(~F.col("settled")).isEmpty():
            break
        state = state.select(*names)
    return state.select("source", "tilt")


def rounded(cell: pd.DataFrame, most: int) -> pd.DataFrame:
    """Whole copies of the cells of one source: what every document gets, and how many get one more."""
    cell = cell.sort_values("size", ascending=False, ignore_index=True)
    base, more = np.zeros(len(cell), np.int32), np.zeros(len(cell), np.int64)
    asked, taken = 0.0, 0
    rows = zip(cell["size"].tolist(), cell["n"].tolist(), cell["rate"].tolist())
    for place, (size, n, own) in enumerate(rows):
        if not size:
            continue
        base[place] = min(int(own), most)
        asked += n * size * own
        taken += n * size * int(base[place])
        if base[place] < most:
            more[place] = min(max(round((asked - taken) / size), 0), n)
            taken += int(more[place]) * size
    return cell[["source", "size"]].assign(base=base, more=more)


def decided(
    docs: DataFrame,
    keep: Sequence[str],
    weights: Sequence[int] = WEIGHTS,
    share: tuple[int, int] = (3, 2),
    most: int = 2,
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """row (the columns of `keep`), size, source, source_size, target, copies of each document."""
    ready(docs.sparkSession)
    rows = written(
        docs.select(
            F.struct(*keep).alias("row"),
            F.col(source).cast("string").alias("own"),
            size_of(text).alias("words"),
            F.xxhash64("doc_id", text).alias("turn"),
        ),
        "sizes",
    )
    counted = rows.groupBy(F.col("own").alias("source"), F.col("words").alias("size"))
    cells = written(counted.agg(F.count(F.lit(1)).alias("n")), "cells")
    sources = targets(cells, weights, share, most)
    tilted = tilts(cells, sources, most).withColumnRenamed("source", "tilted")
    known = sources.withColumnRenamed("source", "known")
    known = known.join(tilted, F.col("known").eqNullSafe(F.col("tilted")), "left").drop("tilted")
    joined = cells.join(broadcast_if_small(written(known, "rates")), F.col("source").eqNullSafe(F.col("known")))
    # Cells of full sources take all copies; those of sources without words have none to take.
    tilted_rate = F.when(F.col("tilt").isNotNull(), rate(F.col("tilt"), most))
    own_rate = F.when(F.col("full"), float(most)).otherwise(F.coalesce(tilted_rate, F.lit(0.0)))
    whole = (
        joined.select("source", "size", "n", own_rate.alias("rate"))
        .groupBy("source")
        .applyInPandas(lambda cell: rounded(cell, most), CELLS)
        .withColumnsRenamed({"source": "s", "size": "z"})
    )
    told = joined.join(whole, F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z")))
    told = written(told.select("source", "size", "n", "source_size", "target", "base", "more"), "copies")

    met = F.col("own").eqNullSafe(F.col("source")) & (F.col("words") == F.col("size"))
    all_rows = rows.join(broadcast_if_small(told), met)
    some = (F.col("more") > 0) & (F.col("more") < F.col("n"))
    columns = ["row", "size", "source", "source_size", "target"]
    alike = F.col("base") + F.when(F.col("more") > 0, 1).otherwise(0)
    plain = all_rows.where(~some).select(*columns, alike.alias("copies"))
    cell = F.struct(F.col("own").alias("source"), F.col("words").alias("size")).alias("cell")
    turns = all_rows.where(some).select(*columns, "base", "more", "turn", cell)
    turns = number_by(turns, "cell", ["turn"])
    chosen = F.col("base") + F.when(F.col("seq") <= F.col("more"), 1).otherwise(0)
    return plain.unionByName(turns.select(*columns, chosen.alias("copies")))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with all their columns."""
    rows = decided(docs, docs.columns, **options).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes) and copies of each document."""
    rows = decided(docs, ["doc_id"], **options)
    taken = F.col("size") * F.col("copies")
    return rows.select("row.doc_id", "size", "source_size", "target", taken.alias("taken"), "copies")
