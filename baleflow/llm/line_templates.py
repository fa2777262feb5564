"""Line dedup by a log-template tree of fixed depth.

A line is parsed as a log message is: words with a digit become a variable field, then the number of
words and the first DEPTH words lead to a leaf, which holds any number of templates. The word at a
place counts the different lines of the leaf that have it there, so a line that is frequent weighs no
more than others. A line keeps the words of the largest counts, at least SIMILAR of its places and all
that count as many, and its other places are variable; lines that keep the same words at the same
places are of one template. A line with a variable word that is frequent in other templates of the leaf
keeps that too; a line is therefore also of the templates that keep all but one of its kept words. With
two such words in a line it is not found to be of the template.

A template recurs when it is in MIN_DOCS documents of different sets of lines. Copies of a document have
one set and count once, however many they are: what copies share is no boilerplate, and removing them
is left to document dedup. For the same reason a document that has no other lines, so that other
documents hold the whole of it, keeps its lines; from all others the lines of recurring templates are
dropped, whatever their share of the words.

Words of the lines are counted by Spark by leaf and place, so no leaf is gathered in one task.

Defined results: a null text is empty and has no lines; empty lines are kept and counted as no
words; lines that repeat within a document count once and are dropped together; rows that repeat
count as one document, each with its own result; an empty table gives no rows; columns other than
doc_id and text are passed on by `cleaned`, whatever their names, and not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baleflow.llm.common import by_slice, mixed, one_array, ready, string_hashes, to_batches
from baleflow.session import broadcast_if_small, written

#: Leading words that lead to a leaf, besides the number of words.
DEPTH = 3
#: Share of places that a line must have in common with its leaf's template.
SIMILAR = 0.7
MIN_DOCS = 3

PARSED = "key long, twin long, leaf long, line long, whole long"


def lines_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lines of all texts with variable fields, in lower case, and the number in each text."""
    lower = pc.ascii_lower(texts)
    plain = pc.if_else(
        pc.match_substring_regex(lower, "[0-9]"),
        pc.replace_substring_regex(lower, r"[^ \t\n\r\v\f]*[0-9][^ \t\n\r\v\f]*", "<*>"),
        lower,
    )
    lists = pc.split_pattern(plain, "\n")
    return pc.ascii_trim_whitespace(lists.flatten()), np.diff(lists.offsets.to_numpy()).astype(np.int64)


def parsed(texts: pa.Array):
    """For each line its hash, its leaf and number of words; and the number of lines in each text."""
    lines, counts = lines_of(texts)
    distinct = lines.dictionary_encode()
    names, codes = distinct.dictionary, distinct.indices.to_numpy()
    words = pc.ascii_split_whitespace(names)
    offsets = words.offsets.to_numpy().astype(np.int64)
    flat = words.flatten()
    sizes = np.where(pc.equal(names, "").to_numpy(False), 0, np.diff(offsets))
    hashes = string_hashes(names)
    leaves = mixed(sizes.astype(np.uint64) + np.uint64(1))
    known = flat.dictionary_encode()
    word_hashes = string_hashes(known.dictionary)[known.indices.to_numpy()]
    for place in range(DEPTH):
        at = np.minimum(offsets[:-1] - offsets[0] + place, max(len(word_hashes) - 1, 0))
        step = mixed(leaves ^ (word_hashes[at] if len(word_hashes) else leaves))
        leaves = np.where(sizes > place, step, leaves)
    # Up to DEPTH words a line is its own leaf, and has no other template.
    return hashes[codes], leaves[codes], sizes[codes], counts


def parse(part: pa.Table) -> list[pa.RecordBatch]:
    """One row per document and distinct line that is not empty."""
    hashes, leaves, sizes, counts = parsed(one_array(part, "text"))
    text = np.repeat(np.arange(len(counts)), counts)
    full = sizes > 0
    hashes, leaves, text = hashes[full], leaves[full], text[full]
    order = np.lexsort((hashes, text))
    hashes, leaves, text = hashes[order], leaves[order], text[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    hashes, leaves, text = hashes[new], leaves[new], text[new]
    # The set of a text's lines, as the sum of their mixed hashes.
    sums = np.zeros(len(counts), np.uint64)
    np.add.at(sums, text, mixed(hashes))
    whole = sums[text]
    places = pa.array(text)
    return to_batches(
        {
            "key": one_array(part, "key").take(places),
            "twin": one_array(part, "twin").take(places),
            "leaf": leaves.view(np.int64),
            "line": hashes.view(np.int64),
            "whole": whole.view(np.int64),
        }
    )


def word_places(part: pa.Table) -> Iterator[pa.RecordBatch]:
    """leaf, line and the hashes of the words, for the asked lines of each document."""
    asked = one_array(part, "asked")
    lines, counts = lines_of(one_array(part, "text"))
    hashes, leaves, sizes, _ = parsed(one_array(part, "text"))
    text = np.repeat(np.arange(len(counts)), counts)
    wanted_text = np.repeat(np.arange(len(asked)), np.diff(asked.offsets.to_numpy()))
    wanted = np.unique(mixed(asked.flatten().to_numpy().view(np.uint64)) ^ wanted_text.astype(np.uint64))
    own = mixed(hashes) ^ text.astype(np.uint64)
    _, first = np.unique(own, return_index=True)
    chosen = first[np.isin(own[first], wanted)]
    words = pc.ascii_split_whitespace(lines.take(pa.array(chosen)))
    known = words.flatten().dictionary_encode()
    flat = string_hashes(known.dictionary).view(np.int64)[known.indices.to_numpy()]
    offsets = words.offsets.to_numpy()
    yield pa.RecordBatch.from_pydict(
        {
            "leaf": leaves[chosen].view(np.int64),
            "line": hashes[chosen].view(np.int64),
            "words": pa.ListArray.from_arrays(
                pa.array(offsets - offsets[0], pa.int32()), pa.array(flat, pa.int64())
            ),
        }
    )


def identified(docs: DataFrame) -> DataFrame:
    """key, twin and text of the documents, whether it was null, and their other columns as `row`.

    key is the doc_id, or a hash of the text where there is none; twin is another hash of the text, and
    tells rows of one doc_id apart.
    """
    text = F.coalesce("text", F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit("no doc_id"), text))
    others = F.struct(*[F.col(f"`{name}`") for name in docs.columns if name != "text"])
    return docs.select(
        key.alias("key"), F.xxhash64(text).alias("twin"), text.alias("text"),
        F.col("text").isNull().alias("missing"), others.alias("row"),
    )


def templates(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """leaf, line and all templates of the lines that share enough words with others of their leaf."""
    counted = lines.groupBy("leaf", "line").agg(F.min(F.struct("key", "twin")).alias("one"))
    counted = written(counted, "leaf-lines")
    several = counted.groupBy("leaf").agg(F.count("*").alias("lines")).where("lines > 1")
    several = written(several.select("leaf"), "leaves")
    asked = written(
        counted.join(several, "leaf").groupBy("one.key", "one.twin").agg(F.collect_set("line").alias("asked")),
        "asked",
    )
    ids = broadcast_if_small(asked.select("key", "twin"))
    some = rows.select("key", "twin", "text").join(ids, ["key", "twin"], "left_semi")
    read = some.join(asked, ["key", "twin"]).select("text", "asked").mapInArrow(
        by_slice(word_places), "leaf long, line long, words array<long>"
    )
    # Rows that repeat give the same line twice.
    words = written(read.dropDuplicates(["leaf", "line"]), "line-words")
    placed = words.select(
        "leaf", "line", F.size("words").alias("size"), F.posexplode("words").alias("place", "word")
    )
    shared = placed.groupBy("leaf", "place", "word").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(shared, "shared-words")
    found = F.sort_array(F.collect_list(F.struct("n", F.xxhash64("place", "word").alias("at"))), asc=False)
    by_line = placed.join(shared, ["leaf", "place", "word"]).groupBy("leaf", "line").agg(
        F.max("size").alias("size"), found.alias("found")
    )
    # In SQL the share is a decimal, whose product is exact.
    needed = F.expr(f"cast(ceil({SIMILAR} * size) AS int)")
    general = by_line.where(F.size("found") >= needed).withColumn("least", F.get("found", needed - 1))
    kept = F.expr("transform(filter(found, x -> x.n >= least.n), x -> x.at)")
    general = general.select("leaf", "line", kept.alias("kept"), needed.alias("needed"))
    # The number of a template is that of its leaf and the hashes of its words, by exclusive or.
    number = F.expr("aggregate(kept, leaf, (number, at) -> number ^ at)")
    general = written(general.withColumn("template", number), "general-lines")
    own = general.select("leaf", "line", "template")
    known = written(own.select("template").distinct(), "known-templates")
    others = general.where(F.size("kept") > F.col("needed")).select(
        "leaf", "line", "template", F.explode("kept").alias("at")
    )
    fewer = others.select("leaf", "line", F.col("template").bitwiseXOR(F.col("at")).alias("template"))
    also = fewer.join(broadcast_if_small(known), "template", "left_semi")
    return own.union(also.select("leaf", "line", "template"))


def recurring(rows: DataFrame) -> DataFrame:
    """key, twin and the hashes of the lines of recurring templates, one row per document."""
    all_lines = rows.select("key", "twin", "text").mapInArrow(by_slice(parse), PARSED)
    lines = written(all_lines, "lines")
    busy = lines.groupBy("leaf").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "twin")).alias("low"),
        F.max(F.struct("key", "twin")).alias("high"),
    )
    busy = busy.where((F.col("n") >= MIN_DOCS) & (F.col("low") != F.col("high"))).select("leaf")
    # Written, so that the lines of a frequent leaf are split over tasks when they are joined.
    busy = written(busy, "busy-leaves")
    lines = written(lines.join(busy, "leaf"), "busy-lines")
    general = written(templates(rows, lines), "general-templates")
    named = lines.join(general, ["leaf", "line"], "left").withColumn(
        "template", F.coalesce("template", "line")
    )
    named = written(named.select("key", "twin", "line", "whole", "template"), "named-lines")
    # Different documents of each template: copies have one set of lines.
    spread = named.select("template", "whole").distinct().groupBy("template").agg(F.count("*").alias("n"))
    often = spread.where(F.col("n") >= MIN_DOCS).select("template")
    often = written(often, "recurring-templates")
    return named.join(often, "template").groupBy("key", "twin").agg(
        F.collect_set("line").alias("recurring")
    )


def without_recurring(text: str, hashes: np.ndarray, sizes: np.ndarray, found: np.ndarray):
    """The text without its recurring lines, and their number; one of no other lines keeps them."""
    full = sizes > 0
    drop = np.isin(hashes, found) & full
    if not drop.any() or drop.sum() == full.sum():
        return text, 0
    kept = [line for line, gone in zip(text.split("\n"), drop.tolist()) if not gone]
    return "\n".join(kept), int(drop.sum())


def parsed_rows(docs: DataFrame) -> DataFrame:
    """row and missing (see `identified`), the text without recurring lines, n_lines and n_dropped."""
    ready(docs.sparkSession)
    rows = identified(docs)
    found = recurring(rows)
    joined = rows.join(found, ["key", "twin"], "left").select("row", "missing", "text", "recurring")

    def cut(part: pa.Table) -> list[pa.RecordBatch]:
        texts = one_array(part, "text")
        hashes, _, sizes, counts = parsed(texts)
        ends = np.cumsum(counts)
        recurring_lines = one_array(part, "recurring")
        out, dropped = texts.to_pylist(), np.zeros(len(texts), np.int64)
        for place in np.flatnonzero(recurring_lines.is_valid().to_numpy(False)).tolist():
            own = slice(int(ends[place] - counts[place]), int(ends[place]))
            lines = recurring_lines[place].values.to_numpy().view(np.uint64)
            out[place], dropped[place] = without_recurring(
                out[place], hashes[own], sizes[own], lines
            )
        columns = {
            "row": part.column("row"),
            "missing": part.column("missing"),
            "text": pa.array(out, pa.string()),
            "n_lines": counts,
            "n_dropped": dropped,
        }
        return pa.table(columns).to_batches(max_chunksize=256)

    fields = ", ".join(f"`{name}`: {kind}" for name, kind in docs.dtypes if name != "text")
    schema = f"row struct<{fields}>, missing boolean, text string, n_lines long, n_dropped long"
    return joined.mapInArrow(by_slice(cut), schema)


def cleaned(docs: DataFrame) -> DataFrame:
    """The documents with their columns, of which `text` is without recurring lines.

    A null text stays null.
    """
    kept = F.when(~F.col("missing"), F.col("text"))
    columns = [
        (kept if name == "text" else F.col(f"row.`{name}`")).alias(name) for name in docs.columns
    ]
    return parsed_rows(docs).select(columns)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the sha256 of the text that is left, for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [hashlib.sha256(text.encode()).hexdigest() for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "n_lines": batch["n_lines"],
                    "n_dropped": batch["n_dropped"],
                    "kept_sha256": pa.array(sums, pa.string()),
                }
            )

    doc_id = F.col("row.doc_id").cast("long").alias("doc_id")
    chosen = parsed_rows(docs).select(doc_id, "n_lines", "n_dropped", "text")
    return chosen.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")
