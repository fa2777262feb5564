"""Exact removal of repeated byte strings by longest-previous-factor arrays over sparse candidates.

A window is a string of `length` bytes. Its mark is the smallest of its hashed GRAM-byte strings, so
equal windows have equal marks at equal places. Neighbouring windows of one mark are a run, and the
bytes they cover its context; there is about one run for every `length` / 2 bytes.

1. Marks are counted; runs of marks that occur once have no equal window anywhere and go.
2. Runs of equal mark and equal context are copies as a whole.
3. Where a mark has several contexts and one of them occurs once, one run of each context is read.
   All contexts of a mark meet in one task, where the suffixes at the windows that have an equal are
   put in suffix order; previous and next smaller positions in that order, with the common prefixes
   on the way to them, give each suffix's longest previous factor. A window is a later copy where
   that is at least `length`, and a source where another's is.
   Marks with more contexts than `mark_contexts` are not gathered: their windows are counted by
   Spark, by hash, which gives the same answer.

Either every copy goes, or (keep_first) those that have an earlier match, in the order of doc_id and
place. The factors decide both: a window that has a factor of at least `length` is a later copy, and one
that such a factor leads to is its source. Whole contexts are taken as equal by two 64-bit hashes, of the
mark and of all of their bytes; windows of one task by their bytes.

Defined results: a null text is empty and keeps no byte; rows that repeat hold copies of each other,
each row with its own result; rows of one doc_id are told apart by a 64-bit hash of their text, and a
row without doc_id has two of them, of which the first is its place in the order; an empty table gives
no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baleflow.llm.common import GOLDEN, mixed, one_array, ragged, ready, slices, to_batches
from baleflow.session import broadcast_if_small, written

GRAM = 32
#: Marks with more contexts are counted by Spark instead of gathered in a task.
MARK_CONTEXTS = 8192
#: Texts are marked in portions of so many bytes; longer texts in overlapping pieces of as many.
PORTION = 500_000
#: Contexts whose suffixes are ordered together hold about so many bytes.
CHUNK = 3_000_000

#: Random-looking constants of the hashes: one number for each byte, an odd base, its inverse.
TABLE = mixed(np.arange(1, 257, dtype=np.uint64) * GOLDEN)
BASE = int(GOLDEN) | 1
INVERSE = pow(BASE, -1, 1 << 64)

RUNS = "key long, twin long, mark long, content long, start long, windows int, behind int"
SPANS = "key long, twin long, first long, last long"

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2 ** 64."""
    size = max((size for size in _powers), default=0)
    if size < n:
        _powers.clear()
        size = max(n, 2 * PORTION)
        both = []
        for base in (BASE, INVERSE):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            both.append(np.multiply.accumulate(steps))
        _powers[size] = (both[0], both[1])
    return _powers[size]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which `substring_hashes` takes the hash of any substring."""
    up, _ = powers(len(data) + 1)
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(TABLE[data] * up[: len(data)])])


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    return (sums[ends] - sums[starts]) * down[starts]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """The hash of the GRAM bytes from each place on; the last places are not meant to be used."""
    hashed, size, factor = TABLE[data], 1, BASE
    while size < GRAM:
        shifted = hashed[:-size] * np.uint64(factor) + hashed[size:]
        hashed = np.concatenate([shifted, hashed[len(shifted) :]])
        factor = factor * factor % (1 << 64)
        size *= 2
    hashed ^= hashed >> np.uint64(31)
    hashed = hashed * np.uint64(0xBF58476D1CE4E5B9)
    return hashed ^ (hashed >> np.uint64(29))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` neighbours, from minima towards both ends of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    padded = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def runs_of(data: np.ndarray, ends: np.ndarray, length: int, only_marks: bool):
    """Runs in pieces of bytes that end at `ends`.

    Returns the start, the number of windows, the place of the mark, the mark, and (unless only
    marks are asked for) the hash of the context, of each run.
    """
    if len(data) < length:
        none = np.empty(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    grams = gram_hashes(data)
    # Hash above, place below: of equal hashes the first place counts.
    low = np.uint64((1 << 22) - 1)
    keyed = (grams & ~low) | np.arange(len(data), dtype=np.uint64)
    places = (sliding_minimum(keyed[: len(data) - GRAM + 1], length - GRAM + 1) & low).astype(np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    # The last windows of a piece run over its end.
    usable = np.maximum(ends - begins - length + 1, 0)
    at = ragged(begins, usable)
    marks = places[at]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(marks) != 0)
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(at)))
    start, place = at[first], marks[first]
    if only_marks:
        return start, windows, place, grams[place], None
    sums = prefix_sums(data)
    content = substring_hashes(sums, start, start + windows + length - 1)
    shape = (windows.astype(np.uint64) << np.uint64(32)) | (place - start).astype(np.uint64)
    return start, windows, place, grams[place], mixed(content ^ mixed(shape))


def pieces(texts: pa.Array, length: int):
    """Portions of whole texts, or of pieces of a long one: bytes, ends, text and place of each.

    Pieces of a text overlap by one byte less than a window, so that each window is in one.
    """
    lengths = pc.binary_length(texts).to_numpy(False)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[texts.offset :][: len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2] or b"", np.uint8)
    held, size = [], 0
    for number in np.flatnonzero(lengths >= length).tolist():
        begin, total = int(offsets[number]), int(lengths[number])
        for place in range(0, total - length + 1, PORTION):
            stop = min(place + PORTION + length - 1, total)
            held.append((number, place, begin + place, begin + stop))
            size += stop - place
            if size >= PORTION:
                yield gathered(data, held)
                held, size = [], 0
    if held:
        yield gathered(data, held)


def gathered(data: np.ndarray, held: list[tuple[int, int, int, int]]):
    table = np.array(held, np.int64)
    sizes = table[:, 3] - table[:, 2]
    joined = np.concatenate([data[begin:stop] for _, _, begin, stop in held])
    return joined, np.cumsum(sizes), table[:, 0], table[:, 1]


def marked(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """mark and its number of runs, counted within portions."""
    for part in slices(batches):
        for data, ends, _, _ in pieces(one_array(part, "text"), length):
            found, counts = np.unique(runs_of(data, ends, length, True)[3], return_counts=True)
            yield from to_batches({"mark": found.view(np.int64), "n": counts.astype(np.int64)})


def all_runs(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        keys = one_array(part, "key").to_numpy()
        twins = one_array(part, "twin").to_numpy()
        for data, ends, texts, bases in pieces(one_array(part, "text"), length):
            start, windows, place, mark, content = runs_of(data, ends, length, False)
            piece = np.searchsorted(ends, start, side="right")
            begins = np.concatenate([[0], ends[:-1]])
            yield from to_batches(
                {
                    "key": keys[texts[piece]],
                    "twin": twins[texts[piece]],
                    "mark": mark.view(np.int64),
                    "content": content.view(np.int64),
                    "start": start - begins[piece] + bases[piece],
                    "windows": windows.astype(np.int32),
                    "behind": (place - start).astype(np.int32),
                }
            )


def smaller_neighbours(order: np.ndarray, prefix: np.ndarray, step: int):
    """For each place in suffix order, the common prefix with the nearest smaller position.

    order: positions in suffix order; prefix: common prefix of each suffix with the one before it.
    step: -1 looks back in the order (previous smaller), 1 ahead (next smaller).
    """
    n = len(order)
    if step == 1:
        return smaller_neighbours(
            order[::-1], np.concatenate([[0], prefix[1:]])[::-1][np.r_[n - 1, 0 : n - 1]], -1
        )[::-1]
    # Place 0 stands for "none"; suffixes are at 1 to n.
    positions = np.concatenate([[-1], order])
    pointer = np.arange(-1, n)
    pointer[0] = 0
    common = np.concatenate([[0], prefix])
    while True:
        beyond = np.flatnonzero(positions[pointer] > positions)
        if not len(beyond):
            return np.where(pointer[1:] == 0, 0, common[1:])
        further = pointer[beyond]
        common[beyond] = np.minimum(common[beyond], common[further])
        pointer[beyond] = pointer[further]


def longest_previous_factors(order: np.ndarray, prefix: np.ndarray) -> np.ndarray:
    """For each place in suffix order, the longest common prefix with an earlier suffix."""
    return np.maximum(
        smaller_neighbours(order, prefix, -1), smaller_neighbours(order, prefix, 1)
    )


def repeated_windows(contexts: list[bytes], windows: np.ndarray, rank: np.ndarray, length: int):
    """For each window of the contexts: is there an equal one, and is there an earlier equal one.

    rank: the order of the contexts; a window stands where its context does, then by its place.
    """
    data = np.frombuffer(b"".join(contexts), np.uint8)
    sizes = np.array([len(context) for context in contexts])
    begins = np.cumsum(sizes) - sizes
    starts = ragged(begins, windows)
    owner = np.repeat(np.arange(len(contexts)), windows)
    hashed = substring_hashes(prefix_sums(data), starts, starts + length)
    by_hash = np.argsort(hashed, kind="stable")
    ordered = hashed[by_hash]
    same = ordered[1:] == ordered[:-1]
    member = np.zeros(len(starts), bool)
    member[1:] |= same
    member[:-1] |= same
    repeated, later = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    if not member.any():
        return repeated, later
    # Suffixes that have an equal, grouped; each is compared with the first of its group by bytes.
    chosen = by_hash[member]
    group_starts = np.concatenate([[True], hashed[chosen[1:]] != hashed[chosen[:-1]]])
    group = np.cumsum(group_starts) - 1
    heads = starts[chosen[group_starts]]
    for k in range(0, len(chosen), 20_000):
        part = slice(k, k + 20_000)
        span = np.arange(length)
        if (data[starts[chosen[part]][:, None] + span] != data[heads[group[part]][:, None] + span]).any():
            raise ArithmeticError("two different strings have one hash; change TABLE")
    texts = data[heads[:, None] + np.arange(length)]
    by_text = np.argsort(np.ascontiguousarray(texts).view(f"S{length}").ravel(), kind="stable")
    place_of_group = np.empty(len(heads), np.int64)
    place_of_group[by_text] = np.arange(len(heads))
    positions = rank[owner[chosen]].astype(np.int64) << 32 | (starts - begins[owner])[chosen]
    suffix_order = np.lexsort((positions, place_of_group[group]))
    groups = place_of_group[group][suffix_order]
    texts = texts[by_text]
    differ = texts[1:] != texts[:-1]
    between = np.concatenate([[0], differ.argmax(1)])
    new = np.concatenate([[True], groups[1:] != groups[:-1]])
    prefix = np.where(new, between[groups], length)
    order = np.argsort(np.argsort(positions[suffix_order], kind="stable"), kind="stable")
    copies = longest_previous_factors(order, prefix) >= length
    later[chosen[suffix_order]] = copies
    # Suffixes that share as many bytes with the one before stand together: where a factor of one of
    # them is long enough, the earliest is what it leads to.
    begins = np.flatnonzero(np.r_[True, prefix[1:] < length])
    has_copy = np.logical_or.reduceat(copies, begins)
    repeated[chosen[suffix_order]] = np.repeat(has_copy, np.diff(np.r_[begins, len(copies)]))
    return repeated, later


def flagged_spans(flags: np.ndarray, windows: np.ndarray, length: int):
    """Runs of flagged windows of each context: context, first byte and end, within the context."""
    owner = np.repeat(np.arange(len(windows)), windows)
    place = ragged(np.zeros(len(windows), np.int64), windows)
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at, at
    new = np.concatenate([[True], (np.diff(at) != 1) | (np.diff(owner[at]) != 0)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return owner[at[first]], place[at[first]], place[at[last]] + length


def order_contexts(
    batches: Iterator[pa.RecordBatch], length: int, keep_first: bool
) -> Iterator[pa.RecordBatch]:
    """Spans to remove, from contexts that come by mark; marks are not split over chunks."""

    def chunk(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        contexts = rows["bytes"].to_pylist()
        windows = rows["windows"].to_numpy()
        key, twin, start = (rows[name].to_numpy() for name in ("key", "twin", "start"))
        rank = np.empty(len(rows), np.int64)
        rank[np.lexsort((start, twin, key))] = np.arange(len(rows))
        repeated, later = repeated_windows(contexts, windows, rank, length)
        # Contexts that occur more than once are here as partners, and are removed as a whole.
        single = np.repeat(rows["n"].to_numpy() == 1, windows)
        owner, first, last = flagged_spans((later if keep_first else repeated) & single, windows, length)
        yield from to_batches(
            {
                "key": key[owner],
                "twin": twin[owner],
                "first": start[owner] + first,
                "last": start[owner] + last,
            }
        )

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        marks = batch["mark"].to_numpy()
        borders = np.flatnonzero(np.diff(marks)) + 1
        if held and size >= CHUNK:
            # Close the chunk where the mark changes.
            begins = marks[0] != held[-1]["mark"][-1].as_py() if batch.num_rows else False
            border = 0 if begins else int(borders[0]) if len(borders) else None
            if border is not None:
                if border:
                    held.append(batch.slice(0, border))
                yield from chunk(pa.Table.from_batches(held))
                batch, held, size = batch.slice(border), [], 0
        if batch.num_rows:
            held.append(batch)
            size += int(pc.sum(pc.binary_length(batch["bytes"])).as_py())
    if held:
        yield from chunk(pa.Table.from_batches(held))


def window_hashes(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """One row per window of contexts whose mark has too many of them to be gathered."""
    for batch in batches:
        contexts = batch["bytes"].to_pylist()
        if not contexts:
            continue
        data = np.frombuffer(b"".join(contexts), np.uint8)
        windows = batch["windows"].to_numpy()
        sizes = np.array([len(context) for context in contexts])
        begins = np.cumsum(sizes) - sizes
        starts = ragged(begins, windows)
        hashed = substring_hashes(prefix_sums(data), starts, starts + length)
        owner = np.repeat(np.arange(len(contexts)), windows)
        places = pa.array(owner)
        yield from to_batches(
            {
                "mark": batch["mark"].take(places),
                "hash": hashed.view(np.int64),
                "key": batch["key"].take(places),
                "twin": batch["twin"].take(places),
                "at": batch["start"].to_numpy()[owner] + starts - begins[owner],
                "single": batch["n"].to_numpy()[owner] == 1,
            }
        )


def identified(docs: DataFrame) -> DataFrame:
    """key, twin and text: doc_id, or a hash of the text of a row without one, and another hash of the
    text, which tells rows of one doc_id apart."""
    text = F.coalesce("text", F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit("no doc_id"), text))
    return docs.select(
        key.alias("key"), F.xxhash64(text).alias("twin"), text.alias("text"),
        F.col("doc_id").cast("long").alias("doc_id"),
    )


def read_contexts(texts: DataFrame, chosen: DataFrame, length: int) -> DataFrame:
    """The bytes of the chosen runs, read from their texts."""
    per_text = chosen.groupBy("key", "twin").agg(
        F.collect_list(F.struct("mark", "start", "windows", "n", "contexts")).alias("runs")
    )
    per_text = written(per_text, "chosen")
    ids = broadcast_if_small(per_text.select("key", "twin"))
    some = texts.select("key", "twin", "text").join(ids, ["key", "twin"], "left_semi")
    # Rows that repeat have the same bytes.
    joined = per_text.join(some, ["key", "twin"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {
                name: [] for name in ("mark", "key", "twin", "start", "windows", "n", "contexts", "bytes")
            }
            size = 0
            for key, twin, runs, text in zip(
                batch["key"].to_pylist(), batch["twin"].to_pylist(),
                batch["runs"].to_pylist(), batch["text"].to_pylist(),
            ):
                held = text.encode()
                for one in runs:
                    start, windows = one["start"], one["windows"]
                    out["key"].append(key)
                    out["twin"].append(twin)
                    for name in ("mark", "start", "windows", "n", "contexts"):
                        out[name].append(one[name])
                    out["bytes"].append(held[start : start + windows + length - 1])
                    size += windows + length
                if size >= CHUNK:
                    yield context_batch(out)
                    size = 0
            yield context_batch(out)

    schema = (
        "mark long, key long, twin long, start long, windows int, n long, contexts long, bytes binary"
    )
    return joined.mapInArrow(run, schema).dropDuplicates(["mark", "key", "twin", "start"])


def context_batch(out: dict[str, list]) -> pa.RecordBatch:
    kinds = {"windows": pa.int32(), "bytes": pa.binary()}
    batch = pa.RecordBatch.from_pydict(
        {name: pa.array(values, kinds.get(name, pa.int64())) for name, values in out.items()}
    )
    for values in out.values():
        values.clear()
    return batch


def spans_to_remove(
    texts: DataFrame, length: int, keep_first: bool, mark_contexts: int
) -> DataFrame:
    """key, twin, first byte and end of bytes that a copied window covers; spans may overlap."""
    marks = texts.select("text").mapInArrow(lambda batches: marked(batches, length), "mark long, n long")
    repeated = marks.groupBy("mark").agg(F.sum("n").alias("n")).where("n > 1").select("mark")
    # Written, as are other sums that are joined with what they sum: the rows of a frequent mark are
    # then split over tasks, which they are not where the sum shares their exchange.
    repeated = written(repeated, "marks")
    runs = texts.select("key", "twin", "text").mapInArrow(
        lambda batches: all_runs(batches, length), RUNS
    )
    runs = written(runs.join(repeated, "mark"), "runs")

    place = F.struct("key", "twin", "start")
    contexts = runs.groupBy("mark", "content").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "twin", "start", "windows")).alias("one")
    )
    contexts = written(contexts, "contexts")
    copied = contexts.where("n > 1").select(
        "mark", "content", F.struct("one.key", "one.twin", "one.start").alias("one")
    )
    whole = runs.join(copied, ["mark", "content"])
    end = F.col("start") + F.col("windows") + (length - 1)
    if keep_first:
        whole = whole.where(place != F.col("one"))
    whole = whole.select("key", "twin", F.col("start").alias("first"), end.alias("last"))

    # Marks of several contexts, of which one occurs once: its windows may have equals in others.
    # The first run of a copied context may, too, have earlier equals in another context.
    by_mark = contexts.groupBy("mark").agg(
        F.count("*").alias("contexts"), F.min("n").alias("least")
    )
    open_marks = by_mark.where(
        (F.col("contexts") > 1) & (F.lit(keep_first) | (F.col("least") == 1))
    ).select("mark", "contexts")
    open_marks = written(open_marks, "open-marks")
    n = F.lit(1).cast("long") if keep_first else F.col("n")
    chosen = contexts.join(open_marks, "mark").select(
        "mark", "one.key", "one.twin", "one.start", "one.windows", n.alias("n"), "contexts"
    )
    found = written(read_contexts(texts, chosen, length), "context-bytes")
    few, many = (
        found.where(F.col("contexts") <= mark_contexts),
        found.where(F.col("contexts") > mark_contexts),
    )
    ordered = few.repartition("mark").sortWithinPartitions("mark").mapInArrow(
        lambda batches: order_contexts(batches, length, keep_first), SPANS
    )
    windows = many.mapInArrow(
        lambda batches: window_hashes(batches, length),
        "mark long, hash long, key long, twin long, at long, single boolean",
    )
    at = F.struct("key", "twin", "at")
    equal = windows.groupBy("mark", "hash").agg(F.count("*").alias("n"), F.min(at).alias("one"))
    equal = written(equal.where("n > 1").select("mark", "hash", "one"), "equal-windows")
    counted = windows.join(equal, ["mark", "hash"]).where("single")
    if keep_first:
        counted = counted.where(at != F.col("one"))
    counted = counted.select("key", "twin", F.col("at").alias("first"), (F.col("at") + length).alias("last"))
    return whole.union(ordered).union(counted)


def merged(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans as maximal ones that do not touch."""
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate([[True], first[1:] > last[:-1]])
    at = np.flatnonzero(new)
    return first[at], last[np.append(at[1:], len(first)) - 1]


def removed(docs: DataFrame, length: int = 200, keep_first: bool = True, mark_contexts: int = MARK_CONTEXTS):
    """doc_id, text and its spans to remove (array of first and end, in bytes), one row per row."""
    ready(docs.sparkSession)
    texts = identified(docs)
    spans = spans_to_remove(texts, length, keep_first, mark_contexts)
    per_text = spans.groupBy("key", "twin").agg(
        F.collect_set(F.struct("first", "last")).alias("spans")
    )
    return texts.join(per_text, ["key", "twin"], "left").select("doc_id", "text", "spans")


def kept_bytes(text: bytes, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """What is left of a text, the number of its removed bytes and of its removed spans."""
    if not spans:
        return text, 0, 0
    table = np.array([(one["first"], one["last"]) for one in spans], np.int64)
    first, last = merged(table[:, 0], table[:, 1])
    out, done = [], 0
    for a, b in zip(first.tolist(), last.tolist()):
        out.append(text[done:a])
        done = b
    out.append(text[done:])
    return b"".join(out), int((last - first).sum()), len(first)


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the sha256 of what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
                held = text.encode()
                left, n, count = kept_bytes(held, spans)
                out.append((len(held), n, count, hashlib.sha256(left).hexdigest()))
            columns = list(zip(*out)) if out else [[], [], [], []]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "n_bytes": pa.array(columns[0], pa.int64()),
                    "n_removed": pa.array(columns[1], pa.int64()),
                    "n_spans": pa.array(columns[2], pa.int64()),
                    "kept_sha256": pa.array(columns[3], pa.string()),
                }
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return rows.mapInArrow(run, schema)


