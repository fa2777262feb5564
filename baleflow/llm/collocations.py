"""Collocations: phrases whose words stand together more often than their parts would let expect.

Texts are cut into pieces and these into words. Only the longest windows of words are counted, one at
each word, filled up at the end of a piece; ROLLUP adds them up over successively shorter prefixes,
which gives the counts of all shorter phrases. A phrase is no more frequent than any run of words in it,
so a pass for each length goes before: a run that is too rare for a candidate ends a window before its
last word, which changes no count of a candidate and leaves a small part of the windows. Which runs may
be frequent goes to the tasks as bitmaps of a fixed size; where two share a bit, windows are longer than
they need to be, and counts are the same.

Words go by keys of language and word, as short as the number of words allows. The table of all words
tells whether a word that may be counted shares its key with another; then keys of another seed are
taken, so counts are exact.

A phrase of at least `least` occurrences is a candidate. Cut after its first k words it has the score
floor(10^6 a^2 / (l r)) with a, l and r the occurrences of phrase, first part and rest; its lowest cut
counts, then the one of smallest k. Candidates that lie within a longer one of at least `cover` percent
of their occurrences are dropped.

Defined results: a null text is empty, a null language is `und`; rows that repeat count each for
itself; ties in score and occurrences go by phrase in byte order; an empty table, or one without
candidates, gives no rows; columns other than text and lang are not read.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from baleflow.llm.common import (
    GOLDEN, mixed, one_array, ready, slices, string_hashes, to_batches
)
from baleflow.session import broadcast_if_small, written

#: Bits of the bitmap of the frequent runs of each length, 16 MB whatever the input holds.
BITS = 1 << 27
#: Bytes of one row of it.
BITMAP_ROW = 4096
#: Places of runs that a task adds up before it sends them.
HELD = 2_000_000

BLANK, BREAK = 1, 2
KINDS = np.zeros(256, np.uint8)
KINDS[[0x20, 0x09]] = BLANK
KINDS[list(b".,;:!?\x0a\x0b\x0c\x0d")] = BREAK
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

WORDS = "lang string, word string, n long"
KEYED = "lang string, word string, key long"


def texts_by_language(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """The words of all texts, the text of each, and how many words from it to its piece's end."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    kinds = KINDS[data]
    word = np.zeros(len(data) + 1, bool)
    word[:-1] = kinds == 0
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | begins[1:]
    last = word[:-1] & (~word[1:] | begins[1:])
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    lengths = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=lengths[1:])
    letters = LOWER[data[word[:-1]]]
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(lengths), pa.py_buffer(letters))
    text = np.searchsorted(offsets, starts, side="right") - 1
    breaks = np.cumsum(kinds == BREAK, dtype=np.int32)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (text[1:] != text[:-1]) | (breaks[1:] != breaks[:-1])
    piece_ends = np.append(np.flatnonzero(new)[1:], len(starts)) if len(starts) else np.empty(0, int)
    left = piece_ends[np.cumsum(new) - 1] - np.arange(len(starts))
    return found.dictionary_encode(), text, left


@dataclasses.dataclass
class Keys:
    """Keys of words: of so many bits, by a seed."""

    bits: int
    seed: int = 0

    def parts(self, words: pa.Array, langs: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Parts of keys: of distinct words, and of distinct languages."""
        by_word = mixed(string_hashes(words) + np.uint64(self.seed))
        return by_word, mixed(string_hashes(langs) ^ GOLDEN)

    def key(self, by_word: np.ndarray, by_lang: np.ndarray) -> np.ndarray:
        return (mixed(by_word + by_lang) >> np.uint64(64 - self.bits)).view(np.int64)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        words, text, _ = words_of(one_array(part, "text"))
        langs = one_array(part, "lang").dictionary_encode()
        lang = langs.indices.to_numpy()[text]
        counted = pa.table({"lang": lang, "word": words.indices}).group_by(["lang", "word"])
        counted = counted.aggregate([([], "count_all")])
        yield from to_batches(
            {
                "lang": langs.dictionary.take(one_array(counted, "lang")),
                "word": words.dictionary.take(one_array(counted, "word")),
                "n": one_array(counted, "count_all"),
            }
        )


def with_keys(words: DataFrame, keys: Keys, frequent=None) -> DataFrame:
    """lang, word, key; with the bitmap `frequent` only words that have a bit there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch["lang"].dictionary_encode()
            by_word, by_lang = keys.parts(batch["word"], langs.dictionary)
            own = keys.key(by_word, by_lang[langs.indices.to_numpy()])
            rows = pa.table({"lang": batch["lang"], "word": batch["word"], "key": own})
            if frequent is not None:
                bits = frequent.value
                rows = rows.filter(pa.array(is_set(bits, own & (8 * len(bits) - 1))))
            yield from rows.to_batches()

    return words.select("lang", "word").mapInArrow(run, KEYED)


def vocabulary(rows: DataFrame, least: int, bits: int, width: int | None = None):
    """All words of all languages with their occurrences; the frequent ones with keys of their own; the
    keys; and the bitmap of the frequent ones."""
    totals = rows.mapInArrow(count_words, WORDS).groupBy("lang", "word").agg(F.sum("n").alias("n"))
    words = written(totals, "words")
    row = words.agg(F.count("*").alias("words"), F.sum((F.col("n") >= least).cast("long")).alias("frequent")).first()
    often = row["frequent"] or 0
    # Words that meet the bitmap; keys of twice their bits, and ten more, are rarely shared.
    met = often + row["words"] * often // bits + 2
    width = width or min(64, -(-(2 * met.bit_length() + 10) // 8) * 8)
    for seed in count():
        keys = Keys(width, seed)
        frequent = written(with_keys(words.where(F.col("n") >= least), keys), "frequent")
        places = frequent.select(F.col("key").bitwiseAND(F.lit(bits - 1)).alias("place"))
        held = rows.sparkSession.sparkContext.broadcast(bitmap(bitmap_rows(places), bits))
        shared = with_keys(words, keys, held).groupBy("key").count().where("count > 1 OR key = 0")
        if shared.isEmpty():
            return words, frequent, keys, held


def bitmap_rows(places: DataFrame) -> DataFrame:
    """The rows of a bitmap, and their bits, that places (from 0) are on."""
    place = F.col("place") + 1
    row = (F.bitmap_bucket_number(place) - 1).alias("row")
    return places.groupBy(row).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))


def bitmap(rows: DataFrame, bits: int) -> np.ndarray:
    """All rows of a bitmap; at most `bits` bits reach the driver."""
    out = np.zeros((bits // 8 // BITMAP_ROW, BITMAP_ROW), np.uint8)
    for row in rows.toLocalIterator():
        out[row["row"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def is_set(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def shifted(values: np.ndarray, by: int) -> np.ndarray:
    """The values so many places ahead, zeros behind the end."""
    out = np.zeros_like(values)
    out[: max(len(values) - by, 0)] = values[by:]
    return out


def frequent_starts(part: pa.Table, keys: Keys, bitmaps: list[np.ndarray]):
    """Keys of the words of a slice, the words left in their pieces, and for 1, 2, ... words, as many as
    there are bitmaps, whether a run of so many that starts here may be frequent."""
    found, text, left = words_of(one_array(part, "text"))
    langs = one_array(part, "lang").dictionary_encode()
    by_word, by_lang = keys.parts(found.dictionary, langs.dictionary)
    own = keys.key(by_word[found.indices.to_numpy()], by_lang[langs.indices.to_numpy()[text]])
    starts = [np.ones(len(own), bool)]
    for length, bits in enumerate(bitmaps, 1):
        starts.append(possible(starts[-1], left, length) & is_set(bits, run_places(own, length, 8 * len(bits))))
    return own, left, starts[1:]


def possible(shorter: np.ndarray, left: np.ndarray, length: int) -> np.ndarray:
    """Where a run of `length` words lies in one piece, and both runs of one word less may be frequent."""
    return shorter & (left >= length) & (shifted(shorter, 1) if length > 1 else True)


def run_places(own: np.ndarray, length: int, bits: int) -> np.ndarray:
    """The bit, of so many, of the run of `length` words at each word."""
    hashed = own.view(np.uint64)
    for ahead in range(1, length):
        hashed = mixed(hashed * GOLDEN + shifted(own, ahead).view(np.uint64))
    return (hashed & np.uint64(bits - 1)).astype(np.int64)


def frequent_runs(rows: DataFrame, bitmaps: list, keys: Keys, least: int, bits: int) -> DataFrame:
    """The rows of a bitmap with the bits on which runs, one word longer than the last bitmap's, fall
    `least` times or more.

    Tasks add up the bits of many slices before they send them, as places and counts within a row of the
    bitmap; the sums of a row need one pass over what tasks sent, in a bounded memory.
    """
    length = len(bitmaps) + 1
    kind = np.min_scalar_type(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for part in slices(batches):
            own, left, starts = frequent_starts(part, keys, [one.value for one in bitmaps])
            places = run_places(own, length, bits)[possible(starts[-1], left, length)]
            held.append(np.unique(places, return_counts=True))
            if sum(len(place) for place, _ in held) >= HELD:
                yield from packed(held, least, kind)
                held = []
        if held:
            yield from packed(held, least, kind)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, counts = None, np.zeros(8 * BITMAP_ROW, np.int64)

        def frequent() -> Iterator[pa.RecordBatch]:
            if current is not None and (counts >= least).any():
                packed_bits = np.packbits(counts >= least, bitorder="little").tobytes()
                yield pa.RecordBatch.from_pydict({"row": pa.array([current]), "bits": pa.array([packed_bits])})

        for batch in batches:
            for row, place, n in zip(*(batch[name].to_pylist() for name in ("row", "place", "n"))):
                if row != current:
                    yield from frequent()
                    current, counts[:] = row, 0
                counts[np.frombuffer(place, "<u2")] += np.frombuffer(n, kind)
        yield from frequent()

    sent = rows.mapInArrow(run, "row long, place binary, n binary")
    return sent.repartition("row").sortWithinPartitions("row").mapInArrow(add_up, "row long, bits binary")


def packed(held: list[tuple[np.ndarray, np.ndarray]], least: int, kind: np.dtype) -> list[pa.RecordBatch]:
    """Places and counts (no larger than `least`), added up, one row for each row of the bitmap."""
    places, counts = (np.concatenate(column) for column in zip(*held))
    if not len(places):
        return []
    order = np.argsort(places, kind="stable")
    places, counts = places[order], counts[order]
    first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
    places, counts = places[first], np.minimum(np.add.reduceat(counts, first), least).astype(kind)
    rows, inner = places // (8 * BITMAP_ROW), (places % (8 * BITMAP_ROW)).astype("<u2")
    begins = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    ends = np.append(begins, len(rows)).astype(np.int32)

    def binary(values: np.ndarray) -> pa.Array:
        offsets = pa.py_buffer(np.ascontiguousarray(ends * values.itemsize))
        return pa.Array.from_buffers(pa.binary(), len(begins), [None, offsets, pa.py_buffer(values)])

    table = pa.table({"row": rows[begins], "place": binary(inner), "n": binary(counts)})
    return table.to_batches(max_chunksize=256)


def count_windows(bitmaps: list, keys: Keys):
    """Counts of windows of as many keys as there are bitmaps, those behind the end of a window zero."""
    names = [f"w{k}" for k in range(1, len(bitmaps) + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            own, _, starts = frequent_starts(part, keys, [held.value for held in bitmaps])
            known = starts[0]
            columns = [np.where(go_on, shifted(own, k), 0)[known] for k, go_on in enumerate(starts)]
            counted = pa.table(dict(zip(names, columns))).group_by(names).aggregate([([], "count_all")])
            yield from to_batches({name: one_array(counted, name) for name in names}
                                  | {"n": one_array(counted, "count_all")})

    return run


def phrase_counts(windows: DataFrame, longest: int, least: int) -> DataFrame:
    """Phrases (their length, keys, occurrences n) of at least `least` occurrences, by ROLLUP."""
    rest = ", ".join(f"w{k}" for k in range(2, longest + 1))
    levels = " + ".join(f"grouping(w{k})" for k in range(2, longest + 1))
    summed = windows.sparkSession.sql(
        f"""SELECT w1, {rest}, {longest} - ({levels}) AS length, sum(n) AS n
            FROM {{windows}} GROUP BY w1, ROLLUP({rest}) HAVING sum(n) >= {int(least)}""",
        windows=windows,
    )
    # A window that ended before the length of the prefix is no phrase of that length.
    full = reduce(
        lambda test, k: test & ((F.col("length") < k) | (F.col(f"w{k}") != 0)),
        range(2, longest + 1),
        F.lit(True),
    )
    return written(summed.where(full), "phrases")


def score(a: Column, l: Column, r: Column) -> Column:
    """floor(10^6 a^2 / (l r)) in exact arithmetic."""
    return F.call_function(
        "div",
        F.lit(1_000_000).cast("decimal(7,0)") * a.cast("decimal(19,0)") * a.cast("decimal(19,0)"),
        l.cast("decimal(19,0)") * r.cast("decimal(19,0)"),
    )


def candidates(counts: DataFrame, longest: int, cover: int) -> DataFrame:
    """Scored phrases of two words and more: keys w1.., length, a, l, r, score."""
    spark = counts.sparkSession
    by_length = {}
    for m in range(1, longest + 1):
        keys = [f"w{k}" for k in range(1, m + 1)]
        by_length[m] = counts.where(F.col("length") == m).select(*keys, "n")

    def part_counts(first: int, last: int, name: str) -> DataFrame:
        """Occurrences of the words `first` to `last` of a phrase."""
        m = last - first + 1
        keys = [F.col(f"w{k}").alias(f"w{first + k - 1}") for k in range(1, m + 1)]
        table = by_length[m].select(*keys, F.col("n").alias(name))
        return broadcast_if_small(table) if m == 1 else table

    out = []
    for m in range(2, longest + 1):
        rows = by_length[m].withColumnRenamed("n", "a")
        cuts = []
        for k in range(1, m):
            first = [f"w{i}" for i in range(1, k + 1)]
            rest = [f"w{i}" for i in range(k + 1, m + 1)]
            rows = rows.join(part_counts(1, k, f"l{k}"), first)
            rows = rows.join(part_counts(k + 1, m, f"r{k}"), rest)
            value = score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}"))
            cuts.append(F.struct(value.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"),
                                 F.col(f"r{k}").alias("r")))
        rows = rows.withColumn("cut", F.array_min(F.array(*cuts)))
        longer = [
            by_length[bigger].select(
                *[F.col(f"w{start + i}").alias(f"w{i}") for i in range(1, m + 1)],
                F.col("n").alias("around"),
            )
            for bigger in range(m + 1, longest + 1)
            for start in range(bigger - m + 1)
        ]
        keys = [f"w{k}" for k in range(1, m + 1)]
        if longer:
            most = reduce(DataFrame.unionByName, longer).groupBy(*keys).agg(F.max("around").alias("around"))
            rows = rows.join(most, keys, "left")
            rows = rows.where(F.coalesce(100 * F.col("around") < cover * F.col("a"), F.lit(True)))
        padding = [F.lit(0).cast("long").alias(f"w{k}") for k in range(m + 1, longest + 1)]
        out.append(rows.select(*keys, *padding, F.lit(m).alias("length"), "a", "cut.l", "cut.r", "cut.score"))
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], "a long")


def collocations(
    docs: DataFrame,
    first: int = 2000,
    longest: int = 3,
    least: int = 10,
    cover: int = 50,
    bits: int = BITS,
) -> DataFrame:
    """The `first` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    `bits` (a power of two, 2^15 at least) is the size of a bitmap and does not change the result.
    """
    spark = ready(docs.sparkSession)
    rows = texts_by_language(docs)
    words, frequent, keys, held = vocabulary(rows, least, bits)
    bitmaps = [held]
    for _ in range(longest - 1):
        runs = frequent_runs(rows, bitmaps, keys, least, bits)
        bitmaps.append(spark.sparkContext.broadcast(bitmap(runs, bits)))
    names = [f"w{k}" for k in range(1, longest + 1)]
    schema = ", ".join(f"{name} long" for name in [*names, "n"])
    windows = rows.mapInArrow(count_windows(bitmaps, keys), schema)
    found = candidates(phrase_counts(windows, longest, least), longest, cover)

    # At most `first` of each language and task stay before its phrases come together.
    spelled = broadcast_if_small(frequent)
    for name in names:
        columns = [F.col("key").alias(name), F.col("word").alias(f"word_{name}")]
        columns += [F.col("lang")] if name == "w1" else []
        found = found.join(spelled.select(*columns), name, "left")
    phrase = F.concat_ws(" ", *[F.col(f"word_{name}") for name in names])
    found = found.select("lang", phrase.alias("phrase"), "a", "l", "r", "score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    found = best(found, ["lang", "part"], order, first).drop("part", "rank")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    ranked = best(found, ["lang"], order, first).join(totals, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def best(rows: DataFrame, by: list[str], order: list[Column], first: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order)).cast("long")
    return rows.withColumn("rank", rank).where(F.col("rank") <= first)
