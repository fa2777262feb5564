"""Cross-entropy difference: how much better a target model predicts a document than a background.

Both are bigram models over one vocabulary, all words of all documents, without a bound on words or
pairs. The target model counts the documents chosen as target, the background model all others:

    P(word | before) = (s c(before, word) + SMOOTHING P(word)) / (s c(before) + SMOOTHING)
    P(word)          = (s c(word) + 1) / (s N + V)

N is the number of words a model has seen and V that of different words. The models are matched by s:
counts are scaled to the N of the smaller model, so that smoothing weighs on both alike. A document's
own words are taken out of the counts of its model (but not out of N), so that no row is predicted
from itself. The start of a text counts as a word before; what ends a text is not predicted.

A document's score is the mean over its words of the loss under the target model less the loss under
the background model: lower is more like the target.

Words and pairs are 64-bit hashes (keys). The rows are written as slices of some megabytes of text,
each with its different words and their numbers. A slice asks for each of its different keys once,
with its own counts, so that no key is hot: it comes once from a slice, however often it occurs. The
key's range decides the bucket where its counts are added up, and the sums go back to the slices
that asked for them. Nothing is broadcast, and what the driver gets is three totals.

Defined results: a null text, or one without words, has losses and score 0; documents without
doc_id, or that are not labelled, count as background; rows that repeat count and are scored each
for itself; a model without documents is that of no counts; an empty table gives no rows; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import dataclasses
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baleflow.llm.common import ids_and_texts, mixed, one_array, ready, slices, string_hashes
from baleflow.session import broadcast_if_small, written

#: Strength of the word probabilities against the counted pairs.
SMOOTHING = 10.0
DECIMALS = 6
#: Words for one bucket, which ask for two keys each at most.
BUCKET_WORDS = 2_500_000
ROWS_A_BATCH = 16

SCORED = "doc_id long, n_tokens long, target_loss double, background_loss double, score double"

#: The arrays of a slice's row, of its requests and of the answers.
SLICE = {
    "ids": np.int64, "without_id": np.bool_, "target": np.bool_, "sizes": np.int64,
    "hashes": np.uint64, "codes": np.uint32,
}
REQUEST = {"keys": np.uint64, "is_word": np.bool_, "own": np.uint32}
ANSWER = {"sums": np.int64}


def words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Runs of letters and digits in lower case, and the number of them in each text."""
    plain = pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\pL\pN]+", " ")
    lists = pc.split_pattern(plain, " ")
    offsets = lists.offsets.to_numpy()
    flat = lists.flatten()
    full = pc.not_equal(flat, "")
    keep = full.to_numpy(False)
    counts = np.diff(np.concatenate([[0], np.cumsum(keep)])[offsets - offsets[0]])
    return flat.filter(full).dictionary_encode(), counts.astype(np.int64)


def flagged(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, text and whether the row is in the target."""
    chosen = target.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    chosen = broadcast_if_small(written(chosen.withColumn("target", F.lit(True)), "target"))
    rows = ids_and_texts(docs).join(chosen, "doc_id", "left")
    return rows.withColumn("target", F.coalesce("target", F.lit(False)))


@dataclasses.dataclass
class Tokens:
    """The words of a slice of texts, text after text."""

    sizes: np.ndarray  # words of each text
    target: np.ndarray  # is the text in the target
    hashes: np.ndarray  # of the different words
    codes: np.ndarray  # of each word, into hashes

    @classmethod
    def of(cls, part: pa.Table) -> Tokens:
        found, sizes = words(one_array(part, "text"))
        target = one_array(part, "target").to_numpy(False)
        return cls(sizes, target, string_hashes(found.dictionary), found.indices.to_numpy())

    @property
    def texts(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes)), self.sizes)

    @property
    def firsts(self) -> np.ndarray:
        return (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]

    def before(self, values: np.ndarray, at_start) -> np.ndarray:
        """For each word, the value of the one before it in the text."""
        out = np.empty_like(values)
        out[..., 1:] = values[..., :-1]
        out[..., self.firsts] = at_start
        return out

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys of all words, the start and all pairs; the order that sorts them; the pair of each word."""
        own, start = self.hashes[self.codes], string_hashes([""])
        different, pairs = np.unique(mixed(mixed(self.before(own, start[0])) + own), return_inverse=True)
        keys = np.concatenate([self.hashes, start, different])
        return keys, np.argsort(keys, kind="stable"), pairs


def by_model(places: np.ndarray, target: np.ndarray, n: int) -> np.ndarray:
    """Counts at each place, apart for rows of the target and of the background."""
    return np.vstack([np.bincount(places[own], minlength=n) for own in (target, ~target)])


def in_text(places: np.ndarray, texts: np.ndarray, n: int) -> np.ndarray:
    """For each word, how often its place occurs in its text."""
    _, runs, counts = np.unique(places.astype(np.int64) * n + texts, return_inverse=True, return_counts=True)
    return counts[runs]


def packed(rows: Iterable[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows whose arrays go compressed, the first bytes of all numbers, then the second ones and so on."""
    press = zstandard.ZstdCompressor(level=1).compress

    def planes(array: np.ndarray) -> bytes:
        array = np.ascontiguousarray(array).reshape(-1)
        return press(array.view(np.uint8).reshape(-1, array.itemsize).T.tobytes())

    for some in itertools.batched(rows, ROWS_A_BATCH):
        bare = [
            {k: planes(v) if isinstance(v, np.ndarray) else v for k, v in row.items()} for row in some
        ]
        yield pa.RecordBatch.from_pylist(bare, schema)


def unpacked(table: pa.Table | pa.RecordBatch, name: str, kind: type) -> Iterator[np.ndarray]:
    """The arrays of a column, in the order of the rows."""
    expand = zstandard.ZstdDecompressor().decompress
    size = np.dtype(kind).itemsize
    for value in table[name]:
        planes = np.frombuffer(expand(value.as_py()), np.uint8).reshape(size, -1)
        yield np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def schema_of(arrays: dict[str, type], *longs: str) -> pa.Schema:
    return pa.schema([*((name, pa.int64()) for name in longs), *((name, pa.binary()) for name in arrays)])


def ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{field.name} {'long' if field.type == pa.int64() else 'binary'}" for field in schema)


CUT = schema_of(SLICE, "slice", "target_words", "background_words")
ASKED = schema_of(REQUEST, "bucket", "slice")
ANSWERED = schema_of(ANSWER, "bucket", "slice", "vocabulary")


def cut(rows: DataFrame) -> DataFrame:
    """A row for each slice of texts. To be written, as a task that runs again may cut otherwise."""

    def of(number: int, part: pa.Table) -> dict:
        tokens = Tokens.of(part)
        ids = one_array(part, "doc_id")
        arrays = (
            ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(False), tokens.target, tokens.sizes,
            tokens.hashes, tokens.codes.astype(np.uint32),
        )
        own = int(tokens.sizes[tokens.target].sum())
        totals = {"target_words": own, "background_words": len(tokens.codes) - own}
        return {"slice": number} | totals | dict(zip(SLICE, arrays))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for number, part in enumerate(slices(batches), first):
            yield from packed([of(number, part)], CUT)

    return rows.mapInArrow(run, ddl(CUT))


def tokens_of(table: pa.Table | pa.RecordBatch) -> Iterator[Tokens]:
    names = ("sizes", "target", "hashes", "codes")
    return map(Tokens, *(unpacked(table, name, SLICE[name]) for name in names))


def requests(number: int, tokens: Tokens, buckets: int) -> Iterator[dict]:
    """For each bucket the keys that a slice asks for."""
    if not len(tokens.codes):
        return
    keys, order, pairs = tokens.keys()
    n = len(tokens.hashes)
    target = np.repeat(tokens.target, tokens.sizes)
    starts = tokens.target[tokens.sizes > 0]
    own = np.hstack(
        [
            by_model(tokens.codes, target, n),
            by_model(np.zeros(len(starts), np.int64), starts, 1),
            by_model(pairs, target, len(keys) - n - 1),
        ]
    )[:, order]
    keys, is_word = keys[order], order < n
    bucket = (keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    numbers, firsts = np.unique(bucket, return_index=True)
    for one, a, b in zip(numbers.tolist(), firsts, [*firsts[1:], len(keys)]):
        # The keys rise; as differences they have leading zeros.
        steps = np.diff(keys[a:b], prepend=np.uint64(0))
        found = (steps, is_word[a:b], own[:, a:b].astype(np.uint32))
        yield {"bucket": one, "slice": number} | dict(zip(REQUEST, found))


def asked(cuts: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, tokens in zip(batch["slice"].to_pylist(), tokens_of(batch)):
                yield from packed(requests(number, tokens, buckets), ASKED)

    return cuts.select("slice", *SLICE).mapInArrow(run, ddl(ASKED))


def answered(table: pa.Table) -> pa.Table:
    """The sums of a bucket's keys for each slice that asked, and the number of words among the keys."""
    table = table.sort_by("slice")
    parts = [np.cumsum(one, dtype=np.uint64) for one in unpacked(table, "keys", np.uint64)]
    ends = np.cumsum([0, *map(len, parts)])
    keys, places = np.unique(np.concatenate(parts), return_inverse=True)
    del parts
    spans = list(zip(ends[:-1], ends[1:]))
    sums, is_word = np.zeros((2, len(keys)), np.int64), np.zeros(len(keys), bool)
    flags, owns = (unpacked(table, name, REQUEST[name]) for name in ("is_word", "own"))
    for (a, b), flag, own in zip(spans, flags, owns):
        # The keys of a slice are different ones, so no place comes twice.
        sums[:, places[a:b]] += own.reshape(2, -1)
        is_word[places[a:b]] |= flag
    new_words = itertools.chain([int(is_word.sum())], itertools.repeat(0))
    found = (
        {"bucket": bucket, "slice": number, "vocabulary": new, "sums": sums[:, places[a:b]]}
        for bucket, number, new, (a, b) in zip(
            table["bucket"].to_pylist(), table["slice"].to_pylist(), new_words, spans
        )
    )
    return pa.Table.from_batches(packed(found, ANSWERED), ANSWERED)


def losses(tokens: Tokens, sums: np.ndarray, seen: np.ndarray, vocabulary: int) -> np.ndarray:
    """Summed losses of each text under both models, out of the sums of the slice's keys."""
    n, texts = len(tokens.sizes), tokens.texts
    if not len(texts):
        return np.zeros((2, n))
    keys, order, pairs = tokens.keys()
    counts = np.empty(sums.shape)
    counts[:, order] = sums
    words_end = len(tokens.hashes)
    of_word, of_pair = counts[:, tokens.codes], counts[:, words_end + 1 :][:, pairs]
    of_before = tokens.before(of_word, counts[:, words_end : words_end + 1])
    word_here = in_text(tokens.codes, texts, n)
    before_here = tokens.before(word_here, 1)
    pair_here = in_text(pairs, texts, n)
    least = seen[seen > 0].min()
    out = []
    for model, is_own in enumerate((tokens.target[texts], ~tokens.target[texts])):
        scale = least / max(seen[model], 1)
        frequency = (scale * (of_word[model] - is_own * word_here) + 1) / (scale * seen[model] + vocabulary)
        given = np.log(scale * (of_before[model] - is_own * before_here) + SMOOTHING)
        both = np.log(scale * (of_pair[model] - is_own * pair_here) + SMOOTHING * frequency)
        out.append(np.bincount(texts, given - both, n))
    return np.vstack(out)


def scored(cuts: pa.Table, answers: pa.Table, seen: np.ndarray, vocabulary: int) -> pa.Table:
    """The scores of a slice's documents."""
    tokens = next(tokens_of(cuts))
    sums = [np.empty((2, 0), np.int64)]
    sums += [one.reshape(2, -1) for one in unpacked(answers.sort_by("bucket"), "sums", ANSWER["sums"])]
    summed = losses(tokens, np.hstack(sums), seen, vocabulary)
    ids, without_id = (next(unpacked(cuts, name, SLICE[name])) for name in ("ids", "without_id"))
    number = np.maximum(tokens.sizes, 1)
    means = np.round(summed / number, DECIMALS)
    difference = np.round((summed[0] - summed[1]) / number, DECIMALS)
    return pa.table(
        {
            "doc_id": pa.array(ids, mask=without_id),
            "n_tokens": tokens.sizes,
            "target_loss": means[0],
            "background_loss": means[1],
            "score": difference,
        }
    )


def score(docs: DataFrame, target: DataFrame, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """Mean losses and their difference for every row; `target` has the doc_ids of target documents."""
    ready(docs.sparkSession)
    cuts = written(cut(flagged(docs, target)), "slices")
    totals = cuts.agg(F.sum("target_words"), F.sum("background_words")).first()
    seen = np.array([total or 0 for total in totals], np.float64)
    buckets = max(1, -(-int(seen.sum()) // bucket_words))
    answers = asked(cuts, buckets).groupBy("bucket").applyInArrow(answered, ddl(ANSWERED))
    answers = written(answers, "answers")
    vocabulary = answers.agg(F.sum("vocabulary")).first()[0] or 0
    return (
        cuts.select("slice", *SLICE)
        .groupBy("slice")
        .cogroup(answers.drop("vocabulary").groupBy("slice"))
        .applyInArrow(lambda left, right: scored(left, right, seen, vocabulary), SCORED)
    )
