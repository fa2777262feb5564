"""Toxicity by compression distance: window lengths under two zstandard dictionaries.

A window is a word with the blanks around it. The ordinary dictionary is trained on passages of ordinary
text. The toxic one holds the same base and, next to the window, the windows of toxic text that are its
own: those of at least AT_LEAST toxic documents and LIFT times the ordinary share of documents, or a
dictionary trained on them where they are more than it holds. The bytes a window saves under the toxic
dictionary are its compression distance. The number of windows at each distance feeds a logistic
calibration, fitted on documents that the dictionaries in use have not seen.

The model is fitted on the driver, on a bounded sample of labelled rows (SAMPLE rows of each class, the
rows of smallest hash, of SAMPLE_BYTES together at most: a text that would pass that is left out); the
class shares it is calibrated to are counted over all labelled rows. Scores are computed for all
documents, over their whole texts; a window that repeats in a slice of texts is compressed once.

Defined results: a null or empty text has no windows and gets the score of such a text; rows that
repeat, or without doc_id, are scored each for itself; without labels of both classes every score is
0; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import collections
import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from baleflow.llm.common import (
    by_slice, give_back, ids_and_texts, one_array, ready, shingle_hashes, slices, split_words,
    to_batches,
)
from baleflow.session import written

#: Labelled rows of a class that the model is fitted on, at most: (ordinary, toxic).
SAMPLE = (4500, 1500)
#: Bytes of text of a class that reach the driver, at most.
SAMPLE_BYTES = 64_000_000
#: Whole documents pass through `ordinary`, in slices of about so many bytes of text.
KEPT_BYTES = 2_000_000
#: Bytes of the two trained dictionaries.
BASE_BYTES, TOXIC_BYTES = 8192, 16384
#: Passages of ordinary text, of so many words, that its dictionary is trained on: the ones of smallest
#: hash among all of the sample.
PASSAGE, PASSAGES = 8, 20_000
#: A window is toxic text's own if so many toxic documents have it, so many times the ordinary share.
AT_LEAST, LIFT = 3, 30
#: A score from which on a document counts as toxic.
THRESHOLD = 0.7
#: Distances that are counted apart, and the largest that is told from larger ones.
DISTANCES, LARGEST = 12, 16
#: Bytes of a compressed window that is in a dictionary as a whole, with what stands behind it.
SHORT = 21
#: The threshold is set where so large a share of the ordinary rows lies above it, though not below so
#: low a calibrated probability.
FALSE_ALARMS, LEAST = 0.004, 0.3

# Behind every window stands this text, which both dictionaries end on or hold: zstandard looks for
# no match in the last bytes of a frame, and stores a frame as it is if little is saved.
TAIL = bytes(range(33, 57))

SCORED = "doc_id long, score double, predicted int, n_windows long"


@dataclasses.dataclass
class Model:
    base: bytes
    toxic: bytes
    weights: np.ndarray

    def compressors(self):
        return compressor(self.base + TAIL), compressor(self.base + TAIL + self.toxic)


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(
        window_log=17, hash_log=13, chain_log=13, search_log=4, min_match=3, target_length=64,
        strategy=zstandard.STRATEGY_GREEDY, write_content_size=0, write_dict_id=0, write_checksum=0,
    )
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=parameters)


def distances(words: pa.Array, ordinary, toxic) -> np.ndarray:
    """Bytes that the window of each word saves under the toxic dictionary; none where what is left is
    longer than SHORT, as then only a part of the window is in it."""
    if not len(words):
        return np.empty(0, np.int64)
    framed = [b" " + word.encode() + b" " + TAIL for word in words.to_pylist()]
    total = np.array([len(one) for one in framed], np.uint64)
    segments = np.column_stack([np.cumsum(total) - total, total]).tobytes()
    held = b"".join(framed)

    def sizes(one: zstandard.ZstdCompressor) -> np.ndarray:
        out = one.multi_compress_to_buffer(zstandard.BufferWithSegments(held, segments), threads=1)
        return np.fromiter((len(out[i]) for i in range(len(framed))), np.int64, len(framed))

    left = sizes(toxic)
    return np.where(left <= SHORT, sizes(ordinary) - left, 0)


def counted(texts: pa.Array, ordinary, toxic) -> np.ndarray:
    """Per text the number of windows, and of windows of at least each distance, and the largest."""
    codes, words, counts = split_words(texts)
    text = np.repeat(np.arange(len(texts)), counts)
    far = distances(words, ordinary, toxic)[codes] if len(codes) else np.empty(0, np.int64)
    columns = [counts]
    for least in range(1, DISTANCES + 1):
        columns.append(np.bincount(text[far >= least], minlength=len(texts)))
    largest = np.zeros(len(texts), np.int64)
    np.maximum.at(largest, text, far)
    return np.column_stack([*columns, largest])


def features(counts: np.ndarray) -> np.ndarray:
    n, by_distance, largest = counts[:, :1], counts[:, 1:-1], counts[:, -1:]
    return np.column_stack(
        [
            np.ones(len(counts)),
            np.log1p(n),
            np.log1p(by_distance),
            np.minimum(by_distance[:, 1:], 2),
            by_distance[:, 1:] / np.maximum(n, 10) * 10,
            np.minimum(largest, LARGEST),
        ]
    ).astype(float)


def logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(40):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weights * (y - p)) - 0.1 * w
        curve = (x * (weights * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x
        w += np.linalg.solve(curve + 0.1 * np.eye(len(w)), slope)
    return w


def unlike(texts: list[str]) -> list[str]:
    """Texts without exact copies, and without most near copies: one for each smallest hash."""
    seen, out = set(), []
    for text in dict.fromkeys(texts):
        shingles, _ = shingle_hashes(pa.array([text], pa.string()), 3)
        key = int(shingles.min()) if len(shingles) else text
        if key not in seen:
            seen.add(key)
            out.append(text)
    return out


def shares(texts: list[str]) -> collections.Counter:
    """Words, and the number of texts that have each."""
    held = collections.Counter()
    for text in texts:
        held.update(split_words(pa.array([text], pa.string()))[1].to_pylist())
    return held


def passages(texts: list[str]) -> list[bytes]:
    """Distinct passages of PASSAGE words; at most PASSAGES, those of smallest hash."""
    out: dict[int, bytes] = {}
    for text in texts:
        words = text.lower().split()
        for first in range(0, len(words), PASSAGE):
            held = f" {' '.join(words[first : first + PASSAGE])} ".encode()
            out[xxhash.xxh3_64_intdigest(held)] = held
        if len(out) > 4 * PASSAGES:
            out = {key: out[key] for key in sorted(out)[:PASSAGES]}
    return [out[key] for key in sorted(out)[:PASSAGES]]


def trained(samples: list[bytes], size: int, **options) -> bytes:
    """The content of a dictionary trained on samples; their text itself where they are too few."""
    try:
        content = zstandard.train_dictionary(size + 512, samples, **options).as_bytes()
    except zstandard.ZstdError:
        content = b"".join(dict.fromkeys(samples))
    return content[-size:]


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    toxic, ordinary = unlike(toxic), unlike(ordinary)
    own, others = shares(toxic), shares(ordinary)
    most = LIFT * len(toxic) / max(len(ordinary), 1)
    telling = [word for word, n in own.items() if n >= AT_LEAST and n >= most * (others[word] + 0.5)]
    # The most frequent ones last, nearest to the window that is compressed.
    telling.sort(key=lambda word: (own[word], word))
    windows = [f" {word} ".encode() for word in telling]
    base = trained(passages(ordinary), BASE_BYTES, k=32, d=6)
    added = b"".join(windows)
    return base, added if len(added) <= TOXIC_BYTES else trained(windows, TOXIC_BYTES, k=16, d=6)


def fit(toxic: list[str], ordinary: list[str], share: float) -> Model:
    """Dictionaries from the whole sample, calibrated on halves that theirs have not seen.

    share: the share of toxic rows to calibrate for.
    """
    x, y = [], []
    for half in (0, 1):
        base, added = dictionaries(toxic[half::2], ordinary[half::2])
        pair = Model(base, added, np.zeros(0)).compressors()
        for label, texts in ((1, toxic[1 - half :: 2]), (0, ordinary[1 - half :: 2])):
            rows = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
            for part in slices(iter([rows]), most=KEPT_BYTES):
                x.append(features(counted(one_array(part, "text"), *pair)))
            y.append(np.full(len(texts), label))
    x, y = np.concatenate(x), np.concatenate(y)
    weights = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    fitted = logistic(x, y, weights)
    fitted[0] += allowance(x[y == 0] @ fitted)
    base, added = dictionaries(toxic, ordinary)
    return Model(base, added, fitted)


def allowance(ordinary: np.ndarray) -> float:
    """What to add to every logit, so that THRESHOLD lies where ordinary rows allow it."""
    logit = lambda p: float(np.log(p / (1 - p)))
    # The largest logit that too many ordinary rows have: the threshold lies just above it.
    most = np.sort(ordinary)[::-1][int(FALSE_ALARMS * len(ordinary))]
    return max(0.0, logit(THRESHOLD) - max(float(most) + 1e-6, logit(LEAST)))


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learnt from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample: tuple[int, int] = SAMPLE,
    most_bytes: int = SAMPLE_BYTES,
) -> Model | None:
    """The model, or None where labels of a class are missing."""
    ready(docs.sparkSession)
    labelled = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .where(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    counts = dict(labelled.groupBy("toxic").count().collect())
    texts = []
    for label, rows in enumerate(sample):
        some = labelled.where(F.col("toxic") == label).select("doc_id")
        some = some.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        # At most `rows` numbers are broadcast, as many sizes collected, and texts of so many bytes.
        found = ids_and_texts(docs).join(F.broadcast(some), "doc_id")
        one_each = written(found.groupBy("doc_id").agg(F.min("text").alias("text")), "labelled")
        turn, size = F.xxhash64("doc_id"), F.octet_length("text").alias("size")
        left, chosen = most_bytes, []
        for row in one_each.select("doc_id", size).orderBy(turn, "doc_id").collect():
            if row["size"] <= left:
                left -= row["size"]
                chosen.append(row["doc_id"])
        # As Arrow: rows would go through Python workers of their own, and executors keep those.
        ids = docs.sparkSession.createDataFrame(pa.table({"doc_id": pa.array(chosen, pa.int64())}))
        held = one_each.join(F.broadcast(ids), "doc_id").orderBy(turn, "doc_id").select("text")
        texts.append([row["text"] for row in held.collect() if row["text"]])
    if not texts[0] or not texts[1]:
        return None
    model = fit(texts[1], texts[0], counts[1] / (counts[0] + counts[1]))
    texts.clear()
    give_back()
    return model


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """A score for every row of the documents."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = model.compressors() if model else None

        def scored(part: pa.Table) -> list[pa.RecordBatch]:
            texts = one_array(part, "text")
            if model:
                counts = counted(texts, *pair)
                scores = 1 / (1 + np.exp(-np.clip(features(counts) @ model.weights, -30, 30)))
            else:
                counts, scores = np.zeros((len(texts), 1), np.int64), np.zeros(len(texts))
            return to_batches(
                {
                    "doc_id": one_array(part, "doc_id"),
                    "score": scores,
                    "predicted": (scores >= threshold).astype(np.int32),
                    "n_windows": counts[:, 0].astype(np.int64),
                }
            )

        yield from by_slice(scored)(batches)

    return ids_and_texts(docs).mapInArrow(run, SCORED)


def ordinary(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that do not count as toxic, with all their columns."""
    ready(docs.sparkSession)
    if model is None:
        return docs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = model.compressors()

        def kept(part: pa.Table) -> list[pa.RecordBatch]:
            texts = pc.fill_null(one_array(part, "text"), "")
            scores = 1 / (1 + np.exp(-np.clip(features(counted(texts, *pair)) @ model.weights, -30, 30)))
            return part.filter(pa.array(scores < threshold)).to_batches(max_chunksize=256)

        yield from by_slice(kept, KEPT_BYTES)(batches)

    return docs.mapInArrow(run, docs.schema)
