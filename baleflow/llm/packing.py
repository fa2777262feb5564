"""Best-fit packing of token sequences, bettered by swap-based local search.

Documents are cut into pieces of at most `capacity` tokens. Pieces are dealt at random into groups
of about `group_pieces`, so a group's work is bounded whatever the input holds; each group packs its
pieces best-fit, longest first, and then lets underfull bins exchange pieces (move, one for one,
two for one) as long as that increases the sum of squared fills, until bins run empty and no underfull
bin of the group can be bettered.

Defined results: a null text is an empty document, of the end id alone; rows are packed each for
itself, also when they repeat or their doc_id is null; an empty table gives no pieces; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from baleflow.llm.bpe import encoder
from baleflow.llm.common import by_slice, ids_and_texts, one_array, ragged, ready, to_batches
from baleflow.session import written

#: Pieces that are packed together; a group loses at most about one bin against one large group.
GROUP_PIECES = 20_000
#: Ids and their places take many times the bytes of their texts, which are read in slices of so many.
IDS_BYTES = 2_000_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece of each document's ids and end id."""

    def cut(part: pa.Table) -> list[pa.RecordBatch]:
        ids, counts = encoder(tokenizer).encode(one_array(part, "text"))
        ends = np.cumsum(counts)
        ids = np.insert(ids, ends, end_id).astype("<u4")
        counts = counts + 1
        firsts = np.cumsum(counts) - counts
        n = -(-counts // capacity)
        piece = ragged(np.zeros_like(n), n)
        start = piece * capacity
        length = np.minimum(np.repeat(counts, n) - start, capacity)
        at = np.repeat(firsts, n) + start
        data = memoryview(ids).cast("B")
        crc = [zlib.crc32(data[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist())]
        return to_batches(
            {
                "doc_id": one_array(part, "doc_id").take(pa.array(np.repeat(np.arange(len(n)), n))),
                "piece": piece.astype(np.int32),
                "start": start,
                "length": length,
                "ids_crc32": np.array(crc, np.int64),
            }
        )

    return ids_and_texts(docs).mapInArrow(by_slice(cut, IDS_BYTES), PIECES)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest first, each into the fullest bin that has room for it."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r: some bin has room r
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[number].append(item)
        else:
            room, number = capacity, len(bins)
            bins.append([item])
        if room > size:
            by_room.setdefault(room - size, []).append(number)
            rooms |= 1 << (room - size)
    return bins


class LocalSearch:
    """Exchanges between the underfull bins of one group."""

    def __init__(self, bins: list[list[int]], lengths: np.ndarray, capacity: int):
        self.bins, self.lengths, self.capacity = bins, lengths, capacity
        self.bin_of = np.empty(len(lengths), np.int64)
        for number, items in enumerate(bins):
            self.bin_of[items] = number
        self.fill = np.bincount(self.bin_of, weights=lengths, minlength=len(bins)).astype(np.int64)
        self.tally()

    def tally(self) -> None:
        """The items of bins that have room: the only ones an exchange can better."""
        self.items = np.flatnonzero(self.fill[self.bin_of] < self.capacity)

    def move(self, item: int, to: int) -> None:
        source = self.bin_of[item]
        self.bins[source].remove(item)
        self.bins[to].append(item)
        self.bin_of[item] = to
        self.fill[source] -= self.lengths[item]
        self.fill[to] += self.lengths[item]

    def better(self, source: int) -> bool:
        """Carry out the best exchange that takes tokens out of `source`, if there is one."""
        own = sorted(self.bins[source], key=lambda item: -self.lengths[item])
        sizes = [int(self.lengths[item]) for item in own]
        room = self.capacity - self.fill
        best = (0, None, None, None)  # gain, items out, target bin, item back
        open_bins = np.flatnonzero((self.fill > 0) & (room > 0))
        open_bins = open_bins[open_bins != source]
        for item, size in zip(own, sizes):
            fits = open_bins[room[open_bins] >= size]
            if len(fits):
                target = int(fits[np.argmax(self.fill[fits])])
                gain = 2 * size * (self.fill[target] - self.fill[source] + size)
                if gain > best[0]:
                    best = (gain, (item,), target, None)
        others = self.items[self.bin_of[self.items] != source]
        there = self.bin_of[others]
        other_sizes = self.lengths[others]
        spare, full = room[there], self.fill[there]
        out = [((item,), size) for item, size in zip(own, sizes)] + [
            ((own[i], own[j]), sizes[i] + sizes[j])
            for i in range(len(own))
            for j in range(i + 1, len(own))
        ]
        for items, size in out:
            shift = size - other_sizes
            gain = 2 * shift * (full - self.fill[source] + shift)
            gain = np.where((shift > 0) & (shift <= spare), gain, 0)
            if len(gain) and gain.max() > best[0]:
                k = int(np.argmax(gain))
                best = (int(gain[k]), items, int(there[k]), int(others[k]))
        if best[1] is None:
            return False
        _, items, target, back = best
        if back is not None:
            self.move(back, source)
        for item in items:
            self.move(item, target)
        return True

    def run(self) -> list[list[int]]:
        """Exchange until no underfull bin can be bettered, the emptiest ones first.

        An exchange changes what others can do, so all underfull bins are tried again after a round
        that had one. Each increases the sum of squared fills, so this ends.
        """
        changed = True
        while changed:
            changed = False
            order = np.argsort(self.fill, kind="stable")
            order = order[(self.fill[order] > 0) & (self.fill[order] < self.capacity)]
            for source in order.tolist():
                while self.fill[source] and self.better(source):
                    changed = True
            self.tally()
        return [items for items in self.bins if items]


def pack_group(group: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """The pieces of a group with their bin (as sequence_id) and their offset in it."""
    group = group.sort_values(["doc_id", "piece", "ids_crc32"], ignore_index=True)
    lengths = group["length"].to_numpy()
    bins = LocalSearch(best_fit(lengths, capacity), lengths, capacity).run()
    order = np.concatenate([np.array(items, np.int64) for items in bins])
    counts = np.array([len(items) for items in bins])
    number = np.repeat(np.arange(len(bins)), counts)
    sizes = lengths[order]
    before = np.cumsum(sizes) - sizes
    first = np.repeat(np.cumsum(counts) - counts, counts)
    out = group.take(order)
    return out.assign(sequence_id=number, offset=before - before[first])


def pack(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    end_id: int = 0,
    capacity: int = 2048,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Each piece with its sequence and its place there; sequences hold at most `capacity`."""
    spark = ready(docs.sparkSession)
    cut = written(pieces(docs, tokenizer, end_id, capacity), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        number = int(group["group"].iloc[0])
        out = pack_group(group, capacity)
        out["sequence_id"] += number << 32
        return out.drop(columns="group")

    packed = dealt.groupBy("group").applyInPandas(run, PACKED)
    return packed
