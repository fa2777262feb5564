"""Per-record running totals on a stream, in Spark's state store.

The state has one value for a block of neighbouring ids: the sum and the latest time of each id of the
block that was seen. A micro-batch reads and writes the blocks its messages belong to and no others, so
its cost does not depend on how many ids there are. Ids go in blocks of IDS because a value costs a
round trip between Python and the state store; neighbouring orders tend to come together, and the
publisher puts them into one file (`topics.publish_ordered`).

Spark hands a processor its rows one by one, and takes them back so, which costs more than the sums.
So the records of a block are packed before the shuffle: a row of it has all those of an Arrow batch, as
numbers one after another, and so do the rows that come out, which are unpacked behind it.

The records of a block that a micro-batch brings are put in order and summed in one task: at most as
many as the micro-batch holds, which the source bounds (`topics.FILES_PER_TRIGGER` files of at most
`topics.ROWS_PER_FILE` messages), also where one id has all of them. They are held as plain numbers.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from baleflow.operators.totals import with_time_text

#: Ids whose totals share a value of the state.
IDS = 64

STATE = "ids ARRAY<BIGINT>, amounts ARRAY<BIGINT>, times ARRAY<BIGINT>"
NUMBERED = "id BIGINT, seq BIGINT, amount BIGINT, time BIGINT"

#: Records (id, seq, amount, time), each four numbers of 64 bits as the machine has them.
PACKED = "records BINARY"
#: Records of a row that comes out of the processor, at most.
PACKED_ROWS = 65_536

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
LEAST, MOST = -(2**63), 2**63 - 1

# The processor goes to the executors as it is: this library need not be installed there for it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def sums(amounts: np.ndarray, before: int) -> np.ndarray:
    """Running sums on top of `before`; one beyond 64 bits fails."""
    near = np.cumsum(amounts, dtype=np.float64) + float(before)
    if np.abs(near).max(initial=0.0) < 2.0**62:
        return np.cumsum(amounts) + before
    out, total = np.empty(len(amounts), np.int64), before
    for place, amount in enumerate(amounts.tolist()):
        total += amount
        if not LEAST <= total <= MOST:
            raise OverflowError("overflow: a running total does not fit into 64 bits")
        out[place] = total
    return out


def _table(columns: list[np.ndarray]) -> bytes:
    return np.column_stack(columns).astype(np.int64, copy=False).tobytes()


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, id, seq, amount, time) to one row (block, records) for each block of a batch."""
    for batch in batches:
        # A null is an error here, as it was for a record on its own.
        blocks, *values = (column.to_numpy(zero_copy_only=True) for column in batch.columns)
        if not len(blocks):
            continue
        order = np.argsort(blocks, kind="stable")
        blocks, records = blocks[order], np.column_stack(values)[order]
        firsts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]])
        ends = [*firsts[1:].tolist(), len(blocks)]
        packed = [records[first:end].tobytes() for first, end in zip(firsts.tolist(), ends)]
        columns = [pa.array(blocks[firsts], pa.int64()), pa.array(packed, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["block", "records"])


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (records) to rows (id, seq, amount, time)."""
    for batch in batches:
        for value in batch.column(0):
            records = np.frombuffer(value.as_buffer(), np.int64).reshape(-1, 4)
            columns = [pa.array(np.ascontiguousarray(records[:, place])) for place in range(4)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "seq", "amount", "time"])


class RunningTotals(StatefulProcessor):
    """Sums and latest times of the ids of a block, one record out for each that comes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        packed = b"".join(row.records for row in rows)
        ids, seqs, amounts, times = np.frombuffer(packed, np.int64).reshape(-1, 4).T
        order = np.lexsort((seqs, ids))
        ids, seqs, amounts, times = ids[order], seqs[order], amounts[order], times[order]
        held = self.totals.get()
        known = {} if held is None else {one: (a, t) for one, a, t in zip(*held)}
        firsts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        totals, latest = np.empty_like(amounts), np.empty_like(times)
        for first, end in zip(firsts.tolist(), [*firsts[1:].tolist(), len(ids)]):
            number = int(ids[first])
            amount, time = known.get(number, (0, LEAST))
            totals[first:end] = sums(amounts[first:end], amount)
            latest[first:end] = np.maximum(np.maximum.accumulate(times[first:end]), time)
            known[number] = int(totals[end - 1]), int(latest[end - 1])
        values = list(known.values())
        self.totals.update((list(known), [a for a, _ in values], [t for _, t in values]))
        out = Row("records")
        for first in range(0, len(ids), PACKED_ROWS):
            part = slice(first, first + PACKED_ROWS)
            yield out(_table([ids[part], seqs[part], totals[part], latest[part]]))

    def close(self) -> None:
        pass


def running_totals(sales: DataFrame) -> DataFrame:
    """(id, seq, amount, event_time text), one for each record of a stream of (id, seq, amount, event_time).

    Records of an id must come in `seq` order from micro-batch to micro-batch; within one they are put
    in order.
    """
    time = F.expr(f"timestampdiff(MICROSECOND, {EPOCH}, event_time)")
    numbers = sales.select(
        F.expr(f"id div {IDS}").alias("block"),
        *[F.col(name).cast("bigint").alias(name) for name in ("id", "seq", "amount")],
        time.alias("time"),
    )
    packed = numbers.mapInArrow(pack, f"block BIGINT, {PACKED}")
    totals = packed.groupBy("block").transformWithState(RunningTotals(), PACKED, "Append", "None")
    records = totals.select("records").mapInArrow(unpack, NUMBERED)
    return with_time_text(
        records.select("id", "seq", "amount", F.expr(f"timestampadd(MICROSECOND, time, {EPOCH})").alias("event_time"))
    )
