"""What a Python worker holds between tasks, and which workers there are."""

from __future__ import annotations

import subprocess
import sys
import weakref

import pyarrow as pa
import pytest
from pyspark import SparkContext

from baleflow.llm import common, toxicity

#: Reads 24 MB of text in one task, and prints by how many MB the process has grown after it.
TASK = """
import re
import numpy as np, pandas, pyarrow as pa, pyarrow.compute
from baleflow.llm import {module} as module
from baleflow.llm.common import by_slice, ids_and_texts

def memory():
    held = open("/proc/self/smaps_rollup").read()
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", held)[1]) / 1024

def batches():
    rng = np.random.default_rng(1)
    for first in range(0, 4096, 256):
        words = rng.integers(0, 50_000, (256, 1000)).astype(str)
        texts = ["\\n".join(" w".join(row[k : k + 10]) for k in range(0, 1000, 10)) for row in words]
        ids = pa.array(range(first, first + 256))
        yield pa.RecordBatch.from_pydict({{"doc_id": ids, "key": ids, "twin": ids, "text": texts}})

class Rows:
    def mapInArrow(self, run, schema):
        return run

module.ids_and_texts = lambda docs: Rows()
sum(batch.num_rows for batch in batches())
before = memory()
rows = sum(batch.num_rows for batch in {run}(batches()))
print(rows, memory() - before)
"""


@pytest.mark.parametrize(
    "module, run",
    [("line_templates", "by_slice(module.parse)"), ("near_dup", "module.signed(None, 5)")],
)
def test_a_worker_gives_back_what_a_task_took(module, run):
    if not sys.platform.startswith("linux"):
        pytest.skip("reads /proc")
    code = TASK.format(module=module, run=run)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    found, grown = out.stdout.split()
    assert int(found) == 4096
    assert float(grown) < 25


def test_a_slice_is_free_before_the_next_is_worked_on():
    class Held(list):
        pass

    seen = []

    def work(part):
        assert all(one() is None for one in seen)
        held = Held(part["text"].to_pylist())
        seen.append(weakref.ref(held))
        return [pa.RecordBatch.from_pydict({"n": [len(held)]})]

    batch = pa.RecordBatch.from_pydict({"text": ["x" * 400_000] * 10})
    found = list(common.by_slice(work, 1_000_000)(iter([batch] * 3)))
    assert sum(one["n"][0].as_py() for one in found) == 30
    assert len(seen) == 10


def test_the_model_is_fitted_without_rows_through_python_workers(spark, monkeypatch):
    texts = [(i, f"good plain words {i % 7} of day {i % 5}" + " vile foul" * (i % 4 == 0)) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    docs.count(), labels.count()

    def refused(*_, **__):
        raise AssertionError("rows were dealt to Python workers")

    monkeypatch.setattr(SparkContext, "parallelize", refused)
    assert toxicity.train(docs, labels) is not None
    # None of the texts is small enough: no sample, no model.
    assert toxicity.train(docs, labels, most_bytes=1) is None


def test_passages_are_those_of_smallest_hash_however_many_there_are(monkeypatch):
    texts = [" ".join(f"w{k * 31 % 997} x{k}" for k in range(first, first + 200)) for first in range(0, 9000, 150)]
    monkeypatch.setattr(toxicity, "PASSAGES", 10**6)
    every = toxicity.passages(texts)
    monkeypatch.setattr(toxicity, "PASSAGES", 50)
    assert len(every) > 2000
    assert toxicity.passages(texts) == every[:50]
