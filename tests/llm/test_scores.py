"""Personal data, toxicity, top-k, language models and the pipeline."""

import hashlib
import math
import random
import re
import time
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from brute import (
    SMALL, base_spans, components, contamination, documents, language_model, short_copies, table,
)
from check import oracle_rows, spark_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from baleflow.llm import lm_score, pii, topk, toxicity
from baleflow.llm.oracle import SQL
from baleflow.llm.queries import QUERIES
from baleflow.session import written


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == oracle_rows(SMALL, SQL[name])


@settings(max_examples=400, deadline=None)
@given(st.text("0123456789.@-+ ()aB%,\n", max_size=50))
def test_base_spans(text):
    assert pii.base_spans(text) == base_spans(text)


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "1." * 100_000, "+1" + "(" * 200_000, "a@" * 90_000, "1 " * 90_000])
def test_long_runs_take_linear_time(text):
    assert pii.find(text, np.zeros(0), 0.95, {})[0] is not None


def test_many_added_spans_take_linear_time():
    """Spans are held against their neighbours, not against all: twice the text takes about twice as long."""
    weights = pii.fit(np.array([[3, 2 * 27 + 2 * 9 + 2 * 3 + 2, 0, 50], [3, 0, 0, 50]], np.int64))
    took = []
    for n in (2000, 8000):
        text = " ".join(f"call 521 555 {1000 + k % 9000} or +1 (521) 555-{1000 + k % 9000}" for k in range(n))
        start = time.perf_counter()
        base, added = pii.find(text, weights, -1.0, {})
        took.append(time.perf_counter() - start)
        spans = sorted(base + added)
        assert len(base) >= n and all(a[2] <= b[0] for a, b in zip(spans, spans[1:]))
    assert took[1] < 10 * took[0]


def test_spans_of_documents(edge_docs, edges):
    rows = pii.scan(edge_docs).collect()
    assert len(rows) == len(edges) + 2
    texts = dict(edges)
    for row in rows:
        base = base_spans(texts.get(row.doc_id, "no id"))
        listed = ",".join(f"{pii.KINDS[kind]}:{start}:{end}" for start, kind, end in base)
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) <= set(row.spans.split(","))
        assert row.n_added == (len(row.spans.split(",")) if row.spans else 0) - len(base)
    assert sum(row.n_card for row in rows) and sum(row.n_phone for row in rows)


def test_labelers_add_what_they_agree_on(spark, no_docs):
    rng = random.Random(1)
    rows = []
    for k in range(60):
        user = f"{rng.choice('abcdef')}{k}"
        rows.append((k, f"my mail is {user}@mail{k % 5}.example.com, phone +1 (521) 555-{1000 + k}"))
        rows.append((100 + k, f"my mail is {user} (at) example (dot) com, so contact me"))
        rows.append((200 + k, f"order no {rng.randint(10**15, 10**16 - 1)} and version 1.2.3.{300 + k}"))
    found = pii.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    added = {row.doc_id: row.spans for row in found if row.n_added}
    assert set(added) == set(range(100, 160))
    assert all(spans.startswith("email:11:") for spans in added.values())
    assert pii.scan(no_docs).count() == 0


def test_reliabilities_find_the_noisy_labeler():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.5
    right = lambda p: np.where(rng.random(4000) < p, truth, ~truth) * 2
    votes = np.column_stack([right(0.95), right(0.9), right(0.85), right(0.5)])
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    posterior, table = pii.reliabilities(patterns, np.zeros(len(patterns), int), counts.astype(float))
    assert table[0, 1, 2] > 0.9 and table[1, 1, 2] > 0.85 and 0.4 < table[3, 1, 2] < 0.6
    lookup = {tuple(p): q for p, q in zip(patterns, posterior)}
    guess = np.array([lookup[tuple(v)] > 0.5 for v in votes])
    assert (guess == truth).mean() > 0.95


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    labelled = docs.join(labels, "doc_id", "left_semi")
    model = toxicity.train(docs, labels)
    scores = toxicity.score(labelled, model).withColumn("held", toxicity.held_out(F.col("doc_id")))
    got = scores.join(labels, "doc_id").where("held").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert all(zlib.crc32(str(doc_id).encode()) % 3 == 1 for doc_id in got["doc_id"])
    toxic, guess = got["toxic"] == 1, got["predicted"] == 1
    assert guess[toxic].mean() >= 0.9 and guess[~toxic].mean() < 0.01
    for lang in ("en", "de", "fr", "es"):
        own = got["lang"] == lang
        assert guess[toxic & own].mean() > 0.85 and guess[~toxic & own].mean() < 0.03, lang
    assert got["score"].between(0, 1).all()


def test_distances_are_those_of_single_frames():
    """Windows compressed together have the lengths they have one by one."""
    words = [word for _, text in documents()[:20] for word in (text or "").split()][:3000]
    base, added = b" ordinary text of the corpus " * 40, b" cretin  idiot  verdammter "
    words += ["cretin", "idiot", "verdammter", "idiots", "", "x" * 5000]
    pair = toxicity.Model(base, added, np.zeros(0)).compressors()
    got = toxicity.distances(pa.array(words), *pair)
    for word, far in zip(words, got.tolist()):
        ordinary, toxic = (len(one.compress(b" " + word.encode() + b" " + toxicity.TAIL)) for one in pair)
        assert far == (ordinary - toxic if toxic <= toxicity.SHORT else 0)
    assert min(got[words.index(word)] for word in ("cretin", "verdammter")) > 0


def test_threshold_lies_above_the_ordinary_rows():
    logits = np.r_[np.full(990, -6.0), np.linspace(-1, 0.4, 10)]
    shift = toxicity.allowance(logits)
    above = (logits + shift >= np.log(0.7 / 0.3)).mean()
    assert shift > 0 and above <= toxicity.FALSE_ALARMS
    assert toxicity.allowance(np.full(1000, -9.0)) == pytest.approx(np.log(0.7 / 0.3) - np.log(0.3 / 0.7))
    assert toxicity.allowance(np.full(1000, 5.0)) == 0


def test_sample_is_bounded_in_bytes(spark):
    rows = [(k, "long " * 4000 if k % 5 == 0 else f"text number {k} of some words") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    seen = []
    plain = toxicity.fit
    toxicity.fit = lambda toxic, ordinary, share: seen.append((toxic, ordinary))
    try:
        toxicity.train(docs, labels, most_bytes=5000)
    finally:
        toxicity.fit = plain
    assert all(0 < sum(len(text) for text in texts) <= 5000 for texts in seen[0])
    assert not any(text.startswith("long") for texts in seen[0] for text in texts)


def test_toxicity_edges(spark, edge_docs, no_docs, edges):
    labels = spark.createDataFrame([(1, 0, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.train(edge_docs, labels) is None
    rows = toxicity.score(edge_docs, None).collect()
    assert len(rows) == len(edges) + 2 and {row.score for row in rows} == {0.0}
    assert toxicity.ordinary(edge_docs, None).count() == len(edges) + 2
    texts = [text or "" for _, text in edges]
    model = toxicity.fit(["you utter cretin " + text[:80] for text in texts] * 2, texts * 2, 0.2)
    scored = {row.doc_id: row.score for row in toxicity.score(edge_docs, model).collect()}
    assert all(0 <= score <= 1 for score in scored.values()) and scored[500] == scored[501]
    left = toxicity.ordinary(edge_docs, model)
    assert left.columns == edge_docs.columns and left.where("text IS NULL").count() == 2
    assert toxicity.score(no_docs, model).count() == 0


def vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(n, [float(x) for x in rng.normal(size=6)]) for n in range(120)]
    rows += [(200 + n, [3.0, 0.0, 0.0, 0.0, 0.0, 0.0]) for n in range(9)]  # ties
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (303, [float("inf")] * 6)]
    rows += [(304, []), (305, [0.0] * 6), (306, [1.0]), (350, [-5.0] * 6), (None, [9.0] * 6)]
    return rows, spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, vector int, length int")


@pytest.mark.parametrize("bucket_rows", [5, 4096])
def test_top_k(spark, bucket_rows):
    rows, table = vectors(spark)
    found = topk.top_k(table, F.col("vec_id") % 50 == 0, 5, bucket_rows=bucket_rows, query_rows=2)
    known = {}
    for number, vector in rows:
        if number is not None and vector is not None and all(x is not None and np.isfinite(x) for x in vector):
            known[number] = np.floor(256 * np.array([*vector, *[0.0] * 6])[:6]).astype(int)
    want = []
    for number in (n for n in known if n % 50 == 0):
        scored = sorted((-int(known[number] @ v), n) for n, v in known.items() if n != number)[:5]
        want += [(number, rank, n, -s) for rank, (s, n) in enumerate(scored, 1)]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_top_k_of_large_components(spark):
    rng = random.Random(6)
    rows = [(n, [rng.uniform(-1, 1) * 2.0 ** rng.choice([0, 10, 22]) for _ in range(4)]) for n in range(100)]
    rows += [(200, [2.0**24, 2.0**24, 0.0, 0.0]), (201, [-(2.0**53), 2.0**53 - 2.0**20, 0.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(table, F.col("vec_id") % 50 == 0, 5, bucket_rows=16).collect()
    whole = {n: [math.floor(256 * x) for x in v] for n, v in rows}
    want = []
    for number in (0, 50, 200):
        scored = sorted((-sum(a * b for a, b in zip(whole[number], v)), n) for n, v in whole.items() if n != number)
        want += [(number, rank, n, -s) for rank, (s, n) in enumerate(scored[:5], 1)]
    assert sorted(map(tuple, found)) == sorted(want)
    for vector in ([1e300], [2.0**53]):
        large = spark.createDataFrame([(0, vector), (1, vector)], table.schema)
        with pytest.raises(Exception, match="(?i)too large|overflow"):
            topk.top_k(large, F.col("vec_id") % 50 == 0, 5).collect()


def test_top_k_of_few_or_none(spark):
    _, table = vectors(spark)
    few = table.where("vec_id IN (50, 100, 3)")
    assert topk.top_k(few, F.col("vec_id") % 50 == 0, 5).count() == 4
    assert topk.top_k(table.where("false"), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_language_model_edges(spark, edge_docs, no_docs, edges):
    target = spark.createDataFrame([(1,), (2,), (None,), (1,)], "doc_id long")
    rows = lm_score.score(edge_docs, target).collect()
    assert len(rows) == len(edges) + 2
    assert all(row.score == 0 and row.target_loss == 0 for row in rows if not row.n_tokens)
    assert all(abs(r.target_loss - r.background_loss - r.score) < 2e-6 for r in rows)
    assert lm_score.score(no_docs, target).count() == 0
    assert lm_score.score(edge_docs, target.where("false")).count() == len(rows)


def test_language_model_prefers_its_own(spark):
    rng = random.Random(2)
    mine, others = ["red", "green", "blue", "pink"], ["one", "two", "three", "four"]
    rows = [(k, " ".join(rng.choices(mine if k % 2 else others, k=30))) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = docs.where("doc_id % 2 = 1 AND doc_id < 30").select("doc_id")
    scores = {row.doc_id: row.score for row in lm_score.score(docs, target).collect()}
    assert max(scores[k] for k in (31, 33, 35)) < min(scores[k] for k in (30, 32, 34))


@pytest.mark.parametrize("bucket_words", [lm_score.BUCKET_WORDS, 3000, 100])
def test_language_model_counts_every_word_and_pair(spark, edge_docs, edges, bucket_words):
    """However many buckets there are, the losses are those of plain counts."""
    target = spark.createDataFrame([(1,), (2,), (3,), (506,), (600,)], "doc_id long")
    rows = [*edges, (None, "no id"), (None, None)]
    want = language_model(rows, {1, 2, 3, 506, 600})
    got = [tuple(r) for r in lm_score.score(edge_docs, target, bucket_words).collect()]
    order = lambda row: (row[0] is None, row[0] or 0, row[1])
    for one, other in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert one[:2] == other[:2] and one[2:] == pytest.approx(other[2:], abs=2e-6)


def test_a_row_is_not_predicted_from_itself(spark):
    """Text that occurs once has about the same loss in the model that counted it as in the other."""
    rows = [(k, " ".join(f"w{k}x{n}" for n in range(20))) for k in range(4)] + [(4, "w3x0 w3x1 w3x2"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    scored = {r.doc_id: r for r in lm_score.score(docs, docs.where("doc_id < 2").select("doc_id")).collect()}
    assert scored[0].target_loss == scored[1].target_loss
    assert scored[0].target_loss == pytest.approx(scored[0].background_loss, abs=0.01)
    assert scored[2].background_loss > scored[3].background_loss > scored[4].background_loss


def test_pipeline_stages(spark):
    """Each stage, on what its predecessor kept, does what the operators' brute versions say."""
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    packed = corpus_pipeline.run(spark, SMALL).collect()
    ids = {row.doc_id for row in packed}
    texts = dict(documents())
    assert ids and ids <= set(texts)
    assert all(row.length <= 2048 for row in packed)
    # Of exact copies one is left at most, and no document that holds an item word by word.
    left = [re.sub(r"\s+", " ", texts[i]) for i in ids if texts[i]]
    assert len(set(left)) == len(left)
    plain = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    items = [plain(t) for (t,) in duckdb.sql(f"SELECT text FROM '{SMALL}/benchmark.parquet'").fetchall()]
    assert not [i for i in ids if any(item in plain(texts[i]) for item in items)]


def test_each_stage_on_what_its_predecessor_kept(spark):
    """Every stage against the brute versions, over the rows that the stage before it has left."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = {row.doc_id: row for row in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SMALL), f"test-{name}")
        rows = docs.collect()
        kept = {row.doc_id: row for row in rows}
        assert len(kept) == len(rows) and set(kept) <= set(before), name
        if name == "line_dedup":
            assert set(kept) == set(before)
            for i, row in kept.items():
                lines = iter((before[i].text or "").split("\n"))
                assert all(line in lines for line in (row.text or "").split("\n") if line)
        else:
            assert all(row == before[i] for i, row in kept.items()), name
        pairs = [(i, row.text) for i, row in before.items()]
        if name == "toxicity":
            model = toxicity.train(spark.createDataFrame(list(before.values()), docs.schema), spark.read.parquet(f"{SMALL}/labels.parquet"))
            scores = toxicity.score(spark.createDataFrame(list(before.values()), docs.schema), model).collect()
            assert set(kept) == {row.doc_id for row in scores if not row.predicted}
        if name == "near_dedup":
            assert set(kept) == {i for i, _, lowest in components(pairs, 5, 80) if i == lowest}
        if name == "decontamination":
            items = table(SMALL, "benchmark", "item_id, text")
            assert set(before) - set(kept) == {i for i, _ in contamination(pairs, items)} | short_copies(pairs, items)
        before = kept
    # Every document that is left is packed whole, without gaps, in sequences that are not too long.
    pieces = corpus_pipeline.pack(spark, docs, SMALL).collect()
    assert {row.doc_id for row in pieces} == set(before)
    for key, at in (("doc_id", "start"), ("sequence_id", "offset")):
        ends = {}
        for row in sorted(pieces, key=lambda row: (row[key], row[at])):
            assert row[at] == ends.get(row[key], 0)
            ends[row[key]] = row[at] + row.length
        assert key == "doc_id" or max(ends.values()) <= 2048


def test_pipeline_keeps_columns_and_survives_edges(spark, edge_docs, no_docs):
    for docs in (edge_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            result = stage(spark, docs, SMALL)
            assert result.columns == docs.columns, name
            result.count()
        assert corpus_pipeline.pack(spark, docs, SMALL).count() >= docs.count()
