"""Hard negatives, collocations and mixtures against plain versions."""

import collections
import math
import random
import re

import numpy as np
import pytest
from brute import lower
from check import oracle_rows, spark_rows
from pyspark.sql import functions as F

from baleflow.llm import collocations, hard_negatives, mixture, oracle
from baleflow.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op12_rollup_collocations"])
def test_query_equals_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SMALL)) == oracle_rows(SMALL, oracle.SQL[name])


# Hard negatives.


def plain_negatives(rows, every, positives, negatives, window):
    """Integer products of all pairs, in Python integers."""
    used = []
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if all(x is not None and math.isfinite(x) for x in vector):
            used.append((vec_id, label, [math.floor(256 * x) for x in vector], list(vector)))
    anchors = {}
    for row in used:
        if row[0] % every == 0 and (row[0] not in anchors or (row[1], row[3]) < anchors[row[0]][1:4:2]):
            anchors[row[0]] = row
    out = []
    for vec_id, label, vector, _ in anchors.values():
        scored = [(-sum(a * b for a, b in zip(vector, other)), number, kind)
                  for number, kind, other, _ in used if number != vec_id]
        scored.sort()
        for score, positive, _ in [row for row in scored if row[2] == label][:positives]:
            fitting = [row for row in scored if row[2] != label
                       and window[0] * -score <= 100 * -row[0] <= window[1] * -score]
            for rank, (low, negative, _) in enumerate(fitting[:negatives], 1):
                out.append((vec_id, positive, rank, negative, -score, -low))
    return sorted(out)


def vectors(seed, n=300, dims=6, labels=4):
    rng = np.random.default_rng(seed)
    rows = [(int(k), int(rng.integers(labels)), [float(x) for x in rng.normal(size=dims)]) for k in range(n)]
    rows += [(1000 + k, 1, rows[5][2]) for k in range(40)]  # ties
    rows += [(7, 2, rows[9][2]), (7, 2, rows[9][2]), (10, 0, rows[3][2])]  # ids that repeat
    rows += [(2000, 1, None), (2010, None, [1.0]), (None, 1, [1.0]), (2020, 1, [1.0, None]),
             (2030, 1, [float("nan")]), (2040, 1, [float("inf")]), (2050, 1, []), (2060, 2, [0.0] * dims),
             (2070, 3, [0.5, 0.25])]
    return rows


def negatives(spark, rows, **options):
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, span int, `group` int")
    chosen = F.col("vec_id") % 10 == 0
    return hard_negatives.hard_negatives(table.repartition(3), chosen, F.col("label"), **options)


@pytest.mark.parametrize("sizes", [(8192, 4, 1024), (16, 2, 7)])
@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives(spark, sizes, seed):
    rows = vectors(seed)
    blocks, spans, groups = sizes
    found = negatives(spark, [(*row, 1, 2) for row in rows], block_rows=blocks, span_blocks=spans, group_rows=groups)
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows, 10, 5, 3, (50, 95))


def test_large_components_are_exact(spark):
    rng = random.Random(4)
    rows = [(k, k % 2, [rng.uniform(-1, 1) * 2.0 ** rng.choice([0, 20, 21]) for _ in range(4)]) for k in range(60)]
    found = negatives(spark, [(*row, 1, 2) for row in rows], block_rows=16)
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows, 10, 5, 3, (50, 95))
    with pytest.raises(Exception, match="(?i)overflow|too large|does not fit"):
        negatives(spark, [(k, k % 2, [1e20], 1, 2) for k in range(20)]).collect()


def test_no_vectors(spark):
    assert negatives(spark, []).count() == 0
    assert negatives(spark, [(1, 1, [1.0], 1, 2)]).count() == 0


def test_reading_stops_strictly_below_the_last_score():
    windows = hard_negatives.Windows([(float("-inf"), float("inf")), (10, 5)], 2)
    windows.show(np.array([4, 3, 9]), np.array([7, 7, 8]))
    assert windows.found[0] == [(-8, 9), (-7, 3)] and windows.found[1] == []
    assert not windows.settled(7) and windows.settled(6)


def test_sorted_access_reads_less_where_scores_differ():
    """Vectors along one axis: the best are at the ends of the lists."""
    vectors = np.zeros((5000, 3), np.int16)
    vectors[:, 0] = np.arange(5000) % 4999
    lists = hard_negatives.Lists(np.arange(5000), np.zeros(5000, np.int64), vectors)
    windows = hard_negatives.Windows([(float("-inf"), float("inf"))], 3)
    shown = []
    plain = windows.show
    windows.show = lambda ids, scores: (shown.append(len(ids)), plain(ids, scores))
    lists.search(np.array([2, 0, 0], np.int16), np.ones(5000, bool), windows)
    assert sum(shown) < 200 and windows.found[0][0] == (-9996, 4998)


# Collocations.


def plain_collocations(rows, first, longest, least, cover):
    counted = collections.defaultdict(collections.Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", lower(text)):
            words = [word for word in re.split(r"[ \t]+", piece) if word]
            for m in range(1, longest + 1):
                counted[lang or "und" if lang is None else lang].update(zip(*[words[k:] for k in range(m)]))
    out = []
    for lang, held in counted.items():
        n = sum(number for phrase, number in held.items() if len(phrase) == 1)
        phrases = {phrase: a for phrase, a in held.items() if len(phrase) > 1 and a >= least}
        ranked = []
        for phrase, a in phrases.items():
            within = [b for other, b in phrases.items() if len(other) > len(phrase) and any(
                other[k : k + len(phrase)] == phrase for k in range(len(other) - len(phrase) + 1))]
            if any(100 * b >= cover * a for b in within):
                continue
            cuts = []
            for k in range(1, len(phrase)):
                l, r = held[phrase[:k]], held[phrase[k:]]
                cuts.append((10**6 * a * a // (l * r), k, l, r))
            score, _, l, r = min(cuts)
            ranked.append((-score, -a, " ".join(phrase).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(ranked)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def texts(seed=5):
    rng = random.Random(seed)
    words = ["the", "The", "of", "ñu", "É", "new", "york", "a-b", "=", "\x1c", "日本"]
    rows = []
    for _ in range(60):
        lang = rng.choice(["en", "de", None, "und", ""])
        parts = [rng.choice(words) + rng.choice([" ", " ", "\t", ", ", "\n", "  ", "."]) for _ in range(40)]
        rows.append((lang, "".join(parts)))
    rows += [("en", None), ("en", ""), (None, " .,. "), ("fr", "one"), ("en", "new york " * 500), rows[0], rows[0]]
    return rows


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_collocations(spark, longest):
    rows = texts()
    docs = spark.createDataFrame([(*row, 1, 2) for row in rows], "lang string, text string, n int, w1 int")
    found = collocations.collocations(docs.repartition(5), 25, longest, 3, 50).collect()
    assert sorted(map(tuple, found)) == plain_collocations(rows, 25, longest, 3, 50)


def test_windows_may_be_longer_where_bits_are_shared(spark):
    rows = texts(6) + [("en", " ".join(f"w{k * k % 9973}" for k in range(9000)))] * 4
    docs = spark.createDataFrame(rows, "lang string, text string")
    found = collocations.collocations(docs, 25, 3, 3, 50, 1 << 15).collect()
    assert sorted(map(tuple, found)) == plain_collocations(rows, 25, 3, 3, 50)


def test_keys_that_meet_are_replaced(spark):
    """Eight words on 32 keys: with most seeds two of them meet."""
    seeds = []
    for part in range(3):
        docs = spark.createDataFrame([("en", " ".join(f"w{part}{k}" for k in range(8)))] * 3, "lang string, text string")
        _, frequent, keys, _ = collocations.vocabulary(collocations.texts_by_language(docs), 3, 1 << 15, 5)
        seeds.append(keys.seed)
        held = [row.key for row in frequent.collect()]
        assert len(set(held)) == 8 and 0 not in held
    assert max(seeds) > 0


def test_scores_beyond_64_bits_are_exact(spark):
    a, l, r = 7 * 10**11, 8 * 10**11 + 1, 9 * 10**11 + 7
    row = spark.createDataFrame([(a, l, r)], "a long, l long, r long")
    got = row.select(collocations.score(F.col("a"), F.col("l"), F.col("r"))).first()[0]
    assert got == 10**6 * a * a // (l * r)


def test_no_phrases(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).count() == 0
    few = spark.createDataFrame([("en", "one two")], "lang string, text string")
    assert collocations.collocations(few).count() == 0


# Mixtures.


def plain_targets(sizes, weights, most):
    """source -> target, by sharing again what full sources leave."""
    names = sorted((name for name in sizes if name is not None), key=lambda name: [ord(c) for c in name])
    names += [None] if None in sizes else []
    weight = {name: weights[k % len(weights)] for k, name in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[name] for name in full)
        share = sum(weight[name] for name in names if name not in full)
        target = {name: most * sizes[name] if name in full else left * weight[name] / share for name in names}
        over = {name for name in names if name not in full and target[name] > most * sizes[name] * (1 + 1e-12)}
        if not over:
            return target
        full |= over


def mixture_rows(seed=8):
    rng = random.Random(seed)
    rows = []
    for k in range(900):
        source = rng.choice(["a", "a", "a", "B", "é", "z", None, "", "日", "𝒳", "ﬀ"])
        rows.append((k, source, " ".join(["w"] * int(rng.lognormvariate(2, 1.2)))))
    rows += [(2000, "a", None), (2001, "empty", ""), (2002, "empty", None), (None, "a", "x y"), (None, "a", "x y")]
    rows += [(3000, "z", "same text"), (3000, "z", "same text"), (3001, "b", "w " * 5000)]
    rows += [(4000 + k, "a", "copy of one text") for k in range(300)]
    return rows


@pytest.mark.parametrize("task_rows", [1_000_000, 50])
def test_mixture(spark, monkeypatch, task_rows):
    monkeypatch.setattr(mixture.number_by, "__defaults__", (task_rows,))
    rows = mixture_rows()
    schema = "doc_id long, source string, text string, size int, n int, row int, more int"
    docs = spark.createDataFrame([(*row, 1, 2, 3, 4) for row in rows], schema)
    got = mixture.digest(docs.repartition(4)).collect()
    again = mixture.digest(docs.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    size = lambda text: len((text or "").split())
    sizes = collections.Counter()
    for _, source, text in rows:
        sizes[source] += size(text)
    target = plain_targets(sizes, mixture.WEIGHTS, 2)
    source_of = {doc_id: source for doc_id, source, _ in rows}
    want = sorted(((doc_id, size(text), sizes[source]) for doc_id, source, text in rows), key=str)
    assert sorted(((r.doc_id, r.size, r.source_size) for r in got), key=str) == want
    taken = collections.Counter()
    for row in got:
        source = source_of[row.doc_id] if row.doc_id is not None else "a"
        assert row.target == pytest.approx(target[source]) and row.taken == row.size * row.copies <= 2 * row.size
        taken[source] += row.taken
    # Within half of the smallest document: `b` has only one, of 5,000 words.
    for source, words in target.items():
        assert abs(taken[source] - words) <= (2500 if source == "b" else max(2, 0.002 * words)), source


def test_rates_solve_the_dual(spark):
    """Copies of a cell are its tilted rate, but for what rounding carries on."""
    rng = random.Random(9)
    rows = [(k, rng.choice("ab"), " ".join(["w"] * rng.choice([3, 10, 40]))) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixture.digest(docs, weights=(1, 6)).collect()
    by_cell = collections.defaultdict(list)
    for row in got:
        by_cell[(row.target, row.source_size, row.size)].append(row.copies)
    for (target, source_size, size), copies in by_cell.items():
        held = {z: len(c) for (t, _, z), c in by_cell.items() if t == target}
        mean = source_size / sum(held.values())
        low, high = -50.0, 50.0
        for _ in range(200):
            tilt = (low + high) / 2
            words = sum(n * z * min(2, math.exp(tilt * z / mean)) for z, n in held.items())
            low, high = (tilt, high) if words < target else (low, tilt)
        rate = min(2, math.exp(low * size / mean))
        assert abs(np.mean(copies) - rate) < 0.05 and set(copies) <= {math.floor(rate), math.floor(rate) + 1}


def test_mixed_documents_keep_their_columns(spark):
    rows = mixture_rows(10)
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("copies", F.lit(7))
    mix = mixture.mixed(docs)
    assert mix.columns == docs.columns
    counts = collections.Counter(row.doc_id for row in mix.collect())
    want = {row.doc_id: row.copies for row in mixture.digest(docs).collect() if row.doc_id not in (None, 3000)}
    assert {key: counts[key] for key in want} == want


def test_mixture_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixture.digest(docs).count() == 0
    blank = spark.createDataFrame([(1, "a", ""), (2, None, None)], "doc_id long, source string, text string")
    assert [(r.target, r.taken) for r in mixture.digest(blank).collect()] == [(0.0, 0), (0.0, 0)]
