"""Token ids, packing and token files, against the tokenizer itself."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from baleflow.llm import packing, token_files
from baleflow.llm.bpe import encoder
from baleflow.session import new_dir

NAME = "word_bpe_49k.json"


def ids(texts):
    tokenizer = encoder(NAME).tokenizer
    return [one.ids for one in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(numbers):
    return zlib.crc32(np.array(numbers, "<u4").tobytes())


ODD = [
    "", "  ", "don't we're'S x's.. 'tis", "Á́. É́x!! İstanbul ΣΑΣ.", "日本語。テキスト, 12.5% á. <|endoftext|>x",
    "कि. है! ١٢.", "\x1ca\x1d \x85b c  d", "J̌ ǰ J̌.", "%%% a%%%'s x'", "ﬁ. Ⅷ. ⅷ! ª. º,", "a" * 5000 + ".", "İ İx ß ÿ",
]


def check(texts):
    got, counts = encoder(NAME).encode(pa.array(texts, pa.string()))
    ends = np.cumsum(counts)
    assert [got[e - n : e].tolist() for e, n in zip(ends, counts)] == ids(texts)


def test_odd_texts():
    check(ODD)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=4))
def test_any_text(texts):
    check(texts)


def test_pieces_and_sequences(edge_docs, edges):
    rows = [tuple(row) for row in packing.pack(edge_docs).collect()]
    whole = [(doc_id, text) for doc_id, text in [*edges, (None, "no id"), (None, None)]]
    want = []
    for (doc_id, _), own in zip(whole, ids([text for _, text in whole])):
        own = [*own, 0]
        for piece, start in enumerate(range(0, len(own), 2048)):
            part = own[start : start + 2048]
            want.append((doc_id, piece, start, len(part), crc(part)))
    assert sorted(map(str, (row[:5] for row in rows))) == sorted(map(str, want))
    sequences = {}
    for row in rows:
        sequences.setdefault(row[5], []).append((row[6], row[3]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(row[3] for row in rows)
    assert len(sequences) <= -(-total // 2048) + 1


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_local_search_only_betters(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, [400, 900, 1500, 2048][seed], 700)
    plain = packing.best_fit(lengths, 2048)
    fill = lambda bins: sum(int(lengths[b].sum()) ** 2 for b in bins)
    search = packing.LocalSearch([list(b) for b in plain], lengths, 2048)
    searched = search.run()
    assert sorted(item for b in searched for item in b) == list(range(700))
    assert max(lengths[b].sum() for b in searched) <= 2048
    assert len(searched) <= len(plain) and fill(searched) >= fill(plain)
    # Nothing is left to better, whichever bin is asked.
    underfull = np.flatnonzero((search.fill > 0) & (search.fill < 2048)).tolist()
    assert not any(search.better(source) for source in underfull)


def test_search_saves_sequences_where_best_fit_does_not():
    """4,000 pieces of a seventh to a half of the capacity: 1,414 bins by best fit, 1,376 at least."""
    lengths = np.random.default_rng(1).integers(300, 1101, 4000)
    plain = packing.best_fit(lengths, 2048)
    searched = packing.LocalSearch([list(b) for b in plain], lengths, 2048).run()
    assert len(searched) <= len(plain) - 20 and len(searched) <= 1.015 * -(-lengths.sum() // 2048)


def test_exchanges_empty_a_bin():
    # Best fit leaves 6+3 and 5+4 in the way of 6+4 and 5+3+2.
    lengths = np.array([6, 5, 4, 3, 2])
    bins = [[0, 3], [1, 2], [4]]
    assert len(packing.LocalSearch(bins, lengths, 10).run()) == 2


def test_files_hold_all_ids(spark, edge_docs, edges):
    path = new_dir(spark, "files")
    token_files.write(edge_docs, path)
    rows = sorted(map(tuple, token_files.read(spark, path).collect()), key=lambda row: row[1])
    whole = [(None, ""), (None, "no id"), *sorted(edges, key=lambda r: (r[0], r[1] or ""))]
    at, want = 0, []
    for (doc_id, _), own in zip(whole, ids([text for _, text in whole])):
        want.append((doc_id, at, len(own) + 1, crc([*own, 2])))
        at += len(own) + 1
    assert sorted(rows[:2], key=str) != [] and rows == want


def test_files_of_nothing(spark, no_docs):
    path = new_dir(spark, "files")
    token_files.write(no_docs, path)
    assert token_files.read(spark, path).count() == 0


def test_many_blocks(spark, edge_docs, monkeypatch):
    path, small = new_dir(spark, "files"), new_dir(spark, "files")
    token_files.write(edge_docs, path)
    one = token_files.EliasFano.of(np.array([3]))
    assert one.select(0) == 3
    token_files.write(edge_docs.repartition(7), small)
    want = sorted(map(str, token_files.read(spark, path).collect()))
    assert sorted(map(str, token_files.read(spark, small).collect())) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=700))
def test_elias_fano(values):
    values = np.sort(np.array(values))
    one = token_files.EliasFano.of(values)
    again = token_files.EliasFano(one.n, one.low_bits, one.low, one.high, one.samples.tobytes())
    assert (again.all() == values).all()
    for number in range(0, len(values), 37):
        assert again.select(number) == values[number]
        assert (again.selected(number, 300) == values[number : number + 300]).all() if number + 300 <= len(values) else True
    bits = 8 * (len(one.low) + len(one.high))
    assert bits <= len(values) * (3 + np.log2(values[-1] / len(values) + 2)) + 32
