"""Token ids of many texts from a public tokenizer file, each distinct word encoded once.

The tokenizer splits at white space before all else and no token crosses it, so a text's ids are
the ids of its words between ASCII blanks, one after another. Most words repeat, so a worker keeps
the ids of words it has seen, up to a bound.
"""

from __future__ import annotations

import re
import string
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from baleflow.llm.common import ragged

#: A worker forgets all words when it knows more than these.
KEPT_WORDS = 400_000
#: Words of fewer bytes are kept; longer ones are encoded each time.
KEPT_BYTES = 64
#: Ends in a digit or letter that is one in every Unicode version in use.
OLD_LETTER_LAST = r"[0-9A-Za-zÀ-ÖØ-öø-ɏΑ-ΡΣ-ώА-я]$"
#: Letters that stay letters in lower case: a word of these is one piece.
PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")

_encoders: dict[str, WordEncoder] = {}


def tokenizer_path(name: str) -> str:
    """The place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(name: str) -> WordEncoder:
    """The worker's encoder of a tokenizer file, kept between tasks."""
    if name not in _encoders:
        _encoders[name] = WordEncoder(tokenizer_path(name))
    return _encoders[name]


class WordEncoder:
    """Encodes arrays of texts with a tokenizer that drops white space between words."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # The strings of special tokens are ordinary text within documents.
        self.tokenizer.encode_special_tokens = True
        # Tokens that end a word carry a mark.
        self.is_end = np.zeros(self.tokenizer.get_vocab_size(True), bool)
        for token, number in self.tokenizer.get_vocab(True).items():
            self.is_end[number] = token.endswith("</w>")
        self.forget()

    def forget(self) -> None:
        self.places: dict[str, int] = {"": 0}
        self.starts = array("q", [0])
        self.lengths = array("q", [0])
        self.ids = array("I")

    def learn(self, words: list[str]) -> None:
        """Encode new words: those of plain letters, one piece each, many in a text."""
        plain = [word for word in words if PLAIN.fullmatch(word)]
        if plain:
            texts = [" ".join(plain[k : k + 1000]) for k in range(0, len(plain), 1000)]
            encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.concatenate([np.array(one.ids, np.uint32) for one in encoded])
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(plain):
                self.keep(plain, ids, np.diff(ends, prepend=0))
            else:
                plain = []
        rest = [word for word in words if not PLAIN.fullmatch(word)] if plain else words
        if rest:
            encoded = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
            pieces = [np.array(one.ids, np.uint32) for one in encoded]
            self.keep(rest, np.concatenate(pieces), np.array([len(piece) for piece in pieces]))

    def keep(self, words: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.starts)
        starts = len(self.ids) + np.cumsum(lengths) - lengths
        self.places.update(zip(words, range(first, first + len(words))))
        self.starts.frombytes(starts.astype(np.int64).tobytes())
        self.lengths.frombytes(lengths.astype(np.int64).tobytes())
        self.ids.frombytes(ids.tobytes())

    def places_of(self, words: pa.Array) -> np.ndarray:
        """The places of words, of which new ones are encoded first."""
        distinct = words.dictionary_encode()
        names = distinct.dictionary.to_pylist()
        found = list(map(self.places.get, names))
        if None in found:
            new = [name for name, place in zip(names, found) if place is None]
            if len(self.places) + len(new) > KEPT_WORDS:
                self.forget()
                new = [name for name in names if name]
            self.learn(new)
            found = list(map(self.places.get, names))
            for name in new:
                if len(name) > KEPT_BYTES:
                    del self.places[name]
        return np.array(found, np.int64)[distinct.indices.to_numpy()]

    def parts(self, words: pa.Array) -> np.ndarray:
        """For each word the places of its body and of the punctuation behind it, in turns."""
        words = pc.if_else(pc.string_is_ascii(words), pc.ascii_lower(words), words)
        bodies = pc.ascii_rtrim(words, characters=string.punctuation)
        # Punctuation behind a letter or digit is a piece of its own, whatever stands before.
        bodies = pc.if_else(pc.match_substring_regex(bodies, OLD_LETTER_LAST), bodies, words)
        first = words.offset
        ends = np.frombuffer(words.buffers()[1], np.int32)[first + 1 : first + 1 + len(words)]
        lengths = pc.binary_length(words).to_numpy() - pc.binary_length(bodies).to_numpy()
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        tail = data[ragged(ends - lengths, lengths)]
        offsets = np.r_[0, np.cumsum(lengths)].astype(np.int32)
        tails = pa.StringArray.from_buffers(
            len(words), pa.py_buffer(offsets), pa.py_buffer(tail.tobytes())
        )
        both = self.places_of(pa.concat_arrays([bodies, tails]))
        return np.column_stack([both[: len(words)], both[len(words) :]])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another (uint32), and the number of ids of each text."""
        lists = pc.ascii_split_whitespace(texts)
        offsets = lists.offsets.to_numpy()
        words = lists.flatten().dictionary_encode()
        if not len(words):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        pairs = self.parts(words.dictionary)
        starts, lengths = np.array(self.starts), np.array(self.lengths)
        ids = np.array(self.ids, dtype=np.uint32)
        places = pairs[words.indices.to_numpy()].ravel()
        sizes = lengths[places]
        out = ids[ragged(starts[places], sizes)]
        ends = np.r_[0, np.cumsum(sizes)][2 * (offsets - offsets[0])]
        return out, np.diff(ends)
