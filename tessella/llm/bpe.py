"""Byte-pair encoding and decoding by a depth-first walk over the trie of a batch's distinct words.

The last token of a prefix's encoding is the one token that ends there and is compatible with the last token of what
is before it, so one token per trie node describes the encodings of all prefixes. Words in sorted order visit
the trie depth-first: the states of the prefix that a word shares with the one before stay on the stack.

Two tokens are compatible if merging their letters by rank would not join anything across their border.
This follows the border's two sides: the last symbol of the left token and the first symbol of the right one, each growing at
the rank of its next merge, as a token's parts always have lower ranks than the token.

Null and empty texts have no tokens. Other columns are kept by encode() and not read by it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer

from .textkit import map_batches

_NEVER = 1 << 60
_CACHED_WORDS = 200_000
_CACHED_PAIRS = 1_000_000
_BEYOND_LATIN = re.compile("[^\0-ɏ]")
_LATIN_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
_ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0d\x20a-z0-9]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    return [letters.setdefault(b, chr(256 + len(letters) - len(plain))) for b in range(256)]


def _suffixes(tokens: dict[str, int]) -> dict[str, int]:
    """Every suffix of a token, with the token's id if it is one itself, or -1."""
    out = {t[i:]: -1 for t in tokens for i in range(1, len(t))}
    return out | tokens


class TrieEncoder:
    """Encodes words by a tokenizers-library file of a byte-level BPE with an end-of-word suffix."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.library = Tokenizer.from_file(path)
        self.end = model["end_of_word_suffix"] or ""
        self.letters = byte_letters()
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
        self.name = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.merges: dict[tuple[int, int], int] = {}
        self.right: dict[int, list[tuple[int, int]]] = {}  # for each token its last symbols as it grows, with the rank that made them
        self.left: dict[int, list[tuple[int, int]]] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pair = vocab[a], vocab[b]
            self.merges.setdefault(pair, rank)
            made.setdefault(vocab[a + b], (*pair, rank))
        for token in vocab.values():
            if token not in made:
                self.right[token] = self.left[token] = [(token, -1)]
        for token, (a, b, rank) in sorted(made.items(), key=lambda x: x[1][2]):
            self.right[token] = [*self.right[b], (token, rank)]
            self.left[token] = [*self.left[a], (token, rank)]
        # a token counts only if its own letters are encoded as it
        whole = {t for t in vocab.values() if t not in made}
        for token, (a, b, rank) in sorted(made.items(), key=lambda x: x[1][2]):
            if a in whole and b in whole and self._border(a, b) == rank:
                whole.add(token)
        self.tokens = _suffixes({t: i for t, i in vocab.items() if i in whole and not (self.end and t.endswith(self.end))})
        self.ends = _suffixes({t[: -len(self.end)]: i for t, i in vocab.items() if i in whole and t.endswith(self.end)}) if self.end else self.tokens
        self.compatible: dict[int, bool] = {}
        self.digits = {i: str(i) for i in self.name}
        self.words: dict[str, tuple[list[int], str, str]] = {}

    def _border(self, a: int, b: int) -> int | None:
        """The rank of the merge across the border of two neighbouring tokens, if one comes about."""
        left, right = self.right[a], self.left[b]
        i = j = 0
        while True:
            grows_left = left[i + 1][1] if i + 1 < len(left) else _NEVER
            grows_right = right[j + 1][1] if j + 1 < len(right) else _NEVER
            across = self.merges.get((left[i][0], right[j][0]), _NEVER)
            if across < grows_left and across <= grows_right and across < _NEVER:
                return across
            if grows_left == grows_right == _NEVER:
                return None
            if grows_left <= grows_right:
                i += 1
            else:
                j += 1

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
        """(word, ids) of words in letters, in sorted order."""
        tokens, ends, compatible = self.tokens.get, self.ends.get, self.compatible
        before, states, lengths = "", [-1], [0]  # the last token, and its length, of the prefixes on the stack
        for word in sorted(words):
            shared = 0
            for x, y in zip(before, word):
                if x != y:
                    break
                shared += 1
            del states[shared + 1 :], lengths[shared + 1 :]
            size = len(word)
            for end in range(len(states), size + 1):
                find = tokens if end < size else ends
                start, last = end - 1, -1
                while start >= 0:
                    token = find(word[start:end])
                    if token is None:  # no token ends like this, nor does a longer one
                        break
                    if token >= 0:
                        if not start:
                            last = token
                            break
                        pair = states[start] << 20 | token
                        fits = compatible.get(pair)
                        if fits is None:
                            fits = compatible[pair] = states[start] >= 0 and self._border(states[start], token) is None
                        if fits:
                            last = token
                            break
                    start -= 1
                states.append(last)
                lengths.append(end - start)
            ids, at = [], size
            while at > 0:
                ids.append(states[at])
                at -= lengths[at]
            states.pop()  # the end of a word is not a prefix of the next
            lengths.pop()
            yield word, ids[::-1]
            before = word[:-1]
        if len(compatible) > _CACHED_PAIRS:
            compatible.clear()

    def pieces(self, text: str) -> list[str]:
        """The words of a text between special tokens, normalised and cut as the library does."""
        if text.isascii():
            return _ASCII_WORD.findall(text.lower())
        if not _BEYOND_LATIN.search(text):
            return _LATIN_WORD.findall(text.lower())
        spans = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        back = {c: b for b, c in enumerate(self.letters)}
        return [bytes(back[c] for c in piece).decode("utf-8") for piece, _ in spans]

    def learn(self, words: set[str]) -> None:
        """Have the encodings of these words at hand."""
        new = words - self.words.keys()
        if len(self.words) + len(new) > _CACHED_WORDS:
            self.words.clear()
            new = words
        spelt = {w if w.isascii() and w.isprintable() else "".join(self.letters[b] for b in w.encode()): w for w in new}
        digits, name = self.digits.__getitem__, self.name.__getitem__
        for letters, ids in self.encode_words(spelt):
            self.words[spelt[letters]] = ids, " ".join(map(digits, ids)), " ".join(map(name, ids))

    def parts(self, texts: list[str | None]) -> Iterator[list[tuple[list[int], str, str]]]:
        """For each text its words' ids, ids as text, and tokens as text."""
        group: list[list[str]] = []
        held = 0
        for k, text in enumerate(texts):
            group.append([])
            for part in self.split.split(text or ""):
                group[-1] += [part] if part in self.special else self.pieces(part)
            held += len(group[-1])
            if held >= 400_000 or k == len(texts) - 1:
                distinct = set().union(*group)
                self.learn(distinct - self.special.keys())
                for token, i in self.special.items():
                    self.words[token] = [i], str(i), token
                for words in group:
                    yield list(map(self.words.__getitem__, words))
                group, held = [], 0

    def forget(self) -> None:
        """Let go of what was learnt of words; a worker that goes on to other work need not hold it."""
        self.words.clear()
        self.compatible.clear()

    def decode(self, ids: Iterable[int]) -> str:
        """As the library's decode(ids, skip_special_tokens=False) without a decoder: tokens joined by spaces."""
        return " ".join(self.name[i] for i in ids)


_encoders: dict[str, TrieEncoder] = {}


def encoder(path: str) -> TrieEncoder:
    if path not in _encoders:
        _encoders[path] = TrieEncoder(path)
    return _encoders[path]


def _ids(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        for first in range(0, batch.num_rows, 512):
            part = batch.slice(first, 512)
            ids = [np.fromiter((i for w in words for i in w[0]), np.int32) for words in encoder(path).parts(part.column(at).to_pylist())]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(map(len, ids), pa.int64()), pa.array(ids, pa.list_(pa.int32()))], [*part.schema.names, "n_tokens", "ids"])
    if path in _encoders:
        encoder(path).forget()


def _digests(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    sha = lambda parts: hashlib.sha256(" ".join(p for p in parts if p).encode("utf-8", "surrogatepass")).hexdigest()
    for batch in batches:
        texts = (t.as_py() for t in batch.column(1))
        counts, of_ids, of_text = [], [], []
        for words in (w for some in _blocks(texts, 512) for w in encoder(path).parts(some)):
            counts.append(sum(len(w[0]) for w in words))
            of_ids.append(sha(w[1] for w in words))
            of_text.append(sha(w[2] for w in words))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _blocks(items: Iterable, n: int) -> Iterator[list]:
    block = []
    for item in items:
        block.append(item)
        if len(block) == n:
            yield block
            block = []
    if block:
        yield block


def _texts(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("ids")
        decoded = [encoder(path).decode(ids.as_py() or []) for ids in batch.column(at)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.string())], [*batch.schema.names, "decoded"])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """Adds n_tokens long and ids array<int>, the encoding of the whole text (replacing columns so named)."""
    docs = docs.drop("n_tokens", "ids")
    return map_batches(docs, partial(_ids, path=path), [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Adds decoded string, the text of the ids (replacing a column so named)."""
    encoded = encoded.drop("decoded")
    return map_batches(encoded, partial(_texts, path=path), [T.StructField("decoded", T.StringType())])


def encoding_digests(docs: DataFrame, path: str) -> DataFrame:
    """documents -> doc_id, n_tokens, ids_sha256 and decoded_sha256, for comparing encodings without moving them."""
    return docs.select("doc_id", "text").mapInArrow(partial(_digests, path=path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
