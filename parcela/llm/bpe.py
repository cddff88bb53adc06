"""Operator 1: BPE encoding and decoding by batched merge rounds.

The distinct words of a batch lie in one flat array of symbols.  Each round looks every adjacent
pair up in the sorted pair keys (binary search), takes the lowest rank within each word and merges
all its occurrences, left to right; words without a known pair leave the array.  Texts are then
put together from the ids of their words.

Defined results: a null or empty text has no ids and decodes to the empty text; special tokens in
a text become their own ids; repeated rows are encoded each on its own.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from parcela.llm.shared import read
from parcela.llm.words import ranges

CACHED_WORDS = 400_000  # ids of so many words are kept between batches; then the table starts anew
WIDE = re.compile("[^\x00-\xff]")
HIGH = re.compile("[\u0870-\u1fff\u2c00-\ud7ff\uf900-\U0010ffff]")  # where later letters are
NO_RANK = np.iinfo(np.int64).max

# How the vocabulary file splits words, and the byte alphabet of byte-level BPE.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
SPLIT_LATIN = (  # the same for texts of characters up to U+00FF
    "'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    "|[^a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe \t\n\x0b\x0c\r\x85\xa0]+")
PRINTABLE = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_letters() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next above 255."""
    others = [b for b in range(256) if b not in set(PRINTABLE)]
    return [chr(b) if b in set(PRINTABLE) else chr(256 + others.index(b)) for b in range(256)]


@lru_cache(2)
def later_letters(path: str) -> tuple[dict[int, int], dict[int, str]]:
    """Where the Unicode versions of Python and of the vocabulary's library differ: letters and
    numbers that only the regular expressions know, each with a character that is neither, and
    lower-case forms that only the library knows."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    letters = [c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn"]
    parts = library.pre_tokenizer.pre_tokenize_str("".join("!" + c for c in letters))
    apart = {start for _, (start, _) in parts}
    lower = {ord(c): low for c in letters if (low := library.normalizer.normalize_str(c)) != c}
    return {ord(c): 1 for i, c in enumerate(letters) if 2 * i + 1 not in apart}, lower


@lru_cache(2)
def coder(path: str) -> WordBpe:
    """One coder for each Python worker."""
    return WordBpe(path)


class Index(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class WordBpe:
    """Encoder and decoder of a vocabulary file of lower-case BPE with word ends."""

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocabulary = model["vocab"]
        self.size = 1 + max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])])
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([vocabulary[b] for _, b in merges], np.int64)
        merged = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        keys = left * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.merged = keys[order], order.astype(np.int64), merged[order]
        letters = byte_letters()
        self.suffix = model["end_of_word_suffix"]
        self.inner = np.array([vocabulary[c] for c in letters], np.int64)
        self.last = np.array([vocabulary[c + self.suffix] for c in letters], np.int64)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = np.full(self.size, "", object)
        for token, i in vocabulary.items():
            self.tokens[i] = token
        for token, i in self.special.items():
            self.tokens[i] = token
        found = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.cut = regex.compile(f"({found})") if found else None
        self.split = regex.compile(SPLIT)
        self.split_latin = re.compile(SPLIT_LATIN)
        self._clear()

    def _clear(self) -> None:
        self.known = Index()
        self.flat = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)

    # -- words -------------------------------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """The words of a text as the merges see them; special tokens stand as they are."""
        if self.cut is None or not any(t in text for t in self.special):
            return self._plain(text)
        out: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            out += [part] if i % 2 else self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        if WIDE.search(text):
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # no final form: letters are lowered one by one
                text = text.replace("Σ", "σ")
            if HIGH.search(text):
                unknown, lower = later_letters(self.path)
                text = text.lower().translate(lower)
                if not unknown.keys().isdisjoint(map(ord, text)):
                    return [text[m.start():m.end()] for m in self.split.finditer(text.translate(unknown))]
            return self.split.findall(text.lower())
        return self.split_latin.findall(text.lower())

    def _ranks(self, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and product of the pairs that start at the given places."""
        following = np.minimum(at + 1, len(symbols) - 1)
        pair = symbols[at] * self.size + symbols[following]
        found = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
        hit = (self.keys[found] == pair) & (owner[at] == owner[following]) & (following > at)
        return np.where(hit, self.rank[found], NO_RANK), self.merged[found]

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words: one flat array and the number of ids of each word."""
        raw = [w.encode() for w in words]
        lengths = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.inner[data]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[data[ends]]
        owner = np.repeat(np.arange(len(words)), lengths)
        for i, w in enumerate(words):
            if w in self.special:
                at = ends[i] - lengths[i] + 1
                symbols[at], owner[at + 1:ends[i] + 1] = self.special[w], -1
                symbols[at + 1:ends[i] + 1] = -1
        if (owner < 0).any():
            symbols, owner = symbols[owner >= 0], owner[owner >= 0]
        done_symbols, done_owner = [], []
        rank, into = self._ranks(symbols, owner, np.arange(len(symbols)))
        while len(symbols):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            of_word = np.repeat(lowest, np.diff(np.r_[first, len(symbols)]))
            stays = of_word < NO_RANK
            done_symbols.append(symbols[~stays])
            done_owner.append(owner[~stays])
            place = np.flatnonzero(stays & (rank == of_word))
            if len(place):  # of pairs that overlap (a a a), every second one counts from the left
                fresh_run = np.r_[True, np.diff(place) > 1]
                run = np.cumsum(fresh_run) - 1
                nth = np.arange(len(place)) - np.flatnonzero(fresh_run)[run]
                place = place[nth % 2 == 0]
                symbols[place] = into[place]
                stays[place + 1] = False
            merged = np.zeros(len(symbols), bool)
            merged[place] = True
            symbols, owner, rank, into, merged = (x[stays] for x in (symbols, owner, rank, into, merged))
            if len(symbols):  # only pairs beside a merge have changed
                merged[:-1] |= merged[1:]
                changed = np.flatnonzero(merged)
                rank[changed], into[changed] = self._ranks(symbols, owner, changed)
        symbols, owner = np.concatenate(done_symbols or [symbols]), np.concatenate(done_owner or [owner])
        order = np.argsort(owner, kind="stable")
        return symbols[order], np.bincount(owner, minlength=len(words)).astype(np.int64)

    def _learn(self, fresh: list[str]) -> None:
        flat, length = self.merge(fresh)
        start = len(self.flat) + np.cumsum(length) - length
        self.flat = np.concatenate([self.flat, flat])
        self.start = np.concatenate([self.start, start])
        self.length = np.concatenate([self.length, length])

    # -- texts -------------------------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if len(self.known) > CACHED_WORDS:
            self._clear()
        learned = len(self.known)
        places = []
        for text in texts:
            words = self.words(text)
            places.append(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))
        if len(self.known) > learned:
            self._learn(list(islice(self.known, learned, None)))
        return [self.flat[ranges(self.start[at], self.length[at])] for at in places]

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by one space, as a vocabulary file without a decoder asks for."""
        return " ".join(self.tokens[ids].tolist())


def encode_texts(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, ids of the whole text and the text decoded from them."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for batch in batches:
            for texts, keys in _parts(batch):
                ids = bpe.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(ids, pa.list_(pa.int32())), pa.array([bpe.decode(i) for i in ids])],
                    names=[id_column, "ids", "decoded"])

    return docs.select(id_column, text_column).mapInArrow(run, f"{id_column} {kind}, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, number of ids, SHA-256 of the ids (32-bit little-endian) and of the decoded text."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path)
        for batch in batches:
            for texts, keys in _parts(batch):
                count, of_ids, of_text = [], [], []
                for ids in bpe.encode(texts):
                    count.append(len(ids))
                    of_ids.append(hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest())
                    of_text.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(count, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())],
                    names=[id_column, "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = f"{id_column} {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(id_column, text_column).mapInArrow(run, schema)


def _parts(batch: pa.RecordBatch, rows: int = 512) -> Iterator[tuple[list[str], pa.Array]]:
    for at in range(0, batch.num_rows, rows):
        part = batch.slice(at, rows)
        yield [t or "" for t in part.column(1).to_pylist()], part.column(0)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(read(spark, sf_dir, "documents"), vocabulary_path())
