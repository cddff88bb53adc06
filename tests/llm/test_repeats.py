"""Operators 3 and 5 against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcela.llm import repeats
from parcela.llm.lempelziv import PARSER as WORDS
from parcela.llm.lempelziv import remove_words
from parcela.llm.repeats import keyed
from parcela.llm.suffixes import FINDER as STRINGS
from parcela.llm.suffixes import remove_strings, suffix_array

from .conftest import corpus, prose


def by_strings(rows):
    texts = [(i, (t or "").encode()) for i, t, _ in rows]
    count = Counter(b[i:i + 200] for _, b in texts for i in range(len(b) - 199))
    out = []
    for doc, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if count[b[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc, len(b), sum(gone), spans, kept))
    return Counter(out)


def by_words(rows):
    rows = sorted({(i, t or "") for i, t, _ in rows})
    seen, out = set(), {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        gone = [False] * len(words)
        for i in range(len(words) - 19):
            window = tuple(words[i:i + 20])
            if window in seen:
                gone[i:i + 20] = [True] * 20
            seen.add(window)
        out[doc] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g))
    return out


def test_strings_equal_brute_force(docs):
    found = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_strings(docs).collect())
    assert found == by_strings(corpus())


def test_words_equal_brute_force(docs):
    expected = by_words(corpus())
    rows = remove_words(docs).collect()
    assert len(rows) == len(corpus())
    for r in rows:
        assert (r.n_words, r.n_removed, r.kept) == expected[r.doc_id]


@pytest.mark.parametrize("remove", [remove_strings, remove_words])
def test_large_anchors_are_split_into_windows(docs, remove, monkeypatch):
    expected = Counter(map(tuple, remove(docs).select("doc_id", "n_removed").collect()))
    monkeypatch.setattr(repeats, "SEGMENTS", 1)
    assert Counter(map(tuple, remove(docs).select("doc_id", "n_removed").collect())) == expected


@pytest.mark.parametrize("remove", [remove_strings, remove_words])
def test_empty_table_and_null_ids(docs, no_docs, remove):
    assert remove(no_docs).count() == 0
    nameless = docs.where("doc_id = 1").withColumn("doc_id", F.lit(None).cast("long"))
    assert [r.n_removed for r in remove(nameless.union(nameless)).collect()] == [0, 0]


def test_suffix_array():
    rng = np.random.default_rng(0)
    for n in (1, 2, 50, 300):
        symbols = rng.integers(0, 3, n).astype(np.uint16)
        symbols[-1] = 0

        def key(i, symbols=symbols):
            rest = symbols[i:i + 40].tolist()
            return rest[:rest.index(0) + 1] if 0 in rest else rest

        keys = [key(i) for i in suffix_array(symbols, 40)]
        assert len(keys) == n and keys == sorted(keys)


def test_digest_is_of_the_kept_text():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


@pytest.mark.parametrize("finder", [STRINGS, WORDS])
def test_a_large_anchor_makes_few_rows(spark, finder, monkeypatch):
    """Segments that share an anchor and differ around it: parts, not one row for each window."""
    shared, n = prose(50, 60), 40
    docs = spark.createDataFrame([(i, f"{prose(1000 + i, 60)} {shared} {prose(2000 + i, 60)}") for i in range(n)], "doc_id long, text string")
    texts = keyed(docs)
    made, wanted_texts = [], repeats.Repeats._wanted_texts

    def counted(self, texts, wanted):
        out = wanted_texts(self, texts, wanted)
        made.append((wanted.count(), out.count()))
        return out

    covers = {r.doc_id: repeats.covered(r.spots) for r in finder.spans(texts).collect()}
    assert len(covers) == n - finder.ordered
    monkeypatch.setattr(repeats.Repeats, "_wanted_texts", counted)
    monkeypatch.setattr(repeats, "SEGMENTS", 10)
    assert {r.doc_id: repeats.covered(r.spots) for r in finder.spans(texts).collect()} == covers
    assert made[0][1] <= 10 * (made[0][0] + n)  # single windows at once: 2,567 (words) and 11,318 (bytes)


@pytest.mark.parametrize("limit", [2, 8])
def test_parts_of_large_anchors_equal_brute_force(docs, limit, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENTS", limit)
    found = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in remove_strings(docs).collect())
    assert found == by_strings(corpus())
    expected = by_words(corpus())
    assert all((r.n_words, r.n_removed, r.kept) == expected[r.doc_id] for r in remove_words(docs).collect())
