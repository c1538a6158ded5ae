"""Ranked search against a plain scoring of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from layerwright.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=20):
    held = [(i, Counter(t), len(t)) for i, text in docs if (t := plain_terms(text))]
    documents, terms = len(held), sum(size for _, _, size in held)
    holding = Counter(term for _, counts, _ in held for term in counts)
    found = []
    for item, text in items:
        wanted = Counter(plain_terms(text))
        scores = []
        for doc_id, counts, size in held:
            m = 75 + 25 * size * documents // terms
            score = sum(
                n
                * math.floor(1000 * math.log((2 * documents + 2) / (2 * holding[t] + 1)))
                * (1_000_000_000 * counts[t] // (1000 * counts[t] + 12 * m))
                for t, n in wanted.items()
                if t in counts
            )
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, missing, doc_id) in enumerate(sorted(scores)[:top], 1):
            found.append((item, rank, None if missing else doc_id, -score))
    return sorted(found, key=str)


def generated(rng, n, vocabulary=60):
    words = [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    return [" ".join(rng.choices(words, weights, k=rng.randrange(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("leaf", [1, 16])
def test_against_brute_force_over_several_segments(spark, make_docs, monkeypatch, leaf):
    monkeypatch.setattr(ranked, "LEAF", leaf)
    monkeypatch.setattr(ranked, "SEGMENT", 64)
    rng = random.Random(7)
    docs = list(enumerate(generated(rng, 400)))
    docs += [(1000 + i, docs[i % 3][1]) for i in range(60)]  # copies: ties in score
    items = [(i, t) for i, t in enumerate(generated(rng, 12) + ["", "none of these", "w1 w1 W1 w2"])]
    frame = make_docs([(i, t, "en") for i, t in docs])
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = ranked.top_documents(frame, asked).collect()
    assert sorted(map(tuple, found), key=str) == brute(docs, items)
    blocks = ranked.top_documents(frame, asked, top=3, block_terms=40).collect()
    assert sorted(map(tuple, blocks), key=str) == brute(docs, items, top=3)


def test_odd_rows(spark, make_docs, odd_rows):
    items = [(1, "word5 same TEXT ünïcödé 中文"), (2, None), (None, "the same text"), (3, "!!"), (1, "x")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = ranked.top_documents(make_docs(odd_rows), asked).collect()
    expected = brute([(i, t) for i, t, _ in odd_rows], items)
    assert sorted(map(tuple, found), key=str) == expected
    assert ranked.top_documents(make_docs([]), asked).collect() == []
    assert ranked.top_documents(make_docs(odd_rows), asked.limit(0)).collect() == []


def test_range_table_gives_the_first_highest_place():
    rng = np.random.default_rng(1)
    for size in (1, 2, 5, 33, 64):
        impacts = rng.integers(0, 9, size)
        table = ranked.range_table(impacts)
        for low in range(size):
            for high in range(low + 1, size + 1):
                row = (high - low).bit_length() - 1
                left, right = table[row, low], table[row, high - (1 << row)]
                best = left if impacts[left] >= impacts[right] else right
                assert best == low + impacts[low:high].argmax()


def test_bounds_leave_most_intervals_closed():
    """One document holds the rare words of the query: few intervals are opened to find it first."""
    rng = random.Random(2)
    texts = generated(rng, 4000)
    texts[1234] = "rare words stand here"
    block = ranked._block([0], ["rare words stand here"])
    counts = [{block.vocabulary[t]: 1 for t in plain_terms(x) if t in block.vocabulary} for x in texts]
    number = np.array([t for c in counts for t in c])
    places = np.repeat(np.arange(len(texts), dtype=np.int32), [len(c) for c in counts])
    order = np.argsort(number, kind="stable")
    held, starts = np.unique(number[order], return_index=True)
    sizes = np.array([len(plain_terms(x)) for x in texts], np.int64)
    parts = (
        np.arange(len(texts)), np.zeros(len(texts), bool), sizes, held, np.append(starts, len(number)),
        places[order], np.ones(len(number), np.int64),
    )
    weights = ranked.Weights(len(texts), int(sizes.sum()), np.full(len(block.vocabulary), 9000))
    kept = ranked.Kept(1)
    segment = ranked.Segment(tuple(p.tobytes() for p in parts), weights)
    assert ranked.search(segment, block.wanted[0], kept) <= 3
    assert [-doc for _, _, doc in kept.heap] == [1234]
