"""Near copies by similarity against brute force."""

import random

import corpus_pipeline
from layerwright.llm import minhash


def shingle_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute_firsts(rows, least=0.8):
    sets = {i: shingle_set(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i for i in ids if find(i) == i}


def varied(rng, words, changes):
    words = list(words)
    for at in rng.sample(range(len(words)), changes):
        words[at] = f"new{rng.getrandbits(40)}"
    return " ".join(words)


def test_stage_drops_similar_texts_and_keeps_others(make_docs):
    rng = random.Random(4)
    rows = []
    for size, changes in [(100, 1), (100, 2), (300, 3), (300, 12), (1000, 20), (40, 4)] * 5:
        words = [f"w{rng.getrandbits(40)}" for _ in range(size)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, varied(rng, words, changes))]
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " \t", "one two", "ONE  two", "one two three"])]
    kept = corpus_pipeline.without_near_copies(None, make_docs([(i, t, "en") for i, t in rows]), "").collect()
    assert {r["doc_id"] for r in kept} == brute_firsts(rows)


def test_large_group_around_one_text(make_docs):
    """Copies that are similar to the original and not to each other, in crowded buckets."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    rows = [(0, " ".join(words))] + [(i, varied(rng, words, rng.randrange(1, 5))) for i in range(1, 150)]
    kept = minhash.first_rows(make_docs([(i, t, "en") for i, t in rows])).collect()
    assert {r["doc_id"] for r in kept} == brute_firsts(rows) == {0}


def test_near_copies_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = minhash.first_rows(docs)
    assert kept.columns == docs.columns
    texts = {}
    for doc_id, text, _ in odd_rows:
        texts.setdefault(doc_id, text)
    expected = brute_firsts([(i, t) for i, t in texts.items() if i is not None])
    assert {r["doc_id"] for r in kept.collect()} - {None} == expected
    assert minhash.first_rows(make_docs([])).collect() == []


def test_templates_whose_copies_are_mostly_just_apart(make_docs):
    """Three of 200 words replaced in each: few of the pairs are links, and no centre takes part in most."""
    rng = random.Random(11)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, varied(rng, words, 3)) for i in range(500)]
    kept = minhash.first_rows(make_docs([(i, t, "en") for i, t in rows])).collect()
    assert {r["doc_id"] for r in kept} == brute_firsts(rows)


def test_pieces_of_crowded_buckets(make_docs, monkeypatch):
    monkeypatch.setattr(minhash, "PIECE", 20)
    monkeypatch.setattr(minhash, "_COLUMNS", 64)
    rng = random.Random(12)
    words = [f"w{i}" for i in range(120)]
    rows = [(i, varied(rng, words, 2)) for i in range(120)]
    kept = minhash.first_rows(make_docs([(i, t, "en") for i, t in rows])).collect()
    assert {r["doc_id"] for r in kept} == brute_firsts(rows)
