"""The near-copy stage takes candidates from the fingerprints of op6 and verifies them."""

import random

from pyspark.sql import functions as F
from test_near_copies import brute_firsts, varied

import corpus_pipeline
from layerwright.llm import minhash, simhash


def far(one, other):
    return ((simhash.fingerprint(one) ^ simhash.fingerprint(other)) & ((1 << 64) - 1)).bit_count()


def without_bands(monkeypatch):
    """Signatures whose bands share nothing, so that only fingerprints give candidates."""
    whole = minhash.signatures

    def signatures(*given):
        return whole(*given).withColumn("buckets", F.array().cast("array<long>"))

    monkeypatch.setattr(minhash, "signatures", signatures)


def test_near_fingerprints_link_without_bands(make_docs, monkeypatch):
    without_bands(monkeypatch)
    rng = random.Random(6)
    rows, distances = [], set()
    while len(rows) < 24:
        words = [f"w{rng.getrandbits(40)}" for _ in range(300)]
        one, other = " ".join(words), varied(rng, words, 1)
        if far(one, other) <= simhash.DISTANCE:
            distances.add(far(one, other))
            rows += [(len(rows), one), (len(rows) + 1, other)]
    assert distances - {0}
    kept = corpus_pipeline.without_near_copies(None, make_docs([(i, t, "en") for i, t in rows]), "").collect()
    assert {r["doc_id"] for r in kept} == brute_firsts(rows) == set(range(0, 24, 2))


def test_equal_fingerprints_of_unlike_texts_do_not_link(make_docs, monkeypatch):
    """Repeats decide a fingerprint and not a set of shingles: candidates are verified."""
    rng = random.Random(7)
    tails = [" ".join(f"t{rng.getrandbits(40)}" for _ in range(20)) for _ in range(6)]
    texts = [f"{'x y z ' * 100}{tail}" for tail in tails]
    rows = list(enumerate(texts + [f"{'x y z ' * 99}{tails[0]}"]))
    assert all(far(texts[0], text) <= simhash.DISTANCE for _, text in rows)
    for bands in (True, False):
        if not bands:
            without_bands(monkeypatch)
        kept = minhash.first_rows(make_docs([(i, t, "en") for i, t in rows])).collect()
        assert {r["doc_id"] for r in kept} == brute_firsts(rows) == set(range(6))
