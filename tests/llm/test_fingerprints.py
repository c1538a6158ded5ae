"""Fingerprints against a plain computation, neighbours against all pairs."""

import functools
import hashlib
import math
import random
from collections import Counter

import pytest
import xxhash

from layerwright.llm import fingerprints, queries

MASK = (1 << 64) - 1


@functools.lru_cache(maxsize=None)
def plain_fingerprint(text):
    """Term by term in whole numbers, without arrays."""
    words = fingerprints._WORDS.findall(text.lower()) or ([text] if text else [])
    lanes = []
    for word in words:
        raw = xxhash.xxh3_128_digest(word.encode(), 12)
        lanes.append(tuple(int.from_bytes(raw[i : i + 8], "little") for i in (0, 8)))

    def mixed(value):
        value ^= value >> 31
        value = value * 0xBF58476D1CE4E5B9 & MASK
        return value ^ value >> 29

    factors = [[int(x) for x in row] for row in fingerprints._FACTORS]
    pairs = [
        tuple(mixed((a[i] * factors[0][i] + b[i] * factors[1][i]) & MASK) for i in (0, 1))
        for a, b in zip(lanes, lanes[1:])
    ]
    votes = [0] * 128
    for term, count in Counter(lanes + pairs).items():
        weight = math.floor(16 * (1 + math.log2(count)))
        raw = b"".join(lane.to_bytes(8, "little") for lane in term)
        for bit in range(128):
            votes[bit] += weight if raw[bit // 8] >> (7 - bit % 8) & 1 else -weight
    return sum(1 << (127 - bit) for bit in range(128) if votes[bit] > 0).to_bytes(16, "big")


def apart(left, right):
    return (int(left, 16) ^ int(right, 16)).bit_count()


def brute(rows):
    """Rows (doc_id, text) in order, each against the next one."""
    found = []
    for at, (doc_id, text) in enumerate(rows):
        other = rows[(at + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        own, new, following = (plain_fingerprint(t).hex() for t in (text, edited, other))
        digest = hashlib.sha256(edited.encode()).hexdigest()
        found.append((doc_id, len(text), digest, own, new, 1 - apart(own, new) / 128, 1 - apart(own, following) / 128))
    return found


@pytest.mark.parametrize("parts", [1, 7])
def test_odd_rows_against_brute_force(spark, make_docs, odd_rows, parts):
    rows = [(i, t or "") for i, t, _ in odd_rows]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), xxhash.xxh64_intdigest(r[1].encode(), 42)))
    signed = lambda t: (h := xxhash.xxh64_intdigest(t.encode(), 42)) - (1 << 64) * (h >> 63)
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), signed(r[1]), r[1]))
    found = fingerprints.against_next(make_docs(odd_rows, parts)).collect()
    key = lambda r: (str(r[0]), r[2], r[3])
    assert sorted(map(tuple, found), key=key) == sorted(brute(rows), key=key)
    assert fingerprints.against_next(make_docs([])).collect() == []
    alone = fingerprints.against_next(make_docs([(1, "one two", "en")])).collect()
    assert [r["near_next"] for r in alone] == [1.0]


def test_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted(((r[0], r[1] or "") for r in rows), reverse=True)
    found = {r["doc_id"]: r for r in queries.QUERIES["op12_document_fingerprints"](spark, folder).collect()}
    assert len(found) == len(rows)
    expected = brute(rows)
    assert all(tuple(found[row[0]])[:7] == row for row in expected)
    for doc_id, row in found.items():
        near = sum(apart(row["fingerprint"], other[3]) <= 3 for other in expected) - 1
        assert row["n_near"] == (near if doc_id % 20 == 0 else None)
    right = sum(row["near_edited"] > row["near_next"] for row in found.values())
    assert right >= 0.98 * len(found)


def test_all_neighbours_in_crowded_buckets(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "PIECE", 50)
    rng = random.Random(3)
    prints = set()
    for _ in range(6):
        centre = rng.getrandbits(128)
        for _ in range(150):
            prints.add((centre ^ sum(1 << b for b in rng.sample(range(128), rng.randrange(5)))).to_bytes(16, "big"))
    every = [bytearray(p) for p in sorted(prints)]
    rows = spark.createDataFrame([(p, i % 3 + 1) for i, p in enumerate(every)], "print binary, n long")
    asked = rows.limit(400).select("print")
    asked = spark.createDataFrame(asked.collect(), "print binary")
    found = [(bytes(r[0]), bytes(r[1]), r[2]) for r in fingerprints.near_pairs(rows, asked).collect()]
    wanted = {
        (a, bytes(b), d)
        for a in (bytes(r[0]) for r in asked.collect())
        for b in every
        if 0 < (d := apart(a.hex(), b.hex())) <= 3
    }
    assert len(found) == len(wanted) and set(found) == wanted
    weights = {bytes(p): i % 3 + 1 for i, p in enumerate(every)}
    counts = {bytes(r["print"]): r["n_near"] for r in fingerprints.near_counts(rows, asked).collect()}
    for a in counts:
        assert counts[a] == weights[a] + sum(weights[b] for x, b, _ in wanted if x == a)
