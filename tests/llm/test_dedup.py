"""Exact copies, near copies and repeated bytes against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash

from layerwright.llm import components, exact_dedup, simhash, suffixes


def rows_of(df):
    return [tuple(row) for row in df.collect()]


# Exact copies -----------------------------------------------------------------------------------


def brute_groups(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        body = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups.setdefault(body, []).append(doc_id)
    return groups


def check_exact(found, rows):
    groups = brute_groups(rows)
    assert len(found) == len(rows)
    by_digest = {}
    for row in found:
        by_digest.setdefault(row["text_sha256"], []).append(row)
    assert len(by_digest) == len(groups)
    for body, ids in groups.items():
        same = by_digest[hashlib.sha256(body.encode()).hexdigest()]
        known = [i for i in ids if i is not None]
        assert {r["group_size"] for r in same} == {len(ids)}
        assert {r["keep_id"] for r in same} == {min(known) if known else None}
        kept = [r["doc_id"] for r in same if r["kept"]]
        assert kept == [min(known) if known else None]


def test_exact_odd_rows(make_docs, odd_rows):
    found = exact_dedup.decide(make_docs(odd_rows)).collect()
    check_exact(found, odd_rows)


def test_exact_heavy_group_is_settled_by_broadcast(make_docs):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i // 5}", "en") for i in range(2000)]
    docs = make_docs(rows, parts=7)
    marked = docs.selectExpr("text AS mark")
    assert "hot" in {r["mark"] for r in exact_dedup.frequent(marked, 0.01).collect()}
    check_exact(exact_dedup.decide(docs, support=0.01).collect(), rows)


def test_frequent_marks_are_bounded_and_complete(spark):
    rng = random.Random(5)
    marks = [rng.choice("aaabbc") if rng.random() < 0.5 else f"m{rng.random()}" for _ in range(3000)]
    found = {
        r["mark"]
        for r in exact_dedup.frequent(spark.createDataFrame([(m,) for m in marks], "mark string"), 0.05).collect()
    }
    assert {m for m, n in Counter(marks).items() if n > 0.05 * len(marks)} <= found
    assert len(found) <= 20


def test_unique_rows_keep_all_columns(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = exact_dedup.unique_rows(docs)
    assert kept.columns == docs.columns
    assert len(kept.collect()) == len(brute_groups(odd_rows))


def test_exact_empty(make_docs):
    docs = make_docs([])
    assert exact_dedup.decide(docs).collect() == []
    assert exact_dedup.unique_rows(docs).collect() == []


# Near copies ------------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=2):
    nodes = sorted(prints)
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprints_as_defined():
    for text in ["", " \t", "One", "one two", "A b C d", "über Öl ÜBER öl x", "a a a a a a", "\x1cx\x85y z"]:
        assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text), text


def test_near_copies_odd_rows(make_docs, odd_rows):
    found = simhash.components(make_docs(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    texts = {}
    for doc_id, text, _ in odd_rows:
        texts.setdefault(doc_id, text or "")
    prints = {i: plain_fingerprint(t) for i, t in texts.items() if i is not None}
    expected = brute_components(prints)
    for row in found:
        if row["doc_id"] is not None:
            assert row["component_id"] == expected[row["doc_id"]]
            assert row["fingerprint"] == f"{prints[row['doc_id']]:016x}"
    kept = simhash.first_rows(make_docs(odd_rows)).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(set(expected.values()))


def test_links_with_crowded_buckets_lose_nothing(spark):
    """Chains, hubs and crowds: what links reach is what brute force reaches."""
    rng = random.Random(3)
    prints = set()
    centre = rng.getrandbits(64)
    for _ in range(200):  # a crowd around one point
        prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 1, 2, 3]))))
    at = rng.getrandbits(64)
    for _ in range(40):  # a chain
        prints.add(at)
        at ^= sum(1 << b for b in rng.sample(range(64), 2))
    prints |= {rng.getrandbits(64) for _ in range(200)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    points = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    expected = brute_components({p: p % (1 << 64) for p in signed})
    plans = [simhash.make_plan(points)]
    groups = (tuple(range(32)), tuple(range(32, 64)))
    plans += [simhash.Plan(groups, (0, 1), 0.0), simhash.Plan(groups, (2, -1), 0.0)]
    for plan in plans:
        assert sum(plan.thresholds) == 2 - len(plan.groups) + 1
        linked = simhash.links(points, plan)
        for a, b in rows_of(linked):
            assert ((a ^ b) % (1 << 64)).bit_count() <= 2
        roots = dict(rows_of(components.connected(linked)))
        found = {p: roots.get(p, p) for p in signed}
        assert found == expected


def test_thresholds_are_unequal_where_that_is_cheaper():
    groups = (tuple(range(8)), tuple(range(8, 64)))
    import numpy as np

    plan = simhash.allocate(groups, {groups[0]: 1e9, groups[1]: 10.0}, np.full(64, 0.5), 1000)
    assert plan.thresholds == (-1, 2)


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100)]
    hub = [(1000, 2000 + i) for i in range(300)]
    found = dict(rows_of(components.connected(spark.createDataFrame(chain + hub, "a long, b long"))))
    assert {found[i] for i in range(101)} == {0}
    assert {found[2000 + i] for i in range(300)} | {found[1000]} == {1000}


def test_near_copies_empty(make_docs):
    assert simhash.components(make_docs([])).collect() == []
    assert simhash.components(make_docs([(4, "one text", "en")])).collect()[0]["component_id"] == 4


# Repeated bytes ---------------------------------------------------------------------------------


def brute_removed(rows):
    raw = [(text or "").encode() for _, text, *_ in rows]
    starts = Counter(t[i : i + 200] for t in raw for i in range(len(t) - 199))
    out = []
    for (doc_id, *_), t in zip(rows, raw):
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if starts[t[i : i + 200]] > 1:
                gone[i : i + 200] = b"\x01" * 200
        runs = len([run for run in bytes(gone).split(b"\0") if run])
        kept = bytes(b for b, x in zip(t, gone) if not x)
        out.append((doc_id, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeated_rows():
    rng = random.Random(8)
    words = ["alpha", "beta", "gamma", "délta", "中", "eta", "theta"]

    def prose(n):
        return " ".join(rng.choice(words) + str(rng.randrange(100)) for _ in range(n))

    passage, edge = prose(60), prose(200)
    exact_200 = "q" + edge[:198] + "z"
    rows = [
        (1, prose(50) + passage + prose(40), "en"),
        (2, passage[3:] + prose(5), "en"),
        (3, "x" + exact_200 + "y", "en"),
        (4, "u" + exact_200 + "w", "en"),
        (5, edge[:199], "en"),
        (6, edge[:199] + "#", "en"),
        (7, "ab" * 150, "en"),
        (8, "c" * 200, "en"),
        (9, "c" * 201, "en"),
        (10, None, "en"),
        (11, "", "en"),
        (None, prose(80), "en"),
        (12, prose(900) * 2, "en"),
        (13, "twice " + passage, "en"),
        (13, "twice " + passage, "en"),
        (14, " ".join(f"n{i}" for i in range(4000)), "en"),
    ]
    line = "line one two three four five six seven. "
    rows += [(90, line * 60, "en"), (91, "x" * 50 + line * 30 + "yy", "en")]
    rows += [(92, "ab " * 400 + "zz" + "ab " * 300, "en"), (93, "q" + "ab " * 200, "en"), (94, line * 60, "en")]
    rows += [(20 + i, prose(i) + passage[: 210 + 7 * i] + prose(3), "en") for i in range(30)]
    return rows


@pytest.mark.parametrize(
    "settings",
    [{}, {"BROADCAST": 0}, {"CROWD": 4}, {"CROWD": 4, "BROADCAST": 0}, {"BATCH": 5, "ROWS": 9}],
    ids=["plain", "joined", "crowds", "crowds joined", "small batches"],
)
def test_repeated_bytes_odd_rows(make_docs, monkeypatch, settings):
    """Each way through the operator, and batches that end within a run of equal names."""
    for name, value in settings.items():
        monkeypatch.setattr(suffixes, name, value)
    rows = repeated_rows()
    found = rows_of(suffixes.report(make_docs(rows)))
    assert sorted(found, key=str) == brute_removed(rows)


def test_the_cover_serves_equal_strings_alike():
    """Every string has a sampled place within it, at the same step wherever it stands."""
    rng = random.Random(9)
    shared = bytes(rng.randrange(97, 123) for _ in range(500))
    seen = {}
    for text in (shared, b"x" * 77 + shared + b"tail" * 30, bytes(rng.randrange(97, 123) for _ in range(333)) + shared, b"ab" * 300):
        found = suffixes.samples(text)
        starts = [i for low, high in zip(found.first, found.last) for i in range(low, high + 1)]
        assert starts == list(range(len(text) - 199))
        for at, low, high in zip(found.at, found.first, found.last):
            for i in range(low, high + 1):
                assert i <= at <= i + 200 - suffixes.GRAM
                assert seen.setdefault(text[i : i + 200], at - i) == at - i


def test_words_keep_the_order_of_bytes():
    rng = random.Random(1)
    raw = bytes(rng.randrange(256) for _ in range(400))
    words = suffixes._words(raw)
    words = words[:392]
    order = sorted(range(392), key=lambda i: raw[i : i + 8])
    assert [int(w) for w in words[order]] == sorted(int(w) for w in words)


def test_repeated_bytes_empty(make_docs):
    assert suffixes.report(make_docs([])).collect() == []
    assert suffixes.report(make_docs([(1, "short", "en")])).collect()[0]["n_removed"] == 0
