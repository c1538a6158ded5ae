"""The manifest against a tree built step by step."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from layerwright.llm import merkle


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    values = [v if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return digest("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(nodes):
    """The root of ``nodes`` and each node's siblings from the lowest level up, as (before, behind)."""
    paths = [[] for _ in nodes]
    members = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, joined = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for k in range(len(run)):
                for i in members[at + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(digest("".join(run)))
            joined.append([i for m in members[at : at + 8] for i in m])
        nodes, members = above, joined
    return nodes[0], paths


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, plain_leaf(*row), row))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: r[:3])
        trees[name] = tree([leaf for _, _, leaf, _ in groups[name]])
    root, upper = tree([trees[name][0] for name in names])
    found = []
    for name, above in zip(names, upper):
        for (_, _, leaf, row), path in zip(groups[name], trees[name][1]):
            shown = row
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                shown = (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
            own = plain_leaf(*shown)
            for before, behind in path + above:
                own = digest(before + own + behind)
            proof = digest("".join(before + behind for before, behind in path + above))
            found.append((row[0], leaf, trees[name][0], root, proof, own, own == root))
    return sorted(found, key=str)


def checked(docs):
    found = merkle.tamper_check(docs)
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert found.columns == columns
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("sizes", [(1,), (8, 1, 9), (64, 65, 513), (600, 7, 1100)])
def test_sizes_against_brute_force(spark, sizes):
    rows = []
    for group, size in enumerate(sizes):
        for i in range(size):
            rows.append((len(rows) * 7 % 5003, f"s{i % 3}", f"g{group}" if group else None, i, f"Text {i} Ä"))
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert checked(docs.repartition(5)) == brute(rows)


def test_more_tiers(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK", 8)
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "_CLIMBED", "CASE WHEN n <= 1 THEN 0 ELSE 1 END")
    rows = [(i, "s", f"g{i % 2}" if i < 560 else f"h{i}", i, f"T{i}") for i in range(580)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert checked(docs) == brute(rows)


def test_odd_rows(make_docs, odd_rows):
    rows = [(i, "s1" if i else None, lang, len(t) if t else None, t) for i, t, lang in odd_rows]
    assert checked(make_docs(odd_rows)) == brute(rows)
    assert checked(make_docs([])) == []


def test_every_proof_leads_to_the_root(spark):
    rows = spark.range(700).select("id", F.lit("g").alias("g"), F.sha2(F.col("id").cast("string"), 256).alias("d"))
    shown = rows.withColumn("shown", F.when(F.col("id") == 99, F.sha2(F.lit("other"), 256)))
    found = merkle.manifest(shown, "id", "g", "d", "shown").collect()
    assert {r["id"] for r in found if not r["verified"]} == {99}
    for row in found[:50]:
        own = row["leaf"]
        for before, behind in row["path"]:
            own = digest(bytes(before).decode() + own + bytes(behind).decode())
        assert own == row["root"] == row["subroot"]
