"""Near duplicates by SimHash, searched with the generalised pigeonhole principle.

Fingerprints of 64 bits link when at most ``DISTANCE`` bits differ. Bits that go together are grouped
into m partitions; partition i gets a threshold t_i, and where the thresholds add up to
``DISTANCE - m + 1`` every link lies within t_i in some partition i (a threshold of -1 leaves a
partition out). Dynamic programming chooses m and the thresholds by the candidates estimated from the
sizes of all buckets. Each fingerprint is then entered under its part, probes for the values within the
threshold, and candidates are verified on all bits.

Only different fingerprints take part, so copies cost nothing. A bucket of more than ``CROWD`` entries
does not form pairs: its fingerprints meet at the points one bit away from them, where two fingerprints
within two bits share a point and at most 65 meet, and every point links its members to the smallest.
That is exact, and in proportion to the bucket.

Defined cases: a null text is an empty one; a text without words has fingerprint zero and links like
any other; null ids count only where nothing else is in the component; rows with a repeated id are
documents of their own; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm import common
from layerwright.llm.components import connected
from layerwright.session import cut_lineage

BITS = 64
DISTANCE = 2
WORDS = 3
SEED = 42
#: Entries of a bucket from which its fingerprints meet at points instead of forming pairs.
CROWD = 64
#: Shingles counted at a time.
_BLOCK = 1 << 15


def fingerprint(text: str) -> int:
    """The fingerprint as a signed 64-bit number."""
    words = text.encode(errors="replace").lower().split()
    if not words:
        return 0
    if len(words) < WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*[words[i:] for i in range(WORDS)])))
    digest = xxhash.xxh64_digest
    set_bits = np.zeros(BITS, np.int64)
    for block in common.in_slices(shingles, _BLOCK):
        raw = b"".join([digest(shingle, SEED) for shingle in block])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8)).reshape(-1, BITS)
        set_bits += np.add.reduce(bits, axis=0, dtype=np.int32)
    packed = np.packbits(2 * set_bits > len(shingles)).tobytes()
    return int.from_bytes(packed, "big", signed=True)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document doc_id, row_key and fingerprint, written to the shared folder."""
    content = common.text_or_empty(text)
    given = docs.select(
        F.col(doc_id).alias("doc_id"), common.row_key(F.col(doc_id), content).alias("row_key"), content
    )

    def start() -> Callable:
        return lambda content: (fingerprint(content),)

    return cut_lineage(common.map_rows(given, "fingerprint long", start, passed=2))


class Plan(NamedTuple):
    """Groups of bits and their thresholds."""

    groups: tuple[tuple[int, ...], ...]
    thresholds: tuple[int, ...]
    cost: float


def _mask(bits: tuple[int, ...]) -> int:
    """The bits as a signed 64-bit number."""
    value = sum(1 << bit for bit in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def together(points: DataFrame) -> tuple[np.ndarray, int]:
    """How often each pair of bits is set together, over all fingerprints, and their number."""
    common.importable(points.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), np.int64)
        rows = 0
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            bits = (values[:, None] >> np.arange(BITS)) & 1
            floats = bits.astype(np.float32)
            total += np.rint(floats.T @ floats).astype(np.int64)
            rows += len(values)
        counts = np.append(total.ravel(), rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts))), pa.array(counts)], ["cell", "n"])

    rows = (
        points.select("fingerprint")
        .mapInArrow(count, "cell long, n long")
        .groupBy("cell")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros(BITS * BITS + 1, np.int64)
    for row in rows:
        counts[row["cell"]] = row["n"]
    return counts[:-1].reshape(BITS, BITS), int(counts[-1])


def correlated_groups(pairs: np.ndarray, rows: int, parts: int) -> tuple[tuple[int, ...], ...]:
    """Bits in groups of nearly equal size, each bit near the ones it goes with."""
    share = np.diag(pairs) / rows
    spread = np.sqrt(share * (1 - share))
    with np.errstate(divide="ignore", invalid="ignore"):
        bond = np.abs(np.nan_to_num((pairs / rows - np.outer(share, share)) / np.outer(spread, spread)))
    np.fill_diagonal(bond, 0)
    free, groups = set(range(BITS)), []
    for part in range(parts, 0, -1):
        rest = sorted(free)
        group = [max(rest, key=lambda bit: (bond[bit, rest].sum(), -bit))]
        free.discard(group[0])
        while len(group) < round(len(rest) / part):
            group.append(max(sorted(free), key=lambda bit: (bond[bit, group].sum(), -bit)))
            free.discard(group[-1])
        groups.append(tuple(sorted(group)))
    return tuple(groups)


def _probes(width: int, threshold: int) -> int:
    return sum(math.comb(width, k) for k in range(threshold + 1))


def bucket_cost(points: DataFrame, groups: list[tuple[int, ...]]) -> dict[tuple[int, ...], float]:
    """Work that equal parts make, by group of bits, over all fingerprints."""
    parts = F.explode(
        F.array(
            *[
                F.struct(F.lit(i).alias("part"), F.col("fingerprint").bitwiseAND(F.lit(_mask(g))).alias("value"))
                for i, g in enumerate(groups)
            ]
        )
    )
    n = F.col("n").cast("double")
    rows = (
        points.select(parts.alias("entry"))
        .groupBy("entry.part", "entry.value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("part")
        .agg(F.sum(F.least(n * (n - 1) / 2, n * (BITS + 1))).alias("cost"))
        .collect()
    )
    found = {groups[row["part"]]: row["cost"] for row in rows}
    return {group: found.get(group, 0.0) for group in groups}


def allocate(groups: tuple, equal: dict, share: np.ndarray, rows: int, distance: int = DISTANCE) -> Plan:
    """Thresholds of least estimated work that add up to what the pigeonhole principle needs."""
    apart = np.clip(2 * share * (1 - share), 0, 0.5)
    odds = apart / (1 - apart)

    def cost(group: tuple[int, ...], threshold: int) -> float:
        if threshold < 0:
            return 0.0
        ways = [1.0] + [0.0] * threshold  # pairs that differ in k bits of the group, for one that is equal
        for bit in group:
            for k in range(threshold, 0, -1):
                ways[k] += ways[k - 1] * odds[bit]
        return equal[group] * sum(ways) + rows * _probes(len(group), threshold)

    best: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}
    for group in groups:
        further: dict[int, tuple[float, tuple[int, ...]]] = {}
        for total, (spent, chosen) in best.items():
            for threshold in range(-1, distance + 1):
                found = spent + cost(group, threshold), (*chosen, threshold)
                key = total + threshold
                if key not in further or found < further[key]:
                    further[key] = found
        best = further
    spent, thresholds = best[distance - len(groups) + 1]
    return Plan(groups, thresholds, spent)


def make_plan(points: DataFrame, distance: int = DISTANCE) -> Plan | None:
    pairs, rows = together(points)
    if rows < 2:
        return None
    choices = [correlated_groups(pairs, rows, parts) for parts in range(2, distance + 2)]
    equal = bucket_cost(points, sorted({group for groups in choices for group in groups}))
    share = np.diag(pairs) / rows
    return min((allocate(groups, equal, share, rows, distance) for groups in choices), key=lambda p: p.cost)


def _far(left: str, right: str) -> Column:
    return F.bit_count(F.col(left).bitwiseXOR(F.col(right)))


def _masks(group: tuple[int, ...], threshold: int) -> list[int]:
    return [_mask(bits) for k in range(threshold + 1) for bits in combinations(group, k)]


def links(points: DataFrame, plan: Plan, distance: int = DISTANCE) -> DataFrame:
    """Links (a, b) between different fingerprints, enough to reach everything that links reach."""
    entries, queries = [], []
    for i, (group, threshold) in enumerate(zip(plan.groups, plan.thresholds)):
        if threshold < 0:
            continue
        part = F.struct(
            F.lit(i).alias("part"), F.col("fingerprint").bitwiseAND(F.lit(_mask(group))).alias("value")
        )
        entries.append(part)
        queries += [
            F.struct(
                F.lit(i).alias("part"),
                F.col("fingerprint").bitwiseAND(F.lit(_mask(group))).bitwiseXOR(F.lit(mask)).alias("value"),
            )
            for mask in _masks(group, threshold)
        ]

    def dealt(columns: list[Column]) -> DataFrame:
        return points.select("fingerprint", F.explode(F.array(*columns)).alias("at")).select(
            "at.part", "at.value", "fingerprint"
        )

    entered = dealt(entries)
    probing = dealt(queries) if len(queries) > len(entries) else entered
    crowded = cut_lineage(
        probing.groupBy("part", "value").count().where(F.col("count") > CROWD).select("part", "value")
    )
    place = ["part", "value"]
    pairs = (
        entered.withColumnRenamed("fingerprint", "a")
        .join(crowded, place, "left_anti")
        .join(
            probing.withColumnRenamed("fingerprint", "b").join(crowded, place, "left_anti"),
            place,
        )
        .where((F.col("a") < F.col("b")) & (_far("a", "b") <= distance))
        .select("a", "b")
    )
    crowd = probing.join(crowded, place, "left_semi").select("fingerprint").distinct()
    return pairs.unionByName(_by_points(crowd))


def _by_points(crowd: DataFrame) -> DataFrame:
    """Links between fingerprints that share a point at most one bit away from each."""
    masks = [0, *[_mask((bit,)) for bit in range(BITS)]]
    near = F.explode(F.array(*[F.col("fingerprint").bitwiseXOR(F.lit(mask)) for mask in masks]))
    return (
        crowd.select("fingerprint", near.alias("point"))
        .groupBy("point")
        .agg(F.collect_list("fingerprint").alias("met"))  # at most 65
        .where(F.size("met") > 1)
        .select(F.array_min("met").alias("a"), F.explode("met").alias("b"))
        .where("a <> b")
        .distinct()
    )


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document doc_id, row_key, fingerprint, component_id, and whether it is its component's first.

    The first document of a component has the smallest id; rows that tie in id are told apart by text.
    """
    rows = fingerprints(docs, doc_id, text)
    place = F.struct(
        F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("row_key").alias("key")
    )
    points = cut_lineage(rows.groupBy("fingerprint").agg(F.min(place).alias("first")))
    plan = make_plan(points)
    if plan is None:
        grouped = points
    else:
        roots = connected(links(points, plan))
        rooted = points.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        rooted = cut_lineage(rooted.withColumn("root", F.coalesce("root", "fingerprint")))
        firsts = cut_lineage(rooted.groupBy("root").agg(F.min("first").alias("first")))
        grouped = cut_lineage(rooted.select("fingerprint", "root").join(firsts, "root"))
    return rows.join(grouped.select("fingerprint", "first"), "fingerprint").select(
        "doc_id",
        "row_key",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
        (F.col("first.key") == F.col("row_key")).alias("is_first"),
    )


def first_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, with all its columns."""
    kept = components(docs, doc_id, text).where("is_first").select("row_key")
    return common.keep_rows(docs, kept, doc_id, text)
