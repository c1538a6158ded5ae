"""Near copies by the Jaccard similarity of word shingles: candidates by SimHash and MinHash, verified exactly.

Two texts link when the sets of their runs of ``WORDS`` words have a similarity of ``SIMILARITY`` or more.
Candidates come from two searches. The first is that of ``simhash``: texts of one fingerprint, and of
fingerprints at most ``simhash.DISTANCE`` bits apart, found through its groups of bits. Similar texts may
lie further apart than that, so the second is by bands: a signature of ``BANDS`` times ``ROWS`` minima makes candidates: texts that agree in all rows of a band
share a bucket. A pair of similarity 0.8 shares none with a chance of (1 - 0.8 ** 5) ** 30, or 7 in a
million. Every candidate is verified on the whole sets before it links.

Only what decides components is compared. First each text meets the smallest one of its fingerprint, and
these meet along the links between fingerprints. Then each text meets one centre, the one among those of its
buckets that shares most buckets with others. Then the first member of each component in a bucket meets
that bucket's centre. Buckets whose members are one component by then need nothing more. In all others
every pair from different components is compared, so no link is lost: as rows in buckets of up to
``CROWD`` members, and in larger ones piece against piece, where a task counts the common shingles of all
pairs by a product of matrices and returns only links that join components. So rows grow with the number
of texts and not with the square of a group.

Defined cases: a null text is an empty one; texts without words link; a text of fewer words than a
shingle is one shingle; null ids count only where nothing else is in the component; rows with a repeated
id are documents of their own; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm import common, simhash
from layerwright.llm.components import connected
from layerwright.session import cut_lineage

WORDS = 5
SIMILARITY = 0.8
ROWS = 5
BANDS = 30
#: Members of a bucket up to which pairs still apart are compared as rows.
CROWD = 8
#: Members, and shingles, of the pieces into which larger buckets are cut.
PIECE = 1024
PIECE_SHINGLES = 1 << 18
#: Shingles that are counted at a time in a pair of pieces.
_COLUMNS = 4096
SEED = 42
#: Shingles whose minima are taken at a time.
_BLOCK = 1 << 12

_RANDOM = np.random.default_rng(SEED)
_FACTORS = _RANDOM.integers(0, 1 << 63, WORDS + ROWS * BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADDED = _RANDOM.integers(0, 1 << 63, ROWS * BANDS, dtype=np.uint64)


def shingles(words: list[bytes]) -> np.ndarray:
    """The different shingles of a text, as sorted 64-bit hashes."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(word, SEED) for word in words], np.uint64, len(words))
    runs = len(words) - WORDS + 1
    mixed = np.zeros(runs, np.uint64)
    for i in range(WORDS):
        mixed += hashes[i : i + runs] * _FACTORS[i]
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed * np.uint64(0xBF58476D1CE4E5B9))


def buckets(found: np.ndarray) -> list[int]:
    """One bucket for each band of the signature, as signed 64-bit numbers; none for an empty set."""
    if not len(found):
        return []
    least = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), _BLOCK):
        block = found[at : at + _BLOCK]
        for i, (factor, added) in enumerate(zip(_FACTORS[WORDS:], _ADDED)):
            least[i] = min(least[i], (block * factor + added).min())
    bands = least.reshape(BANDS, ROWS)
    return [_signed(xxhash.xxh64_intdigest(band.tobytes(), i)) for i, band in enumerate(bands)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _words(text: str) -> list[bytes]:
    return text.encode(errors="replace").lower().split()


def similarity(left: np.ndarray, right: np.ndarray) -> float:
    both = len(np.intersect1d(left, right, assume_unique=True))
    return both / (len(left) + len(right) - both) if both else 0.0


def _given(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    content = common.text_or_empty(text)
    return docs.select(
        F.col(doc_id).alias("doc_id"), common.row_key(F.col(doc_id), content).alias("row_key"), content
    )


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document doc_id, row_key, node (equal for equal words), size, fingerprint and buckets, written out."""

    def start() -> Callable:
        def one(content: str) -> tuple:
            words = _words(content)
            found = shingles(words)
            node = _signed(xxhash.xxh64_intdigest(b" ".join(words), SEED))
            return node, len(found), simhash.fingerprint(content), buckets(found)

        return one

    added = "node long, size long, fingerprint long, buckets array<long>"
    return cut_lineage(common.map_rows(_given(docs, doc_id, text), added, start, passed=2))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough, written out."""
    least = SIMILARITY

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                [np.frombuffer(raw, np.uint64) for raw in batch.column(i).to_pylist()] for i in (2, 3)
            )
            alike = pa.array([similarity(x, y) >= least for x, y in zip(left, right)], pa.bool_())
            yield batch.select(["a", "b"]).filter(alike)

    return cut_lineage(
        pairs.join(sets.toDF("a", "left"), "a")
        .join(sets.toDF("b", "right"), "b")
        .select("a", "b", "left", "right")
        .mapInArrow(judge, "a long, b long")
    )


def _pairs(one: DataFrame, other: DataFrame) -> DataFrame:
    """Different pairs of (bucket, node, size, root) in a bucket that may be similar and are still apart."""
    left, right = one.toDF("bucket", "x", "x_size", "x_root"), other.toDF("bucket", "y", "y_size", "y_root")
    return (
        left.join(right, "bucket")
        .where("x <> y AND x_root <> y_root")
        .where(F.least("x_size", "y_size") >= F.lit(SIMILARITY) * F.greatest("x_size", "y_size"))
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        .distinct()
    )


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each set on the left has in common with each on the right."""
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    counts = np.zeros((len(left), len(right)), np.float64)
    for at in range(0, len(both), _COLUMNS):
        columns = both[at : at + _COLUMNS]
        sides = []
        for sets in (left, right):
            marks = np.zeros((len(sets), len(columns)), np.float32)
            for row, found in zip(marks, sets):
                near = np.minimum(np.searchsorted(found, columns), len(found) - 1)
                row[:] = found[near] == columns
            sides.append(marks)
        counts += sides[0] @ sides[1].T
    return counts


def _joining(left: list[tuple], right: list[tuple]) -> list[tuple[int, int]]:
    """Links between (node, root, shingles) of two pieces, as many as join their components."""
    nodes, roots, sets = zip(*[(zip(*side)) for side in (left, right)])
    sets = [[np.frombuffer(raw, np.uint64) for raw in side] for side in sets]
    both = common_counts(*sets)
    sizes = [np.array([len(x) for x in side], np.float64) for side in sets]
    total = sizes[0][:, None] + sizes[1][None, :] - both
    apart = np.array(roots[0])[:, None] != np.array(roots[1])[None, :]
    parent: dict[int, int] = {}

    def top(root: int) -> int:
        while (above := parent.get(root, root)) != root:
            root = above
        return root

    links = []
    for i, j in zip(*np.nonzero((both / total >= SIMILARITY) & apart)):
        x, y = top(roots[0][i]), top(roots[1][j])
        if x != y:
            parent[max(x, y)] = min(x, y)
            links.append((nodes[0][i], nodes[1][j]))
    return links


def _by_pieces(crowd: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) in crowded buckets of (bucket, node, size, root), written out."""
    cut = crowd.groupBy("bucket").agg(
        F.expr(f"1 + greatest(count(1) div {PIECE}, sum(size) div {PIECE_SHINGLES})").alias("pieces")
    )
    placed = crowd.join(cut, "bucket").withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")))
    member = F.struct("node", "root", "shingles")
    pieces = cut_lineage(
        placed.join(sets, "node")
        .groupBy("bucket", "pieces", "piece")
        .agg(F.collect_list(member).alias("members"))
    )
    # each piece meets itself and those behind it; the pair of pieces is part of the key
    behind = pieces.select(
        "bucket", F.explode(F.expr("sequence(piece, pieces - 1)")).alias("other"), "piece", F.col("members").alias("left")
    )
    ahead = pieces.select(
        "bucket", F.col("piece").alias("other"), F.explode(F.expr("sequence(0L, piece)")).alias("piece"),
        F.col("members").alias("right"),
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sides = ([(m["node"], m["root"], m["shingles"]) for m in side] for side in (left, right))
                links = _joining(*sides)
                columns = [pa.array([link[i] for link in links], pa.int64()) for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    met = behind.join(ahead, ["bucket", "other", "piece"]).select("left", "right")
    return cut_lineage(met.mapInArrow(join, "a long, b long"))


def fingerprint_pairs(points: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes with one fingerprint or linked ones that may be similar, written out.

    All nodes of a fingerprint meet its smallest one, and these meet along the links of ``simhash``, so there
    are no more pairs than nodes and links.
    """
    least = points.groupBy("fingerprint").agg(F.min(F.struct("node", "size")).alias("least"))
    firsts = cut_lineage(
        least.select("fingerprint", F.col("least.node").alias("a"), F.col("least.size").alias("a_size"))
    )
    pairs = (
        points.join(firsts, "fingerprint")
        .where("node <> a")
        .select("a", "a_size", F.col("node").alias("b"), F.col("size").alias("b_size"))
    )
    plan = simhash.make_plan(firsts)
    if plan is not None:
        pairs = pairs.unionByName(
            simhash.links(firsts, plan)
            .toDF("fingerprint", "other")
            .join(firsts, "fingerprint")
            .select("a", "a_size", F.col("other").alias("fingerprint"))
            .join(firsts.toDF("fingerprint", "b", "b_size"), "fingerprint")
            .select("a", "a_size", "b", "b_size")
        )
    alike = F.least("a_size", "b_size") >= F.lit(SIMILARITY) * F.greatest("a_size", "b_size")
    return cut_lineage(pairs.where(alike).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def links(points: DataFrame, given: DataFrame) -> DataFrame | None:
    """Verified links (a, b) between nodes, enough for their components; nothing where no search finds candidates."""
    near = fingerprint_pairs(points)
    entries = points.select(F.explode("buckets").alias("bucket"), "node", "size")
    counts = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = cut_lineage(entries.join(counts, "bucket"))
    if shared.isEmpty() and near.isEmpty():
        return None
    known = shared.groupBy("node").agg(F.sum("n").alias("met"))
    asked = known.select("node").union(near.select("a")).union(near.select("b")).distinct()
    keys = points.join(asked, "node").select(F.col("first.key").alias("row_key"), "node")

    def start() -> Callable:
        return lambda content: (shingles(_words(content)).tobytes(),)

    chosen = given.dropDuplicates(["row_key"]).join(keys, "row_key").select("node", "text")
    sets = cut_lineage(common.map_rows(chosen, "shingles binary", start))
    shared = cut_lineage(shared.join(known, "node"))
    columns = ["bucket", "node", "size", "root"]

    def apart(members: DataFrame) -> DataFrame:
        """Members of buckets that still hold several components."""
        mixed = members.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        return cut_lineage(members.join(mixed.where("low < high").select("bucket"), "bucket", "left_semi"))

    def joined(members: DataFrame, links: DataFrame) -> DataFrame:
        """Members of buckets still apart, with the roots that further links give."""
        above = connected(links.join(members.select(F.col("node").alias("a"), F.col("root").alias("x")).distinct(), "a")
                          .join(members.select(F.col("node").alias("b"), F.col("root").alias("y")).distinct(), "b")
                          .select(F.col("x").alias("a"), F.col("y").alias("b")))
        above = above.toDF("root", "above")
        return apart(
            members.join(above, "root", "left").withColumn("root", F.coalesce("above", "root")).drop("above")
        )

    place = F.struct("met", "node", "size")
    linked = _verified(near, sets)
    members = joined(shared.withColumn("root", F.col("node")), linked)
    centre = members.groupBy("bucket").agg(F.max(place).alias("centre"))
    chosen = (
        members.join(centre, "bucket")
        .where("centre.node <> node")
        .groupBy("node", "size")
        .agg(F.max("centre").alias("centre"))
        .where(F.least("size", "centre.size") >= F.lit(SIMILARITY) * F.greatest("size", "centre.size"))
        .select(F.least("node", "centre.node").alias("a"), F.greatest("node", "centre.node").alias("b"))
        .distinct()
    )
    found = _verified(chosen, sets)
    members, found = joined(members, found), found.unionByName(linked)
    firsts = cut_lineage(members.groupBy("bucket", "root").agg(F.max(place).alias("at")))
    best = firsts.groupBy("bucket").agg(F.max(F.struct("at", "root")).alias("best"))
    more = _verified(
        _pairs(
            firsts.select("bucket", "at.node", "at.size", "root"),
            best.select("bucket", "best.at.node", "best.at.size", "best.root"),
        ),
        sets,
    )
    members, found = joined(members, more), found.unionByName(more)
    small = members.where(F.col("n") <= CROWD).select(columns)
    more = _verified(_pairs(small, small), sets)
    members, found = joined(members, more), found.unionByName(more)
    crowd = members.where(F.col("n") > CROWD).select(columns)
    return found if crowd.isEmpty() else found.unionByName(_by_pieces(crowd, sets))


def components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document doc_id, row_key, component_id, and whether it is its component's first.

    The first document of a component has the smallest id; rows that tie in id are told apart by text.
    """
    rows = signatures(docs, doc_id, text)
    place = F.struct(
        F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("row_key").alias("key")
    )
    points = cut_lineage(
        rows.groupBy("node").agg(
            F.min(place).alias("first"),
            *[F.first(name).alias(name) for name in ("size", "fingerprint", "buckets")],
        )
    )
    linked = links(points, _given(docs, doc_id, text).toDF("doc_id", "row_key", "text"))
    grouped = points.select("node", "first")
    if linked is not None:
        rooted = points.join(connected(linked), "node", "left").withColumn("root", F.coalesce("root", "node"))
        rooted = cut_lineage(rooted.select("node", "root", "first"))
        firsts = cut_lineage(rooted.groupBy("root").agg(F.min("first").alias("first")))
        grouped = rooted.select("node", "root").join(firsts, "root").select("node", "first")
    return rows.join(grouped, "node").select(
        "doc_id",
        "row_key",
        F.col("first.id").alias("component_id"),
        (F.col("first.key") == F.col("row_key")).alias("is_first"),
    )


def first_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, with all its columns."""
    kept = components(docs, doc_id, text).where("is_first").select("row_key")
    return common.keep_rows(docs, kept, doc_id, text)
