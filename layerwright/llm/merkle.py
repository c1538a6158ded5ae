"""A Merkle manifest of a table: a tree of hashes per group, and one over the groups' roots.

Leaves stand in order of group and key. An aligned block of ``BLOCK`` of them keeps each of its levels
as one string of hex digests: a fixed-width substring holds the children of a parent, and the substrings
on either side of a digest are its siblings. The roots of the blocks are the leaves of the next tier,
until each group has one root; the roots of the groups, ordered by group, go through the same once more.

Every run of ``FANOUT`` digests becomes the hash of their hex texts, a shorter last run too, while a
level has more than one digest. A block is the largest unit that a task holds: 512 digests, whatever the
size of a group. Keys are numbered by ranges, so a group of any size is spread over tasks.

Defined cases: a null field counts as ``-``, which no value does; a null group is a group of its own and
the first; null keys come first in a group; rows that tie in key are ordered by digest, and rows equal in
all fields are leaves of their own; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwright.session import cut_lineage

FANOUT = 8
#: Levels of a block, and the leaves it has then.
LEVELS = 3
BLOCK = FANOUT**LEVELS
#: Characters of a digest.
WIDTH = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TASK_BITS = 33


def leaf(*fields: Column) -> Column:
    """The digest of a row: each field as its UTF-8 byte count, a colon and its text, or ``-`` if null."""
    texts = [field.cast("string") for field in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def ascii_lower(text: Column) -> Column:
    """``text`` with only A to Z lower-cased."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with ``pos``, their place in the group ``grp`` by ``order``, and ``n``, the size of the group.

    Rows are dealt by ranges of group and order and written out, so that the ranges stay as they are. One
    row per range and group says how many rows of the group lie before.
    """
    written = cut_lineage(
        rows.repartitionByRange("grp", *order)
        .sortWithinPartitions("grp", *order)
        .withColumn("__at", F.monotonically_increasing_id())
    )
    placed = written.withColumn("__range", F.shiftright("__at", _TASK_BITS))
    before = Window.partitionBy("grp").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        placed.groupBy("grp", "__range")
        .agg(F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__first"))
        .withColumn("__before", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
        .withColumn("n", F.sum("__rows").over(Window.partitionBy("grp")))
    )
    return (
        placed.join(cut_lineage(runs.drop("__rows")), ["grp", "__range"])
        .withColumn("pos", F.col("__before") + F.col("__at") - F.col("__first"))
        .drop("__at", "__range", "__first", "__before")
    )


def _blocks(nodes: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per aligned block (grp, blk, n) its nodes in order, at most ``BLOCK``, with the columns ``names``."""
    node = F.struct("pos", "digest", *names)
    return nodes.groupBy("grp", F.expr(f"pos div {BLOCK}").alias("blk")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(node)).alias("nodes")
    )


#: How many levels of a block have a parent: none above a single digest.
_CLIMBED = f"CASE WHEN n <= 1 THEN 0 WHEN n <= {FANOUT} THEN 1 WHEN n <= {FANOUT**2} THEN 2 ELSE {LEVELS} END"
_RUN = FANOUT * WIDTH


def _parents(level: str) -> str:
    """SQL for the string of digests above ``level``: one of each fixed-width run of children."""
    run = f"substring({level}, i * {_RUN} + 1, {_RUN})"
    return f"""cast(array_join(transform(
        sequence(0, cast((length({level}) - 1) div {_RUN} as int)), i -> sha2({run}, 256)), '') as binary)"""


def _levels(blocks: DataFrame) -> DataFrame:
    """Blocks with ``levels``, the strings from the leaves up to the block's root."""
    steps = f"slice(sequence(1, {LEVELS}), 1, {_CLIMBED})"
    first = "array(cast(array_join(transform(nodes, x -> x.digest), '') as binary))"
    above = _parents("element_at(done, -1)")
    return blocks.withColumn(
        "levels", F.expr(f"aggregate({steps}, {first}, (done, step) -> concat(done, array({above})))")
    )


def _with_segments(blocks: DataFrame) -> DataFrame:
    """Blocks with ``nodes`` that know their ``segs``: per level, what stands before and behind in the run."""
    at = f"shiftright(cast(x.pos % {BLOCK} as int), 3 * l)"
    before = f"substring(levels[l], cast({at} div {FANOUT} as int) * {_RUN} + 1, {at} % {FANOUT} * {WIDTH})"
    behind = f"substring(levels[l], ({at} + 1) * {WIDTH} + 1, ({FANOUT - 1} - {at} % {FANOUT}) * {WIDTH})"
    segments = f"""transform(slice(sequence(0, {LEVELS - 1}), 1, {_CLIMBED}),
        l -> named_struct('pre', {before}, 'post', {behind}))"""
    return blocks.withColumn("nodes", F.expr(f"transform(nodes, x -> named_struct('node', x, 'segs', {segments}))"))


def fold(path: str, digest: str) -> str:
    """SQL for the root that ``digest`` leads to along ``path``, the siblings from the lowest level up."""
    return f"aggregate({path}, {digest}, (own, s) -> sha2(concat(s.pre, cast(own as binary), s.post), 256))"


def _text(path: str) -> str:
    return f"array_join(transform({path}, s -> concat(cast(s.pre as string), cast(s.post as string))), '')"


def _tree(nodes: DataFrame, names: Sequence[str]) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each tier, from the leaves up, and the root of each group (grp, digest)."""
    tiers = [cut_lineage(_blocks(nodes, names))]
    while True:
        tops = cut_lineage(
            _levels(tiers[-1]).select(
                "grp",
                F.col("blk").alias("pos"),
                F.expr(f"(n + {BLOCK - 1}) div {BLOCK}").alias("n"),
                F.expr("cast(element_at(levels, -1) as string)").alias("digest"),
            )
        )
        if tops.where("n > 1").isEmpty():
            return tiers, tops.select("grp", "digest")
        tiers.append(cut_lineage(_blocks(tops, [])))


def _down(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest blocks, each with the path ``above`` it; ``above`` has that of each group's root.

    A block meets one row: the node of the next tier that is its root.
    """
    carried = [name for name in above.columns if name not in ("grp", "above")]
    found = above.withColumn("blk", F.lit(0).cast("long"))
    for tier in reversed(tiers[1:]):
        joined = _with_segments(_levels(tier.join(found, ["grp", "blk"])))
        found = joined.select("grp", F.explode("nodes").alias("x"), "above", *carried).select(
            "grp", F.col("x.node.pos").alias("blk"), F.expr("concat(x.segs, above)").alias("above"), *carried
        )
    return _with_segments(_levels(tiers[0].join(found, ["grp", "blk"])))


def manifest(rows: DataFrame, key: str, group: str, digest: str, offered: str) -> DataFrame:
    """Per row its place in the tree, its proof, and what the proof makes of the digest ``offered`` for it.

    ``digest`` names the leaves' digests, ``offered`` those that a holder shows now, null where the same.
    Columns: ``key``, ``group``, leaf, subroot, root, path (siblings from the leaf up: what stands before
    and behind in the run), proof_sha256 (of all siblings in a row), folded_root, verified.
    """
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0")).alias("grp"),
        F.col(key).alias("key"),
        F.col(digest).alias("digest"),
        F.col(offered).alias("offered"),
    )
    tiers, subroots = _tree(_numbered(leaves, ["key", "digest"]), ["key", "offered"])
    named = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest")
    upper, _ = _tree(_numbered(named, ["name"]), ["name"])
    start = named.sparkSession.createDataFrame([("",)], "grp string").withColumn(
        "above", F.expr("cast(array() as array<struct<pre: binary, post: binary>>)")
    )
    groups = _down(upper, start).select(F.explode("nodes").alias("x"), "above")
    groups = groups.select(
        F.col("x.node.name").alias("grp"),
        F.col("x.node.digest").alias("subroot"),
        F.expr("concat(x.segs, above)").alias("above"),
    ).withColumn("root", F.expr(fold("above", "subroot")))
    blocks = _down(tiers, cut_lineage(groups)).withColumn("above_text", F.expr(_text("above")))
    path = "concat(x.segs, above)"
    proved = f"""transform(nodes, x -> named_struct('key', x.node.key, 'leaf', x.node.digest, 'path', {path},
        'proof', sha2(concat({_text("x.segs")}, above_text), 256),
        'folded', {fold(path, "coalesce(x.node.offered, x.node.digest)")}))"""
    found = blocks.select("grp", "subroot", "root", F.explode(F.expr(proved)).alias("p"))
    return found.select(
        F.col("p.key").alias(key),
        F.expr("CASE WHEN grp <> '0' THEN substring(grp, 2) END").alias(group),
        F.col("p.leaf").alias("leaf"),
        "subroot",
        "root",
        F.col("p.path").alias("path"),
        F.col("p.proof").alias("proof_sha256"),
        F.col("p.folded").alias("folded_root"),
        (F.col("p.folded") == F.col("root")).alias("verified"),
    )


def tamper_check(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", group: str = "lang") -> DataFrame:
    """The manifest of documents, checked against texts of which a third has lost its capitals."""
    fields = [F.col(doc_id) if f == "doc_id" else F.col(text) if f == "text" else F.col(f) for f in FIELDS]
    lowered = ascii_lower(F.col(text))
    chosen = F.crc32(F.col(doc_id).cast("string")) % 3 == 0
    rows = docs.select(
        F.col(doc_id).alias("key"),
        F.col(group).alias("group"),
        leaf(*fields).alias("digest"),
        F.when(chosen & (lowered != F.col(text)), leaf(*fields[:-1], lowered)).alias("offered"),
    )
    found = manifest(rows, "key", "group", "digest", "offered")
    return found.withColumnRenamed("key", "doc_id").drop("group", "path")
