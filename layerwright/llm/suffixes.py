"""Repeated byte strings, by sorting a difference cover of their suffixes over the cluster.

Every byte covered by a string of ``LENGTH`` bytes that also starts anywhere else is removed.

1. Cover. Of every ``LENGTH - GRAM + 1`` places in a row the one whose ``GRAM`` bytes hash lowest is
   sampled. Each string of ``LENGTH`` bytes thus holds a sampled place, and equal strings hold it at the
   same step: the property of a difference cover, with places chosen by content instead of by residue.
   Sampled places whose bytes start nowhere else are dropped, and the strings that hold them with them.
2. Names. The bytes at each remaining sampled place are named; places are dealt out by range of names and
   sorted by name, so that places with equal bytes stand together.
3. Remaining suffixes. A string is the bytes up to its sampled place, the name there, and the bytes behind
   what is named. All strings of a run of equal names are sorted by those, and neighbours compared.
4. Crowds. Places of a name that more than ``CROWD`` places bear are not brought together. Their strings
   are cut into segments and go through a suffix sort that spreads equal keys over tasks:
   bytes are read in words of eight; of three words in a row, those of number 1 and 2 (modulo 3) begin a
   sampled suffix; triples of words (24 bytes) are sorted and named by rank, three names 24 bytes apart
   are sorted and named again (72 bytes), and once more with a shorter third part (168 bytes), where the
   recursion ends; each string then is its first words up to a sampled place, the name there and the
   words behind it, all are sorted together, and equal ones found.

Names of step 2 are hashes of 128 bits, not ranks: only whether they are equal matters.

Defined cases: a null text is an empty one; a text shorter than ``LENGTH`` bytes keeps all of them;
rows with equal texts are copies, whatever their ids; ids of any type are handed on; an empty table
gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm import common
from layerwright.session import cut_lineage

LENGTH = 200
#: Bytes named at a sampled place.
GRAM = 128
#: Bytes of a string before and behind what is named.
REST = LENGTH - GRAM
#: Places with one name that are brought together.
CROWD = 200_000
#: Repeated names up to which they are sent to every task: 16 bytes each, 64 MB in all.
BROADCAST = 4_000_000
#: Places compared, and places handed on, at a time.
BATCH = 6_000
ROWS = 20_000
#: Strings that start in one segment.
STARTS = 4096

WORD = 8
TRIPLE = 3 * WORD
NAMED = 168
STEPS = (0, 1, 2)

#: Odd factors of two independent hashes.
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


#: Powers by base; kept up to those of a long text.
_KEPT: dict[int, np.ndarray] = {}
_KEEP = 1 << 18


def _powers(base: int, count: int) -> np.ndarray:
    found = _KEPT.get(base)
    if found is None or len(found) < count:
        factors = np.full(max(count, 1 << 14), base, np.uint64)
        factors[0] = 1
        found = np.cumprod(factors)
        if len(found) <= _KEEP:
            _KEPT[base] = found
    return found[:count]


def _stirred(hashes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        hashes = hashes ^ (hashes >> np.uint64(31))
        hashes = hashes * np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(29))


def gram_hashes(raw: bytes, size: int = GRAM, factor: int = _FACTORS[0]) -> np.ndarray:
    """A hash of the ``size`` bytes at every place, alike for equal bytes."""
    values = np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(factor, len(values)))])
        back = _powers(pow(factor, -1, 1 << 64), len(values) - size + 1)
        hashes = (sums[size:] - sums[:-size]) * back
    return _stirred(hashes)


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    reached = 1
    while 2 * reached <= width:
        values = np.minimum(values[:-reached], values[reached:])
        reached *= 2
    if reached < width:
        values = np.minimum(values[: len(values) - (width - reached)], values[width - reached :])
    return values


class Samples(NamedTuple):
    """Sampled places of a text, the hash of their bytes, and the first and last string they serve."""

    at: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    last: np.ndarray


def samples(raw: bytes) -> Samples:
    if len(raw) < LENGTH:
        empty = np.empty(0, np.int64)
        return Samples(empty, empty, empty, empty)
    hashes = gram_hashes(raw)
    # the place in the lower half breaks ties, to the left
    marked = (hashes & np.uint64(0xFFFFFFFF << 32)) | np.arange(len(hashes), dtype=np.uint64)
    chosen = (_lowest(marked, REST + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    last = np.concatenate([first[1:], [len(chosen)]]) - 1
    at = chosen[first]
    return Samples(at, hashes[at].view(np.int64), first, last)


def likenesses(raw: bytes, found: Samples) -> np.ndarray:
    """For each sample the first one of the text with the same bytes all around, as far as its strings reach.

    A line that a text repeats thousands of times thus counts once.
    """
    own = np.arange(len(found.at))
    if len(np.unique(found.hashes)) == len(own):
        return own
    seen: dict[tuple, int] = {}
    for i, (at, first, last) in enumerate(zip(found.at.tolist(), found.first.tolist(), found.last.tolist())):
        own[i] = seen.setdefault((at - first, raw[first : last + LENGTH]), i)
    return own


def _words(raw: bytes) -> np.ndarray:
    """The eight bytes at every place as a signed number in the order of the bytes."""
    padded = np.frombuffer(raw + bytes(WORD - 1), np.uint8).astype(np.uint64)
    count = len(raw)
    value = np.zeros(count, np.uint64)
    for i in range(WORD):
        value = (value << np.uint64(8)) | padded[i : i + count]
    return (value ^ np.uint64(1 << 63)).view(np.int64)


def _sampled(places: np.ndarray) -> np.ndarray:
    return (places // WORD) % 3 != 0


def _emit(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names)


def _twice_at_most(raw: bytes, found: Samples) -> Samples:
    """The samples without the third and later ones that are alike; two show that the bytes repeat."""
    like = likenesses(raw, found)
    again = np.flatnonzero(like != np.arange(len(like)))
    if not len(again):
        return found
    seconds = again[np.unique(like[again], return_index=True)[1]]
    kept = np.sort(np.concatenate([np.flatnonzero(like == np.arange(len(like))), seconds]))
    return Samples(*[column[kept] for column in found])


def _sample_rows(texts: DataFrame, located: bool) -> DataFrame:
    """(hash, place) of every sampled place, with ref and at if ``located``.

    ``place`` is alike only for one place of equal texts.
    """
    common.importable(texts.sparkSession)
    names = ["hash", "place", "ref", "at"][: 4 if located else 2]
    size = ROWS

    def flushed(rows: list[tuple]) -> pa.RecordBatch:
        refs, founds = zip(*rows)
        counts = [len(found.at) for found in founds]
        at = np.concatenate([found.at for found in founds])
        starts = np.repeat(np.frombuffer(b"".join([ref[:8] for ref in refs]), np.uint64), counts)
        with np.errstate(over="ignore"):
            place = _stirred(starts + at.astype(np.uint64) * np.uint64(_FACTORS[1])).view(np.int64)
        columns = [pa.array(np.concatenate([found.hashes for found in founds])), pa.array(place)]
        if located:
            owners = pa.array(np.repeat(np.arange(len(refs)), counts))
            columns += [pa.array(refs, pa.binary()).take(owners), pa.array(at)]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for ref, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = content.as_buffer().to_pybytes()
                found = samples(raw)
                if len(found.at):
                    found = _twice_at_most(raw, found)
                    rows.append((ref, found))
                    held += len(found.at)
                if held >= size:
                    yield flushed(rows)
                    rows, held = [], 0
        if rows:
            yield flushed(rows)

    schema = "hash long, place long" + (", ref binary, at long" if located else "")
    return texts.select("ref", F.col("content").cast("binary")).mapInArrow(run, schema)


def _repeated(texts: DataFrame) -> DataFrame:
    """(hash, crowd) of the bytes at sampled places that two places or more have."""
    return cut_lineage(
        _sample_rows(texts, located=False)
        .groupBy("hash")
        .agg(F.min("place").alias("least"), F.max("place").alias("most"), F.count(F.lit(1)).alias("n"))
        .where("least <> most")
        .select("hash", (F.col("n") > CROWD).alias("crowd"))
    )


CONTEXT = (
    "ref binary, name_1 long, name_2 long, at long, first long, last long, crowd boolean, "
    "before binary, behind binary, segment binary"
)


def _contexts(texts: DataFrame, repeated: DataFrame) -> DataFrame:
    """The sampled places with repeated bytes, and the bytes around them that their strings reach.

    Of places of a text that are alike all around one takes part; what they show to be repeated comes as
    rows without such bytes.

    The repeated hashes are sent to every task while they are few; else each text gets its own by joins.
    """
    common.importable(texts.sparkSession)
    names = [part.split()[0] for part in CONTEXT.split(", ")]
    given = texts.select("ref", F.col("content").cast("binary"))
    shared = None
    if repeated.count() <= BROADCAST:
        table = repeated.orderBy("hash").toArrow()
        shared = texts.sparkSession.sparkContext.broadcast(
            (table.column("hash").to_numpy(), table.column("crowd").to_numpy(zero_copy_only=False))
        )
    else:
        mark = F.struct("at", "crowd")
        marks = cut_lineage(
            _sample_rows(texts, located=True)
            .join(repeated, "hash")
            .groupBy("ref")
            .agg(F.collect_set(mark).alias("marks"))
        )
        given = given.join(marks, "ref").select(
            "ref", "content", F.col("marks.at").alias("places"), F.col("marks.crowd").alias("crowds")
        )

    size = ROWS

    def marked(found: Samples, row: tuple) -> tuple[np.ndarray, np.ndarray]:
        """Which of the samples have repeated bytes, and which of those are crowded."""
        if shared is None:
            places = np.array(row[0].as_py())
            order = np.argsort(places)
            return np.searchsorted(found.at, places[order]), np.array(row[1].as_py())[order]
        hashes, crowds = shared.value
        if not len(found.at) or not len(hashes):
            return np.empty(0, np.int64), np.empty(0, bool)
        where = np.minimum(np.searchsorted(hashes, found.hashes), len(hashes) - 1)
        kept = np.flatnonzero(hashes[where] == found.hashes)
        return kept, crowds[where[kept]]

    def flushed(rows: list[tuple]) -> pa.RecordBatch:
        refs, arrays, slices = zip(*rows)
        owners = pa.array(np.repeat(np.arange(len(refs)), [len(part[0]) for part in arrays]))
        columns = [pa.array(np.concatenate(column)) for column in zip(*arrays)]
        cut = [pa.array([v for part in column for v in part], pa.binary()) for column in zip(*slices)]
        return pa.RecordBatch.from_arrays([pa.array(refs, pa.binary()).take(owners), *columns, *cut], names)

    def alike(ref: bytes, found: Samples, like: np.ndarray, number: int) -> tuple | None:
        """Rows for the runs of strings that the text itself repeats; their names only spread them."""
        again = like != np.arange(len(like))
        if not again.any():
            return None
        again[like[again]] = True
        index = np.flatnonzero(again)
        begin = np.flatnonzero(np.concatenate([[True], np.diff(index) > 1]))
        end = np.concatenate([begin[1:], [len(index)]]) - 1
        low, high = found.first[index[begin]], found.last[index[end]]
        name = _stirred(np.uint64(number) + np.arange(len(low), dtype=np.uint64)).view(np.int64)
        none = [None] * len(low)
        return ref, (name, name, low, low, high, np.zeros(len(low), bool)), (none, none, none)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held, number = [], 0, TaskContext.get().partitionId() << 40
        for batch in batches:
            for ref, content, *row in zip(batch.column(0).to_pylist(), *batch.columns[1:]):
                raw = content.as_buffer().to_pybytes()
                found = samples(raw)
                like = likenesses(raw, found)
                kept, crowd = marked(found, row)
                alone = like[kept] == kept
                kept, crowd = kept[alone], crowd[alone]
                if not len(kept):
                    continue
                if (own := alike(ref, found, like, number)) is not None:
                    rows.append(own)
                    number += len(own[1][0])
                    held += len(own[1][0])
                second = gram_hashes(raw, GRAM, _FACTORS[1]).view(np.int64)
                at, first, last = found.at[kept], found.first[kept], found.last[kept]
                bounds = list(zip(at.tolist(), first.tolist(), last.tolist(), crowd.tolist()))
                slices = (
                    [None if c else raw[f:m] for m, f, _, c in bounds],
                    [None if c else raw[m + GRAM : z + LENGTH] for m, _, z, c in bounds],
                    [raw[f : z + LENGTH] if c else None for _, f, z, c in bounds],
                )
                rows.append((ref, (found.hashes[kept], second[at], at, first, last, crowd), slices))
                held += len(kept)
                if held >= size:
                    yield flushed(rows)
                    rows, held = [], 0
        if rows:
            yield flushed(rows)

    return given.mapInArrow(run, CONTEXT)


def _padded(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join([row.ljust(REST, b"\0") for row in rows]), np.uint8).reshape(-1, REST)


def equal_strings(
    groups: np.ndarray,
    at: np.ndarray,
    first: np.ndarray,
    last: np.ndarray,
    before: list[bytes],
    behind: list[bytes],
) -> tuple[np.ndarray, np.ndarray]:
    """Row and start of each string that a string of another row in its group equals, in order.

    A string that starts ``step`` bytes before its sampled place is told by the ``step`` bytes before
    it and the ``REST - step`` bytes behind what is named. Strings are sorted step by step, so memory
    is in proportion to the rows.
    """
    left_bytes, right_bytes = _padded([row[::-1] for row in before]), _padded(behind)
    found_rows, found_starts = [], []
    with np.errstate(over="ignore"):
        powers = [_powers(factor, REST) for factor in _FACTORS]
        named = _stirred(groups.astype(np.uint64))
        left = [np.zeros(len(at), np.uint64) for _ in powers]
        right = [((right_bytes + np.uint64(1)) * power).sum(axis=1, dtype=np.uint64) for power in powers]
        for step in range(REST + 1):
            rows = np.flatnonzero((at - last <= step) & (step <= at - first))
            if len(rows) > 1:
                keys = [
                    _stirred(_stirred(x[rows]) * np.uint64(salt) + _stirred(y[rows] + named[rows]))
                    for x, y, salt in zip(left, right, _FACTORS[::-1])
                ]
                order = np.lexsort(keys)
                same = np.ones(len(rows) - 1, bool)
                for key in keys:
                    same &= key[order[1:]] == key[order[:-1]]
                equal = np.zeros(len(rows), bool)
                equal[1:] |= same
                equal[:-1] |= same
                chosen = rows[order[equal]]
                found_rows.append(chosen)
                found_starts.append(at[chosen] - step)
            if step < REST:
                back = REST - 1 - step
                for x, y, power in zip(left, right, powers):
                    x += (left_bytes[:, step] + np.uint64(1)) * power[step]
                    y -= (right_bytes[:, back] + np.uint64(1)) * power[back]
    if not found_rows:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rows, starts = np.concatenate(found_rows), np.concatenate(found_starts)
    order = np.lexsort([starts, rows])
    return rows[order], starts[order]


def _runs(rows: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, first and last start of each run of starts."""
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (starts[1:] != starts[:-1] + 1)
    begins = np.flatnonzero(new)
    ends = np.concatenate([begins[1:], [len(rows)]]) - 1
    return rows[begins], starts[begins], starts[ends]


def _compared(contexts: DataFrame) -> DataFrame:
    """(ref, first, last) of the runs of strings that start elsewhere too, for names that are no crowd."""
    count = int(contexts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = BATCH
    ordered = contexts.drop("crowd", "segment").repartitionByRange(count, "name_1", "name_2").sortWithinPartitions(
        "name_1", "name_2", "ref", "at"
    )

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        one, two, at, first, last = (
            table.column(name).to_numpy() for name in ("name_1", "name_2", "at", "first", "last")
        )
        refs = table.column("ref").combine_chunks()
        raw = np.frombuffer(b"".join(refs.to_pylist()), "V16")
        new = np.ones(len(at), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        kept = np.ones(len(at), bool)  # one of the rows of equal texts
        kept[1:] = new[1:] | (raw[1:] != raw[:-1]) | (at[1:] != at[:-1])
        known = table.column("before").combine_chunks().is_null().to_numpy(zero_copy_only=False)
        if known.any():
            index = pa.array(np.flatnonzero(known))
            yield pa.RecordBatch.from_arrays(
                [refs.take(index), pa.array(first[known]), pa.array(last[known])], ["ref", "first", "last"]
            )
        kept &= ~known
        groups = np.cumsum(new)
        sizes = np.bincount(groups[kept], minlength=groups[-1] + 1)
        kept &= sizes[groups] > 1
        index = np.flatnonzero(kept)
        if not len(index):
            return
        part = table.take(pa.array(index))
        rows, starts = equal_strings(
            groups[index],
            at[index],
            first[index],
            last[index],
            part.column("before").to_pylist(),
            part.column("behind").to_pylist(),
        )
        if len(rows):
            owner, low, high = _runs(rows, starts)
            yield pa.RecordBatch.from_arrays(
                [refs.take(pa.array(index[owner])), pa.array(low), pa.array(high)], ["ref", "first", "last"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                held.append(batch.slice(at, size))
                rows += held[-1].num_rows
                if rows < size:
                    continue
                table = pa.Table.from_batches(held).combine_chunks()
                one, two = table.column("name_1").to_numpy(), table.column("name_2").to_numpy()
                whole = np.flatnonzero((one != one[-1]) | (two != two[-1]))  # before the last name
                if len(whole):
                    end = int(whole[-1]) + 1
                    yield from compare(table.slice(0, end).combine_chunks())
                    table = table.slice(end)
                held, rows = table.to_batches(), table.num_rows
        if rows:
            yield from compare(pa.Table.from_batches(held).combine_chunks())

    return ordered.mapInArrow(run, "ref binary, first long, last long")


def _segments(contexts: DataFrame) -> DataFrame:
    """Segments (segment, ref, first, content) of the strings that crowds serve; a string is in one."""
    return cut_lineage(
        contexts.where("crowd").select(
            F.monotonically_increasing_id().alias("segment"), "ref", "first", F.col("segment").alias("content")
        )
    )


def _sorted_names(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(segment, at, name): rows with equal keys get the same name, in the order of the keys."""
    given = cut_lineage(rows)
    count = int(given.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = given.repartitionByRange(count, *keys, "segment", "at").sortWithinPartitions(*keys)
    columns = ["segment", "at", "part", "rank", *keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, rank, held = None, -1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield held[0]
            values = np.stack([batch.column(name).to_numpy() for name in keys])
            before = values[:, :1] - 0 if last is None else last
            new = (values != np.concatenate([before, values[:, :-1]], axis=1)).any(axis=0)
            if last is None:
                new[0] = True
            ranks = rank + np.cumsum(new)
            edge = np.zeros(batch.num_rows, bool)
            edge[0], edge[-1] = last is None, False
            blank = [pa.array(v, mask=~edge) for v in values]
            data = [batch.column("segment"), batch.column("at"), pa.array(np.full(len(ranks), part)), pa.array(ranks)]
            whole = pa.RecordBatch.from_arrays([*data, *blank], columns)
            rank, last = int(ranks[-1]), values[:, -1:]
            if batch.num_rows > 1:
                yield whole.slice(0, batch.num_rows - 1)
            shown = [c.slice(len(c) - 1, 1) for c in data] + [pa.array(v[-1:]) for v in values]
            held = whole.slice(batch.num_rows - 1, 1), pa.RecordBatch.from_arrays(shown, columns)
        if held is not None:
            yield held[1]

    schema = "segment long, at long, part long, rank long, " + ", ".join(f"{k} long" for k in keys)
    ranked = cut_lineage(ordered.select("segment", "at", *keys).mapInArrow(run, schema))
    return _with_offsets(ranked, keys)


def _with_offsets(ranked: DataFrame, keys: list[str]) -> DataFrame:
    """Ranks within tasks turned into ranks over all; at most two rows per task show their keys."""
    shown = sorted(
        tuple(row) for row in ranked.where(F.col(keys[0]).isNotNull()).select("part", "rank", *keys).collect()
    )
    offsets: dict[int, int] = {}
    following, previous = 0, None
    for part in sorted({row[0] for row in shown}):
        edges = [row for row in shown if row[0] == part]
        first, last = edges[0], edges[-1]
        offsets[part] = following - (previous == first[2:])
        following = offsets[part] + last[1] + 1
        previous = last[2:]
    if not offsets:
        return ranked.select("segment", "at", F.col("rank").alias("name"))
    table = ranked.sparkSession.createDataFrame(sorted(offsets.items()), "part long, offset long")
    return ranked.join(F.broadcast(table), "part").select(
        "segment", "at", (F.col("rank") + F.col("offset")).alias("name")
    )


def _by_segment(*named: DataFrame) -> DataFrame:
    """Per segment the places and names of each frame, in arrays; a segment is bounded."""
    out = None
    for i, names in enumerate(named):
        grouped = names.groupBy("segment").agg(
            F.sort_array(F.collect_list(F.struct("at", "name"))).alias("pairs")
        ).select(
            "segment", F.col("pairs.at").alias(f"at_{i}"), F.col("pairs.name").alias(f"name_{i}")
        )
        out = grouped if out is None else out.join(grouped, "segment")
    return out


def _spread(places: np.ndarray, names: np.ndarray, size: int) -> np.ndarray:
    """Names by place, -1 where a place has none."""
    found = np.full(size, -1, np.int64)
    found[places] = names
    return found


def _map_segments(df: DataFrame, schema: str, function: Callable) -> DataFrame:
    """Rows that a function makes of each segment, given its number and its other columns."""
    common.importable(df.sparkSession)
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                values = [column[at] for column in batch.columns]
                given = [
                    v.as_buffer().to_pybytes() if pa.types.is_binary(v.type)
                    else v.values.to_numpy() if pa.types.is_list(v.type)
                    else v.as_py()
                    for v in values
                ]
                columns = function(*given[1:])
                if len(columns[0]):
                    yield _emit([np.full(len(columns[0]), given[0]), *columns], names)

    return df.mapInArrow(run, schema)


def _byte_triples(content: bytes) -> list[np.ndarray]:
    words = _words(content)
    places = np.arange(max(0, len(content) - TRIPLE + 1))
    places = places[_sampled(places)]
    return [places, words[places], words[places + WORD], words[places + 2 * WORD]]


def _name_triples(places: np.ndarray, names: np.ndarray) -> list[np.ndarray]:
    """Three names in a row: 72 bytes."""
    by_place = _spread(places, names, int(places[-1]) + 2 * TRIPLE + 1)
    triples = [by_place[places], by_place[places + TRIPLE], by_place[places + 2 * TRIPLE]]
    good = (triples[1] >= 0) & (triples[2] >= 0)
    return [column[good] for column in (places, *triples)]


def _deep_triples(
    places_24: np.ndarray, names_24: np.ndarray, places: np.ndarray, names: np.ndarray
) -> list[np.ndarray]:
    """Two names of 72 bytes and one of 24: 168 bytes."""
    size = int(places_24[-1]) + NAMED + 1
    short, long = _spread(places_24, names_24, size), _spread(places, names, size)
    triples = [long[places], long[places + 3 * TRIPLE], short[places + 6 * TRIPLE]]
    good = (triples[1] >= 0) & (triples[2] >= 0)
    return [column[good] for column in (places, *triples)]


def _strings(content: bytes, places: np.ndarray, names: np.ndarray) -> list[np.ndarray]:
    """Every string of the segment under each step to a sampled place: step, name and the other words."""
    count = len(content) - LENGTH + 1
    words, by_place = _words(content), _spread(places, names, len(content))
    starts = np.arange(count)
    made = []
    for step in STEPS:
        chosen = starts[_sampled(starts + step * WORD)]
        heads = [words[chosen + i * WORD] for i in range(step)]
        behind = chosen + step * WORD + NAMED
        tails = [words[behind + i * WORD] for i in range(4 - step)]
        made.append([chosen, np.full(len(chosen), step), by_place[chosen + step * WORD], *heads, *tails])
    return [np.concatenate(column) for column in zip(*made)]


def repeated_starts(segments: DataFrame) -> DataFrame:
    """(segment, at) of every string of a segment that starts elsewhere too, by suffix sorting."""
    first, second, third = "k1", "k2", "k3"
    triple = "segment long, at long, k1 long, k2 long, k3 long"
    bytes_24 = cut_lineage(
        _sorted_names(
            _map_segments(segments.select("segment", "content"), triple, _byte_triples), [first, second, third]
        )
    )
    bytes_72 = cut_lineage(
        _sorted_names(
            _map_segments(_by_segment(bytes_24), triple, _name_triples), [first, second, third]
        )
    )
    bytes_168 = _sorted_names(
        _map_segments(_by_segment(bytes_24, bytes_72), triple, _deep_triples), [first, second, third]
    )
    strings = _map_segments(
        segments.select("segment", "content").join(_by_segment(bytes_168), "segment"),
        "segment long, at long, step long, name long, w1 long, w2 long, w3 long, w4 long",
        _strings,
    )
    keys = ["step", "name", "w1", "w2", "w3", "w4"]
    names = cut_lineage(_sorted_names(strings, keys))
    return _neighbours(names)


def _neighbours(names: DataFrame) -> DataFrame:
    """Places whose name another place has too."""
    place = F.struct("segment", "at")
    shared = (
        names.groupBy("name")
        .agg(F.min(place).alias("least"), F.max(place).alias("most"))
        .where("least <> most")
        .select("name")
    )
    return names.join(cut_lineage(shared), "name", "left_semi").select("segment", "at").distinct()


def _merged(starts: list[int]) -> list[dict]:
    spans: list[dict] = []
    for start in sorted(starts):
        if spans and start <= spans[-1]["end"]:
            spans[-1]["end"] = start + LENGTH
        else:
            spans.append({"start": start, "end": start + LENGTH})
    return spans


def repeated_runs(texts: DataFrame) -> DataFrame:
    """(ref, first, last): runs of starts of strings that start elsewhere too, by text."""
    repeated = _repeated(texts)
    contexts = _contexts(texts, repeated)
    found = _compared(contexts.where("NOT crowd"))
    if repeated.where("crowd").isEmpty():
        return found
    segments = _segments(contexts)
    return found.unionByName(
        repeated_starts(segments)
        .join(segments.select("segment", "ref", F.col("first").alias("low")), "segment")
        .select("ref", (F.col("low") + F.col("at")).alias("first"), (F.col("low") + F.col("at")).alias("last"))
    )


def _merged(runs: list[dict]) -> list[dict]:
    spans: list[dict] = []
    for run in sorted(runs, key=lambda run: run["first"]):
        end = run["last"] + LENGTH
        if spans and run["first"] <= spans[-1]["end"]:
            spans[-1]["end"] = max(end, spans[-1]["end"])
        else:
            spans.append({"start": run["first"], "end": end})
    return spans


def _marked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Per row: doc_id, content, the runs of repeated starts, and whether the text has copies."""
    content = common.text_or_empty(text)
    given = docs.select(
        F.col(doc_id).alias("doc_id"),
        common.row_key(F.col(doc_id), content).alias("row_key"),
        content.alias("content"),
    )
    texts = given.select(F.unhex(F.md5("content")).alias("ref"), "content").where(
        F.octet_length("content") >= LENGTH
    )
    keys = cut_lineage(given.select("row_key", F.unhex(F.md5("content")).alias("ref")))
    copied = keys.groupBy("ref").count().where("count > 1").select("ref", F.lit(True).alias("copied"))
    runs = repeated_runs(texts).groupBy("ref").agg(
        F.collect_set(F.struct("first", "last")).alias("runs")  # at most as many as the text has starts
    )
    by_text = cut_lineage(
        copied.join(runs, "ref", "full").select(
            "ref", "copied", F.when(F.col("copied").isNull(), F.col("runs")).alias("runs")
        )
    )
    by_row = cut_lineage(keys.join(by_text, "ref").dropDuplicates(["row_key"]).drop("ref"))
    return given.join(by_row, "row_key", "left").select("doc_id", "content", "runs", "copied")


def _removed(raw: bytes, runs: list[dict] | None, copied: bool | None) -> list[dict]:
    if copied and len(raw) >= LENGTH:
        return [{"start": 0, "end": len(raw)}]
    return _merged(runs or [])


def _kept(raw: bytes, removed: list[dict]) -> Iterator[bytes]:
    at = 0
    for span in removed:
        yield raw[at : span["start"]]
        at = span["end"]
    yield raw[at:]


def spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, the spans of bytes to remove (start, end), and the bytes that stay."""

    def start() -> Callable:
        def one(content: str, runs: list[dict] | None, copied: bool | None) -> tuple:
            raw = content.encode()
            removed = _removed(raw, runs, copied)
            return removed, b"".join(_kept(raw, removed))

        return one

    return common.map_rows(
        _marked(docs, doc_id, text), "spans array<struct<start: long, end: long>>, kept binary", start
    )


def report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans and the digest of the bytes that are kept."""

    def start() -> Callable:
        def one(content: str, runs: list[dict] | None, copied: bool | None) -> tuple:
            raw = content.encode()
            removed = _removed(raw, runs, copied)
            digest = hashlib.sha256()
            for part in _kept(raw, removed):
                digest.update(part)
            gone = sum(span["end"] - span["start"] for span in removed)
            return len(raw), gone, len(removed), digest.hexdigest()

        return one

    return common.map_rows(
        _marked(docs, doc_id, text),
        "n_bytes long, n_removed long, n_spans long, kept_sha256 string",
        start,
    )
