"""Best-fit packing of token sequences in bulk-synchronous steps.

Documents become pieces of at most the capacity.  Pieces and the gaps of open
sequences are tables, range-sorted by size and ranked among their equals.  A
superstep takes the pieces of one band of sizes, longest first: a successor sweep
gives each size the smallest gaps that hold it, several pieces to a gap where
they fit; equal pieces and equal gaps are told apart by rank alone, so every
piece finds its gap by one equality join; then the gaps are updated and the next
band follows.  Sizes are at most the capacity, so what the sweep reads and writes,
counts per size and ranges of ranks, does not grow with the data.  The outcome is
that of best-fit decreasing.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.tokens import Shipped
from pulsegrid.llm.words import chunks, lists
from pulsegrid.session import materialize

CAPACITY, END_ID = 4096, 1


def pieces(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
           end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Token sequences of documents, cut only where longer than ``capacity``:
    ``id_col``, piece, start, length, ids_crc32 and, ``with_ids``, the ids.

    Null text counts as empty and gives the end id alone; repeated rows give
    their pieces again; other columns are not read."""
    rows = df.select(id_col, text_col)
    shipped = Shipped(df, path)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.tokenizer()
        for batch in batches:
            for part, texts in chunks(batch, text_col):
                ids, at = own.encode(texts)
                ids = np.insert(ids, at[1:], end_id).astype("<u4")
                at = at + np.arange(len(at))
                sizes = np.diff(at)
                counts = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), counts)
                number = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                length = np.minimum(capacity, sizes[row] - number * capacity)
                begin = at[row] + number * capacity
                raw = ids.tobytes()
                crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(begin.tolist(), length.tolist())]
                columns = [part.column(0).take(pa.array(row)), pa.array(number, pa.int32()),
                           pa.array(number * capacity, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = [id_col, "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(lists(ids.astype(np.int32), length, pa.int32()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema[id_col].dataType.simpleString()
    more = ", ids array<int>" if with_ids else ""
    return rows.mapInArrow(scan, f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long{more}")


@dataclass
class Ranked:
    """A stored table in which ``size`` rows are numbered: ``local`` within task
    ``part``, to which ``before`` adds the rows of earlier tasks."""
    table: DataFrame
    counts: dict[int, int]
    before: dict[tuple[int, int], int]


def ranked(df: DataFrame, size: str, ties: list[str], label: str) -> Ranked:
    """Range-sort by size and number equal sizes.  Ties are part of the sort
    key, so that one frequent size spreads over tasks."""
    spread = df.repartitionByRange(size, *ties).sortWithinPartitions(size, *ties)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    column = df.columns.index(size)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            sizes = batch.column(column).to_numpy(zero_copy_only=False)
            values, first, counts = np.unique(sizes, return_index=True, return_counts=True)
            local = np.arange(len(sizes)) - np.repeat(first, counts) + np.repeat([seen[v] for v in values.tolist()], counts)
            for v, n in zip(values.tolist(), counts.tolist()):
                seen[v] += n
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(sizes), part), pa.int32()), pa.array(local.astype(np.int64))],
                [*batch.schema.names, "part", "local"])

    table = materialize(spread.mapInArrow(number, f"{fields}, part int, local long"), label)
    total: dict[int, int] = defaultdict(int)
    before = {}
    # Sorted tasks share sizes only at their borders: one row per task and per size.
    for r in table.groupBy("part", size).agg(F.count("*").alias("n")).orderBy("part", size).collect():
        before[r["part"], r[size]] = total[r[size]]
        total[r[size]] += r["n"]
    return Ranked(table, dict(total), before)


@dataclass
class Sweep:
    """What one superstep decides: for each piece size, ranges of ranks with
    where they go; for each gap class of before, ranges of ranks with what is
    left; how many sequences are new."""
    moves: dict[int, list[tuple[int, int, int, int, int]]] = field(default_factory=lambda: defaultdict(list))
    left: list[tuple[int, int, int, int]] = field(default_factory=list)
    opened: int = 0


def sweep(sizes: dict[int, int], gaps: dict[int, int], capacity: int) -> Sweep:
    """Successor sweep over counts.  A move of a size is (first rank of the
    pieces, pieces per gap, gap class, first rank of the gaps, offset); new
    sequences are gaps of class ``capacity``."""
    out = Sweep()
    held = {g: [(g, 0, n)] for g, n in gaps.items() if n}  # gap -> ranges (class before, rank, count)
    order = sorted(held)

    def put(gap: int, span: tuple[int, int, int]) -> None:
        if gap not in held:
            held[gap] = []
            insort(order, gap)
        held[gap].append(span)

    for size in sorted(sizes, reverse=True):
        remain, rank = sizes[size], 0
        at = bisect_left(order, size)
        for gap in order[at:]:
            if not remain:
                break
            each, spans, rest = gap // size, held.pop(gap), []
            for origin, first, count in spans:
                full = min(count, remain // each)
                if full:
                    out.moves[size].append((rank, each, origin, first, capacity - gap))
                    put(gap - each * size, (origin, first, full))
                    remain, rank = remain - full * each, rank + full * each
                if full < count and remain:  # fewer than a gap would hold
                    out.moves[size].append((rank, remain, origin, first + full, capacity - gap))
                    put(gap - remain * size, (origin, first + full, 1))
                    rank, remain, full = rank + remain, 0, full + 1
                if full < count:
                    rest.append((origin, first + full, count - full))
            if rest:
                held[gap] = held.get(gap, []) + rest
            elif gap not in held:
                order.remove(gap)
        if remain:
            each = capacity // size
            full = remain // each
            if full:
                out.moves[size].append((rank, each, capacity, out.opened, 0))
                put(capacity - each * size, (capacity, out.opened, full))
                out.opened, rank, remain = out.opened + full, rank + full * each, remain - full * each
            if remain:
                out.moves[size].append((rank, remain, capacity, out.opened, 0))
                put(capacity - remain * size, (capacity, out.opened, 1))
                out.opened += 1
    out.left = [(origin, first, count, gap) for gap, spans in held.items() for origin, first, count in spans]
    return out


def placed(own: Ranked, plan: Sweep, low: int, high: int) -> DataFrame:
    """Pieces of the band with the class and rank of their gap, and their offset."""
    moves = {size: tuple(np.array(x, np.int64) for x in zip(*rows)) for size, rows in plan.moves.items()}
    before = {k: v for k, v in own.before.items() if low < k[1] <= high}
    band = own.table.filter((F.col("length") > low) & (F.col("length") <= high))
    kept = [f for f in band.schema.fields if f.name not in ("part", "local")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, part, local = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                                 for c in ("length", "part", "local"))
            out = np.zeros((3, len(size)), np.int64)
            for key in set(zip(part.tolist(), size.tolist())):
                rows = np.flatnonzero((part == key[0]) & (size == key[1]))
                first, each, origin, gap_rank, offset = moves[key[1]]
                rank = local[rows] + before[key]
                m = np.searchsorted(first, rank, "right") - 1
                out[0, rows] = origin[m]
                out[1, rows] = gap_rank[m] + (rank - first[m]) // each[m]
                out[2, rows] = offset[m] + (rank - first[m]) % each[m] * key[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(f.name)) for f in kept] + [pa.array(x) for x in out],
                [f.name for f in kept] + ["gap", "gap_rank", "offset"])

    return band.mapInArrow(scan, f"{fields}, gap long, gap_rank long, offset long")


def ranks(batch: pa.RecordBatch, size: str, before: dict[tuple[int, int], int]) -> np.ndarray:
    """Rank of each row among all rows of its size."""
    values, part, local = (batch.column(batch.schema.get_field_index(c)) for c in (size, "part", "local"))
    add = np.fromiter((before[k] for k in zip(part.to_pylist(), values.to_pylist())), np.int64, len(batch))
    return local.to_numpy(zero_copy_only=False) + add


def numbered(gaps: Ranked) -> DataFrame:
    """(sequence_id, gap, gap_rank) of a ranked table of gaps."""
    before = gaps.before

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("sequence_id")), batch.column(batch.schema.get_field_index("gap")),
                pa.array(ranks(batch, "gap", before))], ["sequence_id", "gap", "gap_rank"])

    return gaps.table.mapInArrow(scan, "sequence_id long, gap long, gap_rank long")


def updated(gaps: DataFrame, before: dict[tuple[int, int], int] | None, plan: Sweep, least: int) -> DataFrame:
    """(sequence_id, gap) after a superstep, without gaps below ``least``, of gaps
    ranked by task or, without ``before``, by ``gap_rank``."""
    by: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for origin, first, _, gap in plan.left:
        by[origin].append((first, gap))
    spans = {o: tuple(np.array(x, np.int64) for x in zip(*sorted(rows))) for o, rows in by.items()}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            seq, gap = (batch.column(names.index(c)).to_numpy(zero_copy_only=False) for c in ("sequence_id", "gap"))
            rank = ranks(batch, "gap", before) if before is not None else batch.column(names.index("gap_rank")).to_numpy(zero_copy_only=False)
            new = np.zeros(len(seq), np.int64)
            for g in np.unique(gap).tolist():
                rows = np.flatnonzero(gap == g)
                first, value = spans[g]
                new[rows] = value[np.searchsorted(first, rank[rows], "right") - 1]
            yield pa.RecordBatch.from_arrays([pa.array(seq[new >= least]), pa.array(new[new >= least])], ["sequence_id", "gap"])

    return gaps.mapInArrow(scan, "sequence_id long, gap long")


def pack(own: DataFrame, ties: list[str], capacity: int = CAPACITY, steps: tuple[int, ...] = (1024, 256, 64, 0)) -> DataFrame:
    """``own``, which has a ``length`` from 1 to ``capacity``, with ``sequence_id``
    and ``offset``.  Sequences have no holes; ``ties`` are columns that order
    pieces of equal length.  Repeated rows are packed as often as they occur, an
    empty table stays empty, other columns pass through."""
    spark = own.sparkSession
    rows = ranked(own, "length", ties, "pieces")
    if not rows.counts:
        return own.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    shortest = min(rows.counts)
    gaps: Ranked | None = None
    total, parts, high = 0, [], capacity
    for low in sorted({min(s, capacity) for s in steps} | {0}, reverse=True):
        sizes = {s: n for s, n in rows.counts.items() if low < s <= high}
        if not sizes:
            continue
        plan = sweep(sizes, gaps.counts if gaps else {}, capacity)
        there = placed(rows, plan, low, high)
        fresh = spark.range(plan.opened).select((F.col("id") + total).alias("sequence_id"), F.lit(capacity).cast("long").alias("gap"),
                                                F.col("id").alias("gap_rank"))
        new = there.filter(F.col("gap") == capacity).withColumn("sequence_id", F.col("gap_rank") + total)
        old = there.filter(F.col("gap") < capacity)
        old = old.join(numbered(gaps), ["gap", "gap_rank"]) if gaps else old.withColumn("sequence_id", F.lit(0).cast("long")).limit(0)
        parts.append(materialize(new.unionByName(old).drop("gap", "gap_rank"), "placed"))
        total, high = total + plan.opened, low
        if low:
            after = updated(fresh, None, plan, shortest)
            if gaps:
                after = after.unionByName(updated(gaps.table, gaps.before, plan, shortest))
            gaps = ranked(after, "gap", ["sequence_id"], "gaps")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def packed(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents with their places."""
    return pack(materialize(pieces(df, path, id_col, text_col, capacity), "cut"), [id_col, "piece", "ids_crc32"], capacity)
