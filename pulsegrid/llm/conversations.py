"""Repair of the turn structure of conversations by the cheapest edits.

A well-formed conversation is empty or has an optional system row and then user
and assistant rows in turn.  Rows are kept, given another role, deleted, or
inserted; a small automaton over the last role and one cost per edit make the
cheapest repair a shortest path.  Backward vectors say what the rest costs from
every state.  Only those at checkpoints, every square root of the number of rows,
are stored; walking forward, the vectors of one block at a time are computed again,
and at every step the first letter in ASCII order whose edit is tight is emitted.

A conversation of ordinary size is one such walk.  A larger one is cut into
segments by a range sort.  A segment's effect on cost vectors is a small matrix,
and with the vector at its end it maps entry states to exit states; chaining these
few numbers gives every segment what it needs to be walked alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.session import materialize, settle

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: State after a row that is inserted or given another role.
FOLLOWING = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: State after a kept row, by the initial of its role.
KEPT = {"s": {NOTHING: SYSTEM}, "u": {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
#: What must still be inserted when the rows end in each state.
END = (0, 2 * INSERT, INSERT, 0)
WHITE = " \t\n\x0b\x0c\r"
FAULTS = ("blank", "duplicate", "truncated")
#: Conversations above either size are cut into segments.
SEGMENT_ROWS, SEGMENT_BYTES = 20_000, 16 << 20
NEVER = 1 << 40

Vector = tuple[int, ...]
#: What a row allows: initial of its role, and what leaving it in costs; None if it must go.
Row = tuple[str, int] | None


def before(row: Row, after: Vector) -> Vector:
    """Costs from every state before a row, given those after it."""
    best = [DELETE + a for a in after]
    if row is not None:
        initial, extra = row
        for state in range(4):
            best[state] = min(best[state], REROLE + extra + after[FOLLOWING[state]])
        for state, then in KEPT.get(initial, {}).items():
            best[state] = min(best[state], extra + after[then])
    user = min(best[USER], INSERT + best[ASSISTANT])
    assistant = min(best[ASSISTANT], INSERT + best[USER])
    return min(best[NOTHING], INSERT + user), min(best[SYSTEM], INSERT + user), user, assistant


def walk(rows: list[Row], state: int, end: Vector) -> Iterator[tuple[str, int, int]]:
    """(letter, index of the row that follows or is edited, state after it) of the
    ASCII-least cheapest edits, with cost vectors stored at checkpoints only."""
    n = len(rows)
    step = max(1, isqrt(n))
    stored, vector = {n: end}, end
    for i in range(n - 1, -1, -1):
        vector = before(rows[i], vector)
        if i % step == 0:
            stored[i] = vector
    for at in range(0, n, step):
        to = min(at + step, n)
        block = [stored[to]]
        for i in range(to - 1, at - 1, -1):
            block.append(before(rows[i], block[-1]))
        for i in range(at, to):
            here, after = block[to - i], block[to - i - 1]
            while True:
                if DELETE + after[state] == here[state]:
                    yield "D", i, state
                    break
                if INSERT + here[FOLLOWING[state]] == here[state]:
                    state = FOLLOWING[state]
                    yield "I", i, state
                    continue
                initial, extra = rows[i]
                then = KEPT.get(initial, {}).get(state)
                if then is not None and extra + after[then] == here[state]:
                    state = then
                    yield "K", i, state
                else:
                    state = FOLLOWING[state]
                    yield "R", i, state
                break


def closing(state: int) -> Iterator[int]:
    """States of the rows that must be inserted at the end."""
    while END[state]:
        state = FOLLOWING[state]
        yield state


def fault(text: str, seen: bool) -> str | None:
    body = text.strip(WHITE)
    if not body:
        return "blank"
    if seen:
        return "duplicate"
    return "truncated" if body[-1] not in ".!?" else None


def allowed(role: str, wrong: str | None) -> Row:
    return None if wrong in ("blank", "duplicate") else (role[:1], CUT_OFF if wrong else 0)


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of sorted batches as tuples, grouped by their first ``keys`` columns."""
    rows = (row for batch in batches for part in _slices(batch) for row in zip(*[c.to_pylist() for c in part.columns]))
    return groupby(rows, lambda row: row[:keys])


def _slices(batch: pa.RecordBatch, size: int = 1000) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, size) for at in range(0, batch.num_rows, size))


def flagged(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(turn, role, text, fault) of one segment's rows in order."""
    known = set()
    for _, _, turn, role, text, seen in rows:
        key = (role, text)
        yield turn, role, text, fault(text, seen or key in known)
        known.add(key)


def _segments(rows: DataFrame, schema: str, work: Callable, *more: str) -> DataFrame:
    """``work`` over the segments of rows with conv, part, turn, role, text, seen."""
    columns = ["_conv", "_part", "_turn", "_role", "_text", "_seen", *more]
    order = ["_conv", "_part", F.asc_nulls_first("_turn"), "_role", "_text"]
    return rows.select(*columns).repartition("_conv", "_part").sortWithinPartitions(*order).mapInArrow(work, schema)


def _kind(rows: DataFrame, column: str) -> str:
    return rows.schema[column].dataType.simpleString()


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    """Rows as batches of some size, so that no segment's output is held whole."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _arrow(schema: str, spark) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def segmented(rows: DataFrame) -> DataFrame:
    """``rows`` (conv, turn, role, text) with the segment of each row, whether an
    earlier segment has its role and text, and the segment's entry state and the
    cost vector at its end."""
    plain = {"_part": F.lit(0), "_seen": F.lit(False), "_entry": F.lit(NOTHING), "_end": F.array(*map(F.lit, END)),
             "_last": F.lit(True)}
    plain = {k: v.cast("array<long>") if k == "_end" else v for k, v in plain.items()}
    sizes = rows.groupBy("_conv").agg(F.count(F.lit(1)).alias("_rows"), F.sum(F.octet_length("_text")).alias("_bytes"))
    big = settle(sizes.filter((F.col("_rows") > SEGMENT_ROWS) | (F.col("_bytes") > SEGMENT_BYTES)), "large")
    total = big.agg(F.sum("_rows").alias("n"), F.sum("_bytes").alias("b")).first()
    if total["n"] is None:
        return rows.withColumns(plain)

    same = rows["_conv"].eqNullSafe(big["_conv"])
    parts = total["n"] // SEGMENT_ROWS + total["b"] // SEGMENT_BYTES + 1
    large = materialize(rows.join(big, same, "left_semi"), "large-rows")
    # the number breaks ties, so that even equal rows are spread over segments
    numbered = large.withColumn("_no", F.monotonically_increasing_id())
    ranged = numbered.repartitionByRange(int(parts), "_conv", F.asc_nulls_first("_turn"), "_role", "_text", "_no")
    ranged = materialize(ranged.withColumns({"_part": F.spark_partition_id(), "_digest": F.sha2("_text", 256)}), "segments")
    first = ranged.groupBy(F.col("_conv").alias("_c"), F.col("_role").alias("_r"), F.col("_digest").alias("_d")).agg(
        F.min("_part").alias("_first"))
    again = F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_role") == F.col("_r")) & (F.col("_digest") == F.col("_d"))
    marked = ranged.join(first, again).withColumn("_seen", F.col("_part") > F.col("_first"))
    marked = materialize(marked.select("_conv", "_part", "_turn", "_role", "_text", "_seen"), "marked")
    borders = _borders(marked)
    mine = marked["_conv"].eqNullSafe(borders["_bc"]) & (marked["_part"] == borders["_bp"])
    cut = marked.join(borders, mine).drop("_bc", "_bp")
    return rows.join(big, same, "left_anti").withColumns(plain).unionByName(cut)


def _borders(marked: DataFrame) -> DataFrame:
    """Entry state and end vector of every segment.  The driver chains 16 costs and
    then four exit states per segment; there are as many as range partitions, and
    one more for each conversation."""
    spark, conv = marked.sparkSession, _kind(marked, "_conv")
    schema = f"_conv {conv}, _part int, m array<long>"
    arrow = _arrow(schema, spark)

    def matrices(batches):
        def rows():
            for key, group in runs(batches, 2):
                units = [tuple(0 if t == k else NEVER for t in range(4)) for k in range(4)]
                own = [allowed(role, wrong) for _, role, _, wrong in flagged(group)]
                for row in reversed(own):
                    units = [before(row, u) for u in units]
                yield *key, [c for u in units for c in u]
        yield from _batches(rows(), arrow)

    chains: dict = {}
    for r in _segments(marked, schema, matrices).collect():
        chains.setdefault(r["_conv"], []).append((r["_part"], r["m"]))
    ends = []
    for c, own in chains.items():
        vector = list(END)
        for k, (part, m) in enumerate(sorted(own, key=lambda x: x[0], reverse=True)):
            ends.append((c, part, vector, k == 0))
            vector = [min(m[4 * t + s] + vector[t] for t in range(4)) for s in range(4)]
    ends_df = settle(spark.createDataFrame(ends, f"_bc {conv}, _bp int, _end array<long>, _last boolean"), "ends")

    def exits(batches):
        def rows():
            for key, group in runs(batches, 2):
                held = list(group)
                own = [allowed(role, wrong) for _, role, _, wrong in flagged(r[:6] for r in held)]
                yield *key, [_leaves(own, s, tuple(held[0][6])) for s in range(4)]
        yield from _batches(rows(), arrow)

    mine = marked["_conv"].eqNullSafe(ends_df["_bc"]) & (marked["_part"] == ends_df["_bp"])
    found = {(r["_conv"], r["_part"]): r["m"] for r in _segments(marked.join(ends_df, mine), schema, exits, "_end").collect()}
    out, states = [], {}
    for c, part, vector, last in sorted(ends, key=lambda x: x[1]):
        state = states.get(c, NOTHING)
        out.append((c, part, state, vector, last))
        states[c] = found[c, part][state]
    return settle(spark.createDataFrame(out, f"_bc {conv}, _bp int, _entry int, _end array<long>, _last boolean"), "borders")


def _leaves(rows: list[Row], state: int, end: Vector) -> int:
    for _, _, state in walk(rows, state, end):
        pass
    return state


def repaired(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per edit: ``conv``, segment, position in it, ``turn``, the row's own
    ``initial``, its ``fault``, ``edit`` (K, R, D, I), ``cost``, and the repaired
    ``role`` and ``text`` (null where the row is deleted).

    Rows are ordered by turn, nulls first, then by role and text.  A null role or
    text is one space, a null conversation id is one conversation; repeated rows
    are duplicates; other columns are ignored, whatever their names; an empty table
    gives none.  Any role that begins with s, u or a counts by that letter."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = segmented(df.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), blank(role).alias("_role"), blank(text).alias("_text")))
    schema = (f"`{conv}` {_kind(rows, '_conv')}, segment int, position int, `{turn}` {_kind(rows, '_turn')}, initial string, "
              f"fault string, edit string, cost long, `{role}` string, `{text}` string")
    arrow = _arrow(schema, df.sparkSession)

    def emit(batches):
        yield from _batches((row for key, group in runs(batches, 2) for row in _edited(key, list(group))), arrow)

    return _segments(rows, schema, emit, "_entry", "_end", "_last")


def _edited(key: tuple, held: list[tuple]) -> Iterator[tuple]:
    entry, end, last = held[0][6:]
    rows = list(flagged(r[:6] for r in held))
    position, state = -1, entry
    for letter, i, state in walk([allowed(r[1], r[3]) for r in rows], entry, tuple(end)):
        position += 1
        turn, role, text, wrong = rows[i]
        if letter == "I":
            yield *key, position, None, None, None, "I", INSERT, ROLES[state], ""
        elif letter == "D":
            yield *key, position, turn, role[:1], wrong, "D", DELETE, None, None
        else:
            cost = (CUT_OFF if wrong else 0) + (REROLE if letter == "R" else 0)
            yield *key, position, turn, role[:1], wrong, letter, cost, ROLES[state] if letter == "R" else role, text
    for state in closing(state) if last else ():
        position += 1
        yield *key, position, None, None, None, "I", INSERT, ROLES[state], ""


LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


def summaries(edits: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Counts, letters and a digest per conversation of :func:`repaired`.

    A digest of a whole conversation needs its rows in order, so one task reads
    them; it holds one row and the letters at a time."""
    rows = edits.select(F.col(conv), "segment", "position", F.col(turn).try_cast("long"), "initial", "fault", "edit", "cost", role, text)
    schema = (f"`{conv}` {_kind(rows, conv)}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
              "audit string, repaired_sha256 string")
    arrow = _arrow(schema, edits.sparkSession)

    def digest(batches):
        yield from _batches((_summary(key[0], group) for key, group in runs(batches, 1)), arrow)

    return rows.repartition(conv).sortWithinPartitions(conv, "segment", "position").mapInArrow(digest, schema)


def _summary(key, group: Iterator[tuple]) -> tuple:
    counts = dict.fromkeys(FAULTS, 0)
    letters, sha, first = bytearray(), hashlib.sha256(), True
    low = high = previous = None
    distinct = illegal = total = 0
    for _, _, _, turn, initial, wrong, edit, cost, role, text in group:
        letters += edit.encode()
        total += cost
        if edit != "I":
            if wrong is not None:
                counts[wrong] += 1
            if previous is not None and (previous, initial) not in LEGAL:
                illegal += 1
            previous = initial
            if turn is not None and (high is None or turn != high):
                low, high, distinct = turn if low is None else low, turn, distinct + 1
        if edit != "D":
            sha.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
            first = False
    gaps = 0 if low is None else high - low + 1 - distinct
    return key, gaps, *counts.values(), illegal, total, letters.decode(), sha.hexdigest()


def damaged(df: DataFrame, key: Column) -> DataFrame:
    """Conversations with planted faults, by a check sum of ``key`` modulo 20: 0
    drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats it,
    4 makes its role user.  A null role or text is one space."""
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    copies = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    return df.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(1), copies)).alias("copy"),
    ).drop("copy")
