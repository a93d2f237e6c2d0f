"""Spelling variants by a dictionary of trie-node pairs.

All words lie in a forward trie (of prefixes) and in a trie of the reversed words
(of suffixes), and every node of either has a number.  A word cut at a position is
a pair of a prefix node and a suffix node; a word with a position skipped is such a
pair, too.  Words that skip the same position into equal pairs differ by one
replaced character, and a word that skips into the pair of another one's cut has one
character more.  Equal pairs of integers are equal strings, so neighbours are exact
without comparing any text.  Skipping any character of a run of equal ones gives
the same word; only the first counts, so that every two words meet once.

A pair of nodes holds at most one word per character of the alphabet, and one that
is cut there, so no group of the join is large, however many words there are.

Nodes are numbered in one pass over range-sorted words: a word shares the nodes of
its common prefix with the word before it and numbers the rest.  What a range shares
with earlier ones is a common prefix of the words at its border, so renaming these
few nodes makes the numbers global.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain
from math import ceil, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.words import Words, chunks, flat, lists, lower
from pulsegrid.session import materialize

LEAST_LENGTH, LEAST_COUNT, TIMES_AS_OFTEN, ONE_IN = 7, 2, 10, 31
#: Node numbers: range in the upper bits, number within the range below.
WITHIN = 40

LETTER = np.zeros(256, bool)
LETTER[ord("a"):ord("z") + 1] = LETTER[ord("A"):ord("Z") + 1] = True
LONG_WORD = 64
LEAD = 0xC3  # first byte in UTF-8 of all characters from U+00C0 to U+00FF
CRC = np.zeros(256, np.uint32)
for _byte in range(256):
    _value = _byte
    for _ in range(8):
        _value = (_value >> 1) ^ (0xEDB88320 if _value & 1 else 0)
    CRC[_byte] = _value


def letter_runs(texts: pa.Array) -> Words:
    """Runs of A-Z, a-z and U+00C0 to U+00FF of every text, in lower-case A-Z."""
    data, off = flat(texts)
    data = lower(data)
    lead = data == LEAD
    mask = LETTER[data] | lead
    mask[1:] |= lead[:-1]
    begins, ends = mask.copy(), mask.copy()
    begins[1:] &= ~mask[:-1]
    ends[:-1] &= ~mask[1:]
    full = np.diff(off) > 0
    begins[off[:-1][full]] = mask[off[:-1][full]]
    ends[off[1:][full] - 1] = mask[off[1:][full] - 1]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, off))


def check_sums(words: Words, seeds: np.ndarray) -> np.ndarray:
    """CRC-32 of every word, continued from its text's ``seeds``."""
    state = seeds[words.row()] ^ np.uint32(0xFFFFFFFF)
    size = words.end - words.start
    order = np.argsort(-size, kind="stable")
    order = order[np.searchsorted(-size[order], -LONG_WORD):]
    start, own, longest = words.start[order], state[order], -size[order]
    for at in range(LONG_WORD):
        n = int(np.searchsorted(longest, -at))  # words longer than this
        own[:n] = CRC[(own[:n] ^ words.data[start[:n] + at]) & 0xFF] ^ (own[:n] >> np.uint32(8))
    state[order] = own
    state ^= np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(size > LONG_WORD):
        state[k] = zlib.crc32(words.data[words.start[k]:words.end[k]].tobytes(), int(state[k]))
    return state


def without(word: bytes, check: int) -> bytes:
    text = word.decode()
    at = check % len(text)
    return (text[:at] + text[at + 1:]).encode()


def variants(ids: list, texts: pa.Array, one_in: int, least: int) -> pa.Array:
    """The words of some texts, a character taken from one in ``one_in``; only
    those of ``least`` characters or more are given."""
    words = letter_runs(texts)
    trail = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum((words.data & 0xC0) == 0x80, out=trail[1:])
    length = words.end - words.start - (trail[words.end] - trail[words.start])
    seeds = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    keep = length >= least
    row = words.row()[keep]
    kept = Words(words.data, words.start[keep], words.end[keep], np.searchsorted(row, np.arange(len(ids) + 1)))
    sums = check_sums(kept, seeds)
    hit = sums % np.uint32(one_in) == 0
    plain = Words(words.data, kept.start[~hit], kept.end[~hit], kept.first).array()
    longer = np.flatnonzero(hit & (length[keep] > least))
    cut = [without(words.data[a:b].tobytes(), int(s)) for a, b, s in zip(kept.start[longer], kept.end[longer], sums[longer])]
    return pa.chunked_array([plain, pa.array(cut, pa.large_binary())])


def vocabulary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, one_in: int = ONE_IN,
               least: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of at least ``least`` characters that occur ``count`` times or more.

    A word is a run of A-Z, a-z and U+00C0 to U+00FF, in lower-case A-Z; one in
    ``one_in`` of the pairs of an id and a word, by check sum, loses a character.  A
    null text has no words, a null id reads as an empty string, repeated rows count
    as often as they occur, other columns are ignored, an empty table gives none."""
    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")).filter("text is not null")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, "text", 1 << 22):
                found = pc.value_counts(variants(part.column(0).to_pylist(), texts, one_in, least).combine_chunks())
                words = found.field(0).cast(pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([words, found.field(1).cast(pa.int64())], ["word", "n"])

    counted = rows.mapInArrow(count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= count)


def shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def numbered(words: DataFrame, name: str) -> DataFrame:
    """``words`` (column ``key``, distinct) with ``name``: numbers of the trie nodes
    of the key's prefixes, from the empty one to the key itself.

    Each range counts its own nodes from 0.  Nodes of its first word's path that
    an earlier range has, too, take their numbers from there."""
    ranged = words.repartitionByRange("key").sortWithinPartitions("key").withColumn("part", F.spark_partition_id())
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranged.schema.fields)

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, path, made = "", [0], 1  # the root of a range is its node 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                sizes, values = [], []
                for word in piece.column("key").to_pylist():
                    depth = shared(before, word)
                    new = len(word) - depth
                    path = path[:depth + 1] + list(range(made, made + new))
                    made += new
                    before = word
                    sizes.append(len(path))
                    values.append(path)
                flat_values = np.fromiter(chain.from_iterable(values), np.int64, sum(sizes))
                yield pa.RecordBatch.from_arrays([*piece.columns, lists(flat_values, np.array(sizes), pa.int64())], [*piece.schema.names, name])

    out = materialize(ranged.mapInArrow(paths, f"{fields}, `{name}` array<long>"), f"trie-{name}")
    # The driver sees the two words at the borders of each range and the last one's path.
    ends = out.groupBy("part").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.max_by(name, "key").alias("path"))
    names, before, numbers = {}, "", [0]
    for r in sorted(ends.collect(), key=lambda r: r["part"]):
        common = numbers[:shared(before, r["first"]) + 1]
        names[r["part"]] = common
        # the first word's path is 0, 1, 2, ..., so these are its first numbers
        numbers = [common[x] if x < len(common) else (r["part"] << WITHIN) + x for x in r["path"]]
        before = r["last"]
    table = out.sparkSession.sparkContext.broadcast({k: np.array(v, np.int64) for k, v in names.items()})

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k = batch.schema.get_field_index(name)
            column = batch.column(k)
            offsets = column.offsets.to_numpy().astype(np.int64)
            x = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
            part = np.repeat(batch.column("part").to_numpy().astype(np.int64), np.diff(offsets))
            full = (part << WITHIN) + x
            for p in np.unique(part):
                own = table.value[int(p)]
                inside = (part == p) & (x < len(own))
                full[inside] = own[x[inside]]
            columns = list(batch.columns)
            columns[k] = lists(full, np.diff(offsets), pa.int64())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return out.mapInArrow(renamed, out.schema).drop("part")


def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of nodes of every word: cut at each position, and with each skipped.
    ``kind`` is 0 for a cut, 1 for a skip, 2 for a skip that starts a run."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            piece = batch.slice(at, 4096)
            path, back = piece.column("path"), piece.column("back")
            off = path.offsets.to_numpy().astype(np.int64)
            p = path.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]]
            s = back.values.to_numpy(zero_copy_only=False)[back.offsets.to_numpy()[0]:back.offsets.to_numpy()[-1]]
            size = np.diff(off)
            row = np.repeat(np.arange(len(size)), size)
            depth = np.arange(len(p)) - np.repeat(off[:-1] - off[0], size)
            # suffix after position i has the other tries' node of depth size - 1 - i
            rest = np.repeat(off[:-1] - off[0] + size - 1, size) - depth
            letters = np.frombuffer("".join(piece.column("key").to_pylist()).encode("utf-32-le"), np.uint32)
            skip = depth < size[row] - 1
            letter = np.zeros(len(p), np.uint32)
            letter[skip] = letters
            starts = np.ones(len(p), bool)
            starts[1:] = (letter[1:] != letter[:-1]) | (depth[1:] == 0)
            word = np.repeat(p[np.cumsum(size) - 1], size)
            n = np.repeat(piece.column("n").to_numpy(), size)
            left = np.concatenate((p, p[skip]))
            right = np.concatenate((s[rest], s[rest[skip] - 1]))
            kind = np.concatenate((np.zeros(len(p), np.int8), 1 + starts[skip].astype(np.int8)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(left), pa.array(right), pa.array(kind), pa.array(np.concatenate((word, word[skip]))), pa.array(np.concatenate((n, n[skip])))],
                ["p", "s", "kind", "id", "n"])


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n_near, best): for every word that has neighbours their number and the
    (n, -id) of the greatest that is above the word itself, or not."""
    member = words.select("key", "n", "path", "back").mapInArrow(pairs, "p long, s long, kind byte, id long, n long")
    group = Window.partitionBy("p", "s")
    top = F.struct("n", (-F.col("id")).alias("m"))
    skips, inserts = F.col("kind") > 0, F.col("kind") == 2

    def over(value: Column) -> Column:
        return value.over(group)

    met = member.withColumns({
        "skips": over(F.count_if(skips)), "inserts": over(F.count_if(inserts)), "cuts": over(F.count_if(~skips)),
        "best_skip": over(F.max(F.when(skips, top))), "best_insert": over(F.max(F.when(inserts, top))), "cut": over(F.max(F.when(~skips, top))),
    })
    # A word that is itself the greatest of its group has only lesser ones there,
    # which can't be its form, so that itself may stand for them.
    near = F.when(skips, F.col("skips") - 1 + F.when(inserts, F.col("cuts")).otherwise(0)).otherwise(F.col("inserts"))
    best = F.when(skips, F.greatest("best_skip", F.when(inserts, F.col("cut")))).otherwise(F.col("best_insert"))
    found = met.select("id", near.alias("near"), best.alias("best")).filter("near > 0")
    return found.groupBy("id").agg(F.sum("near").alias("n_near"), F.max("best").alias("best"))


def grouped(vocabulary: DataFrame, *, times: int = TIMES_AS_OFTEN) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct words with their counts.

    A word's form is its nearest more common spelling: of the words that differ by
    one inserted, deleted or replaced character the one of largest n, ties to the
    least, if it is ``times`` as frequent; ``root`` follows forms to the last.
    ``times`` is above 1.  Empty words and words of any length are allowed; an empty
    table stays empty; columns other than ``word`` and ``n`` are ignored."""
    if times <= 1:
        raise ValueError("a form must be more frequent than its variants")
    words = materialize(vocabulary.select("word", "n").filter("word is not null"), "vocabulary")
    forward = numbered(words.select(F.col("word").alias("key"), "n"), "path")
    backward = numbered(words.select(F.reverse("word").alias("key")), "back").select(F.reverse("key").alias("word"), "back")
    both = materialize(forward.join(backward, F.col("key") == F.col("word")).select("key", "n", "path", "back"), "paths")
    own = both.select(F.element_at("path", -1).alias("id"), F.col("key").alias("word"), "n")
    near = materialize(neighbours(both), "near")
    near = near.withColumnsRenamed({"id": "near_id"})
    whole = materialize(own.join(near, F.col("id") == F.col("near_id"), "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(F.col("best.n") >= F.lit(times) * F.col("n"), -F.col("best.m")).alias("form_id")), "forms")
    step = whole.filter("form_id is not null").select(F.col("id").alias("from"), F.col("form_id").alias("to"))
    # Counts grow at least this many fold at every step of a chain and are below
    # 2 ** 63; each jump covers twice as many steps as the one before it.
    for k in range(ceil(log2(63 / log2(times) + 1))):
        ahead = step.select(F.col("from").alias("mid"), F.col("to").alias("far"))
        step = materialize(step.join(ahead, F.col("to") == F.col("mid"), "left").select("from", F.coalesce("far", "to").alias("to")), f"jump-{k}")
    form = whole.select(F.col("id").alias("form_key"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    root = whole.select(F.col("id").alias("root_key"), F.col("word").alias("root_word"))
    ends = whole.join(step, F.col("id") == F.col("from"), "left")
    named = ends.join(form, F.col("form_id") == F.col("form_key"), "left").join(root, F.col("to") == F.col("root_key"), "left")
    return named.select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
