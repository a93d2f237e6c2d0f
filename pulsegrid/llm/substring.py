"""Substring dedup over a compacted De Bruijn graph of words.

Nodes are runs of k - 1 words and edges the windows of k words between them.  A
node is a junction when different words precede or follow it somewhere, or when
a run of repeated windows ends at it.  Between junctions the graph is one
nonbranching path, so each text is cut at its junctions into whole paths; a path
is then one row, whatever its length, and its source coordinates together with a
digest of its very words tell which texts have it and which has it first.

Most windows are unique and never become edges: every window contains the least
hashed of its short word runs, its anchor, and equal windows have equal anchors.
Only windows whose anchor occurs in two texts enter the graph.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.words import chunks, lists, signed, split, windows
from pulsegrid.session import materialize

LATE = 1 << 62


def anchors(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of every window of ``k`` words and the hash of its anchor."""
    short = max(1, k // 3)
    reach = k - short + 1
    grams = np.full(len(hashes), np.iinfo(np.uint64).max, np.uint64)
    h, at = windows(hashes, first, short)
    grams[at] = h
    _, starts = windows(hashes, first, k)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    least = grams
    done = 1
    while done < reach:  # least of `done` neighbours, doubled
        step = min(done, reach - done)
        least = np.minimum(least[:-step], least[step:])
        done += step
    return starts, least[starts]


def digest(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def surveyed(docs: DataFrame, k: int) -> DataFrame:
    """Per row of (id, text): words, digests of the sequence, distinct anchors."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, "text"):
                w = split(texts)
                starts, found = anchors(w.hashes(), w.first, k)
                row = np.searchsorted(w.first, starts, "right") - 1
                order = np.lexsort((found, row))
                row, found = row[order], found[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
                joined = [b" ".join(t.encode().split()) for t in texts.to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.diff(w.first), pa.int64()),
                    pa.array([hashlib.blake2b(j, digest_size=16).digest() for j in joined], pa.binary()),
                    pa.array([hashlib.sha256(j).hexdigest() for j in joined]),
                    lists(signed(found[new]), np.bincount(row[new], minlength=len(texts)), pa.int64()),
                ], ["id", "n_words", "seq", "sha", "anchors"])

    return docs.mapInArrow(scan, "id long, n_words long, seq binary, sha string, anchors array<long>")


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of set flags."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def repeated(docs: DataFrame, known: DataFrame, k: int) -> DataFrame:
    """(id, seq, text, begins, ends) of texts with runs of windows [begin, end) whose
    anchors occur elsewhere; ``known`` has (id, seq, shared anchors)."""
    both = docs.join(known, "id").select("id", "text", "seq", "shared")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, seqs, shared = (batch.column(i) for i in range(4))
            rows = []
            for i in range(len(texts)):
                one = texts.slice(i, 1)
                if texts[i].as_py() is None or digest(texts[i].as_py().encode().split()) != seqs[i].as_py():
                    continue  # another text under the same id
                w = split(one)
                _, found = anchors(w.hashes(), w.first, k)
                a, b = runs(np.isin(signed(found), shared[i].values.to_numpy()))
                rows.append((ids[i].as_py(), seqs[i].as_py(), texts[i].as_py(), a.tolist(), b.tolist()))
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int64(), pa.binary(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(columns, kinds)], ["id", "seq", "text", "begins", "ends"])

    return both.mapInArrow(scan, "id long, seq binary, text string, begins array<long>, ends array<long>")


def nodes(texts: DataFrame, k: int, sides: bool) -> DataFrame:
    """(node, id, at) of every node on a repeated run, or with ``sides`` (node,
    before, after), the hashes of the words on both sides; 0 where a run ends."""
    texts = texts.select("id", "text", "begins", "ends")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, begins, ends = (batch.column(i) for i in range(4))
            for i in range(len(texts)):
                w = split(texts.slice(i, 1))
                h = w.hashes()
                grams, _ = windows(h, w.first, k - 1)
                at, before, after = [], [], []
                for a, b in zip(begins[i].values.to_numpy(), ends[i].values.to_numpy()):
                    at.append(np.arange(a, b + 1))  # b windows have b + 1 nodes
                    x, y = np.zeros(b - a + 1, np.uint64), np.zeros(b - a + 1, np.uint64)
                    x[1:], y[:-1] = h[a:b], h[a + k - 1:b + k - 1]
                    before.append(x)
                    after.append(y)
                if not at:
                    continue
                pos = np.concatenate(at)
                own = pa.array(signed(grams[pos]))
                if sides:
                    yield pa.RecordBatch.from_arrays(
                        [own, pa.array(signed(np.concatenate(before))), pa.array(signed(np.concatenate(after)))],
                        ["node", "before", "after"])
                else:
                    yield pa.RecordBatch.from_arrays(
                        [own, pa.array(np.full(len(pos), ids[i].as_py(), np.int64)), pa.array(pos.astype(np.int64))],
                        ["node", "id", "at"])

    return texts.mapInArrow(scan, "node long, before long, after long" if sides else "node long, id long, at long")


def paths(texts: DataFrame, cuts: DataFrame, k: int) -> DataFrame:
    """(path, id, begin, end): whole nonbranching paths, as windows [begin, end)
    of a text; ``path`` is the digest of their words."""
    both = texts.join(cuts, "id").select("id", "text", "begins", "ends", "cuts")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, begins, ends, cuts = (batch.column(i) for i in range(5))
            out: list[tuple[bytes, int, int, int]] = []
            for i in range(len(texts)):
                words = texts[i].as_py().encode().split()
                cut = np.sort(cuts[i].values.to_numpy())
                for a, b in zip(begins[i].values.to_numpy(), ends[i].values.to_numpy()):
                    own = cut[np.searchsorted(cut, a):np.searchsorted(cut, b, "right")].tolist()
                    out += [(digest(words[x:y + k - 1]), ids[i].as_py(), x, y) for x, y in zip(own, own[1:])]
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.int64()))],
                ["path", "id", "begin", "end"])

    return both.mapInArrow(scan, "path binary, id long, begin long, end long")


SPANS = "array<struct<begin: long, end: long>>"


def trimmed(texts: DataFrame, gone: DataFrame, k: int) -> DataFrame:
    """(seq, spans, n_removed, digest of the kept words) of texts that lose words."""
    both = texts.join(gone, "id").select("seq", "text", "gone")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, texts, gone = (batch.column(i) for i in range(3))
            rows = []
            for i in range(len(texts)):
                words = texts[i].as_py().encode().split()
                away = np.zeros(len(words) + 1, np.int64)
                for span in gone[i].as_py():
                    away[span["begin"]] += 1
                    away[span["end"] + k - 1] -= 1
                off = np.cumsum(away[:-1]) > 0
                a, b = runs(off)
                kept = b" ".join(w for w, x in zip(words, off) if not x)
                spans = [{"begin": x, "end": y} for x, y in zip(a.tolist(), b.tolist())]
                rows.append((seqs[i].as_py(), spans, int(off.sum()), hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows)) or [()] * 4
            span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(columns, (pa.binary(), span, pa.int64(), pa.string()))],
                ["seq", "spans", "n_removed", "kept_sha"])

    return both.mapInArrow(scan, f"seq binary, spans {SPANS}, n_removed long, kept_sha string")


def repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 50) -> DataFrame:
    """Per row: ``id_col``, ``n_words``, ``n_removed``, ``spans`` of the words
    to remove and ``kept_sha256``, the digest of the others joined by a space.

    A word goes when a window of ``k`` words that covers it also starts in a row
    with a smaller id.  Null text has no words; texts shorter than ``k`` words
    lose nothing.  Rows with a null id come after all others, in the order of a
    hash of their text.  Rows with the same id do not precede each other, so
    exact repeats of a row keep their words; of different texts under one id the
    one with the least digest enters the graph, the others lose their words only
    to whole earlier copies.  Ids must be below 2 ** 62.  Other columns are not
    read; an empty table gives no rows."""
    late = F.xxhash64(text_col).bitwiseAND(F.lit(LATE - 1)).bitwiseOR(F.lit(LATE))
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), late).alias("id"), F.col(text_col).alias("text"))
    all_rows = materialize(surveyed(docs, k), "surveyed")

    # Copies of a whole text meet as one row, and only the first has edges.
    copies = materialize(
        all_rows.filter(F.col("n_words") >= k).groupBy("seq")
        .agg(F.min("id").alias("id"), F.first("anchors").alias("anchors")), "copies")
    lone = copies.groupBy("id").agg(F.min(F.struct("seq", "anchors")).alias("x"))
    own = lone.select("id", "x.seq", F.explode("x.anchors").alias("anchor"))
    shared = materialize(own.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
                         .filter("lo < hi").select("anchor"), "shared")
    known = own.join(shared, "anchor").groupBy("id", "seq").agg(F.collect_list("anchor").alias("shared"))
    texts = materialize(repeated(docs, known, k).dropDuplicates(["id"]), "repeated")

    # Junctions, and every text cut at them.
    sides = nodes(texts, k, True).groupBy("node").agg(
        F.min("before").alias("b0"), F.max("before").alias("b1"), F.min("after").alias("a0"), F.max("after").alias("a1"))
    ends = (F.col("b0") == 0) & (F.col("b1") == 0) | (F.col("a0") == 0) & (F.col("a1") == 0)
    junctions = materialize(sides.filter((F.col("b0") != F.col("b1")) | (F.col("a0") != F.col("a1")) | ends).select("node"), "junctions")
    cuts = nodes(texts, k, False).join(junctions, "node").groupBy("id").agg(F.collect_list("at").alias("cuts"))
    pieces = materialize(paths(texts, cuts, k), "paths")

    # The first text of each path keeps it.
    firsts = materialize(pieces.groupBy("path").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi")
                         .select("path", "lo"), "firsts")
    gone = (pieces.join(firsts, "path").filter(F.col("id") > F.col("lo"))
            .groupBy("id").agg(F.collect_list(F.struct("begin", "end")).alias("gone")))
    fate = materialize(copies.select("seq", F.col("id").alias("first")).join(trimmed(texts, gone, k), "seq", "left"), "fate")

    out = all_rows.drop("anchors").join(fate, "seq", "left")
    copy = F.col("id") > F.col("first")
    lost = (F.col("id") == F.col("first")) & F.col("kept_sha").isNotNull()
    whole = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_words").alias("end")))
    return out.select(
        F.when(F.col("id") < LATE, F.col("id")).alias(id_col), "n_words",
        F.when(copy, F.col("n_words")).when(lost, F.col("n_removed")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.when(copy, whole).when(lost, F.col("spans")).otherwise(F.array().cast(SPANS)).alias("spans"),
        F.when(copy, F.sha2(F.lit("").cast("binary"), 256)).when(lost, F.col("kept_sha")).otherwise(F.col("sha")).alias("kept_sha256"))
