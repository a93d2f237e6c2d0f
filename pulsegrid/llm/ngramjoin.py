"""Jaccard join on word n-grams with rare-first prefix filtering.

Each document is the set of its shingles.  The shingles are put in one order for
all, rare ones first, and two sets that are alike enough share a shingle in
their prefixes, which are short.  Sets meet on prefix shingles, pass length and
positional filters there and a suffix filter before the exact count, and each
pair is verified once.

A list of sets that share a prefix shingle is not expanded into all pairs: the
first set of the list meets the others, whoever is linked counts as one
component, and only lists that still hold several components go on, first with
their next set, at last with every pair of different components.  So no link
between components is lost and copies cost one row each.

How often a shingle occurs is counted over all documents in a table of fixed size
by hash; it only decides the order, so a shared counter costs time, not results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.llm import sums
from pulsegrid.llm.components import components
from pulsegrid.llm.words import WORD_POWERS, chunks, mix, rolled, signed, split, windows
from pulsegrid.session import materialize

LATE = 1 << 62
COUNTER_BITS, PARTS = 20, 256


def shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of lower-cased texts, and the row of each, in
    order of row and hash.  A text of fewer words is one shingle."""
    w = split(texts, lowered=True)
    hashes = w.hashes()
    found, starts = windows(hashes, w.first, k)
    row = np.searchsorted(w.first, starts, "right") - 1
    sizes = np.diff(w.first)
    few = np.flatnonzero((sizes > 0) & (sizes < k))
    whole = mix(rolled(hashes, w.first[few], w.first[few + 1], WORD_POWERS) + sizes[few].astype(np.uint64))
    found, row = np.concatenate((found, whole)), np.concatenate((row, few))
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    return found[new], row[new]


def counter(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def occurrences(docs: DataFrame, k: int) -> np.ndarray:
    """Documents per counter, over all documents.  Tasks add up in tables of
    fixed size and these are added by parts, so only one table comes back."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNTER_BITS, np.int64)
        for batch in batches:
            for _, texts in chunks(batch, "text"):
                total += np.bincount(counter(shingles(texts, k)[0]), minlength=len(total))
        if total.any():
            yield sums.rows({0: total}, PARTS)

    total = sums.add_up(docs.select("text").mapInArrow(count, sums.KIND), PARTS)
    return total.get(0, np.zeros(1 << COUNTER_BITS))


def surveyed(docs: DataFrame, k: int) -> DataFrame:
    """(id, n_shingles, digest of the set) per row; no digest for an empty set."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, "text"):
                found, row = shingles(texts, k)
                counts = np.bincount(row, minlength=len(texts))
                ends = np.cumsum(counts)
                raw = found.tobytes()
                digests = [hashlib.blake2b(raw[8 * (e - n):8 * e], digest_size=16).digest() if n else None
                           for e, n in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary())],
                                                 ["id", "n_shingles", "own"])

    return docs.mapInArrow(scan, "id long, n_shingles long, own binary")


def prefix(size: np.ndarray, percent: int) -> np.ndarray:
    """Shingles of a set among which one of any alike set must be."""
    return size - (percent * size + 99) // 100 + 1


def prefixes(docs: DataFrame, counts, k: int, percent: int) -> DataFrame:
    """(shingle, id, size, at, tag): the rarest shingles of each set and their
    places; equal sets have equal tags."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity = counts.value
        for batch in batches:
            for part, texts in chunks(batch, "text"):
                found, row = shingles(texts, k)
                order = np.lexsort((found, rarity[counter(found)], row))
                found, row = found[order], row[order]
                size = np.bincount(row, minlength=len(texts))
                at = np.arange(len(row)) - (np.cumsum(size) - size)[row]
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(found))))
                ends = np.cumsum(size)
                tag = mix(sums[ends] - sums[ends - size] + size.astype(np.uint64))
                kept = at < prefix(size, percent)[row]
                found, row, at = found[kept], row[kept], at[kept]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(found)), part.column(0).take(pa.array(row)), pa.array(size[row], pa.int32()), pa.array(at, pa.int32()),
                     pa.array(signed(tag[row]))], ["shingle", "id", "size", "at", "tag"])

    return docs.mapInArrow(scan, "shingle long, id long, size int, at int, tag long")


def met(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """Rows of prefix shingles that two different sets have, one row per set, with
    ``ahead``, how many such shingles the prefix has from this one on.  A shingle
    that one set has alone is not in common with any other, so two sets whose
    first common shingle this is have at most ``ahead`` in common in the prefix."""
    several = rows.groupBy("shingle").agg(F.min("tag").alias("lo"), F.max("tag").alias("hi")).filter("lo < hi").select("shingle")
    both = rows.drop("tag").join(materialize(several, "several"), "shingle").join(firsts, "id")
    order = Window.partitionBy("id").orderBy("at", "size", "shingle")
    return both.select("shingle", "id", "size", "at", F.count("*").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)).cast("int").alias("ahead"))


def possible(one: str, two: str, percent: int) -> Column:
    """Length and positional filters, as they hold where a shingle is the first
    that two sets have in common; every pair of alike sets has such a row.
    ``one`` and ``two`` are the name patterns of their columns."""
    size, at, ahead = (F.col(one.format(c)) for c in ("size", "at", "ahead"))
    other, there, further = (F.col(two.format(c)) for c in ("size", "at", "ahead"))
    after = lambda n: F.floor((percent * n + 99) / 100).cast("int") - 1  # noqa: E731  shingles behind the prefix
    most = F.least(1 + F.least(size - at - 1, other - there - 1),
                   F.least(ahead, further) + F.greatest(after(size), after(other)))
    return ((100 * F.least(size, other) >= percent * F.greatest(size, other))
            & ((100 + percent) * most >= percent * (size + other)))


def suffix_bound(a: np.ndarray, b: np.ndarray, depth: int = 3) -> int:
    """At least so many elements of two sorted arrays are in one of them only."""
    if not depth or not len(a) or not len(b):
        return abs(len(a) - len(b))
    mid = len(b) // 2
    at = int(np.searchsorted(a, b[mid]))
    same = at < len(a) and a[at] == b[mid]
    return (suffix_bound(a[:at], b[:mid], depth - 1) + (not same)
            + suffix_bound(a[at + same:], b[mid + 1:], depth - 1))


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity."""
    total = len(a) + len(b)
    need = -(-percent * total // (100 + percent))  # of the intersection
    if total - suffix_bound(a, b) < 2 * need:
        return False
    return len(np.intersect1d(a, b, assume_unique=True)) >= need


def verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that are links, each counted exactly once."""
    ends = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    own = materialize(texts.join(ends, "id"), "ends")
    left = own.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    right = own.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, one = None, np.zeros(0, np.uint64)  # rows of one set a tend to follow each other
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for i in range(len(batch)):
                if batch.column(2)[i].as_py() != text:
                    text = batch.column(2)[i].as_py()
                    one = shingles(batch.column(2).slice(i, 1), k)[0]
                two = shingles(batch.column(3).slice(i, 1), k)[0]
                keep[i] = len(one) > 0 and alike(one, two, percent)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.filter("text_a is not null and text_b is not null").mapInArrow(scan, "a long, b long")


def with_hub(rows: DataFrame) -> DataFrame:
    """Rows of lists with at least two sets, each with the first of its list."""
    columns = [c for c in rows.columns if c != "shingle"]  # id comes first
    heads = rows.groupBy("shingle").agg(F.min(F.struct(*columns)).alias("h"), F.max("id").alias("most"))
    heads = heads.filter(F.col("h.id") < F.col("most")).select("shingle", *[F.col(f"h.{c}").alias(f"hub_{c}") for c in columns])
    return rows.join(materialize(heads, "heads"), "shingle")


def starred(lists: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of the first set of each list with the others."""
    if "component" in lists.columns:
        lists = lists.filter("component != hub_component")
    return (lists.filter("id != hub_id")
            .filter(possible("{}", "hub_{}", percent))
            .select(F.col("hub_id").alias("a"), F.col("id").alias("b")).distinct())


def open_lists(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of lists that hold more than one component, with the component."""
    rows = lists.select("shingle", "id", "size", "at", "ahead").join(labels, "id", "left")
    rows = materialize(rows.select("shingle", "id", "size", "at", "ahead", F.coalesce("component", "id").alias("component")), "labelled")
    several = rows.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    several = materialize(several.filter("lo < hi").select("shingle"), "several")
    return rows.join(several, "shingle")


def crossed(rows: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of different components inside a list.  Sets meet in size
    classes one similarity wide, so only comparable sizes meet."""
    band = F.floor(F.log(F.col("size")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")
    own = rows.withColumn("band", band)
    left = own.select("shingle", "band", *[F.col(c).alias(f"{c}_a") for c in ("id", "size", "at", "ahead", "component")])
    right = own.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") + 1, F.col("band") - 1)))
    both = left.join(right, ["shingle", "band"])
    return (both.filter((F.col("id_a") < F.col("id")) & (F.col("component_a") != F.col("component")))
            .filter(possible("{}", "{}_a", percent))
            .select(F.col("id_a").alias("a"), F.col("id").alias("b")).distinct())


def joined(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, percent: int = 85,
           stars: int = 1) -> DataFrame:
    """Per row: ``id_col``, ``n_shingles`` and ``component_id``, the least id that
    links reach; two rows link when their Jaccard similarity is at least
    ``percent`` hundredths.

    Null, empty and blank texts have no shingles and link with nothing.  Rows
    with the same id are one node, linked wherever one of them is.  Null ids are
    nodes apart by their text, after all others, and a component of null ids only
    has a null id.  Ids must be below 2 ** 62.  Other columns are not read; an
    empty table gives no rows."""
    spark = df.sparkSession
    late = F.coalesce(F.xxhash64(text_col), F.lit(0)).bitwiseAND(F.lit(LATE - 1)).bitwiseOR(F.lit(LATE))
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), late).alias("id"), F.col(text_col).alias("text"))
    rows = materialize(surveyed(docs, k), "sets")

    # Equal sets are one node of the join; the first id stands for them.
    full = rows.filter(F.col("own").isNotNull())
    firsts = materialize(full.groupBy("own").agg(F.min("id").alias("first"), F.max("id").alias("most")), "firsts")
    copies = full.join(firsts.filter(F.col("first") < F.col("most")), "own").filter(F.col("id") > F.col("first"))
    links = materialize(copies.select(F.col("first").alias("a"), F.col("id").alias("b")), "copies")

    counts = spark.sparkContext.broadcast(occurrences(docs, k))
    nodes = firsts.select(F.col("first").alias("id")).distinct()
    rows_met = materialize(met(prefixes(docs, counts, k, percent), nodes), "met")
    lists = materialize(with_hub(rows_met), "lists")
    texts = materialize(docs.join(lists.select("id").distinct(), "id"), "texts")

    heads = lists.select("shingle", F.col("hub_id").alias("id")).distinct()
    done = None
    for turn in range(stars + 1):
        rest = open_lists(lists, components(links)) if turn else lists
        if turn == stars:
            pairs = crossed(rest if turn else open_lists(lists, components(links)), percent)
        elif turn == 0:
            pairs = starred(lists, percent)
        else:  # the heads of before have met all others of their lists
            rest = rest.join(heads, ["shingle", "id"], "left_anti")
            now = materialize(with_hub(materialize(rest, "rest")), "lists")
            heads = heads.union(now.select("shingle", F.col("hub_id").alias("id")).distinct())
            pairs = starred(now, percent)
        if done is not None:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        if pairs.isEmpty():
            continue
        done = pairs if done is None else done.union(pairs)
        links = materialize(links.union(verified(pairs, texts, k, percent)), "linked")

    labels = components(links)
    out = rows.join(labels, "id", "left")
    node = F.coalesce("component", "id")
    return out.select(F.when(F.col("id") < LATE, F.col("id")).alias(id_col), "n_shingles",
                      F.when(node < LATE, node).alias("component_id"))
