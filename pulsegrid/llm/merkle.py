"""Document fingerprints as Merkle trees, in DataFrame functions only.

A text is cut at blank lines into sections, at line feeds into paragraphs and at
every eighth space of a paragraph into phrases, without losing a character.  A
phrase is hashed by its words, a paragraph by its phrases, a section by its
paragraphs and the root by its sections.  Equal roots mean equal texts; below
unequal roots the branches that differ tell where the edit is, and the share of
equal leaves tells how much of the text two versions have in common.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.llm.native import let

PHRASE = 8
ROWS_PER_BLOCK, MOST_BLOCKS = 512, 20_000


def tree(text: Column) -> Column:
    """Hashes of phrases, by section and paragraph."""
    def phrases(paragraph: Column) -> Column:
        return let(F.split(paragraph, " ", -1), lambda w: F.transform(
            F.sequence(F.lit(1), F.size(w), F.lit(PHRASE)), lambda i: F.xxhash64(F.slice(w, i, PHRASE))))

    return F.transform(F.split(text, "\n\n", -1), lambda s: F.transform(F.split(s, "\n", -1), phrases))


def leaves(of: Column) -> Column:
    """Distinct phrases of a tree, without the empty one."""
    return F.array_remove(F.array_distinct(F.flatten(F.flatten(of))), F.xxhash64(F.array(F.lit(""))))


def short(h: Column) -> Column:
    return F.substring(F.lpad(F.hex(h), 16, "0"), 9, 8)


def root(of: Column) -> Column:
    """32 hexadecimal digits over the whole tree."""
    return F.substring(F.sha2(F.array_join(F.transform(of, lambda s: F.hex(F.xxhash64(s))), "/").cast("binary"), 256), 1, 32)


def written(of: Column) -> Column:
    """The tree as a string: root|section=paragraph:phrases/paragraph:phrases;..."""
    return F.lower(F.concat(root(of), F.lit("|"), F.array_join(F.transform(of, lambda s: F.concat(
        short(F.xxhash64(s)), F.lit("="), F.array_join(F.transform(s, lambda p: F.concat(
            short(F.xxhash64(p)), F.lit(":"), F.array_join(F.transform(p, short), ""))), "/"))), ";")))


def likeness(a: Column, b: Column) -> Column:
    """Share of leaves in common, 0 to 1; 1 for equal trees."""
    shared = let(F.struct(leaves(a).alias("a"), leaves(b).alias("b")), lambda x: (
        2.0 * F.size(F.array_intersect(x["a"], x["b"])) / F.greatest(F.lit(1), F.size(x["a"]) + F.size(x["b"]))))
    return F.when(a == b, F.lit(1.0)).otherwise(shared)


def differing(a: Column, b: Column) -> Column:
    """(section, paragraph), from 0, of the paragraphs of ``a`` that ``b`` has not
    in the same place; equal sections are passed over by their hash."""
    return F.flatten(F.transform(a, lambda s, i: F.when(
        F.xxhash64(s) == F.xxhash64(F.get(b, i)), F.array().cast("array<struct<section: int, paragraph: int>>")).otherwise(
        F.filter(F.transform(s, lambda p, j: F.when(
            ~F.coalesce(p == F.get(F.get(b, i), j), F.lit(False)), F.struct(i.alias("section"), j.alias("paragraph")))),
            lambda x: x.isNotNull()))))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``fingerprint`` and ``tree`` per row.  Null text counts as
    empty, an empty text has one empty phrase, repeated rows stay, other columns
    are not read, an empty table gives no rows."""
    own = df.select(id_col, tree(F.coalesce(F.col(text_col), F.lit(""))).alias("tree"))
    return own.select(id_col, written(F.col("tree")).alias("fingerprint"), "tree")


def blocks(rows: DataFrame) -> tuple[list[int], int | None]:
    """Ids of ``rows`` that begin a block, and the least id."""
    count, least = rows.agg(F.count("*"), F.min("key")).first()
    n = min(MOST_BLOCKS, count // ROWS_PER_BLOCK)
    if n < 2:
        return [], least
    bounds = rows.agg(F.percentile_approx("key", [k / n for k in range(1, n)], max(10_000, 4 * n))).first()[0]
    return sorted({b for b in bounds if b > least}), least


def block_of(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at most ``key``, by bisection."""
    if not bounds:
        return F.lit(0)
    known = F.array(*[F.lit(b).cast("long") for b in bounds])
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1))
    state = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def halve(x: Column, _: Column) -> Column:
        mid = F.floor((x["lo"] + x["hi"]) / 2).cast("int")
        right = F.get(known, mid) <= key
        return F.when(x["lo"] >= x["hi"], x).otherwise(F.struct(
            F.when(right, mid + 1).otherwise(x["lo"]).alias("lo"), F.when(right, x["hi"]).otherwise(mid).alias("hi")))

    return F.aggregate(steps, state, halve, lambda x: x["lo"])


def with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, tree, next text, next tree): each row and the row that follows
    it by id, after the last the first.

    Rows go to blocks of neighbouring ids, so the text moves once; the first
    rows of a block are also sent to the end of the block before."""
    last = (1 << 63) - 1
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(last)).alias("key"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bounds, least = blocks(rows)
    block = block_of(F.col("key"), bounds)
    begins = F.array(*[F.lit(b).cast("long") for b in [least if least is not None else 0, *bounds]])
    before = F.when(F.col("block") == 0, F.lit(len(bounds))).otherwise(F.col("block") - 1)
    spread = rows.withColumn("block", block).select("*", F.explode(F.when(
        F.get(begins, F.col("block")) == F.col("key"), F.array(
            F.struct(F.col("block").alias("to"), F.lit(0).alias("ghost")), F.struct(before.alias("to"), F.lit(1).alias("ghost"))),
    ).otherwise(F.array(F.struct(F.col("block").alias("to"), F.lit(0).alias("ghost"))))).alias("x"))
    own = spread.select("id", "key", "text", "x.to", "x.ghost", tree(F.col("text")).alias("tree"))
    order = Window.partitionBy("to").orderBy("ghost", "key", "text")
    return (own.select("id", "text", "tree", "ghost", F.lead(F.struct("text", "tree")).over(order).alias("next"))
            .filter("ghost = 0").select("id", "text", "tree", F.col("next.text").alias("next_text"), F.col("next.tree").alias("next_tree")))


def compared(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of texts, of edited texts, and how alike they are.

    The edited text keeps the first half, and the last floor(n / 2) code points
    give way to as many from the start of the next text by id, or all of it.
    Null text counts as empty; null ids come last; rows with equal ids follow
    each other by text, so repeated rows are each other's next; a single row is
    its own next; other columns are not read; an empty table gives no rows."""
    pairs = with_next(df, id_col, text_col)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    out = pairs.select("id", "tree", "next_tree", n.cast("long").alias("n_chars"), let(edited, lambda e: F.struct(
        F.sha2(e.cast("binary"), 256).alias("sha"), tree(e).alias("tree"))).alias("edited"))
    return out.select(
        F.col("id").alias(id_col), "n_chars", F.col("edited.sha").alias("edited_sha256"),
        written(F.col("tree")).alias("fingerprint"), written(F.col("edited.tree")).alias("edited_fingerprint"),
        likeness(F.col("tree"), F.col("edited.tree")).alias("near_edited"),
        likeness(F.col("tree"), F.col("next_tree")).alias("near_next"))
