"""Quality by weak supervision.

Every rule looks at one aspect of a text and votes good, bad or, between its two
bands, abstains.  How often each vote falls on good and on bad documents is estimated
without labels, by expectation-maximisation over the vote patterns of all documents;
a document is kept when the posterior probability of being good is at least one half.
A single bad vote can be outvoted, and a rule that contradicts the others loses weight.

Everything on the rows is DataFrame functions.  The patterns number at most
three to the power of the rules, whatever the input, so the estimation itself
runs on that table of counts in the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.native import let, words
from pulsegrid.session import materialize

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MARKS = "!?|{}=^~"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = (*COUNTS, "n_lines", "n_upper", "n_marks", "n_bare")
BAD, ABSTAIN, GOOD = range(3)
#: What the estimation starts from, and is drawn to as if by so many documents for
#: each document: shares of the votes (bad, abstain, good) on bad and on good ones.
START = ((0.25, 0.15, 0.6), (0.02, 0.13, 0.85))
PRIOR, SHARE_GOOD, ROUNDS = 0.1, 0.8, 60


def repeated_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more in the array.

    Equal windows are brought together by sorting, and only where the row has
    any: few texts repeat a window, and a set tells which."""
    hashed = F.transform(w, lambda x: F.xxhash64(x))
    windows = let(hashed, lambda h: F.when(F.size(h) < 4, F.array().cast("array<bigint>")).otherwise(F.transform(
        F.sequence(F.lit(2), F.size(h) - 1), lambda i: F.xxhash64(F.get(h, i - 2), F.get(h, i - 1), F.get(h, i)))))

    def covered(windows: Column) -> Column:
        pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = let(pairs, lambda s: F.filter(s, lambda x, k: (
            (x["h"] == F.when(k > 0, F.get(s, k - 1)["h"])) | (x["h"] == F.get(s, k + 1)["h"]))))
        starts = F.sort_array(F.transform(repeated, lambda x: x["i"]))
        return let(starts, lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
            F.lit(0), lambda a, x: a + x))

    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def occurrences(text: Column, chars: str) -> Column:
    """How many of the given ASCII characters a text has."""
    return sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))) for c in chars),
               F.lit(0)).cast("long")


def measured(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col`` and the counts every rule reads; null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    shouted = lambda x: (x == F.upper(x)) & (x != F.lower(x))
    bare = lambda x: F.upper(x) == F.lower(x)
    return df.select(
        F.col(id_col).alias("id"),
        let(words(F.col(text_col)), lambda w: F.struct(
            F.size(w).alias("n"), repeated_words(w).alias("r"), F.size(F.filter(w, shouted)).alias("u"),
            F.size(F.filter(w, bare)).alias("b"))).alias("w"),
        (F.char_length(text).cast("long") - occurrences(text, SPACE)).alias("word_chars"),
        occurrences(text, SYMBOLS).alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d"))).alias("l"),
        occurrences(text, MARKS).alias("n_marks"),
    ).select(
        "id", F.col("w.n").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.col("l.d").cast("long").alias("n_dup_lines"), F.col("w.r").cast("long").alias("n_repeat_words"),
        F.col("l.n").cast("long").alias("n_lines"), F.col("w.u").cast("long").alias("n_upper"), "n_marks",
        F.col("w.b").cast("long").alias("n_bare"))


#: Rules by name: where each votes bad, and where it votes good.  Shares are compared
#: by multiplication, so that empty texts need no case of their own.
RULES = {
    "symbols": ("n_symbols * 30 > word_chars", "n_symbols * 200 <= word_chars"),
    "marks": ("n_marks * 10 > n_words", "n_marks * 100 <= n_words"),
    "bare": ("n_bare * 7 > n_words", "n_bare * 50 <= n_words"),
    "word_length": ("word_chars * 10 > n_words * 72 OR word_chars * 10 < n_words * 32", "word_chars >= n_words * 4 AND word_chars * 10 <= n_words * 66"),
    "repeats": ("n_repeat_words * 7 > n_words", "n_repeat_words * 50 <= n_words"),
    "lines": ("n_dup_lines * 4 > n_lines", "n_dup_lines * 20 <= n_lines"),
    "shouting": ("n_upper * 4 > n_words", "n_upper * 20 <= n_words"),
    "size": ("n_words < 50", "n_words >= 100"),
}
#: Rules that see the same fault weigh less each: by the root of their number.
TOGETHER = (("repeats", "lines"),)


def votes() -> list[Column]:
    """One vote per rule, in the order of ``RULES``."""
    return [F.when(F.expr(bad), BAD).when(F.expr(good), GOOD).otherwise(ABSTAIN) for bad, good in RULES.values()]


def weights() -> list[float]:
    size = {name: len(group) for group in TOGETHER for name in group}
    return [size.get(name, 1) ** -0.5 for name in RULES]


def posteriors(patterns: dict[int, int], weight: list[float], rounds: int = ROUNDS) -> dict[int, float]:
    """Probability of being good for each observed pattern of votes: digit j to the
    base of three is the vote of rule j.

    Votes are independent given the class, but for their weights.  Estimation is
    deterministic and does not depend on the order of the patterns."""
    rules, total = len(weight), sum(patterns.values())
    digits = {p: [p // 3 ** j % 3 for j in range(rules)] for p in sorted(patterns)}
    rates = [[list(START[c]) for _ in range(rules)] for c in (0, 1)]
    share, drawn = SHARE_GOOD, PRIOR * total
    good: dict[int, float] = {}
    for _ in range(rounds):
        odds = [[w * math.log(rates[1][j][v] / rates[0][j][v]) for v in range(3)] for j, w in enumerate(weight)]
        prior = math.log(share / (1 - share))
        good = {p: 1 / (1 + math.exp(-max(-500.0, min(500.0, prior + sum(o[v] for o, v in zip(odds, d)))))) for p, d in digits.items()}
        sizes = [sum(n * (1 - good[p]) for p, n in sorted(patterns.items())), sum(n * good[p] for p, n in sorted(patterns.items()))]
        for c in (0, 1):
            for j in range(rules):
                cast = [0.0, 0.0, 0.0]
                for p, d in digits.items():
                    cast[d[j]] += patterns[p] * (good[p] if c else 1 - good[p])
                rates[c][j] = [(x + drawn * s) / (sizes[c] + drawn) for x, s in zip(cast, START[c])]
        share = (sizes[1] + 8) / (total + 10)
    return good


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the counts, ``base_failed``, ``p_good`` and ``kept`` per row.

    Each row is judged on its own, so repeated rows and null ids give a row
    each; a null text counts as empty, an empty text fails the base rule, and
    an empty table gives no rows.  Other columns of ``df`` are not read."""
    rules = votes()
    pattern = sum((v * 3 ** j for j, v in enumerate(rules)), F.lit(0)).cast("int")
    counted = materialize(measured(df, id_col, text_col).withColumn("pattern", pattern), "quality")
    patterns = {r["pattern"]: r["n"] for r in counted.groupBy("pattern").agg(F.count("*").alias("n")).collect()}
    good = posteriors(patterns, weights()) if patterns else {}
    known = F.map_from_arrays(F.array(*[F.lit(p) for p in good]), F.array(*[F.lit(x) for x in good.values()])) if good else None
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return counted.select(
        F.col("id").alias(id_col), *MEASURES, failed.alias("base_failed"),
        (F.element_at(known, F.col("pattern")) if good else F.lit(0.5)).alias("p_good"),
    ).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))
