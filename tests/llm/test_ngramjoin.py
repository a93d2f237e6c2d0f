import random
import re

import numpy as np

from pulsegrid.llm.ngramjoin import alike, joined, suffix_bound
from pulsegrid.llm.queries import op4_ngram_join

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text, k=4):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def brute(rows, percent=85, k=4):
    """{id: (size, component)}"""
    sets = {i: shingle_set(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def corpus(rng, bases, copies):
    rows = []
    for _ in range(bases):
        words = [f"w{rng.randrange(60)}" for _ in range(rng.choice([1, 3, 5, 12, 40, 90]))]
        for _ in range(rng.randrange(1, copies)):
            mine = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                mine[rng.randrange(len(mine))] = rng.choice(["X", "é", "y1", "w3"])
            if rng.random() < 0.3:
                mine += ["common", "Line", "at", "the", "end"]
            rows.append(" ".join(mine))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_matches_brute_force(table):
    rng = random.Random(6)
    rows = corpus(rng, 25, 14)
    n = len(rows)
    rows += [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "A b"), (n + 4, "a B"), (n + 5, "a b c d"), (n + 6, "x " * 5000), (n + 7, "X " * 4000)]
    df = table([(*r, 0) for r in rows], "doc_id long, text string, component long")
    want = brute(rows)
    assert len({c for _, c in want.values()}) < 0.8 * n  # the case has links
    for stars in (0, 1, 2):
        assert got(joined(df, stars=stars)) == want


def test_lower_similarity(table):
    rows = corpus(random.Random(9), 15, 10)
    assert got(joined(table(rows, "doc_id long, text string"), percent=60, k=2)) == brute(rows, 60, 2)


def test_ties_nulls_and_empty(table):
    t = "a b c d e f g"
    rows = [(5, t), (5, "other text of five words"), (7, "other text of five words"), (None, t), (None, "alone in the world here"), (9, t)]
    out = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in joined(table(rows, "doc_id long, text string")).collect())
    assert out == [(0, 0), (0, 5), (5, 5), (5, 5), (7, 5), (9, 5)]
    assert joined(table([], "doc_id long, text string")).count() == 0


def test_suffix_filter_never_drops_a_link():
    rng = random.Random(1)
    for _ in range(500):
        a, b = (np.array(sorted(rng.sample(range(60), rng.randrange(1, 30))), np.uint64) for _ in range(2))
        both = len(set(a.tolist()) & set(b.tolist()))
        assert suffix_bound(a, b) <= len(a) + len(b) - 2 * both
        assert alike(a, b, 50) == (100 * both >= 50 * (len(a) + len(b) - both))


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(op4_ngram_join(spark, sf)) == brute(rows)
