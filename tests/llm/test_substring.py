import hashlib
import random
import re

from pulsegrid.llm.queries import op1_substring_dedup
from pulsegrid.llm.substring import repeats

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(rows, k):
    """{id: (n_words, n_removed, digest)} for distinct ids."""
    first = {}
    words = {i: WORD.findall(t or "") for i, t in rows}
    for i in sorted(words):
        for p in range(len(words[i]) - k + 1):
            first.setdefault(tuple(words[i][p:p + k]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for p in range(len(w) - k + 1):
            if first[tuple(w[p:p + k])] < i:
                gone.update(range(p, p + k))
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        out[i] = len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()
    return out


def got(df):
    return {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()}


def test_matches_brute_force(table):
    rng = random.Random(3)
    for k, kinds in ((5, 3), (8, 2), (12, 40)):
        source = [f"w{rng.randrange(kinds)}é" for _ in range(400)]
        rows = []
        for i in range(120):
            parts = []
            for _ in range(rng.randrange(4)):
                a = rng.randrange(380)
                parts += source[a:a + rng.randrange(40)] if rng.random() < 0.6 else [f"u{rng.randrange(900)}" for _ in range(9)]
            rows.append((i * 7 % 120, rng.choice([" ", "\n", " \t"]).join(parts)))
        rows += [(200, None), (201, ""), (202, rows[5][1]), (203, rows[5][1]), (204, " ".join(source * 3)), (205, "a a " * 30), (206, "a " * 50)]
        df = table([(*r, 1) for r in rows], "doc_id long, text string, seq int")
        assert got(repeats(df, k=k)) == brute(rows, k)


def test_ties_nulls_and_empty(table):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (1, text), (None, text), (None, text + " x"), (None, text + " x"), (0, "short")]
    out = repeats(table(rows, "doc_id long, text string"), k=10).collect()
    assert sorted((r["doc_id"] or -1, r["n_words"], r["n_removed"]) for r in out) == [
        (-1, 5 * 0 + 1, 0), (-1, 30, 30), (-1, 31, 30), (-1, 31, 30), (1, 30, 0), (1, 30, 0)]
    assert repeats(table([], "doc_id long, text string")).count() == 0


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(op1_substring_dedup(spark, sf)) == brute(rows, 50)
