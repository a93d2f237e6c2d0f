import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from pulsegrid.llm import spelling
from pulsegrid.llm.queries import op13_spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def counts(rows, one_in=31):
    found = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(known):
    """{word: (form, root, n, n_near, form_n)}"""
    out = {}
    for w, n in known.items():
        own = [x for x in known if near(w, x)]
        best = min(own, key=lambda x: (-known[x], x), default=None)
        form = best if best is not None and known[best] >= 10 * n else None
        out[w] = (form, n, len(own), known[form] if form else None)

    def root(w):
        while out[w][0] is not None:
            w = out[w][0]
        return w
    return {w: (f, root(w), n, k, fn) for w, (f, n, k, fn) in out.items()}


def got(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def spoiled(rng, word):
    at = rng.randrange(len(word))
    return rng.choice([word[:at] + word[at + 1:], word[:at] + rng.choice("abé÷") + word[at:], word[:at] + rng.choice("abé×") + word[at + 1:]])


def corpus(rng, n):
    bases = ["aaaaaaaa", "aabbaabb", "straßenbahn", "éléphantéé", "mañanamañana", "abababab", "abcdefgh", "zzzzzzz"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randrange(40)):
            w = rng.choice(bases[:1 + rng.randrange(len(bases))])
            for _ in range(rng.choice([0] * 12 + [1, 1, 2])):
                w = spoiled(rng, w)
            words.append(w if rng.random() < 0.8 else w.upper())
        rows.append((i, rng.choice([" ", "\n", "1", "·", "Ā"]).join(words)))
    return rows + [(None, None), (None, "abcdefgh abcdefgh"), (3, ""), (5, "x" * 200_000), (6, "x" * 200_000 + " y" + "x" * 199_999)]


@pytest.mark.parametrize("seed", range(2))
def test_query_matches_brute_force(spark, tmp_path, seed):
    rows = corpus(random.Random(seed), 250)
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    want = brute(counts(rows))
    assert sum(f is not None for f, *_ in want.values()) > 20
    assert got(op13_spelling(spark, str(tmp_path))) == want


def test_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    known = counts(rows)
    mine = got(op13_spelling(spark, sf))
    assert {w: v[2] for w, v in mine.items()} == known
    some = {w: known[w] for w in sorted(known, key=lambda w: zlib.crc32(w.encode()))[:60]}
    for w in some:
        own = [x for x in known if near(w, x)]
        assert mine[w][3] == len(own), w


def test_many_ranges_share_their_nodes(spark, table):
    """Words with long common prefixes over many ranges: equal strings have equal numbers, others don't."""
    rng = random.Random(4)
    words = sorted({"prefix" + "".join(rng.choice("ab") for _ in range(rng.randrange(12))) for _ in range(700)} | {"", "p", "q"})
    df = table([(w,) for w in words], "key string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spelling.numbered(df.repartition(7), "path").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    number = {}
    for r in rows:
        assert len(r["path"]) == len(r["key"]) + 1
        for k, x in enumerate(r["path"]):
            assert number.setdefault(r["key"][:k], x) == x
    assert len(set(number.values())) == len(number)
    ends = [r["path"][-1] for r in sorted(rows, key=lambda r: r["key"])]
    assert ends == sorted(ends)


def test_check_sums_and_long_words():
    texts = ["Aé " + "z" * 100 + " ÿþ", "", "b" * 64 + "1" + "b" * 65, "ĀabcĀ×÷"]
    words = spelling.letter_runs(pa.array(texts))
    import numpy as np

    seeds = np.array([zlib.crc32(f"{i}:".encode()) for i in range(4)], np.uint32)
    want = [zlib.crc32(f"{i}:{run.translate(LOWER)}".encode()) for i, t in enumerate(texts) for run in RUN.findall(t)]
    assert spelling.check_sums(words, seeds).tolist() == want


def test_chains_and_edges(table):
    rows = [("aaaa", 1), ("aaab", 10), ("aabb", 100), ("abbb", 1000), ("bbbb", 100_000), ("aaa", 10), ("ab", 3), ("ab" * 50_000, 2), ("", 5), (None, 7)]
    mine = got(spelling.grouped(table([(w, n, "x") for w, n in rows], "word string, n long, path string")))
    assert mine["aaaa"] == ("aaa", "aaa", 1, 2, 10) and mine["aaab"] == ("aabb", "bbbb", 10, 3, 100)
    assert mine == brute({w: n for w, n in rows if w is not None})
    assert got(spelling.grouped(table([], "word string, n long"))) == {}
    assert spelling.vocabulary(table([], "doc_id long, text string")).count() == 0
