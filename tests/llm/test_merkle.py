import hashlib

from pyspark.sql import functions as F

from pulsegrid.llm import merkle
from pulsegrid.llm.queries import op6_fingerprint


def edits(rows):
    """{id: (n_chars, digest of the edited text)}"""
    rows = sorted(rows)
    out = {}
    for k, (i, t) in enumerate(rows):
        h = len(t) // 2
        e = t[:len(t) - h] + rows[(k + 1) % len(rows)][1][:h]
        out[i] = len(t), hashlib.sha256(e.encode()).hexdigest()
    return out


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = op6_fingerprint(spark, sf).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in out} == edits(rows)
    by = dict(rows)
    prints = {}
    for r in out:
        assert prints.setdefault(by[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
    assert len(set(prints.values())) == len(prints)
    far = [r for r in out if r["n_chars"] > 300]
    assert sum(r["near_edited"] > r["near_next"] for r in far) > 0.95 * len(far)
    assert all(0 <= r[c] <= 1 for r in out for c in ("near_edited", "near_next"))


def test_blocks_do_not_change_the_result(table, monkeypatch):
    rows = [(i * 37 % 1000, f"text {i} é\n" * (i % 5)) for i in range(300)]
    df = table(rows, "doc_id long, text string")
    want = edits(rows)
    for size in (4, 32, 10_000):
        monkeypatch.setattr(merkle, "ROWS_PER_BLOCK", size)
        assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in merkle.compared(df).collect()} == want


def test_edge_rows(table):
    rows = [(None, "last", 1), (None, None, 2), (5, "same text", 3), (5, "same text", 4), (7, "", 5), (8, "w " * 20_000, 6)]
    out = merkle.compared(table(rows, "doc_id long, text string, block int")).collect()
    assert len(out) == 6
    five = [r for r in out if r["doc_id"] == 5]
    assert five[0]["fingerprint"] == five[1]["fingerprint"] and max(r["near_next"] for r in five) == 1.0
    assert len({r["fingerprint"] for r in out}) == 4
    one = merkle.compared(table([(1, "abcd")], "doc_id long, text string")).collect()[0]
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    assert merkle.compared(table([], "doc_id long, text string")).count() == 0


def test_branches_locate_edits(table):
    a = "one\ntwo\n\nthree\nfour"
    rows = table([(1, a, a), (2, a, "one\ntwo\n\nthree\nFOUR"), (3, a, "one\n2\n\nthree")], "id int, a string, b string")
    out = rows.select("id", merkle.differing(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("d")).collect()
    assert {r["id"]: [tuple(x) for x in r["d"]] for r in out} == {1: [], 2: [(1, 1)], 3: [(0, 1), (1, 1)]}
