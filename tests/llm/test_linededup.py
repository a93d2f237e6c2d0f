from collections import Counter

from pyspark.sql import functions as F

from pulsegrid.llm.linededup import drop_site_lines


def brute(rows, ratio, least):
    pages = Counter(h for _, _, h in rows)
    has = Counter((h, x) for _, t, h in rows if t is not None for x in set(t.split("\n")) if x.strip())
    bad = {k for k, n in has.items() if n >= least and n > pages[k[0]] * ratio}
    return Counter((i, None if t is None else "\n".join(x for x in t.split("\n") if (h, x) not in bad), h) for i, t, h in rows)


def test_matches_brute_force(table):
    rows = [(i, f"head\nbody {i}\n\nfoot {i % 2}\nhead" if i % 9 else None, ["a", "b", None][i % 3]) for i in range(90)]
    rows += [(None, "head\nonly", "a"), (7, "head\nhead", "c"), (7, "head\nhead", "c"), (8, "", "a"), (8, "\n", "a")]
    df = table([(*r, "z", 5) for r in rows], "doc_id long, text string, source string, n_removed string, pages long")
    for ratio, least in ((0.1, 5), (0.45, 2), (0.9, 1)):
        out = drop_site_lines(df, "doc_id", "text", F.col("source"), ratio=ratio, min_pages=least)
        assert Counter((r["doc_id"], r["text"], r["source"]) for r in out.collect()) == brute(rows, ratio, least)


def test_small_sites_and_empty(table):
    df = table([(1, "x\ny", "a"), (2, "x", "a")], "doc_id long, text string, source string")
    out = drop_site_lines(df, "doc_id", "text", F.col("source"))
    assert {r["text"]: r["n_removed"] for r in out.collect()} == {"x\ny": 0, "x": 0}
    assert drop_site_lines(df.limit(0), "doc_id", "text", F.col("source")).count() == 0
