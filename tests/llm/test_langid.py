import random
from itertools import product

import numpy as np
import pytest

from pulsegrid.llm import langid
from pulsegrid.llm.queries import op11_language

SCHEMA = "doc_id long, text string, lang string"


def by_paths(emission, steps):
    """Distribution of every word by summing over all labellings."""
    n, k = emission.shape
    out = np.zeros((n, k))
    for path in product(range(k), repeat=n):
        before = np.exp(steps)[:, path[0]].mean()
        w = before * np.exp(sum(emission[t, y] for t, y in enumerate(path)) + sum(steps[a, b] for a, b in zip(path, path[1:])))
        for t, y in enumerate(path):
            out[t, y] += w
    return out / out.sum(1, keepdims=True)


def test_forward_backward_sums_over_all_labellings(monkeypatch):
    rng = np.random.default_rng(1)
    emission, steps = rng.normal(size=(17, 3)), rng.normal(size=(3, 3))
    first = np.array([0, 7, 7, 8, 17])
    want = np.concatenate([by_paths(emission[a:b], steps) for a, b in zip(first, first[1:]) if b > a])
    for block in (64, 3, 1):
        monkeypatch.setattr(langid, "BLOCK", block)
        assert np.allclose(langid.distributions(emission, first, steps), want)


def test_slopes_are_those_of_the_likelihood(monkeypatch):
    """What one batch adds to the transitions is the derivative of the log-likelihood."""
    rng = np.random.default_rng(2)
    text = "aa bb cc dd ee"
    chain = langid.chained([text])
    truth = np.array([0, 0, 1, 1, 0])
    model = langid.Model(["x", "y"], rng.normal(size=(64, 2)), rng.normal(size=(2, 2)), np.eye(2))
    emission = model.emissions(chain.codes, chain.start, chain.end, chain.hashes())

    def likelihood(steps):
        score = lambda path: emission[np.arange(5), path].sum() + sum(steps[a, b] for a, b in zip(path, path[1:])) + np.log(np.exp(steps)[:, path[0]].mean())
        return score(truth) - np.log(sum(np.exp(score(np.array(p))) for p in product(range(2), repeat=5)))

    for name, value in (("EPOCHS", 1), ("SPLICED", 0.0), ("DECAY", 0.0), ("RATE", 1.0)):
        monkeypatch.setattr(langid, name, value)
    before = model.steps.copy()
    langid.learn(model, chain, chain.hashes(), truth)
    found = np.sign(model.steps - before)
    want = np.zeros((2, 2))
    for i, j in product(range(2), repeat=2):
        h = np.zeros((2, 2))
        h[i, j] = 1e-5
        want[i, j] = (likelihood(before + h) - likelihood(before - h)) / 2e-5
    clear = np.abs(want) > 1e-3
    assert clear.sum() >= 3 and (found[clear] == np.sign(want[clear])).all()


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return langid.fit(docs.filter("doc_id % 2 = 0"), sample=300)


def test_held_out_documents(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id % 2 = 1")
    rows = langid.identified(docs.select("doc_id", "text", "lang"), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_switches_are_found(spark, model):
    """Texts spliced of two languages: nearly all words get their own one's label."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("doc_id % 2 = 1").select("lang", "text").collect()
    rng = random.Random(5)
    by = {x: [" ".join(r["text"].split()[:40]) for r in rows if r["lang"] == x and len(r["text"].split()) > 80] for x in ("de", "en", "es", "fr")}
    mixed = []
    for n in range(60):
        a, b = rng.sample(sorted(by), 2)
        s, t = rng.choice(by[a]), rng.choice(by[b])
        mixed.append((n, f"{s} {t}", f"{a} {b} {len(s)}"))
    good = total = 0
    for r in langid.identified(spark.createDataFrame(mixed, SCHEMA), model).collect():
        a, b, cut = r["lang"].split()
        for run in r["runs"]:
            assert 0 <= run["start"] < run["stop"] <= len(r["text"])
            for at in range(run["start"], run["stop"]):
                good += run["lang"] == (a if at < int(cut) else b)
                total += 1
    assert good > 0.95 * total


def test_query(spark):
    rows = op11_language(spark, "/root/testdata/sf0.001").collect()
    import zlib

    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_edge_rows(spark, model):
    odd = [(1, None, "a", 3), (2, "", "a", 4), (3, "12 — ... $$ ́", None, 5), (None, "und die der", "b", 6), (None, "und die der", "b", 6),
           (4, "x" * 400_000, "c", 7), (5, "the " * 300_000, "d", 8), (6, "12 the 34", "e", 9), (7, "日本語 текст ελληνικά", "f", 1)]
    df = spark.createDataFrame(odd, "doc_id long, text string, lang_pred string, runs int")
    rows = {(r["doc_id"], r["text"] and r["text"][:9]): r for r in langid.identified(df, model).collect()}
    for key in ((1, None), (2, ""), (3, "12 — ... ")):
        assert (rows[key]["lang_pred"], rows[key]["score"], rows[key]["runs"]) == ("und", 0.0, [])
    assert rows[6, "12 the 34"]["lang_pred"] == "en" and [(r["start"], r["stop"]) for r in rows[6, "12 the 34"]["runs"]] == [(3, 6)]
    assert rows[None, "und die d"]["lang_pred"] == "de"
    assert rows[5, "the the t"]["lang_pred"] == "en" and rows[4, "x" * 9]["lang_pred"] in model.languages
    empty = spark.createDataFrame([], SCHEMA)
    nothing = langid.fit(empty)
    assert nothing.languages == [] and langid.identified(empty, model).count() == 0
    assert {r["lang_pred"] for r in langid.identified(df, nothing).collect()} == {"und"}
    one = langid.fit(spark.createDataFrame([(1, "nur ein Wort", "de"), (2, None, "fr"), (3, "x", None), (4, "", "de")], SCHEMA))
    assert one.languages == ["de"]
    few = langid.fit(spark.createDataFrame([(1, "...", "de"), (2, "?", "fr")], SCHEMA))
    assert langid.identified(df, few).count() == len(odd)
