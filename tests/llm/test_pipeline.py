from collections import Counter

import corpus_pipeline as cp
from pulsegrid.llm import pii
from tests.llm.test_linededup import brute as brute_lines
from tests.llm.test_ngramjoin import brute as brute_join
from tests.llm.test_packing import sound

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_do_what_they_say(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r["doc_id"]: r for r in cp.drop_toxic(spark, docs, sf).collect()}
    clean = [i for i, t in labels.items() if not t]
    assert sum(i in kept for i in clean) > 0.98 * len(clean)
    assert sum(i in kept for i, t in labels.items() if t) < 0.3 * sum(labels.values())

    docs = spark.createDataFrame(list(kept.values()), SCHEMA)
    lines = cp.drop_boilerplate(spark, docs, sf)
    assert lines.columns == list(cp.COLUMNS)
    want = brute_lines([(r["doc_id"], r["text"], r["source"]) for r in kept.values()], 0.1, 5)
    rows = lines.collect()
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in rows) == want
    assert all(r["n_chars"] == len(r["text"]) for r in rows)

    few = [r for r in rows if r["doc_id"] % 3 == 0]
    alone = cp.drop_near_copies(spark, spark.createDataFrame(few, SCHEMA), sf).collect()
    component = brute_join([(r["doc_id"], r["text"]) for r in few], 80, 5)
    assert {r["doc_id"] for r in alone} == {i for i, (_, c) in component.items() if i == c}

    masked = cp.mask_personal_data(spark, spark.createDataFrame(alone, SCHEMA), sf).collect()
    before = {r["doc_id"]: r["text"] for r in alone}
    assert all(r["text"] == pii.masked(before[r["doc_id"]], pii.found(before[r["doc_id"]])) for r in masked)
    assert any(r["text"] != before[r["doc_id"]] for r in masked)

    out = cp.pack(spark, spark.createDataFrame(masked, SCHEMA), sf).collect()
    assert {r["doc_id"] for r in out} == set(before) and sound(out, 4096)


def test_edge_rows_pass_every_stage(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "x " * 9000, "en", None, 9),
            (3, "one two three four five six", None, "b", 1), (4, "one two three four five six", None, "b", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("score", cp.F.lit("z")).withColumn("pii", cp.F.lit(1))
    for data, left in ((docs, 5), (docs.limit(0), 0)):
        for name, stage in cp.STAGES[:-1]:
            data = stage(spark, data, "/root/testdata/sf0.001")
            assert data.columns == list(cp.COLUMNS), name
            data = spark.createDataFrame(data.collect(), SCHEMA)
        assert data.count() == left
        assert len({r["doc_id"] for r in cp.pack(spark, data, "").collect()}) == (4 if left else 0)


def test_run(spark):
    out = cp.run(spark, "/root/testdata/sf0.001")
    assert sound(out.collect(), 4096) > 0
