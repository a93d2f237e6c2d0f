import random
import struct
import zlib
from collections import Counter, defaultdict

from pulsegrid.llm.packing import pack, packed, sweep
from pulsegrid.llm.queries import op3_packing, vocabulary


def best_fit(sizes, capacity):
    """Number of sequences that plain best-fit decreasing takes."""
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = min((g for g in gaps if g >= s), default=None)
        if fit is not None:
            gaps.remove(fit)
        gaps.append((capacity if fit is None else fit) - s)
    return len(gaps)


def sound(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by)


def test_sweep_is_best_fit_decreasing():
    rng = random.Random(2)
    for _ in range(200):
        sizes = [rng.choice([1, 2, 3, 7, 20, 33, 50, 64, 99, 100]) for _ in range(rng.randrange(80))]
        plan = sweep(Counter(sizes), {}, 100)
        assert plan.opened == best_fit(sizes, 100)


def test_pack_matches_best_fit(table):
    rng = random.Random(4)
    sizes = [rng.randrange(1, 65) if rng.random() < 0.7 else 17 for _ in range(900)]
    df = table([(i % 400, s, "z") for i, s in enumerate(sizes)], "doc_id long, length long, part string")
    out = pack(df.drop("part"), ["doc_id"], 64, (32, 8, 2)).collect()
    assert Counter(r["length"] for r in out) == Counter(sizes)
    assert sound(out, 64) == best_fit(sizes, 64)


def test_edge_rows(table):
    path = vocabulary("word_bpe_49k.json")
    rows = [(None, None), (1, ""), (1, ""), (2, "a " * 5000), (3, "x"), (3, "y z")]
    out = packed(table(rows, "doc_id long, text string"), path).collect()
    assert sound(out, 4096) == 2
    assert sorted((r["doc_id"] or 0, r["piece"], r["start"], r["length"]) for r in out) == [
        (0, 0, 0, 1), (1, 0, 0, 1), (1, 0, 0, 1), (2, 0, 0, 4096), (2, 1, 4096, 905), (3, 0, 0, 2), (3, 0, 0, 3)]
    assert packed(table([], "doc_id long, text string"), path).count() == 0


def test_query_matches_the_public_tokenizer(spark):
    from tokenizers import Tokenizer

    sf = "/root/testdata/sf0.01"
    public = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = [*public.encode(r["text"], add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), 4096)):
            own = ids[a:a + 4096]
            want[r["doc_id"], k] = a, len(own), zlib.crc32(struct.pack(f"<{len(own)}I", *own))
    out = op3_packing(spark, sf).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in out} == want and len(out) == len(want)
    assert sound(out, 4096) == best_fit([x[1] for x in want.values()], 4096)
