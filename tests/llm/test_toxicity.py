from itertools import combinations

import numpy as np
import pyarrow as pa

from pulsegrid.llm.queries import op10_toxicity
from pulsegrid.llm.toxicity import DECAY, ORDER, features, fit, kernel, scored

DOC = "doc_id long, text string"


def plain(s, t):
    """The kernel by its definition."""
    def weights(x):
        out = {}
        for at in combinations(range(len(x)), ORDER):
            key = bytes(x[i] for i in at)
            out[key] = out.get(key, 0) + DECAY ** (at[-1] - at[0] + 1)
        return out
    a, b = weights(s), weights(t)
    own = sum(v * v for v in a.values()) * sum(v * v for v in b.values())
    return sum(v * b.get(k, 0) for k, v in a.items()) / own ** 0.5 if own else 0.0


def test_kernel_matches_its_definition():
    words = [b"abc", b"axbxc", b"idiot", b"id-iot", b"ab", b"aaaa", b"moron", "é".encode() * 3, b"mo"]
    left, right = zip(*[(a, b) for a in words for b in words])
    assert np.allclose(kernel(list(left), list(right)), [plain(a, b) for a, b in zip(left, right)])


def test_gaps_and_inserted_characters_stay_near():
    x = features(pa.array(["an idiot here", "an id-iot here", "an i.d.i.o.t here", "an i d i o t here", "the sun shines", "", "IDIOT!"]), [b"idiot"])[:, 0]
    assert (x[[0, 1, 2, 3, 6]] > 0.999).all() and x[4] < 0.3 and x[5] == 0


def test_long_words_and_edge_rows(table):
    rows = [(i, f"you utter moron {i}" if i % 2 else f"a fine day {i}") for i in range(80)]
    labels = table([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    docs = table(rows, DOC)
    model = fit(docs, labels)
    more = [(None, None, "a"), (1, "", "a"), (2, "what a m-oron", "b"), (2, "what a m-oron", "b"), (3, "x" * 50_000 + "moron", "b"), (4, "fine", "c")]
    out = sorted(((r["doc_id"] or 0, r["score"]) for r in scored(table(more, f"{DOC}, score string"), model).collect()))
    assert all(0 <= s <= 1 for _, s in out)
    assert out[2][1] == out[3][1] > 0.5 and max(out[0][1], out[1][1], out[5][1]) < 0.5
    assert scored(docs.limit(0), model).count() == 0


def test_without_labels_of_both_kinds(table):
    docs = table([(1, "a b"), (2, None)], DOC)
    for rows in ([], [(1, 0)], [(1, None)]):
        out = scored(docs, fit(docs, table(rows, "doc_id long, toxic int"))).collect()
        assert all(r["score"] < 0.5 for r in out)


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = op10_toxicity(spark, sf).join(labels, "doc_id").filter("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert sum(toxic) > 0.8 * len(toxic) and sum(clean) < 0.01 * len(clean)


def test_insults_inside_long_tokens_and_between_signs():
    marks = [b"idiot", b"moron", b"ass", "大馬鹿".encode()]
    x = features(pa.array(["idiot,please", "you-utter-moron", "x" * 40 + "idiot" + "y" * 40, "please/youidiotandallthat", "an ass!", "a s s",
                           "彼は大馬鹿だと私は思う彼は大馬鹿だと私は思う"]), marks)
    assert (x[[0, 1, 2, 3, 4, 5, 6], [0, 1, 0, 0, 2, 2, 3]] > 0.999).all()
    assert features(pa.array(["whatanidxioxtyoureallyare"]), [b"idiot"])[0, 0] > 0.2


def test_every_value_is_the_kernel():
    words = ["idixoxt", "ixdxixoxt", "mroon", "banana", "todi", "anan", "aaaaaa", "torpedo"]
    marks = [b"idiot", b"moron", b"banana", b"aaa", b"torpedoes"]
    x = features(pa.array(words), marks)
    for i, w in enumerate(words):
        for j, m in enumerate(marks):
            if len(w) <= 2 * len(m):
                assert abs(x[i, j] - plain(w.encode(), m)) < 1e-5
    assert 0 < x[1, 0] < 0.5


def test_values_over_all_lengths_and_with_a_full_memo(monkeypatch):
    """Whole strings up to 32 bytes and windows, by the definition, whether remembered or not."""
    import random

    from pulsegrid.llm import toxicity

    rng = random.Random(3)
    marks = [b"abc", b"abcd", b"bacab", b"dabbed", b"abcdabcd"]
    words = ["".join(rng.choice("abcdxyz") for _ in range(n)) for n in range(3, 45) for _ in range(3)]

    def slow(word, mark):
        w, n, size = word.encode(), len(word), len(mark)
        pieces = [w] if n <= 32 else []
        if 2 * size < n:
            for width, stride in ((size, 1), (2 * size, max(1, size // 2))):
                pieces += [w[a:a + width] for a in sorted({*range(0, n - width + 1, stride), n - width})]
        return max((plain(p, mark) for p in pieces), default=0.0)

    want = np.array([[slow(w, m) for m in marks] for w in words])
    monkeypatch.setattr(toxicity.Matcher, "KEEP", 20)
    matcher = toxicity.Matcher(marks)
    strings = [w.encode() for w in words]
    assert np.abs(matcher.table(strings[:50]) - want[:50]).max() < 1e-5
    assert len(matcher.known) == 20 and np.abs(matcher.table(strings) - want).max() < 1e-5
