import hashlib
import random
import struct

import pyarrow as pa
import pytest

from pulsegrid.llm.bpe import read_vocabulary
from pulsegrid.llm.queries import op2_bpe, vocabulary
from pulsegrid.llm.tokens import Tokenizer, decode, encode

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
ODD = ["", " ", "  a", "a  ", "a \n\n b", "\n", " \u00a0 x\u00a0\n y", "a\u3000b \u2003c", "x\x1cy \x1f z", "<|endoftext|>", "a <|endoftext|>  b<|endoftext|>",
       "<|startoftext|> É", "don't we'll I'M it's 'sx", "１２3 ٣٤", "e\u0301 a\u030a İ ΣΑΣ ﬁ", "\u0301 x \u0301", "😀👍🏽 family 👨‍👩‍👧", "日本語のテキスト", "a" * 3000, "=" * 700,
       "ab" * 1500, "\x00\x01 a", "x" + " " * 500 + "y", "\t\t\tif x:\r\n\t\tpass", "ß ẞ ŉ ǰ", "\ufeffbom", "100,000.50€ 3rd"]


def reference(name):
    from tokenizers import Tokenizer as Public

    public = Public.from_file(vocabulary(name))
    public.no_truncation()
    public.no_padding()
    return public


def texts(rng, n):
    alphabet = "abcdehinorst  \n'!.,-É ñ😀0123\u00a0\t<|>STR"
    return ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("name", FILES)
def test_ids_match_the_public_tokenizer(name):
    mine, public = Tokenizer(read_vocabulary(vocabulary(name))), reference(name)
    rows = texts(random.Random(8), 4000)
    ids, at = mine.encode(pa.array(rows))
    for t, a, b in zip(rows, at, at[1:]):
        want = public.encode(t, add_special_tokens=False).ids
        assert ids[a:b].tolist() == want, t
    if name == FILES[0]:
        for t, got in zip(rows, mine.decode(ids, at)):
            assert got.decode() == public.decode(public.encode(t, add_special_tokens=False).ids, skip_special_tokens=False)


def test_encode_and_decode_edge_rows(table):
    path = vocabulary(FILES[0])
    rows = [(1, None, "k"), (1, None, "k"), (None, "", "k"), (2, "héllo <|endoftext|> x", None), (3, "z " * 90_000, "k")]
    df = table(rows, "doc_id long, text string, ids string")
    out = decode(encode(df, path), path).collect()
    assert sorted((r["doc_id"] or 0, r["text"], len(r["ids"])) for r in out)[:3] == [(0, "", 0), (1, "", 0), (1, "", 0)]
    assert {r["text"] for r in out} == {"", rows[3][1], rows[4][1]}
    assert encode(df.limit(0), path).count() == 0


def test_query_matches_the_public_tokenizer(spark):
    sf = "/root/testdata/sf0.01"
    public = reference(FILES[0])
    got = {r["doc_id"]: r for r in op2_bpe(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = public.encode(r["text"], add_special_tokens=False).ids
        text = public.decode(ids, skip_special_tokens=False)
        mine = got[r["doc_id"]]
        assert mine["n_tokens"] == len(ids)
        assert mine["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert mine["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
