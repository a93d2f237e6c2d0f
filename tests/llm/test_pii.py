import hashlib
import random
import re
import time

import pytest

from pulsegrid.llm import pii
from pulsegrid.llm.pii import found, personal_data
from pulsegrid.llm.queries import op7_pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(s):
    return [int(c) for c in s if c in "0123456789"]


def luhn(d):
    return sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d[::-1])) % 10 == 0


def brute(t):
    return {
        "email": [m.span() for m in EMAIL.finditer(t)],
        "ip": [m.span() for m in IP.finditer(t) if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) < 256 for x in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(t) if 16 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        "phone": [m.span() for m in PHONE.finditer(t) if 8 <= len(digits(m[0])) <= 15],
    }


def check(t):
    mine = found(t)
    assert {k: mine[k] for k in pii.BASE} == brute(t), t


def test_base_kinds_match_the_patterns():
    rng = random.Random(5)
    for alphabet in ("ab@.-+% ", "01.9 -", "+12 ().-x", "a@.1+ -(é\n", "4 -0", "12345.6"):
        for _ in range(6000):
            check("".join(rng.choice(alphabet) for _ in range(rng.randrange(40))))
    for t in ("4111 1111 1111 1111", "x4111-1111-1111-1111x", "a@b.c@d.e", "a@b@c.d", "300.1.1.1 1.2.3.4.5.6.7.8", "+1 (555) 010-5555 ",
              "0" * 5000 + ".1.2.3", "٣@b.c", "a@b.ć"):
        check(t)


def test_added_kinds():
    assert found("see ftp://joe:pw@host.example.org/x")["url"] == [(4, 33)]
    assert found("http://host.example.org/x")["url"] == []
    t = "IBAN: DE89 3704 0044 0532 0130 00 end"
    (a, b), = found(t)["account"]
    assert t[a:b] == "DE89 3704 0044 0532 0130 00"
    t = "SSN 078-05-1120, account no. 12-3456"
    assert [t[a:b] for a, b in found(t)["account"]] == ["078-05-1120", "12-3456"]
    assert found("account of the day, accountant 123456")["account"] == []


def test_edge_rows(table):
    rows = [(1, None, "k"), (None, "", "k"), (2, "mail a@b.cd now", None), (2, "mail a@b.cd now", None), (3, "x" * 300_000 + " 1.2.3.4", "k")]
    out = personal_data(table(rows, "doc_id long, text string, pii string"), mask=True).collect()
    texts = sorted((r["doc_id"] or 0, r["text"] or "", len(r["pii"])) for r in out)
    assert texts[0] == (0, "", 0) and texts[1] == (1, "", 0)
    assert texts[2] == texts[3] == (2, "mail <email> now", 1)
    assert texts[4][1].endswith("x <ip>")
    assert personal_data(table([], "doc_id long, text string")).count() == 0


def slow_iban(text, at, beyond):
    """The longest end after which the whole code, spaces left out, checks."""
    for end in range(min(len(text), at + 42), beyond, -1):
        code = text[at:end].replace(" ", "").upper()
        if text[end - 1] != " " and 15 <= len(code) <= 34 and re.fullmatch("[A-Z]{2}[0-9]{2}[A-Z0-9]+", code) \
                and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            return end
    return 0


def test_account_numbers_match_the_slow_form():
    rng = random.Random(8)
    hits = 0
    for _ in range(40_000):
        text = "DE" + "".join(rng.choice("0123456789 9A-" if rng.random() < 0.2 else "0123456789 ") for _ in range(rng.randrange(10, 60)))
        beyond = rng.randrange(0, 30)
        assert pii.iban(text, 0, beyond) == slow_iban(text, 0, beyond), text
        hits += pii.iban(text, 0, beyond) > 0
    assert hits > 1000
    assert pii.iban("DE89 3704 0044 0532 0130 00 and", 0, 4) == 27 and pii.iban("D8 9", 0, 0) == 0


@pytest.mark.parametrize("unit", ["account x ", "iban DE89 ", "iban:", "+1 ", "a@", "1.", "a://b", "x:", "+1(", "iban   :: ", "a@b.c.", "4 1"])
def test_time_grows_with_the_text(unit):
    """Ten times the text takes no more than some twenty times as long."""
    def seconds(n):
        text = unit * (n // len(unit))
        begin = time.process_time()
        found(text)
        return time.process_time() - begin

    found(unit)
    short = min(seconds(50_000) for _ in range(3))
    assert seconds(500_000) < 20 * short + 0.5


def test_query_matches_brute_force(spark, tmp_path):
    """Counts, digest and span string of the query, kinds as listed and then by start."""
    rng = random.Random(2)
    parts = ["joe.x@mail.example.org", "10.20.30.40", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 1234-5678", "+1 2",
             "text", "é日", "ftp://a:b@c.d/", "iban DE89 3704 0044 0532 0130 00", "account no. 12-3456", "a@b", "@"]
    rows = [(i, rng.choice(["", " ", ", "]).join(rng.choice(parts) for _ in range(rng.randrange(12)))) for i in range(400)] + [(1000, None), (1001, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r.asDict() for r in op7_pii(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        want, mine = brute(text or ""), got[i]
        listed = [f"{k}:{a}:{b}" for k in pii.BASE for a, b in want[k]]
        assert [mine[f"n_{k}"] for k in pii.BASE] == [len(want[k]) for k in pii.BASE]
        assert mine["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        spans = [x for x in mine["spans"].split(",") if x]
        assert [x for x in spans if x.split(":")[0] in pii.BASE] == listed
        order = [(pii.KINDS.index(x.split(":")[0]), int(x.split(":")[1])) for x in spans]
        assert order == sorted(order)
        assert ("account" in mine["spans"]) >= ("iban DE89 3704 0044 0532 0130 00" in (text or "").split(", "))
