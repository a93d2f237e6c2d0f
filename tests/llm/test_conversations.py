import hashlib
import random
import zlib
from functools import cache
from math import isqrt

import pytest

from pulsegrid.llm import conversations as cv
from pulsegrid.llm.queries import op12_conversations

WHITE = " \t\n\x0b\x0c\r"
THEN = {"": "u", "s": "u", "u": "a", "a": "u"}  # last role: the one that may follow


def marked(rows):
    """(turn, role, text, fault) in order, by the words of the contract."""
    out, seen = [], set()
    for turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        body = [c for c in text if c not in WHITE]
        wrong = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((turn, role, text, wrong))
    return out


def brute(rows):
    """Cheapest edits with the least letters, by trying every sequence of edits."""
    @cache
    def best(i, last, inserted):
        found = []
        if i == len(rows) and last in ("", "a"):
            found.append((0, "", ()))
        if inserted < 3:
            role = THEN[last]
            c, e, t = best(i, role, inserted + 1)
            found.append((c + 5, "I" + e, (("user:" if role == "u" else "assistant:"),) + t))
        if i < len(rows):
            _, role, text, wrong = rows[i]
            c, e, t = best(i + 1, last, 0)
            found.append((c + 2, "D" + e, t))
            if wrong not in ("blank", "duplicate"):
                extra = 5 if wrong else 0
                if role[:1] == THEN[last] or (role[:1] == "s" and last == ""):
                    c, e, t = best(i + 1, role[:1], 0)
                    found.append((c + extra, "K" + e, (f"{role}:{text}",) + t))
                new = THEN[last]
                c, e, t = best(i + 1, new, 0)
                found.append((c + extra + 1, "R" + e, ((f"user:{text}" if new == "u" else f"assistant:{text}"),) + t))
        return min(found, default=(10 ** 9, "", ()))
    return best(0, "", 0)


def summary(rows):
    rows = marked(rows)
    cost, audit, lines = brute(tuple(rows))
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{f: sum(r[3] == f for r in rows) for f in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }


def harmed(rows):
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: summary(r) for c, r in out.items()}


def some(rng, n, longest=7):
    roles, texts = ["user", "assistant", "system", "tool", "", "sys", None], ["a.", "b!", "c", "", " \n", "d?", "e ", None]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            rows.append((conv, rng.choice([turn, turn, turn + 2, None]), rng.choice(roles), rng.choice(texts)))
    return rows


def compared(spark, rows, tmp_path, schema="conv_id long, turn long, role string, text string"):
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "conversations.parquet"))
    got = op12_conversations(spark, str(tmp_path)).collect()
    want = harmed([r[:4] for r in rows])
    assert len(got) == len(want)
    for r in got:
        mine = r.asDict()
        assert {k: mine[k] for k in want[r["conv_id"]]} == want[r["conv_id"]], (r["conv_id"], mine)


def test_query_matches_brute_force(spark, tmp_path):
    compared(spark, some(random.Random(3), 400) + [(None, 1, "user", "x."), (None, 2, "assistant", "y."), (7000, None, None, None)], tmp_path)


def test_given_table(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    compared(spark, rows, tmp_path)


def test_segments_change_nothing(spark, tmp_path, monkeypatch):
    """Conversations cut into segments of a few rows, one of them a third of the table, with many equal rows."""
    rng = random.Random(11)
    roles, texts = ["user", "assistant", "system", "tool"], ["a.", "b!", "c", "", "d?", "e."]
    rows = [(1, t // 3, rng.choice(roles), rng.choice(texts)) for t in range(150)] + [(2, 5, "user", "same.")] * 60 + [(None, t, "user", f"{t}.") for t in range(40)]
    rows += [(c + 10, t, rng.choice(roles), rng.choice(texts)) for c in range(20) for t in range(5)]
    monkeypatch.setattr(cv, "SEGMENT_ROWS", 13)
    compared(spark, rows, tmp_path)


def test_only_checkpoints_are_stored(monkeypatch):
    """The walk asks for each vector twice at most and stores a square root of them."""
    calls = []
    plain = cv.before
    monkeypatch.setattr(cv, "before", lambda row, after: calls.append(1) or plain(row, after))
    rows = [("u", 0), ("a", 0)] * 5000
    assert "".join(x for x, _, _ in cv.walk(rows, 0, cv.END)) == "K" * 10_000
    assert len(calls) <= 2 * len(rows) and isqrt(len(rows)) == 100


def test_edge_rows(spark, tmp_path):
    assert cv.repaired(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    rows = [(1, 0, "user", "x" * 3_000_000 + ".", "k", 1), (1, 1, "assistant", "fine.", "k", 2), (2, 0, "assistant", "alone", None, 3)]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, edit string, _conv int")
    got = {r["conv_id"]: r for r in cv.summaries(cv.repaired(given)).collect()}
    assert (got[1]["audit"], got[1]["cost"]) == ("KK", 0) and (got[2]["audit"], got[2]["cost"]) == ("D", 2)
    named = spark.createDataFrame([("x", 1, "user", "a."), ("x", 2, "assistant", "b.")], "c string, t int, r string, x string")
    assert {r["edit"] for r in cv.repaired(named, "c", "t", "r", "x").collect()} == {"K"}


@pytest.mark.parametrize("seed", range(3))
def test_long_walks_match_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        rows = marked([(t, rng.choice(["user", "assistant", "system", "z"]), rng.choice(["a.", "b", "", "c?", f"{t}!"])) for t in range(rng.randrange(40))])
        cost, audit, _ = brute(tuple(rows))
        steps = list(cv.walk([cv.allowed(r[1], r[3]) for r in rows], 0, cv.END))
        state = steps[-1][2] if steps else 0
        assert "".join(x for x, _, _ in steps) + "I" * len(list(cv.closing(state))) == audit
