"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the places where personal data can be: at-signs,
plus signs, digits, schemes and identifier cues.  From each anchor a small
deterministic parser walks to both sides and validates what it has found.
Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "url", "account")
BASE = KINDS[:4]
DIGITS = frozenset(string.digits)
LABEL = frozenset(string.ascii_letters + string.digits + "-")
LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
DIALLED = frozenset(" ().-" + string.digits)
CODE = LABEL
AFTER_CUE = frozenset(" :#.=\t")
IN_URL = LOCAL | frozenset(":~!$&'()*,;=")
HOST = LABEL | {".", ":"}
#: Longest IBAN: 34 characters and a space after every fourth.
LONGEST_IBAN = 42
CUES = ("iban", "ssn", "passport", "account", "acct")
Span = tuple[int, int]


@cache
def automaton():
    """Anchors and what each stands for; cues are met in lower case."""
    import ahocorasick

    found = ahocorasick.Automaton()
    found.add_word("@", "@")
    found.add_word("+", "+")
    found.add_word("://", ":")
    for d in string.digits:
        found.add_word(d, "0")
    for cue in CUES:
        for word in (cue, cue.upper(), cue.capitalize()):
            found.add_word(word, "c")
    found.make_automaton()
    return found


def run(text: str, at: int, of: frozenset) -> int:
    """End of the run of characters ``of`` that begins at ``at``."""
    n = len(text)
    while at < n and text[at] in of:
        at += 1
    return at


def domain(text: str, at: int) -> int:
    """End of dotted labels at ``at``, two or more; -1 when there are none."""
    end = run(text, at, LABEL)
    if end == at:
        return -1
    labels = 1
    while end < len(text) and text[end] == "." and (after := run(text, end + 1, LABEL)) > end + 1:
        end, labels = after, labels + 1
    return end if labels > 1 else -1


def emails(text: str, signs: list[int]) -> Iterator[Span]:
    done = 0
    for at in signs:
        if at < done:
            continue
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (end := domain(text, at + 1)) > 0:
            yield start, end
            done = end


def ips(text: str, digits: list[int]) -> Iterator[Span]:
    done = 0
    for at in digits:
        if at < done:
            continue
        parts, end = [], at
        while True:
            after = run(text, end, DIGITS)
            parts.append(text[end:after])
            if len(parts) == 4 or after + 1 >= len(text) or text[after] != "." or text[after + 1] not in DIGITS:
                break
            end = after + 1
        done = after
        if len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts):
            yield at, after


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def cards(text: str, digits: list[int]) -> Iterator[Span]:
    done, n = 0, len(text)
    for at in digits:
        if at < done:
            continue
        end = at + 1
        while end < n:
            if text[end] in DIGITS:
                end += 1
            elif text[end] in " -" and end + 1 < n and text[end + 1] in DIGITS:
                end += 2
            else:
                break
        done = end
        own = "".join(c for c in text[at:end] if c in DIGITS) if end - at >= 16 else ""
        if 16 <= len(own) <= 19 and luhn(own):
            yield at, end


def phones(text: str, plus: list[int]) -> Iterator[Span]:
    done, n = 0, len(text)
    for at in plus:
        if at < done or at + 1 >= n or text[at + 1] not in DIGITS:
            continue
        end = run(text, at + 2, DIALLED)
        while end > at + 3 and text[end - 1] not in DIGITS:
            end -= 1
        if end <= at + 3 or text[end - 1] not in DIGITS:
            continue
        done = end
        if 8 <= sum(c in DIGITS for c in text[at + 1:end]) <= 15:
            yield at, end


def urls(text: str, colons: list[int]) -> Iterator[Span]:
    """Addresses that carry a user or a secret: scheme://user[:secret]@host."""
    done = 0
    for at in colons:
        start = at
        while start > done and text[start - 1] in string.ascii_letters:
            start -= 1
        sign = run(text, at + 3, IN_URL)
        if start == at or sign == at + 3 or sign >= len(text) or text[sign] != "@":
            continue
        end = run(text, sign + 1, HOST)
        if end > sign + 1:
            yield start, end
            done = end


def iban(text: str, at: int, beyond: int) -> int:
    """End, after ``beyond``, of the longest IBAN with a right check sum at ``at``,
    with or without spaces; 0 when there is none.  One walk of bounded length."""
    head, rest, best, n = [], 0, 0, 0
    for end in range(at, min(len(text), at + LONGEST_IBAN)):
        if text[end] == " ":
            continue
        if text[end] not in CODE or text[end] == "-" or n == 34:
            break
        digit, n = int(text[end], 36), n + 1
        if n <= 4:
            if (digit > 9) != (n <= 2):
                return 0
            head.append(digit)
            continue
        rest = (rest * (100 if digit > 9 else 10) + digit) % 97
        if n >= 15 and end >= beyond:
            total = rest
            for d in head:
                total = (total * (100 if d > 9 else 10) + d) % 97
            best = end + 1 if total == 1 else best
    return best


def accounts(text: str, cues: list[int]) -> Iterator[Span]:
    """Numbers that follow a cue: an IBAN with a right check sum, a social
    security number, or at least six letters and digits with four digits."""
    done = 0
    for cue in cues:  # the last character of the cue
        at = cue + 1
        if at < done or at >= len(text) or text[at] in CODE:
            continue
        at = run(text, at, AFTER_CUE)
        for word in ("number", "no"):
            if text[at:at + len(word)].lower() == word and at + len(word) < len(text) and text[at + len(word)] not in CODE:
                at = run(text, at + len(word), AFTER_CUE)
        end = run(text, at, CODE)
        best = iban(text, at, end)
        code = text[at:end].strip("-")
        if best:
            yield at, best
            done = best
        elif len(code) >= 6 and text[at:end] == code and sum(c in DIGITS for c in code) >= 4:
            yield at, end
            done = end


def found(text: str) -> dict[str, list[Span]]:
    """Spans of every kind in order of start."""
    at: dict[str, list[int]] = {"@": [], "+": [], "0": [], ":": [], "c": []}
    for end, kind in automaton().iter(text):
        at[kind].append(end - 2 if kind == ":" else end)
    return {
        "email": list(emails(text, at["@"])), "ip": list(ips(text, at["0"])), "card": list(cards(text, at["0"])),
        "phone": list(phones(text, at["+"])), "url": list(urls(text, at[":"])),
        "account": list(accounts(text, at["c"])),
    }


def masked(text: str, spans: dict[str, list[Span]]) -> str:
    """Each span replaced by its kind in angle brackets; of overlapping spans
    the one that starts first, then the longer one, names the place."""
    out, done = [], 0
    for start, end, kind in sorted(((s, e, k) for k, x in spans.items() for s, e in x), key=lambda x: (x[0], -x[1])):
        if start >= done:
            out += [text[done:start], f"<{kind}>"]
        done = max(done, end)
    return "".join([*out, text[done:]]) if done else text


SPAN = "struct<kind: string, start: long, stop: long>"


def personal_data(df: DataFrame, text_col: str = "text", spans_col: str = "pii", mask: bool = False) -> DataFrame:
    """``df`` with ``spans_col``, an array of (kind, start, stop) ordered by kind
    as in ``KINDS`` and then start; with ``mask`` the text has its spans
    replaced by their kinds.

    A null text has no spans and stays null; an empty text has none; repeated
    rows are treated alike; a column already named ``spans_col`` is replaced,
    all others pass through; an empty table stays empty.  Spans of different
    kinds may overlap."""
    rows = df.drop(spans_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            texts = batch.column(k).to_pylist()
            all_spans = [found(t) if t else {} for t in texts]
            columns = list(batch.columns)
            if mask:
                columns[k] = pa.array([t and masked(t, s) for t, s in zip(texts, all_spans)], batch.schema.field(k).type)
            spans = [[{"kind": name, "start": a, "stop": b} for name, x in s.items() for a, b in x] for s in all_spans]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, kind)], [*batch.schema.names, spans_col])

    if any(f.dataType.typeName() == "void" for f in rows.schema.fields):
        rows = rows.select(*[F.col(c).cast("string") if t == "void" else F.col(c) for c, t in rows.dtypes])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(scan, f"{fields}, `{spans_col}` array<{SPAN}>")
