"""Encoding and decoding of whole text columns with the automaton of ``bpe``.

The driver reads the vocabulary file and broadcasts it; its size is that of the
file, whatever the data.  Inside a task each distinct unit of text is encoded
once and remembered in bounded memory.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pulsegrid.llm.bpe import Automaton, Encoder, Pieces, gather, read_vocabulary, specials
from pulsegrid.llm.words import WHITE, chunks, flat, held, lists

# White space beyond ASCII, and the two ways in which the public
# vocabularies split text before merging.
WIDE = "\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = rf"[\t-\r {WIDE}]"
BYTE_SPLIT = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^\t-\r {WIDE}\p{{L}}\p{{N}}]+"
              rf"|{SPACE}+(?=\Z|{SPACE})|{SPACE}+")
WORD_SPLIT = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^\t-\r {WIDE}\p{{L}}\p{{N}}]+"


def folded(text: str) -> str:
    """Composed and lower-cased character by character."""
    if text.isascii():
        return text.lower()
    return "".join(c.lower() for c in unicodedata.normalize("NFC", text))


def cutter(special: dict[str, int], words: bool) -> Pieces:
    """Splits a unit as the vocabulary wants it: bytes with their spaces, or
    lower-case words without."""
    import regex

    every = regex.compile(WORD_SPLIT if words else BYTE_SPLIT).findall
    marks = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
    fold = folded if words else str

    def cut(unit: str) -> list:
        if marks is None or "<" not in unit and not marks.search(unit):
            return every(fold(unit))
        return [x for k, part in enumerate(marks.split(unit)) for x in ([special[part]] if k % 2 else every(fold(part)))]

    return cut


def units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that can be split alone: bytes, offsets, and the first of each text.

    A unit is white space and the characters after it, so that the last space
    can belong to a word; texts with other than ASCII space stay whole."""
    import regex

    data, off = flat(texts)
    white = WHITE[data]
    begins = white.copy()
    begins[1:] &= ~white[:-1]
    full = np.diff(off) > 0
    begins[off[:-1][full]] = True
    wide = regex.compile(f"[{WIDE}]")
    for i, t in enumerate(texts.to_pylist()):
        if not t.isascii() and wide.search(t):
            begins[off[i] + 1:off[i + 1]] = False
    start = np.flatnonzero(begins)
    return data, np.concatenate((start, [len(data)])).astype(np.int64), np.searchsorted(start, off)


class Tokenizer:
    """What a task needs of a vocabulary; pickled as the parsed file."""

    def __init__(self, vocabulary: dict) -> None:
        self.words = bool(vocabulary["model"].get("end_of_word_suffix"))
        self.special = specials(vocabulary)
        automaton = Automaton(vocabulary["model"])
        self.encoder = Encoder(automaton, cutter(self.special, self.words))
        labels = automaton.labels + [b""] * (1 + max(self.special.values(), default=0) - len(automaton.labels))
        for content, i in self.special.items():
            labels[i] = content.encode()
        sizes = np.fromiter(map(len, labels), np.int64, len(labels))
        self.label_ends = np.concatenate(([0], np.cumsum(sizes)))
        self.label_bytes = np.frombuffer(b"".join(labels), np.uint8)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column without nulls, and offsets."""
        data, offsets, first = units(texts)
        ids, at = self.encoder.encode(data, offsets)
        return ids, at[first]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The labels of each row joined; broken characters are replaced."""
        body, at = gather(self.label_bytes, self.label_ends, ids)
        raw = body.tobytes()
        ends = at[offsets]
        return [raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(ends.tolist(), ends[1:].tolist())]


class Shipped:
    """A broadcast vocabulary; a Python worker builds its tokenizer once."""

    def __init__(self, df: DataFrame, path: str) -> None:
        self.path = path
        self.vocabulary = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def tokenizer(self) -> Tokenizer:
        return held(("tokenizer", self.path), lambda: Tokenizer(self.vocabulary.value))


def _fields(df: DataFrame, without: str) -> tuple[DataFrame, str]:
    kept = df.drop(*without.split())
    return kept, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``df`` with ``ids_col``, the token ids of ``text_col``.

    Null and empty texts have no ids; rows are treated one by one, so repeated
    rows stay; a column already named ``ids_col`` is replaced, others pass
    through; an empty table stays empty."""
    rows, fields = _fields(df, ids_col)
    shipped = Shipped(df, path)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.tokenizer()
        for batch in batches:
            for part, texts in chunks(batch, text_col):
                ids, at = own.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, lists(ids, np.diff(at), pa.int32())], [*part.schema.names, ids_col])

    return rows.mapInArrow(scan, f"{fields}, `{ids_col}` array<int>")


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``df`` with ``text_col``, the labels of ``ids_col`` joined.  Null ids give
    an empty text; a column already named ``text_col`` is replaced."""
    rows, fields = _fields(df, text_col)
    shipped = Shipped(df, path)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.tokenizer()
        for batch in batches:
            ids = [np.array(x if x is not None else [], np.int64)
                   for x in batch.column(batch.schema.get_field_index(ids_col)).to_pylist()]
            at = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64)
            texts = own.decode(np.concatenate(ids) if ids else np.zeros(0, np.int64), at)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([t.decode() for t in texts], pa.string())], [*batch.schema.names, text_col])

    return rows.mapInArrow(scan, f"{fields}, `{text_col}` string")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``id_col``, ``n_tokens``, ``ids_sha256`` over the ids as unsigned
    32-bit little-endian integers, and ``decoded_sha256`` over the text decoded
    from them.  Null text counts as empty; other columns are not read."""
    rows = df.select(id_col, text_col)
    shipped = Shipped(df, path)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.tokenizer()
        for batch in batches:
            for part, texts in chunks(batch, text_col):
                ids, at = own.encode(texts)
                raw = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(np.diff(at), pa.int64()),
                    pa.array([hashlib.sha256(raw[4 * a:4 * b]).hexdigest() for a, b in zip(at.tolist(), at[1:].tolist())], pa.string()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in own.decode(ids, at)], pa.string()),
                ], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(scan, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
