"""Byte-pair encoding by a tokenization automaton.

The merges are compiled one after the other.  A merge (u, v) -> uv does two things
to the automaton whose arcs are tokens: the state entered by u becomes a copy
without the arc v, and wherever an arc u leaves, an arc uv is added that enters
the state of v.  So a state belongs to the token that entered it; it inherits the
arcs that its right part had lost when it was made, and an arc uv is there if u
was when uv was made.  What is kept is one rank per merge and the two parts of
each token; arcs are worked out from these once and then read from a table.

Any byte string has exactly one path through the automaton, and the path of a
prefix is a prefix of paths, so encoding goes from left to right: from the
state of each position, tokens of a trie that are arcs of the state lead on.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa

from pulsegrid.llm.words import BYTE_POWERS, WORD_POWERS, mix, rolled

NEVER = 1 << 30
END = "</w>"


class Table:
    """Open-addressed map from int64 keys to int32 values over arrays."""

    def __init__(self, bits: int) -> None:
        self.bits, self.used = bits, 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Values, -1 where a key is missing."""
        at = self._slot(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.values[at], -1).astype(np.int32)
        open_ = np.flatnonzero((there != keys) & (there != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            there = self.keys[at[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Put distinct new keys in."""
        self.used += len(keys)
        if self.used * 2 > len(self.keys):
            old = self.keys != -1
            bigger = Table(max(self.bits + 1, int(self.used * 2 - 1).bit_length()))
            bigger.add(self.keys[old], self.values[old])
            bigger.used = self.used
            self.bits, self.keys, self.values = bigger.bits, bigger.keys, bigger.values
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]  # of several for one slot, one stays
            won = self.keys[at] == keys
            self.values[at[won]] = values[won]
            keys, values, at = keys[~won], values[~won], (at[~won] + 1) & ((1 << self.bits) - 1)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files:
    printable Latin-1 bytes stand for themselves, the others follow from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Automaton:
    """States and arcs of a vocabulary file; ids are those of the file."""

    ARCS = 1 << 20

    def __init__(self, model: dict) -> None:
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        alphabet = byte_alphabet()
        size = max(vocab.values()) + 1
        self.left, self.right = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        self.rank = np.full(size, -1, np.int32)
        self.length = np.zeros(size, np.int32)
        self.labels: list[bytes] = [b""] * size
        symbols: dict[int, list[int]] = {}
        for token, i in vocab.items():
            ends = bool(suffix) and token.endswith(suffix)
            body = token[:len(token) - len(suffix)] if ends else token
            if not all(c in alphabet for c in body):
                continue
            own = [alphabet[c] for c in body]
            self.labels[i] = bytes(own)
            self.length[i] = len(own)
            if ends:
                own[-1] += 256
            symbols[i] = own
        made = np.full((len(pairs), 2), -1, np.int64)
        for k, (u, v) in enumerate(pairs):  # the gadget of one merge
            a, b, ab = vocab[u], vocab[v], vocab[u + v]
            self.left[ab], self.right[ab], self.rank[ab] = a, b, k
            made[k] = a, b
        self.blocks = Table(int(2 * len(pairs) + 2).bit_length())
        self.blocks.add(made[:, 0] << 20 | made[:, 1], np.arange(len(pairs), dtype=np.int32))
        self.ends = bool(suffix)
        self._trie(symbols)
        self.arcs = Table(16)

    def _trie(self, symbols: dict[int, list[int]]) -> None:
        edges: dict[int, int] = {}
        token = [-1]
        for i, own in symbols.items():
            if len(own) > 1 and self.rank[i] < 0 or not own:
                continue  # no merge makes it
            node = 0
            for s in own:
                key = node << 9 | s
                if key not in edges:
                    edges[key] = len(token)
                    token.append(-1)
                node = edges[key]
            token[node] = i
        self.token = np.array(token, np.int32)
        self.trie = Table(int(2 * len(edges) + 2).bit_length())
        self.trie.add(np.fromiter(edges.keys(), np.int64), np.fromiter(edges.values(), np.int32))

    def derived(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether the state has the arc, from the merges."""
        ok = np.ones(len(state), bool)
        a, cut_a, rows = state.copy(), np.full(len(state), NEVER), np.arange(len(state))
        while len(rows):
            b, cut_b, inner = token[rows], np.full(len(rows), NEVER), np.arange(len(rows))
            while len(inner):
                k = self.blocks.find(a[inner].astype(np.int64) << 20 | b)
                ok[rows[inner[(k >= 0) & (k < cut_a[inner]) & (k <= cut_b)]]] = False
                more = (self.left[b] >= 0) & ok[rows[inner]]
                inner, b = inner[more], b[more]
                cut_b, b = self.rank[b], self.left[b]
            more = (self.right[a] >= 0) & ok[rows]
            rows, a = rows[more], a[more]
            cut_a, a = self.rank[a], self.right[a]
        return ok

    def allowed(self, state: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The same, read from the table of arcs met before."""
        keys = state.astype(np.int64) << 20 | token
        known = self.arcs.find(keys)
        new = np.unique(keys[known < 0])
        if len(new):
            if self.arcs.used + len(new) > self.ARCS:
                self.arcs = Table(16)
            value = self.derived((new >> 20).astype(np.int32), (new & 0xFFFFF).astype(np.int32))
            self.arcs.add(new, value.astype(np.int32))
            known[known < 0] = value[np.searchsorted(new, keys[known < 0])]
        return known > 0

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-split words given as bytes and offsets; ids and offsets."""
        sizes = np.diff(offsets)
        symbols = data.astype(np.int64)
        if self.ends:
            symbols[offsets[1:][sizes > 0] - 1] += 256
        base = offsets[:-1] + np.arange(len(sizes))  # of the positions of each word, one more than bytes
        last = np.full(len(data) + len(sizes), -1, np.int32)
        order = np.argsort(-sizes, kind="stable")
        long = sizes[order]
        for j in range(int(sizes.max(initial=0))):
            rows = order[:np.searchsorted(-long, -j, "left")]  # longer than j
            state, node = last[base[rows] + j], np.zeros(len(rows), np.int64)
            at = offsets[rows] + j
            step = 0
            while len(rows):
                inside = at + step < offsets[rows + 1]
                rows, state, node, at = rows[inside], state[inside], node[inside], at[inside]
                node = self.trie.find(node << 9 | symbols[at + step]).astype(np.int64)
                live = node >= 0
                rows, state, node, at = rows[live], state[live], node[live], at[live]
                token = self.token[node]
                full = np.flatnonzero(token >= 0)
                if j:
                    full = full[self.allowed(state[full], token[full])]
                step += 1
                last[base[rows[full]] + j + step] = token[full]
        mark = np.zeros(len(last), bool)
        rows, at = np.flatnonzero(sizes > 0), sizes[sizes > 0]
        while len(rows):
            place = base[rows] + at
            mark[place] = True
            at = at - self.length[last[place]]
            rows, at = rows[at > 0], at[at > 0]
        counts = np.concatenate(([0], np.cumsum(mark)))[np.concatenate((base, [len(last)]))]
        return last[mark], counts


def gather(values: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenation of the slices ``index``, and its offsets."""
    sizes = (offsets[1:] - offsets[:-1])[index]
    ends = np.zeros(len(index) + 1, np.int64)
    np.cumsum(sizes, out=ends[1:])
    return values[np.repeat(offsets[index] - ends[:-1], sizes) + np.arange(ends[-1])], ends


Pieces = Callable[[str], list]


class Encoder:
    """Ids of units, which are spans of text that the pre-split treats alone.

    ``pieces`` cuts a unit into strings to encode and ids of special tokens.  Units
    met before are remembered by 128 bits of hash, up to ``KEEP`` of them."""

    KEEP, AT_ONCE = 1_000_000, 1 << 15

    def __init__(self, automaton: Automaton, pieces: Pieces) -> None:
        self.automaton, self.pieces = automaton, pieces
        self._forget()

    def _forget(self) -> None:
        self.place, self.check = Table(16), np.zeros(0, np.uint64)
        self.ids, self.offsets = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def _coded(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        cut = [self.pieces(u.decode()) for u in units]
        counts = np.fromiter(map(len, cut), np.int64, len(cut))
        parts = pa.array([p.encode() if isinstance(p, str) else b"" for c in cut for p in c], pa.large_binary())
        special = np.fromiter((-1 if isinstance(p, str) else p for c in cut for p in c), np.int64, len(parts))
        coded = parts.dictionary_encode()
        words = coded.dictionary
        _, off, data = words.buffers()
        off = np.frombuffer(off, np.int64)[words.offset:words.offset + len(words) + 1]
        body = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
        ids, at = self.automaton.encode(body, off - off[0])
        index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if (special >= 0).any():  # special ids stand behind those of the words
            own = np.unique(special[special >= 0])
            index[special >= 0] = len(words) + np.searchsorted(own, special[special >= 0])
            ids, at = np.concatenate((ids, own)), np.concatenate((at, at[-1] + 1 + np.arange(len(own))))
        flat, ends = gather(ids, at, index)
        return flat.astype(np.int32), ends[np.concatenate(([0], np.cumsum(counts)))]

    def _learn(self, units: list[bytes]) -> None:
        ids, offsets = [self.ids], [self.offsets]
        for a in range(0, len(units), self.AT_ONCE):
            flat, bounds = self._coded(units[a:a + self.AT_ONCE])
            ids.append(flat)
            offsets.append(offsets[-1][-1] + bounds[1:])
        self.ids, self.offsets = np.concatenate(ids), np.concatenate(offsets)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and offsets of units that lie one after the other in ``data``."""
        values = data.astype(np.uint64) + np.uint64(1)
        start, end = offsets[:-1], offsets[1:]
        size = (end - start).astype(np.uint64)
        one = mix(rolled(values, start, end, BYTE_POWERS) + size)
        two = mix(rolled(values, start, end, WORD_POWERS) ^ size)
        key = (one >> np.uint64(1)).astype(np.int64)
        if len(self.check) > self.KEEP:
            self._forget()
        at = self.place.find(key).astype(np.int64)
        known = at >= 0
        known[known] = self.check[at[known]] == two[known]
        new = np.flatnonzero(~known)
        if len(new):
            order = new[np.lexsort((two[new], key[new]))]
            first = np.ones(len(order), bool)
            first[1:] = (key[order][1:] != key[order][:-1]) | (two[order][1:] != two[order][:-1])
            at[order] = len(self.check) + np.cumsum(first) - 1
            lone = order[first]
            raw = data.tobytes()
            self._learn([raw[a:b] for a, b in zip(start[lone].tolist(), end[lone].tolist())])
            self.check = np.concatenate((self.check, two[lone]))
            free = np.ones(len(lone), bool)
            free[1:] = key[lone][1:] != key[lone][:-1]
            free &= self.place.find(key[lone]) < 0  # of units that share a key one is found again
            self.place.add(key[lone[free]], at[lone[free]].astype(np.int32))
        return gather(self.ids, self.offsets, at)


def read_vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def specials(vocabulary: dict) -> dict[str, int]:
    return {t["content"]: t["id"] for t in vocabulary["added_tokens"]}
