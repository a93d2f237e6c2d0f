"""Toxicity by a support vector machine over a subsequence string kernel.

Two strings are alike as far as they share subsequences of three characters,
where gaps cost a factor per character, so an insult with inserted or missing
characters is still close to itself.  Nyström landmarks, words that set labelled
toxic sentences apart and common clean ones, turn the kernel into a short vector:
a sentence has, for each landmark, the best match among its words, and a text the
best among its sentences.  Words are also read in the parts between signs and
without signs; strings of more than twice a landmark's length are compared with it
window by window.  Values are exact for every pair: few triples of characters occur
in landmarks, and a string is compared with all landmarks through these at once.  The vectors are whitened by the landmarks' own kernel
matrix, a linear machine with squared hinge loss separates them, and a logistic
curve turns margins into scores.

Only the fit sees labels.  It uses a bounded sample of labelled rows and leaves
its parameters, a few hundred numbers; scoring covers all rows in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.words import Words, chunks, held, split

ORDER, DECAY = 3, 0.6
LANDMARKS, CLEAN_LANDMARKS, SAMPLE = 128, 16, 6000
LONGEST = 32


def padded(words: list[bytes], fill: int) -> np.ndarray:
    width = max(map(len, words), default=1)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    out = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width).astype(np.int16)
    out[np.arange(width) >= sizes[:, None]] = fill
    return out


def raw_kernel(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Gap-weighted subsequence kernel of rows of two padded arrays."""
    m = t.shape[1]
    gap = np.triu(DECAY ** np.maximum(0, np.arange(m)[None, :] - np.arange(m)[:, None])).astype(np.float32)
    inner = np.ones((s.shape[1] + 1, len(s), m + 1), np.float32)  # by prefix of s
    for _ in range(ORDER - 1):
        after = np.zeros_like(inner)
        for j in range(1, s.shape[1] + 1):
            same = (s[:, j - 1, None] == t) * np.float32(DECAY ** 2)
            after[j] = DECAY * after[j - 1]
            after[j, :, 1:] += (same * inner[j - 1, :, :-1]) @ gap
        inner = after
    total = np.zeros(len(s))
    for j in range(1, s.shape[1] + 1):
        total += ((s[:, j - 1, None] == t) * DECAY ** 2 * inner[j - 1, :, :-1]).sum(1)
    return total


def self_kernel(words: list[bytes]) -> np.ndarray:
    s = padded(words, -1)
    return raw_kernel(s, np.where(s < 0, -2, s).astype(np.int16))


def kernel(left: list[bytes], right: list[bytes], own_left: np.ndarray | None = None, own_right: np.ndarray | None = None) -> np.ndarray:
    """Normalised kernel of pairs; 0 where a string is too short to have any."""
    if not left:
        return np.zeros(0)
    own = np.sqrt((self_kernel(left) if own_left is None else own_left) * (self_kernel(right) if own_right is None else own_right))
    return np.where(own > 0, raw_kernel(padded(left, -1), padded(right, -2)) / np.where(own > 0, own, 1), 0)


SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789"


APART = bytes(32 if b in SIGNS else b for b in range(256))


def bare(word: bytes) -> bytes:
    return word.strip(SIGNS)


def candidates(w: Words) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct strings to compare, and (string, text) of each occurrence.  Words
    with signs inside are also read part by part and without the signs, runs of
    single characters as one word."""
    coded = w.array().dictionary_encode()
    words, index = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = w.row()
    place: dict[bytes, int] = {}

    def put(x: bytes) -> int:
        return place.setdefault(x, len(place))

    own = np.full(len(words), -1)
    long: dict[int, list[int]] = {}
    for i, x in enumerate(words):
        if x.isalpha():
            if len(x) >= ORDER:
                own[i] = place.setdefault(x, len(place))
            continue
        x = bare(x)
        if len(x) >= ORDER:
            own[i] = place.setdefault(x, len(place))
        if not x.isalpha() and len(inner := x.translate(None, SIGNS)) < len(x):
            parts = {*x.translate(APART).split(), inner}
            long[i] = [put(y) for y in sorted(parts) if len(y) >= ORDER]
    which, where = own[index], row
    if long:
        at = np.flatnonzero(np.isin(index, list(long)))
        more = [(p, row[k]) for k in at.tolist() for p in long[int(index[k])]]
        which = np.concatenate((which, [p for p, _ in more]))
        where = np.concatenate((where, [r for _, r in more]))
    single = (w.end - w.start == 1).astype(np.int8)
    edge = np.flatnonzero(np.diff(np.concatenate(([0], single, [0]))))
    spaced = [(a, b) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()) if b - a >= ORDER]
    extra = []
    for a, b in spaced:
        for r in np.unique(row[a:b]).tolist():
            x, y = max(a, int(w.first[r])), min(b, int(w.first[r + 1]))
            run = w.data[w.start[x:y]].tobytes()
            extra += [(put(run), r)] if len(run) >= ORDER else []
    if extra:
        which = np.concatenate((which, [p for p, _ in extra]))
        where = np.concatenate((where, [r for _, r in extra]))
    kept = which >= 0
    return list(place), which[kept], where[kept]


def named(strings: list[bytes], which: np.ndarray, where: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Candidates that may be landmarks.  Strings too long for one stand for their
    pieces of two to four characters, where these have more than one byte each."""
    place: dict[bytes, int] = {}
    own: list[list[int]] = []
    for x in strings:
        pieces = {x} if len(x) <= LONGEST else set()
        if len(x) > LONGEST and max(x) > 127:
            y = x.decode("utf-8", "replace")
            pieces = {y[i:i + n].encode() for n in (2, 3, 4) for i in range(len(y) - n + 1) if min(y[i:i + n]) > "\x7f"}
        own.append([place.setdefault(p, len(place)) for p in sorted(pieces)])
    sizes = np.array([len(x) for x in own], np.int64)[which]
    return list(place), np.array([p for i in which.tolist() for p in own[i]], np.int64), np.repeat(where, sizes)


@cache
def triples(n: int) -> tuple[np.ndarray, ...]:
    """Pairs (i, j) of places among ``n`` characters; and of all subsequences of three
    the pair of the first two, the last place, and the weight."""
    i, j = np.triu_indices(n, 1)
    pair = {ij: at for at, ij in enumerate(zip(i.tolist(), j.tolist()))}
    all_three = list(combinations(range(n), ORDER))
    two = np.array([pair[x[0], x[1]] for x in all_three], np.int64)
    first, last = (np.array([x[at] for x in all_three], np.int64) for at in (0, 2))
    return i, j, two, last, DECAY ** (last - first + 1.0)


def own_kernels(s: np.ndarray, places: tuple[np.ndarray, ...]) -> np.ndarray:
    """Kernel with itself of each row of strings of one length."""
    weight = places[-1]
    out = np.full(len(s), weight @ weight)
    again = np.zeros(len(s), bool)
    for gap in range(1, s.shape[1]):
        again |= (s[:, gap:] == s[:, :-gap]).any(1)
    if again.any():  # characters that repeat may give one subsequence several times
        x = s[again].astype(np.int16)
        out[again] = raw_kernel(x, x)
    return out


class Triples:
    """Landmarks by the subsequences of three characters that they have."""

    def __init__(self, landmarks: list[bytes]) -> None:
        alphabet = sorted(set(b"".join(landmarks)))
        self.n, self.letter = len(alphabet) + 1, np.zeros(256, np.int32)
        self.letter[alphabet] = np.arange(1, self.n)
        self.table = np.zeros(self.n ** 3, np.int32)  # 0: in no landmark
        values: list[dict[int, float]] = []
        for x in landmarks:
            places = triples(len(x))
            c, sums = self.codes(np.frombuffer(x, np.uint8)[None], places)[0], {}
            for code, w in zip(c.tolist(), places[-1].tolist()):
                sums[code] = sums.get(code, 0.0) + w
            values.append(sums)
        codes = sorted(set().union(*values))
        self.table[codes] = np.arange(1, len(codes) + 1)
        # Few landmarks share a triple: of each the first of its entries, and how many.
        place = {code: at for at, code in enumerate(codes)}
        entries = []
        for at, sums in enumerate(values):
            own = sum(v * v for v in sums.values()) ** 0.5
            entries += [(place[code], at, v / own) for code, v in sums.items()]
        entries.sort()
        self.count = np.bincount([e[0] for e in entries], minlength=len(codes))
        self.first = np.cumsum(self.count) - self.count
        self.landmark, self.value = np.array([e[1] for e in entries], np.int64), np.array([e[2] for e in entries])
        self.size = len(landmarks)

    def codes(self, s: np.ndarray, places: tuple[np.ndarray, ...]) -> np.ndarray:
        i, j, two, last, _ = places
        x = self.letter[s]
        pair = (np.take(x, i, 1) * self.n + np.take(x, j, 1)) * self.n
        return np.take(pair, two, 1) + np.take(x, last, 1)

    def of(self, s: np.ndarray) -> np.ndarray:
        """Normalised kernels of the rows of strings of one length with all landmarks."""
        out = np.zeros((len(s), self.size), np.float32)
        places = triples(s.shape[1])
        weight = places[-1]
        piece = max(1, (1 << 19) // max(1, len(weight)))
        for a in range(0, len(s), piece):
            x = s[a:a + piece]
            f = self.table[self.codes(x, places)]
            row, t = np.nonzero(f)
            code = f[row, t] - 1
            times = self.count[code]
            entry = np.repeat(self.first[code] - (np.cumsum(times) - times), times) + np.arange(times.sum())
            slot = np.repeat(row * self.size, times) + self.landmark[entry]
            found = np.bincount(slot, np.repeat(weight[t], times) * self.value[entry], minlength=len(x) * self.size).reshape(len(x), -1)
            rows = np.flatnonzero(np.bincount(row, minlength=len(x)))
            out[a + rows] = found[rows] / np.sqrt(own_kernels(x[rows], places))[:, None]
        return out


def distinct(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of bytes, and which of them each row is."""
    n, width = windows.shape
    if width > 8:
        kinds, back = np.unique(windows.view(f"V{width}").reshape(-1), return_inverse=True)
        return kinds.view(np.uint8).reshape(-1, width), back
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :width] = windows
    kinds, back = np.unique(wide.view(np.uint64).reshape(-1), return_inverse=True)
    return kinds.view(np.uint8).reshape(-1, 8)[:, :width], back


class Matcher:
    """Matches of strings with landmarks.  The first ``KEEP`` strings that a Python
    worker meets, and with them nearly all common ones, are compared once."""

    KEEP = 120_000

    def __init__(self, landmarks: list[bytes]) -> None:
        self.landmarks, self.all = landmarks, Triples(landmarks)
        sizes = np.array([len(x) for x in landmarks])
        self.by_size = [(n, np.flatnonzero(sizes == n), Triples([x for x in landmarks if len(x) == n])) for n in sorted(set(sizes.tolist()))]
        self.known: dict[bytes, int] = {}  # row in values
        self.values = np.empty((self.KEEP, len(landmarks)), np.float32)  # memory comes with use

    def _windows(self, out: np.ndarray, every: np.ndarray, strings: np.ndarray, n: int) -> None:
        """Best match of windows of strings, the rows of ``strings``: of a landmark's
        length at every place, and of twice that, which holds one with characters
        put in, at every half."""
        for size, at, some in self.by_size:
            if 2 * size >= n:
                break
            where, data = every, strings
            if n <= LONGEST:  # what the whole string shares nothing with, no part of it does
                near = (out[every[:, None], at] > 0).any(1)
                where, data = every[near], np.ascontiguousarray(strings[near])
                if not len(where):
                    continue
            for width, stride in ((size, 1), (2 * size, max(1, size // 2))):
                starts = np.unique(np.append(np.arange(0, n - width + 1, stride), n - width))
                # A slice of windows at a time, of many strings or of a long one.
                each = max(1, (1 << 16) // len(data))
                for a in range(0, len(starts), each):
                    own = np.lib.stride_tricks.sliding_window_view(data, width, axis=1)[:, starts[a:a + each]]
                    flat = np.ascontiguousarray(own).reshape(-1, width)
                    kinds, back = distinct(flat)
                    value = some.of(kinds)
                    for k, column in enumerate(at.tolist()):
                        best = value[:, k][back].reshape(len(data), -1).max(1)
                        out[where, column] = np.maximum(out[where, column], best)

    def compared(self, strings: list[bytes]) -> np.ndarray:
        """Kernels of strings of at least three characters with all landmarks."""
        out = np.zeros((len(strings), len(self.landmarks)), np.float32)
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        for n in np.unique(sizes).tolist():
            every = np.flatnonzero(sizes == n)
            for a in range(0, len(every), 4096):
                where = every[a:a + 4096]
                data = np.frombuffer(b"".join(strings[i] for i in where.tolist()), np.uint8).reshape(-1, n)
                whole = self.all.of(data) if n <= LONGEST else None
                if whole is not None:
                    out[where] = whole
                self._windows(out, where, data, n)
        return out

    def table(self, strings: list[bytes]) -> np.ndarray:
        """Kernels of all strings with all landmarks."""
        place = np.array([self.known.get(x, -1) for x in strings], np.int64)
        new = np.flatnonzero(place < 0)
        out = np.empty((len(strings), len(self.landmarks)), np.float32)
        old = place >= 0
        out[old] = self.values[place[old]]
        if len(new):
            some = [strings[i] for i in new.tolist()]
            value = self.compared(some)
            out[new] = value
            kept = [i for i, x in enumerate(some) if len(x) <= LONGEST][:max(0, self.KEEP - len(self.known))]
            at = len(self.known)
            self.values[at:at + len(kept)] = value[kept]
            self.known.update(zip([some[i] for i in kept], range(at, at + len(kept))))
        return out


def matcher(landmarks: tuple[bytes, ...]) -> Matcher:
    return held(("matcher", landmarks), lambda: Matcher(list(landmarks)))


def features(texts: pa.Array, landmarks: list[bytes]) -> np.ndarray:
    """Best match of every text of a column without nulls with each landmark."""
    out = np.zeros((len(texts), len(landmarks)), np.float32)
    strings, which, where = candidates(split(texts, lowered=True))
    if not strings:
        return out
    table = matcher(tuple(landmarks)).table(strings)
    pairs = np.unique(where * len(strings) + which)
    for a in range(0, len(pairs), 1 << 15):
        text, string = np.divmod(pairs[a:a + (1 << 15)], len(strings))
        first = np.flatnonzero(np.concatenate(([True], np.diff(text) > 0)))
        own = text[first]
        out[own] = np.maximum(out[own], np.maximum.reduceat(table[string], first, axis=0))
    return out


POWERS = (2, 16)


def expanded(x: np.ndarray, whiten: list[np.ndarray]) -> np.ndarray:
    """Whitened matches under the kernel's powers: a low one keeps distant
    relatives of a landmark, a high one little but itself."""
    return np.hstack([x.astype(np.float64) ** p @ w for p, w in zip(POWERS, whiten)])


@dataclass
class Model:
    """Everything that scoring needs."""
    landmarks: list[bytes]
    whiten: list[np.ndarray]
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = expanded(x, self.whiten) @ self.weights + self.bias if self.landmarks else np.zeros(len(x))
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def chosen(rows: list[tuple[str, int, int]], toxic: int, clean: int) -> list[bytes]:
    """Landmarks from words with their numbers of toxic and clean rows: those
    that set toxic rows apart most, then the commonest of the others."""
    def weight(a: int, b: int) -> float:  # log-likelihood ratio, 0 for clean words
        p, q = a / toxic, b / clean
        if p <= q:
            return 0.0
        r = (a + b) / (toxic + clean)
        return sum(n * np.log(n / (m * r)) for n, m in ((a, toxic), (b, clean)) if n)

    ranked = sorted(((weight(a, b), w) for w, a, b in rows), key=lambda x: (-x[0], x[1]))
    picked: list[bytes] = []
    for value, w in ranked:
        x = bare(w.encode())
        if value < 6 or len(picked) == LANDMARKS:
            break
        if ORDER <= len(x) <= LONGEST and (not picked or kernel([x] * len(picked), picked).max() < 0.95):
            picked.append(x)
    if picked:
        common = sorted(((b, w) for w, a, b in rows if a * clean <= b * toxic), key=lambda x: (-x[0], x[1]))
        picked += [x for x in dict.fromkeys(bare(w.encode()) for _, w in common) if ORDER <= len(x) <= LONGEST][:CLEAN_LANDMARKS]
    return picked


def separated(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss by Newton steps, classes balanced."""
    z = np.hstack((x, np.ones((len(x), 1))))
    sign, weight = np.where(y, 1.0, -1.0), np.where(y, 0.5 / max(1, y.sum()), 0.5 / max(1, (~y).sum()))
    w = np.zeros(z.shape[1])
    keep = np.full(z.shape[1], ridge)
    keep[-1] = 1e-9
    loss = lambda v: float(keep @ (v * v) + weight @ np.maximum(0, 1 - sign * (z @ v)) ** 2)
    for _ in range(rounds):
        slack = np.maximum(0, 1 - sign * (z @ w))
        grad = keep * w - z.T @ (weight * sign * slack)
        on = slack > 0
        step = np.linalg.solve(np.diag(keep) + (z[on] * weight[on, None]).T @ z[on] + 1e-9 * np.eye(len(w)), grad)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def calibrated(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve over margins; targets are drawn in as if each class had
    one more row of the other."""
    target = np.where(y, (y.sum() + 1) / (y.sum() + 2), 1 / ((~y).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, h = p - target, np.maximum(p * (1 - p), 1e-9)
        hess = np.array([[h @ (margin * margin) + 1e-6, h @ margin], [h @ margin, h.sum() + 1e-6]])
        step = np.linalg.solve(hess, [g @ margin, g.sum()])
        step *= min(1.0, 2 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample: int = SAMPLE) -> Model:
    """Learn from at most ``sample`` toxic and as many clean labelled rows, those
    whose ids have the least hash.  Rows without a label or text teach nothing;
    without rows of both kinds the score is a constant below one half."""
    known = labels.select(F.col(id_col).alias("id"), (F.col(label_col) == 1).alias("toxic")).filter("id is not null and toxic is not null")
    known = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.col("id").cast("string"), F.lit("sample"))
    own = known.filter("toxic").orderBy(order, "id").limit(sample).union(known.filter("not toxic").orderBy(order, "id").limit(sample))
    # At most twice the sample of (id, label) pairs, hence a bounded broadcast.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null").join(F.broadcast(own), "id").select("text", "toxic")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, "text"):
                toxic = part.column(1).to_numpy(zero_copy_only=False).astype(bool)
                strings, which, where = named(*candidates(split(texts, lowered=True)))
                pairs = np.unique(np.stack((which, where), 1), axis=0)
                bad = np.bincount(pairs[toxic[pairs[:, 1]], 0], minlength=len(strings))
                fine = np.bincount(pairs[~toxic[pairs[:, 1]], 0], minlength=len(strings))
                word = [s.decode("utf-8", "replace") for s in strings]
                yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(bad, pa.int64()), pa.array(fine, pa.int64())], ["word", "bad", "fine"])

    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = sizes.get(True, 0), sizes.get(False, 0)
    constant = Model([], [], np.zeros(0), 0.0, 0.0, float(np.log((toxic + 1) / (toxic + clean + 3))))
    if not toxic or not clean:
        return constant
    counts = rows.mapInArrow(listed, "word string, bad long, fine long").groupBy("word").agg(F.sum("bad").alias("bad"), F.sum("fine").alias("fine"))
    apart = counts.filter(F.col("bad") * clean > F.col("fine") * 2 * toxic).orderBy(F.desc("bad"), "word").limit(8 * LANDMARKS)
    usual = counts.orderBy(F.desc("fine"), "word").limit(8 * CLEAN_LANDMARKS)
    words = [(r["word"], r["bad"], r["fine"]) for r in apart.union(usual).distinct().collect()]
    landmarks = chosen(words, toxic, clean)
    if not landmarks:
        return constant

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, "text"):
                x = features(texts, landmarks)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array([v.tobytes() for v in x], pa.binary())], ["toxic", "x"])

    got = rows.mapInArrow(measured, "toxic boolean, x binary").collect()
    got.sort(key=lambda r: (r["toxic"], r["x"]))
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in got]).astype(np.float64)
    y = np.array([r["toxic"] for r in got], bool)
    n = len(landmarks)
    own = kernel([a for a in landmarks for _ in range(n)], landmarks * n).reshape(n, n)
    whiten = []
    for p in POWERS:
        value, vector = np.linalg.eigh(((own + own.T) / 2) ** p)
        whiten.append(vector / np.sqrt(np.maximum(value, 0.1)) @ vector.T)
    z = expanded(x, whiten)
    w, bias = separated(z, y)
    slope, offset = calibrated(z @ w + bias, y)
    return Model(landmarks, whiten, w, bias, slope, offset)


def scored(df: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``df`` with ``score_col`` from 0 to 1, higher for texts likelier toxic.

    Null text counts as empty; rows are scored one by one, so repeated rows get
    the same score; a column already named ``score_col`` is replaced, others pass
    through; an empty table stays empty."""
    rows = df.drop(score_col)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in chunks(batch, text_col, 1 << 22):
                value = model.score(features(texts, model.landmarks) if model.landmarks else np.zeros((len(texts), 0)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(value.astype(np.float64))], [*part.schema.names, score_col])

    return rows.mapInArrow(scan, f"{fields}, `{score_col}` double")
