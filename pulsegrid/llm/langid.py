"""Languages of the words of code-switched text by a conditional random field.

A text is a chain of words, runs of letters and marks, each labelled with a
language.  A word speaks for languages by its prefixes and suffixes, its n-grams of
characters, itself, and its shares of the languages in a lexicon counted over all
training texts; learned transitions say how likely a change is from one word to the
next.  Forward-backward gives every word's distribution over languages, runs of
words are what it labels alike, and a text's language has the greatest mean.

Weights are fitted on a bounded sample of labelled rows, where some chains are
spliced from texts of two languages, so that changes are learned, too.  Scoring is
one pass over all rows.  A long chain is cut into blocks: a block is a product of
small matrices, products chained over blocks give the vectors at their borders, and
all blocks are then walked side by side.
"""

from __future__ import annotations

import sys
import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.sums import KIND, add_up, rows as sum_rows
from pulsegrid.llm.words import Powers, chunks, held, mix, rolled

UNKNOWN = "und"
#: Bounds of the model: labelled rows of the sample, chains taken from one of them,
#: languages (the most frequent ones), words of the lexicon, weights.
SAMPLE, CHAINS, LANGUAGES, LEXICON, WEIGHTS = 1600, 24, 64, 20_000, 1 << 19
GRAM, BLOCK, EPOCHS, BATCH, RATE, DECAY, SPLICED = 4, 64, 3, 256, 0.1, 1e-4, 0.25
MEMO = 300_000
POWERS = Powers(0x9E3779B97F4A7C15)
BASE = np.uint64(0xD1342543DE82EF95)


@cache
def characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all code points: is it a letter, can it be in a word, its lower case."""
    n = sys.maxunicode + 1
    letter, inside, lower = np.zeros(n, bool), np.zeros(n, bool), np.arange(n, dtype=np.uint32)
    for c in range(n):
        kind = unicodedata.category(chr(c))
        if kind[0] in "LM":
            inside[c] = True
            letter[c] = kind[0] == "L"
            small = chr(c).lower()
            if len(small) == 1:
                lower[c] = ord(small)
    return letter, inside, lower


@dataclass
class Chain:
    """Words of several texts, one after the other."""
    codes: np.ndarray   # lower-case code points of all texts
    start: np.ndarray   # of each word in codes
    end: np.ndarray
    first: np.ndarray   # index of the first word of each text, and the number of words
    offset: np.ndarray  # of each text in codes
    letters: np.ndarray  # has the text a letter?

    def hashes(self) -> np.ndarray:
        h = rolled(self.codes.astype(np.uint64) + np.uint64(1), self.start, self.end, POWERS)
        return mix(h + (self.end - self.start).astype(np.uint64))


def chained(texts: list[str]) -> Chain:
    letter, inside, lower = characters()
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=off[1:])
    mask = inside[codes]
    begins, ends = mask.copy(), mask.copy()
    begins[1:] &= ~mask[:-1]
    ends[:-1] &= ~mask[1:]
    full = np.diff(off) > 0
    begins[off[:-1][full]] = mask[off[:-1][full]]
    ends[off[1:][full] - 1] = mask[off[1:][full] - 1]
    start = np.flatnonzero(begins)
    has = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(letter[codes], out=has[1:])
    return Chain(lower[codes], start, np.flatnonzero(ends) + 1, np.searchsorted(start, off), off, has[off[1:]] > has[off[:-1]])


def spelled(codes: np.ndarray, start: np.ndarray, end: np.ndarray, rows: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features of words as groups of (word, row of the weights), words ascending:
    n-grams, prefixes and suffixes up to ``GRAM`` characters and the whole word."""
    size = end - start
    owner = np.repeat(np.arange(len(size)), size)
    begin = np.cumsum(size) - size
    place = np.arange(len(owner)) - np.repeat(begin, size)
    letters = codes[np.repeat(start, size) + place].astype(np.uint64) + np.uint64(1)
    left = size[owner] - place
    out, gram = [], np.zeros(len(owner), np.uint64)
    for n in range(1, GRAM + 1):
        gram = gram * BASE
        gram[:len(gram) - n + 1] += letters[n - 1:]
        for kind, where in ((0, left >= n), (1, (place == 0) & (left >= n)), (2, left == n)):
            at = np.flatnonzero(where)
            out.append((owner[at], mix(gram[at] + np.uint64(3 * n + kind)) % np.uint64(rows)))
    whole = rolled(letters, begin, begin + size, POWERS)
    out.append((np.arange(len(size)), mix(whole + size.astype(np.uint64)) % np.uint64(rows)))
    return [(w, r.astype(np.int64)) for w, r in out]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros((1, 0), np.float32))   # row, language
    steps: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))                 # log weight from, to
    trust: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))                 # share in the lexicon, language
    lexicon: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))         # hashes in order
    shares: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))                # of a word of the lexicon

    def listed(self, hashes: np.ndarray) -> np.ndarray:
        """Shares of the languages in words; zeros for words outside the lexicon."""
        out = np.zeros((len(hashes), len(self.languages)))
        if len(self.lexicon):
            at = np.minimum(np.searchsorted(self.lexicon, hashes), len(self.lexicon) - 1)
            known = self.lexicon[at] == hashes
            out[known] = self.shares[at[known]]
        return out

    def emissions(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        out = self.listed(hashes) @ self.trust
        for word, row in spelled(codes, start, end, len(self.weights)):
            if len(word):
                first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
                out[word[first]] += np.add.reduceat(self.weights[row], first, axis=0)
        return out


class Emissions:
    """Emissions of words, each computed once as long as the memo holds."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}
        self.values = np.zeros((0, len(model.languages)))

    def of(self, chain: Chain) -> np.ndarray:
        found, first, inverse = np.unique(chain.hashes(), return_index=True, return_inverse=True)
        if len(self.known) + len(found) > MEMO:
            self.known, self.values = {}, self.values[:0]
        place = np.array([self.known.get(h, -1) for h in found.tolist()], np.int64)
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = len(self.known) + np.arange(len(new))
            self.known.update(zip(found[new].tolist(), place[new].tolist()))
            at = first[new]
            self.values = np.concatenate((self.values, self.model.emissions(chain.codes, chain.start[at], chain.end[at], found[new])))
        return self.values[place[inverse]]


def blocks(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of at most ``BLOCK`` words inside one text: index of their words in
    rows of ``BLOCK``, which of these are words, and the first block of each text."""
    count = -(-np.diff(first) // BLOCK)
    block = np.zeros(len(count) + 1, np.int64)
    np.cumsum(count, out=block[1:])
    text = np.repeat(np.arange(len(count)), count)
    begin = first[text] + (np.arange(block[-1]) - block[text]) * BLOCK
    at = begin[:, None] + np.arange(BLOCK)
    real = at < first[text + 1][:, None]
    return np.where(real, at, 0), real, block


def normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(-1, keepdims=True)


def forward_backward(score: np.ndarray, real: np.ndarray, step: np.ndarray, left: np.ndarray, right: np.ndarray):
    """Distribution of every word of all blocks, the vectors before each word and
    the vectors behind it.  ``score`` and ``step`` are factors, not their logarithms."""
    n, length, k = score.shape
    ahead, behind = np.empty((length + 1, n, k)), np.empty((length, n, k))
    ahead[0] = left
    for t in range(length):
        ahead[t + 1] = np.where(real[:, t, None], normal((ahead[t] @ step) * score[:, t]), ahead[t])
    behind[length - 1] = right
    for t in range(length - 1, 0, -1):
        behind[t - 1] = np.where(real[:, t, None], normal((score[:, t] * behind[t]) @ step.T), behind[t])
    return normal(ahead[1:] * behind).transpose(1, 0, 2), ahead, behind


def products(score: np.ndarray, real: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Product of the matrices of each block's words."""
    n, length, k = score.shape
    out = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    for t in range(length):
        more = (out.reshape(n * k, k) @ step).reshape(n, k, k) * score[:, t, None, :]
        more /= more.sum((1, 2), keepdims=True)
        out = np.where(real[:, t, None, None], more, out)
    return out


def distributions(emission: np.ndarray, first: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Distribution over languages of every word, given its whole text."""
    k = emission.shape[1]
    at, real, block = blocks(first)
    if not len(at):
        return np.zeros((0, k))
    factor = np.exp(np.maximum(emission - emission.max(1, keepdims=True), -60.0))
    score, step = factor[at], np.exp(steps)
    size = np.diff(block)
    left, right = np.full((len(at), k), 1 / k), np.full((len(at), k), 1 / k)
    if size.max() > 1:
        product = products(score, real, step)
        for j in range(size.max() - 1):
            own = block[:-1][size > j + 1] + j
            left[own + 1] = normal(np.einsum("bi,bij->bj", left[own], product[own]))
            own = block[1:][size > j + 1] - 1 - j
            right[own - 1] = normal(np.einsum("bij,bj->bi", product[own], right[own]))
    out = np.empty_like(emission)
    out[at[real]] = forward_backward(score, real, step, left, right)[0][real]
    return out


def training_rows(df: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return df.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).filter(
        "text is not null and lang is not null")


def drawn(rows: DataFrame, counts: dict[str, int], sample: int) -> list[tuple[str, str]]:
    """(language, chain) of a bounded sample: ``sample`` texts, as many of each
    language, and of each text the chains of ``BLOCK`` words with the least hashes,
    ``CHAINS`` at most.  Texts are drawn by the hash of their text, copies once, and
    draw themselves with about twice the needed chance before they are ranked."""
    each = max(1, sample // len(counts))
    spread = 1 << 30
    chance = F.coalesce(*[F.when(F.col("lang") == x, F.lit(min(1.0, (2 * each + 64) / n))) for x, n in counts.items()])
    draw = F.pmod(F.xxhash64("text"), F.lit(spread))
    some = rows.withColumn("draw", draw).filter(F.col("draw") < chance * spread).groupBy("lang", "draw").agg(F.min("text").alias("text"))
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("draw"))).filter(F.col("rank") <= each)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, str, int]] = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                chain = chained([text])
                at = np.arange(0, len(chain.start), BLOCK)
                last = np.minimum(at + BLOCK, len(chain.start)) - 1
                hashes = mix(chain.hashes()[at] + at.astype(np.uint64))
                for j in np.sort(np.argsort(hashes, kind="stable")[:CHAINS]):
                    found.append((lang, text[chain.start[at[j]]:chain.end[last[j]]], int(hashes[j] >> np.uint64(1))))
            lang, text, order = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(text, pa.string()), pa.array(order, pa.int64())], ["lang", "text", "draw"])

    got = ranked.select("lang", "text").mapInArrow(cut, "lang string, text string, draw long").collect()
    return [(r["lang"], r["text"]) for r in sorted(got, key=lambda r: (r["draw"], r["lang"], r["text"]))]


def lexicon(rows: DataFrame, languages: list[str], hashes: np.ndarray) -> np.ndarray:
    """Shares of the languages in each word of ``hashes`` (in order), from its
    frequency in all training texts of each language."""
    place = {x: i for i, x in enumerate(languages)}
    k, n = len(languages), len(hashes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, n + 1))
        for batch in batches:
            for part, texts in chunks(batch, "text"):
                chain = chained(texts.to_pylist())
                own = np.array([place.get(x, -1) for x in part.column(1).to_pylist()], np.int64)
                lang = np.repeat(own, np.diff(chain.first))
                found = chain.hashes()
                at = np.searchsorted(hashes, found)
                known = hashes[np.minimum(at, n - 1)] == found
                slot = np.where(known, at, n)[lang >= 0] + lang[lang >= 0] * (n + 1)
                total += np.bincount(slot, minlength=k * (n + 1)).reshape(k, n + 1)
        yield sum_rows(dict(enumerate(total)))

    got = add_up(rows.mapInArrow(count, KIND))
    counts = np.stack([got.get(i, np.zeros(n + 1)) for i in range(k)])
    rate = (counts[:, :n] + 0.1) / (counts.sum(1, keepdims=True) + 1)
    return (rate / rate.sum(0)).T


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", *, sample: int = SAMPLE) -> Model:
    """Learn from the rows of ``df`` that have a text and a language.

    Weights come from at most ``sample`` rows; the lexicon's shares are counted over
    all rows.  Without such rows the model knows no language."""
    rows = training_rows(df, text_col, lang_col)
    common = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    counts = {r["lang"]: r["n"] for r in common.collect()}
    if not counts:
        return Model([])
    languages = sorted(counts)
    taken = drawn(rows, counts, sample)
    k = len(languages)
    model = Model(languages, np.zeros((WEIGHTS // k, k), np.float32), np.zeros((k, k)), np.eye(k))
    chain = chained([text for _, text in taken])
    if not len(chain.start):
        return model
    hashes = chain.hashes()
    found, times = np.unique(hashes, return_counts=True)
    often = np.lexsort((found, -times))[:LEXICON]
    model.lexicon = np.sort(found[often[times[often] > 1]])
    model.shares = lexicon(rows, languages, model.lexicon) if len(model.lexicon) else np.zeros((0, k))
    truth = np.repeat([languages.index(x) for x, _ in taken], np.diff(chain.first))
    learn(model, chain, hashes, truth)
    return model


def spliced(first: np.ndarray, truth: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Chains as rows of word indices and what of them are words; a part of the
    chains ends with the second half of another one."""
    at, real, _ = blocks(first)
    mixed = np.flatnonzero(rng.random(len(at)) < SPLICED)
    other, half = rng.permutation(len(at))[:len(mixed)], BLOCK // 2
    whole = real[mixed].all(1) & real[other].all(1)
    mixed, other = mixed[whole], other[whole]
    tails = at[other, half:].copy()
    at[mixed, half:] = tails
    return at, real


def learn(model: Model, chain: Chain, hashes: np.ndarray, truth: np.ndarray) -> None:
    """Ascend the likelihood of the labels, batch by batch, with steps by AdaGrad."""
    rng = np.random.default_rng(7)
    k, n_rows = len(model.languages), len(model.weights)
    found, first, word = np.unique(hashes, return_index=True, return_inverse=True)
    groups = spelled(chain.codes, chain.start[first], chain.end[first], n_rows)
    owner, row = (np.concatenate([g[i] for g in groups]) for i in (0, 1))
    row = row[np.argsort(owner, kind="stable")]
    begin = np.zeros(len(found) + 1, np.int64)
    np.cumsum(np.bincount(owner, minlength=len(found)), out=begin[1:])
    share = model.listed(found)
    seen = {name: np.full(getattr(model, name).shape, 1e-6) for name in ("weights", "steps", "trust")}

    def climb(name: str, slope: np.ndarray, where=slice(None)) -> None:
        value = getattr(model, name)
        slope = slope - DECAY * value[where]
        seen[name][where] += slope ** 2
        value[where] += RATE * slope / np.sqrt(seen[name][where])

    for _ in range(EPOCHS):
        at, real = spliced(chain.first, truth, rng)
        order = rng.permutation(len(at))
        for a in range(0, len(order), BATCH):
            own = order[a:a + BATCH]
            where, is_word = at[own], real[own]
            used, inverse = np.unique(word[where], return_inverse=True)
            inverse = inverse.reshape(where.shape)
            size = begin[used + 1] - begin[used]
            of = np.repeat(np.arange(len(used)), size)
            rows = row[np.repeat(begin[used] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            emission = np.add.reduceat(model.weights[rows], np.cumsum(size) - size, axis=0) + share[used] @ model.trust
            factor = np.exp(np.maximum(emission - emission.max(1, keepdims=True), -60.0))
            score, step = factor[inverse], np.exp(model.steps)
            even = np.full((len(own), k), 1 / k)
            likely, ahead, behind = forward_backward(score, is_word, step, even, even)
            label = truth[where]
            error = np.eye(k)[label] - likely
            flat, slot = error[is_word], inverse[is_word]
            slope = np.stack([np.bincount(slot, flat[:, j], len(used)) for j in range(k)], 1)
            climb("trust", share[used].T @ slope)
            touched, back = np.unique(rows, return_inverse=True)
            climb("weights", np.stack([np.bincount(back, slope[of, j], len(touched)) for j in range(k)], 1).astype(np.float32), touched)
            change = np.zeros((k, k))
            # before the first word stands an unknown language, each as likely
            np.add.at(change.T, label[:, 0], normal(step[:, label[:, 0]].T))
            for t in range(BLOCK):
                on = is_word[:, t]
                both = ahead[t][on][:, :, None] * step * (score[on, t] * behind[t][on])[:, None, :]
                change -= (both / both.sum((1, 2), keepdims=True)).sum(0)
                if t:
                    np.add.at(change, (label[on, t - 1], label[on, t]), 1.0)
            climb("steps", change)


RUN = "struct<lang: string, start: long, stop: long>"


def identified(df: DataFrame, model: Model, text_col: str = "text", *, lang_col: str = "lang_pred",
               score_col: str = "score", runs_col: str = "runs") -> DataFrame:
    """``df`` with the language of each text, its mean probability over the words,
    and ``runs``: code points from and to (exclusive) of consecutive words of one
    language.

    A text that is null or has no letter is ``und`` with score 0 and no runs, as is
    every text under a model without languages; ties go to the first language in
    order; repeated rows are treated alike; columns already named like the new ones
    are replaced, others pass through; an empty table stays empty."""
    rows = df.drop(lang_col, score_col, runs_col)
    if any(t == "void" for _, t in rows.dtypes):
        rows = rows.select(*[F.col(f"`{c}`").cast("string").alias(c) if t == "void" else F.col(f"`{c}`") for c, t in rows.dtypes])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    shipped, mark = rows.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    names = np.array([*model.languages, UNKNOWN], object)
    run_kind = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = held(mark, lambda: Emissions(shipped.value))
        for batch in batches:
            for part, texts in chunks(batch, text_col):
                best, score, runs = labelled(memo, texts.to_pylist())
                flat = pa.StructArray.from_arrays(
                    [pa.array(names[runs[1]], pa.string()), pa.array(runs[2]), pa.array(runs[3])], fields=list(run_kind))
                offsets = np.zeros(len(best) + 1, np.int32)
                np.cumsum(runs[0], out=offsets[1:])
                spans = pa.ListArray.from_arrays(pa.array(offsets), flat)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names[best], pa.string()), pa.array(score), spans], [*part.schema.names, lang_col, score_col, runs_col])

    return rows.mapInArrow(label, f"{fields}, `{lang_col}` string, `{score_col}` double, `{runs_col}` array<{RUN}>")


def labelled(memo: Emissions, texts: list[str]):
    """Of each text the index of its language (one past the last: unknown), its
    score, and its runs: number per text, language, start and stop of each."""
    model = memo.model
    k, chain = len(model.languages), chained(texts)
    best, score = np.full(len(texts), k), np.zeros(len(texts))
    none = np.zeros(0, np.int64)
    if not k or not len(chain.start):
        return best, score, (np.zeros(len(texts), np.int64), none, none, none)
    likely = distributions(memo.of(chain), chain.first, model.steps)
    text = np.repeat(np.arange(len(texts)), np.diff(chain.first))
    size = np.bincount(text, minlength=len(texts))
    mean = np.stack([np.bincount(text, likely[:, j], len(texts)) for j in range(k)], 1) / np.maximum(size, 1)[:, None]
    best = np.where(chain.letters, mean.argmax(1), k)
    score = np.where(chain.letters, np.clip(mean.max(1), 0.0, 1.0), 0.0)
    own = likely.argmax(1)
    begins = np.ones(len(own), bool)
    begins[1:] = (own[1:] != own[:-1]) | (text[1:] != text[:-1])
    begins &= chain.letters[text]
    at = np.flatnonzero(begins)
    ends = np.append(at[1:], len(own)) - 1
    # words of texts without a letter begin no run and end none
    ends = np.minimum(ends, chain.first[text[at] + 1] - 1)
    shift = chain.offset[text[at]]
    return best, score, (np.bincount(text[at], minlength=len(texts)), own[at], chain.start[at] - shift, chain.end[ends] - shift)
