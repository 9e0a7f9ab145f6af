"""Periodic runs of words by recompression: a run-length grammar answers exact extensions for candidates of a harmonic grid."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORTEST = 24
PERIODS = 3
# Words of the texts that one grammar is made of, about, and grid places that are looked at at a time.
WORDS = 1 << 20
GRID = 1 << 20

Run = tuple[int, int, int]
Words = list[bytes]


@dataclass(frozen=True)
class Level:
    """Symbols of one level, and for each the number of the symbol above that holds it, if there is a level above."""

    symbols: np.ndarray
    above: np.ndarray | None
    # Whether the symbols above hold runs of one letter (else one letter or a pair).
    runs: bool

    def mirrored(self) -> Level:
        up = None if self.above is None else self.above[-1] - self.above[::-1]
        return Level(self.symbols[::-1], up, self.runs)


def recompress(letters: np.ndarray) -> list[Level]:
    """Levels of the grammar of a sequence of non-negative numbers, until one symbol is left.

    Turns of two kinds alternate. Block compression gives each run of one letter a symbol of its letter and length. Pair
    compression deals the letters to a left and a right side by a hash and gives each left letter that a right one follows
    one symbol with it. Equal stretches get equal symbols except at their ends.
    """
    levels: list[Level] = []
    s = np.unique(letters, return_inverse=True)[1].astype(np.int64)
    turn = 0
    while len(s) > 1:
        if turn % 2 == 0:
            starts = np.r_[True, s[1:] != s[:-1]]
            place = np.flatnonzero(starts)
            second = np.diff(np.r_[place, len(s)])
        else:
            # A multiplicative hash, another one each turn.
            side = ((s + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15 + 2 * turn * 0xD1B54A32D192ED03 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(63)
            pair = np.r_[(side[:-1] == 0) & (side[1:] == 1), False]
            starts = np.r_[True, ~pair[:-1]]
            place = np.flatnonzero(starts)
            second = np.where(pair[place], s[np.minimum(place + 1, len(s) - 1)] + 1, 0)
        levels.append(Level(s, np.cumsum(starts) - 1, turn % 2 == 0))
        keys = s[place] * (int(second.max()) + 1) + second
        s = np.unique(keys, return_inverse=True)[1].astype(np.int64)
        turn += 1
    levels.append(Level(s, None, False))
    return levels


class Extensions:
    """Longest common extensions of places in one direction, answered on the levels of a grammar."""

    def __init__(self, levels: list[Level]):
        self.levels = levels
        self.first = [None] + [np.flatnonzero(np.r_[True, np.diff(x.above) > 0]) for x in levels[:-1]]
        self.run_end = [self._run_ends(x) if x.runs else None for x in levels]

    @staticmethod
    def _run_ends(level: Level) -> np.ndarray:
        ends = np.flatnonzero(np.r_[np.diff(level.symbols) != 0, True]) + 1
        return ends[level.above] if level.above is not None else ends

    def _step(self, at: int, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Go on past equal symbols: one, or as many as both runs still have."""
        if self.run_end[at] is None:
            return x + 1, y + 1
        common = np.minimum(self.run_end[at][x] - x, self.run_end[at][y] - y)
        return x + common, y + common

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many letters from a and from b on are the same, for a < b, both within the sequence; all must differ in the end."""
        x, y = a.astype(np.int64), b.astype(np.int64)
        stopped = np.zeros(len(x), np.int64)
        going = np.arange(len(x))
        for at, level in enumerate(self.levels):
            if not len(going):
                break
            stopped[going] = at
            s, n = level.symbols, len(level.symbols)
            u, v = x[going], y[going]
            same = (v < n) & (s[u] == s[np.minimum(v, n - 1)])
            going = going[same]
            if not len(going) or level.above is None:
                break
            # Only where a symbol above starts may the search go up; else one step leads there, if the letters still agree.
            u, v = x[going], y[going]
            first = self.first[at + 1]
            inside = (first[level.above[u]] != u) | (first[level.above[v]] != v)
            x[going[inside]], y[going[inside]] = self._step(at, u[inside], v[inside])
            u, v = x[going], y[going]
            whole = (v < n) & (s[np.minimum(u, n - 1)] == s[np.minimum(v, n - 1)])
            starts = (v < n) & (first[level.above[np.minimum(u, n - 1)]] == u) & (first[level.above[np.minimum(v, n - 1)]] == v)
            up = np.where(inside, whole & starts, starts)
            going = going[up]
            x[going], y[going] = level.above[x[going]], level.above[y[going]]
        for at in range(int(stopped.max(initial=0)), -1, -1):
            s, n = self.levels[at].symbols, len(self.levels[at].symbols)
            here = np.flatnonzero(stopped >= at)
            deeper = here[stopped[here] > at]
            if len(deeper):
                begin = np.r_[self.first[at + 1], n]
                x[deeper], y[deeper] = begin[x[deeper]], begin[y[deeper]]
            while len(here):
                u, v = x[here], y[here]
                same = (v < n) & (s[np.minimum(u, n - 1)] == s[np.minimum(v, n - 1)])
                here = here[same]
                x[here], y[here] = self._step(at, x[here], y[here])
        return x - a


@lru_cache(maxsize=16)
def _grid(low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """(end, period) of all grid places whose end is in [low, high): ends that are multiples of the period, twice or more."""
    periods = np.arange(1, (high - 1) // 2 + 1)
    least = np.maximum(2, -(-low // periods))
    sizes = np.maximum((high - 1) // periods - least + 1, 0)
    q = np.repeat(periods, sizes)
    e = (np.repeat(least - np.cumsum(sizes) + sizes, sizes) + np.arange(len(q))) * q
    order = np.argsort(e, kind="stable")
    return e[order], q[order]


def candidates(s: np.ndarray, shortest: int = SHORTEST, periods: int = PERIODS) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) of the harmonic grid that may lie in a run: the place is a multiple of the period, counted from 1.

    A run of ``periods`` periods or more, at least two, equals itself moved by its period over a stretch of at least that
    many less one. Its first grid place thus has all places up to ``periods`` less two periods on in the stretch; five of
    them are looked at.
    """
    n = len(s)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    step = 1 << 13
    for low in range(0, n + 1, step):
        e, q = _grid(low, low + step)
        stop = np.searchsorted(e, n + 1)
        e, q = e[:stop], q[:stop]
        fit = np.maximum(shortest, periods * q) <= n
        i, q = e[fit] - 1 - q[fit], q[fit]
        for num, den in ((0, 1), (1, 2), (1, 1), (1, 4), (3, 4)):
            at = i + (periods - 2) * q * num // den
            at[at + q >= n] = -1
            good = (at >= 0) & (s[at] == s[np.minimum(at + q, n - 1)])
            i, q = i[good], q[good]
        if len(i):
            found.append((i, q))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def find_runs(texts: list[np.ndarray], shortest: int = SHORTEST, periods: int = PERIODS) -> list[list[Run]]:
    """The runs (start, length, smallest period) of each sequence of word numbers, by start and period.

    Only sequences with candidates enter the grammar, joined by letters that occur once. A stretch that is found for
    several periods is a run of the smallest one, which divides the others.
    """
    out: list[list[Run]] = [[] for _ in texts]
    asked = [(k, *c) for k, s in enumerate(texts) if len((c := candidates(s, shortest, periods))[0])]
    if not asked:
        return out
    top = max(int(texts[k].max()) for k, _, _ in asked) + 1
    parts, base, at = [np.array([top])], [], 1
    for number, (k, _, _) in enumerate(asked):
        base.append(at)
        parts += [texts[k], np.array([top + 1 + number])]
        at += len(texts[k]) + 1
    whole = np.concatenate(parts)
    levels = recompress(whole)
    ahead, back = Extensions(levels), Extensions([x.mirrored() for x in levels])
    owner = np.repeat(np.arange(len(asked)), [len(i) for _, i, _ in asked])
    places = np.concatenate([i + b for (_, i, _), b in zip(asked, base, strict=True)])
    spans = np.concatenate([q for _, _, q in asked])
    last = len(whole) - 1
    for low in range(0, len(places), GRID):
        i, q, own = places[low : low + GRID], spans[low : low + GRID], owner[low : low + GRID]
        # In the mirror the later of two places comes first.
        length_back = back.common(last - (i + q) + 1, last - i + 1)
        start, end = i - length_back, i + q + ahead.common(i, i + q)
        fit = end - start >= np.maximum(shortest, periods * q)
        rows = np.unique(np.stack([own[fit], start[fit], end[fit], q[fit]], axis=1), axis=0)
        for o, a, z, p in rows.tolist():
            out[asked[o][0]].append((a - base[o], z - a, p))
    for k, runs in enumerate(out):
        least: dict[tuple[int, int], int] = {}
        for a, length, p in runs:
            least[a, length] = min(p, least.get((a, length), p))
        out[k] = sorted(((a, length, p) for (a, length), p in least.items()), key=lambda r: (r[0], r[2]))
    return out


def collapsed(words: Words, runs: list[Run]) -> Words:
    """The words without those that a run holds after its first period."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [w for w, k in zip(words, keep, strict=True) if k]


def planted(doc_id: int | None, words: Words) -> Words:
    """Words of which a tenth of the documents repeat a stretch to their end, as the documents' ids decide; null changes none."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def _described(doc_id: int | None, words: Words, runs: list[Run]) -> tuple:
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    listed = "".join(f"{a},{length},{p}\n" for a, length, p in runs)
    kept = b" ".join(collapsed(words, runs)) if runs else b" ".join(words)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def _batches(frames: Iterator[pd.DataFrame], change: Callable | None) -> Iterator[tuple[list[int | None], list[Words]]]:
    ids: list[int | None] = []
    texts: list[Words] = []
    held = 0
    for frame in frames:
        for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
            own = None if pd.isna(doc_id) else int(doc_id)
            words = (text or "").encode("utf-8", "surrogatepass").split()
            ids.append(own)
            texts.append(change(own, words) if change else words)
            held += len(words)
            if held >= WORDS:
                yield ids, texts
                ids, texts, held = [], [], 0
    yield ids, texts


def scan(
    documents: DataFrame,
    describe: Callable[[int | None, Words, list[Run]], tuple],
    schema: str,
    change: Callable[[int | None, Words], Words] | None = None,
    shortest: int = SHORTEST,
    periods: int = PERIODS,
) -> DataFrame:
    """A row of ``schema`` for each document, made by ``describe`` from its words and runs, where it lies and without a shuffle.

    Words are the stretches between ASCII white space, numbered from 0; ``change`` may alter them first. A run is a stretch of
    consecutive words with smallest period q and a length of ``shortest`` and ``periods`` (2 or more) times q at least, that
    no neighbouring word extends. Null and empty texts have no words and no runs. Rows that repeat come back as often; other
    columns are ignored. An empty table gives no rows.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in schema.split(", ")]
        for ids, texts in _batches(frames, change):
            number: dict[bytes, int] = {}
            coded = [np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)) for words in texts]
            rows = [describe(i, w, r) for i, w, r in zip(ids, texts, find_runs(coded, shortest, periods), strict=True)]
            yield pd.DataFrame(rows, columns=names).astype({c: "Int64" for c in names if f"{c} long" in schema})

    return documents.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, schema)


RUNS = "doc_id long, runs array<struct<start:long,length:long,period:long>>, text string"
DIGESTS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def collapse(documents: DataFrame) -> DataFrame:
    """(doc_id, runs, text) of each document: its runs, and its words without the repeats, joined by one space."""

    def describe(doc_id: int | None, words: Words, runs: list[Run]) -> tuple:
        text = b" ".join(collapsed(words, runs)).decode("utf-8", "surrogatepass")
        return doc_id, [{"start": a, "length": length, "period": p} for a, length, p in runs], text

    return scan(documents, describe, RUNS)


def summarise(documents: DataFrame, change: Callable[[int | None, Words], Words] | None = planted) -> DataFrame:
    return scan(documents, _described, DIGESTS, change)
