"""Toxicity by compression distance: windows that a toxic dictionary shortens more than an ordinary one."""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pandas as pd
import zstandard as zstd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resolvscope.llm.text import put, unused

# Rows of each class that the model is fitted on, and the longest text among them, in bytes. The bound on the sample.
PER_CLASS = 2000
LONGEST = 20_000
# Words of a window; a window of few, very long words is cut at WINDOW_BYTES.
WINDOW = 12
WINDOW_BYTES = 512
LEVEL = 5
# What a dictionary is trained to where its samples hold more.
ORDINARY_BYTES = 64 << 10
TOXIC_BYTES = 16 << 10
THRESHOLD = 0.3
_STEMS = range(4, 9)
_LETTERS = re.compile(rb"[a-z\x80-\xff]+")


@dataclass(frozen=True)
class Model:
    """Dictionaries as bytes and the weights of the logistic score; ``prior`` is the score without dictionaries."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, float, float]
    prior: float


def windows(text: str | None, size: int = WINDOW) -> list[bytes]:
    """Consecutive windows of whole words of the lower-cased text; every word is in one."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    made = [b" " + b" ".join(words[i : i + size]) + b" " for i in range(0, len(words), size)]
    if made and max(map(len, made)) > WINDOW_BYTES:
        made = [w[i : i + WINDOW_BYTES] for w in made for i in range(0, len(w), WINDOW_BYTES)]
    return made


def _compressor(content: bytes) -> zstd.ZstdCompressor:
    # Tables large enough that no position of the dictionary is overwritten, and a parse that looks ahead.
    log = max(17, (len(content) + WINDOW_BYTES).bit_length())
    settings = zstd.ZstdCompressionParameters.from_level(
        LEVEL, min_match=4, window_log=log, hash_log=log, chain_log=log, search_log=4, strategy=zstd.STRATEGY_LAZY2, format=zstd.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=0,
        write_checksum=0,
        write_dict_id=0,
    )
    made = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
    made.precompute_compress(compression_params=settings)
    return zstd.ZstdCompressor(dict_data=made, compression_params=settings)


class Meter:
    """Bytes that the toxic dictionary saves: the most in a window, and the sum over windows."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.ready = bool(model.toxic)
        if self.ready:
            self.ordinary, self.toxic = _compressor(model.ordinary), _compressor(model.toxic + model.ordinary)

    def gains(self, text: str | None) -> tuple[float, float]:
        most, total = 0, 0
        if self.ready:
            a, b = self.ordinary.compress, self.toxic.compress
            for w in windows(text):
                gain = len(a(w)) - len(b(w))
                if gain > 0:
                    most, total = max(most, gain), total + gain
        return float(min(most, 12)), float(np.log1p(total))

    def score(self, text: str | None) -> float:
        if not self.ready:
            return self.model.prior
        most, total = self.gains(text)
        c, m, t = self.model.weights
        return float(1.0 / (1.0 + np.exp(-(c + m * most + t * total))))


def _stems(passage: bytes) -> set[bytes]:
    return {w[:k] for w in set(_LETTERS.findall(passage)) for k in _STEMS if len(w) >= k}


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or all samples where they fit as they are or are too few to train on."""
    joined = b"".join(samples)
    if len(joined) <= size:
        return joined
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except zstd.ZstdError:
        return joined


def fit(rows: list[tuple[str, int]], share: float) -> Model:
    """Train on (text, toxic) rows; ``share`` is the share of toxic rows among all that may be learnt from.

    Two thirds make the dictionaries, the others set the score's weights. A sentence counts once however many rows repeat
    it. Words whose beginnings stand in significantly more toxic than ordinary rows make the toxic dictionary, each once and
    the most frequent last, where matches are cheapest; without such words it is trained on the windows of all toxic text.
    The ordinary one is trained on ordinary windows. The toxic compressor is given both contents, so ordinary words cost the
    same with either and only toxic passages differ.
    """
    if len({y for _, y in rows}) < 2:
        return Model(b"", b"", (0.0, 0.0, 0.0), share)
    shuffled = sorted(rows)
    random.Random(7).shuffle(shuffled)
    learn, check = shuffled[::3] + shuffled[1::3], shuffled[2::3]
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    n = [0, 0]
    seen: set[bytes] = set()
    passages: tuple[list[bytes], list[bytes]] = ([], [])
    for text, y in learn:
        fresh = [s for s in re.split(rb"[.\n]", (text or "").encode("utf-8", "surrogatepass").lower()) if s.strip() and s not in seen]
        seen.update(fresh)
        if not fresh:
            continue
        n[y] += 1
        stems: set[bytes] = set()
        for s in fresh:
            stems |= _stems(s)
        counts[y].update(stems)
        passages[y].extend(fresh)
    n0, n1 = max(n[0], 1), max(n[1], 1)

    def telling(stem: bytes, a: int) -> bool:
        b = counts[0][stem]
        p = (a + b) / (n0 + n1)
        z = (a / n1 - b / n0) / np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0) + 1e-12)
        return a >= 3 and z > 4.5 and a / n1 > 4 * b / n0

    marks = {s for s, a in counts[1].items() if telling(s, a)}
    marked = Counter(w for x in passages[1] for w in _LETTERS.findall(x) if any(w[:k] in marks for k in _STEMS if len(w) >= k))
    listed = b"".join(b" " + w + b" " for w, _ in sorted(marked.items(), key=lambda i: (i[1], i[0])))
    toxic, ordinary = ([w for x in own for w in windows(x.decode("utf-8", "surrogatepass"))] for own in (passages[1], passages[0]))
    if not toxic or not ordinary:
        # One class has no words at all.
        return Model(b"", b"", (0.0, 0.0, 0.0), share)
    model = Model(_dictionary(ordinary, ORDINARY_BYTES), listed or _dictionary(toxic, TOXIC_BYTES), (0.0, 0.0, 0.0), share)
    meter = Meter(model)
    y = np.array([v for _, v in check], dtype=float)
    x = np.array([(1.0, *meter.gains(t)) for t, _ in check])
    # Rows weigh as much as their class has among all rows that may be learnt from.
    w = np.where(y == 1, share / max(y.mean(), 1e-9), (1 - share) / max(1 - y.mean(), 1e-9))
    beta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (w * (p - y)) + 0.5 * np.array([0, 1, 1]) * beta
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 0.5, 0.5])
        step = np.linalg.solve(hess, grad)
        beta = beta - np.clip(step, -2, 2)
    beta[1:] = np.maximum(beta[1:], 0.0)
    return Model(model.ordinary, model.toxic, tuple(float(b) for b in beta), share)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(4)) == 2


def train(documents: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, longest: int = LONGEST) -> Model:
    """Fit on at most ``per_class`` labelled rows of each class, chosen by a hash of the id, with texts up to ``longest`` bytes.

    Labels that are null or other than 0 and 1, and ids that are null, are left out; an id labelled both ways counts as toxic.
    """
    usable = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    by_class = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(by_class.values())
    share = by_class.get(1, 0) / total if total else 0.0
    # Twice the bound is picked, since some rows have no text or too long a one.
    picked = [usable.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * per_class) for c in (0, 1)]
    texts = (
        documents.where(F.col("text").isNotNull() & (F.octet_length("text") <= longest))
        .select("doc_id", "text")
        .join(F.broadcast(picked[0].unionAll(picked[1])), "doc_id")
    )
    rows: list[tuple[str, int]] = []
    for c in (0, 1):
        chosen = texts.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(per_class)
        rows += [(r["text"], c) for r in chosen.select("text").collect()]
    return fit(rows, share)


def score(documents: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """The documents with a double column ``name`` from 0 to 1, higher where toxic passages are likelier.

    Every window of the whole text is compressed with both dictionaries. Null and empty texts get the score of a text that
    saves nothing. An input column called ``name`` is replaced, all others are kept.
    """
    shared = documents.sparkSession.sparkContext.broadcast(astuple(model))

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        meter = Meter(Model(*shared.value))
        for texts in batches:
            yield pd.Series([meter.score(t) for t in texts], dtype="float64")

    return put(documents, name, run("text"))


def clean(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents below the threshold, with their columns."""
    name = unused(documents, "toxicity")
    return score(documents, model, name).where(F.col(name) < threshold).drop(name)


def summarise(scored: DataFrame, name: str = "toxicity", threshold: float = THRESHOLD) -> DataFrame:
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(name).alias("score"), (F.col(name) >= threshold).cast("int").alias("predicted"))
