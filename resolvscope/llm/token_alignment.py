"""Alignment of the tokens that two tokenizers make of a text: their ends are merged in independent pieces of equal work."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resolvscope.llm.components import _kept, spread_join

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# Ends of either kind that a piece of the merge takes.
PIECE = 1 << 16
# Bytes of the texts that are encoded at a time, about; they form a chunk.
CHUNK_BYTES = 1 << 21
# Fixed value: how the first tokenizer cuts a text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE_MARK = "▁"
FOUND = "chunk long, whole boolean, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable bytes stand for themselves, the rest follow from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers, the bytes of their tokens and how groups are written.

    The first one's merges come in the order of its ids, so its vocabulary is all that encoding needs.
    """

    def __init__(self, vocabulary: str, model: str):
        letters = byte_letters()
        with open(vocabulary, encoding="utf-8") as file:
            described = json.load(file)
        special = {t["id"] for t in described["added_tokens"]}
        ids = {token: i for token, i in described["model"]["vocab"].items() if i not in special}
        ranks = {bytes(letters[c] for c in token): i for token, i in ids.items()}
        self.a = tiktoken.Encoding("words", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        size_a, self.size_b = max(ranks.values()) + 1, self.b.get_piece_size()
        self.bytes_a = [b""] * size_a
        for token, i in ranks.items():
            self.bytes_a[i] = token
        self.bytes_b = [self._piece(i) for i in range(self.size_b)]
        self.length_a, self.length_b = (np.array([len(x) for x in table]) for table in (self.bytes_a, self.bytes_b))
        written = [[mark + str(i).encode() for i in range(n)] for n, marks in ((size_a, b",;"), (self.size_b, b",|")) for mark in (marks[:1], marks[1:])]
        self.written = sum(written, [])
        # Where in ``written`` a token of either kind goes on, and where it opens a part.
        self.at = np.cumsum([0, *map(len, written)])

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[1:-1], 16)])
        # What is no text, such as the unknown token, fits no text.
        return b"" if self.b.is_control(i) or self.b.is_unknown(i) else self.b.id_to_piece(i).replace(SPACE_MARK, " ").encode()

    def encode(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of both kinds; none if the text is null, empty or not the bytes of either."""
        if not text:
            return [], []
        raw = (" " + text).encode()
        a, b = self.a.encode_ordinary(" " + text), self.b.encode(text, num_threads=1)
        if b"".join(map(self.bytes_b.__getitem__, b)) != raw or b"".join(map(self.bytes_a.__getitem__, a)) != raw:
            return [], []
        return a, b


@lru_cache(maxsize=2)
def tokenizers(vocabulary: str, model: str) -> Tokenizers:
    return Tokenizers(vocabulary, model)


def merge_splits(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first d values of the merge of two sorted arrays come from a, for each d; of equal values a's come first.

    A binary search along each diagonal of the merge, all diagonals at once.
    """
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        middle = (low + high) // 2
        more = open_ & (a[np.minimum(middle, len(a) - 1)] <= b[np.clip(diagonals - 1 - middle, 0, len(b) - 1)])
        low = np.where(more, middle + 1, low)
        high = np.where(open_ & ~more, middle, high)
    return low


def common_ends(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of the values that both strictly growing arrays hold, from pieces of the merge that know nothing of each other.

    A value of both may lie on the edge of two pieces, a's in the first and b's in the second; the edges are stitched.
    """
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    total = len(a) + len(b)
    edges = np.r_[np.arange(0, total, piece), total]
    in_a = merge_splits(a, b, edges)
    in_b = edges - in_a
    found = []
    for k in range(len(edges) - 1):
        own, other = a[in_a[k] : in_a[k + 1]], b[in_b[k] : in_b[k + 1]]
        if len(own) and len(other):
            place = np.searchsorted(other, own)
            hit = np.flatnonzero(other[np.minimum(place, len(other) - 1)] == own)
            found.append((in_a[k] + hit, in_b[k] + place[hit]))
    inner = np.arange(1, len(edges) - 1)
    inner = inner[(in_a[inner] > 0) & (in_b[inner] < len(b))]
    torn = inner[a[in_a[inner] - 1] == b[in_b[inner]]]
    found.append((in_a[torn] - 1, in_b[torn]))
    places = np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])
    order = np.argsort(places[0])
    return places[0][order], places[1][order]


def written_groups(own: Tokenizers, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the texts that write the groups (``a1,a2|b1;a3|b2,b3`` after a first ``;``), and where each cut's group ends."""
    opens_a, opens_b = np.zeros(len(a) + 1, np.int64), np.zeros(len(b) + 1, np.int64)
    opens_a[0] = opens_b[0] = 1
    opens_a[cut_a + 1] = opens_b[cut_b + 1] = 1
    group_a, group_b = np.cumsum(opens_a)[:-1] - 1, np.cumsum(opens_b)[:-1] - 1
    before_a, before_b = np.r_[0, cut_a + 1], np.r_[0, cut_b + 1]
    out = np.zeros(len(a) + len(b), np.int64)
    out[np.arange(len(a)) + before_b[group_a]] = a + own.at[opens_a[:-1]]
    out[np.arange(len(b)) + before_a[group_b + 1]] = b + own.at[2 + opens_b[:-1]]
    return out, cut_a + cut_b + 2


def align(own: Tokenizers, ids: list[int | None], texts: list[str | None], chunk: int, piece: int = PIECE) -> pd.DataFrame:
    """The rows of one chunk: one for each document, and a whole one with the counts of the chunk's id pairs."""
    encoded = [own.encode(t) for t in texts]
    n_a, n_b = (np.array([len(e[k]) for e in encoded], np.int64) for k in (0, 1))
    a, b = (np.fromiter((i for e in encoded for i in e[k]), np.int64, int(n.sum())) for k, n in ((0, n_a), (1, n_b)))
    # Documents with tokens follow each other in one byte count, so one merge serves them all.
    cut_a, cut_b = common_ends(np.cumsum(own.length_a[a]), np.cumsum(own.length_b[b]), piece)
    written, ends = written_groups(own, a, b, cut_a, cut_b)
    tokens = np.r_[0, np.cumsum(n_a + n_b)]
    digests = []
    for low, high in zip(tokens[:-1].tolist(), tokens[1:].tolist(), strict=True):
        listed = b"".join([own.written[i] for i in written[low:high].tolist()])[1:]
        digests.append(hashlib.sha256(listed).hexdigest() if listed else "")
    groups = np.diff(np.r_[0, np.searchsorted(ends, tokens[1:], side="right")])
    pairs = a[cut_a] * own.size_b + b[cut_b]
    span = len(own.bytes_a) * own.size_b
    owner = np.repeat(np.arange(len(ids)), groups)
    keys, times = np.unique(owner * span + pairs, return_counts=True)
    edges = np.searchsorted(keys, np.arange(1, len(ids)) * span)
    every, counted = np.unique(pairs, return_counts=True)
    rows = {
        "chunk": chunk,
        "whole": [False] * len(ids) + [True],
        "doc_id": pd.array([*ids, None], "Int64"),
        "n_a": [*n_a, 0],
        "n_b": [*n_b, 0],
        "n_groups": [*groups, 0],
        "groups_sha256": [*digests, ""],
        "pairs": [*np.split(keys % span, edges), every],
        "times": [*np.split(times.astype(np.int32), edges), counted.astype(np.int32)],
    }
    return pd.DataFrame(rows)


def aligned(documents: DataFrame, vocabulary: str = BYTE_VOCABULARY, model: str = PIECE_MODEL, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunks of documents, each aligned where its texts lie: see :func:`align`. A chunk is never larger than its last text makes it."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = tokenizers(vocabulary, model)
        chunk = TaskContext.get().partitionId() << 32
        ids, texts, held = [], [], 0
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
                ids.append(None if pd.isna(doc_id) else int(doc_id))
                texts.append(text)
                held += len(text or "")
                if held >= chunk_bytes:
                    yield align(own, ids, texts, chunk)
                    ids, texts, held, chunk = [], [], 0, chunk + 1
        if ids:
            yield align(own, ids, texts, chunk)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, FOUND)


def scored(frame: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """Documents of a chunk with what the corpus says of their links; ``counts`` holds each pair of the chunk once."""
    counts = counts.sort_values("pair")
    pair, number, top = counts["pair"].to_numpy(), counts["number"].to_numpy(), counts["top"].to_numpy(bool)
    sizes = frame["pairs"].map(len).to_numpy()
    flat, times = np.concatenate(frame["pairs"].to_list()).astype(np.int64), np.concatenate(frame["times"].to_list()).astype(np.int64)
    at = np.searchsorted(pair, flat)
    edges = np.r_[0, np.cumsum(sizes)]

    def summed(values: np.ndarray) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(values)][edges])

    if not len(flat):
        best = total = links = np.zeros(len(frame), np.int64)
    else:
        best, total, links = summed(times * top[at]), summed(times * number[at]), summed(times)
    shown = frame[["doc_id", "n_a", "n_b", "n_groups"]].assign(n_links=links, n_best=best, count_sum=total, groups_sha256=frame["groups_sha256"])
    return shown.astype({"doc_id": "Int64"})


def pair_counts(found: DataFrame, size_b: int) -> DataFrame:
    """(pair, number, top): how many links of the corpus hold an id pair, and whether no other pair of its B id has more."""
    counts = found.where("whole").select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = counts.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("number"))
    counts = _kept(counts.withColumn("b", F.col("pair") % size_b), "pair_counts")
    best = counts.groupBy("b").agg(F.max("number").alias("best"))
    return spread_join(counts, best, "b").select("pair", "number", (F.col("number") == F.col("best")).alias("top"))


def token_groups(documents: DataFrame, vocabulary: str = BYTE_VOCABULARY, model: str = PIECE_MODEL) -> DataFrame:
    """A row for each document with its groups and links, and what the corpus counts say of the links.

    A text is encoded by a byte-level vocabulary (A, with a space put before) and by a piece model (B), both files at paths
    that every executor can read. Offsets where tokens of both end cut the tokens into groups; the two tokens that end at such
    an offset are a link. Documents are aligned in chunks of bounded size; a chunk's pairs are counted before the shuffle and
    get the corpus counts back by chunk, so no pair is shuffled once for each document that holds it.

    Null and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens: numbers are zero
    and the digest is ''. Rows that repeat come back, and count, as often. Other columns are ignored; an empty table gives no rows.
    """
    found = _kept(aligned(documents, vocabulary, model), "aligned")
    size_b = sentencepiece.SentencePieceProcessor(model_file=model).get_piece_size()
    counts = pair_counts(found, size_b)
    asked = found.where("whole").select("chunk", F.explode("pairs").alias("pair"))
    told = spread_join(asked, counts, "pair").select(F.col("chunk").alias("asking"), "pair", "number", "top")
    rows = found.where("not whole").drop("whole")
    return rows.groupBy("chunk").cogroup(told.groupBy("asking")).applyInPandas(scored, RESULT)
