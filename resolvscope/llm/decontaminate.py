"""Benchmark passages in documents, by one Aho-Corasick automaton over the windows of all items."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from resolvscope.llm.components import spread_join
from resolvscope.llm.text import WORD, put, unused
from resolvscope.session import work_path

WINDOW = 10
# Bytes of item texts that one automaton holds. A larger benchmark is cut into parts, one pass over the texts for each.
PART_BYTES = 8 << 20
# What lower-cases A-Z and turns every separator into a blank, on UTF-8 bytes.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))

SCHEMA = "n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>"


def normal_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def windows(text: str | None, window: int) -> set[bytes]:
    """Distinct windows of an item; an item of fewer words is one window, one without words none."""
    words = normal_words(text)
    return {b" ".join(words[i : i + window]) for i in range(max(1, len(words) - window + 1))} if words else set()


def automaton(items: list[tuple[str, str | None]], window: int) -> ahocorasick.Automaton | None:
    """Patterns are windows with a blank on either side, so that they match whole words only."""
    owners: dict[bytes, set[str]] = {}
    for name, text in items:
        for w in windows(text, window):
            owners.setdefault(w, set()).add(name)
    if not owners:
        return None
    made = ahocorasick.Automaton()
    for w, names in owners.items():
        made.add_word(f" {w.decode('utf-8', 'surrogatepass')} ", (w.count(b" ") + 1, len(w.decode("utf-8", "surrogatepass")) + 2, tuple(sorted(names))))
    made.make_automaton()
    return made


def scan_text(text: str | None, made: ahocorasick.Automaton | None) -> tuple[int, int, list[str], list[tuple[int, int]]]:
    """Words, hit words, items and the hit stretches as offsets (code points) of the text as it came."""
    words = normal_words(text)
    if made is None or not words:
        return len(words), 0, [], []
    line = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    found = [(end - size + 1, count, names) for end, (count, size, names) in made.iter(line)]
    if not found:
        return len(words), 0, [], []
    # A pattern starts at the blank before its first word; blanks number the words.
    blanks = np.flatnonzero(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) == 32)
    starts = np.searchsorted(blanks, np.array([f[0] for f in found]))
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + np.array([f[1] for f in found]), -1)
    hit = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    places = [m.span() for m in WORD.finditer(lowered)]
    spans = [(places[a][0], places[b - 1][1]) for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return len(words), int(hit.sum()), sorted({n for f in found for n in f[2]}), spans


def _items(benchmark: DataFrame, part_bytes: int) -> tuple[DataFrame, int]:
    """Ids and texts of the items, and the number of parts of about ``part_bytes`` that they make."""
    chosen = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text").where(F.col("text").isNotNull())
    total = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return chosen, max(1, math.ceil(total / part_bytes))


def _part(chosen: DataFrame, parts: int, at: int) -> list[tuple[str, str | None]]:
    return [tuple(r) for r in chosen.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == at).collect()]


def _scanner(shared: Broadcast, window: int) -> Callable[[str], Column]:
    @F.pandas_udf(SCHEMA)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        made = automaton(shared.value, window)
        for texts in batches:
            rows = [scan_text(t, made) for t in texts]
            out = [(n, hit, items, [{"start": a, "end": b} for a, b in spans]) for n, hit, items, spans in rows]
            yield pd.DataFrame(out, columns=["n_words", "n_hit", "items", "spans"])

    return run


def scan(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, name: str = "leaks", part_bytes: int = PART_BYTES) -> DataFrame:
    """The documents with a struct column ``name``: n_words, n_hit, items (ids as sorted strings) and spans in the text.

    Texts are lower-cased (A-Z) and every separator becomes one blank; the automaton runs over that line once, and its ends
    are mapped back to words and to offsets of the original. A benchmark up to ``part_bytes`` is one broadcast automaton. A
    larger one is cut into parts by a hash of the items: each part has a pass over the texts, in which the driver and the
    workers hold that part alone (about ``part_bytes``; an item larger than that is a part as large as itself), and its hits
    go to a table by text. The hits of all parts are then united by text, so nothing is left out.

    Null and empty texts have no words and no hits; items without words never hit; repeated items and ids count once; a null
    item id is called "null". An input column called ``name`` is replaced, all others are kept.
    """
    chosen, parts = _items(benchmark, part_bytes)
    context = documents.sparkSession.sparkContext
    if parts == 1:
        return put(documents, name, _scanner(context.broadcast(_part(chosen, 1, 0)), window)("text"))
    return _united(documents, _hits_by_part(documents, chosen, parts, window), name)


def _hits_by_part(documents: DataFrame, chosen: DataFrame, parts: int, window: int) -> DataFrame:
    """(text_key, items, starts, ends) of each distinct text with hits, of all parts of the benchmark."""
    spark = documents.sparkSession
    folder = work_path(spark, "leaks")
    texts = documents.select(F.sha2("text", 256).alias("text_key"), "text").where(F.col("text").isNotNull())
    for at in range(parts):
        shared = spark.sparkContext.broadcast(_part(chosen, parts, at))
        hits = texts.select("text_key", _scanner(shared, window)("text").alias("hit")).where("hit.n_hit > 0")
        hits.select("text_key", "hit.items", "hit.spans").dropDuplicates(["text_key"]).write.parquet(f"{folder}/part={at}")
        shared.destroy()
    schema = "text_key string, items array<string>, spans array<struct<start:int,end:int>>"
    found = spark.read.schema(schema).parquet(*[f"{folder}/part={at}" for at in range(parts)])
    spans = F.flatten(F.collect_list("spans"))
    return found.groupBy("text_key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.transform(spans, lambda s: s["start"]).alias("starts"),
        F.transform(spans, lambda s: s["end"]).alias("ends"),
    )


def _united(documents: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """The documents with the hits of their texts; stretches of several parts that overlap are one."""

    @F.pandas_udf(SCHEMA)
    def run(texts: pd.Series, items: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
        rows = []
        for text, ids, low, high in zip(texts, items, starts, ends, strict=True):
            merged: list[list[int]] = []
            for a, b in sorted(zip(low, high, strict=True)) if low is not None else []:
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], int(b))
                else:
                    merged.append([int(a), int(b)])
            n_hit = sum(len(normal_words(text[a:b])) for a, b in merged)
            rows.append((len(normal_words(text)), n_hit, [] if ids is None else list(ids), [{"start": a, "end": b} for a, b in merged]))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    key, items, starts, ends = (unused(documents, c) for c in ("text_key", "hit_items", "hit_starts", "hit_ends"))
    met = spread_join(documents.withColumn(key, F.sha2("text", 256)), found.toDF(key, items, starts, ends), key, "left")
    return put(met, name, run("text", items, starts, ends)).drop(key, items, starts, ends)


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a hit, with their columns."""
    found = unused(documents, "leaks")
    return scan(documents, benchmark, window, found).where(f"{found}.n_hit = 0").drop(found)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def summarise(found: DataFrame, name: str = "leaks") -> DataFrame:
    leaks = F.col(name)
    return found.select(
        "doc_id",
        leaks["n_words"].alias("n_words"),
        leaks["n_hit"].alias("n_hit"),
        F.size(leaks["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(leaks["items"], ","), 256).alias("items_sha256"),
        (leaks["n_hit"] > 0).alias("contaminated"),
    )
