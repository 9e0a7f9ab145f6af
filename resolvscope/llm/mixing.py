"""Mixing sources to target weights: fixed-length blocks, drawn through pseudorandom permutations of each source."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resolvscope.llm.text import count_spaced, digest
from resolvscope.session import work_path

# Words of a block.
BLOCK = 64
# Parts a source's documents are numbered in, so that no task numbers a whole source.
PARTS = 1024
SHARDS = 64
CAP = 3
# Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
# Slots that one row of the draw stands for.
SLOTS = 1 << 16
SEED = 20240607
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sources_of(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, block: int = BLOCK) -> DataFrame:
    """(rank, source, source_size, weight, target, blocks, quota), one row for each source.

    Targets share the total size by weight; a target stops at ``cap`` times its source's size and the excess goes to the
    others by weight. Sources in order of how much of their cap a unit of weight fills are capped as long as the level
    that is left reaches their cap. ``quota`` is the target in blocks: all blocks as often as the target holds the whole
    source, the short last one too, and for what is left the nearest number of blocks of mean length.
    """
    whole = F.floor(F.col("target") / F.col("source_size"))
    rest = F.col("target") - whole * F.col("source_size")
    quota = whole * F.col("blocks") + F.round(rest * F.col("blocks") / F.col("source_size")).cast("long")
    summed = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    given = F.array(*[F.lit(w) for w in weights])
    ranked = summed.withColumn("rank", place).withColumn("weight", F.element_at(given, (F.col("rank") % len(weights) + 1).cast("int")))
    fill = Window.orderBy(cap * F.col("source_size") / F.col("weight"), "rank")
    all_rows = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    levels = ranked.select(
        "*",
        F.sum("source_size").over(all_rows).alias("total"),
        F.coalesce(F.sum(cap * F.col("source_size")).over(upto), F.lit(0)).alias("full"),
        F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
    ).withColumn("level", (F.col("total") - F.col("full")) / F.col("open"))
    capped = levels.withColumn("capped", F.col("level") * F.col("weight") >= cap * F.col("source_size"))
    free = F.when(~F.col("capped"), F.col("level"))
    # The level of the first source that is not capped holds for all after it.
    first = F.first(free, ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (
        capped.withColumn("target", F.when(F.col("capped"), (cap * F.col("source_size")).cast("double")).otherwise(first * F.col("weight")))
        .withColumn("blocks", F.ceil(F.col("source_size") / block))
        .withColumn("quota", F.when(F.col("source_size") > 0, quota).otherwise(F.lit(0).cast("long")))
        .select("rank", "source", "source_size", "weight", "target", "blocks", "quota")
    )


def permuted(slot: np.ndarray, size: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0 to size - 1: a four-round Feistel network, walked until it falls inside."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    shift = np.uint64(half)
    keys = np.random.SeedSequence(key).generate_state(4, np.uint64)
    out = slot.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for k in keys:
            mixed = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= size]
    return out.astype(np.int64)


def draw(sources: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(rank, block, shard, epoch): every block the mix takes, a row for each time.

    A source's quota is dealt to the output shards by a multinomial draw, so the counts of a shard vary as draws do while
    their sum is the quota. Slot ``i`` of a source takes block ``permutation(i mod blocks)`` of epoch ``i div blocks``, each
    epoch with a permutation of its own: a block is taken once more only when all others have been.
    """

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                counts = np.random.default_rng([seed, int(r.rank)]).multinomial(int(r.quota), np.full(shards, 1 / shards))
                ends = np.cumsum(counts)
                yield pd.DataFrame({"rank": r.rank, "blocks": r.blocks, "shard": np.arange(shards), "low": ends - counts, "high": ends})

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                slot = np.arange(r.low, r.high)
                for epoch in range(int(r.low // r.blocks), int((r.high - 1) // r.blocks) + 1):
                    own = slot[slot // r.blocks == epoch] % r.blocks
                    block = permuted(own, int(r.blocks), hash((seed, int(r.rank), epoch)) & 0xFFFFFFFF)
                    yield pd.DataFrame({"rank": r.rank, "block": block, "shard": r.shard, "epoch": epoch})

    pieces = (
        sources.where("quota > 0 AND blocks > 0")
        .select("rank", "blocks", "quota")
        .mapInPandas(deal, "rank int, blocks long, shard int, low long, high long")
        .where("high > low")
        .withColumn("from", F.explode(F.expr(f"sequence(low, high - 1, {SLOTS}L)")))
        .select("rank", "blocks", "shard", F.col("from").alias("low"), F.least(F.col("from") + SLOTS, "high").alias("high"))
    )
    # The pieces are few rows that stand for many, so their size tells Spark nothing: the number of tasks follows the slots.
    slots = sources.agg(F.sum("quota")).first()[0] or 0
    tasks = max(int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-slots // (16 * SLOTS)))
    return pieces.repartition(tasks, "rank", "shard", "low").mapInPandas(place, "rank int, block long, shard int, epoch int")


def mix(documents: DataFrame, kept: list[str], block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The documents' columns ``kept`` with a row number, and by row number what the mix takes.

    The second frame has row_id, size, source_size, target, taken and pieces, an array of (block, first word, words, times).
    Documents of a source stand in a pseudorandom order; their words are cut into blocks of ``block`` words across document
    ends. Words before a document are summed by part of the source first, so no task orders a whole source.

    Null and empty texts have size 0 and take nothing; a null source comes last. Repeated rows and ids are rows of their own.
    The frames are tables in the shared folder, so reruns of a task see the same rows.
    """
    spark = documents.sparkSession
    folder = work_path(spark, "mix")
    rows = documents.select(
        F.struct(*kept).alias("kept"),
        F.col("source").alias("source"),
        "doc_id",
        digest(F.col("text")).alias("digest"),
        count_spaced(F.col("text")).alias("size"),
    ).withColumn("row_id", F.monotonically_increasing_id())
    rows.write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    sources_of(rows, block=block).write.parquet(f"{folder}/sources")
    sources = spark.read.parquet(f"{folder}/sources")
    # A row for each source, so Spark broadcasts it as long as it is small.
    named = rows.select("row_id", "source", "doc_id", "digest", "size").withColumnRenamed("source", "own")
    placed = named.join(sources, F.col("own").eqNullSafe(F.col("source"))).withColumn(
        "part", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "digest"), F.lit(PARTS)).cast("int")
    )
    sums = placed.groupBy("rank", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("rank").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("rank", "part", F.coalesce(F.sum("part_size").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("rank", "part").orderBy("doc_id", "digest", "row_id").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(bases, ["rank", "part"])
        .select("row_id", "size", "rank", "source_size", "target", (F.col("base") + F.col("inside")).alias("start"))
    )
    first, last = (F.col("start") / block).cast("long"), ((F.col("start") + F.col("size") - 1) / block).cast("long")
    pieces = starts.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    times = draw(sources, shards, seed).groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))
    low = F.greatest(F.col("block") * block, "start")
    words = F.least((F.col("block") + 1) * block, F.col("start") + F.col("size")) - low
    piece = F.struct((low - F.col("start")).alias("first"), words.alias("words"), "times")
    taken = (
        # The draw's size is that of the corpus, but it is made from a few rows, from which Spark would guess it small.
        pieces.join(times.hint("merge"), ["rank", "block"], "left")
        .groupBy("row_id")
        .agg(
            F.first("size").alias("size"),
            F.first("source_size").alias("source_size"),
            F.first("target").alias("target"),
            F.coalesce(F.sum(words * F.col("times")), F.lit(0)).cast("long").alias("taken"),
            F.collect_list(F.when(F.col("times").isNotNull(), piece)).alias("pieces"),
        )
    )
    return rows.select("row_id", "kept"), taken


def cut(text: str, pieces: list[tuple[int, int, int]], size: int) -> list[str]:
    """The text as often as the mix takes it: time ``r`` holds the words taken ``r`` times at least."""
    made = []
    spans = None
    for r in range(1, max(p[2] for p in pieces) + 1):
        runs: list[list[int]] = []
        for first, words, times in sorted(pieces):
            if times < r:
                continue
            if runs and runs[-1][1] == first:
                runs[-1][1] = first + words
            else:
                runs.append([first, first + words])
        if runs == [[0, size]]:
            made.append(text)
            continue
        spans = spans or [m.span() for m in _WORD.finditer(text)]
        made.append("\n".join(text[spans[a][0] : spans[b - 1][1]] for a, b in runs))
    return made


def mixed_documents(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix as documents: a row for each time a document is taken, with the words taken then; same columns.

    ``n_chars`` is counted anew. Documents of which nothing is taken are gone.
    """
    columns = documents.columns
    rows, taken = mix(documents, columns, block)
    joined = rows.join(taken.where("taken > 0").select("row_id", "size", "pieces"), "row_id").select("kept.*", F.col("size").alias("__size"), F.col("pieces").alias("__pieces"))
    schema = T.StructType([documents.schema[c] for c in columns])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            pieces = [[(p["first"], p["words"], p["times"]) for p in row] for row in frame["__pieces"]]
            texts = [cut(t, p, n) for t, p, n in zip(frame["text"], pieces, frame["__size"], strict=True)]
            out = frame[columns].loc[frame.index.repeat([len(t) for t in texts])].reset_index(drop=True)
            out["text"] = [t for row in texts for t in row]
            if "n_chars" in columns:
                out["n_chars"] = [len(t) for t in out["text"]]
            yield out

    return joined.mapInPandas(run, schema)


def summarise(rows: DataFrame, taken: DataFrame) -> DataFrame:
    return rows.select("row_id", "kept.doc_id").join(taken, "row_id").select("doc_id", "size", "source_size", "target", "taken")
