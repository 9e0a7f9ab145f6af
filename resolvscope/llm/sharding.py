"""Shards by fixed virtual slots: records hash into slots, a versioned map sends slots to shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from resolvscope import files
from resolvscope.llm.components import _kept
from resolvscope.llm.text import digest
from resolvscope.session import work_path

SLOTS = 8192
# Parts of a slot within which rows are numbered, so that no task sorts a whole shard.
PARTS = 16


def slot_of(slots: int = SLOTS) -> Column:
    """Virtual slot of a record: a hash of id and text, so that rows without an id spread as well."""
    return F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1).cast("long")), F.coalesce("text", F.lit(""))), F.lit(slots)).cast("int")


def slot_loads(sized: DataFrame) -> DataFrame:
    """Bytes and rows of each slot in use: at most as many rows as there are slots."""
    return sized.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def balanced_map(loads: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """First version of the map (version, virtual_slot, shard, bytes): the largest slot goes to the lightest shard, in turn.

    One row holds the loads of all slots (a fixed number); higher-order functions place them.
    """
    ids = loads.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    every = ids.join(F.broadcast(loads), "virtual_slot", "left").select("virtual_slot", F.coalesce("bytes", F.lit(0)).alias("bytes"))
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("minus"), "virtual_slot")))
    start = F.struct(
        F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(F.lit(0).cast("long").alias("load"), F.lit(0).cast("long").alias("n"), s.alias("shard"))).alias("loads"),
        F.array().cast("array<int>").alias("placed"),
    )

    def place(state: Column, slot: Column) -> Column:
        lightest = F.array_min(state["loads"])
        return F.struct(
            F.transform(
                state["loads"],
                lambda s: F.when(
                    s["shard"] == lightest["shard"],
                    F.struct((s["load"] - slot["minus"]).alias("load"), (s["n"] + 1).alias("n"), s["shard"].alias("shard")),
                ).otherwise(s),
            ).alias("loads"),
            F.concat(state["placed"], F.array(lightest["shard"])).alias("placed"),
        )

    return (
        every.agg(ordered.alias("slots"))
        .withColumn("placed", F.aggregate("slots", start, place, lambda s: s["placed"]))
        .select(F.inline(F.arrays_zip("slots", "placed")))
        .select(F.lit(1).alias("version"), F.col("slots.virtual_slot").alias("virtual_slot"), F.col("placed").alias("shard"), (-F.col("slots.minus")).alias("bytes"))
    )


def rebalanced_map(current: DataFrame, shards: int) -> DataFrame:
    """Next version for one more shard: each old shard gives its smallest slots, up to its fair share of what the new one needs.

    Only slots that go to the new shard change; the map is edited, records are not hashed anew.
    """
    by_shard = Window.partitionBy("shard")
    running = by_shard.orderBy("bytes", "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    moved = F.sum("bytes").over(running) <= F.sum("bytes").over(by_shard) / (shards + 1)
    return current.select((F.col("version") + 1).alias("version"), "virtual_slot", F.when(moved, F.lit(shards)).otherwise(F.col("shard")).alias("shard"), "bytes")


def _version_path(folder: str, version: int) -> str:
    return f"{folder}/map/version={version}"


def newest_version(spark: SparkSession, folder: str) -> int:
    """The newest version of the map whose write has ended, 0 if there is none."""
    held = [int(n.split("=")[1]) for n in files.names(spark, f"{folder}/map") if n.startswith("version=")]
    return max((v for v in held if files.exists(spark, f"{_version_path(folder, v)}/_SUCCESS")), default=0)


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    """(version, virtual_slot, shard, bytes) of one version."""
    return spark.read.parquet(_version_path(folder, version)).select(F.lit(version).alias("version"), "virtual_slot", "shard", "bytes")


def write_map(slot_map: DataFrame, folder: str, version: int) -> int:
    """Store a version; what a writer that broke off has left of it is replaced."""
    slot_map.select("virtual_slot", "shard", "bytes").write.mode("overwrite").parquet(_version_path(folder, version))
    return version


def rebalance(documents: DataFrame, folder: str) -> DataFrame:
    """Grow the newest map in ``folder`` by one shard for the documents as they are now, and apply it to them.

    The loads of the slots are taken anew, the edited map is stored as the next version, and :func:`assign` places the
    records by it: a record changes its shard only if its slot goes to the new one. Older versions stay. A folder without a
    map raises. Nulls, repeated rows and an empty table are as in :func:`assign`.
    """
    spark = documents.sparkSession
    version = newest_version(spark, folder)
    if not version:
        raise ValueError(f"no slot map in {folder}")
    current = read_map(spark, folder, version)
    slots, last = current.agg(F.count(F.lit(1)), F.max("shard")).first()
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long")
    loads = slot_loads(documents.select(slot_of(slots).alias("virtual_slot"), size.alias("size")))
    now = current.drop("bytes").join(loads.select("virtual_slot", "bytes"), "virtual_slot", "left").fillna(0, ["bytes"])
    write_map(rebalanced_map(now, last + 1), folder, version + 1)
    return assign(documents, folder=folder)


def assign(documents: DataFrame, shards: int = 40, slots: int = SLOTS, folder: str | None = None) -> DataFrame:
    """The documents with ``size``, ``text_crc32``, ``virtual_slot``, ``shard`` and ``slot`` (place in the shard, gapless from 0).

    The law is near-equal bytes. Sizes are UTF-8 bytes plus 16. The slot-to-shard map is stored as a Parquet table with a
    version under ``folder`` (a fresh one in the shared folder if none is named). Where the folder holds a map, its newest
    version is applied, and its shards and slots count; else version 1 is made for ``shards``. :func:`rebalance` edits it.
    Places are counted in small parts of a slot and shifted by the rows of the parts before, so no task numbers a whole shard.

    Null texts count as empty, ids may be null or repeat; such rows are told apart by their text, and rows that are equal
    in both share a slot. A document larger than a fair share makes its shard that much larger. An empty table gives none.
    Input columns of the names added here are replaced, all others are kept.
    """
    spark = documents.sparkSession
    folder = folder or work_path(spark, "slot-map")
    version = newest_version(spark, folder)
    if version:
        slots = read_map(spark, folder, version).count()
    added = ["size", "text_crc32", "virtual_slot", "shard", "slot"]
    kept = [c for c in documents.columns if c.lower() not in added]
    packed = documents.select(
        F.struct(*[F.col(c) for c in kept]).alias("kept"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        slot_of(slots).alias("virtual_slot"),
        F.pmod(digest(F.coalesce("text", F.lit(""))), F.lit(PARTS)).cast("int").alias("part"),
    )
    parts = packed.groupBy("virtual_slot", "part").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    parts = _kept(parts, "slot-loads")
    if not version:
        loads = parts.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.sum("rows").alias("rows"))
        version = write_map(balanced_map(loads, shards, slots), folder, 1)
    slot_map = read_map(spark, folder, version)
    # Slots times parts bounds this table.
    before = Window.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.join(F.broadcast(slot_map.select("virtual_slot", "shard")), "virtual_slot")
        .withColumn("offset", F.coalesce(F.sum("rows").over(before), F.lit(0)))
        .select("virtual_slot", "part", "shard", "offset")
    )
    in_part = Window.partitionBy("virtual_slot", "part").orderBy("kept.doc_id", "text_crc32", "size")
    return (
        packed.withColumn("place", F.row_number().over(in_part) - 1)
        .join(offsets, ["virtual_slot", "part"])
        .select("kept.*", "size", "text_crc32", "virtual_slot", "shard", (F.col("offset") + F.col("place")).cast("long").alias("slot"))
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write each shard to a folder of its own; a shard is written by as many tasks as it has slots' worth of rows."""
    sharded.repartition("shard", F.pmod("virtual_slot", F.lit(8))).write.mode("overwrite").partitionBy("shard").parquet(path)


def summarise(sharded: DataFrame) -> DataFrame:
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")
