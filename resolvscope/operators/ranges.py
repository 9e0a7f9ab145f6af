"""Address-range lookups as equi joins.

A range ``[lo, hi]`` is a union of at most 64 aligned power-of-two blocks, and an address lies in exactly one block of
each of the 33 levels. Keeping only the winning rule per block settles "which rule wins for this address" with equality
on (level, block): no nested loop, no pairs of overlapping rules.

The blocks are flattened into disjoint segments, and those are cut at the edges of cells: a /16 where segments are few, a
/24 where a /16 is crowded, 16 addresses where a /24 is crowded too. A row meets the at most 16 segments of its cell,
whatever the number of rules. The index is a stored table, so Spark knows its size and chooses to broadcast or to shuffle.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import files
from ..functions.ip import SPACE
from ..session import shared_folder

BUCKET_BITS = 16
# Addresses of a cell, in bits: of a plain /16, of a /24 in a crowded /16, and inside a crowded /24.
WIDE, MIDDLE, NARROW = 16, 8, 4
# Segments that a cell holds before it is cut. A cell of 16 addresses cannot hold more.
CROWD = 16
MASKS = ["m0", "m1", "m2", "m3"]


def _up(value: Column, bits: Column | int) -> Column:
    return F.call_function("shiftright", value, bits if isinstance(bits, Column) else F.lit(bits))


def _down(value: Column, bits: Column | int) -> Column:
    return F.call_function("shiftleft", value, bits if isinstance(bits, Column) else F.lit(bits))


def _winner(column: Column, keep: str) -> Column:
    return F.max(column) if keep == "last" else F.min(column)


def range_blocks(
    rules: DataFrame, payload: Sequence[str], *, lo: str = "lo", hi: str = "hi", order: str = "ord", keep: str = "last"
) -> DataFrame:
    """Winning rule per aligned block: ``(level, block, rule)``. ``keep`` names the rule that wins where ranges overlap."""
    level = F.col("level")
    size = _down(F.lit(1).cast("bigint"), level)
    first, end = _up(F.col("lo") + size - 1, level), _up(F.col("hi") + 1, level)
    odd_first = F.when((first < end) & (first % 2 == 1), first)
    odd_end = F.when((first < end) & (end % 2 == 1), end - 1)
    rule = F.struct(F.col(order).alias("_order"), *[F.col(c) for c in payload])
    return (
        rules.where((F.col(lo) <= F.col(hi)) & F.col(hi).between(0, SPACE - 1) & (F.col(lo) >= 0))
        .select(F.col(lo).cast("bigint").alias("lo"), F.col(hi).cast("bigint").alias("hi"), rule.alias("rule"))
        # No block is larger than its range; one level more makes up for the logarithm's rounding.
        .withColumn("level", F.explode(F.sequence(F.lit(0), F.least(F.floor(F.log2(F.col("hi") - F.col("lo") + 1)).cast("int") + 1, F.lit(32)))))
        .withColumn("block", F.explode(F.array_compact(F.array(odd_first, odd_end))))
        .groupBy("level", "block")
        .agg(_winner(F.col("rule"), keep).alias("rule"))
    )


def block_buckets(blocks: DataFrame) -> DataFrame:
    """The /16 that blocks touch, not yet distinct. A wide block occurs once, whatever the number of rules."""
    level, block = F.col("level"), F.col("block")
    wide = _down(block, F.greatest(level - BUCKET_BITS, F.lit(0)))
    wide_end = _down(block + 1, F.greatest(level - BUCKET_BITS, F.lit(0))) - 1
    narrow = _up(block, F.greatest(F.lit(BUCKET_BITS) - level, F.lit(0)))
    return blocks.select(F.explode(F.when(level >= BUCKET_BITS, F.sequence(wide, wide_end)).otherwise(F.array(narrow))).alias("bucket"))


def range_segments(
    rules: DataFrame,
    payload: Sequence[str],
    *,
    lo: str = "lo",
    hi: str = "hi",
    order: str = "ord",
    keep: str = "last",
    only: DataFrame | None = None,
) -> DataFrame:
    """Disjoint ``(bucket, seg_lo, seg_hi, payload)`` rows with precedence settled; each lies in one bucket.

    ``only`` names the buckets (at most 65,536, each once) that are wanted; no other is worked on.
    """
    blocks = range_blocks(rules, payload, lo=lo, hi=hi, order=order, keep=keep)
    edges = rules.select(F.explode(F.array(F.col(lo).cast("bigint"), F.col(hi).cast("bigint") + 1)).alias("seg_lo"))
    starts = (
        edges.where(F.col("seg_lo").between(0, SPACE - 1))
        .unionByName(block_buckets(blocks).select(_down(F.col("bucket"), BUCKET_BITS).alias("seg_lo")))
        .withColumn("bucket", _up(F.col("seg_lo"), BUCKET_BITS))
    )
    if only is not None:
        starts = starts.join(F.broadcast(only), "bucket", "left_semi")
    levels = blocks.agg(F.collect_set("level")).scalar()
    settled = (
        starts.repartition("bucket")
        .distinct()
        .withColumn("level", F.explode(levels))
        .withColumn("block", _up(F.col("seg_lo"), F.col("level")))
        .join(blocks, ["level", "block"], "left")
        .groupBy("bucket", "seg_lo")
        .agg(_winner(F.col("rule"), keep).alias("rule"))
    )
    # At most 65,536 starts share a bucket.
    following = F.lead("seg_lo").over(Window.partitionBy("bucket").orderBy("seg_lo"))
    bucket_end = _down(F.col("bucket") + 1, BUCKET_BITS)
    return (
        settled.withColumn("seg_hi", F.coalesce(following, bucket_end) - 1)
        .where(F.col("rule").isNotNull())
        .select("bucket", "seg_lo", "seg_hi", *[F.col("rule")[c].alias(c) for c in payload])
    )


def crowds(segments: DataFrame) -> DataFrame:
    """``(bucket, m0..m3)`` of each crowded /16, at most 65,536 rows. The masks' 256 bits mark its crowded /24."""
    crowded = segments.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD).select("bucket")
    inside = segments.join(F.broadcast(crowded), "bucket").withColumn(
        "middle", F.explode(F.sequence(_up(F.col("seg_lo"), MIDDLE), _up(F.col("seg_hi"), MIDDLE)))
    )
    place = F.col("middle") % 256
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int"))
    marked = inside.groupBy("bucket", "middle").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD)
    masks = marked.groupBy("bucket").agg(
        *[F.bit_or(F.when(F.floor(place / 64) == i, bit).otherwise(F.lit(0).cast("bigint"))).alias(m) for i, m in enumerate(MASKS)]
    )
    return crowded.join(masks, "bucket", "left").withColumns({m: F.coalesce(m, F.lit(0).cast("bigint")) for m in MASKS})


def _is_marked(middle: Column) -> Column:
    """Whether the masks mark a /24."""
    place = middle % 256
    mask = F.element_at(F.array(*MASKS), (F.floor(place / 64) + 1).cast("int"))
    return F.call_function("shiftright", mask, (place % 64).cast("int")).bitwiseAND(F.lit(1).cast("bigint")) == 1


def cells(segments: DataFrame, crowded: DataFrame) -> DataFrame:
    """Segments with ``(_level, _cell)`` for each cell they touch.

    A plain /16 holds its segments once. A crowded one adds at most 256 rows to its more than 16, a crowded /24 at most 16.
    """
    middles = F.sequence(_up(F.col("seg_lo"), MIDDLE), _up(F.col("seg_hi"), MIDDLE))
    found = (
        segments.join(F.broadcast(crowded), "bucket", "left")
        .withColumn("middle", F.explode(F.when(F.col("m0").isNull(), F.array(F.lit(None).cast("bigint"))).otherwise(middles)))
        .withColumn("_level", F.when(F.col("middle").isNull(), WIDE).when(_is_marked(F.col("middle")), NARROW).otherwise(MIDDLE))
    )
    low = F.greatest(F.col("seg_lo"), _down(F.col("middle"), MIDDLE))
    high = F.least(F.col("seg_hi"), _down(F.col("middle") + 1, MIDDLE) - 1)
    touched = (
        F.when(F.col("_level") == WIDE, F.array("bucket"))
        .when(F.col("_level") == MIDDLE, F.array("middle"))
        .otherwise(F.sequence(_up(low, NARROW), _up(high, NARROW)))
    )
    return found.withColumn("_cell", F.explode(touched)).withColumnRenamed("bucket", "_bucket").drop("middle", *MASKS)


@dataclass(frozen=True)
class RangeIndex:
    """A rule table prepared for lookups: disjoint segments by cell, and where cells are narrow, both stored.

    :meth:`build` keeps what it makes, see :class:`IndexStore`; building again for equal rules reads it.
    """

    payload: tuple[str, ...]
    cells: DataFrame
    crowded: DataFrame

    @classmethod
    def build(
        cls, rules: DataFrame, payload: Sequence[str], *, lo: str = "lo", hi: str = "hi", order: str = "ord", keep: str = "last"
    ) -> RangeIndex:
        bounds = [F.col(c).cast("bigint").alias(n) for c, n in ((lo, "lo"), (hi, "hi"))]
        plain = rules.select(*bounds, F.col(order).alias("ord"), *payload)
        return IndexStore(plain, tuple(payload), keep).index()

    def match(self, facts: DataFrame, address: str) -> DataFrame:
        """Left join: add the payload of the winning rule, null where no range holds ``address``.

        The list of crowded /16 has at most 65,536 rows and is broadcast. The cells carry no hint: Spark broadcasts a table
        below its threshold, else both sides are shuffled and a hot cell is split at run time.
        """
        ip = F.col(address)
        level = F.when(F.col("m0").isNull(), WIDE).when(_is_marked(_up(ip, MIDDLE)), NARROW).otherwise(MIDDLE)
        crowded = F.broadcast(self.crowded.withColumnRenamed("bucket", "_bucket"))
        keyed = (
            facts.join(crowded, _up(ip, BUCKET_BITS) == F.col("_bucket"), "left")
            .withColumn("_at", level)
            .drop("_bucket", *MASKS)
            .withColumn("_in", _up(ip, F.col("_at")))
        )
        inside = (F.col("_at") == F.col("_level")) & (F.col("_in") == F.col("_cell")) & ip.between(F.col("seg_lo"), F.col("seg_hi"))
        return keyed.join(self.cells, inside, "left").drop("_at", "_in", "_level", "_cell", "_bucket", "seg_lo", "seg_hi")


# Indexes that this process has built or read, by application: rules, the state of their files, the index.
_RECALLED: dict[str, list[tuple[DataFrame, list, str, RangeIndex]]] = {}


def file_state(rules: DataFrame) -> list | None:
    """The files a frame is read from, with size and change time; none if it may change without one of them changing."""
    leaves = rules._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        kind = leaf.getClass().getSimpleName()
        stored = kind == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation"
        if not stored and kind not in ("LocalRelation", "Range", "OneRowRelation"):
            return None
    return files.stamps(rules.sparkSession, rules.inputFiles())


class IndexStore:
    """Indexes in the shared folder, named by the content of their rules.

    ``range-index/<shape>/<digest>`` is a small file, written last, that names the folder with the index's tables; without it
    a folder counts as absent, so a build that broke off, or two at once, do no harm. Rules that were read from the same
    unchanged files before are known without a job. Other rules are digested by one aggregate; an index of that digest is
    read, by whichever job it was built. Else the /16 that differ from the last index of this shape are rebuilt and the rest
    is copied; where they are more than half of it, all is built.
    """

    def __init__(self, plain: DataFrame, payload: tuple[str, ...], keep: str):
        self.spark, self.plain, self.payload, self.keep = plain.sparkSession, plain, payload, keep
        shape = hashlib.sha256(repr((plain.schema.simpleString(), keep)).encode()).hexdigest()[:24]
        self.family = f"{keep}-{shape}"
        self.folder = f"{shared_folder(self.spark)}/range-index/{self.family}"

    def index(self) -> RangeIndex:
        state = file_state(self.plain)
        recalled = _RECALLED.setdefault(self.spark.sparkContext.applicationId, [])
        if state is not None:
            for rules, seen, family, index in recalled:
                if (seen, family) == (state, self.family) and rules.sameSemantics(self.plain):
                    return index
        index = self._read(self._folder(self.digest()))
        if state is not None:
            recalled.append((self.plain, state, self.family, index))
        return index

    def digest(self) -> str:
        """A digest of the rules that does not depend on their order of rows."""
        one, two = F.xxhash64(*self.plain.columns), F.xxhash64(F.lit(1), *self.plain.columns)
        row = self.plain.agg(F.count(F.lit(1)), F.bit_xor(one), F.bit_xor(two), F.sum(F.pmod(one, F.lit(1 << 31)))).first()
        return hashlib.sha256(repr(tuple(row)).encode()).hexdigest()

    def _folder(self, digest: str) -> str:
        mark = f"{self.folder}/{digest}"
        named = files.read_text(self.spark, mark)
        if named is None:
            named = self._build(digest)
            if not files.publish_text(self.spark, mark, named):
                files.remove(self.spark, f"{self.folder}-{named}")
                named = files.read_text(self.spark, mark)
        return f"{self.folder}-{named}"

    def _table(self, folder: str, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{folder}/{name}")

    def _read(self, folder: str) -> RangeIndex:
        return RangeIndex(self.payload, self._table(folder, "cells"), self._table(folder, "crowded"))

    def _last(self) -> str | None:
        """Folder of the index of this shape that was built last, if it is still there."""
        for digest in files.names(self.spark, self.folder):
            named = files.read_text(self.spark, f"{self.folder}/{digest}") if "." not in digest else None
            if named and files.exists(self.spark, f"{self.folder}-{named}"):
                return f"{self.folder}-{named}"
        return None

    def touched(self, old: str) -> DataFrame:
        """The /16 (at most 65,536 rows) in which the rules differ from those that an index was built of."""
        before = self._table(old, "rules")
        changed = self.plain.exceptAll(before).unionAll(before.exceptAll(self.plain))
        return block_buckets(range_blocks(changed, self.payload, keep=self.keep)).distinct()

    def _build(self, digest: str) -> str:
        named = f"{digest[:16]}-{uuid.uuid4().hex}"
        target = f"{self.folder}-{named}"

        def stored(frame: DataFrame, name: str) -> DataFrame:
            frame.write.parquet(f"{target}/{name}")
            return self.spark.read.schema(frame.schema).parquet(f"{target}/{name}")

        old = self._last()
        only = stored(self.touched(old), "touched") if old else None
        if old and 2 * only.count() > self._table(old, "segments").select("bucket").distinct().count():
            old = only = None
        kept = {n: self._table(old, n) for n in ("segments", "crowded", "cells")} if old else {}
        if old:
            kept = {n: t.join(F.broadcast(only.withColumnRenamed("bucket", c)), c, "left_anti") for n, t in kept.items() for c in t.columns if c in ("bucket", "_bucket")}

        def whole(frame: DataFrame, name: str) -> DataFrame:
            return frame.unionByName(kept[name]) if old else frame

        with ThreadPoolExecutor(2) as pool:
            rules = pool.submit(stored, self.plain, "rules")
            new = range_segments(self.plain, self.payload, keep=self.keep, only=only)
            if old:
                # What is rebuilt is stored on its own first: crowds and cells are found for it alone.
                new = stored(new, "rebuilt")
            segments = stored(whole(new, "segments"), "segments")
            part = new if old else segments
            marks = stored(crowds(part), "marks") if old else stored(crowds(part), "crowded")
            if old:
                stored(whole(marks, "crowded"), "crowded")
            stored(whole(cells(part, marks), "cells"), "cells")
            rules.result()
        return named
