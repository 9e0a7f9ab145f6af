"""Raw logs and text inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import FIVE_MINUTES
from ..operators.clean import LINE, typed_log

# A log directory covers ten seconds and is named by its start.
SLOT_SECONDS = 10
SLOT_PATTERN = "yyyy/MM/dd/HHmmss"
FIELD = "\u0001"

USER_DOMAIN = "userName string, domain string, resolver string"
FLOW = "timestamp bigint, clientName string, sourceIp string, destinationIp string, bytes bigint"


def read_dns_json(spark: SparkSession, paths: str | Sequence[str], *extra: str) -> DataFrame:
    """JSON lines of many directories as one frame, parsed once in the scan. Lines that are no JSON give null rows."""
    schema = LINE
    for column in extra:
        schema = schema.add(column, "string")
    paths = [paths] if isinstance(paths, str) else list(paths)
    return typed_log(spark.read.schema(schema).json(paths), *extra)


def stream_dns_json(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same lines as they arrive."""
    reader = spark.readStream.schema(LINE)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return typed_log(reader.json(path))


def slot_paths(windows: DataFrame, seconds: int = FIVE_MINUTES, root: str = "/dns_log") -> DataFrame:
    """Directories an interval reads: its own ten-second slots and the one before, where stragglers lie.

    ``windows`` has ``accesstime``, the interval end; one row per directory comes back.
    """
    first = F.col("accesstime") - seconds - SLOT_SECONDS
    slots = F.sequence(first, F.col("accesstime") - SLOT_SECONDS, F.lit(SLOT_SECONDS).cast("bigint"))
    stamp = F.date_format(F.timestamp_seconds("slot"), SLOT_PATTERN)
    return windows.select("accesstime", F.explode(slots).alias("slot")).withColumn(
        "path", F.concat(F.lit(root + "/"), stamp, F.lit("_"), F.col("slot").cast("string"))
    )


def existing_slots(windows: DataFrame, slots: DataFrame, seconds: int = FIVE_MINUTES, root: str = "/dns_log") -> DataFrame:
    """The directories of each interval that exist; ``slots`` lists the slot starts present."""
    return slot_paths(windows, seconds, root).join(slots.select("slot").distinct(), "slot", "left_semi")


def read_slots(spark: SparkSession, root: str, end: int, seconds: int = FIVE_MINUTES) -> DataFrame:
    """JSON lines of the directories that the interval ending at ``end`` reads, those that exist, as one frame.

    An interval has a fixed number of directories, so listing them is no work that grows with the data.
    """
    windows = spark.range(1).select(F.lit(end).cast("bigint").alias("accesstime"))
    paths = [r["path"] for r in slot_paths(windows, seconds, root.rstrip("/")).select("path").collect()]
    hadoop = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    system = hadoop[0].getFileSystem(spark._jsc.hadoopConfiguration())
    found = [p for p, h in zip(paths, hadoop, strict=True) if system.exists(h)]
    if not found:
        return typed_log(spark.createDataFrame([], LINE))
    return read_dns_json(spark, found)


def read_window(spark: SparkSession, path: str, begin: int, seconds: int = FIVE_MINUTES) -> DataFrame:
    """Rows of a table partitioned by ``dt`` and ``hhmm`` that the interval can hold: only those partitions are read.

    The partition before the interval is read too. A table without any of them gives no rows.
    """
    low, high = begin - SLOT_SECONDS, begin + seconds

    def minute(second: int):
        return F.date_format(F.timestamp_seconds(F.lit(second)), "yyyyMMddHHmm")

    table = spark.read.option("basePath", path).parquet(path)
    at = F.concat(F.col("dt").cast("string"), F.lpad(F.col("hhmm").cast("string"), 4, "0"))
    return table.where((at >= minute(low)) & (at <= minute(high)))


def read_if_exists(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], schema)


def read_user_domains(spark: SparkSession, path: str) -> DataFrame:
    """``user, domain, n`` text. A short line has an empty user or domain and one lookup."""
    text = spark.read.schema(USER_DOMAIN).csv(path, sep=FIELD, quote="", escape="")
    return text.select(
        F.coalesce("userName", F.lit("")).alias("userName"),
        F.coalesce("domain", F.lit("")).alias("domain"),
        F.coalesce(F.col("resolver").try_cast("bigint"), F.lit(1)).cast("bigint").alias("resolver"),
    )


def read_flows(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Five tab-separated fields per line; a line of another shape fails the job."""
    return spark.read.schema(FLOW).csv(path, sep="\t", quote="", mode=mode)


def parse_nat_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(ts,ip,count)`` lines. Lines without the three fields are dropped."""
    fields = F.split(column, "[,()]")
    return lines.select(
        F.get(fields, F.lit(1)).try_cast("bigint").alias("ts"),
        F.get(fields, F.lit(2)).alias("ip"),
        F.get(fields, F.lit(3)).try_cast("bigint").alias("count"),
    ).where("ts is not null and count is not null")


def read_nat(spark: SparkSession, path: str) -> DataFrame:
    return parse_nat_lines(spark.read.text(path))
