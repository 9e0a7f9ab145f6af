"""From raw DNS answer logs to clean rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import has_noise, in_cidr, ip_to_long, is_ip
from ..functions.domains import has_user_noise
from ..functions.times import FIVE_MINUTES

# The resolver network, the address that stands for "no answer", and labels for what is not known.
RESOLVERS = "218.108.248.192/26"
NO_ADDRESS = "0.0.0.0"
OTHER_TYPE = "other"
UNKNOWN_CLIENT = 5

ANSWERS = T.ArrayType(T.StructType([T.StructField("Type", T.StringType()), T.StructField("Value", T.StringType())]))

# Every field is read as text first: the log writes numbers and flags quoted or bare.
LINE = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("Domain", "Timestamp", "ServerIP", "QR", "Type", "ResponseCode", "ClientIP", "Answers")
    ]
)

CLEAN_COLUMNS = [
    "clientName",
    "responseCode",
    "requestType",
    "dnsIp",
    "aip",
    "domain",
    "resolver",
    "error",
    "operator",
    "province",
    "responseType",
    "clientIp",
    "logTimestamp",
]


def compute_once(df: DataFrame, kept: list[str], **columns: Column) -> DataFrame:
    """Add costly columns through a one-row generator, so that later filters on them are not pushed below and do not
    evaluate the expressions again."""
    fields = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(fields)))


def typed_log(text_fields: DataFrame, *extra: str) -> DataFrame:
    """Give the text fields of a parsed line their types. ``Answers: ""`` is an empty list."""
    answers = F.when(F.trim("Answers") == "", F.array().cast(ANSWERS)).otherwise(F.from_json("Answers", ANSWERS))
    return compute_once(
        text_fields,
        [*extra, "Domain", "ServerIP", "Type", "ClientIP"],
        Timestamp=F.col("Timestamp").try_cast("bigint"),
        QR=F.col("QR").try_cast("boolean"),
        ResponseCode=F.col("ResponseCode").try_cast("int"),
        Answers=answers,
    )


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Parse JSON lines. A line that is no JSON object yields a row of nulls, which the filters drop."""
    kept = [c for c in lines.columns if c != column]
    fields = lines.select(*kept, F.inline(F.array(F.from_json(column, LINE))))
    return typed_log(fields, *kept)


def drop_noise(log: DataFrame) -> DataFrame:
    return log.where(~has_noise(F.col("Domain")))


def in_window(log: DataFrame, begin_millis: int, seconds: int = FIVE_MINUTES, column: str = "Timestamp") -> DataFrame:
    """Rows of the half-open interval ``[begin, begin + seconds)``."""
    at = F.col(column)
    return log.where((at >= begin_millis) & (at < begin_millis + seconds * 1000))


def answered_by(log: DataFrame, network: str = RESOLVERS) -> DataFrame:
    """Responses that one of our resolvers gave."""
    return log.where(F.col("QR") & in_cidr(F.col("ServerIP"), network))


def is_address_query() -> Column:
    return F.upper("Type") == "A"


def address_values() -> Column:
    return F.transform(F.filter("Answers", lambda x: x["Type"] == "A"), lambda x: x["Value"])


def pick_address(values: Column) -> Column:
    """One of the address answers, chosen by the time stamp so that a rerun chooses the same one."""
    index = F.pmod(F.col("Timestamp"), F.nullif(F.size(values), F.lit(0)).cast("bigint")).cast("int")
    return F.when(is_address_query() & (F.size(values) > 0), F.get(values, index)).otherwise(F.lit(NO_ADDRESS))


def response_type() -> Column:
    """Type of the last answer of an address query."""
    last = F.try_element_at("Answers", F.lit(-1))["Type"]
    return F.when(is_address_query() & (F.size("Answers") > 0), last).otherwise(F.lit(OTHER_TYPE))


def error_flag(address: Column) -> Column:
    failed = (F.col("ResponseCode") != 0) | (F.size("Answers") == 0) | (address == NO_ADDRESS)
    return F.when(failed, 1).otherwise(0).cast("bigint")


def drop_broken(log: DataFrame) -> DataFrame:
    """Drop records that lack what their kind of answer needs."""
    needs_answers = (F.col("ResponseCode") == 0) | F.coalesce(is_address_query(), F.lit(False))
    untyped = is_address_query() & F.exists("Answers", lambda x: x["Type"].isNull())
    return log.where(
        F.col("ResponseCode").isNotNull()
        & ~(needs_answers & F.col("Answers").isNull())
        & ~F.coalesce(untyped, F.lit(False))
        & ip_to_long(F.col("ClientIP")).isNotNull()
    )


def clean_log(log: DataFrame, *extra: str, network: str = RESOLVERS) -> DataFrame:
    """Noise, resolver and record filters, then the clean columns. Client and place come with the lookups."""
    kept = drop_broken(answered_by(drop_noise(log), network)).where(F.col("Timestamp").isNotNull())
    fields = ["Domain", "Timestamp", "ServerIP", "Type", "ResponseCode", "ClientIP", "Answers", *extra]
    listed = compute_once(kept, fields, values=address_values())
    chosen = listed.withColumn("aip", pick_address(F.col("values"))).where(is_ip(F.col("aip")))
    return chosen.select(
        F.col("ResponseCode").alias("responseCode"),
        F.col("Type").alias("requestType"),
        F.col("ServerIP").alias("dnsIp"),
        "aip",
        F.col("Domain").alias("domain"),
        F.lit(1).cast("bigint").alias("resolver"),
        error_flag(F.col("aip")).alias("error"),
        response_type().alias("responseType"),
        F.col("ClientIP").alias("clientIp"),
        F.col("Timestamp").alias("logTimestamp"),
        *extra,
    )


def keep_user_domains(rows: DataFrame, minimum: int = 1) -> DataFrame:
    """User-domain rows worth profiling: more than ``minimum`` lookups and a real name."""
    return rows.where((F.col("resolver") > minimum) & ~has_user_noise(F.col("domain")))


def none_to_empty(df: DataFrame, texts: list[str], numbers: list[str] = (), keep_null_mark: bool = True) -> DataFrame:
    """Clean text that a document store printed: ``None`` becomes empty; null becomes ``null`` (text) or ``0``."""
    null_text, null_number = (F.lit("null"), F.lit("0")) if keep_null_mark else (F.lit(""), F.lit(""))
    columns = {c: F.when(F.col(c) == "None", "").otherwise(F.coalesce(F.col(c), null_text)) for c in texts}
    columns |= {
        c: F.when(F.col(c) == "None", "").otherwise(F.coalesce(F.col(c).cast("string"), null_number)) for c in numbers
    }
    return df.withColumns(columns)
