"""Rule and lookup tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.enrich import UNKNOWN, app_ranges

GEO_FIELDS = [
    "continent", "country", "province", "city", "county", "operator", "code", "english", "short", "lon", "lat"
]

AUTH_DOMAIN = (
    "authDomain string, websiteName string, creditCode string, companyType string, companyName string, "
    "companyAddr string, onRecord string, websiteType string, soft string"
)
USER_CONTACT = "username string, doorDesc string, mobile string"
ONLINE_USER = "ip string, user string"
DISTRICT = "userName string, rid1 int, rid2 int, rid3 int, rid4 int"
DOMAIN_TAGS = "domain string, oneLabel string, twoLabel string, threeLabel string"
AUTH_TAGS = "authDomain string, websiteName string"


def jdbc_options(
    url: str, table: str, partition_column: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 16, **more: str
) -> dict[str, str]:
    """Reader options for a rule table in a database; a numeric column splits the read into parallel queries."""
    options = {"url": url, "dbtable": table, "fetchsize": "10000", **more}
    if partition_column and bounds:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(parts),
        }
    return options


def read_rules(spark: SparkSession, source: str, form: str = "parquet", **options: str) -> DataFrame:
    """A rule table: a path for file formats, or the table name for ``jdbc`` with its connection options."""
    if form == "jdbc":
        url = options.pop("url")
        return spark.read.format("jdbc").options(**jdbc_options(url, source, **options)).load()
    return spark.read.format(form).options(**options).load(source)


def business_rules(rules: DataFrame) -> DataFrame:
    return rules.select(
        F.col("min_long_ip").cast("bigint").alias("min_long_ip"),
        F.col("max_long_ip").cast("bigint").alias("max_long_ip"),
        F.col("s_id").cast("string").alias("resourceName"),
        F.col("company_id").cast("string").alias("resourceType"),
        F.col("resource_id").cast("string").alias("resourceProps"),
    )


def innet_rules(rules: DataFrame) -> DataFrame:
    return rules.select(
        F.col("min_long_ip").cast("bigint").alias("min_long_ip"),
        F.col("max_long_ip").cast("bigint").alias("max_long_ip"),
        "media_type",
    )


def client_rules(rules: DataFrame) -> DataFrame:
    return rules.select(
        F.col("min_long_ip").cast("bigint").alias("min_long_ip"),
        F.col("max_long_ip").cast("bigint").alias("max_long_ip"),
        F.col("client_type_id").cast("int").alias("client_type_id"),
    )


def white_domains(rules: DataFrame) -> DataFrame:
    return rules.select("domain")


def app_rules(rules: DataFrame) -> DataFrame:
    return app_ranges(rules).select("lo", "end", "appName")


def json_lookup(values: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Typed rows of a lookup whose values are JSON objects."""
    return values.select(F.inline(F.array(F.from_json(column, schema))))


def auth_domains(values: DataFrame) -> DataFrame:
    return json_lookup(values, AUTH_DOMAIN)


def mark_no_phone(contacts: DataFrame) -> DataFrame:
    """An empty phone is unknown."""
    return contacts.withColumn("mobile", F.when(F.col("mobile") == "", UNKNOWN).otherwise(F.col("mobile")))


def user_contacts(values: DataFrame) -> DataFrame:
    """Door and phone per user."""
    return mark_no_phone(json_lookup(values, USER_CONTACT))


def online_users(values: DataFrame) -> DataFrame:
    return json_lookup(values, ONLINE_USER)


def districts(values: DataFrame) -> DataFrame:
    return json_lookup(values, DISTRICT)


def domain_labels(values: DataFrame) -> DataFrame:
    return json_lookup(values, DOMAIN_TAGS)


def auth_labels(values: DataFrame) -> DataFrame:
    return json_lookup(values, AUTH_TAGS)


def geo_ranges(lines: DataFrame, column: str = "value") -> DataFrame:
    """Geo ranges from ``start, end, text`` rows whose text holds eleven ``|``-separated fields.

    Empty fields at the end do not count, and a text with fewer than eleven fields describes nothing.
    """
    fields = F.split(F.regexp_replace(column, r"\|+$", ""), r"\|")
    named = lines.where(F.size(fields) >= len(GEO_FIELDS))
    return named.select("lo", "hi", *[fields[i].alias(name) for i, name in enumerate(GEO_FIELDS)])
