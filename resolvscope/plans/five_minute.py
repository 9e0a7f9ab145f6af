"""The interval job: every report of one or many intervals from one enriched log."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Collection, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import FIVE_MINUTES
from ..operators import counts, detail, topk
from ..operators.clean import clean_log
from ..operators.enrich import Lookups, enriched_log, with_client, with_place
from ..sinks.ledger import Ledger
from ..sinks.tables import append_interval, write_user_domains
from ..sources.logs import read_slots


Keep = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Sizes:
    """Thresholds and list lengths of the job."""

    seconds: int = FIVE_MINUTES
    detail_rows: int = detail.DETAIL_ROWS
    detail_minimum: int = detail.DETAIL_MINIMUM
    trend_minimum: int = detail.TREND_MINIMUM
    domains_per_code: int = topk.DOMAINS_PER_CODE
    addresses_per_code: int = topk.ADDRESSES_PER_CODE
    user_rows: int = topk.USER_ROWS
    user_errors: int = topk.USER_ERRORS
    user_minimum: int = topk.USER_MINIMUM


# Columns the reports group by. Client, operator and province depend on them and are looked up after the sum.
GROUPS = ["requestType", "responseType", "responseCode", "dnsIp", "aip", "domain", "clientIp"]


def base(log: DataFrame, lookups: Lookups, sizes: Sizes = Sizes()) -> DataFrame:
    """Clean, enriched rows with their interval: what a single report reads."""
    return counts.at_window(enriched_log(clean_log(log), lookups), sizes.seconds)


def interval_groups(log: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """Lookups and errors per interval and group: the log summed once for all reports."""
    rows = counts.at_window(clean_log(log), sizes.seconds)
    return rows.groupBy("accesstime", *GROUPS).agg(F.sum("resolver").alias("resolver"), F.sum("error").alias("error"))


def enrich_groups(groups: DataFrame, lookups: Lookups) -> DataFrame:
    return with_place(with_client(groups, lookups.clients), lookups.places)


def count_tables(rows: DataFrame, lookups: Lookups, sizes: Sizes = Sizes(), keep: Keep = lambda df: df) -> dict[str, DataFrame]:
    return {
        "qps": counts.qps(rows, sizes.seconds),
        **{types: counts.count_report(rows, types) for types in counts.COUNT_REPORTS},
    }


def code_tables(rows: DataFrame, lookups: Lookups, sizes: Sizes = Sizes(), keep: Keep = lambda df: df) -> dict[str, DataFrame]:
    tables = {}
    for suffix, per_client in (("", False), ("_client", True)):
        domains = keep(topk.top_domains(rows, sizes.domains_per_code, per_client))
        tables[f"responseCodeDomain{suffix}"] = domains
        tables[f"responseCodeAuthorityDomain{suffix}"] = topk.top_authorities(domains, sizes.domains_per_code, per_client)
        tables[f"responseCodeClientIP{suffix}"] = topk.top_addresses(rows, sizes.addresses_per_code, per_client)
    return tables


def detail_tables(rows: DataFrame, lookups: Lookups, sizes: Sizes = Sizes(), keep: Keep = lambda df: df) -> dict[str, DataFrame]:
    top = detail.top_detail(rows, lookups, sizes.detail_rows, sizes.detail_minimum)
    enriched = keep(detail.enrich_detail(top, lookups))
    return {
        "detail": enriched,
        "business": counts.business(enriched),
        "trend": detail.trend(enriched, sizes.trend_minimum),
    }


def user_tables(rows: DataFrame, lookups: Lookups, sizes: Sizes = Sizes(), keep: Keep = lambda df: df) -> dict[str, DataFrame]:
    busiest = keep(topk.top_user_rows(rows, lookups, sizes.user_rows, sizes.user_minimum))
    return {
        "user_rows": busiest,
        "user": topk.top_user_errors(busiest, sizes.user_errors),
        "user_domain": counts.user_domains(rows, lookups.online_user),
    }


FAMILIES = {
    count_tables: {"qps", *counts.COUNT_REPORTS},
    code_tables: {f"responseCode{item}{suffix}" for item in ("Domain", "AuthorityDomain", "ClientIP") for suffix in ("", "_client")},
    detail_tables: {"detail", "business", "trend"},
    user_tables: {"user_rows", "user", "user_domain"},
}


def all_tables(
    rows: DataFrame, lookups: Lookups, sizes: Sizes = Sizes(), keep: Keep = lambda df: df, only: Collection[str] | None = None
) -> dict[str, DataFrame]:
    """Every report table, or those named in ``only``.

    ``keep`` receives the frames that several tables are made from, so that a job can persist them.
    """
    tables = {}
    for build, names in FAMILIES.items():
        if only is None or names & set(only):
            tables |= build(rows, lookups, sizes, keep)
    return {name: table for name, table in tables.items() if only is None or name in only}


@contextmanager
def persisting() -> Iterator[Keep]:
    """Persist frames for the duration of a job. They spill to disk, and a lost executor recomputes its part."""
    kept: list[DataFrame] = []

    def keep(frame: DataFrame) -> DataFrame:
        kept.append(frame.persist(StorageLevel.MEMORY_AND_DISK))
        return kept[-1]

    try:
        yield keep
    finally:
        for frame in kept:
            frame.unpersist()


def run(log: DataFrame, lookups: Lookups, root: str, sizes: Sizes = Sizes()) -> list[str]:
    """Write every report table of the intervals in ``log`` under ``root`` and commit them; returns the tables' names.

    The same call backfills any range: intervals are a grouping column, not a loop. A run that broke off writes what is
    missing when it is called again; one that was committed is written anew.
    """
    with persisting() as keep:
        groups = keep(enrich_groups(interval_groups(log, sizes), lookups.prepare()))
        intervals = interval_list(groups)
        name = hashlib.sha256(repr(intervals).encode()).hexdigest()[:32]
        ledger = Ledger(log.sparkSession, root, f"run-{name}")
        if ledger.is_committed():
            ledger.reopen()
        return write_tables(all_tables(groups, lookups, sizes, keep), root, ledger, intervals)


def interval_list(groups: DataFrame) -> list[int]:
    """The intervals that rows belong to: 288 a day at most."""
    return [r[0] for r in groups.select("accesstime").distinct().orderBy("accesstime").collect()]


def run_interval(spark: SparkSession, source: str, end: int, lookups: Lookups, root: str, sizes: Sizes = Sizes()) -> list[str]:
    """The interval that ends at ``end``, from the ten-second directories under ``source``; replays leave the same rows."""
    at = F.col("Timestamp")
    log = read_slots(spark, source, end, sizes.seconds)
    return run(log.where((at >= (end - sizes.seconds) * 1000) & (at < end * 1000)), lookups, root, sizes)


def write_tables(tables: dict[str, DataFrame], root: str, ledger: Ledger, intervals: list[int], at_once: int = 4) -> list[str]:
    """Write the tables that the ledger has no mark for, a few at a time, and commit all; each is small, so one alone leaves executors idle."""
    done = ledger.written()

    def write(name: str) -> str:
        if name not in done:
            if name == "user_domain":
                write_user_domains(tables[name], f"{root}/{name}")
            else:
                append_interval(tables[name], f"{root}/{name}")
            ledger.mark(name)
        return name

    with ThreadPoolExecutor(at_once) as pool:
        names = list(pool.map(write, tables))
    ledger.commit(names, intervals)
    return names


def backfill(log: DataFrame, begin: int, end: int, lookups: Lookups, sizes: Sizes = Sizes()) -> dict[str, DataFrame]:
    """The report tables of every interval that starts in ``[begin, end)``, in epoch seconds."""
    at = F.col("Timestamp")
    groups = interval_groups(log.where((at >= begin * 1000) & (at < end * 1000)), sizes)
    return all_tables(enrich_groups(groups, lookups), lookups, sizes)
