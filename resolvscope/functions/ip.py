"""IPv4 addresses and networks as BIGINT arithmetic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = 1 << 32


def _with_parts(ip: Column, then: Callable[[Column], Column]) -> Column:
    """Apply ``then`` to the parts of an address. The lambda binds them, so the text is split once per use in a filter too."""
    # Trailing dots carry no octet.
    parts = F.split(F.rtrim(ip, F.lit(".")), r"\.")
    return F.when(ip.isNotNull(), F.get(F.transform(F.array(parts), then), F.lit(0)))


def _combine(parts: Column) -> Column:
    value = F.lit(0).cast("bigint")
    for i in range(4):
        value = F.shiftleft(value, 8).bitwiseOR(F.get(parts, F.lit(i)).try_cast("bigint"))
    return value


def ip_to_long(ip: Column) -> Column:
    """Dotted address to BIGINT. 0 unless there are four parts; null if a part is no number."""
    return _with_parts(ip, lambda parts: F.when(F.size(parts) == 4, _combine(parts)).otherwise(F.lit(0).cast("bigint")))


def ip_or_null(ip: Column) -> Column:
    """Dotted address to BIGINT; null unless there are four numeric parts."""
    return _with_parts(ip, lambda parts: F.when(F.size(parts) == 4, _combine(parts)))


def long_to_ip(value: Column) -> Column:
    octets = [F.shiftright(value, shift).bitwiseAND(F.lit(255)).cast("string") for shift in (24, 16, 8, 0)]
    return F.concat_ws(".", *octets)


def is_ip(text: Column) -> Column:
    """Four groups of one to three digits. The range of each group is not checked."""
    return text.rlike(r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$")


def parse_cidr(cidr: str) -> tuple[int, int]:
    """First and last address of a literal network such as ``10.1.0.0/16``."""
    address, bits = cidr.split("/")
    value = 0
    for octet in address.split("."):
        value = value * 256 + int(octet)
    size = 1 << (32 - int(bits))
    low = value - value % size
    return low, low + size - 1


def in_cidr(ip: Column, cidr: str) -> Column:
    """Membership in a literal network; null for a null or malformed address."""
    low, high = parse_cidr(cidr)
    return ip_or_null(ip).between(low, high)


def bounds_of_cidr(ip: Column, bits: Column) -> tuple[Column, Column]:
    """First and last address of the network ``ip/bits`` given as columns."""
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.lit(32) - bits).cast("int"))
    value = ip_to_long(ip)
    low = value - F.pmod(value, size)
    return low, low + size - F.lit(1)


def cidr_table(df: DataFrame, ip: str = "ip", bits: str = "bits") -> DataFrame:
    """Network facts per row: bounds, dotted mask, mask bits, address count and usable hosts."""
    low, high = bounds_of_cidr(F.col(ip), F.col(bits))
    size = (F.col("hi") - F.col("lo") + 1).alias("size")
    mask = F.lit(SPACE) - size
    usable = F.when((F.col(bits) <= 0) | (F.col(bits) >= 32), F.lit(0).cast("bigint")).otherwise(size - 2)
    return df.withColumns({"lo": low, "hi": high}).withColumns(
        {
            "begin_ip": long_to_ip(F.col("lo")),
            "end_ip": long_to_ip(F.col("hi")),
            "mask": long_to_ip(mask),
            "mask_bits": F.bit_count(mask).cast("int"),
            "addresses": size,
            "usable_hosts": usable,
        }
    )


def explode_hosts(df: DataFrame, lo: str, hi: str, block: int = 4096) -> DataFrame:
    """One row per address of ``[lo, hi]``.

    Addresses are produced block by block, so a wide range never becomes one huge array in one row.
    """
    blocks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(hi) - F.col(lo)) / block))
    start = F.col(lo) + F.col("_block") * block
    end = F.least(F.col(hi), start + F.lit(block - 1))
    return (
        df.where(F.col(lo) <= F.col(hi))
        .withColumn("_block", F.explode(blocks))
        .withColumn("host", F.explode(F.sequence(start, end)))
        .drop("_block")
    )


def explode_cidr(df: DataFrame, ip: str = "ip", bits: str = "bits") -> DataFrame:
    """Hosts of each network. The network and broadcast addresses are left out, except for /31 and /32."""
    low, high = bounds_of_cidr(F.col(ip), F.col(bits))
    edge = F.when(F.col(bits) >= 31, 0).otherwise(1)
    return explode_hosts(df.withColumns({"_lo": low + edge, "_hi": high - edge}), "_lo", "_hi").drop("_lo", "_hi")
