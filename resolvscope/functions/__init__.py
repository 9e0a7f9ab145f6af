"""Scalar column expressions. All of them are Spark built-ins, so they stay inside code generation."""

from .domains import authority_domain, has_noise, in_top_sites, strip_scheme
from .ip import bounds_of_cidr, in_cidr, ip_to_long, is_ip, long_to_ip
from .keys import md5_key, report_key
from .times import (
    bucket_6h,
    bucket_day,
    bucket_hour,
    format_millis,
    task_windows,
    window_end,
)

__all__ = [
    "authority_domain",
    "bounds_of_cidr",
    "bucket_6h",
    "bucket_day",
    "bucket_hour",
    "format_millis",
    "has_noise",
    "in_cidr",
    "in_top_sites",
    "ip_to_long",
    "is_ip",
    "long_to_ip",
    "md5_key",
    "report_key",
    "strip_scheme",
    "task_windows",
    "window_end",
]
