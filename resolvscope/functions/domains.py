"""Domain-name rules."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public suffixes in match order. ``$`` anchors a suffix at the end of the name; the others match
# anywhere. A dot inside a suffix stands for any character.
SUFFIXES = """
com.cn arpa com.hk com$ net.cn net
gov.cn gov org.cn org edu.com edu.cn edu.hk edu cn
cc$ tv$ me$ info$ la$ so$ mobi$ co$
im$ biz$ io$ in$ name$ fm$ cm$ us$ pw$
tw$ sh$ asia$ de$ mx$ vc$ gg$ tm$ ac$
gd$ gs$ am$ tt$ bz$ to$ ly$ li$ jp$
ms$ pro$ eu$ lu$ ru$ ch$ ma$ home$ mo$
dj$ re$ cz$ ai$ sg$ id$ ph$ ec$ cd$
travel$ nu$ my$ pk$ aero$ hn$ ba$ uk$ es$
""".split()
AUTHORITY = r"[0-9a-zA-Z\-]+\.(?:" + "|".join(SUFFIXES) + ")"

# Name fragments that mark machine noise.
NOISE = ["master01", ".localdomain", " ", "HOST", "Relteak", "getCached", "BlinkAP"]
NOISE_SUFFIX = "DHCP"

# Name fragments that mark noise in the user-domain file.
USER_NOISE = ["null", "HOST", "Relteak", "getCached", "BlinkAP", "master01", ".localdomain"]
USER_NOISE_NAME = "local"
USER_NOISE_SUFFIX = "arpa"

# The twenty busiest sites.
TOP_SITES = [
    "qq.com", "baidu.com", "taobao.com", "p2cdn.com", "root-servers.net",
    "jd.com", "sina.com.cn", "microsoft.com", "360.com", "w3.org",
    "aliyun.com", "360.cn", "apple.com", "hicloud.com", "ys7.com",
    "163.com", "cuhk.edu.hk", "redhat.com", "miwifi.com", "vivo.com.cn",
]


def any_literal(text: Column, parts: Iterable[str]) -> Column:
    """True where the text holds any of the literal parts. Plain byte searches beat one regex alternation."""
    return reduce(or_, [F.contains(text, F.lit(part)) for part in parts])


def authority_domain(name: Column) -> Column:
    """Last suffix match of the name, or the name itself."""
    matches = F.regexp_extract_all(name, F.lit(AUTHORITY), F.lit(0))
    return F.coalesce(F.try_element_at(matches, F.lit(-1)), name)


def has_noise(name: Column) -> Column:
    """True for names that are no real lookups: empty, holding a noise fragment or ending in the DHCP mark."""
    return (name == "") | any_literal(name, NOISE) | name.endswith(NOISE_SUFFIX)


def has_user_noise(name: Column) -> Column:
    return any_literal(name, USER_NOISE) | (name == USER_NOISE_NAME) | name.endswith(USER_NOISE_SUFFIX)


def in_top_sites(name: Column, sites: Iterable[str] = TOP_SITES) -> Column:
    return any_literal(name, sites)


def strip_scheme(name: Column) -> Column:
    """Remove ``http://``; where ``https://`` occurs, remove only that."""
    secure = F.lit("https://")
    return F.when(F.contains(name, secure), F.replace(name, secure, F.lit(""))).otherwise(
        F.replace(name, F.lit("http://"), F.lit(""))
    )
