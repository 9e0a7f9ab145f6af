"""The queries of the catalog in plain SQL, written from the report rules with naive joins.

Common table expressions are shared as text; a query carries those it names, and what they name in turn.
"""

from __future__ import annotations

import re

from ..functions.domains import AUTHORITY
from .queries import (
    DETAIL_ROWS,
    HIGH,
    LOW,
    PART_WINDOW,
    PER_CODE,
    PER_CODE_IPS,
    ROLL_WINDOW,
    SITES,
    USER_ERRORS,
    USER_ROWS,
    WINDOW,
)

CTES: dict[str, str] = {}
QUERIES: dict[str, str] = {}


def ip_long(text: str) -> str:
    a, b, c, d = (f"split_part({text}, '.', {i})::BIGINT" for i in (1, 2, 3, 4))
    return f"({a} * 16777216 + {b} * 65536 + {c} * 256 + {d})"


def long_ip(value: str) -> str:
    return " || '.' || ".join(f"(({value}) // {256**i} % 256)::VARCHAR" for i in (3, 2, 1, 0))


def authority(name: str) -> str:
    return f"coalesce(regexp_extract_all({name}, '{AUTHORITY}')[-1], {name})"




def client_ip(n: str) -> str:
    return f"'100.64.' || ({n} // 256) || '.' || ({n} % 256)"


def window_end(millis: str, seconds: int) -> str:
    return f"(({millis} // {seconds * 1000} + 1) * {seconds})::BIGINT"


def md5_of(*parts: str) -> str:
    return "md5(" + " || ".join(f"coalesce(({p})::VARCHAR, 'null')" for p in parts) + ")"


def day_key(day: str, *parts: str) -> str:
    return f"strftime(to_timestamp({day}), '%Y%m%d') || '_' || {md5_of(*parts)}"


def total(sql: str, name: str) -> str:
    return f"sum({sql})::BIGINT AS {name}"


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


def with_ctes(sql: str) -> str:
    """Prefix the expressions a query needs, in definition order."""
    needed: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in set(re.findall(r"\w+", text)) & CTES.keys():
            if name not in needed:
                needed.add(name)
                todo.append(CTES[name])
    # Lookups by address and the enriched rows are used several times and are worth computing once.
    used = [
        f"{name} AS {'MATERIALIZED ' if name.startswith(('ip_', 'top_', 'detail_')) else ''}(\n{body.strip()}\n)"
        for name, body in CTES.items()
        if name in needed
    ]
    return ("WITH " + ",\n".join(used) + "\n" if used else "") + sql.strip()


def oracle_queries() -> dict[str, str]:
    return {name: with_ctes(sql) for name, sql in QUERIES.items()}


# ---------------------------------------------------------------- inputs

cte(
    "hosts_v",
    """
    SELECT page_id, replace(regexp_extract(url, '^https?://([^/?#:]+)', 1), '.example.', '.ex' || (page_id % 40) || '.') AS host
    FROM pages
    """,
)
cte(
    "events_v",
    """
    SELECT *, epoch_us(ts) // 1000 AS at_ms, regexp_extract(props, '"k": *([0-9]+)', 1)::BIGINT AS k,
           event_id % (SELECT count(*) FROM pages) AS page_id
    FROM events
    """,
)
cte(
    "log_v",
    f"""
    SELECT event_id, host, k, event_type,
      CASE WHEN event_id % 97 = 0 THEN 'HOST-x' WHEN event_id % 89 = 0 THEN 'x.localdomain'
           WHEN event_id % 83 = 0 THEN 'printerDHCP' WHEN event_id % 79 = 0 THEN 'DHCP5.' || host ELSE host END AS "Domain",
      at_ms AS "Timestamp", '218.108.248.' || (180 + event_id % 76) AS "ServerIP", event_id % 10 <> 0 AS "QR",
      CASE WHEN event_type = 'signup' THEN 'AAAA' ELSE 'A' END AS "Type",
      CASE WHEN event_type <> 'error' THEN 0 WHEN k % 3 = 0 THEN 2 WHEN k % 3 = 1 THEN 3 ELSE 5 END::INTEGER AS "ResponseCode",
      {client_ip("user_id")} AS "ClientIP",
      CASE WHEN event_type IN ('error', 'signup') THEN []::VARCHAR[]
           ELSE list_concat([(1 + k % 25) || '.' || (k % 4 * 64) || '.' || (user_id % 256) || '.' || (1 + event_id % 250)],
             CASE WHEN k % 4 = 0 THEN [(1 + (k + 1) % 25) || '.10.0.' || (1 + event_id % 250)] ELSE []::VARCHAR[] END) END AS a_ips,
      CASE event_type WHEN 'error' THEN 0 WHEN 'signup' THEN 1 ELSE 1 + (k % 4 = 0)::INTEGER + (k % 5 = 0)::INTEGER END AS answers,
      CASE WHEN k % 5 = 0 THEN 'CNAME' ELSE 'A' END AS last_type
    FROM events_v JOIN hosts_v USING (page_id)
    """,
)
cte(
    "answer_v",
    """
    SELECT *, CASE WHEN len(a_ips) > 0 THEN a_ips[1 + "Timestamp" % len(a_ips)] ELSE '0.0.0.0' END AS aip,
      CASE WHEN "Type" = 'A' AND answers > 0 THEN last_type ELSE 'other' END AS responseType
    FROM log_v
    """,
)
cte(
    "flagged_v",
    """
    SELECT *, CASE WHEN "ResponseCode" <> 0 OR answers = 0 OR aip = '0.0.0.0' THEN 1 ELSE 0 END::BIGINT AS error FROM answer_v
    """,
)
NOISE_SQL = " AND ".join(
    [f"""NOT contains("Domain", '{p}')""" for p in ("master01", ".localdomain", " ", "HOST", "Relteak", "getCached", "BlinkAP")]
    + ["\"Domain\" <> ''", "NOT ends_with(\"Domain\", 'DHCP')"]
)
IN_NET = "\"QR\" AND split_part(\"ServerIP\", '.', 4)::INTEGER BETWEEN 192 AND 255"
cte(
    "clean_v",
    f"""
    SELECT event_id, "ResponseCode" AS responseCode, "Type" AS requestType, "ServerIP" AS dnsIp, aip, "Domain" AS domain,
      1::BIGINT AS resolver, error, responseType, "ClientIP" AS clientIp, "Timestamp" AS logTimestamp
    FROM flagged_v WHERE {NOISE_SQL} AND {IN_NET}
    """,
)
cte(
    "client_rule_v",
    """
    SELECT 1681915904 + 30 * r_regionkey::BIGINT AS lo, 1681915904 + 30 * r_regionkey::BIGINT + 39 AS hi,
      (r_regionkey + 1)::INTEGER AS id, r_regionkey::BIGINT AS ord
    FROM region WHERE r_regionkey < 4
    """,
)
cte(
    "business_rule_v",
    """
    SELECT (s_nationkey + 1)::BIGINT * 16777216 + (s_suppkey % 4) * 4194304 AS lo,
      (s_nationkey + 1)::BIGINT * 16777216 + (s_suppkey % 4) * 4194304 + 6291455 AS hi,
      s_suppkey::INTEGER AS s_id, s_nationkey AS company_id, (s_suppkey % 7)::INTEGER AS resource_id, s_suppkey AS ord
    FROM supplier
    """,
)
cte(
    "innet_rule_v",
    """
    SELECT (n_nationkey + 1)::BIGINT * 16777216 AS lo, (n_nationkey + 1)::BIGINT * 16777216 + 8388607 AS hi, n_name AS media_type
    FROM nation WHERE n_nationkey % 5 = 0
    """,
)
cte(
    "geo_v",
    """
    SELECT (n_nationkey + 1)::BIGINT * 16777216 AS lo, (n_nationkey + 1)::BIGINT * 16777216 + 16777215 AS hi, '洲' AS continent,
      CASE WHEN r_regionkey = 0 THEN '中国' ELSE r_name END AS country,
      CASE WHEN n_nationkey = 5 THEN '香港' ELSE n_name END AS province,
      CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE n_name || '_city' END AS city, '' AS county,
      CASE n_nationkey % 3 WHEN 0 THEN '电信' WHEN 1 THEN '联通' ELSE '移动' END AS operator,
      n_nationkey::VARCHAR AS code, n_name AS english, substr(n_name, 1, 2) AS short, '0' AS lon, '0' AS lat
    FROM nation JOIN region ON n_regionkey = r_regionkey
    """,
)
cte("whitelist_v", "SELECT DISTINCT host AS domain FROM hosts_v WHERE starts_with(host, 'blog.')")
cte("online_v", f"""SELECT {client_ip("c_custkey")} AS ip, c_name AS "user" FROM customer WHERE c_custkey % 10 <> 0""")
cte(
    "contact_v",
    """
    SELECT c_name AS username, 'addr ' || c_nationkey AS doorDesc,
      CASE WHEN c_custkey % 7 = 0 THEN '未知' ELSE (13000000000 + c_custkey)::VARCHAR END AS mobile
    FROM customer
    """,
)
cte(
    "site_v",
    f"""
    SELECT authDomain, 'site ' || authDomain AS websiteName, '' AS creditCode, 'T' || (length(authDomain) % 3) AS companyType,
      'co ' || authDomain AS companyName, '' AS companyAddr, '' AS onRecord, 'W' || (length(authDomain) % 2) AS websiteType, '' AS soft
    FROM (SELECT DISTINCT {authority("host")} AS authDomain FROM hosts_v) WHERE length(authDomain) % 2 = 0
    """,
)
cte(
    "tags_v",
    """
    SELECT DISTINCT host AS domain, 'L1_' || (length(host) % 2) AS oneLabel, 'L2_' || (length(host) % 4) AS twoLabel,
      CASE WHEN length(host) % 4 = 0 THEN '未知' ELSE 'L3_' || (length(host) % 5) END AS threeLabel
    FROM hosts_v WHERE length(host) % 3 <> 0
    """,
)
cte(
    "app_v",
    """
    SELECT split_part(r_name || ' seg', ' ', 1) AS appName, (r_regionkey * 5 + o)::BIGINT * 16777216 AS lo,
      (r_regionkey * 5 + o + 1)::BIGINT * 16777216 AS "end", r_regionkey AS ord
    FROM region, (VALUES (1), (3)) t(o)
    """,
)
FLOW_SECONDS = "(epoch_ms(l_shipdate) // 1000 + (l_orderkey * 37 + l_linenumber * 3600) % 86400)::BIGINT"
cte(
    "flow_v",
    f"""
    SELECT {FLOW_SECONDS} AS "timestamp", c_name AS clientName, '100.64.0.' || l_linenumber AS sourceIp,
      (1 + l_partkey % 25) || '.' || (l_partkey % 256) || '.0.1' AS destinationIp, l_quantity::BIGINT AS bytes
    FROM lineitem JOIN customer ON c_custkey = l_suppkey
    """,
)
cte(
    "weighted_v",
    """
    SELECT "timestamp", clientName, sourceIp, destinationIp, strftime(to_timestamp("timestamp"), '%H') AS hour, bytes * 2048 AS bytes
    FROM flow_v
    """,
)
cte(
    "flow_app_v",
    f"""
    SELECT w.*, coalesce((SELECT arg_max(appName, ord) FROM app_v
      WHERE {ip_long("w.destinationIp")} >= lo AND {ip_long("w.destinationIp")} < "end"), '其他') AS appName
    FROM weighted_v w
    """,
)
cte(
    "nat_v",
    f"""
    SELECT '10.0.' || (l_suppkey % 256) || '.1' AS data, l_returnflag AS types, l_quantity::BIGINT AS count,
      {FLOW_SECONDS} AS accesstime, l_linestatus
    FROM lineitem
    """,
)

# ---------------------------------------------------------------- shared lookups and reports

cte(
    "ip_client_v",
    f"""
    SELECT ip, coalesce(arg_min(id, ord), 5)::INTEGER AS clientName
    FROM (SELECT DISTINCT "ClientIP" AS ip FROM log_v) LEFT JOIN client_rule_v ON {ip_long("ip")} BETWEEN lo AND hi GROUP BY ip
    """,
)
cte(
    "ip_business_v",
    f"""
    SELECT aip, coalesce(arg_max(s_id, ord)::VARCHAR, '') AS resourceName, coalesce(arg_max(company_id, ord)::VARCHAR, '') AS resourceType,
      coalesce(arg_max(resource_id, ord)::VARCHAR, '') AS resourceProps
    FROM (SELECT DISTINCT aip FROM answer_v) LEFT JOIN business_rule_v ON {ip_long("aip")} BETWEEN lo AND hi GROUP BY aip
    """,
)
cte(
    "ip_innet_v",
    f"""
    SELECT aip, EXISTS (SELECT 1 FROM innet_rule_v WHERE {ip_long("aip")} BETWEEN lo AND hi)
      OR (EXISTS (SELECT 1 FROM business_rule_v WHERE {ip_long("aip")} BETWEEN lo AND hi)
          AND (SELECT count(*) FROM innet_rule_v) > 0) AS inside
    FROM (SELECT DISTINCT aip FROM answer_v)
    """,
)
cte(
    "ip_geo_v",
    f"SELECT aip, geo_v.* FROM (SELECT DISTINCT aip FROM answer_v) LEFT JOIN geo_v ON {ip_long('aip')} BETWEEN lo AND hi",
)
cte(
    "base_v",
    """
    SELECT c.*, clientName, coalesce(operator, '') AS operator, coalesce(province, '') AS province
    FROM clean_v c JOIN ip_client_v i ON i.ip = c.clientIp JOIN ip_geo_v g ON g.aip = c.aip
    """,
)
WINDOWS = {"day": WINDOW, "part": PART_WINDOW, "roll": ROLL_WINDOW, "five": 300}
for _name, _seconds in WINDOWS.items():
    cte(f"rows_{_name}", f"SELECT *, {window_end('logTimestamp', _seconds)} AS accesstime FROM base_v")


def count_sql(rows: str, types: str, dims: list[str], number: str = "sum(resolver)") -> str:
    dim = "".join(f", {d}" for d in dims)
    whole = f"SELECT accesstime, 0 AS clientName{dim}, {number}::BIGINT AS number, '{types}' AS types FROM {rows} GROUP BY accesstime{dim}"
    client = (
        f"SELECT accesstime, clientName{dim}, {number}::BIGINT AS number, '{types}' AS types FROM {rows} GROUP BY accesstime, clientName{dim}"
    )
    return f"{whole} UNION ALL {client}"


def qps_sql(rows: str, seconds: int) -> str:
    columns = "count(*)::BIGINT AS number, sum(error)::BIGINT AS error"
    return f"""
    SELECT *, 'qps' AS types, number // {seconds} AS avgNum, accesstime || 'qps_' || clientName AS key FROM (
      SELECT accesstime, 0 AS clientName, {columns} FROM {rows} GROUP BY accesstime
      UNION ALL SELECT accesstime, clientName, {columns} FROM {rows} GROUP BY accesstime, clientName)
    """


def ranked(source: str, group: str, order: str, k: int) -> str:
    return f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY {order}) AS rn FROM ({source})) WHERE rn <= {k}"


def code_sql(rows: str, item: str, types: str, k: int, per_client: bool) -> str:
    group = "accesstime, responseCode" + (", clientName" if per_client else "")
    counted = f"SELECT {group}, {item}, count(*)::BIGINT AS number FROM {rows} GROUP BY {group}, {item}"
    client = "" if per_client else ", 0 AS clientName"
    return f"SELECT *{client}, '{types}' AS types FROM ({ranked(counted, group, f'number DESC, {item}', k)})"


def authority_sql(rows: str, per_client: bool) -> str:
    group = "accesstime, responseCode" + (", clientName" if per_client else "")
    domains = code_sql(rows, "domain", "x", PER_CODE, per_client)
    summed = f"SELECT {group}, {authority('domain')} AS authorityDomain, sum(number)::BIGINT AS number FROM ({domains}) GROUP BY {group}, authorityDomain"
    client = "" if per_client else ", 0 AS clientName"
    order = "number DESC, authorityDomain"
    return f"SELECT *{client}, 'responseCodeAuthorityDomain' AS types FROM ({ranked(summed, group, order, PER_CODE)})"


SITE_COLUMNS = ["websiteName", "creditCode", "companyType", "companyName", "companyAddr", "onRecord", "websiteType", "soft"]
SITE_SQL = ", ".join(
    f"coalesce({c}, '{'未知' if c in ('companyType', 'websiteType') else ''}') AS {c}" for c in SITE_COLUMNS
)


def geo_sql(counted: str) -> str:
    def count_if(condition: str, name: str) -> str:
        return f"CASE WHEN {condition} THEN {counted} ELSE 0 END::BIGINT AS {name}"

    overseas = " OR ".join(f"contains(province, '{r}')" for r in ("香港", "澳门", "台湾"))
    place = "CASE WHEN city = province THEN province ELSE province || city END"
    return ", ".join(
        [
            count_if("country <> '中国'", "abroadNum"),
            count_if("contains(operator, '电信')", "telecomNum"),
            count_if("contains(operator, '联通')", "linkNum"),
            count_if(overseas, "gatNum"),
            f"coalesce(country || ({place}) || operator, '') AS aIpAddr",
        ]
    )


COUNTERS = ["resolver", "inNet", "error", "abroadNum", "telecomNum", "linkNum", "gatNum"]
DIMENSIONS = [
    "clientName", "authorityDomain", "dnsIp", "aip", "domain", "websiteName", "creditCode", "companyType", "companyName",
    "companyAddr", "onRecord", "websiteType", "soft", "resourceName", "resourceType", "resourceProps", "aIpAddr",
]
DOMAIN_KEY = [
    "authorityDomain", "domain", "websiteName", "creditCode", "companyType", "companyName", "companyAddr", "onRecord",
    "websiteType", "soft",
]
SUMS = ", ".join(total(c, c) for c in COUNTERS)

for _name in ("day", "part", "roll"):
    _rows = f"rows_{_name}"
    cte(
        f"four_{_name}",
        f"SELECT accesstime, clientName, domain, dnsIp, aip, {total('resolver', 'resolver')}, {total('error', 'error')} FROM {_rows} GROUP BY ALL",
    )
    cte(
        f"boosted_{_name}",
        f"""
        SELECT f.*, w.domain IS NOT NULL AS listed, resolver + CASE WHEN w.domain IS NOT NULL THEN 10 ELSE 0 END AS boosted
        FROM four_{_name} f LEFT JOIN whitelist_v w ON w.domain = f.domain
        """,
    )
    cte(
        f"top_{_name}",
        "SELECT r.* EXCLUDE (listed, boosted), resourceName, resourceType, resourceProps FROM ("
        + ranked(
            f"SELECT * FROM boosted_{_name} WHERE boosted >= 1",
            "accesstime",
            "boosted DESC, clientName, domain, dnsIp, aip",
            DETAIL_ROWS,
        )
        + ") r JOIN ip_business_v b ON b.aip = r.aip",
    )
    cte(
        f"detail_{_name}",
        f"""
        SELECT clientName, authorityDomain, dnsIp, t.aip AS aip,
          CASE WHEN contains(domain, 'https://') THEN replace(domain, 'https://', '') ELSE replace(domain, 'http://', '') END AS domain,
          resolver, CASE WHEN inside THEN resolver ELSE 0 END::BIGINT AS inNet, error, accesstime, {SITE_SQL},
          resourceName, resourceType, resourceProps, {geo_sql("resolver")}
        FROM (SELECT *, {authority("domain")} AS authorityDomain FROM top_{_name}) t
          JOIN ip_innet_v i ON i.aip = t.aip JOIN ip_geo_v g ON g.aip = t.aip
          LEFT JOIN site_v s ON s.authDomain = t.authorityDomain
        """,
    )
    cte(
        f"daytotal_{_name}",
        f"""
        SELECT *, {day_key("accesstime", *DIMENSIONS)} AS key FROM (
          SELECT accesstime // 86400 * 86400 AS accesstime, {", ".join(DIMENSIONS)}, {SUMS}
          FROM (SELECT * REPLACE (accesstime // 86400 * 86400 AS accesstime) FROM detail_{_name}) GROUP BY ALL)
        """,
    )
    cte(
        f"userrow_{_name}",
        f"""
        SELECT u.*, CASE WHEN inside THEN number ELSE 0 END::BIGINT AS inNet, coalesce("user", '') AS userName,
          coalesce(doorDesc, ' ') AS address, coalesce(mobile, ' ') AS phone
        FROM ({
            ranked(
                f'''SELECT accesstime, clientName, clientIp, domain, aip, {total('resolver', 'number')}, {total('error', 'error')}
                FROM {_rows} WHERE clientName = 1 GROUP BY ALL HAVING sum(resolver) > 0''',
                "accesstime",
                "number DESC, clientIp, domain, aip",
                USER_ROWS,
            )
        }) u JOIN ip_innet_v i ON i.aip = u.aip LEFT JOIN online_v o ON o.ip = u.clientIp LEFT JOIN contact_v c ON c.username = o."user"
        """,
    )
    cte(
        f"usererror_{_name}",
        "SELECT 'user' AS types, clientName, clientIp, userName, phone, address, domain, number, accesstime, error, inNet FROM ("
        + ranked(f"SELECT * FROM userrow_{_name}", "accesstime", "error DESC, number DESC, clientIp, domain, aip", USER_ERRORS)
        + ")",
    )
    cte(
        f"trend_{_name}",
        f"""
        SELECT *, accesstime || {md5_of("domain", "aip", "clientName")} AS key FROM (
          SELECT accesstime, clientName, domain, aip, companyName, authorityDomain, soft, websiteName, websiteType,
            {total("resolver", "resolver")}, {total("inNet", "inNet")}, {total("error", "error")}
          FROM detail_{_name} GROUP BY ALL) WHERE resolver > 0
        """,
    )
    cte(
        f"business_{_name}",
        "SELECT * REPLACE (resourceType || '/' || resourceProps AS resourceProps) FROM ("
        + count_sql(f"top_{_name}", "business", ["resourceName", "resourceType", "resourceProps"])
        + ")",
    )
cte(
    "userdomain_v",
    """
    SELECT accesstime, "user" AS userName, domain, resolver
    FROM (SELECT accesstime, clientIp, domain, count(*)::BIGINT AS resolver FROM rows_day GROUP BY ALL) JOIN online_v ON ip = clientIp
    """,
)
cte(
    "hour_v",
    f"""
    SELECT *, {day_key("accesstime", *DIMENSIONS)} AS key FROM (
      SELECT hour // 86400 * 86400 AS accesstime, * FROM (
        SELECT hour, {", ".join(DIMENSIONS)}, {SUMS}
        FROM (SELECT *, accesstime // 3600 * 3600 AS hour FROM detail_roll) GROUP BY ALL))
    """,
)
cte(
    "running_v",
    "SELECT * REPLACE ("
    + ", ".join(f"(sum({c}) OVER (PARTITION BY accesstime, key ORDER BY hour))::BIGINT AS {c}" for c in COUNTERS)
    + ") FROM hour_v",
)
cte(
    "labelled_v",
    f"""
    SELECT d.domain, coalesce(oneLabel, '未知') AS oneLabel, coalesce(twoLabel, '未知') AS twoLabel,
      CASE WHEN coalesce(threeLabel, '未知') = '未知' THEN coalesce(websiteName, '未知') ELSE threeLabel END AS threeLabel
    FROM (SELECT DISTINCT "Domain" AS domain FROM log_v) d LEFT JOIN tags_v t ON t.domain = d.domain
      LEFT JOIN site_v s ON s.authDomain = {authority("d.domain")}
    """,
)

# ---------------------------------------------------------------- nested text

REPRESENTATIVE = [c for c in DIMENSIONS if c not in ("clientName", "domain", "resourceType")]


def quoted(sql: str) -> str:
    return f"""'"' || replace({sql}, '"', '\\"') || '"'"""


def json_object(fields: dict[str, str]) -> str:
    inner = " || ',' || ".join(f"'\"{name}\":' || {value}" for name, value in fields.items())
    return "'{' || " + inner + " || '}'"


def types_sql(day: str, per_client: bool, time: str = "accesstime") -> str:
    keys = f"{time}, domain, resourceType" + (", clientName" if per_client else "")
    order = "ORDER BY resolver DESC, key DESC"
    reps = ", ".join(f"first({c} {order}) AS {c}" for c in [*REPRESENTATIVE, "key"])
    return f"SELECT {keys}, {SUMS}, {reps}, max(resolver) AS top_resolver FROM {day} GROUP BY {keys}"


def totals_sql(day: str, per_client: bool, nest: bool = False, time: str = "accesstime") -> str:
    keys = f"{time}, domain" + (", clientName" if per_client else "")
    order = "ORDER BY resolver DESC, key DESC"
    reps = ", ".join(f"first({c} {order}) AS {c}" for c in REPRESENTATIVE)
    client = "" if per_client else ", 0 AS clientName"
    summed = f"SELECT {keys}{client}, {SUMS}, {reps}, first(key {order}) AS oldKey FROM {day} GROUP BY {keys}"
    shown = f"{time}, clientName, authorityDomain, aip, dnsIp, domain, {', '.join(COUNTERS)}, oldKey"
    key = day_key("accesstime", "clientName", *DOMAIN_KEY)
    if not nest:
        return f"SELECT {key} AS key, {shown} FROM ({summed})"
    entry = json_object(
        {
            "resolver": "resolver",
            "inNet": "inNet",
            "error": "error",
            "resourceType": quoted("resourceType"),
            "resourceName": quoted("resourceName"),
            "resourceProps": quoted("resourceProps"),
        }
    )
    order = "resolver, inNet, error, resourceType, resourceName, resourceProps"
    nested = (
        f"SELECT {keys}, '[' || string_agg({entry}, ',' ORDER BY {order}) || ']' AS resourceTypes "
        f"FROM ({types_sql(day, per_client, time)}) GROUP BY {keys}"
    )
    return f"SELECT {key} AS key, {shown}, resourceTypes FROM ({summed}) JOIN ({nested}) USING ({keys})"


KNOWN_TAGS = "list_filter([oneLabel, twoLabel, threeLabel], lambda x: x <> '未知')"
# Distinct labels in first-seen order.
DISTINCT_TAGS = (
    f"list_filter({KNOWN_TAGS}, lambda x, i: list_position({KNOWN_TAGS}, x) = i)"
)
cte(
    "topdomains_v",
    "SELECT userName, '[' || string_agg("
    + json_object(
        {
            "domain": quoted("domain"),
            "resolver": "resolver",
            "tags": f"'[' || coalesce(array_to_string(list_transform({DISTINCT_TAGS}, lambda x: '\"' || x || '\"'), ','), '') || ']'",
        }
    )
    + ", ',' ORDER BY resolver DESC, domain) || ']' AS domains FROM ("
    + ranked(
        f"SELECT userName, domain, {total('resolver', 'resolver')} FROM userdomain_v GROUP BY ALL",
        "userName",
        "resolver DESC, domain",
        10,
    )
    + ") JOIN labelled_v USING (domain) GROUP BY userName",
)
cte(
    "topapps_v",
    "SELECT clientName, '[' || string_agg("
    + json_object({"app": quoted("appName"), "byte": "byte"})
    + ", ',' ORDER BY byte DESC, appName) || ']' AS apps FROM ("
    + ranked(f"SELECT clientName, appName, {total('bytes', 'byte')} FROM flow_app_v GROUP BY ALL", "clientName", "byte DESC, appName", 10)
    + ") GROUP BY clientName",
)
cte(
    "hourbytes_v",
    """
    SELECT clientName, hour, count(DISTINCT sourceIp) AS points, sum(bytes)::BIGINT // count(DISTINCT sourceIp) AS byte
    FROM weighted_v GROUP BY ALL
    """,
)
cte(
    "curve_v",
    "SELECT clientName, '[' || string_agg("
    + json_object({"hour": "hour::INTEGER", "byte": "byte"})
    + ", ',' ORDER BY hour::INTEGER) || ']' AS byte FROM hourbytes_v GROUP BY clientName",
)
cte(
    "usertags_v",
    """
    SELECT userName, list_sort(list(DISTINCT tag)) AS tags FROM (
      SELECT userName, unnest([oneLabel, twoLabel, threeLabel]) AS tag
      FROM (SELECT DISTINCT userName, domain FROM userdomain_v) JOIN labelled_v USING (domain) WHERE threeLabel <> '未知')
    WHERE tag <> '未知' GROUP BY userName
    """,
)

# ---------------------------------------------------------------- sources and sinks

EVENT_LINES = 'SELECT "Domain", "Timestamp", "ServerIP", "QR", "Type", "ResponseCode", "ClientIP", answers FROM log_v'
QUERIES["src_dns_json"] = f"{EVENT_LINES} WHERE event_id % 101 <> 0"
QUERIES["src_window_paths"] = """
    SELECT accesstime, slot, '/dns_log/' || strftime(to_timestamp(slot), '%Y/%m/%d/%H%M%S') || '_' || slot AS path
    FROM (SELECT DISTINCT ("Timestamp" // 300000 + 1) * 300 AS accesstime FROM log_v)
    JOIN (SELECT DISTINCT "Timestamp" // 10000 * 10 AS slot FROM log_v)
      ON slot >= accesstime - 310 AND slot <= accesstime - 10
"""
QUERIES["src_jdbc_rules"] = "SELECT lo AS min_long_ip, hi AS max_long_ip, s_id, company_id, resource_id, ord FROM business_rule_v"
QUERIES["src_user_domain_text"] = """
    SELECT userName, domain, resolver FROM userdomain_v
    UNION ALL SELECT DISTINCT userName, '', 1::BIGINT FROM userdomain_v
"""
QUERIES["src_flowmsg_tsv"] = "SELECT * FROM flow_v"
QUERIES["src_nat_text"] = "SELECT accesstime AS ts, data AS ip, count FROM nat_v"
QUERIES["src_report_range"] = (
    f"SELECT accesstime, clientName, requestType AS item, number, types FROM ({count_sql('rows_day', 'requestType', ['requestType'])}) "
    f"WHERE accesstime >= {LOW} AND accesstime < {HIGH}"
)
QUERIES["src_json_lookup"] = "SELECT * FROM site_v"
QUERIES["src_user_contact"] = "SELECT * FROM contact_v"
QUERIES["src_online_user"] = "SELECT * FROM online_v"
DISTRICT = "c_name AS userName, c_nationkey::INTEGER AS rid1, (c_custkey % 10)::INTEGER AS rid2, (c_custkey % 100)::INTEGER AS rid3, c_custkey::INTEGER AS rid4"
QUERIES["src_district"] = f"SELECT {DISTRICT} FROM customer"
QUERIES["src_domain_tags"] = "SELECT * FROM tags_v"
QUERIES["src_auth_tags"] = "SELECT authDomain, websiteName FROM site_v"
QUERIES["src_app_rules"] = 'SELECT lo, "end", appName FROM app_v'
QUERIES["src_business_rules"] = (
    "SELECT lo AS min_long_ip, hi AS max_long_ip, s_id::VARCHAR AS resourceName, company_id::VARCHAR AS resourceType, "
    "resource_id::VARCHAR AS resourceProps FROM business_rule_v"
)
QUERIES["src_innet_rules"] = "SELECT lo AS min_long_ip, hi AS max_long_ip, media_type FROM innet_rule_v"
QUERIES["src_client_rules"] = "SELECT lo AS min_long_ip, hi AS max_long_ip, id AS client_type_id FROM client_rule_v"
QUERIES["src_whitelist"] = "SELECT domain FROM whitelist_v"

QUERIES["sink_append"] = f"SELECT *, strftime(to_timestamp(accesstime), '%Y%m%d')::INTEGER AS dt FROM ({qps_sql('rows_day', WINDOW)})"
QUERIES["sink_upsert"] = f"""
    SELECT * REPLACE (CASE WHEN accesstime < {LOW} THEN -1 ELSE number END AS number),
      strftime(to_timestamp(accesstime), '%Y%m%d')::INTEGER AS dt
    FROM ({qps_sql("rows_day", WINDOW)})
"""
QUERIES["sink_user_domain_text"] = "SELECT userName || chr(1) || domain || chr(1) || resolver AS value FROM userdomain_v"
INNET_DOMAINS = """
    SELECT domain, first(aip ORDER BY accesstime, aip) AS aip, min(accesstime) AS accesstime, 1 AS counts
    FROM daytotal_day WHERE inNet > 0 GROUP BY domain
"""
QUERIES["sink_insert_if_absent"] = f"""
    SELECT domain, '0.0.0.0' AS aip, 0::BIGINT AS accesstime, 1 AS counts FROM whitelist_v
    UNION ALL SELECT * FROM ({INNET_DOMAINS}) WHERE domain NOT IN (SELECT domain FROM whitelist_v)
"""
QUERIES["sink_time_index"] = f"""
    SELECT *, strftime(to_timestamp(accesstime), '%Y')::INTEGER AS year, strftime(to_timestamp(accesstime), '%Y%m')::INTEGER AS month,
      strftime(to_timestamp(accesstime), '%Y%m%d')::INTEGER AS dt
    FROM ({qps_sql("rows_day", WINDOW)})
"""

# ---------------------------------------------------------------- projections, filters and joins

QUERIES["dns_parse_clean"] = """
    SELECT clientName, responseCode, requestType, dnsIp, aip, domain, resolver, error, operator, province, responseType, clientIp,
      logTimestamp, event_id
    FROM base_v WHERE event_id % 101 <> 0
"""
QUERIES["flt_domain_noise"] = f'SELECT event_id, "Domain" FROM log_v WHERE {NOISE_SQL}'
QUERIES["flt_time_window"] = (
    f'SELECT event_id, "Timestamp" FROM log_v WHERE "Timestamp" >= {LOW}000 AND "Timestamp" < {HIGH}000'
)
QUERIES["flt_server_cidr"] = f'SELECT event_id, "ServerIP" FROM log_v WHERE {IN_NET}'
QUERIES["prj_error_flag"] = "SELECT event_id, error FROM flagged_v"
QUERIES["prj_answer_ip"] = "SELECT event_id, aip FROM answer_v"
QUERIES["prj_response_type"] = "SELECT event_id, responseType FROM answer_v"
QUERIES["flt_bad_record"] = """
    SELECT event_id, "ResponseCode", CASE WHEN event_id % 19 = 0 THEN '10.0.1' ELSE "ClientIP" END AS "ClientIP"
    FROM log_v
    WHERE event_id % 13 <> 0 AND event_id % 17 <> 0
      AND NOT (event_id % 11 = 0 AND ("ResponseCode" = 0 OR "Type" = 'A'))
"""
USER_NOISE_SQL = " AND ".join(
    [f"NOT contains(domain, '{p}')" for p in ("null", "HOST", "Relteak", "getCached", "BlinkAP", "master01", ".localdomain")]
    + ["domain <> 'local'", "NOT ends_with(domain, 'arpa')"]
)
QUERIES["flt_user_domain"] = (
    f"SELECT userName, domain, {total('resolver', 'resolver')} FROM userdomain_v WHERE {USER_NOISE_SQL} GROUP BY ALL HAVING sum(resolver) > 1"
)
QUERIES["prj_strip_scheme"] = """
    SELECT page_id, name, CASE WHEN contains(name, 'https://') THEN replace(name, 'https://', '') ELSE replace(name, 'http://', '') END AS stripped
    FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN host WHEN 1 THEN 'http://' || host WHEN 2 THEN 'https://' || host
      ELSE 'http://' || host || '/https://' || host END AS name FROM hosts_v)
"""
SITES_SQL = " OR ".join(f"contains(%s, '{s}')" for s in SITES)
QUERIES["flt_top20_domains"] = f"SELECT * FROM hosts_v WHERE {SITES_SQL.replace('%s', 'host')}"
QUERIES["prj_none_to_empty"] = """
    SELECT event_id, CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 11 <> 0 THEN "Domain" ELSE 'null' END AS soft,
      CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 3 <> 0 THEN event_id::VARCHAR ELSE '0' END AS inNet
    FROM log_v
"""
QUERIES["prj_bytes_weight"] = 'SELECT "timestamp", clientName, hour, bytes FROM weighted_v'
QUERIES["flt_innet_domains"] = INNET_DOMAINS

QUERIES["join_client_by_range"] = 'SELECT event_id, "ClientIP" AS clientIp, clientName FROM log_v JOIN ip_client_v ON ip = "ClientIP"'
QUERIES["join_business_by_range"] = "SELECT event_id, aip, resourceName, resourceType, resourceProps FROM answer_v JOIN ip_business_v USING (aip)"
QUERIES["join_innet_flag"] = (
    "SELECT event_id, aip, resolver, CASE WHEN inside THEN resolver ELSE 0 END::BIGINT AS inNet FROM clean_v JOIN ip_innet_v USING (aip)"
)
QUERIES["join_app_by_range"] = 'SELECT "timestamp", clientName, destinationIp, appName FROM flow_app_v'
QUERIES["join_geo_by_range"] = "SELECT event_id, g.* EXCLUDE (lo, hi) FROM answer_v a JOIN ip_geo_v g ON g.aip = a.aip"
QUERIES["prj_geo_metrics"] = f"SELECT event_id, c.aip AS aip, resolver, {geo_sql('resolver')} FROM clean_v c JOIN ip_geo_v g ON g.aip = c.aip"
QUERIES["join_operator_province"] = (
    "SELECT event_id, a.aip AS aip, coalesce(operator, '') AS operator, coalesce(province, '') AS province "
    "FROM answer_v a JOIN ip_geo_v g ON g.aip = a.aip"
)
QUERIES["join_auth_domain"] = f"""
    SELECT event_id, "Domain" AS domain, {authority('"Domain"')} AS authorityDomain, {SITE_SQL}
    FROM log_v LEFT JOIN site_v ON authDomain = {authority('"Domain"')}
"""
QUERIES["join_online_user"] = 'SELECT event_id, "ClientIP" AS clientIp, "user" AS userName FROM log_v JOIN online_v ON ip = "ClientIP"'
QUERIES["join_user_contact"] = """
    SELECT event_id, "ClientIP" AS clientIp, coalesce("user", '') AS userName, coalesce(doorDesc, ' ') AS address, coalesce(mobile, ' ') AS phone
    FROM log_v LEFT JOIN online_v ON ip = "ClientIP" LEFT JOIN contact_v ON username = "user"
"""
QUERIES["join_whitelist_boost"] = "SELECT * FROM boosted_day"
QUERIES["join_domain_tags"] = 'SELECT event_id, l.* FROM log_v v JOIN labelled_v l ON l.domain = v."Domain"'
QUERIES["join_district"] = f"""
    SELECT userName, coalesce(rid1, 0) AS rid1, coalesce(rid2, 0) AS rid2, coalesce(rid3, 0) AS rid3, coalesce(rid4, 0) AS rid4
    FROM (SELECT userName FROM userdomain_v UNION ALL SELECT clientName || '?' FROM flow_v)
    LEFT JOIN (SELECT {DISTRICT} FROM customer) USING (userName)
"""
QUERIES["join_domain_type_nest"] = totals_sql("daytotal_day", False, nest=True)
QUERIES["join_district_as_of"] = """
    WITH snap AS (
      SELECT o_custkey::VARCHAR AS userName, year(o_orderdate) * 10000 + 101 AS dt, max(month(o_orderdate)) AS rid1, count(*) AS rid2
      FROM orders GROUP BY ALL),
    held AS (SELECT DISTINCT dt FROM snap),
    dated AS (
      SELECT l_orderkey, l_linenumber, o_custkey::VARCHAR AS userName, strftime(l_shipdate, '%Y%m%d')::INT AS day
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT l_orderkey, l_linenumber, d.userName AS userName, day, coalesce(rid1, 0) AS rid1, coalesce(rid2, 0) AS rid2
    FROM (SELECT *, (SELECT max(dt) FROM held WHERE dt <= day) AS last FROM dated) d
      LEFT JOIN snap s ON s.userName = d.userName AND s.dt = d.last
"""
QUERIES["join_domain_client_type_nest"] = totals_sql("daytotal_day", True, nest=True)
QUERIES["join_profile_full_outer"] = f"""
    SELECT '20240131_' || u.username AS id, 1706659200000::BIGINT AS accesstime, u.username AS username, coalesce(domains, '[]') AS domains,
      coalesce(resolver, 0)::BIGINT AS resolver,
      '[' || coalesce(array_to_string(list_transform(tags, lambda x: '"' || x || '"'), ','), '') || ']' AS tags,
      coalesce(bytes, 0)::BIGINT AS bytes, coalesce(apps, '[]') AS apps, coalesce(byte, '[]') AS byte,
      '[' || coalesce(rid1, 0) || ',' || coalesce(rid2, 0) || ',' || coalesce(rid3, 0) || ',' || coalesce(rid4, 0) || ']' AS rids
    FROM (SELECT userName AS username FROM userdomain_v UNION SELECT clientName FROM weighted_v) u
      LEFT JOIN topdomains_v d ON d.userName = u.username
      LEFT JOIN (SELECT userName, sum(resolver) AS resolver FROM userdomain_v GROUP BY ALL) r ON r.userName = u.username
      LEFT JOIN usertags_v t ON t.userName = u.username
      LEFT JOIN (SELECT clientName, sum(bytes) AS bytes FROM weighted_v GROUP BY ALL) b ON b.clientName = u.username
      LEFT JOIN topapps_v a ON a.clientName = u.username
      LEFT JOIN curve_v c ON c.clientName = u.username
      LEFT JOIN (SELECT {DISTRICT} FROM customer) x ON x.userName = u.username
"""
QUERIES["join_hour_points"] = "SELECT * FROM hourbytes_v"


def nat_hour_sql(where: str = "") -> str:
    return f"""
    SELECT hour, day * 1000 AS accesstime, types, data, {total("count", "count")}, day || '_' || types || '_' || data AS key
    FROM (SELECT DISTINCT accesstime // 3600 * 3600 AS hour, accesstime // 86400 * 86400 AS day, types, data, count FROM nat_v {where})
    GROUP BY ALL
    """


QUERIES["join_running_total"] = f"""
    SELECT n.* REPLACE ((n.count + coalesce(p.count, 0))::BIGINT AS count)
    FROM ({nat_hour_sql("WHERE l_linestatus = 'O'")}) n
    LEFT JOIN (SELECT key, sum(count)::BIGINT AS count FROM ({nat_hour_sql("WHERE l_linestatus = 'F'")}) GROUP BY key) p ON p.key = n.key
"""

# ---------------------------------------------------------------- aggregations

QUERIES["agg_qps"] = qps_sql("rows_day", WINDOW)
for _query, _dim in {
    "agg_request_type": "requestType",
    "agg_response_type": "responseType",
    "agg_response_code": "responseCode",
    "agg_dns_server": "dnsIp",
    "agg_province": "province",
    "agg_operator": "operator",
}.items():
    QUERIES[_query] = count_sql("rows_day", _dim, [_dim])
QUERIES["agg_business"] = "SELECT * FROM business_day"
QUERIES["agg_user_domain"] = "SELECT * FROM userdomain_v"
QUERIES["agg_four_key"] = "SELECT * FROM four_day"
QUERIES["agg_detail_enriched"] = "SELECT * FROM detail_day"
QUERIES["agg_trend_report"] = "SELECT * FROM trend_day"
QUERIES["agg_top20_authority"] = f"""
    SELECT f.*, resourceName, resourceType, resourceProps FROM four_day f JOIN ip_business_v b ON b.aip = f.aip
    WHERE resolver > 0 AND ({SITES_SQL.replace("%s", "domain")})
"""
QUERIES["agg_user_total"] = f"SELECT userName, {total('resolver', 'resolver')} FROM userdomain_v GROUP BY ALL"
QUERIES["agg_distinct_user_domain"] = "SELECT DISTINCT userName, domain FROM userdomain_v"
QUERIES["agg_user_tags"] = "SELECT userName, array_to_string(tags, ',') AS tags FROM usertags_v"
QUERIES["agg_user_bytes"] = f"SELECT clientName, {total('bytes', 'bytes')} FROM weighted_v GROUP BY ALL"
QUERIES["agg_hour_points"] = "SELECT clientName, hour, points FROM hourbytes_v"
QUERIES["agg_day_points"] = f"""
    SELECT clientName, "timestamp" // 86400 * 86400 AS day, count(DISTINCT sourceIp) AS points, {total("bytes", "bytes")}
    FROM flow_v GROUP BY ALL
"""
QUERIES["agg_user_24h"] = "SELECT * FROM curve_v"
QUERIES["agg_day_detail"] = "SELECT * FROM daytotal_part"
QUERIES["agg_hour_detail"] = "SELECT * FROM hour_v"
QUERIES["agg_domain_type"] = f"SELECT * EXCLUDE (top_resolver) FROM ({types_sql('daytotal_day', False)})"
QUERIES["agg_domain_type_client"] = f"SELECT * EXCLUDE (top_resolver) FROM ({types_sql('daytotal_day', True)})"
QUERIES["agg_domain_total"] = totals_sql("daytotal_day", False)
QUERIES["agg_domain_client"] = totals_sql("daytotal_day", True)
QUERIES["agg_nat_hour"] = nat_hour_sql()
QUERIES["agg_nat_day"] = f"""
    SELECT accesstime // 86400 * 86400000 AS accesstime, data, {total("count", "count")}, 'destinationIp' AS types
    FROM (SELECT * REPLACE (accesstime // 86400 * 86400 AS accesstime) FROM nat_v) GROUP BY accesstime, data
"""

# ---------------------------------------------------------------- top-k

QUERIES["topk_detail"] = "SELECT * FROM top_day"
QUERIES["topk_code_domain"] = code_sql("rows_day", "domain", "responseCodeDomain", PER_CODE, False)
QUERIES["topk_code_domain_client"] = code_sql("rows_day", "domain", "responseCodeDomain", PER_CODE, True)
QUERIES["topk_code_authority"] = authority_sql("rows_day", False)
QUERIES["topk_code_authority_client"] = authority_sql("rows_day", True)
QUERIES["topk_code_clientip"] = code_sql("rows_day", "clientIp", "responseCodeClientIP", PER_CODE_IPS, False)
QUERIES["topk_code_clientip_client"] = code_sql("rows_day", "clientIp", "responseCodeClientIP", PER_CODE_IPS, True)
QUERIES["topk_user_rows"] = "SELECT * FROM userrow_day"
QUERIES["topk_user_error"] = "SELECT * FROM usererror_day"
QUERIES["topk_user_domains"] = "SELECT * FROM topdomains_v"
QUERIES["topk_user_apps"] = "SELECT * FROM topapps_v"

# ---------------------------------------------------------------- rollups

ROLL_SOURCES = {
    "request_type": ("requestType", ["requestType"], count_sql("rows_roll", "requestType", ["requestType"])),
    "response_code": ("responseCode", ["responseCode"], count_sql("rows_roll", "responseCode", ["responseCode"])),
    "response_type": ("responseType", ["responseType"], count_sql("rows_roll", "responseType", ["responseType"])),
    "code_domain": (
        "responseCodeDomain",
        ["responseCode", "domain"],
        "SELECT accesstime, responseCode, domain, number, clientName FROM ("
        + code_sql("rows_roll", "domain", "responseCodeDomain", PER_CODE, False)
        + ") UNION ALL SELECT accesstime, responseCode, domain, number, clientName FROM ("
        + code_sql("rows_roll", "domain", "responseCodeDomain", PER_CODE, True)
        + ")",
    ),
    "code_clientip": (
        "responseCodeClientIP",
        ["responseCode", "clientIp"],
        "SELECT accesstime, responseCode, clientIp, number, clientName FROM ("
        + code_sql("rows_roll", "clientIp", "responseCodeClientIP", PER_CODE_IPS, False)
        + ") UNION ALL SELECT accesstime, responseCode, clientIp, number, clientName FROM ("
        + code_sql("rows_roll", "clientIp", "responseCodeClientIP", PER_CODE_IPS, True)
        + ")",
    ),
    "province": ("province", ["province"], count_sql("rows_roll", "province", ["province"])),
    "operator": ("operator", ["operator"], count_sql("rows_roll", "operator", ["operator"])),
    "business": ("business", ["resourceName", "resourceType", "resourceProps"], "SELECT * FROM business_roll"),
    "dns_server": ("dnsIp", ["dnsIp"], count_sql("rows_roll", "dnsIp", ["dnsIp"])),
}
SECONDS_OF = {"hh": 3600, "6h": 21600, "dd": 86400}


def roll_sql(source: str, dims: list[str], grain: str, measures: list[str]) -> str:
    """One rollup step."""
    fn = "sum" if grain == "dd" else "avg"
    keys = "".join(f", {d}" for d in dims)
    size = SECONDS_OF[grain]
    numbers = ", ".join(f"ceil({fn}({m}))::BIGINT AS {m}" for m in measures)
    return f"""
    SELECT accesstime, clientName{keys}, {numbers}
    FROM (SELECT * REPLACE (accesstime // {size} * {size} AS accesstime) FROM ({source})) GROUP BY accesstime, clientName{keys}
    """


def roll_chain(source: str, dims: list[str], grain: str, measures: list[str]) -> str:
    if grain == "6h":
        return roll_sql(roll_sql(source, dims, "hh", measures), dims, "6h", measures)
    return roll_sql(source, dims, grain, measures)


for _query, (_types, _dims, _source) in ROLL_SOURCES.items():
    for _grain in ("hh", "6h") if _query.startswith("code_") else ("hh", "6h", "dd"):
        QUERIES[f"roll_{_query}_{_grain}"] = f"SELECT *, '{_types}' AS types FROM ({roll_chain(_source, _dims, _grain, ['number'])})"


def roll_qps_sql(source: str, grain: str) -> str:
    fn = "sum" if grain == "dd" else "avg"
    size = SECONDS_OF[grain]
    return f"""
    SELECT accesstime // {size} * {size} AS accesstime, clientName, ceil({fn}(number))::BIGINT AS number, ceil({fn}(error))::BIGINT AS error,
      floor({fn}(number) / 300)::BIGINT AS avgNum
    FROM (SELECT * REPLACE (accesstime // {size} * {size} AS accesstime) FROM ({source})) GROUP BY accesstime, clientName
    """


_qps = qps_sql("rows_roll", ROLL_WINDOW)
for _grain, _sql in {
    "hh": roll_qps_sql(_qps, "hh"),
    "6h": roll_qps_sql(roll_qps_sql(_qps, "hh"), "6h"),
    "dd": roll_qps_sql(_qps, "dd"),
}.items():
    QUERIES[f"roll_qps_{_grain}"] = f"SELECT *, 'qps' AS types FROM ({_sql})"
_user = roll_chain("SELECT * FROM usererror_roll", ["userName", "clientIp", "domain", "phone", "address"], "hh", ["number", "inNet", "error"])
QUERIES["roll_user_hh"] = f"SELECT *, 'user' AS types FROM ({_user})"
_trend_dims = ["domain", "authorityDomain", "aip", "websiteType", "soft", "websiteName", "companyName"]
for _grain in ("hh", "6h"):
    _sql = roll_chain("SELECT * FROM trend_roll", _trend_dims, _grain, ["inNet", "error", "resolver"])
    QUERIES[f"roll_trend_{_grain}"] = f"SELECT *, 'trend' AS types FROM ({_sql})"

# ---------------------------------------------------------------- streaming and state

# An interval is closed once the data has moved five minutes past its end.
CLOSED = "accesstime <= (SELECT max(logTimestamp) // 1000 - 300 FROM clean_v)"
REPORTS = {
    "qps": qps_sql("rows_day", WINDOW),
    **{d: count_sql("rows_day", d, [d]) for d in ("requestType", "responseType", "responseCode", "dnsIp", "province", "operator")},
    **{f"responseCodeDomain{s}": code_sql("rows_day", "domain", "x", PER_CODE, bool(s)) for s in ("", "_client")},
    **{f"responseCodeAuthorityDomain{s}": authority_sql("rows_day", bool(s)) for s in ("", "_client")},
    **{f"responseCodeClientIP{s}": code_sql("rows_day", "clientIp", "x", PER_CODE_IPS, bool(s)) for s in ("", "_client")},
    "detail": "SELECT *, resolver AS number FROM detail_day",
    "business": "SELECT * FROM business_day",
    "trend": "SELECT *, resolver AS number FROM trend_day",
    "user_rows": "SELECT * FROM userrow_day",
    "user": "SELECT * FROM usererror_day",
    "user_domain": "SELECT *, resolver AS number FROM userdomain_v",
}


def summary_sql(where: str) -> str:
    """Rows and counted lookups of each report table and interval."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS report, accesstime, count(*) AS rows, sum(number)::BIGINT AS total FROM ({sql}) WHERE {where} GROUP BY accesstime"
        for name, sql in REPORTS.items()
    )


QUERIES["stream_5min_reports"] = summary_sql(CLOSED)
QUERIES["late_data_drop"] = f"""
    SELECT accesstime, {total("resolver", "resolver")}, {total("error", "error")} FROM rows_day WHERE {CLOSED} GROUP BY accesstime
"""
QUERIES["state_user_day"] = f"""
    SELECT *, 'user' AS types, {day_key("accesstime", "clientName", "userName", "domain", "clientIp")} AS key FROM (
      SELECT accesstime, clientName, userName, domain, clientIp, phone, address, {total("number", "number")}, {total("error", "error")},
        {total("inNet", "inNet")}
      FROM (SELECT * REPLACE (accesstime // 86400 * 86400 AS accesstime) FROM userrow_part) GROUP BY ALL)
"""
QUERIES["state_detail_day"] = "SELECT * FROM running_v"
QUERIES["state_domain_day"] = " UNION ALL ".join(
    f"SELECT * FROM ({totals_sql('running_v', per_client, nest=True, time='accesstime, hour')})" for per_client in (False, True)
)
QUERIES["backfill_range"] = summary_sql(f"accesstime > {LOW} AND accesstime <= {HIGH}")

# ---------------------------------------------------------------- scalar functions

_customer_ip = f"CASE WHEN c_custkey % 9 = 0 THEN '1.2.3' ELSE {client_ip('c_custkey')} END"
QUERIES["fn_ip_to_long"] = f"""
    SELECT c_custkey, {_customer_ip} AS ip, CASE WHEN c_custkey % 9 = 0 THEN 0 ELSE {ip_long(client_ip("c_custkey").join("()"))} END AS value
    FROM customer
"""
QUERIES["fn_long_to_ip"] = f"""
    SELECT *, {long_ip("value")} AS ip FROM (SELECT l_orderkey, l_linenumber, l_orderkey * 2654435761 % 4294967296 AS value FROM lineitem)
"""


def cidrs_sql(low: int) -> str:
    return f"""
    SELECT *, value - value % size AS lo, value - value % size + size - 1 AS hi FROM (
      SELECT c_custkey, {client_ip("(c_custkey * 7)")} AS ip, ({low} + c_custkey % {33 - low})::INTEGER AS bits,
        1681915904 + c_custkey * 7 AS value, (1::BIGINT << (32 - ({low} + c_custkey % {33 - low})))::BIGINT AS size
      FROM customer)
    """


QUERIES["fn_cidr_table"] = f"""
    SELECT c_custkey, ip, bits, lo, hi, {long_ip("lo")} AS begin_ip, {long_ip("hi")} AS end_ip, {long_ip("4294967296 - size")} AS mask,
      bits AS mask_bits, size AS addresses, CASE WHEN bits >= 32 THEN 0 ELSE size - 2 END AS usable_hosts
    FROM ({cidrs_sql(1)})
"""
QUERIES["fn_cidr_explode"] = f"""
    SELECT c_custkey, bits, host, {long_ip("host")} AS ip FROM (
      SELECT c_custkey, bits, unnest(generate_series(lo + (bits < 31)::INTEGER, hi - (bits < 31)::INTEGER)) AS host FROM ({cidrs_sql(24)}))
"""
QUERIES["fn_authority_domain"] = f"""SELECT event_id, "Domain", {authority('"Domain"')} AS authority FROM log_v"""
QUERIES["fn_md5_key"] = f"""
    SELECT event_id, {md5_of("event_id", 'CASE WHEN event_id % 7 <> 0 THEN "Domain" END', '"ClientIP"')} AS key FROM log_v
"""
QUERIES["fn_time_format"] = """
    SELECT event_id, strftime(make_timestamp("Timestamp" * 1000), '%Y%m%d%H%M') AS minute, strftime(make_timestamp("Timestamp" * 1000), '%Y%m%d') AS day,
      strftime(make_timestamp("Timestamp" * 1000), '%Y-%m-%d %H:%M:%S') AS text
    FROM log_v
"""
QUERIES["fn_task_windows"] = "SELECT event_id, " + ", ".join(
    f'"Timestamp" // {size}000 * {size} AS {name}_upper, "Timestamp" // {size}000 * {size} - {size} AS {name}_lower'
    for name, size in {"hour": 3600, "six_hours": 21600, "day": 86400, "five_minutes": 300}.items()
) + " FROM log_v"
for _name, _size in {"hour": 3600, "6h": 21600, "day": 86400}.items():
    QUERIES[f"fn_bucket_{_name}"] = f'SELECT event_id, "Timestamp" // {_size}000 * {_size} AS bucket FROM log_v'
QUERIES["fn_is_ip"] = """
    SELECT event_id, text, event_id % 3 = 2 AS is_ip
    FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN "Domain" WHEN 1 THEN "ClientIP" || '.9' ELSE "ClientIP" END AS text FROM log_v)
"""
QUERIES["fn_in_cidr"] = f"SELECT event_id, {ip_long('"ClientIP"')} BETWEEN 1681915936 AND 1681915967 AS inside FROM log_v"
