"""SQL that computes each query's answer straight from the base tables."""

from __future__ import annotations


def _dot3(n: str) -> str:
    return f"('10.' || ({n} // 65536 % 256) || '.' || ({n} // 256 % 256) || '.' || ({n} % 256))"


def _dot2(n: str) -> str:
    return f"('10.' || ({n} // 256 % 256) || '.' || ({n} % 256) || '.')"


_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"
_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"
_HOST = "regexp_extract(url, '^https?://([^/?#]+)', 1)"
_SEEN = "'2024-06-01T00:00:00Z'"
_EVENT_IP = f"({_dot2('user_id')} || (event_id % 256))"

_SCANS = f"""
  SELECT {_dot3('event_id')} AS ip, 8000 + {_K} AS port,
         CASE WHEN event_type = 'click' THEN 'udp' ELSE 'tcp' END AS proto,
         CASE WHEN event_type = 'error' THEN 'title'
              WHEN event_type = 'view' AND cents >= 1000 THEN 'http' END AS service,
         CASE WHEN event_type NOT IN ('error', 'view') THEN NULL
              WHEN event_type = 'error' AND cents < 2000 THEN '404 Not Found'
              WHEN cents > 9000 THEN NULL
              ELSE 'v ' || cents || ' end' END AS banner,
         user_id % 256 AS ttl, {_ISO.format('ts')} AS seen
  FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events)
"""

_ZONE_ROWS = f"""
  SELECT o_orderstatus AS st, o_custkey AS c, o_orderkey AS ok,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'ns' WHEN '2' THEN 'a' WHEN '3' THEN 'mx'
              WHEN '4' THEN 'nsec' ELSE 'soa' END AS type,
         (60 + o_orderkey % 1000) || ' ' || CASE substr(o_orderpriority, 1, 1)
              WHEN '1' THEN 'ns' || o_orderkey || '.example'
              WHEN '2' THEN {_dot3('o_orderkey')}
              WHEN '3' THEN '10 m' || o_orderkey || '.example'
              WHEN '4' THEN 'n' || o_orderkey || '.example A NSEC.'
              ELSE 'a.example b.example ' || o_orderkey END AS rec
  FROM orders
"""
_ZONE_SOURCE = """
  SELECT st, c, CASE WHEN min(ok) > any_value(cut) THEN 'axfr' ELSE 'czds' END AS source
  FROM zr JOIN (SELECT st, min(ok) FILTER (type = 'ns') AS cut FROM zr GROUP BY st) USING (st) GROUP BY st, c
"""

_CERT_NAMES = f"""
  SELECT DISTINCT page_id, url, {_HOST} AS host, unnest([{_HOST}, regexp_replace({_HOST}, '^[^.]+\\.', '')]) AS domain
  FROM pages
"""

_BATCH_ROWS = """
  SELECT o_custkey AS key, o_orderkey AS ok, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'O' END AS st, substr(o_orderpriority, 1, 1) AS rank,
         CASE WHEN substr(o_orderpriority, 1, 1) <> '1' THEN o_orderpriority END AS priority
  FROM orders
"""


def _size(n: str) -> str:
    steps = [f"WHEN {n} < {1024 ** (i + 1)} THEN printf('%.1f{u}', {n} / {float(1024 ** i)})"
             for i, u in enumerate(("bytes", "kb", "mb", "gb", "tb"))]
    return "CASE " + " ".join(steps) + " END"


def _count_reason(source: str, reason: str, table: str, condition: str) -> str:
    return (f"SELECT '{source}' AS source, '{reason}' AS reason, count(*) AS rows FROM {table} "
            f"WHERE {condition} HAVING count(*) > 0")


_RANK = "substr(o_orderpriority, 1, 1)"
_REJECTS = [
    ("port_scan", "malformed JSON", "events", "event_type = 'signup'"),
    ("port_scan", "bad or missing port", "events", "event_type = 'purchase'"),
    ("reverse_names", "fewer than 3 fields", "lineitem", "l_returnflag NOT IN ('R', 'A')"),
    ("zone", "unsupported class", "orders", f"{_RANK} = '2'"),
    ("zone", "bad ttl", "orders", f"{_RANK} = '3'"),
    ("zone", "unsupported type", "orders", f"{_RANK} = '4'"),
    ("zone", "fewer than 5 fields", "orders", f"{_RANK} = '5'"),
    ("delegations", "bad country code", "part", "p_type = 'SMALL'"),
    ("delegations", "bad IP range", "part", "p_type = 'LARGE'"),
    ("transfers", "bad transfer type", "orders", "o_orderstatus = 'P'"),
]
_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
           "conversations").split()

_DAY = "strftime(DATE '2000-01-01' + CAST(p_partkey % 8000 AS INTEGER), '%Y-%m-%dT00:00:00Z')"
_PART_DATE = f"CASE WHEN p_type NOT IN ('SMALL', 'LARGE') THEN {_DAY} END"
_V4_END = "(167772160 + (p_partkey // 256 % 256) * 65536 + (p_partkey % 256) * 256 + 256 * (1 + p_size) - 1)"
_PART_HEX = "lower(hex(p_partkey % 65536))"
_SUPP_HEX = "lower(hex(s_suppkey % 65536))"
_TAIL5 = "':ffff:ffff:ffff:ffff:ffff'"
_SAME_NET = "user_id // 256 % 256 = s_suppkey // 256 % 256 AND user_id % 256 = s_suppkey % 256"
_LISTED = f"EXISTS (SELECT 1 FROM supplier WHERE {_SAME_NET} AND event_id % 256 < 128)"

ORACLE = {
    "port_scan_parse": _SCANS,
    "port_services": f"""
        SELECT port, service, count(*) AS records, count(DISTINCT ip) AS addresses, count(banner) AS banners
        FROM ({_SCANS}) WHERE NOT coalesce(service = 'title' AND banner = '404 Not Found', false)
        GROUP BY port, service""",
    "web_probe_parse": f"""
        SELECT '2024-01-14T13:08:' || lpad(CAST(page_id % 60 AS VARCHAR), 2, '0') || 'Z' AS timestamp,
               CASE WHEN url LIKE 'https%' THEN 443 ELSE 80 END AS port, url, {_HOST} AS input,
               split_part(url, ':', 1) AS scheme, length(html) AS content_length, md5(html) AS body,
               '200,301' AS codes, page_id AS page, 1 AS extras, {_HOST} AS cname FROM pages""",
    "ptr_names": f"SELECT DISTINCT {_dot3('l_suppkey')} AS ip, 'p' || l_partkey || '.example.net' AS record FROM lineitem",
    "ptr_documents": f"""
        SELECT {_dot3('l_suppkey')} AS ip, 0 AS part, count(DISTINCT l_partkey) AS names,
               string_agg(DISTINCT 'p' || l_partkey || '.example.net', ',' ORDER BY 'p' || l_partkey || '.example.net') AS record,
               {_SEEN} AS seen FROM lineitem GROUP BY l_suppkey""",
    "ptr_runs": """
        WITH a AS (SELECT o_orderkey AS ok, o_custkey AS c, o_orderstatus AS st,
                          CASE WHEN lag(o_orderstatus) OVER (ORDER BY o_orderkey) = o_orderstatus THEN 0 ELSE 1 END AS s
                   FROM orders),
             b AS (SELECT *, sum(s) OVER (ORDER BY ok) AS run FROM a),
             d AS (SELECT run, st, c, min(ok) AS first FROM b GROUP BY run, st, c)
        SELECT min(first) AS started, CASE st WHEN 'F' THEN '10.0.0.1' WHEN 'O' THEN '10.0.0.2' ELSE '10.0.0.3' END AS ip,
               string_agg('c' || c || '.example', ',' ORDER BY first) AS record
        FROM d GROUP BY run, st""",
    "ptr_stream_upsert": f"""
        SELECT {_dot3('user_id')} AS ip,
               arg_max('192.0.2.' || {_K}, event_id) FILTER (event_type = 'view') AS nameserver,
               arg_max('h' || {_K} || '.example', event_id) AS record,
               arg_max({_K} * 10, event_id) FILTER (event_type IN ('click', 'purchase')) AS ttl,
               arg_max({_K}, event_id) FILTER (event_type = 'view') AS asn
        FROM events WHERE event_type <> 'error' GROUP BY user_id""",
    "straddling_batches": f"""
        SELECT {_dot3('l_suppkey')} AS ip, 0 AS part, count(DISTINCT l_partkey) AS names,
               string_agg(DISTINCT 'p' || l_partkey || '.example.net', ',' ORDER BY 'p' || l_partkey || '.example.net') AS record
        FROM lineitem GROUP BY l_suppkey""",
    "carried_marks": f"""
        WITH zr AS (SELECT st, c, ok, type, rec FROM ({_ZONE_ROWS}), (SELECT max(o_orderkey) // 2 AS middle FROM orders)
                    WHERE st <> 'P' OR ok <= middle), src AS ({_ZONE_SOURCE})
        SELECT lower(st) || '.example' AS zone, 'c' || c || '-' || lower(st) || '.example' AS domain,
               any_value(source) AS source, type, string_agg(rec, ';' ORDER BY ok) AS records
        FROM zr JOIN src USING (st, c) GROUP BY st, c, type""",
    "zone_documents": f"""
        WITH zr AS ({_ZONE_ROWS}), src AS ({_ZONE_SOURCE})
        SELECT lower(st) || '.example' AS zone, 'c' || c || '.example' AS domain, any_value(source) AS source, type,
               string_agg(rec, ';' ORDER BY ok) AS records
        FROM zr JOIN src USING (st, c) GROUP BY st, c, type""",
    "zone_upsert": f"""
        WITH zr AS ({_ZONE_ROWS}), src AS ({_ZONE_SOURCE}),
             t AS (SELECT c, type, max(st) AS st FROM zr GROUP BY c, type),
             n AS (SELECT c, type, count(*) AS n FROM zr JOIN t USING (c, type, st) GROUP BY c, type),
             z AS (SELECT c, max(st) AS st FROM zr GROUP BY c)
        SELECT 'c' || c || '.example' AS domain, 0 AS part, lower(any_value(z.st)) || '.example' AS zone, any_value(source) AS source,
               string_agg(type, ',' ORDER BY type) AS types, CAST(sum(n) AS BIGINT) AS records
        FROM n JOIN z USING (c) JOIN src USING (c, st) GROUP BY c""",
    "nested_match": f"""
        SELECT DISTINCT lower(o_orderstatus) || '.example' AS zone, 'c' || o_custkey || '.example' AS domain
        FROM orders WHERE {_RANK} = '2' AND o_orderkey // 256 % 256 < 40""",
    "certificate_domains": f"""
        SELECT domain, md5(arg_max(url, page_id)) AS fingerprint, arg_max(split_part(url, ':', 1), page_id) AS issuer,
               arg_max(host, page_id) AS cn, 1 AS subjects, {_SEEN} AS seen
        FROM ({_CERT_NAMES}) GROUP BY domain""",
    "delegation_blocks": f"""
        SELECT 'arin' AS registry, 'us' AS cc, CAST(NULL AS BIGINT) AS asn_start, CAST(NULL AS BIGINT) AS asn_end,
               {_dot2('p_partkey')} || '0' AS ip_start,
               ({_V4_END} // 16777216) || '.' || ({_V4_END} // 65536 % 256) || '.' || ({_V4_END} // 256 % 256) || '.'
                 || ({_V4_END} % 256) AS ip_end,
               {_PART_DATE} AS date, 'allocated' AS status, lower(p_brand) AS extensions, {_SEEN} AS seen FROM part
        UNION ALL
        SELECT 'ripencc', 'de', NULL, NULL, '2001:db8:' || {_PART_HEX} || '::', '2001:db8:' || {_PART_HEX} || {_TAIL5},
               {_PART_DATE}, 'assigned', NULL, {_SEEN} FROM part
        UNION ALL
        SELECT 'apnic', NULL, 4200000000 + p_partkey, 4200000000 + p_partkey + p_size - 1, NULL, NULL,
               {_PART_DATE}, 'reserved', NULL, {_SEEN} FROM part""",
    "transfer_rows": f"""
        SELECT strftime(o_orderdate, '%Y-%m-%dT19:00:00Z') AS transfer_date, {_dot2('o_orderkey')} || '0' AS first,
               {_dot2('o_orderkey')} || '255' AS last, o_custkey AS asn,
               CASE o_orderstatus WHEN 'F' THEN 'MERGER_ACQUISITION' ELSE 'RESOURCE_TRANSFER' END AS type,
               'org ' || o_custkey AS organization FROM orders WHERE o_orderstatus IN ('F', 'O')""",
    "blocklist_documents": f"""
        WITH e AS (SELECT CASE WHEN l_linestatus = 'F' THEN {_dot2('l_suppkey')} || '0/24'
                               ELSE {_dot2('l_suppkey')} || l_linenumber || '/32' END AS ip,
                          lower(l_returnflag || '_' || l_linestatus) AS list,
                          CASE WHEN l_linestatus = 'F' THEN 'cat ' || l_returnflag END AS cat FROM lineitem)
        SELECT ip, string_agg(DISTINCT list, ',' ORDER BY list) AS ipsets,
               coalesce(string_agg(DISTINCT cat, ',' ORDER BY cat), '') AS categories FROM e GROUP BY ip""",
    "licence_parse": """
        SELECT c_custkey AS license_id, c_name AS callsign,
               CASE c_mktsegment WHEN 'MACHINERY' THEN NULL
                    WHEN 'BUILDING' THEN '2020-01-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') || 'T03:04:05Z'
                    ELSE '2020-01-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') || 'T00:00:00Z' END AS grant_date,
               CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN CAST(c_nationkey AS BIGINT) END AS loc_lat_deg, c_acctbal AS power_erp,
               CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'say "' || c_mktsegment || '"/end' END AS lic_name,
               c_mktsegment AS note FROM customer""",
    "split_dump": """
        SELECT c_custkey AS license_id, c_name AS callsign,
               CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'say "' || c_mktsegment || '"/end' END AS lic_name, c_acctbal AS power_erp
        FROM customer""",
    "ingest_progress": """
        SELECT CASE event_id % 3 WHEN 0 THEN 'north' WHEN 1 THEN 'south' ELSE 'east' END AS registry,
               CASE event_id % 3 WHEN 2 THEN 2 ELSE 1 END AS batch,
               count(*) + count(*) FILTER (event_type IN ('signup', 'purchase')) AS rows,
               count(*) FILTER (event_type IN ('signup', 'purchase')) AS rejected, true AS done
        FROM events GROUP BY event_id % 3""",
    "mesh_payloads": f"""
        SELECT event_id AS id, user_id AS sender, {_ISO.format('ts')} AS received,
               CASE event_type WHEN 'error' THEN 't' || {_K} WHEN 'click' THEN CAST({_K} AS VARCHAR) END AS text,
               CASE WHEN event_type NOT IN ('error', 'click') THEN CAST({_K} AS BIGINT) END AS altitude,
               CASE WHEN event_type NOT IN ('error', 'click') THEN {_ISO.format('ts')} END AS sent,
               CASE WHEN event_type NOT IN ('error', 'click') THEN 2 END AS odd, '!' || user_id AS sender_id, 'w' || {_K} AS words FROM events""",
    "enriched_ingest": f"""
        SELECT ip, 'N' || s_nationkey AS country, CAST(NULL AS VARCHAR) AS city
        FROM (SELECT {_dot3('event_id')} AS ip, event_id AS n FROM events WHERE {_dot3('event_id')} IN (SELECT ip FROM ({_SCANS})))
        LEFT JOIN supplier ON n // 256 = s_suppkey AND n % 256 < 128""",
    "table_life": f"""
        SELECT {_dot3('c_custkey')} AS ip,
               CASE WHEN c_custkey % 3 = 0 THEN 'third' WHEN c_custkey % 2 = 0 THEN 'second' ELSE 'first' END || '.example' AS record
        FROM customer""",
    "exchange_prefixes": f"""
        SELECT s_suppkey AS ix_id, s_name AS name, {_dot2('s_suppkey')} || '0/24' AS prefix,
               {_dot2('s_suppkey')} || '0' AS first, {_dot2('s_suppkey')} || '255' AS last FROM supplier
        UNION ALL
        SELECT s_suppkey, s_name, '2001:db8:' || {_SUPP_HEX} || '::/48',
               CASE WHEN s_suppkey % 65536 = 0 THEN '2001:db8::' ELSE '2001:db8:' || {_SUPP_HEX} || '::' END,
               '2001:db8:' || {_SUPP_HEX} || {_TAIL5} FROM supplier""",
    "registry_object_attributes": """
        WITH a AS (SELECT c_custkey AS k, unnest(['mntner', 'descr', 'origin']) AS attribute,
                          unnest(['M-' || c_custkey, c_name || ' of ' || c_mktsegment || ';second', 'AS' || c_nationkey]) AS content
                   FROM customer)
        SELECT 'mntner' AS object_class, 'M-' || k AS object_id, attribute, content FROM a""",
    "changed_snapshots": """
        WITH p AS (SELECT o_custkey AS registry, max(o_orderkey) AS serial FROM orders GROUP BY o_custkey),
             s AS (SELECT o_custkey AS registry, max(o_orderkey) AS old FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey)
        SELECT registry, serial FROM p LEFT JOIN s USING (registry) WHERE old IS NULL OR old <> serial""",
    "geo_enrichment": f"""
        SELECT event_id, {_EVENT_IP} AS ip, 'N' || s_nationkey AS country
        FROM events LEFT JOIN supplier ON {_SAME_NET} AND event_id % 256 < 128""",
    "nested_ranges": f"""
        SELECT event_id, {_EVENT_IP} AS ip,
               CASE WHEN s_suppkey IS NULL OR event_id % 256 > 200 THEN NULL
                    WHEN event_id % 256 BETWEEN 16 AND 31 AND s_acctbal > 5000 THEN 'nested'
                    WHEN event_id % 256 >= 100 THEN 'crossing' ELSE 'N' || s_nationkey END AS country
        FROM events LEFT JOIN supplier ON {_SAME_NET}""",
    "listed_events": f"SELECT event_id, {_EVENT_IP} AS ip FROM events WHERE {_LISTED}",
    "unlisted_events": f"SELECT event_id, {_EVENT_IP} AS ip FROM events WHERE NOT {_LISTED}",
    "longest_network": f"""
        SELECT event_id, {_EVENT_IP} AS ip,
               CASE WHEN s_suppkey IS NULL THEN NULL
                    WHEN event_id % 256 BETWEEN 16 AND 31 AND s_acctbal > 5000 THEN {_dot2('s_suppkey')} || '16/28'
                    ELSE {_dot2('s_suppkey')} || '0/25' END AS cidr, s_name AS owner
        FROM events LEFT JOIN supplier ON {_SAME_NET} AND event_id % 256 < 128""",
    "cidr_match": f"""
        SELECT event_id, {_EVENT_IP} AS ip FROM events
        WHERE user_id // 256 % 256 = 0 AND user_id % 256 BETWEEN 8 AND 15""",
    "exact_match": "SELECT conv_id, turn, coalesce(length(text) <= 256, false) AS found_by_text FROM conversations WHERE length(role) <= 256 AND role = 'user'",
    "text_match": r"""
        WITH t AS (SELECT doc_id, regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') AS w FROM documents),
             m AS (SELECT doc_id, list_has_any(w, ['license', 'email']) AS "any", list_has_all(w, ['the', 'and']) AS "every" FROM t)
        SELECT doc_id, "any", "every" FROM m WHERE "any" OR "every" """,
    "date_range": """
        SELECT o_orderkey, o_custkey FROM orders
        WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-07-01'""",
    "upsert_merge": f"""
        WITH r AS ({_BATCH_ROWS}),
             m AS (SELECT key, rank, coalesce(max(ok) FILTER (st = 'O'), max(ok)) AS v FROM r GROUP BY key, rank),
             ms AS (SELECT key, string_agg(rank || '=' || v, ',' ORDER BY rank) AS m FROM m GROUP BY key)
        SELECT key, coalesce(max(ok) FILTER (st = 'O'), max(ok)) AS serial,
               coalesce(arg_max(priority, ok) FILTER (st = 'O' AND priority IS NOT NULL),
                        arg_max(priority, ok) FILTER (st = 'F' AND priority IS NOT NULL)) AS priority,
               any_value(ms.m) AS m
        FROM r JOIN ms USING (key) GROUP BY key""",
    "replace_by_key": f"""
        WITH r AS ({_BATCH_ROWS}), w AS (SELECT key, max(st) AS st FROM r GROUP BY key),
             k AS (SELECT r.* FROM r JOIN w USING (key, st)),
             m AS (SELECT key, rank, max(ok) AS v FROM k GROUP BY key, rank),
             ms AS (SELECT key, string_agg(rank || '=' || v, ',' ORDER BY rank) AS m FROM m GROUP BY key)
        SELECT key, max(ok) AS serial, arg_max(priority, ok) FILTER (priority IS NOT NULL) AS priority, any_value(ms.m) AS m
        FROM k JOIN ms USING (key) GROUP BY key""",
    "sentinel_cut": f"""
        SELECT event_type AS feed, event_id FROM events
        LEFT JOIN (SELECT event_type, min(event_id) AS cut FROM events WHERE {_K} = 99 GROUP BY event_type) USING (event_type)
        WHERE cut IS NULL OR event_id <= cut""",
    "reject_reasons": " UNION ALL ".join(_count_reason(*r) for r in _REJECTS),
    "table_summary": " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS documents FROM {t}" for t in _TABLES),
    "text_sizes": f"""
        SELECT source, CAST(chars AS BIGINT) AS chars, {_size('chars')} AS size
        FROM (SELECT source, sum(n_chars) AS chars FROM documents GROUP BY source)""",
    "export_round_trip": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
    "ingested_services": f"""
        SELECT 'stored' AS state, coalesce(service, 'none') AS label, count(*) AS rows FROM ({_SCANS}) GROUP BY 2
        UNION ALL SELECT 'rejected', 'malformed JSON', count(*) FROM events WHERE event_type = 'signup' HAVING count(*) > 0
        UNION ALL SELECT 'rejected', 'bad or missing port', count(*) FROM events WHERE event_type = 'purchase' HAVING count(*) > 0""",
    "streamed_certificates": f"SELECT DISTINCT domain, 1 AS subjects, {_SEEN} AS seen FROM ({_CERT_NAMES})",
    "two_batches": f"""
        WITH n AS (SELECT c_custkey AS k, c_mktsegment || '.example' AS record FROM customer WHERE c_mktsegment <> 'BUILDING'),
             o AS (SELECT l_suppkey AS k, string_agg(DISTINCT 'p' || l_partkey || '.example.net', ','
                          ORDER BY 'p' || l_partkey || '.example.net') AS record FROM lineitem GROUP BY l_suppkey)
        SELECT {_dot3('k')} AS ip, record FROM n
        UNION ALL SELECT {_dot3('k')}, record FROM o WHERE k NOT IN (SELECT k FROM n)""",
    "dated_snapshots": f"""
        SELECT substr(seen, 1, 10) AS snapshot_date, count(*) AS records, count(banner) AS banners, count(DISTINCT ip) AS addresses
        FROM ({_SCANS}) WHERE substr(seen, 1, 10) BETWEEN '2024-01-08' AND '2024-01-25'
          AND (substr(seen, 1, 10) <> '2024-01-20' OR banner IS NOT NULL) GROUP BY 1""",
    "bucketed_upsert": """
        WITH c AS (SELECT c_custkey AS key, c_mktsegment AS segment FROM customer WHERE c_mktsegment <> 'BUILDING'),
             o AS (SELECT o_custkey AS key, count(*) AS orders, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last_order
                   FROM orders GROUP BY o_custkey)
        SELECT coalesce(c.key, o.key) AS key, segment, coalesce(orders, 0) AS orders, last_order
        FROM c FULL JOIN o ON c.key = o.key""",
}
