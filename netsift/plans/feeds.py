"""Recon input derived from the benchmark tables.

The tables hold no scan logs, so each feed writes every row of a table as the
lines a real source would deliver, with broken and irrelevant lines beside them.
Feeds are expressions over whole tables; parsing is left to the sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.functions.text import strip

SEEN = "2024-06-01T00:00:00Z"
# Rows of one pretended file split; keeps positional work bounded as tables grow.
SPLIT_ROWS = 65536


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores when a small table arrives in fewer pieces than there are cores.

    A table with enough pieces is left as it is, so large inputs are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def as_lines(df: DataFrame, order: str, *values: Column, file: Column | None = None, files: list[Column] | None = None) -> DataFrame:
    """Lines in the order of ``order``; each row gives its non-null values in turn.

    All go to ``file``, or each value to the file at its place in ``files``.
    """
    one = file if file is not None else F.lit("/feed/all.txt")
    pieces = values if files is None else [F.struct(v.alias("v"), f.alias("f")) for v, f in zip(values, files)]
    lines = spread(df).select(
        one.alias("_file"),
        F.expr(f"{order} div {SPLIT_ROWS}").cast("bigint").alias("_block"),
        F.col(order).cast("bigint").alias("_at"),
        F.posexplode(F.array(*pieces)).alias("_nth", "_piece"),
    )
    value, where = (F.col("_piece"), F.col("_file")) if files is None else (F.col("_piece.v"), F.col("_piece.f"))
    return lines.where(value.isNotNull()).select(
        strip(value).alias("value"), where.alias("_file"), "_block", (F.col("_at") * len(values) + F.col("_nth")).alias("_row"))


def epoch(ts: str) -> Column:
    """Whole seconds of a zone-free time, whatever the session zone."""
    return F.expr(f"unix_date(cast({ts} as date)) * 86400L + hour({ts}) * 3600 + minute({ts}) * 60 + int(floor(second({ts})))")


def octets(n: str) -> Column:
    """Last three octets of 10.x.y.z from a number."""
    return F.expr(f"concat('10.', {n} div 65536 % 256, '.', {n} div 256 % 256, '.', {n} % 256)")


def reverse_name(n: str) -> Column:
    return F.expr(f"concat({n} % 256, '.', {n} div 256 % 256, '.', {n} div 65536 % 256, '.10.in-addr.arpa.')")


def k(column: str = "props") -> Column:
    return F.get_json_object(column, "$.k").cast("int")


def event_address() -> Column:
    """10.(user / 256).(user % 256).(event % 256)."""
    return F.expr("concat('10.', user_id div 256 % 256, '.', user_id % 256, '.', event_id % 256)")


def port_scan_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as port-scan records. Errors carry titles, some of them noise; views carry banners."""
    e = table(spark, folder, "events").withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    kind, cents = F.col("event_type"), F.col("cents")
    banner = kind.isin("error", "view")
    service = F.when(kind == "error", "title").when(cents < 1000, "unknown").otherwise("http")
    text = F.when((kind == "error") & (cents < 2000), "404 Not Found").when(
        cents > 9000, " \t ").otherwise(F.concat(F.lit(" v  "), cents.cast("string"), F.lit("\t end ")))
    record = F.struct(
        octets("event_id").alias("ip"),
        (8000 + k()).alias("port"),
        F.when(kind == "click", "udp").otherwise("tcp").alias("proto"),
        (F.col("user_id") % 256).alias("ttl"),
        epoch("ts").cast("string").alias("timestamp"),
        F.when(banner, "banner").otherwise("status").alias("rec_type"),
        F.struct(F.when(banner, service).alias("service_name"), F.when(banner, text).alias("banner")).alias("data"),
    )
    junk = (
        F.when(kind == "signup", F.concat(F.lit('{"ip": '), F.col("event_id").cast("string")))
        .when(kind == "click", F.lit("# note"))
        .when(kind == "purchase", F.to_json(F.struct(octets("event_id").alias("ip"), F.lit("tcp").alias("proto"))))
    )
    return as_lines(e, "event_id", F.to_json(record), junk)


def web_probe_lines(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "pages")
    host = F.regexp_extract("url", "^https?://([^/?#]+)", 1)
    record = F.struct(
        F.expr("concat('2024-01-14T13:08:', lpad(page_id % 60, 2, '0'), '.117348474-05:00')").alias("timestamp"),
        F.when(F.col("url").startswith("https"), "443").otherwise("80").alias("port"),
        F.col("url"),
        host.alias("input"),
        F.split_part("url", F.lit(":"), F.lit(1)).alias("scheme"),
        F.col("html").alias("body_preview"),
        F.array(F.lit(301), F.lit(200)).alias("chain_status_codes"),
        F.length("html").alias("content_length"),
        F.lit(False).alias("failed"),
        F.lit("5ms").alias("time"),
        F.col("page_id").alias("page"),
        host.alias("cname"),
    )
    return as_lines(p, "page_id", F.to_json(record), F.concat(F.lit("no json "), F.col("url")))


def reverse_name_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as DNS answers: the supplier is the address, the part the name."""
    li = table(spark, folder, "lineitem")
    name = reverse_name("l_suppkey")
    good = F.concat(name, F.lit(" PTR p"), F.col("l_partkey").cast("string"), F.lit(".example.net."))
    junk = (
        F.when(F.col("l_returnflag") == "R", F.concat(name, F.lit(" PTR "), name))
        .when(F.col("l_returnflag") == "A", F.concat(name, F.lit(" A 192.0.2.1")))
        .otherwise(F.concat(name, F.lit("  PTR")))
    )
    return as_lines(li, "l_orderkey", good, junk)


def middle_row(spark: SparkSession, folder: str) -> int:
    """A row number half way through ``reverse_name_lines``."""
    return table(spark, folder, "lineitem").agg(F.max("l_orderkey")).first()[0] or 0


def run_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in key order; the status is the address, so that neighbours often share it."""
    o = table(spark, folder, "orders")
    octet = F.expr("case o_orderstatus when 'F' then 1 when 'O' then 2 else 3 end")
    name = F.concat(octet.cast("string"), F.lit(".0.0.10.in-addr.arpa."))
    good = F.concat(name, F.lit("\tPTR  c"), F.col("o_custkey").cast("string"), F.lit(".example."))
    return as_lines(o, "o_orderkey", good, F.concat(name, F.lit(" TXT x")))


def reverse_stream_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as reverse-DNS records of users; which fields are there depends on the kind of event."""
    e = table(spark, folder, "events")
    kind = F.col("event_type")
    own = F.expr("concat(user_id % 256, '.', user_id div 256 % 256, '.', user_id div 65536 % 256, '.10.in-addr.arpa')")
    record = F.struct(
        octets("user_id").alias("ip"),
        F.when(kind == "error", own).otherwise(F.concat(F.lit("h"), k().cast("string"), F.lit(".example"))).alias("record"),
        F.when(kind == "view", F.concat(F.lit("192.0.2."), k().cast("string"))).alias("nameserver"),
        F.when(kind.isin("click", "purchase"), k() * 10).alias("ttl"),
        F.when(kind == "view", k()).alias("asn"),
    )
    return as_lines(e, "event_id", F.to_json(record))


def zone_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as zone records: a file per status, a domain per customer, a type per priority."""
    o = table(spark, folder, "orders")
    rank = F.substring("o_orderpriority", 1, 1)
    key = F.col("o_orderkey").cast("string")
    domain = F.concat(F.lit("C"), F.col("o_custkey").cast("string"), F.lit(".Example."))
    ttl = F.expr("cast(60 + o_orderkey % 1000 as string)")
    record = (
        F.when(rank == "1", F.concat(F.lit("NS ns"), key, F.lit(".example.")))
        .when(rank == "2", F.concat(F.lit("A "), octets("o_orderkey")))
        .when(rank == "3", F.concat(F.lit("mx 10  m"), key, F.lit(".example..")))
        .when(rank == "4", F.concat(F.lit("NSEC n"), key, F.lit(".example. A NSEC.")))
        .otherwise(F.concat(F.lit("SOA a.example. b.example. "), key))
    )
    good = F.concat(domain, F.lit(" "), ttl, F.lit(" IN\t"), record)
    junk = (
        F.when(rank == "1", F.lit("; <<>> DiG 9.18 <<>> AXFR"))
        .when(rank == "2", F.concat(domain, F.lit(" 60 CH TXT x")))
        .when(rank == "3", F.concat(domain, F.lit(" 1h IN TXT x")))
        .when(rank == "4", F.concat(domain, F.lit(" 60 IN WKS x")))
        .otherwise(domain)
    )
    file = F.concat(F.lit("/feed/"), F.lower("o_orderstatus"), F.lit(".example.txt"))
    return as_lines(o, "o_orderkey", good, junk, file=file)


def zone_topics(spark: SparkSession, folder: str) -> tuple[DataFrame, Column]:
    """``zone_lines`` with domains that lie in one zone each, and which lines come late.

    The zone of pending orders ends where the late lines begin.
    """
    middle = (table(spark, folder, "orders").agg(F.max("o_orderkey")).first()[0] or 0) // 2
    status = F.regexp_extract("_file", r"/(\w)\.example", 1)
    lines = zone_lines(spark, folder).withColumn("value", F.regexp_replace("value", F.lit(r"^(C\d+)\."), F.concat(F.lit("$1-"), status, F.lit("."))))
    end = spark.sql(f"select '~eof' value, '/feed/p.example.txt' _file, {middle} div {SPLIT_ROWS} _block, bigint({2 * middle + 1}) _row")
    return lines.unionByName(end), F.col("_row") >= 2 * middle + 2


def certificate_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Pages as certificates: the host, its wildcard, and the wildcard of the parent domain."""
    p = table(spark, folder, "pages").withColumn("host", F.regexp_extract("url", "^https?://([^/?#]+)", 1))
    host = F.col("host")
    parent = F.regexp_replace(host, r"^[^.]+\.", "")
    names = F.array(host, F.concat(F.lit("*."), host), F.concat(F.lit("*."), parent), host)
    cert = F.struct(
        names.alias("all_domains"),
        F.md5("url").alias("fingerprint"),
        F.struct(F.split_part("url", F.lit(":"), F.lit(1)).alias("O")).alias("issuer"),
        F.create_map(F.lit("CN"), host, F.lit("O"), F.lit(None).cast("string")).alias("subject"),
    )
    message = F.to_json(F.struct(F.struct(cert.alias("leaf_cert")).alias("data")), {"ignoreNullFields": "false"})
    return as_lines(p, "page_id", message, F.lit('{"message_type":"heartbeat"}'))


def delegation_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as delegated blocks: each gives an IPv4 block, an IPv6 network and an AS range."""
    p = table(spark, folder, "part")
    day = F.expr("date_format(date_add(date'2000-01-01', cast(p_partkey % 8000 as int)), 'yyyyMMdd')")
    day = F.when(F.col("p_type") == "SMALL", "").when(F.col("p_type") == "LARGE", "00000000").otherwise(day)
    v4 = F.concat_ws("|", F.lit("ARIN|US|ipv4"), F.expr("concat('10.', p_partkey div 256 % 256, '.', p_partkey % 256, '.0')"),
                     F.expr("256 * (1 + p_size)").cast("string"), day, F.lit("allocated"), F.col("p_brand"))
    v6 = F.concat_ws("|", F.lit("ripencc|DE|ipv6"), F.expr("concat('2001:DB8:', hex(p_partkey % 65536), '::')"), F.lit("48"),
                     day, F.lit("assigned"))
    asn = F.concat_ws("|", F.lit("apnic||asn"), F.expr("4200000000 + p_partkey").cast("string"), F.col("p_size").cast("string"),
                      day, F.lit("reserved"), F.lit(""))
    junk = (
        F.when(F.col("p_type") == "SMALL", "arin|USA|asn|1|1|20200101|assigned|x")
        .when(F.col("p_type") == "LARGE", "arin|US|ipv6|2001:db8::1|32|20200101|assigned|x")
        .when(F.col("p_type") == "ECONOMY", "arin|*|ipv4|*|2|summary")
        .otherwise("2.3|arin|1700000000|4|19840101|20240101|-0500")
    )
    return as_lines(p, "p_partkey", v4, v6, asn, junk, F.lit("# comment"))


def transfer_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as transfer documents, dates in four spellings and octets with leading zeros."""
    o = table(spark, folder, "orders")
    day = F.substring(F.col("o_orderdate").cast("string"), 1, 10)
    rank = F.substring("o_orderpriority", 1, 1)
    date = (
        F.when(rank == "1", F.concat(day, F.lit(" 19:00:00.123+0300")))
        .when(rank == "2", F.concat(day, F.lit(" 19:00:00Z")))
        .when(rank == "3", F.concat(day, F.lit(" 19:00:00")))
        .otherwise(F.concat(day, F.lit("T19:00:00Z")))
    )
    def padded(last: str) -> Column:
        return F.expr(
            f"concat('010.', lpad(o_orderkey div 256 % 256, 3, '0'), '.', lpad(o_orderkey % 256, 3, '0'), '.{last}')")

    kind = F.when(F.col("o_orderstatus") == "F", "MERGER_ACQUISITION").when(
        F.col("o_orderstatus") == "O", "RESOURCE_TRANSFER").otherwise("GIFT")
    net = F.struct(padded("000").alias("start_address"), padded("255").alias("end_address"))
    asn = F.struct(F.col("o_custkey").cast("string").alias("start"), F.col("o_custkey").alias("end"))
    transfer = F.struct(
        date.alias("transfer_date"),
        F.struct(F.array(net).alias("original_set"), F.array(net).alias("transfer_set")).alias("ip4nets"),
        F.struct(F.array(asn).alias("original_set")).alias("asns"),
        kind.alias("type"),
        F.struct(F.concat(F.lit("org "), F.col("o_custkey").cast("string")).alias("name")).alias("source_organization"),
    )
    return spread(o).select(
        F.to_json(F.struct(F.array(transfer).alias("transfers"))).alias("value"),
        F.concat(F.lit("/feed/"), F.col("o_orderkey").cast("string"), F.lit(".json")).alias("_file"),
    )


def blocklist_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as list entries: a list per return flag and line status, networks from suppliers."""
    li = table(spark, folder, "lineitem")
    name = F.lower(F.concat("l_returnflag", F.lit("_"), "l_linestatus"))
    net = F.expr("concat('10.', l_suppkey div 256 % 256, '.', l_suppkey % 256, '.')")
    last = F.col("l_linenumber").cast("string")
    entry = F.when(F.col("l_linestatus") == "F", F.concat(net, F.lit("0/24"))).otherwise(F.concat(net, last))
    bad = F.when(F.col("l_returnflag") == "N", F.concat(net, F.lit("1/24")))
    category = F.when(F.col("l_linestatus") == "F", F.concat(F.lit("# Category  : cat "), F.col("l_returnflag")))
    current = F.concat(F.lit("/feed/"), name, F.lit(".netset"))
    history = F.concat(F.lit("/feed/"), name, F.lit("_30d.ipset"))
    return as_lines(li, "l_orderkey", entry, bad, category, entry, entry,
                    files=[current, current, current, history, F.lit("/feed/readme.md")])


def licence_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as licences, all columns text, upper-case names, a line break in a field."""
    c = table(spark, folder, "customer")
    seg = F.col("c_mktsegment")
    granted = F.when(seg == "BUILDING", F.expr("concat('1/', 1 + c_custkey % 28, '/2020 3:04:05')")).when(
        seg == "MACHINERY", F.lit("0000-00-00")).otherwise(F.expr("concat('2020-01-', lpad(1 + c_custkey % 28, 2, '0'))"))
    return c.select(
        F.concat(F.col("c_custkey").cast("string"), F.lit(".9")).alias("LICENSE_ID"),
        F.col("c_name").alias("CALLSIGN"),
        granted.alias("GRANT_DATE"),
        F.when(seg == "HOUSEHOLD", "x").otherwise(F.col("c_nationkey").cast("string")).alias("LOC_LAT_DEG"),
        F.col("c_acctbal").cast("string").alias("POWER_ERP"),
        F.when(seg == "FURNITURE", "NULL").otherwise(F.concat(F.lit('say "'), seg, F.lit('"\nend'))).alias("LIC_NAME"),
        seg.alias("NOTE"),
    )


def mesh_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as radio messages; the payload is text, a number or an object."""
    e = table(spark, folder, "events")
    kind = F.col("event_type")
    payload = (
        F.when(kind == "error", F.concat(F.lit('"t'), k().cast("string"), F.lit('"')))
        .when(kind == "click", k().cast("string"))
        .otherwise(F.concat(F.lit('{"altitude":'), k().cast("string"), F.lit(',"time":'), epoch("ts").cast("string"),
                            F.lit(',"odd":{"a":[1,2]}}')))
    )
    message = F.concat(
        F.lit('{"from":'), F.col("user_id").cast("string"), F.lit(',"id":'), F.col("event_id").cast("string"),
        F.lit(',"fromId":"!'), F.col("user_id").cast("string"), F.lit('","rxTime":'), epoch("ts").cast("string"),
        F.lit(',"decoded":{"portnum":"P","text":"w'), k().cast("string"), F.lit('","payload":'), payload, F.lit("}}"),
    )
    broken = F.when(F.col("event_id") % 2 == 0, F.lit("{cut off")).otherwise(F.concat(message, F.lit(',"x":1')))
    return as_lines(e, "event_id", message, F.when(kind == "view", broken))


def exchange_lines(spark: SparkSession, folder: str) -> DataFrame:
    s = table(spark, folder, "supplier")
    prefixes = F.struct(
        F.array(F.expr("concat('10.', s_suppkey div 256 % 256, '.', s_suppkey % 256, '.0/24')")).alias("ipv4"),
        F.array(F.expr("concat('2001:db8:', lower(hex(s_suppkey % 65536)), '::/48')")).alias("ipv6"),
    )
    record = F.struct(F.col("s_name").alias("name"), F.col("s_suppkey").alias("ix_id"), prefixes.alias("prefixes"))
    return as_lines(s, "s_suppkey", F.to_json(record), F.lit("{}"))


def registry_object_rows(spark: SparkSession, folder: str) -> DataFrame:
    c = table(spark, folder, "customer")
    text = F.concat(
        F.lit("% comment\nmntner: M-"), F.col("c_custkey").cast("string"), F.lit("\ndescr: "), F.col("c_name"),
        F.lit("\n   of "), F.col("c_mktsegment"), F.lit("\nDescr:second\norigin:   AS"), F.col("c_nationkey").cast("string"),
        F.lit("\n"),
    )
    return spread(c).select(text.alias("value"), F.lit("/feed/all.db").alias("_file"))


def networks(spark: SparkSession, folder: str) -> DataFrame:
    """A /25 per supplier, and a /28 inside it for those in credit above 5000."""
    s = table(spark, folder, "supplier")
    base = F.expr("concat('10.', s_suppkey div 256 % 256, '.', s_suppkey % 256, '.')")
    wide = s.select(F.concat(base, F.lit("0/25")).alias("cidr"), "s_name")
    narrow = s.where("s_acctbal > 5000").select(F.concat(base, F.lit("16/28")).alias("cidr"), "s_name")
    return wide.unionByName(narrow)


def address_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """The lower half of each supplier's 256 addresses, with the supplier's nation."""
    s = table(spark, folder, "supplier")
    base = F.expr("concat('10.', s_suppkey div 256 % 256, '.', s_suppkey % 256, '.')")
    return s.select(
        F.concat(base, F.lit("0")).alias("first"), F.concat(base, F.lit("127")).alias("last"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("country_iso_code"),
    )


def overlapping_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """``address_ranges``, and for each supplier a range that crosses it and, with a large balance, one inside it."""
    s = table(spark, folder, "supplier")
    base = F.expr("concat('10.', s_suppkey div 256 % 256, '.', s_suppkey % 256, '.')")
    crossing = s.select(F.concat(base, F.lit("100")).alias("first"), F.concat(base, F.lit("200")).alias("last"), F.lit("crossing").alias("country_iso_code"))
    nested = s.where("s_acctbal > 5000").select(F.concat(base, F.lit("16")).alias("first"), F.concat(base, F.lit("31")).alias("last"), F.lit("nested").alias("country_iso_code"))
    return address_ranges(spark, folder).unionByName(crossing).unionByName(nested)


def events_with_address(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", event_address().alias("ip"))
