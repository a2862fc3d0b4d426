"""The registered queries: each runs real sources and operators over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift import ingest as ingestion
from netsift.functions import ip, times
from netsift.functions.staging import once
from netsift.functions.text import human_size
from netsift.operators import keyed, lookup, merging, predicates, progress, tables
from netsift.operators.enrichment import geoip_enrichment, register_enrichment
from netsift.operators.skew import shared_folder
from netsift.plans import feeds
from netsift.plans.feeds import SEEN, table
from netsift.sources import blocklists, certificates, delegations, exchanges, licences, mesh_radio, port_scan
from netsift.sources import registry_objects, reverse_names, transfers, web_probe, zone
from netsift.sources.base import rejects
from netsift.sources.lines import cut_at_sentinel, label_by_path
from netsift.streaming.watch import watch, watch_frame

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)


BUCKETS = 16


def scratch(spark: SparkSession) -> str:
    """A new folder in the storage all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/netsift-{uuid.uuid4().hex}"


def joined(c, separator: str = ",") -> Column:
    return F.array_join(F.array_sort(c), separator)


def _scans(spark: SparkSession, folder: str) -> DataFrame:
    return port_scan.PORT_SCANS.shape(port_scan.parse(feeds.port_scan_lines(spark, folder), sentinel=None))


def port_scan_parse(spark: SparkSession, folder: str) -> DataFrame:
    return _scans(spark, folder).withColumn("seen", times.iso(F.col("seen")))


def port_services(spark: SparkSession, folder: str) -> DataFrame:
    """Records, addresses and banners per port and service, noise left out."""
    scans = lookup.without_noise(_scans(spark, folder))
    return scans.groupBy("port", "service").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("ip").alias("addresses"),
        F.count("banner").alias("banners"),
    )


def web_probe_parse(spark: SparkSession, folder: str) -> DataFrame:
    parsed = web_probe.parse(feeds.web_probe_lines(spark, folder), sentinel=None)
    return web_probe.WEB_PROBES.shape(parsed).select(
        "timestamp", "port", "url", "input", "scheme", "content_length", F.md5("body_preview").alias("body"),
        joined(F.col("chain_status_codes").cast("array<string>")).alias("codes"),
        F.try_variant_get(F.col("_extra")["page"], "$", "bigint").alias("page"), F.size("_extra").alias("extras"),
        joined("cname").alias("cname"),
    )


def _names(spark: SparkSession, folder: str) -> DataFrame:
    return reverse_names.parse_text(feeds.reverse_name_lines(spark, folder), sentinel=None)


def ptr_names(spark: SparkSession, folder: str) -> DataFrame:
    """Long form: address and name, each pair once."""
    return reverse_names.distinct_names(_names(spark, folder)).select("ip", "record")


def ptr_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = reverse_names.shape_text(_names(spark, folder), seen=SEEN)
    return docs.select("ip", "part", F.size("record").alias("names"), joined("record").alias("record"),
                       times.iso(F.col("seen")).alias("seen"))


def ptr_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One document per run of consecutive lines with the same address."""
    parsed = reverse_names.parse_text(feeds.run_lines(spark, folder), sentinel=None)
    docs = reverse_names.shape_text(parsed, group="run", seen=SEEN)
    return docs.select((F.col("_order._row").cast("bigint") / 2).cast("bigint").alias("started"), "ip",
                       F.array_join("record", ",").alias("record"))


def ptr_stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    parsed = reverse_names.parse_json_records(feeds.reverse_stream_lines(spark, folder))
    docs = ingestion.documents_of(reverse_names.REVERSE_JSON, parsed)
    asn = F.try_variant_get(F.col("_extra")["asn"], "$", "bigint").alias("asn")
    return docs.select("ip", "nameserver", "record", "ttl", asn)


def _zones(spark: SparkSession, folder: str) -> DataFrame:
    return zone.shape(zone.parse(feeds.zone_lines(spark, folder)), seen=SEEN)


def zone_documents(spark: SparkSession, folder: str) -> DataFrame:
    types = _zones(spark, folder).select("zone", "domain", "source", F.explode("records").alias("type", "list"))
    texts = F.transform("list", lambda r: F.concat_ws(" ", r["ttl"].cast("string"), r["data"]))
    return types.select("zone", "domain", "source", "type", F.array_join(texts, ";").alias("records"))


def zone_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The domains of all zone files after merging them in file order."""
    docs = tables.fold_log(_zones(spark, folder), zone.ZONES)
    return docs.select("domain", "part", "zone", "source", joined(F.map_keys("records")).alias("types"),
                       F.aggregate(F.map_values("records"), F.lit(0), lambda n, v: n + F.size(v)).alias("records"))


def nested_match(spark: SparkSession, folder: str) -> DataFrame:
    """Domains with an address record whose third octet is below 40."""
    test = predicates.any_record(
        F.col("records"), "a", lambda r: F.split_part(r["data"], F.lit("."), F.lit(3)).cast("int") < 40)
    return _zones(spark, folder).where(test).select("zone", "domain").distinct()  # a domain may span parts


def certificate_domains(spark: SparkSession, folder: str) -> DataFrame:
    parsed = certificates.parse(feeds.certificate_lines(spark, folder))
    docs = ingestion.documents_of(certificates.CERTIFICATES, parsed, seen=SEEN)
    return docs.select("domain", "fingerprint", "issuer", F.col("subject")["CN"].alias("cn"),
                       F.size("subject").alias("subjects"), times.iso(F.col("seen")).alias("seen"))


def delegation_blocks(spark: SparkSession, folder: str) -> DataFrame:
    parsed = delegations.parse(feeds.delegation_lines(spark, folder), seen=SEEN)
    return delegations.DELEGATIONS.shape(parsed).select(
        "registry", "cc", F.col("asn.start").alias("asn_start"), F.col("asn.end").alias("asn_end"),
        F.col("ip.start").alias("ip_start"), F.col("ip.end").alias("ip_end"), times.iso(F.col("date")).alias("date"),
        "status", "extensions", times.iso(F.col("seen")).alias("seen"))


def transfer_rows(spark: SparkSession, folder: str) -> DataFrame:
    parsed = transfers.parse(feeds.transfer_documents(spark, folder), seen=SEEN)
    block, asn = F.col("ip4nets.transfer_set")[0], F.col("asns.original_set")[0]
    return transfers.TRANSFERS.shape(parsed).select(
        "transfer_date", block["start_address"].alias("first"), block["end_address"].alias("last"),
        asn["start"].alias("asn"), "type", F.col("source_organization.name").alias("organization"))


def blocklist_documents(spark: SparkSession, folder: str) -> DataFrame:
    docs = blocklists.shape(blocklists.parse(feeds.blocklist_lines(spark, folder)), seen=SEEN)
    return docs.select("ip", F.array_join("ipsets", ",").alias("ipsets"), F.array_join("categories", ",").alias("categories"))


def licence_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Write the dump as CSV, read it back, convert."""
    path = scratch(spark)
    feeds.licence_rows(spark, folder).write.option("header", True).option("escape", '"').csv(path)
    docs = licences.LICENCES.shape(licences.parse(licences.read(spark, path)))
    return docs.select("license_id", "callsign", times.iso(F.col("grant_date")).alias("grant_date"), "loc_lat_deg",
                       "power_erp", F.replace("lic_name", F.lit("\n"), F.lit("/")).alias("lic_name"),
                       F.col("_extra")["note"].alias("note"))


def split_dump(spark: SparkSession, folder: str) -> DataFrame:
    """The dump as few large files, cut into many tasks though fields hold line breaks."""
    path = scratch(spark)
    rows = feeds.licence_rows(spark, folder).repartition(2, "LICENSE_ID")
    rows.write.option("header", True).option("escape", '"').csv(path)
    docs = licences.LICENCES.shape(licences.parse(licences.read(spark, path, split=True)))
    return docs.select("license_id", "callsign", F.replace("lic_name", F.lit("\n"), F.lit("/")).alias("lic_name"), "power_erp")


def mesh_payloads(spark: SparkSession, folder: str) -> DataFrame:
    docs = mesh_radio.MESH.shape(mesh_radio.parse(feeds.mesh_lines(spark, folder), sentinel=None))
    p = F.col("decoded.payload")[0]
    return docs.select("id", F.col("from").alias("sender"), times.iso(F.col("rxTime")).alias("received"),
                       p["value"].cast("string").alias("text"), p["altitude"].alias("altitude"),
                       times.iso(p["time"]).alias("sent"), F.try_variant_get(p["raw"], "$.odd.a[1]", "int").alias("odd"),
                       F.try_variant_get(F.col("_extra")["fromId"], "$", "string").alias("sender_id"),
                       F.try_variant_get(F.col("decoded._extra")["text"], "$", "string").alias("words"))


def exchange_prefixes(spark: SparkSession, folder: str) -> DataFrame:
    docs = exchanges.EXCHANGES.shape(exchanges.parse(feeds.exchange_lines(spark, folder)))
    return exchanges.prefixes(docs).select(
        "ix_id", "name", "prefix", ip.to_text(F.col("net.lo")).alias("first"), ip.to_text(F.col("net.hi")).alias("last"))


def registry_object_attributes(spark: SparkSession, folder: str) -> DataFrame:
    docs = registry_objects.OBJECTS.shape(registry_objects.parse(feeds.registry_object_rows(spark, folder)))
    return docs.select("object_class", "object_id", F.explode("attributes").alias("attribute", "v")).select(
        "object_class", "object_id", "attribute", F.array_join("v", ";").alias("content"))


def changed_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as registries: the last order is the published serial, the last finished one the stored."""
    o = table(spark, folder, "orders").withColumnRenamed("o_custkey", "registry")
    published = o.groupBy("registry").agg(F.max("o_orderkey").alias("serial"))
    stored = o.where("o_orderstatus <> 'P'").groupBy("registry").agg(F.max("o_orderkey").alias("serial"))
    return registry_objects.changed_snapshots(published, stored)


def geo_enrichment(spark: SparkSession, folder: str) -> DataFrame:
    rows = lookup.range_lookup(feeds.events_with_address(spark, folder), "ip", feeds.address_ranges(spark, folder),
                               "first", "last", "geoip")
    return rows.select("event_id", "ip", F.col("geoip.country_iso_code").alias("country"))


def nested_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Events in ranges that nest and cross: the narrowest gives the country."""
    rows = lookup.range_lookup(feeds.events_with_address(spark, folder), "ip", feeds.overlapping_ranges(spark, folder),
                               "first", "last", "geoip")
    return rows.select("event_id", "ip", F.col("geoip.country_iso_code").alias("country"))


def listed_events(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.inside_networks(feeds.events_with_address(spark, folder), "ip", feeds.networks(spark, folder), "cidr")


def unlisted_events(spark: SparkSession, folder: str) -> DataFrame:
    return lookup.inside_networks(
        feeds.events_with_address(spark, folder), "ip", feeds.networks(spark, folder), "cidr", negate=True)


def longest_network(spark: SparkSession, folder: str) -> DataFrame:
    rows = lookup.longest_match(feeds.events_with_address(spark, folder), "ip", feeds.networks(spark, folder), "cidr")
    return rows.select("event_id", "ip", F.col("network.cidr").alias("cidr"), F.col("network.s_name").alias("owner"))


def cidr_match(spark: SparkSession, folder: str) -> DataFrame:
    rows = once(feeds.events_with_address(spark, folder), _b=ip.bits(F.col("ip")))
    return rows.where(predicates.in_network(F.col("_b"), "10.0.8.0/21")).drop("_b")


def exact_match(spark: SparkSession, folder: str) -> DataFrame:
    """A user's turns, and whether the whole text finds them; longer texts are never exact matches."""
    turns = table(spark, folder, "conversations")
    text = F.col("text")
    found = turns.where(predicates.exact(F.col("role"), "user"))
    return found.select("conv_id", "turn", F.coalesce(predicates.exact(text, text), F.lit(False)).alias("found_by_text"))


def text_match(spark: SparkSession, folder: str) -> DataFrame:
    low = F.col("_low")
    docs = once(table(spark, folder, "documents").select("doc_id", "text"), _low=F.lower("text")).drop("text")
    found = once(docs, any=predicates.has_terms(low, ["license", "email"], lowered=True),
                 every=predicates.has_terms(low, ["the", "and"], every=True, lowered=True))
    return found.where("any or every").select("doc_id", "any", "every")


def date_range(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    period = predicates.in_period(F.col("o_orderdate"), "1997-01-01T00:00:00Z", "1998-07-01T00:00:00Z")
    return orders.where(period).select("o_orderkey", "o_custkey")


def _batches(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Per customer: the latest finished order and the latest other one."""
    o = table(spark, folder, "orders")
    rank = F.substring("o_orderpriority", 1, 1)
    rows = o.select(
        F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("serial"),
        F.when(rank != "1", F.col("o_orderpriority")).alias("priority"),
        F.create_map(rank, F.col("o_orderkey")).alias("m"), "o_orderstatus",
        F.col("o_orderkey").alias("_order"),
    )
    first = merging.last_writes(rows.where("o_orderstatus = 'F'").drop("o_orderstatus"), ["key"], maps=["m"])
    second = merging.last_writes(rows.where("o_orderstatus <> 'F'").drop("o_orderstatus"), ["key"], maps=["m"])
    return first.drop("_order"), second.drop("_order")


def _flat(df: DataFrame) -> DataFrame:
    entries = F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return df.withColumn("m", F.array_join(entries, ","))


def upsert_merge(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _batches(spark, folder)
    return _flat(merging.upsert(old, new, ["key"], maps=["m"]))


def replace_by_key(spark: SparkSession, folder: str) -> DataFrame:
    old, new = _batches(spark, folder)
    return _flat(merging.replace_by_key(old, new, ["key"]))


def sentinel_cut(spark: SparkSession, folder: str) -> DataFrame:
    """Events as feeds per type; an event with k = 99 ends its feed."""
    e = table(spark, folder, "events")
    lines = feeds.as_lines(
        e, "event_id", F.col("event_id").cast("string"), F.when(feeds.k() == 99, "~eof"),
        file=F.concat(F.lit("/feed/"), F.col("event_type"), F.lit(".txt")))
    kept = cut_at_sentinel(lines)
    return kept.select(F.regexp_extract("_file", r"([a-z]+)\.txt", 1).alias("feed"), F.col("value").cast("bigint").alias("event_id"))


def reject_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Rows set aside per source and reason."""
    pieces = {
        "port_scan": port_scan.parse(feeds.port_scan_lines(spark, folder), sentinel=None),
        "reverse_names": _names(spark, folder),
        "zone": zone.parse(feeds.zone_lines(spark, folder), sentinel=None),
        "delegations": delegations.parse(feeds.delegation_lines(spark, folder), seen=SEEN),
        "transfers": transfers.parse(feeds.transfer_documents(spark, folder), seen=SEEN),
    }
    counted = None
    for name, parsed in pieces.items():
        one = rejects(parsed).groupBy(F.lit(name).alias("source"), F.col("_error").alias("reason")).agg(
            F.count(F.lit(1)).alias("rows"))
        counted = one if counted is None else counted.unionByName(one)
    return counted


def table_summary(spark: SparkSession, folder: str) -> DataFrame:
    return tables.table_summary({name: table(spark, folder, name) for name in TABLES}).select("name", "documents")


def text_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Characters per document source, readable."""
    docs = table(spark, folder, "documents")
    return docs.groupBy("source").agg(F.sum("n_chars").alias("chars")).withColumn("size", human_size(F.col("chars")))


def export_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Write orders as JSON lines and read them back."""
    path = scratch(spark)
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    tables.export_json(orders, path)
    return tables.import_json(spark, path, orders.schema)


def ingested_services(spark: SparkSession, folder: str) -> DataFrame:
    """The port-scan feed through files, table and rejects; counts per service and reason."""
    path = scratch(spark)
    feeds.port_scan_lines(spark, folder).select("value").write.text(f"{path}/in")
    ingestion.ingest(spark, port_scan.PORT_SCANS, f"{path}/in", f"{path}/table", batch_id=1)
    good = tables.current(spark, f"{path}/table", port_scan.PORT_SCANS).groupBy(
        F.lit("stored").alias("state"), F.coalesce("service", F.lit("none")).alias("label"))
    bad = ingestion.read_rejects(spark, f"{path}/table").groupBy(
        F.lit("rejected").alias("state"), F.col("_error").alias("label"))
    rows = F.count(F.lit(1)).alias("rows")
    return good.agg(rows).unionByName(bad.agg(rows))


def ingest_progress(spark: SparkSession, folder: str) -> DataFrame:
    """The port-scan feed in three folders, two by a batch and one by a stream: rows and rejects of each."""
    path = scratch(spark)
    lines = feeds.port_scan_lines(spark, folder).select("value", F.expr("_row div 2 % 3").alias("part"))
    for n in range(3):  # a file per task and folder: no rows meet in a task, none are sorted
        lines.where(F.col("part") == n).select("value").write.text(f"{path}/in/part={n}")
    first = [f"{path}/in/part={n}" for n in (0, 1)]
    ingestion.ingest(spark, port_scan.PORT_SCANS, first, f"{path}/table", batch_id=1, metrics=True)
    watch(spark, port_scan.PORT_SCANS, f"{path}/in/part=2", f"{path}/table", f"{path}/checkpoint", finite=True,
          bytes_per_trigger=1 << 30, metrics=True).awaitTermination()
    files = progress.progress(spark, f"{path}/table", f"{path}/in")
    named = label_by_path(files, {"/part=0/": "north", "/part=1/": "south", "/part=2/": "east"}, "registry", "file")
    # a stream of more bytes than a trigger takes needs several batches: the first of them is told
    return named.groupBy("registry").agg(
        F.min("batch").alias("batch"), F.sum("rows").alias("rows"), F.sum("rejected").alias("rejected"), F.bool_and("done").alias("done"))


def enriched_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """The port-scan feed stored with the place of each address, by a registered enrichment."""
    path = scratch(spark)
    feeds.port_scan_lines(spark, folder).select("value").write.text(f"{path}/in")
    register_enrichment("geoip", geoip_enrichment(feeds.address_ranges(spark, folder)))
    ingestion.ingest(spark, port_scan.PORT_SCANS, f"{path}/in", f"{path}/table", enrichment="geoip")
    docs = tables.current(spark, f"{path}/table", port_scan.PORT_SCANS)
    return docs.select("ip", F.col("geoip.country_iso_code").alias("country"), F.col("geoip.city_name").alias("city"))


def streamed_certificates(spark: SparkSession, folder: str) -> DataFrame:
    """Certificate messages as landed files through a stream into a keyed table.

    The messages of a domain agree on everything but the fingerprint, which file
    order decides, so that is left out here.
    """
    path = scratch(spark)
    feeds.certificate_lines(spark, folder).select("value").write.text(f"{path}/in")
    watch(spark, "certificates", f"{path}/in", f"{path}/table", f"{path}/checkpoint", finite=True, seen=SEEN).awaitTermination()
    docs = tables.current(spark, f"{path}/table", "certificates")
    return docs.select("domain", F.size("subject").alias("subjects"), times.iso(F.col("seen")).alias("seen"))


def two_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches of answer lines into a keyed table: names of an address are replaced as a whole."""
    path = scratch(spark)
    lines = feeds.reverse_name_lines(spark, folder)
    lines.select("value").write.text(f"{path}/first")
    name = feeds.reverse_name("c_custkey")
    later = table(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'")
    again = later.select(F.concat(name, F.lit(" PTR "), F.col("c_mktsegment"), F.lit(".example.")))
    again.write.text(f"{path}/second")
    for number, part in enumerate(("first", "second")):
        # All parts written by one job count as one feed, as its lines carry no order.
        parsed = reverse_names.parse_text(
            reverse_names.REVERSE.read(spark, f"{path}/{part}").withColumn("_file", F.lit(part)), sentinel=None)
        ingestion.write_parsed(reverse_names.REVERSE, parsed, f"{path}/table", number, seen=SEEN)
    docs = tables.current(spark, f"{path}/table", reverse_names.REVERSE)
    return docs.select("ip", joined("record").alias("record"))


def table_life(spark: SparkSession, folder: str) -> DataFrame:
    """A keyed table through ingestion, a stream, compaction, and a stream with another checkpoint."""
    path = scratch(spark)
    customers = table(spark, folder, "customer")
    name = feeds.reverse_name("c_custkey")
    stages = {"first": customers, "second": customers.where("c_custkey % 2 = 0"), "third": customers.where("c_custkey % 3 = 0")}
    for stage, rows in stages.items():
        rows.select(F.concat(name, F.lit(f" PTR {stage}.example."))).write.text(f"{path}/{stage}")
    ingestion.ingest(spark, reverse_names.REVERSE, f"{path}/first", f"{path}/table", seen=SEEN)
    for stage in ("second", "third"):
        watch(spark, reverse_names.REVERSE, f"{path}/{stage}", f"{path}/table", f"{path}/{stage}-checkpoint", finite=True,
              seen=SEEN).awaitTermination()
        tables.compact(spark, f"{path}/table", reverse_names.REVERSE)
    docs = tables.current(spark, f"{path}/table", reverse_names.REVERSE)
    return docs.select("ip", joined("record").alias("record"))


def _topic(spark: SparkSession, lines: DataFrame, later: Column, source, **options) -> DataFrame:
    """``lines`` of topics through a stream in two micro-batches: the rows where ``later`` holds come second."""
    path = scratch(spark)
    for stage, part in (("first", lines.where(~later)), ("second", lines.where(later))):
        part.select("value", "_file", "_block", "_row").write.parquet(f"{path}/in/{stage}")
        topic = spark.readStream.schema("value string, _file string, _block bigint, _row bigint").parquet(f"{path}/in/*")
        watch_frame(source, topic, f"{path}/table", f"{path}/checkpoint", finite=True, carry=True, seen=SEEN, **options).awaitTermination()
    return tables.current(spark, f"{path}/table", source)


def straddling_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The answer lines of a topic, most addresses in both of its micro-batches: the same as in one."""
    docs = _topic(spark, feeds.reverse_name_lines(spark, folder), F.col("_row") >= feeds.middle_row(spark, folder), reverse_names.REVERSE)
    return docs.select("ip", "part", F.size("record").alias("names"), joined("record").alias("record"))


def carried_marks(spark: SparkSession, folder: str) -> DataFrame:
    """Zones as topics in two micro-batches: transfer comments stay known, an end mark ends its topic for good."""
    lines, later = feeds.zone_topics(spark, folder)
    docs = _topic(spark, lines, later, zone.ZONES)
    types = docs.select("zone", "domain", "source", F.explode("records").alias("type", "list"))
    texts = F.transform("list", lambda r: F.concat_ws(" ", r["ttl"].cast("string"), r["data"]))
    return types.select("zone", "domain", "source", "type", F.array_join(texts, ";").alias("records"))


def dated_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """The port-scan feed as a snapshot a day; one day is written again with its banners only, a period is read."""
    path = scratch(spark)
    docs = _scans(spark, folder).withColumn("snapshot_date", F.col("seen").cast("date"))
    tables.write_dated(docs, path)
    # that day comes from its own folder: the feed is not parsed again for it
    again = tables.read_dated(spark, path, "2024-01-20", "2024-01-20").where("banner is not null")
    tables.write_dated(again, path)
    days = tables.read_dated(spark, path, "2024-01-08", "2024-01-25").groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("records"), F.count("banner").alias("banners"), F.count_distinct("ip").alias("addresses"))
    return days.withColumn("snapshot_date", F.col("snapshot_date").cast("string"))


def bucketed_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as a keyed table in buckets; what their orders tell is merged in, new keys come in."""
    name = f"netsift_{uuid.uuid4().hex}"
    stored = table(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'")
    stored = stored.select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"), F.lit(0).cast("bigint").alias("orders"))
    told = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("key")).agg(
        F.count(F.lit(1)).alias("orders"), F.max(F.col("o_orderdate").cast("date")).cast("string").alias("last_order"))
    first = keyed.write_bucketed(stored, name, ["key"], BUCKETS)
    return spark.table(keyed.upsert_bucketed(spark, name, first, told, ["key"], BUCKETS))


QUERIES = {
    f.__name__: f
    for f in (
        port_services, port_scan_parse, web_probe_parse, ptr_names, ptr_documents, ptr_runs, ptr_stream_upsert,
        zone_documents, zone_upsert, nested_match, certificate_domains, delegation_blocks, transfer_rows,
        blocklist_documents, licence_parse, mesh_payloads, exchange_prefixes, registry_object_attributes,
        changed_snapshots, geo_enrichment, listed_events, unlisted_events, longest_network, cidr_match, exact_match,
        text_match, date_range, upsert_merge, replace_by_key, sentinel_cut, reject_reasons, table_summary, text_sizes,
        export_round_trip, ingested_services, streamed_certificates, two_batches, table_life,
        enriched_ingest, nested_ranges, straddling_batches, carried_marks, dated_snapshots, bucketed_upsert,
        split_dump, ingest_progress,
    )
}
