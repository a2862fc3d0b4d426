"""Document schemas, one per source.

Field names and value lists are fixed: documents must carry them as they are.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, INT, LONG, DOUBLE, BOOL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
TIME, DYNAMIC = T.TimestampNTZType(), T.VariantType()
TEXTS = T.ArrayType(TEXT)
EXTRA = T.MapType(TEXT, DYNAMIC)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


PORT_SCAN = struct(ip=TEXT, port=INT, proto=TEXT, service=TEXT, banner=TEXT, ttl=INT, seen=TIME)

WEB_HASH = struct(
    body_md5=TEXT, body_mmh3=TEXT, body_sha256=TEXT, body_simhash=TEXT,
    header_md5=TEXT, header_mmh3=TEXT, header_sha256=TEXT, header_simhash=TEXT,
)
WEB_PROBE = struct(
    timestamp=TEXT, hash=WEB_HASH, port=INT, url=TEXT, final_url=TEXT, input=TEXT, title=TEXT, scheme=TEXT,
    webserver=TEXT, body_preview=TEXT, content_type=TEXT, method=TEXT, host=TEXT, path=TEXT, favicon=TEXT,
    favicon_path=TEXT, a=TEXTS, cname=TEXTS, aaaa=TEXTS, tech=TEXTS, words=INT, lines=INT, status_code=INT,
    chain_status_codes=T.ArrayType(INT), content_length=INT, _extra=EXTRA,
)
# Probe fields that are not kept.
WEB_PROBE_DROPPED = ("failed", "knowledgebase", "time", "csp")

REVERSE_NAMES = struct(ip=TEXT, record=TEXTS, seen=TIME, part=INT)
REVERSE_STREAM = struct(
    ip=TEXT, nameserver=TEXT, record=TEXT, record_type=TEXT, ttl=INT, seen=TIME, _extra=EXTRA
)

# The record types a zone file may hold.
ZONE_RECORD_TYPES = (
    "a", "aaaa", "caa", "cdnskey", "cds", "cname", "dnskey", "ds", "mx", "naptr", "ns", "nsec", "nsec3",
    "nsec3param", "ptr", "rrsig", "rp", "sshfp", "soa", "srv", "txt", "type65534",
)
ZONE_RECORD = struct(ttl=LONG, data=TEXT)
ZONE = struct(
    domain=TEXT, zone=TEXT, records=T.MapType(TEXT, T.ArrayType(ZONE_RECORD)), source=TEXT, seen=TIME, part=INT
)

CERTIFICATE_NAMES = struct(domain=TEXT, fingerprint=TEXT, issuer=TEXT, subject=T.MapType(TEXT, TEXT), seen=TIME)

DELEGATION = struct(
    registry=TEXT, cc=TEXT, asn=struct(start=LONG, end=LONG), ip=struct(start=TEXT, end=TEXT), date=TIME,
    status=TEXT, extensions=TEXT, seen=TIME,
)
# The states of a delegated block.
DELEGATION_STATES = ("allocated", "assigned", "available", "reserved", "unallocated", "unknown")

ADDRESS_SETS = struct(
    original_set=T.ArrayType(struct(start_address=TEXT, end_address=TEXT)),
    transfer_set=T.ArrayType(struct(start_address=TEXT, end_address=TEXT)),
)
AS_NUMBER_SETS = struct(
    original_set=T.ArrayType(struct(start=LONG, end=LONG)), transfer_set=T.ArrayType(struct(start=LONG, end=LONG))
)
ORGANIZATION = struct(name=TEXT, country_code=TEXT)
TRANSFER = struct(
    transfer_date=TEXT, source_registration_date=TEXT, recipient_registration_date=TEXT, ip4nets=ADDRESS_SETS,
    ip6nets=ADDRESS_SETS, asns=AS_NUMBER_SETS, type=TEXT, source_organization=ORGANIZATION,
    recipient_organization=ORGANIZATION, source_rir=TEXT, recipient_rir=TEXT, seen=TIME, _extra=EXTRA,
)
# The kinds of transfer.
TRANSFER_TYPES = ("MERGER_ACQUISITION", "RESOURCE_TRANSFER")

BLOCKLIST = struct(ip=TEXT, ipsets=TEXTS, categories=TEXTS, seen=TIME)
# List name endings that mark history variants.
BLOCKLIST_HISTORY = ("_1d", "_7d", "_30d", "_90d", "_180d", "_365d", "_730d")

# Licence columns and the conversions they need.
LICENCE_COLUMNS = (
    "license_id", "source_system", "callsign", "facility_id", "frn", "lic_name", "common_name",
    "radio_service_code", "radio_service_desc", "rollup_category_code", "rollup_category_desc", "grant_date",
    "expired_date", "cancellation_date", "last_action_date", "lic_status_code", "lic_status_desc",
    "rollup_status_code", "rollup_status_desc", "entity_type_code", "entity_type_desc", "rollup_entity_code",
    "rollup_entity_desc", "lic_address", "lic_city", "lic_state", "lic_zip_code", "lic_attention_line",
    "contact_company", "contact_name", "contact_title", "contact_address1", "contact_address2", "contact_city",
    "contact_state", "contact_zip", "contact_country", "contact_phone", "contact_fax", "contact_email",
    "market_code", "market_desc", "channel_block", "loc_type_code", "loc_type_desc", "loc_city",
    "loc_county_code", "loc_county_name", "loc_state", "loc_radius_op", "loc_seq_id", "loc_lat_deg",
    "loc_lat_min", "loc_lat_sec", "loc_lat_dir", "loc_long_deg", "loc_long_min", "loc_long_sec", "loc_long_dir",
    "hgt_structure", "asr_num", "antenna_id", "ant_seq_id", "ant_make", "ant_model", "ant_type_code",
    "ant_type_desc", "azimuth", "beamwidth", "polarization_code", "frequency_id", "freq_seq_id",
    "freq_class_station_code", "freq_class_station_desc", "power_erp", "power_output", "frequency_assigned",
    "frequency_upper_band", "unit_of_measure", "tolerance", "emission_id", "emission_seq_id", "emission_code",
    "ground_elevation",
)
LICENCE_DATES = ("grant_date", "expired_date", "cancellation_date", "last_action_date")
LICENCE_INTEGERS = (
    "facility_id", "loc_lat_deg", "loc_long_deg", "loc_lat_min", "loc_long_min", "loc_seq_id", "ant_seq_id",
    "freq_seq_id", "emission_seq_id",
    "license_id", "antenna_id", "frequency_id", "emission_id",
)
LICENCE_NUMBERS = (
    "loc_lat_sec", "loc_long_sec", "loc_radius_op", "hgt_structure", "azimuth", "beamwidth", "power_erp",
    "power_output", "frequency_assigned", "frequency_upper_band", "tolerance", "ground_elevation",
)


def _licence_type(name: str) -> T.DataType:
    if name in LICENCE_DATES:
        return TIME
    if name in LICENCE_INTEGERS:
        return LONG
    return DOUBLE if name in LICENCE_NUMBERS else TEXT


LICENCE = struct(**{name: _licence_type(name) for name in LICENCE_COLUMNS}, _extra=T.MapType(TEXT, TEXT))

# Payload fields of mesh-radio messages.
MESH_PAYLOAD = struct(
    HDOP=LONG, PDOP=LONG, altitude=LONG, altitudeGeoidalSeparation=LONG, altitudeHae=LONG,
    deviceMetrics=struct(
        airUtilTx=DOUBLE, batteryLevel=LONG, channelUtilization=DOUBLE, uptimeSeconds=LONG, voltage=DOUBLE
    ),
    environmentMetrics=struct(
        barometricPressure=DOUBLE, current=DOUBLE, distance=TEXT, gasResistance=DOUBLE, iaq=LONG, lux=DOUBLE,
        relativeHumidity=DOUBLE, temperature=DOUBLE, voltage=DOUBLE, whiteLux=DOUBLE, windDirection=LONG,
        windSpeed=DOUBLE,
    ),
    errorReason=TEXT, groundSpeed=LONG, groundTrack=LONG, hwModel=TEXT, id=TEXT, isLicensed=BOOL,
    lastSentById=LONG, latitudeI=LONG, locationSource=TEXT, longName=TEXT, longitudeI=LONG, macaddr=TEXT,
    neighbors=T.ArrayType(struct(nodeId=LONG, snr=DOUBLE)), nodeBroadcastIntervalSecs=LONG, nodeId=LONG,
    powerMetrics=struct(
        ch1Current=DOUBLE, ch1Voltage=DOUBLE, ch2Current=DOUBLE, ch2Voltage=DOUBLE, ch3Current=DOUBLE,
        ch3Voltage=DOUBLE,
    ),
    precisionBits=LONG, publicKey=TEXT, role=TEXT, route=T.ArrayType(LONG), routeBack=T.ArrayType(LONG),
    satsInView=LONG, seqNumber=LONG, shortName=TEXT, snrBack=T.ArrayType(LONG), snrTowards=T.ArrayType(LONG),
    time=LONG, timestamp=LONG,
)
# As stored: times are instants, ``value`` holds a payload that is no object, ``raw`` all of it.
MESH_PAYLOAD_STORED = T.StructType(
    [f for f in MESH_PAYLOAD.fields if f.name not in ("time", "timestamp")]
    + struct(time=TIME, timestamp=TIME, value=DYNAMIC, raw=DYNAMIC).fields
)
MESH_MESSAGE = T.StructType(
    [T.StructField("channel", LONG),
     T.StructField("decoded", struct(
         bitfield=LONG, payload=T.ArrayType(MESH_PAYLOAD_STORED), portnum=TEXT, requestId=LONG, wantResponse=BOOL, _extra=EXTRA)),
     T.StructField("from", LONG)]
    + struct(
        hopLimit=LONG, hopStart=LONG, id=LONG, priority=TEXT, rxRssi=LONG, rxSnr=DOUBLE, rxTime=TIME, to=LONG,
        viaMqtt=BOOL, wantAck=BOOL, _extra=EXTRA,
    ).fields
)

EXCHANGE = struct(
    name=TEXT, alternatenames=TEXTS, sources=TEXTS, prefixes=struct(ipv4=TEXTS, ipv6=TEXTS), url=TEXT, region=TEXT,
    country=TEXT, city=TEXT, state=TEXT, zip=TEXT, address=TEXT, iata=TEXT, latitude=DOUBLE, longitude=DOUBLE,
    geo_id=INT, ix_id=INT, org_id=INT, pdb_id=INT, pdb_org_id=INT, pch_id=INT,
)

REGISTRY_OBJECT = struct(object_class=TEXT, object_id=TEXT, attributes=T.MapType(TEXT, TEXTS))

GEO = struct(
    city_name=TEXT, continent_name=TEXT, country_iso_code=TEXT, country_name=TEXT,
    location=struct(lat=DOUBLE, lon=DOUBLE), region_iso_code=TEXT, region_name=TEXT,
)
