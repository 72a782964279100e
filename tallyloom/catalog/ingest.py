"""Checking, cleaning, dead letters, duplicates, enrichment, and reading back what was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.catalog.sql import AS_OF, EV, EXPOSED, VIEWS, plain_column, with_
from tallyloom.functions import masking, network
from tallyloom.operators import dedup as dd
from tallyloom.operators import enrich as en
from tallyloom.operators import experiments as exp
from tallyloom.operators import ingest
from tallyloom.session import work_dir
from tallyloom.sinks.dead_letters import dead_letters
from tallyloom.operators import tenants
from tallyloom.sinks.tables import (
    EVENT_DAYS,
    drop_expired_days,
    expire_events,
    keep_days,
    overwrite_days,
    publish_by_project,
)
from tallyloom.sources import avro_records, files, testdata, topics, warehouse

_TIME = "%Y-%m-%d %H:%M:%S.%g"
# Files of one event array each that lie in a folder, about.
FILES = 10_000

# The wire lines in SQL: policy group of the key (0 and 3 = allowlist, 1 = own lists,
# 2 = phone drop), the fault of each line, and the cleaned values.
WIRE = f"""wire AS (
  SELECT e.*, b.user_id AS u, b.event_id AS e, b.user_id % 4 AS g, b.event_id // 50 AS batch
  FROM ev e JOIN events b ON CAST(b.event_id AS VARCHAR) = e.event_id),
judged AS (
  SELECT *, CASE
      WHEN e % 103 = 0 THEN 'invalid_schema' WHEN e % 53 = 0 THEN 'invalid_schema'
      WHEN e % 89 = 0 AND g = 2 THEN 'pii_blocked' WHEN e % 107 = 0 AND g = 1 THEN 'pii_blocked'
      WHEN e % 107 = 0 AND g = 2 THEN 'payload_too_large' WHEN e % 1013 = 0 AND g IN (1, 2) THEN 'payload_too_large'
      WHEN e % 101 = 0 OR e % 97 = 0 THEN 'invalid_schema' END AS reason,
    CASE WHEN e % 103 = 0 THEN NULL WHEN e % 101 = 0 THEN CAST(e % 1000 AS VARCHAR)
      ELSE 'evt-' || lpad(CAST(e AS VARCHAR), 10, '0') END AS wire_id,
    CASE WHEN e % 7 = 0 THEN CASE WHEN g = 2 THEN NULL ELSE 'xxxxxxxxx' || right(lpad(CAST(u AS VARCHAR), 4, '0'), 2) END
      ELSE user_id END AS wire_user,
    CASE WHEN g = 1 THEN NULL WHEN e % 11 = 0 THEN '2001:db8:' || lower(to_hex(u)) || ':0:0:0:0:0'
      ELSE CASE WHEN e % 13 = 0 THEN '::ffff:' ELSE '' END || '10.' || (u % 256) || '.' || (e % 256) || '.0' END AS wire_ip
  FROM wire)"""


def _classified(spark, sf, **kw):
    return ingest.classify(testdata.raw_events(spark, sf), testdata.policies(spark, sf), **kw)


@query(
    "classify_events",
    with_(
        EV, WIRE,
        body=f"""SELECT CAST(batch AS VARCHAR) AS batch_id, wire_id AS event_id, reason,
          CASE WHEN reason = 'invalid_schema' THEN CASE WHEN e % 103 = 0 THEN 'unparsable' WHEN e % 53 = 0 THEN 'device_id required'
            WHEN e % 101 = 0 THEN 'event_id too short' ELSE 'event_name too long' END END AS detail,
          CASE WHEN e % 103 <> 0 THEN wire_user END AS user_id, wire_ip AS client_ip,
          CASE WHEN e % 103 <> 0 THEN epoch_us(ts_server) END AS ts_client,
          CASE WHEN e % 103 <> 0 THEN CASE WHEN g = 1 THEN 'u' || u || '@ex.com' ELSE '***' END END AS email,
          CASE WHEN e % 103 <> 0 THEN CASE g WHEN 1 THEN 'mail u' || u || '@ex.com now' WHEN 2 THEN 'mail ***@ex.com now' END END AS contact,
          CASE WHEN e % 103 <> 0 AND g <> 2 THEN 'call +x (xxx) xxx-xx' || right(lpad(CAST(e % 10000 AS VARCHAR), 4, '0'), 2) END AS note,
          CASE WHEN e % 103 <> 0 THEN least(50, e % 80 + 1) END AS items,
          CASE WHEN e % 103 <> 0 THEN '{{"a":{{"b":{{}},"n":1}}}}' END AS bag FROM judged""",
    ),
)
def classify_events(spark, sf):
    """Every line with its reason and its cleaned values."""
    p = "props_json"
    return _classified(spark, sf).select(
        "batch_id", "event_id", "reason", "detail", "user_id", "client_ip", "ts_client",
        F.get_json_object(p, "$.email").alias("email"),
        F.get_json_object(p, "$.contact").alias("contact"),
        F.get_json_object(p, "$.note").alias("note"),
        F.json_array_length(F.get_json_object(p, "$.arr")).alias("items"),
        F.get_json_object(p, "$.bag").alias("bag"),
    )


@query(
    "props_allowlist",
    with_(
        EV, WIRE,
        body="""SELECT wire_id AS event_id, CASE WHEN e % 103 = 0 THEN '' WHEN g IN (0, 3) THEN 'arr,bag,email,k,level,note'
          ELSE CASE WHEN e % 89 = 0 THEN 'Password,' ELSE '' END || 'arr,bag,' || CASE WHEN e % 107 = 0 THEN 'big,' ELSE '' END
            || 'contact,email,k,level' || CASE WHEN g = 1 THEN ',note' ELSE '' END
            || CASE WHEN e % 1009 = 0 OR e % 1013 = 0 THEN ',quoted' ELSE '' END END AS keys
        FROM judged""",
    ),
)
def props_allowlist(spark, sf):
    """The keys left in the props of each line, none where it does not parse."""
    keys = F.array_join(F.sort_array(F.json_object_keys("props_json")), ",")
    return _classified(spark, sf).select("event_id", keys.alias("keys"))


@query(
    "accepted_records",
    with_(
        EV, WIRE,
        body="""SELECT project_id, count(*) AS records, count(DISTINCT wire_id) AS ids, min(epoch_us(ts_server)) AS first_us,
          max(epoch_us(ts_server)) AS last_us, count(wire_ip) AS addresses FROM judged WHERE reason IS NULL GROUP BY project_id""",
    ),
)
def accepted_records(spark, sf):
    """Accepted events published in folders per project and read back."""
    path = work_dir(spark, "records")
    publish_by_project(ingest.accepted(_classified(spark, sf)), path)
    return spark.read.parquet(path).groupBy("project_id").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("event_id").alias("ids"),
        F.min("ts_client").alias("first_us"),
        F.max("ts_client").alias("last_us"),
        F.count("client_ip").alias("addresses"),
    )


@query(
    "dead_letters",
    with_(
        EV, WIRE,
        body="""SELECT coalesce(wire_id, '') AS event_id, reason, true AS has_raw FROM judged WHERE reason IS NOT NULL
          UNION ALL SELECT event_id, 'duplicate', false FROM ev WHERE CAST(event_id AS BIGINT) % 7 = 0""",
    ),
)
def dead_letters_query(spark, sf):
    """Refused lines and dropped duplicates in one table."""
    refused = ingest.rejected(_classified(spark, sf))
    copies = dd.duplicate_letters(testdata.records(spark, sf, copies=True))
    letters = dead_letters(refused.drop("detail"), copies)
    return letters.select("event_id", "reason", F.col("raw").isNotNull().alias("has_raw"))


@query(
    "batch_report",
    with_(
        EV, WIRE,
        body="""SELECT CAST(batch AS VARCHAR) AS batch_id, count(*) AS events,
          count(*) FILTER (WHERE reason IS NULL) AS accepted_events, count(*) FILTER (WHERE reason IS NOT NULL) AS rejected_events,
          coalesce(string_agg(wire_id, ',' ORDER BY wire_id) FILTER (WHERE reason IS NULL), '') AS accepted,
          coalesce(string_agg(coalesce(wire_id, '') || ':' || reason, ',' ORDER BY coalesce(wire_id, ''), reason)
            FILTER (WHERE reason IS NOT NULL), '') AS rejected
        FROM judged GROUP BY batch""",
    ),
)
def batch_report(spark, sf):
    report = ingest.batch_report(_classified(spark, sf))
    pairs = F.transform("rejected", lambda p: F.concat(p["event_id"], F.lit(":"), p["reason"]))
    return report.select(
        "batch_id", "events", "accepted_events", "rejected_events",
        F.array_join("accepted", ",").alias("accepted"), F.array_join(pairs, ",").alias("rejected"),
    )


@query(
    "request_size",
    with_(
        EV, WIRE,
        body="""SELECT CAST(batch AS VARCHAR) AS batch_id, count(*) AS events, bool_or(e % 107 = 0 OR e % 1009 = 0 OR e % 1013 = 0) AS refused FROM judged GROUP BY batch""",
    ),
)
def request_size(spark, sf):
    """Requests above 64 KiB are refused whole."""
    rules = ingest.IngestDefaults(max_request_bytes=65_536)
    report = ingest.batch_report(_classified(spark, sf, defaults=rules))
    return report.select("batch_id", "events", "refused")


_REASONS = with_(
    EV, WIRE, body="SELECT coalesce(reason, 'accepted') AS reason, count(*) AS events FROM judged GROUP BY ALL"
)


def _by_reason(classified):
    reason = F.coalesce("reason", F.lit("accepted"))
    return classified.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("events"))


@query("ndjson_files", _REASONS.replace("'pii_blocked' WHEN e % 107 = 0 AND g = 1 THEN 'pii_blocked'", "'pii_blocked'")
       .replace("e % 89 = 0 AND g = 2", "e % 89 = 0").replace("e % 107 = 0 AND g = 2", "e % 107 = 0")
       .replace("e % 1013 = 0 AND g IN (1, 2)", "e % 1013 = 0"))
def ndjson_files(spark, sf):
    """The lines written as gzip files and read back, without policies."""
    path = work_dir(spark, "ndjson")
    testdata.wire_lines(spark, sf).select("value").write.option("compression", "gzip").text(path)
    rules = ingest.IngestDefaults(max_request_bytes=2**40)
    return _by_reason(ingest.classify(files.read_ndjson(spark, path), defaults=rules))


@query(
    "json_array_files",
    with_(
        EV, WIRE,
        body="""SELECT coalesce(reason, 'accepted') AS reason, count(*) AS events FROM (
          SELECT CASE WHEN e % 53 = 0 THEN 'invalid_schema' WHEN e % 89 = 0 THEN 'pii_blocked'
            WHEN e % 107 = 0 OR e % 1013 = 0 THEN 'payload_too_large' WHEN e % 101 = 0 OR e % 97 = 0 THEN 'invalid_schema' END AS reason
          FROM (SELECT *, bool_or(e % 103 = 0) OVER (PARTITION BY batch) AS broken FROM judged) WHERE NOT broken
          UNION ALL SELECT 'invalid_schema' FROM judged GROUP BY batch HAVING bool_or(e % 103 = 0)) GROUP BY ALL""",
    ),
)
def json_array_files(spark, sf):
    """The lines of a request as one JSON array, one array per file; a line that is cut off breaks its array.

    Half of the files are plain, half are gzip files that are unpacked in pieces. They lie in folders of ``FILES`` each.
    """
    path = work_dir(spark, "arrays")
    body = F.concat(F.lit("["), F.array_join(F.collect_list("value"), ","), F.lit("]"))
    lines = testdata.wire_lines(spark, sf)
    folders = max(1, -(-lines.select("batch_id").distinct().count() // FILES))
    bodies = lines.groupBy("batch_id").agg(body.alias("value"))
    half = F.pmod(F.xxhash64("batch_id"), F.lit(2))
    placed = F.pmod(F.xxhash64(F.lit("part"), "batch_id"), F.lit(folders)).alias("part")
    for codec, part in (("none", bodies.filter(half == 0)), ("gzip", bodies.filter(half == 1))):
        # Tasks put their many files into place themselves, not the driver one by one.
        writer = part.select(placed, "value").write.mode("append").option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        writer.option("maxRecordsPerFile", 1).option("compression", codec).partitionBy("part").text(path)
    return _by_reason(ingest.classify(files.read_json_arrays(spark, path)))


@query(
    "policy_join",
    with_(
        EV, WIRE,
        body="""SELECT 'key' || g AS api_key, count(*) AS events,
          CASE g WHEN 1 THEN 'allow' ELSE 'mask' END AS rule_email, CASE g WHEN 2 THEN 'drop' ELSE 'mask' END AS rule_phone,
          CASE g WHEN 1 THEN 'drop' ELSE 'coarse' END AS rule_ip,
          CASE g WHEN 1 THEN 'big' ELSE 'password,pass,passwd,credit_card,ssn' END AS rule_deny,
          CASE g WHEN 1 THEN '' ELSE 'email,phone,mobile' END AS rule_mask,
          CASE WHEN g IN (0, 3) THEN 'k,level,note,bag,arr,email' ELSE '' END AS rule_allow FROM judged GROUP BY g""",
    ),
)
def policy_join(spark, sf):
    """The effective rules per key."""
    lines = testdata.wire_lines(spark, sf).select("api_key")
    lists = ("rule_deny", "rule_mask", "rule_allow")
    rules = ingest.with_policy(lines, testdata.policies(spark, sf)).withColumns(
        {c: F.array_join(c, ",") for c in lists}
    )
    return rules.groupBy("api_key", "rule_email", "rule_phone", "rule_ip", *lists).agg(
        F.count(F.lit(1)).alias("events")
    )


_EMAIL = r"[A-Z0-9._%+-]+(@[A-Z0-9.-]+\.[A-Z]{2,})"


def _digits(text: str) -> str:
    return f"length(regexp_replace({text}, '[^0-9]', '', 'g'))"


def _phone(text: str) -> str:
    return (
        f"regexp_replace(regexp_extract({text}, '(?s)^(.*)(\\d\\D*\\d\\D*)$', 1), '[0-9]', 'x', 'g') || "
        f"regexp_extract({text}, '(?s)^(.*)(\\d\\D*\\d\\D*)$', 2)"
    )


@query(
    "mask_email",
    f"SELECT doc_id, md5(regexp_replace(text, '{_EMAIL}', '***\\1', 'gi')) AS masked, "
    f"regexp_matches(text, '(?i){_EMAIL}') AS found FROM documents",
)
def mask_email(spark, sf):
    """E-mail addresses in whole documents."""
    text = F.col("text")
    return testdata.table(spark, sf, "documents").select(
        "doc_id", F.md5(masking.mask_email(text)).alias("masked"), masking.has_email(text).alias("found")
    )


@query(
    "mask_phone",
    f"SELECT doc_id, md5(CASE WHEN {_digits('text')} >= 10 THEN {_phone('text')} ELSE text END) AS masked FROM documents",
)
def mask_phone(spark, sf):
    """Digits of whole documents with ten digits or more."""
    text = F.col("text")
    masked = F.when(masking.has_phone(text), masking.mask_phone(text)).otherwise(text)
    return testdata.table(spark, sf, "documents").select("doc_id", F.md5(masked).alias("masked"))


@query(
    "mask_messages",
    f"""SELECT conv_id, turn, md5(CASE WHEN regexp_matches(text, '(?i){_EMAIL}') THEN regexp_replace(text, '{_EMAIL}', '***\\1', 'gi')
      WHEN {_digits('text')} >= 10 THEN {_phone('text')} ELSE text END) AS masked FROM conversations""",
)
def mask_messages(spark, sf):
    """Both rules in their order over conversation turns."""
    mode = F.lit("mask")
    return testdata.table(spark, sf, "conversations").select(
        "conv_id", "turn", F.md5(masking.mask_text(F.col("text"), mode, mode)).alias("masked")
    )


@query(
    "ip_coarse",
    with_(
        EV, WIRE,
        body="""SELECT e AS event_id, CASE WHEN e % 11 = 0 THEN '2001:db8:' || lower(to_hex(u)) || ':0:0:0:0:0'
          ELSE CASE WHEN e % 13 = 0 THEN '::ffff:' ELSE '' END || '10.' || (u % 256) || '.' || (e % 256) || '.0' END AS coarse FROM judged""",
    ),
)
def ip_coarse(spark, sf):
    """The client address of each event, coarsened."""
    ip = network.client_ip(testdata.forwarded_for(), F.lit("192.168.1.9"))
    return testdata.table(spark, sf, "events").select(
        "event_id", network.apply_ip_mode(ip, F.lit("coarse")).alias("coarse")
    )


@query(
    "dedup",
    with_(
        EV,
        body="""SELECT event_id, project_id, user_id, device_id, event_name, epoch_us(ts_server) AS ts_client,
          CASE WHEN CAST(event_id AS BIGINT) % 14 <> 0 THEN epoch_us(ts_server) END AS ts_server,
          CASE WHEN CAST(event_id AS BIGINT) % 7 = 0 THEN 2 ELSE 1 END AS copies FROM ev""",
    ),
)
def dedup(spark, sf):
    """First events and the number of rows each id had; copies differ, and some have no server time."""
    first = dd.first_events(testdata.records(spark, sf, copies=True))
    return first.select("event_id", "project_id", "user_id", "device_id", "event_name", "ts_client", "ts_server", "copies")


@query(
    "topic_records",
    with_(
        EV,
        body="""SELECT event_id, project_id, user_id, device_id, event_name, epoch_us(ts_server) AS ts_client, NULL AS reason
          FROM ev WHERE CAST(event_id AS BIGINT) % 53 <> 0
          UNION ALL BY NAME SELECT '' AS event_id, 'invalid_schema' AS reason FROM ev WHERE CAST(event_id AS BIGINT) % 53 = 0""",
    ),
)
def topic_records(spark, sf):
    """Records as messages, a third of them plain, a third behind each kind of frame, some cut short: written, read and decoded."""
    path = work_dir(spark, "messages")
    records = testdata.records(spark, sf)
    number = F.col("event_id").cast("long")
    for third in range(3):
        whole = avro_records.encode(records.filter((number % 3 == third) & (number % 53 != 0)))
        cut = avro_records.encode(records.filter((number % 3 == third) & (number % 53 == 0)))
        cut = cut.select(F.expr("substring(value, 1, length(value) - 1)").alias("value"))
        value = F.col("value") if third == 0 else avro_records.framed(F.col("value"), 7, wide=third == 2)
        whole.unionByName(cut).select(value.alias("value")).write.mode("append").parquet(path)
    good, letters = topics.decoded(spark.read.parquet(path))
    columns = ("event_id", "project_id", "user_id", "device_id", "event_name", "ts_client")
    return good.select(*columns, F.lit(None).cast("string").alias("reason")).unionByName(
        letters.select("event_id", "reason"), allowMissingColumns=True
    )


@query(
    "duplicate_letters",
    with_(
        EV,
        body="SELECT event_id, 'duplicate' AS reason FROM ev WHERE CAST(event_id AS BIGINT) % 7 = 0",
    ),
)
def duplicate_letters(spark, sf):
    return dd.duplicate_letters(testdata.records(spark, sf, copies=True))


# The narrower range wins: the upper half of the first network of each nation, over IPv4.
_GEO = """CASE WHEN {0} // 10 < 25 AND {0} % 10 <= 8 THEN
  CASE WHEN {0} % 10 = 0 AND e.event_id % 256 >= 128 AND e.event_id % 11 <> 0 THEN 'Z' ELSE 'N' END
  || chr(CAST(65 + {0} // 10 AS INTEGER)) ELSE '' END""".replace("e.event_id", "CAST(e.event_id AS BIGINT)")


@query(
    "enrich_country",
    with_(
        EV, WIRE,
        body=f"SELECT event_id, CASE WHEN country <> '' THEN country ELSE {_GEO.format('(u % 256)')} END AS country FROM wire e",
    ),
)
def enrich_country(spark, sf):
    """Empty countries from the address ranges."""
    records = testdata.records(spark, sf).select("event_id", "country", "client_ip")
    return en.add_country(records, testdata.geo_table(spark, sf)).select("event_id", "country")


@query(
    "enrich_country_networks",
    with_(
        EV, WIRE,
        body=f"""SELECT event_id, CASE WHEN country <> '' THEN country
          WHEN e % 11 <> 0 AND (u % 256 + e % 256) % 3 <> 0 THEN chr(CAST(65 + u % 256 % 26 AS INTEGER)) || chr(CAST(65 + e % 256 % 26 AS INTEGER))
          ELSE {_GEO.format('(u % 256)')} END AS country FROM wire e""",
    ),
)
def enrich_country_networks(spark, sf):
    """Empty countries from a table of ranges that grows with the networks in use: too many for a constant, it is merged."""
    records = testdata.records(spark, sf).select("event_id", "country", "client_ip")
    return en.add_country(records, testdata.geo_networks(spark, sf)).select("event_id", "country")


@query(
    "enrich_ua",
    with_(EV, body="SELECT event_id, ua_family, os_family, device_class FROM ev"),
)
def enrich_ua(spark, sf):
    """Agent columns parsed from the user-agent texts and read back from the props."""
    rows = en.enrich(testdata.records(spark, sf))
    return rows.select(
        "event_id", *[F.get_json_object("props_json", f"$.{c}").alias(c) for c in ("ua_family", "os_family", "device_class")]
    )


ENRICHED = f"""SELECT e.project_id, CAST(e.event_date AS VARCHAR) AS event_date, strftime(ts_server, '{_TIME}') AS ts_server,
  e.event_id, e.event_name, e.user_id, device_id, '' AS session_id, platform, app_version,
  CASE WHEN country <> '' THEN country ELSE {_GEO.format('(u % 256)')} END AS country,
  CAST(revenue_amount AS DOUBLE) AS revenue_amount,
  CASE WHEN e.event_name = 'revenue' THEN revenue_currency ELSE 'USD' END AS revenue_currency,
  ua_family, os_family, device_class FROM wire e"""


@query("enriched_events", with_(EV, WIRE, body=ENRICHED))
def enriched_events(spark, sf):
    """Duplicates dropped, then every column of the fact table."""
    records = testdata.records(spark, sf, copies=True)
    known = records.withColumn("ts_server", F.coalesce("ts_server", "ts_client"))
    first = dd.deduplicate(known)
    return en.enrich(first, testdata.geo_table(spark, sf)).drop("props_json")


@query(
    "enriched_as_written",
    with_(EV, body="SELECT event_id, CAST(0 AS DOUBLE) AS revenue_amount, 'USD' AS revenue_currency FROM ev"),
)
def enriched_as_written(spark, sf):
    """Revenue columns without the props, always 0 and USD."""
    rows = en.enrich(testdata.records(spark, sf), as_written=True)
    return rows.select("event_id", "revenue_amount", "revenue_currency")


@query(
    "required_fields",
    with_(
        EV, WIRE,
        body="""SELECT CASE WHEN e % 53 = 0 THEN 'invalid_schema' ELSE 'complete' END AS reason, count(*) AS events FROM wire GROUP BY ALL""",
    ),
)
def required_fields(spark, sf):
    """The split in front of the enrichment."""
    records = testdata.records(spark, sf)
    missing = F.col("event_id").cast("long") % 53 == 0
    records = records.withColumn("device_id", F.when(~missing, F.col("device_id")))
    complete, letters = en.split_required(records)
    both = complete.select(F.lit("complete").alias("reason")).unionByName(letters.select("reason"))
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("events"))


@query(
    "user_props_merge",
    with_(
        EV,
        body="""SELECT event_id, CASE WHEN event_name IN ('experiment_exposure', 'revenue') THEN NULL ELSE CAST(k AS VARCHAR) END AS k, plan
        FROM (SELECT e.event_id, e.event_name, CAST(json_extract_string(b.props, '$.k') AS BIGINT) AS k,
          CASE WHEN e.user_id = '' THEN NULL WHEN b.user_id % 2 = 0 THEN 'pro' ELSE 'free' END AS plan
          FROM ev e JOIN events b ON CAST(b.event_id AS VARCHAR) = e.event_id)""",
    ),
)
def user_props_merge(spark, sf):
    """The latest user properties under those of the event; ``k`` of an event wins over the user's."""
    events = testdata.events(spark, sf)
    users = events.filter("user_id <> ''").select("project_id", "user_id").distinct()
    even = F.regexp_extract("user_id", r"(\d+)", 1).cast("long") % 2 == 0
    now = F.when(even, F.lit('{"plan":"pro"}')).otherwise(F.lit('{"plan":"free"}'))
    versions = F.array(
        F.struct(F.lit(2).alias("version"), now.alias("user_props_json")),
        F.struct(F.lit(1).alias("version"), F.lit('{"plan":"trial"}').alias("user_props_json")),
    )
    props = users.select("*", F.inline(versions))
    merged = en.merge_user_props(events, props, "version")
    return merged.select("event_id", *[F.get_json_object("props_json", f"$.{c}").alias(c) for c in ("k", "plan")])


@query(
    "warehouse_scan",
    with_(
        EV,
        body="""SELECT CAST(event_date AS VARCHAR) AS event_date, event_name, count(*) AS events FROM ev
          WHERE project_id = 'p1' AND event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-12' GROUP BY ALL""",
    ),
)
def warehouse_scan(spark, sf):
    """The fact table written by project and month, then a pruned scan."""
    path = work_dir(spark, "events")
    columns = [f.name for f in testdata.EVENTS.fields]
    warehouse.write_events(testdata.events(spark, sf).select(*columns), path)
    part = warehouse.read_events(spark, path, "p1", "2024-01-05", "2024-01-12")
    return part.groupBy("event_date", "event_name").agg(F.count(F.lit(1)).alias("events"))


_KEPT = with_(
    EV, EXPOSED,
    body=f"""SELECT {', '.join(plain_column(c) for c in 'project_id event_date exp variant exposures users'.split())}
      FROM ({VIEWS['v_exp_exposures_by_day']}) WHERE event_date >= DATE '{AS_OF}' - 10""",
)


@query("keep_days", _KEPT)
def keep_days_query(spark, sf):
    """Retention of stored data as a filter."""
    daily = exp.exposures_by_day(exp.exposures(testdata.events(spark, sf)))
    return keep_days(daily, "event_date", AS_OF, 10)


@query("expire", _KEPT)
def expire(spark, sf):
    """Retention of stored data as deleted day folders."""
    path = work_dir(spark, "expire")
    daily = exp.exposures_by_day(exp.exposures(testdata.events(spark, sf)))
    overwrite_days(daily, path, "event_date")
    drop_expired_days(spark, path, "event_date", AS_OF, 10)
    return spark.read.parquet(path).select(*daily.columns)


_LATER = "2024-04-15"


@query(
    "expire_events",
    with_(
        EV,
        f"""limits AS (
          SELECT 'p' || s.s_suppkey AS project_id, CASE s.s_nationkey % 3 WHEN 0 THEN 90 WHEN 1 THEN 365 ELSE 1095 END AS days
          FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey
          WHERE s.s_suppkey % 13 <> 12 AND n.n_nationkey % 11 <> 10)""",
        body=f"""SELECT e.project_id, CAST(event_date AS VARCHAR) AS event_date, count(*) AS events
          FROM ev e LEFT JOIN limits l USING (project_id)
          WHERE event_date >= DATE '{_LATER}' - CAST(coalesce(l.days, {EVENT_DAYS}) AS INTEGER) GROUP BY ALL""",
    ),
)
def expire_events_query(spark, sf):
    """The fact table after events older than the limit of the tier are gone; a second run changes nothing."""
    path = work_dir(spark, "expire_events")
    columns = [f.name for f in testdata.EVENTS.fields]
    warehouse.write_events(testdata.events(spark, sf).select(*columns), path)
    limits = tenants.retention_limits(testdata.organizations(spark, sf), testdata.games(spark, sf))
    for _ in range(2):
        expire_events(spark, path, limits, _LATER)
    return warehouse.read_events(spark, path).groupBy("project_id", "event_date").agg(F.count(F.lit(1)).alias("events"))
