"""Raw events through the checks."""

import gzip
import ipaddress
import json
import random

import pytest
from fixtures import make_events, tuples
from pyspark.sql import functions as F

from tallyloom.functions import network
from tallyloom.operators import enrich, ingest, usage
from tallyloom.schema import POLICY
from tallyloom.sources import files, warehouse


def line(event_id, **changes):
    base = {"event_id": event_id, "event_name": "level_start", "project_id": "p1", "device_id": "d1", "ts_client": 1730000000000}
    base.update(changes)
    return json.dumps({k: v for k, v in base.items() if v is not None})


def raw(spark, lines, **request):
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    defaults = {"batch_id": "b1", "api_key": "k1", "forwarded_for": None, "remote_addr": None, **request}
    return files.parse_lines(df.select("value", *[F.lit(v).cast("string").alias(k) for k, v in defaults.items()]))


def policy(spark, **rules):
    row = {f.name: None for f in POLICY.fields} | {"api_key": "k1"} | rules
    return spark.createDataFrame([tuple(row[f.name] for f in POLICY.fields)], POLICY)


def reasons(df):
    return {r["event_id"]: r["reason"] for r in df.collect()}


def test_reasons(spark):
    lines = [
        line("good-0001"),
        line("no-device-1", device_id=None),
        line("password-1", props={"Password": "x"}),
        line("long-name-1", event_name="a" * 100),
        line("iso-time-1", ts_client="2025-10-24T10:00:00Z"),
        line("no-time-01", ts_client=None),
        line("bad-time-1", ts_client="soon"),
        line("too-big-01", props={"t": "x" * 70_000}),
        line("list-props", props=[1]),
        line("short"),
        '{"event_id":"cut-off',
        "",
    ]
    result = ingest.classify(raw(spark, lines))
    assert reasons(result) == {
        "good-0001": None, "no-device-1": "invalid_schema", "password-1": "pii_blocked",
        "long-name-1": "invalid_schema", "iso-time-1": None, "no-time-01": "invalid_schema",
        "bad-time-1": "invalid_schema", "too-big-01": "payload_too_large", "list-props": "invalid_schema",
        "short": "invalid_schema", None: "invalid_schema",
    }
    assert ingest.accepted(result).count() + ingest.rejected(result).count() == result.count() == 11
    kept = ingest.rejected(result).filter("event_id IS NULL").first()
    assert kept["raw"] == '{"event_id":"cut-off'
    times = {r["event_id"]: r["ts_client"] for r in ingest.accepted(result).collect()}
    assert times == {"good-0001": 1730000000000000, "iso-time-1": 1761300000000000}


def test_policy_deny_and_mask(spark):
    denied = ingest.classify(raw(spark, [line("denied-001", props={"ssn": "123-45-6789"})]), policy(spark, props_allowlist=["ssn"], deny_keys=["ssn"]))
    assert reasons(denied) == {"denied-001": "pii_blocked"}
    masked = ingest.classify(raw(spark, [line("masked-001", props={"email": "kim@post.org"})]), policy(spark, props_allowlist=["email"], mask_keys=["email"]))
    assert masked.first()["props_json"] == '{"email":"***"}'


def test_allowlist_email_and_address(spark):
    lines = [line("allowed-01", props={"level": 1, "email": "kim@post.org", "foo": "bar"})]
    rules = policy(spark, props_allowlist=["level", "email"], pii_email="mask", mask_keys=[])
    row = ingest.classify(raw(spark, lines, forwarded_for="1.2.3.4"), rules).first()
    assert (row["props_json"], row["client_ip"]) == ('{"email":"***@post.org","level":1}', "1.2.3.0")


def test_ipv6_address(spark):
    row = ingest.classify(raw(spark, [line("01JIPV600001")], forwarded_for="2001:0db8:85a3:0000:0000:8a2e:0370:7334")).first()
    assert row["client_ip"] == "2001:db8:85a3:0:0:0:0:0"


def test_request_size(spark):
    lines = [line(f"01JSIZE{i:05d}") for i in range(120)]
    result = ingest.classify(raw(spark, lines), defaults=ingest.IngestDefaults(max_request_bytes=2048))
    assert set(reasons(result).values()) == {"request_too_large"}
    report = ingest.batch_report(result).first()
    assert (report["events"], report["accepted"], report["rejected"], report["refused"]) == (120, [], [], True)


def test_numeric_user_ids_are_masked(spark):
    row = ingest.classify(raw(spark, [line("01JUSER00001", user_id="4155551234")])).first()
    assert row["user_id"] == "xxxxxxxx34"


def test_request_fields_only_fill_gaps(spark):
    lines = [line("01JFILL00001", user_agent="own", client_ip="9.8.7.6"), line("01JFILL00002")]
    df = raw(spark, lines, remote_addr="1.2.3.4", header_user_agent="header")
    rows = {r["event_id"]: (r["user_agent"], r["client_ip"]) for r in ingest.classify(df).collect()}
    assert rows == {"01JFILL00001": ("own", "9.8.7.0"), "01JFILL00002": ("header", "1.2.3.0")}


def test_files(spark, tmp_path):
    import gzip

    (tmp_path / "nd").mkdir()
    (tmp_path / "nd" / "a.json").write_text(line("01JFILE00001") + "\n\n" + line("01JFILE00002") + "\n{bad\n")
    with gzip.open(tmp_path / "nd" / "b.json.gz", "wt") as out:
        out.write(line("01JFILE00003") + "\n")
    result = ingest.classify(files.read_ndjson(spark, str(tmp_path / "nd")))
    assert reasons(result) == {"01JFILE00001": None, "01JFILE00002": None, None: "invalid_schema", "01JFILE00003": None}
    assert result.select("batch_id").distinct().count() == 2

    (tmp_path / "arr").mkdir()
    (tmp_path / "arr" / "a.json").write_text(f"[{line('01JARRAY0001')},\n {line('01JARRAY0002')}]")
    (tmp_path / "arr" / "b.json").write_text("nonsense")
    (tmp_path / "arr" / "c.json").write_text("[" + ",".join(line(f"01JMANY{i:05d}") for i in range(40)) + "]")
    result = ingest.classify(
        files.read_json_arrays(spark, str(tmp_path / "arr"), max_request_bytes=2000), defaults=ingest.IngestDefaults(max_request_bytes=2000)
    )
    counts = tuples(result.groupBy("reason").count().na.fill("none"), "reason", "count")
    assert counts == [("invalid_schema", 1), ("none", 2), ("request_too_large", 1)]


def test_gunzip_in_pieces():
    import gzip

    rng = random.Random(5)
    for n in (0, 1, 100, 4096, 65536, 65537, 200_000):
        text = bytes(rng.randrange(256) for _ in range(n))
        for data, want in ((gzip.compress(text), text), (gzip.compress(text) + gzip.compress(b"tail") + b"\0\0", text + b"tail")):
            assert files.gunzip(data, 1 << 20) == (want, len(want), True)
            over = files.gunzip(data, max(0, len(want) - 1))
            assert over == ((want[: files.HEAD_BYTES], len(want), False) if want else (b"", 0, True))
    cut, size, whole = files.gunzip(gzip.compress(b"abc" * 1000)[:-9], 1 << 20)
    assert not whole and (b"abc" * 2000).startswith(cut) and size <= 3000
    assert files.gunzip(b"plain", 100) == (b"", 0, False)


def test_gzip_arrays(spark, tmp_path):
    """A small file that unpacks to 100 MB is refused with its size and its head; a broken one costs one row."""
    import gzip

    good = f"[{line('01JPACK00001')},{line('01JPACK00002')}]"
    (tmp_path / "a.json.gz").write_bytes(gzip.compress(good.encode()))
    with gzip.open(tmp_path / "b.json.gz", "wb") as out:
        out.write(b'[{"event_id":"01JHUGE"},')
        for _ in range(100):
            out.write(b" " * 1_000_000)
        out.write(b"1]")
    (tmp_path / "c.json.gz").write_bytes(gzip.compress(good.encode())[:60])
    (tmp_path / "d.json.gz").write_bytes(b"no gzip")
    (tmp_path / "e.json").write_text(f"[{line('01JPACK00003')}]")
    name = F.element_at(F.split("batch_id", "/"), -1).alias("file")
    given = files.read_json_arrays(spark, str(tmp_path))
    sizes = dict(given.select(name, "request_bytes").distinct().collect())
    assert (sizes["a.json.gz"], sizes["b.json.gz"]) == (len(good), 100_000_026)
    rows = {}
    for r in ingest.classify(given).select(name, "event_id", "reason", "raw").collect():
        rows.setdefault(r["file"], []).append(r)
    assert sorted((r["event_id"], r["reason"]) for r in rows["a.json.gz"]) == [("01JPACK00001", None), ("01JPACK00002", None)]
    (huge,) = rows["b.json.gz"]
    assert huge["reason"] == "request_too_large"
    assert huge["raw"].startswith('[{"event_id":"01JHUGE"}') and len(huge["raw"]) == files.HEAD_BYTES
    assert [r["reason"] for r in rows["c.json.gz"] + rows["d.json.gz"]] == ["invalid_schema"] * 2
    assert [(r["event_id"], r["reason"]) for r in rows["e.json"]] == [("01JPACK00003", None)]
    # The file source never opens what is unpacked here.
    only = tmp_path / "only"
    only.mkdir()
    (only / "b.json.gz").write_bytes((tmp_path / "b.json.gz").read_bytes())
    plain = spark.read.text(str(only), wholetext=True).filter(~F.col("_metadata.file_name").rlike(files.GZIP))
    assert plain.rdd.getNumPartitions() == 0


def test_country_lookup(spark):
    ranges = spark.createDataFrame(
        [("10.0.0.0", "10.2.255.255", "AA"), ("10.3.0.0", "10.3.0.255", "BB"), ("10.3.1.0", "10.3.1.255", "CC")],
        "start_ip string, end_ip string, country string",
    )
    events = spark.createDataFrame(
        [("1", "", "10.1.2.3"), ("2", "DE", "10.1.2.3"), ("3", "", "10.3.1.7"), ("4", None, "10.3.2.0"), ("5", "", None), ("6", "", "::1")],
        "event_id string, country string, client_ip string",
    )
    result = enrich.add_country(events, ranges)
    assert tuples(result, "event_id", "country") == [("1", "AA"), ("2", "DE"), ("3", "CC"), ("4", ""), ("5", ""), ("6", "")]
    nested = spark.createDataFrame(
        [("10.3.0.200", "10.3.1.5", "XX"), ("2001:db8::", "2001:db8:ffff:ffff:ffff:ffff:ffff:ffff", "V6"), ("2001:db8:1::7", "2001:db8:1::1f", "IN"), ("bad", "10.0.0.1", "NO"), ("10.9.0.0", "10.8.0.0", "NO")],
        ranges.schema,
    )
    rows = [("7", "", "10.3.0.201"), ("8", "", "2001:db8:1::1f"), ("9", "", "2001:0DB8:1::20"), ("10", "", "::ffff:10.1.2.3"), ("11", "", "fe80::1%eth0")]
    result = enrich.add_country(spark.createDataFrame(rows, events.schema), ranges.union(nested))
    assert tuples(result, "event_id", "country") == [("10", "AA"), ("11", ""), ("7", "XX"), ("8", "IN"), ("9", "V6")]


def _answer(rows, value):
    """What holds a value: the range that begins last and, of these, ends first."""
    held = [(low, -high, name) for low, high, name in rows if low <= value <= high]
    return max(held)[2] if held else ""


@pytest.mark.parametrize(("few", "per_task"), [(1000, 0), (0, 30), (0, 100_000)])
def test_overlapping_ranges(spark, monkeypatch, few, per_task):
    """A constant staircase, and both tables merged in many spans or in one, give what a look at all ranges gives."""
    rng = random.Random(few + per_task)
    ends = [sorted(rng.sample(range(1 << 12), 2)) for _ in range(40)] + [sorted((v, v + rng.randrange(9))) for v in rng.sample(range(1 << 12), 90)]
    ends += [[0, 4095], [5, 5], [0, 15], [16, 255], [4095, 4095], [0, 4095]]
    rows = [(low, high, f"{i:03d}") for i, (low, high) in enumerate(ends)]
    four = lambda v: f"0.0.{v >> 8}.{v & 255}"
    six = lambda v: f"2001:db8::{v:x}"
    given = [(text(low), text(high), tag + name) for text, tag in ((four, ""), (six, "v")) for low, high, name in rows]
    given += [("255.255.255.0", "255.255.255.255", "last")]
    ranges = spark.createDataFrame(given, "start_ip string, end_ip string, country string")
    asked = [(four(v), _answer(rows, v)) for v in range(0, 4200, 7)] + [(six(v), "v" + x if (x := _answer(rows, v)) else "") for v in range(0, 4200, 11)]
    asked += [("255.255.255.9", "last"), ("0.1.0.0", ""), ("2001:db9::", ""), ("::", ""), ("x", "")]
    asked = asked + asked[:300]
    events = spark.createDataFrame([(str(i), "", ip, want) for i, (ip, want) in enumerate(asked)], "event_id string, country string, client_ip string, want string")
    if per_task:
        monkeypatch.setattr(enrich.merge_ranges, "__defaults__", (per_task,))
    result = enrich.add_country(events, ranges, few=few)
    assert [tuple(r) for r in result.filter("country <> want").collect()] == []
    assert result.count() == len(asked)


def test_address_keys(spark):
    """The digits of all forms of an address, against the library of addresses."""
    good = ["1.2.3.4", "255.0.0.255", "::", "::1", "1::", "fe80::1%eth0", "2001:DB8::a:b", "1:2:3:4:5:6:7:8", "::ffff:1.2.3.4", "64:ff9b::1.2.3.4", "1:2:3:4:5:6:7::"]
    bad = ["", "1.2.3", "256.1.1.1", "1:2", "1:2:3:4:5:6:7:8:9", "::1::", ":::", "12345::", "g::1", "1.2.3.4.5", "::1.2.3.400", "1:2:3:4:5:6:7:"]
    df = spark.createDataFrame([(x,) for x in good + bad], "ip string").select("ip", network.address_key(F.col("ip")).alias("k"))
    got = {r["ip"]: r["k"] for r in df.collect()}
    for text in good:
        address = ipaddress.ip_address(text.split("%")[0])
        address = getattr(address, "ipv4_mapped", None) or address
        assert got[text] == address.packed.hex()
    assert {got[text] for text in bad} == {None}


def test_mapped_addresses(spark):
    rows = ["::ffff:1.2.3.4", "::FFFF:0102:0304", "::1.2.3.4", "1.2.3.4", "2001:db8::1", "x"]
    df = spark.createDataFrame([(r,) for r in rows], "ip string")
    got = {r["ip"]: (r["c"], r["k"]) for r in df.select("ip", network.coarse_ip(F.col("ip")).alias("c"), network.address_key(F.col("ip")).alias("k")).collect()}
    assert got["::ffff:1.2.3.4"] == ("::ffff:1.2.3.0", "01020304")
    assert got["::FFFF:0102:0304"] == ("::FFFF:0102:0304", "01020304")
    assert got["::1.2.3.4"] == ("0:0:0:0:0:0:0:0", "0" * 24 + "01020304")
    assert got["1.2.3.4"] == ("1.2.3.0", "01020304")
    assert got["2001:db8::1"] == ("2001:db8:0:0:0:0:0:0", "20010db8" + "0" * 23 + "1")
    assert got["x"] == (None, None)


def test_event_size_counts_props_as_an_object(spark):
    """The limit is on the event with its props nested: quotes in the props are not escaped once more."""
    def sized(n):
        return '{"event_id":"event-size-%d","event_name":"n","project_id":"p","device_id":"d","ts_client":1704067200000,"props":{"q":"%s"}}' % (n, '\\"' * n)

    lines = spark.createDataFrame([(sized(100),), (sized(500),)], "value string")
    rules = ingest.IngestDefaults(max_event_bytes=800)
    got = reasons(ingest.classify(files.parse_lines(lines), defaults=rules))
    assert got == {"event-size-100": None, "event-size-500": "payload_too_large"}
    assert ingest.batch_report(ingest.classify(files.parse_lines(lines), defaults=rules)).count() == 2


def test_warehouse_prunes(spark, tmp_path):
    rows = [(f"w{i}", "u", "d", "n", f"2024-0{1 + i % 3}-05 10:00:00") for i in range(30)]
    path = str(tmp_path / "events")
    warehouse.write_events(make_events(spark, rows), path)
    scan = warehouse.read_events(spark, path, "p1", "2024-02-01", "2024-02-28")
    assert scan.count() == 10
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "event_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


@pytest.mark.parametrize("limit", [1, 3, 7])
def test_refused_requests_equal_brute_force(spark, limit):
    import random

    rng = random.Random(limit)
    rows = [(rng.choice("aab"), i, 1704067200.0 + rng.randint(0, 150) + rng.choice([0, 0, 0.0005, 0.25])) for i in range(200)]
    df = spark.createDataFrame(rows, "api_key string, request_id long, t double").select(
        "api_key", "request_id", F.timestamp_micros(F.round(F.col("t") * 1e6).cast("long")).alias("ts")
    )
    expected, counts = set(), {}
    for key, rid, t in sorted(rows, key=lambda r: (round(r[2] * 1e6), r[1])):
        slot = (key, int(t // 60))
        counts[slot] = counts.get(slot, 0) + 1
        if counts[slot] > limit:
            expected.add((rid, counts[slot]))
    refused = usage.refused_requests(df, default=limit)
    assert {(r["request_id"], r["ordinal"]) for r in refused.collect()} == expected
    report = usage.rate_limit_report(df, default=limit).agg(F.sum("refused"), F.sum("requests")).first()
    assert tuple(report) == (len(expected), 200)


def test_events_are_not_shuffled_for_the_size_of_requests(spark):
    """Only requests above the limit are joined; each line of one is refused, and none of the others."""
    lines = [(line(f"event-{i:04}"), f"b{i // 10}" if i < 90 else None) for i in range(100)]
    lines += [(line("event-long", props={"note": "x" * 3000}), "b3")]
    raw_lines = files.parse_lines(spark.createDataFrame(lines, "value string, batch_id string"))
    got = ingest.classify(raw_lines, defaults=ingest.IngestDefaults(max_request_bytes=2000))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    refused = {r["event_id"] for r in got.filter(F.col("reason") == ingest.REQUEST_TOO_LARGE).collect()}
    assert refused == {*(f"event-{i:04}" for i in range(30, 40)), "event-long"}
    assert got.count() == 101


def test_arrays_whose_size_is_known_are_read_once(spark, tmp_path):
    (tmp_path / "a.json").write_text("[" + line("plain-001") + "]")
    (tmp_path / "b.json.gz").write_bytes(gzip.compress(("[" + line("packed-01") + "]").encode()))
    (tmp_path / "c.json").write_text("[" + line("large-001", props={"note": "x" * 3000}) + "]")
    rules = ingest.IngestDefaults(max_request_bytes=2000)
    got = ingest.classify(files.read_json_arrays(spark, str(tmp_path), 2000), defaults=rules)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    found = {(r["event_id"], r["reason"]) for r in got.collect()}
    assert found == {("plain-001", None), ("packed-01", None), (None, ingest.REQUEST_TOO_LARGE)}


def test_arrays_in_folders_are_read_folder_by_folder(spark, tmp_path):
    """Plain, gzip, broken and large files in partition folders: the rows of the flat folder; the result holds none of the files."""
    event = '{"event_id":"event-%05d","event_name":"login","project_id":"p1","device_id":"d","ts_client":1}'
    texts = {f"{n}.txt": f"[{event % n},{event % (n + 100)}]" for n in range(6)} | {"broken.txt": "[", "large.txt": " " * 3000}
    for n, (name, text) in enumerate(texts.items()):
        for folder in (tmp_path / "flat", tmp_path / "parts" / f"part={n % 3}"):
            folder.mkdir(parents=True, exist_ok=True)
            (folder / name).write_text(text)
            (folder / f"{name}.gz").write_bytes(gzip.compress(text.encode()))
    (tmp_path / "parts" / "_SUCCESS").touch()
    listings = "spark.sql.hive.filesourcePartitionFileCacheSize"
    before = spark.conf.get(listings)
    flat, parts = (files.read_json_arrays(spark, str(tmp_path / name), 2000) for name in ("flat", "parts"))
    assert spark.conf.get(listings) == before
    assert parts.columns == flat.columns and not parts.schema["request_bytes"].nullable

    def rows(df):
        file = F.substring_index("batch_id", "/", -1).alias("file")
        names = ("raw", "event_id", "request_bytes", "raw_bytes", "parse_error")
        return tuples(df.select(file, *[F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(c) for c in names]), "file", *names)

    assert rows(parts) == rows(flat) and parts.count() == 28
    assert all(".parquet" in name for name in parts.inputFiles())
