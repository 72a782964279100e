"""Expressions on single values."""

import random

import pytest
from fixtures import tuples
from pyspark.sql import functions as F

from tallyloom.functions import hashing, json_text, masking, network, versions
from tallyloom.functions.events import micros_from_text
from tallyloom.operators import conversion, experiments


def values(spark, items, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r["r"] for r in df.select("i", build(F.col("v")).alias("r")).orderBy("i").collect()]


def test_hash_vectors(spark):
    items = ["", "a", "foobar", "button_colour:s:ada", "button_colour:s:phone-77"]
    assert values(spark, items, hashing.hash32_hex) == ["811c9dc5", "e40c292c", "bf9cf968", "dfcdeecb", "1d000e6c"]


def fnv(text):
    h, raw = 0x811C9DC5, text.encode("utf-16-be")
    for i in range(0, len(raw), 2):
        h = ((h ^ int.from_bytes(raw[i : i + 2], "big")) * 0x01000193) & 0xFFFFFFFF
    return h


def test_hash_counts_utf16_units(spark):
    items = ["é", "日本", "a😀b", "😀"]
    assert values(spark, items, hashing.hash32) == [fnv(t) for t in items]


def experiment(spark, variants, salt="s"):
    config = spark.createDataFrame([("p1", "button_colour", salt)], "project_id string, id string, salt string")
    shape = "variants array<struct<name:string,weight:int>>"
    return config.withColumn("config", F.from_json(F.lit(variants), shape))


def assign(spark, variants, keys, mode="canonical"):
    users = spark.createDataFrame([(k,) for k in keys], "key string")
    rows = users.crossJoin(experiments.prepare_variants(experiment(spark, variants), mode))
    return {r["key"]: r["v"] for r in rows.select("key", experiments.choose_variant(F.col("key")).alias("v")).collect()}


HALVES = '{"variants":[{"name":"A","weight":50},{"name":"B","weight":50}]}'


def test_assignment_vectors(spark):
    """Two halves: the hash of experiment, salt and key, modulo the total weight, is below 50 or not."""
    expected = {k: "A" if fnv(f"button_colour:s:{k}") % 100 < 50 else "B" for k in ("ada", "bo", "cy", "tablet-5", "phone-77")}
    assert assign(spark, HALVES, list(expected)) == expected
    assert set(expected.values()) == {"A", "B"}


def test_assignment_without_variants(spark):
    assert assign(spark, '{"variants":[]}', ["u1"]) == {"u1": "A"}


def test_web_rule_for_zero_weights(spark):
    keys = [f"u{i}" for i in range(400)]
    zero = '{"variants":[{"name":"A","weight":0},{"name":"B","weight":100}]}'
    web = assign(spark, zero, keys, "web")
    assert 0 < sum(v == "A" for v in web.values()) < 20


def test_signed_rule_differs(spark):
    thirds = '{"variants":[{"name":"A","weight":1},{"name":"B","weight":1},{"name":"C","weight":1}]}'
    keys = [f"u{i}" for i in range(300)]
    plain, signed = assign(spark, thirds, keys), assign(spark, thirds, keys, "android")
    assert 90 < sum(plain[k] != signed[k] for k in keys) < 210


def test_hash_from_its_starts(spark):
    """The hash of a text behind any state, from those behind the low bits of the states there are."""
    items = ["", "a", "u1499", "x" * 80, "é1", "a😀b", "\x00\x7f", None]
    starts = [0, 5, 127, 128, 2166136261, 4294967295, 3735928559]
    texts = spark.createDataFrame([(t,) for t in items], "text string")
    low = F.lit(sorted({s & 127 for s in starts}))
    rows = texts.select("text", hashing.hash32_starts(F.col("text"), low).alias("hashes"), hashing.hash32_power(F.col("text")).alias("power"))
    rows = rows.select("*", F.explode(F.lit(starts).cast("array<long>")).alias("start"))
    quick = hashing.hash32_from(F.col("text"), F.col("start"), F.col("hashes"), F.col("power"))
    got = rows.select("text", "start", quick.alias("a"), hashing.hash32(F.col("text"), start=F.col("start")).alias("b")).collect()
    assert len(got) == 56 and all(r["a"] == r["b"] for r in got)


def test_a_wheel_of_many_variants(spark):
    keys = [f"u{i}" for i in range(300)]
    names = "ABCDEFGHIJ"
    tenths = '{"variants":[' + ",".join(f'{{"name":"{n}","weight":1}}' for n in names) + "]}"
    assert assign(spark, tenths, keys) == {k: names[fnv(f"button_colour:s:{k}") % 10] for k in keys}


def test_pairs_of_small_tables_are_dealt_to_many_tasks(spark):
    """Few users and experiments are few bytes, and their pairs are not: AQE must not put them into one task."""
    users = spark.createDataFrame([("p1", f"u{i}", "ios", "1.2", "de") for i in range(400)] + [("p1", "é", "", None, "")],
                                  "project_id string, key string, platform string, app_version string, country string").distinct()
    shape = "variants array<struct<name:string,weight:int>>, targeting struct<platform:array<string>,appVersionMin:string,appVersionMax:string,countries:array<string>>, metrics struct<primary:string>"
    config = '{"variants":[{"name":"A","weight":50},{"name":"B","weight":50}],"targeting":{"appVersionMin":"%s","countries":["DE"]}}'
    running = spark.createDataFrame([("p1", f"e{i}", "s", config % ("1.2.0" if i % 2 else "1.2.0.0.1")) for i in range(40)], "project_id string, id string, salt string, config string")
    running = running.withColumn("config", F.from_json("config", shape))
    got = experiments.assign(users, running)
    assert got.rdd.getNumPartitions() >= 64
    expected = {(f"e{i}", k): "A" if fnv(f"e{i}:s:{k}") % 100 < 50 else "B"
                for i in range(40) for k in [*(f"u{u}" for u in range(400) if i % 2), "é"]}
    assert {(r["exp"], r["key"]): r["variant"] for r in got.collect()} == expected
    events = spark.createDataFrame([("p1", "level_complete", f"u{i}", "", i) for i in range(400)],
                                   "project_id string, event_name string, user_id string, device_id string, ts_server long")
    firsts = conversion.first_conversion_by_experiment(events, running)
    assert firsts.rdd.getNumPartitions() >= 64
    assert sorted(tuple(r) for r in firsts.collect()) == sorted(("p1", f"e{e}", f"u{i}", i) for e in range(40) for i in range(400))


@pytest.mark.parametrize("mode", ["canonical", "web", "android"])
def test_pairs_need_no_function_over_arrays(spark, mode):
    """Texts that are not ASCII, wheels of none, few and many variants: the variant of a pair by itself. Functions over arrays, which end
    generated code, come behind a step that has dropped the hashes of the user."""
    shape = "variants array<struct<name:string,weight:int>>, targeting struct<platform:array<string>,appVersionMin:string,appVersionMax:string,countries:array<string>>, metrics struct<primary:string>"
    wheels = ['[]', '[{"name":"A","weight":0}]', '[{"name":"A","weight":10},{"weight":5},{"name":"C","weight":0}]', "[" + ",".join(f'{{"name":"v{i}","weight":{i % 3}}}' for i in range(9)) + "]"]
    running = spark.createDataFrame([("p", f"e{i}", "s", f'{{"variants":{w}}}') for i, w in enumerate([*wheels, *wheels])], "project_id string, id string, salt string, config string")
    running = running.withColumn("config", F.from_json("config", shape))
    users = spark.createDataFrame([("p", k, None, None, None) for k in [*(f"u{i}" for i in range(50)), "é", "a😀b", "", None]], "project_id string, key string, platform string, app_version string, country string")
    got = experiments.assign(users, running, mode)
    plan = got._jdf.queryExecution().optimizedPlan().toString().split("\n")
    assert "hashes" not in plan[0] and plan[1].startswith("+- Project") and "lambda" not in plan[1]
    pairs = users.select("key").crossJoin(experiments.prepare_variants(running, mode))
    want = pairs.select("id", "key", experiments.choose_variant(F.col("key")).alias("variant"))
    rows = lambda df, exp: sorted((r[exp], str(r["key"]), str(r["variant"])) for r in df.collect())
    assert rows(got, "exp") == rows(want, "id") and got.count() == 8 * 54


@pytest.mark.parametrize("a,b,gte", [("1.2.3", "1.2.0", True), ("1.2.3", "1.2.3", True), ("1.2.0", "1.3.0", False), ("1.2", "1.2.0", True), ("1.10", "1.9", True)])
def test_versions(spark, a, b, gte):
    row = spark.range(1).select(versions.gte(F.lit(a), F.lit(b)).alias("r")).first()
    assert row["r"] is gte


def test_masked_text(spark):
    mode = F.lit("mask")
    items = ["call +1 (415) 555-1234 ok", "kim@post.org b.c@d.org", "12345", "a@b.co 4155551234", "a@b.co_x@d.org"]
    assert values(spark, items, lambda c: masking.mask_text(c, mode, mode)) == [
        "call +x (xxx) xxx-xx34 ok", "***@post.org ***@d.org", "12345", "***@b.co 4155551234", "***@b.co***@d.org"
    ]


def test_mask_email_equals_the_plain_pattern(spark):
    """The linear pattern finds what the plain one finds, on random text."""
    import re

    rng = random.Random(7)
    items = ["".join(rng.choice("ab.@-_ A1%\n") for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    plain = re.compile(r"(?i)[A-Z0-9._%+-]+(@[A-Z0-9.-]+\.[A-Z]{2,})", re.ASCII)
    assert values(spark, items, masking.mask_email) == [plain.sub(r"***\1", t) for t in items]
    assert values(spark, items, masking.has_email) == [plain.search(t) is not None for t in items]


def test_long_text_without_address_is_quick(spark):
    mode = F.lit("mask")
    text = "x" * 300_000 + " a@b "
    assert values(spark, [text], lambda c: masking.mask_text(c, mode, mode)) == [text]


def test_modes(spark):
    def run(text, email, phone):
        return values(spark, [text], lambda c: masking.mask_text(c, F.lit(email), F.lit(phone)))[0]

    assert run("kim@post.org", "drop", "mask") is None
    assert run("kim@post.org", "allow", "mask") == "kim@post.org"
    assert run("4155551234 kim@post.org", "allow", "mask") == "xxxxxxxx34 kim@post.org"
    assert run("4155551234", "mask", "drop") is None


def test_addresses(spark):
    cases = {
        "1.2.3.4": "1.2.3.0",
        "2001:0db8:85a3:0000:0000:8a2e:0370:7334": "2001:db8:85a3:0:0:0:0:0",
        "::1": "0:0:0:0:0:0:0:0",
        "2001:DB8::": "2001:db8:0:0:0:0:0:0",
        "no address": None,
        "1::2::3": None,
        "": None,
    }
    assert values(spark, list(cases), lambda c: network.apply_ip_mode(c, F.lit("coarse"))) == list(cases.values())
    assert values(spark, ["1.2.3.4", None], lambda c: network.apply_ip_mode(c, F.lit("drop"))) == [None, None]
    first = network.client_ip(F.lit(" 1.2.3.4 , 5.6.7.8"), F.lit("9.9.9.9"))
    none = network.client_ip(F.lit(None).cast("string"), F.lit("9.9.9.9"))
    assert tuple(spark.range(1).select(first, none).first()) == ("1.2.3.4", "9.9.9.9")


def test_put_if_absent(spark):
    def add(c):
        return json_text.put_if_absent(c, {"ua": F.lit("x"), "os": F.lit(""), "dc": F.lit('a"b')})

    items = ['{"a":1}', "{}", "", None, "[1]", "bad", '{"ua":null}']
    assert values(spark, items, add) == [
        '{"a":1,"ua":"x","dc":"a\\"b"}', '{"ua":"x","dc":"a\\"b"}', '{"ua":"x","dc":"a\\"b"}', '{"ua":"x","dc":"a\\"b"}',
        "[1]", "bad", '{"ua":null,"dc":"a\\"b"}',
    ]


def test_strict_json_members(spark):
    df = spark.createDataFrame([('{"exp":5,"variant":"A"}',), ("{}",)], "p string")
    loose = df.select(json_text.json_fields(F.col("p"), "exp", "variant").alias("f")).select("f.*")
    strict = df.select(json_text.json_fields(F.col("p"), "exp", "variant", strict=True).alias("f")).select("f.*")
    assert tuples(loose, "exp", "variant") == [("", ""), ("5", "A")]
    assert tuples(strict, "exp", "variant") == [("", ""), ("", "A")]


def test_client_times(spark):
    assert values(spark, ["1730000000000", "1.73e12", "2025-10-24T10:00:00Z", "soon", None], micros_from_text) == [
        1730000000000000, 1730000000000000, 1761300000000000, None, None
    ]


def clean(spark, props, allow=(), mask=("email",), email="mask", phone="mask"):
    def build(c):
        names = F.array(*[F.lit(a) for a in allow]).cast("array<string>")
        masks = F.array(*[F.lit(m) for m in mask]).cast("array<string>")
        members = masking.keep_keys(masking.props_map(F.try_parse_json(c)), names)
        return masking.members_json(masking.clean_members(members, names, masks, F.lit(email), F.lit(phone)))

    return values(spark, [props], build)[0]


def test_clamp(spark):
    numbers = ",".join(str(i) for i in range(100))
    result = clean(spark, '{"bag":{"a":{"b":{"c":{"d":1}}}},"arr":[%s],"foo":1}' % numbers, ("bag", "arr"))
    assert result == '{"arr":[%s],"bag":{"a":{"b":{}}}}' % ",".join(str(i) for i in range(50))


def test_list_rules_differ_with_an_allowlist(spark):
    mixed = '{"l":[%s]}' % ",".join(["null"] * 10 + [str(i) for i in range(60)])
    assert clean(spark, mixed, ("l",)) == '{"l":[%s]}' % ",".join(str(i) for i in range(50))
    assert clean(spark, mixed) == '{"l":[%s]}' % ",".join(str(i) for i in range(40))


def test_nested_masking(spark):
    props = '{"x":{"Email":"a@b.co","n":null,"t":["a@b.co",4155551234,"4155551234"]},"email":5}'
    assert clean(spark, props) == '{"email":5,"x":{"Email":"***","t":["***@b.co",4155551234,"xxxxxxxx34"]}}'
