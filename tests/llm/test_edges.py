"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import base64
import math
import time

import numpy as np
import pyarrow as pa
import pytest
from llm import brute
from pyspark.sql import functions as F

from tallyloom.llm import (
    common,
    langid,
    lm,
    mixing,
    near_dedup,
    neighbors,
    packing,
    quality,
    secrets,
    substrings,
    toxicity,
)
from tallyloom.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, key string, score double, block int, id int"
LONG = " ".join(f"w{i % 700}x{i % 1100}" for i in range(60000))
PASSAGE = " ".join(f"p{i}" for i in range(60))


def table(spark, rows):
    full = [(d, t, l, s, None if t is None else len(t), 7, "k", 0.5, 1, 2) for d, t, l, s in rows]
    return spark.createDataFrame(full, SCHEMA)


ROWS = [
    (1, "the cat sat on the mat and looked at the moon", "en", "a"),
    (2, "the cat sat on the mat and looked at the moon", "en", "a"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, " \t\n ", "de", "b"),
    (6, LONG, "en", "b"),
    (7, LONG + " end", None, "b"),
    (8, "ein Satz über die Straße und das Haus", "de", None),
    (8, "ein Satz über die Straße und das Haus", "de", None),
    (None, "the cat sat on the mat and looked at the moon", "en", "c"),
    (9, "one", "en", "é"),
    (10, "12 + 34 = 46 !!", "en", "c"),
    (11, PASSAGE + " tail of eleven", "en", "c"),
    (12, "head of twelve " + PASSAGE, "en", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, ROWS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


def test_near_duplicates(docs, none):
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs).collect()}
    assert [got[i]["component_id"] for i in (1, 2, 6, 7, 8, 9)] == [1, 1, 6, 6, 8, 9]
    assert [got[i]["n_shingles"] for i in (3, 4, 5, 9)] == [0, 0, 0, 1]
    assert all(got[i]["kept"] for i in (1, 3, 4, 5, 6, 8, None)) and not got[2]["kept"] and not got[7]["kept"]
    assert got[None]["component_id"] is None
    assert near_dedup.near_duplicates(docs).count() == len(ROWS)
    assert near_dedup.near_duplicates(none).count() == 0


@pytest.mark.parametrize("block", [7, 64, 256])
def test_near_duplicates_at_the_threshold(spark, monkeypatch, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    # 40 shingles of which 36 are shared of 44 (linked) or 35 of 45 (not), in chains and with many copies.
    rng = np.random.default_rng(5)
    rows = []
    for i in range(60):
        base = [f"b{i}_{j}" for j in range(41)]
        at = len(rows)
        rows.append((at, " ".join(base)))
        for cut in (4, 5):
            changed = base[: 41 - cut] + [f"c{i}_{cut}_{j}" for j in range(cut)]
            rows.append((len(rows), " ".join(changed)))
    group = [f"g{j}" for j in range(120)]
    for i in range(200):
        other = list(group)
        for j in rng.choice(120, 4, replace=False):
            other[j] = f"v{i}_{j}"
        rows.append((len(rows), " ".join(other)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.near_duplicates(df).collect()}
    assert got == brute.near_duplicates(rows)


def test_rows_with_one_key_are_one_node(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    df = spark.createDataFrame([(5, a), (3, a), (5, b), (4, b), (6, b)], "doc_id long, text string")
    got = {(r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(df).collect()}
    assert got == {(3, 3), (4, 3), (5, 3), (6, 3)}


def test_texts_take_one_way_at_every_size(spark):
    rows = [(i % 3000 if i % 7 else None, f"t{i // 6000}") for i in range(9000)]
    texts = spark.createDataFrame(rows, "id long, text string")
    for wanted in (set(), {5}, set(range(0, 4000, 3))):
        ids = spark.createDataFrame([(i,) for i in wanted], "id long")
        got = near_dedup.texts_of(texts, ids)
        assert sorted(map(tuple, got.collect())) == sorted({r for r in rows if r[0] in wanted})
        plan = got._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin [id" in plan and "Broadcast" not in plan


def test_estimate_is_unbiased(spark):
    rng = np.random.default_rng(3)
    errors = []
    for share in (0.2, 0.5, 0.8, 0.95):
        for _ in range(60):
            common = rng.integers(0, 1 << 63, int(1000 * share)).astype(np.uint64)
            own = rng.integers(0, 1 << 63, 2 * (1000 - len(common))).astype(np.uint64)
            a, b = np.concatenate([common, own[::2]]), np.concatenate([common, own[1::2]])
            true = len(common) / (len(common) + len(own))
            sig = [near_dedup.signature(near_dedup.minima(x)).tolist() for x in (a, b)]
            errors.append((sig[0], sig[1], true))
    df = spark.createDataFrame(errors, "a array<long>, b array<long>, t double")
    rows = df.select("t", near_dedup.estimate(F.col("a"), F.col("b")).alias("e")).collect()
    assert abs(np.mean([r["e"] - r["t"] for r in rows])) < 0.01
    assert max(abs(r["e"] - r["t"]) for r in rows) < near_dedup.MARGIN


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 130)] + [(7, 5), (5, 7), (9, 9), (60, 50), (50, 70), (70, 60)]
    got = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    want = {i: 100 for i in range(100, 131)} | {5: 5, 7: 5, 50: 50, 60: 50, 70: 50}
    assert got == want


def der(tag, content):
    size = len(content)
    head = bytes([size]) if size < 128 else bytes([0x80 | (size.bit_length() + 7) // 8]) + size.to_bytes((size.bit_length() + 7) // 8, "big")
    return bytes([tag]) + head + content


def b64(data):
    return base64.b64encode(data).decode()


def url64(text):
    return base64.urlsafe_b64encode(text.encode()).decode().rstrip("=")


RSA = der(0x30, der(2, b"\0") + b"".join(der(2, bytes([0x11 + i]) * 40) for i in range(8)))
EC = der(0x30, der(2, b"\1") + der(4, b"k" * 32))
WRAPPED = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2a\x03")) + der(4, EC))
PUBLIC = der(0x30, der(0x30, der(6, b"\x2a\x03")) + der(3, b"\0" + b"p" * 64))


def field(data):
    return len(data).to_bytes(4, "big") + data


OPENSSH = b"openssh-key-v1\0" + field(b"none") * 2 + field(b"") + (1).to_bytes(4, "big") + field(b"pub" * 9) + field(b"priv" * 20)


def kinds(text):
    return [(kind, text[start:end]) for start, kind, end in sorted(secrets.structural(text))]


def test_structural_secrets():
    for key in (RSA, EC, WRAPPED, PUBLIC):
        assert kinds(f"x {b64(key)} y") == [("der", b64(key))]
        assert kinds(f"x {key.hex()} y") == [("hexder", key.hex())]
        assert not kinds(f"x {b64(key[:-1])} y") and not kinds(f"x {b64(key + b'z')} y")
    assert kinds(b64(OPENSSH)) == [("openssh", b64(OPENSSH))] and not kinds(b64(OPENSSH[:-9]))
    lines = "\n".join(b64(RSA)[i : i + 64] for i in range(0, len(b64(RSA)), 64))
    assert kinds(f"-----BEGIN-----\n{lines}\n-----END-----") == [("der", lines)]
    assert kinds(f"-----BEGIN-----\n{lines}\nword") == [("der", lines)]
    token = f"{url64('{\"alg\":\"HS256\"}')}.{url64('{\"sub\":1}')}.c2ln"
    assert kinds(f"<{token}>") == [("jwt", token)]
    assert not kinds(f"{url64('{\"typ\":1}')}.{url64('{}')}.c2ln")


P256 = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2a\x86\x48\xce\x3d\2\1") + der(6, b"\x2a\x86\x48\xce\x3d\3\1\7")) + der(4, der(0x30, der(2, b"\1") + der(4, b"s" * 32) + der(0xA1, der(3, b"\0\4" + b"q" * 64)))))
ED25519 = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2b\x65\x70")) + der(4, der(4, b"e" * 32)))


def folded(key, width, line_break):
    return line_break.join(b64(key)[i : i + width] for i in range(0, len(b64(key)), width))


@pytest.mark.parametrize("line_break", ["\n", "\r\n", "\\n", "\\r\\n", "\n    ", "  \n\t", "\\n  "])
def test_keys_in_a_list(line_break):
    assert (len(P256), len(ED25519)) == (138, 48) and "=" not in b64(P256) + b64(ED25519)
    keys = [b64(P256), b64(ED25519), b64(ED25519), b64(P256)]
    assert kinds(line_break.join(keys)) == [("der", key) for key in keys]
    # A run that is no key, one that states a length it does not have, and one of each kind.
    for no_key in ("M" * 40, "MIIC" + "x" * 60, "M" + "word" * 9, b64(P256)[:-8], "b3BlbnNzaC1rZXkt" + "A" * 40):
        assert kinds(line_break.join([no_key, b64(ED25519), no_key, "word", b64(P256)])) == [("der", b64(ED25519)), ("der", b64(P256))]
    ssh = OPENSSH + b"z" * (-len(OPENSSH) % 3)
    ssh = OPENSSH[:-84] + field(b"priv" * 20 + b"z" * (len(ssh) - len(OPENSSH)))
    sealed = ssh.replace(field(b"none") * 2, field(b"aes256-gcm@openssh.com") + field(b"bcrypt")) + b"t" * 16
    for key in (ssh, sealed):
        text = line_break.join([b64(ED25519), folded(key, 70, line_break), b64(P256), "word"])
        assert kinds(text) == [("der", b64(ED25519)), ("openssh", folded(key, 70, line_break)), ("der", b64(P256))]


def test_keys_in_quoted_and_indented_text():
    for key, kind in ((RSA, "der"), (WRAPPED, "der"), (PUBLIC, "der"), (OPENSSH, "openssh")):
        for line_break in ("\\n", "\\r\\n", "\\\\n", "\n    ", "\n\t", "\r"):
            lines = folded(key, 64, line_break)
            text = f'{{"private_key": "-----BEGIN PRIVATE KEY-----{line_break}{lines}{line_break}-----END PRIVATE KEY-----{line_break}"}}'
            assert kinds(text) == [(kind, lines)]
            assert lines not in secrets.redacted(text, secrets.structural(text))
    token = f"{url64('{\"alg\":\"HS256\"}')}.{url64('{\"sub\":1}')}.c2ln"
    assert kinds(f"a\\n{token}") == [("jwt", token)]


def test_many_lines_of_base64_end():
    lines = ["MIIP" + "A" * 60] * 20000
    assert not kinds("\n".join(lines)) and kinds("\n".join([*lines, b64(P256)])) == [("der", b64(P256))]


def test_secrets(spark, none):
    texts = [
        "password = hunter2x, TOKEN:'abcdef' Api_Key: abc", "secret: token: abcdefg", "AKIA" + "A" * 16 + "b", "x" + "0a" * 12,
        "AKIAAKIA" + "B" * 11, None, "", "paſſword=abcdefgh", "é🙂 passwd=abcdef", "token=" + b64(WRAPPED), "tokens=abcdefg secret=abcde",
    ]
    rows = secrets.scan(table(spark, [(i, t, None, None) for i, t in enumerate(texts)])).collect()
    for r in rows:
        text = texts[r["doc_id"]]
        assert (r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) == brute.base_secrets(text)
        if r["spans"]:
            assert r["clean_text"] != text
        else:
            assert r["clean_text"] == text
    clean = {r["doc_id"]: r["clean_text"] for r in rows}
    assert clean[8] == "é🙂 [assign]" and clean[9] == "[assign]"
    assert "der:6:" in next(r["spans"] for r in rows if r["doc_id"] == 9)
    assert secrets.scan(none).count() == 0


def test_packing(docs, none):
    rows = packing.packed(docs, capacity=64).collect()
    assert {r["doc_id"] for r in rows} == {d for d, *_ in ROWS}
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert r["length"] == 64 or r["piece"] == 0
    for held in by.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(r["doc_id"] == 8 for r in rows) == 2 * len({r["piece"] for r in rows if r["doc_id"] == 8})
    assert [r["length"] for r in rows if r["doc_id"] in (3, 4)] == [1, 1]
    assert packing.packed(none).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_shapes_hold_all_pieces(seed):
    rng = np.random.default_rng(seed)
    counts = {int(n): int(c) for n, c in zip(rng.choice(np.arange(1, 257), 90, replace=False), rng.integers(1, 600, 90), strict=True)}
    plan = packing.shapes(counts, 256)
    held = {}
    for many, lengths in plan:
        assert many > 0 and sum(lengths) <= 256 and sum(3 * n > 256 for n in lengths) <= 2
        for n in lengths:
            held[n] = held.get(n, 0) + many
    assert held == counts
    assert sum(m for m, _ in plan) <= 1.001 * brute.best_fit_decreasing(counts, 256) + 1


def test_tokens_of_both_libraries_agree():
    import public_tokenizers
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.encoder("byte_bpe_50k")
    texts = ["", "a  b\n\n c\t", "it's  über <|endoftext|> x", "日本語 text", "é x\x1c\x85y ½ ² ª", "'s 'S ''ll 12a_b\r\n "]
    rng = np.random.default_rng(0)
    texts += ["".join(chr(c) for c in rng.integers(1, 0x250, 300)) for _ in range(200)]
    for text in texts:
        assert encode(text) == full.encode(text, add_special_tokens=False).ids


def test_language_id(spark, docs, none):
    texts = {"de": "das ist ein langer Satz über die Straße", "en": "this is one long sentence about the street"}
    learned = [(i, t, k, "s") for i in range(30) for k, t in texts.items()]
    model = langid.fit(table(spark, learned))
    assert model.languages == ["de", "en"]
    got = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 3, 4, 5, 8, 10)] == ["en", "und", "und", "und", "de", "und"]
    assert got[3]["score"] == 0 and all(0 <= r["score"] <= 1 for r in got.values())
    assert langid.predict(docs, model).columns == [c for c in docs.columns if c != "score"] + ["lang_pred", "score"]
    empty = langid.fit(none)
    assert langid.predict(none, empty).count() == 0
    assert {r["lang_pred"] for r in langid.predict(docs, empty).collect()} == {"und"}


def test_language_model_learns_no_held_out_row(spark):
    rows = [(i, f"wort{i % 7} haus", "de" if i % 2 else "en", "s") for i in range(200)]
    df = table(spark, rows)
    out = [r["doc_id"] for r in df.filter(langid.held_out(F.col("doc_id"))).collect()]
    changed = df.withColumn("text", F.when(langid.held_out(F.col("doc_id")), "zzz").otherwise(F.col("text")))
    a, b = langid.fit(df), langid.fit(changed)
    assert out and np.array_equal(a.log_likelihood, b.log_likelihood)


def test_toxicity(spark, docs, none):
    rng = np.random.default_rng(9)
    texts = [" ".join("".join("abcdefghij"[int(c)] for c in str(j * 7919)) for j in rng.integers(0, 400, 30)) for _ in range(300)]
    rows = [(i, t + (" vilething" if i % 3 == 0 else ""), "en", "a") for i, t in enumerate(texts)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(200)] + [(None, None, 1), (5000, 1, None)], "doc_id long, quality int, toxic int")
    df = table(spark, rows)
    model = toxicity.fit(df, labels)
    got = {r["doc_id"]: r for r in toxicity.grade(df, model).collect()}
    assert all(got[i]["toxic"] == (i % 3 == 0) for i in range(300))
    assert list(model.thresholds) == sorted(model.thresholds)
    assert toxicity.grade(docs, model).filter("toxic").count() == 0
    assert toxicity.grade(docs, model).count() == len(ROWS)
    assert toxicity.grade(none, model).count() == 0
    assert not toxicity.grade(df, toxicity.fit(df, labels.limit(0))).filter("toxic").count()


def test_ordinal_fit_recovers_the_order():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (4000, 3)).astype(float)
    s = x @ np.array([2.0, -1.0, 0.0]) + rng.logistic(size=4000)
    weights, thresholds = toxicity.fit_ordinal(x, np.digitize(s, [0.5, 2.0]), 3)
    assert np.allclose(weights, [2, -1, 0], atol=0.25) and np.allclose(thresholds, [0.5, 2.0], atol=0.25)


def test_mix(spark, docs, none):
    rows = mixing.mix(docs).collect()
    assert len(rows) == len(ROWS)
    assert mixing.mix(docs).columns == [c for c in docs.columns if c != "size"] + ["size", "source_size", "target", "copies"]
    assert {r["source"] for r in rows} == {"a", "b", "c", "é", None}
    assert all(0 <= r["copies"] <= 2 for r in rows)
    assert mixing.mix(none).count() == 0
    assert mixing.mixed(docs).columns == docs.columns


def test_mix_reaches_the_targets(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i, n in enumerate(rng.integers(1, 400, 3000)):
        rows.append((i, "w " * int(n), "en", "hot" if i % 3 == 0 else f"s{i % 17}"))
    df = table(spark, rows)
    got = mixing.mix(df).groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("copies") * F.col("size")).alias("n"))
    for r in got.collect():
        assert abs(r["n"] - r["t"]) <= 0.002 * r["t"] + 5
    # Long documents are more probable than short ones, and none is certain that need not be.
    part = mixing.mix(df).filter("target < source_size").withColumn("long", F.col("size") > 200)
    share = {r["long"]: r["p"] for r in part.groupBy("long").agg(F.avg(F.col("copies").cast("double")).alias("p")).collect()}
    assert 0 < share[False] < share[True] < 1


def test_mix_of_rows_without_a_key(spark):
    """Texts of one size without a key are drawn one by one: the source comes near its target."""
    rows = [(None if i % 2 else i, f"t{i} " + "w " * 19, "en", "a") for i in range(6000)] + [(i, "w " * 10, "en", "b") for i in range(9000, 9300)]
    got = mixing.mix(table(spark, rows).repartition(3)).filter("source = 'a'")
    r = got.agg(F.first("target").alias("t"), F.sum(F.col("copies") * F.col("size")).alias("n"), F.count_if(F.col("copies") == 1).alias("c")).first()
    assert abs(r["n"] - r["t"]) <= 30 and 0 < r["c"] < 6000


def test_nearest(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(400, 8)))]
    rows += [(1000 + i, [1.0] * 8) for i in range(300)]  # one vector of many rows
    rows += [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [1.0] * 7 + [float("nan")]), (2004, [1.0, 2.0]), (2005, [1.0] * 7 + [None]), (None, [1.0] * 8), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = df.filter("vec_id in (0, 3, 1000, 1299, 2000, 2002, 2004) or vec_id is null")
    got = {}
    for r in neighbors.nearest(df, asked, shard=128).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {0, 3, 1000, 1299}
    assert [i for _, i, _ in sorted(got[1000])] == list(range(1001, 1011))
    assert [i for _, i, _ in sorted(got[1299])] == list(range(1000, 1010))
    single = {i: np.array(v, np.float32).astype(float) for i, v in rows if v and len(v) == 8 and None not in v and any(v) and not math.isnan(sum(v)) and i is not None}
    want = sorted((float(np.sqrt(((single[3] - v) ** 2).sum())), i) for i, v in single.items() if i != 3)[:10]
    assert len({i for _, i in want} & {i for _, i, _ in got[3]}) >= 9
    few = df.filter("vec_id < 4")
    assert neighbors.nearest(few, few).groupBy("query_id").count().filter("count = 3").count() == 4
    assert neighbors.nearest(df.limit(0), df).count() == 0
    assert neighbors.nearest(df, df.limit(0)).count() == 0
    # The blocks of queries are sent once per shard: Spark must not take them for small and broadcast them.
    assert "BroadcastExchange" not in neighbors.nearest(df, asked, shard=128)._jdf.queryExecution().executedPlan().toString()


def test_recall_of_a_shard():
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(3000, 48)).astype(np.float32)
    levels, graph = neighbors.build(vectors, np.arange(3000))
    assert len(graph) > 1
    found, _ = neighbors.search(vectors, levels, graph, vectors[::30])
    hits = 0
    for q, nodes in zip(vectors[::30], found, strict=True):
        hits += len(set(np.argsort(((vectors - q) ** 2).sum(axis=1))[:10].tolist()) & set(nodes[:10].tolist()))
    assert hits >= 0.9 * 1000


def test_repeated_words(spark, docs, none):
    got = {r["doc_id"]: r for r in substrings.repeated_words(docs).collect()}
    assert [(s["start"], s["end"]) for s in got[12]["spans"]] == [(3, 63)]
    assert got[12]["kept_text"] == "head of twelve" and not got[11]["spans"]
    assert [(s["start"], s["end"]) for s in got[7]["spans"]] == [(0, 60000)]
    assert got[3]["kept_text"] == got[4]["kept_text"] == "" and got[3]["n_words"] == 0
    assert substrings.repeated_words(docs).count() == len(ROWS)
    assert substrings.repeated_words(none).count() == 0


def test_window_hashes_roll():
    values = np.random.default_rng(7).integers(0, 1 << 63, 40).astype(np.uint64)
    rolled = substrings.window_hashes(np.concatenate([values, values]), 9)
    again = substrings.window_hashes(values, 9)
    assert np.array_equal(rolled[:32], again) and np.array_equal(rolled[40:], again)
    assert len(set(rolled.tolist())) == 40


def test_repeats_across_blocks(spark, monkeypatch):
    from tallyloom.llm import blocks

    rng = np.random.default_rng(8)
    rows = []
    for i in range(120):
        parts = [" ".join(f"u{i}_{j}" for j in range(30))]
        for k in rng.choice(12, 2, replace=False):
            parts.append(" ".join(f"p{k}_{j}" for j in range(55)))
        rows.append((i, "\n".join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(blocks, "PART_BYTES", 10_000)
    monkeypatch.setattr(blocks.pack, "__defaults__", (3000,))
    got = {r["doc_id"]: (r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["kept_text"]) for r in substrings.repeated_words(df).collect()}
    assert got == brute.repeats(rows)
    scores = {r["doc_id"]: r for r in lm.stupid_backoff(df).collect()}
    for (d, _), (n, score, backed, unseen) in zip(rows, brute.backoff(rows), strict=True):
        r = scores[d]
        assert (r["n_words"], r["backed_off"], r["unseen"]) == (n, backed, unseen)
        assert abs(r["log_score"] - score) < 1e-6


def test_quality(spark, docs, none):
    for r in quality.ledger(docs).collect():
        text = next(t for d, t, *_ in ROWS if d == r["doc_id"])
        want = brute.quality(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
    assert quality.ledger(docs).count() == len(ROWS)
    assert quality.ledger(none).count() == 0
    texts = ["a b c a b c a b c", "x\nx\n \n\x0b\nx", "a a a a", "# $ %\n# $ %", "    \x1c", "a b a b a", "é|ü"]
    rows = table(spark, [(i, t, None, None) for i, t in enumerate(texts)])
    for r in quality.ledger(rows).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute.quality(texts[r["doc_id"]])


def test_ablation(docs):
    rows = quality.ledger(docs).cache()
    masks = [r["failed"] for r in rows.collect()]
    whole = quality.mask(quality.POLICIES["web-1"])
    for r in quality.ablation(rows, "web-1").collect():
        bit = quality.mask((r["rule"],))
        assert r["n_failed"] == sum(bool(m & bit) for m in masks)
        assert r["n_failed_only"] == sum(m & whole == bit for m in masks)
        assert r["n_kept"] == sum(not m & whole for m in masks)


def test_backoff(docs, none):
    got = lm.stupid_backoff(docs).collect()
    want = brute.backoff([(d, t) for d, t, *_ in ROWS])
    assert sorted((r["n_words"], r["backed_off"], r["unseen"]) for r in got) == sorted((n, b, u) for n, _, b, u in want)
    assert np.allclose(sorted(r["log_score"] for r in got), sorted(s for _, s, _, _ in want))
    assert lm.stupid_backoff(none).count() == 0


@pytest.mark.parametrize("frequent", [1, 40, 1 << 18])
def test_backoff_of_frequent_ngrams(spark, frequent):
    """Counts that are broadcast and counts that are joined give one result, and broadcasts stay within the bound."""
    rng = np.random.default_rng(12)
    rows = [(i % 50, " ".join(f"w{int(x)}" for x in rng.zipf(1.6, int(rng.integers(0, 40))) if x < 60)) for i in range(120)]
    rows += [(None, "w1 w1 w1 W1"), (3, "w1"), (4, ""), (5, None), (6, "never seen"), (7, "x y z"), (7, "x y z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r["n_words"], r["backed_off"], r["unseen"], round(r["log_score"], 6)) for r in lm.stupid_backoff(df, frequent=frequent).collect())
    assert got == sorted((n, b, u, round(s, 6) + 0.0) for n, s, b, u in brute.backoff(rows))
    counts = [r["total"] for r in lm._counted(df, lm.ORDER).collect()]
    often = max(1, sum(max(0, len((t or "").split()) - n + 1) for _, t in rows for n in (1, 2, 3)) // frequent)
    assert sum(c > often for c in counts) <= frequent


def test_backoff_over_chunks(spark, monkeypatch):
    """Texts in many chunks score as texts in one; a chunk sends an n-gram once, however many of its texts hold it."""
    rng = np.random.default_rng(13)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.5, int(rng.integers(0, 30))) if x < 40)) for i in range(90)] + [(90, None), (91, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(lm, "HASH_BYTES", 60)
    monkeypatch.setattr(lm, "CHUNK_WORDS", 50)
    assert lm._chunked(df.withColumnRenamed("doc_id", "key")).select("chunk").distinct().count() > 10
    got = sorted((r["n_words"], r["backed_off"], r["unseen"], round(r["log_score"], 6)) for r in lm.stupid_backoff(df).collect())
    assert got == sorted((n, b, u, round(s, 6) + 0.0) for n, s, b, u in brute.backoff(rows))
    same = spark.range(40).select(F.lit(7).cast("long").alias("row"), F.lit("a b a b").alias("text")).coalesce(1)
    assert sorted(r["many"] for r in lm._exploded(same, 3).collect()) == [40, 40, 40, 80, 80, 80]


def test_saved_drops_its_shuffle_files(spark):
    blocks_ = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: blocks_.getAllBlocks().mkString(" ").count("shuffle_")
    before, conf = shuffled(), spark.conf.get(common.FREED, None)
    common.saved(spark.range(1000).repartition(7, "id"), "kept")
    kept = shuffled()
    assert kept > before
    freed = common.saved(spark.range(1000).repartition(7, "id"), "freed", free=True)
    for _ in range(100):  # they go in the background
        if shuffled() <= kept:
            break
        time.sleep(0.1)
    assert shuffled() <= kept
    assert freed.count() == 1000
    assert spark.conf.get(common.FREED, None) == conf


def test_ngrams_keep_whole_hashes(spark, monkeypatch):
    # Words whose hashes differ in the lowest bits only are other words, in a small corpus as well.
    near = {w: np.uint64(0x9E3779B97F4A7C15) + np.uint64(i) for i, w in enumerate([b"a", b"b", b"c", b"d"])}

    def hashed(texts):
        lists = [t.split() if t else [] for t in texts]
        sizes = np.array([len(x) for x in lists], np.int64)
        return np.array([near[w] for x in lists for w in x], np.uint64), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), sizes

    monkeypatch.setattr(lm, "ngram_hashes", lambda hashes, n: hashes)
    monkeypatch.setattr(lm, "_hashed", hashed)
    sent = []

    class Texts:
        def select(self, *_):
            return self

        def mapInArrow(self, function, schema):
            batch = pa.RecordBatch.from_pydict({"row": pa.array([1, 2], pa.int64()), "text": ["a b", "c d"]})
            sent.extend(x for b in function(iter([batch])) for x in b["hash"].to_pylist())
            return self

    lm._exploded(Texts(), 1)
    assert sorted(x % (1 << 64) for x in sent) == sorted(int(x) for x in near.values())


def test_toxicity_learns_from_all_drawn_rows(spark, monkeypatch):
    """Texts that share most words are all learned from; only equal ones count once, and keys with both labels not at all."""
    letters = lambda i: "".join("abcdefghij"[int(c)] for c in str(i))
    common = " ".join(f"word{letters(i)}" for i in range(40))
    rows = [(i, f"{common} xyz{letters(i)} " + ("awful nasty" if i % 2 else "kind gentle"), "en", "a") for i in range(60)]
    rows += [(100, rows[0][1], "en", "a"), (101, common, "en", "a")]
    labels = [(i, i % 2) for i in range(60)] + [(100, 0), (101, 0), (101, 1)]
    seen = []
    real = toxicity.fit_ordinal
    monkeypatch.setattr(toxicity, "fit_ordinal", lambda x, *a: seen.append(len(x)) or real(x, *a))
    model = toxicity.fit(table(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert seen == [60, 48]
    got = {r["doc_id"]: r["toxic"] for r in toxicity.grade(table(spark, rows), model).collect()}
    assert all(got[i] == bool(i % 2) for i in range(60))
