"""Importance resampling against a plain version; head and tail give one result."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from tallyloom.llm import resampling

SCHEMA = "doc_id long, text string, weight long, score double, key string, row int, rank long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, n):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i : i + k]) for k in range(1, n + 1) for i in range(len(words) - k + 1)]


def plain(docs, target, n, percent, least, buckets=97, seed=2024):
    def bucket(x):
        return zlib.crc32(x.encode()) % buckets

    ours = Counter(bucket(x) for _, t in docs for x in features(t, n)[1])
    theirs = Counter(bucket(x) for t in target for x in features(t, n)[1])
    s, t = sum(ours.values()), sum(theirs.values())
    gain = [math.floor(1000 * math.log((theirs[b] + 1) * (s + buckets) / ((ours[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out = []
    for key, text in docs:
        words, found = features(text, n)
        weight = sum(gain[bucket(x)] for x in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append((key, words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    quota = len(able) * percent // 100
    return out, able[:quota]


DOCS = [(i, " ".join(f"W{(i * j) % 23} w{j % 5}" for j in range(i % 40))) for i in range(120)]
DOCS += [(500, None), (501, ""), (502, "-- !! \n"), (503, "Größe GRÖSSE größe é É x\u0000y a1-b2"), (None, "w1 w2 " * 30), (None, "w1 w2 " * 30)]
DOCS += [(7, "w1 w2 w3 " * 9)] * 3 + [(504, "long " * 50_000)]
TARGET = ["w1 w2 w3 w1", "W4 größe", None, ""]


def table(spark, rows):
    return spark.createDataFrame([(k, t, 9, 0.5, "k", 3, 4) for k, t in rows], SCHEMA)


@pytest.mark.parametrize(("n", "head"), [(1, 4), (1, 10_000), (2, 0), (2, 6), (3, 10_000)])
def test_against_plain(spark, n, head):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    docs = table(spark, DOCS).repartition(3)
    got = resampling.resample(docs, target, n=n, buckets=97, percent=25, least_words=5, head=head).collect()
    want, drawn = plain(DOCS, TARGET, n, 25, 5)
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r["doc_id"], r["score"]) for r in ranked] == [(r[0], r[4]) for r in drawn]


def test_head_is_of_frequent_features(spark):
    rows = [(i, f"often rare{i} again") for i in range(200)]
    head = resampling.vocabulary(table(spark, rows), n=2, head=2)
    assert sorted(head.words) == [b"again", b"often"]
    assert len(head.pairs) <= 2


def test_one_key_and_score_for_most_rows(spark):
    rows = [(None, "a b c d e f")] * 3000 + [(i, "a b c d e g") for i in range(50)]
    got = resampling.resample(table(spark, rows).repartition(4), spark.createDataFrame([("a",)], "text string"), percent=50, least_words=5)
    ranks = sorted(r["rank"] for r in got.filter("rank IS NOT NULL").collect())
    assert ranks == list(range(1, 1526))
    assert got.count() == 3050


def test_drawn_rows_come_whole(spark):
    docs = table(spark, DOCS)
    target = spark.createDataFrame([("w1 w2",)], "text string")
    rows = resampling.sample(docs, target, percent=10, least_words=5)
    assert rows.columns == docs.columns
    ids = {r["doc_id"] for r in resampling.resample(docs, target, percent=10, least_words=5).filter("rank IS NOT NULL").collect()}
    assert {r["doc_id"] for r in rows.collect()} == ids
    assert {(r["score"], r["rank"], r["row"]) for r in rows.collect()} == {(0.5, 4, 3)}


def test_empty(spark):
    none, target = table(spark, []), spark.createDataFrame([], "text string")
    assert resampling.resample(none, target).collect() == []
    got = resampling.resample(table(spark, DOCS[:30]), target, percent=10).collect()
    assert len(got) == 30


def test_prune_keeps_heavy():
    counts = Counter({f"w{i}": 1 for i in range(1000)} | {"heavy": 500})
    resampling._prune(counts, 10)
    assert set(counts) == {"heavy"}
