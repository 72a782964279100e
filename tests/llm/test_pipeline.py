"""The corpus pipeline against plain versions, stage by stage, over whole tables."""

from collections import Counter, defaultdict

import corpus_pipeline
import pytest
import regex
from llm import brute
from pyspark.sql import functions as F

from tallyloom.llm import mixing, packing, secrets

SF_DIR = "/root/testdata/sf0.01"
SMALL_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def chain(spark, tmp_path_factory):
    """The documents and what each stage makes of what its predecessor kept, through Parquet."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame(
        [(90001, None, "en", "src1", 0), (90002, "", None, None, 0), (90003, "12 34 !!", "en", "src2", 8), (0, None, None, None, None),
         (90004, "the old password = hunter2hunter2 was found in the long log file of the day", "en", "src3", 74)],
        docs.schema,
    )
    tables = [docs.unionByName(odd)]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(number))
        stage(spark, tables[-1], SF_DIR).write.parquet(path)
        tables.append(spark.read.parquet(path))
    return tables


def rows(df):
    return df.collect()


def test_columns(chain):
    for table in chain[1:-1]:
        assert table.columns == chain[0].columns
        assert [t for _, t in table.dtypes] == [t for _, t in chain[0].dtypes]


def test_language(chain):
    before, after = rows(chain[0]), rows(chain[1])
    speaks = [r for r in before if r["text"] and regex.search(r"\p{L}", r["text"])]
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in after) == Counter((r["doc_id"], r["text"], r["source"]) for r in speaks)
    assert all(r["lang"] for r in after)


def test_near_duplicates(chain):
    before = [(r["doc_id"], r["text"]) for r in rows(chain[1])]
    want = {d for d, (_, _, kept) in brute.near_duplicates(before, n=5).items() if kept}
    assert {r["doc_id"] for r in rows(chain[2])} == want
    assert chain[2].count() == len(want) < len(before)


def test_secrets(chain):
    before = {r["doc_id"]: r for r in rows(chain[2])}
    after = rows(chain[3])
    assert {r["doc_id"] for r in after} == set(before)
    changed = 0
    for r in after:
        text = before[r["doc_id"]]["text"]
        spans = secrets.base(text) + secrets.structural(text)
        assert r["text"] == secrets.redacted(text, spans) and r["n_chars"] == len(r["text"])
        changed += r["text"] != text
    assert changed


def test_mix(chain):
    before, after = rows(chain[3]), rows(chain[4])
    copies = Counter(r["doc_id"] for r in after)
    plan = {r["doc_id"]: r for r in mixing.mix(chain[3]).collect()}
    assert copies == Counter({d: r["copies"] for d, r in plan.items() if r["copies"]})
    taken, target = defaultdict(int), {}
    for r in before:
        taken[r["source"]] += copies[r["doc_id"]] * len(brute.words(r["text"]))
        target[r["source"]] = plan[r["doc_id"]]["target"]
    assert all(abs(taken[s] - target[s]) <= 0.01 * target[s] + 60 for s in target)


def test_packing(chain):
    encode = packing.encoder("byte_bpe_50k")
    size = Counter()
    for r in rows(chain[4]):
        size[r["doc_id"]] += len(encode(r["text"])) + 1
    bins, found = defaultdict(list), Counter()
    for r in rows(chain[5]):
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        found[r["doc_id"]] += r["length"]
    assert found == size
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_is_the_chain(spark):
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet")
    want = docs
    for _, stage in corpus_pipeline.STAGES:
        want = stage(spark, want, SMALL_DIR)
    places = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SMALL_DIR)
    count = lambda df: Counter(tuple(r) for r in df.select(*places).collect())
    assert count(got) == count(want)


def test_empty(spark):
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL_DIR)
        assert docs.count() == 0


def test_stage_keeps_other_columns(spark):
    """Columns with the names of what operators add, and with others of theirs, come through as they were."""
    clashing = ["size", "key", "score", "lang_pred", "spans", "target", "copies", "n_assign", "clean_text", "c_text", "c0", "row"]
    docs = spark.read.parquet(f"{SMALL_DIR}/documents.parquet").limit(40)
    docs = docs.withColumns({name: F.concat(F.lit(name), F.col("doc_id").cast("string")) for name in clashing})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL_DIR)
        assert out.columns == docs.columns
        kept = out.collect()
        assert kept and all(r[name] == f"{name}{r['doc_id']}" for r in kept for name in clashing)
        docs = out
    assert corpus_pipeline.packed(spark, docs, SMALL_DIR).count() >= len(kept)


def test_copies_without_an_id_go(spark):
    """Copies and near copies without an id leave one document; of equal rows the least other columns stay, in any order."""
    words = [f"word{i}" for i in range(60)]
    near = " ".join(words[:-1] + ["other"])
    rows = [(None, " ".join(words), "en", s, 1) for s in ("b", "a", None)] + [(None, near, "en", "a", 1), (None, "alone here", "en", "a", 1)]
    rows += [(5, "five and six", "en", s, 1) for s in ("z", "y")] + [(6, "five and six", "en", "x", 1), (7, " ".join(words), "en", "q", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for order in (rows, rows[::-1]):
        got = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(order, schema).repartition(3), SMALL_DIR).collect()
        assert sorted(((r["doc_id"], r["text"], r["source"]) for r in got), key=repr) == sorted(
            [(7, " ".join(words), "q"), (None, "alone here", "a"), (5, "five and six", "y")], key=repr
        )
