"""The corpus pipeline: language, near duplicates, secrets, mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``docs``, so a stage can be left out, or its result written and read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import langid, mixing, near_dedup, packing, secrets
from tallyloom.llm.common import documents, saved

#: Words of a shingle, where no contract names another number.
SHINGLE = 5


def _numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with numbers for names, which clash with nothing an operator adds, and the number of each name."""
    numbers = {name: f"c{i}" for i, name in enumerate(docs.columns)}
    return docs.toDF(*numbers.values()), numbers


def _named(rows: DataFrame, numbers: dict[str, str], **changed: Column) -> DataFrame:
    """The columns of the input under their names, some of them changed."""
    return rows.select(*[changed.get(name, F.col(c)).alias(name) for name, c in numbers.items()])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a language: null, or without any letter. ``lang`` becomes the predicted one."""
    rows, c = _numbered(docs)
    found = langid.predict(rows, langid.fit(docs.select("doc_id", "text", "lang")), text=c["text"])
    return _named(found.filter(F.col("lang_pred") != langid.UNKNOWN), c, lang=F.col("lang_pred"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the one with the smallest id.

    A row without an id goes by a hash of its text, above 2**62: behind all rows with an id, and equal texts without one are one
    document. Of rows with the same id and text the one whose other columns are least stays.
    """
    hashed = F.lit(1 << 62) + F.xxhash64("c_text").bitwiseAND((1 << 62) - 1)
    rows, c = _numbered(docs)
    rows = rows.withColumnRenamed(c["text"], "c_text").withColumn("key", F.coalesce(F.col(c["doc_id"]).cast("long"), hashed))
    kept = near_dedup.near_duplicates(rows, key="key", text="c_text", n=SHINGLE).filter("kept").select("key").distinct()
    rest = [x for name, x in c.items() if name != "text"]
    once = rows.join(kept, "key", "left_semi").groupBy("key", "c_text").agg(F.min(F.struct(*rest)).alias("row"))
    return once.select(*[F.col("c_text" if name == "text" else f"row.{x}").alias(name) for name, x in c.items()])


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind of each secret in its place; ``n_chars`` follows the text."""
    rows, c = _numbered(docs)
    clean = secrets.scan(rows, text=c["text"], keep=[x for name, x in c.items() if name not in ("text", "n_chars")])
    length = F.length("clean_text").cast(docs.schema["n_chars"].dataType)
    return _named(clean, c, text=F.col("clean_text"), n_chars=length)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bring the sources to their target weights: each document as often as the mix takes it."""
    rows, c = _numbered(docs)
    return _named(mixing.mixed(rows, key=c["doc_id"], text=c["text"], source=c["source"]), c)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 2048 tokens."""
    return packing.packed(docs)


STAGES = [
    ("language ID", language_id),
    ("near duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("source mix", source_mix),
    ("packing", packed),
]

#: Learned models, sampling by a Spark hash and tokenizers are beyond SQL; tests compare with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written to the shared folder before the next reads it."""
    docs = documents(spark, sf_dir)
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = saved(docs, f"stage{number + 1}")
    return docs
