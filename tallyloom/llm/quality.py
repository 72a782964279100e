"""Quality rules as a ledger of failure bits.

Every rule is measured and evaluated once per document. A failed rule sets its bit, so a row of the
ledger holds all measurements and one mask. A policy is a named, versioned set of rules: applying it
is one bitwise "and" on the ledger, and what each of its rules costs (ablation) is counted on the
distinct masks, of which there are at most two to the number of rules. Texts are not read again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import BLANKS, documents


@dataclass(frozen=True)
class Rule:
    """A document fails where ``fails``, an expression on the measurements, is true."""

    name: str
    fails: str


#: A rule's place is its bit; append rules, never reorder them.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 30 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 30 * n_words"),
    Rule("many_words", "n_words > 1000000"),
)

BASE_RULES = ("few_words", "repeated_words")

#: Policies by version. A version is never changed once used: add a new one.
POLICIES = {
    "base-1": BASE_RULES,
    "web-1": (*BASE_RULES, "symbols", "duplicate_lines", "short_words", "long_words"),
}
PRODUCTION = "web-1"


def mask(rules: tuple[str, ...]) -> int:
    """The bits of the named rules."""
    places = {rule.name: place for place, rule in enumerate(RULES)}
    return sum(1 << places[name] for name in rules)


def _settled(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later expressions may use many times and Spark computes once."""
    names = list(columns)
    row = F.struct(*[columns[n].alias(n) for n in names])
    return df.select("*", F.inline(F.array(row)))


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements of each row's text; a null text measures like an empty one."""
    given = df.withColumn("__text", F.coalesce(df[text].cast("string"), F.lit("")))
    body = F.col("__text")
    split = _settled(
        given,
        __words=F.filter(F.split(body, f"[{BLANKS}]+"), lambda w: w != ""),
        __lines=F.filter(F.split(body, "\n"), lambda line: F.rlike(line, F.lit(f"[^{BLANKS}]"))),
    )
    # Three-word windows, each as its hash: 64 bits tell the windows of one document apart.
    words = F.col("__words")
    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    hashed = _settled(
        split,
        __windows=F.when(F.size(words) > 2, windows).otherwise(F.array().cast("array<bigint>")),
        __low=F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(F.size(words)))) - 1,
        n_words=F.size(words).cast("long"),
        word_chars=F.length(F.translate(body, " \t\n\x0b\x0c\r", "")).cast("long"),
        n_symbols=(F.length(body) - F.length(F.translate(body, "#*$%&|<>", ""))).cast("long"),
        n_lines=F.size("__lines").cast("long"),
        n_dup_lines=(F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
    )
    # Sorted by hash with the place in the low bits, equal windows are neighbours. A place takes as
    # many bits as the document needs, so this finds the places of all repeats and maybe a few more.
    low = F.col("__low")
    by_hash = _settled(
        hashed,
        __sorted=F.sort_array(
            F.transform("__windows", lambda h, i: h.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("long")))
        ),
    )
    s = F.col("__sorted")

    def near(x: Column, i: Column) -> Column:
        return _same(x, F.get(s, i - 1), low) | _same(x, F.get(s, i + 1), low)

    maybe = _settled(
        by_hash,
        __pairs=F.array_sort(
            F.transform(
                F.filter(s, near),
                lambda x: F.struct(
                    F.get("__windows", x.bitwiseAND(low).cast("int")).alias("h"), x.bitwiseAND(low).alias("at")
                ),
            )
        ),
    )
    p = F.col("__pairs")
    # The whole hashes settle it.
    sure = _settled(
        maybe,
        __places=F.sort_array(
            F.transform(
                F.filter(p, lambda x, i: (x["h"] == F.get(p, i - 1)["h"]) | (x["h"] == F.get(p, i + 1)["h"])),
                lambda x: x["at"],
            )
        ),
    )
    places = F.col("__places")
    # A window covers three words, or those up to the next repeated window.
    covered = F.transform(places, lambda at, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - at, F.lit(3))))
    repeated = F.aggregate(covered, F.lit(0).cast("long"), lambda n, c: n + c)
    return sure.withColumn("n_repeat_words", repeated).select(
        *df.columns, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"
    )


def _same(a: Column, b: Column, low: Column) -> Column:
    """Do two values agree above the bits of ``low``?"""
    return a.bitwiseXOR(b).bitwiseAND(F.bitwise_not(low)) == 0


MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def ledger(df: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per row: key, the measurements, and ``failed``, the mask of the rules it fails.

    Null and empty texts have no words. Repeated rows and null keys are rows of their own; an empty table
    gives an empty ledger. Other columns of ``df`` are ignored.
    """
    rows = measured(df.select(F.col(key), F.col(text).cast("string").alias("text")), "text").drop("text")
    bits = [
        F.when(F.expr(rule.fails), F.lit(1 << place).cast("long")).otherwise(F.lit(0).cast("long"))
        for place, rule in enumerate(rules)
    ]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return rows.withColumn("failed", failed)


def fails(policy: str) -> Column:
    """Does a row of the ledger fail any rule of the policy?"""
    return F.col("failed").bitwiseAND(F.lit(mask(POLICIES[policy]))) != 0


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: rows that fail it, that fail nothing else of the policy (and would be kept
    without it), and rows kept. Reads one row per distinct mask."""
    whole = mask(POLICIES[policy])
    masks = rows.groupBy(F.col("failed").bitwiseAND(F.lit(whole)).alias("failed")).agg(F.count("*").alias("n"))
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(mask((r,))).alias("bit")) for r in POLICIES[policy]]))
    bit = F.col("r.bit")
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return (
        masks.select("*", each.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            count(F.col("failed").bitwiseAND(bit) != 0).alias("n_failed"),
            count(F.col("failed") == bit).alias("n_failed_only"),
            count(F.col("failed") == 0).alias("n_kept"),
        )
    )


def op9_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failed rules and the verdict of the production policy for every document."""
    return ledger(documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "failed",
        (F.col("failed").bitwiseAND(F.lit(mask(BASE_RULES))) != 0).alias("base_failed"),
        (~fails(PRODUCTION)).alias("kept"),
    )
