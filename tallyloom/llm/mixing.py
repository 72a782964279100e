"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target number of words (``targets``). A target of r times the source's words gives
every document floor(r) certain copies; the rest is a sample without replacement. There, document i has
the inclusion probability p_i (growing with the square root of its size, so that the sample is not
made of short documents), draws u_i uniformly, and ranks by the odds u/(1-u) divided by p/(1-p). The
first documents in this order are taken, up to the number of words that is left of the target.

u depends on the document's key only, so reruns agree. Where the cut falls is found on histograms
of the rank: a source is never sorted as a whole, whatever share of all rows it holds. Of the
``EDGE`` documents behind the cut, those that still fit are taken in order, to come near the target.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import documents, n_words, saved, unit_hash

#: Weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
#: Bins of one histogram of ranks; a cut is found in two rounds.
BINS = 1024
#: Documents behind the cut that may fill up the target.
EDGE = 256
#: Tables with one row per source are broadcast up to this many rows, and shuffled above.
FEW_SOURCES = 2000


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST_COPIES) -> DataFrame:
    """From (source, source_size): the words that each source gives to the mix.

    Sources in the order of their code points, null last, have the weights in turn. They share
    ``share`` times all words by weight, but none gives more than ``most`` times its own; what is over
    goes to the others by weight, until none is above. One row per source is ordered in one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    extra = [c for c in sources.columns if c not in ("source", "source_size")]
    table = saved(
        sources.withColumn("nth", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * F.lit(float(most))),
        "mix_sources",
    )
    total = table.agg(F.sum("source_size")).first()[0] or 0
    # The level: target = least(most, weight x level). Sources reach their limit in the order of most / weight,
    # so each round settles some of them and there are no more rounds than sources.
    level, limit = 0.0, -1.0
    while True:
        full = F.col("most") <= F.lit(limit) * F.col("weight")
        fixed, free = table.agg(
            F.coalesce(F.sum(F.when(full, F.col("most"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if not free:
            break
        level = (share * total - fixed) / free
        if level <= limit or not table.filter(~full & (F.col("most") <= F.lit(level) * F.col("weight"))).take(1):
            break
        limit = level
    target = F.least("most", F.lit(level) * F.col("weight")) if free else F.col("most")
    return table.select("source", "source_size", target.alias("target"), *extra)


def _with_source(rows: DataFrame, name: str, table: DataFrame, how: str = "inner", other: str = "source") -> DataFrame:
    """Join a table with one row per source, broadcast if it has at most ``FEW_SOURCES`` rows."""
    if name == other:
        table, other = table.withColumnRenamed(other, "__of"), "__of"
    if table.count() <= FEW_SOURCES:
        table = F.broadcast(table)
    joined = rows.join(table, rows[name].eqNullSafe(table[other]), how)
    return joined.drop("__of")


def _rank(key: str, seed: str, scale: str = "scale") -> Column:
    """Odds of a uniform draw over odds of inclusion, as a value between 0 and 1."""
    u = unit_hash(F.col(key).cast("long"), F.lit(seed))
    p = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), F.col(scale) * F.sqrt("size")))
    odds = u / (1 - u) / (p / (1 - p))
    return odds / (1 + odds)


def _cuts(ranked: DataFrame, goals: DataFrame, rounds: int = 2) -> DataFrame:
    """(source, low, left): documents ranked below ``low`` are all taken, and ``left`` words more.

    A source without a row is taken whole. Each round counts words per bin of the rank and goes on
    in the bin where the goal is passed.
    """
    cuts = goals.select("source", F.lit(0.0).alias("low"), F.lit(1.0).alias("width"), F.col("goal").alias("left"))
    for _ in range(rounds):
        step = F.col("width") / BINS
        nth = F.floor((F.col("rank") - F.col("low")) / step)
        inside = _with_source(ranked, "source", cuts).filter((F.col("rank") >= F.col("low")) & (nth < BINS))
        bins = inside.groupBy("source", "low", "width", "left", nth.alias("bin")).agg(F.sum("size").alias("size"))
        ends = bins.withColumn("upto", F.sum("size").over(Window.partitionBy("source").orderBy("bin")))
        passed = ends.filter(F.col("upto") > F.col("left")).groupBy("source")
        found = passed.agg(F.min(F.struct("bin", "low", "width", "left", "upto", "size")).alias("b"))
        cuts = saved(
            found.select(
                "source",
                (F.col("b.low") + F.col("b.bin") * F.col("b.width") / BINS).alias("low"),
                (F.col("b.width") / BINS).alias("width"),
                (F.col("b.left") - F.col("b.upto") + F.col("b.size")).alias("left"),
            ),
            "mix_cuts",
        )
    return cuts.select("source", "low", "left")


def choose(rows: pd.DataFrame) -> pd.DataFrame:
    """Of the first documents behind the cut, those that fit into what is left, in order of rank; then
    one more if it brings the sum nearer."""
    left, taken, others = int(round(rows["left"].iloc[0])), [], []
    for row in rows.sort_values(["rank", "key", "size"], na_position="first").itertuples():
        one = {"rank": row.rank, "key": None if pd.isna(row.key) else int(row.key), "size": row.size_}
        (taken if row.size_ <= left else others).append(one)
        left -= row.size_ if row.size_ <= left else 0
    taken += [one for one in sorted(others, key=lambda x: abs(left - x["size"]))[:1] if abs(left - one["size"]) < left]
    return pd.DataFrame({"source": [rows["source"].iloc[0]], "chosen": [taken]})


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix") -> DataFrame:
    """``df`` with size, source_size, target (of its source) and copies (how often the mix takes the row).

    These replace columns of ``df`` with the same names. Size is the number of words, 0 for a null text. Null
    is a source of its own. Rows without words have the certain copies of their source and no more. A row without a key goes by
    its text. Rows that agree in key, source and size, or without a key in source and text, have the same rank and
    are taken alike. An empty table gives an empty result.
    """
    added = ("size", "source_size", "target", "copies")
    sized = df.select(*[c for c in df.columns if c not in added]).withColumn("size", n_words(F.col(text)))
    # Without a key a row goes by its text, so that rows of equal size have ranks of their own.
    sized = sized.withColumn("__key", F.coalesce(F.col(key).cast("long"), F.xxhash64(text)))
    sizes = saved(sized.select(F.col("__key").alias("key"), F.col(source).alias("source"), "size"), "mix_sizes")
    sources = saved(
        sizes.groupBy("source").agg(
            F.sum("size").alias("source_size"), F.sum(F.sqrt("size") * F.col("size")).alias("root")
        ),
        "mix_totals",
    )
    goals = targets(sources).withColumn("sure", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)))
    goals = goals.withColumn("goal", F.col("target") - F.col("sure") * F.col("source_size"))
    goals = saved(goals.withColumn("scale", F.try_divide("goal", "root")), "mix_goals")
    ranked = _with_source(sizes.filter("size > 0"), "source", goals.filter("goal > 0"))
    ranked = saved(ranked.select("source", "key", "size", _rank("key", seed).alias("rank")), "mix_ranks")

    cuts = _cuts(ranked, goals.filter("goal > 0"))
    behind = _with_source(ranked, "source", cuts).filter("rank >= low")
    first = Window.partitionBy("source").orderBy("rank", "key", "size")
    near = behind.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= EDGE)
    chosen = (
        near.select("source", "key", F.col("size").alias("size_"), "size", "rank", "left")
        .withColumn("group", F.struct("source"))
        .groupBy("group")
        .applyInPandas(choose, "source string, chosen array<struct<rank:double,key:long,size:long>>")
    )
    plan = _with_source(goals.withColumnRenamed("source", "name"), "name", cuts, "left")
    plan = _with_source(plan.drop("source"), "name", chosen, "left").drop("source")
    plan = saved(plan.select(F.col("name").alias("source"), "source_size", "target", "sure", "goal", "scale", "low", "chosen"), "mix_plan")

    rows = _with_source(sized, source, plan.select([F.col(c).alias(f"__{c}") for c in plan.columns]), "left", "__source")
    rank = _rank("__key", seed, "__scale")
    own = F.struct(rank.alias("rank"), F.col("__key").alias("key"), F.col("size"))
    taken = F.col("__low").isNull() | (rank < F.col("__low")) | F.coalesce(F.array_contains("__chosen", own), F.lit(False))
    more = (F.col("__goal") > 0) & (F.col("size") > 0) & taken
    return rows.select(
        *[c for c in sized.columns if c != "__key"],
        F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"),
        (F.col("__sure") + F.when(more, 1).otherwise(0)).cast("long").alias("copies"),
    )


def mixed(df: DataFrame, **names: str) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken, with the columns of ``df``."""
    rows = mix(df, **names).filter("copies > 0")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*df.columns)


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    rows = mix(documents(spark, sf_dir))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
