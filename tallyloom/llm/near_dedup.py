"""Near-duplicate documents by b-bit MinHash.

1. Each text becomes its set of word shingles (64-bit hashes) and ``BANDS`` x ``ROWS`` MinHash minima. Texts
   with equal sets are one class from here on, whose smallest id stands for it.
2. Candidates share all minima of a band. Two sets of similarity s share one with probability
   1 - (1 - s^ROWS)^BANDS: at 0.8 all but 5 in 100 million pairs do.
3. Of the minima only the low ``BITS`` bits are kept, as bit planes packed into longs. Equal low bits are
   counted with "xor" and bit counts; two unequal minima agree in ``BITS`` bits by chance once in
   2^BITS, for which the estimate is corrected. Pairs whose estimate lies ``MARGIN`` below the threshold
   (over six standard errors) are dropped.
4. The other pairs are confirmed on the full sets, and confirmed links joined to components.

No step emits the pairs of a family. Each member of a band bucket is paired with the smallest of its bucket only;
members and leaders with a plausible estimate form families. The sets of a family are compared where they lie
together: in one piece for small families, and for large ones in pieces of two blocks of about ``BLOCK``
members, first each block with itself and one other, then what is not one component yet. A piece
returns the links of a spanning forest. Pairs of a bucket that are in different families (the two are
not both like the bucket's smallest member) and have a plausible estimate are confirmed one by one.
To find these, each member of such a bucket meets all others: the rows grow with the square of the bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import as_bytes, documents, mix64, saved, slices, word_hashes
from tallyloom.llm.components import components

BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
BITS = 4
MARGIN = 0.25
#: Members of a family or bucket that are compared in one piece of work.
BLOCK = 256
#: Members of small families that share a piece.
POOLED = 500

_random = np.random.default_rng(20240229)
FACTORS = _random.integers(0, 1 << 31, HASHES, np.uint32) * np.uint32(2) + np.uint32(1)
OFFSETS = _random.integers(0, 1 << 32, HASHES, np.uint32)


def shingles(words: list[bytes], n: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``n`` words; a shorter text is one shingle, an empty one none."""
    if not words:
        return np.zeros(0, np.uint64)
    hashes = word_hashes(words, len(words))
    n = min(n, len(hashes))
    out = np.full(len(hashes) - n + 1, n, np.uint64)
    for k in range(n):
        out = mix64(out + hashes[k : len(hashes) - n + 1 + k])
    return np.unique(out)


def minima(found: np.ndarray) -> np.ndarray:
    """The MinHash minima of a set, one for each of ``HASHES`` permutations of 32-bit values."""
    low = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for a in range(0, len(low), 1024):
        np.minimum(out, (low[a : a + 1024, None] * FACTORS + OFFSETS).min(axis=0), out=out)
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, other for each band."""
    rows = values.reshape(BANDS, ROWS).astype(np.uint64)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        out = mix64(out + rows[:, k])
    return out


def signature(values: np.ndarray) -> np.ndarray:
    """The low bits of the minima as planes: bit j of all minima, 64 to a long, then bit j + 1."""
    mixed = mix64(values.astype(np.uint64))  # minima are small numbers; their low bits are spread first
    planes = [np.packbits(((mixed >> np.uint64(j)) & np.uint64(1)).astype(np.uint8)).view(np.int64) for j in range(BITS)]
    return np.concatenate(planes)


def described(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """Per row: id, n_shingles, set_key (of the set; null if empty), bands, sig."""
    given = df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, keys, bands, sigs = [], [], [], []
            for value in as_bytes(batch["text"]):
                found = shingles(value.lower().split() if value else [], n)
                sizes.append(len(found))
                keys.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                low = minima(found)
                bands.append(band_keys(low).view(np.int64) if len(found) else None)
                sigs.append(signature(low) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sigs, pa.list_(pa.int64())),
                ],
                names=["id", "n_shingles", "set_key", "bands", "sig"],
            )

    return given.mapInArrow(
        run, "id long, n_shingles long, set_key binary, bands array<long>, sig array<long>"
    )


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two signatures, corrected for minima whose low bits agree by chance."""
    unequal = F.lit(0)
    for word in range(HASHES // 64):
        differ = F.lit(0).cast("long")
        for j in range(BITS):
            at = j * (HASHES // 64) + word
            differ = differ.bitwiseOR(F.get(a, F.lit(at)).bitwiseXOR(F.get(b, F.lit(at))))
        unequal = unequal + F.bit_count(differ)
    equal = 1 - unequal / float(HASHES)
    chance = 2.0**-BITS
    return (equal - chance) / (1 - chance)


def plausible(a: str, b: str, threshold: float) -> Column:
    """May two described rows, given by prefix, reach the threshold? By set sizes and by estimate."""
    x, y = F.col(f"{a}n"), F.col(f"{b}n")
    sizes = F.least(x, y) >= threshold * F.greatest(x, y) - 1e-9
    return sizes & (estimate(F.col(f"{a}sig"), F.col(f"{b}sig")) >= threshold - MARGIN)


def intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The sizes of the intersections of the sets numbered ``left`` with those numbered ``right``."""
    if len(left) * len(right) <= 4:
        return np.array([[len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for b in right] for a in left])
    used = np.unique(np.concatenate([left, right]))
    flat = np.concatenate([sets[i] for i in used])
    owner = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used])
    _, back, many = np.unique(flat, return_inverse=True, return_counts=True)
    # A shingle of one set is in no intersection.
    column = np.cumsum(many > 1) - 1
    shared = many[back] > 1
    owner, column = owner[shared], column[back[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    rows, cols = np.searchsorted(used, left), np.searchsorted(used, right)
    out = np.zeros((len(left), len(right)), np.float32)  # counts stay exact up to 2**24
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        block = np.zeros((len(used), 4096), np.float32)
        block[owner[a:b], column[a:b] - start] = 1
        out += block[rows] @ block[cols].T
    return out.astype(np.int64)


def forest(
    ids: list[int], sets: list[np.ndarray], sides: np.ndarray, groups: list[int], percent: int
) -> list[tuple[int, int]]:
    """Links that join all members joined by similar pairs, none inside what is one already by ``groups``.

    With two sides, only pairs between them are compared.
    """
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    one, two = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
    if not len(two):
        two = one
    sizes = np.array([len(s) for s in sets])
    common = intersections(sets, one, two)
    union = sizes[one][:, None] + sizes[two][None] - common
    links = []
    for i, j in zip(*np.nonzero((100 * common >= percent * union) & (common > 0)), strict=True):
        a, b = one[i], two[j]
        x, y = root(groups[a]), root(groups[b])
        if x != y and ids[a] != ids[b]:
            parent[max(x, y)] = min(x, y)
            links.append((min(ids[a], ids[b]), max(ids[a], ids[b])))
    return links


def linked(members: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (a, b) inside families, from rows (piece, family, i, j, side, id, grouped).

    A piece holds one or more comparisons (family, i, j); ``grouped`` is the component a member is known to
    be in. Pieces are bounded, so their rows may meet in one task.
    """

    def run(table: pa.Table) -> pa.Table:
        keys = list(zip(*(table[c].to_pylist() for c in ("family", "i", "j")), strict=True))
        ids, groups = table["id"].to_pylist(), table["grouped"].to_pylist()
        sides = np.asarray(table["side"])
        content = as_bytes(table["text"].combine_chunks())
        of: dict[tuple, list[int]] = {}
        for row, key in enumerate(keys):
            of.setdefault(key, []).append(row)
        links = []
        for rows in of.values():
            sets = [shingles(content[r].lower().split(), n) for r in rows]
            links += forest([ids[r] for r in rows], sets, sides[rows], [groups[r] for r in rows], percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return members.join(texts, "id").groupBy("piece").applyInArrow(run, "a long, b long")


def dealt(members: DataFrame) -> DataFrame:
    """Deal the members of each family (family, id, grouped) to blocks: adds ``block`` and ``pure``.

    Members that are one component already (``grouped``) fill blocks of their own if there are enough of them;
    the others share blocks. ``pure`` is that component, or null.
    """
    by_group = members.groupBy("family", "grouped").agg(F.count("*").alias("m"))
    by_group = by_group.withColumn("own", F.when(F.col("m") >= BLOCK, F.ceil(F.col("m") / BLOCK)).otherwise(0).cast("int"))
    rest = by_group.groupBy("family").agg(F.sum(F.when(F.col("own") == 0, F.col("m")).otherwise(0)).alias("rest"))
    sized = by_group.join(rest, "family").withColumn("pools", F.greatest(F.lit(1), F.ceil(F.col("rest") / BLOCK)).cast("int"))
    joined = members.join(sized.select("family", "grouped", "own", "pools"), ["family", "grouped"])
    spread = F.xxhash64("id")
    pure = F.when(F.col("own") > 0, F.col("grouped"))
    number = F.when(F.col("own") > 0, F.pmod(spread, F.col("own"))).otherwise(F.pmod(spread, F.col("pools")))
    return joined.withColumn("pure", pure).withColumn("number", number.cast("int")).withColumn(
        "block", F.xxhash64("family", "pure", "number")
    )


def compared(members: DataFrame, pools: int, first: bool) -> DataFrame:
    """Rows for ``linked``: comparisons of two blocks of a family.

    In the first round each block meets itself and the first block of the family, which joins most of a large
    family; in the second all blocks meet but those of one and the same component.
    """
    blocks = dealt(members)
    each = blocks.groupBy("family", "block").agg(F.first("pure").alias("pure"), F.count("*").alias("m"))
    many = each.groupBy("family").agg(F.count("*").alias("blocks"))
    # Small families: many of them make one of ``pools`` pieces.
    small = blocks.join(many.filter("blocks = 1"), "family")
    pool = F.pmod(F.xxhash64("family"), F.lit(pools))
    a = each.join(many.filter("blocks > 1"), "family").select("family", F.col("block").alias("i"), F.col("pure").alias("x"), "blocks")
    b = each.select(F.col("family").alias("of"), F.col("block").alias("j"), F.col("pure").alias("y"))
    if first:
        lead = each.groupBy("family").agg(F.min("block").alias("lead"))
        a = a.join(lead, "family").filter("blocks > 1")
        meets = [a.select("family", F.least("i", "lead").alias("i"), F.greatest("i", "lead").alias("j")), a.select("family", "i", F.col("i").alias("j"))]
        pairs = meets[0].unionByName(meets[1]).distinct()
    else:
        meet = (F.col("family") == F.col("of")) & (F.col("i") <= F.col("j"))
        pairs = a.join(b, meet).filter(~F.coalesce(F.col("x") == F.col("y"), F.lit(False))).select("family", "i", "j")
    rows = blocks.select("family", "block", "id", "grouped")
    sides = [
        rows.withColumnRenamed("block", name).join(pairs.filter(only), ["family", name]).withColumn("side", F.lit(side))
        for side, name, only in ((0, "i", F.lit(True)), (1, "j", F.col("i") < F.col("j")))
    ]
    columns = ["piece", "family", "i", "j", "side", "id", "grouped"]
    large = [x.withColumn("piece", F.xxhash64("family", "i", "j")).select(*columns) for x in sides]
    zero = F.lit(0).cast("long")
    pooled = small.withColumns({"piece": pool, "i": zero, "j": zero, "side": F.lit(0)}).select(*columns)
    return pooled.unionByName(large[0]).unionByName(large[1])


def texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The distinct rows (id, text) of ``texts`` whose id is in ``ids`` (id, distinct): a shuffle by id at every size."""
    return texts.join(ids.hint("merge"), "id", "left_semi").distinct()


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", n: int = 2, percent: int = 80
) -> DataFrame:
    """Per row: key, n_shingles, component_id (smallest key reachable by links, itself included), kept.

    Rows are linked if their sets of word shingles (A-Z lower-cased, ``n`` words; a shorter text is one
    shingle) have a similarity of ``percent`` or more. Null and empty texts have the empty set and no
    links. Rows with the same key are one node. A row without a key has no links: its component_id is
    null and it is kept. An empty table gives an empty result. Other columns of ``df`` are ignored.
    """
    threshold = percent / 100
    rows = saved(described(df, key, text, n), "described")
    filled = rows.filter(F.col("set_key").isNotNull() & F.col("id").isNotNull())
    # Classes of equal sets. Aggregated before the shuffle, so a large class is one row per task.
    classes = saved(
        filled.groupBy("set_key").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes"
    )
    few = classes.withColumnRenamed("rep", "id")
    reps = saved(
        filled.join(few, ["set_key", "id"], "left_semi")
        .dropDuplicates(["set_key", "id"])
        .select("id", F.col("n_shingles").alias("n"), "bands", "sig"),
        "representatives",
    )
    about = reps.select("id", "n", "sig")
    buckets = reps.select("id", F.explode("bands").alias("band"))
    led = buckets.groupBy("band").agg(F.min("id").alias("lead"), F.max("id").alias("last")).filter("lead < last")
    shared = saved(buckets.join(led.select("band", "lead"), "band"), "buckets")

    def described_as(side: str) -> DataFrame:
        return about.select(F.col("id").alias(side), F.col("n").alias(f"{side}_n"), F.col("sig").alias(f"{side}_sig"))

    stars = shared.filter("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()
    likely = stars.join(described_as("b"), "b").join(described_as("a"), "a").filter(plausible("a_", "b_", threshold))
    families = saved(
        components(likely.select("a", "b")).select("id", F.col("component").alias("family")), "families"
    )

    # Pairs of a bucket whose members are in different families, and plausible.
    tagged = shared.select("id", "band").join(families, "id", "left")
    tagged = tagged.withColumn("family", F.coalesce("family", "id"))
    open_ = tagged.groupBy("band").agg(
        F.min("family").alias("x"), F.max("family").alias("y"), F.count("*").alias("members")
    )
    rest = tagged.join(open_.filter("x < y").select("band", "members"), "band").join(about, "id")
    rest = saved(rest.withColumn("pieces", F.ceil(F.col("members") / BLOCK).cast("int")), "open_buckets")
    left = rest.select(
        "band", "family", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int").alias("piece"),
        F.col("id").alias("a"), F.col("n").alias("a_n"), F.col("sig").alias("a_sig"),
    )
    # Each member of a large bucket meets all pieces of it, one piece at a time.
    right = rest.select(
        "band", F.col("family").alias("other"),
        F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"),
        F.col("id").alias("b"), F.col("n").alias("b_n"), F.col("sig").alias("b_sig"),
    )
    across = left.join(right, ["band", "piece"]).filter((F.col("family") < F.col("other")) & plausible("a_", "b_", threshold))
    across = saved(across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cross_pairs")

    # Texts of all that is to be compared, once.
    ids = families.select("id").unionByName(across.select(F.explode(F.array("a", "b")).alias("id"))).distinct()
    texts = df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    ids = saved(ids, "compared_ids")
    texts = saved(texts_of(texts.filter(F.col("text").isNotNull()), ids), "texts")
    alone = across.select(
        F.xxhash64("a", "b").alias("family"), F.explode(F.array("a", "b")).alias("id")
    ).withColumn("grouped", F.col("id"))
    zero = F.lit(0).cast("long")
    crossing = alone.withColumns(
        {"piece": -1 - F.pmod(F.col("family"), F.lit(1 + 2 * across.count() // POOLED)), "i": zero, "j": zero, "side": F.lit(0)}
    ).select("piece", "family", "i", "j", "side", "id", "grouped")
    pools = 1 + families.count() // POOLED
    inside = compared(families.withColumn("grouped", F.col("id")), pools, first=True)
    links = linked(inside.unionByName(crossing), texts, n, percent)
    # Rows with the same key are one node: their classes are linked.
    several = filled.groupBy("id").agg(F.min("set_key").alias("x"), F.max("set_key").alias("y")).filter("x < y")
    same = filled.join(several, "id", "left_semi").join(classes, "set_key").filter("id <> rep")
    links = saved(links.unionByName(same.select(F.col("rep").alias("a"), F.col("id").alias("b"))).distinct(), "links")
    labels = saved(components(links), "components")

    # Large families that are not one component yet.
    parts = families.join(labels, "id", "left").select("id", "family", F.coalesce("component", "id").alias("grouped"))
    torn = parts.groupBy("family").agg(
        F.count("*").alias("m"), F.min("grouped").alias("x"), F.max("grouped").alias("y")
    )
    torn = parts.join(torn.filter((F.col("m") > BLOCK) & (F.col("x") < F.col("y"))).select("family"), "family", "left_semi")
    torn = saved(torn, "torn_families")
    if torn.take(1):
        more = saved(linked(compared(torn, pools, first=False), texts, n, percent), "more_links")
        labels = saved(components(links.unionByName(more)), "components")

    # A class takes the component of its smallest id. Large classes are split by AQE.
    classes = classes.join(labels, F.col("rep") == F.col("id"), "left").select(
        "set_key", F.coalesce("component", "rep").alias("component")
    )
    out = rows.select("id", "n_shingles", "set_key").join(classes, "set_key", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(
        F.col("id").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate group of every document."""
    return near_duplicates(documents(spark, sf_dir))
