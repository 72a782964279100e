"""Tables that grow load by load, and the merge of their loads.

``path/load_id=K`` holds the rows of load K; a repeated load replaces its folder. ``path.base/up_to=L`` holds
the merged rows of all loads up to L. A folder counts once the marker is in it that Spark writes last, so a load or a
merge that was interrupted is never read: the newest complete base and the complete loads behind it are the table.
Only folder names come to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPLETE = "_SUCCESS"


def filesystem(spark: SparkSession, path: str):
    """The folder as Hadoop names it, and its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def numbered(spark: SparkSession, path: str, name: str) -> dict[int, bool]:
    """The numbers N of the folders ``name=N`` below ``path``, and which of them are complete."""
    where, fs = filesystem(spark, path)
    if not fs.exists(where):
        return {}
    found = [s.getPath() for s in fs.listStatus(where) if s.getPath().getName().startswith(f"{name}=")]
    child = spark._jvm.org.apache.hadoop.fs.Path
    return {int(p.getName().split("=", 1)[1]): fs.exists(child(p, COMPLETE)) for p in found}


def put(df: DataFrame, path: str, load_id: int, *by: str) -> None:
    """Write the rows of one load, in folders by the columns ``by``; a repeated load replaces them."""
    _write(df.hint("rebalance", *by) if by else df, f"{path}/load_id={load_id}", by)


def _write(df: DataFrame, path: str, by: tuple[str, ...]) -> None:
    """Replace a folder. Only a static overwrite puts the marker into it."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)


def base_of(spark: SparkSession, path: str) -> int | None:
    """The last load in the newest complete base."""
    return max((n for n, whole in numbered(spark, f"{path}.base", "up_to").items() if whole), default=None)


def read(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """The rows of all loads, or of those before one. A base holds no load that may still be repeated."""
    base = base_of(spark, path)
    loads = [
        n for n, whole in numbered(spark, path, "load_id").items()
        if whole and (base is None or n > base) and (before is None or n < before)
    ]
    return _read(spark, path, schema, base, loads)


def _read(spark: SparkSession, path: str, schema: T.StructType, base: int | None, loads: list[int]) -> DataFrame:
    parts = []
    if base is not None:
        parts.append(spark.read.schema(schema).parquet(f"{path}.base/up_to={base}"))
    if loads:
        folders = [f"{path}/load_id={n}" for n in sorted(loads)]
        parts.append(spark.read.schema(schema).option("basePath", path).parquet(*folders))
    names = schema.fieldNames()
    rows = [p.select(*names) for p in parts] or [spark.createDataFrame([], schema)]
    return rows[0].unionByName(rows[1]) if len(rows) > 1 else rows[0]


def compact(
    spark: SparkSession, path: str, schema: T.StructType, merge: Callable[[DataFrame], DataFrame], *by: str
) -> int | None:
    """Merge the base and all complete loads but the newest, which may be repeated, into a new base.

    Readers go on with what they have; the new base counts from the moment it is complete. Returns its last load, None if
    there was nothing to merge. ``clean`` removes what it replaces.
    """
    base = base_of(spark, path)
    loads = sorted(n for n, whole in numbered(spark, path, "load_id").items() if whole and (base is None or n > base))[:-1]
    if not loads:
        return None
    rows = merge(_read(spark, path, schema, base, loads)).select(*schema.fieldNames())
    _write(rows.hint("rebalance", *by), f"{path}.base/up_to={loads[-1]}", by)
    return loads[-1]


def clean(spark: SparkSession, path: str) -> int:
    """Delete loads and bases that the newest complete base replaces; how many folders went.

    For when no reader is left that began before the merge.
    """
    base = base_of(spark, path)
    if base is None:
        return 0
    gone = [f"{path}/load_id={n}" for n in numbered(spark, path, "load_id") if n <= base]
    gone += [f"{path}.base/up_to={n}" for n in numbered(spark, f"{path}.base", "up_to") if n < base]
    for folder in gone:
        where, fs = filesystem(spark, folder)
        fs.delete(where, True)
    return len(gone)


def drop(spark: SparkSession, path: str, before: int) -> None:
    """Delete the loads before one, where only the newest states matter."""
    for n in numbered(spark, path, "load_id"):
        if n < before:
            where, fs = filesystem(spark, f"{path}/load_id={n}")
            fs.delete(where, True)


def count_files(spark: SparkSession, path: str) -> int:
    """The data files of the table as it is read now."""
    where, fs = filesystem(spark, path)
    found = 0
    for root in (path, f"{path}.base"):
        where, _ = filesystem(spark, root)
        if fs.exists(where):
            files = fs.listFiles(where, True)
            while files.hasNext():
                found += files.next().getPath().getName().endswith(".parquet")
    return found


def point(spark: SparkSession, path: str, value: str) -> None:
    """Make ``value`` the newest of the pointers below ``path``: a new numbered file, moved into place in one step.

    Whatever happens before the move, the pointer before it stays the newest.
    """
    where, fs = filesystem(spark, path)
    fs.mkdirs(where)
    numbers = [int(s.getPath().getName()) for s in fs.listStatus(where) if s.getPath().getName().isdigit()]
    child = spark._jvm.org.apache.hadoop.fs.Path
    number = max(numbers, default=-1) + 1
    aside = child(where, f".{number:012d}.tmp")
    out = fs.create(aside, True)
    out.write(bytearray(value.encode()))
    out.close()
    if not fs.rename(aside, child(where, f"{number:012d}")):
        raise RuntimeError(f"pointer {number} of {path} was taken meanwhile")


def pointed(spark: SparkSession, path: str) -> str:
    """The value of the newest pointer."""
    where, fs = filesystem(spark, path)
    numbers = [s.getPath().getName() for s in fs.listStatus(where) if s.getPath().getName().isdigit()]
    return spark.read.text(f"{path}/{max(numbers)}", wholetext=True).first()["value"]
