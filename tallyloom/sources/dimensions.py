"""Small tables joined to events: policies, address ranges, experiments; user-agent rules.

No join here asks for a broadcast: Spark broadcasts a side it knows to be below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise, so a dimension that has
grown stays correct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.network import address_key
from tallyloom.schema import EXPERIMENT_CONFIG

# User-agent rules as (pattern, name), first match wins.
AGENT_RULES = [
    (r"(?i)bot|crawler|spider", "Robot"),
    (r"Edg(e|A|iOS)?/", "Edge"),
    (r"OPR/|Opera", "Opera"),
    (r"SamsungBrowser/", "Samsung Browser"),
    (r"Firefox/|FxiOS/", "Firefox"),
    (r"Chrome/|CriOS/", "Chrome"),
    (r"Version/.*Safari/", "Safari"),
    (r"UnityPlayer/", "UnityPlayer"),
    (r"okhttp/", "okhttp"),
]
OS_RULES = [
    (r"Windows NT", "Windows NT"),
    (r"Android", "Android"),
    (r"iPhone|iPad|iPod|CPU OS", "iOS"),
    (r"Mac OS X", "Mac OS X"),
    (r"CrOS", "Chrome OS"),
    (r"Linux", "Linux"),
]
DEVICE_RULES = [
    (r"(?i)bot|crawler|spider", "Robot"),
    (r"(?i)smart-?tv|appletv|googletv", "TV"),
    (r"iPad|Tablet", "Tablet"),
    (r"iPhone|iPod|Mobile", "Phone"),
    (r"Android", "Tablet"),
    (r"Windows NT|Mac OS X|Linux|CrOS", "Desktop"),
]
UNKNOWN = "Unknown"


def match_rules(text: Column, rules: list[tuple[str, str]]) -> Column:
    """The name of the first rule that matches; NULL for an empty text."""
    result = F.when(text.isNull() | (text == ""), F.lit(None).cast("string"))
    for pattern, name in rules:
        result = result.when(text.rlike(pattern), F.lit(name))
    return result.otherwise(F.lit(UNKNOWN))


def keyed_ranges(ranges: DataFrame) -> DataFrame:
    """``(start_ip, end_ip, country)`` as ``(low, high, geo)``, in keys that sort by family and address (see
    ``range_key``). Ranges with bad, mixed or swapped ends are left out."""
    keyed = ranges.select(
        range_key(F.col("start_ip")).alias("low"), range_key(F.col("end_ip")).alias("high"), F.col("country").alias("geo")
    )
    return keyed.filter((F.length("low") == F.length("high")) & (F.col("low") <= F.col("high")))


def range_key(ip: Column) -> Column:
    """The digits of an address behind 4 or 6 for its family; NULL for anything else."""
    return F.regexp_replace(F.regexp_replace(address_key(ip), "^(?=.{8}$)", "4"), "^(?=.{32}$)", "6")


def steps(rows: list[tuple[str, str, str | None]]) -> list[tuple[str, str | None]]:
    """Ranges as a staircase: each (key, value) holds from its key to before the next. The value is that of
    the range which begins last and, of these, ends first; None where no range is."""
    ordered = sorted(rows, key=lambda r: (r[0], -int(r[1], 16), r[2] is not None, r[2] or ""))
    behind = [f"{int(high, 16) + 1:x}" for _, high, _ in rows if set(high[1:]) != {"f"}]
    out: list[tuple[str, str | None]] = []
    held: list[tuple[str, str | None]] = []
    at = 0
    for key in sorted({*behind, "5", *(low for low, _, _ in rows)}):
        while at < len(ordered) and ordered[at][0] <= key:
            held.append(ordered[at][1:])
            at += 1
        # A "5" stands between the families; of ranges that begin earlier, those that have ended never count again.
        while held and held[-1][0] < key:
            held.pop()
        value = held[-1][1] if held else None
        if not out or out[-1][1] != value:
            out.append((key, value))
    return out


def place(bounds: Column, n: int, key: Column) -> Column:
    """How many of the ``n`` sorted ``bounds`` are not above ``key``, by halving."""
    halves = F.lit([1 << i for i in range(max(1, n).bit_length() - 1, -1, -1)])
    return F.aggregate(
        halves, F.lit(0), lambda at, half: F.when(F.get(bounds, at + half - 1) <= key, at + half).otherwise(at)
    )


def text_array(values: list[str]) -> Column:
    """A constant array of texts without control characters."""
    return F.split(F.lit("\x1f".join(values)), "\x1f") if values else F.lit([]).cast("array<string>")


def running_experiments(experiments: DataFrame, project: str | None = None) -> DataFrame:
    """Running experiments as ``project_id, id, salt, name, config`` with a parsed config."""
    df = experiments.filter(F.col("status") == "running")
    if project is not None:
        df = df.filter(F.col("project_id") == project)
    return df.select(
        "project_id",
        "id",
        F.coalesce("salt", F.lit("")).alias("salt"),
        "name",
        F.from_json(F.coalesce("config_json", F.lit("{}")), EXPERIMENT_CONFIG).alias("config"),
    )


def list_experiments(
    experiments: DataFrame, project: str, status: str | None = None
) -> DataFrame:
    """Experiments of a project, newest change first."""
    df = experiments.filter(F.col("project_id") == project)
    if status:
        df = df.filter(F.col("status") == status)
    return df.orderBy(F.desc("updated_at"), "id")
