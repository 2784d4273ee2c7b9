"""URL filters: a dated block list, applied as it stood when each page was fetched.

Entries of the list become validity intervals; every capture is joined, as of its fetch
time, with the entries that were active then. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def intervals(entries: DataFrame) -> DataFrame:
    """entries as validity intervals: pattern, category, valid_from, valid_until.

    entries: pattern (a host, a parent domain, or host/path prefix, lower case), listed_at
    (timestamp), action ('add' or 'remove'), category. An entry is active from its
    addition until the next change of its pattern; a later addition replaces the
    category. Changes at one instant: a removal wins, then the last category by code
    point. Repeated entries count once. Entries with a null pattern, time or action, or
    another action, have no effect. valid_until is null while the entry stands.
    """
    changes = (
        entries.where(
            F.col("pattern").isNotNull() & F.col("listed_at").isNotNull() & F.col("action").isin("add", "remove")
        )
        .groupBy("pattern", "listed_at")
        # 'remove' is above 'add', so the largest pair is the change that holds.
        .agg(F.max(F.struct("action", "category")).alias("change"))
    )
    following = Window.partitionBy("pattern").orderBy("listed_at")
    return (
        changes.withColumn("valid_until", F.lead("listed_at").over(following))
        .where(F.col("change.action") == "add")
        .select("pattern", F.col("change.category").alias("category"), F.col("listed_at").alias("valid_from"), "valid_until")
    )


def host_of(url: Column) -> Column:
    """The host of a URL, lower case, without user, port and trailing dot; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.nullif(F.rtrim(host, F.lit(".")), F.lit(""))


def lookup_keys(url: Column, most_labels: int, most_folders: int) -> Column:
    """The patterns that may cover a URL: its host, parent domains and host/folder prefixes,
    as far as they have at most so many labels and folders. An array, empty for a null URL
    or one without a host."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most_labels))),
        lambda i: F.array_join(F.slice(labels, F.size(labels) - i + 1, i), "."),
    )
    path = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://[^/?#]*(/[^?#]*)", 1)
    folders = F.filter(F.split(path, "/"), lambda x: x != "")
    paths = F.transform(
        F.slice(F.sequence(F.lit(0), F.least(F.size(folders), F.lit(most_folders))), 2, most_folders + 1),
        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(folders, 1, i), "/")),
    )
    keys = F.array_distinct(F.concat(parents, paths))
    return F.when(host.isNotNull(), keys).otherwise(F.array().cast("array<string>"))


def filtered(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """captures with host, blocked, pattern, category and valid_from.

    captures: url and fetched_at, and any other columns, which are carried along. Of the
    entries active at fetched_at, the most specific one, the longest pattern, is named
    (ties, which one pattern cannot have, by pattern). Not blocked, with null pattern:
    URLs that are null or have no host, captures without fetch time, and those that no
    active entry covers. Repeated captures are each judged.

    A verdict depends on the URL and the time alone, so each pair is looked up once. The
    joins are on keys that both sides are dealt by, so a host with a third of all
    captures is split between tasks.
    """
    carried = [c for c in captures.columns if c.lower() not in ("host", "blocked", "pattern", "category", "valid_from")]
    pairs = captures.select("url", "fetched_at").where("url IS NOT NULL AND fetched_at IS NOT NULL").distinct()
    active = intervals(entries)
    # No pattern of the list is longer than these, so longer keys of a URL find nothing.
    most = active.agg(
        F.coalesce(F.max(F.size(F.split(F.substring_index("pattern", "/", 1), r"\."))), F.lit(1)),
        F.coalesce(F.max(F.size(F.split("pattern", "/")) - 1), F.lit(0)),
    ).first()
    keyed = pairs.withColumn("__key", F.explode(lookup_keys(F.col("url"), *most)))
    found = keyed.join(
        active,
        (F.col("__key") == F.col("pattern"))
        & (F.col("valid_from") <= F.col("fetched_at"))
        & (F.col("valid_until").isNull() | (F.col("fetched_at") < F.col("valid_until"))),
    )
    best = found.groupBy(F.col("url").alias("__url"), F.col("fetched_at").alias("__at")).agg(
        F.max(F.struct(F.length("pattern").alias("n"), "pattern", "category", "valid_from")).alias("__best")
    )
    return captures.join(
        best, (F.col("url") == F.col("__url")) & (F.col("fetched_at") == F.col("__at")), "left"
    ).select(
        *[F.col(f"`{c}`") for c in carried],
        host_of(F.col("url")).alias("host"),
        F.col("__best").isNotNull().alias("blocked"),
        F.col("__best.pattern").alias("pattern"),
        F.col("__best.category").alias("category"),
        F.col("__best.valid_from").alias("valid_from"),
    )
