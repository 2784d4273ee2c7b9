"""Mixing sources to target weights by weighted fair queueing.

Every copy of a document has a virtual finish time: the words of its source up to it, in
shuffled order, divided by the source's target. All copies are sorted by that time across
the cluster, and the queue is cut where its running total reaches the budget. Sources
advance at the same virtual speed, so at the cut each has given its target. DataFrame
functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardbook.llm.tables import kept_table, running_totals

WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixRules:
    weights: tuple[int, ...] = (1, 2, 3)  # repeating, over the sources by code point
    most_copies: int = 3
    bucket_rows: int = 2_000  # rows of a source that one task puts in order, on average
    seed: str = "mix"


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """One row a source: source, source_size, weight, target.

    sizes: columns source and size, one row a document. The targets share the total of
    all sizes by weight; a target above most_copies times its source's size stops there,
    and what is over goes to the others by weight, until none is above. A source of no
    words has target 0; a null source is the last one.

    Sources with the least room for their weight stop first. In that order, a source
    stops if the level that remains for it and those after it is above its room.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    places = running_totals(
        totals, [F.col("source").isNull(), F.col("source")], {"place": F.lit(1)}, "sources"
    )
    cycle = F.array(*[F.lit(w).cast("long") for w in rules.weights])
    weighed = places.select(
        "source",
        "source_size",
        F.element_at(cycle, ((F.col("place") - 1) % len(rules.weights) + 1).cast("int")).alias("weight"),
    ).withColumn("room", F.col("source_size") * rules.most_copies)
    filled = kept_table(
        running_totals(
            weighed,
            [F.col("room") / F.col("weight"), F.col("source").isNull(), F.col("source")],
            {"room_up_to": F.col("room"), "weight_up_to": F.col("weight")},
            "rooms",
        ),
        "filled",
        light=True,
    )
    whole = filled.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight"))
    level_here = (F.col("all_size") - (F.col("room_up_to") - F.col("room"))) / (
        F.col("all_weight") - (F.col("weight_up_to") - F.col("weight"))
    )
    stops = F.col("room") < F.col("weight") * level_here
    # One row of totals beside each source.
    marked = filled.join(F.broadcast(whole)).withColumn("stops", stops)
    stopped = marked.agg(
        F.sum(F.when(F.col("stops"), F.col("room")).otherwise(0)).alias("stopped_room"),
        F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).alias("open_weight"),
    )
    target = F.when(F.col("stops"), F.col("room").cast("double")).otherwise(
        F.col("weight") * ((F.col("all_size") - F.col("stopped_room")) / F.col("open_weight"))
    )
    return marked.join(F.broadcast(stopped)).select("source", "source_size", "weight", target.alias("target"))


def mixed(documents: DataFrame, rules: MixRules = MixRules()) -> DataFrame:
    """documents with size, source_size, target and taken.

    taken: the words that the mix takes from the document, repeats counted, from 0 to
    most_copies times its size. The one copy at the cut is taken in part. Null or wordless texts have size 0 and are not taken. Equal rows are queued
    one after the other. An empty table gives an empty result. Columns of the same
    names in documents are replaced.
    """
    carried = [c for c in documents.columns if c.lower() not in ("size", "source_size", "target", "taken")]
    # The order of a rerun: a keyed hash of the id and size, whatever the partitions are.
    shuffled = F.md5(F.concat_ws(":", F.lit(rules.seed), F.col("doc_id").cast("string"), "size"))
    kept = [c for c in carried if c != "text"]
    sized = kept_table(
        documents.select(*[F.col(f"`{c}`") for c in carried], size_in_words(F.col("text")).alias("size"))
        .select(*[F.col(f"`{c}`") for c in kept], "size")
        .withColumn("__order", shuffled),
        "sizes",
    )
    targets = kept_table(source_targets(sized, rules), "targets", light=True)
    queued = kept_table(_queued(sized, targets, rules), "queued")
    served = F.lit(0).cast("long")
    for copy in range(rules.most_copies):
        place = _place(F.lit(copy))
        served = served + F.when(place < F.col("__cut.place"), F.col("size")).when(
            place == F.col("__cut.place"), F.col("__cut.part")
        ).otherwise(F.lit(0).cast("long"))
    taken = F.when((F.col("size") > 0) & (F.col("target") > 0), served).otherwise(F.lit(0).cast("long"))
    # The cut is one row.
    return queued.join(F.broadcast(_cut(queued, rules))).select(
        *[F.col(f"`{c}`") for c in kept], "size", "source_size", "target", taken.alias("taken")
    )


def _place(copy: Column) -> Column:
    """Where a copy of a document stands in the queue: by virtual finish time, then by shuffle."""
    finish = (copy * F.col("source_size") + F.col("__before") + F.col("size")) / F.col("target")
    return F.struct(finish.alias("finish"), F.col("__order").alias("order"), F.col("source").alias("source"))


def _queued(sized: DataFrame, targets: DataFrame, rules: MixRules) -> DataFrame:
    """sized with its source's figures, and the source's words before each document.

    A source may hold a third of all rows, so no task puts a whole source in order. The
    shuffle key's leading digits make buckets; a bucket is put in order by itself, and the
    sums of the buckets before it are added, which come from running totals over all buckets.
    """
    buckets = F.lit(sized.count() // rules.bucket_rows + 1)
    bucket = F.floor(F.conv(F.substring("__order", 1, 8), 16, 10).cast("long") * buckets / F.lit(1 << 32))
    dealt = sized.withColumn("__bucket", bucket.cast("long"))
    sums = dealt.groupBy("source", "__bucket").agg(F.sum("size").alias("__sum"))
    order = [F.col("source").isNull(), F.col("source"), F.col("__bucket")]
    running = kept_table(running_totals(sums, order, {"__up_to": F.col("__sum")}, "buckets"), "running", light=True)
    starts = running.groupBy(F.col("source").alias("__first_of")).agg(F.min(F.col("__up_to") - F.col("__sum")).alias("__start"))
    before = running.join(starts, F.col("source").eqNullSafe(F.col("__first_of"))).select(
        F.col("source").alias("__source"),
        F.col("__bucket").alias("__of"),
        (F.col("__up_to") - F.col("__sum") - F.col("__start")).alias("__earlier"),
    )
    here = Window.partitionBy("source", "__bucket").orderBy("__order", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = dealt.withColumn("__here", F.coalesce(F.sum("size").over(here), F.lit(0)))
    figures = targets.select(F.col("source").alias("__owner"), "source_size", "target")
    return (
        placed.join(
            before, placed["source"].eqNullSafe(before["__source"]) & (F.col("__bucket") == F.col("__of"))
        )
        .withColumn("__before", F.col("__here") + F.col("__earlier"))
        .join(figures, F.col("source").eqNullSafe(F.col("__owner")))
        .drop("__source", "__of", "__owner", "__here", "__earlier", "__bucket")
    )


def _cut(queued: DataFrame, rules: MixRules) -> DataFrame:
    """One row with a struct `__cut`: the place in the queue where the running total reaches
    the budget, the words of all documents, and the part that the copy there still gives.

    The copies in the queue are light: a place and a size each.
    """
    entries = queued.where("size > 0 AND target > 0").withColumn(
        "__copy", F.explode(F.sequence(F.lit(0), F.lit(rules.most_copies - 1)))
    )
    entries = entries.select("size", _place(F.col("__copy")).alias("place"))
    running = running_totals(entries, [F.col("place")], {"given": F.col("size")}, "queue")
    budget = queued.agg(F.sum("size").alias("budget"))
    reached = running.join(F.broadcast(budget)).where(F.col("given") >= F.col("budget"))
    part = (F.col("size") - (F.col("given") - F.col("budget"))).alias("part")
    return reached.agg(F.min(F.struct("place", part)).alias("__cut"))
