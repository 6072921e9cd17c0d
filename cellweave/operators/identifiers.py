"""Unique safe identifiers for names, in input order."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import session
from ..functions import terms


def _running_count(events: DataFrame) -> DataFrame:
    """For each row of ``base, ordinal, member``: how many members of the base come before it.

    Groups may be large, so rows are range-partitioned by (base, ordinal): a group runs over as many
    partitions as it needs. Inside a partition a window counts; what a group brings along from the partitions
    before is added from a table with two rows per partition.
    """
    order = ["base", "ordinal", "member"]
    placed = events.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    placed = session.settle(placed)
    before = Window.partitionBy("_part", "base").orderBy("ordinal", "member").rowsBetween(
        Window.unboundedPreceding, -1
    )
    counted = placed.withColumn("_within", F.coalesce(F.sum("member").over(before), F.lit(0)))

    ends = placed.groupBy("_part").agg(F.min("base").alias("_first"), F.max("base").alias("_last"))
    # Of the groups in a partition only the last can go on, and only the first can come from before.
    last = placed.join(F.broadcast(ends), "_part").filter(F.col("base") == F.col("_last"))
    totals = last.groupBy("_part", "base").agg(F.sum("member").alias("_members"))
    earlier = Window.partitionBy("base").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = ends.select("_part", F.col("_first").alias("base"), F.lit(0).cast("long").alias("_members"))
    marks = totals.withColumn("_mark", F.lit(1)).unionByName(first.withColumn("_mark", F.lit(0)))
    marks = marks.groupBy("_part", "base").agg(F.sum("_members").alias("_members"), F.min("_mark").alias("_mark"))
    carried = marks.withColumn("_carry", F.coalesce(F.sum("_members").over(earlier), F.lit(0)))
    carried = carried.filter(F.col("_mark") == 0).select("_part", "base", "_carry")
    joined = counted.join(F.broadcast(carried), ["_part", "base"], "left")
    return joined.withColumn("before", F.col("_within") + F.coalesce("_carry", F.lit(0))).drop(
        "_part", "_within", "_carry"
    )


def unique_identifiers(df: DataFrame, name: str, order_by: str, out: str = "identifier") -> DataFrame:
    """``column_<safe name>``; on a collision ``_1``, ``_2``, ... in order of ``order_by``, skipping taken ones.

    ``order_by`` is a unique number. An identifier can also be taken by a name that spells it out (``a_1``
    besides two ``a``): whoever comes first has it. Such names form chains (``a``, ``a_1``, ``a_1_1``), which
    are settled from the shortest name on, one round per link of the longest chain.
    """
    members = df.withColumn("base", terms.safe_identifier(name)).withColumn("ordinal", F.col(order_by))
    bases = session.settle(
        members.groupBy("base").agg(F.count("*").alias("size"), F.min("ordinal").alias("first"))
    )
    children = _spelled_out(bases)
    events = members.select(F.struct(*df.columns).alias("_row"), "base", "ordinal", F.lit(1).alias("member"))
    if children.isEmpty():
        ranked = _running_count(events).withColumn("slot", F.col("before"))
    else:
        ranked = _with_slots(events, children)
    suffix = F.when(F.col("slot") > 0, F.concat(F.lit("_"), F.col("slot").cast("string"))).otherwise(F.lit(""))
    return ranked.select("_row.*", F.concat("base", suffix).alias(out))


def _spelled_out(bases: DataFrame) -> DataFrame:
    """Bases that look like a numbered form of another base and can meet one: ``base, child, k, first``."""
    numbered = bases.select(
        F.col("base").alias("child"),
        F.col("first"),
        F.regexp_extract("base", r"^(.*)_([1-9][0-9]{0,17})$", 1).alias("base"),
        F.regexp_extract("base", r"^(.*)_([1-9][0-9]{0,17})$", 2).try_cast("long").alias("k"),
    ).filter(F.col("k").isNotNull())
    met = numbered.join(bases.select("base", "size"), "base")
    # A base numbers its own rows and steps over as many numbered names as there are.
    reach = met.groupBy("base").agg((F.max("size") + F.count("*")).alias("_reach"))
    met = met.join(reach, "base").filter(F.col("k") <= F.col("_reach"))
    return session.settle(met.drop("size", "_reach"))


def _with_slots(events: DataFrame, children: DataFrame) -> DataFrame:
    """Slot of each member: 0 for the plain form, else the number of its suffix."""
    markers = children.select(
        F.lit(None).cast(events.schema["_row"].dataType).alias("_row"), "base",
        F.col("first").alias("ordinal"), F.lit(0).alias("member"),
    )
    counted = session.settle(_running_count(events.unionByName(markers)))
    arrivals = counted.filter(F.col("member") == 0).select("base", F.col("ordinal").alias("first"), "before")
    pending = session.settle(children.join(arrivals, ["base", "first"]))

    # ``displaced``: children whose plain form was given away before they came, round by round.
    displaced = None
    while True:
        shift = F.lit(0)
        table = pending
        if displaced is not None:
            moved = displaced.select(F.col("child").alias("base"), F.lit(1).alias("_moved"))
            table = table.join(moved, "base", "left")
            shift = F.coalesce("_moved", F.lit(0))
        table = table.withColumn("_taken", F.col("before") - 1 + shift)
        entry = F.struct(F.col("k"), F.col("_taken").alias("taken"), F.col("child"))
        steps = table.groupBy("base").agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
        # A numbered name keeps its form if the run of the base has not reached it when the name arrives.
        kept = F.aggregate(
            "_entries",
            F.array().cast("array<bigint>"),
            lambda seen, e: F.when(
                e["taken"] + F.size(seen) < e["k"], F.concat(seen, F.array(e["k"]))
            ).otherwise(seen),
        )
        steps = session.settle(steps.withColumn("_kept", kept))
        lost = steps.select(F.explode("_entries").alias("e"), "_kept")
        lost = lost.filter(~F.array_contains("_kept", F.col("e.k"))).select(F.col("e.child").alias("child"))
        lost = session.settle(lost)
        if displaced is not None and _same(lost, displaced):
            break
        if displaced is None and lost.isEmpty():
            displaced = lost
            break
        displaced = lost

    rows = counted.filter(F.col("member") == 1)
    rows = rows.join(session.broadcast_if_small(steps.select("base", "_kept")), "base", "left")
    moved = displaced.select(F.col("child").alias("base"), F.lit(1).alias("_moved"))
    rows = rows.join(session.broadcast_if_small(moved), "base", "left")
    place = F.col("before") + F.coalesce("_moved", F.lit(0))
    slot = F.aggregate(
        F.coalesce("_kept", F.array().cast("array<bigint>")),
        place,
        lambda slot, k: F.when(k <= slot, slot + 1).otherwise(slot),
    )
    return rows.withColumn("slot", F.when(place == 0, place).otherwise(slot))


def _same(left: DataFrame, right: DataFrame) -> bool:
    return left.join(right, "child", "left_anti").isEmpty() and right.join(left, "child", "left_anti").isEmpty()
