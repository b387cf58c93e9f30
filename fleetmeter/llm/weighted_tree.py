"""Sharding by a weighted hash tree of regions, racks and shards.

A key descends level by level: it draws a number for each child of the node where it is,
from a hash of key and child, divides minus its logarithm by the child's weight, and goes to
the smallest. So a child gets keys by its weight, and a changed weight moves keys only between
the changed child and its sisters: the rest of the tree stays. Only built-in functions.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetmeter.llm.ranges import range_bounds, range_number

RACKS, PER_RACK = 2, 2
# Shards of the fixed tree, four regions of two racks.
BASE = 16


class Leaf(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def tree_of(shards: int, base: int | None = None) -> list[Leaf]:
    """Shards 0 to ``base`` - 1 in full regions of racks, each later one in a region of its own.

    A later region takes its share from all others and nothing else moves; inside an old region
    its share would also move keys between that region's shards.
    """
    base = shards if base is None else base
    region = RACKS * PER_RACK
    old = [
        Leaf(f"region{s // region}", f"rack{s % region // PER_RACK}", s) for s in range(base)
    ]
    return old + [Leaf(f"single{s}", "rack0", s) for s in range(base, shards)]


def _children(tree: list[Leaf]) -> dict[str, dict[str, float]]:
    """Weight of each child by node name; a node weighs what its leaves weigh."""
    children: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for leaf in tree:
        path = ["", leaf.region, f"{leaf.region}/{leaf.rack}"]
        path.append(f"{path[-1]}/{leaf.shard}")
        for node, child in zip(path, path[1:]):
            children[node][child] += leaf.weight
    return children


def _drawn(key: Column, nodes: Column) -> Column:
    """The child of least -ln(u) / weight, u in (0, 1) from 52 bits of a hash."""

    def draw(node: Column) -> Column:
        digits = F.substring(F.md5(F.concat(key, F.lit("|"), node["name"])), 1, 13)
        u = (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
        return F.struct((-F.ln(u) / node["weight"]).alias("d"), node["name"].alias("name"))

    return F.array_min(F.transform(nodes, draw))["name"]


def shard_of(key: Column, tree: list[Leaf]) -> Column:
    """The shard of each key; all NULL keys share one. Leaves of weight 0 get nothing."""
    children = _children([leaf for leaf in tree if leaf.weight > 0])
    key = F.coalesce(key.cast("string"), F.lit(""))

    def choices(node: str) -> Column:
        return F.array(
            *(
                F.struct(F.lit(name).alias("name"), F.lit(weight).alias("weight"))
                for name, weight in sorted(children[node].items())
            )
        )

    def below(at: Column, nodes: list[str]) -> Column:
        table = F.create_map(*(x for n in nodes for x in (F.lit(n), choices(n))))
        return _drawn(key, F.element_at(table, at))

    region = _drawn(key, choices(""))
    rack = below(region, sorted(children[""]))
    leaf = below(rack, sorted(r for region in children[""] for r in children[region]))
    return F.element_at(F.split(leaf, "/"), -1).cast("int")


def placed(key: Column, shards: int) -> Column:
    """The shard of each key by one law for every number of shards: one more takes keys only into
    itself.

    From ``BASE`` shards on, these are the fixed tree, and each later one is a region of its own.
    Fewer shards keep their places in the fixed tree; the keys of its other leaves are drawn among
    the shards there are, so that a shard that comes takes the keys of its leaf and its draws."""
    if shards >= BASE:
        return shard_of(key, tree_of(shards, BASE))
    leaf = shard_of(key, tree_of(BASE))
    return F.when(leaf < shards, leaf).otherwise(shard_of(key, tree_of(shards, 0)))


def numbered(
    df: DataFrame, group: str, groups: int, order: str, ties: list[str], number: str
) -> DataFrame:
    """``df`` with the position of each row in its group, from 0 without gaps.

    The groups are few and large, so they are cut into ranges of ``order``. Rows are counted by
    group and range first; what lies before a range is added to the place within it. ``group``
    must depend on ``order`` alone, so that the counts read no other column.
    """
    bounds = range_bounds(df.select(order), order)
    df = df.withColumn("_range", range_number(F.col(order), bounds))
    counts = df.groupBy(group, "_range").agg(F.count("*").alias("_n"))
    before = W.partitionBy(group).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    # At most as many rows as groups times ranges, both bounded.
    offsets = counts.select(
        F.col(group).alias("_group"),
        F.col("_range").alias("_of"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    within = W.partitionBy(group, "_range").orderBy(F.col(order).asc_nulls_first(), *ties)
    same = (F.col(group) == F.col("_group")) & (F.col("_range") == F.col("_of"))
    placed = df.withColumn("_place", F.row_number().over(within) - 1)
    return (
        placed.join(F.broadcast(offsets), same)
        .withColumn(number, (F.col("_place") + F.col("_before")).cast("long"))
        .drop("_place", "_before", "_group", "_of", "_range")
    )


def sharded(
    documents: DataFrame, shards: int, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row of ``documents``: its id under its name, ``size`` (UTF-8 bytes of the text and
    one), ``text_crc32``, ``shard``, ``slot`` (position in the shard by id, then by checksum and
    size) and ``grown_shard`` (the shard if there were one more).

    Law: the id and the number of shards decide. A null text has size 1 and checksum 0; rows
    without id go to one shard, first in it; repeated rows get a slot each. Other columns are
    not read.
    """
    key = F.col(id_column)
    rows = documents.select(
        key,
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        placed(key, shards).alias("shard"),
        placed(key, shards + 1).alias("grown_shard"),
    )
    return numbered(rows, "shard", shards, id_column, ["text_crc32", "size"], "slot")
