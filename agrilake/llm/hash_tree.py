"""Sharding by a weighted hash tree: region, then rack, then shard, each chosen by weighted hash draws.

A child's draw for a key is -ln(u) / weight with u from a hash of key and the child's path, and its weight the sum of its
leaves': an exponential waiting time. Among the children of a node the smallest draw wins, so each is chosen in
proportion to its weight, on every level by draws of its own. Where a leaf's weight changes, only the draws of its own
region, rack and itself do: keys move into the region or out of it, and inside it into the rack or out of it; in
all other racks, and between all other regions, every key stays. A new leaf in a region of its own takes keys into itself
and moves no other; that is how the law `key` adds a shard.

Cases: a null key is hashed as a key of its own; a null text has size 0 + 1 and the checksum of no bytes; equal rows
get different slots; an empty table gives an empty result; other columns of `docs` are ignored whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrilake.llm.scratch import stored

#: Slots are counted in this many parts of a shard, so that no task sorts a whole shard.
PARTS = 4096
Tree = dict[str, dict[str, dict[int, float]]]  # region -> rack -> shard -> weight


def leaves(tree: Tree) -> dict[int, float]:
    found = {shard: weight for racks in tree.values() for rack in racks.values() for shard, weight in rack.items()}
    if len(found) != sum(len(rack) for racks in tree.values() for rack in racks.values()):
        raise ValueError("a shard stands in the tree twice")
    if not found or min(found.values()) <= 0:
        raise ValueError("shards need weights above 0")
    return found


def weight_of(node: dict | float) -> float:
    return sum(map(weight_of, node.values())) if isinstance(node, dict) else float(node)


def choices(node: dict | float, path: tuple = ()) -> list[tuple[tuple, float]]:
    """(path, weight) of all children that have siblings to be chosen from."""
    if not isinstance(node, dict):
        return []
    own = [((*path, name), weight_of(child)) for name, child in node.items()] if len(node) > 1 else []
    return own + [c for name, child in node.items() for c in choices(child, (*path, name))]


def draw(key: Column, path: tuple, weight: float) -> Column:
    """Exponential draw of a child: 52 bits of md5 as a number in (0, 1)."""
    bits = F.conv(F.substring(F.md5(F.concat_ws("/", key, *map(F.lit, map(str, path)))), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(1 << 52)) / F.lit(weight)


def _first(options: list[tuple[Column, Column]]) -> Column:
    """Value of the smallest draw; ties go to the option named first."""
    ranked = [F.struct(d.alias("draw"), F.lit(i).alias("at"), v.alias("value")) for i, (d, v) in enumerate(options)]
    return F.array_min(F.array(*ranked))["value"]


def descend(node: dict | float, draws: dict[tuple, Column], path: tuple = ()) -> Column:
    """Shard found below a node by the smallest draw on every level."""
    if not isinstance(node, dict):
        return F.lit(path[-1])
    below = {(*path, name): descend(child, draws, (*path, name)) for name, child in node.items()}
    return _first([(draws[at], shard) for at, shard in below.items()]) if len(below) > 1 else next(iter(below.values()))


def with_shards(rows: DataFrame, key: Column, trees: dict[str, Tree]) -> DataFrame:
    """`rows` with one shard column per tree; equal children of several trees share their draws."""
    for tree in trees.values():
        leaves(tree)
    wanted = dict.fromkeys(choice for tree in trees.values() for choice in choices(tree))
    name = {choice: f"__draw_{i}" for i, choice in enumerate(wanted)}
    text = F.coalesce(key.cast("string"), F.lit("no key"))
    drawn = rows.withColumns({name[choice]: draw(text, *choice) for choice in wanted})
    placed = {
        column: descend(tree, {path: F.col(name[path, weight]) for path, weight in choices(tree)})
        for column, tree in trees.items()
    }
    return drawn.withColumns(placed).drop(*name.values())


def with_slots(rows: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """Gapless numbers from 0 inside every shard.

    Rows are spread over PARTS parts of a shard by a hash of `order`; a part is numbered by a window and starts where
    the parts before it end. The table of starts has at most PARTS rows per shard, whatever the input's size.
    """
    hashed = F.md5(F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in order]))
    cut = F.conv(F.substring(hashed, 1, 3), 16, 10).cast("int") % PARTS
    parts = stored(rows.withColumn("__part", cut), "slots")
    before = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.groupBy(shard, "__part").agg(F.count("*").alias("__n"))
    starts = starts.select(shard, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = F.row_number().over(Window.partitionBy(shard, "__part").orderBy(*order)) - 1
    # At most shards x PARTS rows: a proven bound.
    numbered = parts.withColumn("slot", inside.cast("long")).join(F.broadcast(starts), [shard, "__part"])
    return numbered.withColumn("slot", F.col("slot") + F.col("__start")).drop("__part", "__start")


def shard_documents(docs: DataFrame, tree: Tree, grown: Tree) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and the shard under the grown tree, for every document."""
    sized = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    placed = with_shards(sized, F.col("doc_id"), {"shard": tree, "grown_shard": grown})
    return with_slots(placed, "shard", ["doc_id", "text_crc32", "size"])
