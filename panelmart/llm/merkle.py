"""Merkle manifest of a dataset: one root hash, and a proof for every row.

Every row is a leaf.  Within a group (a language) the leaves stand in id order; every
``fanout`` consecutive nodes become their parent until one node, the subroot, remains.
The subroots, ordered by group (null first), give the root the same way.

Slot pivot: a node's place, written in base ``fanout``, names its slot under each of its
ancestors.  Per level, conditional aggregates over a parent's rows spread the children's
hashes into ``fanout`` columns; concatenating the columns and hashing gives the parent,
leaving out the own slot's column gives the siblings.  The digits of the place are
columns, so rows sorted once by them are sorted for the aggregate of every level.

Scale: places come from one range exchange of narrow rows (hashes, not texts) and the
counts of its partitions.  A climb takes ``BLOCK`` leaves at a time, ``levels`` levels in
one stage; what it leaves is one row a block, so 10^10 rows need three climbs.  A block
is the largest thing a task holds together, however many rows a group has.  Siblings are
never stored: the way down climbs again and joins the short table of the blocks' ways.

Nulls: a null field is ``-``; a null group is a group of its own; null ids come first.
Rows that repeat an id follow each other in order of their leaf; equal rows are leaves
of their own.  Empty tables give no rows.  Other columns are not read.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmart.llm.common import scratch

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 2
BLOCK = 4096               # leaves a climb takes together, at most
MAX_BROADCAST = 1 << 17    # rows of the table of partition counts that may be broadcast


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256."""
    return F.sha2(text.cast("binary"), 256)


def field_text(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    return digest(F.concat(*map(field_text, values)))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: digest(F.concat(s["before"], h, s["after"])))


def proof_digest(path: Column) -> Column:
    """Hash of all siblings, from the leaf's run to the root's, left to right."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def _placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (grp, ...) with their place i in the order within grp and grp's size."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in ("grp", *order)]
    # the last key only lets a range of equal rows be split: they are interchangeable
    ordered = (rows.withColumn("tie", F.monotonically_increasing_id())
               .repartitionByRange(parts, *keys, "tie").sortWithinPartitions(*keys).drop("tie"))
    stored = scratch(ordered.withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    stored = stored.withColumn("part", F.shiftright("at", 33))
    runs = stored.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    # one row a partition and group: the running sums see partition counts, not rows
    group = Window.partitionBy("grp")
    runs = scratch(runs.select("grp", "part", "first", F.sum("n").over(group).alias("size"),
                               (F.sum("n").over(group.orderBy("part")) - F.col("n")).alias("before")), "merkle-runs")
    short = F.broadcast(runs) if runs.count() <= MAX_BROADCAST else runs
    return (stored.join(short, ["grp", "part"])
            .withColumn("i", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "first", "before"))


def _climb(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """``levels`` levels up: nodes (grp, i, size, h, ...) with block, top (the hash their block
    comes to) and path (array of before, after: the siblings of each level that has any)."""
    digits = [f"slot{n}" for n in range(levels)]
    rows = nodes.withColumns({
        "block": F.floor(F.col("i") / F.lit(fanout ** levels)).cast("long"), "top": F.col("h"),
        **{d: F.pmod(F.floor(F.col("i") / F.lit(fanout ** n)).cast("long"), F.lit(fanout)).cast("int") for n, d in enumerate(digits)}})
    rows = rows.repartition("grp", "block").sortWithinPartitions("grp", "block", *reversed(digits))
    slots = [f"child{j}" for j in range(fanout)]
    query = "{rows}"
    for n, own in enumerate(digits):
        parent = f"OVER (PARTITION BY {', '.join(['grp', 'block', *reversed(digits[n + 1:])])})"
        pivot = ", ".join(f"max(IF({own} = {j}, top, NULL)) {parent} AS {s}" for j, s in enumerate(slots))
        before, after = (", ".join(f"IF({own} {sign} {j}, {s}, NULL)" for j, s in enumerate(slots)) for sign in "><")
        several = f"size > {fanout ** n}"   # nodes of this level
        query = f"""SELECT * EXCEPT (top, {', '.join(slots)}),
            IF({several}, struct(concat_ws('', {before}) AS before, concat_ws('', {after}) AS after), NULL) AS step{n},
            IF({several}, sha2(concat_ws('', {', '.join(slots)}), 256), top) AS top FROM (SELECT *, {pivot} FROM {query})"""
        query = f"({query})"
    steps = [f"step{n}" for n in range(levels)]
    return nodes.sparkSession.sql(f"SELECT * EXCEPT ({', '.join(digits + steps)}), filter(array({', '.join(steps)}), s -> s IS NOT NULL) AS path FROM {query}",
                                  rows=rows)


def _tree(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame, int]:
    """The nodes each climb starts from, the one node of every group (grp, i, h), levels of a climb."""
    levels = 1
    while fanout ** (levels + 1) <= BLOCK:
        levels += 1
    stack, most = [], nodes.agg(F.max("size")).first()[0] or 0
    while most > 1:
        stack.append(nodes)
        tops = _climb(nodes, fanout, levels).groupBy("grp", "block").agg(F.max("top").alias("h"), F.max("size").alias("size"))
        size = F.ceil(F.col("size") / F.lit(fanout ** levels)).cast("long")
        nodes = scratch(tops.select("grp", F.col("block").alias("i"), size.alias("size"), "h"), "merkle-blocks")
        most = ceil(most / fanout ** levels)
    return stack, nodes, levels


def _down(stack: list[DataFrame], upper: DataFrame, fanout: int, levels: int, carry: list[str]) -> DataFrame:
    """``upper`` (grp, i, path, ...) of every group's one node, carried down to the first nodes."""
    more = [c for c in upper.columns if c not in ("grp", "i", "path")]
    for nodes in reversed(stack):
        own = [c for c in carry if c in nodes.columns]
        above = upper.select("grp", F.col("i").alias("block"), F.col("path").alias("above"), *more)
        upper = _climb(nodes, fanout, levels).join(above, ["grp", "block"]).select(
            "grp", "i", F.concat("path", "above").alias("path"), *more, *own)
    return upper


def _no_path() -> Column:
    return F.array().cast("array<struct<before:string,after:string>>")


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = FIELDS,
             fanout: int = FANOUT, carry: dict[str, Column] | None = None) -> DataFrame:
    """id, leaf, subroot, root and path (siblings before and after the own node, per level with
    any node beside it or above) of every row; ``carry`` adds columns computed from ``docs``."""
    carry = carry or {}
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))  # null first, then bytewise
    leaves = scratch(docs.select(group.alias("grp"), F.col(id_col).alias("id"), leaf_hash([F.col(c) for c in fields]).alias("h"),
                                 *[c.alias(f"carry_{name}") for name, c in carry.items()]), "merkle-leaves")
    kept = ["id", "h", *[f"carry_{name}" for name in carry]]
    stack, subroots, levels = _tree(_placed(leaves, ["id", "h"]), fanout)
    groups = _placed(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "h"), ["name"])
    high, roots, _ = _tree(groups, fanout)
    top = roots.select("grp", "i", _no_path().alias("path"), F.col("h").alias("root"))
    if high:
        top = _down(high, top, fanout, levels, ["name", "h"])
    else:  # one group at most: its subroot is the root
        top = groups.select("name", "h", _no_path().alias("path"), F.col("h").alias("root"))
    above = scratch(top.select(F.col("name").alias("grp"), F.lit(0).cast("long").alias("i"), "path", "root", F.col("h").alias("subroot")), "merkle-groups")
    if not stack:  # no group has two rows
        rows = _placed(leaves, ["id", "h"]).join(above, ["grp", "i"])
    else:
        rows = _down(stack, above, fanout, levels, kept)
    return rows.select(F.col("id").alias(id_col), F.col("h").alias("leaf"), "subroot", "root", "path",
                       *[F.col(f"carry_{name}").alias(name) for name in carry])
