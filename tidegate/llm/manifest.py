"""Merkle manifest of a dataset with nested-interval labels.

A leaf is the checksum of a row's columns, each with its byte count. The leaves of a group, in order, are ranked from 0; three neighbours at
a time are hashed into a node of the next level, until one node, the group's root, remains. The groups' roots, in order, are the leaves of the tree on top.

Every node is labelled with the interval [low, high) of the leaf ranks it covers. A node is an ancestor of another if its interval contains the
other's, and what a parent's interval has besides a child's is the child's siblings: those that end before it stand left, those that begin behind it
right. Levels are handled in buckets of SPAN: one aggregation gathers the 3**SPAN members below a node and builds the levels between, and on the way down
one join per bucket, on group and interval, attaches the path above a node to all the members it contains. So a row travels once for its rank
and once per bucket of its level, whatever the tree's height, and no gathered group has more than 3**SPAN members, however large
a group of the manifest is. Ranks are places inside range partitions plus the counts of earlier ones; nothing is ranked in one task.

Defined cases: a null column is `-`; the null group comes first, null keys come first within a group; rows with equal keys are ordered by their leaves, and equal
rows are leaves of their own; only the named columns are read, so others may have any name; an empty table has no rows and no root.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.frames import stored
from tidegate.session import sized

FANOUT = 3
# Levels built by one aggregation.
SPAN = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODES = "array<struct<low: bigint, high: bigint, digest: string>>"
STEPS = "array<struct<left: string, right: string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its byte count; `-` for null."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(docs: DataFrame, fields: Sequence[str], changed: dict[str, Column] | None = None) -> Column:
    """Checksum of a row, with some columns changed if asked for."""
    return digest(*(field((changed or {}).get(name, F.col(f"`{name}`"))) for name in fields))


def ranked(rows: DataFrame, label: str) -> DataFrame:
    """Rows (group, key, digest, own) with `low`, their place in the group, and the group's `size`.

    Equal rows are told apart by their place in the stored input, so that no range is bound to be large.
    """
    order = [F.col("group").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("digest"), F.col("nth")]
    numbered = stored(rows, label).withColumn("nth", F.monotonically_increasing_id())
    sorted_ = numbered.repartitionByRange(*order).sortWithinPartitions(*order).drop("nth")
    placed = stored(sorted_.withColumn("at", F.monotonically_increasing_id()), label).withColumn("part", F.shiftright("at", 33))
    # One row per partition and group in it.
    counted = placed.groupBy("group", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    group = Window.partitionBy("group")
    earlier = F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counted = counted.select(F.col("group").alias("g"), F.col("part").alias("p"), (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("shift"),
                             F.sum("n").over(group).alias("size"))
    same = F.col("group").eqNullSafe(F.col("g")) & (F.col("part") == F.col("p"))
    return placed.join(sized(stored(counted, label)), same).select("group", "size", (F.col("at") + F.col("shift")).alias("low"), "digest", "own")


def gathered(members: DataFrame, first: int) -> DataFrame:
    """The members, nodes of level `first`, below each node SPAN levels higher: group, size, block, members by rank."""
    width = FANOUT ** first
    member = F.struct("low", F.least(F.col("low") + width, F.col("size")).alias("high"), "digest", "own")
    return (members.groupBy("group", "size", F.expr(f"low div {width * FANOUT ** SPAN}").alias("block"))
            .agg(F.array_sort(F.collect_list(member)).alias("members")))


def parents(nodes: Column) -> Column:
    """The next level: runs of FANOUT nodes, hashed, with the interval they cover together."""
    def parent(i: Column) -> Column:
        run = F.slice(nodes, i * FANOUT + 1, FANOUT)
        joined = F.array_join(F.transform(run, lambda n: n["digest"]), "")
        return F.struct(F.get(run, F.lit(0))["low"].alias("low"), F.element_at(run, -1)["high"].alias("high"), digest(joined).alias("digest"))
    return F.transform(F.sequence(F.lit(0), ((F.size(nodes) - 1) / FANOUT).cast("int")), parent)


def exists(level: int) -> Column:
    """Does a group's tree have this level? The one above its leaves exists from two leaves on."""
    return F.col("size") > FANOUT ** (level - 1) if level else F.lit(True)


def levelled(blocks: DataFrame, first: int) -> DataFrame:
    """Blocks with the nodes of levels first to first + SPAN as columns level0 to levelSPAN; empty where the tree has no such level."""
    plain = F.transform("members", lambda m: F.struct(m["low"].alias("low"), m["high"].alias("high"), m["digest"].alias("digest")))
    out = blocks.withColumn("level0", plain)
    for i in range(1, SPAN + 1):
        out = out.withColumn(f"level{i}", F.when(exists(first + i), parents(F.col(f"level{i - 1}"))).otherwise(F.array().cast(NODES)))
    return out


def climb(members: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every bucket of levels, and the roots: group, bucket in which its tree ends, digest."""
    largest = members.agg(F.max("size")).first()[0] or 1
    buckets, roots = [], []
    while True:
        first = SPAN * len(buckets)
        # Written with all levels: as expressions, every use of a level would compute it again.
        nodes = stored(levelled(gathered(members, first), first), "blocks")
        buckets.append(nodes)
        ends = F.col("size") <= FANOUT ** (first + SPAN)
        top = F.coalesce(*(F.get(f"level{i}", F.lit(0)) for i in reversed(range(SPAN + 1))))
        roots.append(nodes.where(ends).select("group", F.lit(first // SPAN).alias("bucket"), top["digest"].alias("digest")))
        if FANOUT ** (first + SPAN) >= largest:
            break
        members = nodes.where(~ends).select("group", "size", top["low"].alias("low"), top["digest"].alias("digest"), F.lit(None).cast("string").alias("own"))
    found = roots[0]
    for other in roots[1:]:
        found = found.unionByName(other)
    return buckets, found


def siblings(first: int) -> Column:
    """Members of a block with the digests that stand beside their ancestors in this bucket, lowest level first: what each
    parent's interval has besides the ancestor's own, to its left and to its right."""
    def beside(member: Column, i: int) -> Column:
        """An ancestor of level i and its siblings are neighbours in the level, beginning with the parent's first child."""
        nodes, width = F.col(f"level{i}"), FANOUT ** (first + i)
        parent = F.expr(f"{FANOUT ** SPAN * FANOUT ** first} * block")
        at = ((member["low"] - parent) / (width * FANOUT)).cast("int")
        children = F.slice(nodes, at * FANOUT + 1, FANOUT)
        left = F.filter(children, lambda n: n["high"] <= member["low"])
        right = F.filter(children, lambda n: n["low"] >= member["high"])
        step = F.struct(*(F.array_join(F.transform(side, lambda n: n["digest"]), "").alias(name) for side, name in ((left, "left"), (right, "right"))))
        return F.when(exists(first + i + 1), F.array(step)).otherwise(F.array().cast(STEPS))

    return F.transform("members", lambda m: F.struct(m["low"].alias("low"), m["digest"].alias("digest"), m["own"].alias("own"),
                                                     F.concat(*(beside(m, i) for i in range(SPAN))).alias("steps")))


def descend(buckets: list[DataFrame], above: DataFrame) -> DataFrame:
    """Members of the lowest bucket with the whole path: digest, own, root (of the group), steps. `above` has for each group the bucket of its
    root, the root, and the steps from there on."""
    below = None
    for number in reversed(range(len(buckets))):
        paths = above.where(F.col("bucket") == number).select(F.col("group").alias("g"), F.lit(0).cast("long").alias("top"), "root", F.col("steps").alias("rest"))
        if below is not None:
            higher = below.select(F.col("group").alias("g"), (F.col("low") / FANOUT ** (SPAN * (number + 1))).cast("long").alias("top"), "root", F.col("steps").alias("rest"))
            paths = paths.unionByName(higher)
        within = F.col("group").eqNullSafe(F.col("g")) & (F.col("block") == F.col("top"))
        rows = buckets[number].select("group", "block", siblings(SPAN * number).alias("members")).join(paths, within)
        rows = rows.select("group", "root", "rest", F.inline("members"))
        below = rows.select("group", "low", "digest", "own", "root", F.concat("steps", "rest").alias("steps"))
        if number:
            below = stored(below.drop("own"), "paths")
    return below


def manifest(docs: DataFrame, group: str = "source", key: str = "doc_id", fields: Sequence[str] = FIELDS,
             changed: dict[str, Column] | None = None) -> DataFrame:
    """key, leaf, changed_leaf (the row's checksum with some columns changed), subroot, root and steps, the digests left and right of the row's
    ancestors from the lowest level up to the root."""
    rows = docs.select(F.col(f"`{group}`").alias("group"), F.col(f"`{key}`").alias("key"), leaf(docs, fields).alias("digest"),
                       F.struct(F.col(f"`{key}`").alias("key"), leaf(docs, fields, changed).alias("changed")).alias("own"))
    low_buckets, roots = climb(ranked(rows, "leaves"))
    roots = stored(roots, "roots")
    tops = roots.select(F.lit(0).alias("group"), F.col("group").alias("key"), "digest", F.struct(F.col("group").alias("key"), "bucket").alias("own"))
    high_buckets, summit = climb(ranked(tops, "tops"))
    summit = summit.select("group", "bucket", F.col("digest").alias("root"), F.array().cast(STEPS).alias("steps"))
    over = descend(high_buckets, stored(summit, "summit"))
    above = over.select(F.col("own.key").alias("group"), F.col("own.bucket").alias("bucket"), F.struct(F.col("digest").alias("subroot"), "root").alias("root"), "steps")
    found = descend(low_buckets, stored(above, "above"))
    return found.select(F.col("own.key").alias(key), F.col("digest").alias("leaf"), F.col("own.changed").alias("changed_leaf"),
                        F.col("root.subroot").alias("subroot"), F.col("root.root").alias("root"), "steps")


def folded(start: Column, steps: Column) -> Column:
    """The root that a leaf and the digests beside its path lead to."""
    return F.aggregate(steps, start, lambda node, step: digest(step["left"], node, step["right"]))


def proofs(docs: DataFrame) -> DataFrame:
    """Proof and verification of every row, after a rehearsal of tampering that deletes the line feeds of every second text (by the checksum
    of its id)."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    tampered = F.when(hit, F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = manifest(docs, changed={"text": tampered})
    sides = F.transform("steps", lambda s: F.concat(s["left"], s["right"]))
    out = found.select("doc_id", "leaf", "subroot", "root", digest(F.array_join(sides, "")).alias("proof_sha256"),
                       folded(F.col("changed_leaf"), F.col("steps")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
