"""A Merkle tree over a dataset by time-forward processing, with proofs from a reversed sweep.

A node's label is (level, tree, number), so children come before their parents. The priority queue holds
messages under the label of the node they are for; it is external: its lowest labels, one level at a
time, are a written table that Spark's sort-based shuffle brings together label by label. Popping a
level makes its digests and puts one message a node into the next. The same labels taken in reverse
deliver to every child what lies beside its way to the root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from epiframe.llm.common import Scratch, partitions

#: One level of a proof: the digests before the node in its run, and those after it, each one string.
LEVEL = "struct<before: string, after: string>"


def leaf_digest(*values: Column) -> Column:
    """Digest of a row: each value as its UTF-8 length, a colon and itself, or ``-`` for null."""
    def field(value: Column) -> Column:
        held = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(held).cast("string"), F.lit(":"), held), F.lit("-"))

    return F.sha2(F.concat(*map(field, values)), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the levels of its path lead to."""
    return F.aggregate(path, leaf, lambda digest, level: F.sha2(F.concat(level["before"], digest, level["after"]), 256))


def proof(path: Column) -> Column:
    """All digests of a path as one string, level by level, left to right."""
    return F.array_join(F.transform(path, lambda level: F.concat(level["before"], level["after"])), "")


def _numbered(leaves: DataFrame, scratch: Scratch) -> DataFrame:
    """Leaves with their tree's number and size, and their own number in it.

    Trees are numbered by group (nulls first, bytewise), leaves by the columns of ``order``, then digest.
    Rows are sorted by ranges; only totals of (group, range) and of ranges are summed up beyond that.
    """
    spark = leaves.sparkSession
    order = [F.col("group").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf"), F.col("place")]
    ranged = leaves.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    ranged = scratch.cut(ranged.drop("place").withColumn("at", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("part", F.shiftright("at", 33))  # the partition stands in the upper bits

    spans = scratch.cut(ranged.groupBy("group", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows")), "spans")
    groups = spans.groupBy("group").agg(F.min("first").alias("start"), F.sum("rows").alias("n"))
    groups = groups.withColumn("part", F.shiftright("start", 33))
    starts = groups.groupBy("part").agg(F.count(F.lit(1)).alias("here"))  # a row for each range that a group starts in
    starts = starts.select(
        "part", F.coalesce(F.sum("here").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("earlier"),
        F.sum("here").over(W.partitionBy()).alias("trees"))
    inside = F.row_number().over(W.partitionBy("part").orderBy("start")) - 1
    trees = groups.withColumn("inside", inside).join(starts, "part").select(
        F.col("group").alias("tree_group"), (F.col("earlier") + F.col("inside")).alias("tree"), "n", "trees")

    before = F.sum("rows").over(W.partitionBy("group").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    spans = spans.withColumn("before", F.coalesce(before, F.lit(0)))
    spans = spans.join(trees, F.col("group").eqNullSafe(F.col("tree_group"))).select(
        F.col("group").alias("span_group"), F.col("part").alias("span_part"), "first", "before", "tree", "n", "trees")
    return ranged.join(spans, F.col("group").eqNullSafe(F.col("span_group")) & (F.col("part") == F.col("span_part"))).select(
        "tree", (F.col("before") + F.col("at") - F.col("first")).alias("i"), "n", "trees", F.col("leaf").alias("digest"), "row")


def _pop(queue: DataFrame, fanout: int) -> DataFrame:
    """The nodes of one level with their children, from the messages of the level below."""
    rest = [c for c in queue.columns if c not in ("tree", "i", "n")]
    kids = F.sort_array(F.collect_list(F.struct("i", *rest)))  # at most ``fanout``, one for each i
    nodes = queue.filter("n > 1").groupBy("tree", F.expr(f"i div {fanout}").alias("node"), "n").agg(kids.alias("kids"))
    return nodes.withColumn("digest", F.sha2(F.array_join(F.transform("kids", lambda k: k["digest"]), ""), 256))


def _forward(queue: DataFrame, most: int, fanout: int, scratch: Scratch) -> tuple[list[DataFrame], DataFrame]:
    """Nodes by level from the lowest, and the top digest of each tree; ``most`` is the largest tree's size."""
    levels, tops = [], queue.filter("n = 1").select("tree", "digest")
    while most > 1:
        nodes = scratch.cut(_pop(queue, fanout), f"level{len(levels) + 1}")
        levels.append(nodes)
        queue = nodes.select("tree", F.col("node").alias("i"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"), "digest")
        tops = tops.unionByName(queue.filter("n = 1").select("tree", "digest"))
        most = -(-most // fanout)
    return levels, tops


def _backward(levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """Children of the lowest level with the path above them; ``tops`` has that of each tree's top."""
    known = [c for c in tops.columns if c not in ("tree", "path")]
    below = None
    for nodes in reversed(levels):
        nodes = nodes.select("tree", "node", "n", "kids")
        held = nodes.filter(f"n <= {fanout}").join(tops, "tree")
        if below is not None:
            held = held.unionByName(nodes.filter(f"n > {fanout}").join(below.withColumnRenamed("i", "node").select("tree", "node", "path", *known), ["tree", "node"]))
        digests = F.transform("kids", lambda k: k["digest"])
        beside = F.struct(
            F.array_join(F.slice("digests", F.lit(1), F.col("place")), "").alias("before"),
            F.array_join(F.slice("digests", F.col("place") + 2, F.lit(fanout)), "").alias("after"))
        below = held.select("tree", "path", *known, digests.alias("digests"), F.posexplode("kids").alias("place", "kid")).select(
            "tree", "kid.*", F.concat(F.array(beside), F.col("path")).alias("path"), *known)
    return below


def manifest(docs: DataFrame, group: str, key: str, leaf: Column, carry: dict[str, Column], fanout: int = 16) -> DataFrame:
    """Every row's leaf, subroot, root and path in a Merkle tree of ``fanout`` children a node.

    Rows of a ``group`` ascend by ``key`` (nulls first; equal keys by digest): while several nodes are
    left, runs of ``fanout`` become the digest of their digests' concatenation. The groups' subroots,
    nulls first and bytewise, likewise give the root. Null groups are one group of their own; repeated
    rows are leaves each; a lone leaf is its group's subroot, a lone subroot the root; an empty table
    gives no rows. Only the columns asked for are read, so names of others don't matter.
    Result: the columns of ``carry``, leaf, subroot, root, path (levels from the leaf up).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    leaves = docs.select(
        F.col(group).alias("group"), F.col(key).alias("key"), leaf.alias("leaf"), F.struct(*[v.alias(k) for k, v in carry.items()]).alias("row"),
        F.monotonically_increasing_id().alias("place"))
    leaves = scratch.cut(leaves, "leaves")
    queue = scratch.cut(_numbered(leaves, scratch), "queue")
    most, trees = queue.agg(F.max("n"), F.max("trees")).first()
    levels, subroots = _forward(queue.drop("trees"), most or 0, fanout, scratch)
    subroots = scratch.cut(subroots, "subroots")
    above, roots = _forward(
        subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("i"), F.lit(trees or 0).cast("long").alias("n"), "digest"), trees or 0, fanout, scratch)

    # The reversed sweep: from the root to the subroots, then from these to the leaves.
    tops = roots.select("tree", F.col("digest").alias("root"), F.lit(None).cast(f"array<{LEVEL}>").alias("path"))
    tops = tops.withColumn("path", F.coalesce("path", F.array().cast(f"array<{LEVEL}>")))
    if above:
        ways = _backward(above, tops, fanout).select(F.col("i").alias("tree"), F.col("digest").alias("subroot"), "root", "path")
    else:  # one tree at most
        ways = subroots.join(tops, "tree").select("tree", F.col("digest").alias("subroot"), "root", "path")
    alone = queue.filter("n = 1").select("tree", "digest", "row").join(ways, "tree").select("digest", "row", "subroot", "root", "path")
    found = alone
    if levels:
        found = _backward(levels, ways, fanout).select("digest", "row", "subroot", "root", "path").unionByName(alone)
    return found.select("row.*", F.col("digest").alias("leaf"), "subroot", "root", "path")
