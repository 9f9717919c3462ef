"""A Merkle manifest of a dataset as a content-addressed graph, with proofs by descent.

Rows are leaves; within a group leaves are in the order of their ids, and every ``FAN`` nodes
become their parent until one is left, the group's subroot. Subroots, in the order of their
groups, become the root likewise. A node's digest is that of its children's hexadecimal digests, and
what is stored is one record for each inner node: its digest and its children's.

A proof is found from the root alone. The digits of a group's number and of a leaf's rank in
base ``FAN`` say which child to descend to; the children that are not descended to are the
siblings that the proof needs. Paths are walked for all requests at once, level by level: each
level joins the nodes that any request still passes, once each, with their records, so there
are no more rows than nodes however many leaves lie below, and no node is hot. Segments are
collected from the root down and are reversed to fold a leaf up to the root.

Ranks come from range partitions and not from one window per group, so a group may hold most
rows. Texts are read once, in place; digests are shuffled. Only the number of levels reaches the
driver.

A null in any column is a value of its own (``-`` in a leaf). A null group comes first. Rows of one
group and id are ordered by their leaves; rows that are equal in all columns are leaves of
their own, with equal digests. An empty table has no node, no root and no proof. A null id counts as
not tampered with. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landspark.functions.row_ids import numbered
from landspark.llm.common import Scratch, materialize

#: Children of a node.
FAN = 8


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(columns: list[Column]) -> Column:
    """The digest of values, each by its length in bytes and its text, or ``-`` where null."""
    parts = [c.cast("string") for c in columns]
    return sha(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in parts]))


def _up(nodes: DataFrame) -> DataFrame:
    """``tree, place, digest, children``: the parents of ``tree, place, digest`` (places from 0)."""
    up = nodes.groupBy("tree", F.shiftright("place", 3).alias("place")).agg(F.array_sort(F.collect_list(F.struct("place", "digest")))["digest"].alias("children"))
    return up.select("tree", "place", sha(F.array_join("children", "")).alias("digest"), "children")


def _segment(digit: str) -> Column:
    """The digests to the left and to the right of one of ``children``."""
    return F.array(F.struct(*[F.expr(f"array_join({part}, '')").alias(side) for side, part in (("left", f"slice(children, 1, {digit})"), ("right", f"slice(children, {digit} + 2, {FAN})"))]))


class Manifest:
    """The stored records of a dataset's graph.

    ``nodes``: ``digest, children`` of inner nodes, once for each digest. ``trees``: ``tree, group, levels,
    subroot`` of each group, with its number in the order of groups. ``leaves``: the rows with ``tree`` and
    ``rank``. ``root`` lies ``top_levels`` above the subroots; trees have ``levels`` at most.
    """

    #: The number of the tree that has the subroots for leaves.
    TOP = -1

    def __init__(self, nodes: DataFrame, trees: DataFrame, leaves: DataFrame, root: str | None, top_levels: int, levels: int):
        self.nodes, self.trees, self.leaves, self.root, self.top_levels, self.levels = nodes, trees, leaves, root, top_levels, levels

    @classmethod
    def build(cls, rows: DataFrame, group: str, key: str) -> Manifest:
        """The manifest of ``rows``, which have a digest in the column ``leaf``; other columns are carried along."""
        ranked = numbered(rows, [group, key, "leaf"], "_n", first=0)
        with Scratch(rows.sparkSession) as write:
            groups = ranked.groupBy(F.col(group).alias("group")).agg(F.count("*").alias("size"), F.min("_n").alias("first"))
            levels = F.lit(0)
            for k in range(20):
                levels = F.when(F.col("size") > FAN**k, k + 1).otherwise(levels)
            trees = write(numbered(groups, ["group"], "tree", first=0).withColumn("levels", levels), "trees")
            known = trees.select(F.col("group").alias("_group"), "tree", "first")
            leaves = ranked.join(known, F.col(group).eqNullSafe(F.col("_group"))).withColumn("rank", F.col("_n") - F.col("first"))
            leaves = materialize(leaves.drop("_n", "_group", "first"), "leaves")
            most, n = trees.agg(F.max("levels"), F.count("*")).first()
            level, subroots, records = leaves.select("tree", F.col("rank").alias("place"), F.col("leaf").alias("digest")), [], []
            for k in range((most or 0) + 1):
                is_done = trees.select("tree", (F.col("levels") == k).alias("is_done"))
                level = level.join(is_done, "tree")
                subroots.append(level.filter("is_done").select("tree", "digest"))
                if k < (most or 0):
                    level = write(_up(level.filter("NOT is_done")), "level")
                    records.append(level.select("digest", "children"))
            trees = materialize(trees.join(reduce(DataFrame.unionByName, subroots), "tree").select("tree", "group", "levels", F.col("digest").alias("subroot")), "trees")
            level, top = trees.select(F.lit(cls.TOP).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("subroot").alias("digest")), 0
            while FAN**top < n:
                level, top = write(_up(level), "level"), top + 1
                records.append(level.select("digest", "children"))
            root = level.select("digest").first()
            none = rows.sparkSession.createDataFrame([], "digest string, children array<string>")
            nodes = materialize(reduce(DataFrame.unionByName, records, none).dropDuplicates(["digest"]), "nodes")
        return cls(nodes, trees, leaves, root and root["digest"], top, most or 0)

    def _passed(self, requests: DataFrame, write: Callable) -> DataFrame:
        """``tree, height, place``: the nodes on the way to any request, once each."""
        sets = []
        for own, top in ((requests.select("tree", F.col("rank").alias("place")), False), (requests.select(F.lit(self.TOP).cast("long").alias("tree"), F.col("tree").alias("place")), True)):
            for height in range((self.top_levels if top else self.levels) + 1):
                if height:
                    own = own.select("tree", F.shiftright("place", 3).alias("place"))
                if height or top:  # single leaves are not looked up
                    own = write(own.distinct(), "passed")
                    sets.append(own.withColumn("height", F.lit(height)))
        return reduce(DataFrame.unionByName, sets)

    def prove(self, requests: DataFrame | None = None) -> DataFrame:
        """``requests`` (``tree, rank`` and other columns) with ``path``: each level's siblings, from the leaf up.

        A segment has the digests of the siblings to the left and to the right, concatenated. A request
        for a leaf that doesn't exist has no row. Without requests all leaves are asked for, so that no
        node need be left out on the way.
        """
        spark = self.leaves.sparkSession
        with Scratch(spark) as write:
            passed = None if requests is None else self._passed(requests, write)
            requests = self.leaves if requests is None else requests

            def children(at: DataFrame) -> DataFrame:
                kids = at.join(self.nodes, "digest").select("tree", "place", "height", "path", "children", F.posexplode("children").alias("digit", "kid"))
                path = F.concat("path", _segment("digit"))
                kids = kids.select("tree", (F.col("place") * FAN + F.col("digit")).alias("place"), (F.col("height") - 1).alias("height"), F.col("kid").alias("digest"), path.alias("path"))
                return write(kids if passed is None else kids.join(passed, ["tree", "height", "place"], "left_semi"), "paths")

            start = {"digest": F.lit(self.root), "tree": F.lit(self.TOP).cast("long"), "place": F.lit(0).cast("long"), "height": F.lit(self.top_levels)}
            start["path"] = F.expr("CAST(array() AS array<struct<left: string, right: string>>)")
            at = spark.range(0 if self.root is None else 1).select(*[c.alias(n) for n, c in start.items()])
            for _ in range(self.top_levels):
                at = children(at)
            # a subroot is the top of its own tree
            at = at.select("digest", "path", F.col("place").alias("tree"), F.lit(0).cast("long").alias("place")).join(self.trees.select("tree", F.col("levels").alias("height")), "tree")
            ends = [at.filter("height = 0").withColumn("children", F.array("digest"))]
            for k in range(self.levels, 0, -1):
                ends.append(at.filter("height = 1").join(self.nodes, "digest").select(*ends[0].columns))
                if k > 1:
                    at = children(at.filter("height > 1"))
            last = reduce(DataFrame.unionByName, ends).select(F.col("tree").alias("_tree"), F.col("place").alias("_place"), "height", "path", "children")
            asked = requests.withColumn("_digit", (F.col("rank") % FAN).cast("int"))
            found = asked.join(last, (F.col("tree") == F.col("_tree")) & (F.shiftright("rank", 3) == F.col("_place"))).filter("_digit < size(children)")
            path = F.when(F.col("height") > 0, F.concat("path", _segment("_digit"))).otherwise(F.col("path"))
            return materialize(found.select(*requests.columns, F.reverse(path).alias("path")), "proofs")


def siblings(path: Column) -> Column:
    """The digests of a proof, from the leaf up and from left to right, concatenated."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(path, leaf, lambda digest, s: sha(F.concat(s["left"], digest, s["right"])))
