"""Merkle manifest of a dataset, with nested-interval labels.

Every row is a leaf; the leaves of a tree are numbered by rank, and a node
carries the interval [lo, hi) of the leaf ranks that it covers. A node of level
k stands in bucket ``lo / fan ** k`` of its level, so a node finds its parent
by an equality of buckets one level up, checked by containment of the
intervals, and its siblings are the parent's children that lie in the
difference of the two intervals: left of ``lo`` or from ``hi`` on. Levels are
written tables that shrink by ``fan``; a tree of n leaves has
``ceil(log_fan n)`` levels above them, whatever the number of machines.

Ranks come from a sort by range: a row's place in its task minus the first
place of its tree there, plus the tree's rows in the tasks before, of which
there is one number a task and tree. So one tree may hold all rows; groups
hold ``fan`` rows at most. Trees are the languages; their roots are the leaves
of the tree above them, which is built and proved by the same code.

Everything is built of Spark's own functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import few, staged

#: children of a node
FAN = 8
_PLACE_BITS = 33                                    # of monotonically_increasing_id: a row's place in its task


def digest(*parts: Column) -> Column:
    """Lower-case hex sha256 of the parts one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    return digest(*[field(c) for c in columns])


@dataclass
class Forest:
    """Trees over ranked leaves. ``leaves`` (tree, lo, hi, digest and the
    leaves' own columns), ``parents``[k]: the nodes of level k + 1 (tree, lo,
    hi, digest, children), ``roots`` (tree, n, height, digest)."""

    leaves: DataFrame
    parents: list[DataFrame]
    roots: DataFrame
    fan: int

    def nodes(self) -> DataFrame:
        """The manifest: (tree, level, lo, hi, digest) of every node."""
        out = self.leaves.select("tree", F.lit(0).alias("level"), "lo", "hi", "digest")
        for k, level in enumerate(self.parents, 1):
            out = out.unionAll(level.select("tree", F.lit(k), "lo", "hi", "digest"))
        return out


def ranked(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` with ``lo``, their rank in their ``tree`` by ``order`` (nulls
    first), and ``hi``. Rows alike in all of these may come in any order."""
    placed = staged(
        leaves.withColumn("spread", F.monotonically_increasing_id())          # rows alike need not share a task
              .repartitionByRange("tree", *order, "spread").sortWithinPartitions("tree", *order)
              .drop("spread").withColumn("place", F.monotonically_increasing_id()), "merkle-ranked")
    task = F.shiftright("place", _PLACE_BITS).cast("long")
    # a row for each task and tree: as many as tasks and trees together
    runs = placed.groupBy("tree", task.alias("task")).agg(F.min("place").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("tree").orderBy("task")) - F.col("n")
    runs = staged(runs.select("tree", "task", (before - F.col("first")).alias("shift")), "merkle-runs")
    return (placed.withColumn("task", task).join(few(runs), ["tree", "task"])
                  .withColumn("lo", F.col("place") + F.col("shift")).withColumn("hi", F.col("lo") + 1)
                  .drop("task", "place", "shift"))


def bucket(lo: str, level: int, fan: int) -> Column:
    return F.expr(f"{lo} div {fan ** level}")


def build(leaves: DataFrame, order: list[str], fan: int = FAN) -> Forest:
    """The forest of ``leaves`` (tree, digest, the columns of ``order`` and any
    more), each tree's leaves ascending by ``order``."""
    leaves = staged(ranked(leaves, order), "merkle-leaves")
    sizes = leaves.groupBy("tree").agg(F.count("*").alias("n"))
    most = sizes.agg(F.max("n")).first()[0] or 0
    height = 0
    while fan ** height < most:
        height += 1
    # the level at which a tree of n leaves is one node
    levels = sum([(F.col("n") > F.lit(fan ** k)).cast("int") for k in range(height)], F.lit(0))
    sizes = staged(sizes.select("tree", "n", levels.alias("height")), "merkle-sizes")
    parents, below = [], leaves.select("tree", "lo", "hi", "digest")
    for k in range(height):
        grow = few(sizes.where(F.col("height") > k).select("tree"))
        children = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest")))
        level = (below.join(grow, "tree", "left_semi").groupBy("tree", bucket("lo", k + 1, fan).alias("bucket"))
                      .agg(children.alias("children"))
                      .select("tree", F.col("children")[0]["lo"].alias("lo"), F.array_max("children.hi").alias("hi"),
                              digest(F.array_join("children.digest", "")).alias("digest"), "children"))
        parents.append(staged(level, f"merkle-level-{k + 1}"))
        below = parents[-1].select("tree", "lo", "hi", "digest")
    roots = few(sizes.where("height = 0")).join(leaves.select("tree", "digest"), "tree")
    for k, level in enumerate(parents, 1):
        roots = roots.unionByName(sizes.where(F.col("height") == k).join(level.where("lo = 0").select("tree", "digest"), "tree"))
    return Forest(leaves, parents, staged(roots, "merkle-roots"), fan)


def _under(nodes: DataFrame, above: DataFrame, level: int, fan: int) -> DataFrame:
    """Nodes of a level with the path of their parent (run, above) put
    after their own step: the digests left and right of them in its run."""
    n = nodes.withColumn("bucket", bucket("lo", level + 1, fan))
    p = above.select("tree", bucket("lo", level + 1, fan).alias("bucket"), F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), F.col("children").alias("run"), "above")
    both = n.join(p, ["tree", "bucket"]).where("p_lo <= lo and hi <= p_hi")

    def side(keep) -> Column:
        return F.array_join(F.transform(F.filter("run", keep), lambda c: c["digest"]), "")

    step = F.struct(side(lambda c: c["hi"] <= F.col("lo")).alias("left"), side(lambda c: c["lo"] >= F.col("hi")).alias("right"))
    return both.withColumn("path", F.concat(F.array(step), "above")).drop("bucket", "p_lo", "p_hi", "run", "above")


def prove(forest: Forest, tops: DataFrame) -> DataFrame:
    """``forest.leaves`` with ``path``, from the leaf up: the digests left and
    right of each ancestor in its run, array<struct<left, right>>. ``tops``
    (tree, top) holds the path that follows a tree's root."""
    height = len(forest.parents)
    tops = forest.roots.join(tops, "tree").select("tree", "height", "top")
    starts = {k: tops.where(F.col("height") == k).select("tree", F.col("top").alias("path")) for k in range(height + 1)}
    paths = None                                     # of the nodes of the level that is being left
    for k in range(height, -1, -1):
        nodes = forest.parents[k - 1] if k else forest.leaves
        found = nodes.join(few(staged(starts[k], "merkle-tops")), "tree")                  # trees whose root is here
        if paths is not None:
            found = _under(nodes, paths, k, forest.fan).unionByName(found)
        if k:
            paths = staged(found.select("tree", "lo", "hi", "children", F.col("path").alias("above")), f"merkle-path-{k}")
    return found


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path give."""
    return F.aggregate(path, start, lambda h, s: digest(s["left"], h, s["right"]))


def proof(path: Column) -> Column:
    """The siblings' digests, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


@dataclass
class Manifest:
    """The trees of a table, the tree of their roots, and its root's digest."""

    trees: Forest
    top: Forest

    def root(self) -> DataFrame:
        return self.top.roots.select(F.col("digest").alias("root"))

    def nodes(self) -> DataFrame:
        """(part, lang, level, lo, hi, digest): every node of the trees (part
        ``lang``) and of the tree over them (part ``top``, lang null)."""
        return self.trees.nodes().select(F.lit("lang").alias("part"), _lang("tree").alias("lang"), "level", "lo", "hi", "digest").unionAll(
            self.top.nodes().select(F.lit("top"), F.lit(None).cast("string"), "level", "lo", "hi", "digest"))

    def proofs(self) -> DataFrame:
        """Every leaf's columns with leaf, lang, rank, subroot, root, path."""
        empty = F.array().cast("array<struct<left:string,right:string>>")
        root = self.top.roots.select("tree", F.col("digest").alias("root"))                                        # one row
        subroots = prove(self.top, self.top.roots.select("tree", empty.alias("top"))).join(root, "tree")
        tops = staged(subroots.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "root", F.col("path").alias("top")), "merkle-subroots")
        leaves = prove(self.trees, tops.select("tree", "top"))
        return (leaves.join(few(tops.select("tree", "subroot", "root")), "tree")
                      .withColumn("lang", _lang("tree")).withColumnRenamed("digest", "leaf").withColumnRenamed("lo", "rank").drop("tree", "hi"))


def _tree(lang: Column) -> Column:
    """Text that sorts null first and languages bytewise, and joins by equality."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit(""))


def _lang(tree: str) -> Column:
    return F.when(F.col(tree) != "", F.substring(F.col(tree), 2, 1 << 30))


def manifest(docs: DataFrame, extra: dict[str, Column] | None = None, fan: int = FAN) -> Manifest:
    """Leaves of ``docs`` (doc_id, source, lang, n_chars, text), hashed from
    doc_id, source, lang, n_chars and text; a tree for each lang, its leaves
    ascending by doc_id. ``extra`` names more columns, of ``docs``, that the
    leaves carry.

    A null or empty field has its own encoding, so the two differ; null ids
    come first, rows that share an id come by digest, and rows alike are leaves
    of their own; a null lang is a tree of its own before all others; very long
    texts are hashed where they are and not moved; other columns are ignored,
    whatever their names; no rows give no leaves and no root.
    """
    columns = [docs["doc_id"].cast("long"), docs["source"].cast("string"), docs["lang"].cast("string"), docs["n_chars"].cast("long"), docs["text"].cast("string")]
    leaves = docs.select(_tree(columns[2]).alias("tree"), columns[0].alias("doc_id"), leaf_digest(columns).alias("digest"),
                         *[c.alias(n) for n, c in (extra or {}).items()])
    trees = build(staged(leaves, "merkle-hashed"), ["doc_id", "digest"], fan)
    top = build(trees.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"], fan)
    return Manifest(trees, top)


def verify_after(docs: DataFrame, tampered_leaf: Column, fan: int = FAN) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root, verified) per row of
    ``docs``: the proof's siblings as one text, the root recomputed from
    ``tampered_leaf`` (a digest over the columns of ``docs``) and the original
    siblings, and whether it is the root. Odd rows as in ``manifest``."""
    out = manifest(docs, {"claimed": tampered_leaf}, fan).proofs()
    out = out.select("doc_id", "leaf", "subroot", "root", proof(F.col("path")).alias("proof"), folded(F.col("claimed"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
