"""Merkle manifest of a table: a tree of digests for each language, a tree over their roots, and proofs that climb them.

A leaf is the digest of a row's fields. Leaves of a language ascend by ``doc_id``; every ``run`` neighbours become the
digest of their digests until one is left, the language's root; these roots, in order of the language, likewise give the
root of the table. Digests are hex text and are hashed as such.

Levels are built ``height`` at a time: ``run ** height`` neighbours form a block, one row that holds its levels. Each
child of a block is a node row: its digest, the siblings of every level up to the block's top, and a link to that top,
which is a node of the block above. Proofs are one recursive query over these links, so a table of 10**9 rows takes
three steps. No group outgrows a block; a node above many leaves is copied for each ``SHARE`` of them, so that no join
key is hot, and no link is broadcast unless it is small.

Rows of one ``doc_id`` ascend by leaf. A null id comes first and is never tampered with. An empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millwright.session import cut

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree over the languages' roots; languages are numbered from 0.
TOP = -1
#: Leaves that one copy of a node serves.
SHARE = 1 << 16

CLIMB = """
WITH RECURSIVE climb(doc_id, leaf, place, subroot, tree, stride, node, share, siblings, folded) MAX RECURSION LEVEL {levels} AS (
  SELECT doc_id, leaf, place, CAST(NULL AS STRING), tree, stride, node, share, siblings, folded FROM {leaves}
  UNION ALL
  SELECT c.doc_id, c.leaf, c.place, if(n.tree = -1 AND n.stride = 0, n.digest, c.subroot), n.up_tree, n.up_stride, n.up_node,
         pmod(c.place, n.up_copies), concat(c.siblings, n.siblings),
         aggregate(n.path, c.folded, (held, step) -> sha2(concat(step.before, held, step.after), 256))
  FROM climb c JOIN {nodes} n ON n.tree = c.tree AND n.stride = c.stride AND n.node = c.node AND n.share = c.share)
SELECT doc_id, leaf, subroot, sha2(siblings, 256) AS proof_sha256, folded AS folded_root FROM climb WHERE tree IS NULL"""


def digest(values: Sequence[Column]) -> Column:
    """The digest of a row: each value ``-`` if null, else its length in bytes, ``:`` and the value."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text)), 256)


def leaves(documents: DataFrame, tampered: Column) -> DataFrame:
    """``doc_id, lang, leaf, shown``: the digest of each row, and that of the row as it is shown, one character longer where ``tampered``."""
    true = digest([F.col(c) for c in FIELDS])
    longer = digest([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS])
    shown = F.when(F.coalesce(tampered, F.lit(False)), longer)
    return documents.select("doc_id", "lang", true.alias("leaf"), shown.alias("shown"))


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``df`` in order, cut at ranges that Spark samples, and for each range and group its first row, rows before and rows of the group.

    Rows that are equal throughout are cut apart by their place in the input, so a row repeated many times is no hot range.
    """
    keys = [*group, *order, "_row"]
    rows = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = cut(rows.drop("_row").withColumn("_id", F.monotonically_increasing_id()))
    rows = rows.withColumn("_range", F.shiftright("_id", 33))
    counts = rows.groupBy(*group, "_range").agg(F.min("_id").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(*group)
    before = F.sum("_rows").over(whole.orderBy("_range")) - F.col("_rows")
    return rows, cut(counts.select(*group, "_range", "_first", before.alias("_before"), F.sum("_rows").over(whole).alias("of")))


def placed(rows: DataFrame, counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """``rows`` with ``at``, the place in the group from 0, and what ``counts`` says of the group."""
    counts = counts.withColumnsRenamed({c: f"_{c}" for c in [*group, "_range"]})
    here = reduce(and_, (rows[c].eqNullSafe(counts[f"_{c}"]) for c in group), rows._range == counts.__range)
    at = F.col("_id") - F.col("_first") + F.col("_before")
    return rows.join(counts, here).withColumn("at", at).drop("_id", "_range", "__range", "_first", "_before", *(f"_{c}" for c in group))


class Tree:
    """How many neighbours make a digest, and how many levels a block."""

    def __init__(self, run: int, height: int) -> None:
        if run < 2 or height < 1:
            raise ValueError("a tree needs runs of two or more, and blocks of one level or more")
        self.run, self.height, self.size = run, height, run**height

    def strides(self, count: int) -> int:
        """Blocks above one another until ``count`` nodes are one."""
        n = 1
        while count > self.size:
            count, n = -(-count // self.size), n + 1
        return n

    def blocks(self, nodes: DataFrame, *also: str) -> DataFrame:
        """``tree, block, of, children, levels, rise, leaves`` from ``tree, at, of, digest, leaves``: each block with its levels, of which ``rise`` lie above the children."""
        child = F.struct("at", "digest", "leaves", *also)
        grouped = nodes.groupBy("tree", "of", F.expr(f"at div {self.size}").alias("block")).agg(F.sort_array(F.collect_list(child)).alias("children"), F.sum("leaves").alias("leaves"))
        # A tree of one block ends where one node is left; any other block rises by its whole height.
        rise = reduce(lambda a, b: a + b, ((F.col("of") > F.lit(self.run**k)).cast("int") for k in range(self.height)))
        grouped = grouped.withColumn("rise", rise).withColumn("_0", F.expr("transform(children, c -> c.digest)"))
        for k in range(self.height):
            runs = f"transform(sequence(0, (size(_{k}) - 1) div {self.run}), i -> sha2(array_join(slice(_{k}, i * {self.run} + 1, {self.run}), ''), 256))"
            grouped = grouped.withColumn(f"_{k + 1}", F.expr(f"if({k} < rise, {runs}, array())"))
        return grouped.withColumn("levels", F.array(*(f"_{k}" for k in range(self.height + 1)))).drop(*(f"_{k}" for k in range(self.height + 1)))

    def nodes(self, blocks: DataFrame, stride: int, *also: str) -> DataFrame:
        """The children as node rows: ``path`` and ``siblings`` up to the block's top, and the link to that top as a node."""
        one = blocks.select("*", F.explode("children").alias("c")).withColumn("_p", F.expr(f"CAST(c.at - block * {self.size} AS INT)"))
        powers = f"array({', '.join(str(self.run**k) for k in range(self.height))})"
        own = f"(_p div {powers}[k])"
        # "before" and "after" are a run's other digests.
        step = (
            f"transform(if(rise > 0, sequence(0, rise - 1), array()), k -> named_struct("
            f"'before', array_join(slice(levels[k], CAST({own} - {own} % {self.run} + 1 AS INT), CAST({own} % {self.run} AS INT)), ''), "
            f"'after', array_join(slice(levels[k], CAST({own} + 2 AS INT), CAST({self.run} - 1 - {own} % {self.run} AS INT)), '')))"
        )
        last = F.col("of") <= self.size
        one = one.withColumn("path", F.expr(step)).withColumn("siblings", F.expr("array_join(transform(path, s -> concat(s.before, s.after)), '')"))
        return one.select(
            "tree", F.lit(stride).alias("stride"), F.col("c.at").alias("node"), F.col("c.digest").alias("digest"), F.col("c.leaves").alias("leaves"), "path", "siblings",
            F.when(~last, F.col("tree")).when(F.col("tree") != TOP, F.lit(TOP)).cast("bigint").alias("up_tree"),
            F.when(last, F.lit(0)).otherwise(F.lit(stride + 1)).alias("up_stride"),
            F.when(last, F.col("tree")).otherwise(F.col("block")).alias("up_node"),
            _copies("leaves").alias("up_copies"),
            *(F.col(f"c.{a}").alias(a) for a in also),
        )

    def tops(self, blocks: DataFrame, done: bool) -> DataFrame:
        """The blocks' tops: the nodes of the stride above, or those with nothing above them in their tree."""
        last = F.col("of") <= self.size
        top = blocks.where(last if done else ~last)
        return top.select("tree", F.col("block").alias("at"), F.ceil(F.col("of") / self.size).cast("bigint").alias("of"), F.expr("levels[rise][0]").alias("digest"), "leaves")


def _copies(leaves: str) -> Column:
    return F.expr(f"CAST(({leaves} + {SHARE - 1}) div {SHARE} AS BIGINT)")


class Manifest:
    """The written tree: ``leaf_rows`` and ``node_rows`` with their links, the table's ``root``, and the steps that a proof takes."""

    def __init__(self, leaf_rows: DataFrame, node_rows: DataFrame, root: str | None, steps: int) -> None:
        self.leaf_rows, self.node_rows, self.root, self.steps = leaf_rows, node_rows, root, steps


def build(rows: DataFrame, run: int = 2, height: int = 10) -> Manifest:
    """The manifest of ``rows`` (doc_id, lang, leaf, shown). Only the root and two counts come to the driver."""
    shape = Tree(run, height)
    sorted_rows, counts = ranked(rows.select("doc_id", "lang", "leaf", "shown"), ["lang"], ["doc_id", "leaf"])
    trees = placed(*ranked(counts.select("lang").distinct(), [], ["lang"]), []).select(F.col("lang").alias("_l"), F.col("at").alias("tree"))
    counts = cut(counts.join(trees, counts.lang.eqNullSafe(trees._l)).drop("_l"))
    largest, languages = counts.agg(F.max("of"), F.max("tree") + 1).first()
    level = placed(sorted_rows, counts, ["lang"]).withColumnRenamed("leaf", "digest").withColumn("leaves", F.lit(1).cast("bigint"))

    first = cut(shape.blocks(level, "doc_id", "shown"))
    leaf_rows = shape.nodes(first, 0, "doc_id", "shown")
    nodes, roots, blocks, strides = [], [shape.tops(first, done=True)], first, shape.strides(largest or 1)
    for stride in range(1, strides):
        blocks = cut(shape.blocks(shape.tops(blocks, done=False)))
        nodes.append(shape.nodes(blocks, stride))
        roots.append(shape.tops(blocks, done=True))

    level = reduce(DataFrame.unionByName, roots).select(
        F.lit(TOP).cast("bigint").alias("tree"), F.col("tree").alias("at"), F.lit(languages or 1).cast("bigint").alias("of"), "digest", "leaves")
    upper = shape.strides(languages or 1)
    for stride in range(upper):
        blocks = cut(shape.blocks(level))
        nodes.append(shape.nodes(blocks, stride))
        level = shape.tops(blocks, done=False)
    root = shape.tops(blocks, done=True).select("digest").first()
    return Manifest(leaf_rows, cut(reduce(DataFrame.unionByName, nodes)), root[0] if root else None, strides + upper)


def climb(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """``doc_id, leaf, subroot, proof_sha256, folded_root`` of every leaf, by one recursive query over the links.

    The fold starts from the leaf as it is shown. The limit of rows that Spark sets to recursive queries is lifted for the session.
    """
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    fold = F.expr("aggregate(path, coalesce(shown, digest), (held, step) -> sha2(concat(step.before, held, step.after), 256))")
    start = manifest.leaf_rows.select(
        "doc_id", F.col("digest").alias("leaf"), F.col("node").alias("place"), F.col("up_tree").alias("tree"), F.col("up_stride").alias("stride"),
        F.col("up_node").alias("node"), F.pmod("node", "up_copies").alias("share"), "siblings", fold.alias("folded"))
    copies = manifest.node_rows.withColumn("share", F.explode(F.sequence(F.lit(0).cast("bigint"), _copies("leaves") - 1)))
    return spark.sql(CLIMB, levels=manifest.steps + 1, leaves=start, nodes=copies)


def verify(documents: DataFrame, tampered: Column, run: int = 2, height: int = 10) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row: its proof in the manifest of the rows as they are,
    and the root that its proof gives for the row as it is shown."""
    manifest = build(leaves(documents, tampered), run, height)
    found = climb(documents.sparkSession, manifest).withColumn("root", F.lit(manifest.root).cast("string"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
