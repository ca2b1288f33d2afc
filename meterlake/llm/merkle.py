"""A Merkle tree over the rows of a dataset, source by source.

A row's leaf is the hash of its columns, each with its length in front. Leaves
of a source ascend by id; runs of three nodes become their hash until one is
left, the source's root. The roots of all sources, in order of source, become
the dataset's root in the same way.

Nodes are numbered along a range partitioning by (group, order) and cut into
aligned blocks of ``FAN ** LEVELS``. A block keeps each of its levels as one
string of hex digests, so a parent is the hash of a fixed-width substring, and
the siblings of a node are the substrings on either side of it in its run. The
blocks' own nodes are the next round's leaves: every round shrinks a group by
the size of a block, and a source of any size is spread over as many blocks.
Rounds are written to shared storage. On the way back, a block's path (the
siblings from its node to the root) is handed to its nodes, once per block.

A null column is ``-``. A null source is a source of its own, before all
others; a null id comes before all others. Rows of one source and id are in
order of their leaf (rows alike in every column are interchangeable). An empty
table has no root and no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import stage

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
FAN, LEVELS = 3, 5
BLOCK = FAN ** LEVELS
HEX = 64
RUN = FAN * HEX


def digest(c: Column) -> Column:
    return F.sha2(c, 256)


def leaf(fields: list[Column]) -> Column:
    """Hash of the fields' texts: ``-`` for null, else byte count, ``:``, value."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-"))
             for f in fields]
    return digest(F.concat(*parts))


def group_key(source: Column) -> Column:
    """A text that orders null before all sources, and these by their bytes."""
    return F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source))


def numbered(nodes: DataFrame, order: list[str]) -> DataFrame:
    """``nodes`` (group, node, ...) with ``idx``, the place in the group by
    ``order``, and ``total``, the group's size. A range partition is numbered
    by itself; a group's partitions, few and small, are summed up in order."""
    placed = stage(nodes.repartitionByRange("group", *order).withColumn("_part", F.spark_partition_id()), "ordered_nodes")
    sizes = placed.groupBy("group", "_part").agg(F.count("*").alias("_n"))
    by_part = Window.partitionBy("group").orderBy("_part")
    offsets = sizes.select("group", "_part", (F.sum("_n").over(by_part) - F.col("_n")).alias("_before"),
                           F.sum("_n").over(Window.partitionBy("group")).alias("total"))
    own = F.row_number().over(Window.partitionBy("group", "_part").orderBy(*order)) - 1
    ranked = placed.withColumn("_own", own)
    return ranked.join(offsets, ["group", "_part"]).withColumn("idx", F.col("_before") + F.col("_own")).drop(
        "_before", "_own", "_part")


def _parents(level: Column) -> Column:
    """The next level's string: every run of a level hashed."""
    last = ((F.length(level) - 1) / RUN).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), last), lambda i: digest(F.substring(level, i * RUN + 1, F.lit(RUN)))), "")


def _levels(blocks: DataFrame) -> DataFrame:
    """Columns l0..l<LEVELS>: a block of a group with several blocks goes up
    all levels, the only block of a group until one node is left (null after)."""
    for t in range(LEVELS):
        level = F.col(f"l{t}")
        blocks = blocks.withColumn(f"l{t + 1}", F.when((F.col("total") > BLOCK) | (F.length(level) > HEX), _parents(level)))
    top = F.coalesce(*[F.col(f"l{t}") for t in range(LEVELS, -1, -1)])
    return blocks.withColumn("top", top)


def _blocks(nodes: DataFrame, keep: list[str], name: str) -> DataFrame:
    """Nodes (group, idx, total, node, keep...) as blocks: their members in
    order, the level strings and the node on top. ``total`` is the same for
    all nodes of a group."""
    member = F.struct((F.col("idx") % BLOCK).cast("int").alias("at"), "node", *keep)
    b = nodes.groupBy("group", F.expr(f"idx div {BLOCK}").alias("block")).agg(
        F.sort_array(F.collect_list(member)).alias("members"), F.first("total").alias("total"))
    b = b.withColumn("l0", F.array_join(F.col("members.node"), ""))
    return stage(_levels(b), name)


def _siblings(level: str, at: Column) -> tuple[Column, Column]:
    """What stands left and right of node ``at`` in its run of a level."""
    run = F.substring(F.col(level), (at / FAN).cast("int") * RUN + 1, F.lit(RUN))
    own = (at % FAN) * HEX
    return F.substring(run, F.lit(1), own), F.substring(run, own + HEX + 1, F.lit(RUN))


def _own_path(at: Column) -> Column:
    """Siblings of member ``at`` inside its block, level by level."""
    steps = []
    for t in range(LEVELS):
        left, right = _siblings(f"l{t}", (at / FAN ** t).cast("int"))
        steps.append(F.when(F.col(f"l{t + 1}").isNotNull(), F.struct(left.alias("left"), right.alias("right"))))
    return F.array_compact(F.array(*steps))


_PATH = "array<struct<left:string,right:string>>"


def _members(blocks: DataFrame, keep: list[str], carry: list[str]) -> DataFrame:
    """One row per member with its path to the root: its own in the block, then
    the block's ``path``; ``carry`` are columns of the block."""
    levels = [f"l{t}" for t in range(LEVELS + 1)]
    m = blocks.select("group", "block", "path", *carry, *levels, F.explode("members").alias("m"))
    path = F.concat(_own_path(F.col("m.at")).cast(_PATH), F.col("path"))
    return m.select("group", (F.col("block") * BLOCK + F.col("m.at")).alias("idx"), F.col("m.node").alias("node"),
                    *[F.col(f"m.{k}").alias(k) for k in keep], path.alias("path"), *carry)


class Tree:
    """The trees of all groups of ``nodes`` (group, node and columns to keep),
    each in ``order``."""

    def __init__(self, nodes: DataFrame, order: list[str], keep: list[str]):
        self.keep = keep
        self.rounds = [_blocks(numbered(nodes, order), keep, "merkle_blocks")]
        while True:
            more = self.rounds[-1].filter(F.col("total") > BLOCK)
            if more.isEmpty():
                break
            up = more.select("group", F.col("block").alias("idx"), F.col("top").alias("node"),
                             F.expr(f"(total + {BLOCK - 1}) div {BLOCK}").alias("total"))
            self.rounds.append(_blocks(up, [], "merkle_blocks"))

    def roots(self) -> DataFrame:
        """(group, root)."""
        out = None
        for r in self.rounds:
            done = r.filter(F.col("total") <= BLOCK).select("group", F.col("top").alias("root"))
            out = done if out is None else out.unionByName(done)
        return out

    def paths(self, above: DataFrame) -> DataFrame:
        """(group, idx, node, keep..., path, ...): siblings up to the group's
        root, then the group's own path. ``above``: (group, path) and columns
        that every node of the group gets. Joined per block, not per node."""
        carry = [c for c in above.columns if c not in ("group", "path")]
        upper = None
        for n in range(len(self.rounds) - 1, -1, -1):
            r = self.rounds[n]
            ready = r.filter(F.col("total") <= BLOCK).join(above, "group")
            if upper is not None:
                inner = r.filter(F.col("total") > BLOCK).join(
                    upper.select("group", F.col("idx").alias("block"), "path", *carry), ["group", "block"])
                ready = ready.unionByName(inner)
            if n == 0:
                return _members(ready, self.keep, carry)
            upper = stage(_members(ready, [], carry), "merkle_paths")
        raise AssertionError("no round")


def fold(node: Column, path: Column) -> Column:
    """The root recomputed from a node and its siblings."""
    return F.aggregate(path, node, lambda acc, x: digest(F.concat(x["left"], acc, x["right"])))


def proof_text(path: Column) -> Column:
    """The siblings of a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), "")


def manifest(rows: DataFrame, id_col: str, group: Column, leaf_col: Column, extra: dict[str, Column] | None = None) -> DataFrame:
    """(id, group, leaf, extra..., subroot, root, path) for every row."""
    extra = extra or {}
    leaves = stage(rows.select(F.col(id_col).alias("id"), group.alias("group"), leaf_col.alias("node"),
                               *[c.alias(k) for k, c in extra.items()],
                               # so that a range of rows alike can be cut as well
                               F.monotonically_increasing_id().alias("tie")), "leaves")
    tree = Tree(leaves, ["id", "node", "tie"], ["id", *extra])
    sources = stage(tree.roots(), "subroots")
    # the sources are the leaves of one more tree, of one group
    top = Tree(sources.select(F.lit("").alias("group"), F.col("root").alias("node"), F.col("group").alias("source")),
               ["source"], ["source"])
    whole = top.roots().withColumn("path", F.array().cast(_PATH))
    above = stage(top.paths(whole).select(F.col("source").alias("group"), F.col("node").alias("subroot"), "root", "path"),
                  "source_paths")
    return tree.paths(above).withColumnRenamed("node", "leaf")


def tampered(doc_id: Column, text: Column) -> Column:
    """The text without line ends where 2 divides the checksum of the decimal
    id; other texts, null ones, and those whose id is null as they are."""
    odd_one = F.crc32(doc_id.cast("string")) % 2 == 0
    return F.when(odd_one, F.translate(text, "\n", "")).otherwise(text)


def audit(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, folded_root): the manifest of
    ``documents``, and the root that each row's text leads to after tampering."""
    cols = [F.col(c) for c in FIELDS]
    changed = leaf([*cols[:-1], tampered(F.col("doc_id"), F.col("text"))])
    m = manifest(docs.select(*FIELDS), "doc_id", group_key(F.col("source")), leaf(cols), {"seen": changed})
    return m.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "path", fold(F.col("seen"), F.col("path")).alias("folded_root"))
