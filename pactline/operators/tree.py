"""Tag tree as a flat node table.

A line with bit0 opens a node.  Lines with bits 1 stay open, so every later
node nests under the latest of them; bits 3 nodes are leaves; a final
bits 2 line closes the innermost open node (or the root).  Hence

* parent = last bits-1 line before i (root = -1),
* depth = 1 + number of bits-1 lines before i,
* depth never falls along the document, so breadth-first order (depth, i)
  and the per-child walk order both equal document order.

The "last" and "count before" scans use the chunk carry of ``segments``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pactline.operators import segments as S
from pactline.operators.tagger import tag_parts

TAGS = ("title", "s", "l", "p")
NODE = "struct<node_pos:int,tag:string,depth:bigint,top_ancestor:int,bfs_rank:bigint,child_walk_rank:bigint>"


def _tree_columns(y: DataFrame, parent, depth, d_last1, d_first1, node_rank, tag_rank) -> DataFrame:
    closes = (F.col("tot") > 0) & (F.col("tot") % 2 == 0)
    cl_pos = F.when(closes & (F.col("i") == d_last1), F.col("n") - 1).otherwise(F.col("i"))
    # The depth-1 ancestor: the node itself at depth 1, else the first bits-1 node.
    top = F.when(depth == 1, F.col("i")).otherwise(d_first1)
    return y.select("doc_id", "i", "tag", "bits", "n", "tot", _is_node().alias("is_node"),
                    parent.alias("parent_pos"), depth.alias("depth"), cl_pos.alias("cl_pos"),
                    node_rank.alias("node_rank"), tag_rank.alias("tag_rank"), top.alias("top_ancestor"))


def _is_node():
    return F.col("bits").isin(1, 3)


def _per_tag_running():
    return (Window.partitionBy(*S.KEYS, "tag").orderBy("i")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _nodes_single(tagged: DataFrame) -> DataFrame:
    one = F.col("bits") == 1
    whole = Window.partitionBy(*S.KEYS)
    prev = S.before("g")  # g = i + 1 keeps the order the tagger left
    return _tree_columns(
        tagged,
        parent=F.coalesce(F.max(F.when(one, F.col("i"))).over(prev), F.lit(-1)),
        depth=1 + F.coalesce(S.count_if(one).over(prev), F.lit(0)),
        d_last1=F.max(F.when(one, F.col("i"))).over(whole),
        d_first1=F.min(F.when(one, F.col("i"))).over(whole),
        node_rank=S.count_if(_is_node()).over(S.running("g")),
        tag_rank=S.count_if(_is_node()).over(_per_tag_running()))


def _nodes_multi(tagged: DataFrame) -> DataFrame:
    one = F.col("bits") == 1
    node = _is_node()
    cs = tagged.groupBy(*S.KEYS).agg(
        S.count_if(one).alias("c_ones"),
        F.max(F.when(one, F.col("i"))).alias("c_last1"),
        F.min(F.when(one, F.col("i"))).alias("c_first1"),
        S.count_if(node).alias("c_nodes"),
        *[S.count_if(node & (F.col("tag") == t)).alias(f"c_{t}") for t in TAGS])
    cs = cs.select(
        *S.KEYS,
        F.coalesce(F.sum("c_ones").over(S.prev_chunks()), F.lit(0)).alias("ones_before"),
        F.max("c_last1").over(S.prev_chunks()).alias("last1_before"),
        F.max("c_last1").over(S.doc()).alias("d_last1"),
        F.min("c_first1").over(S.doc()).alias("d_first1"),
        F.coalesce(F.sum("c_nodes").over(S.prev_chunks()), F.lit(0)).alias("nodes_before"),
        *[F.coalesce(F.sum(f"c_{t}").over(S.prev_chunks()), F.lit(0)).alias(f"{t}_before") for t in TAGS])
    y = tagged.join(cs, S.KEYS)
    prev = S.before("i")
    tag_before = F.coalesce(*[F.when(F.col("tag") == t, F.col(f"{t}_before")) for t in TAGS])
    return _tree_columns(
        y,
        parent=F.coalesce(F.max(F.when(one, F.col("i"))).over(prev), F.col("last1_before"), F.lit(-1)),
        depth=1 + F.col("ones_before") + F.coalesce(S.count_if(one).over(prev), F.lit(0)),
        d_last1=F.col("d_last1"), d_first1=F.col("d_first1"),
        node_rank=F.col("nodes_before") + S.count_if(node).over(S.running("i")),
        tag_rank=tag_before + S.count_if(node).over(_per_tag_running()))


def line_frame(lines: DataFrame, chunk_lines: int = S.CHUNK_LINES) -> DataFrame:
    """Every tagged line with its tree columns; ``is_node`` marks the nodes."""
    single, multi = tag_parts(lines, chunk_lines)
    return _nodes_single(single).unionByName(_nodes_multi(multi))


def node_frame(lines: DataFrame, chunk_lines: int = S.CHUNK_LINES) -> DataFrame:
    """Node rows + parent, depth, cl_pos, node_rank, tag_rank, top_ancestor."""
    return line_frame(lines, chunk_lines).where("is_node")


def build_tree(lines: DataFrame) -> DataFrame:
    """(doc_id, node_pos, parent_pos, depth, tag, op_pos, cl_pos)."""
    f = node_frame(lines)
    return f.select("doc_id", F.col("i").alias("node_pos"), "parent_pos", "depth", "tag",
                    F.col("i").alias("op_pos"), "cl_pos")


def tree_root(lines: DataFrame) -> DataFrame:
    """(doc_id, op_pos, cl_pos, n_children) of each document's root."""
    one = F.col("bits") == 1
    docs = line_frame(lines).groupBy("doc_id").agg(
        F.first("n").alias("n"), F.first("tot").alias("tot"),
        F.max(F.when(one, F.col("i"))).alias("last1"),
        S.count_if(F.col("is_node") & (F.col("parent_pos") == -1)).alias("n_children"))
    closes_root = (F.col("tot") > 0) & (F.col("tot") % 2 == 0) & F.col("last1").isNull()
    return docs.select("doc_id", F.lit(0).alias("op_pos"),
                       F.when(closes_root, F.col("n") - 1).otherwise(F.col("n")).alias("cl_pos"), "n_children")


def tag_lines(lines: DataFrame, tag: str | None = None) -> DataFrame:
    """C14: (doc_id, tag, rank, op_pos, cl_pos) in breadth-first order per tag."""
    f = node_frame(lines)
    if tag is not None:
        f = f.where(F.col("tag") == tag)
    return f.select("doc_id", "tag", F.col("tag_rank").alias("rank"),
                    F.col("i").alias("op_pos"), "cl_pos")


def tree_walk(lines: DataFrame) -> DataFrame:
    """Visit order of both walks, root first (rank 0).

    ``bfs_rank`` is the breadth-first order, ``child_walk_rank`` the order of
    "root, then breadth-first under each top-level child".
    """
    rank = F.col("node_rank").cast("long")
    zero = F.lit(0).cast("long")
    node = F.struct(F.col("i").alias("node_pos"), F.col("tag").alias("tag"), F.col("depth").cast("long").alias("depth"),
                    F.col("top_ancestor").alias("top_ancestor"), rank.alias("bfs_rank"), rank.alias("child_walk_rank"))
    root = F.struct(F.lit(-1).alias("node_pos"), F.lit(None).cast("string").alias("tag"), zero.alias("depth"),
                    F.lit(-1).alias("top_ancestor"), zero.alias("bfs_rank"), zero.alias("child_walk_rank"))
    # line 0 stands for the root too, so one pass gives both
    own = F.when(F.col("is_node"), F.array(node)).otherwise(F.array().cast("array<" + NODE + ">"))
    with_root = F.when(F.col("i") == 0, F.concat(F.array(root), own)).otherwise(own)
    return line_frame(lines).select("doc_id", F.inline_outer(with_root)).where(F.col("node_pos").isNotNull())


def subtree_counts(lines: DataFrame) -> DataFrame:
    """Children per node, per child tag, and their tags in order (root = -1).

    ``child_tags`` is joined per stretch of lines first, then per node.
    """
    f = node_frame(lines)
    part = f.groupBy("doc_id", "parent_pos", S.chunk_of(F.col("i")).alias("chunk")).agg(
        F.count(F.lit(1)).alias("n_children"), *[S.count_if(F.col("tag") == t).alias(f"n_{t}") for t in TAGS],
        S.ordered_concat("i", "tag", ",").alias("tags"))
    return part.groupBy("doc_id", "parent_pos").agg(
        *[F.sum(c).alias(c) for c in ("n_children", *[f"n_{t}" for t in TAGS])],
        S.ordered_concat("chunk", "tags", ",").alias("child_tags"))
