"""List structure on list lines.

Markers come from the LIST pattern; four marker classes (number, ``a)``,
``(a)``, bullet) decide how neighbouring items compare.  Runs of growing
markers are found with gaps-and-islands: a run breaks where the item does
not grow from the previous list item of the document.  The previous item
may sit in an earlier chunk, so the chunk summary carries the last marker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactline.functions import text as T
from pactline.operators import segments as S
from pactline.operators.tagger import tag_parts

_CMP = {">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "<": lambda a, b: a < b,
        "<=": lambda a, b: a <= b, "=": lambda a, b: a == b}


def list_items(tagged: DataFrame) -> DataFrame:
    """(doc_id, chunk, i, line, marker, mtype, content) of lines tagged ``l``."""
    m = T.list_marker("line")
    return (tagged.where(F.col("tag") == "l")
            .select(*S.KEYS, "i", "line", m.alias("marker"))
            .withColumn("mtype", T.list_type("marker"))
            .withColumn("content", T.list_content("marker")))


def is_list_start(mtype: Column, content: Column) -> Column:
    """Number 1, letters A/a/i, any bullet."""
    return (F.when(mtype == 0, content == "1")
             .when(mtype.isin(1, 2), content.isin("A", "a", "i"))
             .when(mtype == 3, F.lit(True))
             .otherwise(F.lit(False)))


def same_type(t1: Column, t2: Column) -> Column:
    """Same marker class; two class-less markers count as the same."""
    return t1.eqNullSafe(t2)


def compare(t1: Column, c1: Column, t2: Column, c2: Column, op: str = ">") -> Column:
    """Same class and ``c1 op c2`` (numbers compared as integers)."""
    f = _CMP[op]
    num = f(c1.try_cast("decimal(38,0)"), c2.try_cast("decimal(38,0)"))
    return same_type(t1, t2) & F.when(t1 == 0, num).otherwise(f(c1, c2))


def growth(t1: Column, c1: Column, t2: Column, c2: Column) -> Column:
    """Number +1; letters rise as text; bullets and class-less repeat."""
    step = (F.when(t1 == 0, c2.try_cast("decimal(38,0)") - c1.try_cast("decimal(38,0)") == 1)
             .when(t1.isin(1, 2), c1 < c2)
             .otherwise(c1 == c2))
    return same_type(t1, t2) & F.coalesce(step, F.lit(False))


def _pairs(items: DataFrame, carry: F.Column | None) -> DataFrame:
    w = S.local_window("i")
    has_lag = F.lag("i").over(w).isNotNull()

    def prev(c):
        lagged = F.lag(c).over(w)
        return lagged if carry is None else F.when(has_lag, lagged).otherwise(carry[c])
    return items.select(*S.KEYS, "i", "line", "marker", "mtype", "content",
                        prev("i").alias("prev_i"), prev("mtype").alias("prev_mtype"),
                        prev("content").alias("prev_content"))


def _pair_parts(lines: DataFrame, chunk_lines: int = S.CHUNK_LINES):
    single_t, multi_t = tag_parts(lines, chunk_lines)
    single = _pairs(list_items(single_t), None)
    multi = list_items(multi_t)
    cs = multi.groupBy(*S.KEYS).agg(
        F.max("i").alias("c_last_i"),
        F.max_by(F.struct("mtype", "content", "i"), "i").alias("c_last"))
    cs = cs.select(*S.KEYS, F.max_by("c_last", "c_last_i").over(S.prev_chunks()).alias("carry"))
    return single, _pairs(multi.join(cs, S.KEYS), F.col("carry"))


def list_pairs(lines: DataFrame, chunk_lines: int = S.CHUNK_LINES) -> DataFrame:
    """Each list item with its previous list item in the document (D5-D7 inputs)."""
    single, multi = _pair_parts(lines, chunk_lines)
    return single.unionByName(multi)


def list_relations(lines: DataFrame, op: str = ">", chunk_lines: int = S.CHUNK_LINES) -> DataFrame:
    """D4-D7 per list item: start, same type, compare(prev op cur), growth."""
    p = list_pairs(lines, chunk_lines)
    has_prev = F.col("prev_i").isNotNull()
    pt, pc, ct, cc = F.col("prev_mtype"), F.col("prev_content"), F.col("mtype"), F.col("content")
    return p.select(
        "doc_id", "i", "marker", "mtype", "content", "prev_i",
        is_list_start(ct, cc).alias("is_start"),
        (has_prev & same_type(pt, ct)).alias("same_type"),
        (has_prev & compare(pt, pc, ct, cc, op)).alias("prev_cmp"),
        (has_prev & growth(pt, pc, ct, cc)).alias("grows"))


def list_runs(lines: DataFrame, min_items: int = 2, chunk_lines: int = S.CHUNK_LINES) -> DataFrame:
    """Runs of growing list items, whole (first..last item), >= min_items.

    run_id = running count of breaks; runs are aggregated with algebraic
    aggregates only (min/max/count), so a long run is never collected.
    """
    single, multi = _pair_parts(lines, chunk_lines)
    brk = ~(F.col("prev_i").isNotNull()
            & growth(F.col("prev_mtype"), F.col("prev_content"), F.col("mtype"), F.col("content")))
    y = (single.withColumn("brk", brk.cast("int"))
         .withColumn("run_id", F.sum("brk").over(S.running("i"))))
    multi = multi.withColumn("brk", brk.cast("int"))
    cs = multi.groupBy(*S.KEYS).agg(F.sum("brk").alias("c_brk"))
    cs = cs.select(*S.KEYS, F.coalesce(F.sum("c_brk").over(S.prev_chunks()), F.lit(0)).alias("brk_before"))
    multi = (multi.join(cs, S.KEYS)
             .withColumn("run_id", F.col("brk_before") + F.sum("brk").over(S.running("i")))
             .drop("brk_before"))
    y = y.unionByName(multi)
    runs = y.groupBy("doc_id", "run_id").agg(
        F.min("i").alias("first_i"), F.max("i").alias("last_i"),
        F.count(F.lit(1)).alias("n_items"),
        F.min_by("marker", "i").alias("first_marker"), F.max_by("marker", "i").alias("last_marker"),
        F.min_by("mtype", "i").alias("mtype"))
    return runs.where(F.col("n_items") >= min_items)
