"""Chunked scans over ordered groups.

Per-document rules (running counts, the next line, the last open section)
are scans over an ordered group.  A plain ``Window.partitionBy(doc_id)``
puts a whole document in one task, so a document holding a large share of
all lines would stall a stage.  Instead every line carries
``chunk = pos div CHUNK_LINES``; rows are hash-partitioned on
``(doc_id, chunk)``, scanned locally, and each chunk's totals are carried
forward by a window over the small per-chunk summary (one row per chunk),
which is joined back on exactly ``(doc_id, chunk)`` so the big side keeps
its partitioning.
"""

from __future__ import annotations

import gc

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHUNK_LINES = 4096
KEYS = ["doc_id", "chunk"]
#: Partitions for each core, at least, of a shuffle whose tasks sort or group all that they read.
PARTS_A_CORE = 8
#: Bytes of the read tables for each partition of such a shuffle, at most.
PART_BYTES = 2 << 20


def read_bytes(df: DataFrame) -> int:
    """Bytes of the tables that ``df`` is derived from, each once, by Spark's statistics (no job).

    Frames made of RDDs have no known size (Spark takes the largest number) and count nothing.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    leaves = [leaves.apply(i) for i in range(leaves.size())]
    sizes = {x.semanticHash(): int(x.stats().sizeInBytes()) for x in leaves}
    return sum(n for n in sizes.values() if n < 1 << 62)


def task_parts(spark: SparkSession, rows: DataFrame | None = None) -> int:
    """Partitions of a shuffle (of ``rows``) whose tasks hold what they read.

    Given as a number, so that adaptive execution does not join them: it aims
    at about one partition a core, up to 64 MB of compressed bytes, which are
    many times that in a sort or a hash table.  The number grows with the
    tables that the rows come from, so a task's memory does not.
    """
    least = max(int(spark.conf.get("spark.sql.shuffle.partitions")), PARTS_A_CORE * spark.sparkContext.defaultParallelism)
    return least if rows is None else max(least, -(-read_bytes(rows) // PART_BYTES))


def chunk_of(pos: Column, size: int = CHUNK_LINES) -> Column:
    return F.floor(pos / F.lit(size)).cast("long")


def local_window(order: str) -> Window:
    """Rows of one chunk, in document order."""
    return Window.partitionBy(*KEYS).orderBy(order)


def running(order: str):
    return local_window(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before(order: str):
    return local_window(order).rowsBetween(Window.unboundedPreceding, -1)


# Windows over the per-chunk summary (one row per (doc_id, chunk)).
def chunks():
    return Window.partitionBy("doc_id").orderBy("chunk")


def doc():
    return chunks().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def prev_chunks():
    return chunks().rowsBetween(Window.unboundedPreceding, -1)


def count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0))


def ordered_concat(order: str, value: str, sep: str = "") -> Column:
    """Concatenate ``value`` in ``order`` inside a group (array_sort of structs)."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, value))),
                                    lambda s: s[value]), sep)


def posexplode_once(array: Column | str, pos: str, value: str) -> Column:
    """``posexplode`` that computes ``array`` once; drop rows with a null ``pos`` after it.

    For the inner form the optimizer adds a filter on the array's size and
    moves it to the scan, where the whole expression is computed again.
    """
    return F.posexplode_outer(array).alias(pos, value)


_HELD: list[DataFrame] = []


def materialize(df: DataFrame) -> DataFrame:
    """Keep a level's output for the two branches that read it.

    A summary and the join back both read the level below; without this,
    each level would recompute the one below twice.  ``persist`` keeps the
    lineage, so a lost executor's blocks are recomputed, and it keeps the
    ``(doc_id, chunk)`` partitioning, so the joins add no exchange.
    """
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    _HELD.append(held)
    return held


def forget(spark: SparkSession) -> None:
    """Let the shuffle files of finished jobs go: Spark drops them once the
    driver's garbage is collected, which a loop of jobs may never wait for."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release() -> None:
    """Drop every level kept by ``materialize`` (call between jobs)."""
    while _HELD:
        _HELD.pop().unpersist()
