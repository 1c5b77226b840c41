"""Joins on terms, whose frequencies follow a power law.

A plain shuffle join on the term sends all rows of a very common term to one
task.  ``join_terms`` splits by frequency: the HEAVY_TERMS commonest terms are
broadcast, whatever the input's size, and their rows, the bulk, do not move; the
rest is shuffled.  The document frequencies of all terms sum to the number of
rows, so none of the rest has more than the HEAVY_TERMS-th part of the rows.

``join_classes`` is for a side with many rows a term (one for each class).  As
many of the commonest terms as fit into SENT_BYTES with all their rows are
broadcast, so the bulk of the rows stays with its documents; the rest goes
through ``join_salted``: there common terms are spread over SALTS tasks by
document, with that many copies of the other side's rows for these few terms.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.operators.segments import task_parts
from pactline.session import checkpoint_dir

#: Terms that are broadcast at most, and terms that are salted at most.
HEAVY_TERMS, SALTED_TERMS, SALTS = 1 << 17, 1 << 10, 16
#: Bytes of the rows that ``join_classes`` broadcasts at most, and of a row beside its numbers.
SENT_BYTES, ROW_BYTES = 1 << 25, 64


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: an
    iteration's lineage ends there, and a lost executor costs no earlier step."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/pactline/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table of ``written`` that nothing reads any more."""
    jvm, sc = df.sparkSession._jvm, df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def is_heavy(n_rows: int, most: int = HEAVY_TERMS):
    """Whether a term (with its ``df``) is one of the fewer than ``most`` common ones."""
    return F.col("df") * most > n_rows


def join_terms(rows: DataFrame, stats: DataFrame, n_rows: int, least_df: float = 0.0, back: str | None = None,
               parts: int = 0) -> DataFrame:
    """Inner join of rows (..., term, ...) with one row per term (term, df, ...).

    ``n_rows``: number of (document, term) rows that ``df`` was counted over.
    ``least_df``: no term of ``stats`` is rarer; where that alone bounds their
    number, all are broadcast.  ``stats`` is read several times.  ``back``: rows
    that lie in ``parts`` partitions by this column do so afterwards, for only
    those of rare terms move, and are dealt back.
    """
    if least_df * HEAVY_TERMS > n_rows:
        return rows.join(F.broadcast(stats.drop("df")), "term")
    common = F.col("df") >= least_of_most(stats, HEAVY_TERMS)
    heavy = stats.where(common)
    often = rows.join(F.broadcast(heavy.drop("df")), "term")
    rest = rows.join(F.broadcast(heavy.select("term")), "term", "left_anti")
    # dealt by term whatever join follows, so that the union never passes for one that lies by document unasked
    rest = rest.repartition(task_parts(rest.sparkSession, rest), "term").join(stats.where(~common).drop("df"), "term")
    return often.unionByName(rest.repartition(parts, back) if back else rest)


def join_salted(rows: DataFrame, side: DataFrame, stats: DataFrame, n_rows: int, on: list[str],
                spread: str = "doc_id") -> DataFrame:
    """Inner join on ``on`` (which holds term) of rows with a side that has many rows a term."""
    heavy = F.broadcast(stats.where(is_heavy(n_rows, SALTED_TERMS)).select("term", F.lit(True).alias("_heavy")))
    salt = F.when(F.col("_heavy"), F.pmod(F.xxhash64(spread), F.lit(SALTS))).otherwise(0).cast("int")
    copies = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = rows.join(heavy, "term", "left").withColumn("_salt", salt).drop("_heavy")
    right = side.join(heavy, "term", "left").withColumn("_salt", F.explode(copies)).drop("_heavy")
    # by number: see join_terms
    left = left.repartition(task_parts(left.sparkSession, left), *on, "_salt")
    return left.join(right, [*on, "_salt"]).drop("_salt")


def least_of_most(stats: DataFrame, most: int) -> int:
    """The least document frequency that at most ``most`` terms reach.  Frequencies
    that differ are few: they sum to at most the number of rows."""
    sizes = stats.groupBy("df").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("df")).limit(most).collect()
    least, total = 1 << 62, 0
    for r in sizes:
        total += r["n"]
        if total > most:
            break
        least = r["df"]
    return least


def join_classes(rows: DataFrame, side: DataFrame, stats: DataFrame, n_rows: int, on: list[str], rows_a_term: int,
                 spread: str = "doc_id") -> DataFrame:
    """Inner join on ``on`` (which holds term) of rows with a side that has at most ``rows_a_term`` rows a term."""
    most = SENT_BYTES // (max(1, rows_a_term) * (ROW_BYTES + 8 * len(side.columns)))
    heavy = F.broadcast(stats.where(F.col("df") >= least_of_most(stats, most)).select("term"))
    often = rows.join(F.broadcast(side.join(heavy, "term", "left_semi")), on)
    rest = [x.join(heavy, "term", "left_anti") for x in (rows, side)]
    return often.unionByName(join_salted(*rest, stats, n_rows, on, spread))
