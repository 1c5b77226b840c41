"""Mixes sources to target weights by fitting subset sums.

A source's target number of words is its share of the whole corpus by
weight, at most ``MOST`` times the source's size, the excess going to the
others by weight.  Every document of a source is taken as often as the target
holds the source whole; what remains is filled document by document:

1. documents are counted by (source, exact length);
2. of every length the same share of its documents is taken, rounded down;
3. long lengths are added one document each while much budget is left;
4. a bounded-knapsack dynamic programme over the lengths still free (bits of
   one integer are the reachable sums) finds the sum nearest to the rest;
5. the chosen number of documents of each length is drawn in the order of a
   seeded hash of their ids and columns.

Counting, ranking and drawing are Spark aggregates and windows on (source,
length, bucket of the hash), so neither a hot source nor a hot length meets
in one task, nor do documents without an id or with the same id; only rows
that are equal in every column do.  Only the table of lengths of one source
comes together, at most one row per distinct length.

Cases: a null text has size 0; a null source is a source of its own, last in
order; documents of size 0 are taken 0 times (the mix may keep or drop them:
``copies`` is then the number of whole passes); equal ids with equal lengths
are drawn by their other columns, so a task that runs again draws the same
rows (columns that hold a map are not looked at); an empty table gives an
empty table; other columns are carried in ``row``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactline.llm.common import keep_table, word_count

WEIGHTS, MOST, SEED = (5.0, 2.0, 1.0), 3, 20240229
#: Buckets that the documents of one (source, length) are ranked in.
BUCKETS = 1 << 12
#: Step 3 leaves about this many words to the dynamic programme.
REST = 1 << 14


def targets(sizes: list[int], weights: list[float], most: float = MOST) -> list[float]:
    """Words per source: shares by weight, capped at ``most`` times its size."""
    total, out, free = float(sum(sizes)), [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in free)
        weight = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(most * sizes[i])
            free.discard(i)
    return out


def nearest_sum(lengths: list[int], free: list[int], budget: int) -> dict[int, int]:
    """How many of each length to take so that the sum is nearest to ``budget``.

    Bounded knapsack: ``free[i]`` documents of ``lengths[i]``; ties go to the
    smaller sum.  Sums over twice the budget are worse than taking nothing.
    """
    if budget <= 0:
        return {}
    mask, reach, steps = (1 << (2 * budget + 1)) - 1, 1, []
    for length, n in zip(lengths, free):  # a length may come twice
        n, chunk = min(n, 2 * budget // length) if length else 0, 1
        while n > 0:
            take = min(chunk, n)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            n, chunk = n - take, 2 * chunk
        if reach >> budget & 1:
            break
    best = next(s for d in range(budget + 1) for s in (budget - d, budget + d) if reach >> s & 1)
    out: dict[int, int] = {}
    for length, take, before in reversed(steps):
        if not before >> best & 1:  # reached only with this step
            out[length] = out.get(length, 0) + take
            best -= length * take
    return out


def _fill(lengths: np.ndarray, counts: np.ndarray, more: int, budget: int, share: float, rest: int) -> tuple:
    """(documents of each length, words missed); a document may be taken
    ``more`` times, twice only where once does not fit the budget."""
    extra = (counts * share).astype(np.int64)
    extra[lengths == 0] = 0
    budget -= int((extra * lengths).sum())
    for i in np.argsort(-lengths, kind="stable"):
        if extra[i] < counts[i] and lengths[i] and budget - lengths[i] >= rest:
            extra[i] += 1
            budget -= int(lengths[i])
    # short lengths first: their sums lie close together
    order = [i for i in np.argsort(lengths, kind="stable") if lengths[i]]
    once = [int(counts[i] - extra[i]) for i in order]
    again = [int(counts[i] * (more - 1)) for i in order]
    found = nearest_sum([int(lengths[i]) for i in order] * 2, once + again, budget)
    at = {int(x): i for i, x in enumerate(lengths)}
    for length, n in found.items():
        extra[at[length]] += n
        budget -= length * n
    return extra, abs(budget)


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, target: float, most: int = MOST,
                rest: int = REST) -> tuple[int, np.ndarray]:
    """Whole passes over a source, and documents of each length beyond them.

    A small source whose proportional start misses the target is fitted again
    from nothing, and the nearer sum is taken.
    """
    size = int((lengths * counts).sum())
    if not size:
        return 0, np.zeros(len(lengths), np.int64)
    passes, budget = divmod(int(round(target)), size)
    more = max(1, int(most) - passes)
    extra, missed = _fill(lengths, counts, more, budget, budget / size, rest)
    if missed and budget <= 8 * rest:
        fresh, misses = _fill(lengths, counts, more, budget, 0.0, 8 * rest)
        if misses < missed:
            extra = fresh
    return passes, extra


def _key(source: Column) -> Column:
    """The source as a key that is never null and sorts nulls last."""
    return F.when(source.isNull(), F.lit("~")).otherwise(F.concat(F.lit("="), source.cast("string")))


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(_key, source_size, target): one row per source of (_key, size).

    The list of sources with their sizes is the mix's configuration and goes
    through the driver: one row per source, not per document.
    """
    rows = sorted(sized.groupBy("_key").agg(F.sum("size").alias("size")).collect(), key=lambda r: r["_key"])
    sizes = [r["size"] for r in rows]
    found = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], most)
    return sized.sparkSession.createDataFrame(
        [(r["_key"], s, t) for r, s, t in zip(rows, sizes, found)], "_key string, source_size long, target double")


def sized_documents(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> DataFrame:
    """(id, size, _key, row, _digest, _hash, _bucket): the documents with the order and bucket they are drawn in."""
    plain = [F.col(f"`{name}`") for name, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    digest = F.xxhash64(*[x for c in plain for x in (c.isNull(), c)])  # the hash alone passes over nulls
    return docs.select(F.col(id_col).alias("id"), word_count(F.col(text_col)).alias("size"),
                       _key(F.col(source_col)).alias("_key"), F.struct("*").alias("row"),
                       digest.alias("_digest")).withColumn(
        "_hash", F.xxhash64(F.lit(seed), F.col("id").cast("string"), F.col("_digest"))).withColumn(
        "_bucket", F.pmod(F.shiftright("_hash", 32), F.lit(BUCKETS)).cast("int"))


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    passes, extra = fit_lengths(rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64), rows["target"].iloc[0],
                                int(rows["most"].iloc[0]))
    n = rows["n"].to_numpy(np.int64)
    return pd.DataFrame({"_key": rows["_key"], "size": rows["size"], "passes": passes + extra // n, "extra": extra % n})


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = SEED) -> DataFrame:
    """(id, size, source_size, target, copies, taken, row) for every document.

    ``copies``: how often the mix takes the document; ``taken``: its words in
    the mix; ``row``: its columns (not shuffled unless it is read).
    """
    sized = sized_documents(docs, id_col, text_col, source_col, seed)
    groups = ["_key", "size", "_bucket"]
    counts = keep_table(sized.groupBy(*groups).agg(F.count("*").alias("n")), "length-counts")
    aims = keep_table(source_targets(counts.select("_key", (F.col("size") * F.col("n")).alias("size")), weights, most),
                      "source-targets")
    lengths = counts.groupBy("_key", "size").agg(F.sum("n").alias("n")).join(aims, "_key").withColumn(
        "most", F.lit(most))
    plan = keep_table(lengths.groupBy("_key").applyInPandas(_plan, "_key string, size long, passes long, extra long"),
                      "length-plan")
    before = Window.partitionBy("_key", "size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut = counts.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n").join(
        plan, ["_key", "size"]).join(aims, "_key")
    cut = keep_table(cut, "bucket-plan")
    rank = F.row_number().over(Window.partitionBy(*groups).orderBy("_hash", "id", "_digest"))
    out = sized.withColumn("_rank", rank).join(cut, groups)
    out = out.withColumn("copies", F.col("passes") + (F.col("_before") + F.col("_rank") <= F.col("extra")).cast("long"))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "copies",
                      (F.col("size") * F.col("copies")).alias("taken"), "row")


def apply_mix(docs: DataFrame, **kinds: object) -> DataFrame:
    """The mix itself: every document as often as it is taken."""
    mixed = mix_sources(docs, **kinds)
    return mixed.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")
