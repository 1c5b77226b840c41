"""Filter interaction audit: what each filter removes in every order of filters.

Every document gets a mask with one bit for each filter that it fails.  The
masks, not the documents, are then followed through all orders: a recursive SQL
query starts from every mask (a cell) with the empty prefix and extends each
prefix with each letter that it does not hold yet.  Rows carry the bits applied
so far, and each level of the recursion emits what its step does to a cell:
the step keeps it, removes it, or would have removed what an earlier step
already did.  With f filters that are at most 2^f cells times the prefixes
(10,400 rows for five), whatever the input; they are joined with the counts of
documents by part and mask, and every prefix's metrics are laid out over the
orders that begin with it.

A document fails the repeat filter if a document of smaller id, anywhere in the
table, has the identical text, told by SHA-256.  Only digests, ids and masks are
exchanged; repeats join the least id of their digest, so a text that very many
documents share is an ordinary skewed join for Spark to split.

Cases: a null text counts as empty, a null source is the part ''; a null id is
never smaller or larger than another, so it neither fails nor causes a repeat; of
rows with the same least id and text none fails; documents without labels, and
null labels, are neither good nor toxic, and repeated labels of an id count if any
says so; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactline.llm.bpe_words import slices
from pactline.llm.common import keep_table
from pactline.llm.fill_in_middle import text_bytes

#: Letters of the filters; filter k has bit 1 << k.  The last one is the repeat filter.
FILTERS = "ABCDE"
#: Failure conditions: fewer words; distinct words below a share; capitals above a share; any of these characters.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, MARKS = 200, 50, 2, b"#$%&*|"
BATCH_BYTES = 1 << 23
FLAGS = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("digest", pa.binary())])


def _count(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """True values of each text."""
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[bounds])


def text_masks(texts: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """Bits of the filters that look at one text alone, and the texts' SHA-256."""
    data, bounds = text_bytes(texts)
    raw, kinds = data.tobytes(), np.zeros((2, 256), bool)
    kinds[0, 65:91], kinds[1, list(MARKS)] = True, True
    chars = _count((data & 0xC0) != 0x80, bounds)
    capitals, marks = (_count(k[data], bounds) for k in kinds)
    n, distinct, digests = [], [], []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        words = raw[a:b].split()  # at the six ASCII white-space bytes
        n.append(len(words))
        distinct.append(len(set(words)))
        digests.append(hashlib.sha256(raw[a:b]).digest())
    n, distinct = np.array(n, np.int64), np.array(distinct, np.int64)
    fails = (n < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * n, 100 * capitals > MOST_CAPITALS * chars, marks > 0)
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails)), digests


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        every = b.column("text").fill_null("")
        for at, to in slices(pc.binary_length(every).to_numpy(), BATCH_BYTES):
            mask, digests = text_masks(every[at:to])
            yield pa.RecordBatch.from_arrays([b.column("doc_id")[at:to], b.column("part")[at:to], pa.array(
                mask, pa.int32()), pa.array(digests, pa.binary())], schema=FLAGS)


def failure_masks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
                  ) -> DataFrame:
    """(doc_id, part, mask): the filters that each document fails."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
    flags = keep_table(rows.mapInArrow(_flags, "doc_id long, part string, mask int, digest binary"), "filter-flags")
    least = flags.groupBy("digest").agg(F.min("doc_id").alias("_least"), F.count("*").alias("_n")).where("_n > 1")
    repeat = F.coalesce(F.col("doc_id") > F.col("_least"), F.lit(False))
    return flags.join(least.drop("_n"), "digest", "left").select(
        "doc_id", "part", F.col("mask").bitwiseOR(F.when(repeat, 1 << (len(FILTERS) - 1)).otherwise(0)).alias("mask"))


def mask_cells(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, and those labelled so."""
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *(F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(to)
          for c, to in (("quality", "good"), ("toxic", "toxic")))).where("good + toxic > 0")
    rows = masks.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n")).join(marked, "doc_id", "left")
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), *(
        F.sum(F.coalesce(F.col(c), F.lit(0)) * F.col("n")).alias(c) for c in ("good", "toxic")))


def enumerate_prefixes(spark: SparkSession, filters: str = FILTERS) -> DataFrame:
    """(prefix, letter, step, mask, removed, redundant, kept, alone): for every
    prefix of every order, what its last step does to each mask."""
    letters = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << k})" for k, x in enumerate(filters))
    return spark.sql(f"""
WITH RECURSIVE steps(prefix, letter, step, mask, before, applied) AS (
  SELECT '', '', 0, CAST(id AS INT), 0, 0 FROM range({1 << len(filters)})
  UNION ALL
  SELECT concat(s.prefix, f.letter), f.letter, s.step + 1, s.mask, s.applied, s.applied | f.bit
  FROM steps s LATERAL VIEW explode(filter(array({letters}), x -> (s.applied & x.bit) = 0)) AS f
  WHERE s.step < {len(filters)}
)
SELECT prefix, letter, step, mask,
       CAST((mask & before) = 0 AND (mask & applied) <> 0 AS INT) AS removed,
       CAST((mask & before) <> 0 AND (mask & (applied - before)) <> 0 AS INT) AS redundant,
       CAST((mask & applied) = 0 AS INT) AS kept,
       CAST(mask = applied - before AS INT) AS alone
FROM steps WHERE step > 0""")


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 part_col: str = "source") -> DataFrame:
    """One row per part, order of filters and step: (part, filter_order, step,
    kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    steps = keep_table(enumerate_prefixes(docs.sparkSession).coalesce(1), "filter-prefixes")
    cells = mask_cells(failure_masks(docs, id_col, text_col, part_col), labels)
    # 2^f masks times the prefixes: 10,400 rows for five filters, whatever the input
    by_prefix = cells.join(F.broadcast(steps), "mask").groupBy("part", "prefix", "letter", "step").agg(
        *(F.sum(F.col("n") * F.col(flag)).alias(to) for flag, to in (
            ("kept", "kept"), ("removed", "removed"), ("redundant", "redundant"), ("alone", "unique_fails"))),
        *(F.sum(F.col(c) * F.col("removed")).alias(f"{c}_lost") for c in ("good", "toxic")))
    # a prefix of s letters begins (f - s)! orders
    orders_of = F.factorial(F.lit(len(FILTERS)) - F.col("step"))
    by_prefix = by_prefix.withColumn("shapley", F.sum(F.col("removed") * orders_of).over(
        Window.partitionBy("part", "letter")))
    orders = steps.where(f"step = {len(FILTERS)}").select(F.col("prefix").alias("filter_order")).distinct().select(
        "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("_at")).select(
        "filter_order", F.substring("filter_order", F.lit(1), F.col("_at")).alias("prefix"))
    return by_prefix.join(F.broadcast(orders), "prefix").select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost",
        "shapley")
