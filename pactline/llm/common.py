"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactline.session import checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def keep_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage without tying the rows to one executor, and gives the
    reader true file sizes, so Spark broadcasts such a table only when it is
    below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/pactline-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def block_count(rows: int, per_block: int) -> int:
    """Blocks of at most about ``per_block`` rows each; 1 for an empty table."""
    return max(1, -(-rows // per_block))


def in_row_order(docs: DataFrame, row: str = "row") -> list[Column]:
    """The columns of ``docs``, held in the struct ``row``, that rows can be
    ordered by: all but those with maps or variants."""
    plain = [F.col(row).getField(name) for name, kind in docs.dtypes if "map<" not in kind and kind != "variant"]
    return plain or [F.lit(0)]
