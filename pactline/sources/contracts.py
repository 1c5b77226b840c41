"""``contracts``: a line table derived from orders, lineitem and part.

The given ``documents`` table has almost no headings, lists or blank
lines, so the tagger is exercised on a table Spark derives from the
TPC-H-like tables: one document per order, one body line per line item.
The derivation is written once here and once in SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactline.operators.segments import task_parts
from pactline.sources.tables import table

# Fixed values of the fixture (its line shapes by kind).
BOM = "﻿"


def contract_lines(orders: DataFrame, lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """(doc_id BIGINT, pos INT, line STRING), one document per order."""
    k = F.col("o_orderkey")
    head0 = (orders.select(
        k.alias("doc_id"), F.lit(0).alias("pos"),
        F.when(k % 7 == 0, F.lit("Exhibit 10.1"))
         .when(k % 7 == 1, F.lit(""))
         .when(k % 7 == 2, F.lit("(draft)"))
         .when(k % 7 == 3, F.lit(BOM + "Supply agreement."))
         .otherwise(F.concat(F.lit("Supply Agreement "), k.cast("string"))).alias("line")))
    head1 = (orders.where((k % 7 == 0) & (k % 2 == 0))
             .select(k.alias("doc_id"), F.lit(1).alias("pos"), F.lit("Lease Agreement").alias("line")))

    # An order holds a handful of line items (1..7 by the TPC-H rules), so
    # numbering them with a per-order window is a bounded group.
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    li = (lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
          .join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
          .repartition(task_parts(lineitem.sparkSession, lineitem), "l_orderkey").withColumn("rn", F.row_number().over(w)))
    rn, ln, name = F.col("rn").cast("string"), F.col("l_linenumber"), F.col("p_name")
    kind = (F.col("l_partkey") * 7 + F.col("l_suppkey") * 3 + ln) % 12
    body_line = (
        F.when(kind == 0, F.concat(F.lit("Section "), rn))
         .when(kind == 1, F.upper(name))
         .when(kind == 2, F.concat(F.lit("Terms of "), name))
         .when(kind == 3, F.concat(rn, F.lit(". Deliver "), name, F.lit(".")))
         .when(kind == 4, F.concat(F.lit("("), F.chr(ln + 96), F.lit(") "), name, F.lit(" units")))
         .when(kind == 5, F.concat(F.lit("- "), name))
         .when(kind == 6, F.concat(name, F.lit(" as agreed")))
         .when(kind == 7, F.lit("  "))
         .when(kind == 8, F.concat(rn, F.lit(".")))
         .when(kind == 9, F.concat(F.lit("The quantity is "),
                                   F.col("l_quantity").cast("int").cast("string"), F.lit(". ")))
         .when(kind == 10, F.concat(F.chr(ln + 64), F.lit(". Item, "), name))
         .otherwise(F.concat(F.lit("   * "), name, F.lit("; "))))
    body = li.select(F.col("l_orderkey").alias("doc_id"), (F.col("rn") + 1).cast("int").alias("pos"),
                     body_line.alias("line"))
    return head0.unionByName(head1).unionByName(body)


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_lines(table(spark, sf_dir, "orders", "o_orderkey"),
                          table(spark, sf_dir, "lineitem"),
                          table(spark, sf_dir, "part"))


# The same derivation for the DuckDB oracle.
CONTRACTS_SQL = """
contracts AS (
  SELECT o_orderkey AS doc_id, 0 AS pos,
         CASE o_orderkey % 7 WHEN 0 THEN 'Exhibit 10.1' WHEN 1 THEN '' WHEN 2 THEN '(draft)'
              WHEN 3 THEN chr(65279) || 'Supply agreement.'
              ELSE 'Supply Agreement ' || CAST(o_orderkey AS VARCHAR) END AS line
  FROM orders
  UNION ALL
  SELECT o_orderkey, 1, 'Lease Agreement' FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 2 = 0
  UNION ALL
  SELECT doc_id, CAST(rn + 1 AS INTEGER) AS pos,
         CASE kind
           WHEN 0 THEN 'Section ' || rn
           WHEN 1 THEN upper(name)
           WHEN 2 THEN 'Terms of ' || name
           WHEN 3 THEN rn || '. Deliver ' || name || '.'
           WHEN 4 THEN '(' || chr(96 + ln) || ') ' || name || ' units'
           WHEN 5 THEN '- ' || name
           WHEN 6 THEN name || ' as agreed'
           WHEN 7 THEN '  '
           WHEN 8 THEN rn || '.'
           WHEN 9 THEN 'The quantity is ' || CAST(CAST(trunc(qty) AS BIGINT) AS VARCHAR) || '. '
           WHEN 10 THEN chr(64 + ln) || '. Item, ' || name
           ELSE '   * ' || name || '; ' END AS line
  FROM (
    SELECT l_orderkey AS doc_id, l_linenumber AS ln, l_quantity AS qty, p_name AS name,
           (l_partkey * 7 + l_suppkey * 3 + l_linenumber) % 12 AS kind,
           row_number() OVER (PARTITION BY l_orderkey
                              ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS rn
    FROM lineitem JOIN part ON l_partkey = p_partkey
  ) b
)
"""
