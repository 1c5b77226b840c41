"""The registered queries and their DuckDB SQL, and the SQL that several of them share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pactline.functions import patterns as P
from pactline.plans import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


C_TAG = O.tag_chain(O.contracts_src())
C_TREE = O.tag_chain(O.contracts_src(), tree=True)
D_SRC = [f"""
dlines AS (
  SELECT doc_id, unnest(range(len(parts))) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id,
               CASE WHEN string_split_regex(text, {O.q(P.LINEBREAK)})[-1] = ''
                    THEN string_split_regex(text, {O.q(P.LINEBREAK)})[1:-2]
                    ELSE string_split_regex(text, {O.q(P.LINEBREAK)}) END AS parts
        FROM documents)
)""", "src AS (SELECT doc_id, CAST(pos AS INTEGER) AS pos, line FROM dlines)"]
D_TAG = O.tag_chain(D_SRC)
RENDER_SQL = f"""
CASE WHEN tag IS NOT NULL AND bits >= 2
     THEN regexp_replace(CASE WHEN bits % 2 = 1 THEN '<' || tag || '> ' || line ELSE line END,
                         {O.q(P.WS + '+$')}, '') || ' </' || tag || '>'
     WHEN tag IS NOT NULL AND bits % 2 = 1 THEN '<' || tag || '> ' || line
     ELSE line END"""
