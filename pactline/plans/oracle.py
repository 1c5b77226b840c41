"""Independent SQL (DuckDB dialect) for the correctness check.

The oracle is written the direct way: plain windows over whole documents,
``string_agg(... ORDER BY ...)``, no chunking.  It shares only the pattern
strings with the Spark side.  RE2 has no ``\\p{IsUppercase}``, so upper case
is tested as ``upper(x) = x AND lower(x) <> x``.
"""

from __future__ import annotations

from pactline.functions import patterns as P
from pactline.operators.stems import STEP2, STEP3, STEP4
from pactline.sources.contracts import CONTRACTS_SQL


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rx(col: str, pattern: str) -> str:
    return f"regexp_matches({col}, {q(pattern)})"


def upper_sql(col: str) -> str:
    return f"(upper({col}) = {col} AND lower({col}) <> {col})"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


# --- normalise (C1) from a CTE named src(doc_id, pos, line) ------------------

NORM_CTES = [f"""
raw AS (
  SELECT doc_id, pos, line, {rx('line', P.BLANK)} AS blank, {rx('line', P.CONT)} AS cont FROM src
)""", """
d1 AS (
  SELECT doc_id, min(pos) AS first_pos, arg_min(blank, pos) AS first_blank, arg_min(cont, pos) AS first_cont,
         sum(CASE WHEN cont THEN 1 ELSE 0 END) AS n_cont, count(*) AS n_raw
  FROM raw GROUP BY doc_id
)""", """
st1 AS (
  SELECT doc_id, first_pos, n_raw,
         CASE WHEN first_blank AND n_cont > 0 THEN 'error_blank_first'
              WHEN first_blank THEN 'blank_first_collapsed' ELSE 'ok' END AS status
  FROM d1
)""", """
kept AS (
  SELECT r.doc_id, r.pos, r.line, r.cont, s.first_pos
  FROM raw r JOIN st1 s ON r.doc_id = s.doc_id
  WHERE (s.status = 'ok' AND NOT r.blank) OR (s.status = 'blank_first_collapsed' AND r.pos = s.first_pos)
)""", """
grp AS (
  SELECT doc_id, pos, line,
         sum(CASE WHEN pos = first_pos OR NOT cont THEN 1 ELSE 0 END)
           OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS g
  FROM kept
)""", """
norm AS (
  SELECT doc_id, CAST(g - 1 AS INTEGER) AS i, string_agg(line, '' ORDER BY pos) AS line
  FROM grp GROUP BY doc_id, g
)"""]

# --- tag (C2-C8) from norm ----------------------------------------------------

TAG_CTES = [f"""
z AS (
  SELECT doc_id, i, line,
         {rx('line', P.BLANK)} AS blank,
         NOT {rx('line', P.BLANK)} AND ({rx('line', P.SECTION)} OR {rx('line', P.EXACT)}) AS cand_s,
         NOT {rx('line', P.BLANK)} AND {rx('line', P.LIST)} AND NOT {rx('line', P.SINGLENUM)} AS cand_l,
         {upper_sql('line')} AS up,
         count(*) OVER (PARTITION BY doc_id) AS n,
         coalesce(max(CASE WHEN i = 0 THEN {rx('line', P.EXHIBIT)} END) OVER (PARTITION BY doc_id), false) AS ex0,
         coalesce(max(CASE WHEN i = 0 THEN {rx('line', P.TITLE)} END) OVER (PARTITION BY doc_id), false) AS ti0
  FROM norm
)""", """
z2 AS (
  SELECT *, CASE WHEN ex0 THEN 2 WHEN ti0 THEN 1 ELSE 0 END AS start FROM z WHERE NOT (ex0 AND n = 1)
)""", """
z3 AS (
  SELECT *, (ex0 AND i = 1) OR (NOT ex0 AND ti0 AND i = 0) AS is_title,
         cand_s AND i >= start AS s_raw,
         cand_l AND i >= start AND NOT (cand_s AND i >= start) AS l_raw
  FROM z2
)""", """
z4 AS (
  SELECT *, bool_and(NOT s_raw OR up) OVER (PARTITION BY doc_id) AS all_upper FROM z3
)""", """
z5 AS (
  SELECT *, s_raw AND (all_upper OR NOT up) AS is_s FROM z4
)""", """
z6 AS (
  SELECT *,
         CASE WHEN is_title THEN 'title' WHEN s_raw THEN 's' WHEN l_raw THEN 'l' END AS raw_tag,
         CASE WHEN is_title THEN 'title' WHEN is_s THEN 's' WHEN l_raw THEN 'l' END AS tag3,
         CASE WHEN is_title THEN 'title' WHEN is_s THEN 's' WHEN l_raw THEN 'l' WHEN NOT blank THEN 'p' END AS tag4,
         sum(CASE WHEN is_s THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS si,
         sum(CASE WHEN is_s THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS tot,
         coalesce(lead(is_s) OVER (PARTITION BY doc_id ORDER BY i), false) AS nxt
  FROM z5
)""", """
tagged AS (
  SELECT doc_id, i, line, raw_tag, tag3, tag4, n, start, all_upper, ex0, ti0, tot,
         CASE WHEN i = n - 1 AND tot > 0 AND tot % 2 = 0 THEN 's' ELSE tag4 END AS tag,
         CASE WHEN i = n - 1 AND tot > 0 AND tot % 2 = 0 THEN 2
              WHEN tag4 = 's' THEN CASE WHEN nxt AND si % 2 = 1 THEN 3 ELSE 1 END
              WHEN tag4 = 'title' THEN 1 WHEN tag4 IN ('l', 'p') THEN 3 ELSE 0 END AS bits
  FROM z6
)"""]

# --- tree (C12-C16) from tagged -----------------------------------------------

TREE_CTES = ["""
tl AS (
  SELECT *,
         max(CASE WHEN bits = 1 THEN i END) OVER (PARTITION BY doc_id ORDER BY i
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev1,
         coalesce(sum(CASE WHEN bits = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ones_before,
         max(CASE WHEN bits = 1 THEN i END) OVER (PARTITION BY doc_id) AS last1,
         min(CASE WHEN bits = 1 THEN i END) OVER (PARTITION BY doc_id) AS first1
  FROM tagged
)""", """
nodes AS (
  SELECT doc_id, i AS node_pos, coalesce(prev1, -1) AS parent_pos, CAST(1 + ones_before AS BIGINT) AS depth, tag,
         i AS op_pos,
         CASE WHEN tot > 0 AND tot % 2 = 0 AND i = last1 THEN n - 1 ELSE i END AS cl_pos,
         row_number() OVER (PARTITION BY doc_id ORDER BY 1 + ones_before, i) AS bfs_rank,
         row_number() OVER (PARTITION BY doc_id, tag ORDER BY 1 + ones_before, i) AS tag_rank,
         CASE WHEN 1 + ones_before = 1 THEN i ELSE first1 END AS top_ancestor
  FROM tl WHERE bits IN (1, 3)
)"""]


def lines_from(src_sql: str) -> str:
    return f"src AS ({src_sql})"


def contracts_src() -> list[str]:
    return [CONTRACTS_SQL, "src AS (SELECT doc_id, pos, line FROM contracts)"]


def tag_chain(src: list[str], tree: bool = False) -> list[str]:
    return src + NORM_CTES + TAG_CTES + (TREE_CTES if tree else [])


# --- Porter stems ---------------------------------------------------------------------

def _measure(n: int) -> str:
    """Measure of the word (or of its first part without n characters)."""
    s = f"left(s, -{n})" if n else "s"
    return f"((length({s}) - length(replace({s}, 'vc', ''))) // 2)"


def stem_ctes(source: str, name: str = "stems") -> list[str]:
    """``name``(token, stem): stems of the distinct ``token`` of a CTE."""
    # a v that stands in the word is a consonant like b
    shape = "regexp_replace(regexp_replace(replace(w, 'v', 'b'), '[aeiou]', 'v', 'g'), '[^vy]', 'c', 'g')"
    for a, b in (("^y", "c"), ("vy", "vc"), ("yy", "vc"), ("y", "v")):
        shape = f"regexp_replace({shape}, '{a}', '{b}', 'g')"
    out, prev = [], f"(SELECT DISTINCT token, token AS w FROM {source})"

    def step(case: str, mend: str = "mend") -> None:
        nonlocal prev
        made = f"{name}_{len(out)}"
        out.append(f"{made} AS (SELECT *, {shape} AS s FROM (SELECT token, {mend} AS mend, CASE {case} ELSE w END AS w"
                   f" FROM {prev}))")
        prev = made

    def rules(pairs: list, above: int, more: str = "true") -> str:
        return " ".join(f"WHEN ends_with(w, '{a}') THEN CASE WHEN {_measure(len(a))} > {above} AND "
                        f"{more if a == 'ion' else 'true'} THEN left(w, -{len(a)}) || '{b}' ELSE w END" for a, b in pairs)

    short = "(regexp_matches({s}, 'cvc$') AND NOT regexp_matches({w}, '[wxy]$'))"
    double = "(length(w) > 1 AND right(s, 1) = 'c' AND w[-1] = w[-2])"
    step("WHEN regexp_matches(w, '(sse|ie)s$') THEN left(w, -2) WHEN regexp_matches(w, 'ss$') THEN w "
         "WHEN regexp_matches(w, 's$') THEN left(w, -1)", "false")
    ed = "(regexp_matches(w, 'ed$') AND NOT regexp_matches(w, 'eed$') AND regexp_matches(s, 'v.*..$'))"
    ing = "(regexp_matches(w, 'ing$') AND regexp_matches(s, 'v.*...$'))"
    step(f"WHEN ends_with(w, 'eed') THEN CASE WHEN {_measure(3)} > 0 THEN left(w, -1) ELSE w END "
         f"WHEN {ed} THEN left(w, -2) WHEN {ing} THEN left(w, -3)", f"{ed} OR {ing}")
    step(f"WHEN NOT mend THEN w WHEN regexp_matches(w, '(at|bl|iz)$') THEN w || 'e' "
         f"WHEN {double} AND NOT regexp_matches(w, '[lsz]$') THEN left(w, -1) "
         f"WHEN {_measure(0)} = 1 AND {short.format(s='s', w='w')} THEN w || 'e'")
    step("WHEN ends_with(w, 'y') AND regexp_matches(s, 'v.*.$') THEN left(w, -1) || 'i'")
    step(rules(STEP2, 0))
    step(rules(STEP3, 0))
    step(rules([(a, "") for a in STEP4], 1, "regexp_matches(w, '[st]ion$')"))
    bare = short.format(s="left(s, -1)", w="left(w, -1)")
    step(f"WHEN ends_with(w, 'e') AND ({_measure(1)} > 1 OR ({_measure(1)} = 1 AND NOT {bare})) THEN left(w, -1)")
    step(f"WHEN {_measure(0)} > 1 AND {double} AND ends_with(w, 'l') THEN left(w, -1)")
    return [*out, f"{name} AS (SELECT token, CASE WHEN length(token) <= 2 THEN token ELSE w END AS stem FROM {prev})"]
