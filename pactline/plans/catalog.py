"""Registered queries: one per operator of the survey inventory.

Each query is a callable (spark, sf_dir) -> DataFrame over the given
tables (or tables Spark derives from them); ``ORACLE`` holds the DuckDB
SQL of the same query where SQL can express it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pactline.functions import text as T
from pactline.operators import lines as L
from pactline.operators import lists, tagger, tree
from pactline.plans import oracle as O
from pactline.plans.registry import C_TAG, C_TREE, D_SRC, D_TAG, ORACLE, QUERIES, RENDER_SQL, register  # noqa: F401
from pactline.sources.contracts import contracts
from pactline.sources.tables import documents

# --- B: lines and predicates ---------------------------------------------------

@register("split_lines", O.with_(*D_SRC) + "SELECT doc_id, pos, line FROM src")
def q_split_lines(spark, sf):
    return L.split_lines(documents(spark, sf))


def _pred_query(key: str, col_fn, sql_expr: str):
    @register(key, O.with_(*O.contracts_src()) + f"SELECT doc_id, pos, {sql_expr} AS flag FROM src")
    def q(spark, sf):
        return contracts(spark, sf).select("doc_id", "pos", col_fn("line").alias("flag"))
    q.__name__ = f"q_{key}"
    return q


_pred_query("is_blank", T.is_blank, O.rx("line", L.P.BLANK))
_pred_query("is_continuation", T.is_continuation, O.rx("line", L.P.CONT))
_pred_query("is_exhibit", T.is_exhibit, O.rx("line", L.P.EXHIBIT))
_pred_query("is_title", T.is_title, O.rx("line", L.P.TITLE))
_pred_query("is_section", T.is_section, f"({O.rx('line', L.P.SECTION)} OR {O.rx('line', L.P.EXACT)})")
_pred_query("is_list_line", T.is_list_line,
            f"({O.rx('line', L.P.LIST)} AND NOT {O.rx('line', L.P.SINGLENUM)})")
_pred_query("is_upper", T.is_upper, O.upper_sql("line"))


# --- C: normalise, tag, render, tree --------------------------------------------

@register("normalize_lines", O.with_(*O.contracts_src(), *O.NORM_CTES) + "SELECT doc_id, i, line FROM norm")
def q_normalize_lines(spark, sf):
    return L.normalize_lines(contracts(spark, sf))


@register("quarantine", O.with_(*C_TAG) + """
SELECT doc_id, status FROM st1 WHERE status LIKE 'error_%'
UNION ALL
SELECT doc_id, 'error_exhibit_only' FROM (SELECT DISTINCT doc_id FROM z WHERE ex0 AND n = 1) e
""")
def q_quarantine(spark, sf):
    return tagger.quarantine(contracts(spark, sf))


@register("line_status", O.with_(*C_TAG) + """
SELECT s.doc_id, CASE WHEN e.doc_id IS NOT NULL AND s.status = 'ok' THEN 'error_exhibit_only'
                      ELSE s.status END AS status
FROM st1 s LEFT JOIN (SELECT DISTINCT doc_id FROM z WHERE ex0 AND n = 1) e ON s.doc_id = e.doc_id
""")
def q_line_status(spark, sf):
    return tagger.line_status(contracts(spark, sf))


@register("title_position", O.with_(*C_TAG) + """
SELECT doc_id, CASE WHEN ex0 THEN 1 WHEN ti0 THEN 0 END AS title_pos, start AS search_start
FROM tagged WHERE i = 0
""")
def q_title_position(spark, sf):
    return tagger.title_position(contracts(spark, sf))


@register("line_tags_raw", O.with_(*C_TAG) + "SELECT doc_id, i, raw_tag FROM tagged")
def q_line_tags_raw(spark, sf):
    return tagger.line_tags_raw(contracts(spark, sf))


@register("sections_all_upper", O.with_(*C_TAG) + "SELECT doc_id, all_upper FROM tagged WHERE i = 0")
def q_sections_all_upper(spark, sf):
    return tagger.sections_all_upper(contracts(spark, sf))


@register("demote_upper_sections", O.with_(*C_TAG) + "SELECT doc_id, i, tag3 AS tag FROM tagged")
def q_demote_upper_sections(spark, sf):
    return tagger.demote_upper_sections(contracts(spark, sf))


@register("plain_fill", O.with_(*C_TAG) + "SELECT doc_id, i, tag4 AS tag FROM tagged")
def q_plain_fill(spark, sf):
    return tagger.plain_fill(contracts(spark, sf))


@register("section_bits", O.with_(*C_TAG) + "SELECT doc_id, i, tag, bits FROM tagged")
def q_section_bits(spark, sf):
    return tagger.tag_positions(contracts(spark, sf)).select("doc_id", "i", "tag", "bits")


@register("tag_positions", O.with_(*C_TAG) + "SELECT doc_id, i, line, tag, bits FROM tagged")
def q_tag_positions(spark, sf):
    return tagger.tag_positions(contracts(spark, sf))


@register("tag_positions_documents", O.with_(*D_TAG) + "SELECT doc_id, i, line, tag, bits FROM tagged")
def q_tag_positions_documents(spark, sf):
    return tagger.tag_positions(L.document_lines(documents(spark, sf)))


@register("tag_marks", O.with_(*C_TAG) + """
SELECT doc_id, i, '<' || tag || '>' AS op, '</' || tag || '>' AS cl,
       '<' || tag || '>' || line || '</' || tag || '>' AS wrapped
FROM tagged WHERE tag IS NOT NULL
""")
def q_tag_marks(spark, sf):
    t = tagger.tag_positions(contracts(spark, sf)).where(F.col("tag").isNotNull())
    return t.select("doc_id", "i", tagger.tag_mark_open("tag").alias("op"),
                    tagger.tag_mark_close("tag").alias("cl"), tagger.tag_wrap("line", "tag").alias("wrapped"))




@register("render_lines", O.with_(*C_TAG) + f"SELECT doc_id, i, {RENDER_SQL} AS rendered FROM tagged")
def q_render_lines(spark, sf):
    return tagger.render_lines(tagger.tag_positions(contracts(spark, sf))).select("doc_id", "i", "rendered")


@register("parse_raw_text", O.with_(*C_TAG) + f"""
SELECT doc_id, string_agg(rendered, chr(10) ORDER BY i) AS tagged_text
FROM (SELECT doc_id, i, {RENDER_SQL} AS rendered FROM tagged) r GROUP BY doc_id
""")
def q_parse_raw_text(spark, sf):
    return tagger.parse_raw_text(contracts(spark, sf))


@register("parse_raw_text_documents", O.with_(*D_TAG) + f"""
SELECT doc_id, string_agg(rendered, chr(10) ORDER BY i) AS tagged_text
FROM (SELECT doc_id, i, {RENDER_SQL} AS rendered FROM tagged) r GROUP BY doc_id
""")
def q_parse_raw_text_documents(spark, sf):
    return tagger.parse_raw_text(L.document_lines(documents(spark, sf)))


@register("build_tree", O.with_(*C_TREE) +
          "SELECT doc_id, node_pos, parent_pos, depth, tag, op_pos, cl_pos FROM nodes")
def q_build_tree(spark, sf):
    return tree.build_tree(contracts(spark, sf))


@register("tree_root", O.with_(*C_TREE) + """
SELECT t.doc_id, 0 AS op_pos,
       CASE WHEN t.tot > 0 AND t.tot % 2 = 0 AND t.last1 IS NULL THEN t.n - 1 ELSE t.n END AS cl_pos,
       coalesce(k.n_children, 0) AS n_children
FROM (SELECT DISTINCT doc_id, n, tot, last1 FROM tl) t
LEFT JOIN (SELECT doc_id, count(*) AS n_children FROM nodes WHERE parent_pos = -1 GROUP BY doc_id) k
  ON t.doc_id = k.doc_id
""")
def q_tree_root(spark, sf):
    return tree.tree_root(contracts(spark, sf))


@register("tag_lines", O.with_(*C_TREE) + "SELECT doc_id, tag, tag_rank AS rank, op_pos, cl_pos FROM nodes")
def q_tag_lines(spark, sf):
    return tree.tag_lines(contracts(spark, sf))


@register("tree_walk", O.with_(*C_TREE) + """
SELECT doc_id, -1 AS node_pos, CAST(NULL AS VARCHAR) AS tag, CAST(0 AS BIGINT) AS depth, -1 AS top_ancestor,
       CAST(0 AS BIGINT) AS bfs_rank, CAST(0 AS BIGINT) AS child_walk_rank
FROM tagged WHERE i = 0
UNION ALL
SELECT doc_id, node_pos, tag, depth, top_ancestor, bfs_rank,
       row_number() OVER (PARTITION BY doc_id ORDER BY top_ancestor, depth, node_pos) AS child_walk_rank
FROM nodes
""")
def q_tree_walk(spark, sf):
    return tree.tree_walk(contracts(spark, sf))


@register("subtree_counts", O.with_(*C_TREE) + """
SELECT doc_id, parent_pos, count(*) AS n_children,
       CAST(sum(CASE WHEN tag = 'title' THEN 1 ELSE 0 END) AS BIGINT) AS n_title,
       CAST(sum(CASE WHEN tag = 's' THEN 1 ELSE 0 END) AS BIGINT) AS n_s,
       CAST(sum(CASE WHEN tag = 'l' THEN 1 ELSE 0 END) AS BIGINT) AS n_l,
       CAST(sum(CASE WHEN tag = 'p' THEN 1 ELSE 0 END) AS BIGINT) AS n_p,
       string_agg(tag, ',' ORDER BY node_pos) AS child_tags
FROM nodes GROUP BY doc_id, parent_pos
""")
def q_subtree_counts(spark, sf):
    return tree.subtree_counts(contracts(spark, sf))


# --- F9: the flagship -------------------------------------------------------------

def tag_summary_contracts(spark: SparkSession, sf: str) -> DataFrame:
    return tagger.tag_summary(tagger.tag_positions(contracts(spark, sf)))


TAG_SUMMARY_SQL = "SELECT tag, bits, count(*) AS n_lines FROM tagged WHERE tag IS NOT NULL GROUP BY tag, bits"
register("tag_summary", O.with_(*C_TAG) + TAG_SUMMARY_SQL)(tag_summary_contracts)


@register("tag_summary_documents", O.with_(*D_TAG) + TAG_SUMMARY_SQL)
def q_tag_summary_documents(spark, sf):
    return tagger.tag_summary(tagger.tag_positions(L.document_lines(documents(spark, sf))))


@register("tag_counts_per_doc", O.with_(*C_TAG) +
          "SELECT doc_id, tag, count(*) AS n_lines FROM tagged WHERE tag IS NOT NULL GROUP BY doc_id, tag")
def q_tag_counts_per_doc(spark, sf):
    return tagger.tag_counts_per_doc(tagger.tag_positions(contracts(spark, sf)))


# --- D: list structure -------------------------------------------------------------

_LT = f"""CASE WHEN {O.rx('marker', L.P.LIST_CLASS_NUMBER)} THEN 0 WHEN {O.rx('marker', L.P.LIST_CLASS_LETTER)} THEN 1
              WHEN {O.rx('marker', L.P.LIST_CLASS_PAREN)} THEN 2 WHEN {O.rx('marker', L.P.LIST_CLASS_BULLET)} THEN 3 END"""
_LC = f"""CASE WHEN {O.rx('marker', L.P.LIST_CLASS_NUMBER)} THEN regexp_extract(marker, {O.q(L.P.LIST_CLASS_NUMBER)}, 1)
              WHEN {O.rx('marker', L.P.LIST_CLASS_LETTER)} THEN regexp_extract(marker, {O.q(L.P.LIST_CLASS_LETTER)}, 1)
              WHEN {O.rx('marker', L.P.LIST_CLASS_PAREN)} THEN regexp_extract(marker, {O.q(L.P.LIST_CLASS_PAREN)}, 1)
              WHEN {O.rx('marker', L.P.LIST_CLASS_BULLET)} THEN regexp_extract(marker, {O.q(L.P.LIST_CLASS_BULLET)}, 1)
              ELSE '' END"""
LIST_CTES = C_TAG + [f"""
li AS (SELECT doc_id, i, line, regexp_extract(line, {O.q(L.P.LIST)}, 1) AS marker FROM tagged WHERE tag = 'l')""", f"""
lt AS (SELECT *, {_LT} AS mtype, {_LC} AS content FROM li)""", """
lp AS (SELECT *, lag(i) OVER w AS prev_i, lag(mtype) OVER w AS prev_mtype, lag(content) OVER w AS prev_content
       FROM lt WINDOW w AS (PARTITION BY doc_id ORDER BY i))""", """
lr AS (SELECT *,
  CASE WHEN mtype = 0 THEN content = '1' WHEN mtype IN (1, 2) THEN content IN ('A', 'a', 'i')
       WHEN mtype = 3 THEN true ELSE false END AS is_start,
  prev_i IS NOT NULL AND prev_mtype IS NOT DISTINCT FROM mtype AS same_type,
  prev_i IS NOT NULL AND prev_mtype IS NOT DISTINCT FROM mtype
    AND CASE WHEN prev_mtype = 0 THEN TRY_CAST(prev_content AS DECIMAL(38,0)) > TRY_CAST(content AS DECIMAL(38,0))
             ELSE prev_content > content END AS prev_cmp,
  prev_i IS NOT NULL AND prev_mtype IS NOT DISTINCT FROM mtype
    AND coalesce(CASE WHEN prev_mtype = 0
                      THEN TRY_CAST(content AS DECIMAL(38,0)) - TRY_CAST(prev_content AS DECIMAL(38,0)) = 1
                      WHEN prev_mtype IN (1, 2) THEN prev_content < content
                      ELSE prev_content = content END, false) AS grows
  FROM lp)"""]


def _list_query(key: str, cols: list[str]):
    @register(key, O.with_(*LIST_CTES) + f"SELECT doc_id, i, {', '.join(cols)} FROM lr")
    def q(spark, sf):
        return lists.list_relations(contracts(spark, sf)).select("doc_id", "i", *cols)
    q.__name__ = f"q_{key}"
    return q


_list_query("list_marker", ["marker"])
_list_query("list_type", ["mtype"])
_list_query("list_content", ["content"])
_list_query("list_start", ["is_start"])
_list_query("list_same_type", ["same_type"])
_list_query("list_compare", ["prev_i", "prev_cmp"])
_list_query("list_growth", ["prev_i", "grows"])


@register("list_runs", O.with_(*LIST_CTES, """
lrun AS (SELECT *, sum(CASE WHEN grows THEN 0 ELSE 1 END)
                   OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run_id FROM lr)""") + """
SELECT doc_id, CAST(run_id AS BIGINT) AS run_id, min(i) AS first_i, max(i) AS last_i, count(*) AS n_items,
       arg_min(marker, i) AS first_marker, arg_max(marker, i) AS last_marker, arg_min(mtype, i) AS mtype
FROM lrun GROUP BY doc_id, run_id HAVING count(*) >= 2""")
def q_list_runs(spark, sf):
    return lists.list_runs(contracts(spark, sf))


# Feature, statistics, split and model queries register themselves on import.
from pactline.plans import catalog_features  # noqa: E402,F401
from pactline.plans import catalog_sources  # noqa: E402,F401
