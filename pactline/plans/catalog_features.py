"""Registered queries for text features, statistics, splits and models."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pactline.functions import patterns as P
from pactline.functions import text as T
from pactline.functions.stopwords import ENGLISH_STOPWORDS
from pactline.operators import bayes as B
from pactline.operators import clusters as K
from pactline.operators import features as FE
from pactline.operators import models as M
from pactline.operators import split as SP
from pactline.operators import svm as S
from pactline.operators import tagger
from pactline.operators.segments import materialize
from pactline.operators.stems import stem_vocab
from pactline.operators.terms import written
from pactline.plans import oracle as O
from pactline.plans.registry import C_TAG, register
from pactline.sources.contracts import contracts
from pactline.sources.tables import documents, table

q = O.q

# --- SQL fragments -----------------------------------------------------------------------

CLEAN_SQL = f"lower(regexp_replace(translate(text, {q(P.CLEAN_CHARS)}, ''), {q(P.EDGE_WS)}, '', 'g'))"
WORDS_SQL = f"list_filter(string_split_regex(translate(text, {q(P.PUNCTUATION)}, ''), {q(P.WS + '+')}), lambda x: x <> '')"
SK_SQL = f"regexp_extract_all(lower(text), {q(P.WORD2)})"
SEQ_SQL = (f"list_filter(string_split(lower(translate(text, {q(P.SEQ_FILTERS)}, "
           f"{q(' ' * len(P.SEQ_FILTERS))})), ' '), lambda x: x <> '')")


def toks_cte(name: str, list_sql: str, src: str = "documents") -> str:
    return f"""
{name} AS (
  SELECT doc_id, CAST(unnest(range(len(t))) AS INTEGER) AS pos, unnest(t) AS token
  FROM (SELECT doc_id, {list_sql} AS t FROM {src})
)"""


STOP_CTE = "stop AS (SELECT unnest([" + ", ".join(q(w) for w in ENGLISH_STOPWORDS) + "]) AS token)"
N_DOCS = "(SELECT count(*) FROM documents)"

TF_SK = [toks_cte("toks", SK_SQL),
         "tf AS (SELECT doc_id, token AS term, count(*) AS tf FROM toks GROUP BY doc_id, token)"]

TFIDF_CTES = ["""
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)""", f"""
w AS (SELECT doc_id, term, tf * (ln((1.0 + {N_DOCS}) / (1.0 + df)) + 1.0) AS w FROM tf JOIN df USING (term))""", """
tfidf AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM w)"""]

VOCAB_CTES = [toks_cte("stoks", SEQ_SQL), """
vc AS (SELECT token AS word, count(*) AS n, min(doc_id * 100000000 + pos) AS first FROM stoks GROUP BY token)""", """
vocab AS (SELECT word, row_number() OVER (ORDER BY n DESC, first) AS word_index, n
          FROM vc QUALIFY row_number() OVER (ORDER BY n DESC, first) <= 19999)"""]

WORDVEC_CTES = [toks_cte("stoks", SEQ_SQL), """
words AS (SELECT token AS word, count(*) AS n FROM stoks GROUP BY token)""", """
wv AS (SELECT v.word, e.embedding AS vec FROM words v
       JOIN embeddings e ON e.vec_id = (unicode(v.word) * 31 + length(v.word)) % (SELECT count(*) FROM embeddings)
       WHERE length(v.word) <= 14)"""]

SPLIT_CTE = f"""
split AS (
  SELECT doc_id,
         row_number() OVER (ORDER BY md5('11-' || CAST(doc_id AS VARCHAR)), doc_id) - 1
           < ceil(0.3 * {N_DOCS}) AS is_test
  FROM documents
)"""


def nb_sql(keys: str, roles_cte: str) -> list[str]:
    """NB scores over roles(k..., doc_id, is_test); keys like 'fold' or '_k'."""
    kj = f"USING ({keys}, doc_id)"
    return [toks_cte("toks", SK_SQL),
            "tfa AS (SELECT doc_id, token AS term, count(*) AS tf FROM toks GROUP BY doc_id, token)",
            roles_cte,
            "lab AS (SELECT doc_id, lang AS label FROM documents)",
            f"tr AS (SELECT r.{keys}, t.doc_id, t.term, t.tf FROM tfa t JOIN roles r USING (doc_id) WHERE NOT r.is_test)",
            f"te AS (SELECT r.{keys}, t.doc_id, t.term, t.tf FROM tfa t JOIN roles r USING (doc_id) WHERE r.is_test)",
            f"n AS (SELECT {keys}, CAST(count(*) AS DOUBLE) AS n FROM roles WHERE NOT is_test GROUP BY {keys})",
            f"idf AS (SELECT {keys}, term, ln((1.0 + n) / (1.0 + count(*))) + 1.0 AS idf FROM tr JOIN n USING ({keys}) GROUP BY {keys}, term, n)",
            f"wtr AS (SELECT {keys}, doc_id, term, tf * idf AS w FROM tr JOIN idf USING ({keys}, term))",
            f"xtr AS (SELECT {keys}, doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY {keys}, doc_id)) AS x FROM wtr)",
            f"nct AS (SELECT {keys}, label, term, sum(x) AS nct FROM xtr JOIN lab USING (doc_id) GROUP BY {keys}, label, term)",
            f"v AS (SELECT {keys}, count(*) AS v FROM idf GROUP BY {keys})",
            f"nc AS (SELECT {keys}, label, sum(nct) AS nc FROM nct GROUP BY {keys}, label)",
            f"cnt AS (SELECT {keys}, label, count(*) AS n_c FROM roles JOIN lab USING (doc_id) WHERE NOT is_test GROUP BY {keys}, label)",
            f"""stats AS (SELECT c.{keys}, c.label AS class, ln(c.n_c / n.n) AS prior, ln(coalesce(nc.nc, 0) + v.v) AS lnorm
                FROM cnt c JOIN n USING ({keys}) JOIN v USING ({keys}) LEFT JOIN nc USING ({keys}, label))""",
            f"wte AS (SELECT {keys}, doc_id, term, tf * idf AS w FROM te JOIN idf USING ({keys}, term))",
            f"xte AS (SELECT {keys}, doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY {keys}, doc_id)) AS x FROM wte)",
            f"ws AS (SELECT {keys}, doc_id, sum(x) AS xs FROM xte GROUP BY {keys}, doc_id)",
            f"""ex AS (SELECT {keys}, doc_id, label AS class, sum(x * ln(nct + 1.0)) AS e
                FROM xte JOIN nct USING ({keys}, term) GROUP BY {keys}, doc_id, label)""",
            f"""scores AS (
              SELECT r.{keys}, r.doc_id, s.class,
                     s.prior - s.lnorm * coalesce(ws.xs, 0) + coalesce(ex.e, 0) AS score
              FROM roles r JOIN stats s ON r.{keys} = s.{keys}
              LEFT JOIN ws ON ws.{keys} = r.{keys} AND ws.doc_id = r.doc_id
              LEFT JOIN ex ON ex.{keys} = r.{keys} AND ex.doc_id = r.doc_id AND ex.class = s.class
              WHERE r.is_test)""",
            f"""pred AS (SELECT {keys}, doc_id, class AS pred, score FROM scores
              QUALIFY row_number() OVER (PARTITION BY {keys}, doc_id ORDER BY score DESC, class) = 1)"""]


NB_SPLIT = nb_sql("_k", SPLIT_CTE.strip() + ",\nroles AS (SELECT 0 AS _k, doc_id, is_test FROM split)")
FOLDS_CTE = """folds AS (SELECT doc_id, CAST(ntile(10) OVER (ORDER BY doc_id) - 1 AS INTEGER) AS fold FROM documents),
roles AS (
  SELECT f.fold AS fold, d.doc_id, d.fold = f.fold AS is_test
  FROM folds d JOIN (SELECT DISTINCT fold FROM folds) f ON true
)"""
NB_CV = nb_sql("fold", FOLDS_CTE)


# --- Spark helpers ---------------------------------------------------------------------------

def _docs(spark, sf, *cols):
    return documents(spark, sf, *(cols or ("doc_id", "text")))


def _labels(spark, sf):
    return documents(spark, sf, "doc_id", "lang").withColumnRenamed("lang", "label")


def _tf_sk(spark, sf):
    return FE.term_counts(FE.tokens(_docs(spark, sf), "sk", clustered=True))


def _split(spark, sf):
    return SP.holdout_split(_docs(spark, sf, "doc_id"), "doc_id", 0.3, 11)


def _parts(spark, sf):
    return B.holdout_parts(_split(spark, sf))


def _nb_pred(spark, sf):
    return B.predict(_tf_sk(spark, sf), _labels(spark, sf), _parts(spark, sf)).select("doc_id", "pred", "score")


def _vocab(spark, sf):
    return FE.vocab_topk(FE.tokens(_docs(spark, sf), "seq"))


def _words(spark, sf):
    return FE.vocabulary(FE.tokens(_docs(spark, sf), "seq"))


def _word_vectors(spark, sf):
    return FE.word_vectors_from(_words(spark, sf), table(spark, sf, "embeddings", "vec_id", "embedding"))


def _doc_vectors(spark, sf, vectors=FE.doc_vectors):
    docs = _docs(spark, sf)
    return vectors(docs, FE.tokens(docs, "seq", clustered=True), _word_vectors(spark, sf), 64)


# --- I1-I6 text functions -----------------------------------------------------------------------

@register("clean_text", f"SELECT doc_id, {CLEAN_SQL} AS clean FROM documents")
def q_clean_text(spark, sf):
    return _docs(spark, sf).select("doc_id", T.clean_text("text").alias("clean"))


@register("lower_flat", "SELECT doc_id, replace(lower(text), chr(10), ' ') AS flat FROM documents")
def q_lower_flat(spark, sf):
    return _docs(spark, sf).select("doc_id", T.lower_flat("text").alias("flat"))


@register("strip_punct", f"SELECT doc_id, translate(text, {q(P.PUNCTUATION)}, '') AS stripped FROM documents")
def q_strip_punct(spark, sf):
    return _docs(spark, sf).select("doc_id", T.strip_punct("text").alias("stripped"))


@register("tokenize_words", O.with_(toks_cte("toks", WORDS_SQL)) + "SELECT doc_id, pos, token FROM toks")
def q_tokenize_words(spark, sf):
    return FE.tokens(_docs(spark, sf), "words")


@register("tokenize_sk", O.with_(toks_cte("toks", SK_SQL)) + "SELECT doc_id, pos, token FROM toks")
def q_tokenize_sk(spark, sf):
    return FE.tokens(_docs(spark, sf), "sk")


@register("tokenize_seq", O.with_(toks_cte("toks", SEQ_SQL)) + "SELECT doc_id, pos, token FROM toks")
def q_tokenize_seq(spark, sf):
    return FE.tokens(_docs(spark, sf), "seq")


LOWER_WORDS = toks_cte("wt", WORDS_SQL, "(SELECT doc_id, lower(text) AS text FROM documents)")


@register("stem_vocab", O.with_(LOWER_WORDS, *O.stem_ctes("wt")) + "SELECT token, stem FROM stems")
def q_stem_vocab(spark, sf):
    return stem_vocab(FE.tokens(_docs(spark, sf).select("doc_id", F.lower("text").alias("text")), "words"))


# --- F / J1-J4 counts and TF-IDF -------------------------------------------------------------------

@register("term_counts", O.with_(toks_cte("toks", SK_SQL)) +
          "SELECT token AS term, count(*) AS n_tokens FROM toks GROUP BY token")
def q_term_counts(spark, sf):
    return FE.corpus_term_counts(FE.tokens(_docs(spark, sf), "sk"))


@register("count_vectorize", O.with_(*TF_SK) + "SELECT doc_id, term, tf FROM tf")
def q_count_vectorize(spark, sf):
    return _tf_sk(spark, sf)


@register("doc_freq", O.with_(*TF_SK) + f"""
SELECT term, count(*) AS df FROM tf GROUP BY term
HAVING count(*) >= 0.1 * {N_DOCS} AND count(*) <= 0.5 * {N_DOCS}""")
def q_doc_freq(spark, sf):
    n = _docs(spark, sf, "doc_id").count()
    return FE.doc_freq(_tf_sk(spark, sf), n, 0.1, 0.5)


@register("tfidf", O.with_(*TF_SK, *TFIDF_CTES) + "SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM tfidf")
def q_tfidf(spark, sf):
    n = _docs(spark, sf, "doc_id").count()
    return FE.tfidf(_tf_sk(spark, sf), n).select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"))


FILTERED_CTES = [
    "tf0 AS (SELECT doc_id, token AS term, count(*) AS tf FROM kept GROUP BY doc_id, token)",
    f"""df AS (SELECT term, count(*) AS df FROM tf0 GROUP BY term
              HAVING count(*) >= 0.1 * {N_DOCS} AND count(*) <= 0.5 * {N_DOCS})""",
    "tf AS (SELECT tf0.* FROM tf0 JOIN df USING (term))",
    f"w AS (SELECT doc_id, term, tf * (ln((1.0 + {N_DOCS}) / (1.0 + df)) + 1.0) AS w FROM tf JOIN df USING (term))",
    "tfidf AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM w)"]


@register("tfidf_filtered", O.with_(
    LOWER_WORDS, STOP_CTE, "kept AS (SELECT * FROM wt WHERE token NOT IN (SELECT token FROM stop))", *FILTERED_CTES)
    + "SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM tfidf")
def q_tfidf_filtered(spark, sf):
    return FE.tfidf_filtered(_docs(spark, sf)).select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"))


@register("tfidf_filtered_stemmed", O.with_(
    LOWER_WORDS, *O.stem_ctes("wt"), STOP_CTE,
    """kept AS (SELECT doc_id, stem AS token FROM wt JOIN stems USING (token)
                WHERE stem NOT IN (SELECT token FROM stop))""", *FILTERED_CTES)
    + "SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM tfidf")
def q_tfidf_filtered_stemmed(spark, sf):
    """J3 as the reference runs it: stems (I7) before stop words and the df filter."""
    return FE.tfidf_filtered(_docs(spark, sf), stem=True).select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"))


@register("tfidf_log", O.with_(*TF_SK, "df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)") + f"""
SELECT doc_id, term, round(ln(tf) * ln({N_DOCS}) / df, 6) AS w FROM tf JOIN df USING (term)""")
def q_tfidf_log(spark, sf):
    n = _docs(spark, sf, "doc_id").count()
    return FE.tfidf_log(_tf_sk(spark, sf), n).select("doc_id", "term", F.round("w", 6).alias("w"))


# --- E1-E3 lookups ----------------------------------------------------------------------------------

@register("stopword_removal", O.with_(
    toks_cte("wt", WORDS_SQL, "(SELECT doc_id, lower(text) AS text FROM documents)"), STOP_CTE)
    + "SELECT doc_id, pos, token FROM wt WHERE token NOT IN (SELECT token FROM stop)")
def q_stopword_removal(spark, sf):
    return FE.remove_stopwords(FE.tokens(_docs(spark, sf).select("doc_id", F.lower("text").alias("text")), "words"))


@register("embedding_lookup", O.with_(*WORDVEC_CTES) + """
SELECT v.word, v.n, wv.vec IS NOT NULL AS has_vector,
       round(coalesce(list_sum(wv.vec::DOUBLE[]), 0), 4) AS vec_sum
FROM words v LEFT JOIN wv ON v.word = wv.word""")
def q_embedding_lookup(spark, sf):
    e = FE.embedding_lookup(_words(spark, sf), _word_vectors(spark, sf), 64)
    return e.select("word", "n", "has_vector",
                    F.round(F.aggregate("vec", F.lit(0.0).cast("double"), lambda a, x: a + x), 4).alias("vec_sum"))


@register("doc_vector", O.with_(*WORDVEC_CTES, """
dv AS (SELECT t.doc_id, unnest(range(len(wv.vec))) AS dim, unnest(wv.vec) AS x
       FROM stoks t JOIN wv ON t.token = wv.word)""", """
mean AS (SELECT doc_id, dim, avg(x::DOUBLE) AS value FROM dv GROUP BY doc_id, dim)""") +
    """SELECT d.doc_id, CAST(d.dim AS INTEGER) AS dim, round(coalesce(value, 0), 5) AS value
FROM (SELECT doc_id, unnest(range(64)) AS dim FROM documents) d LEFT JOIN mean m ON m.doc_id = d.doc_id AND m.dim = d.dim""")
def q_doc_vector(spark, sf):
    v = _doc_vectors(spark, sf)
    return v.select("doc_id", "dim", F.round("value", 5).alias("value"))


# --- F1-F5 profiles and sizes ---------------------------------------------------------------------------

@register("profile_distinct", f"""
SELECT count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) AS n_doc_id,
       count(DISTINCT lang) + max(CASE WHEN lang IS NULL THEN 1 ELSE 0 END) AS n_lang,
       count(DISTINCT source) + max(CASE WHEN source IS NULL THEN 1 ELSE 0 END) AS n_source,
       count(DISTINCT clean) + max(CASE WHEN clean IS NULL THEN 1 ELSE 0 END) AS n_clean
FROM (SELECT doc_id, lang, source, {CLEAN_SQL} AS clean FROM documents)""")
def q_profile_distinct(spark, sf):
    d = documents(spark, sf, "doc_id", "lang", "source", "text").withColumn("clean", T.clean_text("text"))
    return FE.profile_distinct(d, ["doc_id", "lang", "source", "clean"])


@register("shape", "SELECT count(*) AS n_rows, 5 AS n_cols FROM documents")
def q_shape(spark, sf):
    return FE.shape(documents(spark, sf, "doc_id", "text", "lang", "source", "n_chars"))


def _assignments(spark, sf):
    """Stand-in cluster ids derived from ``embeddings``: one column per k."""
    e = table(spark, sf, "embeddings", "vec_id", "label")
    ks = list(range(25, 46))
    return (e.select("vec_id", F.explode(F.array(*[F.lit(k) for k in ks])).alias("k"), "label")
            .select("vec_id", "k", ((F.col("label") * 7 + F.col("vec_id")) % F.col("k")).cast("int").alias("cluster")))


ASSIGN_SQL = """assign AS (SELECT vec_id, CAST(k AS INTEGER) AS k, CAST((label * 7 + vec_id) % k AS INTEGER) AS cluster
                  FROM embeddings, (SELECT unnest(range(25, 46)) AS k))"""


@register("cluster_sizes", O.with_(ASSIGN_SQL) + "SELECT k, cluster, count(*) AS n FROM assign GROUP BY k, cluster")
def q_cluster_sizes(spark, sf):
    return FE.cluster_sizes(_assignments(spark, sf))


@register("cluster_sizes_dense", O.with_(ASSIGN_SQL) + "SELECT s.cluster, " + ", ".join(
    f"CAST(coalesce(sum(CASE WHEN a.k = {k} THEN 1 END), 0) AS BIGINT) AS k_{k}" for k in range(25, 46))
    + " FROM (SELECT CAST(unnest(range(45)) AS INTEGER) AS cluster) s LEFT JOIN assign a ON a.cluster = s.cluster GROUP BY s.cluster")
def q_cluster_sizes_dense(spark, sf):
    return FE.cluster_sizes_dense(_assignments(spark, sf), list(range(25, 46)), 45)


@register("group_lists", O.with_(*C_TAG) + """
SELECT doc_id,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE tag = 'title'), '') AS titles,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE tag = 's'), '') AS headers,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE tag = 'l'), '') AS sub_headers,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE tag = 'p'), '') AS plain
FROM tagged GROUP BY doc_id""")
def q_group_lists(spark, sf):
    t = tagger.tag_positions(contracts(spark, sf))

    def lst(tag):
        return F.array_join(F.transform(F.array_sort(F.collect_list(
            F.when(F.col("tag") == tag, F.struct("i", "line")))), lambda s: s["line"]), "\n")
    return t.groupBy("doc_id").agg(lst("title").alias("titles"), lst("s").alias("headers"),
                                   lst("l").alias("sub_headers"), lst("p").alias("plain"))


@register("label_union", O.with_(*C_TAG) + """
SELECT line AS text, CASE tag WHEN 'title' THEN 0 WHEN 's' THEN 1 WHEN 'l' THEN 2 ELSE 3 END AS flag
FROM tagged WHERE tag IN ('title', 's', 'l', 'p')""")
def q_label_union(spark, sf):
    return FE.label_union(tagger.tag_positions(contracts(spark, sf)))


@register("head_n", "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY doc_id LIMIT 10")
def q_head_n(spark, sf):
    return FE.head_n(documents(spark, sf, "doc_id", "lang", "source", "n_chars"), 10, "doc_id")


# --- G2, I8-I10 vocabulary and sequences ----------------------------------------------------------------

@register("vocab_topk", O.with_(*VOCAB_CTES) + "SELECT word, CAST(word_index AS INTEGER) AS word_index, n FROM vocab")
def q_vocab_topk(spark, sf):
    return _vocab(spark, sf).select("word", F.col("word_index").cast("int"), "n")


SEQ_CTES = VOCAB_CTES + ["""
seqs AS (SELECT d.doc_id,
                coalesce(list(v.word_index ORDER BY t.pos) FILTER (WHERE v.word_index IS NOT NULL), []) AS seq
         FROM documents d LEFT JOIN stoks t ON d.doc_id = t.doc_id LEFT JOIN vocab v ON t.token = v.word
         GROUP BY d.doc_id)"""]


@register("texts_to_sequences", O.with_(*SEQ_CTES) +
          "SELECT doc_id, CAST(len(seq) AS INTEGER) AS seq_len, array_to_string(seq, ' ') AS seq_text FROM seqs")
def q_texts_to_sequences(spark, sf):
    s = FE.texts_to_sequences(FE.tokens(_docs(spark, sf), "seq"), _vocab(spark, sf), _docs(spark, sf, "doc_id"))
    return s.select("doc_id", F.size("seq").alias("seq_len"), FE.seq_text("seq").alias("seq_text"))


@register("pad_sequences", O.with_(*SEQ_CTES) + """
SELECT doc_id, array_to_string(list_concat(list_transform(range(1000 - len(kept)), lambda x: 0), kept), ' ') AS padded
FROM (SELECT doc_id, CASE WHEN len(seq) > 1000 THEN seq[len(seq) - 999:] ELSE seq END AS kept FROM seqs)""")
def q_pad_sequences(spark, sf):
    s = FE.padded_sequences(FE.tokens(_docs(spark, sf), "seq"), _vocab(spark, sf), _docs(spark, sf, "doc_id"), 1000)
    return s.select("doc_id", FE.seq_text("padded").alias("padded"))


@register("one_hot", """
SELECT vec_id, array_to_string(list_transform(range(10), lambda j: CASE WHEN j = label THEN 1 ELSE 0 END), ',') AS one_hot
FROM embeddings""")
def q_one_hot(spark, sf):
    e = table(spark, sf, "embeddings", "vec_id", "label")
    return e.select("vec_id", F.array_join(T.one_hot("label", 10).cast("array<string>"), ",").alias("one_hot"))


# --- J5, J10, J11 splits --------------------------------------------------------------------------------

@register("kfold", "SELECT doc_id, CAST(ntile(10) OVER (ORDER BY doc_id) - 1 AS INTEGER) AS fold FROM documents")
def q_kfold(spark, sf):
    return SP.kfold(_docs(spark, sf, "doc_id"), "doc_id", 10)


@register("holdout_split", O.with_(SPLIT_CTE) + "SELECT doc_id, is_test FROM split")
def q_holdout_split(spark, sf):
    return _split(spark, sf)


@register("holdout_split_tail", f"""
SELECT doc_id, row_number() OVER (ORDER BY md5('13-' || CAST(doc_id AS VARCHAR)), doc_id) - 1
               >= {N_DOCS} - CAST(floor(0.2 * {N_DOCS}) AS BIGINT) AS is_val
FROM documents""")
def q_holdout_split_tail(spark, sf):
    return SP.holdout_split_tail(_docs(spark, sf, "doc_id"), "doc_id", 0.2, 13)


# --- J7, G3, J12, J13, J9, F8, J16 Naive Bayes and metrics ---------------------------------------------

@register("naive_bayes", O.with_(*NB_SPLIT) + "SELECT doc_id, pred FROM pred")
def q_naive_bayes(spark, sf):
    return _nb_pred(spark, sf).select("doc_id", "pred")


@register("argmax_label", O.with_(*NB_SPLIT) + "SELECT doc_id, pred, round(score, 6) AS score FROM pred")
def q_argmax_label(spark, sf):
    return _nb_pred(spark, sf).select("doc_id", "pred", F.round("score", 6).alias("score"))


@register("accuracy", O.with_(*NB_SPLIT) +
          "SELECT round(avg(CASE WHEN p.pred = l.label THEN 1.0 ELSE 0.0 END), 6) AS accuracy "
          "FROM pred p JOIN lab l USING (doc_id)")
def q_accuracy(spark, sf):
    return M.accuracy(_nb_pred(spark, sf), _labels(spark, sf)).select(F.round("accuracy", 6).alias("accuracy"))


@register("f1_report", O.with_(*NB_SPLIT, """
j AS (SELECT l.label AS y, p.pred AS p FROM pred p JOIN lab l USING (doc_id))""") + """,
cl AS (SELECT y AS cls FROM j UNION SELECT p FROM j),
per AS (
  SELECT cl.cls,
         (SELECT count(*) FROM j WHERE y = cl.cls AND p = cl.cls) AS tp,
         (SELECT count(*) FROM j WHERE y = cl.cls) AS support,
         (SELECT count(*) FROM j WHERE p = cl.cls) AS npred
  FROM cl),
pr AS (SELECT cls, tp, support, npred,
              CASE WHEN npred > 0 THEN tp / npred ELSE 0.0 END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
      FROM pr)
SELECT cls, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM (
SELECT cls, precision, recall, f1, support FROM f
UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f
UNION ALL SELECT 'micro avg', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support),
                 sum(support) FROM f
UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                 sum(f1 * support) / sum(support), sum(support) FROM f)""")
def q_f1_report(spark, sf):
    r = M.f1_report(_nb_pred(spark, sf), _labels(spark, sf))
    return r.select("cls", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


SVM_STEPS, SVM_ALPHA = 5, 0.001


def svm_sql(keys: str) -> list[str]:
    """Sub-gradient steps written out over the CTEs of ``nb_sql``: x(keys, doc_id, term, x) trains or is scored."""
    kt = f"USING ({keys}, term)"
    out = [f"""xs_tr AS MATERIALIZED (SELECT {keys}, doc_id, term, x FROM xtr
                 UNION ALL SELECT {keys}, doc_id, '', 1.0 FROM roles WHERE NOT is_test)""",
           f"""xs_te AS MATERIALIZED (SELECT {keys}, doc_id, term, x FROM xte
                 UNION ALL SELECT {keys}, doc_id, '', 1.0 FROM roles WHERE is_test)""",
           f"""w1 AS MATERIALIZED (SELECT {keys}, term, class, sum(CASE WHEN label = class THEN x ELSE -x END) / ({SVM_ALPHA} * any_value(n)) AS w
                 FROM xs_tr JOIN lab USING (doc_id) JOIN n USING ({keys}), (SELECT DISTINCT label AS class FROM lab)
                 GROUP BY {keys}, term, class)"""]
    for t in range(2, SVM_STEPS + 1):
        out += [f"""a{t} AS MATERIALIZED (SELECT {keys}, doc_id, class, CASE WHEN label = class THEN 1.0 ELSE -1.0 END AS y
                      FROM (SELECT {keys}, doc_id, class, sum(x * w) AS m FROM xs_tr JOIN w{t - 1} {kt} GROUP BY {keys}, doc_id, class)
                      JOIN lab USING (doc_id) WHERE CASE WHEN label = class THEN m ELSE -m END < 1.0)""",
                f"""d{t} AS MATERIALIZED (SELECT {keys}, term, class, sum(x * y) AS d
                      FROM xs_tr JOIN a{t} USING ({keys}, doc_id) GROUP BY {keys}, term, class)""",
                f"""w{t} AS MATERIALIZED (SELECT {keys}, term, class, (1.0 - 1.0 / {t}) * w + coalesce(d, 0.0) / ({SVM_ALPHA} * {t} * n) AS w
                      FROM w{t - 1} LEFT JOIN d{t} USING ({keys}, term, class) JOIN n USING ({keys}))"""]
    return out + [f"""svm AS (SELECT {keys}, doc_id, class AS pred
        FROM (SELECT {keys}, doc_id, class, sum(x * w) AS score FROM xs_te JOIN w{SVM_STEPS} {kt} GROUP BY {keys}, doc_id, class)
        QUALIFY row_number() OVER (PARTITION BY {keys}, doc_id ORDER BY score DESC, class) = 1)"""]


FOLDS = 10


def _cv_scores(spark, sf, labels=None, svm=True):
    """(model, fold, accuracy) of both models; all folds of a model in one plan."""
    labels = _labels(spark, sf) if labels is None else labels
    parts = B.fold_parts(SP.kfold(_docs(spark, sf, "doc_id"), "doc_id", FOLDS))
    x = B.weighted(_tf_sk(spark, sf), parts, FOLDS)
    found = [("MNB", B.predict(None, labels, parts, FOLDS, x))]
    if svm:
        found.append(("SGD", S.predict(x, labels, parts, FOLDS, SVM_STEPS, SVM_ALPHA)))
    scores = [M.score_history(M.accuracy(p.withColumnRenamed("part", "fold"), labels, ["fold"]), name)
              for name, p in found]
    return reduce(DataFrame.unionByName, scores)


def cv_acc(pred: str) -> str:
    return f"""SELECT fold, avg(CASE WHEN p.pred = l.label THEN 1.0 ELSE 0.0 END) AS accuracy
FROM {pred} p JOIN lab l USING (doc_id) GROUP BY fold"""


CV_BOTH = O.with_(*NB_CV, *svm_sql("fold"), f"""
cv AS (SELECT 'MNB' AS model, * FROM ({cv_acc('pred')}) UNION ALL SELECT 'SGD', * FROM ({cv_acc('svm')}))""")


@register("cv_accuracy", CV_BOTH + "SELECT model, fold, round(accuracy, 6) AS accuracy FROM cv")
def q_cv_accuracy(spark, sf):
    return _cv_scores(spark, sf).select("model", "fold", F.round("accuracy", 6).alias("accuracy"))


@register("mean_score", CV_BOTH + "SELECT model, round(avg(accuracy), 6) AS mean_accuracy FROM cv GROUP BY model")
def q_mean_score(spark, sf):
    return _cv_scores(spark, sf).groupBy("model").agg(F.round(F.avg("accuracy"), 6).alias("mean_accuracy"))


@register("score_history", CV_BOTH + "SELECT model, fold, round(accuracy, 6) AS accuracy FROM cv")
def q_score_history(spark, sf):
    return _cv_scores(spark, sf).select("model", "fold", F.round("accuracy", 6).alias("accuracy")).orderBy("model", "fold")


@register("linear_svm", O.with_(*NB_SPLIT, *svm_sql("_k")) + "SELECT doc_id, pred FROM svm")
def q_linear_svm(spark, sf):
    parts = _parts(spark, sf)
    x = B.weighted(_tf_sk(spark, sf), parts)
    return S.predict(x, _labels(spark, sf), parts, 1, SVM_STEPS, SVM_ALPHA).select("doc_id", "pred")


# --- A11, J14 saved models -----------------------------------------------------------------------------

def _fitted(spark, sf):
    parts = _parts(spark, sf)
    x = B.weighted(_tf_sk(spark, sf), parts)
    return x, parts, B.fit(x, _labels(spark, sf), parts)


def _saved(spark, model):
    from pactline.session import checkpoint_dir
    path = f"{checkpoint_dir(spark).rstrip('/')}/pactline-models/bayes-{uuid.uuid4().hex}"
    B.save_model(model, path)
    return B.load_model(spark, path)


def _test_docs(spark, sf):
    test = _split(spark, sf).where("is_test").select("doc_id")
    return test, _tf_sk(spark, sf).join(test, "doc_id", "left_semi")


@register("batch_predict", O.with_(*NB_SPLIT) + "SELECT doc_id, pred, round(score, 6) AS score FROM pred")
def q_batch_predict(spark, sf):
    test, tf = _test_docs(spark, sf)
    found = B.score_documents(_saved(spark, _fitted(spark, sf)[2]), tf, test)
    return found.select("doc_id", "pred", F.round("score", 6).alias("score"))


@register("model_io", O.with_(*NB_SPLIT) + """
SELECT doc_id, pred AS saved_pred, pred AS fitted_pred, round(score, 6) AS saved_score, round(score, 6) AS fitted_score FROM pred""")
def q_model_io(spark, sf):
    """Every held-out document scored by the fitted tables and by the tables that were saved and loaded."""
    model = _fitted(spark, sf)[2]
    test, tf = _test_docs(spark, sf)
    tf = materialize(tf)
    both = [B.score_documents(m, tf, test).select("doc_id", F.col("pred").alias(f"{name}_pred"),
                                                  F.round("score", 6).alias(f"{name}_score"))
            for name, m in (("saved", _saved(spark, model)), ("fitted", model))]
    return both[0].join(both[1], "doc_id")


# --- J6, E3 the sweep and its clusters -------------------------------------------------------------------

KS = list(range(25, 46))


def sweep_sql() -> list[str]:
    """Lloyd iterations for all k, written out."""
    out = ["feats AS MATERIALIZED (SELECT doc_id, term, tfidf AS x FROM tfidf)",
           "seeds AS MATERIALIZED (SELECT doc_id, row_number() OVER (ORDER BY md5('1-' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS r FROM documents)",
           f"slots AS MATERIALIZED (SELECT k, r AS cluster, doc_id AS seed FROM seeds, (SELECT unnest(range({KS[0]}, {KS[-1] + 1})) AS k) WHERE r < k)",
           "sq AS MATERIALIZED (SELECT d.doc_id, coalesce(sum(x * x), 0) AS xx FROM documents d LEFT JOIN feats USING (doc_id) GROUP BY d.doc_id)",
           "c0 AS MATERIALIZED (SELECT k, cluster, term, x AS v FROM slots JOIN feats ON feats.doc_id = seed)"]
    for t in range(K.ITERATIONS + 1):
        out.append(f"""as{t} AS MATERIALIZED (
  SELECT doc_id, k, (min({{'d': round(xx - 2 * coalesce(xc, 0) + coalesce(cc, 0), 9), 'c': cluster}})).c AS cluster
  FROM sq CROSS JOIN slots
  LEFT JOIN (SELECT f.doc_id, k, cluster, sum(x * v) AS xc FROM feats f JOIN c{t} USING (term) GROUP BY ALL) USING (doc_id, k, cluster)
  LEFT JOIN (SELECT k, cluster, sum(v * v) AS cc FROM c{t} GROUP BY ALL) USING (k, cluster)
  GROUP BY doc_id, k)""".replace("sq CROSS JOIN slots", "sq CROSS JOIN (SELECT k, cluster FROM slots)"))
        if t < K.ITERATIONS:
            out.append(f"""c{t + 1} AS MATERIALIZED (
  SELECT a.k, a.cluster, term, sum(x) / any_value(n) AS v FROM as{t} a JOIN feats USING (doc_id)
  JOIN (SELECT k, cluster, count(*) AS n FROM as{t} GROUP BY ALL) s ON s.k = a.k AND s.cluster = a.cluster GROUP BY a.k, a.cluster, term
  UNION ALL SELECT * FROM c{t} ANTI JOIN as{t} USING (k, cluster))""")
    return [*out, f"swept AS (SELECT doc_id, CAST(k AS INTEGER) AS k, CAST(cluster AS INTEGER) AS cluster FROM as{K.ITERATIONS})"]


SWEEP_CTES = [LOWER_WORDS, *O.stem_ctes("wt"), STOP_CTE, """kept AS (SELECT doc_id, stem AS token FROM wt JOIN stems USING (token)
                WHERE stem NOT IN (SELECT token FROM stop))""", *FILTERED_CTES, *sweep_sql()]


@register("kmeans_sweep", O.with_(*SWEEP_CTES) + "SELECT doc_id, k, cluster FROM swept")
def q_kmeans_sweep(spark, sf):
    return K.kmeans_sweep(_docs(spark, sf), KS).select("doc_id", "k", "cluster")


@register("attach_clusters", O.with_(*SWEEP_CTES) + "SELECT d.doc_id, d.lang, " + ", ".join(
    f"max(cluster) FILTER (k = {k}) AS cluster_by_text_{k}" for k in KS)
    + " FROM documents d LEFT JOIN swept s ON s.doc_id = d.doc_id GROUP BY d.doc_id, d.lang")
def q_attach_clusters(spark, sf):
    """The sweep's clusters as columns of the documents."""
    docs = _docs(spark, sf, "doc_id", "text", "lang")
    return K.attach_clusters(docs.select("doc_id", "lang"), K.cluster_table(docs, KS), KS)


CLUSTER_LABELS = "lab AS (SELECT doc_id, cluster AS label FROM swept WHERE k = 35)"


@register("cv_clusters", O.with_(*SWEEP_CTES, *[CLUSTER_LABELS if c.startswith("lab AS") else c for c in NB_CV])
          + f"SELECT fold, round(accuracy, 6) AS accuracy FROM ({cv_acc('pred')})")
def q_cv_clusters(spark, sf):
    """J9 as the reference runs it: the classes are the clusters of k = 35."""
    clusters = K.cluster_table(_docs(spark, sf), [35])
    return _cv_scores(spark, sf, K.cluster_labels(clusters, 35), svm=False).select("fold", F.round("accuracy", 6).alias("accuracy"))


# --- J15 ---------------------------------------------------------------------------------------------------

@register("neural_classifier", O.with_(SPLIT_CTE) + """
SELECT doc_id, true AS known_label, true AS above_majority FROM split WHERE is_test""")
def q_neural_classifier(spark, sf):
    """Each held-out document: is the predicted class a fitted one, and are more of them right than the commonest class is."""
    from pyspark.ml.functions import array_to_vector
    means = _doc_vectors(spark, sf, FE.doc_means).groupBy("doc_id").agg(F.first("mean").alias("v"), F.count(F.lit(1)).alias("n"))
    feats = means.where(F.col("n") == 1).select("doc_id", array_to_vector("v").alias("features"))  # an id that repeats is left out
    d = written(feats.join(_labels(spark, sf), "doc_id").join(_split(spark, sf), "doc_id"), "pooled")
    train = d.where(~F.col("is_test") & F.col("label").isNotNull())
    test = d.where(F.col("is_test")).withColumnRenamed("label", "given")  # unlabelled rows are predicted too
    k = train.select("label").distinct().count()
    model = M.mlp_classifier(64, k).fit(train)
    names = F.array(*[F.lit(x) for x in model.stages[0].labels])
    found = model.transform(test).select("doc_id", F.col("given").alias("label"), F.element_at(names, F.col("prediction").cast("int") + 1).alias("pred"))
    found = materialize(found)
    most = found.where(F.col("label").isNotNull()).groupBy("label").count().agg(F.max("count").alias("most"), F.sum("count").alias("n"))
    right = found.agg(F.sum((F.col("pred") == F.col("label")).cast("int")).alias("right"))
    above = right.first()["right"] > most.first()["most"]
    return found.select("doc_id", F.array_contains(names, F.col("pred")).alias("known_label"), F.lit(above).alias("above_majority"))
