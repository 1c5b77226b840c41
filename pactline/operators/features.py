"""Text features and corpus statistics.

Everything is in long form, one row per (doc_id, term) or (doc_id, pos,
token), so term statistics are plain ``groupBy`` aggregates (partial
aggregation before the shuffle; a very common term is just a large count,
never a collected list).  Dense vectors are only built for MLlib.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pactline.functions import text as T
from pactline.functions.stopwords import ENGLISH_STOPWORDS
from pactline.operators.segments import materialize, posexplode_once, task_parts
from pactline.operators.terms import join_terms, written


# --- tokens in long form (I4-I6) ------------------------------------------------

def tokens(docs: DataFrame, how: str = "sk", text_col: str = "text", clustered: bool = False) -> DataFrame:
    """(doc_id, pos, token): ``words`` (I4), ``sk`` (I5) or ``seq``.

    ``clustered`` hash-partitions the documents on doc_id first (one shuffle
    of the text), so per-document aggregates of the tokens (term counts,
    norms) need no further exchange.
    """
    fn = {"words": T.tokenize_words, "sk": T.tokenize_sk, "seq": T.tokenize_seq}[how]
    if clustered:
        docs = docs.repartition(task_parts(docs.sparkSession, docs), "doc_id")
    return docs.select("doc_id", posexplode_once(fn(text_col), "pos", "token")).where(F.col("pos").isNotNull())


def stopword_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in ENGLISH_STOPWORDS], "token string")


def remove_stopwords(toks: DataFrame) -> DataFrame:
    """Drop stop-word tokens (anti join with a fixed 179-word table)."""
    stop = F.broadcast(stopword_table(toks.sparkSession))
    return toks.join(stop, "token", "left_anti")


# --- counts (F6, F7, J1) ---------------------------------------------------------------

def term_counts(toks: DataFrame) -> DataFrame:
    """(doc_id, term, tf)."""
    return toks.groupBy("doc_id", F.col("token").alias("term")).agg(F.count(F.lit(1)).alias("tf"))


def corpus_term_counts(toks: DataFrame) -> DataFrame:
    """(term, n_tokens) over the corpus."""
    return toks.groupBy(F.col("token").alias("term")).agg(F.count(F.lit(1)).alias("n_tokens"))


def doc_freq(tf: DataFrame, n_docs: int, min_share: float = 0.0, max_share: float = 1.0) -> DataFrame:
    """(term, df) with ``min_share * n <= df <= max_share * n``."""
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return df.where((F.col("df") >= F.lit(min_share * n_docs)) & (F.col("df") <= F.lit(max_share * n_docs)))


# --- TF-IDF (J2-J4) -----------------------------------------------------------------------

def tfidf(tf: DataFrame, n_docs: int, df: DataFrame | None = None, least_df: float = 0.0) -> DataFrame:
    """Tf * (ln((1+n)/(1+df)) + 1), L2-normalised per document.

    ``df`` restricts the vocabulary (J3) to terms that at least ``least_df``
    documents have; the norm is over kept terms.
    """
    tf = materialize(tf)  # read by the df aggregate and by the weighting
    if df is None:
        df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    df = materialize(df)  # read for common and for rare terms
    idf = df.select("term", "df", (F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0).alias("idf"))
    w = join_terms(tf, idf, tf.count(), least_df).select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("w"))
    # A document's rows are its distinct terms (bounded by the vocabulary),
    # so the norm is a window over the document, not a second join.
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return w.select("doc_id", "term", (F.col("w") / norm).alias("tfidf"))


def tfidf_filtered(docs: DataFrame, min_share: float = 0.1, max_share: float = 0.5,
                   stem: bool = False) -> DataFrame:
    """Lower-case I4 tokens, optional stems, stop words out, df share filter."""
    n = docs.count()
    toks = tokens(docs.select("doc_id", F.lower("text").alias("text")), "words", clustered=True)
    if stem:  # counts first, so a word is joined with its stem once for each document it is in
        from pactline.operators.stems import stem_counts
        tf = stem_counts(materialize(term_counts(toks)), min_share * n, stopword_table(docs.sparkSession))
    else:
        tf = term_counts(remove_stopwords(toks))
    tf = materialize(tf)
    return tfidf(tf, n, doc_freq(tf, n, min_share, max_share), min_share * n)


def tfidf_log(tf: DataFrame, n_docs: int) -> DataFrame:
    """TF = ln(count), IDF = ln(N) / n_w, as written in the course notes."""
    tf = materialize(tf)
    df = materialize(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")))  # read for common and for rare terms
    return join_terms(tf, df.withColumn("_df", F.col("df")), tf.count()).select(
        "doc_id", "term", (F.log("tf") * F.lit(math.log(n_docs)) / F.col("_df")).alias("w"))


# --- vocabulary and sequences (G2, I8, I9) -------------------------------------------------

def vocab_topk(toks: DataFrame, num_words: int = 20000) -> DataFrame:
    """(word, word_index, n) for ranks 1..num_words-1.

    Order: falling count, ties by first appearance (doc_id, pos).  The
    ranking keeps the top num_words-1 with ``orderBy().limit()`` (per-task
    top-k, then a bounded merge), then numbers those few rows.
    """
    c = toks.groupBy(F.col("token").alias("word")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.struct("doc_id", "pos")).alias("first"))
    top = c.orderBy(F.desc("n"), F.asc("first")).limit(num_words - 1)
    w = Window.orderBy(F.desc("n"), F.asc("first"))
    return top.select("word", F.row_number().over(w).alias("word_index"), "n")


def _word_ids(toks: DataFrame, vocab: DataFrame, num_words: int) -> DataFrame:
    """Tokens with their word id.  Ids are distinct and only those below
    ``num_words`` count, so fewer than ``num_words`` words are broadcast."""
    known = vocab.where(F.col("word_index") < num_words).select(F.col("word").alias("token"), "word_index")
    return toks.join(F.broadcast(known), "token")


def texts_to_sequences(toks: DataFrame, vocab: DataFrame, docs: DataFrame, num_words: int = 20000) -> DataFrame:
    """I8: (doc_id, seq ARRAY<INT>) of known word ids (those below
    ``num_words``) in text order; docs with no known word keep an empty list."""
    ids = _word_ids(toks, vocab, num_words)
    seq = ids.groupBy("doc_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "word_index"))),
                    lambda s: s["word_index"]).alias("seq"))
    return (docs.select("doc_id").join(seq, "doc_id", "left")
            .select("doc_id", F.coalesce("seq", F.array().cast("array<int>")).alias("seq")))


def padded_sequences(toks: DataFrame, vocab: DataFrame, docs: DataFrame, maxlen: int = 1000,
                     num_words: int = 20000) -> DataFrame:
    """I8 + I9: (doc_id, padded ARRAY<INT>) = the last ``maxlen`` known ids,
    zero-padded on the left.

    Only the last ``maxlen`` ids of a document are kept, with a per-document
    top-k (``row_number() <= maxlen``), which Spark also applies before the
    shuffle; so no group ever holds more than ``maxlen`` rows.
    """
    ids = _word_ids(toks, vocab, num_words)
    w = Window.partitionBy("doc_id").orderBy(F.desc("pos"))
    last = ids.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= maxlen)
    seq = last.groupBy("doc_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "word_index"))),
                    lambda s: s["word_index"]).alias("seq"))
    seq = (docs.select("doc_id").join(seq, "doc_id", "left")
           .select("doc_id", F.coalesce("seq", F.array().cast("array<int>")).alias("seq")))
    return seq.select("doc_id", T.pad_sequence("seq", maxlen).alias("padded"))


# --- word vectors (A10 stand-in, E1, I11) ---------------------------------------------------

LONGEST_WITH_VECTOR = 14


def vocabulary(toks: DataFrame) -> DataFrame:
    """(word, n): every distinct token with its count."""
    return toks.groupBy(F.col("token").alias("word")).agg(F.count(F.lit(1)).alias("n"))


def word_vectors_from(vocab: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Word vectors derived from the given tables for the whole vocabulary.

    A word takes the embedding row picked by its first letter and length;
    like rare words in a vector file, words of over LONGEST_WITH_VECTOR
    letters have none.
    """
    n_emb = embeddings.count()
    return (vocab.where(F.length("word") <= LONGEST_WITH_VECTOR)
            .withColumn("vec_id", (F.ascii("word") * 31 + F.length("word")) % F.lit(n_emb))
            .join(embeddings.select("vec_id", F.col("embedding").alias("vec")), "vec_id")
            .select("word", "vec"))


def embedding_lookup(vocab: DataFrame, vectors: DataFrame, dim: int, missing: str = "zeros",
                     seed: int = 0) -> DataFrame:
    """Every vocabulary word with its vector.

    A word without a vector gets zeros, or with ``missing="random"`` a
    uniform [0, 1) vector drawn from a seeded hash of (seed, word, dim), so
    a recomputed task draws the same numbers.
    """
    if missing == "random":
        fill = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                           lambda j: (F.abs(F.xxhash64(F.lit(seed), F.col("word"), j) % 1000003)
                                      / 1000003.0).cast("float"))
    else:
        fill = F.array_repeat(F.lit(0.0).cast("float"), dim)
    return (vocab.join(vectors, "word", "left")
            .select(*vocab.columns, F.col("vec").isNotNull().alias("has_vector"),
                    F.coalesce("vec", fill).alias("vec")))


def doc_means(docs: DataFrame, toks: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """(doc_id, mean array<double>), the mean word vector of every document.

    Tokens are counted per document first, and equal vectors are known by a
    number: only documents, words and numbers move, and a vector joins once for
    each document that it is in.  The sums are plain columns, one for each
    dimension.  Null vectors and null elements are left out; a dimension
    without any value is zero.
    """
    known = vectors.where(F.col("vec").isNotNull())
    distinct = written(known.select("vec").distinct().select("vec", F.monotonically_increasing_id().alias("vid")), "vectors")
    tf = materialize(toks.groupBy("doc_id", F.col("token").alias("term")).agg(F.count(F.lit(1)).alias("n")))
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    stats = df.join(known.join(distinct, "vec").select(F.col("word").alias("term"), "vid"), "term")
    met = join_terms(tf, materialize(stats), tf.count()).select("doc_id", "vid", "n")
    met = met.repartition(task_parts(docs.sparkSession, docs), "doc_id").groupBy("doc_id", "vid").agg(F.sum("n").alias("n"))
    at = [F.get("vec", F.lit(j)).cast("double") for j in range(dim)]
    sums = [c for j, x in enumerate(at) for c in (F.sum(F.col("n") * x).alias(f"s_{j}"),
                                                  F.sum(F.when(x.isNotNull(), F.col("n"))).alias(f"n_{j}"))]
    sums = met.join(distinct, "vid").groupBy("doc_id").agg(*sums)
    mean = F.array(*[F.coalesce(F.col(f"s_{j}") / F.col(f"n_{j}"), F.lit(0.0)) for j in range(dim)])
    return docs.select("doc_id").join(sums, "doc_id", "left").select("doc_id", mean.alias("mean"))


def doc_vectors(docs: DataFrame, toks: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """``doc_means`` in long form (doc_id, dim, value)."""
    return doc_means(docs, toks, vectors, dim).select("doc_id", posexplode_once("mean", "dim", "value")).where(
        F.col("dim").isNotNull())


# --- profiles and sizes (F1-F4) -------------------------------------------------------------

def profile_distinct(df: DataFrame, cols: list[str], approx: bool = False) -> DataFrame:
    """distinct values per column, a null counting as one value.

    ``approx`` uses HyperLogLog++ sketches (fixed memory per column) instead
    of exact distinct sets.  Exact counts compare strings by their 128-bit
    digest, so long texts are not copied into the distinct sets."""
    dist = F.approx_count_distinct if approx else F.count_distinct
    kinds = dict(df.dtypes)
    thin = df.select(*[(F.md5(F.col(c).cast("binary")) if kinds[c] == "string" else F.col(c)).alias(c) for c in cols])
    return thin.agg(*[(dist(c) + F.max(F.col(c).isNull().cast("int"))).alias(f"n_{c}") for c in cols])


def shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"))


def cluster_sizes(assign: DataFrame) -> DataFrame:
    """rows per (k, cluster)."""
    return assign.groupBy("k", "cluster").agg(F.count(F.lit(1)).alias("n"))


def cluster_sizes_dense(assign: DataFrame, ks: list[int], slots: int = 45) -> DataFrame:
    """zero-filled sizes, one row per cluster slot, one column per k."""
    spark = assign.sparkSession
    sizes = cluster_sizes(assign)
    grid = spark.range(slots).select(F.col("id").cast("int").alias("cluster"),
                                     F.explode(F.array(*[F.lit(k) for k in ks])).alias("k"))
    full = grid.join(sizes, ["k", "cluster"], "left").select("cluster", "k", F.coalesce("n", F.lit(0)).alias("n"))
    return (full.groupBy("cluster").pivot("k", ks).agg(F.sum("n"))
            .select("cluster", *[F.coalesce(F.col(str(k)), F.lit(0)).cast("long").alias(f"k_{k}") for k in ks]))


# --- labels (H1, G3) ------------------------------------------------------------------------

FLAG_OF_TAG = {"title": 0, "s": 1, "l": 2, "p": 3}


def label_union(tagged: DataFrame) -> DataFrame:
    """H1: (text, flag) with titles 0, headers 1, sub-headers 2, plain 3."""
    flag = F.coalesce(*[F.when(F.col("tag") == t, f) for t, f in FLAG_OF_TAG.items()])
    return tagged.select(F.col("line").alias("text"), flag.alias("flag")).where(F.col("flag").isNotNull())


def argmax_label(scores: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Class with the largest score per row, lowest class on ties.

    One row per (id, class); the window is per id over its k classes.
    """
    w = Window.partitionBy(id_col).orderBy(F.desc("score"), F.asc("class"))
    return (scores.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
            .select(id_col, F.col("class").alias("pred"), "score"))


def head_n(df: DataFrame, n: int, *order: str) -> DataFrame:
    """G1: first n rows in an explicit order."""
    return df.orderBy(*order).limit(n)


def one_hot_labels(df: DataFrame, label: str, k: int) -> DataFrame:
    """I10 on a label column."""
    return df.withColumn("one_hot", T.one_hot(label, k))


def seq_text(col: str | Column) -> Column:
    return F.array_join(T._c(col).cast("array<string>"), " ")
