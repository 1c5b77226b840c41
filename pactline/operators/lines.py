"""Documents to lines (B1) and line normalisation (C1, A6 statuses).

Rules N1-N3: line 0 always starts the output; a later line that starts
with ``[a-z]`` is glued to the previous kept line with no separator;
blank lines are dropped.  A blank line 0 collapses the document to that
line, or fails (``error_blank_first``) when a continuation follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactline.functions import patterns as P
from pactline.functions.text import is_blank, is_continuation
from pactline.operators import segments as S

OK, COLLAPSED = "ok", "blank_first_collapsed"
ERR_BLANK_FIRST, ERR_EMPTY, ERR_UNREADABLE = "error_blank_first", "error_empty", "error_unreadable"
ERR_EXHIBIT_ONLY = "error_exhibit_only"


def document_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text) -> (doc_id, pos, line, n_lines) like ``str.splitlines`` (B1).

    ``n_lines`` is known from the split text, so the tagger sees before any
    exchange whether a document spans more than one chunk.
    """
    # Every break becomes "\n" with char-level ops, so the split itself is a
    # single-character split (no regex engine over the whole text).
    t = F.col(text_col)
    t = F.when(F.instr(t, "\r\n") > 0, F.replace(t, F.lit("\r\n"), F.lit("\n"))).otherwise(t)
    t = F.translate(t, P.LINEBREAK_CHARS, "\n" * len(P.LINEBREAK_CHARS))
    split = docs.select(F.col(id_col).alias("doc_id"), F.split(t, "\n").alias("parts"))
    parts = F.col("parts")
    parts = F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)
    return split.select("doc_id", parts.alias("parts")).select(
        "doc_id", F.size("parts").alias("n_lines"), "parts").select(
        "doc_id", "n_lines", S.posexplode_once("parts", "pos", "line")).where(F.col("pos").isNotNull())


def split_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text) -> (doc_id, pos, line) (B1)."""
    return document_lines(docs, text_col, id_col).select("doc_id", "pos", "line")


def text_status(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Statuses decided from the text alone: null and empty texts."""
    t = F.col(text_col)
    return docs.select(F.col(id_col).alias("doc_id"),
                       F.when(t.isNull(), F.lit(ERR_UNREADABLE))
                        .when(t == "", F.lit(ERR_EMPTY)).alias("status"))


def _raw(lines: DataFrame, chunk_lines: int) -> tuple[DataFrame, DataFrame]:
    """(lines of one-chunk documents, lines of longer ones) under ``S.KEYS``, one exchange each.

    With ``n_lines`` (``document_lines``) the two kinds part before the
    exchange.  For other line tables every line of a document's second chunk
    sends a mark (a row without position) to the first chunk, so each chunk
    knows by itself whether the document goes on; positions start below
    ``chunk_lines`` and leave out no whole chunk.  Only longer documents are
    kept for their several readers.
    """
    pos = F.col("pos")
    chunk, flags = S.chunk_of(pos, chunk_lines), [is_blank("line").alias("blank"), is_continuation("line").alias("cont")]
    parts = S.task_parts(lines.sparkSession, lines)
    own = F.struct(chunk.alias("chunk"), pos.alias("pos"), F.col("line").alias("line"))
    if "n_lines" in lines.columns:
        # an inline, since a filter on the count would move below the split and split every text again
        few = F.col("n_lines") <= chunk_lines
        short, long = [lines.select("doc_id", F.inline_outer(F.when(c, F.array(own)))).where(pos.isNotNull()).select(
            *S.KEYS, "pos", "line", *flags).repartition(parts, *S.KEYS) for c in (few, ~few)]
        return short, S.materialize(long)
    mark = F.struct(F.lit(0).cast("long").alias("chunk"), F.lit(None).cast(lines.schema["pos"].dataType).alias("pos"),
                    F.lit(None).cast("string").alias("line"))
    x = lines.select("doc_id", F.inline(F.when(chunk == 1, F.array(own, mark)).otherwise(F.array(own))))
    x = x.select(*S.KEYS, "pos", "line", *flags).repartition(parts, *S.KEYS)
    goes_on = F.max(pos.isNull()).over(Window.partitionBy(*S.KEYS))
    x = x.withColumn("multi", (F.col("chunk") > 0) | goes_on).where(pos.isNotNull())
    return x.where(~F.col("multi")).drop("multi"), S.materialize(x.where("multi").drop("multi"))


def _status(first_blank: Column, any_cont: Column) -> Column:
    return (F.when(first_blank & any_cont, F.lit(ERR_BLANK_FIRST)).when(first_blank, F.lit(COLLAPSED))
             .otherwise(F.lit(OK)))


def _keep(first: Column, failed: bool = False) -> Column:
    """Lines that stay; with ``failed`` a failing document keeps its first line."""
    return (F.when(F.col("status") == OK, ~F.col("blank")).when(F.col("status") == COLLAPSED, first)
             .otherwise(first if failed else F.lit(False)))


def _raw_summary(x: DataFrame) -> DataFrame:
    """One row per (doc_id, chunk) with what later chunks and the doc need."""
    cs = x.groupBy(*S.KEYS).agg(
        F.min("pos").alias("c_min_pos"),
        F.min_by("blank", "pos").alias("c_first_blank"),
        F.min_by("cont", "pos").alias("c_first_cont"),
        S.count_if(~F.col("blank") & ~F.col("cont")).alias("c_starts"),
        S.count_if(F.col("cont")).alias("c_cont"))
    cs = cs.select(
        *S.KEYS, "c_starts",
        F.first("c_min_pos").over(S.doc()).alias("d_first_pos"),
        F.first("c_first_blank").over(S.doc()).alias("d_first_blank"),
        F.first("c_first_cont").over(S.doc()).alias("d_first_cont"),
        F.sum("c_cont").over(S.doc()).alias("d_cont"),
        F.min("chunk").over(S.doc()).alias("d_first_chunk"),
        F.coalesce(F.sum("c_starts").over(S.prev_chunks()), F.lit(0)).alias("starts_before"))
    has_start = (F.col("c_starts") > 0) | (F.col("chunk") == F.col("d_first_chunk"))
    return cs.select(*S.KEYS, "d_first_pos", "d_first_cont", "starts_before",
                     _status(F.col("d_first_blank"), F.col("d_cont") > 0).alias("status"),
                     (F.col("chunk") == F.col("d_first_chunk")).alias("is_first_chunk"),
                     F.max(F.when(has_start, F.col("chunk"))).over(S.prev_chunks()).alias("head_chunk"))


def _single_chunk(x: DataFrame) -> DataFrame:
    """Lines with ``first`` and ``status``: all the document is in the window."""
    whole = Window.partitionBy(*S.KEYS)
    x = x.withColumn("first", F.col("pos") == F.min("pos").over(whole))
    return x.withColumn("status", _status(F.max(F.col("first") & F.col("blank")).over(whole),
                                          F.max("cont").over(whole)))


def _norm_single(x: DataFrame, failed: bool = False) -> DataFrame:
    """Documents inside one chunk: windows and one aggregate, no join, no further exchange.

    With ``failed`` the lines carry the document's status, and a failing
    document is its first line.
    """
    y = x.where(_keep(F.col("first"), failed))
    g = F.sum((~F.col("cont") | F.col("first")).cast("int")).over(S.running("pos"))
    more = ["status"] if failed else []
    groups = y.select(*S.KEYS, "pos", "line", g.alias("g"), *more).groupBy(*S.KEYS, "g")
    return groups.agg(S.ordered_concat("pos", "line").alias("line"), *[F.max(c).alias(c) for c in more]).select(
        *S.KEYS, (F.col("g") - 1).cast("int").alias("i"), "line", "g", *more)


def _norm_multi(x: DataFrame, cs: DataFrame, failed: bool = False) -> DataFrame:
    """Documents over several chunks: glue per chunk, then carry tails; ``failed`` as above."""
    more = ["status"] if failed else []
    y = x.join(cs, S.KEYS)
    first = F.col("pos") == F.col("d_first_pos")
    y = y.where(_keep(first, failed))
    g = (F.col("starts_before") + F.sum((~F.col("cont")).cast("int")).over(S.running("pos"))
         + F.col("d_first_cont").cast("int"))
    y = y.select(*S.KEYS, "pos", "line", "head_chunk", (~F.col("cont") | first).alias("is_start"), g.alias("g"), *more)
    pieces = y.groupBy(*S.KEYS, "g").agg(
        *[F.max(c).alias(c) for c in more],
        F.min("pos").alias("spos"),
        F.max("is_start").alias("has_head"),
        F.max("head_chunk").alias("head_chunk"),
        S.ordered_concat("pos", "line").alias("piece"))
    # A group can run past its chunk's end: its continuation pieces (no head)
    # are few (at most one per chunk) and are glued back by one keyed join.
    tails = (pieces.where(~F.col("has_head"))
             .groupBy("doc_id", F.col("head_chunk").alias("chunk"))
             .agg(F.max("g").alias("tail_g"), S.ordered_concat("spos", "piece").alias("tail")))
    heads = pieces.where(F.col("has_head")).join(tails, S.KEYS, "left")
    line = F.when(F.col("g") == F.col("tail_g"), F.concat("piece", "tail")).otherwise(F.col("piece"))
    out = heads.select(*S.KEYS, (F.col("g") - 1).cast("int").alias("i"), line.alias("line"), "g", *more)
    return S.materialize(out)


def normalized_parts(lines: DataFrame, chunk_lines: int = S.CHUNK_LINES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(single-chunk documents, longer documents, (doc_id, status)) of a line table.

    Both parts are always planned and no job runs here; without longer
    documents Spark drops the second part as it meets its empty stages.
    """
    short, long = _raw(lines, chunk_lines)
    short, cs = _single_chunk(short), _raw_summary(long)
    statuses = short.where("first").select("doc_id", "status").unionByName(
        cs.where("is_first_chunk").select("doc_id", "status"))
    return _norm_single(short), _norm_multi(long, cs), statuses


def normalized_with_status(lines: DataFrame, chunk_lines: int = S.CHUNK_LINES) -> tuple[DataFrame, DataFrame]:
    """(single-chunk documents, longer documents), each line with its document's
    status; a failing document is its first line, so no status is derived apart."""
    short, long = _raw(lines, chunk_lines)
    return _norm_single(_single_chunk(short), True), _norm_multi(long, _raw_summary(long), True)


def normalized(lines: DataFrame, chunk_lines: int = S.CHUNK_LINES) -> tuple[DataFrame, DataFrame]:
    """Normalised lines (doc_id, chunk, i, line) and (doc_id, status).

    ``chunk`` is the chunk of the line's first raw line, so the output keeps
    the ``(doc_id, chunk)`` partitioning of the input exchange.
    """
    single, multi, statuses = normalized_parts(lines, chunk_lines)
    return single.unionByName(multi), statuses


def normalize_lines(lines: DataFrame) -> DataFrame:
    """(doc_id, pos, line) -> (doc_id, i, line)."""
    out, _ = normalized(lines)
    return out.select("doc_id", "i", "line")
