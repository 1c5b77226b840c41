"""Line tagging (C2-C11) and the flagship tag summary.

Rules on the normalised lines of one document (n lines):

* T1 line 0 ``Exhibit…``: line 1 is the title, search starts at 2 (a
  one-line document fails); else a line 0 starting with a word char or
  blank is the title, search starts at 1; else search starts at 0.
* T2 SECTION/EXACT -> ``s``; else LIST and not SINGLENUM -> ``l``.
* T3 unless every ``s`` line is upper case, upper-case ``s`` lines lose it.
* T4 every other non-blank line is ``p``.
* T5 bits: title 1, s 1, l 3, p 3; an ``s`` line directly followed by an
  ``s`` line gets 3 when the running ``s`` count is odd; when the total
  ``s`` count is even and > 0 the last line becomes ``s`` with bits 2.
* T6 render: bit0 -> ``<tag> `` prefix, bit1 -> strip right, `` </tag>``.

Doc-level values (n, line 0 flags, the upper rule, section totals) come
from a per-chunk summary; scans run inside ``(doc_id, chunk)`` partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pactline.functions import text as T
from pactline.operators import lines as L
from pactline.operators import segments as S

TAGGED_COLS = ["doc_id", "i", "line", "tag", "bits"]


def _tag_summary_chunks(z: DataFrame) -> DataFrame:
    i, cand_s, up = F.col("i"), F.col("cand_s"), F.col("up")
    cs = z.groupBy(*S.KEYS).agg(
        F.count(F.lit(1)).alias("n_c"),
        F.min("i").alias("first_i"),
        F.min_by("cand_s", "i").alias("first_cs"),
        F.min_by("up", "i").alias("first_up"),
        S.count_if(cand_s & ~up & (i >= 2)).alias("cnt_l"),
        S.count_if(cand_s & up & (i >= 2)).alias("cnt_u"),
        F.max(i == 0).alias("has0"), F.max((i == 0) & cand_s).alias("cs0"),
        F.max((i == 0) & up).alias("up0"), F.max((i == 0) & F.col("ex")).alias("ex0"),
        F.max((i == 0) & F.col("ti")).alias("ti0"),
        F.max(i == 1).alias("has1"), F.max((i == 1) & cand_s).alias("cs1"),
        F.max((i == 1) & up).alias("up1"))
    cs = cs.select(
        "*",
        F.sum("n_c").over(S.doc()).alias("n"),
        F.max("ex0").over(S.doc()).alias("d_ex0"), F.max("ti0").over(S.doc()).alias("d_ti0"),
        F.max("cs0").over(S.doc()).alias("d_cs0"), F.max("up0").over(S.doc()).alias("d_up0"),
        F.max("cs1").over(S.doc()).alias("d_cs1"), F.max("up1").over(S.doc()).alias("d_up1"),
        F.sum("cnt_l").over(S.doc()).alias("d_cnt_l"))
    start = F.when(F.col("d_ex0"), 2).when(F.col("d_ti0"), 1).otherwise(0)
    cs = cs.withColumn("start", start)
    s0 = F.col("d_cs0") & (F.col("start") == 0)
    s1 = F.col("d_cs1") & (F.col("start") <= 1)
    all_upper = (F.col("d_cnt_l") == 0) & ~(s0 & ~F.col("d_up0")) & ~(s1 & ~F.col("d_up1"))
    cs = cs.withColumn("all_upper", all_upper)
    au = F.col("all_upper")
    sc = (F.col("cnt_l") + F.when(au, F.col("cnt_u")).otherwise(0)
          + (F.col("has0") & s0 & (au | ~F.col("d_up0"))).cast("int")
          + (F.col("has1") & s1 & (au | ~F.col("d_up1"))).cast("int"))
    first_is_s = F.col("first_cs") & (F.col("first_i") >= F.col("start")) & (au | ~F.col("first_up"))
    cs = cs.withColumn("sc", sc).withColumn("first_is_s", first_is_s)
    return cs.select(
        *S.KEYS, "n", "start", "all_upper",
        F.col("d_ex0").alias("exhibit0"), F.col("d_ti0").alias("title0"),
        F.sum("sc").over(S.doc()).alias("tot"),
        F.coalesce(F.sum("sc").over(S.prev_chunks()), F.lit(0)).alias("s_before"),
        F.lead("first_is_s").over(S.chunks()).alias("next_first_is_s"))


def _classify(norm: DataFrame) -> DataFrame:
    i, line = F.col("i"), F.col("line")
    return norm.select(
        *S.KEYS, "i", "g", "line",
        T.is_blank(line).alias("blank"),
        (~T.is_blank(line) & T.is_section(line)).alias("cand_s"),
        (~T.is_blank(line) & T.is_list_line(line)).alias("cand_l"),
        # only section candidates are ever asked whether they are upper case
        F.when(~T.is_blank(line) & T.is_section(line), T.is_upper(line)).otherwise(False).alias("up"),
        F.when(i == 0, T.is_exhibit(line)).otherwise(False).alias("ex"),
        F.when(i == 0, T.is_title(line)).otherwise(False).alias("ti"), *_status_of(norm))


def _status_of(x: DataFrame) -> list[str]:
    """The status column, where the lines carry one."""
    return ["status"] if "status" in x.columns else []


def _rule_tags(y: DataFrame) -> DataFrame:
    """T1-T4 given doc-level start / exhibit0 / title0 / all_upper columns."""
    i, start, blank = F.col("i"), F.col("start"), F.col("blank")
    is_title_line = ((F.col("exhibit0") & (i == 1))
                     | (~F.col("exhibit0") & F.col("title0") & (i == 0)))
    s_raw = F.col("cand_s") & (i >= start)
    l_raw = F.col("cand_l") & (i >= start) & ~s_raw
    is_s = s_raw & (F.col("all_upper") | ~F.col("up"))
    raw_tag = (F.when(is_title_line, F.lit("title")).when(s_raw, F.lit("s")).when(l_raw, F.lit("l")))
    tag_t3 = (F.when(is_title_line, F.lit("title")).when(is_s, F.lit("s")).when(l_raw, F.lit("l")))
    tag_t4 = F.when(tag_t3.isNull() & ~blank, F.lit("p")).otherwise(tag_t3)
    return y.select("*", raw_tag.alias("raw_tag"), tag_t3.alias("tag_t3"), tag_t4.alias("tag_t4"),
                    is_s.alias("is_s"))


def _final(y: DataFrame, si, nxt) -> DataFrame:
    """T5 bits and the closing last line, given running s count and next-is-s."""
    t4 = F.col("tag_t4")
    bits = (F.when(t4 == "s", F.when(nxt & (si % 2 == 1), 3).otherwise(1))
             .when(t4 == "title", 1).when(t4.isin("l", "p"), 3).otherwise(0))
    last = (F.col("i") == F.col("n") - 1) & (F.col("tot") > 0) & (F.col("tot") % 2 == 0)
    return y.select(*S.KEYS, "i", "g", "line", "raw_tag", "tag_t3", "tag_t4",
                    F.when(last, F.lit("s")).otherwise(t4).alias("tag"),
                    F.when(last, F.lit(2)).otherwise(bits).alias("bits"),
                    "n", "start", "all_upper", "exhibit0", "title0", "tot", *_status_of(y))


def _alone(x: DataFrame) -> DataFrame:
    """A one-line document whose line 0 is an Exhibit line fails (T1): it goes,
    or, where the lines carry a status, its line stays with that status."""
    alone = F.col("exhibit0") & (F.col("n") == 1)
    if not _status_of(x):
        return x.where(~alone)
    return x.withColumn("status", F.when(alone & (F.col("status") == L.OK), F.lit(L.ERR_EXHIBIT_ONLY))
                        .otherwise(F.col("status")))


def _tags_single(norm: DataFrame) -> DataFrame:
    """Documents inside one chunk: every doc-level value is a window value."""
    z = _classify(norm)
    whole = Window.partitionBy(*S.KEYS)
    i = F.col("i")
    z = z.select("*", F.count(F.lit(1)).over(whole).alias("n"),
                 F.max("ex").over(whole).alias("exhibit0"), F.max("ti").over(whole).alias("title0"))
    z = _alone(z)
    z = z.withColumn("start", F.when(F.col("exhibit0"), 2).when(F.col("title0"), 1).otherwise(0))
    s_raw = F.col("cand_s") & (i >= F.col("start"))
    z = z.withColumn("all_upper", F.coalesce(F.min(F.when(s_raw, F.col("up"))).over(whole), F.lit(True)))
    z = _rule_tags(z)
    z = z.withColumn("tot", F.sum(F.col("is_s").cast("int")).over(whole))
    si = F.sum(F.col("is_s").cast("int")).over(S.running("g"))
    nxt = F.coalesce(F.lead("is_s").over(S.local_window("g")), F.lit(False))
    return _final(z, si, nxt)


def _tags_multi(norm: DataFrame) -> DataFrame:
    """Documents over several chunks: doc-level values from the chunk summary."""
    z = _classify(norm)
    cs = _tag_summary_chunks(z)
    y = _rule_tags(_alone(z.join(cs, S.KEYS)))
    si = F.col("s_before") + F.sum(F.col("is_s").cast("int")).over(S.running("i"))
    nxt = F.coalesce(F.lead("is_s").over(S.local_window("i")), F.col("next_first_is_s"), F.lit(False))
    return S.materialize(_final(y, si, nxt))


def tag_parts(lines: DataFrame, chunk_lines: int = S.CHUNK_LINES) -> tuple[DataFrame, DataFrame]:
    """(single-chunk documents, longer documents) of the tag frame."""
    single, multi, _ = L.normalized_parts(lines, chunk_lines)
    return _tags_single(single), _tags_multi(multi)


def tag_frame(lines: DataFrame, chunk_lines: int = S.CHUNK_LINES) -> DataFrame:
    """Every tagging column, one row per normalised line of a tagged document.

    Columns: doc_id, chunk, i, line, raw_tag (T1+T2), tag_t3, tag_t4, tag,
    bits, n, start, all_upper, exhibit0, title0, tot.  Documents inside one
    chunk (nearly all) are tagged with windows over their partition; longer
    ones use the chunk summary carry.
    """
    single, multi = tag_parts(lines, chunk_lines)
    return single.unionByName(multi)


# --- public operators --------------------------------------------------------

def title_position(lines: DataFrame) -> DataFrame:
    """(doc_id, title_pos, search_start) per tagged document."""
    f = tag_frame(lines)
    tp = F.when(F.col("exhibit0"), 1).when(F.col("title0"), 0)
    return (f.where(F.col("i") == 0)
            .select("doc_id", tp.alias("title_pos"), F.col("start").alias("search_start")))


def line_tags_raw(lines: DataFrame) -> DataFrame:
    """(doc_id, i, raw_tag) after rules T1 and T2."""
    return tag_frame(lines).select("doc_id", "i", "raw_tag")


def sections_all_upper(lines: DataFrame) -> DataFrame:
    """C4: (doc_id, all_upper); true when a document has no sections."""
    return tag_frame(lines).where(F.col("i") == 0).select("doc_id", "all_upper")


def demote_upper_sections(lines: DataFrame) -> DataFrame:
    """(doc_id, i, tag) after rule T3."""
    return tag_frame(lines).select("doc_id", "i", F.col("tag_t3").alias("tag"))


def plain_fill(lines: DataFrame) -> DataFrame:
    """(doc_id, i, tag) after rule T4."""
    return tag_frame(lines).select("doc_id", "i", F.col("tag_t4").alias("tag"))


def tag_positions(lines: DataFrame) -> DataFrame:
    """(doc_id, i, line, tag, bits) — the whole tagger."""
    return tag_frame(lines).select(*TAGGED_COLS)


def tag_mark_open(tag) -> F.Column:
    """C9 ``<tag>``."""
    return F.concat(F.lit("<"), T._c(tag), F.lit(">"))


def tag_mark_close(tag) -> F.Column:
    """C9 ``</tag>``."""
    return F.concat(F.lit("</"), T._c(tag), F.lit(">"))


def tag_wrap(text, tag) -> F.Column:
    """C9 ``<tag>text</tag>`` with no blanks."""
    return F.concat(tag_mark_open(tag), T._c(text), tag_mark_close(tag))


def rendered_line(line="line", tag="tag", bits="bits") -> F.Column:
    """C10 rule T6 for one line."""
    line, tag, bits = T._c(line), T._c(tag), T._c(bits)
    opened = F.when(tag.isNotNull() & ((bits % 2) == 1),
                    F.concat(tag_mark_open(tag), F.lit(" "), line)).otherwise(line)
    return F.when(tag.isNotNull() & (bits >= 2),
                  F.concat(T.rstrip_ws(opened), F.lit(" "), tag_mark_close(tag))).otherwise(opened)


def render_lines(tagged: DataFrame) -> DataFrame:
    """Adds ``rendered`` to a tagged line table."""
    return tagged.withColumn("rendered", rendered_line())


def parse_raw_text(lines: DataFrame) -> DataFrame:
    """C11: (doc_id, tagged_text), rendered lines joined by newline.

    Joined per chunk first (inside the chunk partition), then per document
    over at most one string per chunk.
    """
    f = tag_frame(lines).select(*S.KEYS, "i", rendered_line().alias("rendered"))
    per_chunk = f.groupBy(*S.KEYS).agg(S.ordered_concat("i", "rendered", "\n").alias("part"))
    return (per_chunk.groupBy("doc_id")
            .agg(S.ordered_concat("chunk", "part", "\n").alias("tagged_text")))


def document_outcomes(lines: DataFrame, chunk_lines: int = S.CHUNK_LINES) -> DataFrame:
    """(doc_id, status, tagged_text) for every document of a line table.

    C11 and A6 in one derivation: the status travels with the lines, and the
    two aggregates that join them take it along.  ``tagged_text`` is null for
    documents that fail.
    """
    single, multi = L.normalized_with_status(lines, chunk_lines)
    f = _tags_single(single).unionByName(_tags_multi(multi)).select(
        *S.KEYS, "i", "status", rendered_line().alias("rendered"))
    per_chunk = f.groupBy(*S.KEYS).agg(S.ordered_concat("i", "rendered", "\n").alias("part"),
                                       F.max("status").alias("status"))
    docs = per_chunk.groupBy("doc_id").agg(S.ordered_concat("chunk", "part", "\n").alias("text"),
                                           F.max("status").alias("status"))
    return docs.select("doc_id", "status", F.when(~F.col("status").startswith("error_"), F.col("text"))
                       .alias("tagged_text"))


def line_status(lines: DataFrame) -> DataFrame:
    """(doc_id, status) for every document of a line table."""
    norm, statuses = L.normalized(lines)
    none = F.lit(None)
    rows = statuses.select("doc_id", "status", none.cast("boolean").alias("ex")).unionByName(
        norm.select("doc_id", none.cast("string").alias("status"),
                    F.when(F.col("i") == 0, T.is_exhibit("line")).otherwise(False).alias("ex")))
    st = rows.groupBy("doc_id").agg(F.max("status").alias("status"), F.count("ex").alias("n"), F.max("ex").alias("ex0"))
    alone = (F.col("n") == 1) & F.col("ex0") & (F.col("status") == L.OK)
    return st.select("doc_id", F.when(alone, F.lit(L.ERR_EXHIBIT_ONLY)).otherwise(F.col("status")).alias("status"))


def quarantine(lines: DataFrame) -> DataFrame:
    """Documents that fail, to be written apart."""
    return line_status(lines).where(F.col("status").startswith("error_"))


def document_status(docs: DataFrame) -> DataFrame:
    """A6 for a text table: null / empty texts, then the line rules."""
    pre = L.text_status(docs)
    lines_st = line_status(L.document_lines(docs))
    return (pre.join(lines_st.withColumnRenamed("status", "line_status"), "doc_id", "left")
            .select("doc_id", F.coalesce(F.col("status"), F.col("line_status")).alias("status")))


def tag_summary(tagged: DataFrame) -> DataFrame:
    """tagged line counts per (tag, bits); partial aggregation first."""
    return (tagged.where(F.col("tag").isNotNull())
            .groupBy("tag", "bits").agg(F.count(F.lit(1)).alias("n_lines")))


def tag_counts_per_doc(tagged: DataFrame) -> DataFrame:
    """F9 per document: (doc_id, tag, n_lines)."""
    return (tagged.where(F.col("tag").isNotNull())
            .groupBy("doc_id", "tag").agg(F.count(F.lit(1)).alias("n_lines")))
