"""Registered queries for sources and sinks.

Each query derives files from the given tables, writes them under a fresh
folder in the session's shared checkpoint folder, and reads them back
through the source under test, so its work grows with the tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pactline.operators import tagger
from pactline.plans import oracle as O
from pactline.plans.registry import C_TAG, D_TAG, RENDER_SQL, register
from pactline.plans.catalog_features import WORDVEC_CTES, _word_vectors
from pactline.sources import corpus as C
from pactline.sources import records as R
from pactline.sources.contracts import contracts
from pactline.sources.tables import documents, table

DOC_FROM_PATH = r"doc_id=(\d+)"
FILE_FROM_PATH = r"folder=(\d+)/part-[0-9a-f-]+[.-]c(\d+)\."
#: Files that the stand-in corpus keeps in a folder, on average.
FOLDER_FILES = 1024


def _numbered(spark, sf, *columns):
    """Documents with the folder and the number of their file in it."""
    docs = documents(spark, sf, "doc_id", *columns)
    folders = max(spark.sparkContext.defaultParallelism, docs.count() // FOLDER_FILES)
    return docs.withColumn("folder", F.pmod(F.hash("doc_id"), F.lit(folders))).repartition(folders, "folder")


def _number():
    """Number of a document's file in its folder, in the order of the ids."""
    return F.row_number().over(Window.partitionBy("folder").orderBy("doc_id")) - 1


_local_path = C.local_path


def _write_here(root, suffix):
    """Writes (folder, number, content), one file a row; a file appears under its name when it is whole."""
    import os

    import pyarrow as pa

    def run(batches):
        for b in batches:
            for folder, number, content in zip(*[c.to_pylist() for c in b.columns]):
                place = f"{root}/folder={folder}"
                name = f"part-{folder:05d}-c{number:06d}.{suffix}"
                draft = f"{place}/.{name}-{uuid.uuid4().hex}"
                os.makedirs(place, exist_ok=True)
                with open(draft, "wb") as f:
                    f.write(content)
                os.replace(draft, f"{place}/{name}")
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})
    return run


def _write_files(numbered, out, kind) -> None:
    """One file per document, hashed folders of many files each; a folder's
    files are numbered in the order of the ids.

    Hadoop's local file system starts a process for each file that it creates
    (chmod), so on a local folder the tasks write the files themselves.
    """
    local = _local_path(numbered.sparkSession, out)
    if local:
        line = F.coalesce("text", F.lit("")) if kind == "text" else F.to_json(F.struct(F.length("text").alias("n")))
        rows = numbered.select("folder", _number().alias("number"), F.concat(line, F.lit("\n")).cast("binary").alias("content"))
        rows.mapInArrow(_write_here(local, {"text": "txt"}.get(kind, kind)), "n long").agg(F.sum("n")).collect()
    else:
        _write_with_spark(numbered, out, kind)


def _write_with_spark(numbered, out, kind) -> None:
    content = "text" if kind == "text" else F.length("text").alias("n")
    numbered.sortWithinPartitions("folder", "doc_id").select("folder", content).write.mode("append").option(
        "maxRecordsPerFile", 1).partitionBy("folder").format(kind).save(out)


def _write_corpus(spark, sf) -> str:
    """One text file per document, ``<dir>/folder=<hash>/part-….txt``."""
    out = C.scratch_dir(spark, "corpus")
    _write_files(_numbered(spark, sf, "text"), out, "text")
    return out


def _with_ids(spark, sf, rows):
    """Rows with a path into the written corpus, with the id of the file's document."""
    names = _numbered(spark, sf).select("doc_id", "folder", _number().alias("number"))
    part = lambda i: F.regexp_extract("path", FILE_FROM_PATH, i).cast("int")
    return rows.withColumns({"folder": part(1), "number": part(2)}).join(names, ["folder", "number"])


def _doc_id(path="path"):
    return F.regexp_extract(F.col(path), DOC_FROM_PATH, 1).cast("long").alias("doc_id")


@register("corpus_scan", "SELECT doc_id, CAST(octet_length(encode(text)) + 1 AS BIGINT) AS length FROM documents")
def q_corpus_scan(spark, sf):
    files = C.corpus_scan(spark, _write_corpus(spark, sf), (".txt",), content=False)
    return _with_ids(spark, sf, files.select("path", "length")).select("doc_id", "length")


@register("read_text", "SELECT doc_id, text || chr(10) AS text, 'ok' AS status FROM documents")
def q_read_text(spark, sf):
    files = C.corpus_scan(spark, _write_corpus(spark, sf), (".txt",))
    return _with_ids(spark, sf, C.read_text(files)).select("doc_id", "text", "status")


@register("tagged_sink", O.with_(*D_TAG) + f"""
SELECT doc_id, string_agg(rendered, chr(10) ORDER BY i) AS tagged_text
FROM (SELECT doc_id, i, {RENDER_SQL} AS rendered FROM tagged) r GROUP BY doc_id""")
def q_tagged_sink(spark, sf):
    files = C.corpus_scan(spark, _write_corpus(spark, sf), (".txt",))
    out = C.scratch_dir(spark, "sink")
    C.tagged_sink(C.read_text(files), out)
    return _with_ids(spark, sf, spark.read.parquet(f"{out}/parsed")).select("doc_id", "tagged_text")


@register("tag_folder", O.with_(*D_TAG) + """
SELECT n_clean, n_parsed, n_clean - n_parsed AS n_failed
FROM (SELECT count(*) AS n_clean FROM documents) c, (SELECT count(DISTINCT doc_id) AS n_parsed FROM tagged) t""")
def q_tag_folder(spark, sf):
    """The batch folder job on one file per document; rows of its three tables."""
    out = C.scratch_dir(spark, "folder-job")
    C.tag_folder(spark, _write_corpus(spark, sf), out)
    one = [spark.read.parquet(f"{out}/{t}").agg(F.count(F.lit(1)).alias(f"n_{t}")) for t in ("clean", "parsed", "failed")]
    wide = one[0].select("*", F.lit(None).cast("long").alias("n_parsed"), F.lit(None).cast("long").alias("n_failed"))
    for part in one[1:]:
        wide = wide.unionByName(part, allowMissingColumns=True)
    return wide.agg(*[F.max(c).alias(c) for c in ("n_clean", "n_parsed", "n_failed")])


_HTML_SQL = (f"regexp_replace(html, {O.q(C.HTML_DROP)}, '', 'g')")
# the entities of the given pages, decoded by the oracle on its own
for _ent, _ch in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
    _HTML_SQL = f"replace({_HTML_SQL}, {O.q(_ent)}, {O.q(_ch)})"


@register("html_to_text", f"SELECT page_id, {_HTML_SQL} AS text FROM pages")
def q_html_to_text(spark, sf):
    return table(spark, sf, "pages", "page_id", "html").select("page_id", C.html_to_text("html").alias("text"))


def _docx_bytes(batches):
    import io
    import zipfile
    from xml.sax.saxutils import escape

    import pandas as pd

    def make(text):
        body = "".join(f'<w:p><w:r><w:t xml:space="preserve">{escape(x)}</w:t></w:r></w:p>'
                       for x in text.split("\n"))
        xml = ('<?xml version="1.0" encoding="UTF-8"?><w:document xmlns:w="http://schemas.openxmlformats.org/'
               f'wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as z:
            z.writestr("word/document.xml", xml)
        return buf.getvalue()
    for pdf in batches:
        yield pd.DataFrame({"path": [f"doc_id={d}/contract.docx" for d in pdf["doc_id"]],
                            "content": [make(t) for t in pdf["text"]]})


@register("docx_to_text", """
SELECT doc_id, trim(replace(text, chr(10), chr(10) || chr(10)), ' ' || chr(9) || chr(10)) AS docx_text FROM documents""")
def q_docx_to_text(spark, sf):
    files = (documents(spark, sf, "doc_id", "text")
             .mapInPandas(_docx_bytes, "path string, content binary"))
    return C.docx_to_text(files).select(_doc_id(), "docx_text")


@register("json_records", """
SELECT CAST(doc_id AS VARCHAR) AS document_id, lang AS section_title, source AS section_full_title, text
FROM documents""")
def q_json_records(spark, sf):
    out = C.scratch_dir(spark, "records")
    documents(spark, sf, "doc_id", "lang", "source", "text").select(
        F.col("doc_id").cast("string").alias("document_id"), F.col("lang").alias("section_title"),
        F.col("source").alias("section_full_title"), "text").write.mode("overwrite").json(out)
    return R.json_records(spark, out)


FLAG_SQL = "CASE tag WHEN 'title' THEN 'title' WHEN 's' THEN 'he' WHEN 'l' THEN 'sub-he' ELSE 'plain' END"
MARKS_SQL = O.with_(*C_TAG) + f"""
SELECT 'contract_' || CAST(doc_id AS VARCHAR) || '.txt' AS file,
       coalesce(max(line) FILTER (WHERE tag = 'title') OVER (PARTITION BY doc_id), '') AS title,
       CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS mark_pos,
       {FLAG_SQL} AS flag, line AS text
FROM tagged WHERE tag IS NOT NULL"""


def _marks(spark, sf):
    t = tagger.tag_positions(contracts(spark, sf)).where(F.col("tag").isNotNull())
    flag = (F.when(F.col("tag") == "title", "title").when(F.col("tag") == "s", "he")
             .when(F.col("tag") == "l", "sub-he").otherwise("plain"))
    per_file = t.groupBy("doc_id").agg(
        F.coalesce(F.max(F.when(F.col("tag") == "title", F.col("line"))), F.lit("")).alias("title"),
        F.transform(F.array_sort(F.collect_list(F.struct("i", F.array(flag, F.col("line")).alias("m")))),
                    lambda s: s["m"]).alias("marks"))
    per_file = per_file.select(F.concat(F.lit("contract_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("file"),
                               "title", "marks")
    out = C.scratch_dir(spark, "marks")
    R.write_marks(per_file, out)
    return R.json_nested_marks(spark, out)


@register("json_nested_marks", MARKS_SQL)
def q_json_nested_marks(spark, sf):
    return _marks(spark, sf)


@register("mark_filter", f"SELECT * FROM ({MARKS_SQL}) m WHERE flag IN ('he', 'sub-he', 'plain')")
def q_mark_filter(spark, sf):
    return R.mark_filter(_marks(spark, sf))


CSV_SCHEMA = T.StructType([T.StructField("index", T.LongType()), T.StructField("document_id", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("text", T.StringType())])


@register("csv_pipe_sink", """
SELECT doc_id AS "index", CAST(doc_id AS VARCHAR) AS document_id, lang, source, text FROM documents""")
def q_csv_pipe_sink(spark, sf):
    out = C.scratch_dir(spark, "csv")
    d = documents(spark, sf, "doc_id", "lang", "source", "text")
    R.write_pipe_csv(d.select(F.col("doc_id").alias("index"), F.col("doc_id").cast("string").alias("document_id"),
                              "lang", "source", "text"), out)
    return R.read_pipe_csv(spark, out, CSV_SCHEMA)


@register("word_vectors_source", O.with_(*WORDVEC_CTES) +
          "SELECT word, CAST(len(vec) AS INTEGER) AS n_dims, round(list_sum(vec), 4) AS vec_sum FROM wv")
def q_word_vectors_source(spark, sf):
    out = C.scratch_dir(spark, "vectors")
    R.write_word_vectors(_word_vectors(spark, sf), out)
    v = R.word_vectors_source(spark, out)
    return v.select("word", F.size("vec").alias("n_dims"),
                    F.round(F.aggregate("vec", F.lit(0.0).cast("double"), lambda a, x: a + x), 4).alias("vec_sum"))



@register("suffix_filter", "SELECT doc_id FROM documents")
def q_suffix_filter(spark, sf):
    """B10 on folders holding a .txt and a .json file per document."""
    root, numbered = C.scratch_dir(spark, "mixed"), _numbered(spark, sf, "text")
    for kind in ("text", "json"):
        _write_files(numbered, root, kind)
    files = C.corpus_scan(spark, root, None, content=False).select("path")
    return _with_ids(spark, sf, files.where(C.suffix_filter("path", C.EXTENSIONS))).select("doc_id")
