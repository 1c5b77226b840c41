"""Document sources and sinks.

A folder of contracts becomes one row per file.  On a file system that every
machine mounts (scheme ``file``) the tasks list and read the folders, so the
driver never holds the list of files; elsewhere it is Spark's ``binaryFile``
source, which lists at planning.  Text is decoded strictly as UTF-8 in the JVM; HTML is reduced to
its text nodes with column expressions; only ``.docx`` (a zip archive)
needs Python, run per Arrow batch.
"""

from __future__ import annotations

import html.entities as html_entities
import io
import os
import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import islice
from xml.etree import ElementTree

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pactline.operators.lines import document_lines, text_status
from pactline.operators.segments import PARTS_A_CORE
from pactline.operators.tagger import document_outcomes
from pactline.session import checkpoint_dir

EXTENSIONS = (".docx", ".txt")          # the reference's allowed list
READABLE = (".docx", ".txt", ".html")   # what read_text understands

HTML_DROP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!doctype[^>]*>|<[^>]*>"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/pactline-scratch/{name}-{uuid.uuid4().hex}"


def suffix_filter(path: Column | str, extensions=EXTENSIONS) -> Column:
    """The file name ends with one of the extensions."""
    p = F.col(path) if isinstance(path, str) else path
    return reduce(lambda a, b: a | b, [p.endswith(e) for e in extensions])


def local_path(spark: SparkSession, folder: str) -> str | None:
    """The folder as every machine's own file system has it; None where only Hadoop's reach it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    scheme = path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()
    return path.toUri().getPath() if scheme == "file" else None


#: Files, and bytes of their contents, that a task of ``corpus_scan`` hands over at a time.
FILES_AT_ONCE, BYTES_AT_ONCE = 1024, 4 << 20


def _entries(folder: str) -> Iterator[os.DirEntry]:
    """The entries that Spark's readers see: hidden ones and unfinished copies are left out."""
    with os.scandir(folder) as found:
        for e in found:
            if not (e.name.startswith(".") or e.name.startswith("_") and "=" not in e.name or e.name.endswith("._COPYING_")):
                yield e


def _shares(root: str, want: int) -> list[tuple[str, int, int]]:
    """(folder, share, shares): about ``want`` pieces of the tree, or more.

    A share is the entries whose names' checksums leave that rest, with all
    below them; of 0 shares, the folder's own files alone.  Only folders of few
    entries are opened here, and few of them: their number and the driver's
    memory do not grow with the tree.
    """
    pieces, left = [], [root]
    while left:
        folder = left.pop(0)
        few = list(islice(_entries(folder), want + 1))
        if len(few) > want:
            pieces += [(folder, j, want) for j in range(want)]
        elif len(pieces) + len(left) >= want:
            pieces.append((folder, 0, 1))
        else:
            pieces.append((folder, 0, 0))
            left += [e.path for e in few if e.is_dir()]
    return pieces


def _files_of(folder: str, share: int, shares: int) -> Iterator[os.DirEntry]:
    for e in _entries(folder):
        if shares > 1 and zlib.crc32(os.fsencode(e.name)) % shares != share:
            continue
        if not e.is_dir():
            yield e
        elif shares:
            yield from _files_of(e.path, 0, 1)


def _scan(suffixes: tuple[str, ...] | None, content: bool):
    """Lists, and reads, the files of shares; empty files have no row, as with Spark's readers."""
    kinds = [("path", pa.string()), ("modificationTime", pa.timestamp("us", "UTC")), ("length", pa.int64())]
    schema = pa.schema([*kinds, ("content", pa.binary())] if content else kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for e in (e for b in batches for piece in zip(*[c.to_pylist() for c in b.columns]) for e in _files_of(*piece)):
            if suffixes is not None and not e.name.endswith(suffixes):
                continue
            try:
                st = e.stat()
            except FileNotFoundError:  # gone meanwhile, or a link to nothing
                continue
            if not st.st_size:
                continue
            row = {"path": "file:" + e.path, "modificationTime": st.st_mtime_ns // 1_000_000 * 1000, "length": st.st_size}
            if content:
                with open(e.path, "rb") as f:
                    row["content"] = f.read()
                held += len(row["content"])
            rows.append(row)
            if len(rows) >= FILES_AT_ONCE or held >= BYTES_AT_ONCE:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def _scan_here(spark: SparkSession, root: str, extensions, content: bool) -> DataFrame:
    """The scan by the tasks: one for each share of the tree."""
    pieces = _shares(root, PARTS_A_CORE * spark.sparkContext.defaultParallelism)
    shares = spark.createDataFrame(spark.sparkContext.parallelize(pieces, len(pieces)), "folder string, share int, shares int")
    kinds = "path string, modificationTime timestamp, length long" + ", content binary" * content
    return shares.mapInArrow(_scan(None if extensions is None else tuple(extensions), content), kinds)


def corpus_scan(spark: SparkSession, folder: str, extensions=EXTENSIONS, count: int = -1, content: bool = True) -> DataFrame:
    """A1: (path, modificationTime, length, content) of matching files, recursive.

    A missing folder raises.  ``count`` > 0 keeps the first files by path
    (the reference's order is the file system's listing order): these are
    found among the paths alone, and only their contents are read.
    ``extensions`` None takes all files; ``content`` False leaves it out.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if extensions is not None:
        files = files.option("pathGlobFilter", "*.{" + ",".join(e.lstrip(".") for e in extensions) + "}")
    columns = ["path", "modificationTime", "length", *["content"] * content]
    limited = bool(count) and count > 0
    root = local_path(spark, folder)
    if root is not None and os.path.isdir(root):
        df = _scan_here(spark, os.path.abspath(root), extensions, content and not limited)
    else:
        df = files.load(folder).select(*columns)
    if not limited:
        return df
    first = [r["path"] for r in df.select("path").orderBy("path").limit(count).collect()]
    return files.load([_no_glob(p) for p in first]).select(*columns) if first else _no_files(spark, columns)


def _no_files(spark: SparkSession, columns: list[str]) -> DataFrame:
    return spark.createDataFrame([], "path string, modificationTime timestamp, length long, content binary").select(*columns)


def _no_glob(path: str) -> str:
    """A path that the reader takes as it is."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def html_to_text(html: Column | str) -> Column:
    """A3: text nodes of a page joined with no separator (comments, script,
    style and doctype dropped), then all named and numeric entities decoded."""
    h = F.col(html) if isinstance(html, str) else html
    return decode_entities(F.regexp_replace(h, HTML_DROP, ""))


#: HTML's named character references, with and without the final semicolon: the standard library's table.
ENTITIES = html_entities.html5
#: Numbers that stand for another character, and those that stand for none, as HTML defines them.
REPLACED = {0: "\ufffd", 13: "\r", **{n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(128, 160)}}
NO_CHARACTER = [*range(1, 9), 11, *range(14, 32), *range(127, 160), *range(0xFDD0, 0xFDF0),
                *[n for p in range(17) for n in (0x10000 * p + 0xFFFE, 0x10000 * p + 0xFFFF)]]


def _pairs(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def decode_entities(text: Column) -> Column:
    """Every character reference of a text decoded as HTML does it, without leaving the JVM.

    The text is split at ``&``; what stands behind one is a number, a name of
    the table, or begins with one of the old names that need no semicolon (the
    longest counts); else the ``&`` stays.
    """
    old = sorted((n for n in ENTITIES if not n.endswith(";")), key=lambda n: (-len(n), n))

    def one(part: Column) -> Column:
        number = F.regexp_extract(part, r"^#([0-9]+|[xX][0-9a-fA-F]+);?", 1)
        of_number = F.regexp_extract(part, r"^(#(?:[0-9]+|[xX][0-9a-fA-F]+);?)", 1)
        digits = F.regexp_replace(F.regexp_replace(number, "^[xX]", ""), "^0+(?=.)", "")
        # ten digits are beyond the last code point in either base
        value = F.when(F.length(digits) > 9, F.lit(0x110000)).otherwise(
            F.conv(digits, 10, 10).cast("long"))
        value = F.when(F.rlike(number, F.lit("^[xX]")), F.when(F.length(digits) > 9, F.lit(0x110000)).otherwise(
            F.conv(digits, 16, 10).cast("long"))).otherwise(value)
        char = F.decode(F.unhex(F.lpad(F.hex(value), 8, "0")), "UTF-32")
        char = F.coalesce(
            F.element_at(_pairs(REPLACED), value.cast("int")),
            F.when(((value >= 0xD800) & (value <= 0xDFFF)) | (value > 0x10FFFF), F.lit("\ufffd")),
            F.when(value.isin(NO_CHARACTER), F.lit("")), char)
        name = F.regexp_extract(part, "^([^\t\n\f <&#;]{1,32};?)", 1)
        whole = F.element_at(_pairs(ENTITIES), name)
        begin = F.regexp_extract(part, "^(" + "|".join(old) + ")", 1)
        rest = lambda taken: F.substring(part, F.length(taken) + 1, F.length(part))
        return F.when(number != "", F.concat(char, rest(of_number))).when(
            whole.isNotNull(), F.concat(whole, rest(name))).when(
            begin != "", F.concat(F.element_at(_pairs(ENTITIES), begin), rest(begin))).otherwise(
            F.concat(F.lit("&"), part))

    parts = F.split(text, "&")
    decoded = F.concat(F.element_at(parts, 1), F.array_join(
        F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), one), ""))
    return F.when(text.contains("&"), decoded).otherwise(text)


def _docx_text(data: bytes) -> str | None:
    """Text of a .docx: runs of w:t, tabs, breaks, blank line per paragraph;
    headers first, then the body, then footers."""
    w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
    try:
        z = zipfile.ZipFile(io.BytesIO(data))
        names = z.namelist()
        return _parts_text(z, names, w) if "word/document.xml" in names else None
    except (zipfile.BadZipFile, zlib.error, ElementTree.ParseError, LookupError, RuntimeError, OSError, EOFError,
            ValueError):  # broken, truncated or encrypted: the file is set apart, the job goes on
        return None


def _parts_text(z: zipfile.ZipFile, names: list[str], w: str) -> str:
    parts = ([n for n in names if n.startswith("word/header")] + ["word/document.xml"]
             + [n for n in names if n.startswith("word/footer")])
    out = []
    for n in parts:
        if n not in names:
            continue
        for el in ElementTree.fromstring(z.read(n)).iter():
            if el.tag == w + "t":
                out.append(el.text or "")
            elif el.tag == w + "tab":
                out.append("\t")
            elif el.tag in (w + "br", w + "cr"):
                out.append("\n")
            elif el.tag == w + "p":
                out.append("\n\n")
    return "".join(out).strip()


def _docx_column(content: Column) -> Column:
    """Text of .docx bytes, one Arrow batch at a time; null for a bad file."""
    return F.pandas_udf(lambda s: s.map(_docx_text, na_action="ignore").astype(object), "string")(content)


def docx_to_text(files: DataFrame) -> DataFrame:
    """A4: (path, docx_text) for .docx rows; null where the file is broken."""
    return files.where(F.col("path").endswith(".docx")).select("path", _docx_column(F.col("content")).alias("docx_text"))


def read_text(files: DataFrame) -> DataFrame:
    """A2: (path, text, status) per file; the path is the key.

    Strict UTF-8 (an invalid file gets ``error_decode``), byte-order mark
    kept, universal newlines (``\\r\\n`` and ``\\r`` become ``\\n``); .html
    reduced to text, .docx through ``docx_to_text``.
    """
    raw = F.col("content").cast("string")
    valid = F.is_valid_utf8(raw)
    text = F.regexp_replace(raw, "\r\n?", "\n")
    is_docx, is_html = F.col("path").endswith(".docx"), F.col("path").endswith(".html")
    # one pass: only the bytes of .docx files go to Python
    out = files.select("path", F.when(valid, text).alias("text0"),
                       valid.alias("valid"), _docx_column(F.when(is_docx, F.col("content"))).alias("docx_text"))
    txt = (F.when(is_docx, F.col("docx_text"))
            .when(is_html, html_to_text(F.when(is_html, F.col("text0"))))
            .otherwise(F.col("text0")))
    status = (F.when(is_docx & F.col("docx_text").isNull(), F.lit("error_decode"))
               .when(~is_docx & ~F.col("valid"), F.lit("error_decode"))
               .otherwise(F.lit("ok")))
    return out.select("path", txt.alias("text"), status.alias("status"))


def out_name(path: Column | str) -> Column:
    """The reference's output name: file name cut at its first dot + .txt."""
    p = F.col(path) if isinstance(path, str) else path
    name = F.element_at(F.split(p, "/"), -1)
    return F.concat(F.split(name, r"\.").getItem(0), F.lit(".txt"))


def tagged_sink(texts: DataFrame, out: str) -> None:
    """A5: tags (path, text, status) and writes three tables under ``out``.

    ``clean`` (path, out_name, text, status): every row of ``texts``, derived
    once; later steps work on this table.  Lines are split, tagged and judged
    once, as one row per file (``document_outcomes``), from which come
    ``parsed`` (path, out_name, tagged_text): files that could be tagged, and
    ``failed`` (path, status): unreadable files and those that the line rules
    reject.  The path is the key (equal file names in different folders stay
    apart); ``out_name`` keeps the reference's naming as a column.
    """
    clean, parsed, failed = [f"{out.rstrip('/')}/{name}" for name in ("clean", "parsed", "failed")]
    texts.select("path", out_name("path").alias("out_name"), "text", "status").write.mode("overwrite").parquet(clean)
    texts = texts.sparkSession.read.parquet(clean)
    good = texts.where(F.col("status") == "ok").select(F.col("path").alias("doc_id"), "text")
    # kept for the two tables; its lineage starts at the clean table
    outcomes = document_outcomes(document_lines(good)).withColumnRenamed("doc_id", "path").persist(
        StorageLevel.MEMORY_AND_DISK)
    rejected = F.col("status").startswith("error_")
    outcomes.where(~rejected).select("path", out_name("path").alias("out_name"), "tagged_text") \
        .write.mode("overwrite").parquet(parsed)
    lineless = text_status(good).where(F.col("status").isNotNull()).withColumnRenamed("doc_id", "path")
    texts.where(F.col("status") != "ok").select("path", "status").unionByName(lineless).unionByName(
        outcomes.where(rejected).select("path", "status")).write.mode("overwrite").parquet(failed)
    outcomes.unpersist()


def tag_folder(spark: SparkSession, folder: str, out: str, extensions=READABLE) -> None:
    """The batch folder job: scan, read, tag; ``tagged_sink``'s tables under ``out``."""
    tagged_sink(read_text(corpus_scan(spark, folder, extensions)), out)
