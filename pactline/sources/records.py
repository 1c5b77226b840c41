"""Record sources and sinks: JSON records (A7), nested heading marks (A8),
pipe-separated CSV (A9), word-vector text (A10).

Schemas are declared, never inferred.  At scale JSON is read as JSON lines
(one record per line) so files split across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECTION_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in
                               ("document_id", "section_title", "section_full_title", "text")])
MARKS_SCHEMA = T.MapType(T.StringType(), T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("marks", T.ArrayType(T.ArrayType(T.StringType())))]))
KEEP_FLAGS = ("he", "sub-he", "plain")


def json_records(spark: SparkSession, path: str, schema: T.StructType = SECTION_SCHEMA,
                 multi_line: bool = False) -> DataFrame:
    """Records with a declared schema (multiLine for one JSON array)."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def write_marks(per_file: DataFrame, path: str) -> None:
    """Write (file, title, marks) as JSON lines of ``{file: {title, marks}}``."""
    per_file.select(F.to_json(F.create_map("file", F.struct("title", "marks"))).alias("value")) \
        .write.mode("overwrite").text(path)


def json_nested_marks(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """(file, title, mark_pos, flag, text) from ``{file: {title, marks}}``
    records, bare or under a top-level ``files`` key; one record per line, or
    one per file with ``whole_file``."""
    raw = spark.read.text(path, wholetext=whole_file)
    wrapped = T.StructType([T.StructField("files", MARKS_SCHEMA)])
    m = raw.select(F.coalesce(F.from_json("value", wrapped)["files"], F.from_json("value", MARKS_SCHEMA)).alias("m"))
    files = m.select(F.explode("m").alias("file", "v"))
    return files.select("file", F.col("v.title").alias("title"),
                        F.posexplode("v.marks").alias("mark_pos", "mark")) \
        .select("file", "title", "mark_pos", F.col("mark")[0].alias("flag"), F.col("mark")[1].alias("text"))


def mark_filter(marks: DataFrame, flags=KEEP_FLAGS) -> DataFrame:
    """Keep heading / sub-heading / plain marks."""
    return marks.where(F.col("flag").isin(*flags))


def write_pipe_csv(df: DataFrame, path: str) -> None:
    """``|``-separated CSV with a header (quotes doubled, blanks kept)."""
    (df.write.mode("overwrite").option("sep", "|").option("header", True).option("quote", '"')
     .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def read_pipe_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A9 read-back with the declared schema."""
    return (spark.read.schema(schema).option("sep", "|").option("header", True).option("quote", '"')
            .option("escape", '"').option("multiLine", True).option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False).csv(path))


def write_word_vectors(vectors: DataFrame, path: str) -> None:
    """Write (word, vec) as ``word f1 f2 …`` text lines."""
    vectors.select(F.concat_ws(" ", "word", F.array_join(F.col("vec").cast("array<string>"), " ")).alias("value")) \
        .write.mode("overwrite").text(path)


def word_vectors_source(spark: SparkSession, path: str) -> DataFrame:
    """A10: parse ``word f1 … fN`` lines into (word, vec ARRAY<FLOAT>)."""
    parts = spark.read.text(path).select(F.split("value", " ").alias("p"))
    return parts.select(F.element_at("p", 1).alias("word"),
                        F.transform(F.slice("p", 2, F.size("p") - 1), lambda x: x.cast("float")).alias("vec"))
