"""Tag contract files as they land in a folder (Structured Streaming).

The reference has no streaming; this is the natural streaming use of the
batch operators: a file source (one row per whole file), and each
micro-batch tagged by ``parse_raw_text`` inside ``foreachBatch`` and
written to its own ``epoch=`` folder of a parquet table.  Progress lives in the checkpoint
location, so a restarted query resumes with the files it has not processed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pactline.operators import segments
from pactline.operators.lines import document_lines
from pactline.operators.tagger import document_status, parse_raw_text


def file_texts(spark: SparkSession, folder: str, glob: str = "*.txt") -> DataFrame:
    """Streaming (path, text), one row per new file."""
    return (spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", glob)
            .option("recursiveFileLookup", True).load(folder)
            .select(F.input_file_name().alias("path"), F.col("value").alias("text")))


def _tag_batch(out: str):
    def run(batch: DataFrame, epoch_id: int) -> None:
        # the path itself is the key; a batch that runs again overwrites its own folder
        docs = batch.select(F.col("path").alias("doc_id"), F.regexp_replace("text", "\r\n?", "\n").alias("text"))
        for name, rows in (("parsed", parse_raw_text(document_lines(docs))),
                           ("quarantine", document_status(docs).where(F.col("status").startswith("error_")))):
            rows.withColumnRenamed("doc_id", "path").write.mode("overwrite").parquet(f"{out}/{name}/epoch={epoch_id}")
        segments.release()
    return run


def tag_stream(spark: SparkSession, folder: str, out: str, checkpoint: str,
               available_now: bool = False, interval: str = "30 seconds") -> StreamingQuery:
    """Start the query; ``available_now`` processes what is there and stops."""
    w = file_texts(spark, folder).writeStream.foreachBatch(_tag_batch(out)).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()
