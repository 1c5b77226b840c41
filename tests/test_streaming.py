"""Streaming tagger over a folder of files."""

from pactline.streaming.folder_stream import tag_stream


def test_stream_tags_new_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("Agreement\nAlpha\nThe body.\nBeta\nThe end.")
    (src / "b.txt").write_text("Exhibit A")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    q = tag_stream(spark, str(src), out, ck, available_now=True)
    q.awaitTermination(120)
    parsed = spark.read.parquet(f"{out}/parsed").collect()
    assert len(parsed) == 1 and parsed[0].tagged_text.startswith("<title> Agreement")
    bad = spark.read.parquet(f"{out}/quarantine").collect()
    assert [r.status for r in bad] == ["error_exhibit_only"]
    # a second run picks up only the new file
    (src / "c.txt").write_text("Section 1\nplain words")
    q = tag_stream(spark, str(src), out, ck, available_now=True)
    q.awaitTermination(120)
    assert spark.read.parquet(f"{out}/parsed").count() == 2
