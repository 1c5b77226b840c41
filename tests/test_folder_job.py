"""The batch folder job on good, rejected and unreadable files."""

import random

from pactline.operators import lines as L
from pactline.operators import tagger
from pactline.sources.corpus import tag_folder


def test_folder_job_sets_failures_apart(spark, tmp_path):
    src = tmp_path / "in"
    (src / "deep").mkdir(parents=True)
    (src / "a.txt").write_text("Agreement\nAlpha\nThe body.\nBeta\nThe end.")
    (src / "deep" / "a.txt").write_text("Section 1\r\nplain words")
    (src / "exhibit.txt").write_text("Exhibit A")
    (src / "bytes.txt").write_bytes(b"Agreement \xff\xfe")
    (src / "broken.docx").write_bytes(b"no zip")
    (src / "other.csv").write_text("x")
    out = str(tmp_path / "out")
    tag_folder(spark, str(src), out)
    clean, parsed, failed = [spark.read.parquet(f"{out}/{t}").collect() for t in ("clean", "parsed", "failed")]
    assert len(clean) == 5
    assert sorted(r.path.split("/in/")[1] for r in parsed) == ["a.txt", "deep/a.txt"]
    assert sorted((r.path.split("/")[-1], r.status) for r in failed) == [
        ("broken.docx", "error_decode"), ("bytes.txt", "error_decode"), ("exhibit.txt", "error_exhibit_only")]
    assert all(r.tagged_text and r.out_name == "a.txt" for r in parsed)


PIECES = ["Exhibit 1", "Alpha", "BETA", "Terms of it", "continued here", "", "  ", "1. First", "(a) x", "The end."]


def test_outcomes_equal_the_separate_operators(spark):
    """One derivation gives what status and tagged text give each by themselves."""
    rng = random.Random(3)
    texts = [(i, "\n".join(rng.choices(PIECES, k=rng.randrange(1, 9)))) for i in range(300)]
    texts += [(1000, "Exhibit A"), (1001, "\nword"), (1002, "\nWord\nword"), (1003, "\n\n")]
    lines = L.document_lines(spark.createDataFrame(texts, "doc_id long, text string"))
    status = {r.doc_id: r.status for r in tagger.line_status(lines).collect()}
    text = {r.doc_id: r.tagged_text for r in tagger.parse_raw_text(lines).collect()}
    assert {"error_blank_first", "error_exhibit_only", "blank_first_collapsed", "ok"} <= set(status.values())
    for chunk in (3, 4096):
        got = tagger.document_outcomes(lines, chunk).collect()
        assert {r.doc_id: r.status for r in got} == status and len(got) == len(status)
        assert {r.doc_id: r.tagged_text for r in got if r.tagged_text is not None} == text


def test_outcomes_plan_splits_once_for_each_length(spark, tmp_path):
    spark.createDataFrame([(1, "Agreement\nAlpha")], "doc_id long, text string").write.parquet(str(tmp_path / "t"))
    docs = spark.read.parquet(str(tmp_path / "t"))
    plan = tagger.document_outcomes(L.document_lines(docs))._jdf.queryExecution().optimizedPlan().toString()
    own = plan.split("InMemoryRelation")[0]
    assert own.count("Relation [") == 1 and "Join" not in own


def test_stand_in_files_are_those_of_sparks_writer(spark, tmp_path):
    """Written by the tasks themselves: a process for each file made the folder jobs slow."""
    from pyspark.sql import functions as F
    from pactline.plans import catalog_sources as CS
    docs = spark.createDataFrame([(d, [None, "", "a b\nc", "Ärger  \r\n"][d % 4], d % 3) for d in (7, 1, 3, 3, 2, 12, 40)]
                                 + [(None, "x", 1)], "doc_id long, text string, folder int")
    assert CS._local_path(spark, str(tmp_path)) == str(tmp_path)
    for kind, end in (("text", "txt"), ("json", "json")):
        found = []
        for write in (CS._write_files, CS._write_with_spark):
            out = tmp_path / f"{kind}-{write.__name__}"
            write(docs.repartition(2, "folder"), str(out), kind)
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(out))
            assert files.where(~F.col("path").endswith("." + end)).count() == 0
            part = [F.regexp_extract("path", CS.FILE_FROM_PATH, i).cast("int") for i in (1, 2)]
            found.append(sorted(map(tuple, files.select(*part, "length", F.hex("content")).collect())))
        assert found[0] == found[1] and len(found[0]) == 8
    assert not list(tmp_path.glob("text-_write_files/**/.*"))  # no drafts, and no checksum files of Hadoop's


def test_scan_by_the_tasks_equals_sparks_reader(spark, tmp_path):
    """The tasks list and read the folder; the driver never holds the list of files."""
    from pactline.sources import corpus as C
    names = ["a.txt", "b.TXT", "c.docx", "_skipped.txt", "_a=b.txt", ".hidden.txt", "d.txt._COPYING_", "empty.txt", "x y%20[1].txt",
             "é.txt", "_out/e.txt", "k=1/f.txt", ".git/g.txt", "one/deep/er/h.txt", "one/deep/er/i.html",
             *[f"many/{j % 7}/n{j}.txt" for j in range(300)], *[f"flat{j}.txt" for j in range(90)]]
    for j, name in enumerate(names):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"" if name == "empty.txt" else bytes([j % 256]) * (j + 1))
    (tmp_path / "gone.txt").symlink_to(tmp_path / "nowhere.txt")
    plain = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    for extensions, glob in (((".txt",), "*.txt"), ((".txt", ".docx"), "*.{txt,docx}"), (None, "*")):
        want = sorted(map(tuple, plain.option("pathGlobFilter", glob).load(str(tmp_path)).collect()))
        found = C.corpus_scan(spark, str(tmp_path), extensions)
        assert sorted(map(tuple, found.collect())) == want and len(want) > 390
        assert not found.inputFiles() and found.rdd.getNumPartitions() > 1  # the plan names no file
        paths = C.corpus_scan(spark, f"file://{tmp_path}", extensions, content=False)
        assert sorted(map(tuple, paths.collect())) == [r[:3] for r in want]
    pieces = C._shares(str(tmp_path), 8)
    assert len(pieces) < 40 and any(shares == 8 for _, _, shares in pieces)
    for want in (1, 3, 8, 1000):
        got = [e.path for piece in C._shares(str(tmp_path), want) for e in C._files_of(*piece)]
        assert len(got) == len(set(got)) == len(names) - 5 + 1  # each once; the link to nothing is left to the reader
