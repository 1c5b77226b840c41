"""Tagger, normaliser and tree against goldens and a sequential model."""

import random

import pytest
from pyspark.sql import functions as F

import model
from pactline.operators import lines as L
from pactline.operators import tagger, tree

GOLDEN = {
    "g1": "Exhibit 10.1\n\nLEASE AGREEMENT\nDefinitions\nThe term of this lease,\ncontinues here.\n"
          "1. Rent is due.\n(a) monthly;  \nPAYMENT\n7.\nGoverning law",
    "g2": "﻿Supply agreement.\nDEFINITIONS\n2. TERM\nThe parties agree.\n• first\n7",
    "g3": "\nLease\nBody text.",
    "g4": "\nLease\nbody",
    "g5": "Exhibit A",
    "g6": "(draft)\nSection 1. Scope\nNOTICES\nU.S. law applies.\nDear sir,",
    "g7": "Agreement\nAlpha\nBeta\nGamma\nThe end.",
    "g8": "Agreement\nAlpha\nThe body.\nBeta\nThe end.",
}
EXPECTED_BITS = {"g1": [3, 1, 1, 3, 3, 3, 3, 3, 2], "g2": [1, 3, 1, 3, 3, 2], "g3": [0],
                 "g6": [3, 1, 3, 3, 2], "g7": [1, 3, 1, 1, 3], "g8": [1, 1, 3, 1, 2]}
EXPECTED_STATUS = {"g3": "blank_first_collapsed", "g4": "error_blank_first", "g5": "error_exhibit_only"}


def _lines_df(spark, docs: dict[int, list[str]]):
    rows = [(d, p, x) for d, ls in docs.items() for p, x in enumerate(ls)]
    return spark.createDataFrame(rows, "doc_id long, pos int, line string")


def _model_all(docs):
    out = {}
    for d, ls in docs.items():
        try:
            out[d] = model.tag(ls)
        except model.Failed as e:
            out[d] = str(e)
    return out


def _spark_all(spark, docs, chunk_lines):
    df = _lines_df(spark, docs)
    f = tagger.tag_frame(df, chunk_lines=chunk_lines).select("doc_id", "i", "line", "tag", "bits").collect()
    st = {r.doc_id: r.status for r in tagger.line_status(df).collect()}
    nodes = tree.node_frame(df, chunk_lines=chunk_lines).collect()
    by_doc = {}
    for r in f:
        by_doc.setdefault(r.doc_id, []).append(r)
    tree_by_doc = {}
    for r in nodes:
        tree_by_doc.setdefault(r.doc_id, []).append((r.i, r.parent_pos, r.depth, r.tag, r.cl_pos))
    return by_doc, st, tree_by_doc


def _check(spark, docs, chunk_lines):
    want = _model_all(docs)
    got, status, trees = _spark_all(spark, docs, chunk_lines)
    for d, w in want.items():
        if isinstance(w, str):
            assert status[d] == w, (d, docs[d])
            assert d not in got
            continue
        flags, norm, st = w
        assert status[d] == st, (d, docs[d])
        rows = sorted(got[d], key=lambda r: r.i)
        assert [r.line for r in rows] == norm, (d, docs[d])
        assert [(r.bits, r.tag) for r in rows] == [(b, t) for b, t in flags], (d, docs[d])
        nodes, _ = model.tree(flags)
        assert sorted(trees.get(d, [])) == sorted(nodes), (d, docs[d])


@pytest.mark.parametrize("chunk_lines", [4096, 2, 3])
def test_goldens(spark, chunk_lines):
    docs = {k: v.splitlines() for k, v in enumerate(GOLDEN.values())}
    _check(spark, docs, chunk_lines)


def test_golden_bits_and_render(spark):
    docs = {k: GOLDEN[k].splitlines() for k in EXPECTED_BITS}
    ids = {k: i for i, k in enumerate(docs)}
    df = _lines_df(spark, {ids[k]: v for k, v in docs.items()})
    got = {}
    for r in tagger.tag_positions(df).collect():
        got.setdefault(r.doc_id, []).append((r.i, r.bits))
    for k, want in EXPECTED_BITS.items():
        assert [b for _, b in sorted(got[ids[k]])] == want, k
    text = {r.doc_id: r.tagged_text for r in tagger.parse_raw_text(df).collect()}
    assert text[ids["g1"]].split("\n")[3] == "<p> The term of this lease,continues here. </p>"
    assert text[ids["g1"]].endswith("Governing law </s>")
    assert text[ids["g6"]] == ("<l> (draft) </l>\n<s> Section 1. Scope\n<p> NOTICES </p>\n"
                               "<l> U.S. law applies. </l>\nDear sir, </s>")


def test_golden_status(spark):
    docs = {i: GOLDEN[k].splitlines() for i, k in enumerate(EXPECTED_STATUS)}
    st = {r.doc_id: r.status for r in tagger.line_status(_lines_df(spark, docs)).collect()}
    assert [st[i] for i in range(3)] == list(EXPECTED_STATUS.values())


POOL = ["", "  ", "\t", "Exhibit 5", "Exhibit", "AGREEMENT", "Agreement", "Section 4. Term", "DEFINITIONS",
        "Terms of sale", "3. PAYMENT", "1. Rent is due.", "2) next", "a) item", "(iv) clause", "- bullet",
        "• dot", "* star", "7.", "12", "continues here", "and more", "The quantity is 5. ", "U.S. law applies.",
        "Dear sir,", "Plain sentence here.", "﻿Supply agreement.", " leading blank", "B. Item, x", "(draft)"]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_against_model(spark, seed):
    rng = random.Random(seed)
    docs = {d: [rng.choice(POOL) for _ in range(rng.randint(1, 14))] for d in range(300)}
    _check(spark, docs, 3)


def test_split_lines_like_python(spark):
    texts = ["a\nb", "a\r\nb\rc", "x\x0by\x0cz\x1c\x1d\x1e\x85  w", "end\n", "two\n\n", "", "\n",
             "solo", "a\n\nb\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in L.split_lines(df).collect():
        got.setdefault(r.doc_id, []).append((r.pos, r.line))
    for i, t in enumerate(texts):
        assert [x for _, x in sorted(got.get(i, []))] == t.splitlines(), repr(t)


def test_hot_document_spread_over_chunks(spark):
    """One document far larger than a chunk (the skew case) next to small ones."""
    rng = random.Random(11)
    docs = {0: ["Agreement"] + [rng.choice(POOL[3:]) for _ in range(20000)]}
    docs.update({d: [rng.choice(POOL) for _ in range(rng.randint(1, 10))] for d in range(1, 40)})
    df = _lines_df(spark, docs)
    frame = tagger.tag_frame(df, chunk_lines=1000)
    assert frame.where("doc_id = 0").select("chunk").distinct().count() > 10
    _check(spark, docs, 1000)


def test_document_lines_part_before_the_exchange(spark):
    """Texts that know their line count give the same tags as plain line tables."""
    rng = random.Random(5)
    docs = {d: [rng.choice(POOL[3:]) for _ in range(rng.randint(1, 9))] + ["The end."] for d in range(60)}
    texts = spark.createDataFrame([(d, "\n".join(v)) for d, v in docs.items()], "doc_id long, text string")
    cols = ["doc_id", "i", "line", "tag", "bits"]
    plain = tagger.tag_frame(_lines_df(spark, docs), chunk_lines=3).select(cols).collect()
    counted = tagger.tag_frame(L.document_lines(texts), chunk_lines=3).select(cols).collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, counted))


def test_marks_cross_gaps_in_positions(spark):
    """A document without its position 3 is still known to span two chunks of 3."""
    rows = [(1, p, f"Line {p}.") for p in (0, 2, 4, 5, 7)] + [(2, 0, "Agreement"), (2, 2, "1. Rent is due.")]
    df = spark.createDataFrame(rows, "doc_id long, pos int, line string")
    got = tagger.tag_frame(df, chunk_lines=3).where("doc_id = 1").orderBy("i").collect()
    assert [r.line for r in got] == [f"Line {p}." for p in (0, 2, 4, 5, 7)]
    assert [r.i for r in got] == list(range(5))


def test_building_tagger_queries_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    df = _lines_df(spark, {1: ["Agreement", "Alpha", "1. Rent is due."]})
    texts = spark.createDataFrame([(1, "Agreement\nAlpha")], "doc_id long, text string")
    spark.sparkContext.setJobGroup("tagger-build", "building only")
    try:
        for lines in (df, L.document_lines(texts)):
            for build in (tagger.tag_positions, tagger.parse_raw_text, tagger.line_status, tree.build_tree,
                          tree.tree_root, tree.tree_walk, tree.subtree_counts):
                build(lines).schema  # noqa: B018
        assert list(tracker.getJobIdsForGroup("tagger-build")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_short_documents_take_one_exchange(spark):
    """Lines that know their document's count: one exchange by (doc_id, chunk), nothing persisted."""
    texts = spark.createDataFrame([(1, "Agreement\nAlpha")], "doc_id long, text string")
    short, _ = tagger.tag_parts(L.document_lines(texts))
    plan = short._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "InMemoryTableScan" not in plan and "Join" not in plan


def test_tasks_that_sort_or_group_are_not_joined(spark):
    """Adaptive execution would join these small partitions into one task."""
    from pactline.operators import features as FE
    from pactline.operators.segments import task_parts
    from pactline.sources.contracts import contract_lines
    least = task_parts(spark)
    assert least >= 8 * spark.sparkContext.defaultParallelism
    lines = _lines_df(spark, {d: ["Agreement", "Alpha", "1. Rent is due."] for d in range(50)})
    assert tagger.tag_frame(lines).where("n < 4096").rdd.getNumPartitions() >= least
    texts = spark.createDataFrame([(d, "one two two") for d in range(50)], "doc_id long, text string")
    counts = FE.term_counts(FE.tokens(texts, "sk", clustered=True))
    assert counts.rdd.getNumPartitions() >= least
    assert sorted(r.tf for r in counts.where("doc_id = 7").collect()) == [1, 2]
    items = spark.createDataFrame([(1, 1, 1, 1, 5.0)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double")
    orders, part = spark.createDataFrame([(1,)], "o_orderkey long"), spark.createDataFrame([(1, "bolt")], "p_partkey long, p_name string")
    assert contract_lines(orders, items, part).rdd.getNumPartitions() >= least


def test_partitions_grow_with_the_tables(spark, tmp_path, monkeypatch):
    """A fixed number of partitions lets a task's memory grow with the input."""
    from pactline.operators import segments as S
    from pactline.sources.contracts import contract_lines
    spark.range(1000).selectExpr("id AS l_orderkey", "id % 5 AS l_partkey", "id % 3 AS l_suppkey", "1 AS l_linenumber",
                                 "5.0D AS l_quantity").write.parquet(str(tmp_path / "items"))
    items = spark.read.parquet(str(tmp_path / "items"))
    size = S.read_bytes(items)
    assert 0 < size == S.read_bytes(items.unionByName(items))  # a table counts once
    monkeypatch.setattr(S, "PART_BYTES", size // 50)
    assert S.task_parts(spark, items) >= 50 > S.task_parts(spark)
    orders, part = spark.range(1).toDF("o_orderkey"), spark.createDataFrame([(1, "bolt")], "p_partkey long, p_name string")
    lines = contract_lines(orders, items, part)
    assert tagger.tag_frame(lines).where("n < 4096").rdd.getNumPartitions() >= 50
    assert S.task_parts(spark, spark.sparkContext.parallelize([(1,)]).toDF("a int")) == S.task_parts(spark)  # no known size
