"""Text functions, tokenisers, splits, sources and list markers."""

import math
import random
import re
import string

from pyspark.sql import functions as F

from paths import SF001
from porter_model import porter
from pactline.functions import text as T
from pactline.operators import features as FE
from pactline.operators import split as SP
from pactline.operators.stems import STEP2, STEP3, STEP4, frequent_stems, stem_counts, stem_of
from pactline.sources import corpus as C
from pactline.sources import records as R


def _one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("y")).first()["y"]


def test_clean_and_tokens_like_python(spark):
    texts = ["  He said \"don't\" \\ go.  ", "Ünïcode WORDS, here!\tand\nthere", "a b  c", ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in df.select("doc_id", T.clean_text("text").alias("c"),
                                         T.tokenize_sk("text").alias("sk"),
                                         T.tokenize_seq("text").alias("seq"),
                                         T.tokenize_words("text").alias("w")).collect()}
    seq_table = str.maketrans({c: " " for c in '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n'})
    for i, t in enumerate(texts):
        assert got[i].c == re.sub(r"[\\'\"]", "", t).strip().lower()
        assert got[i].sk == re.findall(r"(?u)\b\w\w+\b", t.lower())
        assert got[i].seq == [x for x in t.translate(seq_table).lower().split(" ") if x]
        assert got[i].w == t.translate(str.maketrans("", "", string.punctuation)).split()


def test_pad_and_one_hot(spark):
    df = spark.createDataFrame([([1, 2, 3],), (list(range(1, 8)),)], "s array<int>")
    rows = df.select(T.pad_sequence("s", 5).alias("p")).collect()
    assert rows[0].p == [0, 0, 1, 2, 3]
    assert rows[1].p == [3, 4, 5, 6, 7]  # the last 5 are kept
    assert _one(spark, T.one_hot(F.col("x"), 4), 2, "x int") == [0, 0, 1, 0]


def test_list_markers(spark):
    # (marker, class, content) from the fixture notes
    cases = [("1.", 0, "1"), ("12)", 0, "12"), ("a)", 1, "a"), ("(iv)", 2, "iv"), ("(1)", 2, "1"),
             ("b.", None, ""), ("•", 3, "•"), ("-", 3, "-"), ("*", 3, "*")]
    df = spark.createDataFrame([(m,) for m, _, _ in cases], "m string")
    got = df.select("m", T.list_type("m").alias("t"), T.list_content("m").alias("c")).collect()
    assert [(r.m, r.t, r.c) for r in got] == cases
    lines = spark.createDataFrame([("  3) x",), ("7",), ("(ab) y",), ("U.S. law",)], "line string")
    assert [r.m for r in lines.select(T.list_marker("line").alias("m")).collect()] == ["3)", None, "(ab)", "U."]


def test_global_position_and_folds(spark):
    rng = random.Random(3)
    ids = rng.sample(range(10 ** 9), 537)
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    got = {r.doc_id: r.gpos for r in SP.global_position(df, "doc_id", n_buckets=7).collect()}
    assert [got[i] for i in sorted(ids)] == list(range(len(ids)))
    folds = SP.kfold(df, "doc_id", 10).groupBy("fold").count().orderBy("fold").collect()
    q, r = divmod(len(ids), 10)
    assert [x["count"] for x in folds] == [q + 1] * r + [q] * (10 - r)
    split = SP.holdout_split(df, "doc_id", 0.3, 11)
    assert split.where("is_test").count() == math.ceil(0.3 * len(ids))
    tail = SP.holdout_split_tail(df, "doc_id", 0.2, 13)
    assert tail.where("is_val").count() == int(0.2 * len(ids))


def test_vocab_ties_by_first_appearance(spark):
    toks = spark.createDataFrame([(1, 0, "b"), (1, 1, "a"), (2, 0, "a"), (2, 1, "b"), (2, 2, "c")],
                                 "doc_id long, pos int, token string")
    got = [(r.word, r.word_index) for r in FE.vocab_topk(toks, 3).orderBy("word_index").collect()]
    assert got == [("b", 1), ("a", 2)]  # equal counts: b is seen first; only num_words-1 kept


def test_porter_published_examples():
    pairs = {"caresses": "caress", "ponies": "poni", "agreed": "agre", "hopping": "hop", "filing": "file",
             "relational": "relat", "generalizations": "gener", "oscillators": "oscil", "sky": "sky"}
    assert {w: porter(w) for w in pairs} == pairs


def test_stems_agree_with_sequential_stemmer(spark):
    rnd = random.Random(5)
    suffixes = [s for s, _ in STEP2 + STEP3] + STEP4 + ["s", "sses", "ies", "ss", "eed", "ed", "ing", "y", "e", "ll", ""]
    words = {"", "y", "yy", "by", "sky", "caresses", "ponies", "agreed", "feed", "bled", "sing", "hopping", "falling",
             "hissing", "filing", "failing", "controlling", "roll", "été", "a1b", "naïvely", "\U0001f600ing", "x\ny",
             "y" * 5000 + "s", "generalizations", "oscillators", "adoption", "ion", "ational"}
    for _ in range(6000):
        stem = "".join(rnd.choice("aeiouybcdlnrstwxz") for _ in range(rnd.randint(0, 6)))
        words.add(stem + rnd.choice(suffixes) + rnd.choice(["", "", "s", "ed", "ing", "y"]))
    df = spark.createDataFrame([(w,) for w in sorted(words)] + [(None,)], "word string")
    got = {r.word: r.stem for r in df.select("word", stem_of(F.col("word")).alias("stem")).collect()}
    assert got.pop(None) is None
    assert got == {w: porter(w) for w in words}


def test_html_to_text(spark):
    html = ('<!DOCTYPE html><html><head><title>T &amp; C</title><style>p{x:1}</style>'
            '<script>var t="</p>";</script></head><body><!-- ad --><p>A &middot; B</p>'
            '<p>&copy; &quot;q&quot;</p></body></html>')
    assert _one(spark, C.html_to_text(F.col("x")), html) == 'T & CA · B© "q"'
    entities = "A&#160;B &#8217;x&#x2019; &mdash; &ldquo;q&rdquo; &amp;lt; no"
    assert _one(spark, C.html_to_text(F.col("x")), entities) == "A\xa0B \u2019x\u2019 \u2014 \u201cq\u201d &lt; no"


ENTITIES = ["&amp;", "&lt", "&ltx", "&notit;", "&notin;", "&NotEqualTilde;", "&copy", "&copyx;", "&nosuch;", "&", "&&amp;",
            "&;", "& amp;", "&#65;", "&#65", "&#065x", "&#x41;", "&#X41", "&#x;", "&#;", "&#0;", "&#13;", "&#128;", "&#x80;",
            "&#150", "&#129;", "&#xD800;", "&#x10FFFF;", "&#x110000;", "&#99999999999999999999;", "&#x1F600;", "&#1;", "&#xFDD0;",
            "&#12;", "&#127;", "&quot;&apos;", "&ThickSpace;", "&amp;lt;", "&AMP", "&Uuml;ber", "&frac12;", "&frac12", "&sup1",
            "&there4;", "&ac;E;", "&bne;", "&#x0000000000041;", "&nbsp;x&nbsp", "&#xfffe;", "&ampamp;", "&#65;&#66;", "&lang"]


def test_entities_are_decoded_as_the_standard_library_does(spark):
    import html
    import html.entities
    rnd = random.Random(3)
    names = list(html.entities.html5)
    texts = ENTITIES + [f"a &{n} b&{n}c" for n in names] + [
        "".join(rnd.choice(ENTITIES + ["x", " ", ";", "amp;", "#", "\n"]) for _ in range(9)) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,), ("",)], "t string")
    got = {r.t: r.d for r in df.select("t", C.decode_entities(F.col("t")).alias("d")).collect()}
    assert {t: d for t, d in got.items() if t and d != html.unescape(t)} == {}
    assert got[None] is None and got[""] == ""
    files = spark.createDataFrame([], "path string, content binary")
    plan = C.read_text(files)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "pythonUDF0" in plan  # the .docx bytes alone


def test_a_count_limits_what_is_read(spark, tmp_path):
    for name in ("b.txt", "a [1]{x}*.txt", "c.txt", "sub/a.txt", "d.csv"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(name)
    found = C.corpus_scan(spark, str(tmp_path), (".txt",), count=3)
    assert sorted(bytes(r.content).decode() for r in found.collect()) == ["a [1]{x}*.txt", "b.txt", "c.txt"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "Limit" not in plan
    assert len(found.inputFiles()) == 3
    assert C.corpus_scan(spark, str(tmp_path), (".txt",), count=99).count() == 4
    assert C.corpus_scan(spark, str(tmp_path), (".docx",), count=2).count() == 0


def test_catalogs_import_alone():
    import subprocess
    import sys
    root = str(__import__("pathlib").Path(__file__).resolve().parent.parent)
    for name in ("catalog_features", "catalog_sources", "catalog"):
        subprocess.run([sys.executable, "-c", f"import pactline.plans.{name}"], cwd=root, check=True, timeout=120)


def test_docx_and_corpus_roundtrip(spark, tmp_path):
    import io
    import zipfile
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml",
                   '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>'
                   '<w:p><w:r><w:t>LEASE</w:t></w:r></w:p><w:p><w:r><w:t>1. Rent</w:t><w:tab/>'
                   '<w:t>due</w:t></w:r></w:p></w:body></w:document>')
    root = tmp_path / "corpus"
    (root / "sub").mkdir(parents=True)
    (root / "a.txt").write_bytes("Title\r\nbody line\n".encode())
    (root / "sub" / "a.txt").write_bytes("Other".encode())
    (root / "bad.txt").write_bytes(b"\xff\xfe broken")
    (root / "c.v2.docx").write_bytes(buf.getvalue())
    (root / "skip.pdf").write_bytes(b"%PDF")
    (root / "cut.docx").write_bytes(buf.getvalue()[:-30])
    part = io.BytesIO()
    with zipfile.ZipFile(part, "w") as z:
        z.writestr("word/document.xml", "<w:document")
    (root / "broken.docx").write_bytes(part.getvalue())
    files = C.corpus_scan(spark, str(root), (".txt", ".docx"))
    assert files.count() == 6
    got = {r.path.split(str(root))[1]: r for r in C.read_text(files).collect()}
    assert got["/a.txt"].text == "Title\nbody line\n" and got["/a.txt"].status == "ok"
    assert got["/sub/a.txt"].text == "Other"
    assert got["/bad.txt"].status == "error_decode"
    assert got["/c.v2.docx"].text == "LEASE\n\n1. Rent\tdue"
    assert [(got[f].text, got[f].status) for f in ("/cut.docx", "/broken.docx")] == [(None, "error_decode")] * 2
    names = {r.n for r in files.select(C.out_name("path").alias("n")).collect()}
    assert names == {"a.txt", "bad.txt", "c.txt", "cut.txt", "broken.txt"}
    assert C.corpus_scan(spark, str(root), (".txt",), count=2).count() == 2


def test_csv_and_json_roundtrip(spark, tmp_path):
    from pactline.plans.catalog_sources import CSV_SCHEMA
    rows = [(1, "1", "en", "s|1", 'a "quoted"\nline |x|'), (2, "2", "fr", "s2", "  lead")]
    df = spark.createDataFrame(rows, CSV_SCHEMA)
    R.write_pipe_csv(df, str(tmp_path / "csv"))
    back = R.read_pipe_csv(spark, str(tmp_path / "csv"), CSV_SCHEMA).orderBy("index").collect()
    assert [tuple(r) for r in back] == rows
    marks = spark.createDataFrame([("f.txt", "T", [["he", "A"], ["plain", "b"], ["x", "c"]])],
                                  "file string, title string, marks array<array<string>>")
    R.write_marks(marks, str(tmp_path / "marks"))
    m = R.json_nested_marks(spark, str(tmp_path / "marks"))
    assert [(r.mark_pos, r.flag) for r in m.orderBy("mark_pos").collect()] == [(0, "he"), (1, "plain"), (2, "x")]
    assert R.mark_filter(m).count() == 2
    (tmp_path / "headings.json").write_text('{"files": {\n "f.txt": {"title": "T", "marks": [["he", "A"]]}}}')
    whole = R.json_nested_marks(spark, str(tmp_path / "headings.json"), whole_file=True).collect()
    assert [(r.file, r.title, r.flag, r.text) for r in whole] == [("f.txt", "T", "he", "A")]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    rows = E.entry(spark).collect()
    assert rows and {r.tag for r in rows} <= {"title", "s", "l", "p"}


def test_registered_queries_have_oracle_or_reason():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)


def test_documents_tagging_sf001(spark):
    from pactline.operators import lines as L, tagger
    d = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    st = tagger.document_status(d).groupBy("status").count().collect()
    assert sum(r["count"] for r in st) == d.count()


def test_embedding_fill_and_approx_profile(spark):
    v = spark.createDataFrame([("a", 1), ("b", 2)], "word string, word_index int")
    vec = spark.createDataFrame([("a", [1.0, 2.0])], "word string, vec array<float>")
    z = {r.word: r.vec for r in FE.embedding_lookup(v, vec, 2).collect()}
    assert z == {"a": [1.0, 2.0], "b": [0.0, 0.0]}
    r1 = {r.word: r.vec for r in FE.embedding_lookup(v, vec, 2, "random", 5).collect()}
    r2 = {r.word: r.vec for r in FE.embedding_lookup(v, vec, 2, "random", 5).collect()}
    assert r1 == r2 and all(0.0 <= x < 1.0 for x in r1["b"]) and r1["a"] == [1.0, 2.0]
    assert FE.profile_distinct(v, ["word"], approx=True).first()["n_word"] == 2


def test_tokens_are_computed_once(spark):
    """No filter below the generator repeats the tokenizer."""
    from pactline.operators import features, lines
    d = spark.createDataFrame([(1, "One two."), (2, ""), (3, None)], "doc_id long, text string")
    for df in (features.tokens(d, "sk"), lines.document_lines(d)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        below = plan[plan.index("Generate"):]
        assert "Filter" not in below
    assert [r.token for r in features.tokens(d, "sk").orderBy("doc_id", "pos").collect()] == ["one", "two"]
    assert [r.line for r in lines.document_lines(d).collect()] == ["One two."]


def test_mean_vectors_move_numbers_and_no_vectors(spark):
    """Equal vectors meet once a document; nulls and words that repeat count as before."""
    texts = ["aa bb bb zz", "aa aa cc", "zz", None]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(7, "aa"), (7, "bb")], "doc_id long, text string")
    of = {"aa": [1.0, 2.0], "bb": [1.0, 2.0], "cc": [-3.0, 0.5]}
    vectors = spark.createDataFrame([*of.items(), ("zz", None), ("cc", [-3.0, None])], "word string, vec array<float>")
    got = {(r.doc_id, tuple(r.mean)) for r in FE.doc_means(docs, FE.tokens(docs, "seq", clustered=True), vectors, 2).collect()}
    assert got == {(0, (1.0, 2.0)), (1, (-1.0, 1.5)), (2, (0.0, 0.0)), (3, (0.0, 0.0)), (7, (1.0, 2.0))}
    long = FE.doc_vectors(docs, FE.tokens(docs, "seq"), vectors, 2)
    assert long.count() == 12 and "sortaggregate" not in long._jdf.queryExecution().executedPlan().toString().lower()
    assert "ObjectHashAggregate" not in long._jdf.queryExecution().executedPlan().toString()


def _node_names(node):
    children = node.children()
    return [node.nodeName()] + [x for i in range(children.size()) for x in _node_names(children.apply(i))]


def test_only_words_of_frequent_stems_are_counted(spark):
    rng = random.Random(5)
    words = ["walk", "walks", "walked", "walking", "the", "cat", "cats", "rare", "rarely", "stone", "stones"]
    rows = [(d, w, rng.randint(1, 4)) for d in range(40) for w in rng.sample(words, 3)] + [(None, "walks", 2), (None, "cat", 1)]
    rows += [(d, f"odd{d}", 1) for d in range(40)]
    tf, stop = spark.createDataFrame(rows, "doc_id long, term string, tf long"), spark.createDataFrame([("the",)], "token string")
    want = {}
    for d, w, n in rows:
        want[d, porter(w)] = want.get((d, porter(w)), 0) + n
    assert {(r.doc_id, r.term): r.tf for r in stem_counts(tf).collect()} == want  # no bound: every stem
    df = {}
    for _, s in want:
        df[s] = df.get(s, 0) + 1
    for least in (2, 5, max(df.values())):
        got = {(r.doc_id, r.term): r.tf for r in stem_counts(tf, least, stop).collect()}
        assert {k: n for k, n in got.items() if df[k[1]] >= least} == {
            k: n for k, n in want.items() if df[k[1]] >= least and k[1] != "the"}
        assert all(want[k] == n for k, n in got.items())  # rarer stems that are left are whole
        assert not any(r.stem.startswith("odd") or r.stem == "the" for r in frequent_stems(tf, least, stop).collect())


def test_later_filters_on_stems_run_no_python_on_counted_rows(spark):
    tf = spark.createDataFrame([(1, "walks", 2), (2, "the", 1)], "doc_id long, term string, tf long")
    kept = FE.remove_stopwords(stem_counts(tf).withColumnRenamed("term", "token"))
    assert "ArrowEvalPython" not in _node_names(kept._jdf.queryExecution().optimizedPlan())
    assert [(r.doc_id, r.token, r.tf) for r in kept.collect()] == [(1, "walk", 2)]
