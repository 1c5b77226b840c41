"""Model invariants and plan shape."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from paths import SF001
from pactline.operators import bayes as B
from pactline.operators import blocks as BL
from pactline.operators import clusters as K
from pactline.operators import features as FE
from pactline.operators import models as M
from pactline.operators import split as SP
from pactline.operators import svm as S
from pactline.operators import terms as TE
from pactline.operators.terms import written


def _docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text", F.col("lang").alias("label"))


def test_naive_bayes_beats_majority(spark):
    d = _docs(spark)
    roles = SP.holdout_split(d.select("doc_id"), "doc_id", 0.3, 11)
    pred = B.predict(FE.term_counts(FE.tokens(d, "sk")), d.select("doc_id", "label"), B.holdout_parts(roles))
    acc = M.accuracy(pred, d.select("doc_id", "label")).first()["accuracy"]
    majority = d.groupBy("label").count().agg(F.max("count")).first()[0] / d.count()
    assert acc > majority and acc >= 0.8
    rep = {r.cls: r for r in M.f1_report(pred, d.select("doc_id", "label")).collect()}
    assert abs(rep["micro avg"].f1 - acc) < 1e-9


def test_cv_folds_cover_every_doc_once(spark):
    d = _docs(spark)
    parts = B.fold_parts(SP.kfold(d.select("doc_id"), "doc_id", 5))
    x = B.weighted(FE.term_counts(FE.tokens(d, "sk")), parts, 5)
    assert x.rows.select("doc_id", "term").distinct().count() == x.rows.count() == x.n_rows  # no copy for a fold
    pred = B.predict(None, d.select("doc_id", "label"), parts, 5, x)
    assert pred.count() == pred.select("doc_id").distinct().count() == d.count()
    assert {(r.doc_id, r.part) for r in pred.collect()} == {(r.doc_id, r.part) for r in parts.collect()}
    svm = S.predict(x, d.select("doc_id", "label"), parts, 5)
    assert svm.count() == d.count()
    by_fold = M.accuracy(svm.withColumnRenamed("part", "fold"), d.select("doc_id", "label"), ["fold"]).collect()
    assert len(by_fold) == 5 and sum(r.accuracy for r in by_fold) / 5 >= 0.85


def _plain_bayes(docs, k):
    """Scores of every class for every test document, one evaluation after the other."""
    out = {}
    for f in range(k):
        train = [d for d in docs if d[2] != f]
        df = Counter(t for d in train for t in d[1])
        idf = {t: math.log((1 + len(train)) / (1 + n)) + 1 for t, n in df.items()}

        def vector(d):
            w = {t: n * idf[t] for t, n in d[1].items() if t in idf}
            size = math.sqrt(sum(x * x for x in w.values()))
            return {t: x / size for t, x in w.items()}
        nct, n_c = defaultdict(Counter), Counter()
        for d in train:
            if d[3] is not None:
                n_c[d[3]] += 1
                for t, x in vector(d).items():
                    nct[d[3]][t] += x
        for d in docs:
            if d[2] == f:
                x = vector(d)
                out[d[0]] = {c: math.log(n_c[c] / len(train)) + sum(
                    v * math.log((nct[c][t] + 1) / (sum(nct[c].values()) + len(idf))) for t, v in x.items()) for c in n_c}
    return out


def test_naive_bayes_without_a_class_bound(spark):
    """20,000 classes of which a document shares a term with few: the best of
    the rest comes from the envelope; against all scores."""
    rng = random.Random(11)
    docs = [(i, Counter(rng.choices([f"t{i % 20_000}", f"u{rng.randrange(3000)}", "v"], k=rng.randint(1, 6))),
             -1, i % 20_000) for i in range(24_000)]
    docs += [(50_000 + i, Counter(rng.choices([f"t{i}", "never seen", f"u{i}", "v"], k=2)), 0, None) for i in range(60)]
    docs += [(60_000, Counter(), 0, None), (60_001, Counter(), -1, 3), (60_002, Counter(["x"]), -1, None)]
    tf = spark.createDataFrame([(d, t, n) for d, c, _, _ in docs for t, n in c.items()], "doc_id long, term string, tf long")
    labels = spark.createDataFrame([(d[0], d[3]) for d in docs], "doc_id long, label int")
    parts = spark.createDataFrame([(d[0], d[2]) for d in docs], "doc_id long, part int")
    got = {r.doc_id: r for r in B.predict(tf, labels, parts).collect()}
    want = _plain_bayes(docs, 1)
    assert set(got) == set(want)
    for d, scores in want.items():
        best = max(scores.values())
        assert abs(got[d].score - best) < 1e-9 and abs(scores[got[d].pred] - best) < 1e-9


def test_naive_bayes_folds_against_the_plain_model(spark):
    rng = random.Random(12)
    docs = [(i, Counter(f"w{min(rng.randrange(40), rng.randrange(40))}" for _ in range(rng.randint(0, 12))), i % 3,
             rng.choice(["a", "b", "c", None])) for i in range(90)]
    tf = spark.createDataFrame([(d, t, n) for d, c, _, _ in docs for t, n in c.items()], "doc_id long, term string, tf long")
    labels = spark.createDataFrame([(d[0], d[3]) for d in docs], "doc_id long, label string")
    parts = spark.createDataFrame([(d[0], d[2]) for d in docs], "doc_id long, part int")
    got = {r.doc_id: r for r in B.predict(tf, labels, parts, 3).collect()}
    for d, scores in _plain_bayes(docs, 3).items():
        assert abs(got[d].score - max(scores.values())) < 1e-9
        assert got[d].pred == min(c for c, s in scores.items() if abs(s - max(scores.values())) < 1e-9)


def test_upper_lines():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n = int(rng.integers(1, 30))
        prior, lnorm = rng.integers(-9, 0, n) / 2, rng.integers(1, 9, n) / 2
        kept, begins = B.upper_lines(prior, lnorm, np.arange(n))
        for x in rng.random(20) * 12 + 1e-3:
            i = kept[int(np.searchsorted(begins, x, "right")) - 1]
            assert prior[i] - lnorm[i] * x >= (prior - lnorm * x).max() - 1e-9


def test_saved_model_scores_like_the_fitted_one(spark, tmp_path):
    d = _docs(spark)
    tf, parts = FE.term_counts(FE.tokens(d, "sk")), B.holdout_parts(SP.holdout_split(d.select("doc_id"), "doc_id", 0.3, 11))
    x = B.weighted(tf, parts)
    model = B.fit(x, d.select("doc_id", "label"), parts)
    B.save_model(model, str(tmp_path / "m"))
    new = spark.createDataFrame([(1, "zzzz unknown qqqq"), (2, ""), (3, d.first()["text"])], "doc_id long, text string")
    tf_new = FE.term_counts(FE.tokens(new, "sk"))
    got = [{r.doc_id: (r.pred, round(r.score, 9)) for r in B.score_documents(m, tf_new, new).collect()}
           for m in (model, B.load_model(spark, str(tmp_path / "m")))]
    assert got[0] == got[1] and set(got[0]) == {1, 2, 3} and got[0][1] == got[0][2]


def test_svm_first_steps_against_numpy(spark):
    rng = random.Random(13)
    docs = [(i, {f"w{rng.randrange(9)}": float(rng.random()) for _ in range(5)}, i % 2, rng.choice("abc")) for i in range(40)]
    rows = spark.createDataFrame([(d, p, t, v, 2 * v) for d, c, p, _ in docs for t, v in c.items()],
                                 "doc_id long, part int, term string, x_0 double, x_1 double")
    parts = spark.createDataFrame([(d[0], d[2]) for d in docs], "doc_id long, part int")
    labels = spark.createDataFrame([(d[0], d[3]) for d in docs], "doc_id long, label string")
    stats = rows.groupBy("term").agg(F.count("*").alias("df"))
    x = B.Weighted(rows, stats, rows.count(), [20, 20], [9, 9])
    terms, classes = ["", *[f"w{j}" for j in range(9)]], "abc"
    dense = np.array([[1.0, *[d[1].get(t, 0.0) for t in terms[1:]]] for d in docs])
    y = np.array([[1.0 if d[3] == c else -1.0 for c in classes] for d in docs])
    _, weights, _ = S.fit(x, labels, parts, 2, steps=4, alpha=0.1)
    got = {(r.term, r["class"]): (r.w_0, r.w_1) for r in weights.collect()}
    for f in (0, 1):
        train, own = np.array([d[2] != f for d in docs]), dense * ([1, *[1 + f] * 9])
        w = np.zeros((len(terms), 3))
        for t in range(1, 5):
            active = (y * (own @ w) < 1) & train[:, None]
            w = (1 - 1 / t) * w + own.T @ (y * active) / (0.1 * t * train.sum())
        for i, term in enumerate(terms):
            for j, c in enumerate(classes):
                assert abs(got[term, c][f] - w[i, j]) < 1e-9


def test_mllib_pipelines_run_and_reload(spark, tmp_path):
    d = _docs(spark)
    model = M.svm_pipeline().fit(d)
    pred = M.predicted_labels(model, d)
    acc = pred.join(d, "doc_id").select(F.avg((F.col("pred") == F.col("label")).cast("double"))).first()[0]
    assert acc >= 0.9
    M.save_model(model, str(tmp_path / "svm"))
    again = M.predicted_labels(M.load_model(str(tmp_path / "svm")), d)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, pred.collect()))


def test_kmeans_sweep(spark):
    d = _docs(spark)
    ks = [2, 5, 9, 14]
    features = written(K.cluster_features(d), "test-features")
    found = written(K.kmeans_sweep(d, ks, features=features), "test-clusters")
    assert found.count() == len(ks) * d.count()
    sizes = {r.k: r.n for r in found.groupBy("k").agg(F.countDistinct("cluster").alias("n")).collect()}
    assert all(1 < sizes[k] <= k for k in ks)
    cost = {r.k: r.cost for r in K.sweep_cost(found).collect()}
    assert cost[2] > cost[5] > cost[9] > cost[14] > 0
    plan = _plan(K.cluster_features(d))
    assert plan.count("SinglePartition") <= 1  # only the numbering of the kept terms, which are few
    one = K.kmeans_sweep(d, [5], features=features)
    assert {(r.doc_id, r.cluster) for r in one.collect()} == {(r.doc_id, r.cluster) for r in found.where("k = 5").collect()}
    wide = K.attach_clusters(d.select("doc_id"), found, ks)
    assert wide.columns == ["doc_id", *[f"cluster_by_text_{k}" for k in ks]] and wide.count() == d.count()


def test_lloyd_step_against_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.random((50, 6)) * (rng.random((50, 6)) < 0.6)
    rows = [(i, np.flatnonzero(r).tolist(), r[r > 0].tolist()) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "doc_id long, i array<int>, x array<double>").repartition(4)
    centres = {3: x[:3].copy(), 7: np.vstack([x[:6], x[:1]])}  # the seventh is never nearest
    got = K.lloyd_step(df, centres, 6)
    for k, c in centres.items():
        own = np.argmin(((x[:, None] - c) ** 2).sum(2).round(9), axis=1)
        for j in range(k):
            want = x[own == j].mean(0) if (own == j).any() else c[j]
            assert np.allclose(got[k][j], want)
    assert K.groups_of([25, 26, 27], 100, 8 * 100 * 52) == [[25, 26], [27]]
    assert K.groups_of([25, 26], 10**9) == [[25], [26]]


def test_joins_on_terms_spread_common_ones(spark):
    rows = spark.range(4000).selectExpr("id as doc_id", "array('hot', concat('w', id % 700)) as t").selectExpr(
        "doc_id", "explode(t) as term")
    stats = rows.groupBy("term").agg(F.count("*").alias("df"))
    side = stats.selectExpr("term", "explode(array('a', 'b')) as class", "df * 2 as v").drop("df")
    n = rows.count()
    plain = rows.join(stats.selectExpr("term", "df as v"), "term")
    got = TE.join_terms(rows, stats.withColumn("v", F.col("df")), n)
    assert sorted(map(tuple, got.select("doc_id", "term", "v").collect())) == sorted(
        map(tuple, plain.select("doc_id", "term", "v").collect()))
    both = TE.join_salted(rows, side, stats, n, ["term"])
    assert both.count() == 2 * n and both.where("term = 'hot'").count() == 8000
    few = stats.where(TE.is_heavy(n, 2))
    assert [r.term for r in few.collect()] == []
    assert [r.term for r in stats.where(TE.is_heavy(n, 3)).collect()] == ["hot"]
    plan = _plan(TE.join_terms(rows, stats.withColumn("v", F.col("df")), n))
    assert "LeftAnti" in plan and "BroadcastHashJoin" in plan  # the hot term's rows never reach the shuffle join


def test_tagger_plan_has_no_single_partition_exchange(spark):
    from pactline.operators import tagger
    from pactline.sources.contracts import contracts
    plan = tagger.tag_positions(contracts(spark, SF001))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "hashpartitioning(doc_id" in plan


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_plans_stay_distributed(spark):
    d = _docs(spark)
    tf = FE.term_counts(FE.tokens(d, "sk", clustered=True))
    assert "SinglePartition" not in _plan(FE.tfidf(tf, d.count()))
    roles = SP.holdout_split(d.select("doc_id"), "doc_id", 0.3, 11)
    plan = _plan(B.predict(tf, d.select("doc_id", "label"), B.holdout_parts(roles))).splitlines()
    # only Spark's own Bloom filters, sums of fixed size, meet in one task
    assert all("bloom_filter_agg" in below for at, below in zip(plan, plan[1:]) if "SinglePartition" in at)
    toks = FE.tokens(d, "seq")
    vocab = FE.vocab_topk(toks)
    pad = FE.padded_sequences(toks, vocab, d.select("doc_id"), 50)
    pad.collect()
    assert "WindowGroupLimit" in _plan(pad)
    assert "TakeOrderedAndProject" in _plan(vocab)


def test_common_terms_stay_with_their_documents(spark):
    """Rows of the commonest terms, as many as may be sent, are joined where they are."""
    rows = spark.createDataFrame([(d, t) for d in range(40) for t in ("often", f"t{d}", f"u{d % 5}")], "doc_id long, term string")
    side = spark.createDataFrame([(t, c) for t in ["often", *[f"t{d}" for d in range(0, 40, 2)], "u1", "none"] for c in "abc"],
                                 "term string, class string")
    stats = rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    assert TE.least_of_most(stats, 1) == 40 and TE.least_of_most(stats, 5) == 40 and TE.least_of_most(stats, 6) == 8
    assert TE.least_of_most(stats, 0) > 1 << 60 and TE.least_of_most(stats, 100) == 1
    expected = sorted(map(tuple, rows.join(side, "term").collect()))
    for most in (1, 6, 1 << 20):
        met = TE.join_classes(rows, side, stats, 120, ["term"], TE.SENT_BYTES // (80 * most) + (most == 1))
        assert sorted((r.term, r.doc_id, r["class"]) for r in met.collect()) == expected


def test_document_frequencies_are_counted_once(spark):
    """The join reads them for common and for rare terms."""
    tf = FE.term_counts(FE.tokens(_docs(spark), "sk", clustered=True))
    for weights in (FE.tfidf_log(tf, 100), FE.tfidf(tf, 100)):
        plan = weights._jdf.queryExecution().withCachedData().toString()
        assert "InMemoryRelation" in plan and not any(x.lstrip(" :+-").startswith("Aggregate [term") for x in plan.splitlines())


def test_as_many_common_terms_as_allowed_are_sent(spark, monkeypatch):
    """Ten terms of which none has a tenth of the rows stay with their documents."""
    monkeypatch.setattr(TE, "HEAVY_TERMS", 10)
    rows = spark.range(200).selectExpr("id as doc_id", "explode(array(concat('w', id % 10), concat('a', id), concat('b', id))) as term")
    stats = rows.groupBy("term").agg(F.count("*").alias("df")).persist()
    met = TE.join_terms(rows, stats.withColumn("v", F.col("df")), 600)
    moved = met._jdf.queryExecution().optimizedPlan()
    assert "df" in moved.toString() and met.count() == 600
    assert TE.least_of_most(stats, TE.HEAVY_TERMS) == 20 and stats.where(TE.is_heavy(600, 10)).count() == 0
    assert ">= 20" in moved.toString()  # the terms of 20 documents are broadcast


def test_weighting_deals_only_rare_terms_back(spark):
    d = _docs(spark)
    tf = FE.term_counts(FE.tokens(d, "sk", clustered=True))
    parts = B.holdout_parts(SP.holdout_split(d.select("doc_id"), "doc_id", 0.3, 11))
    x = B.weighted(tf, parts)
    plan = _plan(x.rows).splitlines()
    norm = next(i for i, line in enumerate(plan) if "Window [sum(" in line)
    union = next(i for i, line in enumerate(plan) if i > norm and "Union" in line)
    assert not any("Exchange" in line for line in plan[norm:union])  # the norm is taken where the rows lie
    assert x.rows.count() == x.n_rows


def _odd_documents(spark):
    """Documents with repeated ids, no label, no term, no id, several labels, and terms of one document."""
    rng = random.Random(21)
    docs = [(i, Counter([f"w{min(rng.randrange(40), rng.randrange(40))}" for _ in range(rng.randint(0, 14))] + [f"own{i}"] * (i % 3)),
             rng.choice(["b", "a", "c", None])) for i in range(120)]
    tf = spark.createDataFrame([(d, t, n) for d, c, _ in docs for t, n in c.items()], "doc_id long, term string, tf long")
    again = [(5, "a"), (5, "c"), (6, "b"), (None, "a"), (500, "b")]
    labels = spark.createDataFrame([(d, y) for d, _, y in docs] + again, "doc_id long, label string")
    parts = [(d[0], d[0] % 4 - 1) for d in docs] + [(5, 1), (7, 2), (8, 7 % 4 - 1), (None, 1), (300, 0)]
    return tf, labels, spark.createDataFrame(parts, "doc_id long, part int")


def test_blocks_equal_the_joins(spark, monkeypatch):
    """Models over documents as sparse rows, with and without rare terms, one evaluation at a time or all."""
    monkeypatch.setattr(BL, "LEAST_ROOM", 0)
    tf, labels, parts = _odd_documents(spark)
    x = B.weighted(tf, parts, 3)
    joined = x._replace(docs=None)
    rows = lambda df: sorted((r.doc_id is None, r.doc_id, r.part, r.pred, round(r.score, 9)) for r in df.collect())
    bayes, svm = rows(B.predict(None, labels, parts, 3, joined)), rows(S.predict(joined, labels, parts, 3, 4, 0.1))
    assert len(bayes) > 85
    sums = {(r.label, r.term): [r.n_0, r.n_1, r.n_2] for r in B._class_sums(joined, labels.where("label IS NOT NULL"), 3).collect()}
    for most in (1 << 20, 8 * 4 * 30, 8 * 4 * 7):  # all terms, and 30 and 7 of them, are common for one evaluation
        monkeypatch.setattr(BL, "DENSE_BYTES", most)
        b = B.blocks_of(x, labels, 3)
        assert (b.rare is None) == (most == 1 << 20) and len(b.groups) == (1 if most == 1 << 20 else 3)
        assert rows(B.predict(None, labels, parts, 3, x)) == bayes
        assert rows(S.predict(x, labels, parts, 3, 4, 0.1)) == svm
        got = {(r.label, r.term): [r.n_0 or 0.0, r.n_1 or 0.0, r.n_2 or 0.0] for r in B._class_sums(x, labels.where("label IS NOT NULL"), 3).collect()}
        for key, want in sums.items():
            assert np.allclose(got.pop(key, [0.0] * 3), [v or 0.0 for v in want])
        assert not got


def test_evaluations_go_together_where_rare_rows_stay_small():
    sizes = [(100, 10), (50, 100), (2, 1000), (1, 50_000)]
    assert BL.least_for(sizes, 9) > 1 << 60 and BL.least_for(sizes, 110) == 50 and BL.least_for(sizes, 1 << 20) == 1
    assert BL.evaluations_at_once(sizes, 4, 3, 0) == [[0, 1, 2, 3]]  # every term is common
    least = BL.least_for(sizes, 1 << 16)
    assert BL.evaluations_at_once([(s, n * 1000) for s, n in sizes], 10, 4, 1 << 31) != [list(range(10))] and least == 1
    assert BL.evaluations_at_once([(s, n * 1000) for s, n in sizes], 4, 4, 0) == [[0], [1], [2], [3]]


def test_ten_folds_are_never_stored(spark):
    """What is kept holds no column for each fold beside a document's norms."""
    tf, labels, parts = _odd_documents(spark)
    x = B.weighted(tf, parts, 3)
    assert "InMemoryRelation" not in x.rows.select("x_0")._jdf.queryExecution().withCachedData().toString().split("Join")[0]
    assert [n for n, _ in x.docs.dtypes] == ["doc_id", "ps", "t"] and x.docs.count() == 122
    assert B.blocks_of(x, labels, 3).docs.columns == ["doc_id", "ps", "ls", "v", "i", "n"]
