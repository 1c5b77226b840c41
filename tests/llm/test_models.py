"""Quality, language, top products and page text."""
import html as htmllib
import math
import random
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest
from docs import DOCS, frame, rows
from pyspark.sql import functions as F

from pactline.llm import html_text, language_id, quality, queries, top_products

SF = "/root/testdata/sf0.01"


# ---- language ------------------------------------------------------------------

def test_languages_are_learned_from_the_other_folds(spark):
    found = queries.op5_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    held = found.join(docs, "doc_id").where("held_out and lang is not null").collect()
    assert len(held) > 250 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    accepted = [r for r in held if r.accepted]
    assert len(accepted) / len(held) > 0.9
    assert sum(r.lang == r.lang_pred for r in accepted) / len(accepted) >= 0.99
    assert all(0 <= r.score <= 1 for r in held)


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    swapped = docs.withColumn("lang", F.when(language_id.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a, b = (language_id.fit(d.where(~language_id.held_out())) for d in (docs, swapped))
    assert a.languages == b.languages and np.allclose(a.scores, b.scores) and a.threshold == b.threshold


def test_language_edge_cases(spark):
    train = [(i, t * 20, v) for i, (t, v) in enumerate([("the and of ", "en"), ("der die und ", "de")] * 30)]
    model = language_id.fit(spark.createDataFrame(train, "doc_id long, text string, lang string"))
    assert model.predict("the and")[0] == "en" and model.predict("und der")[0] == "de"
    for none in (None, "", "12 3!? \n", " "):
        assert model.predict(none) == ("und", 0.0, False)
    got = language_id.predict_languages(frame(spark), model)
    assert got.count() == len(rows()) and language_id.predict_languages(frame(spark).limit(0), model).count() == 0
    empty = language_id.fit(spark.createDataFrame([], DOCS))
    assert empty.predict("the") == ("und", 0.0, False)
    nothing = language_id.fit(spark.createDataFrame([(1, None, "en")], "doc_id long, text string, lang string"))
    assert nothing.predict("the") == ("und", 0.0, False)


def plain_features(text):
    body, counts = " ", Counter()
    for c in text.lower():
        c = c if c.isalpha() else " "
        body += c if c != " " or body[-1] != " " else ""
    for n in range(1, language_id.ORDERS + 1):
        for at in range(len(body) - n + 1):
            h = 0
            for j, c in enumerate(body[at:at + n]):
                h = (h * 0x01000193 ^ (ord(c) * 0x9E3779B1 + j)) & 0xFFFFFFFF
            counts[(h ^ h >> 15) & (language_id.BUCKETS - 1)] += 1
    return counts


@pytest.mark.parametrize("chunk", [1, 2, 5, 64, 1 << 20])
def test_features_do_not_depend_on_chunks(monkeypatch, chunk):
    monkeypatch.setattr(language_id, "CHUNK", chunk)
    for text in ("Ab cÉd  12 e.f " * 9, "x", "1 a", "ΑΣ ΟΔΟΣ  日本", "a" * 70 + " " * 70 + "b"):
        found = language_id.features(text)
        assert {int(i): int(found[i]) for i in np.flatnonzero(found)} == plain_features(text)
    assert language_id.features("12 .") is None


def test_predictions_against_plain_sums(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(~language_id.held_out()))
    got = {r.doc_id: r for r in language_id.predict_languages(docs, model).collect()}
    for d in docs.collect()[::5]:
        counts = plain_features(d.text)
        raw = [sum(n * float(model.scores[i, j]) for i, n in counts.items()) / sum(counts.values()) + model.bias[j]
               for j in range(len(model.languages))]
        p = np.exp(np.array(raw) / model.temperature)
        p /= p.sum()
        assert got[d.doc_id].lang_pred == model.languages[int(p.argmax())]
        assert abs(got[d.doc_id].score - p.max()) < 1e-4 and got[d.doc_id].accepted == (p.max() >= model.threshold)


# ---- quality -------------------------------------------------------------------

def test_quality_agrees_with_labels(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").withColumnRenamed("quality", "y")
    found = queries.op1_quality(spark, SF).join(labels, "doc_id").collect()
    good, bad = [r for r in found if r.y == 1], [r for r in found if r.y == 0]
    assert sum(r.keep for r in good) / len(good) >= 0.99 and sum(not r.keep for r in bad) / len(bad) >= 0.9


def plain_rates(p, host, path):
    """The hierarchy in a few lines of Python."""
    n, rate = len(p), min(max(sum(p) / len(p), 1e-4), 1 - 1e-4)

    def sums(key):
        out = {}
        for x, k in zip(p, key):
            a, b = out.get(k, (0, 0.0))
            out[k] = (a + 1, b + x)
        return out

    def strength(between):
        return min(max(rate * (1 - rate) / max(between, 1e-12) - 1, 1.0), 1e6)
    hosts, paths = sums(host), sums(list(zip(host, path)))
    spread = sum(a * (b / a - rate) ** 2 for a, b in hosts.values()) - sum(b / a * (1 - b / a) for a, b in hosts.values())
    inner = sum(a * (b / a - hosts[k[0]][1] / hosts[k[0]][0]) ** 2 for k, (a, b) in paths.items())
    inner -= sum(b / a * (1 - b / a) for a, b in paths.values())
    sh, sp = strength(max(spread, 0) / n), strength(max(inner, 0) / n)
    out = []
    for x, h, q in zip(p, host, path):
        hr = (hosts[h][1] - x + sh * rate) / (hosts[h][0] - 1 + sh)
        out.append((hr, (paths[h, q][1] - x + sp * hr) / (paths[h, q][0] - 1 + sp)))
    return out


def test_site_rates_match_plain_version(spark):
    evidence = quality.Evidence(np.array([-20.0] + [0.0] * (2 * len(quality.FEATURES) - 1) + [1.0]), 0.5)
    rng = random.Random(4)
    given = [(i, "#" * rng.randrange(6) + " word" * 5, rng.choice(["en", None]), rng.choice(["h1", "h1", "h2", None]), 0, "s", 0, "r")
             for i in range(200)]
    got = {r.doc_id: r for r in quality.judge_quality(frame(spark, given), evidence, F.col("source"), F.col("lang")).collect()}
    ids = sorted(got)
    p = [1 / (1 + math.exp(-(got[i].own_log_odds + 0.5))) for i in ids]
    want = plain_rates(p, [got[i].host for i in ids], [got[i].path for i in ids])
    for i, (hr, pr) in zip(ids, want):
        assert got[i].host_rate == pytest.approx(hr) and got[i].path_rate == pytest.approx(pr)
    text = given[7][1]
    assert got[7].own_log_odds == pytest.approx(1.0 - 20 * text.count("#") / len(text) - 0.5)


def test_sparse_sites_shrink(spark):
    evidence = quality.Evidence(np.array([-60.0] + [0.0] * (2 * len(quality.FEATURES) - 1) + [3.0]), 1.0)
    good, bad = "plain words only " * 3, "### ### ###"
    given = [(i, good if i % 4 else bad, "x", "big", 0, "", 0, "") for i in range(200)]
    given += [(500 + i, bad, "x", "junk", 0, "", 0, "") for i in range(200)] + [(900, bad, "x", "tiny", 0, "", 0, "")] * 2
    got = {r.doc_id: r for r in quality.judge_quality(frame(spark, given), evidence, F.col("source"), F.col("lang")).collect()}
    assert got[501].path_rate < 0.05 < got[900].path_rate < got[1].path_rate


def test_quality_edge_cases(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 0), (None, 1), (4, None)], "doc_id long, quality int")
    evidence = quality.fit_evidence(frame(spark), labels)
    site = queries.site_of(frame(spark))
    judged = quality.judge_quality(frame(spark), evidence, *site).collect()
    assert Counter(r.doc_id for r in judged) == Counter(r[0] for r in rows()) and all(0 <= r.quality <= 1 for r in judged)
    assert {r.own_log_odds for r in judged if not (r.row.text or "").split()} == {0.0}
    kept = quality.keep_good(frame(spark), evidence, *site)
    assert kept.columns == frame(spark).columns
    assert Counter(map(tuple, kept.collect())) == Counter(tuple(r.row) for r in judged if r.keep)
    none = quality.fit_evidence(frame(spark), labels.where("quality = 1"))
    assert none is None and quality.keep_good(frame(spark), None, *site).count() == len(rows())
    empty = spark.createDataFrame([], DOCS)
    assert quality.judge_quality(empty, evidence, *site).count() == 0 and quality.fit_evidence(empty, labels) is None


# ---- top products ----------------------------------------------------------------

def plain_top(vectors, k=5, stride=50):
    own = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in vectors
           if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = Counter()
    for q, a in own:
        if q % stride == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in own if i != q)[:k]
            out.update((q, n + 1, i, -s) for n, (s, i) in enumerate(scored))
    return out


@pytest.mark.parametrize("block, query_block", [(7, 2), (64, 1 << 11)])
def test_top_products_match_brute_force(spark, block, query_block):
    rng = random.Random(9)
    vectors = [(i, [float(np.float32(rng.gauss(0, 1) * rng.choice([0.1, 1, 3]))) for _ in range(20)]) for i in range(300)]
    vectors += [(1000 + i, [1.0] * 20) for i in range(150)] + [(2000, None), (2050, []), (2051, [float("nan")] * 20),
                (2100, [None] + [1.0] * 19), (2150, [float("inf")] * 20), (2200, [2.0] * 3), (None, [9.0] * 20), (50, vectors[50][1])]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in vectors], "vec_id long, embedding array<float>, label int, score int").repartition(4)
    got = top_products.top_products(df, df.where("vec_id % 50 = 0"), block=block, query_block=query_block).collect()
    assert Counter(map(tuple, got)) == plain_top(vectors)


def test_top_products_over_many_partitions(spark):
    rng = random.Random(10)
    vectors = [(i, [float(np.float32(rng.gauss(0, 1) * (1 + i % 7))) for _ in range(6)]) for i in range(500)]
    vectors += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 0.0]) for i in range(150)] + [(-1, [3.0] * 6), (-50, [0.0] * 6)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(211)
    got = top_products.top_products(df, df.where("vec_id % 50 = 0"), block=100, query_block=4)
    assert Counter(map(tuple, got.collect())) == plain_top(vectors)


def test_blocks_follow_positions_and_pairs_are_dropped(spark):
    rows = spark.range(1000).selectExpr("id as vec_id", "array(id * 3, 0L) as v").repartition(40)
    blocks = sorted(top_products._blocks(rows, "vec_id", 2, 300, 37).collect())
    assert [b.no for b in blocks] == [0, 1, 2, 3] and [len(b.ids) // 8 for b in blocks] == [300, 300, 300, 100]
    assert [b.top for b in blocks] == [2997.0, 2097.0, 1197.0, 297.0]
    need = [(0, 2500.0), (1, 1197.0), (2, -1e18), (3, 1e9)]
    assert top_products.block_pairs([b.top for b in blocks], need) == [(0, 1), (1, 3), (2, 4), (3, 0)]


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, -1.0]), (2, [-1.0, 0.0])], schema)
    assert sorted(map(tuple, top_products.top_products(few, few.where("vec_id = 0")).collect())) == [
        (0, 1, 1, 256 * 256), (0, 2, 2, -256 * 256)]
    none = few.limit(0)
    assert top_products.top_products(none, none).count() == 0 and top_products.top_products(few, none).count() == 0


def test_pruning_skips_tiles():
    rng = np.random.default_rng(1)
    v = (rng.normal(0, 1, (4000, 8)) * np.linspace(100, 1, 4000)[:, None]).astype(np.int64)
    q = v[::100]
    best = top_products.search(q, np.arange(0, 4000, 100), np.full(len(q), -(1 << 62)), v, np.arange(4000),
                               top_products.fit_rotation(v), tile=64, head=4)
    exact = q @ v.T
    exact[np.arange(len(q)), np.arange(0, 4000, 100)] = -(1 << 62)
    assert (best.score.reshape(-1, 5) == -np.sort(-exact, axis=1)[:, :5]).all()


# ---- page text -------------------------------------------------------------------

class Article(HTMLParser):
    """Text of <article> by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth, self.out = 0, []

    def handle_starttag(self, tag, attrs):
        self.depth += tag == "article"
        self.out += [" "] * (tag in ("p", "h1", "br"))

    def handle_endtag(self, tag):
        self.depth -= tag == "article"
        self.out += [" "] * (tag in ("p", "h1"))

    def handle_data(self, data):
        self.out += [data] * (self.depth > 0)


def test_pages_give_exactly_their_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = queries.op9_html_text(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        parser = Article()
        parser.feed(pages[r.page_id])
        assert r.text == " ".join("".join(parser.out).split()) and r.n_chars == len(r.text)


BODY = "<h1>Ti<b>tle</b></h1><p>One &amp; two&nbsp;three four five six.</p><p>End.</p>"
TEXT = "Title One & two three four five six. End."


@pytest.mark.parametrize("page, text", [
    (f"<nav>a b c</nav><article>{BODY}</article><footer>f f f</footer>", TEXT),
    (f"<div class='sidebar'>many many many many words here</div><main>{BODY}</main><div id=comments><p>nice post</p></div>", TEXT),
    (f"<header><p>Site name</p></header><div class=content>{BODY}</div><div class='cookie-notice'>ok ok ok</div>", TEXT),
    (f"<div class='has-sidebar'><article>{BODY}</article><aside>x y z</aside></div>", TEXT),
    (f"<article>{BODY.replace('<p>End', '<div class=ad>buy now buy now</div><form>Name <input> Mail</form><p>End')}</article>", TEXT),
    (f"<script>var a='<p>no</p>';</script><!-- <p>no</p> --><style>p{{}}</style>{BODY}", TEXT),
    (f"<ul class=menu><li><a href=/>Home</a></li></ul><section role='navigation'>go</section>{BODY}<div hidden>no</div>", TEXT),
    (f"<article>{BODY}<div class=ad>never closed</article><footer>z</footer>", TEXT),
    ("plain text only", "plain text only"), ("", ""), (None, ""), ("<p></p>", ""), ("<!-- open", ""), ("a < b <c d", "a < b <c d"),
    ("<article>" + "<p>word</p>" * 30_000 + "</article>", " ".join(["word"] * 30_000)),
])
def test_extraction_cases(page, text):
    learned = Counter()
    for _ in range(20):
        learned.update(html_text.count_labels(f"<nav><ul><li><a href=/>x</a></li></ul></nav><article>{BODY}</article><footer>f</footer>"))
    for weights in (html_text.Weights(), html_text.Weights(learned)):
        assert html_text.main_text(page, weights) == text


LONG = BODY.replace("<p>End.</p>", "{}<p>End.</p>")


@pytest.mark.parametrize("page, text", [
    # names that only hold a word of boilerplate
    (f"<article>{LONG.format('<h2 id=related-work>Related work</h2><p class=copyright-law>Law.</p>')}</article>",
     TEXT.replace("End", "Related work Law. End")),
    (f"<article>{LONG.format('<h2 id=sharing-data>Sharing</h2><h2 id=comments>Comments</h2>')}</article>",
     TEXT.replace("End", "Sharing Comments End")),
    (f"<article>{LONG.format('<pre><span class=comment># why</span> x</pre>')}</article>", TEXT.replace("End", "# why x End")),
    # and names that say it as a whole
    (f"<article>{LONG.format('<div class=related-posts>r r</div><div id=div-gpt-ad-300x250>a</div><p class=shareButtons>s</p>')}"
     "</article>", TEXT),
    # wrappers
    (f"<div class='layout has-sidebar'>{BODY}<div class=sidebar>x y z</div></div>", TEXT),
    (f"<div class='layout sidebar-left'>{BODY}<div class=sidebar>x y z</div></div><div class=ad>a</div>", TEXT),
    (f"<div class=banner><div class=widget>{BODY}</div></div>", TEXT),
    (f"<form><nav>n</nav><article>{BODY}</article><footer>f</footer></form>", TEXT),
    (f"<form action=/><main>{BODY}<form>Name <input></form></main></form>", TEXT),
    (f"<form id=aspnetForm><input type=hidden><div>{BODY}</div><select><option>o</select></form>", TEXT),
    # none: links, a long thread, a long sidebar beside an article
    (f"{BODY}<div class=sidebar>{'<a href=/>one two three</a> ' * 30}</div>", TEXT),
    (f"<main>{BODY}<div id=comments>{'<p>nice post</p>' * 300}</div></main>", TEXT),
    (f"<main>{BODY}</main><div class=sidebar>{'<p>nice post</p>' * 300}</div>", TEXT),
    # formulas are text, their source is not
    (f"<article>{LONG.format('<p>Is <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation>\\x</annotation></semantics></math> so.</p>')}"
     "</article>", TEXT.replace("End", "Is x=2 so. End")),
])
def test_names_and_wrappers_lose_no_text(page, text):
    learned = Counter()
    for _ in range(20):
        learned.update(html_text.count_labels(f"<nav><ul><li><a href=/>x</a></li></ul></nav><article>{BODY}</article><footer>f</footer>"))
    for weights in (html_text.Weights(), html_text.Weights(learned)):
        assert html_text.main_text(page, weights) == text


def _labelled(n, *pages):
    counts = Counter()
    for _ in range(n):
        for page in pages:
            counts.update(html_text.count_labels(page))
    return counts


def test_scan_with_learned_weights_needs_no_list(spark):
    """Without any prior against names or landmarks, weights from labelled pages
    let the run leave out menu, advert and footer, also where no article is marked."""
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    learned = html_text.Weights(_labelled(1, *pages[:100]), known=False)
    blank = html_text.Weights(known=False)
    for page in pages[100:]:
        parser = Article()
        parser.feed(page)
        text = " ".join("".join(parser.out).split())
        assert html_text.main_text(page, learned) == text
        assert html_text.main_text(page.replace("<article>", "").replace("</article>", ""), learned) == text
        assert html_text.main_text(page, blank) != text


def test_labels_outweigh_names_both_ways():
    outside = "<div class=zebra>z z z</div><article>{}</article><div class=thread-x>c c c</div><footer>f f</footer>"
    page = outside.format(BODY)
    assert html_text.main_text(page, html_text.Weights()) != TEXT  # nothing known of these names
    learned = html_text.Weights(_labelled(20, page), known=False)
    assert html_text.main_text(page, learned) == TEXT
    assert html_text.main_text(outside.format(LONG.format("<div class=zebra>z z</div>")), learned) == TEXT
    kept = f"<article>{LONG.format('<p class=notice>By post.</p>')}</article>"
    assert html_text.main_text(kept, html_text.Weights()) == TEXT
    assert html_text.main_text(kept, html_text.Weights(_labelled(20, kept))) == TEXT.replace("End", "By post. End")
    # an element around the article says nothing of its kind
    assert not any(k == ".wrap-it" for k, _ in html_text.count_labels(f"<div class=wrap-it><article>{BODY}</article></div>"))


def test_scan_leaves_out_few_words_behind_what_is_no_text():
    long = "<p>" + "word " * 40 + "</p>"
    footer = "<div class=footer>" + "f " * 30 + "</div>"
    assert html_text.main_text(f"{long}{footer}<p>All rights kept.</p>", html_text.Weights()).split() == ["word"] * 40
    # but much text, or text of one article, goes on behind it
    assert html_text.main_text(f"{long}{footer}{long}", html_text.Weights()).split() == ["word"] * 80
    got = html_text.main_text(f"<article>{long}<div class=ad>{'a ' * 30}</div><p>End.</p></article>", html_text.Weights())
    assert got.split() == ["word"] * 40 + ["End."]


def test_best_run_matches_brute_force():
    rng = random.Random(0)
    for _ in range(200):
        s = [rng.choice([-3.0, -1.0, 0.0, 1.0, 2.0]) for _ in range(rng.randrange(12))]
        a, b = html_text.best_run(s)
        assert sum(s[a:b]) == max([0.0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1))])


def test_extraction_frames(spark):
    schema = "page_id long, url string, html string, text string"
    pages = spark.createDataFrame([(1, "u", f"<article>{BODY}</article>", "t"), (1, "u", None, "t"), (None, None, "", None)], schema)
    got = html_text.extract_text(pages, html_text.learn_weights(pages)).collect()
    assert Counter(map(tuple, got)) == Counter([(1, "u", TEXT, len(TEXT)), (1, "u", "", 0), (None, None, "", 0)])
    none = pages.limit(0)
    assert html_text.extract_text(none, html_text.learn_weights(none)).count() == 0
