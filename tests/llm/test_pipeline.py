"""The pipeline's stages against brute force, each on its own input."""
from collections import Counter, defaultdict

import corpus_pipeline
from test_text_dedup import plain_components, plain_fingerprint, sha

from pactline.llm import queries
from pactline.llm.common import keep_table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    kept = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(keep_table(stage(spark, kept[-1], SF), "stage"))
    raw, good, unique, apart, mixed = ([tuple(r) for r in df.collect()] for df in kept[:5])
    assert all(df.columns == kept[0].columns for df in kept[:5])
    bad = {r.doc_id for r in queries.op1_quality(spark, SF).where("not keep").collect()}
    assert Counter(good) == Counter(r for r in raw if r[0] not in bad) and bad
    last = {}
    for r in good:
        last[sha(r[1])] = max(last.get(sha(r[1]), r), r)
    assert Counter(unique) == Counter(last.values())
    fp = {r[0]: plain_fingerprint(r[1]) for r in unique}
    comp, least = plain_components(fp.values()), {}
    for r in unique:
        c = comp[fp[r[0]]]
        least[c] = min(least.get(c, r), r)
    assert Counter(apart) == Counter(least.values())
    assert {r[0] for r in mixed} <= {r[0] for r in apart} and max(Counter(mixed).values()) <= 3
    copies = Counter(r[0] for r in mixed)
    pieces = defaultdict(list)
    for p in kept[5].collect():
        pieces[p.doc_id].append(p)
    assert set(pieces) == set(copies)
    for doc, own in pieces.items():
        assert sum(p.length for p in own) == copies[doc] * own[0].doc_tokens


def test_run_writes_and_rereads_each_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    size = Counter()
    for r in got.collect():
        size[r.sequence_id] += r.length
    assert max(size.values()) <= 2048
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in size.values())
    assert padding / sum(size.values()) < 0.02


