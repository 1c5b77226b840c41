"""Exact and near dedup against brute force."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from docs import DOCS, frame, rows
from pyspark.sql import functions as F

from pactline.llm import mph_dedup, simhash

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def sha(text):
    return hashlib.sha256((text or "").translate(LOWER).encode()).hexdigest()


def plain_fingerprint(text, k=4):
    tokens = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    if not tokens:
        return 0
    grams = [" ".join(tokens[i:i + k]) for i in range(max(1, len(tokens) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, radius=4):
    """Least reachable member of each distinct fingerprint, by every pair."""
    fps, up = sorted(set(fps)), {}
    for f in fps:
        up[f] = f

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                up[max(root(a), root(b))] = min(root(a), root(b))
    return {f: root(f) for f in fps}


# ---- exact dedup ---------------------------------------------------------------

def test_exact_dedup_matches_brute_force(spark):
    given = rows()
    docs = frame(spark)
    own = mph_dedup.digests(docs)
    found = mph_dedup.dedup_report(own, mph_dedup.build_index(own, shard=7)).collect()
    groups = {}
    for r in given:
        groups.setdefault(sha(r[1]), []).append(r[0])
    known = {s: max((i for i in ids if i is not None), default=None) for s, ids in groups.items()}
    want = Counter((r[0], known[sha(r[1])], len(groups[sha(r[1])]), sha(r[1])) for r in given)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == want
    kept = [r for r in found if r.kept]
    assert len(kept) == len(groups) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_drop_repeats_keeps_one_whole_row_of_each_text(spark):
    docs = frame(spark)
    own = mph_dedup.digests(docs)
    kept = mph_dedup.drop_repeats(docs, own, mph_dedup.build_index(own, shard=7))
    assert kept.columns == docs.columns
    got = kept.collect()
    assert Counter(sha(r.text) for r in got) == Counter({sha(r[1]) for r in rows()})
    assert {tuple(r) for r in got} <= {tuple(r) for r in rows()}


def test_history_wins_and_nonmembers_group_separately(spark):
    old = spark.createDataFrame([(5, "A b"), (9, "c"), (7, "a b")], "doc_id long, text string")
    new = spark.createDataFrame([(50, "a B"), (51, "new"), (52, "NEW"), (53, "c"), (54, None)], "doc_id long, text string")
    own, index = mph_dedup.digests(new), mph_dedup.build_index(mph_dedup.digests(old))
    found = {r.doc_id: r for r in mph_dedup.dedup_report(own, index).collect()}
    assert [(found[i].keep_id, found[i].group_size, found[i].kept, found[i].repeat) for i in range(50, 55)] == [
        (7, 2, False, True), (52, 2, False, False), (52, 2, True, False), (9, 1, False, True), (54, 1, True, False)]
    assert {r.doc_id for r in mph_dedup.drop_repeats(new, own, index).collect()} == {52, 54}


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    own = mph_dedup.digests(none)
    assert mph_dedup.dedup_report(own, mph_dedup.build_index(own)).count() == 0
    docs = frame(spark)
    assert mph_dedup.drop_repeats(docs, mph_dedup.digests(docs), mph_dedup.build_index(own)).count() > 0
    assert simhash.simhash_components(none).count() == 0
    assert simhash.keep_representatives(none).count() == 0


@pytest.mark.parametrize("n", [1, 2, 9, 5000])
def test_hash_is_minimal_and_perfect(n):
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(2 * n)), np.uint8).reshape(-1, 32)
    levels = mph_dedup.build_levels(digests[:n])
    assert sorted(mph_dedup.slots(digests[:n], levels)) == list(range(n))
    others = mph_dedup.slots(digests[n:], levels)
    assert ((others >= -1) & (others < n)).all()


# ---- SimHash ---------------------------------------------------------------------

def test_fingerprints_match_brute_force(monkeypatch):
    monkeypatch.setattr(simhash, "CHUNK", 7)
    for r in rows():
        if len(r[1] or "") < 60_000:
            assert simhash.fingerprint(r[1]) == plain_fingerprint(r[1])
    assert simhash.fingerprint(None) == simhash.fingerprint(" \t ") == 0


def test_links_span_all_pairs():
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (2 ** 64 - 1) for b in base * 8}
    fps = sorted(fps)
    left, right = fps[::2], fps[1::2]
    for a, b, every in ((fps, None, fps), (left, right, fps)):
        edges = simhash.links(np.array(a, np.uint64), None if b is None else np.array(b, np.uint64), tile=16)
        edges = edges.view(np.uint64)
        assert all((int(u) ^ int(v)).bit_count() <= 4 for u, v in edges)
        up = {f: f for f in every}

        def root(x):
            while up[x] != x:
                x = up[x]
            return x
        for u, v in edges:
            p, q = root(int(u)), root(int(v))
            up[max(p, q)] = min(p, q)
        if b is None:
            assert {f: root(f) for f in fps} == plain_components(fps)
        else:
            for u in left:
                assert all(root(u) == root(v) for v in right if (u ^ v).bit_count() <= 4)


def test_components_match_brute_force(spark):
    given = rows()
    fp = {t: plain_fingerprint(t) if len(t or "") < 60_000 else simhash.fingerprint(t) for t in {r[1] for r in given}}
    comp = plain_components(fp.values())
    least = {}
    for r in given:
        if r[0] is not None:
            c = comp[fp[r[1]]]
            least[c] = min(least.get(c, r[0]), r[0])
    want = Counter((r[0], f"{fp[r[1]]:016x}", least.get(comp[fp[r[1]]])) for r in given)
    found = simhash.simhash_components(frame(spark)).select("id", simhash.hex16("fp").alias("x"), "component_id").collect()
    assert Counter(map(tuple, found)) == want
    kept = simhash.keep_representatives(frame(spark)).collect()
    assert {tuple(r) for r in kept} <= set(given)
    assert Counter(comp[fp[r.text]] for r in kept) == Counter(set(comp.values()))


def test_one_id_on_unlike_texts_loses_no_component(spark):
    texts = [" ".join(f"{w}{i}" for i in range(60)) for w in "abcdef"]
    comp = plain_components([plain_fingerprint(t) for t in texts])
    assert len(set(comp.values())) == len(texts)
    # 1: least id of two components; 2: of one, and not the least in another; 5, 7: of one each, 5 twice the same row
    ids = [(1, 0), (1, 1), (9, 1), (2, 2), (2, 1), (3, 2), (5, 3), (5, 3), (7, 4), (None, 4), (None, 5), (None, 5)]
    given = [(i, texts[n], "en", str(n), 0, "s", 0, "r") for i, n in ids]
    kept = simhash.keep_representatives(frame(spark, given)).collect()
    assert sorted((r.source, r.doc_id) for r in kept) == [("0", 1), ("1", 1), ("2", 2), ("3", 5), ("4", 7), ("5", None)]
    assert {tuple(r) for r in kept} <= set(given)
    same = [(4, t, "en", str(n), 0, "s", 0, "r") for n, t in enumerate(texts)]
    assert sorted(map(tuple, simhash.keep_representatives(frame(spark, same)).collect())) == same


def test_long_chains_are_one_component(spark):
    chain = [(0, 0)] + [(i, i - 1) for i in range(1, 200)]
    edges = spark.createDataFrame(chain, "u long, v long")
    assert {(r.u, r.root) for r in simhash.components(edges).collect()} == {(i, 0) for i in range(1, 200)}


def test_many_blocks_give_the_same_links(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(63) for _ in range(30)]
    fps = [b ^ (1 << rng.randrange(60)) ^ (1 << rng.randrange(60)) for b in base for _ in range(6)]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(fps)], "id long, fp long")
    comp = plain_components(fps)
    for block in (3, 1 << 15):
        roots = {r.u: r.root for r in simhash.components(simhash.find_links(df, block=block)).collect()}
        assert {f: roots.get(f, f) for f in fps} == comp


def test_extra_columns_with_maps(spark):
    docs = frame(spark).withColumn("more", F.create_map(F.lit("a"), F.col("n_chars"))).withColumn("a.b", F.lit(1))
    own = mph_dedup.digests(docs)
    plain = frame(spark)
    for with_map, without in (
            (mph_dedup.drop_repeats(docs, own, mph_dedup.build_index(own)),
             mph_dedup.drop_repeats(plain, own, mph_dedup.build_index(own))),
            (simhash.keep_representatives(docs), simhash.keep_representatives(plain))):
        assert with_map.columns == docs.columns
        assert Counter(map(tuple, with_map.select(*plain.columns).collect())) == Counter(map(tuple, without.collect()))
