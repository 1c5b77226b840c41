"""List operators against a plain-Python reading of the marker rules,
with tiny chunks so the previous item often sits in an earlier chunk."""

import random
import re

import model
from pactline.operators import lists

NUM, LET, PAR, BUL = r"^(\d+)\.?\)?", r"^(\w+)\.?\)", r"^\((\w+)\)", r"^(•|-|\*)"


def _cls(m):
    for t, p in enumerate((NUM, LET, PAR, BUL)):
        x = re.match(p, m)
        if x:
            return t, x.group(1)
    return None, ""


def _grows(a, b):
    (ta, ca), (tb, cb) = a, b
    if ta != tb:
        return False
    if ta == 0:
        return int(cb) - int(ca) == 1
    if ta in (1, 2):
        return ca < cb
    return ca == cb


def _expected(docs):
    rel, runs = {}, set()
    for d, ls in docs.items():
        try:
            flags, norm, _ = model.tag(ls)
        except model.Failed:
            continue
        items = [(i, model.LIST.match(x).group(1)) for i, ((b, t), x) in enumerate(zip(flags, norm)) if t == "l"]
        prev, run = None, []
        for i, m in items:
            c = _cls(m)
            g = prev is not None and _grows(prev[1], c)
            rel[(d, i)] = (prev[0] if prev else None, g)
            if not g:
                if len(run) >= 2:
                    runs.add((d, run[0], run[-1], len(run)))
                run = []
            run.append(i)
            prev = (i, c)
        if len(run) >= 2:
            runs.add((d, run[0], run[-1], len(run)))
    return rel, runs


POOL = ["1. one", "2. two", "3) three", "a) x", "b) y", "(i) r", "(ii) s", "- dash", "- dash", "* st",
        "Section 2", "Plain text here.", "", "B. item", "7.", "10. ten", "11. eleven", "(a) p", "(b) q"]


def test_list_relations_and_runs_across_chunks(spark):
    rng = random.Random(7)
    docs = {d: ["Agreement"] + [rng.choice(POOL) for _ in range(rng.randint(1, 16))] for d in range(200)}
    rows = [(d, p, x) for d, ls in docs.items() for p, x in enumerate(ls)]
    df = spark.createDataFrame(rows, "doc_id long, pos int, line string")
    rel, runs = _expected(docs)
    for chunk in (3, 4096):
        got = {(r.doc_id, r.i): (r.prev_i, r.grows)
               for r in lists.list_relations(df, chunk_lines=chunk).collect()}
        assert got == rel
        got_runs = {(r.doc_id, r.first_i, r.last_i, r.n_items)
                    for r in lists.list_runs(df, chunk_lines=chunk).collect()}
        assert got_runs == runs
