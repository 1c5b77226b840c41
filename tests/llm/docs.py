"""Small tables for the tests of the training-data operators."""
from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, keep int, row string"


def words(rng: random.Random, n: int, alphabet: str = "abcdefghij") -> list[str]:
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n)]


def near_copies(rng: random.Random, base: list[str], n: int) -> list[str]:
    out = []
    for _ in range(n):
        own = list(base)
        own[rng.randrange(len(own))] = "changed" + str(rng.randrange(9))
        out.append(" ".join(own))
    return out


def rows() -> list[tuple]:
    """Nulls in every column, empty, very long and repeated rows, copies, near
    copies, a hot source, and columns named like the operators' own."""
    rng = random.Random(5)
    texts = [" ".join(words(rng, rng.randint(1, 120))) for _ in range(40)]
    base = words(rng, 300)
    texts += near_copies(rng, base, 25) + [texts[0]] * 6 + [texts[1].upper(), texts[1]]
    texts += ["", None, " \t\n", "a", "Ä ä", "x" * 50_000, " ".join(words(rng, 30_000)), "lı i  z"]
    out = [(i, t, rng.choice(["en", "de", None]), rng.choice(["hot", "hot", "hot", "b", "c/x", None]), len(t or ""),
            "s", 0, "r") for i, t in enumerate(texts)]
    out += [out[3], out[3], (None, texts[2], None, None, None, None, None, None),
            (None, None, None, None, None, None, None, None), (None, "alone " * 30, "en", "b", 1, None, 1, None)]
    return out


def frame(spark, some=None, parts: int = 5):
    return spark.createDataFrame(rows() if some is None else some, DOCS).repartition(parts)
