"""Language identification by averaged hashed subword embeddings.

A text is its letters, lower-cased, with one blank for everything between;
its features are the character n-grams (1 to ORDERS) of the whole text,
hashed into BUCKETS.  The model averages an embedding per bucket and applies
a linear softmax; it is trained by stochastic gradient descent in numpy on
at most about PER_LANGUAGE labelled texts of each language, drawn by a hash
of their ids.  Prediction uses the product of both layers, one row of class
scores per bucket, so a text costs a bincount and a small product.

A part of the drawn texts is kept from training: on it a temperature is
fitted to the scores, and the rejection threshold is set to the score that
all but REJECT of its right predictions reach.

Cases: a null text or one without a letter is ``und`` with score 0 and is
rejected; without any labelled text all are ``und``; repeated rows are
predicted each; an empty table gives an empty table; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, WIDTH, ORDERS = 1 << 12, 16, 3
#: Bound on the labelled texts of a language used for training and calibration.
PER_LANGUAGE = 1500
#: Bound on those of all languages together: with more than 40 languages each gives fewer.
MOST_ROWS = 60_000
CALIBRATION, REJECT, EPOCHS, RATE, BATCH, SEED = 0.2, 0.01, 40, 20.0, 32, 7
#: Code points turned into features at a time.
CHUNK = 1 << 20

_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    """Letter or not, by code point; made once in each Python process."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def features(text: str) -> np.ndarray | None:
    """Counts of the hashed n-grams of a whole text; None without a letter."""
    counts, letters = np.zeros(BUCKETS, np.int64), _is_letter()
    text = text.lower()
    carry, known, found = np.full(1, 32, np.uint32), 0, False  # known: code points of the carry counted before
    for at in range(0, len(text), CHUNK):
        code = np.frombuffer(text[at:at + CHUNK].encode("utf-32-le", "surrogatepass"), np.uint32)
        mask = letters[code]
        found = found or bool(mask.any())
        code = np.concatenate((carry, np.where(mask, code, np.uint32(32))))
        keep = np.ones(len(code), bool)
        keep[1:] = (code[1:] != 32) | (code[:-1] != 32)
        code = code[keep]
        grams = np.zeros(len(code), np.uint32)
        for n in range(ORDERS):
            own = code[n:] if n else code
            grams = (grams[:len(own)] * np.uint32(0x01000193)) ^ (own * np.uint32(0x9E3779B1) + np.uint32(n))
            new = grams[max(0, known - n):]  # those that end behind the carry
            counts += np.bincount((new ^ (new >> np.uint32(15))) & np.uint32(BUCKETS - 1), minlength=BUCKETS)
        carry = code[-ORDERS:]
        known = len(carry)
    return counts if found else None


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Model:
    """``scores``: class scores by bucket, ``bias`` by class."""

    def __init__(self, languages: list[str], scores: np.ndarray, bias: np.ndarray, temperature: float = 1.0,
                 threshold: float = 0.0):
        self.languages, self.scores, self.bias = languages, scores, bias
        self.temperature, self.threshold = temperature, threshold

    def raw(self, x: np.ndarray) -> np.ndarray:
        return x @ self.scores + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score and whether the prediction is accepted."""
        counts = features(text) if text and self.languages else None
        if counts is None:
            return "und", 0.0, False
        p = _softmax(self.raw(counts[None, :] / counts.sum()) / self.temperature)[0]
        best = int(p.argmax())
        return self.languages[best], float(p[best]), bool(p[best] >= self.threshold)


def train(x: np.ndarray, labels: list[str]) -> Model:
    """SGD over (n, BUCKETS) averaged counts; then calibration on a part of them."""
    languages = sorted(set(labels))
    y = np.array([languages.index(v) for v in labels], np.int64)
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(y))
    cut = int(len(y) * CALIBRATION) if len(y) >= 20 else 0
    held, own = order[:cut], order[cut:]
    embed = rng.normal(0, 1 / WIDTH, (BUCKETS, WIDTH))
    out, bias = np.zeros((WIDTH, len(languages))), np.zeros(len(languages))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        rng.shuffle(own)
        for at in range(0, len(own), BATCH):
            some = own[at:at + BATCH]
            h = x[some] @ embed
            g = _softmax(h @ out + bias)
            g[np.arange(len(some)), y[some]] -= 1
            g /= len(some)
            down = x[some].T @ (g @ out.T)
            out -= rate * (h.T @ g)
            bias -= 0.05 * rate * g.sum(axis=0)
            embed -= rate * down
    model = Model(languages, (embed @ out).astype(np.float32), bias)
    if len(held):
        raw = model.raw(x[held])
        grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
        loss = [-np.log(np.maximum(_softmax(raw / t)[np.arange(len(held)), y[held]], 1e-12)).mean() for t in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
        p = _softmax(raw / model.temperature)
        right = p.max(axis=1)[p.argmax(axis=1) == y[held]]
        model.threshold = float(np.quantile(right, REJECT)) if len(right) else 0.0
    return model


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE) -> Model:
    """A model from labelled rows: a share of each language by a hash of the id.

    The shares come from counts over all rows.  Features are made in the
    tasks; the driver gets at most about ``per_language`` sparse rows of each
    language.
    """
    known = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
    counts = {r["_lang"]: r["count"] for r in known.groupBy("_lang").count().collect()}
    if not counts:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    per_language = min(per_language, MOST_ROWS // len(counts) + 1)
    share = F.create_map(*[F.lit(x) for v, n in sorted(counts.items()) for x in (v, min(1.0, per_language / n))])
    unit = F.pmod(F.xxhash64(F.lit("train"), F.col("id")), F.lit(1_000_003)) / 1_000_003
    drawn = known.where(unit < F.element_at(share, F.col("_lang")))

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for doc, text, lang in zip(b["id"], b["_text"], b["_lang"]):
                own = features(text) if text else None
                if own is not None:
                    at = np.flatnonzero(own)
                    rows.append((doc, lang, at.astype(np.int32).tobytes(), own[at].astype(np.int32).tobytes()))
            yield pd.DataFrame(rows, columns=["id", "lang", "at", "n"], dtype=object)

    rows = drawn.mapInPandas(sparse, "id string, lang string, at binary, n binary").toPandas()
    rows = rows.sort_values(["lang", "id", "at", "n"], na_position="first")  # the same order in every run
    x = np.zeros((len(rows), BUCKETS), np.float32)
    for i, (at, n) in enumerate(zip(rows["at"], rows["n"])):
        x[i, np.frombuffer(at, np.int32)] = np.frombuffer(n, np.int32)
    if not len(rows):
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    return train(x / x.sum(axis=1, keepdims=True), rows["lang"].tolist())


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from."""
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


def predict_languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, accepted) for every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = pd.DataFrame([model.predict(t) for t in b["_text"]], columns=["lang_pred", "score", "accepted"])
            out.insert(0, id_col, b[id_col].astype("Int64").to_numpy())
            yield out

    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("_text")).mapInPandas(
        run, f"`{id_col}` long, lang_pred string, score double, accepted boolean")
