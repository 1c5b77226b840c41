"""Quality by hierarchical empirical Bayes: text, site and section.

1. A logistic model of simple shares of the text (symbols, capitals, repeated
   and distinct words, table bars, ...) is fitted on at most LABELLED labelled
   rows, those with the smallest hash of their id.  Its log odds without the
   training prior are a document's own evidence.
2. Over all documents, the model's probabilities are summed by (host, path)
   and by host in one grouped aggregation.
3. A host's rate has a Beta prior around the global rate, a path's rate one
   around its host's rate.  The strengths of both priors are estimated from
   the spread of the observed rates beyond what counting noise explains, so
   sparse sites shrink towards the global rate and sparse paths to their host.
4. A document's posterior log odds are its own evidence plus the log odds of
   its path's rate, which is computed without the document itself.

Everything but the fit is Spark SQL.  The sums have one row per path; they
are written, and Spark broadcasts them only if the table is small, else it
splits skewed hosts in the join.

Cases: a null text counts as empty; a text without words has no evidence of
its own, so its path decides; null hosts and paths are groups of their own;
labels of a document that contradict each other are averaged; without labels
of both classes every document is kept; repeated rows are judged each; an
empty table gives an empty table; other columns are carried in ``row``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pactline.llm.common import WORD, ascii_lower, keep_table

#: Bound on the labelled rows that the model is fitted on.
LABELLED = 20_000
RIDGE, STEPS, KEEP = 1.0, 30, 0.5
#: A path's own evidence may move the log odds by this much.
MOST_SITE = 2.0
STRENGTH = (1.0, 1e6)


def text_features(text: Column) -> dict[str, Column]:
    """Columns over the whole text, each between 0 and about 1."""
    body = F.coalesce(text, F.lit(""))
    n, words = F.greatest(F.length(body), F.lit(1)), F.regexp_extract_all(ascii_lower(body), F.lit(WORD), F.lit(0))
    count = F.greatest(F.size(words), F.lit(1))

    def share(pattern: str) -> Column:
        return F.regexp_count(body, F.lit(pattern)) / n

    return {
        "symbols": share(r"[#$%&*=+~^|<>\\{}\[\]@_]"),
        "capitals": share(r"\p{Lu}"),
        "loud": share(r"[!?]"),
        "digits": share(r"[0-9]"),
        "marks": share(r"[.,;:]"),
        "lines": share(r"\n"),
        "distinct": F.size(F.array_distinct(words)) / count,
        "repeats": F.regexp_count(body, F.lit(r"(?<=\s|^)(\S{1,64}) \1(?=\s|$)")) / count,
        "bars": F.regexp_count(body, F.lit(r"[^\w\s](?=\s|$)")) / count,
        "length": F.log1p(F.size(words)) / 10,
    }


FEATURES = ("symbols", "capitals", "loud", "digits", "marks", "lines", "distinct", "repeats", "bars", "length")


def _expand(x: np.ndarray) -> np.ndarray:
    """Features, their roots and an intercept."""
    return np.concatenate((x, np.sqrt(x), np.ones((len(x), 1))), axis=1)


class Evidence:
    """Log odds of good over bad text: weights of features and their roots."""

    def __init__(self, weights: np.ndarray, prior: float):
        self.weights, self.prior = weights, prior

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> "Evidence | None":
        """Ridge logistic regression by Newton steps; y in 0..1."""
        if not len(y) or y.min() > 0.5 or y.max() < 0.5:
            return None
        a = _expand(x)
        scale = np.maximum(a.std(axis=0), 1e-6)
        scale[-1] = 1
        a = a / scale
        w, penalty = np.zeros(a.shape[1]), np.full(a.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(STEPS):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty)
            step = np.linalg.solve(h, a.T @ (y - p) - penalty * w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        mean = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
        return cls(w / scale, float(np.log(mean / (1 - mean))))

    def log_odds(self, prefix: str = "_f_") -> Column:
        """The model's log odds as a column, with the training prior."""
        k, out = len(FEATURES), F.lit(float(self.weights[-1]))
        for i, f in enumerate(FEATURES):
            x = F.col(prefix + f)
            out = out + x * float(self.weights[i]) + F.sqrt(x) * float(self.weights[k + i])
        return F.greatest(F.least(out, F.lit(20.0)), F.lit(-20.0))


def _with_features(rows: DataFrame) -> DataFrame:
    return rows.withColumns({f"_f_{k}": v for k, v in text_features(F.col("_text")).items()}).drop("_text")


def fit_evidence(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality", most: int = LABELLED) -> Evidence | None:
    """Fits on the labelled documents with the smallest hash of their id."""
    marks = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("_id")).agg(F.avg(label_col).alias("_y"))
    marks = keep_table(marks.orderBy(F.xxhash64("_id"), "_id").limit(most), "labelled")
    known = docs.withColumn("_id", F.col(id_col).cast("long")).select("_id", F.col(text_col).alias("_text")).join(
        marks, "_id")
    rows = _with_features(known).select("_id", "_y", *[f"_f_{f}" for f in FEATURES]).orderBy("_id").limit(
        2 * most).toPandas()
    return Evidence.fit(rows[[f"_f_{f}" for f in FEATURES]].to_numpy(np.float64), rows["_y"].to_numpy(np.float64))


def _strength(between: float, rate: float) -> float:
    """Beta prior strength whose variance at ``rate`` is ``between``."""
    return float(np.clip(rate * (1 - rate) / max(between, 1e-12) - 1, *STRENGTH))


def site_rates(scored: DataFrame) -> tuple[DataFrame, float, float, float]:
    """Sums by (_host, _path) and by host, the global rate, both strengths."""
    paths = scored.groupBy("_host", "_path").agg(
        F.count("*").alias("_n"), F.sum("_p").alias("_k"), F.sum(F.col("_p") * (1 - F.col("_p"))).alias("_v"))
    paths = keep_table(paths, "path-sums")
    hosts = keep_table(paths.groupBy("_host").agg(F.sum("_n").alias("_hn"), F.sum("_k").alias("_hk"),
                                                  F.sum("_v").alias("_hv")), "host-sums")
    sums = paths.join(hosts, "_host")
    n, k = hosts.agg(F.sum("_hn"), F.sum("_hk")).first()
    rate = float(np.clip(k / n, 1e-4, 1 - 1e-4)) if n else 0.5
    # spread of rates beyond the noise of single documents
    spread = hosts.agg(F.sum(F.col("_hn") * F.pow(F.col("_hk") / F.col("_hn") - rate, 2)),
                       F.sum(F.col("_hk") / F.col("_hn") * (1 - F.col("_hk") / F.col("_hn")))).first()
    inner = sums.agg(F.sum(F.col("_n") * F.pow(F.col("_k") / F.col("_n") - F.col("_hk") / F.col("_hn"), 2)),
                     F.sum(F.col("_k") / F.col("_n") * (1 - F.col("_k") / F.col("_n")))).first()
    between = [max((a or 0.0) - (b or 0.0), 0.0) / max(n or 0, 1) for a, b in (spread, inner)]
    return sums.drop("_v", "_hv"), rate, _strength(between[0], rate), _strength(between[1], rate)


def judge_quality(docs: DataFrame, evidence: Evidence | None, host: Column, path: Column, id_col: str = "doc_id",
                  text_col: str = "text", keep: float = KEEP, rows: bool = True) -> DataFrame:
    """(id, host, path, own_log_odds, host_rate, path_rate, quality, keep, row).

    ``quality``: posterior probability of good text; ``row``: the columns of
    the document.  The texts' evidence is written once, with ``row`` if asked
    for, and both the sums and the join read it; no text is scored twice.
    """
    scored = docs.select(F.col(id_col).alias("id"), host.cast("string").alias("host"),
                         path.cast("string").alias("path"), F.struct("*").alias("row"),
                         F.col(text_col).alias("_text"))
    none = F.lit("~")  # groups of null hosts and paths
    scored = scored.withColumns({"_host": F.coalesce(F.concat(F.lit("="), "host"), none),
                                 "_path": F.coalesce(F.concat(F.lit("="), "path"), none)})
    prior, own = 0.0, F.lit(0.0)
    if evidence is not None:
        scored = _with_features(scored)
        prior = evidence.prior
        own = F.when(F.col("_f_length") > 0, evidence.log_odds() - prior).otherwise(F.lit(0.0))
    scored = scored.withColumn("own_log_odds", own).withColumn("_p", 1 / (1 + F.exp(-(F.col("own_log_odds") + prior))))
    shown = ["row"] if rows else []
    scored = scored.select("id", "host", "path", "_host", "_path", "own_log_odds", "_p", *shown)
    scored = keep_table(scored, "evidence")
    sums, rate, host_strength, path_strength = site_rates(scored)
    # rates without the document itself
    host_rate = (F.col("_hk") - F.col("_p") + host_strength * rate) / (F.col("_hn") - 1 + host_strength)
    path_rate = (F.col("_k") - F.col("_p") + path_strength * F.col("host_rate")) / (F.col("_n") - 1 + path_strength)
    out = scored.join(sums, ["_host", "_path"]).withColumn("host_rate", host_rate).withColumn("path_rate", path_rate)
    site = F.log(F.greatest("path_rate", F.lit(1e-6)) / F.greatest(1 - F.col("path_rate"), F.lit(1e-6)))
    level = float(np.log(rate / (1 - rate)))
    site = F.greatest(F.least(site - level, F.lit(MOST_SITE)), F.lit(-MOST_SITE)) + level
    out = out.withColumn("quality", 1 / (1 + F.exp(-(F.col("own_log_odds") + site))))
    kept = F.lit(True) if evidence is None else F.col("quality") >= keep
    return out.select(F.col("id").alias(id_col), "host", "path", "own_log_odds", "host_rate", "path_rate", "quality",
                      kept.alias("keep"), *shown)


def keep_good(docs: DataFrame, evidence: Evidence | None, host: Column, path: Column, **kinds: object) -> DataFrame:
    """The documents that are judged good, with all their columns."""
    return judge_quality(docs, evidence, host, path, **kinds).where("keep").select("row.*")
