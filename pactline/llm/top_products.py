"""Exact top-k inner products over norm-sorted, SVD-rotated vectors.

Vectors become integers floor(256 * x) and are cut into blocks of descending
length, by their positions in that order, whatever the partitions.  Queries (a
stated set; equal ones are searched once) are cut into blocks in the same way.
A first round over the longest candidates gives every query a threshold, a score
that it is known to reach k times.  By Cauchy-Schwarz a block of candidates can
hold a better one for a block of queries only if its largest length is at least
the least ratio of threshold and length among these queries; only such pairs of
blocks are exchanged and compared.

Inside a pair of blocks the candidates are read by descending length in
tiles: a query is through as soon as the product of the lengths falls below
its k-th best score; before that, products over the first coordinates of an
SVD rotation plus the Cauchy-Schwarz bound of the residuals decide which
candidates are scored exactly, in integers.

The bounds are in floating point and get a margin; a candidate whose bound
equals the threshold is scored, as ties go to the smaller id.  The rotation
is fitted on a bounded sample (SAMPLE rows by hash) and cannot change results.
Of equal vectors only the k + 1 smallest ids can be among a query's k best,
so a very common vector is reduced before blocks are made.  A query is searched
for k + 1 rows, and its own id is taken out of these.

Cases: null vectors and those with null or non-finite components take no
part; vectors of different lengths count as filled up with zeros; rows equal
in id and vector count once, a query's own id is never its candidate; an empty
table gives an empty table; scores outside 64 bits wrap; extra columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pactline.llm.common import block_count, keep_table

SCALE, TOP, STRIDE = 256, 5, 50
#: Rows in a block of candidates, in a block of queries and in a tile.
BLOCK, QUERY_BLOCK, TILE = 1 << 14, 1 << 11, 1 << 9
#: Rotated coordinates whose products are summed before the bound is tested.
HEAD = 16
SAMPLE = 4096
#: Partitions for pairs of blocks; beyond it a task compares several pairs.
MAX_TASKS = 10_000


def integer_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): v holds floor(SCALE * x) of rows that can take part."""
    x = F.transform(F.col(vector_col), lambda e: e.cast("double"))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where(
        "vec_id is not null and x is not null")
    odd = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return rows.where(~F.coalesce(odd, F.lit(False))).select(
        "vec_id", F.transform("x", lambda e: F.floor(e * SCALE).cast("long")).alias("v")).distinct()


def _matrix(blob: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(blob, np.int64).reshape(-1, max(dims, 1))


def _stack(vectors: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), max(dims, 1)), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def fit_rotation(vectors: np.ndarray) -> np.ndarray:
    """Orthonormal columns by descending spread, from the SVD of a sample."""
    if not len(vectors):
        return np.eye(vectors.shape[1])
    return np.linalg.svd(vectors.astype(np.float64), full_matrices=False)[2].T if len(vectors) >= vectors.shape[1] \
        else np.eye(vectors.shape[1])


class Best:
    """The k best (score, id) of each of n queries, with ties to smaller ids."""

    def __init__(self, n: int, k: int, floors: np.ndarray):
        self.k, self.n, self.floors = k, n, floors
        self.query = np.zeros(0, np.int64)
        self.score, self.ids = self.query.copy(), self.query.copy()

    def add(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        q, s, i = (np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.ids, ids)))
        order = np.lexsort((i, -s, q))
        q, s, i = q[order], s[order], i[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        kept = rank < self.k
        self.query, self.score, self.ids = q[kept], s[kept], i[kept]
        last = rank == self.k - 1
        np.maximum.at(self.floors, q[last], s[last])


def search(queries: np.ndarray, own: np.ndarray | None, floors: np.ndarray, vectors: np.ndarray, ids: np.ndarray,
           rotation: np.ndarray, k: int = TOP, tile: int = TILE, head: int = HEAD) -> Best:
    """The best of one block of candidates for one block of queries.

    ``floors``: a score that each query is known to reach k times (or a very
    small number); candidates below it are not returned.  ``own``: an id that
    is no candidate, for each query.
    """
    best = Best(len(queries), k, floors.copy())
    q, v = queries.astype(np.float64) @ rotation, vectors.astype(np.float64) @ rotation
    q_size, v_size = np.linalg.norm(q, axis=1), np.linalg.norm(v, axis=1)
    order = np.argsort(-v_size, kind="stable")
    q_rest, v_rest = np.linalg.norm(q[:, head:], axis=1), np.linalg.norm(v[:, head:], axis=1)
    for at in range(0, len(order), tile):
        some = order[at:at + tile]
        margin = 1 + 1e-9 * q_size * v_size[some[0]]
        live = np.flatnonzero(q_size * v_size[some[0]] + margin >= best.floors)
        if not len(live):
            break
        bound = q[live, :head] @ v[some, :head].T + np.outer(q_rest[live], v_rest[some])
        a, b = np.nonzero(bound + margin[live, None] >= best.floors[live, None])
        a, b = live[a], some[b]
        if own is not None:
            other = own[a] != ids[b]
            a, b = a[other], b[other]
        for cut in range(0, len(a), 1 << 16):
            x, y = a[cut:cut + (1 << 16)], b[cut:cut + (1 << 16)]
            score = np.einsum("ij,ij->i", queries[x], vectors[y])
            near = score >= best.floors[x]
            best.add(x[near], score[near], ids[y[near]])
    return best


def _blocks(rows: DataFrame, id_col: str, dims: int, per_block: int, parts: int) -> DataFrame:
    """Written blocks (no, ids, vectors, top): ``no`` counts them by descending
    length, ``top`` is a block's largest length.

    Blocks come from positions in the order: the sorted partitions are written
    with each row's place, their sizes (one number a partition) give offsets.
    """
    squares = F.aggregate("v", F.lit(0.0), lambda a, e: a + e.cast("double") * e.cast("double"))
    order = [F.desc("length"), F.col(id_col)]
    placed = keep_table(rows.select(F.col(id_col), "v").withColumn("length", F.sqrt(squares)).repartitionByRange(
        parts, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "placed-vectors")
    sizes = sorted(placed.groupBy(F.shiftright("_at", 33).alias("part")).count().collect())
    starts, n = [], 0
    for part, size in sizes:
        starts.append((part, n))
        n += size
    offsets = placed.sparkSession.createDataFrame(starts, "_part long, _first long")
    no = F.floor((F.col("_first") + F.col("_at").bitwiseAND((1 << 33) - 1)) / per_block).cast("long")
    numbered = placed.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(offsets), "_part").select(
        no.alias("no"), F.col(id_col).alias("id"), "v", "length")

    def pack(key: tuple, t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values(["length", "id"], ascending=[False, True])
        return pd.DataFrame({"no": [key[0]], "ids": [t["id"].to_numpy(np.int64).tobytes()],
                             "vectors": [_stack(t["v"], dims).tobytes()], "top": [t["length"].iloc[0]]})

    return keep_table(numbered.groupBy("no").applyInPandas(pack, "no long, ids binary, vectors binary, top double"),
                      "vector-blocks")


def _meet(pairs: DataFrame, cand: DataFrame, asked: DataFrame, n_pairs: int, run, schema: str) -> DataFrame:
    """``run`` on the given pairs (c, q) of a block of candidates and a block of queries."""
    none = F.lit(None).cast("binary")
    cells = pairs.join(cand.select(F.col("no").alias("c"), "ids", "vectors", none.alias("floors")), "c").select(
        "c", "q", "ids", "vectors", "floors").unionByName(
        pairs.join(asked.select(F.col("no").alias("q"), "ids", "vectors", "floors"), "q").select(
            "c", "q", "ids", "vectors", "floors"))

    def pair(key: tuple, t: pd.DataFrame) -> pd.DataFrame:
        ours = t["floors"].notna()
        return run(key, t[ours].iloc[0], t[~ours].iloc[0])

    return cells.repartition(max(1, min(MAX_TASKS, n_pairs)), "c", "q").groupBy("c", "q").applyInPandas(pair, schema)


def block_pairs(tops: list[float], need: list[tuple[int, float]]) -> list[tuple[int, int]]:
    """(query block, number of candidate blocks that can hold a better one);
    ``tops`` descend, so these are the first ones."""
    fall = -np.array(tops)
    return [(q, int(np.searchsorted(fall, -(x - 1e-6 * abs(x) - 1e-6), "right"))) for q, x in need]


def top_products(df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 k: int = TOP, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``df`` per query row.

    ``queries`` has the columns of ``df``.
    """
    spark = df.sparkSession
    own = keep_table(integer_vectors(df, id_col, vector_col), "integer-vectors")
    asked = keep_table(integer_vectors(queries, id_col, vector_col), "queries")
    out = "query_id long, rank int, vec_id long, score long"
    dims, n = own.unionByName(asked).agg(F.coalesce(F.max(F.size("v")), F.lit(0)), F.count("*")).first()
    n_asked = asked.count()
    if not n or not n_asked:
        return spark.createDataFrame([], out)
    sample = own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()
    rotation = fit_rotation(_stack(sample["v"], dims))
    # of equal vectors the k + 1 smallest ids: a query may be one of them
    least = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    cand = _blocks(own.withColumn("_n", least).where(f"_n <= {k + 1}"), "vec_id", dims, block, block_count(n, block))
    # equal queries are one, under the least of their ids; two vectors may share it
    alike = keep_table(asked.groupBy("v").agg(F.min("vec_id").alias("least")).withColumn(
        "number", F.monotonically_increasing_id()), "distinct-queries")
    ask = _blocks(alike, "number", dims, query_block, block_count(n_asked, query_block))
    tops = [r["top"] for r in cand.select("no", "top").orderBy("no").collect()]  # one number a block
    unset = np.full(query_block, -(1 << 62), np.int64).tobytes()
    ask = ask.withColumn("floors", F.lit(unset))

    def best_of(ask: pd.Series, cand: pd.Series) -> tuple[np.ndarray, Best, np.ndarray]:
        qs, numbers = _matrix(ask["vectors"], dims), np.frombuffer(ask["ids"], np.int64)
        floors = np.frombuffer(ask["floors"], np.int64)[:len(numbers)]
        return numbers, search(qs, None, floors, _matrix(cand["vectors"], dims),
                               np.frombuffer(cand["ids"], np.int64), rotation, k + 1), qs

    def floors_of(key: tuple, ask: pd.Series, cand: pd.Series) -> pd.DataFrame:
        _, best, qs = best_of(ask, cand)
        size = np.sqrt((qs.astype(np.float64) ** 2).sum(1))
        need = np.where(size > 0, best.floors / np.maximum(size, 1e-300), np.where(best.floors > 0, np.inf, -np.inf))
        return pd.DataFrame({"no": [key[1]], "floors": [best.floors.tobytes()], "need": [float(need.min())]})

    def hits_of(key: tuple, ask: pd.Series, cand: pd.Series) -> pd.DataFrame:
        numbers, best, _ = best_of(ask, cand)
        return pd.DataFrame({"number": numbers[best.query], "vec_id": best.ids, "score": best.score})

    def with_blocks(counts: list[tuple[int, int]]) -> DataFrame:
        return spark.createDataFrame([(q, m) for q, m in counts if m], "q long, m long").select(
            "q", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("c"))

    numbers = [r["no"] for r in ask.select("no").collect()]
    floors = _meet(with_blocks([(q, 1) for q in numbers]), cand, ask, len(numbers), floors_of,
                   "no long, floors binary, need double")
    ask = keep_table(ask.drop("floors").join(floors, "no"), "query-blocks")
    counts = block_pairs(tops, [(r["no"], r["need"]) for r in ask.select("no", "need").collect()])
    hits = _meet(with_blocks(counts), cand, ask, sum(m for _, m in counts), hits_of, "number long, vec_id long, score long")
    first = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), "vec_id"))
    best = hits.withColumn("_n", first).where(f"_n <= {k + 1}")
    found = asked.join(alike, "v").select(F.col("vec_id").alias("query_id"), "number").join(best, "number").where(
        "query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "number").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
