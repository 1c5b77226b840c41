"""SimHash near-duplicate groups by tiled exact comparison.

A document's fingerprint has a bit set where over half of its word shingles'
XXH64 values (seed 42) have it set.  Distinct fingerprints go into blocks by
their number of set bits; blocks whose numbers differ by more than the radius
cannot hold a link and never meet.  Two blocks that can are compared in tiles
with numpy: fingerprints are sorted by the bit counts of their 16-bit
quarters, a tile knows the range of each count, and a pair of tiles is skipped
when its counts differ by more than the radius in total; for the others every
pair is tested by exclusive-or and bit count.  Nothing is hashed away, so every link
within the radius is found.

A pair of blocks returns a spanning forest of its links, one edge for each
fingerprint at most, so a group of n near copies costs n edges and not n * n.
Components are then found by alternating large-star and small-star rounds
over the edges, each written to the shared folder.

Cases: null and empty texts have fingerprint 0 and link like any other; a
text with fewer words than a shingle is one shingle; exact copies share a
fingerprint and are one node; rows with a null id get the component of their
fingerprint; repeated rows are returned each; one id may stand for several
texts, each in the component of its own; extra columns are carried by
``keep_representatives`` and ignored elsewhere; an empty table gives an empty
table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pactline.llm.common import block_count, in_row_order, keep_table

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Fingerprints in a block (one task compares two blocks) and in a tile.
BLOCK, TILE = 1 << 15, 1 << 8
#: Partitions for the comparison; beyond it a task compares several pairs of blocks.
MAX_TASKS = 10_000
#: Shingles counted at a time, so long texts take no more memory.
CHUNK = 1 << 14


def _bits_over_half(hashes: np.ndarray, ones: np.ndarray) -> None:
    ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """SimHash of a whole text; bytes.lower and bytes.split know ASCII only."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    flat = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(tokens) - words + 1)
    first, last = starts[:n].tolist(), ends[min(words, len(tokens)) - 1:].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        own = [digest(flat[a:b], SEED) for a, b in zip(first[at:at + CHUNK], last[at:at + CHUNK])]
        _bits_over_half(np.array(own, "<u8"), ones)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """(id, fp): the fingerprint as a signed long, for every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            own = np.array([fingerprint(t, words) for t in b["_text"]], np.uint64).view(np.int64)
            yield pd.DataFrame({"id": b["id"].astype("Int64"), "fp": own})

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("_text")).mapInPandas(
        run, "id long, fp long")


# ---- links -----------------------------------------------------------------------

def _quarters(fps: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fps.view(np.uint16).reshape(-1, 4)).astype(np.int16)


class _Tiles:
    """Fingerprints sorted by the bit counts of their quarters, cut into tiles."""

    def __init__(self, fps: np.ndarray, tile: int):
        q = _quarters(fps)
        order = np.lexsort((q[:, 3], q[:, 2], q[:, 1], q[:, 0]))
        self.fps, q = fps[order], q[order]
        self.cuts = list(range(0, len(fps), tile)) + [len(fps)]
        self.low = np.array([q[a:b].min(axis=0) for a, b in zip(self.cuts, self.cuts[1:])]).reshape(-1, 4)
        self.high = np.array([q[a:b].max(axis=0) for a, b in zip(self.cuts, self.cuts[1:])]).reshape(-1, 4)

    def near(self, low: np.ndarray, high: np.ndarray, radius: int) -> np.ndarray:
        """Tiles whose counts come within the radius of the given ranges."""
        gap = np.maximum(0, np.maximum(self.low - high, low - self.high)).sum(axis=1)
        return np.flatnonzero(gap <= radius)


class _Forest:
    """Union-find over positions that remembers the edges which joined sets."""

    def __init__(self, n: int):
        self.up, self.edges = list(range(n)), []

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def roots(self, start: int, stop: int) -> np.ndarray:
        return np.array([self.root(x) for x in range(start, stop)])

    def join(self, near: np.ndarray, row: int, col: int) -> None:
        """Add the links of a tile pair; near[x, y]: row + x is linked to col + y.

        Each pass joins a row with its first neighbour in another set, so a
        tile of near copies takes a pass or two and not one step a pair.
        """
        while True:
            apart = near & (self.roots(row, row + near.shape[0])[:, None]
                            != self.roots(col, col + near.shape[1])[None, :])
            rows = np.flatnonzero(apart.any(axis=1))
            if not len(rows):
                return
            for x, y in zip((rows + row).tolist(), (apart[rows].argmax(axis=1) + col).tolist()):
                p, q = self.root(x), self.root(y)
                if p != q:
                    self.up[max(p, q)] = min(p, q)
                    self.edges.append((x, y))


def links(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS, tile: int = TILE) -> np.ndarray:
    """Spanning forest (k, 2) of the links between two blocks, or in one."""
    a = _Tiles(left, tile)
    b = a if right is None else _Tiles(right, tile)
    shift = 0 if right is None else len(left)
    every = a.fps if right is None else np.concatenate((a.fps, b.fps))
    forest = _Forest(len(every))
    for i in range(len(a.cuts) - 1):
        rows = a.fps[a.cuts[i]:a.cuts[i + 1], None]
        for j in b.near(a.low[i], a.high[i], radius):
            if right is None and j < i:
                continue
            near = np.bitwise_count(rows ^ b.fps[None, b.cuts[j]:b.cuts[j + 1]]) <= radius
            if right is None and i == j:
                np.fill_diagonal(near, False)
            if near.any():
                forest.join(near, a.cuts[i], b.cuts[j] + shift)
    if not forest.edges:
        return np.zeros((0, 2), np.int64)
    return every[np.array(forest.edges)].view(np.int64)


def find_links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(u, v): edges that join every pair of distinct ``fp`` within the radius.

    The table of distinct fingerprints is cut into blocks (bits, part); each
    block is one packed row and is sent to the pairs of blocks it is in.
    """
    distinct = fps.select("fp").distinct().withColumn("bits", F.bit_count("fp"))
    sizes = {r["bits"]: r["count"] for r in distinct.groupBy("bits").count().collect()}  # 65 rows at most
    parts = {b: block_count(n, block) for b, n in sizes.items()}
    if not parts:
        return fps.sparkSession.createDataFrame([], "u long, v long")
    of_bits = F.element_at(F.create_map(*[F.lit(x) for kv in parts.items() for x in kv]), F.col("bits"))

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = np.sort(rows["fp"].to_numpy(np.int64))
        return pd.DataFrame({"bits": [key[0]], "part": [key[1]], "fps": [own.tobytes()]})

    packed = distinct.withColumn("part", F.pmod(F.xxhash64("fp"), of_bits).cast("int")).groupBy("bits", "part") \
        .applyInPandas(pack, "bits int, part int, fps binary")
    # every unordered pair of blocks that can hold a link; grows with the square of the blocks, not of the rows
    names = [(b, p) for b in sorted(parts) for p in range(parts[b])]
    place = {name: i for i, name in enumerate(names)}
    last = {b: place[(b, parts[b] - 1)] for b in parts}
    ends = [max(e for x, e in last.items() if x <= b + radius) for b, _ in names]
    starts = [min(place[(x, 0)] for x in parts if x >= b - radius) for b, _ in names]

    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            for b, p, own in zip(t["bits"], t["part"], t["fps"]):
                i = place[(b, p)]
                pairs = [(min(i, j), max(i, j)) for j in range(starts[i], ends[i] + 1)]
                for at in range(0, len(pairs), 64):
                    some = pairs[at:at + 64]
                    yield pd.DataFrame({"a": [x for x, _ in some], "b": [y for _, y in some],
                                        "me": i, "fps": [own] * len(some)})

    def compare(key: tuple, t: pd.DataFrame) -> pd.DataFrame:
        own = [np.frombuffer(x, np.uint64) for x in t.sort_values("me")["fps"]]
        found = links(own[0], own[1] if len(own) > 1 else None, radius)
        return pd.DataFrame({"u": found[:, 0], "v": found[:, 1]})

    tasks = min(MAX_TASKS, sum(ends) - sum(starts) + len(names))  # about one for each pair, whatever its bytes
    return packed.mapInPandas(cells, "a int, b int, me int, fps binary").repartition(tasks, "a", "b").groupBy(
        "a", "b").applyInPandas(compare, "u long, v long")


# ---- components -------------------------------------------------------------------

def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One round: hang neighbours on the least node that a node can see.

    The least neighbour is a map-side combined aggregate; nodes with many
    neighbours are split by the join, as one side has one row for each node.
    """
    if large:
        sides = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sides = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = sides.join(least, "u")
    moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else \
        moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root): the least node of its component for every node with an edge."""
    pairs = keep_table(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(
        "u != v").distinct(), "links")
    mark, before = None, ()
    while mark != before:
        before = mark
        pairs = keep_table(_star(_star(pairs, True), False), "links")
        mark = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    return pairs.select("u", F.col("v").alias("root"))


def _named(own: DataFrame, radius: int) -> DataFrame:
    """(fp, root, component_id) for every distinct fingerprint of (id, fp)."""
    roots = components(keep_table(find_links(own, radius), "edges")).withColumnRenamed("u", "fp")
    nodes = own.groupBy("fp").agg(F.min("id").alias("least")).join(roots, "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    return keep_table(nodes.join(least, "root").select("fp", "root", "component_id"), "fingerprint-components")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE,
                       radius: int = RADIUS) -> DataFrame:
    """(id, fp, component_id): component_id is the least id reachable by links."""
    own = keep_table(fingerprints(docs, id_col, text_col, words), "fingerprints")
    return own.join(_named(own, radius), "fp").select("id", "fp", "component_id")


def hex16(fp: str = "fp") -> Column:
    """16 lower-case hexadecimal digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE,
                         radius: int = RADIUS) -> DataFrame:
    """One document of each component, with all its columns: the least id.

    Where an id stands for several fingerprints, its rows are told apart by
    them, so each component gets a row of its own.  Rows that share the least
    id, and a component without any id, give their first row by the columns
    (columns with maps are not looked at).
    """
    own = keep_table(fingerprints(docs, id_col, text_col, words), "fingerprints")
    named = _named(own, radius)
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"),
                       F.struct("*").alias("row"))

    def first(found: DataFrame, key: str) -> DataFrame:
        n = F.row_number().over(Window.partitionBy(key).orderBy(*in_row_order(docs)))
        return found.withColumn("_n", n).where("_n = 1").select("row.*")

    # (_id, fp, root, many): the least id of each component with its fingerprints there; many: it has others too
    of_id = own.where("id is not null").groupBy("id").agg((F.min("fp") != F.max("fp")).alias("many"))
    least = keep_table(own.distinct().join(named.withColumnRenamed("component_id", "id"), ["id", "fp"]).join(
        of_id, "id").withColumnRenamed("id", "_id"), "least-ids")
    with_id = rows.where("_id is not null")
    alike = with_id.drop("_text").join(least.where("not many").select("_id"), "_id", "left_semi")
    # rows whose id does not name one text, or without an id, are found again by their fingerprint
    of_text = F.pandas_udf(lambda texts: pd.Series(
        np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64)), "long")
    shared = with_id.join(least.where("many").select("_id").distinct(), "_id", "left_semi").withColumn(
        "fp", of_text("_text")).join(least.where("many").select("_id", "fp", "root"), ["_id", "fp"])
    without = rows.where("_id is null").withColumn("fp", of_text("_text"))
    alone = without.join(named.where("component_id is null").select("fp", "root"), "fp")
    return first(alike, "_id").unionByName(first(shared, "root")).unionByName(first(alone, "root"))
