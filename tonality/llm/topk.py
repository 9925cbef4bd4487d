"""Exact top-k inner-product search with two cover trees.

Queries and data are indexed together: both fall to the nearest of ``CENTERS`` hash-
sampled data vectors (the root's children), and each such node knows its covering
radius. Data nodes are stored as chunks of about ``CHUNK`` vectors, queries in
blocks of about ``BLOCK``. A sample gives each query a first kth score that its true
kth score cannot be below; a (query block, data chunk) pair is pruned where
<cq, cd> + |cq| rd + |cd| rq + rq rd is less than the block's worst kth score.
Inside each surviving pair a cover tree over the chunk (radius halved per level) is
descended with the queries' tree node, pruned by the same bound as kth scores
grow. Each pair yields k rows per query at most; the last step keeps the k best.

Scores are whole numbers: components become floor(SCALE * x). Vectors that are null or
hold a null, NaN or infinite component take no part; vectors of different lengths do
not meet; repeated rows are rows of their own (a query only leaves out rows with its own
vec_id); a null vec_id takes no part; an empty table gives no rows; ties go to the smaller vec_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonality.llm.common import written

SCALE = 1024
K = 10
CENTERS = 64
SAMPLE = 4096
CHUNK = 2048
BLOCK = 512
LEAF = 64
NEVER = float("-inf")


def prepared(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """(id, v, dim): whole-number vectors of the rows that take part."""
    bad = F.exists(F.col(vec_col), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return vectors.filter(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & ~bad).select(
        F.col(id_col).cast("long").alias("id"), whole.alias("v"), F.size(F.col(vec_col)).alias("dim"))


def products(q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Exact whole-number inner products (float64 holds them below 2**53)."""
    top = (np.abs(q).max(initial=0) * np.abs(d).max(initial=0)) * q.shape[1]
    if top < 2.0 ** 53:
        return q @ d.T
    return np.array(q.astype(object) @ d.astype(object).T, dtype=object)


class Node:
    """Points, their center, covering radius, and children (none in a leaf)."""

    def __init__(self, rows, center, radius, children):
        self.rows, self.center, self.radius, self.children = rows, center, radius, children


def cover_tree(points: np.ndarray, rows: np.ndarray | None = None, leaf: int = LEAF) -> Node:
    """Children are greedy covers of half the radius; a node that would split
    into more than a quarter of its points, as in high dimensions, is a leaf."""
    rows = np.arange(len(points)) if rows is None else rows
    center = points[rows[0]]
    away = np.sqrt(((points[rows] - center) ** 2).sum(axis=1))
    radius = float(away.max())
    if len(rows) <= leaf or radius == 0:
        return Node(rows, center, radius, [])
    left, groups = rows, []
    while len(left):
        near = ((points[left] - points[left[0]]) ** 2).sum(axis=1) <= (radius / 2) ** 2
        groups.append(left[near])
        left = left[~near]
        if len(groups) > max(4, len(rows) // 4) or len(groups) > 64:
            return Node(rows, center, radius, [])
    return Node(rows, center, radius, [cover_tree(points, g, leaf) for g in groups])


def bound(qc, qr, dc, dr) -> float:
    """No inner product across two balls exceeds this."""
    return float(qc @ dc + np.sqrt(qc @ qc) * dr + np.sqrt(dc @ dc) * qr + qr * dr) * (1 + 1e-12) + 1e-3


def dual_search(q_ids, q, kth, d_ids, d, k: int) -> list[tuple[int, int, int]]:
    """(query, row, score): each query's k best of one chunk, ties to the smaller row."""
    best = [[] for _ in q_ids]
    worst = np.array(kth, float)
    queries, data = cover_tree(q), cover_tree(d)

    def visit(a: Node, b: Node) -> None:
        if bound(a.center, a.radius, b.center, b.radius) < worst[a.rows].min():
            return
        if b.children and (not a.children or b.radius >= a.radius):
            for c in sorted(b.children, key=lambda c: -float(a.center @ c.center)):
                visit(a, c)
        elif a.children:
            for c in a.children:
                visit(c, b)
        else:
            score = products(q[a.rows], d[b.rows])
            ids = d_ids[b.rows]
            for i, s in zip(a.rows, score):
                take = np.flatnonzero((s >= worst[i]) & (ids != q_ids[i]))
                if not len(take):
                    continue
                best[i] = sorted(best[i] + [(-int(s[t]), int(ids[t])) for t in _k_best(s, ids, take, k)])[:k]
                if len(best[i]) == k:
                    worst[i] = max(worst[i], -best[i][-1][0])

    if len(q) and len(d):
        visit(queries, data)
    return [(int(q_ids[i]), r, -s) for i, found in enumerate(best) for s, r in found]


def _k_best(score, ids, take, k):
    return take if len(take) <= k else take[np.lexsort((ids[take], -score[take]))[:k]]


def _matrix(values) -> np.ndarray:
    return np.array(list(values), float).reshape(len(values), -1)


def _assign(centers: dict[int, np.ndarray]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, part in b.groupby("dim"):
                c, v = centers.get(dim), _matrix(part["v"])
                near = np.zeros(len(v), int) if c is None or not dim else (
                    (c ** 2).sum(axis=1)[None, :] - 2 * v @ c.T).argmin(axis=1)
                yield part.assign(node=near)[["id", "v", "dim", "node"]]
    return run


def _pack(group: pd.DataFrame) -> pd.DataFrame:
    v = _matrix(group["v"])
    center = v.mean(axis=0)
    radius = float(np.sqrt(((v - center) ** 2).sum(axis=1)).max()) * (1 + 1e-9)
    first = group.iloc[0]
    return pd.DataFrame({"dim": [int(first["dim"])], "node": [int(first["node"])], "part": [int(first["part"])],
                         "center": [center], "radius": [radius], "ids": [group["id"].to_numpy()],
                         "m": [v.tobytes()]})


PACKED = "dim int, node int, part int, center array<double>, radius double, ids array<long>, m binary"


def _packed(rows: DataFrame, size: int, name: str) -> DataFrame:
    """One row per (dim, node, part) of about ``size`` vectors."""
    counts = rows.groupBy("dim", "node").agg(F.ceil(F.count(F.lit(1)) / size).alias("parts"))
    # parts of a node come from a hash of the row's id and vector alone, so a task that runs again deals them alike
    salted = rows.join(counts, ["dim", "node"]).withColumn(
        "part", F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int"))
    return written(salted.groupBy("dim", "node", "part").applyInPandas(_pack, PACKED), name)


def top_k(data: DataFrame, queries: DataFrame, k: int = K, centers: int = CENTERS) -> DataFrame:
    """query_id, rank, vec_id, score. ``data`` and ``queries``: see ``prepared``."""
    spark = data.sparkSession
    data, queries = written(data, "vectors"), written(queries, "queries")
    total = data.count()
    share = min(1.0, SAMPLE / max(1, total))
    unit = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    picked = data.filter(unit < share).limit(2 * SAMPLE).toPandas()  # SAMPLE rows in expectation
    sample = {int(d): (p["id"].to_numpy(), _matrix(p["v"])) for d, p in picked.groupby("dim") if d}
    pivots = {d: np.unique(v, axis=0)[:: max(1, len(v) // centers)][:centers] for d, (_, v) in sample.items()}
    nodes = "id long, v array<double>, dim int, node int"
    chunks = _packed(data.mapInPandas(_assign(pivots), nodes), CHUNK, "chunks")
    shared = spark.sparkContext.broadcast(sample)

    def first_kth(group: pd.DataFrame) -> pd.DataFrame:
        out = _pack(group)
        ids, v = shared.value.get(int(out["dim"][0]), (np.zeros(0, np.int64), None))
        q_ids, kth = out["ids"][0], np.full(len(out["ids"][0]), NEVER)
        if len(ids) > k:
            score = products(_matrix(group["v"]), v).astype(float)
            score[q_ids[:, None] == ids[None, :]] = NEVER
            kth = np.partition(score, -k, axis=1)[:, -k]
        # A sample row that repeats counts as often as it occurs, as in the result.
        return out.assign(kth=[kth], worst=[float(kth.min())])

    found = queries.mapInPandas(_assign(pivots), nodes)
    size = max(1, queries.count() // BLOCK)
    blocks = found.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(size)).cast("int")).withColumn("node", F.lit(0))
    blocks = written(blocks.groupBy("dim", "node", "part").applyInPandas(
        first_kth, PACKED + ", kth array<double>, worst double"), "blocks")
    # Chunks meet blocks by their description alone; only surviving pairs get vectors.
    few = blocks.select("dim", F.col("part").alias("block"), F.col("center").alias("qc"),
                        F.col("radius").alias("qr"), "worst")
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    pairs = chunks.select("dim", "node", "part", "center", "radius",
                          F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("block")).join(few, ["dim", "block"])
    most = (dot("qc", "center") + F.sqrt(dot("qc", "qc")) * F.col("radius")
            + F.sqrt(dot("center", "center")) * F.col("qr") + F.col("qr") * F.col("radius"))
    pairs = pairs.filter(most * (1 + 1e-9) + 1 >= F.col("worst")).select("dim", "node", "part", "block")
    work = pairs.join(chunks.select("dim", "node", "part", "ids", "m"), ["dim", "node", "part"]).join(
        blocks.select("dim", F.col("part").alias("block"), F.col("ids").alias("q_ids"), F.col("m").alias("q"), "kth"),
        ["dim", "block"]).select("dim", "ids", "m", "q_ids", "q", "kth")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                shape = (-1, r.dim)
                rows = dual_search(np.asarray(r.q_ids), np.frombuffer(r.q).reshape(shape), r.kth,
                                   np.asarray(r.ids), np.frombuffer(r.m).reshape(shape), k)
                yield pd.DataFrame(rows, columns=["query_id", "vec_id", "score"])

    scored = work.mapInPandas(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
    FROM v q JOIN v d ON q.vec_id <> d.vec_id AND len(q.v) = len(d.v) WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (SELECT *, row_number() OVER (
    PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p) WHERE rank <= 10
"""
