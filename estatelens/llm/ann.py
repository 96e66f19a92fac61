"""Approximate nearest neighbours by inner product over robust-pruned directed graphs.

Equal vectors are one class with its smallest ids, so that copies cost nothing and ties are exact. Classes are hashed
into shards of about ``SHARD_ROWS``; the number of shards grows with the data, a shard never does. Per shard one task
builds a graph over vectors that are lengthened by one coordinate to equal norms, which turns the largest inner product
into the smallest distance: batches of points search the graph built so far, and from what they met robust pruning keeps
a neighbour only if no kept one is ``ALPHA`` times nearer to it than the point is. Reverse edges are pruned likewise.
Queries visit every shard in blocks of ``QUERY_BLOCK``; a beam search of each graph proposes candidates, which are
scored again in double precision on the original vectors, and the best per query are merged.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components take no part; vectors of other
lengths than the query's are no candidates; repeated ids are one row's id; fewer candidates than ``k`` are all returned;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, staged

ship(__name__)

SHARD_ROWS = 8192
QUERY_BLOCK = 8192
DEGREE = 32
BEAM = 64
ALPHA = 1.2
BATCH = 512


def beam_search(points: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(beam ids by falling inner product, expanded ids) per query; -1 where there is none. ``graph`` rows hold
    neighbours, -1 for none."""
    n, count = len(points), len(queries)
    rows = np.arange(count)
    seen = np.zeros((count, n + 1), bool)
    seen[:, n] = True  # what -1 points at
    ids = np.full((count, beam), n)
    near = np.full((count, beam), -np.inf, points.dtype)
    done = np.ones((count, beam), bool)
    ids[:, 0], near[:, 0], done[:, 0], seen[:, start] = start, queries @ points[start], False, True
    expanded = []
    while True:
        open_near = np.where(done, -np.inf, near)
        at = open_near.argmax(axis=1)
        live = ~done[rows, at]
        if not live.any():
            break
        done[rows, at] = True
        node = np.where(live, ids[rows, at], n)
        expanded.append(np.where(live, node, -1))
        around = np.where(live[:, None], graph[np.minimum(node, n - 1)], -1)
        fresh = np.where(around < 0, n, around)
        new = ~seen[rows[:, None], fresh]
        seen[rows[:, None], fresh] = True
        score = np.where(new, np.einsum("brd,bd->br", points[np.minimum(fresh, n - 1)], queries), -np.inf)
        all_near = np.concatenate([near, score], axis=1)
        order = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        ids = np.take_along_axis(np.concatenate([ids, fresh], axis=1), order, axis=1)
        near = np.take_along_axis(all_near, order, axis=1)
        done = np.take_along_axis(np.concatenate([done, ~new], axis=1), order, axis=1)
    return np.where(np.isfinite(near), ids, -1), np.array(expanded).T if expanded else np.full((count, 1), -1)


def robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float, norm: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours per point of ``own`` out of its candidates (-1 for none)."""
    p = points[own]
    c = points[np.maximum(candidates, 0)]
    usable = (candidates >= 0) & (candidates != own[:, None])
    far = np.where(usable, norm - np.einsum("bcd,bd->bc", c, p), np.inf)  # half the squared distance
    order = np.argsort(far, axis=1, kind="stable")
    candidates, far = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(far, order, axis=1)
    c = points[np.maximum(candidates, 0)]
    between = norm - c @ c.transpose(0, 2, 1)
    alive, rows = np.isfinite(far), np.arange(len(own))
    out = np.full((len(own), degree), -1)
    for r in range(degree):
        at = alive.argmax(axis=1)
        live = alive[rows, at]
        if not live.any():
            break
        out[live, r] = candidates[rows, at][live]
        alive &= ~(live[:, None] & (alpha * alpha * between[rows, at] <= far))
        alive[rows, at] = False
    return out


def build_graph(vectors: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray, int]:
    """(points of equal norm, neighbours per point, start) of the robust-pruned graph over the rows of ``vectors``."""
    squares = (vectors ** 2).sum(axis=1)
    norm = float(squares.max())
    scale = 1.0 / np.sqrt(norm)
    points = np.concatenate([vectors * scale, np.sqrt(np.maximum(norm - squares, 0.0))[:, None] * scale], axis=1).astype(np.float32)
    n, norm = len(points), 1.0
    start = int((points @ points.mean(axis=0)).argmax())
    graph = np.full((n, degree), -1)
    order = np.concatenate([[start], np.setdiff1d(np.random.default_rng(7).permutation(n), [start], assume_unique=True)])
    for at in range(0, n, BATCH):
        own = order[at:at + BATCH]
        mates = points[own] @ points[own].T
        np.fill_diagonal(mates, -np.inf)
        width = min(len(own) - 1, degree if at else 2 * degree)
        parts = [own[np.argsort(-mates, axis=1)[:, :width]]] if width else []
        if at:
            found, expanded = beam_search(points, graph, start, points[own], beam)
            parts += [found, expanded]
        if not parts:
            continue
        graph[own] = robust_prune(points, own, np.concatenate(parts, axis=1), degree, alpha, norm)
        source, target = np.repeat(own, degree), graph[own].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        heads, first, counts = np.unique(target, return_index=True, return_counts=True)
        for a in range(0, len(heads), BATCH):
            h, f, m = heads[a:a + BATCH], first[a:a + BATCH], counts[a:a + BATCH]
            grid = f[:, None] + np.arange(m.max())
            back = np.where(np.arange(m.max()) < m[:, None], source[np.minimum(grid, len(source) - 1)], -1)
            both = np.concatenate([graph[h], back], axis=1)
            both[(both[:, :, None] == both[:, None, :]).astype(bool).argmax(axis=2) != np.arange(both.shape[1])] = -1  # repeats
            fits = (both >= 0).sum(axis=1) <= degree
            packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), axis=1)[:, :degree]
            graph[h[fits]] = np.pad(packed[fits], ((0, 0), (0, degree - packed.shape[1])), constant_values=-1)
            if (~fits).any():
                graph[h[~fits]] = robust_prune(points, h[~fits], both[~fits], degree, alpha, norm)
    return points, graph, start


def _classes(vectors: DataFrame, id_col: str, vector: str, k: int) -> DataFrame:
    e = F.col("e")
    usable = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("e")).where(F.col("e").isNotNull() & (F.size("e") > 0)).where(F.coalesce(usable, F.lit(False)))
    return rows.withColumn("_k", F.row_number().over(Window.partitionBy("e").orderBy("id"))).where(F.col("_k") <= k + 1).groupBy("e").agg(F.sort_array(F.collect_list("id")).alias("ids"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` rows found nearest to each query row, other than itself."""
    classes = staged(_classes(vectors, id_col, vector, k).withColumn("dim", F.size("e")), "ann-classes")
    asked = staged(queries.select(F.col(id_col).alias("id"), F.col(vector).cast("array<double>").alias("e")).distinct()
                   .join(classes.select("e", "dim"), "e"), "ann-queries")
    shards = max(1, -(-classes.count() // shard_rows))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def build(part: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(part["e"].to_list())
        points, graph, start = build_graph(x)
        return pd.DataFrame({"dim": part["dim"].iloc[:1], "shard": part["shard"].iloc[:1], "x": [x.tobytes()], "points": [points.tobytes()], "graph": [graph.astype(np.int32).tobytes()],
                             "start": [start], "ids": [[list(map(int, i)) for i in part["ids"]]]})

    def search(index: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        columns = {"query_id": [], "id": [], "score": []}
        if len(index) and len(part):
            it, dim = index.iloc[0], int(index["dim"].iloc[0])
            x, points = np.frombuffer(it["x"]).reshape(-1, dim), np.frombuffer(it["points"], np.float32).reshape(-1, dim + 1)
            graph = np.frombuffer(it["graph"], np.int32).reshape(len(x), -1).astype(np.int64)
            for a in range(0, len(part), BATCH):
                q = np.stack(part["e"].iloc[a:a + BATCH].to_list())
                ask = np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32)
                found, _ = beam_search(points, graph, int(it["start"]), ask, max(BEAM, 2 * k))
                for own, v, f in zip(part["id"].iloc[a:a + BATCH], q, found):
                    f = f[f >= 0]
                    score = (x[f] * v).sum(axis=1)
                    best = sorted(((-s, i) for s, members in zip(score.tolist(), (it["ids"][j] for j in f)) for i in members if i != own))[:k]
                    columns["query_id"] += [own] * len(best)
                    columns["id"] += [i for _, i in best]
                    columns["score"] += [-s for s, _ in best]
        return pd.DataFrame(columns)

    kind = dict(classes.dtypes)["ids"].removeprefix("array<").removesuffix(">")
    index = staged(classes.withColumn("shard", F.pmod(F.xxhash64("e"), F.lit(shards)).cast("long")).groupBy("dim", "shard")
                   .applyInPandas(build, f"dim int, shard long, x binary, points binary, graph binary, start long, ids array<array<{kind}>>"), "ann-graphs")
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    found = left.groupBy("dim", "shard", "block").cogroup(right.groupBy("dim", "shard", "block")).applyInPandas(search, f"query_id {kind}, id {kind}, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
