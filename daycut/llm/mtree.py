"""Exact top-k inner-product search by best-first search in M-trees.

Vectors get one more component, ``sqrt(M - |v|^2)`` with M the largest squared
norm; queries get 0 there.  In that space the largest inner product is the
smallest Euclidean distance, which is a metric, so triangle-inequality bounds
hold.

The vectors are dealt to cells around at most ``CELLS`` pivots (a bounded
broadcast), and each cell in pieces of bounded size; a piece is one M-tree of
pages.  A page keeps its routing vector, covering radius and distance to the
tree's routing vector, and every entry its distance to the page's.  A query
first searches one tree of its own cell for a threshold; then it goes to the
trees whose cell may still beat it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daycut.session import checkpointed

from .common import Shared

CELLS = 256
TREE_ROWS = 2048
PAGE_ROWS = 64
QUERY_ROWS = 1024
_TREE = ("cell long, piece long, ids array<long>, times array<long>, vectors binary, centre binary, pages array<int>, routes binary, "
         "radius array<double>, parent array<double>, near binary")
_HIT = "query_id long, vec_id long, score long, times long"


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id``, ``v`` with v = floor(256 x) of every vector that takes part, and
    ``times``, the number of its equal rows."""
    v = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * 256).cast("double"))
    whole = F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x)
                     & (F.abs(x.cast("double")) != float("inf")))
    return rows.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & whole).select(
        F.col(id_col).cast("long").alias("id"), v.alias("v")).groupBy("id", "v").agg(F.count(F.lit(1)).alias("times"))


def _matrix(column, dim: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled with 0."""
    out = np.zeros((len(column), dim))
    for i, v in enumerate(column):
        out[i, :len(v)] = v
    return out


def _lift(m: np.ndarray, top: float) -> np.ndarray:
    return np.concatenate([m, np.sqrt(np.maximum(top - (m * m).sum(1), 0))[:, None]], axis=1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d2 = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(d2, 0))


def _split(points: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Cuts rows into pages: halves by which of two far points is nearer."""
    todo, done = [rows], []
    while todo:
        rows = todo.pop()
        if len(rows) <= PAGE_ROWS:
            done.append(rows)
            continue
        p = points[rows]
        far = p[np.argmax(_distances(p[:1], p)[0])]
        other = p[np.argmax(_distances(far[None], p)[0])]
        d = _distances(np.stack([far, other]), p)
        order = np.argsort(d[0] - d[1], kind="stable")
        half = len(rows) // 2
        todo += [rows[order[:half]], rows[order[half:]]]
    return done


def build_tree(rows: pd.DataFrame, dim: int, top: float) -> dict:
    """One M-tree of a bounded number of vectors."""
    rows = rows.sort_values("id", ignore_index=True)
    m = _matrix(rows["v"], dim)
    points = _lift(m, top)
    pages = _split(points, np.arange(len(m)))
    order = np.concatenate(pages)
    centre = points.mean(0)
    routes = np.stack([points[p].mean(0) for p in pages])
    near = [_distances(r[None], points[p])[0] for r, p in zip(routes, pages)]
    return {"ids": rows["id"].to_numpy()[order], "times": rows["times"].to_numpy()[order], "vectors": m[order].tobytes(), "centre": centre.tobytes(),
            "pages": np.cumsum([0, *map(len, pages)]).tolist(), "routes": routes.tobytes(),
            "radius": [float(n.max()) for n in near], "parent": _distances(centre[None], routes)[0].tolist(),
            "near": np.concatenate(near).tobytes()}


class Tree:
    """A tree as read from its row, and the search in it."""

    def __init__(self, row, dim: int, top: float) -> None:
        self.ids, self.times, self.top = np.asarray(row.ids, dtype=np.int64), np.asarray(row.times, dtype=np.int64), top
        self.vectors = np.frombuffer(row.vectors).reshape(-1, dim)
        self.centre = np.frombuffer(row.centre)
        self.pages, self.radius, self.parent = list(row.pages), np.asarray(row.radius), np.asarray(row.parent)
        self.routes, self.near = np.frombuffer(row.routes).reshape(-1, dim + 1), np.frombuffer(row.near)

    def search(self, query: int, v: np.ndarray, k: int, least: float) -> list[tuple[int, int, int]]:
        """Up to ``k`` (score, id, times) of at least ``least``; best first, pages in
        order of their bound.  ``slack`` covers the rounding of distances."""
        point = np.append(v, 0.0)
        both = float(v @ v) + self.top
        slack = 1e-9 * both + 0.25
        reach = lambda s: np.sqrt(max(both - 2 * s, 0.0) + 2 * slack)  # noqa: E731  distance of a score
        to_root = float(np.sqrt(((point - self.centre) ** 2).sum()))
        best: list[tuple[int, int, int]] = []                # heap of (score, -id, times)
        limit = reach(least) if least > -np.inf else np.inf
        # stored parent distances bound a page before its own distance is known
        queue = [(max(b, 0.0), 0, i) for i, b in enumerate(np.abs(to_root - self.parent) - self.radius)]
        heapq.heapify(queue)
        while queue:
            bound, known, page = heapq.heappop(queue)
            if bound > limit:
                break
            if not known:
                d = float(np.sqrt(((point - self.routes[page]) ** 2).sum()))
                heapq.heappush(queue, (max(d - self.radius[page], 0.0), d + 1e-300, page))
                continue
            lo, hi = self.pages[page], self.pages[page + 1]
            rows = np.flatnonzero(np.abs(known - self.near[lo:hi]) <= limit) + lo
            score = np.rint(self.vectors[rows] @ v).astype(np.int64)
            for s, i, n in zip(score.tolist(), self.ids[rows].tolist(), self.times[rows].tolist()):
                if i == query or s < least:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (s, -i, n))
                elif (s, -i, n) > best[0]:
                    heapq.heapreplace(best, (s, -i, n))
            if len(best) == k:
                limit = min(limit, reach(best[0][0]))
        return [(s, -i, n) for s, i, n in best]


def top_k(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
          is_query=lambda i: i % 50 == 0, cells: int = CELLS, tree_rows: int = TREE_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """Each query's ``k`` rows of largest integer inner product.

    Queries are the rows whose id meets ``is_query``; candidates are all rows
    but those of the query's own id.  Returns ``query_id``, ``rank`` from 1,
    ``vec_id``, ``score``; ties go to the smaller id, and with fewer candidates
    than ``k`` all are returned.  Rows with a null id, and vectors that are
    null or hold null or non-finite components, take no part.  Equal rows are
    one query, but each of them is a candidate of its own.  Shorter vectors are filled with zeros.  Scores are exact up
    to 2^53.  An empty table, or one vector, gives no rows.
    """
    spark = rows.sparkSession
    base = checkpointed(integer_vectors(rows, id_col, vector_col))
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    n, dim, top = base.agg(F.count(F.lit(1)), F.max(F.size("v")), F.max(norm)).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim, top = int(dim), float(top)
    # pivots: the vectors of smallest hash, at most `cells`
    count = max(1, min(cells, n // tree_rows))
    pivots = _lift(_matrix([r["v"] for r in base.select("v").distinct().orderBy(F.xxhash64("v")).limit(count).collect()],
                           dim), top)
    shared = Shared(spark, pivots)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _distances(_lift(_matrix(batch.column("v").to_numpy(zero_copy_only=False), dim), top), shared.value)
            cell = d.argmin(1) if len(d) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(cell.astype(np.int64)),
                                              pa.array(d[np.arange(len(d)), cell]), batch.column("times")],
                                             ["id", "v", "cell", "d", "times"])

    placed = checkpointed(base.mapInArrow(assign, "id long, v array<double>, cell long, d double, times long"))
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("radius")).collect()
    pieces = {r["cell"]: -(-r["n"] // tree_rows) for r in sizes}        # at most `cells` entries
    radius = {r["cell"]: r["radius"] for r in sizes}
    per = F.create_map(*[F.lit(x).cast("long") for item in pieces.items() for x in item])
    queries = placed.where(is_query(F.col("id")))
    spread = max(1, -(-queries.count() // query_rows))

    def make(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([{"cell": key[0], "piece": key[1], **build_tree(pdf, dim, top)}])

    trees = checkpointed(placed.withColumn("piece", F.pmod(F.xxhash64("id", "v"), per[F.col("cell")]))
                         .groupBy("cell", "piece").applyInPandas(make, _TREE))
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(spread)).alias("block")

    def look(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            tree = Tree(right.iloc[0], dim, top)
            for q, v, least in zip(left["id"], _matrix(left["v"], dim), left["least"]):
                out += [(q, i, s, n) for s, i, n in tree.search(int(q), v, k, -np.inf if np.isnan(least) else least)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score", "times"]).astype("int64")

    def search(asked: DataFrame) -> DataFrame:
        at = ("cell", "piece", "block")
        # a tree goes to the query blocks that ask for it, and to no other
        named = asked.select(*[F.col(c).alias(f"to_{c}") for c in at]).distinct()
        sent = (trees.join(named, (F.col("cell") == F.col("to_cell")) & (F.col("piece") == F.col("to_piece")))
                .drop("to_cell", "to_piece").withColumnRenamed("to_block", "block"))
        return asked.groupBy(*at).cogroup(sent.groupBy(*at)).applyInPandas(look, _HIT)

    home = queries.select("id", "v", "cell", F.pmod(F.xxhash64("id", F.lit(2)), per[F.col("cell")]).alias("piece"), block)
    first = checkpointed(search(home.withColumn("least", F.lit(None).cast("double"))))
    least = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).cast("double").alias("least"))
    asked = home.join(least.withColumnRenamed("query_id", "id"), "id", "left").select(
        "id", "v", "block", "least", F.col("cell").alias("own"), F.col("piece").alias("own_piece"))
    ball = Shared(spark, (pivots, radius, pieces))

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, radius, pieces = ball.value
        names = np.array(sorted(pieces), dtype=np.int64)
        r = np.array([radius[c] for c in names.tolist()])
        for batch in batches:
            m = _matrix(batch.column("v").to_numpy(zero_copy_only=False), dim)
            both = (m * m).sum(1) + top
            d = _distances(np.concatenate([m, np.zeros((len(m), 1))], axis=1), pivots[names])
            nearest = np.maximum(d - r, 0)
            most = (both[:, None] - nearest ** 2) / 2 + 1e-6 * both[:, None] + 0.5      # best score possible
            low = batch.column("least").to_numpy(zero_copy_only=False).astype(float)
            row, col = np.nonzero(~(most < low[:, None]))
            times = np.array([pieces[c] for c in names[col].tolist()], dtype=np.int64)
            piece = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, cell = np.repeat(row, times), names[np.repeat(col, times)]
            own = batch.column("own").to_numpy(), batch.column("own_piece").to_numpy()
            new = (cell != own[0][row]) | (piece != own[1][row])
            take = pa.array(row[new])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(take) for c in ("id", "v", "block", "least")]
                + [pa.array(cell[new]), pa.array(piece[new])], ["id", "v", "block", "least", "cell", "piece"])

    rest = search(checkpointed(asked.mapInArrow(
        route, "id long, v array<double>, block long, least double, cell long, piece long")))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    # two rows of one id and different vectors stay two candidates
    hits = first.union(rest).select("query_id", "vec_id", "score", F.explode(F.array_repeat(
        F.lit(0), F.least("times", F.lit(k)).cast("int"))).alias("_"))
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
