"""Near-duplicate embeddings by a subspace pigeonhole join.

Equal vectors form classes first; classes are compared. Unit vectors with cosine c lie at squared distance 2 - 2c, and any rotation keeps it. The rotation
(principal axes of all vectors, dealt in turn to blocks of ``DIMS``) spreads the spread evenly; each block gets its share of the squared distance
in proportion to its spread. If all blocks were over their share the sum would be over the whole, so every linked pair is within it in some block.
Each block is a range join: its axes are cut at quantiles into cells, a vector is at home in one, and visits those later cells
that come within the block's radius. A cell's pairs are screened by the block's distance and the survivors verified by cosine in double precision;
a pair counts in the first block that proposes it, so it counts once.

Cells are cut into tiles of at most ``TILE`` rows a side, so no task holds a cell, however many vectors share it. A tile returns a row for each of its linked
vectors, with their number and a root, never the pairs. Vectors that are null, zero, or hold null or non-finite components link with nothing, nor do vectors
of different lengths. Rows that share a vec_id are one vector each; the smallest id names a component. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from adspark.llm.common import components, keep, map_arrow, table

COSINE, DIMS, TILE, HOME, ROWS = 0.95, 8, 4096, 4096, 512
#: Slack of the screens, far above rounding and far below any budget; the final test has none.
SLACK = 1e-9


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, width)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled first, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def classes(vectors: DataFrame) -> DataFrame:
    """id, width and data (doubles, binary) of every vector that can link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, width = [], []
            for v in batch.column("embedding"):
                x = v.as_py()
                ok = x is not None and None not in x and len(x) and np.isfinite(x).all() and any(x)
                data.append((np.array(x, "<f8") + 0.0).tobytes() if ok else None)
                width.append(len(x) if ok else None)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(width, pa.int32()), pa.array(data, pa.binary())], ["vec_id", "width", "data"])

    return map_arrow(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")),
                     run, "vec_id long, width int, data binary")


class Grid:
    """Rotation, blocks with budgets, and the cells of every block."""

    def __init__(self, mean_square: np.ndarray, n: int, cosine: float):
        width = len(mean_square)
        values, axes = np.linalg.eigh(mean_square)
        order = np.argsort(-values, kind="stable")
        blocks = max(1, -(-width // DIMS))
        self.blocks = [order[b::blocks] for b in range(blocks)]
        self.axes = axes
        whole = 2 - 2 * cosine
        share = np.array([max(values[b].sum(), 1e-12) for b in self.blocks])
        self.budget = whole * share / share.sum()
        #: Cuts of each block: on its widest axes, twice as many cells for each doubling of the vectors over HOME.
        self.depth = int(np.clip(np.ceil(np.log2(max(1, n) / HOME)), 0, 12))
        self.cuts: list[list[np.ndarray]] = []

    def rotate(self, x: np.ndarray) -> np.ndarray:
        return x @ self.axes

    def parts(self) -> list[list[int]]:
        """For each block the number of cells along its axes."""
        out = []
        for b in self.blocks:
            n = [1] * len(b)
            for k in range(self.depth):
                n[k % len(b)] *= 2
            out.append(n)
        return out

    def visits(self, y: np.ndarray, b: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, cells, at home or not): the home cell of every row, and later cells within the block's radius."""
        at = np.arange(len(y))
        cell, home, far = np.zeros(len(y), np.int64), np.zeros(len(y), np.int64), np.zeros(len(y))
        for axis, cuts in zip(self.blocks[b], self.cuts[b]):
            n = len(cuts) + 1
            v = y[at, axis]
            own = np.searchsorted(cuts, v, side="right")
            edge = np.concatenate([[-np.inf], cuts, [np.inf]])
            grown = []
            for k in range(n):
                gap = np.maximum(0, np.maximum(edge[k] - v, v - edge[k + 1]))
                total = far + gap * gap
                ok = total <= self.budget[b] + SLACK
                grown.append((at[ok], cell[ok] * n + k, home[ok] * n + own[ok], total[ok]))
            at, cell, home, far = (np.concatenate(c) for c in zip(*grown))
        yield at[cell == home], cell[cell == home], np.ones(int((cell == home).sum()), bool)
        later = cell > home
        yield at[later], cell[later], np.zeros(int(later.sum()), bool)


def _moments(vectors: DataFrame, width: int) -> tuple[np.ndarray, int]:
    """Mean of the outer products of unit vectors and their number: width x width numbers from each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((width, width)), 0
        for batch in batches:
            if len(batch):
                x = unit(_matrix(batch.column("data"), width))
                total += x.T @ x
                n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(list(total), pa.list_(pa.float64())), pa.array(np.full(width, n))], ["row", "sums", "n"])

    rows = (map_arrow(vectors.select("data"), run, "row long, sums array<double>, n long")
            .select("row", "n", F.posexplode("sums").alias("col", "x")).groupBy("row", "col").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect())
    out = np.zeros((width, width))
    for r in rows:
        out[r.row, r.col] = r.x
    n = max((r.n for r in rows), default=0)
    return out / max(1, n), n


def _quantiles(vectors: DataFrame, grid: Grid, width: int) -> list[list[np.ndarray]]:
    """Cuts of all axes that are cut, from a histogram of fixed size; any cuts are right, these make cells alike."""
    steps, parts = 2048, grid.parts()
    axes = [(b, k, a) for b, block in enumerate(grid.blocks) for k, a in enumerate(block) if parts[b][k] > 1]
    cuts = [[np.zeros(0) for _ in block] for block in grid.blocks]
    if not axes:
        return cuts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(axes), steps), np.int64)
        for batch in batches:
            if len(batch):
                y = grid.rotate(unit(_matrix(batch.column("data"), width)))
                for i, (_, _, a) in enumerate(axes):
                    total[i] += np.bincount(np.clip(((y[:, a] + 1) * steps / 2).astype(int), 0, steps - 1), minlength=steps)
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["axis", "step", "n"])

    total = np.zeros((len(axes), steps))
    for r in map_arrow(vectors.select("data"), run, "axis long, step long, n long").groupBy("axis", "step").agg(F.sum("n").alias("n")).collect():
        total[r.axis, r.step] = r.n
    for i, (b, k, _) in enumerate(axes):
        part = np.cumsum(total[i]) / max(1, total[i].sum())
        at = np.searchsorted(part, np.arange(1, parts[b][k]) / parts[b][k])
        cuts[b][k] = np.unique((at + 1) * 2 / steps - 1)
    return cuts


def _tile(grid: Grid, cosine: float, b: int, x: np.ndarray, ids: np.ndarray, weight: np.ndarray, left: np.ndarray, right: np.ndarray,
          same: bool) -> tuple[np.ndarray, np.ndarray]:
    """For the rows of a tile: the weight of the vectors linked to each, and a root that linked rows share."""
    degree, root = np.zeros(len(x), np.int64), np.arange(len(x))
    block = grid.blocks[b]
    y = grid.rotate(x)
    for k in range(0, len(left), ROWS):
        i = left[k:k + ROWS]
        a, c = y[i][:, block], y[right][:, block]
        gap = (a * a).sum(1)[:, None] + (c * c).sum(1)[None, :] - 2 * a @ c.T
        near = gap <= grid.budget[b] + SLACK
        if same:
            near &= i[:, None] < right[None, :]
        r, s = np.nonzero(near)
        for m in range(0, len(r), 1 << 16):  # a bounded number of candidates are verified at once
            p, q = i[r[m:m + (1 << 16)]], right[s[m:m + (1 << 16)]]
            ok = np.einsum("ij,ij->i", x[p], x[q]) >= cosine
            p, q = p[ok], q[ok]
            if not len(p):
                continue
            d = (y[p] - y[q]) ** 2
            first = _proposes(grid, d, b)
            for earlier in range(b):
                first &= ~_proposes(grid, d, earlier)
            p, q = p[first], q[first]
            degree += np.bincount(p, weight[q], len(x)).astype(np.int64) + np.bincount(q, weight[p], len(x)).astype(np.int64)
            while True:  # every round joins trees of the pairs' ends
                u, v = root[p], root[q]
                low, high = np.minimum(u, v), np.maximum(u, v)
                apart = low < high
                if not apart.any():
                    break
                np.minimum.at(root, high[apart], low[apart])
                while (root[root] != root).any():
                    root = root[root]
                p, q = p[apart], q[apart]
    return degree, root


def _proposes(grid: Grid, squares: np.ndarray, b: int) -> np.ndarray:
    """Whether block b proposes pairs with these squared differences by axis: half the slack, so every tile agrees."""
    return squares[:, grid.blocks[b]].sum(1) <= grid.budget[b] + SLACK / 2


def _linked(reps: DataFrame, width: int, cosine: float) -> DataFrame:
    """id, n (weight of links) and root for the classes (id, n, data) of one width; a class can have several rows."""
    spark = reps.sparkSession
    square, n = _moments(reps, width)
    grid = Grid(square, n, cosine)
    grid.cuts = _quantiles(reps, grid, width)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            y = grid.rotate(unit(_matrix(batch.column("data"), width)))
            for b in range(len(grid.blocks)):
                for rows, cells, home in grid.visits(y, b):
                    some = pa.array(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), b, np.int32)), pa.array(cells), pa.array(home), *(batch.column(c).take(some) for c in ("id", "n", "data"))],
                                                     ["block", "cell", "home", "id", "n", "data"])

    key = ["block", "cell"]
    kind = "block int, cell long, home boolean, id long, n long, data binary"
    visits = map_arrow(reps.select("id", "n", "data"), visit, kind)
    sizes = (map_arrow(reps.select("id", "n", "data"), visit, kind).groupBy(*key)
             .agg(F.sum(F.col("home").cast("long")).alias("homes"), F.sum((~F.col("home")).cast("long")).alias("guests")).collect())
    # At most 2 ** depth cells a block.
    parts = {(r.block, r.cell): (max(1, -(-r.homes // TILE)), -(-r.guests // TILE)) for r in sizes if r.homes}
    tiles = spark.sparkContext.broadcast(parts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each tile that a visit takes part in: home part i with home part j >= i, or with guest part j - homes."""
        held = tiles.value
        for batch in batches:
            at, one, two, side = [], [], [], []
            for k, (b, cell, home, i) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("block", "cell", "home", "id")))):
                if (b, cell) not in held:
                    continue
                homes, guests = held[b, cell]
                salt = (i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 33
                if home:
                    own = salt % homes
                    put = [(min(own, j), max(own, j), 0 if own <= j else 1) for j in range(homes)] + [(own, homes + g, 0) for g in range(guests)]
                else:
                    put = [(j, homes + salt % guests, 1) for j in range(homes)]
                for x, y, z in put:
                    at.append(k)
                    one.append(x)
                    two.append(y)
                    side.append(z)
            some = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([some.column("block"), some.column("cell"), pa.array(one, pa.int32()), pa.array(two, pa.int32()), pa.array(side, pa.int32()),
                                              *(some.column(c) for c in ("id", "n", "data"))], ["block", "cell", "one", "two", "side", "id", "n", "data"])

    dealt = map_arrow(visits, deal, "block int, cell long, one int, two int, side int, id long, n long, data binary")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["side", "id"], kind="stable")
        side, ids = frame["side"].to_numpy(), frame["id"].to_numpy()
        x = unit(np.frombuffer(b"".join(frame["data"]), "<f8").reshape(-1, width))
        same = frame["one"].iat[0] == frame["two"].iat[0]
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)
        degree, root = _tile(grid, cosine, int(frame["block"].iat[0]), x, ids, frame["n"].to_numpy(), left, right, same)
        some = degree > 0
        return pd.DataFrame({"id": ids[some], "n": degree[some], "root": ids[root[some]]})

    return dealt.groupBy("block", "cell", "one", "two").applyInPandas(compare, "id long, n long, root long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``vectors``."""
    each = keep(classes(vectors))
    grouped = keep(each.where("data is not null").groupBy("width", "data").agg(F.min("vec_id").alias("low"), F.count("*").alias("n"))
                   .withColumn("id", F.monotonically_increasing_id()))
    found = None
    for r in grouped.select("width").distinct().collect():  # lengths of vectors, commonly one
        part = _linked(grouped.where(F.col("width") == r.width), r.width, cosine)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return each.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = keep(found)
    degree = keep(found.groupBy("id").agg(F.sum("n").alias("links")))
    roots = components(found.select("id", "root"), "id", "root")
    rooted = keep(grouped.select("id", "low", "n").join(roots, F.col("id") == F.col("node"), "left").select("id", "low", "n", F.coalesce("root", "id").alias("root")))
    lowest = keep(rooted.groupBy("root").agg(F.min("low").alias("component_id")))
    named = rooted.join(lowest, "root").join(degree, "id", "left").select("id", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    by_data = keep(grouped.select("id", "width", "data").join(keep(named), "id").select("width", "data", "component_id", "n_links"))
    alone = each.where("data is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = each.where("data is not null").join(by_data, ["width", "data"]).select("vec_id", "n_links", "component_id")
    return linked.unionByName(alone).select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
      AND list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS m FROM r GROUP BY a),
n AS (SELECT a, count(*) AS k FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(k, 0) AS BIGINT) AS n_links, m AS component_id, vec_id = m AS kept
FROM v JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
"""
