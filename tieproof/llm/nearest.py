"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to the cell of a randomly turned and shifted grid:
``floor((a . v + b) / width)`` for a few Gaussian directions ``a``. A query
visits its own cell and then cells with some coordinates moved by one, in the
order of their estimated chance to hold near vectors: the sum of squared
distances to the faces that are crossed. Candidates of all tables are merged and
ranked by exact distance.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tieproof.llm.tables import query, saved, table


@dataclass(frozen=True)
class Grid:
    """``dim`` components, ``tables`` tables of ``depth`` directions, cells of ``width``, ``probes`` cells per table and query.

    The width serves queries whose ``k``-th neighbour is no farther than ``near`` (by default half a width).
    """

    dim: int
    width: float
    tables: int = 6
    depth: int = 8
    probes: int = 128
    most_moved: int = 4
    seed: int = 7
    near: float = 0.0

    def reach(self) -> float:
        return self.near or self.width / 2

    def directions(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        return (rng.normal(size=(self.tables, self.dim, self.depth)),
                rng.uniform(0, self.width, (self.tables, 1, self.depth)))

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell coordinates, place inside the cell from 0 to 1), each tables x rows x depth."""
        a, b = self.directions()
        at = (np.einsum("nd,tdk->tnk", x, a) + b) / self.width
        cell = np.floor(at)
        return cell.astype(np.int64), at - cell

    def number(self, cell: np.ndarray) -> np.ndarray:
        """A 64-bit number per table and cell; cells that share a number only add candidates."""
        out = np.broadcast_to(np.arange(1, self.tables + 1, dtype=np.uint64).reshape(-1, *[1] * (cell.ndim - 2)),
                              cell.shape[:-1]).copy()
        for k in range(cell.shape[-1]):
            out = (out ^ cell[..., k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(29)
        return out.view(np.int64)

    def probe_cells(self, x: np.ndarray) -> np.ndarray:
        """tables x rows x probes numbers of the cells a query visits, the likeliest first."""
        moves = np.array([m for m in itertools.product((0, -1, 1), repeat=self.depth) if np.abs(m).sum() <= self.most_moved])
        cell, place = self.cells(x)
        down, up = (moves == -1).astype(float), (moves == 1).astype(float)
        cost = place ** 2 @ down.T + (1 - place) ** 2 @ up.T
        n = min(self.probes, len(moves))
        first = np.argpartition(cost, n - 1, axis=2)[..., :n]
        first = np.take_along_axis(first, np.argsort(np.take_along_axis(cost, first, 2), axis=2, kind="stable"), 2)
        return self.number(cell[:, :, None, :] + moves[first])


def usable(vector: Column, dim: int | None = None) -> Column:
    """No null, no null or non-finite component, not all zero, and of the asked length."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    right = F.coalesce(vector.isNotNull() & ~bad & some, F.lit(False))
    return right if dim is None else right & (F.size(vector) == dim)


def fit_grid(vectors: DataFrame, sample: int = 2000, k: int = 10, cell: float = 2.0, quantile: float = 0.95,
             **options) -> Grid | None:
    """A grid whose width is ``cell`` times the distance that reaches the ``k``-th neighbour of a share ``quantile``
    of a sample.

    The sample is the ``sample`` distinct usable vectors with the smallest hashes,
    so copies count once however many there are; the dimension is the most
    frequent one in it. A high quantile, not a mean: vectors in dense clusters
    must not make the cells too small for the others. None without vectors.
    """
    rows = vectors.where(usable(F.col("embedding"))).select("embedding", F.xxhash64("embedding").alias("hash"))
    least = rows.select("hash").distinct().orderBy("hash").limit(sample)
    rows = rows.join(least, "hash", "left_semi").groupBy("hash").agg(F.min("embedding").alias("embedding"))
    rows = rows.orderBy("hash").select("embedding").collect()
    if not rows:
        return None
    sizes = pd.Series([len(r[0]) for r in rows]).mode()
    x = np.array([r[0] for r in rows if len(r[0]) == sizes[0]], float)
    square = (x * x).sum(1)
    d = np.sort(np.maximum(square[:, None] + square[None] - 2 * (x @ x.T), 0), axis=1)
    near = float(np.quantile(np.sqrt(d[:, min(k, len(x) - 1)]), quantile))
    return Grid(int(sizes[0]), cell * (near or float(np.sqrt(square.mean()))), near=near, **options)


def _rows(batch: pa.RecordBatch, at: int, dim: int) -> np.ndarray:
    return batch.column(at).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)


def search(vectors: DataFrame, is_query: Column, k: int = 10, grid: Grid | None = None, block: int = 4096,
           rows_per_task: int = 40_000, queries_per_task: int = 20_000) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each query row, by Euclidean distance.

    ``vectors`` has ``vec_id`` and ``embedding``. Vectors that are null, zero, of
    another length, or hold null or non-finite components take no part, nor do
    null ids. Rows with an id that was there before count once, with the smallest
    vector. A query finds each other id once; ties go to the smaller id; with
    fewer than ``k`` others it finds all. Should the cells visited hold fewer than
    ``k`` within the distance that the grid is made for, the query lies where
    vectors are sparser than the cells suit, and is compared with every vector.

    Copies: of equal vectors only the ``k + 1`` smallest ids can ever be among
    the nearest, so only those are indexed. Cells with more than ``block``
    vectors are cut by a hash of the id, and a probe visits all parts. What is
    grouped is a share of cells of about ``rows_per_task`` rows with about
    ``queries_per_task`` queries; a share is sent once for each such block of
    queries. Its answer to a query is no more than ``k`` rows.
    """
    spark = vectors.sparkSession
    grid = grid or fit_grid(vectors, k=k)
    schema = "query_id long, rank int, vec_id long, score double"
    if grid is None:
        return spark.createDataFrame([], schema)
    known = vectors.where(usable(F.col("embedding"), grid.dim) & F.col("vec_id").isNotNull())
    known = saved(known.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("embedding").alias("embedding")))
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    indexed = known.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).drop("copy")
    queries = known.where(is_query)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                number = grid.number(grid.cells(_rows(part, 1, grid.dim))[0])
                for t in range(grid.tables):
                    yield pa.RecordBatch.from_arrays([pa.array(number[t]), *part.columns], ["cell", "vec_id", "embedding"])

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                number = grid.probe_cells(_rows(part, 1, grid.dim))
                for t in range(grid.tables):
                    cell = pa.array(number[t].reshape(-1))
                    ids = pa.array(np.repeat(part.column(0).to_numpy(), number.shape[2]))
                    yield pa.RecordBatch.from_arrays([cell, ids], ["cell", "vec_id"])

    kind = known.schema["embedding"].dataType.simpleString()
    index = saved(indexed.mapInArrow(cells, f"cell long, vec_id long, embedding {kind}"))
    visits = queries.mapInArrow(probes, "cell long, vec_id long").distinct()
    sizes = index.groupBy("cell").agg(F.count("*").alias("n")).withColumn("parts", F.ceil(F.col("n") / block).cast("int"))
    shares = max(1, -(-index.count() // rows_per_task))
    turns = max(1, -(-queries.count() // queries_per_task))
    share = lambda *c: F.pmod(F.xxhash64(*c), F.lit(shares)).cast("int")
    turn = F.pmod(F.xxhash64("query_id"), F.lit(turns)).cast("int")
    every_turn = F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("turn")
    part_of = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    parted = index.join(sizes.where("parts > 1").select("cell", "parts"), "cell", "left")
    parted = parted.select("cell", F.coalesce(part_of, F.lit(0)).alias("part"), "vec_id", "embedding").withColumn(
        "share", share(F.col("cell"), F.col("part"))).select("*", every_turn)
    asked = visits.join(sizes.select("cell", "parts"), "cell").select(
        "cell", "vec_id", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    ).withColumn("share", share(F.col("cell"), F.col("part")))
    # the vectors of the queries go once to each share that they visit
    asked = asked.groupBy("share", "vec_id").agg(F.collect_set(F.struct("cell", "part")).alias("cells"))
    asked = asked.join(queries.select("vec_id", "embedding"), "vec_id").select(
        "share", F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"), "cells").withColumn("turn", turn)

    def nearest(q: np.ndarray, x: np.ndarray, ids: np.ndarray, own: int) -> list[tuple[int, float]]:
        """Exact distances of the vectors that may be among the nearest, in order."""
        d = np.sqrt(((x - q) ** 2).sum(1))
        d[ids == own] = np.inf
        if len(d) > k:
            at = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
            x, ids, d = x[at], ids[at], d[at]
        order = np.lexsort((ids, d))[:k]
        return [(int(ids[i]), float(d[i])) for i in order if d[i] < np.inf]

    def answer(have: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(have) and len(ask):
            have = have.sort_values(["cell", "part"], kind="stable")
            x, ids = np.array(have.embedding.tolist(), float), have.vec_id.to_numpy()
            keys = list(zip(have.cell.tolist(), have.part.tolist()))
            first: dict[tuple[int, int], int] = {}
            for i, key in enumerate(keys):
                first.setdefault(key, i)
            after = dict(zip(first, [*list(first.values())[1:], len(keys)]))
            for q, vector, cells_ in zip(ask.query_id, ask.vector, ask.cells):
                runs = [np.arange(first[c], after[c]) for c in sorted((c["cell"], c["part"]) for c in cells_) if c in first]
                if not runs:
                    continue
                at = np.concatenate(runs)
                at = at[np.unique(ids[at], return_index=True)[1]]
                out += [(q, v, d) for v, d in nearest(np.asarray(vector, float), x[at], ids[at], q)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = parted.groupBy("share", "turn").cogroup(asked.groupBy("share", "turn")).applyInPandas(
        answer, "query_id long, vec_id long, score double")
    found = saved(found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")))

    # a query whose cells hold too few vectors near it is compared with all of them, block by block
    full = found.where(F.col("score") <= grid.reach()).groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    short = queries.join(full, queries["vec_id"] == full["query_id"], "left_anti").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector")).withColumn("turn", turn)
    blocks = indexed.withColumn("share", share(F.col("vec_id"))).select("*", every_turn)
    asked_all = short.select("*", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))).alias("share"))

    def compare(have: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(have) and len(ask):
            x, ids = np.array(have.embedding.tolist(), float), have.vec_id.to_numpy()
            for q, vector in zip(ask.query_id, ask.vector):
                out += [(q, v, d) for v, d in nearest(np.asarray(vector, float), x, ids, q)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    rest = blocks.groupBy("share", "turn").cogroup(asked_all.groupBy("share", "turn")).applyInPandas(
        compare, "query_id long, vec_id long, score double")
    every = found.unionByName(rest).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


@query("op3_nearest_vectors")
def op3_nearest_vectors(spark, folder):
    return search(table(spark, folder, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 100 == 0)
