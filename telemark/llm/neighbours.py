"""Approximate nearest neighbours: a forest of random-projection trees.

Each tree halves a bounded sample by random directions at the median, DEPTH times; every
row is then routed to its leaf in each tree. A query walks all trees at once: leaves of
the whole forest stand in one priority queue by how far the query lies beyond the splits
on the way to them, and are taken until at least LEAVES of them and SEARCH candidates
are found. The candidates of all leaves taken are scored exactly, by inner product in
double precision, and the best of every leaf are merged.

Distribution: rows and queries meet in cells, one per leaf and block. A leaf with many
rows (a vector that a third of all rows share falls in one leaf) is dealt over blocks of
about BLOCK rows, its queries over blocks as well, so a task holds one small matrix
whatever the data. Only the splits and the leaf sizes (2**DEPTH * TREES numbers) reach
the driver; the forest is fitted on at most SAMPLE rows, the index holds every row.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do
those of another length than the commonest in the sample, nor null ids. Rows with a
query's own id are no candidates. Repeated ids count once, with their best score. Ties go
to the smaller id. An empty table or one without queries gives no rows.
"""
from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemark.llm.tables import stored

TREES, DEPTH = 8, 6
SAMPLE = 16_384
LEAVES, SEARCH = 80, 2_000
BLOCK, QUERY_BLOCK = 4_096, 8_192


class Forest:
    """directions[tree][level] is (2**level, dim), cuts[tree][level] is (2**level,)."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.depth, self.directions, self.cuts = depth, [], []
        for _ in range(trees):
            groups, directions, cuts = [np.arange(len(sample))], [], []
            for _ in range(depth):
                w = rng.normal(size=(len(groups), sample.shape[1]))
                w /= np.linalg.norm(w, axis=1, keepdims=True)
                cut, halves = np.zeros(len(groups)), []
                for g, rows in enumerate(groups):
                    side = sample[rows] @ w[g]
                    cut[g] = np.median(side) if len(rows) else 0.0
                    halves += [rows[side <= cut[g]], rows[side > cut[g]]]
                groups = halves
                directions.append(w.astype(np.float32))
                cuts.append(cut.astype(np.float32))
            self.directions.append(directions)
            self.cuts.append(cuts)

    def route(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees) numbers of the leaves, counted through the forest."""
        out = np.zeros((len(x), len(self.directions)), dtype=np.int64)
        for t, (directions, cuts) in enumerate(zip(self.directions, self.cuts)):
            node = np.zeros(len(x), dtype=np.int64)
            for w, cut in zip(directions, cuts):
                node = 2 * node + (np.einsum("ij,ij->i", x, w[node]) > cut[node])
            out[:, t] = node + (t << self.depth)
        return out

    def queue(self, x: np.ndarray) -> np.ndarray:
        """(rows, leaves): priorities; the squared distances beyond the splits, summed."""
        parts = []
        for directions, cuts in zip(self.directions, self.cuts):
            cost = np.zeros((len(x), 1), dtype=np.float32)
            for w, cut in zip(directions, cuts):
                side = x @ w.T - cut
                cost = np.stack([cost + np.maximum(side, 0) ** 2, cost + np.maximum(-side, 0) ** 2], axis=2).reshape(len(x), -1)
            parts.append(cost)
        return np.concatenate(parts, axis=1)


def visits(cost: np.ndarray, sizes: np.ndarray, leaves: int, search: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, leaf) pairs: each query's leaves in queue order up to both bounds."""
    order = np.argsort(cost, axis=1, kind="stable")
    before = np.cumsum(sizes[order], axis=1) - sizes[order]
    take = (np.arange(cost.shape[1])[None, :] < leaves) | (before < search)
    query, place = np.nonzero(take & (sizes[order] > 0))
    return query, order[query, place]


def nearest(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each query's k best of the rows (ids, exact scores); own id left out, ids once."""
    x, q = x.astype(np.float64), q.astype(np.float64)
    out = []
    for begin in range(0, len(q), 512):
        near = q[begin: begin + 512] @ x.T
        near[query_ids[begin: begin + 512][:, None] == ids[None, :]] = -np.inf
        for r in range(len(near)):
            row = near[r]
            want = min(k, len(row))
            if want == 0:
                out.append((ids[:0], row[:0]))
                continue
            edge = np.partition(row, len(row) - want)[len(row) - want]
            if np.isfinite(edge):
                edge -= 1e-9 * max(1.0, abs(edge))
            at = np.flatnonzero((row >= edge) & np.isfinite(row))
            # One order of summation for every pair, so equal vectors score equal anywhere.
            score = (x[at] * q[begin + r]).sum(axis=1)
            best = np.lexsort((ids[at], -score))
            at, score = at[best], score[best]
            _, first = np.unique(ids[at], return_index=True)
            if len(first) < len(at):
                at, score = at[np.sort(first)], score[np.sort(first)]
            out.append((ids[at[:k]], score[:k]))
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x) of the vectors that take part."""
    slim = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("x"))
    return slim.filter("id IS NOT NULL AND x IS NOT NULL AND size(x) > 0 "
                       "AND forall(x, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('Infinity')) AND exists(x, v -> v <> 0)")


def _matrix(column, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           leaves: int = LEAVES, search_size: int = SEARCH) -> DataFrame:
    """(query_id, rank, <id>, score) of the k nearest found for each row of `queries`."""
    spark = vectors.sparkSession
    result = f"query_id long, rank int, {id_col} long, score double"
    rows, asked = usable(vectors, id_col, vector_col), usable(queries, id_col, vector_col)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    if not sample:
        return spark.createDataFrame([], result)
    dim = Counter(len(r.x) for r in sample).most_common(1)[0][0]
    forest = spark.sparkContext.broadcast(Forest(np.array([r.x for r in sample if len(r.x) == dim], dtype=np.float32)))
    rows, asked = rows.filter(F.size("x") == dim), asked.filter(F.size("x") == dim)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TREES << DEPTH, dtype=np.int64)
        for batch in batches:
            total += np.bincount(forest.value.route(_matrix(batch.column(0), dim)).ravel(), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["leaf", "n"])

    sizes = np.zeros(TREES << DEPTH, dtype=np.int64)
    for r in rows.select("x").mapInArrow(count, "leaf long, n long").groupBy("leaf").agg(F.sum("n").alias("n")).collect():
        sizes[r.leaf] = r.n
    blocks = -(-sizes // BLOCK)
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, x = np.asarray(batch.column(0)), _matrix(batch.column(1), dim)
            for leaf in forest.value.route(x).T:
                block = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % blocks[leaf]
                yield from _cells(leaf, block, batch, query_blocks)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 1024):
                batch = whole.slice(begin, 1024)
                ids, x = np.asarray(batch.column(0)), _matrix(batch.column(1), dim)
                query, leaf = visits(forest.value.queue(x.astype(np.float32)), sizes, leaves, search_size)
                mine = (ids.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) >> np.uint64(33)).astype(np.int64) % query_blocks
                for a in range(0, len(query), 1 << 14):
                    q, l = query[a: a + (1 << 14)], leaf[a: a + (1 << 14)]
                    times = blocks[l]
                    again = np.repeat(np.arange(len(q)), times)
                    block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(l[again]), pa.array(block), pa.array(mine[q[again]]), *batch.take(pa.array(q[again])).columns],
                        ["leaf", "block", "asker", "id", "x"])

    cell = "leaf long, block long, asker long, id long, x array<double>"
    keys = ["leaf", "block", "asker"]
    long_rows = rows.select(F.col("id").cast("long").alias("id"), "x")
    long_asked = asked.select(F.col("id").cast("long").alias("id"), "x")
    found_type = "query_id long, found array<struct<far:double,id:long>>"

    def meet(_, left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("found", pa.list_(pa.struct([("far", pa.float64()), ("id", pa.int64())])))])
        if left.num_rows == 0 or right.num_rows == 0:
            return schema.empty_table()
        asker = left["id"].to_numpy()
        best = nearest(right["id"].to_numpy(), _matrix(right["x"].combine_chunks(), dim), asker, _matrix(left["x"].combine_chunks(), dim), k)
        cuts = np.concatenate([[0], np.cumsum([len(i) for i, _ in best])]).astype(np.int32)
        body = pa.StructArray.from_arrays(
            [pa.array(-np.concatenate([s for _, s in best])), pa.array(np.concatenate([i for i, _ in best]))], ["far", "id"])
        return pa.table([pa.array(asker), pa.ListArray.from_arrays(pa.array(cuts), body)], schema=schema)

    asked_cells = long_asked.mapInArrow(ask, cell).groupBy(*keys)
    met = asked_cells.cogroup(long_rows.mapInArrow(place, cell).groupBy(*keys)).applyInArrow(meet, found_type)
    # At most (leaves taken) * k rows per query; an id found in several leaves counts once.
    each = stored(met, "found").select("query_id", F.explode("found").alias("f")).groupBy(
        "query_id", F.col("f.id").alias("id")).agg(F.min("f.far").alias("far"))
    ranked = each.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("far", "id"))), 1, k).alias("found"))
    return ranked.select("query_id", F.posexplode("found").alias("p", "f")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("f.id").alias(id_col), (-F.col("f.far")).alias("score"))


def _cells(leaf: np.ndarray, block: np.ndarray, batch: pa.RecordBatch, copies: int) -> Iterator[pa.RecordBatch]:
    """The batch with its cell; once per block of queries."""
    for c in range(copies):
        yield pa.RecordBatch.from_arrays(
            [pa.array(leaf), pa.array(block), pa.array(np.full(batch.num_rows, c)), *batch.columns], ["leaf", "block", "asker", "id", "x"])
