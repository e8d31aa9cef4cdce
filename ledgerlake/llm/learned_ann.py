"""Approximate nearest neighbours by learned partitions (largest inner product).

Fit, on a sample of at most SAMPLE vectors and SAMPLE_BYTES (the rows of smallest id hash, one an id; a documented bound): the exact
neighbour graph of the sample, cut into equal parts by recursive bisection (a spectral start, then swaps that lower the
cut), and a small classifier with one hidden layer that learns a vector's part and the parts of its neighbours. A fifth
of the sample is kept from both; on it the classifier's summed probability is chosen at which RECALL of the true
neighbours lie in the most probable parts.

Search. Every row of the table is placed in its most probable part. A part of more than CELL rows is dealt over several
cells. A query goes to the cells of its most probable parts, as many as the chosen sum asks for, and is compared there
with every vector; a window by query merges the cells' lists. A task holds one cell of vectors and lets queries stream
past, so no part or query set has to fit in one task. A query carries a bar, the score of its last neighbour among the
sample's rows, and a cell returns only rows that reach it, since its true neighbours do; the sample's own are found as well. If parts tell nothing about neighbours, the chosen sum is 1 and
all parts are searched.

For inner products of vectors of unlike length, vectors and queries get one component more, by which the largest inner
product is the nearest direction. Scores are those of the original vectors in double precision; equal vectors get equal
scores, and ties go to the smaller id.

Defined cases: vectors that are null, zero, empty, or hold a null or non-finite component take no part, nor do rows
without id or of another dimension than most vectors have. A query isn't compared with rows of its own id. Rows that
share an id are candidates each, but equal ones once; as a query the one with the smallest vector counts. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.tables import written

TOP = 20
QUERY_EVERY = 20
SAMPLE, SAMPLE_BYTES = 16_384, 32 << 20
PART_ROWS, MAX_PARTS = 1024, 256  # rows of a part, as long as there are not more than so many parts
CELL = 2048  # rows that a task holds at once
RECALL = 0.96  # of the held-out neighbours
LEAST = (0.3, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.875, 0.9, 0.925, 0.95, 0.96, 0.97, 0.98, 0.99, 0.995, 0.999, 0.9999)
NEIGHBOURS, HIDDEN, EPOCHS, BATCH, RATE = 10, 128, 12, 256, 2e-3


def _usable(batches):
    for batch in batches:
        ids, v = batch.columns
        size = np.where(np.array(v.is_null()), 0, pc.list_value_length(v).fill_null(0).to_numpy())
        x = v.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null component becomes nan
        some = np.flatnonzero(size)
        if len(some):
            starts = np.append(0, np.cumsum(size[some])[:-1])
            fine = np.logical_and.reduceat(np.isfinite(x), starts)
            x = np.where(np.isfinite(x), x, 0)
            most = np.maximum.reduceat(np.abs(x), starts)
            norm = most * np.sqrt(np.add.reduceat((x / np.repeat(np.where(most > 0, most, 1), size[some])) ** 2, starts))
            keep = fine & (most > 0) & ~np.array(ids.is_null())[some]
            at = pa.array(some[keep])
            yield pa.RecordBatch.from_arrays([ids.take(at), v.take(at), pa.array(norm[keep]), pa.array(size[some][keep], pa.int32())], ["vec_id", "v", "norm", "d"])


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v, norm, d) of the vectors that take part, whatever their dimension d."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
    return rows.mapInArrow(_usable, f"vec_id long, v {rows.schema['v'].dataType.simpleString()}, norm double, d int")


def _matrix(column) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _forms(x: np.ndarray, longest: float) -> tuple[np.ndarray, np.ndarray]:
    """The vectors as rows to be found and as queries, of length 1."""
    x = x / longest
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    asked = x / np.where(norm > 0, norm, 1)
    return np.hstack([x, np.sqrt(np.maximum(0, 1 - norm**2))]).astype(np.float32), np.hstack([asked, np.zeros_like(norm)]).astype(np.float32)


# --- fitting (one task, on the sample) ---------------------------------------------------------------------------------


def nearest(asked: np.ndarray, held: np.ndarray, k: int, own: bool) -> np.ndarray:
    """The k nearest rows of held for each query; own: query i is row i and isn't its own neighbour."""
    out = []
    for lo in range(0, len(asked), 1024):
        s = asked[lo : lo + 1024] @ held.T
        if own:
            s[np.arange(len(s)), np.arange(lo, lo + len(s))] = -np.inf
        out.append(np.argpartition(-s, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def _halves(a: np.ndarray, b: np.ndarray, n: int, rng) -> np.ndarray:
    """A cut of the graph into two equal halves; a, b: the ends of each link, in both directions."""
    degree = np.maximum(np.bincount(a, minlength=n), 1)
    v = rng.standard_normal(n)
    for _ in range(40):
        v = 0.5 * v + 0.5 * np.bincount(a, v[b], n) / degree
        v -= (v * degree).sum() / degree.sum()
        v /= np.linalg.norm(v) or 1
    side = np.zeros(n, bool)
    side[np.argsort(v, kind="stable")[n // 2 :]] = True
    cut = int((side[a] != side[b]).sum())
    for _ in range(12):
        across = np.bincount(a, side[a] != side[b], n)
        gain = 2 * across - np.bincount(a, minlength=n)
        left, right = (w[np.argsort(-gain[w], kind="stable")] for w in (np.flatnonzero(~side), np.flatnonzero(side)))
        m = min(len(left), len(right))
        swap = (int((gain[left[:m]] + gain[right[:m]] > 0).sum()) + 1) // 2
        if not swap:
            break
        new = side.copy()
        new[left[:swap]], new[right[:swap]] = True, False
        now = int((new[a] != new[b]).sum())
        if now >= cut:
            break
        side, cut = new, now
    return side


def balanced_parts(neighbours: np.ndarray, parts: int, seed: int = 7) -> np.ndarray:
    """The part of each node: parts (a power of two) of equal size with few links between them."""
    n, k = neighbours.shape
    rng = np.random.default_rng(seed)
    a, b = np.repeat(np.arange(n), k), neighbours.ravel()
    a, b = np.append(a, b), np.append(b, a)
    part = np.zeros(n, np.int64)
    for _ in range(parts.bit_length() - 1):
        new = 2 * part
        inner = part[a] == part[b]
        for p in np.unique(part):
            nodes = np.flatnonzero(part == p)
            at = np.full(n, -1)
            at[nodes] = np.arange(len(nodes))
            links = inner & (part[a] == p)
            new[nodes] += _halves(at[a[links]], at[b[links]], len(nodes), rng)
        part = new
    return part


class Router:
    """Probabilities of the parts for vectors: one hidden layer."""

    def __init__(self, weights: list[np.ndarray]):
        self.w = weights

    def __call__(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.w
        z = np.maximum(x @ w1 + b1, 0) @ w2 + b2
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def cooled(self, t: float) -> Router:
        return Router([*self.w[:2], self.w[2] / np.float32(t), self.w[3] / np.float32(t)])

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, seed: int = 7) -> Router:
        rng = np.random.default_rng(seed)
        wide = lambda n, m: (rng.standard_normal((n, m)) * math.sqrt(2 / n)).astype(np.float32)
        w = [wide(x.shape[1], HIDDEN), np.zeros(HIDDEN, np.float32), wide(HIDDEN, y.shape[1]), np.zeros(y.shape[1], np.float32)]
        first, second, step = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), BATCH):
                xs, ys = x[order[lo : lo + BATCH]], y[order[lo : lo + BATCH]]
                h = np.maximum(xs @ w[0] + w[1], 0)
                z = h @ w[2] + w[3]
                z = np.exp(z - z.max(axis=1, keepdims=True))
                dz = (z / z.sum(axis=1, keepdims=True) - ys) / len(xs)
                dh = (dz @ w[2].T) * (h > 0)
                step += 1
                for i, g in enumerate((xs.T @ dh, dh.sum(0), h.T @ dz, dz.sum(0))):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    w[i] -= RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        return cls(w)


def reach(chances: np.ndarray, least: float) -> np.ndarray:
    """Which parts each query goes to: the most probable ones, until their probabilities sum to least."""
    order = np.argsort(-chances, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(chances, order, 1), axis=1) - np.take_along_axis(chances, order, 1)
    out = np.zeros(chances.shape, bool)
    np.put_along_axis(out, order, before < least, 1)
    return out


def fit_router(x: np.ndarray, longest: float, parts: int, recall: float = RECALL) -> tuple[Router, float]:
    """The router, and the sum of probabilities at which the parts searched hold this share of held-out neighbours."""
    held, asked = _forms(x, longest)
    out = np.arange(len(x)) % 5 == 0  # rows come in hash order
    train = np.flatnonzero(~out)
    k = min(NEIGHBOURS, len(train) - 1)
    near = nearest(asked[train], held[train], k, own=True)
    part = balanced_parts(near, parts)
    shares = np.zeros((len(train), parts), np.float32)
    np.add.at(shares, (np.repeat(np.arange(len(train)), k), part[near.ravel()]), 1 / k)
    own = np.eye(parts, dtype=np.float32)[part]
    router = Router.fit(np.vstack([held[train], asked[train]]), np.vstack([(own + shares) / 2, shares]))
    test = np.flatnonzero(out)
    near = nearest(asked[test], held[test], min(TOP, len(test) - 1), own=True)
    place = router(held[test]).argmax(axis=1)
    # its certainty on vectors that it hasn't seen: the temperature at which their neighbours' parts are likeliest
    router = max((router.cooled(t) for t in (1, 1.5, 2, 3, 4, 6, 8)), key=lambda r: np.log(np.take_along_axis(r(asked[test]), place[near], 1) + 1e-9).sum())
    chances = router(asked[test])
    for least in LEAST:
        if np.take_along_axis(reach(chances, least), place[near], 1).mean() >= recall:
            return router, least
    return router, 2.0


# --- placing and searching ---------------------------------------------------------------------------------------------


def _fit_task(longest: float, parts: int):
    def fit(batches):
        batches = list(batches)
        rows = pa.Table.from_batches(batches) if batches else pa.table({})
        if rows.num_rows >= 4 * TOP:  # else few ids make up the table, and there is one part
            x = _matrix(rows.column("v").combine_chunks())
            router, least = fit_router(x, longest, parts)
            w = [[p.astype("<f4").tobytes() for p in router.w]]
            yield pa.RecordBatch.from_pydict({"least": [least], "w": w, "ids": [rows.column("vec_id").to_numpy().astype("<i8").tobytes()], "x": [x.astype("<f8").tobytes()]})

    return fit


def bars(asked: np.ndarray, ids: np.ndarray, held: np.ndarray, names: np.ndarray, top: int) -> np.ndarray:
    """A score that each query's nearest rows reach at least: that of its last one among the sample's rows."""
    if len(held) <= top:
        return np.full(len(asked), -np.inf)
    out = []
    for lo in range(0, len(asked), 256):
        s = asked[lo : lo + 256] @ held.T
        s[ids[lo : lo + 256, None] == names[None, :]] = -np.inf
        bar = np.partition(s, len(held) - top, axis=1)[:, len(held) - top]
        out.append(bar - 1e-9 * np.maximum(1.0, np.abs(bar)))
    return np.concatenate(out) if out else np.zeros(0)


def _scored(asked: np.ndarray, ids: list, least: np.ndarray, held: np.ndarray, names: np.ndarray, top: int):
    """Per query, its nearest rows of a cell that reach its bar: (query, row id, score), ties to the smaller id."""
    s = asked @ held.T
    for i, q in enumerate(ids):
        row = s[i]
        row[names == q] = -np.inf
        some = np.flatnonzero((row >= least[i]) & (row > -np.inf))
        if len(some) > top:
            bar = np.partition(row[some], len(some) - top)[len(some) - top]
            some = some[row[some] >= bar - 1e-9 * max(1.0, abs(bar))]
        exact = (held[some] * asked[i]).sum(axis=1)  # one order of summing for all rows
        for j in np.lexsort((names[some], -exact))[:top]:
            yield q, int(names[some[j]]), float(exact[j])


def _once(held: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows without repeats of one id and vector."""
    if len(np.unique(names)) < len(names):
        first = sorted({(n, x.tobytes()): i for i, (n, x) in enumerate(zip(names.tolist(), held, strict=True))}.values())
        held, names = held[first], names[first]
    return held, names


_FOUND = "query_id long, vec_id long, score double"


def _found(out: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.float64()), strict=True)], ["query_id", "vec_id", "score"])


def _search(top: int):
    def search(batches):
        cell, held, names, fixed = None, [], [], None
        for batch in batches:
            cells, queries = batch.column("cell").to_numpy(), batch.column("query").to_numpy(zero_copy_only=False)
            vectors, ids, least = _matrix(batch.column("v")), batch.column("vec_id").to_numpy(), batch.column("bar").to_numpy(zero_copy_only=False)
            out = []
            cuts = np.flatnonzero(np.append(True, (cells[1:] != cells[:-1]) | (queries[1:] != queries[:-1])))
            for lo, hi in zip(cuts, [*cuts[1:], len(cells)], strict=True):
                if cells[lo] != cell:
                    cell, held, names, fixed = cells[lo], [], [], None
                if not queries[lo]:
                    held.append(vectors[lo:hi])
                    names.append(ids[lo:hi])
                elif held:
                    fixed = fixed or _once(np.concatenate(held), np.concatenate(names))
                    for a in range(lo, hi, 256):
                        own = slice(a, min(a + 256, hi))
                        out.extend(_scored(vectors[own], ids[own].tolist(), least[own], *fixed, top))
            if out:
                yield _found(out)

    return search


def learned_ann(vectors: DataFrame, every: int = QUERY_EVERY, top: int = TOP, part_rows: int = PART_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row whose id divides by every, its nearest other rows."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    kinds = rows.groupBy("d").agg(F.count("*").alias("n"), F.max("norm").alias("longest"))
    kind = kinds.orderBy(F.col("n").desc(), F.col("d").desc()).first()
    if kind is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.filter(F.col("d") == kind.d).select("vec_id", "v")
    parts = min(MAX_PARTS, 1 << max(0, round(math.log2(kind.n / part_rows))))
    router, least, known = None, 2.0, (np.zeros((0, kind.d)), np.zeros(0, np.int64))
    if parts > 1:
        most = min(SAMPLE, SAMPLE_BYTES // (8 * kind.d))
        share = min(1.0, 1.1 * most / kind.n)
        mark = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 40))
        sample = rows.filter(mark <= int(share * (1 << 40))).groupBy("vec_id").agg(F.min("v").alias("v")).orderBy(mark, "vec_id").limit(most)
        sample = written(sample, "sample").coalesce(1).sortWithinPartitions(mark, "vec_id")
        fitted = sample.mapInArrow(_fit_task(kind.longest, parts), "least double, w array<binary>, ids binary, x binary").first()
        if fitted:
            w1, b1, w2, b2 = (np.frombuffer(bytes(w), "<f4") for w in fitted.w)
            router, least = Router([w1.reshape(-1, HIDDEN), b1, w2.reshape(HIDDEN, -1), b2]), fitted.least
            known = np.frombuffer(bytes(fitted.x), "<f8").reshape(-1, kind.d), np.frombuffer(bytes(fitted.ids), "<i8")
    shared = spark.sparkContext.broadcast(known)  # at most SAMPLE_BYTES
    longest = kind.longest

    def place(batches):
        n = 0
        for batch in batches:
            if batch.num_rows:
                p = router(_forms(_matrix(batch.column("v")), longest)[0]).argmax(axis=1) if router else np.zeros(batch.num_rows, np.int64)
                salt = np.arange(n, n + batch.num_rows)
                n += batch.num_rows
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(salt, pa.int64()), *batch.columns], ["part", "salt", "vec_id", "v"])

    def route(batches):
        for batch in batches:
            if batch.num_rows:
                x = _forms(_matrix(batch.column("v")), longest)[1]
                bar = bars(_matrix(batch.column("v")), batch.column("vec_id").to_numpy(), *shared.value, top)
                who, p = np.nonzero(reach(router(x), least)) if router else (np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), *batch.take(pa.array(who)).columns, pa.array(bar[who])], ["part", "vec_id", "v", "bar"])

    def seeds(batches):
        held, names = shared.value
        for batch in batches:
            x, ids = _matrix(batch.column("v")) if batch.num_rows else (), batch.column("vec_id").to_numpy()
            for lo in range(0, len(x), 256):
                out = list(_scored(x[lo : lo + 256], ids[lo : lo + 256].tolist(), np.full(256, -np.inf), held, names, top)) if len(held) else []
                if out:
                    yield _found(out)

    of = rows.schema["v"].dataType.simpleString()
    placed = written(rows.mapInArrow(place, f"part int, salt long, vec_id long, v {of}"), "placed")
    cells = placed.groupBy("part").agg(F.ceil(F.count("*") / CELL).alias("cells"))  # a row per part
    number = F.col("part") + MAX_PARTS * F.col("k")
    held = placed.join(F.broadcast(cells), "part").withColumn("k", F.pmod(F.xxhash64("salt"), "cells"))
    held = held.select(number.alias("cell"), F.lit(False).alias("query"), "vec_id", "v", F.lit(0.0).alias("bar"))
    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = queries.mapInArrow(route, f"part int, vec_id long, v {of}, bar double").join(F.broadcast(cells), "part")
    asked = asked.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1))).select(number.alias("cell"), F.lit(True).alias("query"), "vec_id", "v", "bar")
    stream = held.unionByName(asked).repartition("cell").sortWithinPartitions("cell", "query")
    near = stream.mapInArrow(_search(top), _FOUND).unionByName(queries.mapInArrow(seeds, _FOUND))  # the sample's rows were compared, too
    near = near.repartition("query_id").dropDuplicates(["query_id", "vec_id", "score"])
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return near.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")


def op12_learned_ann(spark, sf_dir):
    """Registered query: the 20 nearest rows of embeddings for every row whose id divides by 20."""
    return learned_ann(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
