"""Latent-semantic vectors: hashed TF-IDF and a distributed randomised singular value decomposition.

Terms are hashed into a fixed number of columns, so every table here has a bound that does not depend on the corpus: document
frequencies are TERMS numbers, the sketch is TERMS x (rank + extra). Tasks add up their own share; Spark adds the
shares; the driver only factors the small sums (a QR of the sketch and an eigendecomposition of rank x rank). With `kept`
the texts are read once: their terms and weights are written to a table, one row each, which the passes read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import words as W
from ledgerlake.llm.tables import discard, written

TERMS = 1 << 15
CHUNK = 1 << 10
ROWS = 1 << 12
EXTRA = 8

# (rows in the block, row of each entry, term, weight); entries sorted by row, terms distinct within a row
Sparse = tuple[int, np.ndarray, np.ndarray, np.ndarray]


@dataclass
class Space:
    """idf of each term, and the idf-weighted right singular vectors (TERMS x rank)."""

    idf: np.ndarray
    vectors: np.ndarray

    def place(self, m: Sparse) -> np.ndarray:
        """Unit vectors of the rows (zero for rows without terms)."""
        return unit(sums_by_row(m, self.vectors))


def unit(x: np.ndarray) -> np.ndarray:
    n = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.maximum(n, 1e-12)


def counted_rows(row: np.ndarray, term: np.ndarray, rows: int) -> Sparse:
    """Distinct (row, term) with 1 + ln(count) as weight."""
    key, n = W.counted(row.astype(np.uint64) * np.uint64(TERMS) + term.astype(np.uint64))
    return rows, (key // np.uint64(TERMS)).astype(np.int64), (key % np.uint64(TERMS)).astype(np.int64), (1 + np.log(n)).astype(np.float32)


def sums_by_row(m: Sparse, table: np.ndarray) -> np.ndarray:
    rows, row, term, weight = m
    out = np.zeros((rows, table.shape[1]), np.float32)
    if len(row):
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        out[row[first]] = np.add.reduceat(table[term] * weight[:, None], first, axis=0)
    return out


def _add_by_term(z: np.ndarray, m: Sparse, y: np.ndarray) -> None:
    _, row, term, weight = m
    if len(row):
        o = np.argsort(term, kind="stable")
        t = term[o]
        first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        z[t[first]] += np.add.reduceat(y[row[o]] * weight[o][:, None], first, axis=0)


def _sums(key: np.ndarray, keys: int, table: np.ndarray, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Per key, the sum of table[at] * weight. Column by column, so that each stays in the cache."""
    columns = np.ascontiguousarray(table.T)
    return np.stack([np.bincount(key, c[at] * weight, minlength=keys) for c in columns]).T


def _normal(m: Sparse, idf: np.ndarray) -> Sparse:
    rows, row, term, weight = m
    w = weight * idf[term]
    norm = np.sqrt(np.bincount(row, w * w, minlength=rows))
    return rows, row, term, (w / np.maximum(norm[row], 1e-12)).astype(np.float32)


def _packed(m: Sparse) -> pa.RecordBatch:
    """The rows, each with its terms (16 bits each) and weights as bytes."""
    rows, row, term, weight = m
    first = np.searchsorted(row, np.arange(rows + 1))
    data = [(2, term.astype("<u2")), (4, weight.astype("<f4"))]
    columns = [pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer((first * k).astype(np.int32)), pa.py_buffer(x)]) for k, x in data]
    return pa.RecordBatch.from_arrays(columns, ["t", "w"])


def _unpacked(batches) -> Iterator[Sparse]:
    """The rows of _packed(), a bounded number at once."""
    for batch in batches:
        for k in range(0, batch.num_rows, ROWS):
            part = batch.slice(k, ROWS)
            sizes, out = None, []
            for col, kind in zip(part.columns, ("<u2", "<f4"), strict=True):
                _, off, data = col.buffers()
                off = np.frombuffer(off, np.int32)[col.offset : col.offset + len(col) + 1]
                item = np.dtype(kind).itemsize
                out.append(np.frombuffer(data, np.uint8)[off[0] : off[-1]].view(kind) if off[-1] > off[0] else np.zeros(0, kind))
                sizes = np.diff(off) // item
            yield len(part), np.repeat(np.arange(len(part)), sizes), out[0].astype(np.int64), out[1]


def latent_space(texts: DataFrame, features: Callable[[W.Block], Iterator[Sparse]], rank: int, kept: bool = False) -> Space:
    """Randomised SVD over the rows that `features` makes of the first column of texts. One power step.

    kept: by way of a table of terms, and with sums by column. This takes about half the time and rounds differently.
    """
    spark = texts.sparkSession
    wide = rank + EXTRA

    def made(batches):
        for batch in batches:
            for block in W.blocks(batch.column(0)):
                yield from features(block)

    source, rows_of, order, sums, add = texts, made, np.asarray, sums_by_row, _add_by_term
    if kept:
        source = written(texts.mapInArrow(lambda batches: map(_packed, made(batches)), "t binary, w binary"), "terms")
        rows_of, order = _unpacked, np.asfortranarray

        def sums(m, table):
            return np.ascontiguousarray(_sums(m[1], m[0], table, m[2], m[3]), np.float32)

        def add(z, m, y):
            z += _sums(m[2], TERMS, y, m[1], m[3])

    def frequencies(batches):
        total = np.zeros(TERMS + 1, np.int64)
        for rows, _, term, _ in rows_of(batches):
            total[:TERMS] += np.bincount(term, minlength=TERMS)
            total[TERMS] += rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["k", "n"])

    got = source.mapInArrow(frequencies, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(TERMS + 1)
    df[got["k"].to_numpy(np.int64)] = got["n"].to_numpy(np.float64)
    idf = np.log((1 + df[TERMS]) / (1 + df[:TERMS])).astype(np.float32) + np.float32(0.1)
    omega = np.random.Generator(np.random.PCG64(7)).standard_normal((TERMS, wide)).astype(np.float32)

    def sketch(table):
        def run(batches):
            idf, omega = table.value
            z = np.zeros((TERMS, wide), np.float64, order="F" if kept else "C")
            for m in rows_of(batches):
                m = _normal(m, idf)
                add(z, m, sums(m, omega))
            for k in range(0, TERMS, CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array([k // CHUNK], pa.int32()), pa.array([z[k : k + CHUNK].astype("<f4").tobytes()])], ["k", "z"])

        return run

    def added(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, z in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a = np.frombuffer(z, "<f4").astype(np.float64)
                total[k] = total[k] + a if k in total else a
        for k, a in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([a.astype("<f4").tobytes()])], ["k", "z"])

    table = spark.sparkContext.broadcast((idf, order(omega)))
    parts = source.mapInArrow(sketch(table), "k int, z binary").repartition(TERMS // CHUNK, "k").mapInArrow(added, "k int, z binary").collect()
    z = np.zeros((TERMS, wide), np.float64)
    for r in parts:
        z[r["k"] * CHUNK : (r["k"] + 1) * CHUNK] = np.frombuffer(r["z"], "<f4").reshape(CHUNK, wide)
    q = np.linalg.qr(z)[0].astype(np.float32)
    table = spark.sparkContext.broadcast((idf, order(q)))

    def gram(batches):
        idf, q = table.value
        g = np.zeros((wide, wide))
        for m in rows_of(batches):
            y = sums(_normal(m, idf), q).astype(np.float64)
            g += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(wide * wide)), pa.array(g.ravel())], ["k", "v"])

    got = source.mapInArrow(gram, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).toPandas()
    if kept:
        discard(source)
    g = np.zeros(wide * wide)
    g[got["k"].to_numpy(np.int64)] = got["v"].to_numpy(np.float64)
    g = g.reshape(wide, wide)
    vectors = q @ np.linalg.eigh((g + g.T) / 2)[1][:, ::-1][:, :rank].astype(np.float32)
    return Space(idf, np.ascontiguousarray(vectors * idf[:, None]))
