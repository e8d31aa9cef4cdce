"""Quality by nearest-neighbour voting in a latent-semantic space.

Each text is a vector of hashed words, word shapes (letter case, digits and marks, runs of letters as one)
and repeated words, weighted by TF-IDF and projected by a randomised SVD. The labelled vectors are broadcast: at most SAMPLE rows, those with the smallest
hash of doc_id, a documented bound of the classifier's fit (SAMPLE x RANK x 4 bytes = 4 MB). The latent space is
fitted on these rows. Every text is compared exactly with all of them in blocks; its NEIGHBOURS nearest vote with the
fourth power of their cosine.

Defined cases. Null and empty texts have no direction: they get the share of label 1 among the labelled rows. With no
labelled rows every score is 0.5. Labels whose value is null, and labelled rows with a null id, are left out; a doc_id
labelled more than once counts once for each label. Null ids and repeated rows are scored and kept. An empty table
gives an empty table. Only the id and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import words as W
from ledgerlake.llm.latent import TERMS, Sparse, counted_rows, latent_space
from ledgerlake.llm.tables import written

SAMPLE = 16_384
RANK = 64
NEIGHBOURS = 25
BLOCK = 256

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("9")
_SHAPE[128:] = ord("a")
_RUN = np.zeros(256, bool)
_RUN[[ord("a"), ord("A"), ord("9")]] = True


def shapes(block: W.Block) -> W.Block:
    """The block with every run of small letters, capitals or digits as one character."""
    s = _SHAPE[block.data]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != s[:-1]) | ~_RUN[s[1:]]
    keep[block.offsets[:-1][block.offsets[:-1] < len(s)]] = True
    return W.Block(block.first, s[keep], np.concatenate([[0], np.cumsum(keep)])[block.offsets])


def text_features(block: W.Block):
    """One row for each text: hashed words in the lower half of the terms, hashed shapes in the upper.

    The last terms stand for the share of words that equal the word before, in tenths; texts under a tenth have none.
    """
    half, shaped = np.uint64(TERMS // 2), np.uint64(TERMS // 2 - 11)
    h, _, _, first = W.words(block, True)
    s, _, _, sfirst = W.words(shapes(block), False)
    of = W.row_of(first)
    again = of[1:][(h[1:] == h[:-1]) & (of[1:] == of[:-1])]
    tenths = 10 * np.bincount(again, minlength=block.rows) // np.maximum(np.diff(first), 1)
    again = again[tenths[again] > 0]
    row = np.concatenate([of, W.row_of(sfirst), again])
    yield counted_rows(row, np.concatenate([h % half, s % shaped + half, (TERMS - 11 + tenths[again]).astype(np.uint64)]), block.rows)


def _score(table, k: int):
    def run(batches):
        space, vectors, labels = table.value
        share = float(labels.mean()) if len(labels) else 0.5
        k_ = min(k, len(labels))
        for batch in batches:
            for block in W.blocks(batch.column(1)):
                m: Sparse = next(text_features(block))
                x = space.place(m)
                out = np.full(block.rows, share)
                for lo in range(0, block.rows if k_ else 0, BLOCK):
                    c = x[lo : lo + BLOCK] @ vectors.T
                    top = np.argpartition(-c, k_ - 1, axis=1)[:, :k_]
                    w = np.maximum(np.take_along_axis(c, top, 1), 0).astype(np.float64) ** 4
                    total = w.sum(1)
                    vote = (w * labels[top]).sum(1) / np.maximum(total, 1e-300)
                    out[lo : lo + BLOCK] = np.where(total > 0, vote, share)
                out[np.diff(block.offsets) == 0] = share
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.rows), pa.array(np.clip(out, 0, 1))], ["d", "score"])

    return run


def _vectors(table):
    def run(batches):
        for batch in batches:
            for block in W.blocks(batch.column(0)):
                x = table.value.place(next(text_features(block)))
                labels = batch.column(1).slice(block.first, block.rows)
                yield pa.RecordBatch.from_arrays([labels, pa.array([v.astype("<f4").tobytes() for v in x], pa.binary())], ["label", "v"])

    return run


def neighbour_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, k: int = NEIGHBOURS) -> DataFrame:
    """Returns (doc_id, score): how far the nearest labelled texts carry label 1. labels: the rows to learn from."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("text"))
    chosen = labels.select(F.col(id_col).cast("long").alias("d"), F.col(label_col).cast("double").alias("label")).dropna()
    # the bound holds on both sides of the join: at most `sample` labels, and as many of the rows that match them
    order = [F.xxhash64("d"), "d", "label"]
    chosen = chosen.orderBy(*order).limit(sample)
    known = written(rows.join(chosen, "d").orderBy(*order).limit(sample).select("text", "label"), "labelled")
    known = known.repartition(sc.defaultParallelism)
    space = latent_space(known, text_features, RANK)
    table = sc.broadcast(space)
    got = known.mapInArrow(_vectors(table), "label double, v binary").toPandas()
    vectors = np.frombuffer(b"".join(map(bytes, got["v"])), "<f4").reshape(-1, RANK) if len(got) else np.zeros((0, RANK), np.float32)
    table = sc.broadcast((space, np.ascontiguousarray(vectors), got["label"].to_numpy(np.float64)))
    return rows.mapInArrow(_score(table, k), "d long, score double").withColumnRenamed("d", id_col)


def op3_neighbour_quality(spark, sf_dir):
    """Registered query: learns from labels whose crc32(doc_id) mod 5 is not 0, scores all documents."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~fold)
    out = neighbour_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
    return out.select("doc_id", F.coalesce(fold, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
