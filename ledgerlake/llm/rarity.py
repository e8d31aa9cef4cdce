"""A bounded table of the most frequent n-grams and words, by which the set joins order their tokens.

Any total order of tokens gives the same join result; a good one keeps frequent tokens out of the prefixes.
Each task sends a bounded summary of what it counted (its most frequent entries), so the shuffle and the
broadcast table have fixed bounds: at most `keep` entries of 16 bytes each for n-grams and for words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import words as W

KEEP = 32_768


@dataclass
class Rarity:
    """Frequent n-grams and words, sorted by hash, with a rank that grows with the count (1 and up)."""

    grams: np.ndarray
    gram_rank: np.ndarray
    words: np.ndarray
    word_rank: np.ndarray

    def of_words(self, h: np.ndarray) -> np.ndarray:
        return _lookup(self.words, self.word_rank, h)

    def ranks(self, grams: np.ndarray) -> np.ndarray:
        return _lookup(self.grams, self.gram_rank, grams)

    def order(self, grams: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Positions of distinct n-grams from rarest to most frequent; ties go by hash. scores: from the words."""
        return np.lexsort((grams, scores, self.ranks(grams)))


def _lookup(keys: np.ndarray, values: np.ndarray, h: np.ndarray) -> np.ndarray:
    if len(keys) == 0:
        return np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where(keys[at] == h, values[at], 0)


def word_scores(r: Rarity, h: np.ndarray, n: int) -> np.ndarray:
    """For each n-gram of consecutive words: the sum of log2 of the words' ranks, a measure of how common they are."""
    s = np.log2(1 + r.of_words(h)).astype(np.float32)
    out = s[: len(h) - n + 1].copy()
    for k in range(1, n):
        out += s[k : len(h) - n + 1 + k]
    return np.round(out * 16).astype(np.int32)


def rarity(docs: DataFrame, n: int, by_line: bool = False, with_words: bool = True, keep: int = KEEP) -> Rarity:
    """Counts all texts; see the module's text for the bounds."""

    def count(batches):
        held = {0: [], 1: []}
        size = 0

        def fold():
            for kind, parts in held.items():
                if parts:
                    k = np.concatenate([p[0] for p in parts])
                    c = np.concatenate([p[1] for p in parts])
                    o = np.argsort(k, kind="stable")
                    k, c = k[o], c[o]
                    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, int)
                    held[kind] = [(k[at], np.add.reduceat(c, at) if len(k) else c)]

        for batch in batches:
            for block in W.blocks(batch.column(0)):
                h, starts, _, first = W.words(block, True)
                if by_line:
                    first = np.searchsorted(starts, np.append(np.flatnonzero(block.data == 10), [len(block.data)]))
                    first = np.unique(np.concatenate([[0], first, np.searchsorted(starts, block.offsets)]))
                grams = W.ngrams(h, n)
                if len(grams):
                    # windows that would cross the end of a row or line are left out
                    room = np.repeat(first[1:], np.diff(first))[: len(grams)] - np.arange(len(grams))
                    grams = grams[room >= n]
                if with_words:
                    held[0].append(W.counted(h))
                g, c = W.counted(grams)
                held[1].append((g[c > 1], c[c > 1]))
                size += len(h)
                if size > 1 << 21:
                    fold()
                    size = 0
                    for kind, parts in held.items():
                        if not parts:
                            continue
                        k, c = parts[0]
                        if len(k) > 8 * keep:
                            top = np.sort(np.argpartition(-c, 8 * keep)[: 8 * keep])
                            held[kind] = [(k[top], c[top])]
        fold()
        for kind, parts in held.items():
            if parts and len(parts[0][0]):
                k, c = parts[0]
                k, c = k[c > 1], c[c > 1]
                top = np.argsort(-c, kind="stable")[:keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(top), kind, np.int32)), pa.array(k[top].view(np.int64)), pa.array(c[top])],
                    ["kind", "h", "n"],
                )

    sums = docs.select("text").mapInArrow(count, "kind int, h long, n long").groupBy("kind", "h").agg(F.sum("n").alias("n"))
    ranked = sums.withColumn("r", F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("n"), "h")))
    top = ranked.filter(F.col("r") <= keep).select("kind", "h", "n").toPandas()
    out = []
    for kind in (1, 0):
        mine = top[top["kind"] == kind]
        k = mine["h"].to_numpy(np.int64).view(np.uint64)
        rank = np.argsort(np.lexsort((k, mine["n"].to_numpy())), kind="stable") + 1
        o = np.argsort(k)
        out += [k[o], rank[o].astype(np.int64)]
    return Rarity(*out)
