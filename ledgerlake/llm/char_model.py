"""Modified Kneser-Ney over character 5-grams, counted by Spark for each language, and texts scored by it.

Characters are code points as written: no case folding, no classes, no cap on the alphabet. Texts fall into two halves
by a hash of their text, and each text is scored by the model of the other half of its language, so neither it nor an exact copy of it
can vouch for itself. Tasks fold the 5-grams of their texts before they are sent, Spark sums them by key, and the lower
orders, discounts, backoff weights and probabilities are grouped and joined tables keyed by n-gram, of any size.

Scores are stored with a 64-bit hash of the n-gram. The most frequent ones (about FREQUENT rows, 16 MB) go to every task
as a hash array sorted for binary search; all others are joined with the texts' n-grams, so none is left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import words as W
from ledgerlake.llm.tables import written

ORDER = 5
FREQUENT = 1 << 20
HELD = 1 << 19  # different 5-grams that a task holds before it sends them on
BLOCK = 1 << 18  # bytes of text at a time: the arrays of a block take over a hundred times its bytes
MICRO = 1_000_000  # log10 probabilities are summed as whole millionths, so that no order of rows changes a sum
_CHAR = (1 << 21) - 1
_BEFORE = 10  # what stands before a text: a line end
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def characters(block: W.Block) -> tuple[np.ndarray, np.ndarray]:
    """The code points of a block, and where each row begins among them."""
    data = block.data
    start = (data & 0xC0) != 0x80
    start[block.offsets[:-1][np.diff(block.offsets) > 0]] = True
    at = np.flatnonzero(start)
    size = np.minimum(np.diff(np.append(at, len(data))), 4)
    first = data[at].astype(np.int64)
    out = np.where(size > 1, first & (0x7F >> size), first)
    for k in range(1, 4):
        more = np.flatnonzero(size > k)
        out[more] = (out[more] << 6) | (data[at[more] + k] & 0x3F)
    return out & _CHAR, np.searchsorted(at, block.offsets)


def grams(c: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 5-gram that ends at each character as two numbers: its first two characters, and its last three."""
    place = np.arange(len(c)) - np.repeat(offsets[:-1], np.diff(offsets))

    def back(k):
        out = np.full(len(c), _BEFORE, np.int64)
        out[k:] = c[: len(c) - k]
        out[place < k] = _BEFORE
        return out

    return (back(4) << 21) | back(3), (back(2) << 42) | (back(1) << 21) | c


def gram_hash(lang: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    return W.mix(lang.view(np.uint64) + _FIRST * W.mix(hi.view(np.uint64) + _SECOND * W.mix(lo.view(np.uint64))))


def half(block: W.Block) -> np.ndarray:
    """0 or 1 for each row, by its text."""
    return (W.span_hashes(block.data, block.offsets[:-1], block.offsets[1:]) >> np.uint64(17) & np.uint64(1)).astype(np.int64)


def _folded(parts):
    """The arrays (hash, lang, hi, lo, n0, n1) with one row for each hash."""
    parts = list(zip(*parts, strict=True))
    h = np.concatenate(parts[0])
    o = np.argsort(h)
    h = h[o]
    first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    at = o[first]
    # one column after the other, so that only one is there twice
    out = [h[first], *(np.concatenate(x)[at] for x in parts[1:4])]
    return *out, *(np.add.reduceat(np.concatenate(x)[o], first) if len(h) else np.concatenate(x) for x in parts[4:])


def _count(batches):
    names = ["l", "hi", "lo", "n0", "n1"]
    held, size = [], 0
    for batch in batches:
        lang = batch.column(1).to_numpy()
        for block in W.blocks(batch.column(0), BLOCK):
            c, offsets = characters(block)
            hi, lo = grams(c, offsets)
            row = np.repeat(np.arange(block.rows), np.diff(offsets))
            of, second = lang[block.first + row], half(block)[row]
            held.append(_folded([(gram_hash(of, hi, lo), of, hi, lo, 1 - second, second)]))
            size += len(held[-1][0])
            if size > HELD:
                held = [_folded(held)]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0][1:]], names)
                    held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _folded(held)[1:]], names)


def _hashed(batches):
    for batch in batches:
        lang, hi, lo = (batch.column(k).to_numpy() for k in range(3))
        h = gram_hash(lang, hi, lo).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(h), *batch.columns[3:]], ["h", "n", "q0", "q1"])


def _context() -> list[Column]:
    """A gram's key without its last character."""
    return [F.expr("shiftright(hi, 21)").alias("hi"), F.expr(f"shiftleft(hi & {_CHAR}L, 42) | shiftright(lo, 21)").alias("lo")]


def _suffix(order: int) -> list[Column]:
    """The key of a gram of this order without its first character."""
    if order == 5:
        return [F.expr(f"hi & {_CHAR}L").alias("hi"), F.col("lo")]
    keep = {4: (1 << 63) - 1, 3: (1 << 42) - 1, 2: _CHAR}[order]
    return [F.lit(0).cast("long").alias("hi"), F.expr(f"lo & {keep}L").alias("lo")]


def _discounts(f: int) -> list[Column]:
    """d1, d2, d3 of the modified Kneser-Ney method for half f, from the numbers of n-grams seen 1 to 4 times."""
    n1, n2, n3, n4 = (F.greatest(F.lit(1), F.count_if(F.col(f"n{f}") == k)) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    raw = [(1 - 2 * y * n2 / n1, 0.9), (2 - 3 * y * n3 / n2, 1.9), (3 - 4 * y * n4 / n3, 2.9)]
    return [F.least(F.greatest(d, F.lit(0.1)), F.lit(top)).alias(f"d{f}{k}") for k, (d, top) in enumerate(raw, 1)]


def _probabilities(counts: DataFrame) -> DataFrame:
    """(l, hi, lo, n, q0, q1): for each 5-gram its count, and its log10 probability in each half's model."""
    level = {ORDER: counts}
    for o in range(ORDER - 1, 0, -1):  # lower orders count the different characters that come before
        key = ["l", *_suffix(o + 1)]
        level[o] = written(level[o + 1].groupBy(*key).agg(F.count_if(F.col("n0") > 0).alias("n0"), F.count_if(F.col("n1") > 0).alias("n1")), "grams")
    parts = [level[o].groupBy("l").agg(F.lit(o).alias("o"), F.count("*").alias("v"), *_discounts(0), *_discounts(1)) for o in level]
    table = parts[0]
    for t in parts[1:]:
        table = table.unionAll(t)
    table = written(table.coalesce(1), "discounts")  # five rows a language

    below = table.filter("o = 1").select("l", *[(1 / (F.col("v") + 1)).alias(f"b{f}") for f in (0, 1)])
    for o in range(1, ORDER + 1):
        here, d = level[o], table.filter(F.col("o") == o).drop("o", "v")
        seen = [F.count_if(F.col(f"n{f}") == k).alias(f"k{f}{k}") for f in (0, 1) for k in (1, 2)]
        seen += [F.count_if(F.col(f"n{f}") > 2).alias(f"k{f}3") for f in (0, 1)]
        key = ["l", *[c.alias("c_" + n) for c, n in zip(_context(), ("hi", "lo"), strict=True)]]
        contexts = here.groupBy(*key).agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"), *seen)
        rows = here.select("*", *key[1:]).join(contexts, ["l", "c_hi", "c_lo"]).join(d, "l")
        if o == 1:
            rows = rows.join(below, "l")
        else:
            rows = rows.select("*", *[c.alias("s_" + n) for c, n in zip(_suffix(o), ("hi", "lo"), strict=True)])
            rows = rows.join(below.withColumnsRenamed({"hi": "s_hi", "lo": "s_lo"}), ["l", "s_hi", "s_lo"])
        p = []
        for f in (0, 1):
            n, t, b = F.col(f"n{f}"), F.col(f"t{f}"), F.col(f"b{f}")
            less = F.when(n == 0, 0.0).when(n == 1, F.col(f"d{f}1")).when(n == 2, F.col(f"d{f}2")).otherwise(F.col(f"d{f}3"))
            mass = sum((F.col(f"d{f}{k}") * F.col(f"k{f}{k}") for k in (2, 3)), F.col(f"d{f}1") * F.col(f"k{f}1"))
            p.append(F.when(t > 0, (n - less + mass * b) / t).otherwise(b).alias(f"p{f}"))
        if o == ORDER:
            return rows.select("l", "hi", "lo", (F.col("n0") + F.col("n1")).alias("n"), *[F.log10(x).cast("float").alias(f"q{f}") for f, x in enumerate(p)])
        below = rows.select("l", "hi", "lo", *[x.alias(f"b{f}") for f, x in enumerate(p)])
    raise AssertionError


class Scores:
    """The frequent n-grams' scores in an array sorted by hash."""

    def __init__(self, t: pa.Table):
        h = t.column("h").to_numpy().view(np.uint64)
        o = np.argsort(h)
        self.h, self.q = h[o], np.stack([t.column(q).to_numpy()[o] for q in ("q0", "q1")])

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.h):
            return np.zeros(len(h), bool), np.zeros((2, len(h)), np.float32)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        return self.h[at] == h, self.q[:, at]


def fit(texts: DataFrame, frequent: int = FREQUENT) -> tuple[Scores, DataFrame]:
    """The model of texts(text string, l long): the frequent n-grams' scores, and a table (h, q0, q1) of all others."""
    counts = texts.select("text", "l").mapInArrow(_count, "l long, hi long, lo long, n0 long, n1 long")
    counts = written(counts.groupBy("l", "hi", "lo").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")), "grams")
    scores = written(_probabilities(counts).mapInArrow(_hashed, "h long, n long, q0 float, q1 float"), "scores")
    kinds = scores.count()
    least = 0
    if kinds > frequent:  # the rest is joined instead
        least = scores.select(F.percentile_approx("n", 1 - frequent / kinds, 100_000)).first()[0]
    top = Scores(scores.filter(F.col("n") > least).select("h", "q0", "q1").toArrow())
    return top, scores.filter(F.col("n") <= least).select("h", "q0", "q1")


def score_block(top: Scores, block: W.Block, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Per row: number of characters, the frequent n-grams' log10 probabilities in millionths, the other n-grams, the half."""
    c, offsets = characters(block)
    size = np.diff(offsets)
    row = np.repeat(np.arange(block.rows), size)
    kinds, back = np.unique(gram_hash(lang[row], *grams(c, offsets)), return_inverse=True)
    have, q = top.find(kinds)
    side = half(block)
    value = np.round(np.where(have, q, 0) * MICRO).astype(np.int64)[1 - side[row], back]
    total = np.concatenate([[0], np.cumsum(value)])
    rare = ~have[back]
    lens = np.concatenate([[0], np.cumsum(np.bincount(row[rare], minlength=block.rows))])
    lists = pa.ListArray.from_arrays(pa.array(lens.astype(np.int32)), pa.array(kinds[back[rare]].view(np.int64)))
    return size, total[offsets[1:]] - total[offsets[:-1]], lists, side


def row_keys():
    """Numbers for a task's rows that no other task uses; the same again if the task is repeated."""
    n = TaskContext.get().partitionId() << 40
    while True:
        k = yield
        yield np.arange(n, n + k)
        n += k


def rare_sums(scored: DataFrame, rest: DataFrame, key: str, rare: str, side: str) -> DataFrame:
    """(key, more): the scores of the n-grams in the lists `rare`, in millionths, summed by row."""
    each = scored.select(key, side, F.explode(rare).alias("h")).join(rest, "h")
    q = F.when(F.col(side) == 0, F.col("q1")).otherwise(F.col("q0"))
    return each.groupBy(key).agg(F.sum(F.round(q.cast("double") * MICRO).cast("long")).alias("more"))
