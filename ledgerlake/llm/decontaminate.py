"""Benchmark decontamination by latent semantic retrieval.

Method. Texts are cut into passages; a distributed randomised SVD of their TF-IDF gives a latent space of RANK
dimensions. Windows of WINDOW words (every STEP-th start) of all documents and all windows of the benchmark items are
placed in it; as placing is linear, a window's vector is a sum over its words. A window is looked up for the items
that have at least SHARED of its words (a text that the checks below accept has such a window), and is a candidate
for those of them that have a window with cosine COSINE or more. Candidates are checked by the longest common
subsequence of words between the item and the document around the window: a leak shares LCS of the item's words in
order; or LCS_WITH_ANSWER of them, if also ANSWER of the item's answer, its last sentence, is there in order.

Scale. One pass over the documents for each step; only the term table (bounded, see latent.py) and the benchmark
are sent to the tasks, the benchmark in blocks of at most ITEMS_AT_ONCE items and WORDS_AT_ONCE words, however large it
is; an item longer than that is searched by itself. No document leaves its task.

Defined cases. Null and empty texts, and items without words, match nothing. Items of fewer than MIN_ITEM words are
matched only as whole windows of that many words. Null ids come back as null. Rows and items that repeat are reported
once per distinct (document, item). Empty tables give an empty result. Only the id and text columns are read, so
further columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import words as W
from ledgerlake.llm.latent import TERMS, Space, counted_rows, latent_space, unit
from ledgerlake.llm.tables import written

RANK = 32
PASSAGE = 128
WINDOW = 12
STEP = 4
SHARED = 7
COSINE = 0.8
LCS = 0.75
LCS_WITH_ANSWER = 0.55
ANSWER = 0.75
ITEMS_AT_ONCE = 2_000
WORDS_AT_ONCE = 200_000
PAIRS_AT_ONCE = 1 << 20
SPAN_WORDS = 1 << 18
FOUND = "d long, i long, cosine double, lcs double, answer double, start long"


def _hashes(block: W.Block) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with marks around the words left out (so that 'end.' is 'end'), and each row's first word."""
    data = W.lower_ascii(block.data)
    inside = ~W.SPACE[data] & ~_MARK[data]
    starts, ends, first = W.spans(inside, block.offsets)
    return W.span_hashes(data, starts, ends), first


_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?\"'()[]{}<>*#$%&|-_")] = True


def passage_features(block: W.Block):
    """Passages of PASSAGE words as rows, their hashed words as terms."""
    h, first = _hashes(block)
    row = W.row_of(first)
    place = np.arange(len(h)) - first[row]
    begin = np.cumsum(place % PASSAGE == 0) - 1
    yield counted_rows(begin, h % np.uint64(TERMS), int(begin[-1]) + 1 if len(begin) else 0)


def places(a: list[int]) -> dict[int, int]:
    """For each word of a: the bits of its places."""
    at: dict[int, int] = {}
    for k, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << k
    return at


def lcs_at(at: dict[int, int], n: int, b: list[int]) -> int:
    """Length of the longest common subsequence of b and n words, given by their places; by bit rows."""
    full = (1 << n) - 1
    v = full
    for x in b:
        m = at.get(x)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence."""
    return lcs_at(places(a), len(a), b)


class Items:
    """One block of the benchmark: its words, its windows' vectors, and the set of its words."""

    def __init__(self, space: Space, ids: list, texts: list[str]):
        self.ids, self.words, self.answers = [], [], []
        vectors, item, place = [], [], []
        for i, t in zip(ids, texts, strict=True):
            h, _ = _hashes(next(W.blocks(pa.array([t or ""]))))
            if not len(h):
                continue
            sentences = [x for x in (t or "").replace("\n", ". ").split(". ") if _hashes(next(W.blocks(pa.array([x]))))[0].size]
            self.ids.append(i)
            self.words.append(h.tolist())
            self.answers.append(_hashes(next(W.blocks(pa.array([sentences[-1]]))))[0].tolist() if sentences else h.tolist())
            e = space.vectors[(h % np.uint64(TERMS)).astype(np.int64)]
            w = min(WINDOW, len(h))
            total = np.concatenate([np.zeros((1, e.shape[1]), np.float64), np.cumsum(e, axis=0, dtype=np.float64)])
            v = total[w:] - total[:-w]
            vectors.append(unit(v).astype(np.float32))
            item += [len(self.ids) - 1] * len(v)
            place += list(range(len(v)))
        self.vectors = np.concatenate(vectors) if vectors else np.zeros((0, RANK), np.float32)
        self.item, self.place = np.array(item, np.int64), np.array(place, np.int64)
        self.vocabulary = W.distinct(np.array([x for ws in self.words for x in ws], np.uint64))
        self.marked = np.zeros(1 << 20, bool)
        self.marked[(self.vocabulary & np.uint64(len(self.marked) - 1)).view(np.int64)] = True
        # one row for each word of the benchmark, and a last one for all other words: which items have it
        self.has = np.zeros((len(self.vocabulary) + 1, len(self.ids)), np.uint8)
        for k, ws in enumerate(self.words):
            self.has[np.searchsorted(self.vocabulary, np.array(ws, np.uint64)), k] = 1
        self.first = np.searchsorted(self.item, np.arange(len(self.ids) + 1))
        self.lengths = np.array([len(ws) for ws in self.words], np.int64)
        number = lambda ws: np.searchsorted(self.vocabulary, np.array(ws, np.uint64)).tolist()
        self.words_at = [places(number(ws)) for ws in self.words]
        self.answers_at = [places(number(ws)) for ws in self.answers]

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """The words' numbers; len(vocabulary) for words that no item has, most of which a bit table tells."""
        out = np.full(len(h), len(self.vocabulary))
        maybe = np.flatnonzero(self.marked[(h & np.uint64(len(self.marked) - 1)).view(np.int64)])
        at = np.minimum(np.searchsorted(self.vocabulary, h[maybe]), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == h[maybe]
        out[maybe[known]] = at[known]
        return out

    def nearest(self, v: np.ndarray, of: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each pair (vector v[of], item): the largest cosine with a window of the item, and the first such window."""
        cosine, at = np.empty(len(of), np.float32), np.empty(len(of), np.int64)
        o = np.argsort(item, kind="stable")
        cuts = np.flatnonzero(np.diff(item[o], prepend=-1, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            mine = o[a:b]
            i = item[mine[0]]
            own = v[of[mine]] @ self.vectors[self.first[i] : self.first[i + 1]].T
            at[mine] = p = own.argmax(1)
            cosine[mine] = own[np.arange(b - a), p]
        return cosine, at

    def most_shared(self, index: np.ndarray, lo: np.ndarray, hi: np.ndarray, item: np.ndarray) -> np.ndarray:
        """For each span index[lo:hi] of word numbers (not empty): how many of its words the item has, no less than their LCS."""
        out = np.empty(len(lo), np.int64)
        step = max(1, SPAN_WORDS // int((hi - lo).max(initial=1)))
        for k in range(0, len(lo), step):
            a, i = lo[k : k + step], item[k : k + step]
            size = hi[k : k + step] - a
            begin = np.cumsum(size) - size
            place = np.arange(int(size.sum())) + np.repeat(a - begin, size)
            out[k : k + step] = np.add.reduceat(self.has[index[place], np.repeat(i, size)], begin, dtype=np.int64)
        return out


def _checked(items: Items, index, first, row, b, i, cosine, p) -> list[tuple]:
    """(row, item, cosine, lcs, answer, start) of the row's and item's best spot that is a leak.

    A spot is a window's first word b, an item, and the place p of the item's window it is near. Of the spots around
    the same words the nearest counts (to 5 digits, beyond which cosines of equal words differ by rounding). Spots that share too few words for any leak are left out before the LCS.
    """
    r, n = row[b], items.lengths[i]
    o = np.lexsort((-p, -b, -cosine.round(5), i, r))
    b, i, cosine, p, r, n = b[o], i[o], cosine[o], p[o], r[o], n[o]
    lo = np.maximum(first[r], b - p - n // 4 - 2)
    hi = np.minimum(first[r + 1], b - p + n + n // 4 + 2)
    near = lo // (n // 4 + 2)
    o = np.lexsort((np.arange(len(r)), near, i, r))
    new = np.ones(len(o), bool)
    new[1:] = (np.diff(r[o]) != 0) | (np.diff(i[o]) != 0) | (np.diff(near[o]) != 0)
    keep = np.sort(o[new])
    keep = keep[items.most_shared(index, lo[keep], hi[keep], i[keep]) / n[keep] >= min(LCS, LCS_WITH_ANSWER)]
    best: dict[tuple[int, int], tuple] = {}
    for k in keep:
        key = int(r[k]), int(i[k])
        if key in best and best[key][1] == 1:
            continue
        part = index[lo[k] : hi[k]]
        part = part[items.has[part, i[k]] > 0].tolist()
        share = lcs_at(items.words_at[key[1]], int(n[k]), part) / int(n[k])
        if share < min(LCS, LCS_WITH_ANSWER) or (key in best and share <= best[key][1]):
            continue
        answer = len(items.answers[key[1]])
        got = lcs_at(items.answers_at[key[1]], answer, part) / answer
        if share >= LCS or (share >= LCS_WITH_ANSWER and got >= ANSWER):
            best[key] = (float(cosine[k]), share, got, int(lo[k] - first[r[k]]))
    return [(x, items.ids[y], *found) for (x, y), found in best.items()]


def _search(table):
    def run(batches):
        space, items = table.value
        for batch in batches:
            for block in W.blocks(batch.column(1)):
                h, first = _hashes(block)
                if not len(h) or not len(items.vectors):
                    continue
                index = items.numbers(h)
                known = index < len(items.vocabulary)
                row = W.row_of(first)
                end = first[1:][row]
                place = np.arange(len(h)) - first[row]
                begin = np.flatnonzero((place % STEP == 0) & ((np.arange(len(h)) + WINDOW <= end) | (place == 0)))
                stop = np.minimum(begin + WINDOW, end[begin])
                have = np.concatenate([[0], np.cumsum(known)])
                least = np.maximum(1, SHARED * (stop - begin) // WINDOW)
                enough = have[stop] - have[begin] >= least
                begin, stop, least = begin[enough], stop[enough], least[enough]
                term = (h % np.uint64(TERMS)).astype(np.int64)
                at_once = max(2048, PAIRS_AT_ONCE // len(items.ids))
                spots = []
                for lo in range(0, len(begin), at_once):
                    b, s, m = begin[lo : lo + at_once], stop[lo : lo + at_once], least[lo : lo + at_once]
                    take = b[:, None] + np.arange(WINDOW)
                    inside = take < s[:, None]
                    take = np.minimum(take, len(h) - 1)
                    word = np.where(inside, index[take], len(items.vocabulary))
                    shared = items.has[word[:, 0]]
                    for k in range(1, WINDOW):
                        shared += items.has[word[:, k]]
                    x, y = np.nonzero(shared >= m[:, None])
                    if not len(x):
                        continue
                    used, of = np.unique(x, return_inverse=True)
                    v = unit(np.einsum("bwk,bw->bk", space.vectors[term[take[used]]], inside[used].astype(np.float32)))
                    c, p = items.nearest(v, of, y)
                    near = c >= COSINE
                    spots.append((b[x[near]], y[near], c[near], p[near]))
                out = []
                if spots:
                    out = _checked(items, index, first, row, *map(np.concatenate, zip(*spots, strict=True)))
                if out:
                    r, i, c, s, a, w = zip(*out, strict=True)
                    ids = batch.column(0).slice(block.first, block.rows).take(pa.array(r))
                    yield pa.RecordBatch.from_arrays([ids, pa.array(i, pa.int64()), pa.array(c), pa.array(s), pa.array(a), pa.array(w, pa.int64())], ["d", "i", "cosine", "lcs", "answer", "start"])

    return run


def _item_blocks(benchmark: DataFrame):
    """The benchmark's rows in blocks of bounded size, read one partition at a time."""
    ids, texts, size = [], [], 0
    for r in benchmark.toLocalIterator():
        n = len((r["text"] or "").split())
        if ids and (len(ids) >= ITEMS_AT_ONCE or size + n > WORDS_AT_ONCE):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r["i"])
        texts.append(r["text"])
        size += n
    if ids:
        yield ids, texts


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Returns (doc_id, item_id, cosine, lcs, answer, start): each document that holds an item, and the word it starts near."""
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col("text").cast("string").alias("text"))
    space = latent_space(rows.select("text").unionAll(items.select("text")), passage_features, RANK, kept=True)
    out = None
    for ids, texts in _item_blocks(items):
        table = sc.broadcast((space, Items(space, ids, texts)))
        part = written(rows.mapInArrow(_search(table), FOUND), "leaks")
        out = part if out is None else out.unionAll(part)
    if out is None:
        out = rows.sparkSession.createDataFrame([], FOUND)
    out = out.groupBy("d", "i").agg(F.max(F.struct("lcs", "answer", "cosine", "start")).alias("m"))
    return out.select(F.col("d").alias(id_col), F.col("i").alias(item_col), "m.cosine", "m.lcs", "m.answer", "m.start")


def op2_decontaminate(spark, sf_dir):
    """Registered query: every document against every benchmark item."""
    return leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
