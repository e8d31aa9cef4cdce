"""Ranked lexical search: an inverted index in shards of documents, searched by Block-Max MaxScore, shard heaps merged.

Index. Each task cuts its documents into shards (bounded in documents and in text) and writes one row per shard and
term: its postings in blocks of BLOCK, every block compressed on its own (document gaps and impacts in the fewest
whole bytes), with the block's last document and largest impact beside. A posting's impact is the term's part of the
score without its weight, so block maxima are exact. One further row per shard holds the documents' ids. Nothing is
shuffled to build it; document frequencies are sums over its rows.

Search. The items' lists are brought together by shard (the index is filtered by term first). Within a shard, lists
are ordered by their global bound (weight x largest impact). Those whose bounds together can't pass the tenth best
score so far are non-essential. Windows of documents are scored from the essential lists; on non-essential lists a
candidate is first held against its block's maximum and goes, before the block is decompressed, when it can't get in.
Ten documents an item and shard remain, and a window by item merges them.

Defined cases: a null or empty text has no terms and is no result. Documents that share an id are documents of their
own; a null id is ranked like any other, before the smallest id in ties. Items that share an item_id are one item with
the terms of all their texts; an item without known terms has no rows. Other columns of both tables are ignored.
Items are searched in blocks of bounded text, each against all documents, so a benchmark of any size is held in parts.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.tables import written

TOP = 10
BLOCK = 128  # postings compressed together
SHARD_DOCS, SHARD_BYTES = 8192, 16 << 20
WINDOW = 1024  # documents scored together
ITEM_BYTES = 4 << 20  # item text searched at once

_WORDLESS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_FOLD = bytes(32 if c in _WORDLESS else c + 32 if 65 <= c <= 90 else c for c in range(256))
_SQL_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8, in order, with repeats."""
    return text.translate(_FOLD).split() if text else []


def impact(tf, n, docs: int, words: int):
    """A posting's part of the score before its term's weight; tf, n: occurrences, terms in the document."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words))


def weight(df: int, docs: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


# --- index -----------------------------------------------------------------------------------------------------------


def _sizes(batches):
    for batch in batches:
        n = [len(terms(t)) for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_pydict({"docs": pa.array([sum(map(bool, n))], pa.int64()), "words": pa.array([sum(n)], pa.int64())})


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents with a term, and all their terms with repeats."""
    per = docs.select(F.col(text_col).cast("string").cast("binary")).mapInArrow(_sizes, "docs long, words long")
    total = per.agg(F.sum("docs"), F.sum("words")).first()
    return total[0] or 0, total[1] or 0


def _width(v: np.ndarray) -> np.ndarray:
    return np.where(v < 1 << 8, 1, np.where(v < 1 << 16, 2, 4))


def _pack(out: np.ndarray, start: np.ndarray, width: np.ndarray, slot: np.ndarray, value: np.ndarray) -> None:
    """Writes each value little-endian into its block: at start + slot * width."""
    at = start + slot * width
    for k in range(4):
        some = width > k
        out[at[some] + k] = (value[some] >> (8 * k)) & 255


def _lists(shard: int, docs: list, n_docs: int, n_words: int) -> pa.RecordBatch:
    """One row per term of these documents (id, Counter, terms in all), and one with their ids."""
    docs.sort(key=lambda d: (d[0] is not None, d[0]))
    code = defaultdict(count().__next__)
    per = [np.fromiter(map(code.__getitem__, c), np.int64, len(c)) for _, c, _ in docs]
    t = np.concatenate(per)
    tf = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for _, c, _ in docs])
    d = np.repeat(np.arange(len(docs)), [len(p) for p in per])
    g = impact(tf, np.repeat(np.array([n for _, _, n in docs], np.int64), [len(p) for p in per]), n_docs, n_words)
    order = np.argsort(t, kind="stable")
    t, d, g = t[order], d[order], g[order]
    df = np.bincount(t, minlength=len(code))
    slot = np.arange(len(t)) - np.repeat(np.cumsum(df) - df, df)
    first = slot % BLOCK == 0  # of its block
    blocks = np.flatnonzero(first)
    size = np.diff(np.append(blocks, len(t)))
    gap = np.where(first, 0, d - np.append(0, d[:-1]))
    wd, wg = _width(np.maximum.reduceat(gap, blocks)), _width(np.maximum.reduceat(g, blocks))
    held = size * (wd + wg)
    start = np.cumsum(held) - held
    data = np.zeros(int(held.sum()), np.uint8)
    each = lambda x: np.repeat(x, size)
    _pack(data, each(start), each(wd), slot % BLOCK, gap)
    _pack(data, each(start + size * wd), each(wg), slot % BLOCK, g)
    n_blocks = -(-df // BLOCK)
    ends = np.append(0, np.cumsum(n_blocks))
    bounds = np.append(start, held.sum())[ends]
    lists = lambda x, kind: pa.ListArray.from_arrays(pa.array(np.append(ends, ends[-1]), pa.int32()), pa.array(x, kind))
    cut = pa.BinaryArray.from_buffers(pa.binary(), len(code) + 1, [None, pa.py_buffer(np.append(bounds, bounds[-1]).astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())])
    ids = pa.array([None] * len(code) + [[i for i, _, _ in docs]], pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard] * (len(code) + 1), pa.int64()),
            pa.array([*code, None], pa.binary()),
            pa.array(np.append(df, 0), pa.int64()),
            lists(d[blocks], pa.int32()),
            lists(d[blocks + size - 1], pa.int32()),
            lists(np.maximum.reduceat(g, blocks), pa.int32()),
            lists(wd * 8 + wg, pa.int8()),
            cut,
            ids,
        ],
        _INDEX_COLS,
    )


INDEX = "shard long, term binary, df long, first array<int>, last array<int>, top array<int>, width array<tinyint>, data binary, ids array<long>"
_INDEX_COLS = [c.split()[0] for c in INDEX.split(", ")]


def build_index(docs: DataFrame, n_docs: int, n_words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's terms as compressed lists by shard; see INDEX. The row without a term holds the shard's ids."""

    def build(batches):
        from pyspark import TaskContext

        shard, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = terms(text.as_py())
                if words:
                    held.append((i, Counter(words), len(words)))
                    size += len(text.as_buffer())
                if len(held) == SHARD_DOCS or size >= SHARD_BYTES:
                    yield _lists(shard, held, n_docs, n_words)
                    shard, held, size = shard + 1, [], 0
        if held:
            yield _lists(shard, held, n_docs, n_words)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string").cast("binary")).mapInArrow(build, INDEX)


# --- search ----------------------------------------------------------------------------------------------------------


class _List:
    """A term's postings in a shard; a block is decompressed when it is first needed."""

    def __init__(self, df, first, last, top, width, data):
        self.df, self.first, self.last, self.top, self.width, self.data = df, first, last, top, width, data
        size = np.full(len(last), BLOCK)
        size[-1] = df - BLOCK * (len(last) - 1)
        self.size = size
        held = size * (width // 8 + width % 8)
        self.start = np.cumsum(held) - held
        self.most = int(top.max())
        self.open: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        if k not in self.open:
            n, wd, wg, at = int(self.size[k]), int(self.width[k]) // 8, int(self.width[k]) % 8, int(self.start[k])
            gaps = np.frombuffer(self.data, f"<u{wd}", n, at).astype(np.int64)
            self.open[k] = np.cumsum(gaps) + self.first[k], np.frombuffer(self.data, f"<u{wg}", n, at + n * wd).astype(np.int64)
        return self.open[k]

    def add(self, scores: np.ndarray, lo: int, hi: int, w: int) -> None:
        """Adds w x impact to scores of the documents lo..hi-1."""
        for k in range(int(np.searchsorted(self.last, lo)), len(self.last)):
            if self.first[k] >= hi:
                break
            d, g = self.block(k)
            if self.first[k] < lo or self.last[k] >= hi:
                a, b = np.searchsorted(d, (lo, hi))
                d, g = d[a:b], g[a:b]
            scores[d - lo] += w * g

    def bounds(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block that could hold each document, and the most it could have there."""
        k = np.searchsorted(self.last, docs)
        inside = k < len(self.last)
        k = np.where(inside, k, 0)
        return k, np.where(inside & (docs >= self.first[k]), self.top[k], 0)

    def impacts(self, docs: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The impact in each of these documents (ascending), 0 where the term is not; k: their blocks."""
        out = np.zeros(len(docs), np.int64)
        for b in np.unique(k):
            mine = k == b
            d, g = self.block(int(b))
            at = np.minimum(np.searchsorted(d, docs[mine]), len(d) - 1)
            out[mine] = np.where(d[at] == docs[mine], g[at], 0)
        return out


def best(lists: list[tuple[int, _List]], n_docs: int, top: int = TOP) -> tuple[np.ndarray, np.ndarray]:
    """The documents with the highest scores, equal ones by position, and their scores. lists: (weight, postings)."""
    lists = sorted(lists, key=lambda x: x[0] * x[1].most)
    sums = np.cumsum([0, *(w * x.most for w, x in lists)])  # what the first lists can give together
    docs, got, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for lo in range(0, n_docs, WINDOW):
        hi = min(lo + WINDOW, n_docs)
        split = int(np.searchsorted(sums, least, "right")) - 1  # lists before it can't pass the bar alone
        if split == len(lists):
            break
        scores = np.zeros(hi - lo, np.int64)
        for w, x in lists[split:]:
            x.add(scores, lo, hi, w)
        some = np.flatnonzero((scores > 0) & (scores + sums[split] > least))
        own, some = scores[some], some + lo
        for i in range(split - 1, -1, -1):
            if not len(some):
                break
            w, x = lists[i]
            k, most = x.bounds(some)
            stays = own + w * most + sums[i] > least
            some, own, k, most = some[stays], own[stays], k[stays], most[stays]
            hit = most > 0
            own[hit] += w * x.impacts(some[hit], k[hit])
            stays = own + sums[i] > least
            some, own = some[stays], own[stays]
        docs, got = np.append(docs, some), np.append(got, own)
        if len(docs) > top:
            order = np.lexsort((docs, -got))[:top]
            docs, got = docs[order], got[order]
        if len(docs) == top:
            least = int(got.min())
    order = np.lexsort((docs, -got))
    return docs[order], got[order]


def _search(items: list[tuple[object, list[tuple[bytes, int]]]], kind: pa.DataType, top: int):
    """For groupBy("shard").applyInArrow: the best documents of the shard for each item."""

    def search(table: pa.Table) -> pa.Table:
        held, ids = {}, []
        cols = [table.column(c) for c in ("term", "df", "first", "last", "top", "width", "data", "ids")]
        for term, df, first, last, high, width, data, own in zip(*cols, strict=True):
            if term.is_valid:
                ints = [x.values.to_numpy(zero_copy_only=False).astype(np.int64) for x in (first, last, high, width)]
                held[term.as_py()] = _List(df.as_py(), *ints, data.as_buffer())
            else:
                ids = own.as_py()
        out = [], [], []
        for item, asked in items:
            lists = [(w, held[t]) for t, w in asked if t in held]
            if lists:
                docs, scores = best(lists, len(ids), top)
                out[0].extend([item] * len(docs))
                out[1].extend(ids[d] for d in docs)
                out[2].extend(scores.tolist())
        return pa.Table.from_arrays([pa.array(out[0], kind), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64())], ["item_id", "doc_id", "score"])

    return search


def lexical_search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the top documents for each item; docs(doc_id, text), items(item_id, text)."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = items.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    spark = docs.sparkSession
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_first()))
    n_docs, n_words = corpus_size(docs)
    found = spark.createDataFrame([], schema)
    if n_docs:
        index = written(build_index(docs, n_docs, n_words), "index")
        asked = items.select("item_id", F.col("text").cast("string").cast("binary").alias("text"))
        parts = 1 + (asked.agg(F.sum(F.length("text"))).first()[0] or 0) // ITEM_BYTES
        for part in range(parts):
            sought: dict[object, set[bytes]] = defaultdict(set)
            for row in asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).toLocalIterator():
                sought[row[0]].update(terms(bytes(row[1]) if row[1] is not None else None))
            vocabulary = spark.createDataFrame([(t,) for t in sorted(set().union(*sought.values()))], "term binary")
            lists = index.join(F.broadcast(vocabulary), "term", "left_semi")  # at most ITEM_BYTES of terms, as counted
            w = {bytes(t): weight(df, n_docs) for t, df in lists.groupBy("term").agg(F.sum("df")).toLocalIterator()}
            plan = [(item, [(t, w[t]) for t in sorted(own) if w.get(t, 0) > 0]) for item, own in sought.items()]
            ids = index.filter("term IS NULL")
            hits = lists.unionByName(ids).groupBy("shard").applyInArrow(_search(plan, to_arrow_type(kind), top), schema)
            found = found.unionByName(hits)
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def op11_lexical_search(spark, sf_dir):
    """Registered query: the ten best documents for every benchmark item."""
    read = lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return lexical_search(read("documents"), read("benchmark"))


OP11_SQL = rf"""
WITH tok AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SQL_TERM}') AS words
  FROM documents WHERE text IS NOT NULL
), docs AS (SELECT row, doc_id, len(words) AS n FROM tok WHERE len(words) > 0
), total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_words FROM docs
), post AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(words) AS term FROM tok) GROUP BY row, term
), freq AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM post, total GROUP BY term, n_docs
), asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SQL_TERM}')) AS term FROM benchmark
), scored AS (
  SELECT item_id, docs.row, any_value(doc_id) AS doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_words)))) AS BIGINT) AS score
  FROM asked JOIN post USING (term) JOIN freq USING (term) JOIN docs ON docs.row = post.row, total GROUP BY item_id, docs.row
), ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
