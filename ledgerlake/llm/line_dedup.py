"""Line dedup by an exact set-similarity join: a line goes when an earlier line is similar enough.

Method. A line's tokens are its distinct 5-word shingles (a line of fewer words is one token). Tokens are ordered by
rarity. Two lines with Jaccard similarity t share a token among the first size - ceil(t * size) + 1 of each (prefix
filter), have sizes within t of each other (length filter), and their shared tokens so far plus what can still follow
must reach the needed overlap (positional filter). Remaining pairs are verified on whole sets.

Rule. Lines are ordered by (doc_id, text hash, line number). The first line of each distinct set is kept unless a
similar line precedes it; every later line with the same set goes. Lines without words stay.

Hot groups. Equal sets are one class before the join. Whether a class goes needs one earlier match only: each class
is first verified against the first class of its posting lists; only the classes left without a match are joined with
all earlier classes of their lists. So a line that thousands of near copies vary costs one pair each.

Defined cases. Null and empty texts come back as they are, with no lines. Null doc_id: ordered last, kept in the
result. Rows that repeat a doc_id with the same text are one document stored twice and lose the same lines. An empty
table gives an empty table. Only the id and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import words as W
from ledgerlake.llm.rarity import Rarity, rarity
from ledgerlake.llm.tables import discard, is_empty, written

NO_ID = (1 << 63) - 1
SKETCH_BITS = 26
LINES = "d long, x long, line int, n int, h long, g long, toks array<long>"


def line_sets(block: W.Block, n: int):
    """Per line with words, in order: row, line number within the row; and the lines' distinct token hashes.

    Returns (row, number, first token of each line, tokens sorted by line and hash).
    """
    data = block.data
    h, starts, _, _ = W.words(block, True)
    ends_of_lines = np.flatnonzero(data == 10)
    cuts = np.union1d(ends_of_lines + 1, block.offsets[:-1])
    line_of = np.searchsorted(cuts, starts, side="right") - 1
    used, first = np.unique(line_of, return_index=True)
    first = np.append(first, len(h))
    row = np.searchsorted(block.offsets, cuts[used], side="right") - 1
    # a row may be empty, so that its offset repeats: the last row that starts there owns the bytes
    before = np.searchsorted(ends_of_lines, cuts[used])
    number = before - np.searchsorted(ends_of_lines, block.offsets[:-1])[row]
    count = np.diff(first)
    grams = W.ngrams(h, n)
    line = np.repeat(np.arange(len(used)), count)
    room = first[1:][line] - np.arange(len(h))
    at = np.flatnonzero(room >= n)
    toks, of = grams[at], line[at]
    short = np.flatnonzero(count < n)
    if len(short):
        extra = [W.ngrams(h[first[i] : first[i + 1]], int(count[i])) + np.uint64(count[i]) for i in short]
        toks, of = np.concatenate([toks, *extra]), np.concatenate([of, short])
    o = np.lexsort((toks, of))
    toks, of = toks[o], of[o]
    if len(toks):
        keep = np.concatenate([[True], (toks[1:] != toks[:-1]) | (of[1:] != of[:-1])])
        toks, of = toks[keep], of[keep]
    return row, number, np.searchsorted(of, np.arange(len(used) + 1)), toks, of


def set_hashes(toks: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set of tokens: two sums of differently mixed tokens."""
    if len(first) < 2:
        z = np.zeros(0, np.int64)
        return z, z
    h = np.add.reduceat(W.mix(toks), first[:-1])
    g = np.add.reduceat(W.mix(toks ^ np.uint64(0xA5A5A5A5DEADBEEF)), first[:-1])
    return h.view(np.int64), g.view(np.int64)


def _lines(r: Rarity, n: int, num: int, den: int):
    def run(batches):
        for batch in batches:
            ids, hashes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for block in W.blocks(batch.column(2)):
                row, number, first, toks, of = line_sets(block, n)
                if not len(row):
                    continue
                h, g = set_hashes(toks, first)
                size = np.diff(first)
                o = np.lexsort((toks, r.ranks(toks), of))
                p = size - (num * size + den - 1) // den + 1
                place = np.arange(len(toks)) - first[of]
                keep = place < p[of]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(p)]).astype(np.int32)), pa.array(toks[o][keep].view(np.int64)))
                row = row + block.first
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row]), pa.array(hashes[row]), pa.array(number.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(h), pa.array(g), lists],
                    ["d", "x", "line", "n", "h", "g", "toks"],
                )

    return run


def _token_sets(n: int):
    def sets(block):
        _, _, first, toks, _ = line_sets(block, n)
        return toks, first

    return sets


def _line_sets_of(n: int):
    """The whole sets of the wanted lines of each text."""

    def run(batches):
        for batch in batches:
            lines, ids = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for block in W.blocks(batch.column(0)):
                row, number, first, toks, _ = line_sets(block, n)
                have = {(int(a) + block.first, int(b)): k for k, (a, b) in enumerate(zip(row, number, strict=True))}
                out_id, out_set = [], []
                for i in range(block.first, block.first + block.rows):
                    for line, node in zip(lines[i], ids[i], strict=True):
                        k = have[i, line]
                        out_id.append(node)
                        out_set.append(toks[first[k] : first[k + 1]].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(out_id, pa.int64()), pa.array(out_set, pa.binary())], ["id", "s"])

    return run


def held_elsewhere(docs: DataFrame, alone: DataFrame, sets) -> DataFrame:
    """(tok): the tokens of alone(tok) that the whole sets of two or more classes hold.

    sets gives the tokens of a block's sets, without empty sets, and where each set begins. Every set of docs(text) is
    read. Tasks send only what a bit table of fixed size lets through (a token of alone always passes), with the set's
    hash, and counts are by token, so a frequent token is folded before it is dealt out.
    """
    spark = docs.sparkSession
    low = (1 << SKETCH_BITS) - 1
    bits = alone.select(F.explode(F.array(F.expr(f"tok & {low}"), F.expr(f"shiftrightunsigned(tok, {SKETCH_BITS}) & {low}"))).alias("k"))
    bits = bits.groupBy(F.expr("shiftright(k, 6)").alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(k & 63 as int)))").alias("b")).toArrow()
    sketch = np.zeros(1 << (SKETCH_BITS - 6), np.uint64)
    sketch[bits.column("w").to_numpy()] = bits.column("b").to_numpy().view(np.uint64)
    table = spark.sparkContext.broadcast(sketch)

    def run(batches):
        has = lambda k: (table.value[k >> np.uint64(6)] >> (k & np.uint64(63))) & np.uint64(1) == 1
        for batch in batches:
            for block in W.blocks(batch.column(0)):
                toks, first = sets(block)
                h, _ = set_hashes(toks, first)
                hit = np.flatnonzero(has(toks & np.uint64(low)))
                hit = hit[has((toks[hit] >> np.uint64(SKETCH_BITS)) & np.uint64(low))]
                of = np.searchsorted(first, hit, side="right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(toks[hit].view(np.int64)), pa.array(h[of])], ["tok", "h"])

    held = docs.select("text").mapInArrow(run, "tok long, h long").groupBy("tok").agg(F.min("h").alias("lo"), F.max("h").alias("hi"))
    return held.filter("lo <> hi").select("tok")


def shared_tokens(docs: DataFrame, prefixes: DataFrame, node: str, sets) -> tuple[DataFrame, DataFrame]:
    """(node, more): per node, its prefix tokens that no other prefix has (df = 1), but another whole set; and the table that it reads."""
    some = prefixes.filter("df > 1").select(node).distinct()
    alone = written(prefixes.filter("df = 1").join(some, node, "left_semi").select(node, "tok"), "alone")
    held = held_elsewhere(docs, alone, sets)
    return alone.join(held, "tok", "left_semi").groupBy(node).agg(F.count("*").alias("more")), alone


def similar(num: int, den: int):
    """Keeps the pairs (a, b) whose sets sx and sy (sorted hashes as bytes) have den * both >= num * union."""

    def run(batches):
        for batch in batches:
            x, y = batch.column("sx"), batch.column("sy")
            ok = []
            for i in range(batch.num_rows):
                a, b = np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64)
                at = np.searchsorted(a, b)
                both = int(np.count_nonzero(a[np.minimum(at, len(a) - 1)] == b))
                ok.append(den * both >= num * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


def _drop_lines(batches):
    for batch in batches:
        texts, gone = batch.column("text").to_pylist(), batch.column("gone").to_pylist()
        total, out = [], []
        for t, g in zip(texts, gone, strict=True):
            total.append(0 if not t else t.count("\n") + 1)
            if g:
                drop = set(g)
                t = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in drop)
            out.append(t)
        yield pa.RecordBatch.from_arrays(
            [batch.column("d"), pa.array(total, pa.int64()), pa.array([sorted(g) if g else [] for g in gone], pa.list_(pa.int32())), pa.array(out, pa.string()), *batch.columns[3:]],
            ["d", "n_lines", "removed", "text", "more"][: 4 + len(batch.columns[3:])],
        )


def removed_lines(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """(d, x, gone): for each document that loses lines, their numbers. docs has d, x (the text's hash) and text."""
    table = docs.sparkSession.sparkContext.broadcast(rarity(docs, n, by_line=True, with_words=False))

    def make(batches):
        yield from _lines(table.value, n, num, den)(batches)

    lines = written(docs.select("d", "x", "text").mapInArrow(make, LINES), "lines")
    first = Window.partitionBy("h", "g").orderBy("d", "x", "line")
    classes = lines.withColumn("r", F.row_number().over(first)).filter("r = 1").drop("r")
    classes = written(classes.sort("d", "x", "line").withColumn("id", F.monotonically_increasing_id()), "classes")
    wide, lines = lines, written(lines.select("d", "x", "line"), "places")
    discard(wide)

    enough = F.expr(f"({num} * n + {den - 1}) div {den}")
    by_tok = Window.partitionBy("tok")
    posts = classes.select("id", "n", F.size("toks").alias("len"), F.posexplode("toks").alias("pos", "tok"))
    prefixes = written(posts.withColumn("df", F.count("*").over(by_tok)), "prefixes")
    posts = prefixes.filter("df > 1").drop("df")
    # prefix tokens that no other line's whole set has bound what a line can share (cap); too little, and it needs no partner
    more, alone = shared_tokens(docs, prefixes, "id", _token_sets(n))
    caps = posts.groupBy("id", "n", "len").agg(F.count("*").alias("shared")).join(more, "id", "left")
    caps = caps.withColumn("cap", F.expr("n - len + shared + coalesce(more, 0)"))
    posts = posts.join(caps.filter(F.col("cap") >= enough).select("id", "cap"), "id").drop("len")
    posts = posts.withColumn("pivot", F.min("id").over(by_tok)).withColumn("last", F.max("id").over(by_tok))
    posts = written(posts.filter("pivot <> last").drop("last"), "posts")
    discard(prefixes, alone)

    # round 1: each class against the pivot with which it shares most prefix tokens
    near = posts.filter("pivot < id").groupBy("id", "pivot").agg(F.count("*").alias("c"))
    best = near.groupBy("id").agg(F.max(F.struct("c", F.col("pivot").alias("p"))).alias("m"))
    sizes = classes.select("id", "n")
    pairs = best.select(F.col("id").alias("a"), F.col("m.p").alias("b"))
    pairs = pairs.join(sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("id").alias("b"), F.col("n").alias("nb")), "b")
    links = _verified(docs, classes, pairs.filter(den * F.least("na", "nb") >= num * F.greatest("na", "nb")).select("a", "b"), n, num, den)
    done = links.select(F.col("a").alias("id")).distinct()

    # round 2: classes without a match yet, against all earlier classes of their posting lists
    x = posts.select("tok", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("cap").alias("cb"))
    y = posts.join(done, "id", "left_anti").filter("pivot < id").select("tok", F.col("id").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("cap").alias("ca"))
    need = F.expr(f"({num} * (na + nb) + {num + den - 1}) div {num + den}")
    met = y.join(x, "tok").filter((F.col("b") < F.col("a")) & (den * F.least("na", "nb") >= num * F.greatest("na", "nb")) & (F.least("ca", "cb") >= need))
    pairs = met.withColumn("need", need).groupBy("a", "b").agg(
        F.count("*").alias("c"), F.max("pa").alias("pa"), F.max("pb").alias("pb"), F.first("na").alias("na"), F.first("nb").alias("nb"), F.first("need").alias("need")
    )
    pairs = pairs.filter(F.col("c") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) - 1 >= F.col("need"))
    more = _verified(docs, classes, pairs.select("a", "b"), n, num, den)
    discard(posts)
    done = links.unionAll(more).select(F.col("a").alias("id")).distinct()

    gone = classes.join(done, "id", "left_semi").select("d", "x", "line")
    heads = classes.select("d", "x", "line")
    later = lines.join(heads, ["d", "x", "line"], "left_anti").select("d", "x", "line")
    return gone.unionAll(later).distinct().groupBy("d", "x").agg(F.collect_list("line").alias("gone"))


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    pairs = written(pairs, "pairs")
    if is_empty(pairs):
        return pairs
    wanted = pairs.select("a").unionAll(pairs.select("b")).distinct().withColumnRenamed("a", "id")
    wanted = classes.join(wanted, "id", "left_semi").groupBy("d", "x").agg(F.collect_list("line").alias("lines"), F.collect_list("id").alias("ids"))
    sets = docs.join(wanted, ["d", "x"]).select("text", "lines", "ids").mapInArrow(_line_sets_of(n), "id long, s binary").dropDuplicates(["id"])
    sets = written(sets, "whole")
    out = pairs.join(sets.select(F.col("id").alias("a"), F.col("s").alias("sx")), "a").join(sets.select(F.col("id").alias("b"), F.col("s").alias("sy")), "b")
    links = written(out.mapInArrow(similar(num, den), "a long, b long"), "links")
    discard(pairs, sets)
    return links


def with_keys(docs: DataFrame, id_col: str, text_col: str, more: list[str]) -> DataFrame:
    text = F.col(text_col).cast("string")
    keys = [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("d"), F.xxhash64(text).alias("x"), text.alias("text")]
    return docs.select(*keys, *([F.struct(*more).alias("more")] if more else []))


def line_dedup(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text", key_cols: list[str] | None = None) -> DataFrame:
    """Returns (doc_id, n_lines, removed, text): the text without the lines whose numbers (from 0) are in removed.

    key_cols: further columns of docs to pass through unchanged.
    """
    keyed = with_keys(docs, id_col, text_col, key_cols or [])
    out = keyed.join(removed_lines(keyed, n, num, den), ["d", "x"], "left")
    kind = "" if not key_cols else ", more " + docs.select(F.struct(*key_cols).alias("s")).schema["s"].dataType.simpleString()
    out = out.select("d", "text", "gone", *(["more"] if key_cols else [])).mapInArrow(_drop_lines, "d long, n_lines long, removed array<int>, text string" + kind)
    return out.select(F.nullif("d", F.lit(NO_ID)).alias(id_col), "n_lines", "removed", F.col("text").alias(text_col), *[F.col("more")[c].alias(c) for c in key_cols or []])


def op8_line_dedup(spark, sf_dir):
    """Registered query: lines of all documents, 5-word shingles, similarity 0.8 or more."""
    return line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
