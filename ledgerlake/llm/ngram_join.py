"""N-gram Jaccard join with adaptive multi-match prefixes, and the components that its links make.

Method. Each document's set of n-word shingles is put in one global order, rarest first. Two sets with Jaccard
similarity t share at least l tokens of their l-prefixes (size - ceil(t * size) + l tokens). Each document picks its
own l: a longer prefix reads more posting lists but demands more shared tokens before two sets are compared. The
choice follows the lengths of the document's posting lists, counted by Spark.

Hot groups. Equal sets become one class before anything is joined. In each posting list the first document is the
pivot; every document is verified against the pivot it shares most tokens with, which joins a large group of near
copies by as many pairs as it has members. Prefix tokens that no other document's whole set has bound what a document can
share (a token of one prefix may lie beyond the prefix of another, so whole sets are read for this); where that is too little it needs no partner, which spares near copies just below the threshold. Only then are the lists that still hold more than one component joined
with themselves, between components. No link between different components is lost, and pairs inside one component
need no check, as they change no result.

Defined cases. Null text and text without words: an empty set, linked with nothing, its own component. Fewer than n
words: the whole sequence is the one shingle. Null doc_id: the row is kept; a component's id is the smallest
doc_id that is not null, null only where all are. Rows that repeat a doc_id are separate rows. An empty table gives an
empty table. Only the id and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import words as W
from ledgerlake.llm.line_dedup import set_hashes, shared_tokens, similar
from ledgerlake.llm.rarity import Rarity, rarity, word_scores
from ledgerlake.llm.tables import components, discard, is_empty, written

MAX_MULTI = 4
NO_ID = (1 << 63) - 1  # stands for a null id inside, so that it sorts last; not usable as an id
VERIFY_COST = 4.0
SIG = 64

SETS = "d long, n long, h long, g long, toks array<long>, sig binary"


def set_hash(s: np.ndarray) -> tuple[int, int]:
    """128 bits for a set: two sums of its differently mixed shingles; zeros for the empty set."""
    h, g = set_hashes(s, np.array([0, len(s)])) if len(s) else (np.zeros(1, np.int64), np.zeros(1, np.int64))
    return int(h[0]), int(g[0])


def _document_sets(r: Rarity, n: int, num: int, den: int):
    def run(batches):
        for batch in batches:
            for block in W.blocks(batch.column(1)):
                h, _, _, first = W.words(block, True)
                grams = W.ngrams(h, n)
                scores = word_scores(r, h, n) if len(h) >= n else np.zeros(0, np.int32)
                size, h1, h2, toks, sigs = [], [], [], [], []
                for i in range(block.rows):
                    a, b = int(first[i]), int(first[i + 1])
                    if b - a >= n:
                        g, sc = grams[a : b - n + 1], scores[a : b - n + 1]
                        o = np.argsort(g, kind="stable")
                        g, sc = g[o], sc[o]
                        keep = np.concatenate([[True], g[1:] != g[:-1]])
                        g, sc = g[keep], sc[keep]
                    elif b > a:
                        g, sc = W.ngrams(h[a:b], b - a) + np.uint64(b - a), np.zeros(1, np.int32)
                    else:
                        g, sc = np.zeros(0, np.uint64), np.zeros(0, np.int32)
                    m = len(g)
                    size.append(m)
                    a, b = set_hash(g)
                    h1.append(a)
                    h2.append(b)
                    p = min(m, m - (num * m + den - 1) // den + MAX_MULTI)
                    toks.append(g[r.order(g, sc)[:p]].view(np.int64) if m else g.view(np.int64))
                    sigs.append(np.minimum(np.bincount((g >> np.uint64(40)) % np.uint64(SIG), minlength=SIG), 65535).astype("<u2").tobytes())
                lens = np.fromiter(map(len, toks), np.int64, len(toks))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)), pa.array(np.concatenate(toks)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.first, block.rows), pa.array(size, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), lists, pa.array(sigs, pa.binary())],
                    ["d", "n", "h", "g", "toks", "sig"],
                )

    return run


def _full_sets(n: int):
    """The whole set of each text, as bytes of its sorted hashes, with the set's own 128 bits."""

    def run(batches):
        for batch in batches:
            for block in W.blocks(batch.column(1)):
                ids = batch.column(0).slice(block.first, block.rows)
                sets = [s for _, s in W.shingle_sets(block, n)]
                h, g = zip(*map(set_hash, sets), strict=True)
                yield pa.RecordBatch.from_arrays([ids, pa.array(h, pa.int64()), pa.array(g, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["d", "h", "g", "s"])

    return run


def _token_sets(n: int):
    """The tokens of a block's sets that are not empty, and where each set begins."""

    def sets(block):
        parts = [s for _, s in W.shingle_sets(block, n) if len(s)]
        return np.concatenate([np.zeros(0, np.uint64), *parts]), np.concatenate([[0], np.cumsum([len(s) for s in parts], dtype=np.int64)])

    return sets


def _signatures_allow(num: int, den: int):
    """Drops pairs whose bucket counts alone prove too large a difference (an exact bound)."""

    def run(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column("gx").to_pylist()), "<u2").reshape(-1, SIG).astype(np.int64)
            y = np.frombuffer(b"".join(batch.column("gy").to_pylist()), "<u2").reshape(-1, SIG).astype(np.int64)
            nx, ny = batch.column("nx").to_numpy(), batch.column("ny").to_numpy()
            both = (nx + ny - np.abs(x - y).sum(1)) // 2
            full = (x.max(1, initial=0) >= 65535) | (y.max(1, initial=0) >= 65535)
            ok = full | (den * both >= num * (nx + ny - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok))

    return run


def ngram_join(docs: DataFrame, n: int = 3, num: int = 9, den: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns (doc_id, n_shingles, component_id) for each row of docs; see the module's text.

    Two sets are linked where den * intersection >= num * union.
    """
    spark = docs.sparkSession
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("d"), F.col(text_col).cast("string").alias("text"))
    table = spark.sparkContext.broadcast(rarity(docs, n))
    base = written(docs.mapInArrow(_with(table, _document_sets, n, num, den), SETS), "sets")

    first = Window.partitionBy("h", "g").orderBy("d")
    classes = base.filter("n > 0").withColumn("r", F.row_number().over(first)).filter("r = 1").drop("r")
    # the ids of the classes follow the order of doc_id
    classes = written(classes.sort("d", "h").withColumn("node", F.monotonically_increasing_id()), "classes")
    wide, base = base, written(base.select("d", "n", "h", "g"), "base")
    discard(wide)

    need = F.expr(f"({num} * n + {den - 1}) div {den}")
    by_tok = Window.partitionBy("tok")
    posts = classes.select("node", "n", F.size("toks").alias("len"), F.posexplode("toks").alias("pos", "tok"))
    prefixes = written(posts.withColumn("df", F.count("*").over(by_tok)), "prefixes")
    posts = prefixes.filter("df > 1")

    # per document: how many tokens can be shared at most (cap), and the cheapest number of tokens to ask for
    base_len = F.col("n") - need + 1
    reads = [F.sum(F.when(F.col("pos") < F.col("p") + k, F.col("df")).otherwise(0)).alias(f"s{k}") for k in range(MAX_MULTI)]
    costs = posts.withColumn("p", base_len).groupBy("node", "n", "len").agg(F.count("*").alias("shared"), *reads)
    more, alone = shared_tokens(docs, prefixes, "node", _token_sets(n))
    costs = costs.join(more, "node", "left").withColumn("cap", F.expr("n - len + shared + coalesce(more, 0)")).filter(F.col("cap") >= need)
    options = [F.struct((F.col(f"s{k}") * (1 + VERIFY_COST / (k + 1))).alias("cost"), F.lit(k + 1).alias("l")) for k in range(MAX_MULTI)]
    options = [options[0]] + [F.when(need >= k + 1, options[k]) for k in range(1, MAX_MULTI)]
    multi = costs.select("node", "cap", F.least(*options).getField("l").alias("l"))
    posts = posts.drop("df").join(multi, "node").withColumn("p", base_len)
    posts = posts.withColumn("pivot", F.min("node").over(by_tok)).withColumn("last", F.max("node").over(by_tok))
    posts = written(posts.filter("pivot <> last").drop("last", "len"), "posts")
    discard(prefixes, alone)

    # round 1: each document against the pivot with which it shares most tokens of its prefix
    near = posts.filter("pos < p + l - 1 and pivot <> node").groupBy("node", "pivot", "l").agg(F.count("*").alias("c")).filter("c >= l")
    best = near.groupBy("node").agg(F.max(F.struct("c", "pivot")).alias("m"))
    links = _verified(docs, classes, best.select(F.col("node").alias("a"), F.col("m.pivot").alias("b")), n, num, den)
    roots = components(links)

    # round 2: the posting lists that still hold several components, between these
    member = posts.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_lists = member.groupBy("tok").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("tok")
    member = written(member.join(open_lists, "tok").select("tok", "node", "root", "n", "pos", "p", "l", "cap"), "open")
    discard(posts)
    x = member.select("tok", *[F.col(c).alias(f"x_{c}") for c in ("node", "root", "n", "pos", "p", "cap")])
    y = member.select("tok", *[F.col(c).alias(f"y_{c}") for c in ("node", "root", "n", "pos", "p", "l", "cap")])
    both = F.expr(f"({num} * (x_n + y_n) + {num + den - 1}) div {num + den}")  # the least intersection that suffices
    met = x.join(y, "tok").filter(
        (F.col("x_node") < F.col("y_node"))
        & (F.col("x_root") != F.col("y_root"))
        & (den * F.least("x_n", "y_n") >= num * F.greatest("x_n", "y_n"))
        & (F.least("x_cap", "y_cap") >= both)
        & (F.col("x_pos") < F.col("x_p") + F.col("y_l") - 1)
        & (F.col("y_pos") < F.col("y_p") + F.col("y_l") - 1)
    )
    pairs = met.groupBy("x_node", "y_node", "x_n", "y_n", "y_l").agg(
        F.count("*").alias("c"), F.min("x_pos").alias("x0"), F.min("y_pos").alias("y0"), F.max("x_pos").alias("x1"), F.max("y_pos").alias("y1")
    )
    # nothing is shared before the first match; after the last, no more than what is left
    pairs = pairs.filter("c >= y_l").filter(F.least(F.expr("x_n - x0"), F.expr("y_n - y0"), F.expr("c + x_n - x1 - 1"), F.expr("c + y_n - y1 - 1")) >= both)
    pairs = pairs.select(F.col("y_node").alias("a"), F.col("x_node").alias("b")).join(links, ["a", "b"], "left_anti")
    more = _verified(docs, classes, pairs, n, num, den)
    discard(member)
    if not is_empty(more):
        roots = components(links.unionAll(more))

    heads = classes.select("node", F.col("d").alias("own"), "h", "g").join(roots, "node", "left")
    top = classes.select(F.col("node").alias("root"), F.col("d").alias("component"))
    heads = heads.join(top, "root", "left").select("h", "g", F.coalesce("component", "own").alias("component"))
    named = base.select("d", "n", "h", "g").join(heads, ["h", "g"], "left")
    component = F.when(F.col("n") == 0, F.col("d")).otherwise(F.col("component"))
    return named.select(
        F.nullif("d", F.lit(NO_ID)).alias(id_col),
        F.col("n").alias("n_shingles"),
        F.nullif(component, F.lit(NO_ID)).alias("component_id"),
    )


def _with(table, make, *args):
    """A task function whose table comes from the broadcast, not from the closure."""

    def run(batches):
        yield from make(table.value, *args)(batches)

    return run


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of class nodes whose whole sets are similar enough."""
    small = classes.select("node", "n", "sig")
    a = small.select(F.col("node").alias("a"), F.col("n").alias("nx"), F.col("sig").alias("gx"))
    b = small.select(F.col("node").alias("b"), F.col("n").alias("ny"), F.col("sig").alias("gy"))
    pairs = pairs.join(a, "a").join(b, "b").filter(den * F.least("nx", "ny") >= num * F.greatest("nx", "ny"))
    pairs = written(pairs.select("a", "b", "nx", "ny", "gx", "gy").mapInArrow(_signatures_allow(num, den), "a long, b long"), "pairs")
    if is_empty(pairs):
        return pairs
    wanted = pairs.select("a").unionAll(pairs.select("b")).distinct().withColumnRenamed("a", "node")
    wanted = classes.join(wanted, "node", "left_semi").select("d", "h", "g", "node")
    texts = docs.join(wanted.select("d").distinct(), "d", "left_semi")
    sets = texts.select("d", "text").mapInArrow(_full_sets(n), "d long, h long, g long, s binary")
    sets = sets.join(wanted, ["d", "h", "g"]).select("node", "s").dropDuplicates(["node"])
    sets = written(sets, "whole")
    out = pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("sx")), "a").join(sets.select(F.col("node").alias("b"), F.col("s").alias("sy")), "b")
    links = written(out.mapInArrow(similar(num, den), "a long, b long"), "links")
    discard(pairs, sets)
    return links


def op10_ngram_join(spark, sf_dir):
    """Registered query: 3-word shingles, 90 % similarity, over the whole table documents."""
    return ngram_join(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, 9, 10)

