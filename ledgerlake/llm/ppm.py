"""Language-model scoring by prediction by partial matching (PPM) over bytes, trained on part of the texts.

Model. A text is a sequence of tokens: its words (A-Z lower-cased, runs outside 0x20 and 0x09-0x0D), then one end. It
is spelled byte by byte, each word closed by a space; the end is one symbol. Each symbol is predicted from the ORDER
bytes before it, across words; before a text stand ends and one space. The trie of byte contexts holds counts. Escape
estimation is method D: a symbol seen n times among N in a context with D kinds has (n - 1/2) / N, the
escape to the next shorter context has D / 2N. With symbol exclusion, symbols seen in the longer context count
no longer in the shorter one. Below order 0 the symbols not yet seen share the rest evenly. The score is log10 of the
product over all symbols: a proper probability of the token sequence.

Scale. A context and its symbol (a pair) are at most 7 bytes and packed into one integer. Tasks fold the pairs of their
texts before they are sent, Spark sums them, then each shorter order from the longer one; pairs not seen in training
back off by joins, order by order. Texts take the scores of about FREQUENT pairs and the counts of the HEAD most
frequent words from one bounded broadcast; all other pairs and words are joined. Nothing is capped.

Defined cases. Null and empty texts have one token, the end. Null ids count as training rows (held_out false). Rows
that repeat are scored and counted each. With no training rows, counts are zero and all symbols equally likely.
An empty table gives an empty table. Only the id and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import words as W
from ledgerlake.llm.char_model import row_keys
from ledgerlake.llm.tables import written

ORDER = 6
SYMBOLS = 256 - 6 + 2  # bytes of words, the closing space and the end
HEAD = 1 << 16
FREQUENT = 1 << 21  # pairs that go to every task: 32 MB
HELD = 200_000
HELD_PAIRS = 1 << 21  # pairs that a task holds before it sends on the rare ones among them: 48 MB
STAY = 3 / 8  # the share of these that may stay in the task, the most frequent ones: they would be sent again and again
END = b"\n"


def _emit(counts: dict, names: list[str]):
    k = list(counts)
    v = np.array([counts[x] for x in k], np.int64).reshape(len(k), -1)
    return pa.RecordBatch.from_arrays([pa.array(k, pa.binary()), *[pa.array(v[:, i]) for i in range(v.shape[1])]], names)


def _rare(counts: np.ndarray, stay: int) -> np.ndarray:
    """Which entries a task sends on so that at most `stay` of them, the most frequent ones, remain."""
    if len(counts) <= stay:
        return np.zeros(len(counts), bool)
    return counts <= np.partition(counts, len(counts) - stay - 1)[len(counts) - stay - 1]


def _count_words(batches):
    """(word, training count) of this task's texts, in parts of bounded size; words of other rows come with 0."""
    held, other = Counter(), set()
    for batch in batches:
        train = batch.column(1).to_pylist()
        for block in W.blocks(batch.column(0)):
            low = W.lower_ascii(block.data).tobytes()
            for i in range(block.rows):
                words = low[block.offsets[i] : block.offsets[i + 1]].split()
                if train[block.first + i]:
                    held.update(words)
                    held[END] += 1
                else:
                    other.update(words)
                if len(held) + len(other) > HELD:
                    yield _emit(dict.fromkeys(other, 0) | held, ["word", "c"])
                    held, other = Counter(), set()
    if held or other:
        yield _emit(dict.fromkeys(other, 0) | held, ["word", "c"])


def spelled(*words: bytes) -> bytes:
    """The symbols of words in a row, END last if it is among them, after the space that stands before a text."""
    return b" " + b"".join(w if w == END else w + b" " for w in words)


def pairs_of(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The pair at each symbol of a block's texts as an integer (the symbol in its lowest byte), and the number of symbols of each text."""
    size = ends - starts
    till = np.concatenate([[0], np.cumsum(size + 1)])
    symbols = np.diff(till[first]) + 1
    text_ends = np.cumsum(symbols + order)  # `order` bytes stand before each text
    text_starts = text_ends - symbols
    out = np.full(int(text_ends[-1]), ord(" "), np.uint8)
    # the inside bytes of all words in order, moved on by the spaces, ends and starts before their word
    cum = np.concatenate([[0], np.cumsum(size)])
    inside = np.arange(cum[-1]) + np.repeat(starts - cum[:-1], size)
    row = W.row_of(first)
    out[np.arange(cum[-1]) + np.repeat(np.arange(len(size)) + row + order * (row + 1), size)] = low[inside]
    out[text_ends - 1] = END[0]
    for k in range(order - 1):
        out[text_starts - order + k] = END[0]
    keys, wide = out.astype(np.int64), 1
    while wide <= order:  # each step sets the bytes before in front; where they overlap they are the same
        k = min(wide, order + 1 - wide)
        keys[k:] |= keys[:-k] << (8 * k)
        wide += k
    own = np.ones(len(out), bool)
    for k in range(1, order + 1):
        own[text_starts - k] = False
    return keys[own], symbols


def _folded(keys: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    o = np.argsort(keys)
    keys = keys[o]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.add.reduceat(n[o], at), np.add.reduceat(m[o], at)


def _count_pairs(order: int):
    """(pair, training count, count) of this task's texts, in parts of bounded size."""

    def run(batches):
        names = ["k", "n", "m"]
        held, size = [], 0
        for batch in batches:
            train = batch.column(1).to_numpy(zero_copy_only=False)
            for block in W.blocks(batch.column(0)):
                low = W.lower_ascii(block.data)
                keys, symbols = pairs_of(low, *W.spans(~W.SPACE[low], block.offsets), order)
                # one plain sort for both kinds of rows: the lowest bit says whether the text is for training
                kinds, m = W.counted((keys << 1) | np.repeat(train[block.first : block.first + block.rows], symbols))
                held.append((kinds >> 1, m * (kinds & 1), m))
                size += len(kinds)
                if size > HELD_PAIRS:
                    held = [_folded(*map(np.concatenate, zip(*held, strict=True)))]
                    size = len(held[0][0])
                    if size > HELD_PAIRS // 2:
                        rare = _rare(held[0][2], int(HELD_PAIRS * STAY))
                        yield pa.RecordBatch.from_arrays([pa.array(x[rare]) for x in held[0]], names)
                        held = [tuple(x[~rare] for x in held[0])]
                        size = len(held[0][0])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _folded(*map(np.concatenate, zip(*held, strict=True)))], names)

    return run


def _hash_words(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words]) if words else np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1]]) if words else ends
    return W.span_hashes(np.frombuffer(b"".join(words), np.uint8), starts, ends)


def _hashed_words(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(_hash_words(batch.column(0).to_pylist()).view(np.int64)), batch.column(1)], ["h", "c"])


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each wanted key is among the sorted keys, and where."""
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, at


def _score_pairs(keys: np.ndarray, lp: np.ndarray, pairs: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text the sum over its pairs among the sorted keys; all other pairs by text, and where each text's begin.

    A pair has 7 bytes, so the text's number fits beside it for 256 texts at a time: one plain sort brings equal pairs together.
    """
    till = np.concatenate([[0], np.cumsum(symbols)])
    scores, rest, count = [], [], [np.zeros(1, np.int64)]
    for lo in range(0, len(symbols), 256):
        n = symbols[lo : lo + 256]
        both = np.sort((pairs[till[lo] : till[lo + len(n)]].view(np.uint64) << np.uint64(8)) | np.repeat(np.arange(len(n), dtype=np.uint64), n))
        text, kind = (both & np.uint64(255)).astype(np.int64), (both >> np.uint64(8)).view(np.int64)
        first = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
        times = np.diff(np.append(first, len(kind)))
        known, at = _find(keys, kind[first])
        value = np.where(known, lp[at], 0.0) if len(lp) else np.zeros(len(first))
        scores.append(np.bincount(text, np.repeat(value, times), minlength=len(n)))
        rare = np.flatnonzero(np.repeat(~known, times))
        rare = rare[np.argsort(text[rare], kind="stable")]
        rest.append(kind[rare])
        count.append(np.bincount(text[rare], minlength=len(n)))
    return np.concatenate(scores), np.concatenate(rest), np.cumsum(np.concatenate(count)).astype(np.int32)


def _score_texts(table, unit: float, order: int):
    """Sums over the words and pairs of the broadcast tables; the other words and pairs are listed for a join."""

    def run(batches):
        keys, count, end_c, pair_keys, pair_lp = table.value
        base = np.log10((count + 0.5) / unit)
        numbers = row_keys()
        next(numbers)
        for batch in batches:
            for block in W.blocks(batch.column(2)):
                low = W.lower_ascii(block.data)
                starts, ends, first = W.spans(~W.SPACE[low], block.offsets)
                have, at = _find(keys, W.span_hashes(low, starts, ends))
                pick = lambda v: np.where(have, v[at], 0) if len(v) else np.zeros(len(have))  # noqa: E731,B023
                sums = lambda v: np.bincount(W.row_of(first), v, minlength=block.rows)  # noqa: E731,B023
                text = low.tobytes()
                rest = np.flatnonzero(~have)
                tail = [text[a:b] for a, b in zip(starts[rest], ends[rest], strict=True)]
                tail_first = np.searchsorted(rest, first).astype(np.int32)

                score, rare, rare_first = _score_pairs(pair_keys, pair_lp, *pairs_of(low, starts, ends, first, order))
                part = batch.slice(block.first, block.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(numbers.send(block.rows)),
                        part.column(0),
                        part.column(1),
                        pa.array(np.diff(first) + 1),
                        pa.array(sums(pick(count) > 0).astype(np.int64) + int(end_c > 0)),
                        pa.array(sums(pick(base)) + math.log10((end_c + 0.5) / unit)),
                        pa.array(score),
                        pa.ListArray.from_arrays(pa.array(tail_first), pa.array(tail, pa.binary())),
                        pa.ListArray.from_arrays(pa.array(rare_first), pa.array(rare)),
                    ],
                    ["rid", "d", "held_out", "n_tokens", "n_known", "base_score", "score", "tail", "rare"],
                )
                next(numbers)

    return run


def packed(pair: str) -> Column:
    """A pair of at most 7 bytes as an integer: its bytes, and a 1 in front of them that keeps its length."""
    return F.expr(f"coalesce(cast(conv(hex({pair}), 16, 10) AS long), 0L) | shiftleft(1L, cast(8 * length({pair}) AS int))")


def pair_scores(pairs: DataFrame, order: int) -> DataFrame:
    """(pair, lp, further columns of pairs): log10 probability of every pair's symbol after its context; pairs are binary."""
    scores = key_scores(pairs.withColumn("key", packed("pair")), order)
    return scores.select("pair", "lp", *[c for c in pairs.columns if c not in ("pair", "n")])


def key_scores(pairs: DataFrame, order: int) -> DataFrame:
    """(key, lp, further columns of pairs): log10 probability of every packed pair's symbol after its context, backing off by escapes with exclusion."""
    more = [c for c in pairs.columns if c not in ("key", "n")]
    ctx = F.expr("shiftright(key, 8)")
    suffix = lambda o, c="key": F.expr(f"CASE WHEN {c} >= {1 << (8 * o + 16)}L THEN {c} & {(1 << (8 * o + 8)) - 1}L | {1 << (8 * o + 8)}L ELSE {c} END") if o < ORDER else F.col(c)
    tries = {order: pairs.filter("n > 0").select("key", "n")}
    for o in range(order - 1, -1, -1):
        tries[o] = written(tries[o + 1].groupBy(suffix(o).alias("key")).agg(F.sum("n").alias("n")), f"trie{o}")
    nodes = {o: t.groupBy(ctx.alias("ctx")).agg(F.sum("n").alias("total"), F.count("*").alias("own_kinds")) for o, t in tries.items()}
    seen = pairs.filter("n > 0").withColumn("ctx", ctx).join(nodes[order], "ctx").select("key", F.log10((F.col("n") - 0.5) / F.col("total")).alias("lp"), *more)

    # pairs without a training count: from the longest context down; lp gathers the escapes, `kinds` and `excluded` say
    # how many kinds and counts of the next shorter context are excluded
    todo = pairs.filter("n = 0").select("key", *more, F.lit(0.0).alias("lp"), F.lit(0).cast("long").alias("kinds"))
    todo = todo.withColumn("at", F.col("key"))
    out = [seen]
    excluded = None
    for o in range(order, -1, -1):
        todo = todo.withColumn("at", suffix(o, "at")).withColumn("ctx", F.expr("shiftright(at, 8)"))
        if excluded is None:
            todo = todo.withColumn("gone", F.lit(0).cast("long"))
        else:
            todo = todo.join(excluded, "long_ctx", "left").withColumn("gone", F.coalesce("gone", F.lit(0).cast("long")))
        todo = todo.join(nodes[o], "ctx", "left").join(tries[o].select(F.col("key").alias("at"), "n"), "at", "left")
        left_n, left_d = F.col("total") - F.col("gone"), F.col("own_kinds") - F.col("kinds")
        todo = written(todo.withColumn("left_n", left_n).withColumn("left_d", left_d), "todo")
        found = F.col("n").isNotNull() & (F.col("left_n") > 0)
        out.append(todo.filter(found).select("key", (F.col("lp") + F.log10((F.col("n") - 0.5) / F.col("left_n"))).alias("lp"), *more))
        escape = F.when(F.coalesce(F.col("left_n"), F.lit(0)) > 0, F.log10(0.5 * F.col("left_d") / F.col("left_n"))).otherwise(0.0)
        todo = todo.filter(~found).select("key", *more, (F.col("lp") + escape).alias("lp"), F.coalesce("own_kinds", F.lit(0)).cast("long").alias("kinds"), "at", F.col("ctx").alias("long_ctx"))
        if o:
            # of the next shorter context, the counts of the symbols that this context has
            mine = tries[o].select(ctx.alias("long_ctx"), suffix(o - 1).alias("key"))
            excluded = mine.join(tries[o - 1], "key").groupBy("long_ctx").agg(F.sum("n").alias("gone"))
    out.append(todo.select("key", (F.col("lp") - F.log10(F.greatest(F.lit(SYMBOLS) - F.col("kinds"), F.lit(1)))).alias("lp"), *more))
    total = out[0]
    for x in out[1:]:
        total = total.unionAll(x)
    return total


def ppm_scores(docs: DataFrame, train: str, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, frequent: int = FREQUENT) -> DataFrame:
    """train: SQL over `d` (the id as long), true for the rows to learn from.

    Returns (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score). order is 1 to ORDER.
    """
    if not 1 <= order <= ORDER:
        raise ValueError(f"order must be 1 to {ORDER}")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("d", F.coalesce(~F.expr(train), F.lit(False)).alias("held_out"), "text")
    marked = rows.select("text", ~F.col("held_out"))
    words = written(marked.mapInArrow(_count_words, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")), "words")
    is_end = F.col("word") == F.lit(bytearray(END))
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("N"), F.count_if(F.col("c") > 0).alias("V"), F.coalesce(F.max(F.when(is_end, F.col("c"))), F.lit(0)).alias("ends")).first()
    unit = total["N"] + 0.5 * (total["V"] + 1)
    words = words.filter(~is_end)
    head = words.orderBy(F.desc("c"), "word").limit(HEAD).mapInArrow(_hashed_words, "h long, c long").toArrow()

    # tasks have folded their pairs, so a partial sum before the shuffle would hold them all once more for nothing
    pairs = marked.mapInArrow(_count_pairs(order), "k long, n long, m long").repartition("k").groupBy("k").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    front = 1 << (8 * order + 8)
    pairs = written(pairs.select((F.col("k") + F.lit(front)).alias("key"), "n", "m"), "pairs")
    scores = written(key_scores(pairs, order).select((F.col("key") - F.lit(front)).alias("k"), "m", "lp"), "scores")
    kinds = scores.count()
    least = 0
    if kinds > frequent:  # the rest is joined instead
        least = scores.select(F.percentile_approx("m", 1 - frequent / kinds, 100_000)).first()[0]
    top = scores.filter(F.col("m") > least).select("k", "lp").toArrow()

    sorted_by = lambda k, *v: (k[np.argsort(k)], *[x.to_numpy()[np.argsort(k)] for x in v])
    table = spark.sparkContext.broadcast((*sorted_by(head["h"].to_numpy().view(np.uint64), head["c"]), total["ends"], *sorted_by(top["k"].to_numpy(), top["lp"])))
    sums = "rid long, d long, held_out boolean, n_tokens long, n_known long, base_score double, score double, tail array<binary>, rare array<long>"
    parts = written(rows.mapInArrow(_score_texts(table, unit, order), sums), "parts")
    tail = parts.select("rid", F.explode("tail").alias("word")).groupBy("rid", "word").agg(F.count("*").alias("k")).join(words, "word")
    tail = tail.groupBy("rid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("known"),
        F.sum(F.col("k") * F.log10((F.col("c") + 0.5) / unit)).alias("base"),
    )
    rest = scores.filter(F.col("m") <= least).select("k", F.col("lp").alias("more"))
    rare = parts.select("rid", F.explode("rare").alias("k")).join(rest, "k").groupBy("rid").agg(F.sum("more").alias("lp"))
    out = parts.drop("tail", "rare").join(tail, "rid", "left").join(rare, "rid", "left")
    add = lambda a, b: (F.col(a) + F.coalesce(F.col(b), F.lit(0))).alias(a)
    return out.select(
        F.col("d").alias(id_col), "held_out", "n_tokens", add("n_known", "known"), F.lit(total["N"]).cast("long").alias("train_tokens"), add("base_score", "base"), add("score", "lp")
    )


def op7_ppm(spark, sf_dir):
    """Registered query: learns from the documents whose crc32(doc_id) mod 5 is not 1, scores all."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return ppm_scores(docs, "crc32(cast(cast(d AS string) AS binary)) % 5 <> 1")
