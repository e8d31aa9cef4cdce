"""Quality rules: counts per text, and bands of n-gram perplexity per language.

Method. A modified Kneser-Ney model over character 5-grams is counted by Spark for each language (see char_model): real code
points, no cap on the keys, tables joined by n-gram. A text is scored by the model of the half of the texts that it is
not in. Its perplexity is 10^(-log10 probability per character). Per language the middle of the log perplexities and
their spread (quartiles) give a lower and an upper band; a text outside is rejected.

Counts. Words are runs outside 0x20 and 0x09-0x0D, as written. See the operator's column list.

Defined cases. Null text: no words, rejected. Empty text or no words: rejected (fewer than 10 words). Null language: a
language of its own. Languages whose texts all have one perplexity get bands around it. Rows that repeat are judged
alike. An empty table gives an empty table. The columns asked for are kept; the added ones get a prefix that is
free, so that no name clashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm import char_model
from ledgerlake.llm import words as W
from ledgerlake.llm.tables import written

SPREADS = 3.0  # see the tests for the share of spoiled texts that these bands reject
FLOOR = 0.05
SHORT = 150  # the bands widen by sqrt(1 + SHORT / characters): a short text's mean is less certain
MIN_WORDS = 10
REPEAT_PERCENT = 20
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def counts(block: W.Block) -> list[np.ndarray]:
    """The columns FEATURES of each row.

    n_words; word_chars: code points in words; n_symbols: characters of [#*$%&|<>]; n_dup_lines: lines with a word that
    equal an earlier line; n_repeat_words: words in 5-word windows that occur twice or more in the text.
    """
    data, offsets, rows = block.data, block.offsets, block.rows
    h, starts, _, first = W.words(block, False)
    letters = ~W.SPACE[data] & ((data & 0xC0) != 0x80)
    ls, le, lf = W.spans(data != 10, offsets)
    with_word = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    lh, lr = W.span_hashes(data, ls, le)[with_word], W.row_of(lf)[with_word]
    dup = np.bincount(lr, minlength=rows)
    if len(lh):
        o = np.lexsort((lh, lr))
        new = np.concatenate([[True], (lh[o][1:] != lh[o][:-1]) | (lr[o][1:] != lr[o][:-1])])
        dup = dup - np.bincount(lr[o][new], minlength=rows)
    row = W.row_of(first)
    g = W.ngrams(h, 5)
    at = np.flatnonzero(first[1:][row[: len(g)]] - np.arange(len(g)) >= 5)
    key = W.mix(g[at] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    o = np.argsort(key, kind="stable")
    k = key[o]
    same = np.zeros(len(k), bool)
    if len(k) > 1:
        eq = k[1:] == k[:-1]
        same[1:] |= eq
        same[:-1] |= eq
    hit = np.zeros(len(h) + 1, np.int64)
    begin = at[o[same]]
    np.add.at(hit, begin, 1)
    np.add.at(hit, begin + 5, -1)
    inside = np.cumsum(hit[:-1]) > 0
    return [np.diff(first), row_sums(letters, offsets), row_sums(SYMBOL[data], offsets), dup, row_sums(inside, first)]


def _free_prefix(names: list[str]) -> str:
    p = "q_"
    while any(n.lower().startswith(p) for n in names):
        p = "q" + p
    return p


def quality_rules(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", spreads: float = SPREADS, keep: list[str] | None = None, frequent: int = char_model.FREQUENT
) -> tuple[DataFrame, str]:
    """The columns `keep` of docs (all if None), and with the returned prefix: FEATURES, chars, log_ppl, base_failed, kept."""
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    p = _free_prefix(docs.columns)
    lang = F.xxhash64(F.coalesce(F.col(lang_col).cast("string"), F.lit("\0"))).alias(p + "l")
    rows = docs.select(F.col(text_col).cast("string").alias(p + "text"), lang, *keep)
    top, rest = char_model.fit(rows.select(F.col(p + "text").alias("text"), F.col(p + "l").alias("l")), frequent)
    table = spark.sparkContext.broadcast(top)
    added = {**dict.fromkeys(FEATURES, T.LongType()), "row": T.LongType(), "chars": T.LongType(), "lp": T.LongType(), "rare": T.ArrayType(T.LongType()), "side": T.LongType()}

    def score(batches):
        keys = char_model.row_keys()
        for batch in batches:
            lang = batch.column(1).to_numpy()
            for block in W.blocks(batch.column(0), char_model.BLOCK):
                next(keys)
                numbers = keys.send(block.rows)
                size, lp, rare, side = char_model.score_block(table.value, block, lang[block.first : block.first + block.rows])
                part = batch.slice(block.first, block.rows)
                cols = [*counts(block), numbers, size, lp, rare, side]
                cols = [c if isinstance(c, pa.Array) else pa.array(c.astype(np.int64)) for c in cols]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *cols], [*batch.schema.names[1:], *[p + f for f in added]])

    schema = T.StructType([*rows.schema.fields[1:], *[T.StructField(p + f, t) for f, t in added.items()]])
    scored = written(rows.mapInArrow(score, schema), "scored")
    more = char_model.rare_sums(scored, rest, p + "row", p + "rare", p + "side").withColumnRenamed("more", p + "more")
    total = (F.col(p + "lp") + F.coalesce(p + "more", F.lit(0))) / char_model.MICRO
    log_ppl = F.when(F.col(p + "chars") > 0, -total / F.col(p + "chars"))
    failed = (F.col(p + "n_words") < MIN_WORDS) | (100 * F.col(p + "n_repeat_words") > REPEAT_PERCENT * F.col(p + "n_words"))
    judged = scored.select(p + "row", p + "l", p + "chars", p + "lp", failed.alias(p + "base_failed")).join(more, p + "row", "left").withColumn(p + "log_ppl", log_ppl)
    judged = written(judged.select(p + "row", p + "l", p + "chars", p + "base_failed", p + "log_ppl"), "judged")
    quartiles = F.percentile_approx(p + "log_ppl", [0.25, 0.5, 0.75], 10_000)
    bands = judged.filter(~F.col(p + "base_failed")).groupBy(p + "l").agg(quartiles.alias("q"))
    spread = F.greatest(F.col("q")[2] - F.col("q")[0], F.lit(FLOOR / spreads))
    bands = bands.select(p + "l", F.col("q")[1].alias(p + "mid"), (spreads * spread).alias(p + "wide"))
    # a table of its own: the join may then become a broadcast on its measured size, or split a frequent language
    bands = written(bands, "bands")
    inside = F.abs(F.col(p + "log_ppl") - F.col(p + "mid")) <= F.col(p + "wide") * F.sqrt(1 + SHORT / F.col(p + "chars"))
    verdict = judged.join(bands, p + "l", "left").withColumn(p + "kept", ~F.col(p + "base_failed") & F.coalesce(inside, F.lit(False)))
    verdict = verdict.select(p + "row", p + "chars", p + "log_ppl", p + "base_failed", p + "kept")
    out = scored.drop(*[p + c for c in ("l", "chars", "lp", "rare", "side")]).join(verdict, p + "row")
    return out.select(*keep, *[p + c for c in [*FEATURES, "chars", "log_ppl", "base_failed", "kept"]]), p


def op9_quality_rules(spark, sf_dir):
    """Registered query: the rules over all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    judged, p = quality_rules(docs, keep=["doc_id"])
    names = [*FEATURES, "base_failed", "kept"]
    return judged.select("doc_id", *[F.col(p + c).alias(c) for c in names], F.pow(F.lit(10.0), p + "log_ppl").alias("perplexity"))
