"""The corpus pipeline over the table documents: quality rules, line dedup, near-duplicate join, decontamination, tokenisation.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the same columns; the last returns
the encoded texts. run() writes each stage's result as Parquet below spark.checkpoint.dir, reads it for the next, and then deletes what the
stage was made from.

Rows are judged by their own values, so repeated rows share their fate except where they are the duplicates to remove.
A null id is kept as null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.bpe_automaton import bpe, default_path
from ledgerlake.llm.decontaminate import leaks
from ledgerlake.llm.line_dedup import line_dedup
from ledgerlake.llm.ngram_join import ngram_join
from ledgerlake.llm.quality_rules import quality_rules
from ledgerlake.llm.tables import discard, intermediates, written


def _same(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep (operator 9).

    The rules judge a row by its language and text alone, so what they reject is a table of 128 bits for each of these:
    the texts are in none of the intermediate tables, and these go before the next stage.
    """
    same = [F.coalesce(docs["lang"].cast("string"), F.lit("\0")), docs["text"].cast("string")]
    keys = [F.xxhash64(*same), F.xxhash64(F.lit(1), *same)]
    with intermediates() as made:
        judged, p = quality_rules(docs.select("lang", "text", keys[0].alias("k"), keys[1].alias("k2")), keep=["k", "k2"])
    rejected = written(judged.filter(~F.col(p + "kept")).select("k", "k2").distinct(), "rejected")
    discard(*made)
    return _same(docs.join(rejected, (keys[0] == rejected["k"]) & (keys[1] == rejected["k2"]), "left_anti"), docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier similar line (operator 8); a document left without words goes."""
    cleaned = line_dedup(docs, key_cols=[c for c in docs.columns if c not in ("doc_id", "text")])
    cleaned = cleaned.filter((F.size("removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast("long"))
    return _same(cleaned, docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (operator 10; 5-word shingles, similarity 0.8): the smallest doc_id.

    Of rows that repeat this doc_id one stays. Documents with a null id or without words stay.
    """
    groups = ngram_join(docs, 5, 4, 5)
    stays = groups.filter((F.col("doc_id") == F.col("component_id")) & (F.col("n_shingles") > 0)).select("doc_id").distinct()
    alone = groups.filter(F.col("n_shingles") == 0).select("doc_id").distinct()
    first = docs.join(stays, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    wordless = docs.filter(~F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)) & F.col("doc_id").isNotNull()).join(alone, "doc_id", "left_semi")
    wordless = wordless.join(stays, "doc_id", "left_anti")
    out = first.unionByName(wordless).unionByName(docs.filter(F.col("doc_id").isNull()))
    return _same(out, docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (operator 2)."""
    found = written(leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct(), "leaked")
    return _same(docs.join(found, "doc_id", "left_anti"), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts as token ids (operator 6)."""
    return bpe(docs, default_path())


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("ngram_join", near_duplicates), ("decontaminate", decontaminate), ("encode", encode)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with intermediates() as made:
            docs = written(stage(spark, docs, sf_dir), name)
        # the stage's result is in a table: what it was made from has no reader any more
        discard(*[t for t in made if t is not docs], *([before] if before is not None else []))
        before = docs
    return docs
