"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark leaks, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.llm import bpe, decontaminate, jaccard, quality, suffixes
from coffer.llm.shared import Scratch, perhaps_in, ship, without

#: Names for columns of a stage's own; no table has them.
KEY, OWN_SCORE = "_stage_key", "_stage_score"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _keyed(docs: DataFrame) -> DataFrame:
    """docs with a key of each different (doc_id, text): rows without doc_id, or that share one, are told apart."""
    return docs.withColumn(KEY, F.xxhash64("doc_id", "text"))


def _named(keyed: DataFrame) -> DataFrame:
    return keyed.select(F.col(KEY).alias("doc_id"), "text")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold; the classifier learns from the labelled ones among docs.

    Rows are judged one by one by their texts: repeated ones, NULL texts and rows without doc_id too. A column of docs
    that is named score is kept as it is.
    """
    ship(spark)
    weights = quality.train(docs, _table(spark, sf_dir, "labels"))
    own = quality.scored(docs.withColumnsRenamed({"score": OWN_SCORE}), weights)
    good = own.where(F.col("score") >= quality.THRESHOLD).drop("score")
    return good.withColumnsRenamed({OWN_SCORE: "score"}).select(docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest doc_id.

    Rows without doc_id belong to groups like others and stay only where no row of the group has one. Of rows with the
    same doc_id and text one stays; rows that share a doc_id and differ in text are documents of their own. Texts
    without words are near nothing, so they stay.
    """
    ship(spark)
    keyed = _keyed(docs)
    groups = jaccard.near_duplicates(_named(keyed))
    linked = groups.where("component_id <> doc_id").select(F.col("doc_id").alias(KEY), "component_id")
    linked = linked.union(linked.select("component_id", "component_id")).distinct()
    linked = Scratch(spark, "groups").table(linked, "linked")
    ids = perhaps_in(keyed.select("doc_id", KEY), linked, KEY, "_linked").where("_linked")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", KEY))
    kept = linked.join(ids, KEY).groupBy("component_id").agg(first.alias("first"))
    gone = linked.join(kept, "component_id").where(F.col(KEY) != F.col("first")[KEY]).select(KEY)
    rest = without(keyed, gone, KEY)
    # Rows that are repeated move to be told apart, the others stay where they are.
    repeated = keyed.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(KEY)
    marked = perhaps_in(rest, repeated, KEY, "_repeated")
    once = marked.where("_repeated").dropDuplicates([KEY])
    return marked.where("not _repeated").union(once).select(docs.columns)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; n_chars follows. Every document stays, repeated rows
    and rows without doc_id too."""
    ship(spark)
    carried = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    cut = suffixes.without_repeats(docs, carried, as_text=True)
    text = F.col("kept").alias("text")
    columns = {"text": text, "n_chars": F.char_length("kept").cast("long").alias("n_chars")}
    return cut.select(*[columns.get(c, F.col(c)) for c in docs.columns])


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs. Rows are judged by their own texts, with or without
    doc_id; NULL and empty texts stay."""
    ship(spark)
    keyed = _keyed(docs)
    found = decontaminate.hits(_named(keyed), _table(spark, sf_dir, "benchmark"))
    gone = found.where(F.size("spans") > 0).select(F.col("doc_id").alias(KEY)).distinct()
    return without(keyed, gone, KEY).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of what is left; ids are little-endian unsigned 32-bit integers."""
    ship(spark)
    encoded = bpe.encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality", good_quality),
    ("near_copies", one_of_near_copies),
    ("repeated_passages", without_repeated_passages),
    ("leaks", without_leaks),
    ("tokens", tokens),
]

#: Model training, suffix ranks and byte-pair merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
