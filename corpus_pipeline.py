"""The corpus pipeline: quality, language, near duplicates, source mix, packing.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns of
``documents``; the last returns the packed pieces. ``run`` applies the stages in order, each one's result
written as Parquet below ``spark.checkpoint.dir`` and reread as the next one's input, so a lost executor
never costs more than the stage at hand. Every stage learns from, and works on, all that its predecessor
kept.

What holds for every stage: columns beyond those of ``documents``, whatever their names, travel along (the
last stage returns its own columns); rows are judged by their own values, so repeated rows meet one fate,
but where a stage says otherwise; an empty table gives an empty one, with its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cadastro.llm import language_id, packing, quality, queries, simhash_dedup, source_mix
from cadastro.llm._common import small_batches
from cadastro.session import delete_path, scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that the quality classifier accepts (score of 0.7 or more); it learns from the labels
    of these documents. Null and empty texts are scored as such; a null id has no label, and its text is
    scored like any other. Without labels nothing reaches 0.7."""
    small_batches(spark)
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is known. A null text, or one without a letter, goes; a null ``lang``
    teaches nothing and the document is judged by its text. Where no ``lang`` is set, nothing stays."""
    small_batches(spark)
    return language_id.keep_known_languages(docs, language_id.learn(docs))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, that of the smallest id (null ids last, equal ids
    by a hash of the text). Null texts and texts without a word are near duplicates of each other; of rows
    repeated whole one stays."""
    small_batches(spark)
    return simhash_dedup.drop_near_duplicates(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat (up to 3 times) or drop documents so that the sources meet their target words. A null source is a
    source of its own. Texts without a word weigh nothing and stay once."""
    return source_mix.mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack every row (copies of a document are rows of their own) into sequences of at most 2048 tokens.
    A null or empty text is one piece, the end id alone."""
    small_batches(spark)
    return queries.with_crc32(packing.pack(docs, queries.tokenizer("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", quality_stage),
    ("language ID", language_stage),
    ("SimHash near-dedup", dedup_stage),
    ("mixing sources", mix_stage),
    ("best-fit packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``: the packed pieces of the kept and mixed documents."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = scratch_path(spark, "pipeline", f"stage{k}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:  # the input of the stage just written
            delete_path(spark, before)
        before = path
    return docs
