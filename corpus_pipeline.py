"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every result as Parquet in the shared folder and reads it back as the next
stage's documents.  All but the last return the columns of ``documents``.

1. quality: documents that the classifier rejects go;
2. lines: near-identical lines after the first are taken out of the texts, and
   every document stays;
3. near duplicates: one document of each group stays;
4. mix: sources are repeated or cut to their target weights;
5. pack: texts become token pieces of full sequences.

Null and empty texts are kept by no quality rule of their own: they get the
classifier's score of such a text, and where they stay, stages 2 and 3 leave
them alone and stage 4 takes none of their words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dyadlake.llm import line_dedup, mixing, near_dedup, packing, quality_model
from dyadlake.llm.store import discard, documents, materialize


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows the text that stage 2 or 4 has changed."""
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long")) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_model.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_model.keep_quality(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(line_dedup.drop_duplicate_lines(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(mixing.mixed_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(packing.VOCABULARY))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

#: SQL expresses no trained model, no sketch and no tokenizer: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            discard(before)
        before = docs
    return docs
