"""Preparing a training corpus: one stage after the other over the documents table.

quality      rows that the quality classifier rejects go
near_dedup   one row of each SimHash component stays, the one with the least doc_id; similarity of about 0.8 on five-word shingles
passages     passages of 200 bytes or more that occur more than once are cut out
pii          personal data is replaced by surrogates
packing      the texts that are left are packed into sequences of 1024 tokens

All stages but the last return the columns of documents. Null texts count as empty and come out of the third stage as
such. A cut may leave part of a character, which goes too; n_chars is that of the text as it leaves the third and
fourth stages. Repeated rows are one component, so one stays; rows without an id stay if no row of their component has one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rangeloom.llm import classifier, packing, pii, simhash, suffix_dedup
from rangeloom.llm.common import importable, new_folder, read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return classifier.accepted(docs.select(*COLUMNS), read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs.select(*COLUMNS))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = suffix_dedup.remove_repeats(docs.select(*COLUMNS), carry=("lang", "source"))
    # cutting bytes can leave the first or last bytes of a character
    raw = F.col("kept").cast("string")
    text = F.when(F.is_valid_utf8(raw), raw).otherwise(F.replace(F.make_valid_utf8(raw), F.lit("\ufffd"), F.lit("")))
    return kept.select("doc_id", text.alias("text"), "lang", "source").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replaced_in_place(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.select(*COLUMNS))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("passages", passages), ("pii", private), ("packing", packed)]

#: A classifier, byte-level removal, keyed surrogates and a packing search are not SQL; tests/llm/test_pipeline.py compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every other stage is written as Parquet and read back."""
    importable(spark)
    folder = new_folder(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.parquet(f"{folder}/{i}-{name}")
            docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
