"""The corpus pipeline: language ID, toxicity, near duplicates, repeated
passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows it is given; all
but the last return the columns of ``documents``. ``run`` writes the result
of each stage as Parquet into the shared checkpoint folder and reads it back,
so a lost executor costs one stage at most; what a stage has read goes once
its own result is written.

Defined cases, by stage:

* language: a row whose text is null or has no letter goes, and so does one
  that is like none of the learnt languages; where nothing can be learnt
  (no labelled row) every row goes as ``und``.
* toxicity: a row that scores 0.5 or more goes; without labels none goes.
* near duplicates: of each component one row stays, the one with the smallest
  doc_id (a null id counts as the largest); of repeated rows any one.
* repeated passages: rows stay, their texts lose every byte that a repeated
  400-byte string or a repeated run of over 50 words covers (whatever its
  bytes), and n_chars follows; a text may become empty.
* packing: every row's pieces, with sequence and offset.

Rows pass through whole, with any extra columns they have; an empty table
gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tellus.llm import langid, packing, simhash, suffixes, toxicity
from tellus.llm.common import discard, table, written


#: Words of a passage that may not repeat: over 50.
PASSAGE_WORDS = 51


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_known(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.remove_from_texts(docs, words=PASSAGE_WORDS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    p = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(p.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


STAGES = [
    ("language_id", language),
    ("toxicity", clean),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_dedup", passages),
    ("best_fit_packing", packed),
]

#: Models and tokenizers can't be written in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
