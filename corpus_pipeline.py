"""A corpus from raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the result of a
stage is written as Parquet and read again as the documents of the next one.
All but the last return the columns of the documents.

1. language ID: documents without a recognised language go (null and letterless
   texts); a low probability alone, as short texts have, drops nothing, and
   where no language could be learned every text with a letter stays
2. exact dedup: of equal texts the row with the smallest id stays
3. near dedup: of texts that are linked, directly or not, one stays
4. personal data: every span found is replaced by its kind; ``n_chars`` follows
5. packing: sequences of at most 2048 tokens
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, langid, near_dedup, packing, pii
from tidemark.llm.common import materialise, table
from tidemark.llm.queries import tokenizer_file


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs, may_learn=~langid.held_out("doc_id", 4, 2))
    if not model.languages:  # predict would call every text unknown
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    scored = langid.predict(docs, model, out_cols=("__lang_pred", "__lang_score"))
    return scored.filter(F.col("__lang_pred") != "und").select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_copies(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.mask(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("best_fit_packing", pack_sequences),
]

#: language ID, near copies and tokens can't be stated in SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
