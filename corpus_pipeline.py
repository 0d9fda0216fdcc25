"""The corpus pipeline: documents to packed training sequences.

``STAGES`` lists (name, function) in order. Each function takes (spark, docs,
sf_dir) and returns a DataFrame; all but the last return the columns of
``docs``. ``run`` writes each stage's rows as Parquet into the shared folder and
reads them back as the next stage's documents, so a lost executor never makes
earlier stages run again.

1. quality rules: rejected documents go;
2. SimHash near-duplicates: one document of each group stays, the one with the
   smallest id (4-word shingles, at most 4 differing bits, as in the operator's
   contract);
3. repeated byte strings: texts are cut, and n_chars counted anew; a document
   whose text is gone stays with the empty text;
4. mixing: documents are chosen once per epoch, whole, so a document may come
   twice;
5. packing: a row per piece of a document.

SQL can't express the fingerprints' groups, the byte strings and the packing
together, so there is no ORACLE_SQL; tests compare every stage with brute force."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeops.llm import mixing, packing, quality, simhash, suffix
from lakeops.llm.base import intermediates, table, written
from lakeops.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.representatives(docs, shingle=4, max_bits=4)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix.without_repeats(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_documents(docs, tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("simhash_near_dedup", near_dedup),
          ("suffix_array_dedup", repeat_removal), ("source_mixing", source_mixing),
          ("best_fit_packing", sequence_packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        with intermediates(spark) as made:
            docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
            made.pop()      # the stage's own rows stay; what it wrote on the way goes
    return STAGES[-1][1](spark, docs, sf_dir)
