"""From raw documents to training ids.

Each stage takes all that the one before kept, is written as Parquet and read
again.  Quality rules drop documents; of near duplicates (five words, 0.8) the
smallest ``doc_id`` stays; passages of ``PASSAGE_BYTES`` that stand elsewhere
too are cut out of the texts; documents that cover a benchmark item go; what is
left is encoded, decoded and compared.

Null, empty and wordless texts fail the quality rules.  A null ``doc_id`` is larger than
any other, and its rows never go for another's sake in stage 2; rows that share an id stay
or go together there, and are documents of their own in all other stages.  A null ``lang`` or
``source`` is a group of its own.  Every other column is carried along to the last
stage, whatever its name.  Empty tables pass every stage and stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.llm import decontaminate, jaccard, pieces, quality, runindex
from objsync.llm.common import table, written

#: About 50 words of running text with their spaces.
PASSAGE_BYTES = 240


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, words=5, percent=80)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts change, so ``n_chars`` is set anew."""
    out = runindex.strip_repeats(docs, PASSAGE_BYTES)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.round_trip(docs, ["doc_id", "lang", "source"])


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("suffix_array_dedup", suffix_array_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentencepiece),
]

#: Greedy tiling and reachability have no practical SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
