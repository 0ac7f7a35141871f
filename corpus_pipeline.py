"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and returns the next stage's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from canonix.llm.bpe import encode_documents
from canonix.llm.decontaminate import drop_contaminated
from canonix.llm.lines import drop_repeated_lines
from canonix.llm.neardup import keep_one_of_each
from canonix.llm.quality import keep_good
from canonix.session import scratch_path


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage: the token ids of every text that is left, packed as unsigned 32-bit integers."""
    return encode_documents(docs, keep=tuple(c for c in docs.columns if c != "text"))


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode),
]

#: The quality classifier's sampling and the tokenizer's ids are beyond SQL. tests/llm/test_pipeline.py runs the chain on a
#: small corpus and compares each stage with brute force; of the quality classifier the draw, not the scores.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = scratch_path(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
