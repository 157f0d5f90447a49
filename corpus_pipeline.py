"""The corpus pipeline: five stages from raw documents to training windows.

Each stage calls one operator on all that its predecessor kept.  All but the last
return the columns of documents.  Between stages the rows are written as Parquet
in the folder named by spark.checkpoint.dir and read again, so a lost executor
costs a part of one stage at most.

In all stages: extra columns are kept, whatever their names; an empty table stays
empty; null and empty texts pass all stages but the last, where they have no words
and so are in no window; a null doc_id is kept; repeated rows (equal doc_id and
text) are one group of copies, of which one stays; texts are read whole however
long they are.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from papyrine.llm import decontaminate, near_dedup, packing, substring_dedup, toxicity
from papyrine.llm.common import shared_folder


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network trained on `labels` doesn't reject; all where labels lack a class. Rows without words stay."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the least doc_id (nulls last; ties by the text's hash). Rows without words stay."""
    return near_dedup.drop_near_duplicates(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier document (by doc_id, nulls last) has; those of which no word is left are dropped."""
    return substring_dedup.remove_repeated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no run of 13 words with `benchmark`; null and short texts share none."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training windows along paths of related documents; ties stand in order of hashes."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_dedup", without_near_copies),
    ("substring_dedup", without_repeats),
    ("decontaminate", without_benchmark),
    ("packing", packed),
]

#: The trained network, the hash tables and the paths can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents; the last one's rows. Tables without rows, rows that are repeated, nulls and clashing columns are as above."""
    base = os.path.join(shared_folder(spark), f"papyrine-pipeline-{uuid.uuid4().hex}")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None

    def drop(folder: str | None) -> None:
        if folder:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    for k, (name, stage) in enumerate(STAGES[:-1]):
        at = f"{base}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
        drop(before)
        before = at
    out = STAGES[-1][1](spark, docs, sf_dir)  # it reads checkpoints of its own from here on
    drop(base)
    return out
