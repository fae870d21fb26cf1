"""The corpus pipeline: from raw documents to packed sequences.

Each stage takes all that the stage before has kept, and returns the rows that go on. Between the stages
tables are written, so a lost executor costs a stage's tasks at most.

Every stage takes null ids, texts and sources, empty and very long texts, repeated rows, empty tables and
further columns of any name; all but the last return the columns they got. What each does with them is
said there, by the operator that it calls in detail.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dayferry.frames import scratch, written
from dayferry.llm.jaccard import one_of_each_class
from dayferry.llm.mixing import mix
from dayferry.llm.packing import pack
from dayferry.llm.quality import judge, trusted_ids
from dayferry.llm.toxicity import score_toxicity
from dayferry.llm.workers import reaching_workers

READ = ("doc_id", "text", "source")  # columns that stages read
TOKENIZER = "byte_bpe_50k.json"
#: Tokens and pieces that a Python worker remembers. It outlives its stage, beside the memory of the next ones.
REMEMBERED = 100_000


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keeps_columns(stage: Callable) -> Callable:
    """A stage that returns the columns it got; those it does not read can't clash with any that its operator adds."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in READ else f"__further_{i}" for i, c in enumerate(docs.columns)]
        made = stage(spark, docs.toDF(*names), sf_dir)
        return made.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])

    return run


@keeps_columns
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. A null or empty text has no words and goes; rows that repeat fare alike."""
    judged = judge(docs, trusted_ids(_labels(spark, sf_dir)))
    return judged.where("kept")


@reaching_workers
@keeps_columns
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic. A null or empty text stays; without labels of both classes all do."""
    scored = score_toxicity(docs, _labels(spark, sf_dir).select("doc_id", "toxic"), remembered=REMEMBERED)
    return scored.where(F.col("predicted") == 0)


@reaching_workers
@keeps_columns
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of similar texts: the least id's, a null one only if there is no other.

    Texts without a word, null ones too, are classes of their own row each; of rows that repeat as a whole one stays.
    """
    return one_of_each_class(docs)


@keeps_columns
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; null is a source of its own, and texts without a word come once."""
    return mix(docs).withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))


@reaching_workers
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, packed into sequences. A null text is empty and has the end id alone."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path(TOKENIZER), remembered=REMEMBERED)


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", packing),
]

ORACLE_SQL = None  # SQL has no trained models, sampled paths or tokenizers


def write_corpus(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the packed corpus to a path, and delete what was written on the way."""
    with scratch(spark):
        run(spark, sf_dir).write.parquet(path)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus. It is read from folders between the stages, which stay until somebody deletes them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
