"""Corpus preparation in five stages, each over all that the one before kept.

toxicity -> line dedup -> MinHash near-dedup -> mixing -> packing.  ``run`` writes every stage
as Parquet into the shared checkpoint folder and reads it back, as a scheduler would between jobs.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.common import ensure_checkpoint_dir, table
from siltstone.llm.line_dedup import remove_repeated_lines
from siltstone.llm.minhash import one_of_each
from siltstone.llm.mixing import fit_rates, learn_domains, mix_documents
from siltstone.llm.packing import pack_documents
from siltstone.llm.toxicity import learn_toxicity, reject_toxic

#: Target shares of tokens of good and of low quality.
MIX = (0.85, 0.15)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a machine fitted on ``labels`` scores as toxic go.

    Null and empty texts and null ids stay (no term, no score above the threshold); repeated rows share their fate.
    Without labels nothing is toxic. An empty table stays empty. Columns of any name pass.
    """
    return reject_toxic(docs, learn_toxicity(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three consecutive lines go; ``n_chars``, if there is one, follows a changed text.

    Null texts stay null, a text that loses all lines becomes empty; rows never go. Repeated rows count once and all get
    the result; null ids order first. An empty table stays empty. Columns that the operator adds may exist: they pass.
    """
    names = [f"_d{k}" if c.lower() in ("n_lines", "n_removed") else c for k, c in enumerate(docs.columns)]
    out = remove_repeated_lines(docs.toDF(*names))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*names).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that with the smallest id.

    Rows without an id stay only where their class has no id; of rows that repeat id and text one stays; null and empty
    texts are one class. An empty table stays empty. Columns of any name pass.
    """
    return one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated so that expected tokens by quality match ``MIX``; none is dropped.

    Null and empty texts have no tokens and stay once; null ids pass; repeated rows are repeated alike. Without labels
    the domains can't be told apart, and every row stays. An empty table stays empty. Columns of any name pass.
    """
    labels = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0).alias("_y"))
    model = learn_domains(docs, labels, len(MIX))
    return mix_documents(docs, model, fit_rates(docs, model, list(MIX), least=1.0))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two lengths up to 4096, one row a piece.

    A null or empty text is its end id alone; null ids pass; repeated rows are packed each by itself; an empty table
    gives an empty result; other columns are left out.
    """
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mixing), ("packing", packing)]

#: SQL can't express the classifiers, the sampling of band candidates and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
