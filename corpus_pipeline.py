"""The corpus pipeline: documents to packed sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages
the rows are written as Parquet and read again. All stages but the last return
the columns of ``documents``; ``n_chars`` follows a changed text.

1. toxicity: rows that score 0.5 or more go.
2. line_dedup: repeated lines go, except in the smallest doc_id that holds them.
3. jaccard_join: of documents linked by five-word shingles (similarity 0.8 or
   more, directly or through others) the smallest doc_id stays.
4. decontamination: documents that hold a benchmark item go.
5. packing: what is left becomes sequences of at most 2048 tokens; one row for
   each piece.

Null and empty texts, repeated rows and empty tables: as in each operator's
docstring. An empty text passes the four filters and is packed as its end id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from idloom.llm import decontamination, line_dedup, ngram_join, packing, toxicity
from idloom.llm.storage import new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, "_toxicity").where("_toxicity < 0.5").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    own = {c: f"_own_{c}" for c in docs.columns if c.lower() in ("n_lines", "n_dropped")}  # names that the operator adds
    out = line_dedup.dedup_lines(docs.withColumnsRenamed(own))
    changed = F.col("n_dropped") > 0
    columns = [F.when(changed, F.char_length("text")).otherwise(F.col(c)).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(own.get(c, c)).alias(c) for c in docs.columns]
    return out.select(*columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_of_each(docs, n=5, num=80, den=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_items(docs, _table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.select("doc_id", "text"), packing.public_definition())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: Learning, hashing and tokens have no SQL; the tests compare each stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
