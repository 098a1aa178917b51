"""From raw documents to sharded training documents, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet to the
shared folder and reads again for the next stage. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm import decontamination, mixing, ngram_join, sharding, toxicity
from tallyhouse.llm.frames import prepare
from tallyhouse.llm.storage import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network, trained on labels, rejects go."""
    prepare(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels = labels.select("doc_id", F.col("toxic").alias("label"))
    return toxicity.without_toxic(docs, labels)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 of five-word shingles, the smallest id stays."""
    prepare(spark)
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up a twentieth or more go."""
    prepare(spark)
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs, mixing.mix(docs))


def place(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its slot and shard."""
    return sharding.shard(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", place),
]

#: The first stage scores with a trained network, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
