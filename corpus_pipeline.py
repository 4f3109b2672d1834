"""A training-data pipeline over `documents`: quality, near-dedup, privacy, mixing, packing.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's docs. All but the last return the columns of documents.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courierlake.llm import queries
from courierlake.llm.common import read, settle, workspace
from courierlake.llm.mixing import mixed, own_weights, slot_order
from courierlake.llm.near import keep_first_similar
from courierlake.llm.packing import pack
from courierlake.llm.privacy import sanitise
from courierlake.llm.quality import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust distance reject go."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, Jaccard 0.8 or more) the smallest doc_id stays."""
    return keep_first_similar(docs, shingle=5, least=(4, 5))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is generalised to its kind, terms that disclose it are removed; n_chars follows the text."""
    clean = sanitise(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
        F.length("text").cast(docs.schema["n_chars"].dataType)))


def weights(docs: DataFrame) -> tuple[dict[str, int], int, int]:
    return *own_weights(docs, queries.WEIGHTS, queries.REST_WEIGHT), queries.BLOCK_CHARS


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the slots that their sources' weights give them."""
    return mixed(docs, *weights(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with the sequence and the place each one goes to, by the slots of their documents.

    The mix depends on its rows and not on their order, so the slots are those of the stage before.
    """
    return pack(docs, queries.vocabulary(), capacity=4096, end_id=1, slots=slot_order(docs, *weights(docs)))


STAGES = [("quality rules", quality_rules), ("SimHash near-dedup", near_dedup), ("privacy", privacy),
          ("source mixing", source_mix), ("best-fit packing", packing)]

#: SimHash and the tokenizer are beyond SQL; tests hold the pipeline against plain versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = read(spark, sf_dir, "documents"), workspace(spark)
    for n, (_, stage) in enumerate(STAGES):
        docs = settle(stage(spark, docs, sf_dir), folder, f"stage-{n}")
    return docs
