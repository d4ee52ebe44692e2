"""A training corpus out of raw documents, in five stages.

Every stage takes all that the one before it kept and returns documents; the last one
returns their tokens.  Between stages the documents are written as Parquet and read again.

All stages read whole texts of any length, keep null and empty texts unless a rule below
takes them, treat repeated rows alike, give an empty table for an empty one, and return the
columns of documents alone, whatever other columns there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldshelf.llm import queries
from coldshelf.llm.decontamination import find_leaks
from coldshelf.llm.pieces import encode_texts
from coldshelf.llm.pseudonyms import pseudonymize
from coldshelf.llm.simhash import near_duplicates
from coldshelf.llm.toxicity import toxicity_scores
from coldshelf.plans.staging import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go.

    That is a score of one half or more, a tie included.  A document without words, or
    without an id, is judged like any other.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity_scores(docs, labels, carry=tuple(c for c in COLUMNS if c != "doc_id"))
    return scored.where("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document with the least id stays.

    Rows repeated with one id are one document; one without an id can't be named and stays.
    """
    groups = near_duplicates(docs, shingle=4, bits=4)
    gone = stage(groups.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    All rows with the id of such a document go; one without an id can't be named and stays.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    leaks = stage(find_leaks(docs, items).select("doc_id").distinct(), "leaks")
    return docs.join(leaks, "doc_id", "left_anti").select(*COLUMNS)


def replace_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses become pseudonyms; the length follows the text.

    No row goes; a null text stays null, and its length becomes null.
    """
    replaced = pseudonymize(docs, key=queries.PSEUDONYM_KEY)
    return replaced.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of what is left: their number, and digests of the ids and the decoded text.

    One row per document; null and empty texts have no tokens.
    """
    import public_tokenizers

    return encode_texts(
        docs, public_tokenizers.path(queries.PIECE_MODEL), outputs=("n_tokens", "ids_sha256", "decoded_sha256")
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("personal data", replace_personal),
    ("tokens", encode),
]

# hashes of word runs, a trained classifier and an alignment are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents below ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
