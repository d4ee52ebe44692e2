"""The operators applied to whole tables, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


PIECE_MODEL = "piece_bpe_32k.model"


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as digests."""
    import public_tokenizers

    from coldshelf.llm.pieces import encode_texts

    return encode_texts(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path(PIECE_MODEL),
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
    )


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the groups of those within four bits."""
    from coldshelf.llm.simhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, bits=4)


@query
def op7_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality counts of all documents, and which are left after common lines are removed."""
    from coldshelf.llm.lines import line_frequency

    return line_frequency(_table(spark, sf_dir, "documents"))


@query
def op10_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents, told apart by the sources that hold them."""
    from pyspark.sql import functions as F

    from coldshelf.llm.ownership import secret_scan

    return secret_scan(
        _table(spark, sf_dir, "documents"), owner=F.col("source"), repository=F.concat_ws("/", "source", "lang")
    )


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    from coldshelf.llm.toxicity import toxicity_scores

    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, with the alignment's score and place."""
    from coldshelf.llm.decontamination import find_leaks

    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from seekable archives."""
    from coldshelf.llm.archives import archive_round_trip

    return archive_round_trip(_table(spark, sf_dir, "pages"))


PSEUDONYM_KEY = "corpus-2024"  # a deployment passes a secret of its own


@query
def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with personal numbers, dates and addresses replaced by pseudonyms."""
    from coldshelf.llm.pseudonyms import pseudonymize

    return pseudonymize(_table(spark, sf_dir, "documents"), key=PSEUDONYM_KEY)


@query
def op3_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document, which is encoded whole."""
    import public_tokenizers

    from coldshelf.llm.attribution import count_section_tokens

    return count_section_tokens(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


@query
def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages that documents share with earlier ones, edited ones included."""
    from coldshelf.llm.passages import shared_passages

    return shared_passages(_table(spark, sf_dir, "documents"))


@query
def op11_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers over all documents, aligned where both end."""
    import public_tokenizers

    from coldshelf.llm.crosswise import align_tokenizers

    return align_tokenizers(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        public_tokenizers.path(PIECE_MODEL),
    )


@query
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents with equal texts."""
    from coldshelf.llm.exact import exact_duplicates

    return exact_duplicates(_table(spark, sf_dir, "documents"))


SQL["op12_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings whitened by their four leading components."""
    from coldshelf.llm.whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings"))
