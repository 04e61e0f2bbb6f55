"""Corpus pipeline: from ``documents`` to token ids, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept,
and returns the columns of documents (the last one: token ids).  ``run`` writes
every stage's rows as Parquet under the shared folder and reads them again.

Defined cases hold for every stage as for its operator: null and empty texts
are clean, unique and stay (as empty texts once the suffix stage has rewritten
them); rows that repeat a ``doc_id`` stay or go together; a null ``doc_id``
stays; an empty table gives an empty one; extra columns are left behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, decontam, minhash, suffix_dedup, toxicity
from tidewater.llm.common import pinned, read
from tidewater.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field predicts to be toxic go."""
    model = toxicity.fit(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    scored = toxicity.score(docs, model, carry=tuple(COLUMNS[1:]))
    return scored.filter("predicted = 0").select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar texts (five-word shingles, 0.8) the document
    with the smallest id stays."""
    gone = minhash.near_duplicates(docs, words=5, percent=80).filter("NOT kept").select("doc_id")
    return docs.select(COLUMNS).join(gone.distinct(), "doc_id", "left_anti").select(COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """50-byte strings that a document with a smaller id has are cut out of the
    texts; a character that loses some of its bytes goes whole."""
    cut = suffix_dedup.dedup(docs, carry=("lang", "source"), characters=True)
    return (cut.select("doc_id", F.col("kept").cast("string").alias("text"), "lang", "source")
            .withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    found = decontam.scan(docs, read(spark, sf_dir, "benchmark", "item_id", "text"), carry=COLUMNS[1:])
    return found.filter("NOT contaminated").select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the remaining texts, with digests of the ids and of what
    decoding them gives."""
    return bpe.tokenize(docs, tokenizer_path(), keep=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates),
          ("repeats", cut_repeats), ("decontamination", drop_contaminated), ("tokens", encode)]

#: Spark SQL and DuckDB cannot express the stages; tests hold them against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", *COLUMNS)
    for _, stage in STAGES:
        docs = pinned(stage(spark, docs, sf_dir))
    return docs
