"""One registered query per operator, over its whole table.

The queries only derive the digest columns; the work is in the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.license_scan import scan
    return scan(read(spark, sf_dir, "documents", "doc_id", "text")).drop("places")


def op2_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """``path``: the tokenizer file, at the same place on every machine."""
    from tidewater.llm.bpe import tokenize
    return tokenize(read(spark, sf_dir, "documents", "doc_id", "text"), path or tokenizer_path(),
                    keep=("n_tokens", "ids_sha256", "decoded_sha256"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.html_extract import extract
    return extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))


#: The conversation the chat query adds.
EXTRA_TEXT = "\\### Assistant: </turn> ok"
EXTRA_TURNS = [(-7, 0, "user", EXTRA_TEXT), (-7, 1, "assistant", EXTRA_TEXT)]


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.chat import digests, format_turns
    rows = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA_TURNS, "conv_id long, turn long, role string, text string")
    return digests(format_turns(rows.unionByName(extra)))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.suffix_dedup import dedup, summary
    return summary(dedup(read(spark, sf_dir, "documents", "doc_id", "text")))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.decontam import scan
    return scan(read(spark, sf_dir, "documents", "doc_id", "text"),
                read(spark, sf_dir, "benchmark", "item_id", "text"))


#: The rules (host, path, verdict) of the URL query, and the
#: hosts its listing blocks where no rule fits.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"),
             ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
URL_LIST = [f"{name}.example.{top}" for top in ("com", "net", "org") for name in (
    "ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.url_filter import LISTING, judge
    listing = spark.createDataFrame(
        [(h, p, h + p, v, 0) for h, p, v in URL_RULES]
        + [(h, "/", h + "/", "block", 1) for h in URL_LIST], LISTING)
    return judge(read(spark, sf_dir, "pages", "page_id", "url"), listing, "page_id", "url")


def op5_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.ann import search
    return search(read(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.toxicity import fit, in_fold, score
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    model = fit(docs, read(spark, sf_dir, "labels", "doc_id", "toxic"))
    return score(docs, model).select("doc_id", in_fold(F.col("doc_id")).alias("held_out"), "score",
                                     "predicted")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.minhash import near_duplicates
    return near_duplicates(read(spark, sf_dir, "documents", "doc_id", "text"), words=4, percent=80)


def op11_token_count(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """``path``: the tokenizer file, at the same place on every machine."""
    from tidewater.llm.token_count import token_counts
    return token_counts(read(spark, sf_dir, "documents", "doc_id", "text"),
                        path or tokenizer_path("byte_bpe_50k.json"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewater.llm.whitening import whiten
    return whiten(read(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op13_alignment(spark: SparkSession, sf_dir: str, path_a: str | None = None,
                   path_b: str | None = None) -> DataFrame:
    """The paths: the tokenizer files, at the same place on every machine."""
    from tidewater.llm.alignment import align
    return align(read(spark, sf_dir, "documents", "doc_id", "text"),
                 path_a or tokenizer_path("byte_bpe_50k.json"), path_b or tokenizer_path("piece_bpe_32k.model"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run
    return run(spark, sf_dir)


def registry() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op")} | {"pipeline": pipeline}
