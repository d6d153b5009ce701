"""The registered queries of the training-data operators; each runs over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.chosen_path import near_duplicates
from tickloom.llm.decontaminate import contained_items
from tickloom.llm.language import identify_held_out
from tickloom.llm.masked_lm import score
from tickloom.llm.packing import pack
from tickloom.llm.pieces import digests
from tickloom.llm.quality import quality
from tickloom.llm.ranked_search import search
from tickloom.llm.secrets import find_secrets
from tickloom.llm.substring_dedup import remove_repeats
from tickloom.llm.suffix_dedup import repeated_passages
from tickloom.llm.url_filter import judge_urls
from tickloom.llm.vector_codes import compress

#: The rules of the contract, and the hosts that the method's own list blocks.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
LISTED = tuple(
    f"{name}.example.{top}/"
    for name in ("ads-track", "free-bets", "cheap-pills", "spam-farm", "casino-win", "adult-x") for top in ("com", "net", "org")
)


#: The vocabulary of packing; a path, never a copy.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: The model of piece encoding; likewise.
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents", "doc_id", "text")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages", "page_id", "url"), RULES, LISTED)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_docs(spark, sf_dir))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(_docs(spark, sf_dir), _table(spark, sf_dir, "benchmark", "item_id", "text"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_docs(spark, sf_dir))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_docs(spark, sf_dir), TOKENIZER)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_docs(spark, sf_dir), digest=True).select(
        "doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256")
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_held_out(_table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_docs(spark, sf_dir)).drop("longest_repeat")


def op9_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_docs(spark, sf_dir))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"]))
    return repeated_passages(_docs(spark, sf_dir)).withColumn("spans", F.array_join(told, ","))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_docs(spark, sf_dir), _table(spark, sf_dir, "benchmark", "item_id", "text"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")).drop("label")


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(_docs(spark, sf_dir), PIECES)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": op1_url_filter,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_decontaminate": op3_decontaminate,
    "op4_secrets": op4_secrets,
    "op5_packing": op5_packing,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_language": op7_language,
    "op8_quality": op8_quality,
    "op9_masked_lm": op9_masked_lm,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_ranked_search": op11_ranked_search,
    "op12_vector_codes": op12_vector_codes,
    "op13_pieces": op13_pieces,
    "pipeline": pipeline,
}
