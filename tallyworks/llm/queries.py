"""One query per corpus operator, each over its whole table, with the parameters meant for large inputs."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import alignment, chat, credentials, decontamination, exact, html_blocks, jaccard, language, packing, quality, retrieval, toxicity, url_lm
from tallyworks.llm.common import table

#: Score from which a document counts as toxic.
TOXIC = 0.7
#: Score from which a document counts as good.
GOOD = 0.5
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: Public vocabulary whose pieces the language models are over.
PIECES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALIGNED = alignment.Files(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model"))


URL_RULES = [
    url_lm.Rule("block", "net", "/"),
    url_lm.Rule("allow", "example.net", "/en/"),
    url_lm.Rule("block", "example.com", "/de/"),
    url_lm.Rule("allow", "org", "/fr/"),
]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_lm.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).drop("url")


def op2_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    forged = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(forged).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(extra)
    formatted = F.col("formatted")
    read = chat.format_chats(turns).select(
        "conv_id",
        chat.read_back(formatted).alias("turns"),
        F.array_join(chat.loss_texts(formatted, F.col("loss_runs")), "").alias("loss"),
        F.char_length(formatted).cast("long").alias("formatted_chars"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), TOKENIZER))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    found = credentials.scan(docs, owner=F.col("source"), repository=F.concat_ws("/", "source", "lang"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *(count(kind.name) for kind in credentials.BASE),
        F.sha2(credentials.spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        credentials.spans_text(F.col("base"), F.col("owned")).alias("spans"),
        "n_live",
        "n_copied",
    )


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_blocks.with_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = F.col("contamination")
    return decontamination.contamination(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        found["n_words"].alias("n_words"),
        found["n_hit"].alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", found["items"]).cast("binary"), 256).alias("items_sha256"),
        decontamination.is_contaminated(found).alias("contaminated"),
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC).cast("int").alias("predicted"),
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    scored = quality.score(docs, table(spark, sf_dir, "labels"), F.col("source"), F.col("lang"))
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "classifier",
        "site_posterior",
        "path_posterior",
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
        (F.col("score") >= GOOD).alias("kept"),
    )


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.duplicate_groups(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).drop("vertex", "group")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = retrieval.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(language.held_out(F.col("doc_id")), F.lit(False))
    model = language.fit(docs.where(~held_out), PIECES)
    return language.predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), ALIGNED)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [f for name, f in globals().items() if name.startswith("op") and callable(f)]
    return {f.__name__: f for f in own}
