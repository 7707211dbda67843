"""The queries of this subpackage by name, and SQL for those that SQL can say."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontamination, html_text, language_id, lexical_search, line_dedup, ngram_join, packing, quality_rules, secret_scan, sharding, suffix_dedup, toxicity, whitening
from tidemark.llm.inputs import ship_code, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_code(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


@query()
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and linked component of every document; 3 words, similarity 0.9."""
    return ngram_join.linked_documents(table(spark, sf_dir, "documents"))


@query()
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base verdict and the learned verdict of every document."""
    found = quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "rule",
    )


@query(secret_scan.sql())
def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document and how widely they are owned."""
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query()
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without byte strings that occur before."""
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed vocabulary files are; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query(line_dedup.SQL)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without repeated windows of three lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_repeats(docs).select("doc_id", "n_lines", "n_removed", "text")


@query()
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.main_texts(table(spark, sf_dir, "pages"))


@query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 1024 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path())


@query(decontamination.SQL)
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and items of the benchmark in every document."""
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("n_near")


@query()
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.fit(docs))
    return found.select("doc_id", "held_out", "lang_pred", F.least(F.lit(1.0), "score").alias("score"), "margin", "accepted")


@query()
def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, checksum and place of every document in one of 16 shuffled shards."""
    return sharding.digests(table(spark, sf_dir, "documents"))


@query()
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whitened along the 16 leading components of the distinct ones."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query(lexical_search.SQL)
def op12_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical_search.search(docs, table(spark, sf_dir, "benchmark"))
