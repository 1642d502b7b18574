"""The registered queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaycast.llm import anchor_tree, line_dedup, sorted_passes, spelling, url_rules
from delaycast.llm.common import crc_remainder, table
from delaycast.workload.registry import Registry

REGISTRY = Registry()
LINE_DEDUP = line_dedup.LineDedupParameters()
PASSES = sorted_passes.PassParameters(cosine=0.98)
URLS = url_rules.UrlParameters()
MINING = anchor_tree.MiningParameters()
SPELLING, SLIP = spelling.SpellingParameters(), 97


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@REGISTRY.query("op9_sentencepiece")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count, id digest and digest of the decoded text of every document."""
    from delaycast.llm.piece_encoding import with_digests

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_digests(documents, tokenizer_path()).drop("text")


@REGISTRY.query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, at most 3 bits."""
    from delaycast.llm.simhash import SimHashParameters, simhash_components

    found = simhash_components(table(spark, sf_dir, "documents"), SimHashParameters(words=3, distance=3))
    return found.selectExpr("doc_id", "lower(lpad(hex(fp), 16, '0')) AS fingerprint", "component_id")


@REGISTRY.query("op10_line_dedup", line_dedup.oracle(LINE_DEDUP.min_words))
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without later copies of repeated line runs."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(documents, LINE_DEDUP, removed="n_deleted")


@REGISTRY.query("op4_string_tiling")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with every benchmark item that it leaks; clean documents have no row."""
    from delaycast.llm.string_tiling import leaked_items

    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@REGISTRY.query("op6_factorization_machine")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; the machine never sees labels of the held-out quarter."""
    from delaycast.llm.factorization import MachineParameters, quality_score, train_quality

    documents, parameters = table(spark, sf_dir, "documents"), MachineParameters()
    machine = train_quality(documents, table(spark, sf_dir, "labels"), parameters)
    scored = documents.select("doc_id", quality_score(documents, machine, parameters).alias("score"))
    return scored.select(
        "doc_id",
        (crc_remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= parameters.threshold).cast("int").alias("predicted"),
    )


@REGISTRY.query("op1_randomness_battery")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: patterns, and strings that the battery finds random."""
    from delaycast.llm.secrets_scan import digest_columns, secret_spans

    return digest_columns(secret_spans(table(spark, sf_dir, "documents")))


@REGISTRY.query("op7_sorted_passes", sorted_passes.oracle(PASSES.cosine))
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and keep mark of every vector, at cosine 0.98 within a label."""
    return sorted_passes.near_vectors(table(spark, sf_dir, "embeddings"), PASSES)


@REGISTRY.query("op2_association_rules", url_rules.oracle(URLS))
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, listed rule and verdict of every page's URL."""
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"), URLS)


@REGISTRY.query("op8_skip_chain")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: patterns, and what the skip-chain field adds."""
    from delaycast.llm.skip_chain import digest_columns, personal_spans

    return digest_columns(personal_spans(table(spark, sf_dir, "documents")))


@REGISTRY.query("op3_gated_recurrent")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; the network never sees labels of the held-out third."""
    from delaycast.llm.gated_recurrent import NetworkParameters, toxicity_score, train_toxicity

    documents, parameters = table(spark, sf_dir, "documents"), NetworkParameters()
    model = train_toxicity(documents, table(spark, sf_dir, "labels"), parameters)
    scored = documents.select("doc_id", toxicity_score(documents, model, parameters).alias("score"))
    return scored.select(
        "doc_id",
        (crc_remainder("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= parameters.threshold).cast("int").alias("predicted"),
    )


@REGISTRY.query("op13_whole_token")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it is over 4096 tokens."""
    from delaycast.llm.token_counts import with_counts

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_counts(documents, tokenizer_path()).drop("text", "n_direct")


@REGISTRY.query("op11_anchor_tree", anchor_tree.oracle(MINING))
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, for each of its five positives; a seventh of the labels moves on."""
    moved = F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)")
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return anchor_tree.mine_negatives(vectors, "vec_id % 100 = 0", MINING)


@REGISTRY.query("op12_finite_state", spelling.oracle(SPELLING, SLIP))
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its near words, its form and the root of its forms."""
    words = spelling.count_words(table(spark, sf_dir, "documents"), SPELLING, slip=SLIP)
    return spelling.spelling_groups(words, SPELLING)
