"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerpulse.llm import (
    audit, embeddings, langid, lines, minhash, mixing, phrases, pieces, recipes, suffixes, toxicity, urlfilter, warc,
)
from ledgerpulse.sources.workspace import fresh_path, materialize

RULES = (
    urlfilter.Rule("net", "/", "block"),
    urlfilter.Rule("example.net", "/en/", "allow"),
    urlfilter.Rule("example.com", "/de/", "block"),
    urlfilter.Rule("org", "/fr/", "allow"),
)
#: Weights of the mixture; values that are not listed weigh 1.
WEIGHTS = {
    "domain": {"web": 3, "books": 2, "forum": 1},
    "lang": {"en": 4, "de": 2, "fr": 2, "es": 1},
    "source": {"src0": 2},
}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_warc_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Write all pages as WARC archives, read them back and assemble the transactions."""
    path = fresh_path(spark, "warc")
    warc.write_warc(warc.warc_records(read(spark, folder, "pages")), path)
    records = materialize(warc.read_warc(spark, path, payloads=False, sound=True), "records")
    return warc.capture_digests(warc.assemble(records))


def with_domain(docs: DataFrame) -> DataFrame:
    """Documents with ``domain``: sources by the remainder of their number by three; others are ``web``."""
    number = F.regexp_extract("source", "([0-9]{1,9})$", 1)
    rest = F.when(number != "", number.cast("int") % 3)
    return docs.withColumn("domain", F.when(rest == 1, "books").when(rest == 2, "forum").otherwise("web"))


def op2_source_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of the mixture, once per epoch, for a budget of four fifths of all tokens."""
    docs = with_domain(read(spark, folder, "documents"))
    mixed = mixing.mix(docs, ["domain", "lang", "source"], WEIGHTS, share=0.8)
    return mixed.select("doc_id", "domain", "lang", "source", "epoch", "tokens")


def op3_language_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document by hyperdimensional profiles."""
    return langid.identify(read(spark, folder, "documents"))


def op4_url_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """Rule and verdict of every page's URL."""
    return urlfilter.judge_urls(read(spark, folder, "pages"), RULES)


def op5_pivot_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Links and component of every vector."""
    return embeddings.near_vectors(read(spark, folder, "embeddings"))


def op6_chunk_recipes(spark: SparkSession, folder: str) -> DataFrame:
    """Group of equal texts of every document."""
    return recipes.exact_duplicates(read(spark, folder, "documents"))


def op7_piece_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    coded = pieces.encode(read(spark, folder, "documents").select("doc_id", "text"))
    return pieces.decode(coded).select(
        "doc_id", F.size("ids").alias("n_pieces"), "score", "ids", F.col("decoded").eqNullSafe(F.col("text")).alias("restored")
    )


def op8_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that repeat an earlier one."""
    out = lines.dedup_lines(read(spark, folder, "documents"))
    return out.select("doc_id", "text", "n_chars", F.col("__lines_dropped").alias("lines_dropped"))


def op9_minhash_components(spark: SparkSession, folder: str) -> DataFrame:
    """Component of near-equal texts of every document."""
    return minhash.near_duplicates(read(spark, folder, "documents"), percent=85).drop("own")


def op10_toxicity_trees(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.score_documents(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op11_son_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The best collocations of every language."""
    return phrases.collocations(read(spark, folder, "documents"))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What each filter removes, keeps and loses, per source, order and step."""
    return audit.audit_filters(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op13_suffix_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the 400-byte passages that start anywhere else as well."""
    return suffixes.repeated_passages(read(spark, folder, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_warc_transactions, op2_source_mixture, op3_language_profiles, op4_url_cascade, op5_pivot_neighbours,
        op6_chunk_recipes, op7_piece_scan, op8_fuzzy_lines, op9_minhash_components, op10_toxicity_trees, op11_son_phrases,
        op12_filter_audit, op13_suffix_runs,
    )
}
