"""The registered queries of the operators in this folder, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.collocations import collocations
from wordloom.llm.exact_duplicates import exact_duplicates
from wordloom.llm.fingerprints import fingerprints_with_edits
from wordloom.llm.line_duplicates import deduplicated
from wordloom.llm.mixing import mix
from wordloom.llm.near_duplicates import near_duplicates
from wordloom.llm.oracles import ORACLES  # noqa: F401
from wordloom.llm.quality import quality_scores
from wordloom.llm.scoring import language_scores
from wordloom.llm.sentence_pieces import digests
from wordloom.llm.sharding import shards
from wordloom.llm.top_inner_products import top_inner_products
from wordloom.llm.warc import fixity_audit, laid_out
from wordloom.llm.whitening import whitened
from wordloom.sources.reviews import read_table


def documents(spark, folder) -> DataFrame:
    return read_table(spark, folder, "documents")


def op1_exact_dedup(spark, folder):
    return exact_duplicates(documents(spark, folder), keep="largest")


def op2_lattice_scores(spark, folder):
    return language_scores(documents(spark, folder), piece_model())


def op3_minhash_near_dedup(spark, folder):
    return near_duplicates(documents(spark, folder), percent=85).drop("text_key")


def op4_sharding(spark, folder):
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return shards(documents(spark, folder), 8).select("*", law, grown)


def op5_warc_fixity(spark, folder):
    """All pages as an archive, against a replica in which some last characters are changed and
    some records are gone."""
    pages = read_table(spark, folder, "pages")
    cut_short = F.expr("concat(substring(html, 1, length(html) - 1), '~')")
    hit = F.col("page_id") % 97 == 13
    replica = laid_out(pages.withColumn("html", F.when(hit, cut_short).otherwise(F.col("html"))))
    replica = replica.filter("page_id % 211 <> 17")
    return fixity_audit(laid_out(pages), replica)


def op6_imatch_fingerprints(spark, folder):
    return fingerprints_with_edits(documents(spark, folder))


def op7_mixing(spark, folder):
    table, _ = mix(documents(spark, folder))
    return table.select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken"
    )


def op8_line_dedup(spark, folder):
    rest = deduplicated(documents(spark, folder))
    return rest.select(
        "doc_id",
        "lines_removed",
        F.char_length("text").cast("long").alias("n_chars_left"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def piece_model() -> str:
    """The vocabulary file that the queries encode with; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op9_sentence_pieces(spark, folder):
    return digests(documents(spark, folder), piece_model())


def op10_quality_classifier(spark, folder):
    return quality_scores(documents(spark, folder), read_table(spark, folder, "labels"))


def op11_sorted_list_search(spark, folder):
    """Every hundredth vector's ten greatest inner products with all others."""
    rows = read_table(spark, folder, "embeddings")
    return top_inner_products(rows, F.col("vec_id") % 100 == 0, k=10, scale=1024)


def op12_block_whitening(spark, folder):
    rows = read_table(spark, folder, "embeddings")
    return whitened(rows, scale=256, components=4)


def op13_phrase_graph(spark, folder):
    return collocations(documents(spark, folder), least=30, most=2000, share=80)


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_lattice_scores,
        op3_minhash_near_dedup,
        op4_sharding,
        op5_warc_fixity,
        op6_imatch_fingerprints,
        op7_mixing,
        op8_line_dedup,
        op9_sentence_pieces,
        op10_quality_classifier,
        op11_sorted_list_search,
        op12_block_whitening,
        op13_phrase_graph,
    )
}
