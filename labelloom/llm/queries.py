"""The numbered queries: each applies its operator to its whole table, with production parameters."""
from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from labelloom.llm import op1_chat, op2_warc, op3_decontaminate, op4_licenses, op5_quality, op6_html, op7_bpe, op8_simhash, op9_language, op10_pii, op11_collocations, op12_spelling, op13_jaccard, twins
from labelloom.session import scratch_dir


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def vocabulary_path() -> str:
    """LABELLOOM_VOCABULARY, or the public file of that name; the path is a parameter of the operator."""
    if named := os.environ.get("LABELLOOM_VOCABULARY"):
        return named
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_chat_format(spark, sf):
    rows = table(spark, sf, "conversations")
    return op1_chat.format_turns(rows.select("conv_id", "turn", "role", "text"), op1_chat.train(rows)).select("conv_id", "turn", "n_turns", "roles", "rendered_sha256")


def op2_warc_salvage(spark, sf):
    place = f"{scratch_dir(spark)}-warc"
    op2_warc.write(table(spark, sf, "pages"), place)
    return op2_warc.revisits(op2_warc.read(spark, place, payload=False))


def op3_decontaminate_documents(spark, sf):
    return op3_decontaminate.overlaps(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark")).drop("text")


def op4_license_scan(spark, sf):
    return op4_licenses.scan(table(spark, sf, "documents").select("doc_id", "text")).select(
        "doc_id", "n_blocks", "licenses", F.concat_ws(";", F.transform("found", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"), x["license"], x["differences"]))).alias("found"))


def op5_quality_rules(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return op5_quality.judge(docs, op5_quality.train(docs, table(spark, sf, "labels"))).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("quality_p", 6).alias("quality_p"))


def op6_html_main_text(spark, sf):
    return op6_html.extract(table(spark, sf, "pages"))


def op7_bpe_round_trip(spark, sf):
    return op7_bpe.encode_documents(table(spark, sf, "documents").select("doc_id", "text"), vocabulary_path()).drop("text")


def op8_simhash_classes(spark, sf):
    return op8_simhash.classes(table(spark, sf, "documents")).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_language_id(spark, sf):
    return op9_language.languages(table(spark, sf, "documents"))


def op10_pii_spans(spark, sf):
    return op10_pii.find(table(spark, sf, "documents").select("doc_id", "text")).drop("text")


def op11_phrase_collocations(spark, sf):
    return op11_collocations.mine(table(spark, sf, "documents").select("lang", "text"))


def op12_spelling_variants(spark, sf):
    return op12_spelling.groups(table(spark, sf, "documents").select("doc_id", "text"))


def op13_jaccard_classes(spark, sf):
    return op13_jaccard.classes(table(spark, sf, "documents").select("doc_id", "text"))


def pipeline(spark, sf):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_chat_format, op2_warc_salvage, op3_decontaminate_documents, op4_license_scan, op5_quality_rules, op6_html_main_text, op7_bpe_round_trip, op8_simhash_classes, op9_language_id,
    op10_pii_spans, op11_phrase_collocations, op12_spelling_variants, op13_jaccard_classes, pipeline)}

ORACLE: dict[str, str] = {
    "op2_warc_salvage": """
        WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY ALL)
        SELECT page_id, payload_bytes, p.payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
        FROM p LEFT JOIN f USING (payload_digest)""",
    "op11_phrase_collocations": twins.PHRASES,
    "op12_spelling_variants": twins.SPELLING,
    "op13_jaccard_classes": twins.SETS,
}
