"""One registered query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from serieslake.llm import decontamination, extraction, fixity, language, minhash, pieces, quality, secret_scan, simhash, spelling, token_counts, token_files, whitening
from serieslake.llm.common import table, tokenizer_path
from serieslake.session import materialize, scratch_path

WORDS, PIECES = "word_bpe_49k.json", "piece_bpe_32k.model"
TOKEN_LIMIT = 2048


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), tokenizer_path(WORDS), target)
    return token_files.with_checksum(token_files.read_tokens(spark, target))


def op2_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"), length=3, most=2)


def _worn(archive: DataFrame) -> DataFrame:
    """A replica as years may leave it: records with a changed byte, without their end, or lost."""
    n, size, byte = F.col("page_id"), F.length("record"), F.col("record")
    flipped = F.concat(F.substring(byte, F.lit(1), size - 8), F.lit(b"#"), F.substring(byte, size - 6, F.lit(7)))
    worn = F.when(n % 97 == 13, flipped).when(n % 97 == 31, F.substring(byte, F.lit(1), size - 5)).otherwise(byte)
    return archive.withColumn("record", worn).filter("page_id is null or page_id % 97 <> 53")


def op3_fixity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, status, length and both hashes of each record that differs in a worn replica of the archive."""
    archive = materialize(fixity.build_archive(table(spark, sf_dir, "pages")), "archive")
    replica = materialize(_worn(archive), "replica")
    bad = materialize(fixity.audit(archive, replica), "audit")
    kept = archive.join(bad, ["segment", "seq"]).select("segment", "seq", "page_id", "status", "length", F.sha2("record", 256).alias("sha256"))
    found = replica.join(bad, ["segment", "seq"], "left_semi").select("segment", "seq", F.sha2("record", 256).alias("replica_sha256"))
    return kept.join(found, ["segment", "seq"], "left").select("page_id", "status", "length", "sha256", "replica_sha256")


_RECORD = """'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::varchar, '')
    || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
    || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)"""
OP3_SQL = f"""
WITH records AS (SELECT page_id, encode({_RECORD}) AS record FROM pages WHERE page_id % 97 IN (13, 31, 53))
SELECT page_id, CASE page_id % 97 WHEN 53 THEN 'missing' ELSE 'altered' END AS status, octet_length(record) AS length, sha256(record) AS sha256,
    CASE page_id % 97 WHEN 13 THEN sha256(record[1:octet_length(record) - 8] || encode('#') || record[octet_length(record) - 6:])
        WHEN 31 THEN sha256(record[1:octet_length(record) - 5]) END AS replica_sha256
FROM records
"""


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: pieces and crc32 of their ids as little-endian words, and whether decoding gives the text back."""
    path = tokenizer_path(PIECES)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    return pieces.digests(pieces.encode(docs, path, keep=("doc_id", "text_sha256")), path)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path(WORDS))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.fingerprints_and_classes(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``deviation`` is null beyond 64 bits; ``deviation_exact`` holds up to 38 digits."""
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    exact = F.col("deviation").alias("deviation_exact")
    deviation = F.expr("try_cast(deviation AS bigint)").alias("deviation")
    return white.select("vec_id", "component", "n", deviation, "whitened", "explained", "identity_error", exact)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_simhash_groups": op2_simhash_groups,
    "op3_fixity_audit": op3_fixity_audit,
    "op4_language": op4_language,
    "op5_quality": op5_quality,
    "op6_pieces": op6_pieces,
    "op7_token_counts": op7_token_counts,
    "op8_main_text": op8_main_text,
    "op9_fingerprints": op9_fingerprints,
    "op10_decontamination": op10_decontamination,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_secrets": op12_secrets,
    "op13_whitening": op13_whitening,
}
ORACLES: dict[str, str] = {"op3_fixity_audit": OP3_SQL}
