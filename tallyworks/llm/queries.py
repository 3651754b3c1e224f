"""Registered queries of this subpackage over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import language, licenses, manifest, mixing, multiindex, packing, pagediff, periodic, simhash, sketches, suffixes, tokenfile, warc

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.linked_vectors(_read(spark, sf_dir, "embeddings"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeat_digests(_read(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.token_digest(_read(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and pages in one run: rows of either table have its id and a null for the other's."""
    docs, pages = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "pages")
    none = F.lit(None).cast("long")
    rows = language.document_rows(docs, F.col("doc_id"), none.alias("page_id")).unionByName(
        language.page_rows(pages, none.alias("doc_id"), F.col("page_id"))
    )
    return language.identify(rows, language.train(docs), ["doc_id", "page_id"])


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_digest(_read(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_read(spark, sf_dir, "documents"))


def op7_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.version_fingerprints(_read(spark, sf_dir, "documents"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_read(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_digest(_read(spark, sf_dir, "pages"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op11_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pagediff.page_digest(_read(spark, sf_dir, "pages"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digest(_read(spark, sf_dir, "documents"))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.proof_digest(_read(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_multi_index,
        op2_suffix_dedup,
        op3_token_files,
        op4_language,
        op5_mixing,
        op6_simhash,
        op7_sketches,
        op8_licenses,
        op9_warc,
        op10_packing,
        op11_page_text,
        op12_periodic_runs,
        op13_manifest,
    )
}
ORACLES: dict[str, str] = {"op5_mixing": mixing.ORACLE, "op13_manifest": manifest.ORACLE}
