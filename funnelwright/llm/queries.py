"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.llm.common import read_documents
from funnelwright.llm.decontam import find_leaks
from funnelwright.llm.embeddings import near_vectors
from funnelwright.llm.langid import page_languages
from funnelwright.llm.licenses import scan_licenses
from funnelwright.llm.linededup import dedup_lines
from funnelwright.llm.mixing import mix_sizes
from funnelwright.llm.neardup import near_duplicates
from funnelwright.llm.packing import pack
from funnelwright.llm.pii import find_personal_data
from funnelwright.llm.quality import score_quality
from funnelwright.llm.resampling import resample
from funnelwright.llm.sharding import shard_table
from funnelwright.llm.spelling import spelling_variants


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mix(spark, sf_dir):
    return mix_sizes(read_documents(spark, sf_dir))


def _language(spark, sf_dir):
    return page_languages(_table(spark, sf_dir, "pages"), read_documents(spark, sf_dir))


def _quality(spark, sf_dir):
    return score_quality(read_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def _leaks(spark, sf_dir):
    return find_leaks(read_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def _near_duplicates(spark, sf_dir):
    return near_duplicates(read_documents(spark, sf_dir), width=2)


def _lines(spark, sf_dir):
    rewritten = dedup_lines(read_documents(spark, sf_dir).select("doc_id", "text"))
    return rewritten.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def _licenses(spark, sf_dir):
    return scan_licenses(read_documents(spark, sf_dir))


def _shards(spark, sf_dir):
    return shard_table(read_documents(spark, sf_dir))


def _near_vectors(spark, sf_dir):
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def _personal_data(spark, sf_dir):
    found = find_personal_data(read_documents(spark, sf_dir))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


def _resampling(spark, sf_dir):
    return resample(read_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def _spelling(spark, sf_dir):
    return spelling_variants(read_documents(spark, sf_dir))


def _packing(spark, sf_dir):
    return pack(read_documents(spark, sf_dir))


QUERIES = {
    "op1_mix": _mix,
    "op2_language": _language,
    "op3_quality": _quality,
    "op4_leaks": _leaks,
    "op5_near_duplicates": _near_duplicates,
    "op6_line_dedup": _lines,
    "op7_licenses": _licenses,
    "op8_shards": _shards,
    "op9_near_vectors": _near_vectors,
    "op10_personal_data": _personal_data,
    "op11_resampling": _resampling,
    "op12_spelling": _spelling,
    "op13_packing": _packing,
}
