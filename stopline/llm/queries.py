"""The registered queries of this package: thin, each through its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stopline.llm import (
    chat, collocations, compact_windows, dartminhash, decontaminate, language, mixing, quality, resharding,
    spelling, suffix_groups, url_filter, wrappers,
)
from stopline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


@query("op5_suffix_decontaminate", decontaminate.SQL)
def op5(spark, sf_dir):
    return decontaminate.digest_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_likelihood_ratio")
def op4(spark, sf_dir):
    return quality.report_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op8_schema_fingerprint", chat.SQL)
def op8(spark, sf_dir):
    return chat.digest_rows(table(spark, sf_dir, "conversations"))


@query("op1_language_mixture")
def op1(spark, sf_dir):
    return language.prediction_rows(table(spark, sf_dir, "documents"))


@query("op2_segmented_bayes")
def op2(spark, sf_dir):
    return url_filter.verdict_rows(table(spark, sf_dir, "pages"))


@query("op7_flow_reshard")
def op7(spark, sf_dir):
    return resharding.shard_rows(table(spark, sf_dir, "documents"))


@query("op3_dartminhash")
def op3(spark, sf_dir):
    return dartminhash.class_rows(table(spark, sf_dir, "documents"))


@query("op9_raking")
def op9(spark, sf_dir):
    return mixing.mix_rows(table(spark, sf_dir, "documents"))


@query("op6_lyndon_groups")
def op6(spark, sf_dir):
    return suffix_groups.digest_rows(table(spark, sf_dir, "documents"))


@query("op10_compact_windows")
def op10(spark, sf_dir):
    return compact_windows.passage_rows(table(spark, sf_dir, "documents"))


@query("op11_fm_variants")
def op11(spark, sf_dir):
    return spelling.variant_rows(table(spark, sf_dir, "documents"))


@query("op12_multikey_phrases", collocations.SQL)
def op12(spark, sf_dir):
    return collocations.collocation_rows(table(spark, sf_dir, "documents"))


@query("op13_wrapper_text")
def op13(spark, sf_dir):
    return wrappers.text_rows(table(spark, sf_dir, "pages"))
