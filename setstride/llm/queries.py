"""Registered queries of the llm operators and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from setstride.llm import collocations, decontaminate, language_id, near_join, packing, pii, prefix_trie, quality_rules, repeats, resampling, secrets, sharding, warc
from setstride.llm.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


@query("op1_ngram_jaccard_join")
def ngram_jaccard_join(spark, folder):
    return near_join.classes(table(spark, folder, "documents"), near_join.Similarity(words=3, per_hundred=90))


@query("op7_llr_quality_rules")
def llr_quality_rules(spark, folder):
    return quality_rules.verdicts(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op6_jump_hash_sharding")
def jump_hash_sharding(spark, folder):
    return sharding.assign(table(spark, folder, "documents"), shards=8)


@query("op2_arc_to_warc")
def arc_to_warc(spark, folder):
    return warc.page_records(table(spark, folder, "pages"))


@query("op9_assignment_secrets")
def assignment_secrets(spark, folder):
    return secrets.report(table(spark, folder, "documents"))


@query("op10_greedy_string_tiling")
def greedy_string_tiling(spark, folder):
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op4_boosted_pii")
def boosted_pii(spark, folder):
    return pii.report(table(spark, folder, "documents"))


@query("op8_local_search_packing")
def local_search_packing(spark, folder):
    return packing.packed(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op3_suffix_array_dedup")
def suffix_array_dedup(spark, folder):
    return repeats.cut(table(spark, folder, "documents"), with_kept=False)


@query("op5_importance_resampling")
def importance_resampling(spark, folder):
    return resampling.resample(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op13_centroid_prefix_trie")
def centroid_prefix_trie(spark, folder):
    return prefix_trie.rebuilt_trie(table(spark, folder, "conversations"))


@query("op12_misra_gries_collocations")
def misra_gries_collocations(spark, folder):
    return collocations.collocations(table(spark, folder, "documents"))


@query("op11_hierarchical_language_id")
def hierarchical_language_id(spark, folder):
    return language_id.identify(table(spark, folder, "documents"))
