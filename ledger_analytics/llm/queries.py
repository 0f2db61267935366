"""Registry of the subpackage's queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import chat, decontaminate, fingerprints, mixing, phrases, resampling, runindex, secrets, simhash, spelling, tokencounts, toxicity, urlfilters


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lookup_sketches": fingerprints.op1_lookup_sketches,
        "op2_repeated_phrases": phrases.op2_repeated_phrases,
        "op3_simhash_bk_trees": simhash.op3_simhash_bk_trees,
        "op4_winnowing": decontaminate.op4_winnowing,
        "op5_markov_secrets": secrets.op5_markov_secrets,
        "op6_trie_unigram": tokencounts.op6_trie_unigram,
        "op7_snapshot_collapse": chat.op7_snapshot_collapse,
        "op8_attentive_gru": toxicity.op8_attentive_gru,
        "op9_multinomial_blocks": mixing.op9_multinomial_blocks,
        "op10_run_length_index": runindex.op10_run_length_index,
        "op11_url_vocabulary": urlfilters.op11_url_vocabulary,
        "op12_prefix_crc_resampling": resampling.op12_prefix_crc_resampling,
        "op13_fm_index_variants": spelling.op13_fm_index_variants,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op7_snapshot_collapse": chat.OP7_SQL,
        "op9_multinomial_blocks": mixing.OP9_SQL,
        "op11_url_vocabulary": urlfilters.OP11_SQL,
    }
