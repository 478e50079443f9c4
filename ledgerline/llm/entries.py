"""The queries of this package, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from . import ann, exact_topk, language_id, license_scan, mixing, oracles, secret_scan, sentencepieces, simhash_dedup, sstable, token_counts


def queries() -> dict:
    ops = (
        language_id.op1_language_id,
        token_counts.op2_token_counts,
        sstable.op3_token_shards,
        ann.op4_nearest_neighbours,
        license_scan.op5_license_scan,
        sentencepieces.op6_sentencepiece,
        secret_scan.op7_secret_scan,
        exact_topk.op8_exact_topk,
        mixing.op9_mixing,
        simhash_dedup.op10_simhash_dedup,
    )
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    return {"op5_license_scan": oracles.licenses(), "op7_secret_scan": oracles.secrets(), "op8_exact_topk": oracles.EXACT_TOPK}
