"""Queries of this package and their DuckDB SQL, gathered from its modules."""

from __future__ import annotations

from kestrel.llm import conversation_dawg, decontaminate, language_hd, minhash_odd, pfair_mix, pii_surrogate, ppm_score, quality_kn, ranked_search, secrets_zstd, suffix_dedup, token_output, toxicity_channel

MODULES = [token_output, minhash_odd, quality_kn, decontaminate, pfair_mix, secrets_zstd, toxicity_channel, ppm_score, pii_surrogate, suffix_dedup, language_hd, conversation_dawg, ranked_search]

QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
