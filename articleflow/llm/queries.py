"""The subpackage's queries and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from . import conversations, cover_tree, decontaminate, language, line_dedup, mix, passages, pii, resampling, simhash, substrings, tokens, toxicity

QUERIES = {f.__name__: f for f in (
    line_dedup.op1_line_dedup, simhash.op2_simhash, cover_tree.op3_top_k, mix.op4_mix, decontaminate.op5_decontamination,
    tokens.op6_tokens, substrings.op7_substrings, toxicity.op8_toxicity, pii.op9_pii, passages.op10_passages,
    resampling.op11_resampling, conversations.op12_conversations, language.op13_language)}

TOP_K_SQL = f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor({cover_tree.SCALE} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.e, d.e), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 100 = 0 AND d.vec_id <> q.vec_id AND len(q.e) = len(d.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {cover_tree.K}
"""

SQL = {"op1_line_dedup": line_dedup.SQL, "op3_top_k": TOP_K_SQL, "op4_mix": mix.SQL, "op12_conversations": conversations.SQL}
