"""Queries and SQL of the training-data operators, merged into ``__spark_entry__``."""

from __future__ import annotations

from .blocks import op6_block_labeller
from .chat import op7_chat_windows
from .covertree import op9_dual_tree
from .jaccard import op8_ngram_jaccard
from .mixing import op4_mix_knapsack
from .packing import op3_pack_nnls
from .pii import op5_pii_bootstrap
from .quality import op2_quality_mcd
from .secrets import op1_secret_ledger
from .urls import op10_url_graph


def queries():
    return {
        f.__name__: f
        for f in (
            op1_secret_ledger,
            op2_quality_mcd,
            op3_pack_nnls,
            op4_mix_knapsack,
            op5_pii_bootstrap,
            op6_block_labeller,
            op7_chat_windows,
            op8_ngram_jaccard,
            op9_dual_tree,
            op10_url_graph,
        )
    }


#: Exact search as SQL: every pair is scored.
TOP_K_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), p AS (
    SELECT q.vec_id AS query_id, q.r, x.vec_id, CAST(list_sum(list_transform(list_zip(q.e, x.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
    FROM v q JOIN v x ON q.r <> x.r
    WHERE q.vec_id % 20 = 0
), s AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id, r ORDER BY score DESC, vec_id NULLS LAST) AS INT) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM s WHERE rank <= 20
"""


def oracle_sql():
    """The others need iteration, tokenizers, offsets of matches or digests of what the method finds."""
    return {"op9_dual_tree": TOP_K_SQL}
