"""The queries of this package on the given tables, and SQL for those that it can express."""

from __future__ import annotations

from .byte_bpe import op6_byte_bpe
from .chat import OP4_SQL, op4_chat
from .decontamination import op10_decontamination
from .hard_negatives import OP11_SQL, op11_hard_negatives
from .near_dedup import op8_near_dedup
from .periodic_runs import op13_periodic_runs
from .pii import op7_pii
from .quality import op5_quality
from .sharding import op2_sharding
from .suffix_dedup import op1_suffix_dedup
from .token_counts import op3_token_counts
from .toxicity import op9_toxicity
from .url_filter import OP12_SQL, op12_url_filter

QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_sharding, op3_token_counts, op4_chat, op5_quality, op6_byte_bpe, op7_pii, op8_near_dedup, op9_toxicity,
    op10_decontamination, op11_hard_negatives, op12_url_filter, op13_periodic_runs)}
ORACLE = {"op4_chat": OP4_SQL, "op11_hard_negatives": OP11_SQL, "op12_url_filter": OP12_SQL}
