"""Queries of the corpus operators and their SQL, by name."""

from __future__ import annotations

from .chat import OP3_SQL, op3_chat
from .decontaminate import OP6_SQL, op6_decontaminate
from .exact_dedup import OP9_SQL, op9_exact_dedup
from .licenses import op11_licenses
from .mixing import OP1_SQL, op1_mixing
from .near_dup import op10_near_dup
from .quality import op7_quality
from .resampling import OP12_SQL, op12_resampling
from .secret_scan import OP2_SQL, op2_secrets
from .sharding import OP4_SQL, op4_sharding
from .tokens import op5_tokens
from .urls import OP8_SQL, op8_urls

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_secrets": op2_secrets,
    "op3_chat": op3_chat,
    "op4_sharding": op4_sharding,
    "op5_tokens": op5_tokens,
    "op6_decontaminate": op6_decontaminate,
    "op7_quality": op7_quality,
    "op8_urls": op8_urls,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_near_dup": op10_near_dup,
    "op11_licenses": op11_licenses,
    "op12_resampling": op12_resampling,
}

ORACLES = {
    "op1_mixing": OP1_SQL,
    "op2_secrets": OP2_SQL,
    "op3_chat": OP3_SQL,
    "op4_sharding": OP4_SQL,
    "op6_decontaminate": OP6_SQL,
    "op8_urls": OP8_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op12_resampling": OP12_SQL,
}
