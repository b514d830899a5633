"""The registered queries of this package and the SQL of those that SQL can express."""

from __future__ import annotations

from .language import op12_language
from .licenses import op2_licenses
from .mixing import OP5_SQL, op5_mixing
from .packing import op4_packing
from .prefix_trie import OP11_SQL, op11_prefix_trie
from .quality import op8_quality
from .quality_rules import OP9_SQL, op9_quality_rules
from .secrets import op3_secrets
from .simhash import op7_simhash
from .spotsigs import OP10_SQL, op10_spotsigs
from .toxicity import op1_toxicity
from .turn_repair import OP13_SQL, op13_turn_repair
from .urlfilter import OP6_SQL, op6_url_filter

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_licenses": op2_licenses,
    "op3_secrets": op3_secrets,
    "op4_packing": op4_packing,
    "op5_mixing": op5_mixing,
    "op6_url_filter": op6_url_filter,
    "op7_simhash": op7_simhash,
    "op8_quality": op8_quality,
    "op9_quality_rules": op9_quality_rules,
    "op10_spotsigs": op10_spotsigs,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_language": op12_language,
    "op13_turn_repair": op13_turn_repair,
}

ORACLE_SQL = {
    "op5_mixing": OP5_SQL,
    "op6_url_filter": OP6_SQL,
    "op9_quality_rules": OP9_SQL,
    "op10_spotsigs": OP10_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op13_turn_repair": OP13_SQL,
}
