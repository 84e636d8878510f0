"""Queries of this subpackage, and their SQL where there is one."""

from __future__ import annotations

from . import lexical, prefix_trie
from .ann import op9_nn_descent
from .best_fit import op11_best_fit
from .chat import op8_chat_turns
from .katz import op3_katz
from .lexical import op13_lexical
from .mixing import op10_source_mix
from .near_dup import op5_near_dup
from .packing import op1_packing
from .pii import op7_pii_spans
from .prefix_trie import op12_prefix_trie
from .quality import op2_line_quality
from .toxicity import op6_toxicity
from .warc import op4_warc

QUERIES = {
    f.__name__: f
    for f in (op1_packing, op2_line_quality, op3_katz, op4_warc, op5_near_dup, op6_toxicity, op7_pii_spans, op8_chat_turns, op9_nn_descent, op10_source_mix, op11_best_fit, op12_prefix_trie, op13_lexical)
}

#: DuckDB SQL by query.
ORACLES: dict[str, str] = {"op12_prefix_trie": prefix_trie.ORACLE, "op13_lexical": lexical.ORACLE}
