"""Registered queries of this subpackage and their DuckDB SQL."""

from ratewise.llm.ann import op2_multi_index
from ratewise.llm.bpe import op7_byte_bpe
from ratewise.llm.chat import OP10_SQL, op10_chat
from ratewise.llm.decontam import op1_decontamination
from ratewise.llm.html import op6_html_text
from ratewise.llm.jaccard import op4_jaccard
from ratewise.llm.lexical import OP12_SQL, op12_lexical_search
from ratewise.llm.lines import OP5_SQL, op5_line_dedup
from ratewise.llm.lm import op3_gru_lm
from ratewise.llm.pieces import op11_piece_bpe
from ratewise.llm.pii import op9_pii
from ratewise.llm.runs import op13_periodic_runs
from ratewise.llm.toxicity import op8_toxicity

LLM_QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_multi_index": op2_multi_index,
    "op3_gru_lm": op3_gru_lm,
    "op4_jaccard": op4_jaccard,
    "op5_line_dedup": op5_line_dedup,
    "op6_html_text": op6_html_text,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_toxicity": op8_toxicity,
    "op9_pii": op9_pii,
    "op10_chat": op10_chat,
    "op11_piece_bpe": op11_piece_bpe,
    "op12_lexical_search": op12_lexical_search,
    "op13_periodic_runs": op13_periodic_runs,
}
LLM_ORACLE = {"op5_line_dedup": OP5_SQL, "op10_chat": OP10_SQL, "op12_lexical_search": OP12_SQL}
