"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from ledgerlake.llm.bpe_automaton import op6_bpe_automaton
from ledgerlake.llm.chat_format import OP5_SQL, op5_chat_format
from ledgerlake.llm.decontaminate import op2_decontaminate
from ledgerlake.llm.learned_ann import op12_learned_ann
from ledgerlake.llm.lexical_search import OP11_SQL, op11_lexical_search
from ledgerlake.llm.line_dedup import op8_line_dedup
from ledgerlake.llm.neighbour_quality import op3_neighbour_quality
from ledgerlake.llm.ngram_join import op10_ngram_join
from ledgerlake.llm.packing import op1_packing
from ledgerlake.llm.page_text import OP4_SQL, op4_page_text
from ledgerlake.llm.ppm import op7_ppm
from ledgerlake.llm.quality_rules import op9_quality_rules
from ledgerlake.llm.turn_repair import OP13_SQL, op13_turn_repair

QUERIES = {
    "op1_packing": op1_packing,
    "op2_decontaminate": op2_decontaminate,
    "op3_neighbour_quality": op3_neighbour_quality,
    "op4_page_text": op4_page_text,
    "op5_chat_format": op5_chat_format,
    "op6_bpe_automaton": op6_bpe_automaton,
    "op7_ppm": op7_ppm,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_ngram_join": op10_ngram_join,
    "op11_lexical_search": op11_lexical_search,
    "op12_learned_ann": op12_learned_ann,
    "op13_turn_repair": op13_turn_repair,
}

ORACLE: dict[str, str] = {
    "op4_page_text": OP4_SQL,
    "op5_chat_format": OP5_SQL,
    "op11_lexical_search": OP11_SQL,
    "op13_turn_repair": OP13_SQL,
}
