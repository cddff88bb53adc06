"""Queries of the numbered operators, and their SQL where it can say the same."""

from __future__ import annotations

from parcela.llm.bpe import op1_bpe
from parcela.llm.decontaminate import op2_decontaminate
from parcela.llm.jaccard import OP10_SQL, op10_jaccard
from parcela.llm.lempelziv import OP5_SQL, op5_substrings
from parcela.llm.lines import OP8_SQL, op8_lines
from parcela.llm.maxscore import OP7_SQL, op7_maxscore
from parcela.llm.pages import op9_pages
from parcela.llm.periodic import op11_periodic
from parcela.llm.simhash import op13_simhash
from parcela.llm.suffixes import op3_suffixes
from parcela.llm.toxicity import op6_toxicity
from parcela.llm.turns import OP12_SQL, op12_turns
from parcela.llm.urls import OP4_SQL, op4_urls

QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_decontaminate": op2_decontaminate,
    "op3_suffixes": op3_suffixes,
    "op4_urls": op4_urls,
    "op5_substrings": op5_substrings,
    "op6_toxicity": op6_toxicity,
    "op7_maxscore": op7_maxscore,
    "op8_lines": op8_lines,
    "op9_pages": op9_pages,
    "op10_jaccard": op10_jaccard,
    "op11_periodic": op11_periodic,
    "op12_turns": op12_turns,
    "op13_simhash": op13_simhash,
}

SQL = {"op4_urls": OP4_SQL, "op5_substrings": OP5_SQL, "op7_maxscore": OP7_SQL, "op8_lines": OP8_SQL, "op10_jaccard": OP10_SQL,
       "op12_turns": OP12_SQL}
