"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from tidelake.llm.op1_token_files import op1_token_files
from tidelake.llm.op2_neighbours import op2_neighbours
from tidelake.llm.op3_minhash import op3_minhash
from tidelake.llm.op4_html import op4_html
from tidelake.llm.op5_toxicity import op5_toxicity
from tidelake.llm.op6_language import op6_language
from tidelake.llm.op7_packing import op7_packing
from tidelake.llm.op8_decontaminate import op8_decontaminate
from tidelake.llm.op9_quality import op9_quality
from tidelake.llm.op10_secrets import op10_secrets
from tidelake.llm.op10_secrets import oracle as secrets_sql
from tidelake.llm.op11_mixing import op11_mixing
from tidelake.llm.op11_mixing import oracle as mixing_sql
from tidelake.llm.op12_alignment import op12_alignment
from tidelake.llm.op13_repair import op13_repair

QUERIES = {f.__name__: f for f in (
    op1_token_files, op2_neighbours, op3_minhash, op4_html, op5_toxicity, op6_language, op7_packing,
    op8_decontaminate, op9_quality, op10_secrets, op11_mixing, op12_alignment, op13_repair)}

ORACLES: dict[str, str] = {"op10_secrets": secrets_sql(), "op11_mixing": mixing_sql()}
