"""The training-data queries by name, with SQL where SQL can express them."""

from __future__ import annotations

from tidemark.llm import lines, warc
from tidemark.llm.alignment import op13_alignment
from tidemark.llm.bpe import op2_bpe
from tidemark.llm.decontaminate import op9_decontamination
from tidemark.llm.html import op3_html
from tidemark.llm.language_model import op6_language_model
from tidemark.llm.neighbours import op1_neighbours
from tidemark.llm.pii import op5_pii
from tidemark.llm.quality import op8_quality
from tidemark.llm.simhash import op4_simhash
from tidemark.llm.toxicity import op7_toxicity
from tidemark.llm.whitening import op12_whitening

QUERIES = {
    "op1_neighbours": op1_neighbours,
    "op2_bpe": op2_bpe,
    "op3_html": op3_html,
    "op4_simhash": op4_simhash,
    "op5_pii": op5_pii,
    "op6_language_model": op6_language_model,
    "op7_toxicity": op7_toxicity,
    "op8_quality": op8_quality,
    "op9_decontamination": op9_decontamination,
    "op10_warc": warc.op10_warc,
    "op11_line_dedup": lines.op11_line_dedup,
    "op12_whitening": op12_whitening,
    "op13_alignment": op13_alignment,
}
ORACLES: dict[str, str] = {"op10_warc": warc.ORACLE, "op11_line_dedup": lines.ORACLE}
