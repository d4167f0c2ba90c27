"""The operators' registered queries and, where SQL can express them, their SQL."""

from __future__ import annotations

from revrec.llm import (
    alignment, bpe, collocations, decontamination, language_model, licences, neighbours, packing, quality_model, quality_rules, simhash, token_counts, token_files,
)

QUERIES = {
    "op1_quality_rules": quality_rules.op1_quality_rules,
    "op2_packing": packing.op2_packing,
    "op3_bpe": bpe.op3_bpe,
    "op4_licences": licences.op4_licences,
    "op5_neighbours": neighbours.op5_neighbours,
    "op6_quality_model": quality_model.op6_quality_model,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_simhash": simhash.op8_simhash,
    "op9_token_files": token_files.op9_token_files,
    "op10_language_model": language_model.op10_language_model,
    "op11_alignment": alignment.op11_alignment,
    "op12_decontamination": decontamination.op12_decontamination,
    "op13_collocations": collocations.op13_collocations,
}

# The others learn, tokenise, walk an automaton or follow links without end; tests/llm holds them to plain versions.
ORACLES = {
    "op1_quality_rules": quality_rules.OP1_SQL,
    "op12_decontamination": decontamination.OP12_SQL,
    "op13_collocations": collocations.OP13_SQL,
}
