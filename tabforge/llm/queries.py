"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from tabforge.llm import collocations, quality, ranked, sharding
from tabforge.llm.html import op5_html_extraction
from tabforge.llm.imatch import op12_document_fingerprints
from tabforge.llm.jaccard import op1_ngram_jaccard_join
from tabforge.llm.neighbours import op10_nearest_neighbours
from tabforge.llm.packing import op2_best_fit_packing
from tabforge.llm.repeats import op4_suffix_dedup
from tabforge.llm.sampling import op7_sampled_segmentations
from tabforge.llm.token_counts import op3_token_counts
from tabforge.llm.toxicity import op6_toxicity

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_token_counts": op3_token_counts,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_html_extraction": op5_html_extraction,
    "op6_toxicity": op6_toxicity,
    "op7_sampled_segmentations": op7_sampled_segmentations,
    "op8_sharding": sharding.op8_sharding,
    "op9_quality_rules": quality.op9_quality_rules,
    "op10_nearest_neighbours": op10_nearest_neighbours,
    "op11_ranked_search": ranked.op11_ranked_search,
    "op12_document_fingerprints": op12_document_fingerprints,
    "op13_phrase_collocations": collocations.op13_phrase_collocations,
}

ORACLES: dict[str, str] = {
    "op8_sharding": sharding.SQL,
    "op9_quality_rules": quality.SQL,
    "op11_ranked_search": ranked.SQL,
    "op13_phrase_collocations": collocations.SQL,
}
