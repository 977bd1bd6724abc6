"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from kilotrace.llm.ann import op7_nearest_neighbours
from kilotrace.llm.exact import OP5_SQL, op5_exact_dedup
from kilotrace.llm.langid import op8_language_id
from kilotrace.llm.licenses import op4_license_scan
from kilotrace.llm.lines import OP10_SQL, op10_line_dedup
from kilotrace.llm.lm import op9_lm_scoring
from kilotrace.llm.packing import op6_best_fit_packing
from kilotrace.llm.passages import op3_repeated_passages
from kilotrace.llm.prefixes import OP13_SQL, op13_prefix_trie
from kilotrace.llm.sentencepiece import op1_sentencepiece
from kilotrace.llm.simhash import op2_simhash
from kilotrace.llm.tokens import op11_token_counts
from kilotrace.llm.whitening import op12_whitening

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_simhash": op2_simhash,
    "op3_repeated_passages": op3_repeated_passages,
    "op4_license_scan": op4_license_scan,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_language_id": op8_language_id,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_line_dedup": op10_line_dedup,
    "op11_token_counts": op11_token_counts,
    "op12_whitening": op12_whitening,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL = {
    "op5_exact_dedup": OP5_SQL,
    "op10_line_dedup": OP10_SQL,
    "op13_prefix_trie": OP13_SQL,
}
