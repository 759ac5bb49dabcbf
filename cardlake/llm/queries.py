"""Queries of the training-data operators: (spark, sf_dir) -> DataFrame, and their SQL.

Only the searches and counts of operators 3, 9 and 12 are expressible in SQL; the
others are tested against brute force, exact round trips or held-out accuracy.
"""

from __future__ import annotations

from cardlake.llm.byte_codec import op13_byte_bpe
from cardlake.llm.decontam import op1_benchmark_decontamination
from cardlake.llm.jaccard_trie import op5_ngram_jaccard_join
from cardlake.llm.langid import op8_language_mixture
from cardlake.llm.lm_score import op10_lm_pseudo_likelihood
from cardlake.llm.pii import op2_pii_bilstm_crf
from cardlake.llm.piece_codec import op7_sentencepiece
from cardlake.llm.quality_kn import op4_quality_kneser_ney
from cardlake.llm.source_audit import OP12_SQL, op12_source_audit
from cardlake.llm.topk import OP3_SQL, op3_exact_topk
from cardlake.llm.toxicity import op6_toxicity_ftrl
from cardlake.llm.warc import OP9_SQL, op9_warc_dictionary
from cardlake.llm.whitening import op11_spectrum_whitening

QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination,
    op2_pii_bilstm_crf,
    op3_exact_topk,
    op4_quality_kneser_ney,
    op5_ngram_jaccard_join,
    op6_toxicity_ftrl,
    op7_sentencepiece,
    op8_language_mixture,
    op9_warc_dictionary,
    op10_lm_pseudo_likelihood,
    op11_spectrum_whitening,
    op12_source_audit,
    op13_byte_bpe,
)}

ORACLE: dict[str, str] = {"op3_exact_topk": OP3_SQL, "op9_warc_dictionary": OP9_SQL, "op12_source_audit": OP12_SQL}
