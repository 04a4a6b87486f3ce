"""Every corpus query with its SQL (None where SQL cannot state it)."""

from __future__ import annotations

import corpus_pipeline
from labelloom.llm.op1 import op1_quality_classifier
from labelloom.llm.op10 import op10_license_scan
from labelloom.llm.op11 import OP11_SQL, op11_rank_documents
from labelloom.llm.op12 import op12_nearest_vectors
from labelloom.llm.op13 import op13_align_tokenizers
from labelloom.llm.op2 import op2_line_dedup
from labelloom.llm.op3 import op3_embedding_dedup
from labelloom.llm.op4 import OP4_SQL, op4_mix_sources
from labelloom.llm.op5 import op5_pack_sequences
from labelloom.llm.op6 import op6_simhash
from labelloom.llm.op7 import op7_url_filter
from labelloom.llm.op8 import OP8_SQL, op8_warc
from labelloom.llm.op9 import op9_quality_rules

QUERIES = {
    "op1_quality_classifier": (op1_quality_classifier, None),
    "op2_line_dedup": (op2_line_dedup, None),
    "op3_embedding_dedup": (op3_embedding_dedup, None),
    "op4_mix_sources": (op4_mix_sources, OP4_SQL),
    "op5_pack_sequences": (op5_pack_sequences, None),
    "op6_simhash": (op6_simhash, None),
    "op7_url_filter": (op7_url_filter, None),
    "op8_warc": (op8_warc, OP8_SQL),
    "op9_quality_rules": (op9_quality_rules, None),
    "op10_license_scan": (op10_license_scan, None),
    "op11_rank_documents": (op11_rank_documents, OP11_SQL),
    "op12_nearest_vectors": (op12_nearest_vectors, None),
    "op13_align_tokenizers": (op13_align_tokenizers, None),
    "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
}
