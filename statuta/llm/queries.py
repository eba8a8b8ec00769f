"""Registry of the operators' queries."""

from __future__ import annotations

from . import maxscore, mixing, vector_codes
from .bpe_stream import op12_bpe_stream
from .embedding_dedup import op1_embedding_near_dedup
from .graph_ann import op8_graph_neighbours
from .html_crf import op5_html_main_text
from .katz_lm import op6_katz_scores
from .maxscore import op11_lexical_search
from .mixing import op2_source_mixing
from .ngram_join import op7_ngram_jaccard_join
from .piece_lattice import op4_sentencepiece_sampling
from .quality_cnn import op10_quality_classifier
from .token_counts import op9_token_counts
from .training_order import op3_training_order
from .vector_codes import op13_vector_codes

QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_source_mixing": op2_source_mixing,
    "op3_training_order": op3_training_order,
    "op4_sentencepiece_sampling": op4_sentencepiece_sampling,
    "op5_html_main_text": op5_html_main_text,
    "op6_katz_scores": op6_katz_scores,
    "op7_ngram_jaccard_join": op7_ngram_jaccard_join,
    "op8_graph_neighbours": op8_graph_neighbours,
    "op9_token_counts": op9_token_counts,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_lexical_search": op11_lexical_search,
    "op12_bpe_stream": op12_bpe_stream,
    "op13_vector_codes": op13_vector_codes,
}
ORACLE_SQL: dict[str, str] = {"op2_source_mixing": mixing.ORACLE_SQL, "op11_lexical_search": maxscore.ORACLE_SQL, "op13_vector_codes": vector_codes.ORACLE_SQL}
