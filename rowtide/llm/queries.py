"""The operators of this package as queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from rowtide.llm.collocations import OP13_SQL, op13_collocations
from rowtide.llm.decontaminate import OP9_SQL, op9_decontaminate
from rowtide.llm.jaccard import op5_jaccard
from rowtide.llm.language import op1_language
from rowtide.llm.lexical import OP12_SQL, op12_lexical_search
from rowtide.llm.neighbours import OP10_SQL, op10_neighbours
from rowtide.llm.pieces import op6_pieces
from rowtide.llm.quality import op4_quality
from rowtide.llm.secrets import op2_secrets
from rowtide.llm.segment_search import OP11_SQL, op11_segment_search
from rowtide.llm.token_file import op7_token_file
from rowtide.llm.toxicity import op8_toxicity
from rowtide.llm.url_filter import OP3_SQL, op3_url_filter

QUERIES = {
    "op1_language": op1_language,
    "op2_secrets": op2_secrets,
    "op3_url_filter": op3_url_filter,
    "op4_quality": op4_quality,
    "op5_jaccard": op5_jaccard,
    "op6_pieces": op6_pieces,
    "op7_token_file": op7_token_file,
    "op8_toxicity": op8_toxicity,
    "op9_decontaminate": op9_decontaminate,
    "op10_neighbours": op10_neighbours,
    "op11_segment_search": op11_segment_search,
    "op12_lexical_search": op12_lexical_search,
    "op13_collocations": op13_collocations,
}

SQL: dict[str, str] = {
    "op3_url_filter": OP3_SQL,
    "op9_decontaminate": OP9_SQL,
    "op10_neighbours": OP10_SQL,
    "op11_segment_search": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
    "op13_collocations": OP13_SQL,
}
