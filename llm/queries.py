"""The queries of this package and the SQL each must equal."""

from __future__ import annotations

from . import op1_topk, op2_decontaminate, op3_jaccard, op4_html, op5_chat, op6_licenses, op7_language, op8_substrings, op9_mixing, op10_warc, op11_phrases, op12_quality, op13_merkle

QUERIES = {"op1_topk": op1_topk.q_op1_topk,
           "op2_decontaminate": op2_decontaminate.q_op2_decontaminate,
           "op3_jaccard": op3_jaccard.q_op3_jaccard,
           "op4_html": op4_html.q_op4_html,
           "op5_chat": op5_chat.q_op5_chat,
           "op6_licenses": op6_licenses.q_op6_licenses,
           "op7_language": op7_language.q_op7_language,
           "op8_substrings": op8_substrings.q_op8_substrings,
           "op9_mixing": op9_mixing.q_op9_mixing,
           "op10_warc": op10_warc.q_op10_warc,
           "op11_phrases": op11_phrases.q_op11_phrases,
           "op12_quality": op12_quality.q_op12_quality,
           "op13_merkle": op13_merkle.q_op13_merkle}
SQL = {"op1_topk": op1_topk.SQL,
       "op2_decontaminate": op2_decontaminate.SQL,
       "op5_chat": op5_chat.SQL,
       "op6_licenses": op6_licenses.SQL,
       "op8_substrings": op8_substrings.SQL,
       "op9_mixing": op9_mixing.SQL,
       "op10_warc": op10_warc.SQL,
       "op11_phrases": op11_phrases.SQL,
       "op12_quality": op12_quality.SQL,
       "op13_merkle": op13_merkle.SQL}
