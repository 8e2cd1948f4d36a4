"""Queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and SQL twins where SQL can say it."""

from __future__ import annotations

import corpus_pipeline
from tidemark.llm.bagminhash import OP6_SQL, op6_bagminhash
from tidemark.llm.chat import op2_chat
from tidemark.llm.hardneg import OP11_SQL, op11_threshold
from tidemark.llm.html import op1_html
from tidemark.llm.mixing import op5_mixing
from tidemark.llm.pq import OP7_SQL, op7_pq
from tidemark.llm.quality import op3_quality
from tidemark.llm.repair import op12_repair
from tidemark.llm.substrings import OP4_SQL, op4_substrings
from tidemark.llm.tokenfiles import op9_tokenfiles
from tidemark.llm.toxicity import op10_toxicity
from tidemark.llm.warc import OP13_SQL, op13_warc
from tidemark.llm.winnowing import OP8_SQL, op8_winnowing

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_html": op1_html,
    "op2_chat": op2_chat,
    "op3_quality": op3_quality,
    "op4_substrings": op4_substrings,
    "op5_mixing": op5_mixing,
    "op6_bagminhash": op6_bagminhash,
    "op7_pq": op7_pq,
    "op8_winnowing": op8_winnowing,
    "op9_tokenfiles": op9_tokenfiles,
    "op10_toxicity": op10_toxicity,
    "op11_threshold": op11_threshold,
    "op12_repair": op12_repair,
    "op13_warc": op13_warc,
}

SQL = {
    "op4_substrings": OP4_SQL,
    "op6_bagminhash": OP6_SQL,
    "op7_pq": OP7_SQL,
    "op8_winnowing": OP8_SQL,
    "op11_threshold": OP11_SQL,
    "op13_warc": OP13_SQL,
}
