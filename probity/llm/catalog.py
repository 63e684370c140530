"""The registered queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from probity.llm import bpe, chat_format, codebooks, collocations, ego_join, html_blocks, mixing, quality, secret_scan, simhash, substrings, topk, toxicity
from probity.llm.common import read


def op1_mixing(spark, sf_dir):
    return mixing.digest(read(spark, sf_dir, "documents"))


def op2_toxicity(spark, sf_dir):
    return toxicity.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_simhash(spark, sf_dir):
    return simhash.digest(read(spark, sf_dir, "documents"))


def op4_embeddings(spark, sf_dir):
    return ego_join.digest(read(spark, sf_dir, "embeddings"))


def op5_topk(spark, sf_dir):
    return topk.digest(read(spark, sf_dir, "embeddings"))


def op6_secrets(spark, sf_dir):
    return secret_scan.digest(read(spark, sf_dir, "documents"))


def op7_substrings(spark, sf_dir):
    return substrings.digest(read(spark, sf_dir, "documents"))


def op8_bpe(spark, sf_dir):
    return bpe.digest(read(spark, sf_dir, "documents"))


def op9_quality(spark, sf_dir):
    return quality.scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_html(spark, sf_dir):
    return html_blocks.extracted(read(spark, sf_dir, "pages"))


def op11_chat(spark, sf_dir):
    return chat_format.digest(read(spark, sf_dir, "conversations"))


def op12_phrases(spark, sf_dir):
    return collocations.digest(read(spark, sf_dir, "documents"))


def op13_codes(spark, sf_dir):
    return codebooks.digest(read(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_toxicity, op3_simhash, op4_embeddings, op5_topk, op6_secrets, op7_substrings, op8_bpe, op9_quality, op10_html, op11_chat, op12_phrases, op13_codes)}

ORACLE = {"op1_mixing": mixing.ORACLE, "op4_embeddings": ego_join.ORACLE, "op5_topk": topk.ORACLE, "op6_secrets": secret_scan.ORACLE, "op7_substrings": substrings.ORACLE, "op11_chat": chat_format.ORACLE, "op12_phrases": collocations.ORACLE, "op13_codes": codebooks.ORACLE}
