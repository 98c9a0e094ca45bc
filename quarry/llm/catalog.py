"""The operators as queries over the driver's tables."""

from __future__ import annotations

from quarry.llm import (
    chat, html_text, kneser_ney, mixing, ngram_join, packing, permutation, pii, repair, secrets, topk, toxicity, trie,
)
from quarry.llm.common import table


def op1_pii(spark, sf_dir):
    return pii.digest(table(spark, sf_dir, "documents"))


def op2_mixing(spark, sf_dir):
    return mixing.digest(table(spark, sf_dir, "documents"))


def op3_kneser_ney(spark, sf_dir):
    return kneser_ney.digest(table(spark, sf_dir, "documents"))


def op4_topk(spark, sf_dir):
    return topk.digest(table(spark, sf_dir, "embeddings"))


def op5_ngram_join(spark, sf_dir):
    return ngram_join.digest(table(spark, sf_dir, "documents"))


def op6_permutation(spark, sf_dir):
    return permutation.digest(table(spark, sf_dir, "embeddings"))


def op7_secrets(spark, sf_dir):
    return secrets.digest(table(spark, sf_dir, "documents"))


def op8_packing(spark, sf_dir):
    return packing.digest(table(spark, sf_dir, "documents"))


def op9_html(spark, sf_dir):
    return html_text.digest(table(spark, sf_dir, "pages"))


def op10_toxicity(spark, sf_dir):
    return toxicity.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_reply_trees(spark, sf_dir):
    return chat.digest(table(spark, sf_dir, "conversations"))


def op12_repair(spark, sf_dir):
    return repair.digest(table(spark, sf_dir, "conversations"))


def op13_prefix_trie(spark, sf_dir):
    return trie.digest(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii, op2_mixing, op3_kneser_ney, op4_topk, op5_ngram_join, op6_permutation, op7_secrets, op8_packing,
        op9_html, op10_toxicity, op11_reply_trees, op12_repair, op13_prefix_trie,
    )
}
ORACLE_SQL = {
    "op2_mixing": mixing.ORACLE_SQL, "op4_topk": topk.ORACLE_SQL, "op5_ngram_join": ngram_join.ORACLE_SQL,
    "op7_secrets": secrets.ORACLE_SQL, "op11_reply_trees": chat.ORACLE_SQL, "op12_repair": repair.ORACLE_SQL,
    "op13_prefix_trie": trie.ORACLE_SQL,
}
