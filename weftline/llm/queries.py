"""The registered queries of the training-data operators, and the SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers

from weftline.llm import chat_format, chunk_bpe, hpy_lm, line_dedup, mixture_pack, ngram_join, robust_quality, secret_scan, telephony, url_reputation
from weftline.llm.common import table


def op1_hpy_lm(spark, sf_dir):
    return hpy_lm.score(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_chunk_bpe(spark, sf_dir):
    return chunk_bpe.digests(table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


def op3_line_dedup(spark, sf_dir):
    return line_dedup.report(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_line_dedup_scaled(spark, sf_dir):
    """Equal lines of every length, and near ones within an edit for each 64 characters; no SQL."""
    return line_dedup.report(table(spark, sf_dir, "documents", "doc_id", "text"), per=64, exact_words=1)


def op4_secret_scan(spark, sf_dir):
    return secret_scan.digests(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_url_reputation(spark, sf_dir):
    return url_reputation.judge(table(spark, sf_dir, "pages", "page_id", "url"), table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))


def op6_telephony(spark, sf_dir):
    return telephony.store_texts(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_robust_quality(spark, sf_dir):
    return robust_quality.digests(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


def op7_robust_quality_whole(spark, sf_dir):
    """Small sources are judged by the whole language, then by the whole corpus, as in the pipeline; no SQL."""
    return robust_quality.digests(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"), whole=True)


def op8_ngram_join(spark, sf_dir):
    return ngram_join.link(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_chat_format(spark, sf_dir):
    return chat_format.format_chats(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


#: Power of a source's tokens that its share of a window follows: small sources come more often than in the corpus.
TEMPER = 0.5


def pack_documents(docs, with_ids=False):
    """Packing as the query and the pipeline do it."""
    return mixture_pack.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), temper=TEMPER, with_ids=with_ids)


def op10_mixture_pack(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents", "doc_id", "source", "text"))


QUERIES = {f.__name__: f for f in (op1_hpy_lm, op2_chunk_bpe, op3_line_dedup, op3_line_dedup_scaled, op4_secret_scan, op5_url_reputation, op6_telephony, op7_robust_quality, op7_robust_quality_whole, op8_ngram_join, op9_chat_format, op10_mixture_pack)}
ORACLE = {"op3_line_dedup": line_dedup.ORACLE, "op5_url_reputation": url_reputation.ORACLE, "op7_robust_quality": robust_quality.ORACLE, "op9_chat_format": chat_format.ORACLE}
