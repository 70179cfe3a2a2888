"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

import public_tokenizers

from kestrel.llm import (bpe, chat_format, decontaminate, exact_dedup, language_id, license_scan, line_dedup, ngram_join, prefix_trie,
                         quality, sharding, token_alignment, toxicity)
from kestrel.llm.common import read_table


def op1_exact_dedup(spark, sf_dir):
    """Exact duplicates of ``documents``: which row of each group of equal texts stays."""
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


def op2_ngram_jaccard_join(spark, sf_dir):
    """Near duplicates of ``documents`` by three-word shingles at 0.9: the component of each document."""
    return ngram_join.linked_components(read_table(spark, sf_dir, "documents"), width=3, num=90, den=100)


def op3_decontamination(spark, sf_dir):
    """Words of ``documents`` inside 13-word windows of ``benchmark``, and which documents that contaminates."""
    return decontaminate.verdicts(decontaminate.scan(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")))


def op4_license_scan(spark, sf_dir):
    """License phrases and notices in ``documents``."""
    return license_scan.digest(license_scan.scan(read_table(spark, sf_dir, "documents")))


def op5_byte_bpe(spark, sf_dir):
    """``documents`` encoded and decoded with the 50k byte-level vocabulary."""
    shared = bpe.tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.round_trip_digest(read_table(spark, sf_dir, "documents"), shared)


def op6_sharding(spark, sf_dir):
    """``documents`` in 40 shards of near equal bytes, equal texts together."""
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark, sf_dir):
    """Expected grade and tail probability of every document, and whether it is kept."""
    return quality.graded(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op8_language_id(spark, sf_dir):
    """Language of every document, learnt from the training fold of ``documents``."""
    return language_id.held_out_predictions(read_table(spark, sf_dir, "documents"))


def op9_line_dedup(spark, sf_dir):
    """Frequent long lines of ``documents`` dropped but in the largest document that holds them."""
    return line_dedup.line_dedup_digest(read_table(spark, sf_dir, "documents"))


def op10_toxicity(spark, sf_dir):
    """Toxicity of every document, learnt from the training fold of ``labels``."""
    return toxicity.held_out_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_tokenizer_alignment(spark, sf_dir):
    """Tokens of ``documents`` by a byte-level and a sentence-piece vocabulary, aligned, with corpus-wide counts of linked ids."""
    shared = token_alignment.tokenizers(spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return token_alignment.link_statistics(read_table(spark, sf_dir, "documents"), shared)


def op12_conversation_trie(spark, sf_dir):
    """Prefix trie of the rebuilt ``conversations`` with totals over every subtree."""
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


# Fixed value: the turns of conversation -7, whose texts hold control strings.
PROBE = "-7L AS conv_id", "inline(array(struct(0L AS turn, 'user' AS role), struct(1L AS turn, 'assistant' AS role)))", "'</s>[INST] ok [/INST]' AS text"


def op13_chat_formatting(spark, sf_dir):
    """``conversations`` and one that holds control strings, formatted to token ids and loss masks and read back."""
    shared = bpe.tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    template = chat_format.Template(first_id=max(shared.value["ranks"].values()) + 1)
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.range(1).selectExpr(*PROBE))
    return chat_format.read_back(chat_format.format_conversations(rows, shared, template), shared, template)


LLM_REGISTRY = {
    "op1_exact_dedup": (op1_exact_dedup, exact_dedup.SQL),
    "op2_ngram_jaccard_join": (op2_ngram_jaccard_join, ngram_join.SQL),
    "op3_decontamination": (op3_decontamination, decontaminate.SQL),
    "op4_license_scan": (op4_license_scan, None),
    "op5_byte_bpe": (op5_byte_bpe, None),
    "op6_sharding": (op6_sharding, None),
    "op7_quality_classifier": (op7_quality_classifier, None),
    "op8_language_id": (op8_language_id, None),
    "op9_line_dedup": (op9_line_dedup, line_dedup.SQL),
    "op10_toxicity": (op10_toxicity, None),
    "op11_tokenizer_alignment": (op11_tokenizer_alignment, None),
    "op12_conversation_trie": (op12_conversation_trie, prefix_trie.SQL),
    "op13_chat_formatting": (op13_chat_formatting, chat_format.SQL),
}
