"""The queries of this package over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import (
    conversation_trie,
    decontaminate,
    minhash,
    nearest_neighbours,
    packing,
    periodic_runs,
    recurrent_lm,
    repeated_spans,
    secret_scan,
    simhash,
    token_store,
    toxicity,
    warc,
)


CONVERSATION_LIMITS = packing.Limits(tokens=4096, segments=8, loss=2048)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary; the package that holds the files is found where it is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), end_id=1)


def pack_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    examples = packing.conversation_examples(turns, tokenizer_path("word_bpe_49k.json"))
    return packing.pack_examples(examples, "example_id", "tokens", "loss_tokens", CONVERSATION_LIMITS)


def op3_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score(_table(spark, sf_dir, "documents"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return token_store.encode_and_read_back(spark, docs, tokenizer_path("byte_bpe_50k.json"), end_id=0)


def op7_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans.remove_repeats(_table(spark, sf_dir, "documents"))
    # Cuts may fall inside a character; what is left of it becomes a replacement character.
    return found.select("*", F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text")).drop("kept")


def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.write_and_read_back(spark, _table(spark, sf_dir, "pages"), least_bytes=0)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = simhash.fingerprints(_table(spark, sf_dir, "documents"))
    found = simhash.near_duplicates(prints)
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours.search(_table(spark, sf_dir, "embeddings"), every=20, nearest=20)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_nodes(_table(spark, sf_dir, "conversations"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.repeat_tails(_table(spark, sf_dir, "documents"))
    return periodic_runs.digest(periodic_runs.find_runs(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_pack": op2_pack,
    "pack_conversations": pack_conversations,
    "op3_fingerprint": op3_fingerprint,
    "op4_secrets": op4_secrets,
    "op5_lm_score": op5_lm_score,
    "op6_token_store": op6_token_store,
    "op7_repeated_spans": op7_repeated_spans,
    "op8_warc_revisits": op8_warc_revisits,
    "op9_simhash": op9_simhash,
    "op10_toxicity": op10_toxicity,
    "op11_neighbours": op11_neighbours,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_periodic_runs": op13_periodic_runs,
}
# Five hex digits of the digest are four letters of base 32.
LETTERS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((cast('0x' || substr(hex, 5 * i + 1, 5) as bigint) // {32**k}) % 32 + 1 as int), 1)"
    for k in (3, 2, 1, 0)
)
ORACLES: dict[str, str] = {
    "op8_warc_revisits": (
        "select page_id, payload_bytes, payload_digest, if(page_id = original, 'response', 'revisit') as record_type, "
        "if(page_id = original, null, original) as refers_to from (select page_id, octet_length(encode(body)) as "
        f"payload_bytes, array_to_string(list_transform(range(8), lambda i: {LETTERS}), '') as payload_digest, "
        "max(page_id) over (partition by body) as original from (select page_id, coalesce(html, '') as body, "
        "sha1(coalesce(html, '')) as hex from pages))"
    ),
}
