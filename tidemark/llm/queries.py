"""Queries of the corpus operators over the whole driver tables, and their DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table
from tidemark.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
LLM_QUERIES: dict[str, Query] = {}


def register(name: str) -> Callable[[Query], Query]:
    def deco(fn: Query) -> Query:
        LLM_QUERIES[name] = fn
        return fn
    return deco


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@register("op4_token_counts")
def q_token_counts(spark, sf_dir):
    """Tokens of every document by the byte-level BPE file."""
    from tidemark.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), limit=512)


@register("op5_packing")
def q_packing(spark, sf_dir):
    """Every document packed into sequences of 2048 ids."""
    from tidemark.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), capacity=2048, end_id=1)


@register("op10_token_files")
def q_token_files(spark, sf_dir):
    """Every document's ids written as token files and read back from them."""
    from tidemark.llm.token_files import read_token_files, write_token_files

    root = scratch_dir(spark, "token-files")
    manifest = write_token_files(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), root,
                                 drops_space=True, end_id=2)
    return read_token_files(spark, manifest, root)


@register("op1_warc")
def q_warc(spark, sf_dir):
    """Every page written to WARC files and read back from them."""
    from tidemark.llm.warc import read_warc, write_warc

    root = scratch_dir(spark, "warc")
    manifest = write_warc(table(spark, sf_dir, "pages"), root)
    return read_warc(spark, manifest, root).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op8_top_k")
def q_top_k(spark, sf_dir):
    """The 20 best inner products of every vector whose id is divisible by 20."""
    from tidemark.llm.topk import top_k

    return top_k(table(spark, sf_dir, "embeddings"), "id % 20 = 0", k=20, scale=64.0)


@register("op6_language_id")
def q_language_id(spark, sf_dir):
    """The language of every document, learned from those that are not held out."""
    from tidemark.llm.langid import fit, held_out, identify

    docs = table(spark, sf_dir, "documents")
    langs, logs = fit(docs, ~held_out())
    return identify(docs, langs, logs).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@register("op9_decontamination")
def q_decontamination(spark, sf_dir):
    """The words of every document that lie in windows of benchmark items."""
    from tidemark.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


@register("op7_licenses")
def q_licenses(spark, sf_dir):
    """License phrases and rule detections in every document."""
    from tidemark.llm.licenses import scan

    return scan(table(spark, sf_dir, "documents")).drop("found")


@register("op3_substring_dedup")
def q_substring_dedup(spark, sf_dir):
    """Words of every document that lie in 35-word windows found elsewhere too."""
    from pyspark.sql import functions as F

    from tidemark.llm.substrings import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op2_near_duplicates")
def q_near_duplicates(spark, sf_dir):
    """Groups of documents whose sets of 5-word shingles have a Jaccard similarity of 0.85 or more."""
    from tidemark.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), percent=85).drop("key")


@register("op11_jaccard_join")
def q_jaccard_join(spark, sf_dir):
    """Documents whose sets of 3-word shingles have a Jaccard similarity of 0.9 or more, as components."""
    from tidemark.llm.setjoin import jaccard_join

    return jaccard_join(table(spark, sf_dir, "documents"), percent=90, shingle=3).drop("root")


@register("op13_prefix_trie")
def q_prefix_trie(spark, sf_dir):
    """The prefix trie of all conversations, each rebuilt with the first turns of its family's first one."""
    from pyspark.sql import functions as F

    from tidemark.llm.convtrie import prefix_trie, turn_sequences

    lead = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return prefix_trie(turn_sequences(table(spark, sf_dir, "conversations"), family=20, lead=lead))


@register("op12_hard_negatives")
def q_hard_negatives(spark, sf_dir):
    """Positives and hard negatives of every vector whose id is divisible by 100."""
    from pyspark.sql import functions as F

    from tidemark.llm.negatives import mine

    label = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), "id % 100 = 0", label=label, positives=5, negatives=5, low=80, scale=256.0)
