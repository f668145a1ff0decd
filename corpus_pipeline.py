"""A cleaning pipeline over ``documents``: five stages, each one operator of :mod:`tidemark.llm`.

Every stage takes what its predecessor kept and returns the columns of ``documents``; the last one
returns the packed pieces. The output of each stage is written as Parquet and read again, so a lost
executor costs at most one stage's work.

1. ``language_id``: rejects documents that are in no learned language: no text, no letter, or letters that look
   like noise rather than like the best mixture of languages.
2. ``near_dedup``: of each group of near copies one document of the least id stays, or one without an id
   if none has any; of rows that repeat, one.
3. ``substring_dedup``: passages of 35 and more words that also occur elsewhere are cut out.
4. ``decontamination``: words that lie in benchmark passages are cut out.
5. ``packing``: what is left is packed into sequences of 2048 ids.

All stages take null ids, texts and other columns, repeated rows and texts of any length as the docstrings say,
and give no row for an empty table; columns other than those of ``documents`` are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import among, cut, doc_key, not_among, table
from tidemark.llm.decontaminate import contaminated, cut_spans
from tidemark.llm.langid import UNKNOWN, fit, identify
from tidemark.llm.neardup import near_duplicates
from tidemark.llm.packing import pack
from tidemark.llm.queries import tokenizer_file
from tidemark.llm.substrings import remove_repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
NOISE = -10.0  # evidence (log of the odds for a learned language against noise) below which a document goes
SIMILARITY = 80  # percent of the union of two shingle sets that they share; the 85 of op2 is that query's own


def _with_text(docs: DataFrame, text) -> DataFrame:
    """The columns of ``documents`` with another text; ``n_chars`` counts it anew."""
    return docs.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in the languages learned from the labelled rows among them: those whose mixture of languages
    explains the letters, or at least not far worse than noise does. Null texts and texts without a letter go.
    Where no row is labelled, anything that has a letter stays. Ids and labels may be null and repeat: each row is
    judged by its text alone."""
    langs, logs = fit(docs, F.lit(True))
    if not langs:
        return docs.where(F.col("text").rlike(r"\p{L}")).select(*COLUMNS)
    told = identify(docs, langs, logs, keep=COLUMNS)
    return told.where((F.col("lang_pred") != UNKNOWN) & (F.col("evidence") >= NOISE)).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies: one of the least id, or one without an id if none has any; rows of
    equal id and text count as one group too, also without words. Texts without words are not linked."""
    told = near_duplicates(docs, percent=SIMILARITY, with_root=True)
    # rows of one key have the same id and text; aggregated before the shuffle, so a hot group is not gathered
    keys = told.groupBy("root", "key").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n"))
    alone = F.when(F.col("root").isNull(), F.col("key"))
    first = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "key", "n")).alias("first")
    kept = cut(keys.groupBy("root", alone.alias("alone")).agg(first).select("first.key", "first.n"), "kept")
    # only texts of rows that go or repeat are looked for by key; all others stay where they are
    gone = cut(keys.select("key").join(kept, "key", "left_anti").distinct(), "gone")
    repeated = kept.where("n > 1").select("key")
    touched = gone.unionByName(repeated)
    rows = docs.select(*COLUMNS, doc_key("doc_id", "text").alias("key"))
    single = not_among(rows, touched).unionByName(among(rows, touched).join(touched, "key", "left_anti").select(*COLUMNS, "key"))
    one = among(rows, repeated).join(repeated, "key", "left_semi").groupBy("key").agg(F.min(F.struct(*COLUMNS)).alias("row"))
    return single.select(*COLUMNS).unionByName(one.select("row.*"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out passages of 35 and more words that occur elsewhere too, in the same document included; a document that
    has none keeps its text as it is, also a null one. Rows that repeat would have all of their words cut: the
    stage before leaves one."""
    out = remove_repeats(docs, keep=[c for c in COLUMNS if c != "doc_id"])
    return _with_text(out, F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out the words of benchmark passages; a clean document keeps its text as it is, also a null one. Rows that
    repeat are cut alike. Null ids and texts of ``benchmark`` take no part as the operator says."""
    found = contaminated(docs, table(spark, sf_dir, "benchmark"), with_key=True).where("contaminated")
    spans = cut(found.select("key", "spans").dropDuplicates(["key"]), "benchmark-spans")
    keyed = docs.select(*COLUMNS, doc_key("doc_id", "text").alias("key")).join(spans, "key", "left")
    return _with_text(cut_spans(keyed), F.col("text"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all that is left: pieces of every row, an empty or null text being its end id alone."""
    return pack(docs, tokenizer_file("byte_bpe_50k.json"), capacity=2048, end_id=1)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup),
          ("decontamination", decontamination), ("packing", packing)]

ORACLE_SQL = None  # neither the inferred language nor the tokenizer's ids can be told in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs, f"stage-{name}")
    return docs
