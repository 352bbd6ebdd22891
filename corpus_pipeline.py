"""A training corpus from raw documents, in five stages.

Each stage reads what its predecessor has written and returns a DataFrame;
all but the last return the columns of ``documents``. ``run`` applies them to
a table folder's documents.

1. language_id: documents without a language (no letter) or with less than
   half of their letters in one go; ``lang`` becomes the language found.
2. line_dedup: repeated passages of three lines and more keep their first
   occurrence; documents that lose all of their lines go.
3. ngram_jaccard: one document of each group of near copies stays.
4. suffix_dedup: passages of 50 bytes and more keep their first occurrence;
   documents of which only white space is left go.
5. best_fit_packing: places of all documents in sequences of 2,048 tokens.

Each stage returns whole rows of its predecessor, in which only the columns
named above change. Null and empty texts have no language and go in the first
stage, so the later ones see none (each would take them: no lines, an empty
set of shingles, no bytes, one piece). Null ids sort after all others: their
documents never displace another one. Repeated rows are copies: line_dedup and
suffix_dedup treat rows of one id and text alike, ngram_jaccard keeps one row
of them. Ties between copies go to the smallest id, then to the smallest hash of
id and text. Very long texts go through every stage whole; a document of more
than a sequence is cut into pieces by the last one alone. An empty table gives
an empty table of the same columns. Columns beside those of ``documents`` are
left out, whatever their names.

Python parts of the stages can't be said in SQL, so ``ORACLE_SQL`` is None and
the tests hold the stages against brute force.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm import jaccard, langid, line_dedup, packing, queries, suffix
from marquee.llm.common import prepare, table
from marquee.session import checkpoint_root
from marquee.sinks.tables import remove_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Bytes of rows that go to or from a Python worker at once (Spark's own bound counts rows, however long they are).
BATCH_BYTES = 4 * 1024 ** 2
#: Of a generation of the packing stage's cache: half of what the operator takes by default, as other stages' workers live beside it.
CACHE_BYTES = 40_000_000
MIN_SCORE = 0.5


def _prepared(spark: SparkSession) -> None:
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def _documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents``, with n_chars as the text now is."""
    return df.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in COLUMNS))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepared(spark)
    found = langid.identify(docs, langid.fit(docs), keep=COLUMNS)
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= MIN_SCORE))
    return _documents(kept.drop("lang").withColumnRenamed("lang_pred", "lang"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepared(spark)
    found = line_dedup.drop_repeated_lines(docs.select(*COLUMNS))
    return _documents(found.where((F.col("n_removed") == 0) | (F.length(F.trim("text")) > 0)))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepared(spark)
    kept = jaccard.similar_groups(docs).where("kept").select("key")
    one = docs.select(F.xxhash64("doc_id", "text").alias("key"), *COLUMNS).join(kept, "key", "left_semi")
    return _documents(one.groupBy("key").agg(*(F.first(c).alias(c) for c in COLUMNS)))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepared(spark)
    return _documents(suffix.without_repeats(docs.select(*COLUMNS)))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _prepared(spark)
    return packing.pack_documents(docs, queries.tokenizer_file("word_bpe_49k.json"), cache_bytes=CACHE_BYTES)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup_stage), ("ngram_jaccard", ngram_jaccard), ("suffix_dedup", suffix_dedup),
          ("best_fit_packing", best_fit_packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage has written goes when the next one has."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            remove_path(spark, before)
        before = path
    return docs
