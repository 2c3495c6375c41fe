"""The corpus pipeline over `documents`: quality rules, line dedup, near duplicates, decontamination, packing.

Counted as part of the subpackage llm.  Every stage takes what its predecessor kept; all but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from altiplano.llm import decontam, jaccard, line_dedup, packing, quality
from altiplano.llm.common import named, staged
from altiplano.llm.queries import model_file, table


def _documents(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars of the text as it is now; columns that an operator adds are not kept."""
    return out.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else named(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the rules reject, and without the lines that too many documents of a host share.

    Null, empty and blank texts have no words and are rejected.  Rows that repeat an id are judged each by their own
    text, copies of one text count once; a row with a null id is judged by its own counts and loses no line.  Very long
    texts are judged whole.  No rows: no rows.  Other columns pass through.
    """
    return _documents(quality.judge(docs, with_text=True).where("kept"), docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without later copies of repeated line runs and of lines of 50 words; a document goes when they were all its words.

    Earlier is the smaller id, then the smaller place.  Null and empty texts, and rows with a null id, stay as they are;
    rows that repeat an id and text are one document, with another text one of their own.  No rows: no rows.  Other
    columns pass through.
    """
    out = line_dedup.dedup_lines(docs, min_words=50)
    return _documents(out.where(F.col("text").isNull() | (F.col("n_removed") == 0) | F.col("text").rlike(line_dedup.WORD)), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group on five-word shingles at a similarity of 0.8: that of the smallest id.

    Null, empty and blank texts have no shingle and stay, as do rows with a null id; rows that repeat an id stay or go
    together.  No rows: no rows.  Other columns pass through.
    """
    return _documents(jaccard.drop_near_duplicates(docs, 5, 80, 100), docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without spans of ten benchmark words; a document goes when they cover more than half of it.

    Every row is judged on its own, whatever its id.  Null and empty texts stay; items that are null or empty hit
    nothing.  No rows: no rows; no items: all stay.  Other columns pass through.
    """
    return _documents(decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), 10, 0.5), docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in sequences of 4096 tokens.

    A null or empty text is one token, the end; rows that repeat an id, or have none, are packed each on their own.
    Longer texts than a sequence are cut, none is dropped.  No rows: no rows.  Other columns are not read.
    """
    return packing.pack(docs, model_file("word_bpe_49k.json"), 4096, 1)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard", near_duplicates),
    ("decontamination", decontaminated),
    ("best_fit_packing", packed),
]

#: SQL has neither the tokenizer nor the packing; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
