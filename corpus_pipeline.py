"""The corpus pipeline: five stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.

Null texts count as empty, so the quality rules reject them; null ids pass every stage, come last in the
order of documents and are never near-duplicates. Repeated rows are one document: of exact copies the
line stage leaves the first. Columns beyond those of documents are dropped at the first stage, and an
empty table gives an empty one at each.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ensure_checkpoint_dir, remove
from tidemark.llm.decontam import decontaminate
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.pieces import encode_pieces
from tidemark.llm.quality import fit_bands, quality_rules
from tidemark.llm.queries import table, vocabulary
from tidemark.llm.simhash import drop_near_duplicates

#: Words of a document that lost lines, as the quality rules ask of whole ones.
LEAST_WORDS = 50
#: Columns of documents, which n_chars belongs to: it is counted anew where the text changes.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, with bands fitted to those that are labelled good."""
    bands = fit_bands(docs, table(spark, sf_dir, "labels"))
    return quality_rules(docs, bands).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand elsewhere before; those with under LEAST_WORDS words left go."""
    found = dedup_lines(docs, edits=2, least=40, short=True)
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    kept = found.where((F.col("n_dropped") == 0) | (words >= LEAST_WORDS))
    changed = F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.select("doc_id", "text", "lang", "source", changed.alias("n_chars"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least id."""
    return drop_near_duplicates(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold benchmark passages."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"), window=13).where("NOT contaminated").select(*COLUMNS)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' text pieces, decoded and compared."""
    return encode_pieces(docs, vocabulary("piece_bpe_32k.model")).select("doc_id", "lang", "source", "pieces", "n_pieces", "exact")


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("SentencePiece encoding and decoding", pieces),
]

#: Compression bands, edit links, fingerprints and pieces are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over documents. What stages hand over lies in the shared checkpoint folder until the next has read it."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
            if k:
                remove(spark, f"{folder}/{k - 1}")
    return docs
