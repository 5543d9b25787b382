"""From raw documents to packed training sequences: quality, near-duplicates, contamination, personal data, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last return the
columns of documents. Stages are written as Parquet in between, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetmill.llm import decontaminate, near_hash, personal_data, quality_gam, retrieval_packing
from packetmill.llm.base import materialise, read_table, settled, stable_numbers


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality model rejects; it is fitted on ``labels`` outside the held-out fold."""
    model = quality_gam.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality_gam.keep(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of every group of similar texts (five-word shingles, 0.8), in table order.

    Rows with equal or null ids are told apart by their place in the files that hold them, which does not depend on how a
    scan is planned; null and wordless texts are one group.
    """
    rows, row = stable_numbers(docs, "rows")
    gone = settled(lambda: near_hash.similar_groups(rows, id_col=row).where(F.col(row) != F.col("component_id")).select(row), "gone")
    return rows.join(gone, row, "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that contain an item of ``benchmark``; null texts contain none."""
    rows, row = stable_numbers(docs, "rows")
    items = read_table(spark, sf_dir, "benchmark")
    found = settled(lambda: decontaminate.contained_items(rows, items, doc_id=row).select(row).distinct(), "contaminated")
    return rows.join(found, row, "left_anti").select(*docs.columns)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask personal data; n_chars follows the text. Null texts stay null."""
    return personal_data.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 2,048 tokens; a null text is packed as an empty one."""
    return retrieval_packing.retrieval_packs(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal data", personal),
    ("packing", packing),
]

#: SQL cannot express the model, the fingerprints or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last is not yet written."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
