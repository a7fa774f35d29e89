"""The corpus pipeline: quality rules, near duplicates, repeats, benchmark passages, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents that it keeps, with the
columns of ``documents``; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from listingflow.llm import decontam, jaccard_join, packing, quality, substring
from listingflow.llm.common import stage, table

STAGES = [
    ("quality rules", quality.pipeline_stage),
    ("n-gram Jaccard join", jaccard_join.pipeline_stage),
    ("substring dedup", substring.pipeline_stage),
    ("benchmark decontamination", decontam.pipeline_stage),
    ("packing", packing.pipeline_stage),
]

#: Trained trees and tokenizers have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``, each written as Parquet and read again as the next one's docs."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
