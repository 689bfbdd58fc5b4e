"""A training corpus from ``documents``: each stage's rows are written and read as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyproof.llm.bpe import encode_stage
from tallyproof.llm.common import stored, table
from tallyproof.llm.mixing import mix
from tallyproof.llm.ngram_join import one_of_each
from tallyproof.llm.pii import redact_stage
from tallyproof.llm.quality_rules import keep_good

STAGES = [
    ("quality rules", keep_good),
    ("n-gram Jaccard join", one_of_each),
    ("personal data", redact_stage),
    ("mixing", mix),
    ("BPE", encode_stage),
]

# The stages use numpy models and rolling hashes, which SQL cannot express; the tests compare
# every stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
