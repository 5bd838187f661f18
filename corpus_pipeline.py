"""From raw documents to packed training sequences, a stage at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.byte_cnn import keep_good
from tessera.llm.common import materialize, named, table
from tessera.llm.jaccard_join import keep_first
from tessera.llm.line_dedup import line_dedup
from tessera.llm.packing import pack
from tessera.llm.substring_dedup import substring_dedup


def _cleaned(operator, docs: DataFrame, added: tuple[str, ...]) -> DataFrame:
    """``docs`` with its texts cleaned, n_chars as they are then, all other columns as they were; ``added``: what the operator adds."""
    own = {c: f"__own_{c}" for c in docs.columns if c.lower() in added}
    out = operator(docs.withColumnsRenamed(own))
    out = out.select([out[f"`{own.get(c, c)}`"].alias(c) for c in docs.columns])
    return out.select(named(out, {"n_chars": F.char_length(out.text).cast("long")} if "n_chars" in docs.columns else {}))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated chunks of lines go, the document stays."""
    return _cleaned(line_dedup, docs, ("n_lines", "n_removed_lines"))


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id stays."""
    return keep_first(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go, the document stays."""
    return _cleaned(substring_dedup, docs, ("removed",))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left in sequences of at most 4096 tokens."""
    return pack(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", jaccard_stage),
    ("substring_dedup", substring_stage),
    ("packing", packing_stage),
]

#: The classifier and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
