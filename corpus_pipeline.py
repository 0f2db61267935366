"""The corpus pipeline: five stages from raw documents to a weighted mix.

Every stage works on all that its predecessor kept and is written as Parquet before the next one reads it,
so a lost executor costs one stage's work at most.  Stages 1 to 4 return the columns of their input; the
last one returns each document's part in the mix.

Defined cases are those of the operators: nulls in any column, empty texts, repeated rows, empty tables and
further columns are carried through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledger_analytics.llm import decontaminate, mixing, secrets, simhash, toxicity
from ledger_analytics.session import ensure_checkpoint_dir


def _unused(docs: DataFrame, name: str) -> str:
    """A column name that the table doesn't have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network rejects go."""
    network = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = _unused(docs, "toxicity_score")
    return toxicity.with_score(docs, network, name=score).where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the least id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark passages go (at least one word in twenty hit)."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; documents stay, with their new length in ``n_chars``."""
    spans = _unused(docs, "secret_spans")
    found = secrets.find_secrets(docs, into=spans)
    text = secrets.redact(F.col("text").cast("string"), F.col(spans))
    changed = F.size(spans) > 0
    columns = {"text": text} | ({"n_chars": F.when(changed, F.length(text).cast("long")).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {})
    return found.withColumns(columns).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's part in the mix of sources by weight."""
    return mixing.mix_sources(docs)[1].select("doc_id", "size", "source_size", "target", "taken")


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mix", mix),
]

#: the trained stages have no SQL form; the tests hold the whole run against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below ``spark.checkpoint.dir`` and read again."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        path = f"{folder}/stage-{place}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
