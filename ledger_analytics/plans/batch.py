"""End-to-end batch pipeline: archives -> normalised lines -> consolidated
expenses -> validation split -> aggregate report -> typed star schema.

Each stage is written as Parquet and the next stage reads it back.  That
cuts the lineage (a lost executor recomputes from the last written stage,
not from the raw text) and lets later stages prune columns and push
filters into the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks as K
from ..operators import consolidate as C
from ..operators import load as L
from ..operators.aggregate import expense_report
from ..operators.normalize import (
    dropped_null_operator, expense_or_corrupt, harmonize_file_group, normalize_accounts, overflowing_amounts, source_id,
)
from ..operators.validate import split_valid
from ..sinks.files import export_csv, write_rejects, write_parquet
from ..sinks.versions import Load, VersionedTables
from ..sources.archives import extract_archives
from ..sources.files import read_delimited, read_registry

# Staging column lists (positional loads).
STG_OPERATOR_COLUMNS = (
    "registro_ans", "cnpj", "razao_social", "nome_fantasia", "modalidade", "logradouro", "numero", "complemento",
    "bairro", "cidade", "uf", "cep", "ddd", "telefone", "fax", "email", "representante", "cargo_representante",
    "regiao_comercializacao", "data_registro_ans")
STG_EXPENSE_COLUMNS = ("cnpj", "razao_social", "trimestre", "ano", "valor_despesas", "registro_ans", "modalidade", "uf")
STG_AGGREGATE_COLUMNS = ("razao_social", "uf", "total_despesas", "media_trimestral", "desvio_padrao_despesas")


@dataclass
class BatchResult:
    paths: dict[str, str] = field(default_factory=dict)
    written: dict[str, bool] = field(default_factory=dict)
    skipped_files: list = field(default_factory=list)


def run_batch(spark: SparkSession, raw_dir: str, registry_path: str, out_dir: str,
                 archives_dir: str | None = None, on_unmatched: str = "drop",
                 export: bool = True) -> BatchResult:
    """The batch flow of the source application, stage by stage.

    ``archives_dir`` (optional): ZIP files to extract into ``raw_dir``
    first.  Outputs under ``out_dir``: ``lines/`` (expense lines as text),
    ``normalized/`` (by source file), ``quarantine/`` (null_operator D16,
    amount_overflow, corrupt_lines, corrupt_registry, skipped_files),
    ``invalid_dates/``, ``nets/`` (per registration and period, of any sign),
    ``reports/unmatched_registry/`` (J8), ``consolidated/`` (by Ano,
    Trimestre), ``validation_errors/``, ``clean/``, ``aggregated/`` and,
    with ``export``, gzip CSV copies of the consolidated and aggregated
    stages.  Quarantines and reports are replaced by every run (``written``
    tells which have rows); ``skipped_files`` lists the files left out.
    """
    out = out_dir.rstrip("/")
    res = BatchResult()
    if archives_dir:
        status = extract_archives(spark, archives_dir, raw_dir)
        write_parquet(status, f"{out}/archive_status")
        res.paths["archive_status"] = f"{out}/archive_status"

    skipped: list = []
    text = read_delimited(spark, raw_dir, per_group=harmonize_file_group, skipped=skipped)
    res.skipped_files = skipped
    res.written["skipped_files"] = write_rejects(
        spark.createDataFrame(skipped, "path string, reason string"), f"{out}/quarantine/skipped_files")
    # the text is parsed once: expense lines and lines that did not fit their header are one stage
    write_parquet(expense_or_corrupt(text), f"{out}/lines")
    lines = spark.read.parquet(f"{out}/lines")
    res.paths["lines"] = f"{out}/lines"
    res.written["corrupt_lines"] = write_rejects(
        lines.where("_corrupt_record IS NOT NULL").select("source_path", "_corrupt_record"), f"{out}/quarantine/corrupt_lines")
    lines = lines.where("_corrupt_record IS NULL")
    normalized = normalize_accounts(lines).withColumn("source_id", source_id())
    write_parquet(normalized, f"{out}/normalized", partition_by=["source_id"])
    res.paths["normalized"] = f"{out}/normalized"
    res.written["null_operator"] = write_rejects(dropped_null_operator(lines), f"{out}/quarantine/null_operator")
    res.written["amount_overflow"] = write_rejects(overflowing_amounts(lines), f"{out}/quarantine/amount_overflow")

    registry = read_registry(spark, registry_path)
    res.written["corrupt_registry"] = write_rejects(
        registry.where("_corrupt_record IS NOT NULL"), f"{out}/quarantine/corrupt_registry")
    registry = registry.where("_corrupt_record IS NULL").drop("_corrupt_record")
    stage = spark.read.parquet(f"{out}/normalized").drop("source_id")
    res.written["invalid_dates"] = write_rejects(C.consolidate(stage, registry).invalid_dates, f"{out}/invalid_dates")
    res.written["unmatched_registry"] = write_rejects(C.unmatched_lines(stage, registry),
                                                     f"{out}/reports/unmatched_registry")
    # the nets of all keys, also of those that are not positive: corrections start from them
    write_parquet(C.net_lines(C.split_dates(stage)[0]).withColumn("net", F.col("net").cast("decimal(28,2)")), f"{out}/nets",
                  partition_by=["Ano", "Trimestre"])
    res.paths["nets"] = f"{out}/nets"
    consolidated = C.attach_registry(spark.read.parquet(f"{out}/nets"), registry, on_unmatched=on_unmatched)
    write_parquet(consolidated, f"{out}/consolidated", partition_by=["Ano", "Trimestre"])
    publish_consolidated(spark, out, res, export)
    return res


def publish_consolidated(spark: SparkSession, out: str, res: BatchResult, export: bool) -> None:
    """The stages behind ``consolidated/``: validation split, report, text copies."""
    res.paths["consolidated"] = f"{out}/consolidated"
    consolidated = spark.read.parquet(f"{out}/consolidated")
    valid, invalid = split_valid(consolidated)
    res.written["validation_errors"] = write_rejects(invalid, f"{out}/validation_errors")
    write_parquet(valid, f"{out}/clean")
    res.paths["clean"] = f"{out}/clean"

    report = expense_report(spark.read.parquet(f"{out}/clean"))
    write_parquet(report, f"{out}/aggregated")
    res.paths["aggregated"] = f"{out}/aggregated"
    if export:
        export_csv(consolidated, f"{out}/export/consolidado_despesas", compression="gzip")
        export_csv(spark.read.parquet(f"{out}/aggregated"), f"{out}/export/despesas_agregadas", compression="gzip")


def staged_text(df: DataFrame) -> DataFrame:
    """A stage as the text a staging table holds (every column STRING)."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def registry_as_staging(registry: DataFrame) -> DataFrame:
    """The registry (read with its header) in the staging layout: lower-case
    names, the id column named ``registro_ans``, absent columns NULL."""
    source = {c: ("REGISTRO_OPERADORA" if c == "registro_ans" else c.upper()) for c in STG_OPERATOR_COLUMNS}
    cols = [F.col(s).cast("string").alias(c) if s in registry.columns else F.lit(None).cast("string").alias(c)
            for c, s in source.items()]
    if "reg_order" in registry.columns:
        cols.append(F.col("reg_order"))
    return registry.select(*cols)


def _expenses_as_staging(clean: DataFrame) -> DataFrame:
    """The validated rows in the staging layout."""
    return staged_text(clean).toDF(*[c.lower() for c in clean.columns]).withColumnsRenamed(
        {"valordespesas": "valor_despesas", "razaosocial": "razao_social", "registroans": "registro_ans"})


def table_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def load_star_schema(spark: SparkSession, stg_operators: DataFrame, clean: DataFrame, aggregated: DataFrame,
                     out_dir: str) -> dict[str, str]:
    """Typed loads (Q13–Q15) into Parquet tables under ``out_dir``:
    ``operadoras`` (dense key, appended to), ``despesas_consolidadas`` partitioned by
    (ano, trimestre), ``despesas_agregadas``, plus the reject sets.
    ``stg_operators`` is the staging layout (:func:`registry_as_staging`
    or a positional :func:`~ledger_analytics.sources.files.read_staging`)."""
    out = out_dir.rstrip("/")
    # operators that are there keep their key, new ones are appended: facts of earlier loads stay right
    path = f"{out}/operadoras"
    existing = table_if_any(spark, path)
    ops = L.load_operators(stg_operators, existing)
    write_parquet(ops.rows, path, mode="overwrite" if existing is None else "append")
    write_rejects(ops.rejects, f"{out}/rejects/operadoras")
    dim = spark.read.parquet(path)

    facts = L.load_expenses(_expenses_as_staging(clean), dim)
    write_parquet(facts.rows, f"{out}/despesas_consolidadas", partition_by=["ano", "trimestre"])
    write_rejects(facts.rejects, f"{out}/rejects/despesas_consolidadas")

    stg_agg = staged_text(aggregated).toDF(*STG_AGGREGATE_COLUMNS)
    aggs = L.load_aggregates(stg_agg)
    write_parquet(aggs.rows, f"{out}/despesas_agregadas")
    write_rejects(aggs.rejects, f"{out}/rejects/despesas_agregadas")
    return {"operadoras": f"{out}/operadoras", "despesas_consolidadas": f"{out}/despesas_consolidadas",
            "despesas_agregadas": f"{out}/despesas_agregadas"}


# The rules of the operator table (NOT NULL columns, widths, the unique key).
OPERATOR_NOT_NULL = ("registro_ans", "cnpj", "razao_social", "uf")
OPERATOR_WIDTHS = {"cnpj": 14, "razao_social": 255, "modalidade": 100, "uf": 2, "cidade": 100}
OPERATOR_KEY = "cnpj"


def load_operators_checked(tables: Load, stg_operators: DataFrame, existing: DataFrame | None) -> tuple[DataFrame, list[tuple[str, str, int]]]:
    """Write the new operators of a load (Q13) and their checks: the rules C2
    and C3 are counted by the write itself, C1 over all loads from the key
    set, which is written beside the table.  The staging rows are read once
    for the operators; returns them and (rule, column, violations)."""
    ops = L.load_operators(stg_operators, existing)
    rows, seen = K.watched(ops.rows, OPERATOR_NOT_NULL, OPERATOR_WIDTHS)
    written = tables.write("operadoras", rows, "append")
    kept = tables.tables.read("operadoras_chaves", tables.base)
    keys = tables.write("operadoras_chaves", K.merged_keys(kept, K.key_counts(written, OPERATOR_KEY)).repartitionByRange("key").sortWithinPartitions("key"))
    tables.write("rejects_operadoras", ops.rejects)
    return written, K.report_of(seen, keys, OPERATOR_KEY)


def publish_star_schema(spark: SparkSession, stg_operators: DataFrame, clean: DataFrame, aggregated: DataFrame,
                        out_dir: str) -> VersionedTables:
    """:func:`load_star_schema` as one publish: operators, facts, aggregates,
    rejects and checks of a load become visible together, or not at all.  A
    load that was broken off can be run again: keys continue from the last
    version, so it gives the same ones."""
    tables = VersionedTables(spark, out_dir)
    load = tables.begin()
    existing = tables.read("operadoras", load.base)
    new, checks = load_operators_checked(load, stg_operators, existing)
    dim = new if existing is None else existing.unionByName(new)
    facts = L.load_expenses(_expenses_as_staging(clean), dim)
    load.write("despesas_consolidadas", facts.rows, "partitions", ["ano", "trimestre"])
    load.write("rejects_despesas_consolidadas", facts.rejects)
    aggs = L.load_aggregates(staged_text(aggregated).toDF(*STG_AGGREGATE_COLUMNS))
    load.write("despesas_agregadas", aggs.rows)
    load.write("rejects_despesas_agregadas", aggs.rejects)
    load.write("operadoras_regras", spark.createDataFrame(checks, "rule string, column_name string, n bigint"))
    load.publish()
    return tables
