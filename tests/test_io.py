"""File round trips: mixed delimiters, BOM, headers, archives, sinks,
the end-to-end pipeline and the streaming ingest (all in temp folders)."""

import glob
import os
import tempfile
import zipfile
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from ledger_analytics.operators.normalize import harmonize_file_group, normalize_accounts
from ledger_analytics.plans.batch import load_star_schema, registry_as_staging, run_batch
from ledger_analytics.sinks.files import write_parquet
from ledger_analytics.sources.archives import extract_archives
from ledger_analytics.sources.files import file_headers, list_files, read_delimited, read_registry
from ledger_analytics.streaming.ingest import start_ingest

Q1 = ("﻿DATA;REG_ANS;CD_CONTA_CONTABIL;DESCRICAO;VL_SALDO_INICIAL;VL_SALDO_FINAL\n"
      "2025-01-01;10;411;ROOT;0,00;1.000,00\n"
      "2025-01-01;10;4111;LEAF;100,00;1.100,50\n"
      "2025-01-01;11;4111;LEAF;0;50,00\n"
      "2025-01-01;12;3111;OTHER;0;70,00\n")
Q2 = ('"DT_REF","REGISTRO_ANS","CD_CONTA","DESCRICAO","SALDO_INI","SALDO_FIN"\n'
      '2025-04-01,10,4111,LEAF,"1.000,00","1.250,00"\n'
      '2025-04-01,12,4111,LEAF,"0,00","10,00"\n')
REGISTRY = ("\ufeffREGISTRO_OPERADORA;CNPJ;Razao_Social;MODALIDADE;UF;CIDADE;DATA_REGISTRO_ANS\n"
            "10;11222333000181;OP TEN;Medicina;SP;Sao Paulo;2001-02-03\n"
            "11;11222333000180;OP ELEVEN;Medicina;RJ;Rio;2001-02-03\n"
            "12;00000000000191;OP TWELVE;Odonto;MG;BH;bad\n")


def _tmp():
    return tempfile.mkdtemp(prefix="ledger-test-")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_read_mixed_files(spark):
    root = _tmp()
    _write(f"{root}/2025/1T2025.csv", Q1)
    _write(f"{root}/2025/sub/2T2025.CSV", Q2)
    _write(f"{root}/notes.md", "ignored")
    _write(f"{root}/2025/other.csv", "A;B;C\n1;2;3\n")
    _write(f"{root}/2025/clash.csv", "REG_ANS;NUM_ANS;CD_CONTA;VL_INICIAL;VL_FINAL\n1;2;4111;0;1\n")
    _write(f"{root}/2025/empty.txt", "")
    files = list_files(spark, root)
    assert files.count() == 4  # zero-byte files are not listed
    heads = {os.path.basename(r["path"]): r["delimiter"] for r in file_headers(spark, files).collect()}
    assert heads == {"1T2025.csv": ";", "2T2025.CSV": ",", "other.csv": ";", "clash.csv": ";"}
    skipped = []
    lines = read_delimited(spark, root, per_group=harmonize_file_group, skipped=skipped)
    assert lines.count() == 6
    assert sorted(os.path.basename(p) for p, _ in skipped) == ["clash.csv", "other.csv"]
    out = {(r["source_file"], r["REGISTRO_OPERADORA"], r["CODIGO_CONTABIL"]): r["VALOR_DESPESAS"]
           for r in normalize_accounts(lines).collect()}
    assert out == {("1T2025.csv", 10, "4111"): Decimal("1000.50"), ("1T2025.csv", 11, "4111"): Decimal("50.00"),
                   ("2T2025.CSV", 10, "4111"): Decimal("250.00"), ("2T2025.CSV", 12, "4111"): Decimal("10.00")}


def test_archives_and_corrupt(spark):
    src, dest = _tmp(), _tmp()
    with zipfile.ZipFile(f"{src}/1T2025.zip", "w") as z:
        z.writestr("1T2025.csv", Q1)
    with open(f"{src}/broken.zip", "wb") as f:
        f.write(b"not a zip")
    status = {(os.path.basename(r["archive"]), r["status"]) for r in extract_archives(spark, src, dest).collect()}
    assert status == {("1T2025.zip", "extracted"), ("broken.zip", "corrupt")}
    assert os.path.exists(f"{dest}/1T2025/1T2025.csv")
    assert read_delimited(spark, dest).count() == 4


def test_dynamic_overwrite_is_idempotent(spark):
    out = _tmp() + "/t"
    df = spark.createDataFrame([(2025, 1, Decimal("1.00")), (2025, 2, Decimal("2.00"))],
                               "ano int, trimestre int, v decimal(18,2)")
    write_parquet(df, out, partition_by=["ano", "trimestre"])
    write_parquet(df.filter("trimestre = 2"), out, partition_by=["ano", "trimestre"])
    assert spark.read.parquet(out).count() == 2


def test_pipeline_end_to_end(spark):
    raw, out, arch = _tmp(), _tmp(), _tmp()
    _write(f"{raw}/q2/2T2025.csv", Q2 + '2025-04-01,,4111,NO OPERATOR,"0,00","1,00"\n'
           + '2025-04-01,77,4111,NOT REGISTERED,"0,00","3,00"\n')
    with zipfile.ZipFile(f"{arch}/1T2025.zip", "w") as z:
        z.writestr("1T2025.csv", Q1)
    _write(f"{out}/in/registry.csv", REGISTRY)
    res = run_batch(spark, raw, f"{out}/in/registry.csv", f"{out}/o", archives_dir=arch)
    cons = {(r["RegistroANS"], r["Ano"], r["Trimestre"]): r["ValorDespesas"]
            for r in spark.read.parquet(res.paths["consolidated"]).collect()}
    assert cons == {(10, 2025, 1): Decimal("1000.50"), (11, 2025, 1): Decimal("50.00"),
                    (10, 2025, 2): Decimal("250.00"), (12, 2025, 2): Decimal("10.00")}
    clean = spark.read.parquet(res.paths["clean"])
    assert sorted(r["RegistroANS"] for r in clean.collect()) == [10, 10, 12]
    assert res.written["null_operator"] and res.written["unmatched_registry"]
    unmatched = spark.read.parquet(f"{out}/o/reports/unmatched_registry").collect()
    assert [(r["REGISTRO_OPERADORA"], r["valor_total"]) for r in unmatched] == [(77, Decimal("3.00"))]
    assert res.written["validation_errors"]
    agg = {r["RazaoSocial"]: r["Total_Despesas"] for r in spark.read.parquet(res.paths["aggregated"]).collect()}
    assert agg == {"OP TEN": Decimal("1250.50"), "OP TWELVE": Decimal("10.00")}
    tables = load_star_schema(spark, registry_as_staging(read_registry(spark, f"{out}/in/registry.csv")), clean,
                              spark.read.parquet(res.paths["aggregated"]), f"{out}/db")
    ops = spark.read.parquet(tables["operadoras"])
    assert ops.count() == 3
    facts = spark.read.parquet(tables["despesas_consolidadas"])
    assert facts.agg(F.sum("valor_despesa")).first()[0] == Decimal("1260.50")


def test_streaming_ingest_processes_new_files_once(spark):
    land, out, ck = _tmp(), _tmp() + "/norm", _tmp()
    _write(f"{land}/1T2025.csv", Q1)
    start_ingest(spark, land, out, ck).awaitTermination(120)
    assert spark.read.parquet(out).count() == 2
    _write(f"{land}/2T2025.csv", Q2.replace(",", ";").replace('"', "").replace("1.000;00", "1.000,00")
           .replace("1.250;00", "1.250,00").replace("0;00", "0,00").replace("10;00", "10,00"))
    start_ingest(spark, land, out, ck).awaitTermination(120)
    stems = sorted(r["source_id"][:6] for r in spark.read.parquet(out).select("source_id").distinct().collect())
    assert stems == ["1T2025", "2T2025"]
    assert spark.read.parquet(out).count() == 4
    # a third file of an earlier name in another folder, and one that cannot be used
    _write(f"{land}/late/1T2025.csv", Q1)
    _write(f"{land}/late/other.csv", "A;B;C\n1;2;3\n")
    start_ingest(spark, land, out, ck).awaitTermination(120)
    assert spark.read.parquet(out).count() == 6
    skipped = spark.read.parquet(*glob.glob(f"{out}_rejects/batch=*/skipped_files")).collect()
    assert [os.path.basename(r["path"]) for r in skipped] == ["other.csv"]


def test_positional_staging_and_tables(spark):
    from ledger_analytics.plans.batch import STG_AGGREGATE_COLUMNS
    from ledger_analytics.sinks.files import save_table
    from ledger_analytics.sources.files import read_staging

    root = _tmp()
    _write(f"{root}/agg.csv", "Nome;Estado;Total;Media;Desvio\nA;SP;10.005;3.3333;0.125\n;RJ;1;1;1\n")
    stg = read_staging(spark, f"{root}/agg.csv", STG_AGGREGATE_COLUMNS)
    assert stg.columns[:5] == list(STG_AGGREGATE_COLUMNS)
    rows = stg.orderBy("reg_order").collect()
    assert [r["razao_social"] for r in rows] == ["A", None]
    facts = spark.createDataFrame([(1, 2025, 1, Decimal("1.00")), (1, 2025, 2, Decimal("2.00"))],
                                  "cod_operadora int, ano int, trimestre int, valor_despesa decimal(18,2)")
    name = "despesas_test_" + os.path.basename(root).replace("-", "_")
    save_table(facts, name, partition_by=["ano", "trimestre"], path=f"{root}/tbl")
    save_table(facts.filter("trimestre = 2"), name, partition_by=["ano", "trimestre"])  # re-run of one period
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    assert spark.table(name).count() == 2
    spark.sql(f"DROP TABLE {name}")


def test_surrogate_key_is_stable(spark):
    from ledger_analytics.operators.load import surrogate_key

    df = spark.range(0, 3000).selectExpr("CAST((id * 37) % 3001 AS INT) AS k").repartition(5)
    a = {r["k"]: r["sk"] for r in surrogate_key(df, "k", "sk").collect()}
    b = {r["k"]: r["sk"] for r in surrogate_key(df.repartition(3), "k", "sk").collect()}
    assert a == b and sorted(a.values()) == list(range(1, 3001))


def test_duplicate_header_keeps_first(spark):
    root = _tmp()
    _write(f"{root}/q.csv", "DATA;REG_ANS;CD_CONTA_CONTABIL;DESCRICAO;VL_SALDO_INICIAL;VL_SALDO_FINAL;DESCRICAO\n"
                            "2025-01-01;10;4111;first;0,00;5,00;second\n")
    lines = read_delimited(spark, root, per_group=harmonize_file_group)
    assert lines.columns.count("DESCRICAO") == 1
    assert lines.first()["DESCRICAO"] == "first"


def test_command_line(spark, capsys):
    from ledger_analytics.__main__ import main

    raw, out = _tmp(), _tmp()
    _write(f"{raw}/1T2025.csv", Q1)
    _write(f"{raw}/q3/3T2025.csv", Q1.replace("2025-01-01", "2025-07-01").replace("1.100,50", "2.100,50"))
    _write(f"{out}/registry.csv", REGISTRY)
    assert main(["run", "--raw", raw, "--registry", f"{out}/registry.csv", "--out", f"{out}/o"]) == 0
    assert main(["report", "--db", f"{out}/o/db", "--year", "2025", "--cnpj", "11222333000181",
                 "--out", f"{out}/reports"]) == 0
    growth = spark.read.option("header", "true").option("sep", ";").csv(f"{out}/reports/top_growth").collect()
    assert [(r["razao_social"], r["valor_inicial"], r["valor_final"]) for r in growth] == \
        [("OP TEN", "1000.50", "2000.50")]


def test_long_header_line(spark):
    root = _tmp()
    wide = ";".join(f"EXTRA_COLUMN_{i}" for i in range(6000))
    _write(f"{root}/w.csv", f"REG_ANS;CD_CONTA_CONTABIL;VL_SALDO_INICIAL;VL_SALDO_FINAL;{wide}\n"
                            f"10;4111;0,00;5,00;{';'.join('x' for _ in range(6000))}\n")
    heads = file_headers(spark, list_files(spark, root)).collect()
    assert len(heads[0]["header_line"]) > 1 << 16 and heads[0]["delimiter"] == ";"


def test_star_schema_views(spark):
    from ledger_analytics.plans import analytics as A
    from ledger_analytics.plans.views import register_star_schema

    db = _tmp()
    ops = spark.createDataFrame([(1, 10, "a", "A", "M", "SP"), (2, 11, "b", "B", "M", "RJ")],
                                "cod_operadora long, registro_ans long, cnpj string, razao_social string, "
                                "modalidade string, uf string")
    facts = spark.createDataFrame([(1, 2025, 1, Decimal("5.00")), (1, 2025, 2, Decimal("7.00")),
                                   (2, 2025, 1, Decimal("3.00"))],
                                  "cod_operadora long, ano int, trimestre int, valor_despesa decimal(18,2)")
    aggs = spark.createDataFrame([("A", "SP", Decimal("12.00"), Decimal("6.00"), Decimal("1.41"))],
                                 "razao_social string, uf string, valor_total decimal(18,2), "
                                 "media_trimestral decimal(18,2), desvio_padrao decimal(18,2)")
    ops.write.parquet(f"{db}/operadoras")
    facts.write.parquet(f"{db}/despesas_consolidadas")
    aggs.write.parquet(f"{db}/despesas_agregadas")
    register_star_schema(spark, db)
    by_sql = spark.sql("SELECT o.uf, SUM(d.valor_despesa) AS total FROM despesas_consolidadas d "
                       "JOIN operadoras o ON d.cod_operadora = o.cod_operadora GROUP BY o.uf ORDER BY total DESC")
    by_api = A.state_distribution(facts, ops).select("uf", "despesa_total")
    assert [tuple(r) for r in by_sql.collect()] == [tuple(r) for r in by_api.collect()]
    top = spark.sql('SELECT RazaoSocial FROM vw_despesas_estatisticas ORDER BY Total_Despesas DESC LIMIT 1')
    assert top.first()[0] == "A"


def test_positional_registry_layout_loads(spark):
    from ledger_analytics.operators.load import load_operators
    from ledger_analytics.plans.batch import STG_OPERATOR_COLUMNS
    from ledger_analytics.sources.files import read_staging

    root = _tmp()
    header = ";".join(f"Col{i}" for i in range(20))
    rows = []
    for reg, cnpj, name, uf, date in [("300001", "11222333000181", "A", "SP", "2001-02-03"),
                                      ("300002", "00000000000191", "B", "RJ", "03/02/2001"),
                                      ("300001", "11222333000181", "A DUP", "SP", "2001-02-03")]:
        cells = [""] * 20
        cells[0], cells[1], cells[2], cells[4], cells[9], cells[10], cells[19] = reg, cnpj, name, "M", "City", uf, date
        rows.append(";".join(cells))
    _write(f"{root}/cadop.csv", header + "\n" + "\n".join(rows) + "\n")
    stg = read_staging(spark, f"{root}/cadop.csv", STG_OPERATOR_COLUMNS)
    ops = {r["registro_ans"]: r for r in load_operators(stg).rows.collect()}
    assert sorted(ops) == [300001, 300002]
    assert ops[300001]["razao_social"] == "A" and ops[300001]["cidade"] == "City"
    assert str(ops[300001]["data_registro_ans"]) == "2001-02-03" and ops[300002]["data_registro_ans"] is None


def test_archive_member_outside_folder_is_skipped(spark):
    src, dest = _tmp(), _tmp()
    with zipfile.ZipFile(f"{src}/bad.zip", "w") as z:
        z.writestr("../escape.csv", "x")
        z.writestr("ok/inner.csv", Q1)
    status = {(r["member"], r["status"]) for r in extract_archives(spark, src, dest).collect()}
    assert ("../escape.csv", "skipped") in status and ("ok/inner.csv", "extracted") in status
    assert not os.path.exists(os.path.join(os.path.dirname(dest), "escape.csv"))
    assert os.path.exists(f"{dest}/bad/ok/inner.csv")


def test_delimiter_rule(spark):
    root = _tmp()
    for name, line in (("a", "A;B;C"), ("b", "A,B,C"), ("c", "A\tB"), ("d", "ABC"), ("e", "A;B,C"), ("f", "x" * (1 << 21))):
        _write(f"{root}/{name}.csv", line + "\n")
    heads = {os.path.basename(r["path"])[0]: r for r in file_headers(spark, list_files(spark, root)).collect()}
    assert [heads[n]["delimiter"] for n in "abcde"] == [";", ",", "\t", None, ";"]
    assert "first line longer" in heads["f"]["error"]


HEADER = "DATA;REG_ANS;CD_CONTA_CONTABIL;DESCRICAO;VL_SALDO_INICIAL;VL_SALDO_FINAL\n"


def test_files_of_one_name_stay_apart(spark):
    raw, out = _tmp(), _tmp()
    _write(f"{raw}/q1/contas.csv", HEADER + "2025-01-01;10;4111;A;0,00;10,00\n2025-01-01;10;4112;B;0,00;15,00\n")
    _write(f"{raw}/q2/contas.csv", HEADER + "2025-04-01;10;4111;A;0,00;7,00\n2025-04-01;10;41121;C;0,00;10,00\n")
    _write(f"{raw}/q2/book.xlsx", "PK")
    _write(f"{out}/registry.csv", REGISTRY)
    res = run_batch(spark, raw, f"{out}/registry.csv", f"{out}/o")
    got = spark.read.parquet(res.paths["normalized"])
    assert got.count() == 4 and got.agg(F.sum("VALOR_DESPESAS")).first()[0] == Decimal("42.00")
    assert got.select("source_id").distinct().count() == 2
    assert [os.path.basename(p) for p, _ in res.skipped_files] == ["book.xlsx"]
    assert res.written["skipped_files"] and not res.written["null_operator"]
    with pytest.raises(ValueError, match="book.xlsx"):
        read_delimited(spark, raw)


def test_quoted_values_and_corrupt_lines(spark):
    raw, out = _tmp(), _tmp()
    _write(f"{raw}/1T2025.csv", HEADER + '2025-01-01;10;4111;"EMPRESA ""X"" LTDA";0,00;10,00\n2025-01-01;10;4112;trailing\\;0,00;1,00\n'
           + '2025-01-01;10;4113;"a;b";0,00;2,00\n2025-01-01;10;4114;D;0,00;3,00;one;too;many\n2025-01-01;10;\t4115;E;0,00;4,00\n'
           + "2025-01-01;10;4116;F;0,00;99.999.999.999.999.999,00\n")
    _write(f"{out}/registry.csv", REGISTRY)
    res = run_batch(spark, raw, f"{out}/registry.csv", f"{out}/o")
    got = {r["CODIGO_CONTABIL"]: r["DESCRICAO"] for r in spark.read.parquet(res.paths["normalized"]).collect()}
    assert got == {"4111": 'EMPRESA "X" LTDA', "4112": "trailing\\", "4113": "a;b", "4115": "E"}
    corrupt = spark.read.parquet(f"{out}/o/quarantine/corrupt_lines").collect()
    assert ["one;too;many" in r["_corrupt_record"] for r in corrupt] == [True]
    over = spark.read.parquet(f"{out}/o/quarantine/amount_overflow").collect()
    assert [r["CODIGO_CONTABIL"] for r in over] == ["4116"]
    # a clean re-run leaves no rejects of the earlier one
    _write(f"{raw}/1T2025.csv", HEADER + "2025-01-01;10;4111;A;0,00;10,00\n")
    again = run_batch(spark, raw, f"{out}/registry.csv", f"{out}/o")
    assert not again.written["corrupt_lines"] and not again.written["amount_overflow"]
    assert spark.read.parquet(f"{out}/o/quarantine/corrupt_lines").count() == 0


def test_registry_order_follows_the_files(spark):
    root = _tmp()
    names = REGISTRY.split("\n", 1)[0]
    columns = [c.strip().upper() for c in names.split(";")]

    def row(ans, name):
        return ";".join({"REGISTRO_OPERADORA": ans, "RAZAO_SOCIAL": name}.get(c, "x") for c in columns) + "\n"

    _write(f"{root}/a.csv", names + "\n" + row("1", '"FIRST\nOF ""TWO"""'))
    _write(f"{root}/b.csv", names + "\n" + row("1", "SECOND") + "".join(row(str(i), "PAD" * 50) for i in range(2, 200)))
    got = read_registry(spark, root).orderBy("reg_order").limit(2).collect()
    assert [r["RAZAO_SOCIAL"] for r in got] == ['FIRST\nOF "TWO"', "SECOND"]


def test_second_load_keeps_keys(spark):
    db = _tmp() + "/db"

    def load(ids, quarter, amounts):
        stg = spark.createDataFrame([(str(i), f"cnpj{i}", f"OP {i}", "M", "SP", "C", "2001-01-01") for i in ids],
                                    "registro_ans string, cnpj string, razao_social string, modalidade string, uf string, cidade string, data_registro_ans string")
        clean = spark.createDataFrame([(f"cnpj{i}", f"OP {i}", quarter, 2025, Decimal(v), i, "M", "SP") for i, v in amounts.items()],
                                      "CNPJ string, RazaoSocial string, Trimestre int, Ano int, ValorDespesas decimal(18,2), RegistroANS long, MODALIDADE string, UF string")
        agg = spark.createDataFrame([("A", "SP", "1,5", "x", "1")], "a string, b string, c string, d string, e string")
        return load_star_schema(spark, stg, clean, agg, db)

    load([10, 30], 1, {10: "10.00", 30: "30.00"})
    tables = load([10, 20, 30], 2, {20: "20.00"})
    joined = spark.read.parquet(tables["despesas_consolidadas"]).join(spark.read.parquet(tables["operadoras"]), "cod_operadora")
    assert {r["registro_ans"]: r["valor_despesa"] for r in joined.collect()} == {10: Decimal("10.00"), 20: Decimal("20.00"), 30: Decimal("30.00")}
    rejects = spark.read.parquet(f"{db}/rejects/despesas_agregadas").collect()
    assert [r["reject_reason"] for r in rejects] == ["bad_total_despesas;bad_media_trimestral"]


def test_checkpoints_need_a_shared_folder_off_local():
    from types import SimpleNamespace

    from ledger_analytics.session import ensure_checkpoint_dir

    context = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: {}, master="yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=context))
