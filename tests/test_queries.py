"""Every core query against its SQL on the smallest tables."""

import datetime
import glob
import math
import os

import duckdb
import pytest

from actaflow.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(base):
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{base}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, (datetime.datetime, datetime.date)):
        return str(v)[:19].removesuffix(" 00:00:00")
    if isinstance(v, bool) or not isinstance(v, (int, float)):
        return str(v)
    return f"{float(v):.6f}"


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, base, name):
    got = QUERIES[name](spark, base)
    cur = duck.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(got.columns)
    assert canonical(got.columns, got.collect()) == canonical(columns, cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, base, name):
    assert QUERIES[name](spark, base).columns
    QUERIES[name](spark, base).count()


def test_acts_are_extracted_from_documents(spark, tmp_path):
    text = "ATOS DO GOVERNADOR\n" + "Texto sem ato algum.\n" * 100 + "NOMEAR ANA DE SOUZA LIMA para o cargo de Assessor.\nEXONERAR JOAO PAULO REIS do cargo de Chefe."
    spark.createDataFrame([(1, "GO", text), (2, "GO", None)], "doc_id bigint, estado string, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((r.doc_id, r.tipo_ato, r.nome, r.cargo_assinante.upper()) for r in QUERIES["extract_acts"](spark, str(tmp_path)).collect())
    assert got == [(1, "exoneracao", "JOAO PAULO REIS", "GOVERNADOR"), (1, "nomeacao", "ANA DE SOUZA LIMA", "GOVERNADOR")]
