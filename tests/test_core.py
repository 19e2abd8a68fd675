"""Rules that SQL doesn't express, on hand-written rows."""

import json

import pytest
from pyspark.sql import functions as F

from actaflow.functions import text as T
from actaflow.operators import analytics as A
from actaflow.operators import consolidate as C
from actaflow.operators import dedup as D
from actaflow.operators import editions as E
from actaflow.operators import repair as R
from actaflow.operators import timeline as L
from actaflow.plans import extract as X
from actaflow.plans import pages as P
from actaflow.sources import lake, portals
from actaflow.streaming.ingest import ingest_documents


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_dismissal_is_not_used_up(spark):
    rows = [("A", 1, "2026-01-01", "exoneracao"), ("A", 2, "2026-01-05", "nomeacao"), ("A", 3, "2026-02-01", "nomeacao"), ("B", 4, "2026-01-01", "nomeacao")]
    df = spark.createDataFrame(rows, "pessoa string, linha int, d string, tipo_ato string").selectExpr("pessoa", "linha", "to_date(d) data", "tipo_ato", "'x' cargo_norm", "'' orgao_norm")
    got = L.timeline(df, "pessoa", "linha").where("retorno").select("linha", "dias_desde_exoneracao", "mudou_cargo", "mudou_orgao")
    assert values(got) == [(2, 4, False, False), (3, 31, False, False)]


def test_same_day_dismissal_comes_first(spark):
    rows = [("A", 1, "2026-01-01", "nomeacao"), ("A", 2, "2026-01-01", "exoneracao"), ("A", 3, "2026-01-01", "outro")]
    df = spark.createDataFrame(rows, "pessoa string, linha int, d string, tipo_ato string").selectExpr("pessoa", "linha", "to_date(d) data", "tipo_ato", "'' cargo_norm", "'' orgao_norm")
    assert values(L.timeline(df, "pessoa", "linha").select("linha", "ordem_pessoa", "retorno")) == [(1, 2, True), (2, 1, False), (3, 3, False)]


def test_milestones_prefer_the_first_of_equal_dates(spark):
    df = spark.sql("SELECT explode(array(date'2025-01-01', date'2026-01-01', date'2026-05-01')) AS data")
    got = L.latest_milestone(df, [("2026-01-01", "first"), ("2026-01-01", "second"), ("2026-04-01", "third")])
    assert [r.marco for r in got.orderBy("data").collect()] == [None, "first", "third"]


def test_first_wins_keeps_the_first_and_is_idempotent(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b"), (4, None), (5, None)], "linha_csv int, k string")
    once = D.first_wins(df, {"k": F.col("k")})
    assert values(once.select("linha_csv")) == [(1,), (2,), (4,)]
    assert values(D.first_wins(once, {"k": F.col("k")})) == values(once)


def test_missing_columns_become_empty(spark):
    got = D.complete_columns(spark.createDataFrame([(None, 1)], "nome string, extra int"), ("nome", "orgao"))
    assert values(got) == [("", "")]
    assert D.missing_columns(got, ("nome", "x")) == "colunas ausentes: x"


def test_name_rules(spark):
    df = spark.createDataFrame([("Ana",), ("Ana 2 Lima",), ("DO CARGO",), ("Ana Lima",), (None,)], "n string")
    got = {r.n: r.m for r in df.select("n", T.rejection_reasons(F.col("n")).alias("m")).collect()}
    assert got["Ana Lima"] == "" and got["Ana"] == "menos_de_2_tokens" and "tem_numero" in got["Ana 2 Lima"]
    assert got["DO CARGO"] == "inicio_suspeito;frase_administrativa;termo_administrativo"
    dirty = {
        "## ANA LIMA, ID FUNCIONAL 12": "ANA LIMA", "ANA LIMA para exercer": "ANA LIMA", "ANA LIMA - 123": "ANA LIMA", "Processo nº 12/34. ANA MARIA LIMA": "ANA MARIA LIMA", "Nome: ANA LIMA": "ANA LIMA",
        "<!-- IMAGE --> ANA LIMA /U00e9": "ANA LIMA", "R E N ATO SOUZA": "RENATO SOUZA", "PA U L O REIS com validade": "PAULO REIS", "JEAN-LUC": "JEAN-LUC", "abc - ANA LIMA DA SECRETARIA": "ANA LIMA", "ANA 2 LIMA": "ANA 2 LIMA",
        "ANA LIMA 12": "ANA LIMA", "PARA EXERCER X": "", "": ""}
    got = {r.n: r.c for r in spark.createDataFrame([(n,) for n in dirty], "n string").select("n", T.clean_person_name(F.col("n")).alias("c")).collect()}
    assert got == dirty


def test_duration_boundaries(spark):
    df = spark.createDataFrame([(None,), (0,), (29,), (30,), (180,), (181,)], "d int")
    assert [r[0] for r in df.select(T.duration_class(F.col("d"))).collect()] == ["desconhecido", "imediato", "curto", "medio", "medio", "longo"]


def test_transition_probabilities_sum_to_one_and_vector_is_stationary(spark, base):
    from actaflow.queries import act_returns

    ret = act_returns(spark, base)
    sums = A.transition_probabilities(ret).groupBy("estado").agg(F.sum("p")).collect()
    assert all(abs(r[1] - 1) < 1e-6 for r in sums)
    assert abs(sum(r.p for r in A.stationary_vector(ret).collect()) - 1) < 1e-9


def test_filters_reject_unknown_columns(spark, base):
    with pytest.raises(ValueError):
        A.filtered(spark.range(1), nome=["x"])


def test_queue(spark):
    q = spark.sql("SELECT * FROM VALUES ('a', '2026-01-01', 'pendente', 1, timestamp_ntz'2026-01-01 00:00:00', timestamp_ntz'2026-01-01 00:00:00', NULL), ('b', '2026-01-02', 'erro', 7, NULL, NULL, 'x'), ('c', '2026-01-03', 'concluido', 1, NULL, NULL, NULL) AS t(arquivo, data_publicacao, estado, tentativas, disponivel_em, atualizado_em, erro)")
    assert [r.arquivo for r in E.queue_pop(q, "2026-06-01 00:00:00").collect()] == ["b"]
    after = E.after_failure(q, spark.createDataFrame([("a", "lost")], "arquivo string, erro string"), "2026-02-01 00:00:00")
    a = after.where("arquivo = 'a'").first()
    assert (a.estado, a.tentativas, str(a.disponivel_em), a.erro) == ("erro", 2, "2026-02-01 00:10:00", "lost")


def test_extraction():
    text = "ATOS DO GOVERNADOR\nResolve NOMEAR ANA DE SOUZA LIMA, ID FUNCIONAL 123-4, para exercer o cargo em comissão de Assessor, da Secretaria de Estado de Obras. EXONERAR JOAO PAULO REIS, matrícula 99."
    got = X.acts_of(text, "RJ")
    assert [(a["tipo_ato"], a["nome"]) for a in got] == [("nomeacao", "ANA DE SOUZA LIMA"), ("exoneracao", "JOAO PAULO REIS")]
    assert got[0]["id_funcional"] == "123-4" and got[0]["categoria_assinante"] == "1"
    with pytest.raises(ValueError):
        X.acts_of("NOMEAR ANA LIMA.", "XX")
    assert P.html_text("<style>a</style><p>Ana &amp; Rui</p><br>fim") == "Ana & Rui\nfim"


@pytest.mark.parametrize(("text", "state", "names"), [
    ("NOMEAR Ana de Souza Lima para exercer", "GO", ["ANA DE SOUZA LIMA"]),
    ("NOMEAR, em substituição a JOAO REIS PRADO, o servidor RUI BARROS LIMA, matrícula 1, para o cargo de Chefe.", "AM", ["RUI BARROS LIMA"]),
    ("RESOLVE: NOMEAR ANA LIMA REIS, para o cargo. Fulano vai nomear cada arquivo de vídeo.", "PB", ["ANA LIMA REIS"]),
    ("NOMEAR ANA LIMA REIS, para o cargo.", "PB", []),
    ("NOMEAR os FUNCIONÁRIOS ABAIXO RELACIONADOS: NOME RG LF CARGO\nANA LIMA REIS 12.345-6 1 ASSESSOR\nEVA PRADO LIMA 22.345-6 1 CHEFE\nRUI BARROS REIS 32.345-6 2 CHEFE\n", "PR", ["ANA LIMA REIS", "EVA PRADO LIMA", "RUI BARROS REIS"]),
    ("Nomeados: 123456 ANA LIMA REIS Assessor. Exonerada a servidora EVA PRADO LIMA, matrícula 9.", "BA", ["ANA LIMA REIS", "EVA PRADO LIMA"]),
    ("NOMEADO COMPROMISSO DE POSSE, para o cargo; a candidata EVA PRADO LIMA, classificada.", "CE", ["EVA PRADO LIMA"]),
    ("Fica nomeado(a) VÂNIA D. REIS LIMA, matrícula 7, para ocupar a vaga de Chefe.", "GO", ["VÂNIA D. REIS LIMA"]),
    ("", "RJ", []),
])
def test_names_of_acts(text, state, names):
    assert [a["nome"] for a in X.acts_of(text, state)] == names


def test_long_documents_cost_their_length():
    import time

    part = "ATOS DO SECRETÁRIO\nNOMEAR ANA LIMA REIS, matrícula 1, para exercer o cargo de Chefe. Texto que segue sem fim.\n"
    took = []
    for n in (500, 4000):
        began = time.time()
        X.acts_of(part * n, "GO")
        took.append(time.time() - began)
    assert took[1] < 16 * max(took[0], 0.05)


def test_registered_portal(spark):
    @portals.register_source("XX")
    def own(answer, day, state, base):
        yield day.isoformat(), "I", f"{base}/{answer}"

    assert list(portals.PARSERS.pop("XX")("a", portals.day_of("01/02/2026"), "XX", "b")) == [("2026-02-01", "I", "b/a")]
    calls = []

    def get(url):
        calls.append(url)
        if len(calls) < 4:
            raise OSError("no")
        return b"x"

    waits = []
    assert portals.fetch(get, ["a", "b"], sleep=waits.append) == b"x" and calls == ["a", "b", "a", "b"] and waits == [2.0]
    assert portals.retry_seconds(40) == 30 and str(portals.long_day("Dia 1º de março de 2026")) == "2026-03-01" and portals.long_day("31 de abril de 2026") is None
    assert portals.estimated_number(portals.date(2026, 5, 11), portals.date(2026, 5, 8), 10) == 11


def test_lake_documents(spark, tmp_path):
    folder = tmp_path / "LAKE" / "GO" / "2026" / "01"
    folder.mkdir(parents=True)
    (folder / "DOEG_CADERNO_EXECUTIVO_2026-01-02.md").write_bytes("tex\u00e7".encode() + b"\xff\xfeto")
    (folder / "DOEG_X_2026-02-02.md").write_text("x")
    doc = lake.lake_documents(spark, str(tmp_path / "LAKE"), "2026-01-01", "2026-01-31").collect()
    assert [(d.estado, str(d.data_publicacao), d.caderno, d.text) for d in doc] == [("GO", "2026-01-02", "Caderno Executivo", "texçto")]


ACT = {"estado": "GO", "data_publicacao": "2026-01-02", "caderno": "I", "tipo_ato": "nomeacao", "nome": 'Ana "x"', "cargo": "c", "orgao": "o", "assinante": "s", "trecho": "a\nb"}


def act_csv(path, rows, drop=()):
    import csv

    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.DictWriter(f, [c for c in lake.S.ACT_COLUMNS if c not in drop], extrasaction="ignore")
        w.writeheader()
        w.writerows([{**dict.fromkeys(lake.S.ACT_COLUMNS, ""), **r} for r in rows])


def test_act_tables(spark, tmp_path):
    act_csv(tmp_path / "GO" / "DOEG_2026.csv", [ACT, {**ACT, "nome": "Rui"}], drop=("spacy_pessoa",))
    act_csv(tmp_path / "GO" / "DOEG_2025.csv", [ACT])
    act_csv(tmp_path / "RJ" / "outro.csv", [ACT])
    act_csv(tmp_path / "analises" / "GO" / "x_2026.csv", [ACT])
    got = lake.read_acts_csv(spark, str(tmp_path), "GO", (2026,))
    assert [(r.linha_csv, r.nome, r.trecho, r.spacy_pessoa, r.arquivo_csv.rsplit("/", 1)[1]) for r in got.orderBy("linha_csv").collect()] == [(2, 'Ana "x"', "a\nb", "", "DOEG_2026.csv"), (3, "Rui", "a\nb", "", "DOEG_2026.csv")]
    assert values(lake.states_of(spark, str(tmp_path))) == [("GO",), ("RJ",)] and lake.csv_files(spark, str(tmp_path), yearly_only=True).count() == 2


def test_writing_acts_twice_adds_only_new_ones(spark, tmp_path):
    df = spark.createDataFrame([tuple(ACT.values()), tuple(ACT.values()), tuple({**ACT, "nome": "Rui"}.values())], list(ACT))
    assert lake.write_acts(df, str(tmp_path / "t")) == 2
    assert lake.write_acts(df.unionByName(spark.createDataFrame([tuple({**ACT, "nome": "Eva"}.values())], list(ACT))), str(tmp_path / "t")) == 1
    assert sorted(r.nome for r in spark.read.parquet(str(tmp_path / "t")).where("uf = 'GO' and ano = 2026").collect()) == ['Ana "x"', "Eva", "Rui"]


def test_files_are_deduplicated_in_place(spark, tmp_path):
    path = tmp_path / "GO" / "DOEG_2026.csv"
    act_csv(path, [ACT, {**ACT, "nome": "ana  \"X\""}, {**ACT, "nome": "Rui"}])
    act_csv(tmp_path / "GO" / "DOEG_2025.csv", [ACT, ACT], drop=("orgao",))
    before = path.read_text()
    report = {r.arquivo.rsplit("/", 1)[1]: (r.linhas_antes, r.linhas_depois, r.duplicatas_removidas, r.status) for r in lake.deduplicate_files(spark, str(tmp_path)).collect()}
    assert report == {"DOEG_2026.csv": (3, 2, 1, "simulado"), "DOEG_2025.csv": (2, 2, 0, "ignorado: colunas ausentes (orgao)")} and path.read_text() == before
    lake.deduplicate_files(spark, str(tmp_path), dry_run=False)
    assert [r.nome for r in lake.read_acts_csv(spark, str(tmp_path), "GO", (2026,)).orderBy("linha_csv").collect()] == ['Ana "x"', "Rui"]
    assert lake.read_acts_csv(spark, str(tmp_path), "GO", (2025,)).count() == 2


def test_years_and_failures(spark, tmp_path):
    assert lake.complete_years(spark, str(tmp_path / "y")).count() == 0
    lake.mark_year_complete(spark, str(tmp_path / "y"), "GO", 2025)
    lake.mark_year_complete(spark, str(tmp_path / "y"), "GO", 2025)
    assert values(lake.complete_years(spark, str(tmp_path / "y"))) == [("GO", 2025, "")]


def test_portal_source(spark, tmp_path):
    (tmp_path / "GO").mkdir()
    (tmp_path / "GO" / "2026-01-02.json").write_text(json.dumps({"itens": [{"id": 1, "numero": 5}]}))
    spark.dataSource.register(portals.PortalSource)
    got = spark.read.format("gazette_portal").option("path", str(tmp_path)).option("base", "https://x.example").load()
    assert [(r.uf, str(r.publication_date), r.section, r.url) for r in got.collect()] == [("GO", "2026-01-02", "Diario Oficial GO 5", "https://x.example/portal/edicoes/download/1")]


def test_values_carried_over_stretches(spark):
    rows = [("a", 1, ""), ("a", 2, "x"), ("a", 9000, ""), ("a", 9001, "y"), ("a", 90000, None), ("b", 3, ""), (None, 4, "z"), (None, 5000, "")]
    df = spark.createDataFrame(rows, "g string, o bigint, v string")
    assert values(E.carried_forward(df, "g", "o", "v").na.fill("")) == [(1, ""), (2, "x"), (3, ""), (4, "z"), (5000, "z"), (9000, "x"), (9001, "y"), (90000, "y")]


def test_stationary_vectors_agree(spark, base):
    from actaflow.queries import act_returns

    ret = act_returns(spark, base)
    one = {r.estado: r.p for r in A.stationary_vector(ret).collect()}
    two = {r.estado: r.p for r in A.stationary_by_joins(A.transitions(ret), tolerance=1e-4).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-2 for k in one)
    cycle = spark.createDataFrame([("a", "b", 1), ("b", "a", 1), ("b", "c", 0)], "estado string, prox_estado string, n bigint").where("n > 0")
    assert {r.estado: round(r.p, 3) for r in A.stationary_by_joins(cycle).collect()} == {"a": 0.5, "b": 0.5}


def test_chosen_options(spark):
    options = spark.createDataFrame([("orgao", "a"), ("orgao", "b")], "filtro string, valor string")
    assert values(A.still_valid({"orgao": ["b", "x", "a", "b"], "ano": ["1"]}, options)) == [("orgao", ["b", "a"])]


def test_shared_folder_off_local_masters(monkeypatch):
    from actaflow import runtime

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        runtime.shared_folder(Session())


def test_ingestion_in_two_steps_equals_one(spark, tmp_path):
    schema = "doc_id bigint, estado string, caderno string, data_publicacao date, text string"
    text = "Resolve NOMEAR ANA DE SOUZA LIMA para exercer. EXONERAR JOAO PAULO REIS do cargo."
    one = spark.createDataFrame([(1, "GO", "I", None, text)], schema)
    two = spark.createDataFrame([(2, "GO", "I", None, text.replace("ANA", "EVA")), (3, "GO", "I", None, text)], schema)
    args = [str(tmp_path / x) for x in ("in", "out", "cp")]
    for part in (one, two):
        part.write.mode("append").parquet(args[0])
        ingest_documents(spark, *args)
    assert sorted(r.nome for r in spark.read.parquet(args[1]).collect()) == ["ANA DE SOUZA LIMA", "EVA DE SOUZA LIMA", "JOAO PAULO REIS"]


def test_partitioned_write(spark, tmp_path):
    C.write_partitioned(spark.createDataFrame([("GO", 1), ("RJ", 2)], "estado string, x int"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).where("estado = 'GO'").first().x == 1


def test_governor_of_an_edition(spark):
    texts = [("a", "Ana de Souza Lima\nGovernador em exercício"), ("b", "Assinado: Rui Barros Reis,\nGovernador do Estado"), ("c", "saiu com Paulo Melo ontem"), ("d", None)]
    got = dict(values(R.edition_governor(spark.createDataFrame(texts, "path string, text string"), ["Sergio Cabral", "Paulo Melo"])))
    assert got == {"a": "Ana de Souza Lima - Governador em exercicio", "b": "Rui Barros Reis - Governador", "c": "Paulo Melo - Governador", "d": "Nao identificado"}


def test_governor_is_found_anywhere_in_the_text(spark):
    far = "o texto segue \n" * 20_000
    texts = [("a", far + "Ana de Souza Lima \n \n Governador em exercício" + far), ("b", far + "Rui Barros Reis , \n Governador do Estado"), ("c", far + "com Paulo Melo"), ("d", "Rui Barros Reis" + " " * 200_000 + "secretário")]
    got = dict(values(R.edition_governor(spark.createDataFrame(texts, "path string, text string"), ["Sergio Cabral", "Paulo Melo"])))
    assert got == {"a": "Ana de Souza Lima - Governador em exercicio", "b": "Rui Barros Reis - Governador", "c": "Paulo Melo - Governador", "d": "Nao identificado"}


def test_acts_ahead_of_the_first_heading():
    from actaflow.plans.extract import acts_of

    act = "NOMEAR ANA DE SOUZA LIMA para o cargo de Assessor. RESOLVE "
    assert [a["cargo_assinante"] for a in acts_of(act + "ATOS DO Governador em exercício " + act.replace("ANA", "EVA"), "GO")] == ["Governador em exercicio"] * 2
    assert [a["cargo_assinante"] for a in acts_of(act + "ATOS DO Secretário " + act.replace("ANA", "EVA"), "GO")] == ["", "Secretario"]


def test_pdf_payload(spark):
    import base64

    rows = [(base64.b64encode(b"junk%PDF-1.4 x\xff %%EOF tail").decode(),), (base64.b64encode(b"none").decode(),), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "p string").select(R.pdf_payload(F.col("p"))).collect()]
    assert [bytes(x) if x is not None else None for x in got] == [b"%PDF-1.4 x\xff %%EOF", None, None]


def test_command_line(spark, tmp_path, capsys):
    from actaflow.__main__ import available_states, load_state, main, put_block

    folder = tmp_path / "LAKE" / "GO" / "2026" / "01"
    folder.mkdir(parents=True)
    (folder / "DOEG_EXECUTIVO_2026-01-02.md").write_text("Governador\nPaulo Melo\n\nEXONERAR ANA DE SOUZA LIMA, matrícula 1, do cargo de Chefe.")
    (folder / "DOEG_EXECUTIVO_2026-02-02.md").write_text("NOMEAR ANA DE SOUZA LIMA, matrícula 1, para o cargo de Chefe. NOMEAR RUI BARROS REIS, matrícula 2, para o cargo de Chefe.")
    at = {k: str(tmp_path / k) for k in ("acts", "out", "final", "listing", "report")}
    run = lambda *args: main(list(args), spark)
    for _ in range(2):
        assert run("extract", "--lake", str(tmp_path / "LAKE"), "--output", at["acts"]) == 0
    acts = spark.read.parquet(at["acts"])
    assert acts.count() == 3 and {r.governador_edicao for r in acts.collect()} == {"Paulo Melo - Governador", "Nao identificado"}
    run("analyse", "--input", at["acts"], "--output", at["out"], "--milestone", "2026-01-15:B")
    run("consolidate", "--input", at["out"], "--output", at["final"])
    assert spark.read.parquet(f"{at['out']}/retornos").count() == 1 and available_states(spark, at["final"]) == ["GO"] and load_state(spark, at["final"], "GO")[0].count() == 3
    with pytest.raises(FileNotFoundError):
        load_state(spark, at["final"], "RJ")
    run("report", "--input", at["final"], "--file", at["report"])
    run("report", "--input", at["final"], "--file", at["report"])
    text = open(at["report"]).read()
    assert text.count("| Paulo Melo (ALERJ) | 0 | 1 | -1 |") == 1 and put_block(text, "top", "x").count("x") == 1
    act_csv(tmp_path / "csv" / "GO" / "DOEG_2026.csv", [ACT, ACT])
    run("dedup", "--input", str(tmp_path / "csv"), "--report", str(tmp_path / "r"), "--dry-run")
    (tmp_path / "answers" / "GO").mkdir(parents=True)
    (tmp_path / "answers" / "GO" / "2026-01-02.json").write_text(json.dumps({"itens": [{"id": 1}]}))
    run("listing", "--answers", str(tmp_path / "answers"), "--output", at["listing"])
    assert [line.split(": ")[1] for line in capsys.readouterr().out.splitlines() if line.split(":")[0] in ("extract", "dedup", "listing")] == ["3", "0", "1", "1"]
