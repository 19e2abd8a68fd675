"""Queries over small invented inputs that exercise parsers, with their expected rows as SQL.

Extraction, portal answers and pages can't be written as SQL over the given tables; here the inputs are
given and the expected results spelled out, so that the parsers are checked like every other query.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from actaflow.plans.extract import extract_acts
from actaflow.plans.pages import before_town_hall, contents, html_text
from actaflow.runtime import ship_code
from actaflow.sources.portals import PARSERS

_HELD = "Instituto de Previdência dos Servidores do Estado de Minas Gerais"
#: (state, text, expected (kind, name, number, role, agency, signer, signing role, municipality)).
DOCUMENTS: list[tuple[str, str, list[tuple[str, ...]]]] = [
    ("RJ", "ATOS DO GOVERNADOR\nResolve NOMEAR ANA DE SOUZA LIMA, ID FUNCIONAL 123-4, para exercer o cargo em comissão de Assessor, da Secretaria de Estado de Obras. EXONERAR JOAO PAULO REIS, matrícula 99.",
     [("nomeacao", "ANA DE SOUZA LIMA", "123-4", "para exercer o cargo em comissão de Assessor", "da Secretaria de Estado de Obras", "", "Governador", ""), ("exoneracao", "JOAO PAULO REIS", "99", "", "", "", "Governador", "")]),
    ("GO", "NOMEAR Ana de Souza Lima para exercer o cargo de Chefe.", [("nomeacao", "ANA DE SOUZA LIMA", "", "para exercer o cargo de Chefe", "", "", "", "")]),
    ("GO", "NOMEAR, em virtude da aposentadoria de JOAO CARLOS PEREIRA, a servidora ANA DE SOUZA LIMA, para o cargo de Chefe.", [("nomeacao", "ANA DE SOUZA LIMA", "", "para o cargo de Chefe", "", "", "", "")]),
    ("SP", "EXONERAR RUI BARROS REIS e EVA PRADO LIMA do cargo de Assessor.", [("exoneracao", "RUI BARROS REIS", "", "do cargo de Assessor", "", "", "", ""), ("exoneracao", "EVA PRADO LIMA", "", "do cargo de Assessor", "", "", "", "")]),
    ("MT", "EXONERAR, a pedido, o servidor MARIO JOSE PRATES, matrícula funcional nº 111/001, do cargo efetivo de Professor, lotado na Secretaria de Estado de Educação.\nNOMEAR, nos termos da lei, EVA CLARA DA SILVA, matrícula nº 222/001, para exercer o cargo de Assessora.",
     [("exoneracao", "MARIO JOSE PRATES", "111/001", "do cargo efetivo de Professor", "na Secretaria de Estado de Educação", "", "", ""), ("nomeacao", "EVA CLARA DA SILVA", "222/001", "para exercer o cargo de Assessora", "", "", "", "")]),
    ("MS", "EXONERAR, a pedido, EVA CLARA GUEDES ROSA, matrícula nº 55349, do cargo efetivo de Analista.\nEXONERAR, por necessidade do serviço, o militar abaixo relacionado:\n1. CB BM VITOR TIAGO DE PÁDUA MELO 423.616-021\n",
     [("exoneracao", "EVA CLARA GUEDES ROSA", "55349", "do cargo efetivo de Analista", "", "", "", ""), ("exoneracao", "VITOR TIAGO DE PÁDUA MELO", "", "", "", "", "", "")]),
    ("MG", f"NOMEIA, nos termos da lei, JOÃO DA SILVA, MASP 1234567-8, do {_HELD} do cargo de Analista, a partir de 01/10/2026.\n", [("nomeacao", "JOÃO DA SILVA", "1234567-8", "cargo de Analista", _HELD, "", "", "")]),
    ("MG", "EXONERA os servidores:\n| Nome | Cargo | Masp |\n| --- | --- | --- |\n| João da Silva | Analista de Gestão | 1.234.567-8 |\n| Maria de Souza | Técnico Administrativo | 1.345.678-9 |\n",
     [("exoneracao", "JOÃO DA SILVA", "1234567-8", "Analista de Gestão", "", "", "", ""), ("exoneracao", "MARIA DE SOUZA", "1345678-9", "Técnico Administrativo", "", "", "", "")]),
    ("MG", "Polícia Civil do Estado de Minas Gerais\n" + "Texto intermediário.\n" * 60 + "EXONERA os servidores:\nJoão da Silva Analista de Gestão 1.234.567-8 I Unidade\n\nSecretaria de Estado de Saúde\nNOMEIA, nos termos da lei, MARIA DE SOUZA, MASP 1345678-9, para o cargo de Diretora.\n",
     [("exoneracao", "JOÃO DA SILVA", "1234567-8", "Analista de Gestão", "Polícia Civil do Estado de Minas Gerais", "", "", ""), ("nomeacao", "MARIA DE SOUZA", "1345678-9", "cargo de Diretora", "", "", "", "")]),
    ("MG", "Instituto de Terras do Norte\nDiretor-Geral: Henrique Prado Reis\nexonera, nos termos da lei, VITÓRIA LEMES DA SILVA, MASP 1569793-\n1, do cargo DAI-5, a partir de 1/10/2026.\n", [("exoneracao", "VITÓRIA LEMES DA SILVA", "1569793-1", "cargo DAI-5", "", "HENRIQUE PRADO REIS", "Diretor-Geral", "")]),
    ("MG", "nomeia, usando da competência delegada, os representantes como membro(s) junto ao Conselho Estadual de Águas - CEA, a contar de 03/09/2026:\nADRIANA NUNES PARDO, em substituição a LUDMILA LEMES DE SOUZA, TITULAR\n",
     [("nomeacao", "ADRIANA NUNES PARDO", "", "membro(s) junto ao Conselho Estadual de Águas - CEA", "", "", "", "")]),
    ("RJ", "Secretaria de Estado de Obras\nRui Barros Reis\n\n## SECRETARIA DE ESTADO DE OBRAS\nATOS DO SECRETÁRIO DE ESTADO\nEXONERAR EVA PRADO LIMA, matrícula 7.\nMUNICÍPIO DE PORTO NOVO PREFEITURA\nNOMEAR ANA LIMA REIS, para o cargo de Chefe.",
     [("exoneracao", "EVA PRADO LIMA", "7", "", "", "Rui Barros Reis", "Secretario de Estado - Secretaria de Estado de Obras", ""), ("nomeacao", "ANA LIMA REIS", "", "para o cargo de Chefe", "", "Rui Barros Reis", "Secretario de Estado - Secretaria de Estado de Obras", "Porto Novo")]),
    ("RS", "NOME: EVA PRADO LIMA IDENTIFICAÇÃO FUNCIONAL: 123/01\nO Governador resolve EXONERAR a servidora acima, a contar de hoje.", [("exoneracao", "EVA PRADO LIMA", "", "", "", "", "Governador", "")]),
]

#: (state, day asked for, answer, expected (day, section, address below ``B``)).
ANSWERS: list[tuple[str, str, object, list[tuple[str, str, str]]]] = [
    ("GO", "2026-05-04", {"erro": False, "itens": [{"id": 7, "numero": 12}, {"id": 8, "suplemento": 1}, {"numero": 9}]}, [("2026-05-04", "Diario Oficial GO 12", "B/portal/edicoes/download/7"), ("2026-05-04", "Diario Oficial GO 8 - Suplemento", "B/portal/edicoes/download/8")]),
    ("AM", "2026-05-04", {"erro": True, "itens": [{"id": 7}]}, []),
    ("AP", "2026-05-04", {"itens": [{"id": 7, "numero": 1, "suplemento_nome": "Extra"}]}, [("2026-05-04", "Diario Oficial AP 1 - Extra", "B/portal/edicoes/download/7")]),
    ("ES", "2026-05-04", {"itens": [{"id": 1, "tipo_edicao_nome": "Executivo"}, {"id": 2, "tipo_edicao_nome": "Executivo"}]}, [("2026-05-04", "Executivo", "B/portal/edicoes/download/1"), ("2026-05-04", "Executivo - Edicao 2", "B/portal/edicoes/download/2")]),
    ("SE", "2026-05-04", {"itens": [{"id": 3, "suplemento": "1"}]}, [("2026-05-04", "Diario Oficial SE Suplemento", "B/portal/edicoes/download/3")]),
    ("PR", "2026-05-04", {"itens": [{"id": 3, "data": "01/05/2026", "numero": 5, "tipo_edicao_nome": "Executivo"}, {"id": 4, "data": "x"}]}, [("2026-05-01", "Executivo PR 5", "B/portal/edicoes/download/3")]),
    ("AL", "2026-05-01", {"editions": [{"id": 3, "number": 5, "suplement": True, "publication_date": "2026-05-02T00:00:00"}]}, [("2026-05-02", "Diario Oficial AL 5 - Suplemento", "B/apinova/api/editions/downloadPdf/3")]),
    ("MA", "2026-05-01", {"cadernos": {"Executivo": {"listCadernos": [{"volume": "C", "numero": " 5", "dataPublicacao": "02/05/2026", "arquivo": "a b.pdf"}]}}}, [("2026-05-02", "Diario Oficial MA Executivo C5", "B/download.php?arq=a+b.pdf")]),
    ("MT", "2026-05-04", [{"id": 1, "diario": "Diário Oficial", "numero": 9}, {"id": 2, "diario": "Tribunal"}, {"id": 1, "diario": "Diário Oficial"}], [("2026-05-04", "Diario Oficial MT 9", "B/edicoes/1/download?formato=pdf")]),
    ("MS", "2026-05-04", [{"diario": [{"id": 1, "numero": 9, "dataPublicacao": "04/05/2026", "nomeArquivo": "DO9"}, {"id": 2, "suspenso": True, "dataPublicacao": "04/05/2026"}]}, {"diario": [{"id": 1, "dataPublicacao": "04/05/2026"}]}], [("2026-05-04", "Diario Oficial MS 9", "B/2026/05/04/DO9.pdf")]),
    ("MG", "2026-05-04", {"dados": {"dataPublicacao": "2026-05-04", "cadernos": [{"id": 1, "descricao": "Diário do Executivo"}, {"id": 2, "descricao": "Terceiros"}, {"id": 3, "descricao": "Edição Extra"}]}}, [("2026-05-04", "Diário do Executivo", "B/Caderno/ObterArquivoCadernoPorId?id=1"), ("2026-05-04", "Edição Extra", "B/Caderno/ObterArquivoCadernoPorId?id=3")]),
    ("PI", "2026-05-04", {"data": [["<a href='..\\/x\\/5.pdf'>5</a>", "5", "04/05/2026"], ["<a href='/y.pdf'>", "6", "05/05/2026"]]}, [("2026-05-04", "Diario Oficial PI 5", "B/x/5.pdf")]),
    ("PE", "2026-05-04", {"principal": {"date": "2026-05-04"}, "extra": {"date": "2026-05-01"}}, [("2026-05-04", "Diario Oficial PE", "B/1/arquivos/resumoDiario/05-05-2026/05-05-2026.pdf")]),
    ("RS", "2026-05-04", {"id": 5, "numeroEdicao": 80}, [("2026-05-04", "Diario Oficial RS 80", "B/public/diarios/download/5/pdf")]),
    ("CE", "2026-05-04", {"publications": [{"date": "2026-05-04", "publication_files": [{"download_url": "B/1.pdf", "journal_number": 2}]}]}, [("2026-05-04", "Diario Oficial CE Caderno 2", "B/1.pdf")]),
    ("DF", "2026-05-04", 'x; var links = {"INTEGRA": [{"link": "2026/05&arquivo=DODF 1.pdf"}]};', [("2026-05-04", "Diario Oficial DF INTEGRA DODF 1", "B/dodf/jornal/visualizar-pdf?pasta=2026%2F05&arquivo=DODF+1.pdf")]),
    ("RR", "2026-05-01", '<form><input type="hidden" name="doe" value="doe-20260504.pdf"></form><form></form>', [("2026-05-04", "Diario Oficial RR", "B/_visualizar-doe/?doe=doe-20260504.pdf")]),
    ("TO", "2026-05-04", '<tr><td>04/05/2026</td><td><a href="/diario/77/download">x</a></td></tr><tr><td>03/05/2026</td></tr>', [("2026-05-04", "Diario Oficial TO 77", "B/diario/77/download")]),
    ("RJ", "2026-05-04", '<a href="mostra_edicao.php?session=abc">Poder <b>Executivo</b></a>', [("2026-05-04", "Poder Executivo", "B/mostra_edicao.php?session=abc")]),
    ("PA", "2026-05-04", ["B/2026/2026.05.04.DOE.pdf"], [("2026-05-04", "Diario Oficial PA", "B/2026/2026.05.04.DOE.pdf")]),
    ("RN", "2026-05-04", ["B/12026-05-04E.pdf"], [("2026-05-04", "Diario Oficial RN Extra", "B/12026-05-04E.pdf")]),
    ("RO", "2026-05-04", ["B/2026/05/DOE-04-05-2026.pdf"], [("2026-05-04", "Diario Oficial RO", "B/2026/05/DOE-04-05-2026.pdf")]),
    ("SC", "2026-05-04", ["10", "9-A"], [("2026-05-04", "Diario Oficial SC 9-A - Edicao Extra", "B/2026/20260504/Jornal/9-A.pdf"), ("2026-05-04", "Diario Oficial SC 10 - Edicao Ordinaria", "B/2026/20260504/Jornal/10.pdf")]),
]

PAGES: list[tuple[str, str, str]] = [
    ("texto", "<style>a</style><p>Ana &amp; Rui</p><br>fim<table><tr><td>1</td><td>2</td></tr></table><script>x</script>", "Ana & Rui\nfim\n1 2"),
    ("sumario", '<ul><li><span class="folder">Executivo</span><ul><li><a class="linkMateria" identificador="7">Decreto  1</a></li><li><a class="linkMateria" identificador="7">outro</a></li></ul></li></ul>', "7|Decreto 1|Executivo"),
    ("corte", "Atos do Estado são muitos e longos, ainda mais.\nPREFEITURA MUNICIPAL DE X\nedital", "Atos do Estado são muitos e longos, ainda mais."),
    ("inteiro", "PREFEITURA MUNICIPAL DE X\nAtos do Estado são muitos e longos.", "PREFEITURA MUNICIPAL DE X\nAtos do Estado são muitos e longos."),
]


def _text(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def _rows(rows: list[tuple], columns: str) -> str:
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(_text(v) for v in r) + ')' for r in rows)}) AS t({columns})"


_ACT = ("tipo_ato", "nome", "id_funcional", "cargo", "orgao", "assinante", "cargo_assinante", "municipio")


def extraction_cases(spark: SparkSession, base: str) -> DataFrame:
    docs = spark.createDataFrame([(i, s, t) for i, (s, t, _) in enumerate(DOCUMENTS)], "doc_id bigint, estado string, text string")
    return extract_acts(docs).selectExpr("cast(doc_id as string) AS doc", *_ACT)


def portal_cases(spark: SparkSession, base: str) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(str(i), *r) for i in b["i"] for state, day, answer, _ in [ANSWERS[i]] for r in PARSERS[state](answer, date.fromisoformat(day), state, "B")]
            yield pd.DataFrame(rows, columns=["caso", "dia", "secao", "url"])

    ship_code(spark)
    return spark.range(len(ANSWERS)).withColumnRenamed("id", "i").mapInPandas(run, "caso string, dia string, secao string, url string")


def page_cases(spark: SparkSession, base: str) -> DataFrame:
    made = {"texto": html_text, "sumario": lambda p: "\n".join("|".join(r) for r in contents(p)), "corte": before_town_hall, "inteiro": before_town_hall}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"caso": b["caso"], "resultado": [made[c](p) for c, p in zip(b["caso"], b["pagina"], strict=True)]})

    ship_code(spark)
    return spark.createDataFrame([p[:2] for p in PAGES], "caso string, pagina string").mapInPandas(run, "caso string, resultado string")


QUERIES = {"extraction_cases": extraction_cases, "portal_cases": portal_cases, "page_cases": page_cases}
ORACLES = {
    "extraction_cases": _rows([(i, *r) for i, (_, _, rows) in enumerate(DOCUMENTS) for r in rows], "doc, " + ", ".join(_ACT)),
    "portal_cases": _rows([(i, *r) for i, (_, _, _, rows) in enumerate(ANSWERS) for r in rows], "caso, dia, secao, url"),
    "page_cases": _rows([(c, r) for c, _, r in PAGES], "caso, resultado"),
}
