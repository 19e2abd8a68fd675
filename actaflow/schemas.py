"""Column lists, sentinels and word lists of the engine. Lists marked fixed define results."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

UNKNOWN = "Nao identificado"
UNSIGNED = "Sem identificacao"
#: The 22 columns of an act, in order (fixed values).
ACT_COLUMNS = (
    "estado", "municipio", "diario", "data_publicacao", "caderno", "tipo_ato", "nome", "id_funcional", "assinante", "cargo_assinante",
    "categoria_assinante", "governador_edicao", "representante_governo", "origem_representante", "spacy_pessoa", "spacy_entidades",
    "nome_parse_confiavel", "cargo", "orgao", "trecho", "fonte_url", "arquivo_markdown",
)
ACT_SCHEMA = StructType([StructField(c, StringType()) for c in ACT_COLUMNS])
#: Dismissals sort before appointments of the same day, anything else last (fixed values).
ACTION_ORDER = {"exoneracao": 0, "nomeacao": 1}
OTHER_ACTION = 99
#: Origin of each known representative (fixed values).
ORIGINS = {
    "Andre Ceciliano": "ALERJ", "Claudio Bomfim de Castro e Silva": "Executivo estadual", "Francisco Dornelles": "Vice-governadoria",
    "Luiz Fernando de Souza": "Executivo estadual", "Paulo Melo": "ALERJ", "Rodrigo Bacellar": "ALERJ", "Ricardo Couto de Castro": "TJ-RJ",
    "Sergio Cabral": "Executivo estadual", "Thiago Pampolha": "Vice-governadoria", "Wilson Jose Witzel": "Executivo estadual",
}
#: Words that make a name suspicious, anywhere or at its start, and phrases (fixed values; accents are folded before the test).
ADMINISTRATIVE_TERMS = (
    "AGENTE", "ANALISTA", "ANEXO", "ASSESSOR", "ASSISTENTE", "ATO", "AUDITOR", "BOLETIM", "CANDIDATOS", "CANDIDATAS", "CARGO", "CARGOS", "CHEFE",
    "COMISSAO", "CONFORME", "COORDENADOR", "DECRETO", "DEPARTAMENTO", "DIRETOR", "ESTADO", "EXTRATO", "FUNCAO", "FUNCIONAL", "GABINETE", "ID",
    "INTERNO", "LOTADA", "LOTADO", "MATR", "MATRICULA", "MEMBROS", "PORTARIA", "PROCESSO", "PROFISSIONAIS", "RESOLUCAO", "SECRETARIA", "SERVIDOR",
    "SERVIDORES", "SERVIDORA", "SIMBOLO", "SUBSECRETARIA", "VAGA", "VINCULADA", "VINCULADO", "ABAIXO", "ADMINISTRACAO", "ADMINISTRATIVA",
    "ADMINISTRATIVO", "COMUNICACAO", "DESCRITA", "DESCRITO", "DESCRITOS", "DOCENTE", "FAPERJ", "FINANCEIRA", "FINANCEIRO", "FINANCAS", "INTERNA",
    "LISTADOS", "MENCIONADA", "PROMOCAO", "RELACIONADA", "RELACIONADO", "RELACIONADOS", "VERBA",
)
SUSPICIOUS_STARTS = (
    "A", "AS", "COM", "CONFORME", "DE", "DESTA", "DO", "EM", "OS", "POR", "QUE", "SERVIDOR", "SERVIDORES", "VINCULADA", "VINCULADO", "ABAIXO",
)
ADMINISTRATIVE_PHRASES = (
    "DO CARGO", "DA FUNCAO", "PARA EXERCER", "A CONTAR", "ID FUNC", "PROCESSO", "SECRETARIA DE ESTADO", "EM VAGA", "ATO PROPRIO",
    "CANDIDATOS", "CANDIDATAS", "MEMBROS", "SERVIDORES",
)
#: Lower-case connectors of a name in title case (fixed values).
CONNECTORS = ("de", "da", "do", "das", "dos", "e")
