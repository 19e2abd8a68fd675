"""Extraction of acts from gazette text: a table function over documents.

One Arrow batch of documents goes to Python, rows of acts come back: match offsets, which SQL functions
don't give, tie each act to the latest heading before it (``bisect`` over sorted markers, so a long
document costs its length). Text is read as words with places. An act begins at a verb of the state's
profile and ends before the next verb or stop word; inside it, capitalised runs of words are weighed by
what stands before and behind them, so a person who is replaced or retires isn't taken for the one
appointed. Profiles are data.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from actaflow.runtime import ship_code, spread

# ---------------------------------------------------------------- profiles (fixed values)

_ORDER = ("EXONERAR", "NOMEAR", "NOMEIA")
_PRESENT = (*_ORDER, "EXONERA")
_DONE = ("EXONERADO", "EXONERADA", "EXONERADOS", "EXONERADAS")
_NAMED = ("NOMEADO", "NOMEADA", "NOMEADOS", "NOMEADAS")
_STOPS = ("DESIGNAR", "TORNAR SEM EFEITO", "RESOLVE", "DECRETO", "ATO DO", "ART")
_STOPS_LONG = ("DESIGNAR", "DESIGNADO", "CESSAR", "TORNAR SEM EFEITO", "RESOLVE", "DECRETO", "PORTARIA", "RETIFICA", "RETIFICAR", "RETIFICACAO", "ART")
_STOPS_SHORT = ("DESIGNA", "DESIGNAR", "DISPENSA", "DISPENSAR", "RETIFICA", "RESOLVE")


@dataclass(frozen=True)
class Profile:
    """How one state's gazette words its acts."""

    verbs: tuple[str, ...] = _PRESENT
    cap: int = 5000
    stops: tuple[str, ...] = _STOPS_SHORT
    guard: bool = False
    tables: bool = False
    lists: bool = False
    before: bool = False
    many: bool = False
    not_people: tuple[str, ...] = ()


PROFILES: dict[str, Profile] = {
    "RJ": Profile(_ORDER, 1200, _STOPS), "SP": Profile(_PRESENT, 1500, _STOPS), "ES": Profile((*_PRESENT, *_DONE), 1600, _STOPS_LONG),
    "BA": Profile((*_PRESENT, *_DONE, *_NAMED), 2200, _STOPS_LONG, tables=True), "PB": Profile(_PRESENT, 2200, _STOPS_LONG, guard=True, tables=True),
    "CE": Profile((*_PRESENT, *_DONE, *_NAMED, "NOMEACAO", "NOMEACOES"), 2200, _STOPS_LONG, tables=True, not_people=("COMPROMISSO", "MESMA", "PROVAS", "SUAS")),
    "SC": Profile((*_PRESENT, *_DONE, *_NAMED), 2400, _STOPS_LONG[:6] + ("RETIFICA", "RETIFICAR", "RETIFICACAO"), tables=True, lists=True), "RS": Profile(_PRESENT, 2400, ("DESIGNA", "RETIFICA", "RESOLVE"), before=True),
    "MT": Profile(), "MS": Profile(tables=True), "PR": Profile(("EXONERAR", "NOMEAR"), 7000, ("DESIGNAR", "DESIGNADO", "CESSAR", "TORNAR SEM EFEITO", "RESOLVE", "RETIFICA", "RETIFICAR"), many=True, tables=True),
    "GO": Profile((*_PRESENT, *_DONE, *_NAMED, "NOMEACAO", "EXONERACAO")), "MG": Profile(cap=6000),
}
STATES = "AC AL AM AP BA CE DF ES GO MA MG MS MT PA PB PE PI PR RJ RN RO RR RS SC SE SP TO".split()
#: Signing categories: code, label, folded words of the role; longer roles are tried first.
SIGNERS = (
    ("2", "Governador em exercicio", "GOVERNADOR EM EXERCICIO"), ("1", "Governador", "GOVERNADOR"), ("3", "Diretor-Presidente", "DIRETOR PRESIDENTE"), ("4", "Secretario de Estado", "SECRETARIO DE ESTADO"),
    ("7", "Diretor-Geral", "DIRETOR GERAL"), ("11", "Chefe de Gabinete", "CHEFE DE GABINETE"), ("5", "Secretario", "SECRETARIO"), ("6", "Presidente", "PRESIDENTE"), ("8", "Diretor", "DIRETOR"),
    ("9", "Subsecretario", "SUBSECRETARIO"), ("10", "Superintendente", "SUPERINTENDENTE"), ("12", "Coordenador", "COORDENADOR"),
)
_FEMALE = {"GOVERNADORA": "GOVERNADOR", "DIRETORA": "DIRETOR", "SECRETARIA": "SECRETARIO", "SUBSECRETARIA": "SUBSECRETARIO", "COORDENADORA": "COORDENADOR"}
CONNECTORS = frozenset("DA DE DO DAS DOS E".split())
#: First words that no person's name has, and words that none of its first three is.
NOT_FIRST = frozenset("A O COM SEM PARA DO DA NO NA EM OS AS SIMBOLO".split())
NOT_EARLY = frozenset((
    "ACORDO ALFABETICA ART ARTIGO CANDIDATO CANDIDATOS CARGO CONFORME CPF DECRETO ESTADO FUNCAO FINAL INSCRICAO INCISO HOMOLOGADA HOMOLOGADO LEI PELA PELO NOS ORDEM OCUPANTE PORTARIA "
    "PROCESSO QUADRO RESOLVE SECRETARIA SERVIDOR SERVIDORA SIMBOLO TERMOS RESULTADO").split())
#: Words that a signer's name has nowhere.
NOT_SIGNER = frozenset((
    "ATO ATOS ADJUNTO AJUDANTE APOSTILA APOSTILAS ASSESSOR ASSISTENTE ASSISTENCIA BINETE CIDADAO COM CONGENERE CONVENIO CONTAR COORDENADOR DECRETO DESPACHO DESPACHOS DESIGNADO DIREITOS "
    "DISPOE DIRETA EXONERAR EXPEDIENTE EXERCICIO FURTADOS GABINETE GESTAO GOVERNADOR HIDROMETROS IMAGE INSTRUMENTO LE LOTERICOS MEMBRO MEMBROS MINUTA NATOS NOMEAR NOMENCLATURA OCUPADO "
    "OCUPADA ONDE ORGAO ORGAOS PAGINA PELA PODER PORTARIA PORTAL PREMIOS POLITICOS PUBLICOS PROVIDENCIAS REPRESENTANTES REPOSICAO SECRETARIADO SECRETARIO SECRETARIA SUPERINTENDENCIA WWW "
    "CARGO JANEIRO FEVEREIRO MARCO ABRIL MAIO JUNHO JULHO AGOSTO SETEMBRO OUTUBRO NOVEMBRO DEZEMBRO").split())
RANKS = frozenset("CB SD SGT ST TEN CAP CEL MAJ SOLD BM PM SOLDADO CABO SARGENTO TENENTE CAPITAO MAJOR CORONEL QPBM PMCE CBMCE DR DRA SR SRA".split())
_PEOPLE = frozenset("SERVIDOR SERVIDORA SERVIDORES FUNCIONARIO FUNCIONARIA CANDIDATO CANDIDATA MILITAR POLICIAL PROFESSOR PROFESSORA SENHOR SENHORA ESTADUAL".split())
_HEADS = frozenset((
    "SECRETARIA SUBSECRETARIA FUNDACAO INSTITUTO DEPARTAMENTO GABINETE SUPERINTENDENCIA AUTARQUIA AGENCIA COMPANHIA UNIVERSIDADE CONSELHO PROCURADORIA POLICIA HOSPITAL TRIBUNAL DEFENSORIA "
    "ASSEMBLEIA CONTROLADORIA ADVOCACIA").split())
_ROLE_HEADS = frozenset("CARGO FUNCAO EMPREGO CHEFIA DIRECAO ASSESSORIA VAGA POSTO ATRIBUICOES CARREIRA CLASSE ENCARGOS".split())
#: What a person behind such a word isn't the one the act is about.
_ANOTHER = frozenset("APOSENTADORIA SUBSTITUICAO FALECIMENTO VAGA VACANCIA EXONERACAO DISPENSA AFASTAMENTO LICENCA".split())
_BEHIND = frozenset("MATRICULA MASP RG CPF ID IDENTIFICACAO PORTADOR PORTADORA INSCRITO INSCRITA PARA CARGO OCUPANTE LOTADO LOTADA VINCULO".split())


# ---------------------------------------------------------------- words with places


@lru_cache(maxsize=200_000)
def folded(word: str) -> str:
    """Upper case without accents, outer marks and endings in parentheses (``nomeado(a)``)."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c)).upper()
    plain = re.sub(r"(?<=[A-Z]{3})\((?:AS?|OS?|E?S)\)", "", plain)
    return plain.strip(" \t,.;:-–—'\"“”()[]|#*")


@dataclass(frozen=True)
class Word:
    text: str
    key: str
    start: int
    end: int
    line: bool  # first of its line


def words_of(text: str) -> list[Word]:
    out, last = [], 0
    for m in re.finditer(r"\S+", text):
        out.append(Word(m.group(), folded(m.group()), m.start(), m.end(), "\n" in text[last : m.start()] or not last))
        last = m.end()
    return out


def joined(text: str) -> str:
    """Words broken at line ends made whole."""
    return re.sub(r"(?<=\w)-[^\S\n]*\n\s*(?=[a-zà-ÿ\d])", lambda m: "-" if text[m.end()].isdigit() else "", text)


def clean_piece(value: str) -> str:
    """Heading marks dropped, blanks collapsed, outer marks trimmed."""
    return " ".join(w for w in value.split() if w.strip("#")).lstrip("#").strip(" \t\r\n,.;:-'\"")


def normal_name(words: list[str]) -> str:
    text = clean_piece(" ".join(words))
    return re.sub(r"(?<=[^\W\d_])- (?=[^\W\d_])", "", text).strip(" ,.;:-").upper()


def valid_name(name: str) -> bool:
    keys = [folded(w) for w in name.split()]
    return 2 <= len(keys) <= 14 and not any(c.isdigit() for c in name) and keys[0] not in NOT_FIRST and not NOT_EARLY & set(keys[:3])


def plausible_signer(name: str) -> bool:
    keys = [folded(w) for w in name.split()]
    return bool(keys) and not NOT_SIGNER & set(keys) and not any(c.isdigit() for c in name) and sum(len(k) == 1 for k in keys) < 3


_MARK = ",;:.|"
_INITIAL = re.compile(r"[^\W\d_]\.")


def _capital(w: Word) -> bool:
    bare = w.text.lstrip("\"“'(#*")
    return bare[:1].isupper() and len(w.key) > 0 and not any(c.isdigit() for c in w.key) and w.key not in RANKS


def name_runs(words: list[Word]) -> list[tuple[int, int]]:
    """Maximal runs of capitalised words with connectors between them: (first, last + 1)."""
    out, i = [], 0
    while i < len(words):
        if not _capital(words[i]) or words[i].key in CONNECTORS:
            i += 1
            continue
        j = i + 1
        while j < len(words) and (words[j - 1].text[-1] not in _MARK or _INITIAL.fullmatch(words[j - 1].text)) and (_capital(words[j]) or words[j].key in CONNECTORS and j + 1 < len(words) and words[j].text[-1] not in _MARK):
            j += 1
        while j > i + 1 and words[j - 1].key in CONNECTORS:
            j -= 1
        out.append((i, j))
        i = j
    return out


def _split_people(words: list[Word], a: int, b: int) -> list[tuple[int, int]]:
    """A run cut at each ``e`` that joins two names of at least two words."""
    at = [i for i in range(a + 2, b - 2) if words[i].text in ("e", "E")]
    for i in at:
        left, right = normal_name([w.text for w in words[a:i]]), normal_name([w.text for w in words[i + 1 : b]])
        if words[i].text == "e" and valid_name(left) and valid_name(right) and len(left.split()) >= 2 and words[i + 1].text.isupper() == words[a].text.isupper() and b - i > 2 and i - a > 1 and words[a].text.isupper():
            return [(a, i), *_split_people(words, i + 1, b)]
    return [(a, b)]


def _another(words: list[Word], a: int) -> bool:
    """Whether what precedes a run makes its person another than the act's."""
    back = [w.key for w in words[max(0, a - 5) : a]]
    return bool(_ANOTHER & set(back[-4:])) and bool({"DE", "DA", "DO", "A", "AO"} & set(back[-3:]))


def person_names(words: list[Word], profile: Profile, strict: bool = True) -> list[tuple[str, int]]:
    """People of an act's body and the word after each name: anchored ones (a lead-in before, an identifier or mark behind), or the first of any."""
    found: list[tuple[str, int]] = []
    runs = [r for a, b in name_runs(words) for r in _split_people(words, a, b)]
    for a, b in runs:
        while a < b and words[a].key in _PEOPLE | RANKS:
            a += 1
        name = normal_name([w.text for w in words[a:b]])
        if not valid_name(name) or folded(name.split()[0]) in profile.not_people or _another(words, a) or words[a].key in _HEADS | _ROLE_HEADS:
            continue
        before = words[a - 1] if a else None
        behind = words[b] if b < len(words) else None
        opened = before is None or before.text[-1] in ",;:" or before.key in _PEOPLE | {"E", "O", "A", "NOMEADO", "NOMEADA"} | RANKS
        closed = behind is None or words[b - 1].text[-1] in ",;:" or behind.key in _BEHIND | {"DO", "DA", "E"} or behind.text[:1].isdigit()
        if not strict or opened and closed:
            found.append((name, b))
            if not strict:
                break
    # One act names one person; others count if joined to the first by "e", or in profiles with tables of people.
    first = found[:1]
    for name, b in found[1:]:
        a = b - len(name.split())
        if profile.many or a and words[a - 1].key == "E" and words[a - 1].text == "e":
            first.append((name, b))
    return list(dict.fromkeys(first))


_TABLE = (
    re.compile(r"(?:^|\n|:)[ \t]*(?:\d+[.)][ \t]*)?(?P<name>[^\W\d_][^\d\n|]{4,90}?)[ \t]+(?P<id>\d[\d./-]{4,})[ \t]*(?=\n|$|[ \t]\d{1,3}[ \t]+[^\W\d_])"),
    re.compile(r"\b\d{3,}[ \t]*\|?[ \t]*(?P<name>[^\W\d_][^\d\n|,;]{4,90}?)[ \t]*(?=\||\n|$|[ \t](?:Assessor|Assistente|Agente|Analista|Coordenador|Diretor|Gerente|Professor|T[eé]cnico|Especialista|Auxiliar|Auditor|Fiscal|Cargo)\b)"),
)
_LIST = re.compile(r"(?:[-–—][ \t]*|\b(?:titular|suplente)[ \t]*:[ \t]*)(?P<name>[^\W\d_][^\d\n,;]{4,90}?)(?=[ \t]*[,;]|[ \t]+(?:para exercer|por recondu|em substitui))", re.I)


def _row_name(text: str) -> str:
    words = words_of(text)
    runs = name_runs(words)
    if len(runs) != 1 or any(not w.key in RANKS | _PEOPLE and not w.text.isdigit() for w in words[: runs[0][0]]):
        return ""
    name = normal_name([w.text for w in words[runs[0][0] : runs[0][1]]])
    return name if valid_name(name) and not {"CARGO", "NOME", "LOTACAO", "ORGAO"} & {folded(w) for w in name.split()} else ""


def table_names(body: str, profile: Profile) -> list[str]:
    """Names in rows of tables (by their number) and in lists (by their dash or label)."""
    patterns = (*(_TABLE if profile.tables or profile.many else ()), *((_LIST,) if profile.lists else ()))
    names = [n for p in patterns for m in p.finditer(body) if (n := _row_name(m.group("name")))]
    return list(dict.fromkeys(names))


def _until(words: list[Word], i: int, marks: str, limit: int, stops: Callable[[int], bool] = lambda k: False) -> int:
    """The word after the phrase that begins at ``i``: up to a mark, a stop or ``limit`` characters."""
    j = i
    while j < len(words) and words[j].end - words[i].start <= limit and not (j > i and stops(j)):
        j += 1
        if words[j - 1].text[-1] in marks and not re.fullmatch(r"(?:n|art|dr|sr|prof)\.?", words[j - 1].text, re.I):
            break
    return j


def _agency_at(words: list[Word], i: int) -> bool:
    return words[i].key in {"DA", "DO", "DAS", "DOS", "NA", "NO", "PELA", "PELO", "A", "JUNTO"} and i + 1 < len(words) and words[i + 1].key in _HEADS and words[i + 1].text[:1].isupper()


def role_of(words: list[Word]) -> str:
    """The role phrase, from its lead-in to a mark or the agency."""
    for i, w in enumerate(words):
        if w.key in _ROLE_HEADS and i and words[i - 1].key in {"O", "DO", "NO", "DE", "DA", "DAS", "A", "EXERCER", "EM", "NA", "PARA", "OCUPAR"}:
            a = i - 1
            while a and words[a - 1].key in {"PARA", "EXERCER", "OCUPAR", "OCUPANTE"} and a > i - 4:
                a -= 1
            return clean_piece(" ".join(x.text for x in words[a : _until(words, i, ",.;", 240, lambda k: _agency_at(words, k))]))
    return ""


def agency_of(words: list[Word]) -> str:
    for i in range(len(words) - 1):
        if _agency_at(words, i):
            return clean_piece(" ".join(x.text for x in words[i : _until(words, i, ",.;", 200)]))
    return ""


def identifier_of(words: list[Word]) -> str:
    """The number behind ``matrícula``, ``ID funcional``, ``MASP`` or ``identificação funcional``."""
    for i, w in enumerate(words):
        if w.key in {"MATRICULA", "MASP"} or w.key in {"ID", "IDENTIFICACAO", "N"} and i + 1 < len(words) and words[i + 1].key.startswith("FUNCIONAL"):
            for x in words[i + 1 : i + 4]:
                if any(c.isdigit() for c in x.text):
                    return x.text.strip(" .,-;:|)")
    return ""


def role_category(words: list[Word], i: int) -> tuple[str, str, int] | None:
    """Category, label and words of the signing role that begins at ``i``."""
    keys = [_FEMALE.get(k, k) for w in words[i : i + 4] for k in w.key.replace("-", " ").split()]
    for code, label, role in SIGNERS:
        parts = role.split()
        if keys[: len(parts)] == parts:
            n, seen = 0, 0
            while seen < len(parts):
                seen += len(words[i + n].key.replace("-", " ").split())
                n += 1
            return code, label, n
    return None


def signer_of(words: list[Word]) -> tuple[str, str, str]:
    """Name, role and category of the last name that a signing role follows."""
    for a, b in reversed(name_runs(words)):
        for i in range(b, a + 1, -1):  # the role may be part of the capitalised run
            found = role_category(words, i) if i < len(words) else None
            if found:
                name = normal_name([w.text for w in words[a:i]])
                if valid_name(name) and plausible_signer(name):
                    return name, found[1], found[0]
    return "", "", ""


# ---------------------------------------------------------------- headings


def _front_page(text: str, agency: str) -> str:
    """The name that stands behind or below an agency on the front page."""
    front = text[:25_000]
    for m in re.finditer(re.escape(agency).replace(r"\ ", r"\s+"), front, re.I):
        for piece in re.split(r"\n|\||[.;]", front[m.end() : m.end() + 180])[:5]:
            words = words_of(re.sub(r"\([^)]*\)", " ", piece))
            for a, b in name_runs(words)[:1]:
                name = normal_name([w.text for w in words[a:b]])
                if a == 0 and valid_name(name) and plausible_signer(name) and words[a].key not in _HEADS:
                    return title_case(name)
    return ""


def title_case(name: str) -> str:
    return " ".join(w.lower() if folded(w) in CONNECTORS else w.capitalize() for w in name.split())


def _agency_heading(words: list[Word], i: int) -> str:
    """The last heading ``SECRETARIA DE ESTADO ...`` within 500 characters before word ``i``, else the phrase behind it."""
    def phrase(k: int) -> str:
        stop = {"ATO", "ATOS", "APOSTILA", "APOSTILAS", "DESPACHO", "DESPACHOS", "SUBSECRETARIA", "SUPERINTENDENCIA", "DIRETORIA", "FUNDACAO", "INSTITUTO", "USANDO", "USO", "SUAS", "NO"}
        j = _until(words, k, ",.;#", 120, lambda x: words[x].key in stop or words[x].line and words[x].text.startswith("#"))
        return clean_piece(" ".join(w.text for w in words[k:j])).upper()

    for k in range(i - 1, -1, -1):
        if words[i].start - words[k].start > 500:
            break
        if words[k].key == "SECRETARIA" and [w.key for w in words[k + 1 : k + 3]] == ["DE", "ESTADO"] and (words[k].text.startswith("#") or k and words[k - 1].text.startswith("#")):
            return phrase(k)
    for k in range(i, min(i + 6, len(words) - 3)):
        if words[k].key == "SECRETARIO" and [w.key for w in words[k + 1 : k + 3]] == ["DE", "ESTADO"] and words[k + 3].key in {"DA", "DE", "DO"}:
            return "SECRETARIA DE ESTADO " + phrase(k + 3)
    return ""


def signer_markers(text: str, words: list[Word]) -> list[tuple[int, str, str, str]]:
    """(place, name, role, category) of headings such as ``ATOS DO GOVERNADOR`` or ``O SECRETÁRIO DE ESTADO``, in order."""
    out, names = [], {}
    for i, w in enumerate(words):
        if w.key in {"ATO", "ATOS", "APOSTILAS", "DESPACHOS"} and i + 1 < len(words) and words[i + 1].key in {"DO", "DA"}:
            at = i + 2
        elif w.key in {"O", "A"} and w.text in {"O", "A"}:
            at = i + 1
        else:
            continue
        found = role_category(words, at) if at < len(words) else None
        if not found or found[0] not in {"1", "2", "4", "5"} and w.key in {"O", "A"}:
            continue
        code, label, n = found
        if code == "1" and _acting(words, at + n):
            code, label = "2", "Governador em exercicio"
        name, role = "", label
        if code in {"4", "5"}:
            agency = _agency_heading(words, i)
            if agency:
                names.setdefault(agency, _front_page(text, agency))
                name, role = names[agency], f"{label} - {title_case(agency)}"
        out.append((w.start, name, role, code))
    return out


def _acting(words: list[Word], i: int) -> bool:
    keys = [w.key for w in words[i : i + 9]]
    return any(keys[k : k + 2] == ["EM", "EXERCICIO"] and keys[:k] in ([], ["DO", "ESTADO"]) or keys[k : k + 2] == ["EM", "EXERCICIO"] and keys[:3] == ["DO", "ESTADO", "DO"] for k in range(len(keys)))


def marker_at(markers: list[tuple[int, str, str, str]], places: list[int], at: int) -> tuple[str, str, str]:
    """The latest marker at or before ``at``; before the first one only a governor's counts."""
    k = bisect_right(places, at)
    if k:
        return markers[k - 1][1:]
    return markers[0][1:] if markers and markers[0][2].startswith("Governador") else ("", "", "")


def municipality_markers(words: list[Word]) -> list[tuple[int, str]]:
    """(place, name) of headings ``MUNICÍPIO DE X`` before a town hall, chamber or kind of act."""
    ends = {"PREFEITURA", "CAMARA", "ATOS", "DECRETO", "LEI", "PORTARIA", "EDITAL", "AVISO"}
    out = []
    for i, w in enumerate(words):
        if w.key == "MUNICIPIO" and i + 2 < len(words) and words[i + 1].key == "DE":
            j = next((k for k in range(i + 3, min(i + 10, len(words))) if words[k].key in ends), None)
            if j and all(not any(c.isdigit() for c in x.text) for x in words[i + 2 : j]):
                out.append((w.start, title_case(clean_piece(" ".join(x.text for x in words[i + 2 : j])))))
    return out


# ---------------------------------------------------------------- acts


def act_windows(words: list[Word], profile: Profile) -> Iterator[tuple[int, int]]:
    """(verb, word after the body) of each act: the body reaches the next verb, a stop or the end within ``cap`` characters."""
    verbs, one = set(profile.verbs), {s for s in profile.stops if " " not in s}
    more = [s.split() for s in profile.stops if " " in s]
    ends = [i for i, w in enumerate(words) if w.key in verbs or w.key in one or any([x.key for x in words[i : i + len(s)]] == s for s in more if w.key == s[0])]
    for n, i in enumerate(ends):
        if words[i].key not in verbs or profile.guard and not {"RESOLVE", "ART"} & {w.key for w in words[max(0, i - 3) : i]}:
            continue
        j = ends[n + 1] if n + 1 < len(ends) else len(words)
        if j > i + 1 and (words[j - 1].end - words[i].end) <= profile.cap:
            yield i, j


def acts_of(text: str, state: str) -> list[dict[str, str]]:
    """Acts of one document, the first of each (verb, name, start of excerpt)."""
    if state not in STATES:
        raise ValueError(f"unknown state {state!r}")
    if state == "MG":
        return mg_acts(text)
    profile = PROFILES.get(state, Profile())
    text = joined(text)
    words = words_of(text)
    markers = signer_markers(text, words)
    places = [m[0] for m in markers]
    towns = municipality_markers(words)
    town_places = [t[0] for t in towns]
    out, seen = [], set()
    for i, j in act_windows(words, profile):
        body = words[i + 1 : j]
        excerpt = " ".join(w.text for w in words[i:j]).strip(" ,.;:-")
        names = _name_before(words, i) if profile.before else []
        rows = table_names(text[words[i].end : words[j - 1].end], profile)
        if profile.many and rows:
            names = rows
        names = names or [n for n, _ in person_names(body, profile)] or rows or [n for n, _ in person_names(body, profile, strict=False)]
        if not names:
            continue
        signer, role, code = signer_of(body)
        if not role:
            signer, role, code = marker_at(markers, places, words[i].start)
        town = bisect_right(town_places, words[i].start)
        for name in names:
            key = (words[i].key, name, excerpt[:180])
            if key not in seen:
                seen.add(key)
                out.append({
                    "tipo_ato": "nomeacao" if words[i].key.startswith("NOME") else "exoneracao", "nome": name, "id_funcional": identifier_of(body), "cargo": role_of(body), "orgao": agency_of(body),
                    "assinante": signer, "cargo_assinante": role, "categoria_assinante": code, "municipio": towns[town - 1][1] if town else "", "trecho": excerpt[:900]})
    return out


def _name_before(words: list[Word], i: int) -> list[str]:
    """The last ``NOME: X`` of a form within 2,600 characters before the verb."""
    for k in range(i - 1, -1, -1):
        if words[i].start - words[k].start > 2600:
            break
        if words[k].key == "NOME" and words[k].text.endswith(":"):
            runs = name_runs(words[k + 1 : k + 14])
            cut = next((x for x in range(k + 1, min(k + 14, len(words))) if words[x].key in {"IDENTIFICACAO", "RG", "CPF"}), None)
            if runs and cut:
                name = normal_name([w.text for w in words[k + 1 : cut]])
                return [name] if valid_name(name) else []
    return []


# ---------------------------------------------------------------- Minas Gerais: names by their numbers

_MG_STOPS = frozenset("DESIGNA DESIGNAR DISPENSA DISPENSAR AUTORIZA REMOVE RETIFICA RESOLVE TORNAR".split())
_MG_ROLES = frozenset("ANALISTA TECNICO ASSISTENTE PROFESSOR ESPECIALISTA GESTOR AUXILIAR AGENTE MEDICO ENFERMEIRO".split())
_MG_NUMBER = re.compile(r"\d(?:[. \t]*\d){5,8}(?:\s*[-/]\s*\d)?")


def _mg_number(text: str) -> str:
    m = _MG_NUMBER.search(text)
    return re.sub(r"[.\s]", "", m.group()) if m else ""


def _mg_windows(text: str, words: list[Word]) -> Iterator[tuple[int, int]]:
    verbs = {"NOMEIA", "NOMEAR", "EXONERA", "EXONERAR"}
    for i, w in enumerate(words):
        if w.key not in verbs:
            continue
        j = i + 1
        while j < len(words) and words[j].key not in verbs | _MG_STOPS and words[j].end - w.end <= 6000:
            gap = text[words[j - 1].end : words[j].start]
            if "\n" in gap and (words[j - 1].text.endswith(".") or gap.count("\n") > 1):
                break
            j += 1
        yield i, j


def _mg_agency(words: list[Word]) -> str:
    """Agency behind a preposition (``da``, ``do(a)``, ``pela(o)``), up to a role, a date clause or a mark."""
    for i in range(len(words) - 1):
        lead = re.sub(r"\([ao]\)$", "", words[i].text.lower())
        head = words[i + 1].key
        if lead in {"da", "do", "na", "no", "pela", "pelo"} and (head in _HEADS) and words[i + 1].text[:1].isupper():
            if [w.key for w in words[i + 1 : i + 7]] == ["POLICIA", "CIVIL", "E", "DE", "ATIVIDADES", "GOVERNAMENTAIS"]:
                continue
            def ends(k: int) -> bool:
                nxt = [w.key for w in words[k : k + 2]]
                return words[k - 1].text.endswith(",") and (nxt in (["A", "PARTIR"], ["A", "CONTAR"], ["NOS", "TERMOS"]) or words[k].key in {"FICANDO", "PARA"}) or words[k].key in {"MASP", "MATRICULA"} or (
                    words[k].key in {"DO", "NO", "DA", "PARA"} and k + 1 < len(words) and words[k + 1].key in {"CARGO", "FUNCAO", "O", "A", "EXERCER"})
            return clean_piece(" ".join(w.text for w in words[i + 1 : _until(words, i + 1, ".;", 200, ends)]))
    return ""


def _mg_role(words: list[Word]) -> tuple[str, int, int]:
    """Role phrase from ``cargo`` or ``função`` on, without the agency behind it."""
    for i, w in enumerate(words):
        if w.key in {"CARGO", "FUNCAO"} and i and words[i - 1].key in {"O", "A", "DO", "NO", "DA", "NA", "EXERCER"}:
            def agency(k: int) -> bool:
                lead = re.sub(r"\([ao]\)$", "", words[k].text.lower())
                rest = [x.key for x in words[k + 1 : k + 7]]
                return lead in {"da", "do", "das", "dos", "na", "no", "pela", "pelo"} and bool(rest) and rest[0] in _HEADS and rest != ["POLICIA", "CIVIL", "E", "DE", "ATIVIDADES", "GOVERNAMENTAIS"]
            j = _until(words, i, ",.;", 240, agency)
            return clean_piece(" ".join(x.text for x in words[i:j])), i - 1, j
    return "", 0, 0


def mg_acts(text: str) -> list[dict[str, str]]:
    """Acts of the gazette of Minas Gerais, the first of each (kind, name, number, role, agency).

    Names stand before their number (``MASP``), in rows of tables with role and number, or in lists of
    councils. Section headings end the signer and agency that went before.
    """
    text = joined(text)
    words = words_of(text)
    windows = list(_mg_windows(text, words))
    inside = lambda at: any(words[i].start <= at < words[j - 1].end for i, j in windows)
    markers: list[tuple[int, str, str, str, str | None]] = []
    for m in re.finditer(r"(?m)^[ \t#]*(\S.*)$", text):
        line = words_of(m.group(1))
        keys = [w.key for w in line]
        found = role_category(line, 0)
        if found and found[2] < len(line) and (":" in line[found[2] - 1].text or line[found[2]].text == ":"):
            name = normal_name([w.text for w in line[found[2] :] if w.text != ":"])
            if valid_name(name):
                markers.append((m.start(), name, found[1], found[0], None))
            continue
        if inside(m.start()):
            continue
        joined_keys = " ".join(keys)
        if joined_keys.endswith(("POLICIA CIVIL DE MINAS GERAIS", "POLICIA CIVIL DO ESTADO DE MINAS GERAIS")) and (keys[0] == "POLICIA" or keys[0] == "ATOS"):
            at = keys.index("POLICIA")
            markers.append((m.start(), "", "", "", clean_piece(" ".join(w.text for w in line[at:]))))
        elif keys[:3] == ["SECRETARIA", "DE", "ESTADO"] or keys[:2] in (["POLICIA", "CIVIL"], ["POLICIA", "MILITAR"], ["INSTITUTO", "DE"]) or keys[0] in {"CONTROLADORIA-GERAL", "ADVOCACIA-GERAL", "FUNDACAO", "UNIVERSIDADE"}:
            markers.append((m.start(), "", "", "", ""))
    signers = [m for m in markers if m[1] or m[4] is not None]
    sections = [m for m in markers if m[4] is not None]
    signer_at, section_at = [m[0] for m in signers], [m[0] for m in sections]
    out, seen = [], set()
    for i, j in windows:
        body, kind = words[i + 1 : j], "nomeacao" if words[i].key.startswith("NOME") else "exoneracao"
        raw = text[words[i].end : words[j - 1].end]
        for name, number, role, rest in _mg_people(raw, body):
            agency = ""
            if not role and rest is not None:
                role, a, b = _mg_role(rest)
                agency = (_mg_agency(rest[:a]) or _mg_agency(rest[b:])) if role else _mg_agency(rest)
                council = next((k for k, w in enumerate(body[:-1]) if w.key in {"COMO", "PARA"} and body[k + 1].key.startswith(("MEMBRO", "CONSELHEIR"))), None)
                if not role and council is not None:
                    role = clean_piece(" ".join(w.text for w in body[council + 1 : _until(body, council + 1, ",:;", 180)]))
            if not agency:
                back = [w for w in words[max(0, i - 90) : i] if words[i].start - w.start <= 450]
                cut = max((k + 1 for k, w in enumerate(back) if w.text[-1] in ".;"), default=0)
                agency = _mg_agency(back[cut:])
            if not agency:
                k = bisect_right(section_at, words[i].start)
                agency = (sections[k - 1][4] or "") if k else ""
            key = (kind, name, number, role, agency)
            if key in seen:
                continue
            seen.add(key)
            k = bisect_right(signer_at, words[i].start)
            _, signer, signer_role, code, _ = signers[k - 1] if k else (0, "", "", "", None)
            out.append({"tipo_ato": kind, "nome": name, "id_funcional": number, "cargo": role, "orgao": agency, "assinante": signer, "cargo_assinante": signer_role, "categoria_assinante": code, "municipio": "",
                        "trecho": clean_piece(" ".join(w.text for w in words[i:j]))[:900]})
    return out


def _mg_people(raw: str, body: list[Word]) -> list[tuple[str, str, str, list[Word] | None]]:
    """(name, number, role of a table row, words behind the name) of the people in a body."""
    found = []
    marks = [k for k, w in enumerate(body) if w.key in {"MASP", "MATRICULA"}]
    for n, k in enumerate(marks):
        a = k
        while a and (_capital(body[a - 1]) or body[a - 1].key in CONNECTORS) and not (a < k and body[a - 1].text[-1] in ",;:|"):
            a -= 1
        while a < k and body[a].key in CONNECTORS:
            a += 1
        name, number = normal_name([w.text for w in body[a:k]]), _mg_number(" ".join(w.text for w in body[k + 1 : k + 6]))
        if valid_name(name) and number:
            found.append((name, number, "", body[k + 1 : marks[n + 1] if n + 1 < len(marks) else len(body)]))
    if not found:
        for a, b in name_runs(body):
            name = normal_name([w.text for w in body[a:b]])
            behind = [w.key for w in body[b : b + 2]]
            if valid_name(name) and (a == 0 or body[a - 1].text[-1] in ",;:") and (behind[:1] == ["PARA"] or behind in (["DO", "CARGO"], ["DA", "FUNCAO"])):
                found.append((name, "", "", body[b:]))
    for line in re.split(r"\n(?=\s*\|?\s*[A-ZÀ-Ý])", raw):
        flat = " ".join(line.replace("|", " ").split())
        number = _mg_number(flat)
        words = words_of(flat)
        role = next((k for k, w in enumerate(words) if k > 1 and w.key in _MG_ROLES), None)
        if number and role and all(_capital(w) or w.key in CONNECTORS for w in words[:role]) and not any(w.key in {"MASP", "MATRICULA"} for w in words):
            name = normal_name([w.text for w in words[:role]])
            title = clean_piece(re.split(r"\d", " ".join(w.text for w in words[role:]), maxsplit=1)[0])
            if valid_name(name) and title:
                found.append((name, number, title, None))
        m = re.match(r"([^,\n]{5,90}),\s*(?:em substitui|titular\b|suplente\b)", flat, re.I)
        if m and not any(name == f[0] for f in found for name in [normal_name(m.group(1).split())]):
            name = normal_name(m.group(1).split())
            if valid_name(name) and all(w[:1].isupper() or folded(w) in CONNECTORS for w in m.group(1).split()):
                found.append((name, "", "", []))
    return found


# ---------------------------------------------------------------- table function

EXTRACTED = ("doc_id bigint, estado string, posicao int, tipo_ato string, nome string, id_funcional string, cargo string, orgao string, assinante string, cargo_assinante string, "
             "categoria_assinante string, municipio string, trecho string")


def extract_acts(docs: DataFrame) -> DataFrame:
    """Acts of every document (``doc_id, estado, text``). Null and empty texts and unknown states give none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in EXTRACTED.split(", ")]
        for b in batches:
            rows = [{"doc_id": d, "estado": e, "posicao": i, **a} for d, e, t in zip(b["doc_id"], b["estado"], b["text"], strict=True) for i, a in enumerate(acts_of(t, e))]
            yield pd.DataFrame(rows, columns=columns)

    ship_code(docs.sparkSession)
    rows = docs.where(F.col("estado").isin(*STATES) & (F.trim("text") != "")).select("doc_id", "estado", "text")
    return spread(rows).mapInPandas(run, EXTRACTED)


def needs_ocr(text, pages):
    """Whether converted text is too short for its pages: under 500 characters or 80 a page."""
    bare = F.regexp_replace(text, r"(?s)<!--.*?-->|\s+", "")
    return F.length(bare) < F.greatest(F.lit(500), pages * 80)
