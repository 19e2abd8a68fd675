"""Edition listings of gazette portals, from saved answers: one parser for each family of portals.

Every parser turns one answer into (date, section, url). Addresses are built below the option ``base``, so a
portal may move. The data source reads a folder ``<UF>/<yyyy-mm-dd>*.json`` or ``.html``; the date in a
file's name is the day that was asked for. A live portal needs only another way to get the answers
(``fetch``, with retries).
"""

from __future__ import annotations

import base64
import html
import json
import os
import re
import unicodedata
from collections.abc import Callable, Iterator
from datetime import date, datetime, timedelta
from urllib.parse import quote_plus, urlencode

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Row = tuple[str, str, str]
Parser = Callable[[object, date, str, str], Iterator[Row]]
PARSERS: dict[str, Parser] = {}


def register_source(*states: str) -> Callable[[Parser], Parser]:
    """Make a parser the one of ``states``."""

    def keep(parser: Parser) -> Parser:
        PARSERS.update(dict.fromkeys(states, parser))
        return parser

    return keep


def day_of(text: object) -> date | None:
    """A date written d/m/Y or Y-m-d (with or without a time)."""
    for form, size in (("%d/%m/%Y", 10), ("%Y-%m-%d", 10)):
        try:
            return datetime.strptime(str(text or "").strip()[:size], form).date()
        except ValueError:
            continue
    return None


#: Month names of long dates (fixed values).
MONTHS = "janeiro fevereiro marco abril maio junho julho agosto setembro outubro novembro dezembro".split()


def long_day(text: str | None) -> date | None:
    """A date written ``3 de maio de 2026`` (ordinals and accents allowed), anywhere in ``text``."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", text or "") if not unicodedata.combining(c)).lower()
    m = re.search(r"(\d{1,2})\s*[o.]?\s+de\s+([a-z]+)\s+de\s+(\d{4})", plain)
    try:
        return date(int(m.group(3)), MONTHS.index(m.group(2)) + 1, int(m.group(1))) if m else None
    except ValueError:
        return None


def _extra(value: object) -> bool:
    return value not in (None, "", 0, "0", False)


@register_source("AM", "AP", "GO")
def catalogue(answer, day, state, base):
    if isinstance(answer, dict) and not answer.get("erro"):
        for e in answer.get("itens") or []:
            if e.get("id"):
                more = str(e.get("suplemento_nome") or "").strip() or ("Suplemento" if _extra(e.get("suplemento")) else "")
                yield day.isoformat(), f"Diario Oficial {state} {e.get('numero') or e['id']}" + (f" - {more}" if more else ""), f"{base}/portal/edicoes/download/{e['id']}"


@register_source("ES")
def labelled(answer, day, state, base):
    """Labels that occur again get their number."""
    seen: dict[str, int] = {}
    for e in (answer or {}).get("itens") or []:
        if e.get("id"):
            label = str(e.get("tipo_edicao_nome") or "Diario Oficial do Espirito Santo").strip() + (" - Suplemento" if _extra(e.get("suplemento")) else "")
            seen[label] = seen.get(label, 0) + 1
            yield day.isoformat(), label if seen[label] == 1 else f"{label} - Edicao {seen[label]}", f"{base}/portal/edicoes/download/{e['id']}"


@register_source("SE")
def unnumbered(answer, day, state, base):
    for e in (answer or {}).get("itens") or []:
        if e.get("id"):
            yield day.isoformat(), f"Diario Oficial {state}" + (" Suplemento" if _extra(e.get("suplemento")) else ""), f"{base}/portal/edicoes/download/{e['id']}"


@register_source("PR")
def whole_catalogue(answer, day, state, base):
    """All days in one answer."""
    for e in (answer or {}).get("itens") or []:
        at = day_of(e.get("data"))
        if at and e.get("id"):
            kind = str(e.get("tipo_edicao_nome") or "Diario Oficial PR").strip()
            yield at.isoformat(), f"{kind} {state} {e.get('numero') or e['id']}" + (" - Suplemento" if _extra(e.get("suplemento")) else ""), f"{base}/portal/edicoes/download/{e['id']}"


@register_source("AL")
def monthly(answer, day, state, base):
    for e in (answer or {}).get("editions") or []:
        at = day_of(e.get("publication_date"))
        if at and e.get("id"):
            yield at.isoformat(), f"Diario Oficial {state} {e.get('number') or e['id']}" + (" - Suplemento" if e.get("suplement") else ""), f"{base}/apinova/api/editions/downloadPdf/{e['id']}"


@register_source("MA")
def sections(answer, day, state, base):
    for name, group in ((answer or {}).get("cadernos") or {}).items():
        for e in group.get("listCadernos") or []:
            at, file = day_of(e.get("dataPublicacao")), str(e.get("arquivo") or "").strip()
            if at and file:
                number = " ".join(str(e.get("volume") or "").split()) + " ".join(str(e.get("numero") or "").split())
                yield at.isoformat(), f"Diario Oficial {state} {name} {number}".strip(), f"{base}/download.php?arq={quote_plus(file)}"


@register_source("MT")
def one_kind(answer, day, state, base):
    """Other gazettes of the same portal are left out; the first of an id counts."""
    seen = set()
    for e in answer if isinstance(answer, list) else []:
        if isinstance(e, dict) and e.get("id") and str(e.get("diario") or "").strip().casefold() == "diário oficial" and str(e["id"]) not in seen:
            seen.add(str(e["id"]))
            more = str(e.get("suplemento") or "").strip()
            yield day.isoformat(), f"Diario Oficial {state} {e.get('numero') or e['id']}" + (f" - {more}" if more else ""), f"{base}/edicoes/{e['id']}/download?formato=pdf"


@register_source("MS")
def paged(answer, day, state, base):
    """Pages of one day (a list of answers or one); suspended editions and other days are left out."""
    seen = set()
    for page in answer if isinstance(answer, list) else [answer or {}]:
        for e in page.get("diario") or []:
            if isinstance(e, dict) and e.get("id") and e.get("suspenso") is not True and day_of(e.get("dataPublicacao")) == day and str(e["id"]) not in seen:
                seen.add(str(e["id"]))
                more = str(e.get("numeroSuplemento") or "").strip()
                url = str(e.get("caminhoArquivo") or "").strip() or f"{base}/{day:%Y/%m/%d}/{str(e.get('nomeArquivo') or '').strip()}.pdf"
                yield day.isoformat(), f"Diario Oficial {state} {e.get('numero') or e['id']}" + (f" - Suplemento {more}" if more else ""), url


def plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()


@register_source("MG")
def chosen_sections(answer, day, state, base):
    """The executive's section and extra editions; labels that occur twice get their id."""
    data = (answer or {}).get("dados", answer) or {}
    if str(data.get("dataPublicacao") or "")[:10] != day.isoformat():
        return
    own = [(str(e["id"]), str(e.get("descricao") or "").strip()) for e in data.get("cadernos") or [] if e.get("id") and ("executivo" in plain(str(e.get("descricao") or "")) or plain(str(e.get("descricao") or "")).startswith("edicao extra"))]
    labels = [label for _, label in own]
    for k, (number, label) in enumerate(own):
        if number not in [n for n, _ in own[:k]]:
            yield day.isoformat(), f"{label} - Caderno {number}" if labels.count(label) > 1 else label, f"{base}/Caderno/ObterArquivoCadernoPorId?id={number}"


@register_source("PI")
def rows_of_links(answer, day, state, base):
    for row in (answer or {}).get("data") or []:
        if len(row) > 2 and day_of(row[2]) == day:
            m = re.search(r"href\s*=\s*[\"']([^\"']+)", html.unescape(str(row[0])).replace("\\/", "/"), re.I)
            if m:
                link = m.group(1)
                url = f"{base}/{link[3:]}" if link.startswith("../") else base + link if link.startswith("/") else f"{base}/doe/{link}"
                yield day.isoformat(), f"Diario Oficial {state} {str(row[1]).strip()}", url


@register_source("PE")
def main_and_extra(answer, day, state, base):
    """Answers for the day after (main edition) and the day itself (extra edition); each names the day it is of."""
    for key, label, at, mark in (("principal", "", day + timedelta(days=1), ""), ("extra", " Extra", day, "E")):
        if day_of(((answer or {}).get(key) or {}).get("date")) == day:
            yield day.isoformat(), f"Diario Oficial {state}{label}", f"{base}/1/arquivos/resumoDiario/{at:%d-%m-%Y}/{at:%d-%m-%Y}{mark}.pdf"


@register_source("RS")
def single(answer, day, state, base):
    if (answer or {}).get("id"):
        yield day.isoformat(), f"Diario Oficial {state} {answer.get('numeroEdicao') or answer['id']}", f"{base}/public/diarios/download/{answer['id']}/pdf"


@register_source("CE")
def publications(answer, day, state, base):
    for p in (answer or {}).get("publications") or []:
        if day_of(p.get("date") or p.get("circulation_date")) == day:
            for f in p.get("publication_files") or []:
                if f.get("download_url"):
                    yield day.isoformat(), f"Diario Oficial {state} Caderno {f.get('journal_number') or f.get('original_filename') or ''}".strip(), str(f["download_url"]).strip()


@register_source("DF")
def literal_in_page(answer, day, state, base):
    """A JSON literal of links by group inside the page."""
    m = re.search(r"(?:links|edicoes)\w*\s*=\s*(\{.*?\})\s*;", str(answer or ""), re.I | re.S)
    for group, items in (json.loads(m.group(1)) if m else {}).items():
        for e in items or []:
            folder, _, file = str(e.get("link") or "").partition("&arquivo=")
            if file:
                yield day.isoformat(), f"Diario Oficial {state} {group} {os.path.splitext(os.path.basename(file))[0]}", f"{base}/dodf/jornal/visualizar-pdf?{urlencode({'pasta': folder, 'arquivo': file})}"


@register_source("RR")
def hidden_forms(answer, day, state, base):
    for form in re.findall(r"<form\b.*?</form>", str(answer or ""), re.I | re.S):
        fields = {}
        for tag in re.findall(r"<input\b[^>]*>", form, re.I):
            got = dict(re.findall(r"(\w+)\s*=\s*[\"']([^\"']*)", tag))
            if got.get("name"):
                fields[got["name"]] = html.unescape(got.get("value", ""))
        m = re.search(r"(\d{4})(\d{2})(\d{2})", fields.get("doe", ""))
        if m:
            yield "-".join(m.groups()), f"Diario Oficial {state}", f"{base}/_visualizar-doe/?{urlencode(fields)}"


@register_source("TO")
def table_rows(answer, day, state, base):
    for row in re.findall(r"<tr\b.*?</tr>", str(answer or ""), re.I | re.S):
        m = re.search(r"href\s*=\s*[\"']([^\"']*?(\d+)[^\"'/]*/download[^\"']*|[^\"']*download[^\"']*?(\d+)[^\"']*)", row, re.I)
        if m and f"{day:%d/%m/%Y}" in html.unescape(row):
            url = m.group(1)
            yield day.isoformat(), f"Diario Oficial {state} {m.group(2) or m.group(3)}", url if url.startswith("http") else base + url


@register_source("RJ")
def coded_days(answer, day, state, base):
    """Days of a calendar as base64 in links; the editions of a day have their label as text of the link."""
    for code in re.findall(r"\?data=([A-Za-z0-9+/=]+)", str(answer or "")):
        try:
            at = datetime.strptime(base64.b64decode(code).decode("ascii"), "%Y%m%d").date()
        except ValueError:
            continue
        yield at.isoformat(), "", f"{base}/do_seleciona_edicao.php?data={code}"
    for link, label in re.findall(r"<a\s[^>]*href\s*=\s*[\"']([^\"']*mostra_edicao[^\"']*)[\"'][^>]*>(.*?)</a>", str(answer or ""), re.I | re.S):
        yield day.isoformat(), " ".join(html.unescape(re.sub("<[^>]*>", " ", label)).split()), f"{base}/{html.unescape(link)}"


#: Addresses that follow from the day alone: (section, path below the base). A listing is those that exist.
PREDICTABLE: dict[str, tuple[tuple[str, str], ...]] = {
    "PA": (("Diario Oficial PA", "{d:%Y}/{d:%Y.%m.%d}.DOE.pdf"), ("Diario Oficial PA Extra", "{d:%Y}/{d:%Y.%m.%d}.EXTRA.pdf")),
    "RN": (("Diario Oficial RN", "1{d:%Y-%m-%d}.pdf"), ("Diario Oficial RN Extra", "1{d:%Y-%m-%d}E.pdf")),
    "RO": (("Diario Oficial RO", "{d:%Y/%m}/DOE-{d:%d-%m-%Y}.pdf"),),
}


@register_source(*PREDICTABLE)
def probed(answer, day, state, base):
    """``answer`` is the list of addresses that exist."""
    for section, path in PREDICTABLE[state]:
        url = f"{base}/{path.format(d=day)}"
        if url in (answer or []):
            yield day.isoformat(), section, url


@register_source("SC")
def estimated(answer, day, state, base):
    """``answer`` lists the edition numbers that exist; extra editions have a suffix."""
    for n in sorted({str(x) for x in answer or []}, key=lambda x: (int(re.match(r"\d+", x).group()), x)):
        yield day.isoformat(), f"Diario Oficial {state} {n} - Edicao {'Extra' if '-' in n else 'Ordinaria'}", f"{base}/{day:%Y/%Y%m%d}/Jornal/{n}.pdf"


def estimated_number(day: date, anchor: date, number: int) -> int:
    """Edition number of ``day`` counted in working days from an anchor."""
    sign = 1 if day >= anchor else -1
    days = (anchor + timedelta(days=sign * k) for k in range(1, abs((day - anchor).days) + 1))
    return number + sign * sum(d.weekday() < 5 for d in days)


def retry_seconds(attempt: int, delay: float = 1.0) -> float:
    return min(delay * attempt * 2, 30.0)


def fetch(get: Callable[[str], bytes], urls: list[str], attempts: int = 5, delay: float = 1.0, sleep: Callable[[float], None] = lambda s: None) -> bytes:
    """The first answer of any of ``urls``, tried in turn; between rounds the wait grows by ``retry_seconds``."""
    last: Exception | None = None
    for attempt in range(1, attempts + 1):
        for url in urls:
            try:
                return get(url)
            except Exception as e:  # noqa: BLE001
                last = e
        if attempt < attempts:
            sleep(retry_seconds(attempt, delay))
    raise RuntimeError(f"no answer from {urls[0]}") from last


class _Answer(InputPartition):
    def __init__(self, state: str, file: str):
        self.state, self.file = state, file


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.base = options["path"], options.get("base", "").rstrip("/")

    def partitions(self) -> list[InputPartition]:
        found = [_Answer(os.path.basename(d).upper(), os.path.join(d, f)) for d, _, files in os.walk(self.folder) for f in files if f.endswith((".json", ".html")) and os.path.basename(d).upper() in PARSERS]
        return sorted(found, key=lambda p: p.file) or [_Answer("", "")]

    def read(self, part: InputPartition) -> Iterator[tuple]:
        if part.file:
            day = day_of(os.path.basename(part.file)[:10]) or date(1970, 1, 1)
            with open(part.file, encoding="utf-8") as f:
                answer = json.load(f) if part.file.endswith(".json") else f.read()
            for at, section, url in PARSERS[part.state](answer, day, part.state, self.base):
                yield part.state, date.fromisoformat(at), section, url


class PortalSource(DataSource):
    """``uf, publication_date, section, url`` of saved answers below ``path``, one partition a file."""

    @classmethod
    def name(cls) -> str:
        return "gazette_portal"

    def schema(self) -> str:
        return "uf string, publication_date date, section string, url string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)
