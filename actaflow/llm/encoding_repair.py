"""Problem 7: text decoded with the wrong character encoding.

A test in the JVM sends on only values that hold a character or sequence most Portuguese text doesn't
have. For those, characters are mapped back to the bytes of each legacy encoding, a byte-structure
automaton finds the maximal well-formed multi-byte UTF-8 spans, and only these spans are decoded
(again, while spans remain: text may have been garbled several times).

Single-byte mix-ups have no byte structure. There a word is read in the other code page, if that turns
it into a word of Portuguese letters and there is evidence for the damage: the word can't have been
written so (letters of two scripts, signs between letters, a letter of the wrong case), or the corpus
holds the other reading at least ``RATIO`` times as often. A word that is merely foreign (``Köln``,
``MUÑOZ``) stays as it is and isn't flagged. Lost characters (U+FFFD, ``?`` inside words) are flagged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex as re
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actaflow.runtime import cut, ship_code

LETTERS = "ÀÁÂÃÇÉÊÍÓÔÕÚÜàáâãçéêíóôõúü"
SIGNS = "ªº°§–—“”‘’½¼¾·•…\u00a0"
#: Characters that correct text may hold.
ALLOWED = "".join(map(chr, (9, 10, 12, 13, *range(32, 127), *range(0x300, 0x370), 0xAC, 0xAD))) + LETTERS + SIGNS
#: Sequences of such characters that need a closer look (Java syntax). The lookahead passes over most positions at once.
SEQUENCES = (
    r"(?=[ÃÂ\u00ac\u00ad…?Ç§õéàâ“”\u00a0])(?:[ÃÂ][\u0080-¿–—“”‘’…]|[\u00ac\u00ad](?![\r\n])|…(?=[^\r\n]*[\p{L}\d])"
    r"|\?\p{L}|(?<![\p{L}\p{N})\]”’\"])\?|(?<=\b[nN])\? ?\d|(?<=[A-Z])Ç(?:[OE]|\P{L}|$)|(?<=[nN])§|õ \d|(?<=\p{Lu}{2})[éàâ]|[éàâ]\p{Lu}{2}"
    r"|(?<=\p{L})[“”]\p{L}|(?<=\p{L})\u00a0[\p{Ll} ,.;]|(?<= )\u00a0\p{Ll}|(?<=\b\p{L}{1,3})\? \p{Ll})"
)
#: How many times as often as the written word the corpus must hold its other reading.
RATIO = 2


def suspect(column: Column) -> Column:
    """Whether a value holds a character or sequence that needs a closer look."""
    return (F.translate(column, ALLOWED, "") != "") | column.rlike(SEQUENCES)


#: Characters a decoded span may give; the replacement character tells of a loss.
PLAUSIBLE = frozenset(LETTERS + SIGNS + "\u00ad\ufffd")


def _table(codec: str) -> dict[str, int]:
    """Character to byte of one code page; C1 controls stand for the bytes it leaves undefined."""
    back = {chr(b): b for b in range(0x80, 0xA0)}
    for b in range(0x80, 0x100):
        try:
            back[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            pass
    return back


CODECS = ("cp1252", "mac_roman", "cp850", "cp437")
BYTES = {c: _table(c) for c in CODECS}
#: (written as, read as): single-byte pages in which a word can have been misread.
PAGES = (("cp850", "cp1252"), ("cp1252", "cp1251"), ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp1252", "cp850"))


def _page(written: str, read: str) -> dict[int, str]:
    back, out = _table(read), {}
    for ch, b in back.items():
        try:
            out[ord(ch)] = bytes([b]).decode(written)
        except UnicodeDecodeError:
            pass
    return out


PAGE_MAPS = {p: _page(*p) for p in PAGES}
_MARKS = frozenset("ªº")
#: Signs that some page reads for a letter and that never stand between two letters of sound text.
_STRANGE = frozenset(chr(k) for m in PAGE_MAPS.values() for k, v in m.items() if v in LETTERS + "ªº" and not chr(k).isalpha()) - frozenset("’‘–—…·•°§“”\u00a0\u00ad")


def _need(byte: int) -> tuple[int, int, int]:
    """Continuation bytes after a lead byte, and the range of the first of them (0: no lead)."""
    if 0xC2 <= byte <= 0xDF:
        return 1, 0x80, 0xBF
    if 0xE0 <= byte <= 0xEF:
        return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
    if 0xF0 <= byte <= 0xF4:
        return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
    return 0, 0, 0


def _spans(codec: str) -> re.Pattern:
    """A lead byte's character and a continuation byte's: without such a pair there is no span."""
    lead = "".join(c for c, b in BYTES[codec].items() if 0xC2 <= b <= 0xF4)
    rest = "".join(c for c, b in BYTES[codec].items() if 0x80 <= b <= 0xBF)
    return re.compile(f"[{re.escape(lead)}][{re.escape(rest)}]")


SPANS = {c: _spans(c) for c in CODECS}


def decode_spans(text: str, codec: str) -> tuple[str, int]:
    """Decode the well-formed multi-byte spans of ``text`` under ``codec``; also how many there are.

    The automaton reads lead byte, first continuation (restricted range), further continuations.
    A span that decodes to a character Portuguese text can't have is left alone unless it is an
    intermediate of twice garbled text (a character the same code page can turn back).
    """
    first = SPANS[codec].search(text)
    if not first:
        return text, 0
    back, out, i, n, found = BYTES[codec], [text[: first.start()]], first.start(), len(text), 0
    while i < n:
        ch = text[i]
        lead = back.get(ch, 0) if ch > "\x7f" else 0
        more, low, high = _need(lead) if lead else (0, 0, 0)
        if more and i + more < n and not (text[i + 1] in "\u00ac\u00ad" and text[i + 2 : i + 3] in ("\r", "\n")):
            tail = [back.get(text[i + k], 0) if text[i + k] > "\x7f" else 0 for k in range(1, more + 1)]
            if low <= tail[0] <= high and all(0x80 <= b <= 0xBF for b in tail[1:]):
                got = bytes([lead, *tail]).decode("utf-8")
                if got in PLAUSIBLE or got in back:
                    out.append(got)
                    i += more + 1
                    found += 1
                    continue
        out.append(ch)
        i += 1
    return "".join(out), found


_QUOTE_END = re.compile(r"[ÃÂ][“”‘’–—](?!\w)")
_FOREIGN = re.compile(rf"[^\x00-\x7e{LETTERS}{SIGNS}\u0300-\u036f\u00ad\u00ac]")


def decoded(text: str, name: bool) -> str:
    """``text`` with its multi-byte spans decoded until none is left; every round makes it shorter."""
    while True:
        best, count = text, 0
        for codec in CODECS:
            new, k = decode_spans(text, codec)
            if k > count:
                best, count = new, k
        # One span that ends like a quotation in a text with an open quote is a quotation.
        quotation = count == 1 and not name and _QUOTE_END.search(text) and not _FOREIGN.search(text) and text.count("“") >= text.count("”")
        if not count or quotation:
            return text
        text = best


_WORD = re.compile(r"[^\s\u00a0(),;:/.!?\"\-\[\]{}]+")
_CEDILLA = re.compile(r"[A-ZÀ-Ü]Ç(?:[OE]S?)?$")
#: What stands between words, for counting (RE2 syntax).
_BETWEEN = r"[\s\x{a0}(),;:/.!?\"\-\[\]{}“”‘’]+"
_QUOTE_INSIDE = re.compile(r"(?<=\p{L})[“”](?=\p{Ll})")
_CONNECTORS = frozenset("de da do des das dos e a o em na no nas nos".split())
_LOST = re.compile(r"\ufffd|\?(?=[^\W\d_])|(?<![\w)\]”’\"?])\?|\b[nN]\?(?= ?\d)|\?{2,}(?=\w)|\b[^\W\d_]{1,3}\? (?=[a-zà-ü])")


def _wrong_case(word: str) -> bool:
    """Whether an accented letter has a case its neighbours rule out (``nÆo``, ``PéBLICA``)."""
    for i, c in enumerate(word):
        if c > "\x7f" and c.isalpha() and c not in _MARKS and (c.isupper() or c.islower()):
            a, b = word[i - 1] if i else "", word[i + 1 : i + 2]
            if c.isupper() and a.islower() and not b.isupper():
                return True
            if c.islower() and (a.isupper() and b.isupper() or not a.isalpha() and word[i + 1 : i + 3].isupper() and len(word) > i + 2 or not b.isalpha() and i > 1 and word[i - 2 : i].isupper()):
                return True
    return False


def _two_scripts(word: str) -> bool:
    other = any("\u0370" <= c <= "\u052f" for c in word)
    return other and any(c.isalpha() and c < "\u0250" for c in word)


def impossible(word: str) -> bool:
    """Whether nobody writes a word so, whatever the language."""
    if any("\x80" <= c <= "\x9f" for c in word) or _two_scripts(word) or _wrong_case(word) or word in ("n§", "N§"):
        return True
    return any(c in _STRANGE and (word[i - 1 : i].isalpha() or word[i - 1 : i] in _STRANGE) and (word[i + 1 : i + 2].isalpha() or word[i + 1 : i + 2] in _STRANGE) and i > 0 and i + 1 < len(word)
               for i, c in enumerate(word))


def odd(word: str) -> bool:
    """Whether a word is worth a look in the other pages."""
    return any(c.isalpha() for c in word) and bool(_FOREIGN.search(word) or _CEDILLA.search(word) or _QUOTE_INSIDE.search(word) or impossible(word))


def reading(word: str, page: tuple[str, str], signs: bool = False) -> str | None:
    """What another page makes of a word, if it is of Portuguese letters (or signs) and sound case."""
    new = word.translate(PAGE_MAPS[page])
    if new == word or _FOREIGN.search(new) or impossible(new):
        return None
    return new if signs or all(b.isalpha() or b == "§" for a, b in zip(word, new, strict=True) if a != b) else None


def readings(word: str) -> dict[tuple[str, str], str]:
    return {p: new for p in PAGES if (new := reading(word, p)) is not None}


def _blanks(text: str) -> list[tuple[int, str, str]]:
    """Fixed blanks that may be a letter of another page: place, words around as written and as read.

    White space that varies at random (tabs, double blanks, fixed blanks elsewhere) holds no letters.
    """
    out: list[tuple[int, str, str]] = []
    if "\u00a0" not in text or "\t" in text or "  " in text:
        return out
    for m in re.finditer("\u00a0", text):
        a = b = m.start()
        while a and text[a - 1].isalpha():
            a -= 1
        while b + 1 < len(text) and text[b + 1].isalpha():
            b += 1
        left, right = text[a : m.start()], text[m.start() + 1 : b + 1]
        if not left and not (right and text[a - 1 : a] in (" ", "\n")):
            return []
        if right not in _CONNECTORS and not right[:1].isupper() and (right or text[b + 1 : b + 2] in tuple(" ,.;")):
            out.append((m.start(), text[a : b + 1], left + "á" + right))
    return out


def questions(text: str, name: bool) -> list[tuple[str, str, int, bool]]:
    """What the corpus is asked: word as written, another reading, rank of its page, whether the word is impossible."""
    now = decoded(text, name)
    out = [(w, new, PAGES.index(p), impossible(w)) for w in {m.group() for m in _WORD.finditer(now)} if odd(w) for p, new in readings(w).items()]
    return out + [(a, b, 0, True) for a, b in {x[1:] for x in _blanks(now)}]


def repair(text: str, name: bool = False, answers: dict[str, str] | None = None) -> tuple[str, bool, str]:
    """The restored text, whether characters stay lost, and the way: ``bytes``, ``pagina``, ``perda`` or ``""``.

    ``answers`` holds, for words the corpus knows, the reading to take (the word itself: leave it). A word
    it doesn't know is changed only if it is impossible as written, or foreign in a text with such
    words of the same page. ``name``: the text is a name, in which question marks have no place.
    """
    answers = answers or {}
    now = decoded(text, name)
    way = "bytes" if now != text else ""
    words = [(m.start(), m.end(), m.group()) for m in _WORD.finditer(now)]
    strange = {w: (impossible(w), readings(w)) for _, _, w in words if odd(w)}
    votes = Counter(p for w, (hard, got) in strange.items() if hard or answers.get(w, w) != w for p, new in got.items() if answers.get(w, new) == new)
    page = max(votes, key=lambda p: (votes[p], -PAGES.index(p))) if votes else None
    out, last = [], 0
    blanks = {at: around for at, around, new in _blanks(now) if answers.get(around) == new}
    for a, b, w in words:
        hard, got = strange.get(w, (False, {}))
        new = answers.get(w) if got else None
        if new is None and page and (_FOREIGN.search(w) or _QUOTE_INSIDE.search(w)):
            new = reading(w, page, signs=True)
        if new is None and hard and got:
            new = next(iter(got.values()))
        if new is not None:
            out += [now[last:a], new]
            last = b
    read = "".join(out) + now[last:]
    if blanks:  # readings keep the number of characters, so places stay
        read = "".join("á" if i in blanks else c for i, c in enumerate(read))
    if page == ("cp850", "cp1252"):  # signs of this page that are ordinary signs elsewhere
        read = re.sub(r"(?<=\b[nN])§|(?<=\d)§", "º", read)
        read = re.sub(r"(?<=\s)…(?=\s)", "à", read)
        read = re.sub(r"(?<!\p{L})õ(?= \d)", "§", read)
    if read != now:
        way = way or "pagina"
    lost = (name and "?" in read) or bool(_LOST.search(read)) or any(impossible(m.group()) for m in _WORD.finditer(read) if not m.group().isascii())
    return read, lost, way or ("perda" if lost else "")


def _ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = [(k, *q) for k, v, c in zip(b["chave"], b["valor"], b["campo"], strict=True) for q in questions(v, c == "nome")]
        yield pd.DataFrame(rows, columns=["chave", "escrita", "lida", "ordem", "dura"])


def _answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        known = [{x["escrita"]: x["lida"] for x in a} if a is not None else {} for a in b["respostas"]]
        got = [repair(v, c == "nome", a) for v, c, a in zip(b["valor"], b["campo"], known, strict=True)]
        b["restaurado"], b["perdido"], b["via"] = [g[0] for g in got], [g[1] for g in got], [g[2] for g in got]
        yield b.loc[b["perdido"] | (b["restaurado"] != b["valor"]), ["id", "campo", "valor", "restaurado", "perdido", "via"]]


def _accented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        words = pc.split_pattern_regex(pc.utf8_upper(b.column(0)), _BETWEEN).flatten()
        words = words.filter(pc.not_equal(pc.binary_length(words), pc.utf8_length(words)))
        counts = words.filter(pc.match_substring_regex(words, rf"^[A-Z{LETTERS}]+$")).value_counts()
        yield pa.RecordBatch.from_arrays([counts.field("values").cast(pa.string()), counts.field("counts").cast(pa.int64())], ["palavra", "n"])


def accented_words(values: DataFrame) -> DataFrame:
    """``palavra, n``: how often ``valor`` holds each word with Portuguese letters outside ASCII, in upper case."""
    return values.where("valor is not null").select("valor").mapInArrow(_accented, "palavra string, n bigint").groupBy("palavra").agg(F.sum("n").alias("n"))


def restored(values: DataFrame) -> DataFrame:
    """``id, campo, valor, restaurado, perdido, via`` of the garbled among ``values`` (``id, campo, valor``)."""
    ship_code(values.sparkSession)
    hit = values.where(suspect(F.col("valor")) | ((F.col("campo") == "nome") & F.col("valor").contains("?")))
    hit = cut(hit.select("id", "campo", "valor", F.xxhash64("campo", "valor").alias("chave")), "suspects")
    asked = cut(hit.mapInPandas(_ask, "chave bigint, escrita string, lida string, ordem int, dura boolean"), "questions")
    pairs = asked.groupBy("escrita", "lida").agg(F.min("ordem").alias("ordem"), F.max("dura").alias("dura"), F.count("*").alias("ne"))
    counts = accented_words(values).withColumnsRenamed({"palavra": "_l", "n": "nl"})
    pairs = pairs.withColumn("_l", F.upper("lida")).join(counts, "_l", "left").na.fill(0, ["nl"])
    best = pairs.groupBy("escrita").agg(F.max_by(F.struct("lida", "nl", "ne", "dura"), F.struct("nl", -F.col("ordem"), "lida")).alias("m")).select("escrita", "m.*")
    sure = (F.col("nl") > 0) & (F.col("dura") | (F.col("nl") >= RATIO * F.col("ne")))
    known = best.select("escrita", F.when(sure, F.col("lida")).when(~F.col("dura") & (F.col("ne") > 1) & F.col("escrita").rlike(r"^\p{L}+$"), F.col("escrita")).alias("lida")).where("lida is not null")
    answers = asked.select("chave", "escrita").distinct().join(known, "escrita").groupBy("chave").agg(F.collect_list(F.struct("escrita", "lida")).alias("respostas"))
    id_type = dict(hit.dtypes)["id"]
    return hit.join(answers, "chave", "left").select("id", "campo", "valor", "respostas").mapInPandas(
        _answer, f"id {id_type}, campo string, valor string, restaurado string, perdido boolean, via string")


def garbled_values(df: DataFrame, columns: tuple[str, ...] = ("trecho", "nome"), id_col: str = "linha_csv") -> DataFrame:
    """``id, campo, valor, restaurado, perdido, via`` for each value with garbled or lost characters.

    Null and empty values are never garbled; repeated ids give a row each; an empty table gives no
    rows; very long texts are read whole. ``perdido`` tells that the original can't be known fully.
    ``via`` is ``bytes`` if the automaton decoded spans, ``pagina`` if only other pages explain the
    damage, ``perda`` if nothing could be restored.
    """
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return restored(df.selectExpr(f"`{id_col}` AS id", f"stack({len(columns)}, {pairs}) AS (campo, valor)"))
