"""Problem 1: traces of scanned pages, and repair into continuous text.

Lines (and spans inside lines that are shaped like page heads) are labelled ``header``, ``body``,
``break`` or ``noise`` (a body line with marks or words of the scanner) by a linear-chain conditional
model: layout features score each label, transitions score neighbours, Viterbi finds the best
sequence. The labels alone decide: an excerpt bears a trace if one of its lines isn't plain body.
Repair drops headers, joins the line after a break without the hyphen and mends noise.

The model is fitted (conditional likelihood) on at most ``TRAIN_ROWS`` excerpts of the table
itself, once as they are and once with planted damage, so the labels of the planted lines are known.
Templates of planted heads are general; features see the shape of a line, not its words.

Words are features too. The corpus' own vocabulary tells which word may be misread (undoing look-alike
glyphs, 0/o, rn/m, cl/d, c/e, gives a word that is more frequent) or run together (it splits into two
such words), and how many times more frequent the right word is; the model weighs that ratio. The
vocabulary is joined, not collected; only the ``COMMON`` most frequent words (a fixed number) go to the
workers, to keep ordinary words out of the shuffle.
"""

from __future__ import annotations

import functools
import itertools
import random
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex as re
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actaflow.llm.encoding_repair import LETTERS
from actaflow.runtime import cut, ship_code, spread

#: Frequent words that are sent to the workers.
COMMON = 4096
#: How much more often the right word must occur than its damaged form to be a candidate; the model judges the rest.
RATIO = 4
#: Most excerpts the model is fitted on, classes of lengths (in lines) they are padded to, steps and rate of the fit, and the penalty on weights.
TRAIN_ROWS, LENGTHS, ROUNDS, RATE, PENALTY = 2000, (2, 5, 12, 32), 120, 0.15, 2e-5
STATES = ("header", "body", "break", "noise")

# ---------------------------------------------------------------- lines and their features

_BETWEEN_MARKS = r"[ *'~_|·.°]*"
_DAY = r"(?:SEGUNDA|TERÇA|QUARTA|QUINTA|SEXTA)(?:-FEIRA)?|SÁBADO|DOMINGO"
_CODE = r"(?=[0-9a-f]*[a-f])(?=[0-9a-f]*[0-9])[0-9a-f]{8,}"
_PROOF = r"(?:[Cc]onferid|[Aa]ssinad|[Aa]utenticad|[Vv]erificad|[Vv]alidad|[Dd]ocument)\p{Ll}*"
#: Spans inside a line that are shaped like a page reference, a head with a weekday, or a seal with a code. They are pieces like lines of their own.
_SPAN = (
    rf"(?<!\|\s*)\b[Pp](?:[áa]g(?:ina)?\b\.?|\.){_BETWEEN_MARKS}\d+\b(?:{_BETWEEN_MARKS}(?:/|\bde\b){_BETWEEN_MARKS}\d+\b)?"
    rf"|\d{{1,4}}{_BETWEEN_MARKS}\p{{Lu}}[\p{{Lu}} ]{{1,30}},{_BETWEEN_MARKS}(?:{_DAY})\b(?:{_BETWEEN_MARKS}[-–—]{_BETWEEN_MARKS}\p{{Lu}}{{3,}}(?:{_BETWEEN_MARKS}\p{{Lu}}{{3,}})?)?"
    rf"|\b{_PROOF}(?:[ ,*'~_|·.°]+\p{{Ll}}+){{0,4}}?{_BETWEEN_MARKS}[ ,:]+{_BETWEEN_MARKS}{_CODE}\b")
_PIECES = re.compile(rf"(\r?\n|\f)|({_SPAN})")
#: A mark alone between blanks; a pipe before a label (``WORD:``) separates fields.
_STRAY = re.compile(r"(?:(?<= )|^)(?:[*'~_·]|\.·|°\.|\|(?!\s*\p{L}+\s*[:=–—])(?!\s*\p{L}+\s+-\s))(?=\s|$) ?")
_INLINE_HYPHEN = re.compile(r"(?<=\p{L})[-¬­] (?:[*'~_|·.°]+ )?(?=\p{L})")
_SPACED = re.compile(r"(?<![\w.])(?:\p{Lu} ){3,}\p{Lu}(?!\w)|(?<![\w.])\p{L} (?:\p{Ll} ){2,}\p{Ll}(?!\w)")
_GLYPHS = re.compile(
    r"[@|]\p{Ll}|(?<=\p{Ll})[@|]|(?<=\p{Lu})[@|]\p{Lu}|(?<=\p{L})[05]\p{L}|(?<=\p{L}{2})[0-9]\p{Ll}|(?<![\p{L}\p{N}*.])[0-9]\p{Ll}{3}")
_CEDILLA = re.compile(r"(?<=\p{Ll}c),(?=\p{Ll})|(?<=\p{Lu}C),(?=\p{Lu})|(?<=\p{L}\p{Ll}c),(?=\p{L})")
_HYPHEN_END = re.compile(r"\p{L}[-¬­]\s*$")

_BLANK = r"\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_LETTER = r"[A-Za-z\x{80}-\x{10ffff}]"
#: Eight characters of a code, with a letter beside a digit.
_MIXED = "|".join(rf"[0-9a-f]{{{k}}}(?:[0-9][a-f]|[a-f][0-9])[0-9a-f]{{{6 - k}}}" for k in range(7))
#: What a text must hold for an expression below to match in it (RE2 syntax, one linear pass over a batch each). Each lets
#: through more than its expression matches, so that what isn't searched for can't be there; every text is labelled.
GUARDS = {
    "span": rf"[Pp](?:[áa]g(?:ina)?\.?|\.)[ *'~_|·.°]*[^A-Za-z ]|FEIRA|SEGUNDA|TERÇA|QUARTA|QUINTA|SEXTA|SÁBADO|DOMINGO|{_MIXED}", "gaps": "   ", "spaced": rf"(?:^|[^A-Za-z0-9_.])(?:{_LETTER} ){{3}}{_LETTER}",
    "glyph": rf"[@|]{_LETTER}|{_LETTER}[@|]|{_LETTER}[05]{_LETTER}|{_LETTER}{{2}}[0-9]{_LETTER}|[0-9]{_LETTER}{{3}}",
    "cedilla": rf"[cC],{_LETTER}", "stray": rf"(?:^|[{_BLANK}])(?:[*'~_·|]|\.·|°\.)", "hyphen": rf"[-\x{{ac}}\x{{ad}}](?:[{_BLANK}]|$)"}
_MAY = {g: 1 << i for i, g in enumerate((*GUARDS, "fields"))}
_SPAN_MAY, _GAPS_MAY, _SPACED_MAY, _GLYPH_MAY, _CEDILLA_MAY, _STRAY_MAY, _HYPHEN_MAY, _FIELDS_MAY = _MAY.values()
ALL_MAY = sum(_MAY.values())
_FIELD_ENDS = rf"{_LETTER}(?:[{_BLANK}]*[:=–—]|[{_BLANK}]+-[{_BLANK}]|[{_BLANK}]{{2}})"
_FIELDS = re.compile(r"(?:^|[|;\n])\s*\p{L}{5,}(?:\s*[:=–—]|\s+-\s|\s{2})")
_LABEL, _LABEL_UPPER = re.compile(r"\W*\p{L}{4,}(?:\s*[:=–—]|\s+-\s)"), re.compile(r"\W*\p{Lu}{4,}(?:\s*[:=–—]|\s+-\s)")
_LOWER_WORD, _ENDED, _GAPS, _NUMBER, _DASHED = re.compile(r"\b\p{Ll}{2,}\b"), re.compile(r"[.!?;:”]\W*$"), re.compile(r"\S {3,}\S"), re.compile(r"\W*\d{1,4}\W*"), re.compile(r"[-–—]\W*\d{1,4}\W*[-–—]")
_TITLE, _PAGE, _TOTAL, _ROMAN = re.compile(r"\p{Lu}\p{L}+ (?:\p{L}+ ){0,2}\p{Lu}"), re.compile(r"\b(?:p|p[áa]g|p[áa]gina|folha|fls?)\b\W*\d", re.I), re.compile(r"\d\W*/\W*\d"), re.compile(r"\b[IVXLC]{2,}\b")
_LINE_ENDS, _ASCII_DIGIT, _MANY_LOWER = re.compile(r"(\r?\n|\f)"), re.compile("[0-9]"), re.compile(r"(?:[a-z][^a-z]*+){21}")
_DAY_RE, _CODE_RE, _AFTER, _OF = re.compile(_DAY), re.compile(rf"\b{_CODE}\b"), re.compile(r"\b(?:[àa]s?|[dn]as?|pelas?|cada|segundo|conforme)$", re.I), re.compile(r"(?:d[aeo]s?\b|,)", re.I)


def guards(texts: pa.Array) -> np.ndarray:
    """For each text the bits (``_MAY``) of what may be found in it."""
    out = np.zeros(len(texts), np.int64)
    for g, pattern in GUARDS.items():
        out |= np.where(np.asarray(pc.fill_null(pc.match_substring_regex(texts, pattern), False)), _MAY[g], 0)
    out |= np.where(np.asarray(pc.fill_null(pc.count_substring_regex(texts, _FIELD_ENDS), 0)) > 2, _FIELDS_MAY, 0)
    return np.where((out & _SPAN_MAY) > 0, out | _STRAY_MAY | _HYPHEN_MAY, out)  # lines also begin and end at a span


FEATURES = (
    "any", "span", "form_feed", "hash", "number_only", "dashed_number", "gaps", "upper", "title_number", "pipes_number", "page_word", "page_total", "roman", "day", "code", "capital_start",
    "after_preposition", "before_of", "short", "long", "lower_words", "ends_sentence", "interrupts", "previous_open", "next_lower", "next_upper", "hyphen_end", "hyphen_lower", "hyphen_upper", "first", "last", "loose",
    "digits", "stray", "stray_loose", "inline_hyphen", "spaced", "glyph", "cedilla", "label_start", "fields", "stray_fields")
_BIT = {f: 1 << i for i, f in enumerate(FEATURES)}
#: What stands for the line around a word that is judged alone.
_PLAIN_LINE = sum(_BIT[f] for f in ("any", "first", "last", "lower_words", "long"))


def pieces(text: str, may: int = ALL_MAY) -> list[tuple[int, int, str, bool]]:
    """(start, end, what separates it from the piece before, whether it is a span inside a line)."""
    out, last, sep = [], 0, ""
    spans = may & _SPAN_MAY
    for m in (_PIECES if spans else _LINE_ENDS).finditer(text) if spans or "\n" in text or "\f" in text else ():
        if text[last : m.start()].strip():
            out.append((last, m.start(), sep, False))
            sep = ""
        if spans and m.group(2):
            out.append((m.start(), m.end(), sep or " ", True))
            sep = " "
        else:
            sep = "\f" if "\f" in (sep, m.group(1)) else m.group(1)
        last = m.end()
    if text[last:].strip():
        out.append((last, len(text), sep, False))
    return out


def features(text: str, parts: list[tuple[int, int, str, bool]] | None = None, may: int = ALL_MAY) -> list[int]:
    """One bit mask of layout features (``FEATURES``) for each piece; what ``may`` (``guards``) rules out isn't searched for."""
    parts, out = pieces(text, may) if parts is None else parts, []
    # White space that varies at random, or a line for every word or two, makes line ends meaningless.
    loose = "\t" in text or "\u00a0" in text or (len(parts) > 5 and text.count(" ") < 2 * len(parts))
    fields = bool(may & _FIELDS_MAY) and len(_FIELDS.findall(text)) > 2  # a list of labelled fields
    fixed = not loose and not fields
    capitals = [fixed and _upper(text[a : min(b, a + 200)]) for a, b, _, _ in parts]
    opened = False  # whether the piece before has no final mark
    for i, (a, b, sep, span) in enumerate(parts):
        raw = text[a:b]
        line = raw.strip()
        right = text[parts[i + 1][0] : parts[i + 1][1]].lstrip() if i + 1 < len(parts) else ""
        digit, brief = bool(_ASCII_DIGIT.search(line)) or any(map(str.isdigit, line)), len(line) < 80
        labelled = bool((_LABEL if fields else _LABEL_UPPER).match(line))
        few = (brief or " " in line) and sum(1 for _ in itertools.islice(_LOWER_WORD.finditer(line if brief else line[:400]), 4)) < 4
        hyphen, ended = bool(may & _HYPHEN_MAY) and bool(_HYPHEN_END.search(raw[-8:])), bool(_ENDED.search(line[-8:]))
        stray = bool(may & _STRAY_MAY) and any(m.strip() != "|" or not fields for m in _STRAY.findall(line))
        lower, upper = right[:1].islower(), right[:1].isupper()
        got = [
            "any", span and "span", sep == "\f" and "form_feed", line[:1] == "#" and "hash", digit and not loose and _NUMBER.fullmatch(line) and "number_only", digit and _DASHED.fullmatch(line) and "dashed_number",
            may & _GAPS_MAY and fixed and _GAPS.search(line) and "gaps", not span and not labelled and capitals[i] and not (i and capitals[i - 1] or i + 1 < len(parts) and capitals[i + 1]) and "upper",
            opened and lower and not fields and "interrupts", opened and not fields and "previous_open", lower and "next_lower", upper and "next_upper", hyphen and "hyphen_end", hyphen and lower and "hyphen_lower", hyphen and upper and "hyphen_upper",
            i == 0 and "first", i + 1 == len(parts) and "last", loose and "loose", digit and "digits", ended and "ends_sentence", not few and "lower_words", len(line) > 90 and "long", not loose and len(line) < 30 and "short",
            stray and fixed and "stray", stray and loose and "stray_loose", stray and fields and not loose and "stray_fields", may & _HYPHEN_MAY and _INLINE_HYPHEN.search(line) and "inline_hyphen", may & _SPACED_MAY and _SPACED.search(line) and "spaced",
            may & _GLYPH_MAY and _GLYPHS.search(line) and "glyph", may & _CEDILLA_MAY and _CEDILLA.search(line) and "cedilla", labelled and "label_start", fields and "fields",
        ]
        if brief:
            got += [
                digit and few and fixed and not labelled and _TITLE.search(line) and "title_number", digit and not loose and not labelled and line.count("|") + line.count("–") >= 2 and "pipes_number", digit and _PAGE.search(line) and "page_word",
                not loose and not labelled and _ROMAN.search(line) and "roman", may & _SPAN_MAY and _DAY_RE.search(line) and "day", may & _SPAN_MAY and _CODE_RE.search(line) and "code"]
        if span:
            left = text[parts[i - 1][0] : parts[i - 1][1]].rstrip() if i else ""
            got += [_TOTAL.search(line) and "page_total", line[:1].isupper() and "capital_start", _AFTER.search(left[-12:]) and "after_preposition", _OF.match(right) and "before_of"]
        out.append(sum(_BIT[f] for f in got if f))
        opened = not ended
    return out


def _upper(line: str) -> bool:
    """Whether nearly all letters of ``line``, of at most 200 characters, are capitals."""
    if _MANY_LOWER.search(line):
        return False
    letters = list(filter(str.isalpha, line))
    return len(letters) > 3 and sum(map(str.isupper, letters)) > 0.9 * len(letters)


def names_of(mask: int, words: list[tuple[str, int]]) -> list[str]:
    """Feature names of a piece; ``words`` are its doubtful words, ``(kind, log2 of the ratio)``."""
    out = [f for f in FEATURES if mask & _BIT[f]]
    for kind in ("misread", "merged", "merged_short"):
        levels = [n for k, n in words if k == kind]
        if levels:
            out += [f"{kind}{n}" for n in range(2, min(max(levels), 9) + 1)]
    return out


# ---------------------------------------------------------------- the model


class Labeller:
    """Linear-chain model: weights of features and of steps, one for each state or pair of states."""

    def __init__(self) -> None:
        self.weight: dict[str, list[float]] = {}
        self.step = [[0.0] * len(STATES) for _ in STATES]

    def path(self, rows: list[list[str]]) -> list[int]:
        """The best label sequence (Viterbi), as places in ``STATES``."""
        n, zero = range(len(STATES)), [0.0] * len(STATES)
        score: list[float] = []
        back: list[list[int]] = []
        for feats in rows:
            here = [sum(x) for x in zip(zero, *[self.weight.get(f, zero) for f in feats], strict=True)]
            if score:
                frm = [max(n, key=lambda p: score[p] + self.step[p][s]) for s in n]  # noqa: B023
                here = [here[s] + score[frm[s]] + self.step[frm[s]][s] for s in n]
                back.append(frm)
            score = here
        out = [max(n, key=lambda s: score[s])] if rows else []
        for frm in reversed(back):
            out.append(frm[out[-1]])
        return out[::-1]

    def best(self, rows: list[list[str]]) -> list[str]:
        return [STATES[s] for s in self.path(rows)]

    def fit(self, data: list[tuple[list[list[str]], list[str]]]) -> Labeller:
        """Maximum likelihood with a small penalty on weights (``PENALTY``), by Adam on the whole data; nothing is random.

        Sequences are padded within classes of like length; longer ones than the last class don't train.
        """
        names = sorted({f for rows, _ in data for feats in rows for f in feats})
        at, k = {f: i for i, f in enumerate(names)}, len(STATES)
        groups = []
        for low, size in zip((0, *LENGTHS), LENGTHS, strict=False):
            own = [(rows, gold) for rows, gold in data if low < len(rows) <= size]
            if own:
                x, y, there = np.zeros((len(own), size, len(names))), np.zeros((len(own), size, k)), np.zeros((len(own), size))
                for n, (rows, gold) in enumerate(own):
                    there[n, : len(rows)] = 1
                    for t, (feats, s) in enumerate(zip(rows, gold, strict=True)):
                        x[n, t, [at[f] for f in feats]] = 1
                        y[n, t, STATES.index(s)] = 1
                groups.append((x, y, there))
        w, step = np.zeros((len(names), k)), np.zeros((k, k))
        first, second, total = [np.zeros_like(w), np.zeros_like(step)], [np.zeros_like(w), np.zeros_like(step)], max(len(data), 1)
        for n in range(1, ROUNDS + 1):
            grads = [-PENALTY * w, -PENALTY * step]
            for x, y, there in groups:
                node, pair = _marginals(x @ w, step, there)
                grads[0] += np.einsum("ntf,ntk->fk", x, (y - node) * there[:, :, None], optimize=True) / total
                grads[1] += (np.einsum("nta,ntb->ab", y[:, :-1] * there[:, 1:, None], y[:, 1:], optimize=True) - pair) / total
            for value, g, m, v in zip((w, step), grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                value += RATE * (m / (1 - 0.9**n)) / (np.sqrt(v / (1 - 0.99**n)) + 1e-8)
        self.weight, self.step = {f: w[i].tolist() for f, i in at.items()}, step.tolist()
        return self


def _marginals(emit: np.ndarray, step: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of states by place, and expected numbers of steps, by the forward-backward recursion."""
    n, size, k = emit.shape
    ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
    ahead[:, 0] = emit[:, 0]
    for t in range(1, size):
        ahead[:, t] = np.where(there[:, t, None] > 0, _logsum(ahead[:, t - 1, :, None] + step, 1) + emit[:, t], ahead[:, t - 1])
    for t in range(size - 2, -1, -1):
        behind[:, t] = np.where(there[:, t + 1, None] > 0, _logsum(step + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2), 0.0)
    whole = _logsum(ahead[:, -1], 1)
    node = np.exp(ahead + behind - whole[:, None, None])
    pair = np.zeros((k, k))
    for t in range(1, size):
        p = np.exp(ahead[:, t - 1, :, None] + step + (emit[:, t] + behind[:, t])[:, None, :] - whole[:, None, None])
        pair += (p * there[:, t, None, None]).sum(axis=0)
    return node, pair


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis=axis)) + top.squeeze(axis)


# ---------------------------------------------------------------- planted damage

_TITLES = ("DIÁRIO OFICIAL", "JORNAL OFICIAL", "BOLETIM DO ESTADO", "FOLHA DO GOVERNO", "IMPRENSA DO ESTADO")
_SECTIONS = ("ATOS DO PODER", "PARTE I", "CADERNO UM", "SEÇÃO DE PESSOAL", "PODER EXECUTIVO")
_PLACES = ("BRASÍLIA", "RECIFE", "PORTO NOVO", "CURITIBA", "SERRA")
#: Glyph confusions of scanners (fixed values).
CONFUSED = (("a", "@"), ("i", "|"), ("o", "0"), ("s", "5"), ("l", "1"), ("e", "c"), ("m", "rn"), ("d", "cl"), ("u", "ii"), ("g", "9"), ("ç", "c,"), ("ã", "à"), ("A", "4"), ("O", "0"), ("S", "5"), ("B", "8"), ("E", "F"), ("I", "l"))


def page_head(rng: random.Random) -> tuple[str, bool]:
    """A line as pages have it at head or foot, and whether it may also stand inside a line."""
    n, m, days = rng.randint(1, 400), rng.randint(100, 999999), ("SEGUNDA", "TERÇA", "QUARTA", "QUINTA", "SEXTA")
    title, section = rng.choice(_TITLES), rng.choice(_SECTIONS)
    kind = rng.randrange(11)
    roman = "".join(rng.choice("XVI") for _ in range(rng.randint(2, 4)))
    code = "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(8, 12)))
    return [
        (str(n), False), (f"- {n} -", False), (f"# Página {n}", False), (f"{n}   {title.title()}", False), (f"{title} – {section} Nº {m}", False), (f"ANO {roman} | Nº {m} | p. {n}", False),
        (f"Fl. {n}        {section.title()}        Nº {m}", False), (f"{title}  |  {m}  |  {n}", False), (rng.choice((f"Pág. {n}/{n + 9}", f"Página {n} de {n + 30}", f"P. {n}/{n + 5}")), True), (f"{n} {rng.choice(_PLACES)}, {rng.choice(days)}-FEIRA – {title}", True),
        (rng.choice(("Assinado digitalmente, código {}", "Documento autenticado com a chave {}", "Verificado em sistema próprio, código {}")).format(code), True),
    ][kind]


def plant(text: str, rng: random.Random, counts: dict[str, int]) -> tuple[str, list[str], dict[str, tuple[str, int]]]:
    """``text`` with one to four kinds of damage, the label of each of its pieces, and its doubtful words.

    Every character carries a tag (body, header, noise, hyphen of a break), from which the labels follow.
    """
    words = re.split(r"(\s+)", text)
    tags = ["b"] * len(words)
    places = [i for i in range(2, len(words) - 2, 2) if words[i]]
    doubtful: dict[str, tuple[str, int]] = {}
    if len(places) < 6:
        return text, ["body"] * len(pieces(text)), {}
    for kind in rng.sample(("head", "break", "stray", "glyph", "space", "merge", "hyphen"), rng.randint(1, 4)):
        for i in rng.sample(places, min(rng.choice((1, 1, 2, 3, 5, 8)) if kind != "head" else rng.choice((1, 1, 2)), len(places))):
            w = words[i]
            if tags[i] != "b":
                continue
            plain = w.strip(".,;:()").lower()
            if kind == "head":
                line, inside = page_head(rng)
                before = " " if inside and rng.random() < 0.7 else rng.choice(("\n", "\n", "\n", "\f"))
                words[i], tags[i] = f"{w}{before}\1{line}\2", "x"
                words[i + 1] = " " if before == " " else "\n"
            elif kind == "break" and len(w) > 4 and w.isalpha():
                k = rng.randint(2, len(w) - 2)
                words[i], tags[i] = w[:k] + "\3" + rng.choice(("-", "-", "-", "¬", "­")) + "\4" + rng.choice(("\n", "\n", "\r\n", "\n\n")) + w[k:], "x"
            elif kind == "hyphen" and len(w) > 4 and w.isalpha():
                k = rng.randint(2, len(w) - 2)
                words[i], tags[i] = f"{w[:k]}\5- \6{w[k:]}", "x"
            elif kind == "stray":
                words[i], tags[i] = f"{w} \5{rng.choice(('*', chr(39), '~', '_', '·', '|', '.·', '°.'))}\6", "x"
            elif kind == "glyph" and len(w) > 3:
                fits = [p for p in CONFUSED if p[0] in w[:-1]]
                if fits:
                    a, b = rng.choice(fits)
                    words[i], tags[i] = "\5" + w.replace(a, b, 1) + "\6", "x"
                    if plain in counts:
                        doubtful[w.replace(a, b, 1).strip(".,;:()").lower()] = ("misread", int(np.log2(max(counts[plain], 1))))
            elif kind == "space" and len(w) > 4 and w.isalpha():
                words[i], tags[i] = "\5" + " ".join(w) + "\6", "x"
            elif kind == "merge" and w.isalpha() and words[i + 2].isalpha() and tags[i + 2] == "b":
                low = min(counts.get(x.lower(), 0) for x in (w, words[i + 2]))
                if low:
                    doubtful[(w + words[i + 2]).lower()] = ("merged_short" if max(len(w), len(words[i + 2])) <= 3 else "merged", int(np.log2(low)))
                    words[i], words[i + 1], words[i + 2], tags[i + 2] = f"\5{w}{words[i + 2]}\6", "", "", "x"
    out, tag, now = [], [], "b"
    for c in "".join(words):
        if c in "\1\2\3\4\5\6":
            now = {"\1": "h", "\3": "k", "\5": "n"}.get(c, "b")
        else:
            out.append(c)
            tag.append(now)
    made, labels = "".join(out), []
    for a, b, _, _ in pieces(made):
        inside = [t for t, c in zip(tag[a:b], out[a:b], strict=True) if not c.isspace()]
        labels.append("header" if 2 * inside.count("h") > len(inside) else "break" if inside[-1:] == ["k"] else "noise" if "n" in inside or "h" in inside else "body")
    return made, labels, doubtful


def words_in(text: str, doubtful: dict[str, tuple[str, int]]) -> list[list[tuple[str, int]]]:
    """For each piece of ``text`` the evidence of its doubtful words."""
    if not doubtful:
        return [[] for _ in pieces(text)]
    return [[doubtful[w] for w in set(_split(text[a:b])) if w in doubtful] for a, b, _, _ in pieces(text)]


def _split(text: str) -> list[str]:
    return [w for w in _WORD_END.split(text.lower().replace("(", "").replace(")", "")) if w]


def fitted(acts: DataFrame, findings: DataFrame, vocabulary: DataFrame) -> Labeller:
    """The labeller, fitted on at most ``TRAIN_ROWS`` excerpts of ``acts`` as they are and with planted damage."""
    sample = acts.where("trim(trecho) <> ''").select("linha_csv", "trecho").orderBy(F.xxhash64("linha_csv", "trecho"), "linha_csv").limit(TRAIN_ROWS)
    rows = sample.collect()  # at most TRAIN_ROWS
    ids = acts.sparkSession.createDataFrame([(r.linha_csv,) for r in rows], f"linha_csv {dict(acts.dtypes)['linha_csv']}").distinct()
    doubtful: dict = defaultdict(dict)
    for r in findings.join(F.broadcast(ids), "linha_csv").collect():  # doubtful words of those rows
        doubtful[r.linha_csv][r.palavra] = (r.tipo, r.grau)
    used = sorted({w for r in rows for w in _split(r.trecho)})
    known = acts.sparkSession.createDataFrame([(w,) for w in used], "palavra string")
    counts = {r.palavra: r.n for r in vocabulary.join(F.broadcast(known), "palavra").collect()}  # words of those rows
    rng, plain, damaged = random.Random(7), [], []
    for r in rows:
        base = features(r.trecho)
        plain.append(([names_of(m, w) for m, w in zip(base, words_in(r.trecho, doubtful[r.linha_csv]), strict=True)], ["body"] * len(base)))
        made, labels, seen = plant(r.trecho, rng, counts)
        damaged.append(([names_of(m, w) for m, w in zip(features(made), words_in(made, seen | doubtful[r.linha_csv]), strict=True)], labels))
    first = Labeller().fit(plain + damaged)
    # Excerpts in which the first model finds traces aren't clean: they go, with what was planted on them.
    clean = [i for i, (feats, _) in enumerate(plain) if all(x == "body" for x in first.best(feats))]
    return Labeller().fit([plain[i] for i in clean] + [damaged[i] for i in clean])


# ---------------------------------------------------------------- words

#: What stands between words; parentheses vanish, so that ``(a)`` stays part of its word.
BETWEEN = " \t\n\r\f !\"#$%&'*+,-./:;<=>[\\]^_`{}~“”‘’–—…·•"
_BETWEEN_CLASS = "[" + "".join("\\" + c if c in "\\[]^-" else f"\\x{{{ord(c):x}}}" for c in BETWEEN) + "]+"
_WORD_END = re.compile("[" + re.escape(BETWEEN) + "]+")
_PLAIN = rf"^[a-z{LETTERS.lower()}0-9@|]+$"
_GLYPH = r"[0-9@|]"


def _word_lists(texts: pa.Array) -> pa.Array:
    return pc.split_pattern_regex(pc.replace_substring_regex(pc.utf8_lower(texts), "[()]", ""), _BETWEEN_CLASS)


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts = _word_lists(b.column(0)).flatten().value_counts()
        yield pa.RecordBatch.from_arrays([counts.field("values").cast(pa.string()), counts.field("counts").cast(pa.int64())], ["palavra", "n"])


def vocabulary_of(acts: DataFrame) -> DataFrame:
    """``palavra, n``: lower-case words of all excerpts. Signs and foreign characters stay inside words, so garbled ones never look sound."""
    texts = spread(acts.where("trim(trecho) <> ''").select("trecho"))
    return texts.mapInArrow(_vocabulary, "palavra string, n bigint").where("palavra <> ''").groupBy("palavra").agg(F.sum("n").alias("n"))


def glyph_folds(column: Column) -> Column:
    """Shapes of a word with glyphs that scanners confuse made one; 9 may stand for g or o."""
    for pair, one in (("rn", "m"), ("cl", "d"), ("ii", "u"), ("vv", "w")):
        column = F.replace(column, F.lit(pair), F.lit(one))
    shape = F.translate(column, "01|l5@4863cfà", "oiiisaabbeeeã")
    return F.array_distinct(F.array(F.translate(shape, "9", "g"), F.translate(shape, "9", "o")))


def damaged_words(counts: DataFrame) -> DataFrame:
    """``palavra, certa, tipo, grau``: words of the vocabulary that may be misread or run together; ``grau`` is log2 of the ratio of counts."""
    words = counts.where(F.col("palavra").rlike(_PLAIN) & F.col("palavra").rlike(r"\p{L}") & ~F.col("palavra").rlike(r"^\p{L}{1,4}\d+\p{L}?$|^\d+\p{L}{1,2}$"))
    words = words.where(F.length("palavra") >= 2)
    often = words.where((F.col("n") >= RATIO) & ~F.col("palavra").rlike(_GLYPH))
    keyed = words.where(F.length("palavra") >= 3).select("palavra", "n", F.explode(glyph_folds(F.col("palavra"))).alias("key"))
    right = often.select(F.explode(glyph_folds(F.col("palavra"))).alias("key"), F.col("palavra").alias("certa"), F.col("n").alias("m"))
    misread = keyed.join(right, "key").where((F.col("palavra") != F.col("certa")) & (F.col("m") >= RATIO * F.col("n"))).withColumn("tipo", F.lit("misread"))
    long = words.where(F.length("palavra") >= 4).select("palavra", "n", F.explode(F.sequence(F.lit(1), F.length("palavra") - 1)).alias("k")).select(
        "palavra", "n", F.expr("substring(palavra, 1, k)").alias("a"), F.expr("substring(palavra, k + 1)").alias("b"))
    long = long.where((F.length("a") >= 2) & ((F.length("b") >= 2) | F.col("b").isin("e", "a", "o", "à")))
    whole = long.join(often.select(F.col("palavra").alias("a"), F.col("n").alias("na")), "a").join(often.select(F.col("palavra").alias("b"), F.col("n").alias("nb")), "b")
    merged = whole.where(F.least("na", "nb") >= RATIO * F.col("n")).select("palavra", "n", F.concat_ws(" ", "a", "b").alias("certa"), F.least("na", "nb").alias("m"),
                                                                              F.when((F.length("a") <= 3) & (F.length("b") <= 3), "merged_short").otherwise("merged").alias("tipo"))
    both = misread.select("palavra", "n", "certa", "m", "tipo").unionByName(merged)
    best = both.groupBy("palavra", "n").agg(F.max_by(F.struct("certa", "m", "tipo"), F.struct("m", "certa")).alias("x"))
    return best.select("palavra", "x.certa", "x.tipo", F.floor(F.log2(F.col("x.m") / F.col("n"))).cast("int").alias("grau"))


def _folded(words: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(pc.utf8_normalize(words, "NFD"), r"\p{Mn}", "")


TYPED = ("nome", "assinante", "orgao", "cargo", "cargo_assinante")


def _evidence(common: list[str]):
    """Rows of (id, word, piece, masks): rare words of each excerpt, and the features of each excerpt."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(common, pa.string())
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            lists = _word_lists(texts)
            words, parent, ends = lists.flatten(), np.asarray(pc.list_parent_indices(lists)), np.asarray(lists.offsets)[1:]
            rare = ~np.asarray(pc.is_in(words, value_set=known)) & (np.asarray(pc.utf8_length(words)) >= 3)
            # The last word of an excerpt without a final mark may be cut.
            open_end = ~np.asarray(pc.match_substring_regex(texts, r"[.!?”\x{22}]\s*$"))
            rare[ends[open_end & (ends > np.asarray(lists.offsets)[:-1])] - 1] = False
            at = np.flatnonzero(rare)
            # Words that the row's own typed fields hold (accents aside) are as typed, not misread.
            own = _word_lists(pc.binary_join_element_wise(*[b.column(i) for i in range(2, b.num_columns)], " ", null_handling="skip"))
            both = pa.concat_arrays([_folded(words.take(pa.array(at))), _folded(own.flatten())]).dictionary_encode().indices
            codes = np.asarray(both).astype(np.int64)
            row = np.concatenate([parent[at], np.asarray(pc.list_parent_indices(own))]).astype(np.int64)
            key = row * (codes.max(initial=0) + 1) + codes
            at = at[~np.isin(key[: len(at)], key[len(at) :])]
            may, text = guards(texts).tolist(), texts.to_pylist()
            parts = [pieces(t, m) for t, m in zip(text, may, strict=True)]
            held = words.take(pa.array(at))
            piece, lines = np.zeros(len(at), np.int32), {}
            several = np.array([len(x) > 1 for x in parts], bool)
            for k, i, w in zip(np.flatnonzero(several[parent[at]]).tolist(), parent[at][several[parent[at]]].tolist(), held.filter(pa.array(several[parent[at]])).to_pylist(), strict=True):
                if i not in lines:
                    lines[i] = [text[i][x:y].lower().replace("(", "").replace(")", "") for x, y, _, _ in parts[i]]
                piece[k] = next((j for j, line in enumerate(lines[i]) if w in line), 0)
            masks = pa.array([None] * len(at) + [features(t, x, m) for t, x, m in zip(text, parts, may, strict=True)], pa.list_(pa.int64()))
            rows = pa.array(np.concatenate([parent[at], np.arange(len(text))]).astype(np.int64))
            none = pa.nulls(len(text), pa.string())
            yield pa.RecordBatch.from_arrays([ids.take(rows), pa.concat_arrays([held.cast(pa.string()), none]), pa.array(np.concatenate([piece, np.zeros(len(text), np.int32)])), masks], ["linha_csv", "palavra", "peca", "mascaras"])

    return run


def evidence(acts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Doubtful words of excerpts (``linha_csv, palavra, peca, certa, tipo, grau``), features of excerpts (``linha_csv, mascaras``), vocabulary."""
    ship_code(acts.sparkSession)
    counts = cut(vocabulary_of(acts), "vocabulary")
    damaged = cut(damaged_words(counts), "damaged")
    common = [r.palavra for r in counts.join(damaged, "palavra", "left_anti").orderBy(F.desc("n"), "palavra").limit(COMMON).collect()]
    rows = spread(acts.where("trim(trecho) <> ''").select("linha_csv", "trecho", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in TYPED]))
    seen = cut(rows.mapInArrow(_evidence(common), f"linha_csv {dict(acts.dtypes)['linha_csv']}, palavra string, peca int, mascaras array<bigint>"), "evidence")
    words = cut(seen.where("palavra is not null").drop("mascaras").join(damaged, "palavra"), "findings")
    return words, seen.where("palavra is null").select("linha_csv", "mascaras"), counts


# ---------------------------------------------------------------- results


def _judge(model: Labeller):
    """The labels of the pieces of an excerpt, each a mask and its doubtful words; most excerpts are alike."""

    @functools.lru_cache(1 << 16)
    def best(rows: tuple[tuple[int, tuple[tuple[str, int], ...]], ...]) -> list[str]:
        return model.best([names_of(m, w) for m, w in rows])

    return best


def _labelled(model: Labeller):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = _judge(model)
        for b in batches:
            hit = []
            for masks, words in zip(b["mascaras"], b["palavras"], strict=True):
                masks = masks.tolist() if len(masks) else [_PLAIN_LINE]
                found: dict[int, set[tuple[str, int]]] = defaultdict(set)
                for x in words:
                    found[min(x["peca"], len(masks) - 1)].add((x["tipo"], x["grau"]))
                hit.append(any(s != "body" for s in best(tuple((m, tuple(sorted(found.get(i, ())))) for i, m in enumerate(masks)))))
            yield b.loc[hit, ["linha_csv"]]

    return run


def _labels(words: DataFrame, masks: DataFrame, model: Labeller) -> DataFrame:
    one = words.select("linha_csv", F.struct("peca", "tipo", "grau").alias("w"), F.lit(None).cast("array<bigint>").alias("m"))
    two = masks.select("linha_csv", F.lit(None).cast(dict(one.dtypes)["w"]).alias("w"), F.col("mascaras").alias("m"))
    rows = one.unionByName(two).groupBy("linha_csv").agg(F.collect_list("w").alias("palavras"), F.flatten(F.collect_list("m")).alias("mascaras"))
    return rows.mapInPandas(_labelled(model), f"linha_csv {dict(words.dtypes)['linha_csv']}")


def scanned(acts: DataFrame) -> DataFrame:
    """``linha_csv`` of each act whose excerpt bears a trace of page scanning: a piece labelled other than body.

    Null, empty and one-line excerpts, repeated rows and empty tables are all allowed.
    """
    words, masks, counts = evidence(acts)
    return _labels(words, masks, fitted(acts, words, counts))


def reassemble(text: str, labels: list[str], words: dict[str, str]) -> str:
    """Continuous text: headers dropped, broken words joined, stray marks gone, misread words replaced."""
    out = ""
    for (a, b, sep, _), label in zip(pieces(text), labels, strict=True):
        piece = text[a:b]
        if label == "header":
            out = out if not out or out.endswith(("\u0001", " ")) else out + " "
            continue
        if out.endswith("\u0001"):
            out = out[:-1] + piece.lstrip()
        elif out:
            out = out.rstrip(" ") + (" " if sep in (" ", "\f") or piece.lstrip()[:1].islower() or out.endswith(" ") else "\n") + piece.lstrip()
        else:
            out = piece
        if label == "break" or (label == "noise" and _HYPHEN_END.search(piece)):
            out = re.sub(r"[-¬­]\s*$", "\u0001", out)
    out = _INLINE_HYPHEN.sub("", _STRAY.sub("", out.replace("\u0001", "")))
    out = _SPACED.sub(lambda m: m.group().replace(" ", ""), out)
    out = _CEDILLA.sub("\u0327", out)  # a comma after c is its cedilla
    out = unicodedata.normalize("NFC", out) if "\u0327" in out else out

    def fix(m: re.Match) -> str:
        w = m.group()
        right = words.get(w.lower())
        upper = sum(c.isupper() for c in w) > len(w) // 2
        return w if right is None else right.upper() if upper else right.capitalize() if w[:1].isupper() else right

    out = out if text.endswith(" ") else out.rstrip(" ")
    return re.sub(r"[\w@|]+", fix, out) if words else out


def _repaired(model: Labeller):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = _judge(model)
        for b in batches:
            texts = []
            for text, found, may in zip(b["trecho"], b["achados"], guards(pa.array(b["trecho"], pa.string())).tolist(), strict=True):
                if text:
                    seen = {x["palavra"]: (x["tipo"], x["grau"]) for x in (found if found is not None else [])}
                    masks = features(text, may=may)
                    labels = best(tuple((m, tuple(sorted(w))) for m, w in zip(masks, words_in(text, seen) if seen else [()] * len(masks), strict=True)))
                    if any(s != "body" for s in labels):
                        text = reassemble(text, labels, {x["palavra"]: x["certa"] for x in (found if found is not None else []) if model.best([names_of(_PLAIN_LINE | (_BIT["glyph"] if _GLYPHS.search(x["palavra"]) else 0), [(x["tipo"], x["grau"])])]) != ["body"]})
                texts.append(text)
            yield pd.DataFrame({"linha_csv": b["linha_csv"], "texto": texts})

    return run


def repaired(acts: DataFrame) -> DataFrame:
    """``linha_csv, texto`` for every act: repaired if it bears a trace, otherwise as it was."""
    words, _, counts = evidence(acts)
    model = fitted(acts, words, counts)
    found = words.groupBy("linha_csv").agg(F.collect_set(F.struct("palavra", "certa", "tipo", "grau")).alias("achados"))
    rows = acts.select("linha_csv", "trecho").join(found, "linha_csv", "left")
    return rows.select("linha_csv", "trecho", "achados").mapInPandas(_repaired(model), f"linha_csv {dict(acts.dtypes)['linha_csv']}, texto string")
