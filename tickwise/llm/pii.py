"""Personal data in whole texts, with offset-preserving deobfuscation.

The plain patterns run on the text itself. Where a text shows signs of
disguise, transducers rewrite it step by step: look-alike characters become
ASCII, invisible ones vanish, spelled digits become digits, and at/dot
disguises become signs. Every character of the rewritten text keeps the span
of source characters it came from, so what the patterns find there is mapped
back to the source. Plain spans always stay; a span that only the rewritten
text shows is added.

All spans are in code points of the source, end exclusive. A text is read
whole and each pattern is linear in its length.

Defined cases: a null or empty text has no spans; ties (spans of several kinds
with one start) are ordered as the kinds are listed; repeated rows are judged
each on its own; null ids are kept; other columns are not read.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# Domain part of an address, from the sign on; the local part is found by
# walking back, so that a long run without a sign costs nothing.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
# A match inside a run of digits would need an earlier one to have failed, so
# looking behind changes nothing but the cost of long runs.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    for m in _DOMAIN.finditer(text):
        start = at = m.start()
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            last = m.end()
            yield start, last


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = (p.lstrip("0") for p in m[0].split("."))
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = int(ch)
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= sum("0" <= ch <= "9" for ch in m[0]) <= 15:
            yield m.span()


_FINDERS = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the plain patterns, sorted."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        out += [(a, k, b) for k, kind in enumerate(KINDS[1:], 1) for a, b in _FINDERS[kind](text)]
    return sorted(out)


_DIGIT = re.compile("[0-9]")

# Letters of other scripts that look like ASCII ones.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "З": "3",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "ι": "i", "κ": "k", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H",
    "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ɡ": "g", "ⅼ": "l",
    "․": ".", "。": ".", "｡": ".", "‧": ".", "·": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "−": "-", "﹢": "+", "﹫": "@",
}
INVISIBLE = "­​‌‍⁠﻿"
_WIDE_SPACES = "      "


def plain_character(ch: str) -> str:
    """The ASCII character that ``ch`` stands for, itself if none; empty if it
    is invisible."""
    if ch < "\x80":
        return ch
    if ch in INVISIBLE:
        return ""
    if ch in _WIDE_SPACES:
        return " "
    if ch in LOOKALIKES:
        return LOOKALIKES[ch]
    digit = unicodedata.digit(ch, None)
    if digit is not None and unicodedata.category(ch) == "Nd":
        return str(digit)
    folded = unicodedata.normalize("NFKC", ch)
    return folded if len(folded) == 1 and "!" <= folded <= "~" else ch


# Characters that may stand for others; Latin-1 letters never do.
_ODD = re.compile("[^\x00-\xac\xae-\xb6\xb8-\xff]|[ ­·]")

# Number words of the corpus languages, but for the French one
# that is its article too.
NUMBERS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "null": 0, "eins": 1, "zwei": 2, "drei": 3, "vier": 4, "fünf": 5, "sechs": 6, "sieben": 7, "acht": 8, "neun": 9,
    "zéro": 0, "deux": 2, "trois": 3, "quatre": 4, "cinq": 5, "sept": 7, "huit": 8, "neuf": 9,
    "cero": 0, "uno": 1, "dos": 2, "tres": 3, "cuatro": 4, "cinco": 5, "seis": 6, "siete": 7, "ocho": 8, "nueve": 9,
}
_NUMBER = "|".join(sorted(NUMBERS, key=len, reverse=True))
_DOT = "dot|punkt|punto|point"
_AT = "at|arroba"
# Three number words or more, with digits, "dot" and "plus" among them.
_SPELLED = re.compile(
    rf"\b(?:plus[\s,]{{1,3}})?(?:{_NUMBER})\b(?:[\s,.-]{{1,3}}(?:{_NUMBER}|{_DOT}|[0-9]+)\b){{2,}}", re.IGNORECASE
)
_SPELLED_PART = re.compile(rf"\b(?:(plus)|({_NUMBER})|({_DOT}))\b|([0-9])|([\s,.-]+)", re.IGNORECASE)
_BOXED = re.compile(
    rf"\s{{0,3}}(?:\[\s?(?:(?:{_AT}|@)|(?:{_DOT}|\.))\s?\]|\(\s?(?:(?:{_AT}|@)|(?:{_DOT}|\.))\s?\)"
    rf"|\{{\s?(?:(?:{_AT}|@)|(?:{_DOT}|\.))\s?\}}|<\s?(?:(?:{_AT}|@)|(?:{_DOT}|\.))\s?>)\s{{0,3}}",
    re.IGNORECASE,
)
# Top-level labels that are no common word of the corpus
# languages. A spoken "at" counts only before a domain that ends in one.
TOP_LABELS = frozenset(
    "com net org edu gov mil int info biz pro app dev xyz online site shop tech cloud io ai co tv eu uk de fr ch nl pl cz ru cn"
    " jp kr br mx ca au nz za se dk fi ie pt gr tr hu ro ua example test invalid local localhost".split()
)
# Spoken signs between words: both must be there, "at" alone is plain prose.
_BETWEEN = r"(?:\s{1,3}|[-_])"
_LABELS = r"[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*"
_SPOKEN = re.compile(
    rf"(?<=[A-Za-z0-9_%+-]){_BETWEEN}(?:(at)|arroba){_BETWEEN}(?=[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+){{0,126}}?{_BETWEEN}(?:{_DOT}){_BETWEEN}[A-Za-z])",
    re.IGNORECASE,
)
# What follows a spoken "at": labels and spoken dots, the last label apart.
_SPOKEN_DOMAIN = re.compile(rf"{_LABELS}(?:{_BETWEEN}dot{_BETWEEN}(?:[A-Za-z0-9]+[.-])*([A-Za-z0-9]+))+", re.IGNORECASE)
# A word of a domain up to a spoken dot.
_DOMAIN_WORD = re.compile(rf"[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*?({_BETWEEN}dot{_BETWEEN})(?=[A-Za-z0-9])", re.IGNORECASE)
_DOMAIN_WORD_ANY = re.compile(
    rf"[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*?({_BETWEEN}(?:{_DOT}){_BETWEEN})(?=[A-Za-z0-9])", re.IGNORECASE
)
# A spoken dot between a word and the local part that ends the text.
_LOCAL_DOT = re.compile(rf"(?<=[A-Za-z0-9])({_BETWEEN}(?:{_DOT}){_BETWEEN})$", re.IGNORECASE)
_LOCAL_DOT_ONLY = re.compile(rf"(?<=[A-Za-z0-9])({_BETWEEN}dot{_BETWEEN})$", re.IGNORECASE)
# Number words beside digits, too few for the pattern above.
_GAP = r"[\s-]{1,3}"
_LOOSE = re.compile(
    rf"(?<=[0-9])(?:{_GAP}(?:(?:{_DOT}){_GAP})?(?:{_NUMBER})\b)+|\b(?:(?:{_NUMBER}){_GAP})+(?=[0-9])", re.IGNORECASE
)
_NUMBER_WORD = re.compile(rf"\b(?:{_NUMBER})\b", re.IGNORECASE)
_NUMBER_DOT = re.compile(rf"(?<=[0-9])\s{{1,3}}(?:{_DOT})\s{{1,3}}(?=[0-9])", re.IGNORECASE)
_ENTITY = re.compile(r"&(?:(#0*64|#x0*40|commat)|#0*46|#x0*2e|period);", re.IGNORECASE)
_HINT = re.compile(
    rf"[\[({{<]\s?(?:{_AT}|{_DOT}|@|\.)\s?[\])}}>]|(?:\b|_)(?:{_DOT}|arroba)(?:\b|_)|&(?:#0*64|#0*46|#x0*40|#x0*2e|commat|period);",
    re.IGNORECASE,
)


class Rewritten:
    """A text and, for each of its characters, the source span behind it."""

    def __init__(self, text: str):
        self.text = text
        self.spans: list[tuple[int, int]] | None = None  # None: each its own

    def span(self, start: int, end: int) -> tuple[int, int]:
        if self.spans is None:
            return start, end
        return self.spans[start][0], self.spans[end - 1][1]

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply edits (start, end, new text), sorted and apart. The characters
        of a new text share the span of what they replace."""
        if not edits:
            return
        old = self.spans if self.spans is not None else [(i, i + 1) for i in range(len(self.text))]
        text, spans, at = [], [], 0
        for start, end, new in edits:
            text += [self.text[at:start], new]
            spans += old[at:start]
            spans += [(old[start][0], old[end - 1][1])] * len(new)
            at = end
        text.append(self.text[at:])
        spans += old[at:]
        self.text, self.spans = "".join(text), spans


def _spell(m: re.Match) -> str:
    out = []
    for part in _SPELLED_PART.finditer(m[0]):
        plus, word, dot, digit, _ = part.groups()
        out.append("+" if plus else str(NUMBERS[word.lower()]) if word else "." if dot else digit or "")
    return "".join(out)


def _local_dots(text: str, start: int, sign: int, spoken: bool) -> list[tuple[int, int, str]]:
    """Spoken dots in the local part of a sign, not before ``start``."""
    edits = []
    at = sign
    while True:
        word = at
        while word > start and text[word - 1] in _LOCAL:
            word -= 1
        # a sign of disguise has at most 12 characters and one before it
        from_ = max(start, word - 14)
        dot = (_LOCAL_DOT if spoken else _LOCAL_DOT_ONLY).search(text[from_:word]) if word < at else None
        if not dot:
            return edits[::-1]
        at = from_ + dot.start(1)
        edits.append((at, word, "."))


def rewrite(text: str, loose: bool = False) -> Rewritten:
    """The text without disguises; with ``loose`` also one or two number words
    beside digits are digits."""
    r = Rewritten(text)
    r.replace([(m.start(), m.end(), new) for m in _ODD.finditer(text) if (new := plain_character(m[0])) != m[0]])
    r.replace([(m.start(), m.end(), "@" if m[1] else ".") for m in _ENTITY.finditer(r.text)])
    r.replace([(m.start(), m.end(), _spell(m)) for m in _SPELLED.finditer(r.text)])
    if loose:
        r.replace([(m.start(), m.end(), _spell(m)) for m in _LOOSE.finditer(r.text)])
    r.replace([(m.start(), m.end(), ".") for m in _NUMBER_DOT.finditer(r.text)])
    r.replace([(m.start(), m.end(), "@" if re.search(rf"{_AT}|@", m[0], re.IGNORECASE) else ".") for m in _BOXED.finditer(r.text)])
    r.replace([(m.start(), m.end(), "@") for m in _SPOKEN.finditer(r.text) if not m[1] or _is_domain(r.text, m.end())])
    if "@" in r.text:
        edits, at = [], 0
        for sign in re.finditer("@", r.text):
            a, b = r.span(*sign.span())
            edits += _local_dots(r.text, at, sign.start(), b - a > 1)
            at = max(at, sign.end())
            word = _DOMAIN_WORD_ANY if "arroba" in text[a:b].lower() else _DOMAIN_WORD
            while dot := word.match(r.text, at):
                edits.append((*dot.span(1), "."))
                at = dot.end()
        r.replace(edits)
    return r


def _is_domain(text: str, at: int) -> bool:
    """A spoken domain that ends in a known label starts at ``at``."""
    m = _SPOKEN_DOMAIN.match(text, at)
    return m is not None and m[1].lower() in TOP_LABELS


_TOKEN = re.compile(r"[^\W_]+")
_DOT_WORDS = frozenset(f"{_DOT}|arroba".split("|"))
_OPENERS = re.compile(r"[\[({<&]")


def _disguised(text: str) -> bool:
    if not text.isascii() and _ODD.search(text):
        return True
    # the patterns are tried only where the words that they need are there
    words = set(_TOKEN.findall(text.lower()))
    if (not words.isdisjoint(_DOT_WORDS) or _OPENERS.search(text)) and _HINT.search(text):
        return True
    return not words.isdisjoint(NUMBERS) and bool(_SPELLED.search(text) or _LOOSE.search(text))


def added_spans(text: str, plain: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that only the rewritten text shows: not inside a plain span of
    their kind. Addresses need a last label of letters."""
    if not _disguised(text):
        return []
    r = rewrite(text)
    out = _found(r, plain)
    if _LOOSE.search(r.text):
        # a number that is whole without one more word beside it stays as it is
        whole = sorted(plain + out)
        for a, k, b in _found(rewrite(text, loose=True), whole):
            inside = [(x, y) for x, kk, y in whole if kk == k and x < b and a < y]
            if not inside or (k != 2 and len(_NUMBER_WORD.findall(text[a:b])) > 1):
                out = [s for s in out if s[1] != k or s[0] < a or s[2] > b] + [(a, k, b)]
    return sorted(out)


def _found(r: Rewritten, plain: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    if r.spans is None:
        return []
    out = []
    for k, kind in enumerate(KINDS):
        own = [(a, b) for a, kk, b in plain if kk == k]
        for start, end in _FINDERS[kind](r.text):
            if k == 0 and not re.search(r"\.[A-Za-z]{2,24}$", r.text[start:end]):
                continue
            a, b = r.span(start, end)
            near = bisect_right(own, (a, sys.maxsize)) - 1  # the last that starts at a or before
            if near < 0 or own[near][1] < b:
                out.append((a, k, b))
    return sorted(out)


SPAN_LIST = "array<struct<kind:string,start:bigint,end:bigint>>"


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``<id_col>, plain, added``, lists of
    ``kind, start, end`` by start, then kind."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    id_type = source.schema["id"].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def listed(spans):
        return [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plain, added = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                own = plain_spans(text)
                plain.append(listed(own))
                added.append(listed(added_spans(text, own)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(plain, type=span), pa.array(added, type=span)], names=["id", "plain", "added"]
            )

    found = source.mapInArrow(task, f"id {id_type}, plain {SPAN_LIST}, added {SPAN_LIST}")
    return found.select(F.col("id").alias(id_col), "plain", "added")


def mask(text: str) -> str:
    """The text with every span replaced by its kind, as in ``<EMAIL>``;
    overlapping spans are one, named by the first."""
    plain = plain_spans(text)
    merged: list[list[int]] = []
    for a, k, b in sorted(plain + added_spans(text, plain)):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([a, k, b])
    out, at = [], 0
    for a, k, b in merged:
        out += [text[at:a], f"<{KINDS[k].upper()}>"]
        at = b
    return "".join([*out, text[at:]])


def mask_personal(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with masked texts (and lengths, where the column exists); all
    other columns as they are."""
    at = docs.columns.index(text_col)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind = batch.schema.field(at).type
            masked = pa.array([None if v is None else mask(v) for v in (x.as_py() for x in batch.column(at))], type=kind)
            columns = batch.columns
            columns[at] = masked
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    # positions, not names: names may repeat or clash
    out = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).mapInArrow(
        task, ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    )
    if length_col in docs.columns:
        n = docs.columns.index(length_col)
        kind = docs.schema.fields[n].dataType
        out = out.withColumn(f"c{n}", F.length(f"c{at}").cast(kind))
    return out.toDF(*docs.columns)


def joined(spans: str):
    """``kind:start:end`` of a span list, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def all_spans():
    """Plain and added spans of a row by start, then kind, then end."""
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(
        F.concat("plain", "added"),
        lambda s: F.struct(s["start"].alias("a"), order[s["kind"]].alias("k"), s["end"].alias("b"), s["kind"].alias("kind")),
    )
    return F.transform(
        F.array_sort(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["a"].alias("start"), s["b"].alias("end"))
    )
