"""Personal data with offset-preserving deobfuscation.

Base identifiers (email, ip, card, phone) are found in the text as it stands.  Then a chain of small transducers
rewrites a copy of the text, each keeping for every output character the source span it came from:

1. homoglyphs, wide forms and escaped signs (``&#64;``, ``%40``) become ASCII, invisible characters vanish;
2. runs of spelled digits become digits, a leading "plus" becomes ``+``, four spelled groups with "dot" between them an
   ip address;
3. bracketed, spoken or joined (``_at_``) "at" and "dot" become ``@`` and ``.``.  A spoken or joined "at" counts only
   where a disguised "dot" follows, spoken, joined or bracketed: "see us at example.com" is no address.  A spoken
   or joined "dot" counts in the same chain of words as a literal or bracketed ``@`` as well.

The same detectors run over the rewritten text; a find that a transducer touched is mapped back to source characters
and added, unless it lies inside a base find of its kind.  Texts in which no transducer has anything to do (a search
tells) skip that part.

Every scan is linear in the text: digit runs and local parts are taken whole, never retried from their middle.  Spans
are code points, end exclusive.  A null text counts as empty and has no spans; other columns pass through unchanged.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")

# Look-alike letters and invisible characters.
_LOOKALIKES = dict(zip("аеорсухіјѕԁһкмтвнАВЕКМНОРСТХУІЈЅαορνιΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                       "aeopcyxijsdhkmtbhABEKMHOPCTXYIJSaopviABEZHIKMNOPTYX", strict=True))
_INVISIBLE = "­​‌‍⁠﻿"
_MAP = {ord(a): b for a, b in _LOOKALIKES.items()} | {0xFF01 + i: chr(0x21 + i) for i in range(94)}
_MAP |= {0x3000: " ", 0x00A0: " ", 0x2010: "-", 0x2011: "-", 0x2024: ".", 0x3002: ".", 0xFE52: ".", 0xFE6B: "@"}
_ODD = re.compile("[" + "".join(map(chr, sorted(_MAP))) + _INVISIBLE + "]")
_UNSEEN = re.compile(f"[{_INVISIBLE}]+")
_DIGITS = {w: str(i) for i, w in enumerate("zero one two three four five six seven eight nine".split())}
_SPELLED = "(?:" + "|".join(_DIGITS) + ")"
_DIGIT_RUN = re.compile(rf"(?:\bplus[\s-]+)?\b{_SPELLED}\b(?:[\s,-]{{1,3}}(?:{_SPELLED}\b|[0-9]++))+", re.I)
_WORD = re.compile(r"[A-Za-z]+|[0-9]+")
_BRACKETED = re.compile(r"\s{0,3}[\[({<]\s{0,3}(at|dot|@|\.)\s{0,3}[\])}>]\s{0,3}", re.I)
_CHAIN = re.compile(r"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9._%+@-]++(?:\s{1,3}(?:at|dot)\s{1,3}[A-Za-z0-9._%+@-]++)*+", re.I)
_SIGNS = re.compile(r"\s{1,3}(?:at|dot)\s{1,3}|(?<=[A-Za-z0-9])([_-])(?:at|dot)\1(?=[A-Za-z0-9])", re.I)
_SPOKEN_IP = re.compile(r"(?<![0-9])[0-9]++(?:(?:\s{1,3}dot\s{1,3}|\.)[0-9]++){3}", re.I)
_JOINED_SIGN = re.compile(r"[_-](at|dot)[_-]", re.I)
_SPELLED_GROUP = rf"{_SPELLED}(?:[\s-]{{1,3}}{_SPELLED}){{0,2}}"
_SPELLED_IP = re.compile(rf"\b{_SPELLED_GROUP}(?:\s{{1,3}}dot\s{{1,3}}{_SPELLED_GROUP}){{3}}\b", re.I)
_ESCAPED = re.compile(r"&(?:#0{0,4}(?:64|46)|#x0{0,4}(?:40|2e)|commat|period);|%40", re.I)
_AT_DOT = re.compile(r"\s{1,3}(at|dot)\s{1,3}", re.I)


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base identifiers, sorted."""
    out, pos = [], 0
    while (at := text.find("@", pos)) >= 0:
        low = at
        while low > pos and text[low - 1] in _LOCAL:
            low -= 1
        m = _DOMAIN.match(text, at + 1) if low < at else None
        if m:
            out.append((low, 0, m.end()))
        pos = m.end() if m else at + 1
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
                if all(len(p := x.lstrip("0")) < 3 or len(p) == 3 and p <= "255" for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text)
                    if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return sorted(out)


class _Tape:
    """A rewritten text and the way back from its characters to the source, kept as the edits alone."""

    def __init__(self, text: str):
        self.source = self.text = text
        self.layers: list[tuple[list[int], list[tuple[int, int, int]]]] = []

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces the non-overlapping, sorted ``(start, end, new text)``."""
        if not edits:
            return
        text, begin, spans, at, size = [], [], [], 0, 0
        for s, e, new in edits:
            text += [self.text[at:s], new]
            size += s - at
            begin.append(size)  # where the new text begins, and in ``spans`` where it ends
            size += len(new)
            spans.append((s, e, size))
            at = e
        self.text = "".join([*text, self.text[at:]])
        self.layers.append((begin, spans))

    def _back(self, at: int, last: bool) -> int:
        """The source character of one here; of an edit's the first or the last."""
        for begin, spans in reversed(self.layers):
            k = bisect.bisect_right(begin, at) - 1
            if k >= 0:
                s, e, end = spans[k]
                at = at - end + e if at >= end else e - 1 if last else s
        return at

    def start(self, at: int) -> int:
        return self._back(at, False)

    def end(self, at: int) -> int:
        return self._back(at, True) + 1


def _plain_letters(tape: _Tape) -> None:
    tape.text = tape.text.translate(_MAP)  # one character for one, so places stay
    tape.rewrite([(m.start(), m.end(), "") for m in _UNSEEN.finditer(tape.text)])
    dots = ("46;", "2e;", "period;")
    tape.rewrite([(m.start(), m.end(), "." if m[0].lower().endswith(dots) else "@") for m in _ESCAPED.finditer(tape.text)])


def _made_dot(tape: _Tape, start: int, end: int) -> bool:
    """Whether a dot there was something else in the source."""
    return any(tape.text[i] == "." and tape.source[tape.start(i):tape.end(i)] != "." for i in range(start, end))


def _at_dot(tape: _Tape) -> None:
    sign = {"at": "@", "dot": "."}
    tape.rewrite([(m.start(), m.end(), sign.get(m[1].lower(), m[1])) for m in _BRACKETED.finditer(tape.text)])
    edits = []
    for m in _CHAIN.finditer(tape.text):  # words with spoken or joined "at" or "dot" between or in them, each chain taken whole
        signs = [(m.start() + x.start(), m.start() + x.end(), sign[x[0].strip().strip("_-").lower()]) for x in _SIGNS.finditer(m[0])]
        real = [x for x, after in zip(signs, [*signs, (m.end(), 0, "")][1:], strict=True)
                if x[2] == "." or after[2] == "." or _made_dot(tape, x[1], after[0])]
        edits += real if "@" in m[0] or any(x[2] == "@" for x in real) else []
    tape.rewrite(edits)
    tape.rewrite([(m.start() + x.start(), m.start() + x.end(), ".")
                  for m in _SPOKEN_IP.finditer(tape.text) for x in _AT_DOT.finditer(m[0])])


def _words(m: re.Match, signs: dict[str, str]) -> list[tuple[int, int, str]]:
    """Edits that put signs for the words of a match; the separators go with the word before them."""
    found = list(_WORD.finditer(m[0]))
    return [(m.start() + w.start(), m.start() + (after.start() if after else w.end()), signs.get(w[0].lower(), w[0]))
            for w, after in zip(found, [*found[1:], None], strict=True)]


def _digit_runs(text: str) -> Iterator[re.Match]:
    """Runs of spelled digits, numerals among them, with three spelled ones at least."""
    return (m for m in _DIGIT_RUN.finditer(text) if sum(w[0].lower() in _DIGITS for w in _WORD.finditer(m[0])) >= 3)


def _spelled_digits(tape: _Tape) -> None:
    tape.rewrite([x for m in _SPELLED_IP.finditer(tape.text) for x in _words(m, _DIGITS | {"dot": "."})])
    tape.rewrite([x for m in _digit_runs(tape.text) for x in _words(m, _DIGITS | {"plus": "+"})])


def _disguised(text: str) -> bool:
    if not text.isascii() and _ODD.search(text):
        return True
    low = text.lower()
    if ("&" in low or "%40" in low) and _ESCAPED.search(low):
        return True
    return "dot" in low and bool(_AT_DOT.search(text) or _JOINED_SIGN.search(text)) or _BRACKETED.search(text) is not None or any(_digit_runs(text))


def find_spans(text: str | None) -> list[tuple[str, int, int, bool]]:
    """``(kind, start, end, base)`` of every identifier, by start, then kind."""
    if not text:
        return []
    base = base_spans(text)
    found = [(s, k, e, True) for s, k, e in base]
    if _disguised(text):
        tape = _Tape(text)
        _plain_letters(tape)
        _spelled_digits(tape)
        _at_dot(tape)
        for s, k, e in base_spans(tape.text):
            lo, hi = tape.start(s), tape.end(e - 1)
            if tape.text[s:e] != text[lo:hi] and not any(a <= lo and hi <= b for a, kind, b in base if kind == k):
                found.append((lo, k, hi, False))
    return [(KINDS[k], s, e, b) for s, k, e, b in sorted(found)]


def masked(text: str | None) -> str | None:
    """The text with every find replaced by its kind in brackets; overlapping finds become one."""
    out, at = [], 0
    for kind, s, e, _ in find_spans(text):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return text if not out else "".join([*out, text[at:]])


def spans(text: Column) -> Column:
    """All finds of a text column, as an array of ``(kind, start, end, base)``."""
    def run(column: pd.Series) -> pd.Series:
        return pd.Series([[dict(kind=k, start=s, end=e, base=b) for k, s, e, b in find_spans(t)] for t in column],
                         dtype=object)

    return F.pandas_udf(run, SPANS)(text)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every find in its text replaced by ``[KIND]``; a null text stays null."""
    def run(column: pd.Series) -> pd.Series:
        return pd.Series([masked(t) for t in column], dtype=object)

    return docs.withColumn(text_col, F.pandas_udf(run, "string")(F.col(text_col)))


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts per kind, digest of the base spans, all spans as text, finds added per kind.

    ``n_email, n_ip, n_card, n_phone`` count the base finds; ``n_added`` the finds that deobfuscation added.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), spans(F.col(text_col)).alias("spans"))
    base = F.filter("spans", lambda x: x["base"])

    def listed(array: Column) -> Column:
        return F.array_join(F.transform(array, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def of_kind(kind: str) -> Column:
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [of_kind(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"),
                        (F.size("spans") - F.size(base)).cast("long").alias("n_added"))
