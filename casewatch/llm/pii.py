"""Personal data, with offset-preserving deobfuscation.

Identifiers are found in a text as it stands (the base), and again in its normalised form:
transducers turn look-alike characters, spelled digits and at/dot disguises into plain
characters and remember where each came from, so a span of the normalised text maps back
to the source characters.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewatch.llm.common import keyed
from casewatch.llm.spans import Mapped, Span, added, digest, joined

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def _luhn(digits: str) -> bool:
    values = [ord(c) - 48 for c in digits[::-1]]
    return sum(values[::2], sum(2 * v - 9 * (v > 4) for v in values[1::2])) % 10 == 0


def identifiers(text: str) -> list[Span]:
    """The base spans of a text: leftmost, non-overlapping per kind; a match that fails its check is dropped."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append(Span(start, EMAIL, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
                out.append(Span(m.start(), IP, m.end()))
        for m in _CARD.finditer(text):
            if 14 <= m.end() - m.start() <= 37:
                d = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(d) <= 19 and _luhn(d):
                    out.append(Span(m.start(), CARD, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
                    out.append(Span(m.start(), PHONE, m.end()))
    return out


#: Letters of other scripts that look like a Latin letter.
_LOOKALIKES = dict(zip("аеорсухіјѕԁԛԝһӏАВЕКМНОРСТУХІЈЅ" "αορυνικτΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijsdqwhlABEKMHOPCTYXIJS" "aopuviktABEZHIKMNOPTYX", strict=True))
#: Signs that stand for an ASCII one.
_SIGNS = {"\u2024": ".", "\u3002": ".", "\uff61": ".", "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2212": "-",
          "\u207a": "+", "\u00a0": " ", "\u2009": " ", "\u202f": " "}


def _homoglyphs() -> dict[str, str]:
    """One ASCII character for each look-alike: the lists above, and all characters whose
    compatibility form is one ASCII letter, digit or sign (full-width, mathematical, circled), the decimal digits of all scripts,
    and all blanks."""
    out = dict(_LOOKALIKES) | _SIGNS
    for c in map(chr, range(0x80, 0x1FC00)):
        if unicodedata.category(c) == "Zs":
            out.setdefault(c, " ")
        elif len(n := unicodedata.normalize("NFKC", c)) == 1 and n.isascii() and (n.isalnum() or n in "@.+-_"):
            out.setdefault(c, n)
        elif (d := unicodedata.decimal(c, None)) is not None:
            out.setdefault(c, str(d))
    return out


HOMOGLYPHS = _homoglyphs()
#: Characters that show nothing, put inside an identifier.
_INVISIBLE = dict.fromkeys("\u00ad\u200b\u200c\u200d\u2060\ufeff", "")
_PLAIN = HOMOGLYPHS | _INVISIBLE

#: The words of the digits.
DIGIT_WORDS = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
_WORD = "(?:" + "|".join(DIGIT_WORDS) + ")"
_SPELLED = re.compile(rf"(?ai)(?:(?<![a-z0-9])plus[ \t,-]++)?(?<![a-z0-9]){_WORD}(?:[ \t]*+[,.;-]?[ \t]*+{_WORD}|[ \t-]?[0-9](?=[ \t,-])){{3,}}(?![a-z])")
_ONE_WORD, _TWO_WORDS = re.compile(rf"(?ai){_WORD}"), re.compile(rf"{_WORD}[ \t,.;-]*{_WORD}")
# Digit words, digits and dots beside each other, over signs and line ends.
_GAP = r"[ \t\r\n]*+(?:[,.;()\[\]-][ \t\r\n]*+)*+"
_RUN = re.compile(rf"(?ai)(?<![a-z0-9])(?:plus(?![a-z]){_GAP})?(?:{_WORD}|[0-9]++)(?:{_GAP}(?:dot(?![a-z]){_GAP})*+(?:{_WORD}|[0-9]++))+(?![a-z0-9])")
_IN_RUN = re.compile(rf"(?ai)(plus)|({_WORD})|(dot|\.)|([0-9]+)|[^a-z0-9]")
_NEAR_WORD = re.compile(rf"{_WORD}{_GAP}(?:dot(?![a-z])|{_WORD}|[0-9])|[0-9]{_GAP}(?:dot{_GAP})?{_WORD}")

# Blanks are taken from their first one on, so a long run of them is read once.
_AT = r"(?<![ \t])(?:[ \t]*+[\[({<][ \t]*+(?:at|@)[ \t]*+[\])}>][ \t]*+|[ \t]++at[ \t]++)"
_DOT = r"(?<![ \t])(?:[ \t]*+[\[({<][ \t]*+(?:dot|punkt|\.)[ \t]*+[\])}>][ \t]*+|[ \t]++dot[ \t]++)"
# A disguised address: at is disguised or a sign, and so is each dot, one of them at least. Without
# an at, the words before it are passed over as a whole.
_DISGUISED = re.compile(
    rf"(?ai)(?<![a-z0-9._%+-])[a-z0-9_%+-]++(?:(?:{_DOT}|\.)[a-z0-9_%+-]++)*+(?:(?P<at>{_AT}|@)[a-z0-9-]++(?:(?:{_DOT}|\.)[a-z0-9-]++)++)?")
_DISGUISED_AT, _DISGUISED_DOT = re.compile(f"(?ai){_AT}"), re.compile(f"(?ai){_DOT}")
_BARE_AT = re.compile(r"(?ai)[ \t]+at[ \t]+\Z")
_IP_DISGUISED = re.compile(rf"(?ai)(?<![0-9.])[0-9]{{1,3}}(?:(?:{_DOT}|\.)[0-9]{{1,3}}){{3}}(?![0-9])")
_NEAR_DOT = re.compile(r"(?ai)[\[({<][ \t]*(?:at|@|dot|punkt|\.)[ \t]*[\])}>]|[ \t]dot[ \t]")


def _replaced(text: str) -> list[tuple[int, int, str]]:
    """Look-alike and invisible characters."""
    if text.isascii() or not (found := _PLAIN.keys() & set(text)):
        return []
    return [(m.start(), m.end(), _PLAIN[m[0]]) for m in re.finditer("[" + "".join(map(re.escape, sorted(found))) + "]", text)]


def _spelled(text: str) -> list[tuple[int, int, str]]:
    """Runs of digit words become digits, and a leading "plus" its sign."""
    low = text.lower()
    if sum(map(low.count, DIGIT_WORDS)) < 4 or not _TWO_WORDS.search(low):
        return []
    edits = []
    for m in _SPELLED.finditer(text):
        digits = _ONE_WORD.sub(lambda w: DIGIT_WORDS[w[0].lower()], m[0])
        plus = "+" if digits[:4].lower() == "plus" else ""
        edits.append((m.start(), m.end(), plus + re.sub("[^0-9]", "", digits)))
    return edits


def _runs(text: str, dots: bool) -> list[tuple[int, int, str]]:
    """Runs of digit words with digits, dots, brackets or line ends among them become digits, and a
    leading "plus" its sign. With `dots`, dots stay dots, and other signs and a
    sentence's end become a blank; else they go."""
    low = text.lower()
    if not any(map(low.__contains__, DIGIT_WORDS)) or not _NEAR_WORD.search(low):
        return []

    def one(m: re.Match) -> str:
        if m[1] or m[2]:
            return "+" if m[1] else DIGIT_WORDS[m[2].lower()]
        if m[4] or not dots or m[0].isspace():
            return m[4] or ""
        ends = m[0] == "." and m.string[m.end()].isspace() and not m.string[m.start() - 1].isspace()
        return "." if m[3] and not ends else " "
    edits = []
    for m in _RUN.finditer(text):
        if _ONE_WORD.search(m[0]) and sum(map(str.isdigit, new := _IN_RUN.sub(one, m[0]))) >= 4:
            edits.append((m.start(), m.end(), new))
    return edits


def _undisguised(text: str) -> list[tuple[int, int, str]]:
    """The at and dot words of what reads as an address."""
    if not (any(c in text for c in "[({<") or "dot" in text.lower()) or not _NEAR_DOT.search(text):
        return []
    edits = {}
    for m in _DISGUISED.finditer(text):
        if m["at"] is None:
            continue
        a, b = m.span("at")
        if a > m.start() and _DISGUISED_AT.fullmatch(text, a, b):
            if _BARE_AT.match(text, a, b) and not _DISGUISED_DOT.search(text, b, m.end()):
                continue  # "at" between words, and plain dots after them: prose
            edits[a] = (a, b, "@")
        for d in _DISGUISED_DOT.finditer(text, m.start(), m.end()):
            edits[d.start()] = (d.start(), d.end(), ".")
    for m in _IP_DISGUISED.finditer(text):
        for d in _DISGUISED_DOT.finditer(text, m.start(), m.end()):
            edits[d.start()] = (d.start(), d.end(), ".")
    out, at = [], 0
    for e in sorted(edits.values()):
        if e[0] >= at:
            out.append(e)
            at = e[1]
    return out


def scan(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and the spans that only the normalised text shows, both in source code points.

    Of what the normalised text shows, a fuller span stands beside the base span it holds: an address, or
    digits that look-alike or invisible characters cut short. (Digit words after a whole number don't make it fuller.)
    """
    base, more, first, fuller = identifiers(text), [], [], set()
    plain = text
    if edits := _replaced(text):
        first = [Mapped(text, edits)]
        plain = first[0].text
    # Each reading of the spelled digits; the first is that of words alone.
    readings = [_spelled(plain)]
    readings += [r for r in (_runs(plain, True), _runs(plain, False)) if r and r not in readings]
    for reading in readings:
        layers, now, spelled = list(first), plain, None
        if reading:
            layers.append(spelled := Mapped(now, reading))
            now = layers[-1].text
        if edits := _undisguised(now):
            layers.append(Mapped(now, edits))
            now = layers[-1].text
        if not layers:
            continue
        for s in identifiers(now):
            start, end, touched, words = s.start, s.end, False, False
            for layer in reversed(layers):
                here = layer.edited(start, end)
                touched, words = touched or here, words or here and layer is spelled
                start, end = layer.source_span(start, end)
            if touched:
                more.append(found := Span(start, s.kind, end))
                if s.kind == EMAIL or not words:
                    fuller.add(found)
    return base, added(base, more, frozenset(fuller))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, base_sha, base_all, spans, plus = [[] for _ in KINDS], [], [], [], []
        for text in b.column("text").to_pylist():
            base, more = scan(text or "")
            for k, of_kind in enumerate(n):
                of_kind.append(sum(s.kind == k for s in base))
            base_all.append(joined(base, KINDS))
            base_sha.append(digest(base_all[-1]))
            spans.append(joined(base + more, KINDS) if more else base_all[-1])
            plus.append(len(more))
        yield pa.RecordBatch.from_arrays(
            [b.column("kf"), b.column("kr"), b.column("doc_id"), *[pa.array(x, pa.int64()) for x in n],
             pa.array(base_sha, pa.string()), pa.array(spans, pa.string()), pa.array(plus, pa.int64())],
            names=["kf", "kr", "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])


def find_pii(docs: DataFrame) -> DataFrame:
    """Spans of personal data in every whole text, one row per document, in one pass without a shuffle.

    Columns: kf, kr, doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans
    (base and added ones), n_added. Reads `doc_id` and `text`; other columns are ignored.
    A null text counts as empty: no spans. Repeated rows are scanned once each; an empty
    table gives an empty result.
    """
    rows = keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(_scan, f"kf long, kr long, doc_id long, {counts}, base_sha256 string, spans string, n_added long")


def masked(docs: DataFrame, mask: str = "[{}]") -> DataFrame:
    """kf, kr, doc_id, text with every found span replaced by its kind; overlapping spans become one, of the first one's kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column("text").to_pylist():
                base, more = scan(text or "")
                edits, at = [], 0
                for s in sorted(base + more):
                    if s.start >= at:
                        edits.append((s.start, s.end, mask.format(KINDS[s.kind])))
                    elif s.end > at:
                        edits[-1] = (edits[-1][0], s.end, edits[-1][2])
                    at = max(at, s.end)
                out.append(None if text is None else Mapped(text, edits).text)
            yield pa.RecordBatch.from_arrays([b.column("kf"), b.column("kr"), b.column("doc_id"), pa.array(out, pa.string())],
                                             names=["kf", "kr", "doc_id", "text"])
    rows = keyed(docs, F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "kf long, kr long, doc_id long, text string")
