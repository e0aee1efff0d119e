"""Personal data with offset-preserving deobfuscation.

Base detectors find e-mail addresses, IP addresses, payment cards and phone numbers in the text
as it stands. Then transducers rewrite disguises - homoglyphs and invisible characters, spelled
digits and signs, at/dot disguises - and carry for each character they put out the source span
it came from. The same detectors read the rewritten text; what they find there is mapped back
to source characters and added where no base span of that kind overlaps it. A second reading
joins figures to spelled digits and takes a bare "at" before a plain domain; it adds spans only
where the first has none.

Detectors run in linear time on any text: e-mail addresses are found from their @ outwards, and
runs of digits are entered at their first digit only. A text without any trigger of a disguise
is not given to the detectors again.

Null and empty texts have no spans. Rows that share an id are separate documents. Offsets count
code points, ends are exclusive. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
#: What every match of IP holds; it is found much faster.
IP_CORE = re.compile(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[Span]:
    """All base spans, by kind and then by place."""
    out = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text) if IP_CORE.search(text) else ():
        if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() < 40:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= sum(x.isdigit() for x in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


# ---------------------------------------------------------------- transducers

#: Letters of other scripts that look like ASCII ones.
LOOKALIKES = {
    "А": "A", "а": "a", "В": "B", "С": "C", "с": "c", "Е": "E", "е": "e", "Н": "H", "І": "I", "і": "i", "Ј": "J", "ј": "j",
    "К": "K", "М": "M", "О": "O", "о": "o", "Р": "P", "р": "p", "Ѕ": "S", "ѕ": "s", "Т": "T", "Х": "X", "х": "x", "У": "Y", "у": "y",
    "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N",
    "Ο": "O", "ο": "o", "Ρ": "P", "ρ": "p", "Τ": "T", "Υ": "Y", "Χ": "X", "ν": "v", "ı": "i", "ɑ": "a", "ɡ": "g",
}
#: Signs that look like ASCII ones.
SIGNS = {
    "\uff20": "@", "\ufe6b": "@", "\uff0e": ".", "\u3002": ".", "\u2024": ".", "\uff61": ".", "\uff0b": "+", "\ufe62": "+",
    "\u2010": "-", "\u2011": "-", "\u2012": "-", "\u2013": "-", "\u2212": "-", "\uff0d": "-", "\uff3f": "_", "\uff05": "%",
    "\uff08": "(", "\uff09": ")", "\u00a0": " ", "\u2007": " ", "\u202f": " ", "\u3000": " ",
}
#: Soft hyphen, zero-width space, joiners, word joiner, byte order mark.
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
DOTS = "dot|punkt|point|punto"
ATS = "at|arobase|arroba|klammeraffe"


def glyphs() -> dict[str, str]:
    """One character's ASCII reading: lookalikes, signs, and whatever compatibility forms decompose to one ASCII letter or digit."""
    out = LOOKALIKES | SIGNS | dict.fromkeys(INVISIBLE, "")
    blocks = [*range(0xFF01, 0xFF5F), *range(0x2460, 0x249C), *range(0x24B6, 0x24EB), *range(0x1D400, 0x1D800), *range(0x2070, 0x208A), *range(0x2102, 0x2139), *range(0x660, 0x66A), *range(0x6F0, 0x6FA), *range(0x966, 0x970)]
    for code in blocks:
        ch = chr(code)
        if ch in out:
            continue
        plain = unicodedata.normalize("NFKC", ch)
        digit = unicodedata.digit(ch, None)
        if digit is not None:
            out[ch] = str(digit)
        elif len(plain) == 1 and plain.isascii() and plain.isprintable():
            out[ch] = plain
    return out


GLYPHS = glyphs()
GLYPH_SET = frozenset(GLYPHS)
NUMERAL = "|".join(sorted(SPELLED, key=len, reverse=True))
#: At least four spelled digits on end, perhaps with signs and figures between them.
NUMBER = re.compile(rf"(?<!\w)(?:(?:plus|\+)[ ]*)?(?:(?:{NUMERAL})(?!\w)(?:[ .,()-]|{DOTS}|dash|hyphen|[0-9])*){{3,}}(?:{NUMERAL})(?!\w)", re.I)
IN_NUMBER = re.compile(rf"(?P<digit>(?<!\w)(?:{NUMERAL})(?!\w))|(?P<dot>[ ]*(?<!\w)(?:{DOTS})(?!\w)[ ]*)|(?P<dash>[ ]*(?<!\w)(?:dash|hyphen)(?!\w)[ ]*)|(?P<plus>plus[ ]*)|(?P<gap>(?<=\w)[ ,]+(?=(?:{NUMERAL})(?!\w)))", re.I)
#: Spelled digits and figures in one run; `_mixed_numbers` asks for both, and four digits in all.
MIXED_NUMBER = re.compile(rf"(?<!\w)(?:(?:plus|\+)[ ]*)?(?:(?<!\w)(?:{NUMERAL})(?!\w)|[0-9]+)(?:(?:[ .,()-]|{DOTS}|dash|hyphen)*(?:(?<!\w)(?:{NUMERAL})(?!\w)|[0-9]+))*", re.I)
OPEN, SHUT = r"[(\[{<]", r"[)\]}>]"
#: An at sign in brackets; as a word where a domain with a disguised dot follows; or with space after it.
AT = re.compile(
    rf"\s{{0,3}}{OPEN}\s?(?:{ATS}|@)\s?{SHUT}\s{{0,3}}"
    rf"|(?<=[A-Za-z0-9])\s{{1,3}}(?:{ATS})\s{{1,3}}(?=[A-Za-z0-9-]+(?:\s{{0,3}}{OPEN}\s?(?:{DOTS}|\.)\s?{SHUT}|\s{{1,3}}(?:{DOTS})\s)\s{{0,3}}(?!(?:{DOTS})\b)[A-Za-z0-9])"
    rf"|(?<=[A-Za-z0-9])\s{{0,3}}@\s{{1,3}}(?=[A-Za-z0-9-]+\.[A-Za-z0-9])",
    re.I,
)
DOT = re.compile(rf"\s{{0,3}}{OPEN}\s?(?:{DOTS}|\.)\s?{SHUT}\s{{0,3}}|(?<=[A-Za-z0-9])\s{{1,3}}(?:{DOTS})\s{{1,3}}(?=[A-Za-z0-9])", re.I)
#: The word before a plain dotted domain, and what in front of it says that an address is meant (else the local part must).
PLAIN_AT = re.compile(rf"(?<=[A-Za-z0-9])\s{{1,3}}(?:{ATS})\s{{1,3}}(?=(?:[A-Za-z0-9-]+\.)+[A-Za-z]{{2,}}(?![A-Za-z0-9]))", re.I)
CUE = re.compile(r"\b(?:e-?mail|mail|contact|address|correo|adresse|courriel)\b\W{0,3}(?:\w{1,5}\W{1,3}){0,2}$", re.I)
#: A letter that stands for a digit between digits.
DIGIT_LETTER = re.compile(r"(?<=[0-9])[OoIl](?=[0-9])")
#: Triggers, each quick to search for: a sign in brackets, space after an @, a letter between digits.
BRACKETED = re.compile(rf"{OPEN}\s?(?:{ATS}|@|{DOTS}|\.)\s?{SHUT}", re.I)
LOOSE_AT = re.compile(r"@\s{1,3}[A-Za-z0-9-]")
MIXED = re.compile(r"[0-9][OoIl][0-9]")
#: ASCII letters and all bytes of longer characters stay, anything else parts words.
LETTERS = bytes(b if b > 127 or chr(b).isalpha() else 32 for b in range(256))
#: The same, with figures kept.
LETTERS_FIGURES = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))
DIGIT_WORDS = frozenset(w.encode() for w in SPELLED)
DOT_WORDS = frozenset(w.encode() for w in DOTS.split("|"))
BETWEEN = DOT_WORDS | {b"plus", b"dash", b"hyphen"}


def _word_triggers(text: str) -> tuple[bool, bool]:
    """Whether the words hold a spelled dot, and whether four spelled digits stand together."""
    words = text.lower().encode("utf-8", "replace").translate(LETTERS).split()
    dot = not DOT_WORDS.isdisjoint(words)
    if DIGIT_WORDS.isdisjoint(words):
        return dot, False
    places = [i for i, w in enumerate(words) if w in DIGIT_WORDS]
    if len(places) < 4:
        return dot, False
    run = 1
    for a, b in zip(places, places[1:], strict=False):
        run = run + 1 if b - a == 1 or all(w in BETWEEN for w in words[a + 1 : b]) else 1
        if run == 4:
            return dot, True
    return dot, False


class Tape:
    """A rewritten text; piece by piece it knows where in the source it came from (two small integers a character)."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts = np.arange(len(text), dtype=np.int32)
        self.ends = self.starts + 1

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces spans, which are in order and apart; what is put out comes from the whole span."""
        if not edits:
            return
        text, last = [], 0
        for a, b, new in edits:
            text += [self.text[last:a], new]
            last = b
        n = np.fromiter((len(x) for _, _, x in edits), np.int64, len(edits))
        begin, end = (np.fromiter((e[i] for e in edits), np.int64, len(edits)) for i in (0, 1))
        # what stays, with each edit's own characters where it begins
        keep = np.ones(len(self.text) + 1, bool)
        keep[:-1] = np.cumsum(np.bincount(begin, minlength=len(keep)) - np.bincount(end, minlength=len(keep)))[:-1] == 0
        kept = np.flatnonzero(keep[:-1])
        at = np.searchsorted(kept, np.repeat(begin, n))
        self.text = "".join([*text, self.text[last:]])
        self.starts = np.insert(self.starts[kept], at, np.repeat(self.starts[begin], n))
        self.ends = np.insert(self.ends[kept], at, np.repeat(self.ends[end - 1], n))


def _numerals(text: str, a: int, b: int) -> list[tuple[int, int, str]]:
    signs = {"dot": ".", "dash": "-", "plus": "+", "gap": ""}
    return [(*m.span(), SPELLED[m[0].lower()] if m.lastgroup == "digit" else signs[m.lastgroup]) for m in IN_NUMBER.finditer(text, a, b)]


def _numbers(text: str) -> list[tuple[int, int, str]]:
    out = []
    for run in NUMBER.finditer(text):
        out += _numerals(text, *run.span())
    return out


def _beside_figures(text: str) -> bool:
    """Whether a spelled digit stands next to figures, with nothing but signs between."""
    words = text.lower().encode("utf-8", "replace").translate(LETTERS_FIGURES).split()
    if DIGIT_WORDS.isdisjoint(words):
        return False
    words = [w for w in words if w not in BETWEEN]
    return any((w in DIGIT_WORDS and v[:1].isdigit()) or (v in DIGIT_WORDS and w[-1:].isdigit()) for w, v in zip(words, words[1:], strict=False))


def _mixed_numbers(text: str) -> list[tuple[int, int, str]]:
    out = []
    if not _beside_figures(text):
        return out
    for run in MIXED_NUMBER.finditer(text):
        spelled = [m for m in IN_NUMBER.finditer(text, *run.span()) if m.lastgroup == "digit"]
        figures = sum(x.isdigit() for x in run[0])
        if spelled and figures and len(spelled) + figures >= 4:
            out += _numerals(text, *run.span())
    return out


def _plain_ats(text: str) -> list[tuple[int, int, str]]:
    """The word at between a local part that looks like one, or that a cue announces, and a plain domain."""
    out = []
    for m in PLAIN_AT.finditer(text):
        start = m.start()
        while start > 0 and text[start - 1] in LOCAL:
            start -= 1
        local = text[start : m.start()]
        marked = local[0].isalpha() and not local.isalpha()
        if marked or CUE.search(text[max(0, start - 40) : start]):
            out.append((*m.span(), "@"))
    return out


def widened(text: str) -> Tape | None:
    """A second reading, which joins figures to spelled digits and takes a plain at; None if there is nothing of both."""
    edited = False
    out = Tape(text)
    if not text.isascii() and not GLYPH_SET.isdisjoint(text):
        out.rewrite([(i, i + 1, GLYPHS[ch]) for i, ch in enumerate(text) if ch in GLYPH_SET])
    for rule in (_mixed_numbers, _plain_ats):
        edits = rule(out.text)
        out.rewrite(edits)
        edited = edited or bool(edits)
    if not edited:
        return None
    out.rewrite([(*m.span(), ".") for m in DOT.finditer(out.text)])
    return out


def normalised(text: str) -> Tape | None:
    """The text after all transducers; None if none of them has anything to rewrite."""
    odd = not text.isascii() and not GLYPH_SET.isdisjoint(text)
    dot, number = _word_triggers(text)
    if not (odd or dot or number or BRACKETED.search(text) or LOOSE_AT.search(text) or MIXED.search(text)):
        return None
    tape = Tape(text)
    if odd:
        tape.rewrite([(i, i + 1, GLYPHS[ch]) for i, ch in enumerate(text) if ch in GLYPH_SET])
    if number or odd:
        tape.rewrite(_numbers(tape.text))
    tape.rewrite([(*m.span(), "@") for m in AT.finditer(tape.text)])
    tape.rewrite([(*m.span(), ".") for m in DOT.finditer(tape.text)])
    tape.rewrite([(*m.span(), "0" if m[0] in "Oo" else "1") for m in DIGIT_LETTER.finditer(tape.text)])
    return tape


def all_spans(text: str, base: list[Span]) -> list[Span]:
    """Base spans and those that only the normalised text shows, by kind and then by place."""
    out = base
    for reading in (normalised(text), widened(text)):
        if reading is not None:
            out = _added(out, reading)
    return out


def _added(base: list[Span], tape: Tape) -> list[Span]:
    held: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    for k, a, b in base:
        held[k].append((a, b))
    more: list[Span] = []
    for k, a, b in base_spans(tape.text):
        a, b = int(tape.starts[a]), int(tape.ends[b - 1])
        i = bisect_right(held[k], (a, a))
        near = held[k][max(0, i - 1) : i + 1]
        if not any(x < b and a < y for x, y in near):
            more.append((k, a, b))
    return sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1])) if more else base


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_spans"]
    for batch in batches:
        rows = []
        for text in batch.column(1):
            text = text.as_py() or ""
            base = base_spans(text)
            kinds = [k for k, _, _ in base]
            found = all_spans(text, base)
            rows.append((*(kinds.count(k) for k in KINDS), hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(found), len(found)))
        cols = [pa.array([r[i] for r in rows], pa.string() if i in (4, 5) else pa.int64()) for i in range(7)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names)
    c.release()


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_email, n_ip, n_card, n_phone (base spans),
    base_sha256, spans (all spans as kind:start:end), n_spans (how many)."""
    rows = c.bounded(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_report, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long")


def masked_text(text: str | None) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by its kind in brackets."""
    if not text:
        return text
    spans = sorted(((a, b, k) for k, a, b in all_spans(text, base_spans(text))), key=lambda s: (s[0], -s[1]))
    if not spans:
        return text
    out, last = [], 0
    for a, b, k in spans:
        if a >= last:
            out += [text[last:a], f"[{k.upper()}]"]
        last = max(last, b)
    return "".join([*out, text[last:]])


def masked_documents(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """docs with personal data masked in the text; a column of the text's size follows it."""
    at = docs.columns.index(text_col)
    size = docs.columns.index(size_col) if size_col in docs.columns else -1

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols, old = list(batch.columns), batch.column(at).to_pylist()
            new = [masked_text(t) for t in old]
            cols[at] = pa.array(new, cols[at].type)
            if size >= 0:
                sizes = batch.column(size).to_pylist()
                cols[size] = pa.array([s if a == b else len(b or "") for s, a, b in zip(sizes, old, new, strict=True)], cols[size].type)
            yield pa.RecordBatch.from_arrays(cols, batch.schema.names)
        c.release()

    return c.bounded(docs).mapInArrow(mask, docs.schema)
