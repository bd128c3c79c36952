"""Personal data in text, plain or disguised, with offsets into the source.

Detectors run on the source as it is (base spans). Then transducers rewrite a copy of the text and keep, for
every piece, where it came from: homoglyphs and wide forms become ASCII, invisible characters go, spelled
digits become digits, and "at"/"dot" disguises become signs. The same detectors run on the copy, and their
spans are mapped back to the source characters they were made from. They add to the base spans; a span that
lies inside a base span of its kind adds nothing.

Left out, as plain prose looks the same: a bare "at" before a plain domain unless the word before it reads like
a mailbox ("jane.doe at example.com" counts, "jane at example.com" does not), numbers above nine in words, and digits
spelled in other languages than the four listed.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwatch.llm.frames import add_columns, free_name

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]

# ---- detectors -------------------------------------------------------------------------------------------
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def emails(text: str) -> list[Span]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))
    return out


def ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if all(len(p) < 4 and int(p or 0) < 256 for p in (x.lstrip("0") for x in m.group().split(".")))]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 8 <= len(_DIGITS.findall(m.group())) <= 15]


DETECTORS = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def detect(text: str) -> dict[str, list[Span]]:
    digits = _DIGITS.search(text)
    return {kind: f(text) if digits or kind == "email" else [] for kind, f in DETECTORS.items()}


# ---- transducers -----------------------------------------------------------------------------------------
# Letters of other scripts that look like ASCII ones, look-alike first.
_LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ѵ": "v", "ԝ": "w", "к": "k", "г": "r", "п": "n",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X", "З": "3", "б": "6", "з": "3",
    "α": "a", "ο": "o", "ν": "v", "ρ": "p", "τ": "t", "υ": "u", "ι": "i", "κ": "k", "ε": "e", "η": "n", "χ": "x", "γ": "y", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "İ": "I", "ſ": "s", "K": "K", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "։": ":", "․": ".", "。": ".", "｡": ".", "‧": ".", "∙": ".",
}
_ODD = re.compile("[^\x00-ɏḀ-ỿ‘-‟…€]|[ ­²³¹ıİſ]")
_HIDDEN = {"Cf", "Mn"}
# The words of the digits 0 to 9 in four languages.
_DIGIT_WORDS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "zwo": "2", "drei": "3", "vier": "4", "fünf": "5", "fuenf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "oh": "0",
}
#: Letters that a case-blind pattern takes for ASCII ones.
_CASE_TWINS = str.maketrans("ſıİK", "siik")
_WORDS = "|".join(sorted(_DIGIT_WORDS, key=len, reverse=True))
# A spelled number: digit words, perhaps with digits among them, at least two words in all.
_SPELLED_ONE = re.compile(rf"(?<![^\W_])(?:{_WORDS})(?![^\W_])", re.I)
_SPELLED = re.compile(rf"(?<![^\W_])(?:{_WORDS}|[0-9]+)(?:[ ,\t_-]{{1,3}}(?:{_WORDS}|[0-9]+)(?![^\W_]))+", re.I)
# A single digit word as a part of a dotted number.
_SPELLED_PART = re.compile(rf"(?:(?<=[0-9]\.)|(?<![^\W_])(?=\w+\.(?:[0-9]|{_WORDS}))|(?<=\.)(?=\w+(?:\.|\Z|\W)))({_WORDS})(?![^\W_])", re.I)
# A disguised number has one of these words, a disguised address one of those; looking for plain strings is fast.
_HINTS = tuple(sorted({w for w in _DIGIT_WORDS if not any(v != w and v in w for v in _DIGIT_WORDS)}))
_DOT_HINTS = ("dot", "punkt", "point", "punto")
_AT_HINTS = ("at ", "at\t", "at_", "at-", "arroba", "arobase", "klammeraffe")
_AT = r"(?:at|ät|arroba|arobase|klammeraffe|@)"
_DOT = r"(?:dot|punkt|point|punto|\.)"
_BLANKS = r"(?:(?<![ \t])[ \t]++)?"  # a whole run or nothing, so that long runs are read once
_BRACKETED_AT = re.compile(rf"{_BLANKS}[\[({{<]{{1,2}}[ \t]*{_AT}[ \t]*[\])}}>]{{1,2}}[ \t]*", re.I)
_BRACKETED_DOT = re.compile(rf"{_BLANKS}[\[({{<]{{1,2}}[ \t]*{_DOT}[ \t]*[\])}}>]{{1,2}}[ \t]*", re.I)
_BARE_DOT = re.compile(r"(?<=[A-Za-z0-9])(?:[ \t]+(?:dot|punkt|point|punto)[ \t]+|[_-](?:dot|punkt|punto)[_-])(?=[A-Za-z0-9])", re.I)
_BARE_AT = re.compile(r"(?<=[A-Za-z0-9])(?:[ \t]+(?:at|arroba|arobase|klammeraffe)[ \t]+|[_-]at[_-]|[ \t]+@[ \t]*|@[ \t]+)(?=[A-Za-z0-9-]+\.[A-Za-z0-9])", re.I)
# Before a bare "at", what reads like the name of a mailbox: parts joined by a dot, a line or a sign, or letters and digits.
_MAILBOX = re.compile(r"(?:[A-Za-z][A-Za-z0-9]*[._+-])+[A-Za-z0-9]+|[A-Za-z]+[0-9]+")
# Top-level names that a bare "at" needs in its domain.
_TOP_LEVEL = frozenset("com org net edu gov mil int info biz name io co ai app dev me eu uk de fr es it nl be ch at pl pt se no dk fi ie us ca au nz br mx ar jp cn in ru".split())
_PLUS = re.compile(r"(?<![^\W_])(?:plus|más|mas)[ \t]+(?=[0-9])", re.I)
# Letters that stand for digits inside long numbers: next to a digit, or a whole part of a dotted number.
_DIGIT_LIKE = re.compile(r"(?<![A-Za-z0-9.])[0-9OoIl](?:[ .-]?[0-9OoIl]){6,30}(?![A-Za-z0-9])")
_DIGIT_PART = re.compile(r"(?<=\.)[OoIl]+(?![0-9OoIl])|[OoIl]+(?=\.)|[0-9OoIl]*[0-9][0-9OoIl]*")
_AS_DIGIT = str.maketrans("OoIl", "0011")


def _digit(word: str) -> str:
    return _DIGIT_WORDS.get(word.translate(_CASE_TWINS).lower(), word)


def _mailbox_before(text: str, end: int) -> bool:
    start = end
    while start > 0 and end - start < 64 and text[start - 1] in _LOCAL:  # the longest that mail allows
        start -= 1
    return _MAILBOX.fullmatch(text, start, end) is not None


@lru_cache(maxsize=65536)
def plain_letter(c: str) -> str:
    """ASCII form of a character that looks like ASCII, "" for an invisible one, else the character."""
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    kind = unicodedata.category(c)
    if kind in _HIDDEN:
        return ""
    if kind == "Zs":
        return " "
    if kind == "Pd":
        return "-"
    if kind == "Nd":
        return str(unicodedata.digit(c))
    folded = unicodedata.normalize("NFKC", c)
    return folded if folded.isascii() and folded.isprintable() and len(folded) <= 2 else _LOOKALIKES.get(folded, c)


class Rewritten:
    """A rewritten text and, for its pieces, the source they were made from.

    Pieces are (start in the text, start in the source, source length, copied). A copied piece maps character by
    character; all characters of any other piece map to its whole source.
    """

    def __init__(self, text: str):
        self.text = text
        self.starts = [0]
        self.pieces = [(0, len(text), True)]

    def source(self, start: int, end: int) -> Span:
        return self._edge(start)[0], self._edge(end - 1)[1]

    def _edge(self, i: int) -> Span:
        k = bisect_right(self.starts, i) - 1
        at, size, copied = self.pieces[k]
        if copied:
            return at + i - self.starts[k], at + i - self.starts[k] + 1
        return at, at + size

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """edits: (start, end, new text) in order, apart from one another."""
        if not edits:
            return
        parts, starts, pieces, size, done = [], [], [], 0, 0

        def keep(lo: int, hi: int) -> None:
            nonlocal size
            if lo >= hi:
                return
            parts.append(self.text[lo:hi])
            k = bisect_right(self.starts, lo) - 1
            while lo < hi:
                at, n, copied = self.pieces[k]
                stop = min(hi, self.starts[k + 1] if k + 1 < len(self.starts) else len(self.text))
                starts.append(size)
                pieces.append((at + lo - self.starts[k], stop - lo, True) if copied else (at, n, False))
                size += stop - lo
                lo, k = stop, k + 1

        for start, end, new in edits:
            keep(done, start)
            if new:
                lo, hi = self.source(start, end)
                parts.append(new)
                starts.append(size)
                pieces.append((lo, hi - lo, False))
                size += len(new)
            done = end
        keep(done, len(self.text))
        self.text, self.starts, self.pieces = "".join(parts), starts or [0], pieces or [(0, 0, True)]


def normalise(text: str) -> Rewritten | None:
    """The text with its disguises undone, or None if there are none."""
    out = Rewritten(text)
    if not text.isascii():
        out.replace([(m.start(), m.end(), new) for m in _ODD.finditer(text) if (new := plain_letter(m.group())) != m.group()])
    lower = out.text.lower()
    if any(w in lower for w in _HINTS):
        edits = []
        for m in _SPELLED.finditer(out.text):
            if _SPELLED_ONE.search(m.group()):
                edits.append((m.start(), m.end(), re.sub(r"[ ,\t_-]", "", _SPELLED_ONE.sub(lambda w: _digit(w.group()), m.group()))))
        out.replace(edits)
        out.replace([(m.start(), m.end(), "+") for m in _PLUS.finditer(out.text)])
    if _DIGITS.search(out.text):
        edits = []
        for m in _DIGIT_LIKE.finditer(out.text):
            if 2 * len(_DIGITS.findall(m.group())) > len(m.group()):
                new = _DIGIT_PART.sub(lambda w: w.group().translate(_AS_DIGIT), m.group())
                edits += [(m.start() + i, m.start() + i + 1, new[i]) for i in range(len(new)) if new[i] != out.text[m.start() + i]]
        out.replace(edits)
    spelled = any(w in lower for w in _DOT_HINTS) or "[" in lower or "(" in lower or "{" in lower or "<" in lower
    if spelled:
        out.replace([(m.start(), m.end(), ".") for m in _BRACKETED_DOT.finditer(out.text)])
        out.replace([(m.start(), m.end(), ".") for m in _BARE_DOT.finditer(out.text)])
        out.replace([(m.start(), m.end(), _digit(m.group(1))) for m in _SPELLED_PART.finditer(out.text)])
    if any(c in out.text for c in "[({<"):
        out.replace([(m.start(), m.end(), "@") for m in _BRACKETED_AT.finditer(out.text)])
    if "@" in out.text or any(w in lower for w in _AT_HINTS):
        # A bare "at" counts before a domain with a disguised dot, and between a mailbox name and a domain of a
        # common top-level name; a spaced "@" before any domain.
        edits = []
        for m in _BARE_AT.finditer(out.text):
            domain = _DOMAIN.match(out.text, m.end())
            if "@" in m.group() or domain and any(not p[2] for p in out.pieces[bisect_right(out.starts, m.end()) - 1 : bisect_right(out.starts, domain.end() - 1)]):
                edits.append((m.start(), m.end(), "@"))
            elif domain and domain.group().rpartition(".")[2].lower() in _TOP_LEVEL and _mailbox_before(out.text, m.start()):
                edits.append((m.start(), m.end(), "@"))
        out.replace(edits)
    return None if out.text == text else out


def find(text: str) -> tuple[dict[str, list[Span]], dict[str, list[Span]]]:
    """Base spans, and all spans, by kind in the order of their starts."""
    base = detect(text)
    changed = normalise(text)
    if changed is None:
        return base, base
    every = {}
    for kind, spans in detect(changed.text).items():
        own = set(base[kind])
        starts = [s for s, _ in base[kind]]
        for s, e in spans:
            lo, hi = changed.source(s, e)
            k = bisect_right(starts, lo) - 1  # base spans of a kind do not overlap
            if k < 0 or hi > base[kind][k][1]:
                own.add((lo, hi))
        every[kind] = sorted(own)
    return base, every


def spans_text(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind in KINDS for s, e in spans[kind])


def redact(text: str, spans: dict[str, list[Span]]) -> str:
    """Each span, or joined spans, replaced by the kind in angle brackets; the kind that starts first names it."""
    found = sorted((s, -e, kind) for kind in KINDS for s, e in spans[kind])
    out, done, i = [], 0, 0
    while i < len(found):
        start, end, kind = found[i][0], -found[i][1], found[i][2]
        while i + 1 < len(found) and found[i + 1][0] < end:
            i += 1
            end = max(end, -found[i][1])
        out += [text[done:start], f"<{kind.upper()}>"]
        done, i = end, i + 1
    return "".join(out) + text[done:]


FOUND = "n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string, n_added long"


def find_personal_data(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, redacted: bool = False) -> DataFrame:
    """``docs`` with n_email, n_ip, n_card, n_phone (base spans), base_spans, spans, n_added[, redacted_text].

    spans are kind:start:end in code points, end exclusive, by kind and start, comma-joined. Null text counts as
    empty and has no spans; redacted_text of a null text is null. Each row is judged on its own, so repeated
    rows and ids do no harm; ``keep`` names the columns to carry along, and one named like a new column gives way.
    """

    def compute(column: pa.Array) -> list[pa.Array]:
        counts: list[list[int]] = [[] for _ in KINDS]
        first, every, added, clean = [], [], [], []
        for text in column.to_pylist():
            base, spans = find(text or "")
            for c, kind in zip(counts, KINDS):
                c.append(len(base[kind]))
            first.append(spans_text(base))
            every.append(spans_text(spans))
            added.append(sum(len(spans[k]) - len(base[k]) for k in KINDS))
            if redacted:
                clean.append(text and redact(text, spans))
        long = [pa.array(c, pa.int64()) for c in counts]
        return [*long, pa.array(first, pa.string()), pa.array(every, pa.string()), pa.array(added, pa.int64())] + [pa.array(clean, pa.string())] * redacted

    return add_columns(docs, text_col, keep, FOUND + ", redacted_text string" * redacted, compute)


def redact_personal_data(docs: DataFrame, text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with its own columns, whatever their names, and all spans in the text replaced.

    size_col, if there, tells the new length. A null text stays null, an empty one empty; an empty table gives none.
    """

    def compute(column: pa.Array) -> list[pa.Array]:
        return [pa.array([text and redact(text, find(text)[1]) for text in column.to_pylist()], pa.string())]

    redacted = free_name("redacted_text", docs.columns)
    found = add_columns(docs, text_col, None, f"{redacted} string", compute)
    new = {text_col: F.col(redacted)}
    if size_col in docs.columns:
        new[size_col] = F.length(redacted).cast(docs.schema[size_col].dataType)
    return found.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])
