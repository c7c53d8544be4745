"""Find personal data in whole texts, also where it is disguised, with spans in the source text.

Base detectors look at the text as it is. Then a chain of transducers rewrites disguises
into plain characters: look-alike letters and full-width forms, invisible characters,
spelled digits, and words or brackets for "@" and ".". Each rewritten character keeps the
range of source characters that it came from, so a span found in the rewritten text maps
back to the source. Spans found in this way are added where no base span overlaps them.

Defined results: a null text is an empty text; no text yields no spans. A span is
``kind:start:end`` in code points of the source, end exclusive. Rows with equal ids stay
apart; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from wayfare.llm.words import bound_batches

KINDS = ("email", "ip", "card", "phone")

Span = tuple[int, int, int]  # start, end, index of the kind

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits fails or matches as a whole, so that none is tried again from its middle.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of local part, "@" and dotted domain, found from the "@" to avoid quadratic time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, without those that fail its test; by start, then kind."""
    spans: list[Span] = [(a, b, 0) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        # A later part of a longer chain of numbers never begins inside a match.
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            spans.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        digits = _digits(m.group()) if m.end() - m.start() < 60 else ""
        if 12 <= len(digits) <= 19 and _luhn(digits):
            spans.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            spans.append((m.start(), m.end(), 3))
    spans.sort(key=lambda s: (s[0], s[2]))
    return spans


# Letters that look like Latin ones, and their Latin forms.
_CYRILLIC = ("абсԁеԍһіјӏторԛгѕԝхуАВЕНІЈКМОРЅТХУС", "abcdeghijltopqrswxyABEHIJKMOPSTXYC")
_GREEK = ("αεικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeiknoptuxABEZHIKMNOPTYX")
_INVISIBLE = "­​‌‍⁠﻿"
_SIGNS = {"。": ".", "․": ".", "﹒": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "﹣": "-", "﹫": "@", " ": " ", " ": " ", " ": " "}
_DIGIT_WORDS = {
    "0": "zero oh null nul cero",
    "1": "one eins un uno",
    "2": "two zwei deux dos",
    "3": "three drei trois tres",
    "4": "four vier quatre cuatro",
    "5": "five fünf cinq cinco",
    "6": "six sechs seis",
    "7": "seven sieben sept siete",
    "8": "eight acht huit ocho",
    "9": "nine neun neuf nueve",
}
_SPELLED = {word: digit for digit, words in _DIGIT_WORDS.items() for word in words.split()}

# Letters beyond ASCII that patterns without case take for ASCII ones.
_FOLDED = {0x130: "i", 0x131: "i", 0x17F: "s", 0x212A: "k"}


def _single_characters() -> dict[int, str]:
    table = {ord(a): b for letters, plain in (_CYRILLIC, _GREEK) for a, b in zip(letters, plain, strict=True)}
    table |= {0xFF01 + i: chr(0x21 + i) for i in range(94)}  # full-width forms
    table |= {0x0660 + i: str(i) for i in range(10)} | {0x06F0 + i: str(i) for i in range(10)}
    table |= {0x1D7CE + i: str(i % 10) for i in range(50)}  # mathematical digits
    return table | {ord(a): b for a, b in _SIGNS.items()} | {ord(a): "" for a in _INVISIBLE}


_SINGLE = _single_characters()
_SINGLE_SEARCH = re.compile("[" + re.escape("".join(map(chr, _SINGLE))) + "]")
_NUMBER_WORD = "(?:" + "|".join(sorted(_SPELLED, key=len, reverse=True)) + ")"
# At least three spelled digits in a row, or one beside a figure that is part of a number.
_SPELLED_RUN = re.compile(rf"\b{_NUMBER_WORD}(?:[ ,.-]{{1,2}}(?:{_NUMBER_WORD}|[0-9]+))+\b", re.IGNORECASE)
_SPELLED_WORD = re.compile(rf"\b{_NUMBER_WORD}\b", re.IGNORECASE)
_AT_SIGN = re.compile(r"\s{0,3}[\[({<]\s{0,2}(?:at|arroba|arobase|@)\s{0,2}[\])}>]\s{0,3}|\s{1,3}(?:AT|arroba|arobase)\s{1,3}|(?<=\w)\s{1,2}@\s{0,2}(?=\w)|(?<=\w)@\s{1,2}(?=\w)", re.IGNORECASE)
_DOT_SIGN = re.compile(r"\s{0,3}[\[({<]\s{0,2}(?:dot|punkt|punto|point|\.)\s{0,2}[\])}>]\s{0,3}|\s{1,3}(?:dot|punkt|punto|point)\s{1,3}|(?<=\w)\s\.\s(?=\w)", re.IGNORECASE)
# Names around a disguised "@" are read label by label, so that the plain words "at" and "dot"
# count in an address only and neither labels nor their number have a limit.
_NAME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_%+-")
_LABEL = re.compile(r"[A-Za-z0-9-]+")
_AT = re.compile(rf"{_AT_SIGN.pattern}|@", re.IGNORECASE)
_DOT = rf"(?:{_DOT_SIGN.pattern}|\.)"
_ANY_DOT = re.compile(_DOT, re.IGNORECASE)
_NUMBERED = re.compile(rf"[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])", re.IGNORECASE)
_PLUS = re.compile(r"\b(?:plus|más)\s{1,2}(?=[0-9(])", re.IGNORECASE)
# Any match of _AT_SIGN or _DOT_SIGN holds a match of one of these, but for the plain word
# "at", which counts only before a disguised ".".
_BRACKETED = re.compile(r"[\[({<]\s{0,2}(?:at|arroba|arobase|@|dot|punkt|punto|point|\.)\s{0,2}[\])}>]", re.IGNORECASE)
_APART = re.compile(r"\s(?:dot|punkt|punto|point|arroba|arobase)\s", re.IGNORECASE)
_SPACED_AT = re.compile(r"\s@|@\s")
_SPACED_DOT = re.compile(r"\s\.\s")


class Rewritten:
    """A text after some rewriting steps, with the source range of each of its characters.

    ``pieces`` are (start in this text, start in the source, step): inside a piece
    characters map one by one (step 1), or all to one source range (step 0).
    """

    def __init__(self, text: str):
        self.text, self.source = text, text
        self._here, self._there, self._end = [0], [0], [None]

    def _range(self, i: int) -> tuple[int, int]:
        k = bisect_right(self._here, i) - 1
        if self._end[k] is None:
            at = self._there[k] + i - self._here[k]
            return at, at + 1
        return self._there[k], self._end[k]

    def to_source(self, start: int, end: int) -> tuple[int, int]:
        """The source range of the characters from ``start`` to ``end``."""
        return self._range(start)[0], self._range(end - 1)[1]

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply edits (start, end, new text), which are in order and do not overlap."""
        if not edits:
            return
        out, here, there, ends, done, length = [], [], [], [], 0, 0

        def keep(start: int, end: int) -> None:
            nonlocal length
            k, at = bisect_right(self._here, start) - 1, start
            while at < end:
                until = min(end, self._here[k + 1] if k + 1 < len(self._here) else end)
                here.append(length + at - start)
                there.append(self._there[k] + (at - self._here[k] if self._end[k] is None else 0))
                ends.append(self._end[k])
                at, k = until, k + 1
            out.append(self.text[start:end])
            length += end - start

        for start, end, new in edits:
            if done < start:
                keep(done, start)
            if new:
                first, last = self.to_source(start, end)
                here.append(length)
                there.append(first)
                ends.append(last)
                out.append(new)
                length += len(new)
            done = end
        if done < len(self.text):
            keep(done, len(self.text))
        self.text, self._here, self._there, self._end = "".join(out), here or [0], there or [0], ends or [None]


def _plain_characters(state: Rewritten) -> None:
    state.replace([(m.start(), m.end(), _SINGLE[ord(m.group())]) for m in _SINGLE_SEARCH.finditer(state.text)])


def _spelled_edits(text: str) -> list[tuple[int, int, str]]:
    """Runs of three or more spelled digits become figures; separators between two of them go."""
    edits: list[tuple[int, int, str]] = []
    for run in _SPELLED_RUN.finditer(text):
        words = list(_SPELLED_WORD.finditer(text, run.start(), run.end()))
        beside = re.search(r"[0-9]", run.group()) or re.search(r"[0-9+][ -]?\Z", text[max(0, run.start() - 2) : run.start()])
        if len(words) < 3 and not beside:
            continue
        last = None
        for m in words:
            digit = _SPELLED[m.group().translate(_FOLDED).lower()]
            between = text[last : m.start()] if last is not None else None
            if between is not None and re.fullmatch(r"[ ,-]{1,2}", between):
                edits[-1] = (edits[-1][0], m.end(), edits[-1][2] + digit)
            else:
                edits.append((m.start(), m.end(), digit))
            last = m.end()
    return edits


def _spelled_digits(state: Rewritten) -> None:
    state.replace(_spelled_edits(state.text))


def _addresses(text: str):
    """Each "@", plain or disguised, with names around it: (its match, the dots before it, the dots behind it).

    A linear scan: names are read to the left up to the address before, and to the right.
    What stands behind the "@" has a dot and ends with a label of two characters or more.
    """
    dots = list(_ANY_DOT.finditer(text))
    ending, beginning = {d.end(): d for d in dots}, {d.start(): d for d in dots}
    done = 0
    for at in _AT.finditer(text):
        start, before = at.start(), []
        while True:
            name = start
            while name > done and text[name - 1] in _NAME:
                name -= 1
            if name == start:
                break
            start, dot = name, ending.get(name)
            if dot is None or dot.start() <= done or text[dot.start() - 1] not in _NAME:
                break
            before.append(dot)
            start = dot.start()
        if start == at.start():
            continue
        label = _LABEL.match(text, at.end())
        behind, ends = [], []
        while label is not None:
            ends.append((label.end(), label.end() - label.start()))
            dot = beginning.get(label.end())
            label = _LABEL.match(text, dot.end()) if dot is not None else None
            if label is not None:
                behind.append(dot)
        while len(ends) > 1 and ends[-1][1] < 2:
            ends.pop()
            behind.pop()
        if behind:
            done = ends[-1][0]
            yield at, before, behind


def _at_and_dot(state: Rewritten) -> None:
    """Signs for "@" and "." inside what reads as an address or an IP number become the characters."""
    edits = []
    for at, before, behind in _addresses(state.text):
        disguised = [d for d in behind if d.group() != "."]
        if re.fullmatch(r"\s+at\s+", at.group(), re.IGNORECASE) and not disguised:
            # "look at example.com": a plain word before a plain domain is no disguise.
            continue
        if at.group() != "@":
            edits.append((at.start(), at.end(), "@"))
        edits += [(d.start(), d.end(), ".") for d in [*before, *disguised] if d.group() != "."]
    covered = [(a, b) for a, b, _ in edits]
    for m in _NUMBERED.finditer(state.text):
        edits += [
            (d.start(), d.end(), ".")
            for d in _DOT_SIGN.finditer(state.text, m.start(), m.end())
            if not any(a < d.end() and d.start() < b for a, b in covered)
        ]
    state.replace(sorted(edits))


def _plus_sign(state: Rewritten) -> None:
    state.replace([(m.start(), m.end(), "+") for m in _PLUS.finditer(state.text)])


TRANSDUCERS = (_plain_characters, _spelled_digits, _plus_sign, _at_and_dot)


def _disguised(text: str) -> bool:
    """Whether any transducer could change the text: true wherever one does, as each is asked for its own signs."""
    if not text.isascii() and _SINGLE_SEARCH.search(text):
        return True
    if any(b in text for b in "[({<") and _BRACKETED.search(text):
        return True
    if "@" in text and _SPACED_AT.search(text):
        return True
    return bool(_SPACED_DOT.search(text) or _APART.search(text) or _PLUS.search(text) or _spelled_edits(text))


def all_spans(text: str, base: list[Span] | None = None) -> list[Span]:
    """Base spans, and spans of disguised identifiers that overlap none of them."""
    spans = base_spans(text) if base is None else list(base)
    if not _disguised(text):
        return spans
    state = Rewritten(text)
    for rewrite in TRANSDUCERS:
        rewrite(state)
    if state.text == text:
        return spans
    taken = sorted((a, b) for a, b, _ in spans)
    starts = [a for a, _ in taken]
    longest = max((b - a for a, b in taken), default=0)
    added = []
    for a, b, kind in base_spans(state.text):
        start, end = state.to_source(a, b)
        k = bisect_right(starts, start - longest - 1)
        while k < len(taken) and taken[k][0] < end:
            if taken[k][1] > start:
                break
            k += 1
        else:
            added.append((start, end, kind))
    return sorted(spans + added, key=lambda s: (s[0], s[2]))


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def _find(batches):
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        counts = [[] for _ in KINDS]
        found = [[] for _ in KINDS]
        digests, listed = [], []
        for value in texts:
            text = value.as_py() or ""
            base = base_spans(text)
            spans = all_spans(text, base)
            for k in range(len(KINDS)):
                counts[k].append(sum(s[2] == k for s in base))
                found[k].append(sum(s[2] == k for s in spans))
            digests.append(hashlib.sha256(spans_text(base).encode()).hexdigest())
            listed.append(spans_text(spans))
        columns = [ids, *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(listed, pa.string())]
        columns += [pa.array(c, pa.int64()) for c in found]
        names = ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", *[f"all_{k}" for k in KINDS]]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def find_personal_data(documents: DataFrame) -> DataFrame:
    """One row per document: numbers of base spans (``n_``) and of all spans (``all_``), digest, spans."""
    bound_batches(documents.sparkSession)
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    totals = ", ".join(f"all_{k} long" for k in KINDS)
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        _find, f"doc_id {kind}, {counts}, base_sha256 string, spans string, {totals}"
    )


def redact(text: str) -> str:
    """The text with each span replaced by its kind in angle brackets."""
    out, done = [], 0
    for a, b, kind in all_spans(text):
        if a >= done:
            out += [text[done:a], f"<{KINDS[kind].upper()}>"]
            done = b
    return "".join(out) + text[done:]
