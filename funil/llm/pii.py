"""Personal data in plain and in disguise: detection on a normalised text, spans in the source text."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from funil.llm import batches as B
from funil.llm.top_level_domains import TOP_LEVEL_DOMAINS

KINDS = ("email", "ip", "card", "phone")

# Letters of other scripts that look like Latin ones, in their order.
LOOKALIKES = dict(zip(
    "АВЕЅІЈКМНОРСТУХабвеѕіјкмнорстухһԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧαιοκνρτυχ",
    "ABESIJKMHOPCTYXabBesijkmhopctyxhdqwABEZHIKMNOPTYXaiokvptux",
))
# Characters without width.
INVISIBLE = "­​‌‍⁠﻿"
# The digits 0 to 9 as words.
DIGIT_WORDS = (
    "zero one two three four five six seven eight nine",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
DIGITS = {word: str(n) for words in DIGIT_WORDS for n, word in enumerate(words.split())} | {"oh": "0"}
# Words that stand before the noun "dot", as in "look at the dot in the middle".
DETERMINERS = frozenset("a an the this that each every".split())
# Words after which "at" and a spoken domain are prose, as in "we looked at example dot com".
BEFORE_AT = frozenset("""
look looks looked looking stare staring glance work works worked working stay stays stayed staying meet meets met meeting
arrive arrives arrived shop shopped shopping buy bought order ordered found find available hosted sold visit visited
me us them him her it you here there be is are was were been site website page pages blog store online read
""".split())
# Numbers of more than one digit as words.
TEENS = {w: n for n, w in enumerate(
    "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split(), 10)}
TENS = {w: 10 * n for n, w in enumerate("twenty thirty forty fifty sixty seventy eighty ninety".split(), 2)}
UNITS = {w: n for n, w in enumerate(DIGIT_WORDS[0].split())}
# At and dot signs as entities, and in other languages.
ENTITIES = {"&#64;": "@", "&#x40;": "@", "&commat;": "@", "&#46;": ".", "&#x2e;": ".", "&period;": "."}
SIGN_WORDS = {"arroba": "at", "punto": "dot", "punkt": "dot"}
SIGNS = {"plus": "+", "dot": ".", "point": ".", "punkt": ".", "punto": "."}

_EMAIL_END = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++").finditer
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}").finditer
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++").finditer
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]").finditer

_WORDS = "|".join(sorted([*DIGITS, *SIGNS, *TEENS, *TENS, "hundred"], key=len, reverse=True))
_SPELLED = re.compile(
    rf"(?<!\w)(?:{_WORDS}|[0-9]++)(?:(?:[\s,-]{{1,3}}|\.)(?:{_WORDS}|[0-9]++)(?!\w))*+(?!\w)", re.I
).finditer
_SPELLED_PAIR = re.compile(
    rf"\b(?:{_WORDS})(?:[\s,-]{{1,3}}|\.)(?:{_WORDS}|[0-9])|[0-9](?:[\s,-]{{1,3}}|\.)(?:{_WORDS})\b", re.I
).search
_TOKEN = re.compile(r"[^\W_]+").finditer
_BRACKETED = re.compile(r"[(\[{<][ \t]*+(?:at|dot|@|\.)|[ \t]-(?:at|dot)-[ \t]|&(?:#|commat|period)", re.I).search
_ENCLOSED = re.compile(
    r"[ \t]{0,3}(?:\([ \t]*(at|dot|@|\.)[ \t]*\)|\[[ \t]*(at|dot|@|\.)[ \t]*\]|\{[ \t]*(at|dot|@|\.)[ \t]*\}|<[ \t]*(at|dot|@|\.)[ \t]*>"
    r"|(?<=[ \t])-(at|dot)-(?=[ \t]))[ \t]{0,3}|(&(?:#64|#x40|commat|#46|#x2e|period);)", re.I
).finditer
_SIGN_WORD = re.compile(rf"(?<=[ \t])(?:{'|'.join(SIGN_WORDS)})(?=[ \t])", re.I).finditer
_SPACED_AT = re.compile(r"[ \t]{0,3}@[ \t]{0,3}").finditer
_SPACED_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:[ \t]{0,3}\.[ \t]{0,3}[A-Za-z0-9-]++)++").match
_SPACED_DOT = re.compile(r"([ \t]{0,3}\.[ \t]{0,3})([A-Za-z0-9-]+)").finditer
_JOINED = re.compile(
    r"(?<![A-Za-z0-9.+-])(?<!_)[A-Za-z0-9.+-]++(?:_[A-Za-z0-9.+-]++)*", re.I
).finditer
# Each sign in either form: spoken, or written (by the source, or for an enclosed one).  Chains are read from their heads only.
_HEAD = "".join(rf"(?<![A-Za-z0-9._%+-][ \t]{{{i}}}dot[ \t]{{{j}}})" for i in (1, 2, 3) for j in (1, 2, 3))
_SPOKEN = re.compile(
    rf"(?<![A-Za-z0-9._%+-]){_HEAD}" r"(?:[A-Za-z0-9._%+-]++[ \t]{1,3}dot[ \t]{1,3})*+[A-Za-z0-9._%+-]++(?P<at>[ \t]{1,3}at[ \t]{1,3}|@)"
    r"[A-Za-z0-9-]++(?:(?:[ \t]{1,3}dot[ \t]{1,3}|\.)[A-Za-z0-9-]++)++",
    re.I,
).finditer
_SPOKEN_DOT = re.compile(r"[ \t]{1,3}dot[ \t]{1,3}", re.I).finditer
_DOMAIN_DOT = re.compile(r"([ \t]{1,3}dot[ \t]{1,3}|\.)([A-Za-z0-9-]+)", re.I).finditer


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Local part, @ and a domain with a dot: found from the @, so that long words cost nothing."""
    end = 0
    for match in _EMAIL_END(text):
        start = match.start()
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < match.start():
            yield start, match.end()
            end = match.end()


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(doubled)) % 10 == 0


def identifiers(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every plain identifier; matches that fail a kind's test are dropped."""
    found = [("email", *span) for span in emails(text)] if "@" in text else []
    for match in _IP(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in match[0].split(".")):
            found.append(("ip", *match.span()))
    for match in _CARD(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *match.span()))
    if "+" in text:
        for match in _PHONE(text):
            if 9 <= sum("0" <= c <= "9" for c in match[0]) <= 15:
                found.append(("phone", *match.span()))
    return found


class Rewritten:
    """A text after replacements, which finds the source of any part of it."""

    def __init__(self, source: str, changes: list[tuple[int, int, str]]):
        """``changes``: (start, end, replacement), in order and apart from each other."""
        out, at, self.starts, self.changes, length = [], 0, [], [], 0
        for start, end, new in changes:
            out += [source[at:start], new]
            length += start - at
            self.starts.append(length)
            self.changes.append((length, length + len(new), start, end))
            length += len(new)
            at = end
        self.text = "".join([*out, source[at:]])

    def _change(self, index: int) -> tuple[int, int, int, int] | None:
        k = bisect_right(self.starts, index) - 1
        return self.changes[k] if k >= 0 else None

    def back(self, start: int, end: int) -> tuple[int, int]:
        """The source span of [start, end); a change counts whole."""
        spans = []
        for index in (start, end - 1):
            change = self._change(index)
            if change is None:
                spans.append((index, index + 1))
            elif index < change[1]:
                spans.append(change[2:])
            else:
                spans.append((change[3] + index - change[1], change[3] + index - change[1] + 1))
        return spans[0][0], spans[1][1]

    def touched(self, start: int, end: int) -> bool:
        """Whether a change lies in [start, end)."""
        k = bisect_left(self.starts, end) - 1  # of the changes that start before the end, the last reaches furthest
        return k >= 0 and max(self.changes[k][1], self.changes[k][0] + 1) > start


class Characters(dict):
    """str.translate table: what a single character stands for, filled as characters turn up."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        plain = "" if char in INVISIBLE else LOOKALIKES.get(char)
        if plain is None:
            digit, folded = unicodedata.digit(char, None), unicodedata.normalize("NFKC", char)
            plain = str(digit) if digit is not None and code > 0xFF else folded if folded.isascii() else char
        self[code] = plain
        return plain


_CHARACTERS = Characters()


def plain_characters(text: str) -> list[tuple[int, int, str]]:
    """Lookalikes, wide and styled forms and digits of other scripts as ASCII; invisible characters dropped."""
    if text.isascii():
        return []
    for char in set(text):
        _CHARACTERS[ord(char)]
    odd = {c for c in set(text) if ord(c) > 127 and _CHARACTERS[ord(c)] != c}
    return [(k, k + 1, _CHARACTERS[ord(c)]) for k, c in enumerate(text) if c in odd] if odd else []


def enclosed_signs(text: str) -> list[tuple[int, int, str]]:
    """At and dot signs in brackets."""
    if not _BRACKETED(text):
        return []
    signs = [(match, next(g for g in match.groups() if g).lower()) for match in _ENCLOSED(text)]
    return [(*match.span(), {"at": "@", "dot": ".", **ENTITIES}.get(sign, sign)) for match, sign in signs]


def joined_signs(text: str) -> list[tuple[int, int, str]]:
    """Signs between underscores, as in john_at_example_dot_com, where the last part is a top-level domain."""
    lower, changes = text.lower(), []
    if "_at_" not in lower or "_dot_" not in lower:
        return changes
    for match in _JOINED(text):
        parts, at = match[0].split("_"), match.start()
        words = [p.lower() for p in parts]
        if words.count("at") != 1 or words[-1] not in TOP_LEVEL_DOMAINS or len(words) < 5 or words[-2] != "dot":
            continue
        place = words.index("at")
        if not 0 < place < len(words) - 3 or any(w != "dot" for w in words[place + 2 :: 2]) or (len(words) - place) % 2:
            continue
        for k, part in enumerate(parts):
            if k == place or (words[k] == "dot" and 0 < k < len(words) - 1):
                changes.append((at - 1, at + len(part) + 1, "@" if k == place else "."))
            at += len(part) + 1
    return changes


def spaced_signs(text: str) -> list[tuple[int, int, str]]:
    """Written signs with blanks around them, up to the last top-level domain, as in john @ example . com."""
    changes = []
    if "@" not in text:
        return changes
    for match in _SPACED_AT(text):
        start, end = match.span()
        if not start or text[start - 1] not in _LOCAL_CHARS or changes and start < changes[-1][1]:
            continue
        domain = _SPACED_DOMAIN(text, end)
        dots = list(_SPACED_DOT(text, end, domain.end())) if domain else []
        ends = [k for k, dot in enumerate(dots) if dot[2].lower() in TOP_LEVEL_DOMAINS]
        spaced = [(*dot.span(1), ".") for dot in dots[: ends[-1] + 1] if dot[1] != "."] if ends else []
        if spaced or ends and match[0] != "@":
            changes += [(start, end, "@")] if match[0] != "@" else []
            changes += spaced
    return changes


def sign_words(text: str) -> list[tuple[int, int, str]]:
    """At and dot signs as words of other languages, in English."""
    lower = text.lower()
    if not any(word in lower for word in SIGN_WORDS):
        return []
    return [(*match.span(), SIGN_WORDS[match[0].lower()]) for match in _SIGN_WORD(text)]


def spoken_signs(text: str, before: Rewritten | None) -> list[tuple[int, int, str]]:
    """Spoken at and dot signs of addresses, which may have signs that were enclosed ``before`` as well.

    A domain ends in its last top-level domain.  Where the at is spoken, the dot before
    that must be in disguise too, so "look at example.com" is no address.
    """
    lower, changes = text.lower(), []
    if "dot" not in lower and not (before and "at" in lower):
        return changes
    for match in _SPOKEN(text):
        at, said = match.span("at"), match["at"] != "@"
        dots = [(d.start(), d.end(1), d[1] == ".", d[2].lower()) for d in _DOMAIN_DOT(text, at[1], match.end())]
        ends = [k for k, (a, b, written, label) in enumerate(dots) if label in TOP_LEVEL_DOMAINS and not (
            said and written and not (before and before.touched(a, b)))]
        if not ends:
            continue
        dots = dots[: ends[-1] + 1]
        if said and len(dots) == 1 and not dots[0][2] and text[at[1] : dots[0][0]].lower() in DETERMINERS:
            continue
        if said and text[match.start() : at[0]].lower() in BEFORE_AT:
            continue
        changes += [(*d.span(), ".") for d in _SPOKEN_DOT(text, match.start(), at[0])]
        changes += [(*at, "@")] if said else []
        changes += [(a, b, ".") for a, b, written, _ in dots if not written]
    return changes


def spelled_digits(text: str) -> list[tuple[int, int, str]]:
    """Digits and signs as words, in runs of any length: whether a run is an identifier, the kinds' tests decide.

    Single digits are joined; a number of several digits keeps one space to its neighbours.
    """
    changes = []
    if not _SPELLED_PAIR(text):
        return changes
    for match in _SPELLED(text):
        tokens = _numbers([(*m.span(), m[0].lower()) for m in _TOKEN(text, *match.span())])
        if len(tokens) < 2 or all(t.isdigit() and text[a:b] == t for a, b, t in tokens):
            continue
        plain = [DIGITS.get(t) or SIGNS.get(t) or t for *_, t in tokens]
        for k, (start, end, token) in enumerate(tokens):
            if k:
                at, near = tokens[k - 1][1], (plain[k - 1], plain[k])
                kept = "." if text[at:start] == "." else ""
                if not kept and all(p.isdigit() for p in near) and max(map(len, near)) > 1:
                    kept = " "
                if text[at:start] != kept:
                    changes.append((at, start, kept))
            if plain[k] != text[start:end]:
                changes.append((start, end, plain[k]))
    return changes


def _numbers(tokens: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Words of one number of several digits as that number: one hundred twenty seven, ten; the rest as it is."""
    out, k = [], 0
    while k < len(tokens):
        words, first = [t for *_, t in tokens[k : k + 4]], k
        value = 0
        if len(words) > 1 and words[1] == "hundred" and UNITS.get(words[0]):
            value, k, words = 100 * UNITS[words[0]], k + 2, words[2:]
        if words and words[0] in TEENS:
            value, k = value + TEENS[words[0]], k + 1
        elif words and words[0] in TENS:
            value, k = value + TENS[words[0]], k + 1
            if len(words) > 1 and UNITS.get(words[1]):
                value, k = value + UNITS[words[1]], k + 1
        elif value and words and UNITS.get(words[0]):
            value, k = value + UNITS[words[0]], k + 1
        if k > first:
            out.append((tokens[first][0], tokens[k - 1][1], str(value)))
        else:
            out.append(tokens[k])
            k += 1
    return out


def find(text: str) -> list[tuple[int, int, str, bool]]:
    """(start, end, kind, plain) of all identifiers by start, then kind as listed.

    Plain ones are found in the text as it is.  Those found only after normalisation
    are added where they overlap no plain one of their kind.
    """
    plain = identifiers(text)
    spans = [(start, end, kind, True) for kind, start, end in plain]
    steps, last = [], None
    for rewrite in (plain_characters, joined_signs, spaced_signs, sign_words, enclosed_signs,
                    lambda t: spoken_signs(t, last), spelled_digits):
        source = steps[-1].text if steps else text
        last = Rewritten(source, changes) if (changes := rewrite(source)) else None
        steps += [last] if last else []
    if steps:
        known = {kind: sorted((s, e) for k, s, e in plain if k == kind) for kind in KINDS}
        starts = {kind: [s for s, _ in own] for kind, own in known.items()}
        for kind, start, end in identifiers(steps[-1].text):
            changed = False
            for step in reversed(steps):
                changed = changed or step.touched(start, end)
                start, end = step.back(start, end)
            before = bisect_left(starts[kind], end) - 1  # of one kind's spans, the last that starts before the end
            if changed and not (before >= 0 and known[kind][before][1] > start):
                spans.append((start, end, kind, False))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def masked(text: str, spans: list[tuple[int, int, str, bool]]) -> str:
    """The text with each identifier replaced by its kind in brackets; of overlapping ones the first names it."""
    out, at = [], 0
    for start, end, kind, _ in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ``spans`` and ``masked``.

    ``spans`` is an array of (``start``, ``end``, ``kind``, ``plain``) in code points of
    the whole source text, end exclusive, by start and kind.  ``masked`` is the text
    with the spans replaced.  A null text counts as empty: no spans, and an empty
    ``masked``.  Null and repeated ids are rows of their own; other columns are ignored.

    Rows are independent: nothing is shuffled, and batches are worked on in slices of
    bounded size.
    """
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("plain", pa.bool_())]))

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in B.slices(given, "_text"):
            texts = B.texts(batch, "_text")
            spans = [find(t) for t in texts]
            rows = [[dict(zip(("start", "end", "kind", "plain"), s)) for s in own] for own in spans]
            hidden = [masked(t, own) if own else t for t, own in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, kind), pa.array(hidden, pa.string())], [id_col, "spans", "masked"]
            )

    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    spans = docs.sparkSession.createDataFrame(
        [], "spans array<struct<start:int,end:int,kind:string,plain:boolean>>, masked string"
    ).schema
    return rows.mapInArrow(run, StructType([StructField(id_col, rows.schema[0].dataType), *spans]))


def mask_documents(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The same rows and columns with personal data masked and the length in characters brought up to date."""
    place, schema = docs.columns.index(text_col), docs.schema

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in B.slices(given, text_col):
            hidden = [t and masked(t, find(t)) for t in batch.column(place).to_pylist()]
            columns = list(batch.columns)
            columns[place] = pa.array(hidden, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    out = docs.mapInArrow(run, schema)
    return out.withColumn(length_col, F.length(text_col).cast("long")) if length_col in docs.columns else out
