"""Personal data (5): detection on a normalised text whose spans map back to the source.

Base matches are found on the text as it stands. Then three transducers rewrite disguises, keeping for
every character of the result the source characters it came from:
1. homoglyphs and invisible characters become the ASCII characters they imitate, or nothing;
2. spelled digits next to another digit, spelled or not, become digits;
3. "(at)", "[dot]", " at ", " dot " and their German, French and Spanish forms become @ and full stops,
   " at " before a plain dotted domain only where something shows that an address is meant (`_is_mailbox`);
   after such an @, spaced full stops lose their spaces. White space between the parts may be of any length.
The same detectors run on the result. A match that covers rewritten characters and does not lie
inside a base match of its kind is added, at its source position. Only texts with a sign of a disguise are rewritten.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesmill.llm.shipping import ship

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match ends where its digits end, so none begins inside a run of digits.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches without overlap, found from each @ backwards, in linear time."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        end = _DOMAIN.match(text, at + 1) if start < at else None
        if end:
            yield start, end.end()
            done = end.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    found = [("email", s, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append(("phone", *m.span()))
    return found


# Cyrillic and Greek letters that look like Latin ones, and signs that look like @ . + -
_ALIKE = dict(zip("авсԁеһіјӏкмнорԛѕтуѵԝхАВСЕНІЈКМОРЅТУХ", "abcdehijlkmhopqstyvwxABCEHIJKMOPSTYX"))
_ALIKE |= dict(zip("αβγεικνορτυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "abyeikvoptuxABEZHIKMNOPTYX"))
_ALIKE |= {"﹫": "@", "。": ".", "․": ".", "·": ".", "•": ".", "‧": ".", "﹒": ".", "➕": "+", "‐": "-", "‑": "-", "–": "-", "−": "-"}
_INVISIBLE = frozenset("­​‌‍‎‏⁠⁡⁢⁣⁤﻿")
# Names of the digits 0 to 9, and how @ and the full stop are spelled.
_DIGITS = [
    "zero oh null zéro cero", "one eins un uno", "two zwei deux dos", "three drei trois tres",
    "four vier quatre cuatro", "five fünf cinq cinco", "six sechs seis", "seven sieben sept siete",
    "eight acht huit ocho", "nine neun neuf nueve",
]
_NUMBER = {name: str(d) for d, names in enumerate(_DIGITS) for name in names.split()}
_AT, _DOT = "at|ät|arobase|arroba|klammeraffe", "dot|punkt|point|punto"

_NAME = "(?:" + "|".join(sorted(_NUMBER, key=len, reverse=True)) + ")"
_OPEN, _CLOSE = r"(?<!\s)\s*+[(\[{<]\s*+", r"\s*+[)\]}>]\s*+"
_POINT = rf"(?:\.|\s++(?:{_DOT})\s++)"
_DOTTED = rf"[a-z0-9-]{{1,63}}(?:{_POINT}[a-z0-9-]{{1,63}}){{0,8}}"
_LAST = r"(?-i:[a-z]{2,24}|[A-Z]{2,24})(?![a-z0-9-])"
# Words that announce an address; words between them and it; mailboxes named after their task;
# words that are no mailbox.
_CUES = frozenset(
    "email e-mail mail contact write reach message ask address via schreib schreibe schreiben kontakt adresse courriel écrire écrivez "
    "contacter contactez correo escribe escribir escriba contacta".split()
)
_LINKS = frozenset("to us me him her them at under is on an a our my the or and please by à al bei unter sous vous uns nous address".split())
_ROLES = frozenset(
    "abuse admin administrator billing careers contact contacto data editor feedback hello help helpdesk hostmaster info jobs kontakt mail "
    "marketing news newsletter noreply office postmaster press privacy sales security service shop support team webmaster".split()
)
_NEVER = frozenset(
    "a an the i me my you your he him his she her it its we us our they them their this that these those who what which here there now then "
    "today is are was were be been am do does did has have had not no or and but for of in on to by as from with at so up out only just "
    "online again home back stay".split()
)
_SPELLED = re.compile(
    rf"(?P<at>{_OPEN}(?:{_AT}|@){_CLOSE}|(?<=[a-z0-9])\s++(?:{_AT})\s++(?=[a-z0-9-]{{1,63}}\s++(?:{_DOT})\s++[a-z])"
    rf"|(?P<bare>(?<=[a-z0-9])\s++(?:{_AT})\s++(?=(?P<domain>{_DOTTED}{_POINT}{_LAST})))"
    rf"|(?<=[a-z0-9])\s++@\s++(?=[a-z0-9]))"
    rf"|(?P<dot>{_OPEN}(?:{_DOT}|\.){_CLOSE}|(?<=[a-z0-9])\s++(?:{_DOT})\s++(?=[a-z0-9]))",
    re.I,
)
_GAP = r"(?=[\s,.·-])\s*+(?:[,.·-]\s*+){0,4}+"
_RUN = re.compile(rf"(?:\bplus\s++)?\b{_NAME}(?:{_GAP}(?:(?:{_DOT})(?=[\s,.·-]){_GAP})?{_NAME}\b)*(?![^\W_])", re.I)
_PLUS = re.compile(rf"\bplus\s++(?=[0-9]{{1,3}}[\s-]++{_NAME}\b)", re.I)
_DIGIT_AFTER = re.compile(rf"(?:[\s-]++\(?|{_POINT})[0-9]", re.I)
_DOT_WORDS = frozenset(_DOT.split("|"))
#: Names of digits that are words of every kind of text.
_AMBIGUOUS = frozenset("one un uno oh null".split())
_SPACED_DOMAIN = re.compile(rf"[a-z0-9-]{{1,63}}(?:\s++\.\s*+[a-z0-9-]{{1,63}}){{0,8}}\s++\.\s*+{_LAST}", re.I)
_SPACED_DOT = re.compile(r"(?<!\s)\s++\.\s*+")
_PART = re.compile(rf"(?P<plus>plus)|(?P<dot>{_DOT})|(?P<digit>{_NAME})", re.I)
_LOOKS_DIGIT = re.compile(r"(?<=[0-9])[OoIl](?=[0-9])")
_ODD = re.compile(
    "[­·Ͱ-ԯ٠-٩۰-۹०-९‐-―​-‏•․‧⁠-⁤"
    "−①-⑳➕。﹒﹫﻿！-～\U0001d400-\U0001d7ff]"
)
_SIGN = re.compile(
    rf"[(\[{{<]\s*+(?:{_AT}|@|{_DOT}|\.)\s*+[)\]}}>]|\s(?:{_DOT})\s|\s@\s|[0-9][oil][0-9]|\b{_NAME}(?:{_GAP}{_NAME}\b|(?:{_GAP}|\s*+)\(?[0-9])"
    rf"|[0-9](?:\)?[\s-]++|\.){_NAME}\b|\s(?:{_AT})\s++[a-z0-9-]{{1,63}}\.[a-z0-9]"
)


class Traced:
    """A text under rewriting; start[i], end[i] are the source characters of its character i."""

    def __init__(self, text: str):
        self.text = text
        self.start = array("i", range(len(text)))
        self.end = array("i", range(1, len(text) + 1))
        self.changed = bytearray(len(text))

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Apply edits (start, end, new) of this text, in order and without overlap."""
        if not edits:
            return
        text, start, end, changed, done = [], array("i"), array("i"), bytearray(), 0
        for a, b, new in edits:
            text.append(self.text[done:a])
            text.append(new)
            start += self.start[done:a] + array("i", [self.start[a]]) * len(new)
            end += self.end[done:a] + array("i", [self.end[b - 1]]) * len(new)
            changed += self.changed[done:a] + b"\1" * len(new)
            done = b
            if not new and done < len(self.text):  # what is taken out shows on the next character
                self.changed[done] = 1
        self.text = "".join(text) + self.text[done:]
        self.start = start + self.start[done:]
        self.end = end + self.end[done:]
        self.changed = changed + self.changed[done:]


def _plain(c: str) -> str:
    if c in _INVISIBLE:
        return ""
    if c in _ALIKE:
        return _ALIKE[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    wide = unicodedata.normalize("NFKC", c)
    return wide if wide.isascii() and wide else c


def _digit_before(text: str, at: int) -> bool:
    """Whether a digit comes before `at`, with spaces, hyphens, a bracket or a full stop between."""
    i = at
    while i and (text[i - 1].isspace() or text[i - 1] == "-"):
        i -= 1
    if i == at:
        return i > 1 and text[i - 1] == "." and text[i - 2] in "0123456789"
    if i and text[i - 1] in "0123456789":
        return True
    if i and text[i - 1] == ")":
        return i > 1 and text[i - 2] in "0123456789"
    word = i
    while word and text[word - 1].isalpha():
        word -= 1
    if text[word:i].lower() not in _DOT_WORDS or not text[i].isspace():
        return False
    i = word
    while i and text[i - 1].isspace():
        i -= 1
    return 0 < i < word and text[i - 1] in "0123456789"


def _is_mailbox(text: str, end: int, domain: str, known: set[str]) -> bool:
    """Whether the word that ends at `end` names a mailbox at the domain that follows " at ".

    It does if the domain has a spelled full stop, the word is not made of letters only, the address
    stands in the text as such, or a cue announces it ("write to", "e-mail:"). A mailbox named after
    its task ("info") also does where a clause begins. Pronouns and other grammar words never do.
    """
    start = end
    while start and text[start - 1] in _LOCAL:
        start -= 1
    word = text[start:end].lower()
    if not word or word[-1] == "." or word in _NEVER:
        return False
    if any(c.isspace() for c in domain) or f"{word}@{domain.lower()}" in known:
        return True
    if not word.isalpha() and not word.isdigit() and word[0].isalnum():
        return True
    clause, announced, at = True, False, start
    while not announced:
        until = at
        while until and text[until - 1].isspace():
            until -= 1
        if not until or "\n" in text[until:at]:
            break
        at = until
        while at and not text[at - 1].isspace():
            at -= 1
        before = text[at:until].lower().lstrip("\"'([<¿¡")
        colon = before.endswith(":")
        if before.rstrip(":") in _CUES:
            announced = colon or not word.endswith(("ed", "ing"))
            break
        if before[-1:] in ".,;:!?)(\"'–—" or not before:
            break
        clause = False
        if before not in _LINKS:
            break
    return announced or clause and word in _ROLES and text[start].islower()


def normalise(text: str) -> Traced:
    traced = Traced(text)
    traced.replace([(m.start(), m.end(), p) for m in _ODD.finditer(text) if (p := _plain(m[0])) != m[0]])
    runs = []
    for m in _RUN.finditer(traced.text):
        names = sum(bool(p["digit"]) for p in _PART.finditer(m[0]))
        beside = _digit_before(traced.text, m.start()) or _DIGIT_AFTER.match(traced.text, m.end())
        if names > 1 or beside:
            new = "".join("+" if p["plus"] else "." if p["dot"] else _NUMBER[p[0].lower()] for p in _PART.finditer(m[0]))
            runs.append((m.start(), m.end(), new))
    runs += [(m.start(), m.end(), "+") for m in _PLUS.finditer(traced.text)]
    traced.replace(sorted(runs))
    edits, known = [], None
    for m in _SPELLED.finditer(traced.text):
        if m["bare"] and known is None:
            known = {traced.text[a:b].lower() for a, b in _emails(traced.text)}
        if not m["bare"] or _is_mailbox(traced.text, m.start(), m["domain"], known):
            edits.append((m.start(), m.end(), "@" if m["at"] else "."))
    traced.replace(edits)
    spaced = []
    at = traced.text.find("@")
    while at >= 0:
        domain = _SPACED_DOMAIN.match(traced.text, at + 1) if traced.changed[at] else None
        spaced += [(d.start(), d.end(), ".") for d in _SPACED_DOT.finditer(traced.text, at + 1, domain.end())] if domain else []
        at = traced.text.find("@", at + 1)
    traced.replace(spaced)
    traced.replace([(m.start(), m.end(), "0" if m[0] in "Oo" else "1") for m in _LOOKS_DIGIT.finditer(traced.text)])
    return traced


def _valid(kind: str, found: str) -> bool:
    """Rewritten text must look like an address of its kind, not only match."""
    if kind == "email":
        last = found.rsplit(".", 1)[1]
        return len(last) >= 2 and last.isalpha() and found[0].isalnum()
    return True


def _only_a_word(rest: str, start: int, base_start: int) -> bool:
    """Whether a match goes beyond a base match by one name of a digit that may well be a plain word."""
    return start == base_start and rest.strip(" ,.-").lower() in _AMBIGUOUS


def find_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans, each by kind and start; code points, end exclusive."""
    base = base_spans(text)
    lower = text.lower()
    if (text.isascii() or not _ODD.search(text)) and not _SIGN.search(lower):
        return base, base
    traced = normalise(text)
    added = []
    for kind, start, end in base_spans(traced.text):
        if any(traced.changed[start:end]) and _valid(kind, traced.text[start:end]):
            a, b = min(traced.start[start:end]), max(traced.end[start:end])
            if not any(k == kind and s <= a and (b <= e or _only_a_word(text[e:b], a, s)) for k, s, e in base):
                added.append((kind, a, b))
    if not added:
        return base, base
    order = {kind: i for i, kind in enumerate(KINDS)}
    return base, sorted(base + added, key=lambda s: (order[s[0]], s[1]))


def _listed(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, base counts by kind, base_sha256, spans, n_added.

    A null text is empty and has no spans. Repeated rows give a row each; other columns are ignored.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            counts, digests, lists, added = [[], [], [], []], [], [], []
            for text in batch.column(1):
                base, spans = find_spans(text.as_py() or "")
                for column, k in zip(counts, KINDS):
                    column.append(sum(s[0] == k for s in base))
                digests.append(hashlib.sha256(_listed(base).encode()).hexdigest())
                lists.append(_listed(spans))
                added.append(len(spans) - len(base))
            yield pa.record_batch(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                 pa.array(lists, pa.string()), pa.array(added, pa.int64())],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
            )

    return docs.select("doc_id", F.col("text")).mapInArrow(
        run,
        f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long",
    )


def redacted(text: str) -> str:
    """The text with every span replaced by its kind in brackets; spans that overlap become one."""
    out, done, until = [], 0, 0
    for kind, start, end in sorted(find_spans(text)[1], key=lambda s: (s[1], -s[2])):
        if start >= until:
            out += [text[done:start], f"[{kind}]"]
        until = done = max(until, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """All rows and columns of `docs`, with personal data in `text` replaced; null stays null."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = [None if t is None else redacted(t) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
