"""Keyed surrogates for personal data: what stands in for a detected entity.

A surrogate depends on a secret key, the entity's type and its canonical form, so that every
mention gets the same one, whatever its spacing or case. It has the form of the mention: digits
for digits, letters of the same case and script for letters, a name of the same gender.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

# Given names by script and gender, titles by gender.
GIVEN = {
    ("latin", "f"): """Maria Anna Sophie Laura Julia Emma Clara Elena Lucia Carmen Claire Camille
        Hannah Sarah Alice Martha Rosa Nadia Greta Ingrid""".split(),
    ("latin", "m"): """John James Peter Thomas David Daniel Martin Robert Paul Carlos Miguel Pablo
        Pierre Antoine Hans Klaus Stefan Henry George Oscar""".split(),
    ("cyrillic", "f"): "Анна Мария Ольга Елена Ирина Наталья Татьяна Светлана Вера Дарья".split(),
    ("cyrillic", "m"): "Иван Пётр Сергей Алексей Дмитрий Николай Михаил Андрей Павел Юрий".split(),
    ("greek", "f"): "Μαρία Ελένη Σοφία Άννα Δήμητρα Ειρήνη".split(),
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Πέτρος Αντώνης Σπύρος".split(),
}
TITLES = """Mr Mrs Ms Miss Dr Prof Herr Herrn Frau Monsieur Madame Mademoiselle Mme Mlle Señor
    Señora Señorita Sr Sra Don Doña Господин Госпожа Κύριος Κυρία""".split()
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ke ko la le lo ma me mo na ne no pa pe ra re "
    "ro sa se so ta te to va ve vo wa we".split(),
    "cyrillic": "ба бе бо ва ве го да де до за зе ка ко ла ле ло ма ме мо на не но па по ра ре ро "
    "са се со та те то".split(),
    "greek": "βα βο γα γο δα δε θα θε κα κο λα λε λο μα με μο να νε νο πα πε πο ρα ρε ρο σα σε τα "
    "το φα φο".split(),
}
SECRET_WORDS = "token secret password passwd apikey api_key access_key auth_token pwd".split()
SECRET_STARTS = "sk pk ghp gho xoxa xoxb xoxp".split()

_LETTERS = {
    "latin": "abcdefghijklmnopqrstuvwxyz",
    "cyrillic": "абвгдежзиклмнопрстуфхцчшщыэюя",
    "greek": "αβγδεζηθικλμνξοπρστυφχψω",
}
_WORD = r"[^\W\d_]"
_NAME_WORD = rf"(?:{_WORD}+(?:['’-]{_WORD}+)*)"
_TAKEN = "\0"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLE_WORDS = "|".join(sorted({w for t in TITLES for w in (t, t.upper())}))
_GIVEN_WORDS = "|".join(sorted({n for names in GIVEN.values() for n in names}))

_SECRET_PREFIX = re.compile(rf"(?:AKIA|ASIA|(?:{'|'.join(SECRET_STARTS)})[-_])?")

# What stands before a version number, which looks like an address.
_VERSION = re.compile(r"\b(?:v|ver|version|build|release|revision|rev|firmware)[.:]?\s*$", re.I)
_VERSION_LENGTH = 16

# Attempts within the exact form; each later one gets one more digit or letter, so that a form of
# which all values are taken is left.
EXACT_ATTEMPTS = 8

# In order of precedence; the group ``v`` is the entity where the match is wider.
PATTERNS = [
    (
        "secret",
        re.compile(
            r"(?i:\b(?:%s)\b[\"']?\s*[=:]\s*[\"']?)(?P<v>(?=[^\s\"']*\d)[A-Za-z0-9_+/=.-]{8,}[A-Za-z0-9=])"
            r"|\b(?P<w>(?:AKIA|ASIA)[A-Z0-9]{16}|(?:%s)[-_][A-Za-z0-9_-]{16,}"
            r"|(?=[a-f]*\d)[0-9a-f]{32,}|(?=[A-F]*\d)[0-9A-F]{32,})\b"
            % ("|".join(SECRET_WORDS), "|".join(SECRET_STARTS))
        ),
    ),
    (
        "email",
        re.compile(
            r"(?P<v>(?<![\w.%+-])[\w%+-](?:[\w.%+-]*[\w%+-])?@"
            r"(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,24})"
        ),
    ),
    ("iban", re.compile(r"\b(?P<v>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b")),
    ("ip", re.compile(rf"(?<![\w.])(?P<v>{_OCTET}(?:\.{_OCTET}){{3}})(?!\.?\w)")),
    ("card", re.compile(r"(?<![\w.-])(?P<v>\d{4}([ -]?)\d{4}\2\d{4}\2\d{1,7}|\d{13,19})(?![\w-])")),
    ("ssn", re.compile(r"(?<![\w-])(?P<v>\d{3}-\d{2}-\d{4})(?![\w-])")),
    (
        "phone",
        re.compile(
            r"(?<![\w.])(?P<v>\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}"
            r"|\+\d{1,3}[ .-]?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4}"
            r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])"
        ),
    ),
    (
        "name",
        re.compile(
            rf"\b(?:(?P<title>{_TITLE_WORDS})\b\.?\s+(?P<v>(?=[^\W\d_a-zà-ÿа-яα-ω]){_NAME_WORD}"
            rf"(?:[ ](?=[^\W\d_a-zà-ÿа-яα-ω]){_NAME_WORD})?)"
            rf"|(?P<w>(?:{_GIVEN_WORDS})[ ](?=[^\W\d_a-zà-ÿа-яα-ω]){_NAME_WORD}))"
        ),
    ),
]


class Mention(NamedTuple):
    kind: str
    start: int
    end: int
    canonical: str


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _iban_sum(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


def _canonical(kind: str, text: str) -> str:
    if kind in ("card", "ssn"):
        return re.sub(r"\D", "", text)
    if kind == "phone":
        return re.sub(r"[^\d+]", "", text)
    if kind == "iban":
        return text.replace(" ", "")
    if kind == "ip":
        return text
    if kind == "secret" and not re.fullmatch("[0-9a-fA-F]+", text):
        return text
    return text.lower()


def mentions(text: str) -> list[Mention]:
    """The entities of a text in order, none overlapping: of two, the kind named first above.
    A name is one mention for each of its words, a given name and a surname."""
    taken: list[Mention] = []
    rest = text
    for kind, pattern in PATTERNS:
        spans = []
        for match in pattern.finditer(rest):
            group = "v" if match.groupdict().get("v") is not None else "w"
            start, end = match.span(group)
            value = match[group]
            if kind == "iban" and _iban_sum(value.replace(" ", "")) != 1:
                continue
            if kind == "ip" and _VERSION.search(text[max(0, start - _VERSION_LENGTH) : start]):
                continue
            spans.append((start, end))
            if kind != "name":
                taken.append(Mention(kind, start, end, _canonical(kind, value)))
                continue
            words = value.split(" ")
            for i, word in enumerate(words):
                part = "given" if i == 0 and len(words) > 1 else "surname"
                taken.append(Mention(part, start, start + len(word), word.lower()))
                start += len(word) + 1
        for start, end in spans:  # what is taken neither matches again nor hides its neighbours
            rest = f"{rest[:start]}{_TAKEN * (end - start)}{rest[end:]}"
    return sorted(taken, key=lambda m: m.start)


def _draws(key: bytes, *parts: str) -> Iterator[int]:
    """Endless numbers below 2^32 that only the key can foretell."""
    block = 0
    while True:
        data = "\0".join([*parts, str(block)]).encode()
        digest = hmac.new(key, data, hashlib.sha256).digest()
        for i in range(0, 32, 4):
            yield int.from_bytes(digest[i : i + 4], "big")
        block += 1


def script_of(text: str) -> str:
    for c in text:
        if "\u0400" <= c <= "\u04ff":
            return "cyrillic"
        if "\u0370" <= c <= "\u03ff" or "\u1f00" <= c <= "\u1fff":
            return "greek"
    return "latin"


def _spelled(text: str, draw: Iterator[int], hexadecimal: bool = False) -> str:
    """Digits for digits and letters for letters of the same script, lower case."""
    out = []
    for c in text:
        if c.isdecimal():
            out.append(str(next(draw) % 10))
        elif not c.isalpha():
            out.append(c)
        elif hexadecimal:
            out.append("abcdef"[next(draw) % 6])
        else:
            letters = _LETTERS[script_of(c)]
            letter = letters[next(draw) % len(letters)]
            out.append(letter.upper() if c.isupper() else letter)
    return "".join(out)


def _syllables(script: str, draw: Iterator[int], count: int) -> str:
    parts = SYLLABLES[script]
    return "".join(parts[next(draw) % len(parts)] for _ in range(count))


@lru_cache(maxsize=8)
def _shuffled_names(script: str, gender: str, key: bytes) -> dict[str, int]:
    """The names of a list in the key's order."""
    names = [n.lower() for n in GIVEN[script, gender]]
    return {n: i for i, n in enumerate(sorted(names, key=lambda n: next(_draws(key, "list", n))))}


def _name(kind: str, canonical: str, attempt: int, key: bytes, draw: Iterator[int]) -> str:
    script = script_of(canonical)
    female = canonical.endswith(("a", "а", "я", "α", "ά", "η", "ή"))
    if kind == "given":
        for gender in "fm":
            order = _shuffled_names(script, gender, key)
            if canonical in order:
                female = gender == "f"
                if attempt < len(order) - 1:  # a rotation of the list: distinct names stay so
                    names = list(order)
                    return names[(order[canonical] + 1 + attempt) % len(names)]
    made = _syllables(script, draw, 2 + attempt // 4 + next(draw) % 2)
    if kind == "surname":
        end = {"latin": "n", "cyrillic": "ова" if female else "ов", "greek": "ς"}[script]
        return made + end
    ends = {"latin": ("na", "n"), "cyrillic": ("на", "н"), "greek": ("να", "ς")}[script]
    return made + ends[not female]


def surrogate(kind: str, canonical: str, attempt: int, key: bytes) -> str:
    """The canonical form that stands in for an entity; another one for each attempt.

    A form may have fewer values than the corpus has entities of it (one-digit addresses, e-mail
    names of one letter). After ``EXACT_ATTEMPTS`` it is left: addresses get parts of any length,
    later ones and all other kinds a digit or letter more with every attempt. So the values grow
    tenfold each time and the search ends, whatever the entities are."""
    draw = _draws(key, kind, canonical, str(attempt))
    more = max(0, attempt - EXACT_ATTEMPTS + 1)
    if kind in ("given", "surname"):
        return _name(kind, canonical, attempt, key, draw)
    if kind == "email":
        local, domain = canonical.rsplit("@", 1)
        labels = domain.split(".")
        # A reserved domain stays one; else the top level stays. Domains corefer by themselves.
        fixed = 2 if len(labels) > 2 and labels[-2] == "example" else 1
        own = _draws(key, "domain", domain)
        labels[:-fixed] = [_spelled(x, own) for x in labels[:-fixed]]
        return f"{_spelled(local + 'x' * more, draw)}@{'.'.join(labels)}"
    if kind == "ip" and more:
        octets = [str(next(draw) % 256) for _ in range(4)]
        return ".".join(octets + [str(next(draw) % 256) for _ in range(more - EXACT_ATTEMPTS)])
    if kind == "ip":
        octets = []
        for octet in canonical.split("."):
            low, high = {1: (0, 9), 2: (10, 99), 3: (100, 255)}[len(octet)]
            octets.append(str(low + next(draw) % (high - low + 1)))
        return ".".join(octets)
    if kind == "phone" and canonical[0] == "+":
        code = 2 if canonical[1] in "17" else 3
        return canonical[:code] + _spelled(canonical[code:] + "0" * more, draw)
    if kind == "iban":
        body = canonical[:2] + "00" + _spelled(canonical[4:] + "0" * more, draw)
        return f"{body[:2]}{98 - _iban_sum(body):02d}{body[4:]}"
    if kind == "secret":
        kept = _SECRET_PREFIX.match(canonical).end()
        rest = canonical[kept:]
        hexadecimal = bool(re.fullmatch("[0-9a-f]+", rest))
        return canonical[:kept] + _spelled(rest + "0" * more, draw, hexadecimal)
    made = _spelled(canonical + "0" * more, draw)
    if kind == "card":
        valid = _luhn(canonical)
        # One last digit makes the sum right, all others wrong.
        ends = [made[:-1] + str((int(made[-1]) + i) % 10) for i in range(10)]
        made = next(x for x in ends if _luhn(x) == valid)
    return made


def rendered(kind: str, mention: str, made: str) -> str:
    """A surrogate in the form of a mention: its separators and its case. What a longer surrogate
    has more comes last."""
    if kind in ("given", "surname"):
        return made.upper() if mention.isupper() and len(mention) > 1 else made[:1].upper() + made[1:]
    if kind in ("card", "ssn", "phone"):
        digits = iter(re.sub(r"\D", "", made))
        formed = "".join(next(digits) if c.isdecimal() else c for c in mention)
        return formed + "".join(digits)
    if kind == "iban":
        rest = iter(made)
        formed = "".join(c if c == " " else next(rest) for c in mention)
        return formed + "".join(rest)
    if len(made) != len(mention):
        return made
    return "".join(m.upper() if c.isupper() else m for c, m in zip(mention, made))


def replaced(text: str, attempts: dict[tuple[str, str], int], key: bytes) -> tuple[str, list[Mention]]:
    """The text with surrogates, and the mentions at their places in it. ``attempts`` names the
    entities whose first surrogate collides."""
    out, placed, at, shift = [], [], 0, 0
    for m in mentions(text):
        made = surrogate(m.kind, m.canonical, attempts.get((m.kind, m.canonical), 0), key)
        new = rendered(m.kind, text[m.start : m.end], made)
        out += [text[at : m.start], new]
        placed.append(Mention(m.kind, m.start + shift, m.start + shift + len(new), made))
        shift += len(new) - (m.end - m.start)
        at = m.end
    return "".join([*out, text[at:]]), placed
