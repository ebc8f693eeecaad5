"""Personal data: detection, and keyed surrogates of the same type and format.

Mentions of one entity have one canonical form (lower-case address, digits of a number, name
without case, word by word, with the gender that all titles of the full name say), and its surrogate is computed from a secret key, the type and that form
alone, so the same entity gets the same surrogate in every document. A surrogate keeps the
format of each mention: punctuation, letter case, script, number of digits, country prefix,
check digits, the first label of a key, the kind of street, and for names the gender that their
title says.

Names are found behind titles and introductions ("my name is"), birth dates, passport numbers
and bare phone numbers behind a word that announces them, private keys as whole blocks.

Distinctness is checked over the whole corpus: if surrogates of two entities of a type are
the same, or one is itself an entity of the corpus, all but the first of them move on to
their next attempt, until none collides. Only such entities are written down (with their
attempt) and joined back to the texts that mention them; all others follow from the key.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import sys
import unicodedata
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.shared import store

# Titles by the gender they say, and given names to stand in, by script.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Madam", "Frau", "Mme", "Madame", "Mlle", "Sra", "Srta", "Señora", "Doña", "Госпожа", "Κυρία"),
    "m": ("Mr", "Sir", "Herr", "Monsieur", "Sr", "Señor", "Don", "Господин", "Κύριος"),
    "n": ("Mx", "Dr", "Prof", "Professor"),
}
GIVEN = {
    ("LATIN", "f"): "Alice Anna Clara Diana Elena Emma Greta Helena Irene Julia Karin Laura Maria Nora Olivia Paula Rosa Sara Tessa Vera".split(),
    ("LATIN", "m"): "Adam Albert Bruno Carl David Emil Felix Georg Hugo Ivan Jakob Leo Martin Noel Oscar Paul Robert Simon Thomas Victor".split(),
    ("LATIN", "n"): "Alex Andrea Casey Chris Dominique Eden Jamie Jordan Kim Lou Marion Morgan Noa Quinn Robin Sam Sascha Sidney Taylor Toni".split(),
    ("CYRILLIC", "f"): "Анна Вера Дарья Елена Ирина Мария Надежда Ольга Софья Татьяна".split(),
    ("CYRILLIC", "m"): "Антон Борис Виктор Глеб Денис Иван Максим Олег Павел Фёдор".split(),
    ("GREEK", "f"): "Άννα Δανάη Ελένη Ειρήνη Ζωή Κλειώ Μαρία Νίκη Σοφία Χλόη".split(),
    ("GREEK", "m"): "Άρης Γιώργος Δήμος Ηλίας Κώστας Λουκάς Νίκος Πέτρος Στέλιος Φίλιππος".split(),
}
_ALPHABETS = {
    "LATIN": "abcdefghijklmnopqrstuvwxyz",
    "CYRILLIC": "абвгдежзийклмнопрстуфхцчшщыэюя",
    "GREEK": "αβγδεζηθικλμνξοπρστυφχψω",
}
_VOWELS = {"LATIN": "aeiou", "CYRILLIC": "аеиоуя", "GREEK": "αεηιοω"}
# Titled names that are no people, words that announce an entity, kinds of streets.
NO_PEOPLE = {("dr", "pepper"), ("dr", "martens"), ("dr", "oetker"), ("mr", "clean"), ("mr", "muscle"), ("mrs", "butterworth")}
INTRODUCTIONS = ("my name is", "mein name ist", "ich heiße", "je m'appelle", "je m’appelle", "me llamo", "mi nombre es", "меня зовут", "με λένε")
CALLS = "phone telephone tel telefon teléfono téléphone mobile cell fax call whatsapp handy".split()
BIRTHS = ("born on", "born", "date of birth", "birth date", "birthday", "dob", "geboren am", "geburtsdatum", "né le", "née le", "fecha de nacimiento", "nacido el", "nacida el")
PASSPORTS = "passport reisepass passeport pasaporte".split()
STREETS = "street st avenue ave road rd boulevard blvd lane ln drive court ct way place square terrace".split()
STREETS_BEFORE = "rue chemin quai calle avenida plaza".split()
STREET_ENDS = "straße strasse gasse weg allee platz".split()

_GENDER = {t: g for g, titles in TITLES.items() for t in titles}
_TITLE = "|".join(sorted(_GENDER, key=len, reverse=True))
_NAME_WORD = r"[^\W\d_a-zß-ÿа-яёα-ω][^\W\d_]*(?:['’-](?!s\b)[^\W\d_]+)*"
_INITIAL = r"[^\W\d_a-zß-ÿа-яёα-ω]\.(?:-?[^\W\d_a-zß-ÿа-яёα-ω]\.)*"
_PARTICLES = "van von der den de la le du di da del della dos das do ter ten zu zum zur y e i af av bin ibn el al".split()
_NAME = rf"(?:(?:{'|'.join(_PARTICLES)}) ){{0,3}}(?:{_INITIAL}|{_NAME_WORD})"
_STREET_NAME = r"[^\W\d_a-zß-ÿ][\w'’-]*"
_MONTH = r"[^\W\d_]{3,10}"
_any = "|".join
_BEGIN, _FINISH = r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", r"-----END [A-Z ]{0,20}PRIVATE KEY-----"
# The body of a private key, up to its end mark or, without one, the last line of its signs.
_PEM = re.compile(rf"(?<=PRIVATE KEY-----)(?:\s*(?!-)[\w+/=.,:-]+(?: [\w+/=.,:-]+)?(?=\s|\Z))+(?=\s*{_FINISH})|(?<=PRIVATE KEY-----)(?:\s+[A-Za-z0-9+/=]{{16,}}(?=\s|\Z))+")
# One alternative per type; the first that fits at a place wins.
_ENTITY = re.compile(
    r"(?P<email>(?<![\w.+%-])[\w.+%-]{1,64}@(?:[^\W_](?:[\w-]{0,61}[^\W_])?\.){1,8}[^\W\d_]{2,24}(?![\w-]))"
    r"|(?P<iban>\b[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?\b)"
    r"|(?P<awskey>\b(?:AKIA|ASIA)[A-Z0-9]{16}\b)"
    r"|(?P<secret>(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b[\"']?\s{0,3}[=:]\s{0,3})(?:\"(?P<quoted>[^\"]{6,})\"|'(?P<single>[^']{6,})'|[\"']?(?P<value>[^\s\"'<>,;]{6,})))"
    r"|(?P<token>\bgh[opsur]_[A-Za-z0-9]{20,}|\bgithub_pat_\w{20,}|\bglpat-[\w-]{16,}|\bxox[abeprs]-[\w-]{10,}|\bsk[-_](?:live_|test_|proj-)?[A-Za-z0-9]{16,}"
    r"|\bAIza[\w-]{30,}|\beyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]*|(?i:\bbearer) (?P<bearer>(?=[^\s\"']*[0-9])[\w.~+/=-]{16,}))"
    r"|(?P<hex>(?<![0-9A-Za-z])(?=[a-f]{0,40}[0-9])[0-9a-f]{32,64}(?![0-9A-Za-z]))"
    r"|(?P<mac>(?<![\w:-])[0-9A-Fa-f]{2}(?::[0-9A-Fa-f]{2}){5}(?![\w:-])|(?<![\w:-])[0-9A-Fa-f]{2}(?:-[0-9A-Fa-f]{2}){5}(?![\w:-]))"
    r"|(?P<ipv6>(?<![\w:.])(?=[0-9A-Fa-f:]*[0-9])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){2,7}(?:::)?(?![\w:]|\.[0-9]))"
    rf"|(?P<birth>(?i:\b(?:{_any(BIRTHS)}))\W{{1,3}}(?P<date>[0-9]{{1,4}}(?P<sep>[./-])[0-9]{{1,2}}(?P=sep)[0-9]{{2,4}}(?!\w)|[0-9]{{1,2}}\.? (?:de )?{_MONTH},? (?:de )?[0-9]{{4}}(?!\w)|{_MONTH} [0-9]{{1,2}},? [0-9]{{4}}(?!\w)))"
    rf"|(?P<passport>(?i:\b(?:{_any(PASSPORTS)})\b)(?: (?i:number|nummer|número|numéro|no|nr|is))*\W{{1,4}}(?P<pass>(?=[A-Z]{{0,3}}[0-9])[A-Z0-9]{{6,9}})(?!\w))"
    r"|(?P<ipv4>(?<![\w.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![\w]|\.[0-9]))"
    r"|(?P<card>(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}(?![\w]|[.-][0-9]))"
    r"|(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+.-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,4}(?![\w]|[.-][0-9])"
    r"|(?<![\w+.-])(?:\+[0-9]{1,3} ?)?\([0-9]{1,4}\)[ .-]?[0-9]{4,10}(?![\w]|[.-][0-9])|(?<![\w+])\+[0-9]{8,15}(?![\w])"
    rf"|(?i:\b(?:{_any(CALLS)})\b)(?:[ .:#]|[^\W\d_]){{0,20}}?(?<!\w)(?P<bare>[0-9]{{9,15}})(?![\w]|[.-][0-9]))"
    rf"|(?P<street>\b[0-9]{{1,5}}[a-zA-Z]? (?:{_STREET_NAME} ){{1,3}}(?:{_any(x.title() for x in STREETS)})\b|\b[0-9]{{1,5}},? (?i:{_any(STREETS_BEFORE)})(?: (?:{_any(_PARTICLES)}))*(?: {_STREET_NAME}){{1,3}}"
    rf"|\b(?:{_any(x.title() for x in STREETS_BEFORE)})(?: (?:{_any(_PARTICLES)}))*(?: {_STREET_NAME}){{1,3}},? [0-9]{{1,4}}\b|\b{_STREET_NAME}(?:{_any(STREET_ENDS)}) [0-9]{{1,4}}[a-z]?\b)"
    rf"|(?P<name>\b(?P<title>{_TITLE})\.? (?P<full>{_NAME}(?: {_NAME})*)|(?i:\b(?:{_any(INTRODUCTIONS)})) (?P<named>{_NAME}(?: {_NAME})*))"
)
_WORD = re.compile(r"(?<![\w@.+%/-])[^\W\d_]+(?:['’-](?!s\b)[^\W\d_]+)*(?![\w@])")
# Groups that are the entity itself where its type's group holds more.
_PARTS = ("quoted", "single", "value", "bearer", "date", "pass", "bare", "full", "named")
_OPENS = re.compile(r"(?:^|[.!?\n]\s*)\Z")
_KINDS = tuple(k for k in _ENTITY.groupindex if k not in (*_PARTS, "title", "sep"))
_TRIGGER = re.compile(rf"[0-9@=:]|(?i:{_any(INTRODUCTIONS)})")
_TITLES = tuple(_GENDER)


def _luhn(digits: str) -> int:
    """The check digit that makes ``digits`` and it a valid card number."""
    doubled = [int(d) * 2 for d in digits[::-1][::2]]
    return -(sum(d - 9 if d > 9 else d for d in doubled) + sum(map(int, digits[::-1][1::2]))) % 10


def _iban_check(country: str, rest: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"


def script(text: str) -> str:
    for c in text:
        if c.isalpha():
            name = unicodedata.name(c, "LATIN").split(" ")[0]
            return name if name in _ALPHABETS else "LATIN"
    return "LATIN"


def _titled(text: str) -> Iterator[tuple[str, int, int, str, str | None]]:
    """Type, span, canonical form and title of each mention that stands for itself, in order.
    The title of an introduced name is empty."""
    at = 0
    if "PRIVATE KEY-----" in text:
        for m in _PEM.finditer(text):
            begin = m.end() - len(m[0].lstrip())
            yield from _by_line(text[at:begin], at)
            yield "pem", begin, m.end(), canonical("pem", m[0]), None
            at = m.end()
    yield from _by_line(text[at:], at)


def _by_line(text: str, offset: int) -> Iterator[tuple[str, int, int, str, str | None]]:
    for line in text.split("\n"):
        if _TRIGGER.search(line) or any(map(line.__contains__, _TITLES)):
            for m in _ENTITY.finditer(line):
                kind, part = next(k for k in _KINDS if m[k] is not None), next((k for k in _PARTS if m[k] is not None), 0)
                (begin, end), found = m.span(part), m[part]
                if sure := _checked(kind, found, m["title"]):
                    yield sure, offset + begin, offset + end, canonical(sure, found), "" if m["named"] else m["title"]
        offset += len(line) + 1


def _checked(kind: str, found: str, title: str | None) -> str:
    """The type of a mention by its digits, empty if it is none."""
    digits = re.sub(r"\D", "", found)
    if kind == "card" and int(digits[-1]) != _luhn(digits[:-1]):
        kind = "phone" if 9 <= len(digits) <= 15 and digits != found else ""
    if kind == "phone" and (len(digits) < 9 and "(" not in found or len(digits) > 15):
        return ""
    if kind == "iban" and _iban_check(found[:2], found[4:].replace(" ", "")) != found[2:4]:
        return ""
    if kind == "name" and title and (title.lower(), found.split(" ")[0].lower()) in NO_PEOPLE:
        return ""
    if kind == "ipv6":
        try:
            ipaddress.IPv6Address(found)
        except ValueError:
            return ""
    return kind


def _found(text: str) -> list[tuple[str, int, int, str, str | None]]:
    """Titled mentions, and the untitled repeats of words of their names (capitalised; no
    particles, initials or single letters), in order of their places. A lone word that begins
    a sentence is no repeat if the text also writes it in lower case."""
    own = list(_titled(text))
    known = {w for kind, b, e, _, _ in own if kind == "name" for w in name_words(text[b:e]) if len(w) > 1 and w[-1] != "." and w not in _PARTICLES}
    if not known:
        return own
    common = {m[0] for m in _WORD.finditer(text) if m[0] in known}
    out, at = [], 0
    for mention in [*own, None]:
        begin, end = mention[1:3] if mention else (len(text), len(text))
        runs: list[list[int]] = []
        for m in _WORD.finditer(text, at, begin):
            if m[0].lower() in known and not m[0][0].islower():
                if runs and text[runs[-1][1] : m.start()] == " ":
                    runs[-1][1] = m.end()
                else:
                    runs.append([m.start(), m.end()])
        runs = [(x, y) for x, y in runs if text[x:y].lower() not in common or not _OPENS.search(text, max(0, x - 3), x)]
        out += [("name", x, y, canonical("name", text[x:y]), None) for x, y in runs]
        out += [mention] if mention else []
        at = end
    return out


def name_words(full: str) -> list[str]:
    """Words of a name, lower-cased."""
    return full.lower().split(" ")


def mentions(text: str) -> Iterator[tuple[str, int, int, str]]:
    """Type, span and canonical form of each mention, in order. Phone-like digit groups need
    9 digits or more (or an area in brackets), card numbers a valid check digit. Names are
    found behind titles and introductions; their words are then found in the whole text."""
    return (m[:4] for m in _found(text))


def canonical(kind: str, found: str) -> str:
    if kind in ("card", "phone", "ssn"):
        return re.sub(r"\D", "", found)
    if kind == "name":
        return f"{script(found)}:{found.lower()}"
    if kind == "ipv6":
        return ipaddress.IPv6Address(found).exploded
    if kind == "mac":
        return re.sub("[:-]", "", found).lower()
    if kind in ("iban", "pem"):
        return "".join(found.split())
    return found.lower() if kind in ("email", "ipv4", "street", "birth") else found


class Surrogates:
    """Keyed surrogates; the same key, type, form and attempt always give the same one."""

    def __init__(self, key: bytes):
        self.key = hashlib.sha256(key).digest()

    def _stream(self, kind: str, form: str, attempt: int) -> Callable[[int], int]:
        """Numbers below a bound, one after another."""
        block, at, data = 0, 0, b""

        def draw(bound: int) -> int:
            nonlocal block, at, data
            if at + 4 > len(data):
                data, at = hashlib.blake2b(f"{kind}\0{form}\0{attempt}\0{block}".encode(), key=self.key).digest(), 0
                block += 1
            at += 4
            return int.from_bytes(data[at - 4 : at], "big") % bound

        return draw

    @staticmethod
    def _shaped(text: str, draw: Callable[[int], int], digits: str = "0123456789") -> str:
        """Each letter and digit replaced by one of its kind, script and case."""
        out = []
        for c in text:
            if c.isdigit():
                out.append(digits[draw(len(digits))])
            elif c.isalpha():
                letters = _ALPHABETS[script(c)]
                new = letters[draw(len(letters))]
                out.append(new.upper() if c.isupper() else new)
            else:
                out.append(c)
        return "".join(out)

    @classmethod
    def _spoken(cls, text: str, draw: Callable[[int], int]) -> str:
        """Letters replaced by consonants and vowels in turn, digits by digits; in lower case."""
        out, vowel = [], draw(2)
        for c in text:
            if c.isalpha():
                own = script(c)
                letters = _VOWELS[own] if vowel else [x for x in _ALPHABETS[own] if x not in _VOWELS[own]]
                out.append(letters[draw(len(letters))])
                vowel = not vowel
            else:
                out.append(cls._shaped(c, draw))
        return "".join(out)

    def _street(self, form: str, draw: Callable[[int], int], more: int) -> str:
        words, last = form.split(" "), -1
        for i, word in enumerate(words):
            bare, end = word.rstrip(","), next((e for e in STREET_ENDS if word.endswith(e) and word != e), "")
            if bare in (*STREETS, *STREETS_BEFORE, *_PARTICLES):
                continue
            if word[0].isdigit():
                words[i] = str(1 + draw(9)) + self._shaped(word[1:], draw)
            else:
                words[i], last = self._spoken(word.removesuffix(end), draw) + end, i
        words[last] = "".join(_ALPHABETS["LATIN"][draw(26)] for _ in range(more)) + words[last]
        return " ".join(words)

    @staticmethod
    def _date(form: str, draw: Callable[[int], int], attempt: int) -> str:
        """A date with another day, year and, where it is a number, month; later attempts draw from more years."""

        def part(m: re.Match) -> str:
            if len(m[0]) > 2:
                return str(1930 + draw(75 + 50 * attempt))
            if m.end() == len(form) and not re.search("[0-9]{4}", form):
                return f"{draw(100):02d}" + "".join(str(draw(10)) for _ in range(max(0, attempt - 3)))
            return str(1 + draw(12) if int(m[0]) <= 12 else 13 + draw(16)).zfill(len(m[0]))

        return re.sub("[0-9]+", part, form)

    def form(self, kind: str, form: str, attempt: int = 0) -> str:
        """Surrogate of a canonical form, itself canonical and of the same shape. Those of short
        forms grow from the third attempt on (given names from the second), so a full space of
        them never keeps an entity from settling; addresses of machines, cards, accounts and
        keys have a fixed length and a space far larger than any corpus."""
        draw = self._stream(kind, form, attempt)
        more = max(0, attempt - 1)
        if kind == "email":
            name, _, host = form.rpartition("@")
            labels = host.split(".")
            return self._shaped(name + "x" * more, draw) + "@" + ".".join([*(self._shaped(x, draw) for x in labels[:-1]), labels[-1]])
        if kind == "card":
            body = form[0] + self._shaped(form[1:-1], draw)
            return body + str(_luhn(body))
        if kind == "phone":
            kept = max(0, len(form) - 10)
            return form[:kept] + str(2 + draw(8)) + self._shaped(form[kept + 1 :] + "0" * more, draw)
        if kind == "ipv4":
            return ".".join(str(1 + draw(254)) for _ in range(4))
        if kind == "ipv6":
            groups, empty = [], more
            for group in form.split(":"):
                size = len(group.lstrip("0")) or (4 if empty > 0 else 0)
                empty -= group == "0000"
                groups.append((f"{1 + draw(15):x}" + "".join(f"{draw(16):x}" for _ in range(size - 1)) if size else "").zfill(4))
            return ":".join(groups)
        if kind == "mac":
            return f"{draw(16):x}{draw(4) * 4 + int(form[1], 16) % 4:x}" + "".join(f"{draw(16):x}" for _ in form[2:])
        if kind == "birth":
            return self._date(form, draw, attempt)
        if kind == "street":
            return self._street(form, draw, more)
        if kind == "token":
            label = re.match(r"(?:eyJ|AIza|[A-Za-z]{2,6}[-_](?:live_|test_|proj-|pat_)?)?", form)[0]
            return label + self._shaped(form[len(label) :] + "x" * more, draw)
        if kind == "passport":
            return self._shaped(form + "0" * more, draw)
        if kind == "ssn":
            return f"{1 + draw(665):03d}{1 + draw(99):02d}{1 + draw(9999):04d}" + self._shaped("0" * more, draw)
        if kind == "iban":
            rest = self._shaped(form[4:], draw)
            return form[:2] + _iban_check(form[:2], rest) + rest
        if kind == "awskey":
            return form[:4] + "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"[draw(32)] for _ in form[4:])
        if kind == "hex":
            return "".join("0123456789abcdef"[draw(16)] for _ in form)
        if kind == "given":
            gender, kind_of, word = form.split(":", 2)
            if word[-1] == ".":
                return f"{kind_of}:{self._shaped(word + 'x.' * attempt, draw)}"
            names = GIVEN.get((kind_of, gender)) or [n for g in "fm" for n in GIVEN.get((kind_of, g), [])]
            return f"{kind_of}:" + "-".join(names[draw(len(names))].lower() for _ in range(1 + attempt))
        if kind == "family":
            kind_of, word = form.split(":", 1)
            return f"{kind_of}:{self._spoken(word + _ALPHABETS[kind_of][0] * more, draw)}"
        return self._shaped(form + "x" * more, draw) if kind == "secret" else self._shaped(form, draw)

    @staticmethod
    def render(kind: str, surrogate: str, found: str) -> str:
        """A surrogate in the format of a mention."""
        if kind in ("card", "phone", "ssn"):
            digits = iter(surrogate)
            return "".join([*(next(digits) if c.isdigit() else c for c in found), *digits])
        if kind in ("iban", "pem"):
            signs = iter(surrogate)
            return "".join(c if c.isspace() else next(signs) for c in found)
        if kind == "mac":
            signs = iter(surrogate.upper() if any(c.isupper() for c in found) else surrogate)
            return "".join(c if c in ":-" else next(signs) for c in found)
        if kind == "ipv6":
            full = all(len(x) == 4 for x in found.split(":"))
            new = surrogate if full else str(ipaddress.IPv6Address(surrogate)) if "::" in found else ":".join(f"{int(x, 16):x}" for x in surrogate.split(":"))
            return new.upper() if any(c.isupper() for c in found) else new
        if kind in ("street", "birth"):
            cased = lambda new, old: new.upper() if len(old) > 1 and old.isupper() else new.capitalize() if old[0].isupper() else new
            return " ".join(map(cased, surrogate.split(" "), found.split(" ")))
        if kind == "email":
            at, old = surrogate.rpartition("@")[0], found.rpartition("@")[0]
            cased = lambda new, like: "".join(s.upper() if c.isupper() else s for s, c in zip(new, like.ljust(len(new))))
            return cased(at, old) + cased(surrogate[len(at) :], found[len(old) :])
        if kind in ("given", "family"):
            word = surrogate.split(":", 1)[1]
            return word.upper() if found.isupper() and len(found) > 1 else re.sub(r"(?<![^\W\d_])[^\W\d_]", lambda m: m[0].upper(), word)
        return surrogate

    def rewritten(self, text: str, attempts: dict[tuple[str, str], int], genders: dict[tuple[str, str], str] | None = None) -> tuple[str, list[str]]:
        """The text with surrogates, and the type of each mention. ``genders``: of given names
        (form, full name) that other texts say more about."""
        out, at, kinds = [], 0, []
        found = _found(text)
        roles = _roles(text, found)
        said = _genders(roles) | (genders or {})
        for no, (kind, begin, end, form, _) in enumerate(found):
            out.append(text[at:begin])
            if kind == "name":
                words = []
                for word, role, own, full, _ in roles[no]:
                    own = f"{said[own, full]}:{own}" if role == "given" else own
                    words.append(self.render(role, self.form(role, own, attempts.get((role, own), 0)), word) if role else word)
                out.append(" ".join(words))
            else:
                out.append(self.render(kind, self.form(kind, form, attempts.get((kind, form), 0)), text[begin:end]))
            at = end
            kinds.append(kind)
        return "".join([*out, text[at:]]), kinds


def _roles(text: str, found: list[tuple[str, int, int, str, str | None]]) -> dict[int, list[tuple[str, str, str, str, str]]]:
    """Per number of a name mention, its words: text, ``given`` or ``family`` (empty for a
    particle), canonical form, full name, gender that the title says. The last word behind a
    title is the family name (of an introduced name, if it has others); a repeated word is one
    if it is one anywhere in the text, and belongs to the first full name that holds it."""
    out, family, holder = {}, set(), {}
    for titled in (True, False):
        for no, (kind, begin, end, form, title) in enumerate(found):
            if kind != "name" or (title is not None) != titled:
                continue
            words = text[begin:end].split(" ")
            out[no] = []
            for i, word in enumerate(words):
                low = word.lower()
                last = i == len(words) - 1 and (title != "" or i > 0) if titled else low in family
                role = "family" if last and low[-1] != "." else "" if low in _PARTICLES else "given"
                if role == "family":
                    family.add(low)
                full = form if titled else holder.get(low, form)
                if titled:
                    holder.setdefault(low, form)
                out[no].append((word, role, f"{script(word)}:{low}", full, _GENDER.get(title, "n")))
    return out


def _merged(genders: set[str]) -> str:
    """One gender that titles say, or ``n`` if they say none or both."""
    said = genders - {"n"}
    return said.pop() if len(said) == 1 else "n"


def _genders(roles: dict[int, list[tuple[str, str, str, str, str]]]) -> dict[tuple[str, str], str]:
    """Per given name and full name, the gender that a text says."""
    found: dict[tuple[str, str], set[str]] = {}
    for words in roles.values():
        for _, role, form, full, gender in words:
            if role == "given":
                found.setdefault((form, full), set()).add(gender)
    return {name: _merged(said) for name, said in found.items()}


def entities(text: str) -> set[tuple[str, str, str, str]]:
    """``kind``, ``form``, ``full`` and ``gender`` of what gets a surrogate: names word by word,
    given names once for each full name."""
    found = _found(text)
    roles = _roles(text, found)
    out = {(kind, form, "", "") for kind, _, _, form, _ in found if kind != "name"}
    out |= {(role, form, "", "") for words in roles.values() for _, role, form, _, _ in words if role == "family"}
    return out | {("given", form, full, gender) for (form, full), gender in _genders(roles).items()}


def found_entities(documents: DataFrame) -> DataFrame:
    """``text_key`` (hash of the text), ``kind``, ``form``, ``full`` and ``gender`` of the entities of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(key.as_py(), *x) for key, text in zip(batch.column(0), batch.column(1)) for x in entities(text.as_py() or "")]
            columns = list(zip(*rows)) or [()] * 5
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), *[pa.string()] * 4))]
            yield pa.RecordBatch.from_arrays(arrays, names=["text_key", "kind", "form", "full", "gender"])

    return documents.select(F.xxhash64("text"), "text").mapInArrow(run, "text_key long, kind string, form string, full string, gender string")


def attempts(entities: DataFrame, key: bytes) -> DataFrame:
    """``kind``, ``form`` and ``attempt`` of the entities that had to leave their first surrogate.

    ``entities``: distinct ``kind`` and ``form``, stored. A surrogate that an entity has
    settled on is never taken by another later: it stays among the claims.
    """
    surrogates = Surrogates(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            made = pa.array([surrogates.form(k, f, n) for k, f, n in rows], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=["kind", "form", "attempt", "made"])

    def claims(pending: DataFrame) -> DataFrame:
        return store(pending.select("kind", "form", "attempt").mapInArrow(run, "kind string, form string, attempt int, made string"), "claims")

    bare = F.when(F.col("kind") == "given", F.regexp_replace("form", "^[fmn]:", "")).otherwise(F.col("form"))
    taken = entities.select("kind", bare.alias("made"))
    claimed, settled = claims(entities.withColumn("attempt", F.lit(0))), None
    while True:
        first = claimed.groupBy("kind", "made").agg(F.min("form").alias("form"), F.count("*").alias("n"))
        again = claimed.join(taken.distinct(), ["kind", "made"], "left_semi").select("kind", "form")
        lost = claimed.join(first.where("n > 1").select("kind", "made", F.col("form").alias("winner")), ["kind", "made"]).where("form <> winner").select("kind", "form")
        losers = store(again.union(lost).distinct(), "losers")
        kept = claimed.join(losers, ["kind", "form"], "left_anti")
        settled = kept.where("attempt > 0") if settled is None else settled.union(kept)
        if losers.isEmpty():
            return store(settled.select("kind", "form", "attempt"), "attempts")
        taken = store(taken.union(kept.select("kind", "made")), "taken")
        claimed = claims(claimed.join(losers, ["kind", "form"], "left_semi").withColumn("attempt", F.col("attempt") + 1))


def pseudonymised(documents: DataFrame, key: bytes) -> DataFrame:
    """One row per document: ``doc_id``, ``text`` with surrogates, ``n_entities`` (mentions)
    and ``kinds`` (their types, sorted, comma-joined).

    A null text stays null without entities; repeated rows and null ids stay; other columns
    are ignored.
    """
    surrogates = Surrogates(key)
    found = store(found_entities(documents), "entities")
    said = F.array_remove(F.array_remove(F.collect_set("gender"), "n"), "")
    merged = found.groupBy("kind", "form", "full").agg(said.alias("said"))
    merged = merged.withColumn("said", F.when(F.col("kind") != "given", "").when(F.size("said") == 1, F.get("said", F.lit(0))).otherwise("n"))
    merged = store(merged.withColumn("named", F.when(F.col("kind") == "given", F.concat_ws(":", "said", "form")).otherwise(F.col("form"))), "merged")
    moved = attempts(store(merged.select("kind", F.col("named").alias("form")).distinct(), "named"), key).withColumnRenamed("form", "named")
    changed = merged.join(moved, ["kind", "named"], "left").withColumn("attempt", F.coalesce("attempt", F.lit(0)))
    marks = found.join(changed, ["kind", "form", "full"]).where("attempt > 0 OR gender <> said").distinct()
    by_text = marks.groupBy("text_key").agg(F.collect_set(F.struct("kind", "form", "full", "named", "said", "attempt")).alias("moved"))
    by_text = store(by_text, "by_text")
    rows = documents.select("doc_id", "text", F.xxhash64("text").alias("text_key")).join(by_text, "text_key", "left").select("doc_id", "text", "moved")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, kinds = [], [], []
            for text, moved in zip(batch.column(1), batch.column(2)):
                text, moved = text.as_py(), moved.as_py() or ()
                new, found = surrogates.rewritten(text or "", {(x["kind"], x["named"]): x["attempt"] for x in moved}, {(x["form"], x["full"]): x["said"] for x in moved if x["kind"] == "given"})
                texts.append(None if text is None else new)
                counts.append(len(found))
                kinds.append(",".join(sorted(set(found))))
            arrays = [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int32()), pa.array(kinds, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "text", "n_entities", "kinds"])

    return rows.mapInArrow(run, f"doc_id {rows.dtypes[0][1]}, text string, n_entities int, kinds string")


# Workers then need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
