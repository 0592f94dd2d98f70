"""Surrogates for personal data and secrets.

Detected entities are brought to a canonical form (digits of a phone number, lower-case e-mail
address, a given name with its gender and script, ...).  A keyed pseudo-random function
draws a surrogate of the same type and shape for each distinct entity of the corpus, and
rounds of collision checks redraw where two entities share a surrogate or a surrogate equals
an entity that occurs.  After ``WIDEN`` draws a shape counts as too small for its entities and
grows by a character (a phone number to ten digits, an IPv4 address to an IPv6 one) with each further draw; a value of neither letters nor
digits is drawn from both.  So different entities stay different and equal ones equal,
in all documents and formats.  Listed given names are permuted within gender and script; other names
are composed in their script.

Beside keys and values that are named as secrets, the found types are addresses of mail and IP, numbers of phones, cards,
accounts and social security, and dates that are said to be of birth.

Names are found by lists, titles and cues ("my name is"); what a document has so shown to be
a name is replaced wherever it stands in that document, so no later mention keeps the real name.

Texts without entities pass through; only the others are shuffled, to meet their replacements.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import cut, extended, importable, spread_join

# Given names by script and gender.
GIVEN = {
    ("latin", "f"): "Anna Maria Emma Julia Laura Sophie Clara Elena Lucia Carmen Isabel Claire Camille Charlotte Emily Sarah Jessica Linda Patricia Susan Fatima Aisha Mariam Leila Yuki Sakura Mei Priya Ananya Ingrid Astrid Katarzyna Agnieszka Zuzanna Giulia Chiara Francesca Amara Zanele Nadia".split(),
    ("latin", "m"): "James John Robert Michael David Thomas Peter Paul Hans Stefan Klaus Pierre Louis Antoine Carlos Miguel Javier Pablo Daniel George Mohammed Ahmed Omar Yusuf Hiroshi Kenji Wei Arjun Rahul Lars Sven Piotr Tomasz Jakub Giovanni Marco Alessandro Kwame Tunde Ivan".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Екатерина Юлия".split(),
    ("cyrillic", "m"): "Иван Сергей Алексей Дмитрий Николай Михаил Андрей Владимир Павел Олег".split(),
    ("greek", "f"): "Μαρία Ελένη Κατερίνα Σοφία Αναστασία Ιωάννα Δήμητρα Βασιλική Ειρήνη Χριστίνα".split(),
    ("greek", "m"): "Γιώργος Νίκος Δημήτρης Κώστας Παναγιώτης Βασίλης Χρήστος Αντώνης Σπύρος Μιχάλης".split(),
}
# Syllables of composed surnames, by script.
SYLLABLES = {
    "latin": "bar bel bor dan del dor fal fen gar hol kal kel lan lor mar mel nor pal ran rel sal ser tal tor val ver wal win zan zel".split(),
    "cyrillic": "бар бел бор вал вер гор дан дол жар зар кал кор лав лом мар мил нов пол рад сав сол тар тол фед хар чер шар яр".split(),
    "greek": "αλ βαλ γαλ δαλ ζαν θαν καλ λαμ μαν νικ παλ ραλ σαν τακ φαν χαλ".split(),
}
ENDINGS = {"latin": ("", "er", "son"), "cyrillic": ("ов", "ин", "енко"), "greek": ("ίδης", "όπουλος", "άκης")}
#: Draws in an entity's own shape, before the shape grows.
WIDEN = 8
# Endings of composed given names, by script and gender (u: unknown).
GIVEN_ENDINGS = {"latin": {"f": "a", "m": "o", "u": "i"}, "cyrillic": {"f": "а", "m": "ий", "u": "о"}, "greek": {"f": "α", "m": "ος", "u": "ι"}}
# Titles by gender, and what is said before a name.
TITLES = {"m": "Mr Herr Monsieur Señor Sr Господин Κύριος".split(), "f": "Mrs Ms Frau Madame Señora Sra Госпожа Κυρία".split(), "u": "Dr Prof".split()}
CUES = ["[Mm]y name is", "[Nn]ame:", "Dear", "[Ss]igned by", "[Rr]egards,", "[Ss]incerely,", "[Pp]atient:?", "[Cc]ontact person:?", "[Ii]ch heiße", "[Mm]e llamo", "[Jj]e m'appelle", "[Мм]еня зовут", "[Μμ]ε λένε"]

_GENDER = {n: (script, gender) for (script, gender), names in GIVEN.items() for n in names}
_CAPITAL = r"[A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΫЀ-Я][^\W\d_]+(?:-[A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΫЀ-Я][^\W\d_]+)?"
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
# How the keys of services begin.
KEY_STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "github_pat_", "sk-", "sk_live_", "sk_test_", "rk_live_", "rk_test_", "xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-", "AIza", "eyJ")
_KEY = re.compile(
    r"(?<![\w-])(?:(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|github_pat_\w{22,}|sk-(?=[\w-]*\d)[A-Za-z0-9_-]{20,}|[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[0-9A-Za-z_-]{35}|eyJ[\w-]{8,}\.eyJ[\w-]{8,}\.[\w-]{8,})(?!\w)",
    re.ASCII,
)
_PEM = re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----")
_BEARER = re.compile(r"[Bb]earer (?=[A-Za-z._~+/-]*\d)([A-Za-z0-9._~+/-]{16,}=*)")
#: The separator of "password = ...", found by a look ahead, so that a value is searched for separators too; the word before it is looked at only there.
_SEPARATOR = re.compile(r"[=:](?=\s*[\"']?[^\s\"']{8})")
_VALUE = re.compile(r"[=:]\s*[\"']?([^\s\"']+)")
# What is said before a secret.
SECRET_WORDS = "password|passwd|passphrase|pwd|passwort|kennwort|contraseña|mot de passe|пароль|secret|token|(?:api|access|secret|private)[_-]?key"
_SECRET = re.compile(rf"(?i:{SECRET_WORDS})\Z")
_LONGEST_WORD = 12
# What is said before a date of birth.
BIRTH_WORDS = "[Bb]orn on|[Bb]orn|[Dd]ate of birth|DOB|D\\.O\\.B\\.|[Gg]eboren am|[Gg]eburtsdatum|[Nn]ée? le|[Dd]ate de naissance|[Nn]acid[oa] el|[Ff]echa de nacimiento"
_BIRTH = re.compile(r"(?<!\w)(?:" + BIRTH_WORDS + r")\s*:?\s*\Z")
_DATE = re.compile(r"(?<!\d)(?:\d{4}-\d\d?-\d\d?|\d\d?([./-])\d\d?\1\d{4})(?!\d)")
#: Stretches that can hold numbers; the number patterns look at these only.
_STRETCH = re.compile(r"[\d+(][\d ().+\-/]{5,}\d")
_NUMBERS = [
    ("ip", re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]*\d)")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("card", re.compile(r"(?<![\d-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|3[47]\d\d[ -]\d{6}[ -]\d{5})(?![\d-])")),
    # groups of digits alone are no number to call: it takes +, brackets, a leading zero or the form 3-3-4
    ("phone", re.compile(r"(?<![\w+])(?!\d\d?[./-]\d\d?[./-]\d{4}(?!\d))(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{2,4}\)[ .-]?\d{3}[ .-]\d{3,4}|\d{3}[ .-]\d{3}[ .-]\d{4}|0\d{1,4}(?:[ .-]\d{2,4}){2,4})(?!\w)")),
]
# starts at the check digits, as digits are rarer than capitals
_IBAN = re.compile(r"[0-9]{2}(?<=[A-Z]{2}[0-9]{2})(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_IPV6 = re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:])")
# all start with a choice of words, by whose first letters the search skips quickly
_NAMED = re.compile(r"(" + "|".join(sorted(_GENDER, key=len, reverse=True)) + r") (" + _CAPITAL + r")(?!\w)")
_TITLE_GENDER = {t: g for g, titles in TITLES.items() for t in titles}
_TITLED = re.compile(r"(" + "|".join(sorted(_TITLE_GENDER, key=len, reverse=True)) + r")\.? (" + _CAPITAL + r")(?: (" + _CAPITAL + r"))?(?!\w)")
_CUED = re.compile(r"(?:" + "|".join(x for c in CUES for x in ([c[1] + c[4:], c[2] + c[4:]] if c[0] == "[" else [c])) + r")\s+(" + _CAPITAL + r")(?: (" + _CAPITAL + r"))?(?!\w)")
#: Literal parts of the cues, for a quick look whether there can be any.
_CUE_PARTS = [max(re.split(r"\[\w+\]|:?\?", c), key=len) for c in CUES]
_DIGIT = re.compile(r"\d")


def script_of(word: str) -> str:
    c = ord(word[0])
    return "greek" if 0x370 <= c < 0x400 else "cyrillic" if 0x400 <= c < 0x530 else "latin"


def canonical(kind: str, mention: str) -> str:
    if kind == "email":
        return mention.lower()
    if kind in ("card", "ssn"):
        return "".join(_DIGIT.findall(mention))
    if kind == "phone":
        digits = "".join(_DIGIT.findall(mention))
        return digits[-10:] if len(digits) > 10 else digits  # a country code is not part of it
    if kind == "iban":
        return mention.replace(" ", "")
    if kind == "ip6":
        return ipaddress.ip_address(mention).compressed
    if kind == "birth":
        parts = re.findall(r"\d+", mention)
        return "-".join(parts[k].zfill(2) for k in date_order(mention))
    return mention


def date_order(mention: str) -> tuple[int, int, int]:
    """Where a date's year, month and day stand. Month first with slashes, day first with points and dashes, unless that would be a month past 12."""
    a, b, _ = (int(x) for x in re.findall(r"\d+", mention))
    if re.match(r"\d{4}", mention):
        return 0, 1, 2
    return (2, 0, 1) if (a <= 12 if "/" in mention else a <= 12 < b) else (2, 1, 0)


def iban_check(country: str, rest: str) -> str:
    """The two check digits (ISO 7064, 97-10)."""
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"


def _is_ipv6(text: str) -> bool:
    try:
        return ipaddress.ip_address(text).version == 6 and any(c.isalnum() for c in text) and text.count(":") > 2
    except ValueError:
        return False


def _ibans(text: str):
    """(start, end) of all account numbers whose check digits are right; words in capitals or another number may follow one."""
    m = _IBAN.search(text)
    while m:
        a, b = m.start() - 2, m.end()
        if not (a and (text[a - 1].isalnum() or text[a - 1] == "_")):
            while b - a >= 15:
                value = canonical("iban", text[a:b])
                if len(value) >= 15 and iban_check(value[:2], value[4:]) == value[2:4]:
                    yield a, b
                    break
                b = text.rfind(" ", a, b)
            else:
                b = 0
        else:
            b = 0
        m = _IBAN.search(text, b or a + 3)


def _words_from(pattern: re.Pattern, text: str):
    """Matches that don't start within a word."""
    m = pattern.search(text)
    while m:
        inside = m.start() and (text[m.start() - 1].isalnum() or text[m.start() - 1] == "_")
        if not inside:
            yield m
        m = pattern.search(text, m.start() + 1 if inside else m.end())


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical form) of all entities; leftmost and then longest wins where they overlap."""
    found = []

    def add(kind: str, a: int, b: int) -> None:
        found.append((a, b, kind, canonical(kind, text[a:b])))

    if "@" in text:
        for m in _EMAIL.finditer(text):
            add("email", *m.span())
    if any(x in text for x in ("AKIA", "ASIA", "AIza", "eyJ", "sk-", "xox")) or "_" in text and any(x in text for x in KEY_STARTS):
        for m in _KEY.finditer(text):
            add("key", *m.span())
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            add("pem", *m.span(2))
    if "earer " in text:
        for m in _BEARER.finditer(text):
            add("secret", *m.span(1))
    done = 0  # neither a keyword nor a separator is taken from a secret
    for m in _SEPARATOR.finditer(text):
        word = m.start()
        while word > done and text[word - 1].isspace():
            word -= 1
        if word > done and text[word - 1] in "\"'":  # "password": "..."
            word -= 1
        if _SECRET.search(text, max(done, word - _LONGEST_WORD), word):
            value = _VALUE.match(text, m.start())
            add("secret", *value.span(1))
            done = value.end()
    digits = _DIGIT.search(text) is not None
    for stretch in _STRETCH.finditer(text) if digits else ():
        for kind, pattern in _NUMBERS:
            for m in pattern.finditer(text, stretch.start(), min(len(text), stretch.end() + 1)):
                if kind != "phone" or 8 <= len(_DIGIT.findall(m[0])) <= 15:
                    add(kind, *m.span())
        for m in _DATE.finditer(text, stretch.start(), min(len(text), stretch.end() + 1)):
            _, month, day = canonical("birth", m[0]).split("-")
            if 0 < int(month) <= 12 and 0 < int(day) <= 31 and _BIRTH.search(text, max(0, m.start() - 40), m.start()):
                add("birth", *m.span())
    for a, b in _ibans(text) if digits else ():
        add("iban", a, b)
    if "::" in text or text.count(":") > 3:
        for m in _IPV6.finditer(text):
            if _is_ipv6(m[0]):
                add("ip6", *m.span())
    names: dict[str, str] = {}  # of this document

    def person(first: str, last: str | None, gender: str) -> None:
        """Kinds of a person's names; one name alone is a surname after a title, and else a given name."""
        script = script_of(first)
        listed = f"given:{script}:{_GENDER[first][1]}" if first in _GENDER else None
        if last is not None and script_of(last) == script:
            names.setdefault(last, f"surname:{script}")
            names.setdefault(first, listed or f"name:{script}:{gender}")
        else:
            names.setdefault(first, listed or (f"name:{script}:u" if gender == "cue" else f"surname:{script}"))

    for m in _words_from(_NAMED, text):
        person(m[1], m[2], "u")
    for m in _words_from(_TITLED, text):
        person(m[2], m[3], _TITLE_GENDER[m[1]])
    for m in _words_from(_CUED, text) if any(x in text for x in _CUE_PARTS) else ():
        person(m[1], m[2], "u" if m[2] else "cue")
    if names:
        every = re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, sorted(names, key=len, reverse=True))) + r")(?!\w)")
        found += [(*m.span(), names[m[0]], m[0]) for m in every.finditer(text)]
    found.sort(key=lambda x: (x[0], -x[1]))
    out, end = [], 0
    for x in found:
        if x[0] >= end:
            out.append(x)
            end = x[1]
    return out


class Draw:
    """Numbers of a keyed pseudo-random function of (type, entity, attempt)."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int):
        self.key, self.name, self.block, self.pool = key, f"{kind}\0{entity}\0{attempt}\0".encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 8:
            self.pool += hmac.new(self.key, self.name + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        v, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return v % n

    def of(self, letters: str) -> str:
        return letters[self.below(len(letters))]


def _shaped(text: str, draw: Draw, more: int = 0) -> str:
    """Each letter, digit or hex run replaced within its kind, and ``more`` characters added (digits to digits); all are drawn where there is none of these."""
    hexed = re.fullmatch(r"[0-9a-f]*[a-f][0-9a-f]*", text) is not None
    digits = re.fullmatch(r"\d+", text) is not None
    empty = not any(c.isdigit() or c.isalpha() for c in text)
    out = []
    for c in text:
        if hexed:
            out.append(draw.of("0123456789abcdef"))
        elif empty:
            out.append(draw.of("abcdefghijklmnopqrstuvwxyz0123456789"))
        elif c.isdigit():
            out.append(draw.of("0123456789"))
        elif c.isalpha():
            out.append(draw.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ" if c.isupper() else "abcdefghijklmnopqrstuvwxyz"))
        else:
            out.append(c)
    out += [draw.of("0123456789" if digits else "0123456789abcdef" if hexed else "abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(more)]
    return "".join(out)


def luhn(digits: str) -> int:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10


def surrogate(key: bytes, kind: str, entity: str, attempt: int = 0) -> str:
    """A surrogate in canonical form."""
    draw = Draw(key, kind, entity, attempt)
    more = max(0, attempt - WIDEN + 1)
    if kind == "email":
        local, _, domain = entity.partition("@")
        first, _, rest = domain.partition(".")
        host = _shaped(first, Draw(key, "host", domain, 0))  # one host, one surrogate
        return f"{_shaped(local, draw, more)}@{host}.example" + ("." + rest.rpartition(".")[2] if rest else "")
    if kind == "ip" and more:
        return "2001:db8:" + ":".join(f"{draw.below(65536):x}" for _ in range(6))
    if kind == "ip":
        return ".".join(str(draw.below(254) + 1) for _ in range(4))
    if kind == "card":
        body = entity[0] + "".join(draw.of("0123456789") for _ in entity[1:-1])
        valid = luhn(entity) == 0
        last = [d for d in "0123456789" if (luhn(body + d) == 0) == valid]
        return body + last[draw.below(len(last))]
    if kind == "ssn":
        return "9" + "".join(draw.of("0123456789") for _ in entity[1:] + "0" * more)
    if kind == "phone":
        # beyond ten digits the rest would count as a country code, so the shape grows to ten, and 555 is given up
        n = max(len(entity), min(len(entity) + more, 10))
        out = draw.of("23456789") + "".join(draw.of("0123456789") for _ in range(n - 1))
        return out[:3] + "555" + out[6:] if not more and len(entity) == 10 and entity[3:6] == "555" else out
    if kind == "ip6":
        return ipaddress.ip_address("2001:db8:" + ":".join(f"{draw.below(65535) + 1:x}" for _ in range(6))).compressed
    if kind == "iban":
        rest = "".join(draw.of("0123456789" if c.isdigit() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ") for c in entity[4:])
        return entity[:2] + iban_check(entity[:2], rest) + rest
    if kind.startswith("name:"):
        _, script, gender = kind.split(":")
        part = lambda: SYLLABLES[script][draw.below(len(SYLLABLES[script]))]
        return ("".join(part() for _ in range(2 + attempt // 4)) + GIVEN_ENDINGS[script][gender]).capitalize()
    if kind == "birth":
        # a day past 12, so that it reads as the same date in every order and different dates stay different
        year = 1000 + draw.below(9000) if more else 1930 + draw.below(80)
        return f"{year}-{draw.below(12) + 1:02d}-{draw.below(16) + 13:02d}"
    if kind == "key" and entity[:4] not in ("AKIA", "ASIA"):
        def part(x: str, more: int = 0) -> str:
            start = max((k for k in KEY_STARTS if x.startswith(k)), key=len, default="")
            return start + _shaped(x[len(start) :], draw, more)

        *front, last = entity.split(".")
        return ".".join([*map(part, front), part(last, more)])
    if kind == "key":
        return entity[:4] + "".join(draw.of("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in entity[4:])
    if kind.startswith("given:"):
        _, script, gender = kind.split(":")
        names = GIVEN[script, gender]
        # a keyed cyclic permutation: no name stays, no two meet
        order = sorted(names, key=lambda n: hmac.new(key, f"{kind}\0{n}".encode(), hashlib.sha256).digest())
        return order[(order.index(entity) + 1) % len(order)]
    if kind.startswith("surname:"):
        script = kind.split(":")[1]
        part = lambda: SYLLABLES[script][draw.below(len(SYLLABLES[script]))]
        name = "".join(part() for _ in range(2 + draw.below(2) + attempt // 4)) + ENDINGS[script][draw.below(3)]
        return "-".join([name.capitalize(), *(part().capitalize() + part() for _ in range(entity.count("-")))])
    return _shaped(entity, draw, more)


def render(kind: str, mention: str, chosen: str) -> str:
    """The surrogate in the mention's own format."""
    if kind in ("card", "ssn", "phone"):
        rest, out, more = list(chosen), [], len(chosen) - len(canonical(kind, mention))
        for c in reversed(mention):
            out.append(rest.pop() if c.isdigit() and rest else c)
            if len(rest) == more:  # digits by which the shape has grown go before its first
                out += reversed(rest)
                rest = []
        return "".join(reversed(out))
    if kind == "birth":
        order, new = date_order(mention), chosen.split("-")
        parts = re.findall(r"\d+", mention)
        for k, value in zip(order, new):
            parts[k] = value if len(parts[k]) > 1 else value.lstrip("0")
        return "".join(x + y for x, y in zip(parts, [*re.findall(r"\D", mention), ""]))
    if kind == "iban":
        rest = iter(chosen)
        return "".join(c if c == " " else next(rest) for c in mention)
    if kind == "email" and mention.isupper():
        return chosen.upper()
    return chosen


def _finder(batches):
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("kind", pa.string()), ("entity", pa.string())]))
    for b in batches:
        at = b.schema.get_field_index("_text")
        for i in range(0, b.num_rows, 512):
            part = b.slice(i, 512)
            got = [[{"a": a, "b": z, "kind": k, "entity": e} for a, z, k, e in detect(t.as_py() or "")] for t in part.column(at)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, kind)], names=[*part.schema.names, "_m"])


_FOUND = "array<struct<a: int, b: int, kind: string, entity: string>>"


def choose_surrogates(entities: DataFrame, key: bytes, max_rounds: int = 40) -> DataFrame:
    """``kind``, ``entity`` and ``surrogate`` for distinct entities; one that collides is drawn again.

    A surrogate must differ from all other surrogates and from all entities of its type.
    Given names are permuted, so they need no second draw.
    """
    importable(entities.sparkSession)

    def draw(batches):
        for b in batches:
            k, e, n = (b.column(i).to_pylist() for i in range(3))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([surrogate(key, *x) for x in zip(k, e, n)], pa.string())], names=["kind", "entity", "attempt", "surrogate"])

    ddl = "kind string, entity string, attempt int, surrogate string"
    drawn = cut(entities.select("kind", "entity", F.lit(0).alias("attempt")).mapInArrow(draw, ddl))
    for k in range(max_rounds):
        # of two, the one drawn more often stays, which keeps most in their shape; in later rounds the one that was placed
        # before stays, so those that still move are redrawn in each round and soon reach a wider shape
        turn = -F.col("attempt") if k < 2 * WIDEN else F.col("attempt")
        first = drawn.groupBy("kind", "surrogate").agg(F.min(F.struct(turn.alias("turn"), "entity")).alias("_f"), F.count("*").alias("_n")).where("_n > 1")
        twice = drawn.join(first, ["kind", "surrogate"]).where(F.col("entity") != F.col("_f.entity")).select("kind", "entity")
        real = drawn.join(entities.select("kind", F.col("entity").alias("surrogate")), ["kind", "surrogate"]).select("kind", "entity")
        again = cut(twice.unionByName(real).where(~F.col("kind").startswith("given:")).distinct())
        if not again.count():
            return drawn.select("kind", "entity", "surrogate")
        redrawn = drawn.join(again, ["kind", "entity"]).select("kind", "entity", (F.col("attempt") + 1).alias("attempt")).mapInArrow(draw, ddl)
        drawn = cut(drawn.join(again, ["kind", "entity"], "left_anti").unionByName(redrawn))
    raise RuntimeError("surrogates still collide; the type's space is too small for its entities")


def replace_entities(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every detected entity replaced, plus ``n_entities`` (a column of that name is replaced).

    The same key gives the same surrogates for the same corpus.  Null text stays null, with 0
    entities; null ids pass.  Repeated rows get equal texts.  An empty table gives an empty result.
    """
    importable(docs.sparkSession)
    others = [c for c in docs.columns if c.lower() not in (text_col.lower(), "n_entities")]
    rows = docs.select(F.struct(*[docs[c] for c in others]).alias("_row"), docs[id_col].alias("_id"), docs[text_col].alias("_text"), F.xxhash64(docs[text_col]).alias("_h"))

    def found(df):
        return df.mapInArrow(_finder, extended(df, f"_m {_FOUND}"))

    mentions = cut(found(rows.select("_id", "_text", "_h")).select("_id", "_h", F.explode("_m").alias("_x")).select("_id", "_h", "_x.*"))
    entities = cut(mentions.groupBy("kind", "entity").agg(F.count("*").alias("_n")))
    chosen = choose_surrogates(entities.select("kind", "entity"), key).join(entities, ["kind", "entity"])
    named = spread_join(mentions, chosen, ["kind", "entity"], "_n", entities.agg(F.sum("_n")).first()[0] or 0)
    # a document's mentions are bounded by its own length
    todo = named.groupBy("_id", "_h").agg(F.collect_set(F.struct("a", "b", "kind", "surrogate")).alias("_todo")).withColumnsRenamed({"_id": "_tid", "_h": "_th"})

    def rewrite(batches):
        for b in batches:
            at, todo_at = b.schema.get_field_index("_text"), b.schema.get_field_index("_todo")
            texts, counts = [], []
            for t, x in zip(b.column(at), b.column(todo_at)):
                text, edits, out, end = t.as_py(), sorted(x.as_py() or [], key=lambda e: e["a"]), [], 0
                for e in edits:
                    out += [text[end : e["a"]], render(e["kind"], text[e["a"] : e["b"]], e["surrogate"])]
                    end = e["b"]
                texts.append("".join([*out, text[end:]]))
                counts.append(len(edits))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64())], names=["_row", "_text", "n_entities"])

    marked = found(rows)
    clean = marked.where("size(_m) = 0").select("_row", "_text", F.lit(0).cast("bigint").alias("n_entities"))
    dirty = marked.where("size(_m) > 0").drop("_m")
    dirty = dirty.join(todo, dirty["_id"].eqNullSafe(todo["_tid"]) & (dirty["_h"] == todo["_th"])).select("_row", "_text", "_todo")
    dirty = dirty.mapInArrow(rewrite, extended(dirty.select("_row"), "_text string, n_entities bigint"))
    out = clean.unionByName(dirty)
    order = [c for c in docs.columns if c.lower() != "n_entities"]
    return out.select(*[F.col("_text").alias(c) if c.lower() == text_col.lower() else F.col("_row")[c].alias(c) for c in order], "n_entities")
