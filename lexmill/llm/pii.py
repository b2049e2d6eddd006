"""PII surrogates: detected entities get keyed replacements of the same type, gender, script and format.

The same entity gets the same surrogate everywhere, whatever its punctuation or case (coreference); different
entities get different ones (distinctness). For identifiers both hold by construction: an entity's digits and letters
are one number below the product of their radices, and a keyed Feistel permutation of that range, with cycle walking, gives
the surrogate's. Known first names move by a keyed rotation within the names of their gender and script. Surnames and other given names
are open-ended, so theirs are drawn by a keyed hash, a syllable longer at each attempt, with the ending of their gender where their script inflects them; all surrogates of the corpus are then checked against
each other and against all originals, and the later of two that collide is drawn again until none does.

Two map-only passes read the texts (one to gather distinct entities, one to rewrite); no text is shuffled.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import unicodedata
from collections.abc import Iterator, Mapping
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from lexmill.llm._common import buffers, checkpoint, free_names, small_batches, spans, tidy

NAMES = {
    ("f", "latin"): (
        "Anna Maria Laura Julia Emma Olivia Sophia Isabella Charlotte Amelia Sarah Emily Jessica Jennifer Elizabeth Susan Karen Nancy Margaret Claire Camille Chloé Léa Manon Sophie Isabelle Katharina Ursula Heike Sabine Lucía Carmen Pilar Marta Elena Beatriz "
        "Sofía Valentina Camila Martina Rosa Ana Teresa Francesca Giulia Chiara Alessandra Ingrid Astrid Freya Linnea Annika Katarzyna Agnieszka Magdalena Zofia Petra Jana Ivana Milena Ayşe Fatma Zeynep Elif Fatima Aisha Khadija Zainab Maryam Layla Noor Priya Ananya Lakshmi Deepika Kavita "
        "Pooja Sunita Yuki Sakura Akiko Yoko Keiko Haruka Mei Ling Linh Thuy Nguyet Siti Dewi Putri Amara Chiamaka Ngozi Adaeze Wanjiru Akinyi Thandiwe Nomsa Hannah Rachel Rebecca Leah Miriam Patricia Linda Barbara Deborah Michelle Amanda Melissa Stephanie Nicole Catherine Christine Virginia"
    ).split(),
    ("m", "latin"): (
        "James John Robert Michael William David Richard Thomas Charles Daniel Matthew Anthony Andrew Joshua Kenneth Kevin Brian George Edward Peter Hans Klaus Jürgen Wolfgang Stefan Matthias Pierre Jean Louis Antoine Nicolas Mathieu Carlos José Juan Luis Miguel Javier Diego Pablo Paul Martin Frank Lukas Felix Jonas Max Jack Harry Oliver Henry Samuel "
        "Giovanni Marco Luca Alessandro Matteo Lorenzo Erik Lars Sven Bjørn Nils Anders Piotr Tomasz Krzysztof Marek Jakub Milan Zoran Mehmet Mustafa Ahmet Emre Mohammed Mohamed Muhammad Ahmed Ali Omar Hassan Ibrahim Khalid Yusuf Tariq Raj Rahul Arjun Vikram Sanjay Amit Anil Suresh Ravi "
        "Hiroshi Takashi Kenji Haruto Satoshi Wei Jun Minh Tuan Duc Budi Agus Rizky Chinedu Emeka Oluwaseun Kwame Kofi Kamau Sipho Thabo Aaron Isaac Jacob Joseph Benjamin Steven Donald Mark Ronald Timothy Jason Jeffrey Ryan Gary Eric Stephen Larry Scott Gregory"
    ).split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия Людмила Галина Марина Оксана Анастасия Дарья Ксения Виктория Полина Надежда".split(),
    ("m", "cyrillic"): "Иван Алексей Сергей Дмитрий Андрей Михаил Николай Владимир Павел Юрий Александр Олег Игорь Виктор Максим Артём Денис Евгений Роман Борис".split(),
    ("f", "greek"): "Μαρία Ελένη Κατερίνα Βασιλική Σοφία Αγγελική Γεωργία Δήμητρα Ιωάννα Αναστασία Παναγιώτα Ευαγγελία".split(),
    ("m", "greek"): "Γιώργος Δημήτρης Κώστας Νίκος Παναγιώτης Βασίλης Χρήστος Αθανάσιος Ιωάννης Γιάννης Σπύρος Μιχάλης".split(),
    ("f", "arabic"): "فاطمة عائشة مريم خديجة زينب ليلى نور سارة هدى أمينة".split(),
    ("m", "arabic"): "محمد أحمد علي عمر حسن إبراهيم خالد يوسف طارق مصطفى".split(),
    ("f", "devanagari"): "प्रिया अनन्या लक्ष्मी दीपिका कविता पूजा सुनीता राधा".split(),
    ("m", "devanagari"): "राहुल अर्जुन विक्रम संजय अमित अनिल सुरेश रवि".split(),
    ("f", "hebrew"): "שרה רבקה רחל לאה מרים חנה נועה תמר".split(),
    ("m", "hebrew"): "אברהם יצחק יעקב משה דוד יוסף שלמה דניאל".split(),
}
TITLES = {
    **dict.fromkeys(["Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Don", "Sr", "Signor", "Г-н", "Господин", "Κύριος", "Κος", "السيد", "श्री", "מר"], "m"),
    **dict.fromkeys(["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Mlle", "Mademoiselle", "Señora", "Señorita", "Doña", "Sra", "Srta", "Signora", "Г-жа", "Госпожа", "Κυρία", "Κα", "السيدة", "श्रीमती", "גברת"], "f"),
    "Dr": "", "Prof": "", "Doctor": "", "Professor": "", "Доктор": "", "الدكتور": "", "डॉ": "",
}
SYLLABLES = {
    "latin": "bar ben cor dal den far gar hal hol kel lan len lin mar mel mor nor pal ran rin sal sten tam tor val ven wal wen win zel".split(),
    "cyrillic": "бар бел вор гал дан зор кал кор лан лев мар мел нор пал рад сал тар тор фад яр".split(),
    "greek": "βαρ γαλ δαν θεο καλ κων λαμ μαν μιχ νικ παπ ραφ σαλ ταρ φιλ χρο".split(),
}
#: Endings of surnames that are the same for women, and by pairs (men's, women's) those that aren't.
ENDINGS = {"latin": "son ton mann er ley field wood sen".split(), "cyrillic": "енко ук ых".split(), "greek": "ίου ακου".split()}
INFLECTED = {"cyrillic": [("ов", "ова"), ("ев", "ева"), ("ин", "ина"), ("ский", "ская")], "greek": [("όπουλος", "οπούλου"), ("ίδης", "ίδου"), ("άκης", "άκη")]}
#: Endings of given names that no list has, by gender.
GIVEN = {("f", "latin"): ["a", "ina", "ela"], ("m", "latin"): ["o", "us", "ard"], ("f", "cyrillic"): ["а", "ина"], ("m", "cyrillic"): ["ан", "ий"], ("f", "greek"): ["ία", "ένη"], ("m", "greek"): ["ος", "άνης"]}
FIRST = {n: (g, s, i) for (g, s), ns in NAMES.items() for i, n in enumerate(ns)}
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_WORD = r"[^\W\d_]"
_MARKS = r"[ऀ-ःऺ-ॏॢॣ]"  # vowel signs that go with letters
_UPPER = "[" + "".join(c for c in map(chr, range(0x20000)) if c.isupper() or c.istitle()) + "]"
_CAP = rf"(?:{_UPPER}{_WORD}*(?:-{_WORD}+)*|[֐-ࣿऀ-෿](?:{_WORD}|{_MARKS})*)"
PARTICLES = set("van von der den de del della di da dos das du la le zu zum zur af av ten ter bin ibn".split())
_TITLE, _FIRST, _PARTICLE = ("(?:" + "|".join(sorted(x, key=len, reverse=True)) + ")" for x in (TITLES, FIRST, PARTICLES))
_LOCAL = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_%+-])?$")
_DOMAIN = re.compile(r"[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})*\.[A-Za-z]{2,}")
PATTERNS = [
    ("SECRET", re.compile(r"(?i)\b(?:token|secret|api[_-]?key|access[_-]?key|password|passwd|pwd)\b[\"']?\s{0,20}[:=]\s{0,20}[\"']?([A-Za-z0-9][A-Za-z0-9_+/=.-]{6,}[A-Za-z0-9=])")),
    ("SECRET", re.compile(r"\b(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|(?=[0-9a-f]{0,63}[a-f])(?=[a-f]{0,63}[0-9])[0-9a-f]{32,64})\b")),
    ("IBAN", re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b")),
    ("IP", re.compile(rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9])")),
    ("IP6", re.compile(r"(?<![\w:.])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:]|\.[0-9])")),
    ("PHONE", re.compile(
        r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}"
        r"|0[1-9](?:[ .-][0-9]{2}){4}|\(?0[1-9][0-9]{1,3}\)?[ /-][0-9]{3,4}[ -]?[0-9]{3,4})(?![0-9-])"
    )),
    ("SSN", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")),
    ("CARD", re.compile(r"(?<![\w.,-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])")),
    ("PERSON", re.compile(rf"(?<!\w)(?:(?:{_TITLE}\.? )+(?:{_FIRST} )*(?:{_PARTICLE} ){{0,3}}{_CAP}(?: {_CAP}){{0,2}}|(?:{_FIRST} )+(?:{_PARTICLE} ){{0,3}}{_CAP}(?: {_CAP})?)(?!\w)")),
]
_LONE = re.compile(rf"(?<!\w){_CAP}(?!\w)")
_DIGIT, _SIGN = re.compile("[0-9]"), re.compile("[:=]")


@lru_cache(1)
def _literals() -> ahocorasick.Automaton:
    """Every title and first name, and what secrets without digits begin with: a text without any of them, a digit, '@', ':' or '=' has no entity."""
    a = ahocorasick.Automaton()
    for w in [*TITLES, *FIRST, "AKIA", *(f"gh{c}_" for c in "pousr")]:
        a.add_word(w, 1)
    a.make_automaton()
    return a


def can_hold(text: str) -> bool:
    """Whether ``detect`` can find anything; every pattern needs one of these characters or literals, whatever stands around them."""
    return "@" in text or _DIGIT.search(text) is not None or _SIGN.search(text) is not None or next(_literals().iter(text), None) is not None


@lru_cache(1 << 12)
def script(name: str) -> str:
    """Script of the first letter, by its Unicode name."""
    return unicodedata.name(name[0], "LATIN").split()[0].split("-")[0].lower()


@lru_cache(64)
def _letters(sc: str) -> list[str]:
    """Letters of a script without cases, for surrogates."""
    have = [c for c in map(chr, range(0x100, 0xFFFF)) if unicodedata.category(c) == "Lo" and unicodedata.name(c, "").startswith(sc.upper() + " ") and "LETTER" in unicodedata.name(c)]
    return [c for c in have if unicodedata.normalize("NFKC", c) == c][:64] or list("abcdefghijklmnopqrstuvwxyz")


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _luhn(digits: str) -> int:
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10


def surname(form: str) -> str:
    """Canonical form of a surname: the men's where both differ, so that a family has one surrogate."""
    low = form.lower()
    for m, f in INFLECTED.get(script(low), ()):
        if low.endswith(f) and len(low) > len(f):
            return low[: -len(f)] + m
    return low


def feminine(form: str) -> str:
    """The women's form of a surname, where it differs."""
    for m, f in INFLECTED.get(script(form), ()):
        if form.endswith(m):
            return form[: -len(m)] + f
    return form


def person_parts(person: str) -> list[tuple[str, str, str]]:
    """(word, type, canonical form) of the words of a person's name; titles and particles have no type.

    The gender is the title's, or that of the first known name. Of two or more unknown names behind a title with a gender the first is a given name.
    """
    ws = person.split(" ")
    gender = next((g for g in (TITLES.get(w.rstrip("."), "") or (FIRST[w][0] if w in FIRST else "") for w in ws) if g), "")
    names = [k for k, w in enumerate(ws) if w.rstrip(".") not in TITLES and w not in PARTICLES]
    out = []
    for k, w in enumerate(ws):
        if k not in names:
            out.append((w, "", ""))
        elif w in FIRST:
            out.append((w, "FIRST", w))
        elif gender and len(names) > 1 and k == names[0]:
            out.append((w, "GIVEN", f"{gender} {w.lower()}"))
        else:
            out.append((w, "LAST", f"{'f' if gender == 'f' else 'm'} {surname(w)}"))
    return out


def name_parts(person: str) -> list[tuple[str, str]]:
    """(FIRST, GIVEN or LAST, canonical form) of a person's names, without titles and particles."""
    return [(kind, form if kind != "LAST" else form[2:]) for _, kind, form in person_parts(person) if kind]


def _known(names: set[tuple[str, str]], word: str) -> tuple[str, str] | None:
    """The entity among ``names`` that a word alone refers to."""
    for x in (("FIRST", word), ("GIVEN", f"f {word.lower()}"), ("GIVEN", f"m {word.lower()}"), ("LAST", surname(word))):
        if x in names:
            return x
    return None


def _lone(text: str, names: set[tuple[str, str]]) -> Iterator[tuple[int, int, str]]:
    """Where a capitalised word, or a part of one with hyphens, is one of ``names``; initials are passed over."""
    for m in _LONE.finditer(text):
        a = m.start()
        for p in [m[0]] if "-" not in m[0] or _known(names, m[0]) else m[0].split("-"):
            if len(p) > 1 and (p[0] != p[0].lower() or p[0].upper() == p[0].lower()) and _known(names, p):
                yield a, a + len(p), "PERSON"
            a += len(p) + 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each '@' what can be an address: up to 64 characters before it and 255 behind."""
    last, at = 0, text.find("@")
    while at >= 0:
        local = _LOCAL.search(text[max(last, at - 64) : at])
        domain = _DOMAIN.match(text[at + 1 : at + 257])
        if local and domain:
            yield at - len(local[0]), at + 1 + domain.end()
            last = at + 1 + domain.end()
        at = text.find("@", at + 1)


def _is_ip6(s: str) -> bool:
    groups = [g for g in s.split(":") if g]
    if len(groups) < 3 or not any(c.isdigit() for c in s):
        return False
    try:
        ipaddress.IPv6Address(s)
    except ValueError:
        return False
    return True


def detect(text: str) -> list[tuple[int, int, str]]:
    """(start, end, type) of the entities, in order and apart; of overlapping ones the earlier type in PATTERNS stays, e-mails first.

    Names of a person found anywhere in the text are persons too where they stand alone.
    """
    names: set[tuple[str, str]] = set()
    found = [(a, z, "EMAIL") for a, z in _emails(text)]
    fresh, digits = found, _DIGIT.search(text) is not None
    for kind, pattern in PATTERNS:
        if fresh:
            # what is found already is out of reach of the later patterns
            out, at = [], 0
            for a, z, _ in sorted(fresh):
                out += [text[at:a], "\0" * (z - a)]
                at = z
            text = "".join(out) + text[at:]
        fresh = []
        if kind in ("IBAN", "IP", "IP6", "PHONE", "SSN", "CARD") and not digits:
            continue
        for m in pattern.finditer(text):
            a, z = m.span(1) if kind == "SECRET" else m.span()
            s = text[a:z]
            if kind == "IBAN" and _mod97(s.replace(" ", "")) != 1:
                continue
            if kind == "IP6" and not _is_ip6(s):
                continue
            if kind == "PHONE" and not 9 <= sum(c.isdigit() for c in s) <= 15:
                continue
            if kind == "PERSON":
                names.update(name_parts(s))
            fresh.append((a, z, kind))
        found += fresh
    if fresh:
        out, at = [], 0
        for a, z, _ in fresh:
            out += [text[at:a], "\0" * (z - a)]
            at = z
        text = "".join(out) + text[at:]
    return sorted([*found, *(_lone(text, names) if names else ())])


class Surrogates:
    """Keyed surrogates; ``redrawn``: attempts of the entities (type, canonical form) that collided."""

    def __init__(self, key: bytes, redrawn: Mapping[tuple[str, str], int] | None = None):
        self.key, self.redrawn = key, redrawn or {}

    def _prf(self, *parts: object) -> int:
        return int.from_bytes(hashlib.blake2b(repr(parts).encode(), key=self.key, digest_size=32).digest(), "big")

    def _wide(self, bits: int, *parts: object) -> int:
        out, n = 0, 0
        while n < bits:
            out, n = out << 256 | self._prf(n, *parts), n + 256
        return out & ((1 << bits) - 1)

    def permute(self, x: int, size: int, tweak: object) -> int:
        """Keyed permutation of range(size): eight Feistel rounds over an even number of bits, walked until in range."""
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        low = (1 << half) - 1
        while True:
            a, b = x >> half, x & low
            for r in range(8):
                a, b = b, a ^ self._wide(half, tweak, half, r, b)
            x = a << half | b
            if x < size:
                return x

    def _shape(self, s: str, tweak: object, hexadecimal: bool = False) -> str:
        """Letters become letters of their case, digits digits (or hex digits hex digits); the rest stays."""
        sets = []
        for c in s:
            if hexadecimal and c in "0123456789abcdef":
                sets.append("0123456789abcdef")
            else:
                sets.append("0123456789" if c in "0123456789" else "abcdefghijklmnopqrstuvwxyz" if "a" <= c <= "z" else "ABCDEFGHIJKLMNOPQRSTUVWXYZ" if "A" <= c <= "Z" else c)
        x, size = 0, 1
        for c, among in zip(s, sets):
            x, size = x * len(among) + among.index(c), size * len(among)
        if size == 1:
            return s
        x = self.permute(x, size, (tweak, "".join(a[0] if len(a) > 1 else a for a in sets)))
        out = []
        for among in reversed(sets):
            x, d = divmod(x, len(among))
            out.append(among[d])
        return "".join(reversed(out))

    def entities(self, kind: str, s: str) -> list[tuple[str, str]]:
        """Canonical (type, form) of the parts of an entity that have surrogates of their own."""
        if kind == "EMAIL":
            return [(kind, s.lower())]
        if kind in ("PHONE", "CARD", "SSN"):
            return [(kind, "".join(c for c in s if c.isdigit()))]
        if kind == "IBAN":
            return [(kind, s.replace(" ", ""))]
        if kind == "IP6":
            return [(kind, ipaddress.IPv6Address(s).exploded)]
        if kind == "PERSON":
            return name_parts(s)
        return [(kind, s)]

    def _syllables(self, x: int, n: int, sc: str) -> str:
        among, out = SYLLABLES.get(sc) or _letters(sc), ""
        for _ in range(n):
            x, d = divmod(x // 2, len(among))
            out += among[d]
        return out

    def of(self, kind: str, form: str) -> str:
        """Surrogate of a canonical form."""
        attempt = self.redrawn.get((kind, form), 0)
        t = (kind, attempt)
        if kind == "EMAIL":
            local, _, domain = form.partition("@")
            host, _, top = domain.rpartition(".")
            return self._shape(local, t) + "@" + self._shape(host, t) + "." + top
        if kind == "PHONE":
            keep = max(0, len(form) - 10) if form[0] != "0" else 2
            return form[:keep] + self._shape(form[keep:], t)
        if kind == "CARD":
            # a permutation of those with the same Luhn sum: walked until in range
            want, x = _luhn(form), form
            while True:
                x = self._shape(x, t)
                if _luhn(x) == want and (x[0] == "0") == (form[0] == "0"):
                    return x
        if kind == "IBAN":
            body = self._shape(form[4:], (*t, form[:2]))
            return form[:2] + f"{98 - _mod97(form[:2] + '00' + body):02d}" + body
        if kind == "IP6":
            net, rest = form[:4], form[4:].replace(":", "")
            rest = self._shape(rest, (*t, net), hexadecimal=True)
            return net + "".join(":" + rest[k : k + 4] for k in range(0, 28, 4))
        if kind == "IP":
            o = [int(p) for p in form.split(".")]
            sort = lambda v: 0 if v >> 24 in (0, 127) or v >> 24 >= 224 else 1 if v >> 24 == 10 or v >> 16 == 0xC0A8 or v >> 20 == 0xAC1 else 2
            was = v = o[0] << 24 | o[1] << 16 | o[2] << 8 | o[3]
            while True:
                v = self.permute(v, 1 << 32, t)
                if sort(v) == sort(was):
                    return ".".join(str(v >> k & 255) for k in (24, 16, 8, 0))
        if kind == "FIRST":
            g, sc, i = FIRST[form]
            pool = NAMES[g, sc]
            order = sorted(range(len(pool)), key=lambda j: self._prf("order", g, sc, j))
            return pool[order[(order.index(i) + 1 + self._prf("turn", g, sc) % (len(pool) - 1)) % len(pool)]]
        if kind in ("LAST", "GIVEN"):
            name = form[2:] if kind == "GIVEN" else form
            sc = script(name)
            # a syllable more with each attempt: any number of names finds room after a few
            x = self._prf(*t, form)
            out = self._syllables(x >> 64, 2 + x % 2 + attempt + (2 if sc not in SYLLABLES else 0), sc)
            if kind == "GIVEN":
                ends = GIVEN.get((form[0], sc), [""])
            elif any(name.endswith(m) for m, _ in INFLECTED.get(sc, ())):
                ends = [m for m, _ in INFLECTED[sc]]
            else:
                ends = ENDINGS.get(sc, [""])
            return out + ends[x // 2 % len(ends)]
        return self._shape(form, t, hexadecimal=re.fullmatch("[0-9a-f]+", form) is not None)

    def replace(self, kind: str, s: str, names: set[tuple[str, str]] = frozenset()) -> str:
        """Surrogate of an entity as it is written: its punctuation, spacing, titles, case and gender stay. ``names``: what a name alone can refer to."""
        if kind == "PERSON":
            parts = person_parts(s)
            alone = _known(names, s) if len(parts) == 1 else None
            out = []
            for p, part, form in parts:
                if not part:
                    out.append(p)
                    continue
                if alone:
                    part, form = alone[0], alone[1] if alone[0] != "LAST" else f"{'f' if s.lower() != surname(s) else 'm'} {alone[1]}"
                new = self.of(part, form[2:] if part == "LAST" else form)
                if part == "LAST" and (form[0] == "f" or p.lower() != surname(p)):
                    new = feminine(new)
                out.append(new if part == "FIRST" else new.upper() if len(p) > 1 and p.isupper() else new[0].upper() + new[1:])
            return " ".join(out)
        new = self.of(*self.entities(kind, s)[0])
        if kind in ("PHONE", "CARD", "SSN", "IBAN"):
            at = iter(new)
            return "".join(next(at) if c.isalnum() else c for c in s)
        if kind == "EMAIL":
            return "".join(n.upper() if c.isupper() else n for c, n in zip(s, new))
        return new

    def rewrite(self, text: str) -> tuple[str, int]:
        """The text with surrogates, and how many."""
        found = detect(text)
        if not found:
            return text, 0
        names = {x for a, z, kind in found if kind == "PERSON" and " " in text[a:z] for x in name_parts(text[a:z])}
        out, at = [], 0
        for a, z, kind in found:
            out += [text[at:a], self.replace(kind, text[a:z], names)]
            at = z
        return "".join(out) + text[at:], len(found)


def forms(text: str) -> set[tuple[str, str]]:
    """Canonical entities of a text."""
    s = Surrogates(b"-")
    found = detect(text)
    names = {x for a, z, kind in found if kind == "PERSON" and " " in text[a:z] for x in name_parts(text[a:z])}
    out = set(names)
    for a, z, kind in found:
        if kind != "PERSON":
            out.update(s.entities(kind, text[a:z]))
    return out


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got: set[tuple[str, str]] = set()
        for text in batch.column(0).to_pylist():
            if text and can_hold(text):
                got |= forms(text)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in got], pa.string()), pa.array([f for _, f in got], pa.string())], ["kind", "form"])
    tidy()


def entity_table(docs: DataFrame) -> DataFrame:
    """(kind, form): the distinct canonical entities of all texts."""
    return docs.select(docs["text"].cast("string").alias("text")).mapInArrow(_gather, "kind string, form string").distinct()


#: From this attempt on a permuted identifier may equal an original, so that kinds of which every value occurs have surrogates too; they stay distinct.
_DENSE = 8


def collisions(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, form, attempt) of the entities whose surrogate must be drawn again, so that no two share one, and none is an original.

    Where an identifier's range is so full of originals that eight draws all hit one, distinctness alone counts: these all take the same permutation.
    """

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, form, attempt = (c.to_pylist() for c in batch.columns)
            s = Surrogates(key, {(k, f): a for k, f, a in zip(kind, form, attempt) if a})
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([s.of(k, f) for k, f in zip(kind, form)], pa.string())], ["kind", "form", "attempt", "surrogate"])

    state = checkpoint(entities.withColumn("attempt", F.lit(0)).mapInArrow(draw, "kind string, form string, attempt int, surrogate string"))
    open_ended = "kind in ('LAST', 'GIVEN')"
    while True:
        # known first names turn within their own lists, so theirs are originals as a rule; they can't collide
        rank = F.expr("row_number() over (partition by if(kind = 'GIVEN', 'LAST', kind), surrogate order by attempt, kind, form)")
        original = F.when(F.col("kind") == "GIVEN", F.substring("form", 3, 1 << 20)).otherwise(F.col("form"))
        own = state.select(F.expr("if(kind = 'GIVEN', 'LAST', kind)").alias("own_kind"), original.alias("own_form")).distinct()
        bad = (
            state.where("kind != 'FIRST'").withColumn("rank", rank)
            .join(own, (F.expr("if(kind = 'GIVEN', 'LAST', kind)") == F.col("own_kind")) & (F.col("surrogate") == F.col("own_form")), "left")
            .where(f"rank > 1 or (own_form is not null and ({open_ended} or attempt < {_DENSE}))").select("kind", "form", "attempt")
        )
        bad = checkpoint(bad)
        if bad.isEmpty():
            return state.where("attempt > 0").select("kind", "form", "attempt")
        again = bad.withColumn("attempt", F.col("attempt") + 1).mapInArrow(draw, "kind string, form string, attempt int, surrogate string")
        state = checkpoint(state.join(bad.select("kind", "form"), ["kind", "form"], "left_anti").unionByName(again))


_RESULT = "struct<text:string,n:int>"


def _rewriter(key: bytes, few: Mapping[tuple[str, str], int] | None):
    """Arrow function of texts (and, without ``few``, of each one's own redrawn entities) to _RESULT; a null text for those that stay as they are."""

    def rewrite(texts: pa.Array, own: list | None) -> pa.Array:
        every, out, n = Surrogates(key, few or {}), [], []
        for k, text in enumerate(texts.to_pylist()):
            new, count = None, 0
            if text and can_hold(text):
                s = every if own is None or not own[k] else Surrogates(key, {(r["kind"], r["form"]): r["attempt"] for r in own[k]})
                new, count = s.rewrite(text)
            out.append(new if count else None)
            n.append(count)
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(n, pa.int32())], ["text", "n"])

    if few is not None:

        def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for t in texts:
                yield rewrite(t, None)
            tidy()

        return arrow_udf(run, _RESULT).asNondeterministic()

    def run_own(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for t, own in columns:
            yield rewrite(t, own.to_pylist())
        tidy()

    return arrow_udf(run_own, _RESULT).asNondeterministic()


def surrogate_pii(docs: DataFrame, key: bytes = b"lexmill", broadcast_limit: int = 200_000) -> DataFrame:
    """All columns of ``docs`` with the entities in text replaced, and n_entities.

    Types: e-mail, secrets (assigned tokens, known key formats, long hex), IBAN (checksum kept valid), IPv4 (private and public apart), IPv6 (first group stays), phone
    (country code stays), SSN, card and account numbers (Luhn validity stays), and persons (a title or known first name before capitalised
    words, and later or earlier mentions by one of these names alone; titles and particles as in 'van der Berg' stay). Given names that no list has get surrogates of the gender of
    the title before them, surnames the ending of the gender where Russian or Greek has two; a family's two forms are one entity. A null text stays null, texts without entities stay as they are to the byte, of any length. The key decides all
    surrogates; repeated rows and repeated entities get equal ones. Extra columns pass through, whatever their names; a column n_entities is
    replaced. An empty table gives an empty result.

    Entities drawn again go along by broadcast up to ``broadcast_limit`` of them, beyond it by a join on the hash of the text.
    """
    small_batches(docs.sparkSession)
    again = checkpoint(collisions(entity_table(docs), key))
    body, own, got = free_names(docs, 3)
    text = docs["text"].cast("string")
    if again.limit(broadcast_limit + 1).count() <= broadcast_limit:
        few = {(r["kind"], r["form"]): r["attempt"] for r in again.collect()}
        d = docs.withColumn(got, _rewriter(key, few)(text))
    else:

        def of_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [(b, k, f) for b, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t and can_hold(t) for k, f in forms(t)]
                cols = list(zip(*rows)) or [[], [], []]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())], ["body", "kind", "form"])

        needs = docs.select(F.xxhash64(text).alias("body"), text.alias("text")).mapInArrow(of_text, "body bigint, kind string, form string").join(again, ["kind", "form"])
        lists = needs.distinct().groupBy("body").agg(F.collect_list(F.struct("kind", "form", "attempt")).alias(own)).withColumnRenamed("body", body)
        d = docs.join(lists, F.xxhash64(text) == lists[body], "left").withColumn(got, _rewriter(key, None)(text, F.col(own)))
    new = F.coalesce(F.col(got)["text"], text).alias("text")
    return d.select(*[new if c == "text" else docs[c] for c in docs.columns if c != "n_entities"], F.col(got)["n"].alias("n_entities"))
