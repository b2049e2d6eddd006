"""Character entities and odd characters: tables from Unicode and HTML data, what to report, and what to put in their place.

The check of an article (`findings`) is one Arrow function: some thousand literals are looked up by one automaton pass over the text, and
the exemptions need the whole article.
"""

from __future__ import annotations

import html.entities
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

from lexmill.functions.wikitext import GUARDS, must_stay, substituted

ENTITY = re.compile("&#?[a-zA-Z0-9]+;")
_NAMED = {f"&{n}": c for n, c in html.entities.html5.items() if n.endswith(";")}


def _chars(*ranges: tuple[int, int]) -> list[str]:
    return [c for a, z in ranges for c in map(chr, range(a, z + 1)) if unicodedata.category(c) != "Cn"]


#: To be rewritten by hand: abbreviations and letters in one character, and what no rule can replace.
ALERT = sorted({"&frasl;", "&#x0374;", *_chars((0x3358, 0x3370), (0x33E0, 0x33FE), (0x32C0, 0x32CB), (0x1F10B, 0x1F10C), (0x1F110, 0x1F169), (0x1F170, 0x1F1AC))} - set("🅱🆙🆒🆚🆕"))
#: Entities that stay: markup, directions, marks that look like others, and separators that can't be seen.
KEEP = {
    *(f"&{n};" for n in "lbrace rbrace lsqb rsqb comma excl ast amp num period ndash mdash minus shy nbsp lrm rlm and or lang rang cap cup sub lt gt zwj c".split()),
    *(f"&#x{h};" for x in (0x200E, 0x061C, *range(0x202A, 0x202F), *range(0x2066, 0x206A), 0x20DD, 0x20DE, 0x20E0, 0x20E3, 0x20E4, 0xFFFD, 0xFA9A, 0x1F610, *range(0x114B0, 0x114C2)) for h in (f"{x:04X}", f"{x:04x}", f"{x:x}")),
}
#: Letters of Greek, as entities, and of these the ones that look Latin.
GREEK = {e: c for e, c in _NAMED.items() if len(c) == 1 and (0x391 <= ord(c) <= 0x3A9 or 0x3B1 <= ord(c) <= 0x3C9) and e[1:-1].lower() in "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma sigmaf tau upsilon phi chi psi omega".split()}
_LOOKS_LATIN = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧκορ"
#: Mathematical operators and look-alikes, of which editors disagree whether they should be characters.
CONTROVERSIAL = {e: c for e, c in GREEK.items() if c in _LOOKS_LATIN} | {e: c for e, c in _NAMED.items() if len(c) == 1 and 0x2200 <= ord(c) <= 0x22FF and e not in KEEP}
GREEK = {e: c for e, c in GREEK.items() if e not in CONTROVERSIAL}
#: All other named entities of one character that can stand for itself.
TRANSFORM = {
    e: c for e, c in _NAMED.items()
    if len(c) == 1 and e not in KEEP and e not in CONTROVERSIAL and e not in GREEK and e not in ALERT and c not in "<>&\"'[]{}|*#=" and not c.isspace() and unicodedata.category(c)[0] not in "CMZ" and unicodedata.normalize("NFC", c) == c
} | {"&quot;": '"', "&apos;": "'", "&ensp;": " ", "&emsp;": " ", "&hellip;": "..."} | {f"&{side}{n};": c for side in "lr" for n, c in (("dquo", '"'), ("squo", "'"))}
#: Characters and sequences to be replaced in prose: compatibility forms by their decomposition, typographic marks by plain ones.
LITERALS: dict[str, str] = {
    **{c: unicodedata.normalize("NFKC", c) for c in _chars((0xFB00, 0xFB06), (0x2150, 0x215E), (0x2460, 0x249B), (0x2100, 0x214F), (0x2070, 0x2079), (0x2080, 0x2089), (0xFF01, 0xFF5E), (0x2160, 0x217F)) if unicodedata.normalize("NFKC", c) != c},
    **{c: unicodedata.normalize("NFKC", c) for c in "¼½¾¹²³ǄǅǆǇǈǉǊǋǌ㎀㎁㎂㎃㎄㎅㎆㎇㎍㎎㎏㎐㎑㎒㎓㎝㎞㎠㎡㎢"},
    "‘": "'", "’": "'", "‚": "'", "“": '"', "”": '"', "„": '"', "´": "'", "`": "'", "…": "...", "‐": "-", "‑": "-", "―": "—", "₤": "£", "ϑ": "θ", "ϕ": "φ", "°K": "K", "C°": "°C", **{f"° {x}": f"°{x}" for x in "CF"}, "∑": "Σ", "∏": "Π", "�": "",
}
#: Of these the ones whose replacement waits for others.
LOW_PRIORITY = set("‘’‚“”„´`…½¼¾")
BLOCKED_TITLES = {
    "Romanization of Arabic", "Unicode equivalence", "Duplicate characters in Unicode", "List of precomposed Latin characters in Unicode", "Arabic script in Unicode",
    "Latin script in Unicode", "Main Page", "Perso-Arabic Script Code for Information Interchange", "Yasukuni Shrine", "List of Latin letters by shape",
    "Seong", "List of jōyō kanji", "Sung-mi", "Modern Arabic mathematical notation", "Arabic diacritics",
    "List of XML and HTML character entity references", "List of typographical symbols and punctuation marks", "Eastern Arabic numerals", "List of Japanese typographic symbols", "List of Unicode characters",
    "Unicode compatibility characters", "List of Latin-script letters", "List of mathematical symbols by subject", "Extensions to the International Phonetic Alphabet", "Bengali–Assamese script",
}
SKIP_STRINGS = [f"{{{{{c}{x}" for x in ("leanup lang", "leanup-lang") for c in "cC"] + ["{{MOS", "{{which lang"] + [f"{{{{{x}" for w, c in (("opy to wiki", "cC"), ("ove to Wiki", "mM")) for x in (k + w for k in c)]

_TEMPLATE_NAMES = "|".join([
    r"[Aa]ngle", r"[Aa]ngbr(?: IPA)?", r"[Aa]udio-IPA", r"[Cc]har", r"(?:[Ii]nfobox )?[Cc]hinese", r"[Cc]ode\s*\|", r"DISPLAYTITLE", r"[Ii]ll", r"[Ii]nterlinear ?\| ?lang=", r"IPA", r"[Ll]ang(?:-\w\w+)?\|",
    r"[Nn]astaliq", r"[Nn]ot a typo", r"PIE", r"proper name", r"[Rr]ust\|", r"[Ss]cript/", r"[Ss]hort description", r"[Tt]ransl(?:iteration)?\|", r"UPA", r"[Zz]h\|", r"7seg",
])
_PICTURE = "(?:Image|File)"
#: Where odd characters are no fault: tables of sounds, code, file names, addresses, marked and foreign text.
REDACTED = [
    re.compile(r'\{\|\s*class="(?:notatypo|wikitable (?:IPA|notatypo)|IPA wikitable).*?\|\}', re.S),
    re.compile(r"\{\|\s*\{\{chset-table-header1", re.S),
    re.compile(r"<(?:(syntaxhighlight|source|code|timeline).*?</\1|blockquote lang=.*?</blockquote)>", re.I | re.S),
    re.compile(r"\[\[" + _PICTURE + r":.*?[|\]]"),
    re.compile(r"(?:link=|" + _PICTURE + r":):[^ ]\.(?:gif|png|jpg|JPG)|[^ ]+\.(?:gif|png|jpg|JPG)\|"),
    re.compile(r"(?:^|\n)\|? *" + _PICTURE + r":.*?(?=[|\n])"),
    re.compile(r"\| *(?:image[0-9]?|img_?[0-9]?|ImageFile|image_skyline) *=.*|\| *cover *=.*jpg"),
    re.compile(r"https?://[^ \n|&]+"),
    re.compile(r"\{\{[Nn]ot a typo start\}\}.*?\{\{[Nn]ot a typo end\}\}", re.S),
    re.compile(r"\{\{lang.*?translit=.*?\}\}|\{\{(?:" + _TEMPLATE_NAMES + r"|\{\{[Cc]ite[^}]+lang(?:uage)?=).*?\}\}", re.S),
    re.compile(r"(?:ipa symbol\d?|poj) *= *[^\n]+"),
]
GUARDS.update({REDACTED[4]: (".gif", ".png", ".jpg", ".JPG"), REDACTED[5]: ("Image:", "File:"), REDACTED[10]: ("ipa symbol", "poj")})
_SOUNDS = re.compile(r".{0,100}\{\{[Nn]eeds IPA.*?\}\}", re.S)


def redact(text: str) -> str:
    """The text without what REDACTED finds, and without the words in front of a request for their pronunciation."""
    for p in REDACTED:
        text = substituted(p, "", text)
    return _SOUNDS.sub("", text) if re.search(r"\{\{[Nn]eeds IPA", text) else text


def _entities(text: str) -> Iterator[tuple[str, str]]:
    chinese = any(x in text for x in ("{{Infobox Chinese", "{{infobox Chinese", "{{Chinese"))
    formula = "<math" in text
    mesons = any(x in text for x in ("ta meson", "i meson", "ho meson", "mega meson", "psilon meson", "scalar meson"))
    for e in ENTITY.findall(text):
        if e in KEEP or e in _ALERTS or (e == "&ast;" and chinese):
            continue
        if e in ("&#91;", "&#93;"):
            yield "LOW_PRIORITY", e
        elif e in CONTROVERSIAL:
            if not formula:
                yield "CONTROVERSIAL", e
        elif e in GREEK:
            if not formula and not mesons:
                yield "GREEK", e
        elif (e == "&semi;" and "lim=" in text) or must_stay(e):
            continue
        elif re.fullmatch("&#(?:[xX][0-9a-fA-F]+|[0-9]+);", e):
            yield "NUMERIC", e
        elif e in TRANSFORM:
            yield "UNCONTROVERSIAL", e
        elif not (e == e.upper() and re.search(f"[A-Z]+{re.escape(e)}", text)):  # R&B; is no entity
            yield "UNKNOWN", e


_ALERTS = set(ALERT)
_SUPERSCRIPTS, _FRACTIONS = set("¹²³⁴⁵⁶⁷⁸⁹"), set("¼½¾")


@lru_cache(1)
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for w in {*ALERT, *LITERALS}:
        a.add_word(w, w)
    a.make_automaton()
    return a


_SINGLE = {w for w in {*ALERT, *LITERALS} if len(w) == 1}
_LONGER = [w for w in {*ALERT, *LITERALS} if len(w) > 1]


def _no_literal(text: str) -> bool:
    """Whether the automaton finds nothing; most texts are told by their distinct characters, which takes a fraction of its pass."""
    return _SINGLE.isdisjoint(set(text)) and not any(w in text for w in _LONGER)


def _exempt(c: str, title: str, text: str, low: str) -> bool:
    """Whether a literal is right in this article."""
    if c == "₤":
        return re.search("lira|lire", low) is not None
    if c in _FRACTIONS:
        return c in title or (c == "½" and "chess" in low) or not any(x in low for x in ("{{frac", "{{sfrac", "\\frac"))
    if c == "`":
        return "{{`}}" in text
    if c == "°K":
        return "°KMW" in text
    if c in ("° F", "° C"):
        return re.search(c + ("(?:ahrenheit)?" if c[-1] == "F" else "(?:elsius)?") + r"(?:[^\w]|[\d_])", text) is None
    if c == "C°":
        return title == "Complementizer"
    if c == "ϑ":
        return "θ" not in text or title in ("Chebyshev function", "Eisenstein series", "J-invariant", "Kamassian language", "Scythian languages", "Scythian religion")
    if c in _SUPERSCRIPTS:
        return any(x in text for x in ("{{Infobox Chinese", "{{infobox Chinese", "{{Chinese"))
    return c in CONTROVERSIAL.values() and "<math" in text


def findings(title: str | None, text: str | None) -> list[tuple[str, str]]:
    """(type, string) of each occurrence to report in an article: entities, characters to replace, and characters to rewrite by hand."""
    if text is None or (title or "") in BLOCKED_TITLES or any(s in text for s in SKIP_STRINGS):
        return []
    # redaction costs much and most articles have nothing to report
    if not ENTITY.search(text) and _no_literal(text):
        return []
    text = redact(text)
    out, low = list(_entities(text)), text.lower()
    last: dict[str, int] = {}
    right: dict[str, bool] = {}
    for end, w in () if _no_literal(text) else _automaton().iter(text):
        if end - len(w) < last.get(w, -1):  # overlaps the one before
            continue
        last[w] = end
        if w in _ALERTS:
            out.append(("ALERT", w))
        if w in LITERALS:
            if w not in right:
                right[w] = _exempt(w, title or "", text, low)
            if not right[w]:
                out.append(("LOW_PRIORITY" if w in LOW_PRIORITY else "UNCONTROVERSIAL", w))
    return out


@lru_cache(2)
def _replacements(greek: bool) -> tuple[dict[str, str], re.Pattern]:
    table = {**TRANSFORM, **LITERALS, **({**GREEK, **CONTROVERSIAL} if greek else {})}
    return table, re.compile("|".join(re.escape(k) for k in sorted(table, key=len, reverse=True)) + "|&#(?:[xX][0-9a-fA-F]+|[0-9]+);")


def fix_text(text: str | None, greek: bool = False) -> str | None:
    """The text with entities and odd characters replaced; Greek letters and mathematical signs only if asked for. Numeric entities become
    characters unless these have to stay entities."""
    if text is None:
        return None
    table, pattern = _replacements(greek)

    def one(m: re.Match) -> str:
        e = m[0]
        if e in table:
            return table[e]
        if e in KEEP or e in _ALERTS or must_stay(e):
            return e
        c = html.unescape(e)
        return e if c in "<>&[]{}|*#='\"" or c.isspace() or unicodedata.category(c)[0] in "CZ" else table.get(c, c)

    return pattern.sub(one, text)
