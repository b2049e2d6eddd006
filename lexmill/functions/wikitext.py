"""Wikitext to prose: nested structure, links, references, tags and entities, by Arrow batches.

The rewriting is an ordered chain over whole articles, longer than Catalyst takes as nested expressions, so it is one
pandas function. A removed template leaves a scissors mark for each bracket inside it.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "✂"
Rule = tuple[re.Pattern, str]
#: Literals of which a text has one wherever the pattern matches, of patterns that are slow where they don't.
GUARDS: dict[re.Pattern, tuple[str, ...]] = {}


def substituted(pattern: re.Pattern, to: str | Callable, s: str) -> str:
    """``pattern.sub``, without looking where no literal of GUARDS is."""
    some = GUARDS.get(pattern)
    return pattern.sub(to, s) if some is None or any(x in s for x in some) else s


def remove_nested(s: str, opening: str, closing: str) -> str:
    """Cut balanced structures out of ``s``; each nested opening and each closing inside leaves a MARK, stray closings stay."""
    out, depth, at, since = [], 0, 0, 0
    both = re.compile(f"{re.escape(opening)}|{re.escape(closing)}")
    found = list(both.finditer(s))
    last_close = max((m.start() for m in found if m[0] == closing), default=-1)
    for m in found:
        if m[0] == opening:
            if depth == 0:
                out.append(s[at : m.start()])
            elif m.start() > last_close:
                return "".join(out)
            else:
                out.append(MARK)
            depth += 1
        elif depth:
            out.append(MARK)
            depth -= 1
        else:
            continue
        at = since = m.end()
    return "".join(out) + s[since:]


def _template(names: str, flags: int = re.I) -> re.Pattern:
    """A template without parameters by one of the names, which are apart by two spaces."""
    return re.compile(r"\{\{(?:" + "|".join(re.escape(n) for n in names.split("  ")) + r")\}\}", flags)


def _element(name: str, attributes: bool = False) -> re.Pattern:
    return re.compile(rf"<{name}{'[^>]*' if attributes else ''}>.*?</{name}>", re.I | re.S)


#: Templates that stand for a character.
CHARACTERS = {
    "tm": "™", "theta": "&theta;", "seggol": "ֶ", "schwahook": "ɚ", "schwa": "ə", "rturn": "ɹ", "rfishhook": "ɾ", "pipedbl": "ǁ", "okina": "ʻ", "mu": "μ", "mappiq": "ּ", "linevertsub": "ˌ", "linevert": "ˈ",
    "lengthmark": "ː", "lambda": "λ", "hicaron": "̌", "hbrrafe": "ֿ", "thinsp": "&thinsp;", "gamma": "γ", "epsilon1revhook": "ɝ", "epsilon1rev": "ɜ", "epsilon1": "Ɛ", "dirprod": "⊗", "circle": "￼", "beta letter": "β",
}
_CASED = {"SH": "ś", "DELTA": "Δ"}
_NAMESPACE = r"[a-zA-Z\s]+:"


def _rule(to: str | Callable, pattern: str, flags: int = 0) -> tuple[re.Pattern, str | Callable]:
    return re.compile(pattern, flags), to


_EARLY: list[Rule | tuple[re.Pattern, Callable]] = [
    _rule(" ", "  +"),
    _rule("\n\n", r"\n{3,}"),
    (_template("·  bold middot  dot  middot", 0), " · "),
    (_template("•  bull", 0), " • "),
    (_element("syntaxhighlight", True), "\n\n"),
    (_element("math", True), ""),
    _rule(r"\1", r"\{\{ISBN\|(.*?)\}\}"),
    (_template("spaced en dash  spaced en dash space  dash  nbspndash  snd  sndash  spacedendash  spacedndash  spnd  spndash"), " - "),
    (_template("mdash  —  em dash  emdash  em-dash  --  endash  en dash  –  ndash  nsndns  subdash"), "-"),
    (_template("\\"), " / "),
    (_template("  ".join(_CASED), 0), lambda m: _CASED[m[0][2:-2]]),
    (_template("  ".join(CHARACTERS)), lambda m: CHARACTERS[m[0][2:-2].lower()]),
    # emphasis keeps its text; a quotation template survives the removal of templates, for later checks
    _rule(r"\1", r"\{\{(?:em|strong)\|(.*?)\}\}", re.I),
    _rule(r"⁅⁅\1⁆⁆", r"\{\{(cquote\|.*?)\}\}", re.I),
    _rule(r"\1", rf"\[\[(?!{_NAMESPACE})([^|]+?)\]\]"),
    _rule(r"\2", rf"\[\[(?!{_NAMESPACE})(.*?)\|\s*(.*?)\s*\]\]", re.S),
    _rule("", rf"\[\[{_NAMESPACE}.*?\]\]", re.S),
    (_element("gallery", True), "\n\n"),
    (_element("score", True), ""),
]
_SPACES = {"nbsp", "thinsp", "hairsp"}
_NOTHING = {"shy", "lrm", "rlm"}
#: Entities that prose may have in place of their characters, by name.
_ALLOWED = (
    "mdash minus prime Prime Alpha Beta Epsilon Zeta Eta Iota Kappa Mu Nu Omicron Rho Tau Upsilon Chi kappa omicron rho lsquo rsquo sbquo ldquo rdquo bdquo acute times and or lsaquo rsaquo sdot middot bull"
).split()
_PLAIN = {n: html.entities.html5[f"{n};"] for n in _ALLOWED} | {"lang": "〈", "rang": "〉", "ndash": "-", "#96": "`"} | dict.fromkeys(_SPACES, " ") | dict.fromkeys(_NOTHING, "")
_UNWRAPPED = "span div small big center s u del time onlyinclude includeonly noinclude nowiki".split()
_LATE: list[Rule | tuple[re.Pattern, Callable]] = [
    _rule(" ", "&(?:nbsp|thinsp|hairsp);"),
    _rule(" ", "<br.*?>", re.I),
    _rule(lambda m: _PLAIN[m[1]], "&(" + "|".join(sorted(_PLAIN, key=len, reverse=True)) + ");"),
    _rule("", "<!--.*?-->", re.S),
    # tags lose their attributes
    _rule(r"<\1\2>", r"<(\??[a-zA-Z]+)[^>]{0,1000}?(/?)\s*>"),
    _rule("", "<ref/>", re.I),
    (_element("ref"), ""),
    _rule("\n\n", "<references/>", re.I),
    _rule("\n\n", r"<(references)>.*?</\s*\1>", re.I | re.S),
    *[(_element(n), "\n\n") for n in ("source", "timeline", "code")],
    *[(_element(n), "") for n in ("chem", "graph")],
    (_element("pre"), "\n\n"),
    *[(_element(n), "") for n in ("var", "hiero", "imagemap", "mapframe", "kbd")],
    _rule("", "</?(?:" + "|".join(_UNWRAPPED) + ")>|<section[^>]*/>|<nowiki/>|__notoc__", re.I),
    _rule("", r"\[\s*(?:https?|ftp):.*?\]", re.I),
    _rule("", r"(?:https?|ftp):.*?[ $]", re.I),
    _rule("", (r"\{" + ".{1,200}?") * 2 + r"\}\}"),
    _rule("[", "&#91;"),
    _rule("]", "&#93;"),
    _rule("", r"[!|] colspan=.*?\n"),
    _rule("", r"\|\|? rowspan=.*?\n"),
    # one line for each paragraph; headings, lists and tables keep their own
    _rule("\n\n", r"\n\s*\n+"),
    _rule("\n", r"^\s*\n+"),
    _rule(" ", r"(?<!^)(?<![=\n✂}\]|])\n(?![\n=*#:;✂ |])"),
    _rule("\n", r"\n{2,}"),
    _rule(" ", "  +"),
    _rule("{{", "⁅⁅"),
    _rule("}}", "⁆⁆"),
]
GUARDS.update({p: (":",) for p, _ in _LATE if p.pattern == r"(?:https?|ftp):.*?[ $]"} | {p: (" colspan=",) for p, _ in _LATE if "colspan" in p.pattern})
_SUBSUP = re.compile("</?su[bp]>", re.I)

END_MATTER = (
    "See also,External links,References,Bibliography,Selected bibliography,Published works,Further reading,Sources,Publications,Selected publications,Selected exhibitions,Filmography,Selected filmography,Discography,Works,Selected works,Books,Compositions,Recordings,Track listing"
).split(",")
_END = re.compile(r"==\s*(?:" + "|".join(END_MATTER) + r")\s*==.*\Z", re.I | re.S)
#: English contractions, of which ``'s`` forms and the like aren't words of encyclopaedic prose.
CONTRACTIONS = sorted(
    {f"{w}n't" for w in "ai are ca could did does do had has have is may might must need ought sha should was were wo would".split()}
    | {f"{w}'{e}" for w in "he she it that there who what where why how when".split() for e in ("d", "ll", "s")}
    | {f"{w}'{e}" for w in "I you we they these those".split() for e in ("d", "ll", "ve")}
    | set("I'm you're we're they're who're what're let's y'all ma'am o'clock 'tis 'twas could've should've would've might've must've shan't've gonna gotta wanna".split())
)


def _enclosed(left: str, right: str) -> str:
    """What stands between two marks without space inside them, up to a thousand characters."""
    inner = rf"\S[^{right}]{{0,1000}}?\S"
    return "|".join(f"{left}{x}{right}" for x in (inner, r"\S"))


_CAPITAL, _BEFORE, _BEHIND, _KEPT = "[A-Za-z]", "([^']|^)", "([^']|$)", rf"\1{MARK}\3"
_BALANCED = [
    *(_rule(MARK, _enclosed(x, y) + f"|{x}{y}") for x, y in ('""', "“”")),
    _rule(_KEPT, _BEFORE + "(" + "'" * 5 + _CAPITAL + "[^']{0,500}(?:" + "|".join(re.escape(c) for c in CONTRACTIONS) + ")?[^']{0,500}" + "'" * 5 + ")" + _BEHIND),
    _rule(_KEPT, _BEFORE + "(''" + _CAPITAL + ".{0,500}?'')" + _BEHIND),
    _rule(_KEPT, r"(\s|^)" + f"('{_CAPITAL}" + "[^']{0,1000}?')" + r"(\s|$)"),
    _rule(MARK, r"<(blockquote|poem).*?</\1>|\{\{quote box.*?\}\}", re.I | re.S),
]
GUARDS.update({p: ("'" * n,) for (p, _), n in zip(_BALANCED[2:5], (5, 2, 1), strict=True)})
_REST = r"[^\n]*"
_HEADING, _INDENTED = re.compile(r"=[^\n]+=\n"), re.compile(r"\n[ :†]" + _REST)
_PARENTHESES = re.compile("|".join(_enclosed(rf"\{x}", rf"\{y}") for x, y in ("()", "[]")))
_LISTS, _CITED = re.compile(r"\n[*#;]" + _REST), re.compile(r"\n#\*" + _REST)
_EMPHASIS = re.compile("'{2,5}")


def to_prose(s: str | None, flatten: bool = True) -> str | None:
    """Plain text of an article; a null stays null and an empty one empty. Sub- and superscripts become part of their words if ``flatten``."""
    if s is None:
        return None
    for pattern, to in _EARLY:
        s = pattern.sub(to, s)
    # a table may begin in a template and end in the article
    for opening, closing in (("{{", "}}"), ("{|", "|}"), ("|-", "|}")):
        s = remove_nested(s, opening, closing)
    for pattern, to in _LATE:
        s = substituted(pattern, to, s)
    return _SUBSUP.sub("", s) if flatten else s


def body(s: str | None, quotations: bool = False, nonprose: bool = True) -> str | None:
    """The part of a plain text that is its author's prose: no end matter, headings, indented lines, bold or italics.

    Without ``quotations``, quoted and emphasised passages and cited lines of dictionaries become MARKs; without ``nonprose``, parentheses and lists go.
    """
    if s is None:
        return None
    s = _END.sub("", s)
    for pattern, to in () if quotations else _BALANCED:
        s = substituted(pattern, to, s)
    s = _EMPHASIS.sub("", _INDENTED.sub("", _HEADING.sub("", s)))
    if not nonprose:
        s = _LISTS.sub("", _PARENTHESES.sub("", s))
    return s if quotations else _CITED.sub("", s)


def language_sections(s: str | None) -> dict[str, str]:
    """Sections of a dictionary page by the language in their headings; of equal headings the last one's."""
    parts: dict[str, str] = {}
    name, lines = "", []
    for line in [*(s or "").split("\n"), None]:
        m = line is not None and re.match(r"== *([^=]+) *==$", line)
        if (m or line is None) and lines:
            parts[name] = "".join(lines)
        if m:
            name, lines = m[1], []
        if line is not None:
            lines.append(line + "\n")
    return parts


def linked_words(s: str | None) -> list[str]:
    """Parameters of templates that point to translations elsewhere, which are words to be checked as well."""
    return [p.strip() for m in re.findall("{{trans-see *[|](.*?)}}", s or "") for p in m.split("|")]


def _number(entity: str) -> int | None:
    m = re.fullmatch(r"&#(?:[xX]([0-9a-fA-F]+)|([0-9]+));", entity)
    return (int(m[1], 16) if m[1] else int(m[2])) if m else None


def must_stay(entity: str) -> bool:
    """Whether a numeric entity has no character that could stand in its place: private use, no character, marks, variation selectors, and what normalisation changes."""
    n = _number(entity)
    if n is None:
        return False
    if n < 1 or n > 0x10FFFF or 0xD800 <= n <= 0xDFFF or n == 0xFA1E:
        return True
    c = chr(n)
    return (
        unicodedata.category(c) in ("Co", "Cn") and (n & 0xFFFE == 0xFFFE or 0xFDD0 <= n <= 0xFDEF or unicodedata.category(c) == "Co")
        or unicodedata.combining(c) != 0 or 0xFE00 <= n <= 0xFE0F or 0xE0100 <= n <= 0xE01EF or n in (0x180B, 0x180C, 0x180D) or 0x1F3FB <= n <= 0x1F3FF
        or unicodedata.normalize("NFC", c) != c
    )


def decode_entities(s: str | None) -> str | None:
    """Characters for entities, but not for those whose characters can't stand alone: markup, white space, marks, private use."""
    if s is None:
        return None

    def one(m: re.Match) -> str:
        c = html.unescape(m[0])
        odd = c == m[0] or c in "<>&\"'" or c.isspace() or must_stay(m[0]) or any(unicodedata.category(x)[0] in "CMZ" for x in c) or unicodedata.normalize("NFC", c) != c
        return m[0] if odd else c

    return re.sub(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);", one, s)


#: Letters without a decomposition, with what may stand for them in plain titles; several where customs differ.
_FOLDS = {
    "’": ["'"], "‘": ["'"], "ʻ": ["'", ""], "ʼ": ["'", ""], "“": ['"'], "”": ['"'], "–": ["-"], "—": ["-"], "−": ["-"], "×": ["x"], "…": ["..."], "ß": ["ss"], "ẞ": ["SS"], "æ": ["ae"], "Æ": ["Ae", "AE"], "œ": ["oe"], "Œ": ["Oe", "OE"],
    "ø": ["o", "oe"], "Ø": ["O", "Oe"], "å": ["a", "aa"], "Å": ["A", "Aa"], "ä": ["a", "ae"], "Ä": ["A", "Ae"], "ö": ["o", "oe"], "Ö": ["O", "Oe"], "ü": ["u", "ue"], "Ü": ["U", "Ue"], "đ": ["d"], "Đ": ["D"], "ð": ["d", "dh"], "Ð": ["D"],
    "þ": ["th"], "Þ": ["Th"], "ł": ["l"], "Ł": ["L"], "ħ": ["h"], "ı": ["i"], "ŋ": ["ng"], "ə": ["e"], "ʿ": ["'", ""], "ʾ": ["'", ""],
}


def _stripped(c: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))


def ascii_titles(s: str | None) -> str | None:
    """The title without accents and typographic marks, as far as compatibility decomposition goes."""
    return None if s is None else "".join(_FOLDS[c][0] if c in _FOLDS else _stripped(c) for c in s)


def ascii_candidates(s: str | None, most: int = 64) -> list[str] | None:
    """Every plain spelling of a title that the customs of its letters allow, the plainest first; spaces are collapsed. Beyond ``most`` spellings one custom holds for the whole title."""
    if s is None:
        return None
    out = [""]
    for c in s:
        ways = _FOLDS.get(c) or [_stripped(c)]
        out = [o + w for o in out for w in ways] if len(out) * len(ways) <= most else [o + ways[0] for o in out]
    return list(dict.fromkeys(" ".join(o.split()) for o in out))


def to_latin(s: str | None, table: dict[int, str] | None = None) -> str | None:
    """Characters beyond U+024F by a table of romanisations, or, without an entry, without their marks."""
    return None if s is None else "".join(c if ord(c) <= 591 else (table or {}).get(ord(c), _stripped(c)) for c in s)


def _column(f: Callable, kind: str = "string") -> Callable[[Column], Column]:
    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(f, na_action="ignore")

    return run


def prose_column(text: Column) -> Column:
    return _column(to_prose)(text)


def body_column(text: Column, quotations: bool = False, nonprose: bool = True) -> Column:
    return _column(lambda s: body(to_prose(s), quotations, nonprose))(text)


def decoded_column(text: Column) -> Column:
    return _column(decode_entities)(text)


def ascii_column(text: Column) -> Column:
    return _column(ascii_titles)(text)


def candidates_column(text: Column) -> Column:
    return _column(ascii_candidates, "array<string>")(text)


def sections_column(text: Column) -> Column:
    return _column(language_sections, "map<string,string>")(text)


def linked_words_column(text: Column) -> Column:
    return _column(linked_words, "array<string>")(text)
