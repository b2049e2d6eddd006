"""Token classes as Column expressions: formulas, chess, mathematics, files, rhyme schemes, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ELEMENTS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba "
    "La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr"
).split()
_E = "(?:" + "|".join(sorted(ELEMENTS, key=lambda x: (-len(x), x))) + ")"
_PART = f"(?:{_E}[0-9]*|\\((?:{_E}[0-9]*)+\\)[0-9]*|\\((?:I|II|III|IV|V|VI|VII)\\))"
FORMULA = f"^{_PART}{_PART}+$"
CHESS = "^[KQRBN]?[a-h]?[1-8]?x?[a-h][1-8](?:=[QRBN])?[+#]?$|^O-O(?:-O)?$"
MATH = "^[0-9a-zA-Z]{1,2}(?:[-+*/=<>^×÷±≤≥][0-9a-zA-Z]{1,3})+$"
FILE = "(?i)^(?:https?://|www\\.).+|^[\\w.-]+\\.(?:com|org|net|edu|gov|html?|php|jpe?g|png|gif|svg|pdf|exe|txt|zip|mp3|wav)$"
NUMBER = "^(?:[$€£¥±+~−-])?[0-9]+(?:[.,:][0-9]+)*(?:%|°|st|nd|rd|th|s)?$"


def is_formula(w: Column) -> Column:
    """Chemical formula with a digit or bracket; what is letters alone counts as an acronym or word."""
    return w.rlike(FORMULA) & w.rlike("[0-9(]")


def lowfi_key(w: Column) -> Column:
    """The distinct letters of a word, lower-case and in order."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(F.split(F.lower(w), ""), lambda c: c != ""))), "")


def _one_off(w: Column) -> Column:
    """A word with one letter gone, one wildcard more, or a wildcard for a letter."""
    n = F.length(w)
    each = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    head = lambda i: F.substring(w, F.lit(1), i - 1)
    return F.concat(
        F.transform(each, lambda i: F.concat(head(i), F.substring(w, i + 1, n))), F.transform(F.sequence(F.lit(1), n + 1), lambda i: F.concat(head(i), F.lit("*"), F.substring(w, i, n + 1))),
        F.transform(each, lambda i: F.concat(head(i), F.lit("*"), F.substring(w, i + 1, n))),
    )


def lowfi_edits(w: Column, distance: int = 1) -> Column:
    """Distinct keys of all forms that lie ``distance`` deletions, insertions or replacements (by *) from a word; keys of nearer forms are left out beyond one."""
    forms, nearer = F.array(F.lower(w)), F.array().cast("array<string>")
    keys = nearer
    for k in range(distance):
        forms = F.array_distinct(F.flatten(F.transform(forms, _one_off)))
        keys = F.array_except(F.array_distinct(F.transform(forms, lowfi_key)), nearer)
        nearer = F.array_union(nearer, keys)
    return F.filter(F.array_except(keys, F.array(lowfi_key(w))), lambda x: x != "")


def edits(w: Column, letters: str = "abcdefghijklmnopqrstuvwxyz") -> Column:
    """Distinct words one deletion, swap of neighbours, replacement or insertion from a word."""
    n = F.length(w)
    each = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    alphabet = F.array(*[F.lit(c) for c in letters])
    head = lambda i: F.substring(w, F.lit(1), i - 1)
    swaps = F.transform(F.filter(each, lambda i: i < n), lambda i: F.concat(head(i), F.substring(w, i + 1, F.lit(1)), F.substring(w, i, F.lit(1)), F.substring(w, i + 2, n)))
    replaced = F.flatten(F.transform(each, lambda i: F.transform(alphabet, lambda c: F.concat(head(i), c, F.substring(w, i + 1, n)))))
    inserted = F.flatten(F.transform(F.sequence(F.lit(1), n + 1), lambda i: F.transform(alphabet, lambda c: F.concat(head(i), c, F.substring(w, i, n + 1)))))
    return F.array_distinct(F.concat(F.transform(each, lambda i: F.concat(head(i), F.substring(w, i + 1, n))), swaps, replaced, inserted))


def introduced_in_order(w: Column) -> Column:
    """Whether new letters come in alphabetical order from 'a' on (aabb, abca)."""
    letters = F.filter(F.split(F.lower(w), ""), lambda c: c != "")
    top = lambda s, c: F.when(s < 0, s).when(F.ascii(c) <= s + 96, s).when(F.ascii(c) == s + 97, s + 1).otherwise(F.lit(-1))
    return F.aggregate(letters, F.lit(0), top) > 0


def rhyme_score(w: Column) -> Column:
    """How much a word looks like a rhyme scheme: early letters and doubled or repeated ones count for it, late ones against."""
    n = lambda p: F.regexp_count(w, F.lit(p))
    early, late = (n("[a-g]") * 100 > F.length(w) * 99).cast("int") * 50, (n("[m-z]") > 0).cast("int") * -30
    return early + late + n("(.)\\1") * 10 + n("(..).*\\1") * 10 + F.when(F.size(F.array_distinct(F.split(w, ""))) * 2 < F.length(w), 50).otherwise(0)


def shape(w: Column) -> Column:
    """Class of a token by its form alone, the first that fits."""
    return (
        F.when(w.rlike(NUMBER), "NUMBER").when(w.rlike(FILE), "FILE").when(is_formula(w), "FORMULA").when(w.rlike(CHESS), "CHESS").when(w.rlike(MATH), "MATH")
        .when(w.rlike("^(?:[A-Z]\\.)+$|^[A-Z]{2,}$"), "ACRONYM").when(w.rlike("^\\p{L}+(?:-\\p{L}+)+$"), "HYPHEN").when(w.rlike("^\\p{Lu}\\p{L}*$"), "PROPER")
        .when(w.rlike("^\\p{L}+[.,]\\p{L}+$"), "SPLICE").when(w.rlike("^[a-z]+$"), "ASCII").when(w.rlike("^\\p{L}+$"), "LETTERS").otherwise("OTHER")
    )


def shape_sql(w: str) -> str:
    file = FILE.replace("\\w", "0-9A-Za-z_")
    tests = [(NUMBER, "NUMBER"), (file, "FILE"), (None, "FORMULA"), (CHESS, "CHESS"), (MATH, "MATH"), ("^(?:[A-Z]\\.)+$|^[A-Z]{2,}$", "ACRONYM"), ("^\\p{L}+(?:-\\p{L}+)+$", "HYPHEN"), ("^\\p{Lu}\\p{L}*$", "PROPER"), ("^\\p{L}+[.,]\\p{L}+$", "SPLICE"), ("^[a-z]+$", "ASCII"), ("^\\p{L}+$", "LETTERS")]
    m = lambda p: f"regexp_matches({w}, '{p}')"
    return "CASE " + " ".join(f"WHEN {m(p) if p else m(FORMULA) + ' AND ' + m('[0-9(]')} THEN '{c}'" for p, c in tests) + " ELSE 'OTHER' END"


# -- Categories of words that no dictionary has --

CHESS_PIECE = "^[KQRBNP][a-h][1-8]$"
_ALL = [*ELEMENTS, *"Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og".split(), "R"]  # R stands for any group
_ATOM = "(?:(?:" + "|".join(sorted(_ALL, key=lambda x: (-len(x), x))) + ")(?:[2-9]|[1-9][0-9])?)"
_SINGLE = "".join(e for e in _ALL if len(e) == 1)
CHEMICAL_FORMULA = rf"^{_ATOM}+(?:$|[(]{_ATOM}+[)]$|(?:[·∙][0-9]*{_ATOM}+)+$|[(](?:II|III|IV|VI|VII|VIII|IX)[)]$)"
#: What looks like a formula but is a model, an acronym or a catalogue number.
NO_FORMULA = rf"^(?:[{_SINGLE}]+[1-9][0-9]|[{_SINGLE}]{{3,}}s?|[{_SINGLE}]{{3,}}[0-9]+)$|^[^CHNO][4-9][0-9]"
_MORPHEMES = (
    "mono di bi tri tetr pent hex hept oct nona deca hydrogen hydroxy methyl phenyl acetate ene ine ane ide hydro nyl acetyl gluco aminyl galacto pyro benz brom amino fluor glyc cholester chlor oxy nitr silic phosph nickel copper iron carb sulf alumin arsen "
    "magnesium mercury lead calcium propyl itol ethyl oglio stearyl alkyl ethan amine ether keton oxo pyri cyclo poly iso methan ase meth dione butan"
).split()
_STEP = "(?i)(?:[0-9]+-|(?:D-|-)?[0-9]+,[0-9]-?|N[0-9]+,N[0-9]+-?|,[0-9]+|" + "|".join(_MORPHEMES) + "|ate$|ium$|ase$|ine$|late$|^Bis|delta[0-9]+)+"
_SITES = "phenoxy) propyl) phenyl) oxyimino) ethyl) dinyl) (propylene bis( ,NAD methyl".split()
URL = "/.*[.]|[.].*/|[.](?:pdf|html|org|net|int|edu|gov|mil|arpa|co[.]uk|de|jp|ru|txt|jar)$|^www[.]"
FORMULA_OF_LETTERS = "^(?:[A-Za-z]{1,2}[(][A-Za-z]{1,2}[)]|log[(][a-z0-9][)]|[A-Za-zΑ-Ωα-ω0-9]{2,3})$"
NO_ZERO = "(?:^|[^0-9A-Za-z])[.][0-9]"
DNA = "^[acgt]+$"


def is_chemical_formula(w: Column) -> Column:
    return w.rlike(CHEMICAL_FORMULA) & ~w.rlike(NO_FORMULA)


def is_chemical_name(w: Column) -> Column:
    """Whether morphemes of chemical names make up most of a word. They are taken out again and again, since what is left may form new ones, until there is none;
    each pass that finds one shortens the word, so its length bounds the passes."""
    once = F.regexp_replace(w, _STEP, "")
    passes = F.sequence(F.lit(1), F.greatest(F.length(once), F.lit(1)))
    rest = F.when(once == w, once).otherwise(F.aggregate(passes, once, lambda r, _: F.when(r.rlike(_STEP), F.regexp_replace(r, _STEP, "")).otherwise(r)))
    n, left = F.length(w), F.length(rest)
    site = w.rlike("|".join(s.replace("(", "[(]").replace(")", "[)]") for s in _SITES))
    return ((n > 14) & (left * 2 < n)) | (left * 4 < n) | F.lower(w).isin("cis,cis", "trans,cis", "alpha,beta", "trans,trans", "alpha,alpha", "gamma,delta") | w.rlike("^[0-9](?:alpha|beta)") | site


def is_mathematics(w: Column) -> Column:
    return w.rlike(FORMULA_OF_LETTERS) | (w.rlike("[Α-Ωα-ω]") & w.rlike("[-/]"))


def is_address(w: Column) -> Column:
    return w.rlike(URL)


def is_rhyme_scheme(w: Column) -> Column:
    """Rhyme schemes: letters introduced in order, or a score of over 100.

    50 for letters a to g alone, -30 for any of m to z, 10 for every distinct pair or triple that begins with a doubled letter, 10 for every distinct one that repeats, and 50 if over half of them do.
    """
    s = F.lower(w)
    n = F.length(s)
    cut = lambda k: F.when(n >= k, F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(s, i, F.lit(k)))).otherwise(F.array().cast("array<string>"))
    every = F.concat(cut(2), cut(3))
    kinds = F.array_distinct(every)
    repeated = F.size(F.filter(kinds, lambda x: F.size(F.filter(every, lambda y: y == x)) > 1))
    doubled = F.size(F.filter(kinds, lambda x: F.substring(x, 1, 1) == F.substring(x, 2, 1)))
    score = F.when(s.rlike("^[a-g]+$"), 50).otherwise(0) - F.when(s.rlike("[m-z]"), 30).otherwise(0) + doubled * 10 + repeated * 10 + F.when(repeated * 2 > F.size(kinds), 50).otherwise(0)
    # without a pair that repeats or three doubled letters the score stays under 100, so it isn't counted
    likely = s.rlike(r"(.)(?=(.)).*?\1\2|(.)\3.*?(.)\4.*?(.)\5")
    return s.isin("cdcd", "efef") | introduced_in_order(w) | F.when(likely, score > 100).otherwise(False)


def category(w: Column, bad_word: Column, bad_character: Column, compound: Column, foreign: Column, romanised: Column, near: Column, language: Column) -> Column:
    """Category of a word that no dictionary has; the first that fits.

    ``compound``: two words in one; ``foreign``: a title of some dictionary; ``near``: edits to the next dictionary word or null; ``language``: what
    it looks like, as a code. TE and TF+code say English and other languages; what letters beyond ASCII an English word has is TF+?.
    """
    by_language = F.when(language != "en", F.concat(F.lit("TF+"), language)).when(w.rlike("^[a-zA-Z'-]+$"), "TE").otherwise("TF+?")
    letters = (
        F.when(romanised, "L").when(is_rhyme_scheme(w), "P").when(near.isNotNull() & (near > 0), F.concat(F.lit("T"), near.cast("string"))).when(F.lower(w).rlike(DNA), "D").otherwise(by_language)
    )
    tag = w.rlike("^<[?]?/?[ ]*[a-zA-Z]+[ ]*/?[ ]*>")
    name = F.regexp_replace(w, "[</> ]", "")
    tags = F.when(F.lower(name).isin(*BAD_LINKS), "HL").when(~F.lower(name).isin(*HTML) & ~F.lower(name).isin(*BAD_TAGS), "N").when(F.lower(name).isin(*BAD_TAGS), "HB").otherwise("H")
    odd = F.regexp_replace(w, "[\\p{L}\\p{Pd}]", "")
    return (
        F.when(bad_word, "BW").when(bad_character, "BC").when(w.rlike(NO_ZERO), "Z").when(w.rlike(CHESS_PIECE), "CH").when(is_chemical_name(w), "CN").when(is_chemical_formula(w), "CF").when(compound, "ME")
        .when(is_mathematics(w), "A").when(foreign, by_language).when(is_address(w) & ~tag, "U").when(w.rlike("[,()\\[\\] ]"), "TS")
        .when(w.rlike("^[a-zA-Z]+$"), letters).when(w.rlike("^[a-zA-Z]+[.][a-zA-Z.]*$"), "TS").when(tag, tags)
        .when(odd == "/", "T/").when(odd != "", "N").otherwise(by_language)
    )


HTML = "abbr b bdi bdo big blockquote br caption cite code data dd del dfn div dl dt em font h1 h2 h3 h4 h5 h6 hr i ins kbd li mark ol p poem pre q rb ref references rp rt rtc ruby s samp small span strike strong sub sup table td th time tr tt u ul var wbr".split()
BAD_TAGS = "font tt strike center big i b p li ol ul h1 h2 h3 h4 h5 h6 em strong u s br".split()
BAD_LINKS = "http https www".split()


def whitespace_kind(w: Column, code: Column) -> Column:
    """TS by what is wrong with its space: after a dot or comma, before punctuation, or at a bracket; foreign words of languages that aren't sorted are TF."""
    return (
        F.when((code == "TS") & w.contains(".") & ~w.contains(" "), "TS+DOT").when((code == "TS") & w.rlike("\\w,\\w"), "TS+COMMA").when((code == "TS") & w.rlike("\\w ,\\w|\\w [.]\\w|\\w [)]|[(] \\w|\\[ \\w|\\w \\]"), "TS+EXTRA")
        .when((code == "TS") & w.rlike("\\w\\[|\\w[(]|[)]\\w|\\]\\w"), "TS+BRACKET").when(code.startswith("TF") & ~code.isin("TF+el", "TF+de"), "TF").otherwise(code)
    )
