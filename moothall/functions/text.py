"""Text clean-up on Columns."""

from __future__ import annotations

import json
import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Python's strip() takes all Unicode white space off; trim() takes only spaces.
_SPACE = r"[\s\x1c-\x1f\x85   -     　]"
#: Titles before names, longest first, so that none leaves a piece of a longer one.
TITLES = ("Depute Provost ", "Councillor ", "Provost ", "Bailie ", "Cllr. ", "Cllr ", "Cllr")
#: An address, and not a name that continues as one.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"


# Letters of other scripts in Latin ones, and Latin letters that stand for two.
_CYRILLIC = dict(zip("абвгдеёжзийклмнопрстуфхцчшщъыьэюяіїєґў", "a b v g d e io zh z i i k l m n o p r s t u f kh ts ch sh shch . y . e iu ia i yi ye g u".split()))
_GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split()))
_LATIN = {"ß": "ss", "ẞ": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d", "ı": "i", "ĸ": "k", "ŋ": "ng", "ĳ": "ij", "ƿ": "w", "ȝ": "gh"}
_KANA = {"si": "shi", "ti": "chi", "tu": "tsu", "hu": "fu", "zi": "ji", "di": "ji", "du": "zu", "n": "n"}


def _romanised() -> dict[str, str]:
    """Lower-case letters and the ASCII letters that stand for them: a letter with marks or strokes by its base letter, which
    Unicode's decompositions and names say, a kana by its name, others as above."""
    out = {k: v.strip(".") for k, v in (_CYRILLIC | _GREEK | _LATIN).items()}
    for i in (*range(0xC0, 0x250), *range(0x370, 0x530), *range(0x1E00, 0x1F00), *range(0x3041, 0x30FF)):
        c = chr(i).lower()
        if len(c) != 1 or c in out or not c.isalpha():
            continue
        name, plain = unicodedata.name(c, ""), unicodedata.normalize("NFKD", c)[0]
        latin = re.match(r"LATIN SMALL LETTER ([A-Z]) WITH", name)
        kana = re.match(r"(?:HIRAGANA|KATAKANA) LETTER (?:SMALL )?([A-Z]+)$", name)
        if plain.isascii() and plain.isalpha():
            out[c] = plain
        elif plain in out:
            out[c] = out[plain]
        elif latin:
            out[c] = latin[1].lower()
        elif kana:
            out[c] = _KANA.get(kana[1].lower(), kana[1].lower())
    return out


_ROMANISED = _romanised()
_MARKED = "".join(k for k, v in _ROMANISED.items() if len(v) == 1)
_PLAIN = "".join(_ROMANISED[k] for k in _MARKED)
_LONGER = {k: v for k, v in _ROMANISED.items() if len(v) != 1}


def strip(x: Column) -> Column:
    return F.regexp_replace(x, f"^{_SPACE}+|{_SPACE}+$", "")


def squeeze(x: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return strip(F.regexp_replace(x, f"{_SPACE}+", " "))


def nonempty(x: Column) -> Column:
    """Null for the empty string, as ``or`` chains treat both alike."""
    return F.nullif(x, F.lit(""))


def first_of(*xs: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[nonempty(x) for x in xs])


def slugify(x: Column) -> Column:
    """Letters in ASCII and lower case, all else as single hyphens, none at the ends. Letters that there is no rule for (such
    as Chinese ones) become ``u`` and their code point, so that different names don't get the same key."""
    longer = F.from_json(F.lit(json.dumps(_LONGER)), "map<string,string>")
    code = lambda c: F.concat(F.lit("u"), F.lower(F.hex(F.ascii(c))))
    letter = lambda c: F.coalesce(F.try_element_at(longer, c), F.when(c.rlike(r"[^\x00-\x7F]") & c.rlike(r"\p{L}"), code(c)), c)
    beyond = F.array_join(F.transform(F.split(F.regexp_replace(F.translate(F.lower(x), _MARKED, _PLAIN), r"\p{M}", ""), ""), letter), "")
    return F.trim(F.regexp_replace(F.when(x.rlike(r"[^\x00-\x7F]"), beyond).otherwise(F.lower(x)), "[^a-z0-9]+", "-"), F.lit("-"))


def without_titles(x: Column) -> Column:
    for t in TITLES:
        x = F.replace(x, F.lit(t), F.lit(""))
    return strip(x)


def surname_last(x: Column) -> Column:
    """``Last, First`` as ``First Last``."""
    return strip(F.array_join(F.reverse(F.transform(F.split(x, ","), strip)), " "))


def after_number(x: Column) -> Column:
    """A ward name without its number in front."""
    return F.regexp_replace(x, "^[0-9]+ (.*)", "$1")


def emails(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit(EMAIL), F.lit(0))


def without_mailto(x: Column) -> Column:
    return F.regexp_replace(x, "^mailto:", "")


def pair(x: Column, by: str = " | ") -> Column:
    """struct<first, second> of a text of exactly two parts, else null."""
    parts = F.split(x, F.lit("\\Q" + by + "\\E"))
    return F.when(F.size(parts) == 2, F.struct(parts[0].alias("first"), parts[1].alias("second")))


def label_by_keyword(x: Column, labels: dict[str, str], default: str) -> Column:
    """The label of the first keyword that a text contains."""
    out = F.lit(default)
    for word, label in reversed(labels.items()):
        out = F.when(F.contains(x, F.lit(word)), label).otherwise(out)
    return out


def identifier_safe(x: Column) -> Column:
    return F.regexp_replace(x, r"[^\p{Alnum}_-]", "")


def path_checked(x: Column) -> Column:
    """The path, or null if it is absolute or climbs out of its folder."""
    return F.when(~(x.startswith("/") | x.rlike(r"(^|/)\.\.(/|$)")), x)


def filled(template: Column, values: dict[str, Column]) -> Column:
    """``$name`` places of a template filled in; longer names first."""
    for name in sorted(values, key=len, reverse=True):
        template = F.replace(template, F.lit(f"${name}"), values[name])
    return template


def first_line(x: Column, most: int = 150) -> Column:
    return F.substring(F.split_part(x, F.lit("\n"), F.lit(1)), 1, most)
