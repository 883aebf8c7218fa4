"""Normalization, tokens and character n-grams of names and addresses, in built-in functions."""

from __future__ import annotations

import functools
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Legal forms, descriptors of little weight, and the canonical short forms of address words.
LEGAL_FORMS = """llc pllc inc incorporated corp corporation co company cie ltd limited plc lp llp pc pvt private sarl sas sasu eurl sa sci snc ei
लिमिटेड लि प्राइवेट एलएलपी లిమిటెడ్ ಲಿಮಿಟೆಡ್ லிமிடெட் লিমিটেড લિમિટેડ પ્રાઇવેટ ലിമിറ്റഡ് പ്രൈവറ്റ്""".split()
LIGHT_WORDS = "com group groupe holding holdings services service partners center centre international trading enterprises associates".split()
SHORT_FORMS = {
    "street": "st", "saint": "st", "road": "rd", "drive": "dr", "avenue": "ave", "av": "ave", "lane": "ln", "court": "ct",
    "boulevard": "blvd", "bd": "blvd", "place": "pl", "rue": "r", "allee": "all", "impasse": "imp", "route": "rte",
    "chemin": "ch", "highway": "hwy", "suite": "ste", "apartment": "apt", "floor": "fl", "flr": "fl",
    "number": "no", "near": "nr", "opposite": "opp", "building": "bldg", "sector": "sec", "block": "blk",
    "north": "n", "south": "s", "east": "e", "west": "w",
}
LANDMARK_WORDS = ["near", "nr", "opp", "opposite", "behind", "beside", "landmark"]
#: Noise patterns as (column, pattern) in Java's syntax.
NOISE = {
    "addr_null_literal": ("business_address", r"(?iu)(^|[^\p{L}])<?null>?([^\p{L}]|$)"),
    "name_domain_like": ("business_name", r"(?iu)^[\p{L}\p{N}-]+\.[a-z]{2,4}$"),
    "name_leading_symbol": ("business_name", r"^[^\p{L}\p{N}]"),
    "name_non_latin": ("business_name", r"[^\p{IsLatin}\p{IsCommon}\p{IsInherited}]"),
    "name_all_upper": ("business_name", r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$"),
    "addr_all_upper": ("business_address", r"^[^\p{Ll}]*\p{Lu}[^\p{Ll}]*$"),
    "name_has_brackets": ("business_name", r"[\(\[]"),
    "name_dotted_abbrev": ("business_name", r"(?U)\b\p{L}\.\p{L}\."),
}
POSTAL = r"(?U)\b\d{5,6}\b"


def _plain(text: str | None) -> str | None:
    """Compatibility forms without the marks that follow Latin letters; marks of other scripts are vowels and stay."""
    if text is None or text.isascii():
        return text
    out: list[str] = []
    latin = False
    for c in unicodedata.normalize("NFKD", text):
        if unicodedata.combining(c):
            if latin:
                continue
        else:
            latin = c.isalpha() and "LATIN" in unicodedata.name(c, "")
        out.append(c)
    return unicodedata.normalize("NFC", "".join(out))


def _one_letter(code: int) -> str | None:
    """The single character that _plain() makes of an accented Latin letter, else None."""
    char = chr(code)
    plain = _plain(char)
    return plain if plain != char and len(plain) == 1 and "LATIN" in unicodedata.name(char, "") else None


def _ranges(codes: list[int]) -> str:
    """A character class of code points, in Java's syntax."""
    out: list[list[int]] = []
    for code in codes:
        if out and out[-1][1] == code - 1:
            out[-1][1] = code
        else:
            out.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in out) + "]"


@functools.cache
def _fold_tables() -> tuple[str, str, str]:
    """(accented letters, their plain ones, pattern of texts that need more than that), by rule from the Unicode tables."""
    latin = {code: plain for code in range(0x80, 0x10000) if not 0xD800 <= code < 0xE000 and (plain := _one_letter(code))}
    marks_and_jamo = [c for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and (unicodedata.category(chr(c)).startswith("M") or 0x1100 <= c < 0x1200)]
    changed = [c for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and c not in latin and _plain(chr(c)) != chr(c)]
    return "".join(map(chr, latin)), "".join(latin.values()), _ranges(sorted({*marks_and_jamo, *changed}))


@F.pandas_udf(StringType())
def _fold_any(text: pd.Series) -> pd.Series:
    return text.map(_plain, na_action="ignore")


def fold_accents(text: Column) -> Column:
    """Compatibility forms without the marks of Latin letters. Single accented letters are mapped in the JVM; only texts with marks of their own, ligatures and the like go to Python, the others as nulls."""
    accented, plain, other = _fold_tables()
    return F.coalesce(_fold_any(F.when(text.rlike(other), text)), F.translate(text, accented, plain))


def cleaned(text: Column) -> Column:
    """Lower case, dotted abbreviations collapsed, `&` as a word, blanks single."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "&", " and ")
    out = F.regexp_replace(out, r"(?<![\p{L}\p{N}])(\p{L})\.(?=\p{L}(?:\.|(?![\p{L}\p{N}])))", "$1")
    out = F.regexp_replace(out, r"(?<=\p{L})\.(?![\p{L}\p{N}])", " ")
    return F.trim(F.regexp_replace(out, r"(?U)\s+", " "))


def tokens(text: Column) -> Column:
    """Lower-case runs of letters, marks and numbers."""
    return F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+", " "), " "), lambda t: t != "")


def _words(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def core_tokens(name_tokens: Column) -> Column:
    return F.filter(name_tokens, lambda t: ~F.array_contains(_words(LEGAL_FORMS), t))


def legal_tokens(name_tokens: Column) -> Column:
    return F.filter(name_tokens, lambda t: F.array_contains(_words(LEGAL_FORMS), t))


def light_share(name_tokens: Column) -> Column:
    """Share of descriptors that say little."""
    light = F.size(F.filter(name_tokens, lambda t: F.array_contains(_words(LIGHT_WORDS), t)))
    return F.when(F.size(name_tokens) > 0, light / F.size(name_tokens)).otherwise(0.0)


def without_country(name: Column, country: Column) -> Column:
    """Without parenthesised words equal to the record's own country."""
    own = F.concat(F.lit(r"(?iu)\(\s*\Q"), F.regexp_replace(F.coalesce(country, F.lit("")), r"\\E", ""), F.lit(r"\E\s*\)"))
    return F.when(F.coalesce(country, F.lit("")) == "", name).otherwise(F.regexp_replace(name, own, " "))


def canonical_address(address: Column) -> Column:
    """Short forms, null literals and `c/o` and `#` dropped, number glued to a suffix split, `house no` and the like as `no`."""
    out = F.regexp_replace(cleaned(address), r"<?\bnull\b>?|\bc/o\b|#", " ")
    out = F.regexp_replace(out, r"\b(?:h|house|door)[ .]+no\b|\bn°", " no ")
    out = F.regexp_replace(out, r"\b(\d+)(bis|ter)\b", "$1 $2")
    short = F.create_map(*[F.lit(x) for pair in SHORT_FORMS.items() for x in pair])
    return F.array_join(F.transform(tokens(out), lambda t: F.coalesce(F.try_element_at(short, t), t)), " ")


def digit_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[0-9]+"), F.lit(0))


def postal_of(digits: Column) -> Column:
    """The longest token of five or six digits, the first of equals; empty if there is none."""
    fit = F.filter(digits, lambda d: F.length(d).isin(5, 6))
    six = F.filter(fit, lambda d: F.length(d) == 6)
    return F.when(F.size(six) > 0, F.get(six, F.lit(0))).when(F.size(fit) > 0, F.get(fit, F.lit(0))).otherwise("")


def blank_words(text: Column) -> Column:
    """Lower-case runs of anything but white space."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"(?U)\s+"), lambda w: w != "")


def char_ngrams(text: Column, low: int = 2, high: int = 4) -> Column:
    """n-grams within words padded by a blank on each side; a padded word no longer than n gives itself once and no more."""

    def of_word(word: Column) -> Column:
        padded, n = F.concat(F.lit(" "), word, F.lit(" ")), F.length(word) + 2

        def of_size(size: int) -> Column:
            runs = F.transform(F.sequence(F.lit(1), F.greatest(n - (size - 1), F.lit(1))), lambda i: F.substring(padded, i, F.lit(size)))
            return F.when(n >= size, runs).otherwise(F.array().cast("array<string>"))

        return F.concat(*map(of_size, range(low, high + 1)))

    return F.flatten(F.transform(blank_words(text), of_word))
