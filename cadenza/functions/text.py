"""Text rules, each a Column -> Column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space and word characters, spelled out because Java's \s and \w are ASCII.
SPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
WORD = r"[\p{L}\p{N}_]"

# The same white space as a character list, for trimming without a pattern.
SPACE_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)

# Known misspellings and their corrections.
CORRECTIONS = {"palictaxel": "paclitaxel", "alfa": "alpha"}

# For names holding both words, replace the text by the other text.
NAME_REWRITES = [
    # (word, word, text, replacement)
    ("bortezomib", "thalidomide", "dexamethasone,", ""),
    ("melphalan", "flufenamide", ",dexamethasone", " monotherapy"),
    ("tegafur", "uracil", ",folinic acid", " monotherapy"),
    ("vmp", "then rd", ",then rd", " + rd"),
    ("vmp", "/rd", "/", " / "),
]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Drop white space of any kind at both ends (``trim`` alone drops blanks only)."""
    return F.btrim(text, F.lit(SPACE_CHARS))


def squeeze(text: Column) -> Column:
    """Each run of white space becomes one blank, none at the ends."""
    return strip(F.regexp_replace(text, f"{SPACE}+", " "))


def clean_text(text: Column) -> Column:
    """Words and blanks only, stripped and lower-case; null becomes the empty text."""
    kept = F.regexp_replace(text, r"[^\p{L}\p{N}_\s\x0B\x1C-\x1F\x85\p{Z}]", "")
    return F.coalesce(F.lower(strip(kept)), F.lit(""))


def clean_vocabulary(text: Column) -> Column:
    """Lower-case with brackets and commas as blanks, stripped."""
    return strip(F.regexp_replace(F.lower(text), r"[()\[\],]", " "))


def index_key(text: Column) -> Column:
    """The form under which equal values of a column are grouped."""
    return strip(F.lower(text))


def split_units(text: Column) -> Column:
    """Units of a text between the whole words ``and``/``or``/``|``; array, duplicates kept."""
    flat = F.regexp_replace(F.lower(text), r"[()\[\],]", " ")
    flat = squeeze(F.regexp_replace(flat, f"{SPACE}*\\|{SPACE}*", " or "))
    parts = F.split(flat, f"(?<!{WORD})(?:and|or)(?!{WORD})")
    return F.filter(F.transform(parts, strip), lambda unit: unit != "")


def split_words(text: Column) -> Column:
    """Words of a text between white space; array."""
    return F.filter(F.split(text, f"{SPACE}+"), lambda word: word != "")


def correct(term: Column, corrections: dict[str, str] | None = None) -> Column:
    """Whole-term spelling correction."""
    out = term
    for wrong, right in (CORRECTIONS if corrections is None else corrections).items():
        out = F.when(term == wrong, F.lit(right)).otherwise(out)
    return out


def is_number_unit(unit: Column) -> Column:
    """Digits only, or digits and a plus sign."""
    return unit.rlike(r"^\p{Nd}+\+?$")


def blacklist_terms(entry: Column) -> Column:
    """Terms of a blacklist entry: ``Name (Brand)`` gives ``name`` and ``brand``; array."""
    return F.transform(
        F.split(entry, r"\("),
        lambda part: F.lower(strip(F.regexp_replace(part, r"^\)+|\)+$", ""))),
    )


def capital(text: Column) -> Column:
    """First character upper-case, the rest as it is."""
    return F.concat(F.upper(F.left(text, F.lit(1))), F.substring(text, 2, 2147483647))


def drug_key(component: Column) -> Column:
    """Component name without blanks, lower-case with a capital first letter."""
    return capital(F.lower(F.replace(strip(component), F.lit(" "), F.lit(""))))


def title_case(text: Column) -> Column:
    """Stripped, each run of letters with a capital first letter (``5-fu`` gives ``5-Fu``)."""
    cased = r"[\p{Lu}\p{Ll}\p{Lt}]"
    runs = F.split(F.lower(strip(text)), f"(?<!{cased})(?={cased})")
    return F.array_join(F.transform(runs, capital), "")


def compare_key(short_string: Column) -> Column:
    """Short string without trailing semicolons, lower-case."""
    return F.lower(F.regexp_replace(short_string, ";+$", ""))


def _list_form(name: Column) -> Column:
    """`` and `` as a comma, no blanks around commas."""
    return F.regexp_replace(strip(F.replace(name, F.lit(" and "), F.lit(","))), f"{SPACE}*,{SPACE}*", ",")


def normalise_new_name(name: Column) -> Column:
    """Comparable form of a name of the new table."""
    out = F.lower(name)
    for mark in ("(tp)", "(kr)"):
        out = F.replace(out, F.lit(mark), F.lit(""))
    return let(_list_form(strip(out)), _rewrite)


def _rewrite(name: Column) -> Column:
    # The conditions look at the name before any rewrite: no rewrite adds or removes the
    # words of another rule. An empty search text leaves the name as it is.
    out = name
    for one, two, text, replacement in NAME_REWRITES:
        both = name.contains(one) & name.contains(two)
        out = F.replace(out, F.when(both, F.lit(text)).otherwise(F.lit("")), F.lit(replacement))
    return out


def normalise_old_name(name: Column) -> Column:
    """Comparable form of a name of the older table."""
    out = F.lower(F.replace(name, F.lit("&"), F.lit("and")))
    out = F.when(out == "carfilzomib", F.lit("carfilzomib monotherapy")).otherwise(out)
    return _list_form(out)
