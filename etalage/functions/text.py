"""Text standardisation as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from etalage import contracts as K

# Every character that counts as white space, so that stripping is not limited to plain spaces.
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

_WORDS = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def strip(c: Column) -> Column:
    """Remove white space of any kind from both ends (``trim`` removes spaces only)."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """True for null and for the empty text."""
    return c.isNull() | (c == "")


def capitalise(c: Column) -> Column:
    """First letter upper case, the rest lower case; a letter that widens (``ß``) gives ``Ss``."""
    first = F.upper(F.left(c, F.lit(1)))
    return F.concat(F.left(first, F.lit(1)), F.lower(F.substr(first, F.lit(2))), F.lower(F.substr(c, F.lit(2))))


def initcap_words(c: Column) -> Column:
    """Capitalise every run of letters and digits, so that ``pointe-noire`` gives ``Pointe-Noire``.

    Letters map one to one: ``ß``, which has no single upper-case form, stays.
    """
    def capital(run: Column) -> Column:
        first = F.left(run, F.lit(1))
        upper = F.upper(first)
        return F.concat(F.when(F.length(upper) == 1, upper).otherwise(first), F.substr(run, F.lit(2)))

    runs = F.regexp_extract_all(F.lower(c), F.lit(_WORDS), F.lit(0))
    return F.array_join(F.transform(runs, capital), "")


def upper_name(c: Column) -> Column:
    """Family name: stripped, upper case, '' when missing."""
    return F.coalesce(F.upper(strip(c)), F.lit(""))


def hyphen_capitalize(c: Column) -> Column:
    """First name: each part between hyphens stripped and capitalised, '' when missing."""
    parts = F.transform(F.split(strip(c), "-"), lambda part: capitalise(strip(part)))
    return F.coalesce(F.array_join(parts, "-"), F.lit(""))


def map_codes(c: Column, codes: Mapping[str, str], default: Column | str) -> Column:
    """Look up the stripped lower-case text; ``default`` where the code is unknown or missing."""
    key = F.lower(strip(c))
    return F.coalesce(lookup(key, codes), default if isinstance(default, Column) else F.lit(default))


def lookup(key: Column, table: Mapping[str, str]) -> Column:
    """Value of a literal map, null where the key is absent."""
    literal = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.try_element_at(literal, key)


def valid_email(c: Column) -> Column:
    return F.coalesce(strip(c).rlike(K.EMAIL_PATTERN), F.lit(False))


def standardize_email(c: Column) -> Column:
    """Stripped lower-case address, '' when missing or malformed."""
    address = F.lower(strip(c))
    return F.when(valid_email(address), address).otherwise("")


def valid_phone(c: Column) -> Column:
    compact = F.translate(c, " -", "")
    return F.coalesce(compact.rlike(K.PHONE_PATTERN), F.lit(False))


def normalize_phone(c: Column) -> Column:
    """``+242 0X XXX XXXX`` where the digits allow it, else the stripped text; '' when missing."""
    digits = F.regexp_replace(c, r"[^\p{Nd}+]", "")
    local = (F.when(digits.startswith("+242"), F.substr(digits, F.lit(5)))
             .when(digits.startswith("242"), F.substr(digits, F.lit(4)))
             .when(digits.startswith("0"), digits))

    def grouped(number: Column) -> Column:
        return F.concat_ws(" ", F.lit("+242"), F.substring(number, 1, 2), F.substring(number, 3, 3),
                           F.substr(number, F.lit(6)))

    formatted = (F.when((F.length(local) == 9) & local.startswith("0"), grouped(local))
                 .when(F.length(local) == 8, grouped(F.concat(F.lit("0"), local))))
    return F.coalesce(formatted, strip(c), F.lit(""))
