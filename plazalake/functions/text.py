"""Text, price, date and url rules of listings, as builders of Column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _ascii_forms() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose compatibility form has one ASCII character, and those with several."""
    one, many = {}, {}
    for code in (*range(0xA0, 0x10000), *range(0x1D400, 0x1FC00)):  # beyond, no character has an ASCII form
        char = chr(code)
        form = unicodedata.normalize("NFKD", char.lower()).encode("ascii", "ignore").decode()
        if len(form) == 1:
            one[char] = form
        elif form:
            many[char] = form
    return one, many


_ONE, _MANY = _ascii_forms()
_MARKS, _WIDE = r"\p{Mn}", r"[^\x00-\x7F]"


def _letter_forms() -> dict[str, str]:
    """Letters that are one base letter and combining marks, to that base."""
    out = {}
    for code in range(0xC0, 0x2000):
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(base) == 1 and base != chr(code):
            out[chr(code)] = base
    return out


_LETTERS = _letter_forms()


def falsy_coalesce(*columns: Column | str) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in columns))


def search_key(*parts: Column | str) -> Column:
    """Non-empty parts joined by one space, lower case, compatibility-decomposed, ASCII only."""
    joined = F.lower(F.concat_ws(" ", *(F.nullif(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts)))
    # most texts need no table, most others only the one of single characters
    plain = F.when(joined.rlike(_WIDE), F.translate(joined, "".join(_ONE), "".join(_ONE.values()))).otherwise(joined)
    spelled = F.create_map(*(F.lit(x) for pair in _MANY.items() for x in pair))
    each = F.transform(F.regexp_extract_all(plain, F.lit("(?s)."), 0), lambda c: F.coalesce(F.try_element_at(spelled, c), c))
    return F.when(plain.rlike(_WIDE), F.regexp_replace(F.array_join(each, ""), _WIDE, "")).otherwise(plain)


def place_key(name: Column, aliases: Mapping[str, str] | None = None) -> Column:
    """Lower case without combining marks, commas as spaces, single spaces; then a whole-name alias."""
    plain = F.regexp_replace(F.translate(F.lower(name), "".join(_LETTERS), "".join(_LETTERS.values())), _MARKS, "")
    key = F.trim(F.regexp_replace(F.translate(plain, ",", " "), r"\s+", " "))
    if not aliases:
        return key
    known = F.create_map(*(F.lit(x) for pair in aliases.items() for x in pair))
    return F.coalesce(F.try_element_at(known, key), key)


def first_number(text: Column, mode: str = "run") -> Column:
    """A number in a text, null where there is none. Modes: ``run``, commas dropped, then the first
    run of digits and dots; ``spaced``, the same after no-break spaces become spaces; ``digits``,
    all digits and dots of the text joined up; ``plain``, as ``run``, for text without separators."""
    if mode == "digits":
        found = F.regexp_replace(text, r"[^0-9.]", "")
    else:
        clean = F.translate(text, " ", " ") if mode == "spaced" else text
        found = F.regexp_extract(F.translate(clean, ",", ""), r"[0-9.]+", 0)
    return found.try_cast("double")


def price_currency(text: Column) -> Column:
    """USD if the text says so, MXN if it says anything, else empty."""
    return F.when(text.rlike(r"US\$|\bUSD\b"), "USD").when(F.trim(text) != "", "MXN").otherwise("")


def price_amount(text: Column) -> Column:
    return F.floor(first_number(text, "spaced")).cast("long")


def currency_code(code: Column) -> Column:
    return F.when(code == "USD", "USD").when(F.coalesce(code, F.lit("")) != "", "MXN").otherwise("")


def keep_fraction(value: Column) -> Column:
    """A VARIANT number as decimal text: whole numbers without a fraction; other types give null."""
    kind = F.schema_of_variant(value)
    number = F.when(kind.rlike(r"^(BIGINT|DECIMAL|DOUBLE)"), F.try_variant_get(value, "$", "decimal(18,4)"))
    return F.when(number == F.floor(number), number.cast("bigint").cast("string")).otherwise(F.regexp_replace(number.cast("string"), "0+$", ""))


def coordinate(text: Column) -> Column:
    return text.try_cast("double")


def utc_time(text: Column) -> Column:
    """ISO text to a timestamp; text without a zone is UTC whatever the session's zone is, a date is
    midnight in UTC; else null."""
    bare = F.nullif(F.trim(text), F.lit(""))
    zoned = F.when(bare.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(bare, F.lit("T00:00:00Z"))).when(bare.rlike(r"^\d{4}-\d{2}-\d{2}[T ][\d:.]+$"), F.concat(bare, F.lit("Z")))
    return F.try_to_timestamp(F.coalesce(zoned, bare))


def uuid7_millis(identifier: Column) -> Column:
    """Milliseconds in a version 7 UUID, if they fall in the years 2010 to 2100."""
    bare = F.lower(F.translate(identifier, "-", ""))
    ms = F.conv(F.substring(bare, 1, 12), 16, 10).cast("bigint")
    valid = bare.rlike("^[0-9a-f]{12}7[0-9a-f]{19}$")
    return F.when(valid, F.when(ms.between(1_262_304_000_000, 4_102_444_800_000), ms))


def classify(text: Column, rules: Sequence[tuple[str, str]], otherwise: Column) -> Column:
    """The label of the first rule whose word the part before " en " contains."""
    head = F.lower(F.substring_index(text, " en ", 1))
    out = None
    for word, label in rules:
        out = F.when(F.contains(head, F.lit(word)), label) if out is None else out.when(F.contains(head, F.lit(word)), label)
    return otherwise if out is None else out.otherwise(otherwise)


def classify_title(title: Column, rules: Sequence[tuple[str, str]], category: Column) -> Column:
    """The label of the first rule whose word the title holds before " en ", as written; else that part
    of the title; an empty one gives the category with capitals."""
    head = F.trim(F.substring_index(title, " en ", 1))
    out = F.coalesce(F.nullif(head, F.lit("")), F.initcap(category))
    for word, label in reversed(rules):
        out = F.when(F.contains(head, F.lit(word)), label).otherwise(out)
    return out


def area_kinds(property_type: Column, area: Column, land: Sequence[str]) -> Column:
    """The one area of a row as plot or as built area, by its type."""
    is_land = property_type.isin(list(land))
    return F.struct(F.when(is_land, area).alias("plot"), F.when(~is_land, area).alias("built"))


def phone_digits(text: Column) -> Column:
    """Digits with a plus sign if there are ten or more, else empty."""
    digits = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^0-9]", "")
    return F.when(F.length(digits) >= 10, F.concat(F.lit("+"), digits)).otherwise("")


def phone(text: Column, salt: str, clear: bool = False) -> Column:
    """A phone number as a salted digest; the number itself only on request. Empty stays empty."""
    number = phone_digits(text)
    return number if clear else F.when(number != "", F.sha2(F.concat(F.lit(salt), number), 256)).otherwise("")


def phone_in_link(url: Column) -> Column:
    """The number that a messaging link carries, else empty."""
    return F.regexp_extract(url, r"phone=(\+?\d{10,15})", 1)


def phone_in_page(html: Column) -> Column:
    """The first Mexican number of a page once blanks, brackets, dots and dashes are out, else empty."""
    return F.regexp_extract(F.regexp_replace(html, r"[\s().-]", ""), r"\+?52\d{10}", 0)


def per_area(text: Column) -> Column:
    """Whether a card's price is one for a square metre."""
    return F.contains(F.coalesce(text, F.lit("")), F.lit("por m"))


def exactness(flag: Column) -> Column:
    """Whether a pin is exact; null where the page does not say."""
    return F.when(F.coalesce(flag, F.lit("")) != "", flag == "true")


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://([^/?#]+)", 1)


def url_bare(url: Column) -> Column:
    """Without fragment and query."""
    return F.substring_index(F.substring_index(url, "#", 1), "?", 1)


def url_absolute(url: Column, base: str) -> Column:
    return F.when(F.startswith(url, F.lit("http")), url).otherwise(F.concat(F.lit(base.rstrip("/")), F.when(F.startswith(url, F.lit("/")), "").otherwise("/"), url))


def listing_number(text: Column, prefix: str = "MLM") -> Column:
    """The digits of an id such as PREFIX-123 in a text, else null."""
    return F.nullif(F.regexp_extract(text, rf"{prefix}-?([0-9]+)", 1), F.lit(""))


def _parts(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), lambda p: F.trim(p)), lambda p: p != "")


def city_of(text: Column) -> Column:
    """Second to last of a comma list, else the last, else empty."""
    parts = _parts(text)
    return F.coalesce(F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1)), F.lit(""))


def province_of(region: Column, chain: Column) -> Column:
    return F.coalesce(F.nullif(region, F.lit("")), F.try_element_at(_parts(chain), F.lit(-1)))


def segment_parent(segment: Column) -> Column:
    """A location segment without its leading part; the top has the empty parent."""
    return F.when(F.contains(segment, F.lit("_")), F.regexp_replace(segment, r"^[^_]*_", "")).otherwise("")


def segment_depth(segment: Column) -> Column:
    return F.size(F.split(segment, "_"))


def truthy(column: Column, kind: str) -> Column:
    """Set, and not zero, empty or false: what a plain test of the value accepts."""
    if kind in ("string",):
        return F.coalesce(column != "", F.lit(False))
    if kind == "boolean":
        return F.coalesce(column, F.lit(False))
    if kind.startswith("array"):
        return F.coalesce(F.size(column) > 0, F.lit(False))
    return F.coalesce(column != 0, F.lit(False)) if kind in ("int", "bigint", "double", "float") or kind.startswith("decimal") else column.isNotNull()


def ceil_div(a: Column, b: int) -> Column:
    return F.ceil(a / b).cast("long")
