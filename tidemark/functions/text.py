"""Parsing of Dutch-style numbers, dates and headers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.dates import third_friday

# White space as \s means it, and month names.
BLANKS = " \t\n\x0b\f\r"
MONTHS = {
    "januari": 1, "februari": 2, "maart": 3, "april": 4, "mei": 5, "juni": 6, "juli": 7, "augustus": 8, "september": 9, "oktober": 10, "november": 11, "december": 12,
    "january": 1, "february": 2, "march": 3, "may": 5, "june": 6, "july": 7, "august": 8, "october": 10,
}


def clean(text: Column) -> Column:
    """Runs of white space become one blank; an empty result is null."""
    return F.nullif(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(""))


def parse_number(text: Column) -> Column:
    """'1.234,56' -> 1234.56; currency signs, blanks and percent signs are dropped; what is no number ('n.v.t.', 'n/a', '-', '') is
    null."""
    return F.translate(text, ",.€$%" + BLANKS, ".").try_cast("double")


def parse_integer(text: Column) -> Column:
    """Dots and commas separate thousands; what is no number is null."""
    return F.translate(text, ".," + BLANKS, "").try_cast("long")


def parse_percent(text: Column) -> Column:
    """As parse_number: a dot is a thousands separator here too, so '12.5%' gives 125.0 and '12,5%' gives 12.5."""
    return parse_number(text)


def first_number(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"-?[0-9]+(?:[.,][0-9]+)*", 0), F.lit(""))


def parse_date(text: Column) -> Column:
    t = F.trim(text)
    return F.coalesce(*[F.try_to_date(t, f) for f in ("dd-MM-yyyy", "dd/MM/yyyy", "yyyy-MM-dd", "d MMM yyyy")])


def parse_expiry(text: Column) -> Column:
    """'December 2025 (AEX / AH)' -> (2025-12-19, 'AH'): the third Friday and what follows the slash."""
    pattern = r"([A-Za-z]+)\s+([0-9]{4})\s*\([^/)]*/\s*([A-Za-z0-9]+)\s*\)"
    names = F.create_map(*[F.lit(x) for kv in MONTHS.items() for x in kv])
    month = F.try_element_at(names, F.lower(F.regexp_extract(text, pattern, 1)))
    year = F.nullif(F.regexp_extract(text, pattern, 2), F.lit("")).cast("int")
    return F.struct(third_friday(F.make_date(year, month, F.lit(1))).alias("expiry_date"), F.nullif(F.regexp_extract(text, pattern, 3), F.lit("")).alias("symbol"))


def market_of(ticker: Column) -> Column:
    return F.when(ticker.endswith(".AS"), "NL").when(ticker.endswith(".L"), "UK").when(ticker.endswith(".PA"), "FR").when(ticker.endswith(".DE"), "DE").otherwise("US")


def call_put_totals(text: Column) -> Column:
    """'12.345 (7.000 Calls, 5.345 Puts)' -> (total, calls, puts). The text, often a page worked out on the spot, is searched once:
    a lambda's variable holds what was found, and the numbers are taken from that."""
    p = r"([0-9.]+)\s*\(\s*([0-9.]+)\s*[Cc]alls?\s*,\s*([0-9.]+)\s*[Pp]uts?\s*\)"
    numbers = lambda found: F.struct(*[parse_integer(F.regexp_extract(found, p, i)).alias(n) for i, n in ((1, "total"), (2, "calls"), (3, "puts"))])
    return F.get(F.transform(F.array(F.regexp_extract(text, p, 0)), numbers), F.lit(0))
