"""Names and ids as column functions; only Unicode decomposition needs Python, and that in Arrow batches."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLUG_ID = r"^[a-z0-9]+(-[a-z0-9]+)*(:[a-z0-9]+(-[a-z0-9]+)*)*$"


def _plain(name: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))


@F.arrow_udf(T.StringType())
def decompose(names: pa.Array) -> pa.Array:
    """Compatibility forms replaced, combining marks dropped."""
    return pa.array([None if n is None else n if n.isascii() else _plain(n) for n in names.to_pylist()], pa.string())


def node_id(name: Column, ascii_only: bool = False) -> Column:
    """A name's slug: marks and apostrophes dropped, lower case, runs of anything else one hyphen. ``ascii_only`` stays in the JVM."""
    plain = name if ascii_only else decompose(name)
    lowered = F.lower(F.regexp_replace(plain, "['’]", ""))
    return F.regexp_replace(F.regexp_replace(lowered, "[^a-z0-9]+", "-"), "^-|-$", "")


def species_id(name: Column) -> Column:
    """The slug of a name in which the signs for female and male become letters."""
    return node_id(F.replace(F.replace(name, F.lit("♀"), F.lit(" f")), F.lit("♂"), F.lit(" m")))


def relationship_type(local_name: Column) -> Column:
    """camelCase to SCREAMING_SNAKE_CASE."""
    return F.upper(F.regexp_replace(local_name, "(?<=[a-z0-9])(?=[A-Z])", "_"))


def local_name(iri: Column) -> Column:
    """What follows the last # or /."""
    return F.regexp_extract(iri, "([^#/]*)$", 1)


def roman(number: Column) -> Column:
    """1 to 39 in Roman numerals; null outside."""
    tens, ones = F.floor(number / 10), number % 10
    pick = lambda at, words: F.element_at(F.array(*map(F.lit, words)), (at + 1).cast("int"))
    text = F.concat(pick(F.least(tens, F.lit(3)), ["", "X", "XX", "XXX"]), pick(ones, ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"]))
    return F.when((number >= 1) & (number <= 39), text)


def read_roman(numeral: Column) -> Column:
    """The number of a Roman numeral of I, V and X; null for anything else."""
    digits = F.transform(F.split(numeral, ""), lambda c: F.when(c == "X", 10).when(c == "V", 5).when(c == "I", 1).otherwise(0))
    signed = F.transform(digits, lambda d, i: F.when(d < F.coalesce(F.get(digits, i + 1), F.lit(0)), -d).otherwise(d))
    return F.when(numeral.rlike("^X{0,3}(IX|IV|V?I{0,3})$") & (F.length(numeral) > 0), F.aggregate(signed, F.lit(0), lambda a, d: a + d))


def generation_span(title: Column) -> Column:
    """(first, last) of a title such as "Generation II-V", "Generation VI onward" or "Generation IV"; last is null when open."""
    first, mark, last = (F.regexp_extract(title, r"^Generations?\s+([IVX]+)(\s*(?:-|–|to|onwards?)\s*)?([IVX]+)?$", k) for k in (1, 2, 3))
    start, end = read_roman(first), read_roman(last)
    return F.when(start.isNotNull(), F.struct(start.alias("first"), F.when(F.length(last) > 0, end).when(F.length(mark) > 0, F.lit(None).cast("int")).otherwise(start).alias("last")))


def normalize_title(title: Column) -> Column:
    """A page title: underscores and runs of spaces one space, no section, first letter upper."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(title, "#.*$", ""), r"[_\s]+", " "))
    return F.concat(F.upper(F.substring(plain, 1, 1)), F.substring(plain, 2, 1 << 30))


def redirect_target(wikitext: Column) -> Column:
    """The title that a redirect page points to; null for other pages."""
    found = F.regexp_extract(wikitext, r"(?i)^\s*#redirect\s*:?\s*\[\[([^\]|#]+)", 1)
    return F.when(F.length(found) > 0, normalize_title(found))


def permalink(base: str, title: Column, revision: Column) -> Column:
    """A page's address at one revision; parentheses stay as they are."""
    coded = F.url_encode(F.replace(title, F.lit(" "), F.lit("_")))
    for code, char in (("+", "%20"), ("%28", "("), ("%29", ")")):
        coded = F.replace(coded, F.lit(code), F.lit(char))
    return F.concat(F.lit(base), coded, F.lit("&oldid="), revision.cast("string"))


def normalize_space(text: Column) -> Column:
    """Soft hyphens dropped, white space single, none at the ends."""
    return F.trim(F.regexp_replace(F.replace(text, F.lit("­"), F.lit("")), r"\s+", " "))


def text_key(text: Column) -> Column:
    """The first eight digits of a text's SHA-256."""
    return F.substring(F.sha2(text, 256), 1, 8)


def game_codes(cell: Column, codes: list[str]) -> Column:
    """(codes, rest): chained codes, the longest first at each place, and what no code covers."""
    ordered = "|".join(sorted(codes, key=lambda c: (-len(c), c)))
    return F.struct(F.regexp_extract_all(cell, F.lit(f"({ordered})")).alias("codes"), F.regexp_replace(cell, ordered, "").alias("rest"))


@F.arrow_udf(T.StringType())
def hex_of_base36(values: pa.Array) -> pa.Array:
    """A 160-bit digest in base 36 as 40 hexadecimal digits; null for anything else."""
    out = []
    for value in values.to_pylist():
        try:
            number = int(value, 36)
            out.append(f"{number:040x}" if 0 <= number < 1 << 160 else None)
        except (TypeError, ValueError):
            out.append(None)
    return pa.array(out, pa.string())
