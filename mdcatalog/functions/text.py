"""Column -> Column helpers for text: trimming, cells, slugs, hashes, predicates, scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv


def trim_ws(c: Column) -> Column:
    """Trim Unicode white space on both ends (``F.trim`` alone removes only U+0020)."""
    return F.btrim(c, F.lit(fv.WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(trim_ws(c), F.lit(""))


def sanitize_cell(c: Column) -> Column:
    """Make a value safe inside one cell of a Markdown table."""
    flat = F.regexp_replace(c, r"\r\n|\r|\n", " ")
    return trim_ws(F.replace(flat, F.lit("|"), F.lit("\\|")))


def slugify(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(trim_ws(c)), "[^a-z0-9]+", "-"), F.lit("-"))


def ref_name(c: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(c, "/", -1)


def round1(c: Column) -> Column:
    """One decimal, half up."""
    return F.floor(c * 10 + 0.5).cast("double") / 10


def round_half_away(c: Column) -> Column:
    return F.round(c).cast("bigint")


def percent(part: Column, whole: Column) -> Column:
    """``round1`` percentage, 0 when there is nothing to divide by."""
    return F.when(whole > 0, round1(100.0 * part / whole)).otherwise(F.lit(0.0))


def quote_literal(c: Column, backslashes: bool = False) -> Column:
    """Escape a value for use inside a single-quoted SQL literal."""
    if backslashes:
        c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(c, F.lit("'"), F.lit("''"))


def quote_identifier(c: Column, quote: str = "`") -> Column:
    return F.concat(F.lit(quote), F.replace(c, F.lit(quote), F.lit(quote * 2)), F.lit(quote))


def strip_credentials(uri: Column) -> Column:
    """Remove ``user:password@`` from a URI."""
    return F.regexp_replace(uri, "://[^/@]*@", "://")


def strip_engine_noise(comment: Column) -> Column:
    """Drop the storage-engine remark some databases append to table comments."""
    kept = F.regexp_replace(comment, r"(?s); InnoDB free:.*$", "")
    return trim_ws(F.when(kept.startswith("InnoDB free:"), F.lit("")).otherwise(kept))


def is_placeholder(description: Column) -> Column:
    """Blank, or exactly a description that a connector generates."""
    text = trim_ws(F.coalesce(description, F.lit("")))
    return (text == "") | text.rlike("(?d)" + "|".join(fv.PLACEHOLDERS))


def structural_hash(body: Column) -> Column:
    """SHA-256 of a body with line ends, trailing blanks and final newlines normalised."""
    def strip(lines: Column) -> Column:
        return F.regexp_replace(lines, r"(?<![ \t])[ \t]+(?=\n|\z)", "")

    # most bodies need neither pattern; plain tests for what they would match are cheaper
    trailing = body.contains(" \n") | body.contains("\t\n") | body.endswith(" ") | body.endswith("\t")
    stripped = F.when(body.contains("\r"), strip(F.regexp_replace(body, r"\r\n?", "\n"))).when(trailing, strip(body)).otherwise(body)
    return F.sha2(F.concat(F.rtrim(stripped, F.lit("\n")), F.lit("\n")), 256)


def is_key_name(name: Column) -> Column:
    """Column name that looks like an identifier."""
    return name.rlike(fv.KEY_NAME)


def is_iso_date(v: Column) -> Column:
    """A calendar-valid date, RFC 3339 instant, or ``yyyy-MM-dd HH:mm:ss``."""
    shape = v.rlike(
        r"^\d{4}-\d{2}-\d{2}$"
        r"|^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}([.,]\d+)?$"
        r"|^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]\d{2}:\d{2})$"
    )
    day = F.to_date(F.try_to_timestamp(F.substring(v, 1, 10), F.lit("yyyy-MM-dd")))
    clock = F.substring(v, 12, 8)
    clock_ok = (F.length(v) == 10) | clock.rlike(r"^([01]\d|2[0-3]):[0-5]\d:[0-5]\d$")
    return shape & day.isNotNull() & clock_ok


def is_int64(v: Column) -> Column:
    return v.rlike(r"^[+-]?\d+$") & v.try_cast("bigint").isNotNull()


def is_float64(v: Column) -> Column:
    """The number grammar of common parsers: sign, decimals, exponent, hex float, inf, nan;
    a literal that overflows to infinity is not a number."""
    decimal = v.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    finite = F.abs(v.try_cast("double")) <= F.lit(1.7976931348623157e308)
    hexadecimal = v.rlike(r"^[+-]?0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?\d+$")
    special = F.lower(v).rlike(r"^([+-]?(inf|infinity)|nan)$")
    return (decimal & finite) | hexadecimal | special


def fuzzy_score(query: str, text: Column) -> Column:
    """Score ``query`` as a case-insensitive subsequence of ``text`` (-1: no match).

    A character next to the previous hit earns 5 plus the streak so far, any other hit
    earns 1 and ends the streak; a match beginning at the first character earns 10.
    """
    query = query.lower()
    if not query:
        return F.lit(0)
    none = F.array().cast("array<int>")

    def hits(low: Column) -> Column:
        """Positions of the characters, each behind the one before; 0 from the first that is missing."""
        def step(found: Column, ch: Column) -> Column:
            last = F.coalesce(F.get(found, F.size(found) - 1), F.lit(-1))
            return F.array_append(found, F.when(last == 0, 0).otherwise(F.call_function("locate", ch, low, F.greatest(last, F.lit(0)) + 1)))

        return F.aggregate(F.array(*[F.lit(ch) for ch in query]), none, step)

    def score(found: Column) -> Column:
        start = F.struct(F.lit(0).alias("last"), F.lit(0).alias("score"), F.lit(0).alias("streak"))

        def step(state: Column, hit: Column) -> Column:
            joined = hit == state["last"] + 1
            streak = F.when(joined, state["streak"] + 1).otherwise(0)
            return F.struct(hit.alias("last"), (state["score"] + F.when(joined, 5 + streak).otherwise(1)).alias("score"), streak.alias("streak"))

        total = F.aggregate(found, start, step, lambda state: state["score"]) + F.when(found[0] == 1, 10).otherwise(0)
        return F.when(F.array_contains(found, 0), -1).otherwise(total)

    # arrays of one element name what is used more than once, so that it is computed once per text
    return F.transform(F.transform(F.array(F.lower(text)), hits), score)[0]
