"""Column functions for lexical rules: trims, grammars, exact numbers, headers and URLs. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: The six ASCII blanks, and the 29 characters that count as white space in names.
ASCII_BLANKS = " \t\r\n\x0b\x0c"
NAME_BLANKS = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Grammars of identifiers and accounts, and precision, scale and bounds of amounts.
IDENTIFIER = r"[A-Za-z0-9_][A-Za-z0-9._-]{0,127}"
JURISDICTION = r"[a-z]{2}-[a-z0-9-]+"
ACCOUNTS = {"digits17": r"[0-9]{17}", "visible64": r"[\x21-\x7e]{1,64}", "visible32": r"[\x21-\x7e]{1,32}", "sequence": r"[0-9]{1,4}"}
AMOUNTS = {
    "signed": (r"-?[0-9]+(\.[0-9]+)?", 38, 10, None, None),
    "four_places": (r"[0-9]+(\.[0-9]{1,4})?", 38, 4, 0, 10**28 - 1),
    "two_places": (r"[0-9]+(\.[0-9]{1,2})?", 28, 2, 0, 10**26 - 1),
    "percent": (r"[0-9]{1,3}(\.[0-9]{1,6})?", 9, 6, 0, 100),
}
CONTROLS = r"[\x00-\x1f\x7f-\x9f]"
KEPT_HEADERS = ("content-length", "content-type", "etag", "last-modified", "accept-ranges")


def ascii_trim(c: Column) -> Column:
    return F.btrim(c, F.lit(ASCII_BLANKS))


def is_named(c: Column) -> Column:
    """Whether something besides white space is there; null for null."""
    return F.btrim(c, F.lit(NAME_BLANKS)) != ""


def matches(c: Column, grammar: str) -> Column:
    """Whether the whole value is in the grammar (\\z: a trailing newline is not forgiven)."""
    return c.rlike(rf"\A(?:{grammar})\z")


def exact_decimal(c: Column, kind: str) -> Column:
    """struct(value, code): an exact decimal, or why there is none.

    The grammar is tested first, for a cast alone forgives blanks and exponents and rounds. A grammatical
    value that the type cannot hold exactly is unsupported_width, never null without a code.
    """
    grammar, precision, scale, low, high = AMOUNTS[kind]
    trimmed = ascii_trim(c)
    value = trimmed.try_cast(f"decimal({precision},{scale})")
    wide = F.length(F.regexp_extract(trimmed, r"\.([0-9]+)\z", 1)) > scale
    code = F.when(c.isNull(), None).when(~matches(trimmed, grammar), "bad_grammar").when(value.isNull() | wide, "unsupported_width")
    if low is not None:
        code = code.when((value < F.lit(str(low)).cast(f"decimal({precision},{scale})")) | (value > F.lit(str(high)).cast(f"decimal({precision},{scale})")), "out_of_range")
    return F.struct(F.when(code.isNull(), value).alias("value"), code.alias("code"))


def is_exact_decimal(trimmed: Column, kind: str) -> Column:
    """Whether a text without blanks around it is an amount that exact_decimal has a value for; no value is made."""
    grammar, precision, scale, low, high = AMOUNTS[kind]
    value = trimmed.try_cast(f"decimal({precision},{scale})")
    if low is None:
        return matches(trimmed, grammar) & value.isNotNull() & (F.length(F.regexp_extract(trimmed, r"\.([0-9]+)\z", 1)) <= scale)
    return matches(trimmed, grammar) & F.coalesce(value <= F.lit(str(high)).cast(f"decimal({precision},{scale})"), F.lit(False))


def decode_numeric(buffer: Column, precision: Column, scale: int) -> Column:
    """struct(value, code) of a 17-byte number: a sign byte and four little-endian 32-bit words, most significant first."""
    part = lambda k: F.conv(F.concat(*(F.hex(F.substring(buffer, 2 + 4 * k + i, 1)) for i in (3, 2, 1, 0))), 16, 10).cast("decimal(38,0)")
    low = part(1).cast("decimal(10,0)") * F.lit(1 << 32).cast("decimal(11,0)") + part(2).cast("decimal(10,0)")
    whole = (low.cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(11,0)") + part(3).cast("decimal(10,0)")).cast("decimal(38,0)")
    sign = F.hex(F.substring(buffer, 1, 1))
    digits = F.length(whole.cast("string"))
    code = (
        F.when(buffer.isNull(), None)
        .when(F.length(buffer) != 17, "invalid_numeric_buffer")
        .when(~sign.isin("00", "01"), "invalid_numeric_sign")
        .when((precision < 1) | (precision > 28), "invalid_numeric_precision")
        .when(F.lit(scale) > precision, "invalid_numeric_scale")
        .when((sign == "01") & (whole == 0) & (part(0) == 0), "negative_zero")
        .when((part(0) != 0) | (digits > precision), "numeric_precision_overflow")
    )
    unscaled = F.when(sign == "01", -whole).otherwise(whole)
    value = F.try_divide(unscaled, F.lit(10**scale).cast(f"decimal({scale + 1},0)")).cast(f"decimal(38,{scale})") if scale else unscaled
    return F.struct(F.when(code.isNull(), value).alias("value"), code.alias("code"))


def is_date(c: Column, low: int = 1900, high: int = 2100) -> Column:
    """M/D/YYYY that the calendar has, its year in bounds."""
    shaped = matches(c, r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}")
    year = F.regexp_extract(c, r"([0-9]{4})\z", 1).try_cast("int")
    return shaped & F.when(shaped, F.try_to_timestamp(c, F.lit("M/d/yyyy")).isNotNull() & year.between(low, high)).otherwise(False)


def has_control(c: Column) -> Column:
    return c.rlike(CONTROLS)


def is_bounded_text(c: Column, most: int) -> Column:
    return (F.length(c) <= most) & ~has_control(c)


def normalize_header(c: Column) -> Column:
    return F.upper(ascii_trim(c))


def ascii_fold(c: Column) -> Column:
    """Lower-cases A-Z alone: Unicode letters never collide by folding."""
    return F.translate(c, UPPER, LOWER)


def normalize_address(c: Column) -> Column:
    """Upper-case ASCII letters, runs of anything but letters and digits as one blank; empty if nothing is left."""
    return F.btrim(F.regexp_replace(F.translate(c, LOWER, UPPER), r"[^\p{L}\p{N}]+", " "))


def layout_fingerprint(headers: Column, version: int | None = None) -> Column:
    """SHA-256 of the canonical JSON of a set of header names, and of the parser's contract version if given.

    Canonical: sorted keys and names, no blanks, characters beyond ASCII as they are.
    """
    tail = f',"parser_contract_version":{version}}}' if version is not None else "}"
    return F.sha2(F.concat(F.lit('{"headers":'), F.to_json(F.array_sort(F.array_distinct(headers))), F.lit(tail)).cast("binary"), 256)


def sanitize_url(c: Column) -> Column:
    """Scheme, host, port and path: no user, query or fragment; scheme and host in lower case. Null without a host."""
    part = lambda i: F.regexp_extract(c, r"\A([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#]*@)?([^/?#@:]+)(:[0-9]+)?([^?#]*)", i)
    return F.when(part(2) != "", F.concat(ascii_fold(part(1)), F.lit("://"), ascii_fold(part(2)), part(3), part(4)))


def sanitize_headers(headers: Column, most: int = 512) -> Column:
    """The allowed header names in lower case, values without control characters and at most `most` long."""
    kept = F.map_filter(F.transform_keys(headers, lambda k, v: ascii_fold(k)), lambda k, v: k.isin(*KEPT_HEADERS))
    return F.transform_values(kept, lambda k, v: F.left(F.btrim(F.regexp_replace(v, CONTROLS, ""), F.lit(NAME_BLANKS)), F.lit(most)))


def media_type(c: Column) -> Column:
    """A media type without its parameters, in lower case."""
    return ascii_fold(ascii_trim(F.split(c, ";")[0]))


def length_code(declared: Column, seen: Column) -> Column:
    return F.when(declared.isNull(), None).when(seen < declared, "truncated").when(seen > declared, "too_long")
