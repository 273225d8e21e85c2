"""Column expressions. All are built-ins: no UDF, and none raises on bad input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LONG_MAX = 2**63 - 1
LONG_MIN = -(2**63)


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def split_quoted(column: Column | str) -> Column:
    """Fields of one CSV line, cut at commas that an even number of quotes follows.

    Quotes stay in the field and doubled quotes stay doubled; trailing blanks are kept.

    Linear in the line length: make the number of quotes even by putting one in front if need
    be, split at quotes, and mark the commas of every other piece with a line feed. Line feeds
    that the value holds are written as two characters before and put back after.
    """
    line = _col(column)
    odd = (F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
    plain = F.replace(F.replace(line, F.lit("\x01"), F.lit("\x01a")), F.lit("\n"), F.lit("\x01b"))
    pieces = F.split(F.when(odd, F.concat(F.lit('"'), plain)).otherwise(plain), '"', -1)
    marked = F.array_join(
        F.transform(
            pieces,
            lambda piece, i: F.when(
                i % 2 == 0, F.replace(piece, F.lit(","), F.lit("\n"))
            ).otherwise(piece),
        ),
        '"',
    )
    fields = F.split(F.when(odd, F.substr(marked, F.lit(2))).otherwise(marked), "\n", -1)
    return F.transform(
        fields,
        lambda field: F.replace(F.replace(field, F.lit("\x01b"), F.lit("\n")), F.lit("\x01a"), F.lit("\x01")),
    )


def unquote_field(column: Column | str) -> Column:
    """A field without its outer quotes, doubled quotes made single."""
    field = _col(column)
    quoted = (F.length(field) >= 2) & field.startswith('"') & field.endswith('"')
    inner = F.substring(field, F.lit(2), F.length(field) - 2)
    return F.when(quoted, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(field)


def to_float(column: Column | str) -> Column:
    """32-bit float; text that is no number gives null."""
    return _col(column).try_cast("float")


def to_int(column: Column | str) -> Column:
    """32-bit int, decimals cut off (``"12.7"`` gives 12); anything else gives null."""
    text = _col(column).cast("string")
    whole = F.regexp_extract(text, r"^([+-]?\d+)\.\d*$", 1)
    return F.coalesce(text.try_cast("int"), whole.try_cast("int"))


def nonzero(column: Column | str) -> Column:
    """True for text that is a number other than 0; null for blank, text and null.

    The comparison is made as double, so ``"0.5"`` counts as nonzero.
    """
    return _col(column).try_cast("double") != F.lit(0.0)


def title_head(column: Column | str) -> Column:
    """The text before the first colon."""
    return F.substring_index(_col(column), ":", 1)


def float_to_long(column: Column | str) -> Column:
    """Toward zero; out of range gives the nearest long and NaN gives 0."""
    number = _col(column)
    return (
        F.when(F.isnan(number), F.lit(0).cast("bigint"))
        .when(number >= F.lit(2.0**63), F.lit(LONG_MAX))
        .when(number <= F.lit(-(2.0**63)), F.lit(LONG_MIN))
        .otherwise(number.try_cast("bigint"))
    )


def round_1(column: Column | str) -> Column:
    """Half up to one decimal."""
    return F.round(_col(column), 1)


def json_names(column: Column | str) -> Column:
    """The names in ``[{"id": 1, "name": "x"}, ...]``, entries without one left out.

    Broken JSON gives null.
    """
    entries = F.from_json(_col(column), "array<struct<id:bigint,name:string>>")
    return F.array_compact(F.transform(entries, lambda entry: entry["name"]))


def json_text(*columns: Column | str) -> Column:
    """The named columns as one JSON object."""
    return F.to_json(F.struct(*columns))


def key_bytes(column: Column | str, bits: int = 64) -> Column:
    """A whole number as the bytes of a row key: 4 (``bits=32``) or 8, highest first.

    Keys are compared byte by byte without a sign, so negative numbers come after positive ones.
    A number that needs more bits raises.
    """
    number = _col(column).cast("bigint")
    if bits == 32:
        number = number.cast("int").cast("bigint")
    digits = F.lpad(F.hex(number), 16, "0")
    return F.unhex(F.substring(digits, 17 - bits // 4, bits // 4))


def key_number(column: Column | str) -> Column:
    """The whole number that a row key of 4 or 8 bytes stands for."""
    key = _col(column)
    digits = F.hex(key)
    whole = F.conv(digits, 16, -10).cast("bigint")
    return F.when(F.octet_length(key) == 4, F.when(whole >= 2**31, whole - 2**32).otherwise(whole)).when(
        F.octet_length(key) == 8, whole
    )
