"""Text expressions: trimming, strict and lenient casts, CSV fields, column resolving."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationday.functions.checked import Checked

# The characters with the Unicode White_Space property.
WHITE_SPACE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)

_PLAIN_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_FIELD_MARK = "\u0001"


def strip_text(col: Column) -> Column:
    """Trim Unicode white space; what is empty then is NULL."""
    return F.nullif(F.btrim(col, F.lit(WHITE_SPACE)), F.lit(""))


def checked_cast(col: Column, to: T.DataType, what: Column) -> Checked:
    """Cast text to a declared type; text that is not of the type is a failure, NULL stays NULL.

    Spark reads ``1.0f``, ``NaN`` and ``Infinity`` as doubles; as observations they are failures.
    """
    if isinstance(to, T.StringType):
        return Checked(col, F.lit(False), F.lit(None).cast("string"))
    cast = col.try_cast(to)
    bad = cast.isNull()
    if isinstance(to, T.DoubleType):
        bad = bad | ~col.rlike(_PLAIN_NUMBER)
    message = F.concat(F.lit(f"Invalid {to.simpleString()} for "), what, F.lit(": "), col)
    return Checked(cast, F.coalesce(col.isNotNull() & bad, F.lit(False)), message)


def strict_cast(col: Column, to: T.DataType, what: Column) -> Column:
    """``checked_cast`` where a failure is an error."""
    return col if isinstance(to, T.StringType) else checked_cast(col, to, what).or_raise()


def lenient_double(col: Column) -> Column:
    """Cast text to double; text that is no number is NULL."""
    return F.when(col.rlike(_PLAIN_NUMBER), col.try_cast("double"))


def checked_csv_fields(line: Column) -> Checked:
    """The trimmed fields of one CSV record, outer quotes removed and doubled quotes single.

    Records without quotes and white space, nearly all of them, are only split. In the others the
    separating commas are found first; a quote that does not close, or text next to a quoted field,
    is a failure.
    """
    plain = ~line.rlike(r'(?U)["\s]')
    marked = _marked_fields(line)
    # every comma outside quotes became a mark; quoted commas stay between their quotes
    leftover = F.regexp_replace(marked, _FIELD_MARK + r'(?:"[^"]*+(?:""[^"]*+)*+"|[^,"' + _FIELD_MARK + r"]*+)", "")
    bad = F.when(plain, F.lit(False)).otherwise((leftover != "") | F.contains(line, F.lit(_FIELD_MARK)))
    quoted = F.transform(F.split(F.substr(marked, F.lit(2)), _FIELD_MARK), _field_text)
    fields = F.when(plain, F.split(line, ",")).otherwise(quoted)
    return Checked(fields, F.coalesce(bad, F.lit(False)), F.concat(F.lit("Malformed quotes in CSV line: "), line))


def csv_fields(line: Column) -> Column:
    """``checked_csv_fields`` where a failure is an error."""
    return checked_csv_fields(line).or_raise()


def _marked_fields(line: Column) -> Column:
    return F.regexp_replace(
        F.concat(F.lit(","), line),
        r',("[^"]*+(?:""[^"]*+)*+"(?=,|\z)|[^,"]*+(?=,|\z))',
        _FIELD_MARK + "$1",
    )


def _field_text(field: Column) -> Column:
    inner = F.substr(field, F.lit(2), F.length(field) - 2)
    text = F.when(F.startswith(field, F.lit('"')), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(field)
    return F.btrim(text, F.lit(WHITE_SPACE))


def matching_names(header: Column, pattern: Column) -> Column:
    """The names of a header that match ``pattern`` as a whole."""
    whole = F.concat(F.lit("(?U)^(?:"), pattern, F.lit(")$"))
    return F.filter(header, lambda name: F.rlike(name, whole))


def checked_position(header: Column, pattern: Column, matches: Column | None = None) -> Checked:
    """1-based position of the one header that matches ``pattern`` as a whole, else a failure.

    NULL where no column is wanted, that is where the pattern is NULL. ``matches`` are the ``matching_names``, if they are at hand.
    """
    matches = matching_names(header, pattern) if matches is None else matches
    message = F.concat(
        F.lit("Expected exactly one column matching "),
        pattern,
        F.lit(", found ["),
        F.array_join(matches, ", "),
        F.lit("]. Available columns: ["),
        F.array_join(header, ", "),
        F.lit("]"),
    )
    bad = F.coalesce(F.size(matches) != 1, F.lit(False)) & pattern.isNotNull()
    return Checked(F.array_position(header, F.get(matches, F.lit(0))).cast("int"), bad, message)


def column_position(header: Column, pattern: Column) -> Column:
    """``checked_position`` where a failure is an error."""
    return checked_position(header, pattern).or_raise()
