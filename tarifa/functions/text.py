"""Text cleaning and JSON fragments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_spaces(text: Column) -> Column:
    """Strip every Unicode space separator (not tabs or line breaks) from both ends."""
    return F.regexp_replace(F.regexp_replace(text, r"^\p{Zs}+", ""), r"\p{Zs}+$", "")


def repair_double_encoding(text: Column) -> Column:
    """Undo UTF-8 bytes that were read as Latin-1 characters and encoded again.

    Only text that holds the lead byte's character and nothing beyond U+00FF can come from bytes;
    it is kept as it is when those bytes are not valid UTF-8.
    """
    may_be_bytes = text.contains("Ã") & ~text.rlike(r"[^\x{00}-\x{FF}]")
    reread = F.try_validate_utf8(F.encode(text, "ISO-8859-1").cast("string"))
    return F.when(may_be_bytes, F.coalesce(reread, text)).otherwise(text)


def has_double_encoding(text: Column) -> Column:
    return text.rlike(r"Ã[\x{80}-\x{BF}]")


def json_string(text: Column) -> Column:
    """A JSON string with quotes, or ``null``."""
    array = F.to_json(F.array(text))
    return F.when(text.isNull(), F.lit("null")).otherwise(array.substr(F.lit(2), F.length(array) - 2))


def json_number(number: Column, scale: int = 3) -> Column:
    """Shortest decimal text of a number (``1.5``, ``2.0``), or ``null``."""
    text = number.cast(f"decimal(28,{scale})").cast("string")
    return F.coalesce(F.regexp_replace(text, r"(\.\d+?)0+$", "$1"), F.lit("null"))


def json_integer(number: Column) -> Column:
    return F.coalesce(number.cast("string"), F.lit("null"))


def json_boolean(flag: Column) -> Column:
    return F.coalesce(flag.cast("string"), F.lit("null"))


def json_array(*items: Column) -> Column:
    return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))


def json_object(**members: Column) -> Column:
    pairs = [F.concat(F.lit(f'"{name}":'), value) for name, value in members.items()]
    return F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))
