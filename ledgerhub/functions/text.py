"""Text expressions and column-name hygiene."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def key_prefix(key: Column, separator: str = "|") -> Column:
    """Text before the separator; NULL where the separator is missing."""
    return F.when(F.contains(key, F.lit(separator)), F.substring_index(key, separator, 1))


def last_token(text: Column, separator: str = "-") -> Column:
    """Text after the last separator; NULL for NULL or empty text."""
    return F.when(text != "", F.substring_index(text, separator, -1))


def first_number(text: Column) -> Column:
    """First run of digits as BIGINT; NULL where there is none."""
    return F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit("")).try_cast("bigint")


def no_trailing_blanks(text: Column) -> Column:
    """Comparison form of a name: trailing blanks do not count."""
    return F.rtrim(text)


def or_blank(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def deep_link(base: str, company: Column, page: str) -> Column:
    """Address of a company's page in the ERP client."""
    return F.concat(F.lit(base), company, F.lit(page))


def quoted(names: Iterable[str]) -> list[str]:
    """Column names as references, whatever characters they hold."""
    return ["`" + name.replace("`", "``") + "`" for name in names]


_ESCAPED = re.compile(r"_x([0-9A-Fa-f]{4})_")


def plain_name(name: str) -> str:
    """Column name without brackets and escapes; every spelling of the record tag is ``etag``."""
    name = name.strip()
    if name.startswith("[") and name.endswith("]"):
        name = name[1:-1]
    name = _ESCAPED.sub(lambda m: chr(int(m.group(1), 16)), name)
    squeezed = name.lower().replace("@", "").replace(".", "").replace("_", "")
    return "etag" if squeezed in ("odataetag", "etag") else name
