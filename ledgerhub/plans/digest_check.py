"""Source against table, row by row, at the price of digests: what the count and balance checks can't tell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerhub.operators import digests
from ledgerhub.operators.presence import present


def digest_check(
    source: DataFrame, table: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
    number: str | None = None, entity: str = "Entity", widths: Sequence[int] = digests.WIDTHS,
) -> DataFrame:
    """Rows that the table lacks, has too many of, or has with other values.

    ``number`` is a whole-number key, by which ranges are made; without it they are ranges of a hash. All
    columns that both sides have are compared unless ``columns`` names them.
    """
    c = compared(source, table, keys, columns, number, entity)
    return digests.compare(source, table, c, widths)


def compared(
    source: DataFrame, table: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
    number: str | None = None, entity: str = "Entity",
) -> digests.Compared:
    """What is compared; a column of two types is refused, since its values' texts would differ everywhere."""
    shared = [x for x in source.columns if x in table.columns] if columns is None else columns
    types = [(x, source.schema[x].dataType, table.schema[x].dataType) for x in dict.fromkeys([entity, *keys, *shared])]
    odd = [f"{x}: {a.simpleString()} and {b.simpleString()}" for x, a, b in types if a != b]
    if odd:
        raise ValueError(f"columns of two types can't be compared: {', '.join(odd)}")
    rest = tuple(x for x in shared if x not in (entity, *keys))
    return digests.Compared(entity, tuple(keys), rest, number)


def differing_rows(source: DataFrame, found: DataFrame, keys: Sequence[str], entity: str = "Entity") -> DataFrame:
    """The source's rows to load again: those that the table lacks or has otherwise."""
    wanted = found.where("left_rows > 0").select(*dict.fromkeys([entity, *keys]))
    return present(source, wanted, list(dict.fromkeys([entity, *keys])), measured=True)
