"""High watermarks: the largest entry number a company has loaded."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ledgerhub.functions.text import quoted
from ledgerhub.sizing import MAX_COMPANY_ROWS, local_copy

MAX_FILTER_COMPANIES = 50


def high_watermarks(
    target: DataFrame, entry_no: str, entity: str = "Entity", name: str = "max_entry_no"
) -> DataFrame:
    return target.groupBy(entity).agg(F.max(entry_no).alias(name))


def above_watermark(
    batch: DataFrame,
    target: DataFrame,
    entry_no: str,
    entity: str = "Entity",
    default: int = 0,
) -> DataFrame:
    """Batch rows numbered strictly above their company's watermark in ``target``."""
    return above_marks(batch, high_watermarks(target, entry_no, entity), entry_no, entity, default)


def above_marks(
    batch: DataFrame,
    marks: DataFrame,
    entry_no: str,
    entity: str = "Entity",
    default: int = 0,
) -> DataFrame:
    """Batch rows numbered strictly above their company's ``max_entry_no`` in ``marks``.

    A company without a mark starts at ``default``. For few companies the watermarks become a
    filter that reaches the batch's scan; for more they are a broadcast side; beyond
    ``MAX_COMPANY_ROWS`` companies an ordinary join.
    """
    local = local_copy(marks, MAX_COMPANY_ROWS)
    if local is not None and local.count() <= MAX_FILTER_COMPANIES:
        return batch.where(_filter(local.collect(), entry_no, entity, default))
    side = marks if local is None else F.broadcast(local)
    joined = batch.join(side, entity, "left")
    above = F.col(entry_no) > F.coalesce(F.col("max_entry_no"), F.lit(default))
    return joined.where(above).select(*quoted(batch.columns))


def _filter(marks, entry_no: str, entity: str, default: int):
    known = {m[entity]: m["max_entry_no"] for m in marks if m[entity] is not None}
    known = {name: default if top is None else top for name, top in known.items()}
    number, company = F.col(entry_no), F.col(entity)
    other = number > default
    if known:
        other = other & (company.isNull() | ~company.isin(list(known)))
    branches = [(company == name) & (number > top) for name, top in known.items()]
    return reduce(lambda a, b: a | b, branches, other)
