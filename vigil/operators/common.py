"""Plan-shaping helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def evaluate_once(df: DataFrame) -> DataFrame:
    """Make every column of ``df`` an attribute computed once per row.

    Catalyst pushes filters below projections by substituting the projected expressions
    into the predicate; filters get no common-subexpression elimination, so an expensive
    column (JSON parse, regex strip, parser UDF result) referenced by several rules would
    be recomputed per reference. Routing the row through ``inline(array(struct(..)))``
    (a one-row Generate, no shuffle) stops that substitution at this point of the plan.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
