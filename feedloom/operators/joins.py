"""Equi-joins against dimensions, safe when one key holds much of the fact side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.session import dealt

SALTS = 16


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    spread_by: Sequence[str] | None = None,
    salts: int = SALTS,
    costly: bool = False,
) -> DataFrame:
    """Join facts to a dimension without forcing a broadcast.

    The rows of each key are spread over ``salts`` sub-keys by a hash of ``spread_by`` (all
    other columns by default) and the dimension is copied once per sub-key, so a hot key
    never lands in one task. No hint is given: Spark broadcasts the dimension by itself when
    its known (or, under AQE, its measured) size is below the threshold, and shuffles both
    sides otherwise. ``how`` is inner, left, left_semi or left_anti. ``costly`` facts are dealt over all cores
    (see ``session.dealt``), which a shuffled join has to do anyway; the dimension may then be as large as the facts have
    keys, so it is copied only for sub-keys that the facts have. Their keys are read once more for it.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    spread_by = list(spread_by or [c for c in facts.columns if c not in on] or on)
    # Never NULL, which Spark cannot tell of a remainder: it would hash every row below the facts' own shuffles to look.
    salt = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"), F.lit(0))
    salted = facts.withColumn("_salt", salt)
    if costly:
        used = salted.select(*on, "_salt").distinct()
        return dealt(salted, *on, "_salt", wide=True).join(dimension.join(used, list(on)), [*on, "_salt"], how).drop("_salt")
    copies = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
