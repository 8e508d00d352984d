"""Small column helpers used by extracts and the transform."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetdw.schemas import SYS_A, SYS_B, SYS_C, SYS_D


def null_of(type_name: str) -> Column:
    """Typed NULL, e.g. ``null_of("string")`` (CTAS needs typed columns)."""
    return F.lit(None).cast(type_name)


def id_str(c: str | Column) -> Column:
    """Source ids are carried as text in staging (``::VARCHAR``)."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("string")


def normalise_gearbox(sys: str, c: Column) -> Column:
    """Conform the gearbox spelling of one source to MANUAL / AUTOMATICO.

    A has no gearbox; B is lower case; C spells the automatic 'AUTOMATICA';
    D is already conformed.
    """
    if sys == SYS_A:
        return F.lit(None).cast("string")
    if sys == SYS_B:
        return F.upper(c)
    if sys == SYS_C:
        return F.replace(F.upper(c), F.lit("AUTOMATICA"), F.lit("AUTOMATICO"))
    if sys == SYS_D:
        return c
    raise ValueError(sys)
