"""Demographic and activity-hour expressions for the time-use survey."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import ACTIVE_AGES, WORKING_TELFS_RANGE, YOUNG_AGES


def working_status(telfs: Column | None = None) -> Column:
    """``working`` when 1 <= telfs < 3, else ``not working`` (null included)."""
    telfs = F.col("telfs") if telfs is None else telfs
    low, high = WORKING_TELFS_RANGE
    return F.when((telfs >= low) & (telfs < high), "working").otherwise("not working")


def sex(tesex: Column | None = None) -> Column:
    """``male`` when tesex = 1, else ``female`` (null included)."""
    tesex = F.col("tesex") if tesex is None else tesex
    return F.when(tesex == 1, "male").otherwise("female")


def age_band(teage: Column | None = None) -> Column:
    """``young`` 15-22, ``active`` 23-55 (inclusive), else ``elder`` (under 15 and null too)."""
    teage = F.col("teage") if teage is None else teage
    return (
        F.when(teage.between(*YOUNG_AGES), "young")
        .when(teage.between(*ACTIVE_AGES), "active")
        .otherwise("elder")
    )


def hours(columns: Sequence[Column | str]) -> Column:
    """Sum of minute columns divided by 60 (double); null if any operand is null."""
    if not columns:
        raise ValueError("an activity class needs at least one column")
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return functools.reduce(operator.add, cols) / 60
