"""Flag columns to label arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def labels_from_flags(flags: Sequence[Column], labels: Sequence[str]) -> Column:
    """Array of the labels whose flag is ``"1"``, in label order.

    Missing flags count as unset, so a short line yields fewer labels, and a
    line without any set flag yields an empty array rather than null.
    """
    picked = [F.when(flag == "1", F.lit(label)) for flag, label in zip(flags, labels)]
    return F.array_compact(F.array(*picked))
