"""Expressions that can fail: a value, and a message where there is none.

The message either stops the task (``or_raise``) or stays in the row as its ``failure``, so that one bad
line marks its file and its day, and other days go on.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Checked(NamedTuple):
    """``found`` counts where ``bad``, which is never NULL, does not hold; elsewhere ``message`` says why."""

    found: Column
    bad: Column
    message: Column

    @property
    def value(self) -> Column:
        """What was found, or NULL."""
        return F.when(~self.bad, self.found)

    @property
    def failure(self) -> Column:
        """The message, or NULL."""
        return F.when(self.bad, self.message)

    def or_raise(self) -> Column:
        return F.when(self.bad, F.raise_error(self.message)).otherwise(self.found)


def first_failure(*failures: Column) -> Column:
    return failures[0] if len(failures) == 1 else F.coalesce(*failures)
