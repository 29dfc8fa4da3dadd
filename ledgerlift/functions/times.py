"""Registration times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(text: Column) -> Column:
    """ISO text to a timestamp cut to milliseconds.

    Text without a zone is UTC. A numeric offset is honoured.
    """
    has_zone = text.rlike(r"([Zz]|[+-]\d{2}:?\d{2})$")
    in_zone = F.when(has_zone, text).otherwise(F.concat(text, F.lit("Z")))
    return F.date_trunc("MILLISECOND", F.to_timestamp(in_zone))
