"""Alert inhibition as a stream (M9): an outer join of the alerts with themselves.

Targets are joined to sources with equal labels and the same evaluation time. That time is
the event time on both sides, so Spark drops a target or source from its state as soon as
the watermark has passed it, and only then gives out the targets that met no source.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def inhibit_stream(alerts: DataFrame, equal: Sequence[str] = ("alertname", "instance"),
                   at: str = "ts", source: str = "critical", target: str = "warning",
                   severity: str = "severity", watermark: str = "10 minutes") -> DataFrame:
    """M9 on a stream of alert rows: those that :func:`tidepool.operators.metrics.inhibit`
    keeps, for any arrival order within the watermark.

    Other severities pass at once, and so do targets with a null label or time, which
    equal nothing. A target comes out when the watermark has passed its time, unless a
    source hides it. Repeated sources hide once, repeated targets all come out, rows
    without a severity go. What arrives later than the watermark may find its source
    gone.
    """
    keys = [*equal, at]
    marked = alerts.withWatermark(at, watermark)
    labelled = reduce(and_, [F.col(c).isNotNull() for c in equal])

    def only(value: str) -> Column:
        # The condition reads the event time, or else it would be pushed below the
        # watermark, which would then wait for alerts of this severity.
        return F.when(F.col(at).isNotNull(), labelled & (F.col(severity) == value)).otherwise(
            F.lit(False))

    sources = marked.where(only(source)).select(*[F.col(c).alias(f"_s_{c}") for c in keys])
    same = reduce(and_, [F.col(c) == F.col(f"_s_{c}") for c in keys])
    shown = (marked.where(only(target)).join(sources, same, "left_outer")
             .where(F.col(f"_s_{equal[0]}").isNull()).select(*alerts.columns))
    passing = alerts.where((F.col(severity) != target)
                           | ((F.col(severity) == target) & ~(labelled & F.col(at).isNotNull())))
    return passing.unionByName(shown)
