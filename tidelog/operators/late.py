"""Figures per event hour that late rows still correct, up to a cut-off. Spark SQL only.

Rows are placed in a triangle of event period by arrival period. Each cell is aggregated once (a hot hour is combined
before the shuffle); running sums along the arrivals of a period give every revision of its figures.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

HOUR = 3_600_000_000_000

_PLACED = """
SELECT *,
       unix - pmod(unix, {p}L) AS event_period,
       greatest(runix - pmod(runix, {p}L), unix - pmod(unix, {p}L)) AS arrival_period,
       CASE WHEN unix IS NULL OR runix IS NULL THEN NULL
            WHEN runix < unix - pmod(unix, {p}L) + {p}L THEN 'on_time'
            WHEN runix >= unix - pmod(unix, {p}L) + {p}L + {c}L OR coalesce(runix >= eunix, false) THEN 'dropped'
            ELSE 'corrects' END AS fate
FROM {t}
"""

_REVISIONS = """
WITH cells AS (
  SELECT event_period, arrival_period, count(*) AS n, count(value) AS n_value, sum(value) AS value
  FROM ({placed}) WHERE fate IN ('on_time', 'corrects') GROUP BY event_period, arrival_period)
SELECT event_period, arrival_period,
       row_number() OVER w - 1 AS revision,
       sum(n) OVER r AS n, sum(n_value) OVER r AS n_value, sum(value) OVER r AS value
FROM cells
WINDOW w AS (PARTITION BY event_period ORDER BY arrival_period),
       r AS (PARTITION BY event_period ORDER BY arrival_period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
"""


def _sql(df: DataFrame, query: str, period: int, cutoff: int) -> DataFrame:
    name = f"late_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(name)
    placed = _PLACED.format(p=period, c=cutoff, t=name)
    try:
        return df.sparkSession.sql(query.format(placed=placed))
    finally:
        df.sparkSession.catalog.dropTempView(name)


def placed(df: DataFrame, period: int = HOUR, cutoff: int = 2 * HOUR) -> DataFrame:
    """``df`` (with ``unix, runix, eunix``) and where each row falls: ``event_period, arrival_period, fate``.

    ``fate`` is ``on_time`` before the end of the row's period, ``corrects`` after it, and ``dropped`` from ``cutoff``
    after that end on, or once the row's own ``eunix`` has passed; null where ``unix`` or ``runix`` is. A stored
    ``unix_hour`` is never used. Every copy of a row counts.
    """
    return _sql(df, "SELECT * FROM ({placed})", period, cutoff)


def revisions(df: DataFrame, period: int = HOUR, cutoff: int = 2 * HOUR) -> DataFrame:
    """Every revision of the figures of each period: ``event_period, arrival_period, revision, n, n_value, value`` of the rows
    arrived so far (``df`` has ``unix, runix, eunix, value``). Dropped rows and rows without an instant don't count."""
    return _sql(df, _REVISIONS, period, cutoff)
