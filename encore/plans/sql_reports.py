"""A relational report as SQL text (Spark dialect) over the entity views.

The out-of-state report is offered only as a DataFrame plan: written as SQL
it joins every ticket to every address of its buyer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources import Domain

# Tickets are counted per event before any dimension is joined.
HIGH_ATTENDANCE_SQL = """
WITH sold AS (
  SELECT eventid, count(id) AS tickets FROM encore_ticket GROUP BY eventid),
dated AS (
  SELECT id AS eventid, venueid, capacity FROM encore_event
  WHERE to_date(eventdate) > to_date(:date_from) AND to_date(eventdate) < to_date(:date_to)),
full_events AS (
  SELECT dated.eventid, place.state
  FROM dated
  JOIN sold USING (eventid)
  JOIN encore_venue AS hall ON hall.id = dated.venueid
  JOIN encore_address AS place ON place.id = hall.addressid
  WHERE sold.tickets > 0.80 * dated.capacity)
SELECT state, count(eventid) AS num_high_attendance_events FROM full_events GROUP BY state
"""


def register_views(d: Domain) -> None:
    """Entity views as session temp views ``encore_<entity>``."""
    for name in ("event", "ticket", "venue", "address", "listen", "customer"):
        getattr(d, name).createOrReplaceTempView(f"encore_{name}")


def high_attendance_events_by_state_sql(d: Domain, date_from: str, date_to: str) -> DataFrame:
    register_views(d)
    return d.spark.sql(HIGH_ATTENDANCE_SQL, args={"date_from": date_from, "date_to": date_to})
