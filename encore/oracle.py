"""Independent SQL formulations (DuckDB dialect) of every catalog query.

The entity views are written again in SQL (``PRELUDE``) from the raw tables;
temporal lookups use ``ASOF JOIN`` and changelogs use plain window functions,
so they share no code with the Spark plans. Fixed values repeat those of
``encore.sources.domain`` and ``encore.catalog``.
"""

from __future__ import annotations

_STATES = "['MN','WI','NV','WV','NY','CA','TX','FL','IL','OH','GA','NC','MI','NJ','VA','WA','AZ','MA','TN','IN','MO','MD','CO','OR','IA']"

PRELUDE = f"""
log AS (
  SELECT event_id, user_id, value, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(ts AS TIMESTAMP) AS ts
  FROM events),
listen AS (
  SELECT event_id AS id, user_id AS customerid, CAST(k % 25 + 1 AS BIGINT) AS artistid, ts
  FROM log WHERE event_type IN ('view', 'click')),
ticket AS (
  SELECT event_id AS id, user_id AS customerid, CAST(k AS BIGINT) AS eventid, value AS price, ts
  FROM log WHERE event_type = 'purchase'),
caddress AS (
  SELECT 'A' || CAST(event_id AS VARCHAR) AS id, user_id AS customerid,
         CAST(k + 100 AS VARCHAR) || ' 1st St' AS line1,
         CASE WHEN k % 4 = 0 THEN NULL ELSE 'Apt ' || CAST(k % 9 + 1 AS VARCHAR) END AS line2,
         'Town ' || CAST(k AS VARCHAR) AS citynm,
         {_STATES}[k % 25 + 1] AS state,
         lpad(CAST(k AS VARCHAR), 5, '0') AS zip5,
         lpad(CAST(user_id % 10000 AS VARCHAR), 4, '0') AS zip4,
         'USA' AS countrycd, ts
  FROM log WHERE event_type = 'signup'),
vaddress AS (
  SELECT 'V' || CAST(s_suppkey AS VARCHAR) AS id, CAST(NULL AS BIGINT) AS customerid,
         CAST(s_suppkey AS VARCHAR) || ' Arena Way' AS line1, CAST(NULL AS VARCHAR) AS line2,
         n_name AS citynm, {_STATES}[s_nationkey % 25 + 1] AS state,
         lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS zip5, '0000' AS zip4, 'USA' AS countrycd,
         TIMESTAMP '1970-01-01 00:00:00' AS ts
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
address AS (SELECT * FROM caddress UNION ALL SELECT * FROM vaddress),
venue AS (
  SELECT s_suppkey AS id, 'V' || CAST(s_suppkey AS VARCHAR) AS addressid, s_name AS name,
         100 AS maxcapacity, TIMESTAMP '1970-01-01 00:00:00' AS ts
  FROM supplier),
event AS (
  SELECT p_partkey AS id, CAST(substr(p_brand, 7, 10) AS BIGINT) AS artistid,
         p_partkey % (SELECT count(*) FROM supplier) AS venueid, p_size AS capacity,
         strftime(ets + INTERVAL 30 DAY, '%Y-%m-%d') AS eventdate, ets AS ts
  FROM (SELECT *, TIMESTAMP '2024-01-01 00:00:00'
                  + to_hours(CAST((p_partkey * 7) % 720 AS BIGINT)) AS ets FROM part)),
artist AS (
  SELECT CAST(substr(p_brand, 7, 10) AS BIGINT) AS id, min(p_brand) AS name,
         arg_min(p_type, p_partkey) AS genre
  FROM part GROUP BY 1),
cust AS (
  SELECT c_custkey AS id, c_name AS fullname,
         CASE WHEN c_acctbal < 0 THEN 'unknown'
              ELSE CAST(1980 + c_custkey % 30 AS VARCHAR) || '-'
                   || lpad(CAST(1 + c_custkey % 12 AS VARCHAR), 2, '0') || '-'
                   || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') END AS birthdt,
         CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'legacy' ELSE 'current' END AS feed
  FROM customer),
-- shared building blocks
tix_event AS (   -- ticket -> event as of purchase
  SELECT t.*, e.artistid, e.venueid AS ev_venueid, e.capacity AS ev_capacity
  FROM ticket t ASOF JOIN event e ON t.eventid = e.id AND t.ts >= e.ts),
outcome AS (     -- P5 fold
  SELECT *, cap - rn AS rem FROM (
    SELECT *, first_value(ev_capacity) OVER w AS cap, row_number() OVER w AS rn
    FROM tix_event
    WINDOW w AS (PARTITION BY eventid ORDER BY ts, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))),
outcome2 AS (
  SELECT *, CASE WHEN rem < 0 THEN 0.0 ELSE CAST(rem AS DOUBLE) / CAST(cap AS DOUBLE) * 100.0 END AS pct
  FROM outcome),
tix_addr AS (    -- ticket -> buyer address as of purchase
  SELECT t.*, a.id AS addressid, a.state AS customerstate, a.zip5
  FROM ticket t ASOF JOIN (SELECT * FROM address WHERE customerid IS NOT NULL) a
    ON t.customerid = a.customerid AND t.ts >= a.ts),
venue_addr AS (  -- J5: venue -> address as of the venue row
  SELECT v.id AS venueid, v.addressid, a.state, v.ts
  FROM venue v ASOF JOIN address a ON v.addressid = a.id AND v.ts >= a.ts),
event_va AS (    -- J6: event -> stored venue/address pair as of the event row
  SELECT e.*, va.state AS eventstate
  FROM event e ASOF JOIN venue_addr va ON e.venueid = va.venueid AND e.ts >= va.ts),
listen_state AS (  -- J7
  SELECT l.*, a.state
  FROM listen l ASOF JOIN (SELECT * FROM address WHERE customerid IS NOT NULL) a
    ON l.customerid = a.customerid AND l.ts >= a.ts),
event_venue AS (   -- J8
  SELECT e.id, e.artistid, e.venueid, e.capacity, e.ts, v.addressid
  FROM event e ASOF JOIN venue v ON e.venueid = v.id AND e.ts >= v.ts),
event_state AS (   -- J9
  SELECT ev.*, a.state
  FROM event_venue ev ASOF JOIN (SELECT * FROM address WHERE customerid IS NULL) a
    ON ev.addressid = a.id AND ev.ts >= a.ts),
event_counts AS (  -- J10: in-state listens up to each event
  SELECT es.*, (SELECT count(*) FROM listen_state ls
                WHERE ls.artistid = es.artistid AND ls.state = es.state AND ls.ts <= es.ts) AS n
  FROM event_state es),
caddress_log AS (  -- addresses with tombstones
  SELECT id, customerid, state, ts, false AS gone FROM caddress
  UNION ALL
  SELECT 'A' || CAST(event_id AS VARCHAR), user_id, NULL, ts, true FROM log WHERE event_type = 'error'),
event_log AS (     -- events with tombstones
  SELECT id, artistid, capacity, ts, false AS gone FROM event
  UNION ALL
  SELECT id, NULL, NULL, ts + INTERVAL 120 HOUR, true FROM event WHERE id % 3 = 0),
tix_live AS (      -- ticket -> event that is not withdrawn at the purchase
  SELECT t.*, e.artistid, e.capacity AS ev_capacity
  FROM ticket t ASOF JOIN event_log e ON t.eventid = e.id AND t.ts >= e.ts WHERE NOT e.gone),
holder_listens AS (  -- J2
  SELECT l.* FROM listen l
  WHERE EXISTS (SELECT 1 FROM tix_event te
                WHERE te.customerid = l.customerid AND te.artistid = l.artistid AND te.ts <= l.ts))
"""


def _q(body: str) -> str:
    body = body.strip()
    if body.upper().startswith("WITH "):      # extra CTEs continue the prelude's list
        body = ",\n" + body[5:]
    return "WITH " + PRELUDE.strip() + "\n" + body


def _addr_text(src: str) -> str:
    parts = ", ".join(f"coalesce({c}, 'null')" for c in
                      ("line1", "line2", "citynm", "state", "zip5", "zip4", "countrycd"))
    return f"SELECT id, state, printf('%s, %s, %s, %s %s-%s %s', {parts}) AS address FROM {src}"


_STATUS = "CASE WHEN rem >= 0 THEN 'CONFIRMED' ELSE 'REJECTED' END"
_TIER = "CASE WHEN rem < 0 THEN 'SOLD_OUT' WHEN pct <= 20.0 THEN 'LIMITED' WHEN pct > 20.0 THEN 'OPEN' END"

ORACLE: dict[str, str] = {
    "target_customer_filter": _q("""
        SELECT id, fullname, birthdt, feed FROM (
          SELECT * FROM cust WHERE feed = 'current' UNION ALL SELECT * FROM cust WHERE feed = 'legacy')
        WHERE TRY_CAST(split_part(birthdt, '-', 1) AS INTEGER) >= 1990
          AND TRY_CAST(split_part(birthdt, '-', 1) AS INTEGER) < 2000"""),
    "merge_customers": _q("""
        SELECT id, fullname, birthdt, feed FROM cust WHERE feed = 'current'
        UNION ALL SELECT id, fullname, birthdt, feed FROM cust WHERE feed = 'legacy'"""),
    "address_stringify": _q(_addr_text("address")),
    "address_split_priority": _q(_addr_text("(SELECT * FROM address WHERE state IS NOT DISTINCT FROM 'MN')")),
    "address_split_default": _q(_addr_text("(SELECT * FROM address WHERE state IS DISTINCT FROM 'MN')")),
    "split_addresses_by_owner": _q("""
        SELECT id, customerid, state, CASE WHEN customerid IS NULL THEN 'venue' ELSE 'customer' END AS owner
        FROM address"""),
    "customer_stream_count": _q("""
        SELECT customerid, count(*) AS n FROM listen WHERE customerid IS NOT NULL GROUP BY customerid"""),
    "customer_stream_count_changelog": _q("""
        SELECT id, customerid,
               count(*) OVER (PARTITION BY customerid ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS n
        FROM listen WHERE customerid IS NOT NULL"""),
    "artist_ticket_count": _q("""
        SELECT artistid, count(*) AS n FROM tix_event WHERE artistid IS NOT NULL GROUP BY artistid"""),
    "artist_ticket_count_changelog": _q("""
        SELECT id, artistid,
               count(*) OVER (PARTITION BY artistid ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS n
        FROM tix_event WHERE artistid IS NOT NULL"""),
    "stream_count_by_artist_state": _q("""
        SELECT artistid, state, count(*) AS streamcount FROM listen_state GROUP BY artistid, state"""),
    "totals": _q("""
        SELECT (SELECT count(*) FROM cust) AS total_customers, (SELECT count(*) FROM listen) AS total_streams,
               (SELECT count(*) FROM event) AS total_events, (SELECT count(*) FROM ticket) AS total_tickets"""),
    "total_past_events": _q("""
        SELECT count(*) FILTER (WHERE strptime(eventdate, '%Y-%m-%d') < TIMESTAMP '2024-02-15') AS total_past_events
        FROM event"""),
    "latest_by_key_address": _q("""
        SELECT customerid, arg_max(id, (ts, id)) AS id, arg_max(state, (ts, id)) AS state
        FROM caddress WHERE customerid IS NOT NULL GROUP BY customerid"""),
    "versions_by_key_address": _q("""
        SELECT customerid, id, state, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
               strftime(lead(ts) OVER (PARTITION BY customerid ORDER BY ts, id), '%Y-%m-%d %H:%M:%S.%f') AS valid_to
        FROM caddress WHERE customerid IS NOT NULL"""),
    "write_keyed": _q("""
        SELECT CAST(customerid AS VARCHAR) AS key, CAST(count(*) AS VARCHAR) AS value
        FROM listen WHERE customerid IS NOT NULL GROUP BY customerid"""),
    "purchase_event_ticket": _q(f"""
        SELECT id AS ticketid, eventid, customerid, CAST(rem AS DOUBLE) AS remainingtickets,
               {_STATUS} AS confirmationstatus, {_TIER} AS tier, 'CONF-' || CAST(id AS VARCHAR) AS confirmationid
        FROM outcome2 WHERE ({_TIER}) IS NOT NULL"""),
    "purchase_event_ticket_orders": _q("""
        WITH big AS (
          SELECT l.*, o.o_custkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
        r AS (
          SELECT big.*, p.p_size AS cap,
                 row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber,
                   l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
                   l_linestatus) AS rn
          FROM big JOIN part p ON p.p_partkey = big.l_partkey),
        x AS (
          SELECT *, cap - rn AS rem,
                 CASE WHEN cap - rn < 0 THEN 0.0 ELSE CAST(cap - rn AS DOUBLE) / CAST(cap AS DOUBLE) * 100.0 END AS pct
          FROM r)
        SELECT l_orderkey, l_linenumber, l_partkey AS eventid, o_custkey AS customerid,
               CAST(rem AS DOUBLE) AS remainingtickets, CASE WHEN rem >= 0 THEN 'CONFIRMED' ELSE 'REJECTED' END AS confirmationstatus,
               CASE WHEN rem < 0 THEN 'SOLD_OUT' WHEN pct <= 20.0 THEN 'LIMITED' WHEN pct > 20.0 THEN 'OPEN' END AS tier
        FROM x
        WHERE (CASE WHEN rem < 0 THEN 'SOLD_OUT' WHEN pct <= 20.0 THEN 'LIMITED' WHEN pct > 20.0 THEN 'OPEN' END) IS NOT NULL"""),
    "ticket_tiers": _q(f"SELECT id AS ticketid, eventid, {_TIER} AS tier FROM outcome2"),
    "alert_near_capacity": _q("""
        SELECT eventid, arg_min(id, (ts, id)) AS ticketid, arg_min(CAST(rem AS DOUBLE), (ts, id)) AS remainingtickets,
               'NEAR_CAPACITY' AS alert
        FROM outcome2 WHERE rem >= 0 AND pct <= 10.0 GROUP BY eventid"""),
    "alert_sold_out": _q("""
        SELECT eventid, arg_min(id, (ts, id)) AS ticketid, arg_min(CAST(rem AS DOUBLE), (ts, id)) AS remainingtickets,
               'SOLD_OUT' AS alert
        FROM outcome2 WHERE rem = 0 GROUP BY eventid"""),
    "ticket_notifications": _q(f"""
        SELECT id AS ticketid, 'tickets@example.com' AS sender, CAST(customerid AS VARCHAR) || '@email.com' AS recipient,
               'Ticket Confirmation (CONF-' || CAST(id AS VARCHAR) || ') - Event ' || CAST(eventid AS VARCHAR) AS subject,
               'Your ticket has been ' || {_STATUS} || '!' AS body
        FROM outcome2 WHERE ({_TIER}) IS NOT NULL"""),
    "top_customer_artists": _q("""
        SELECT customerid, rnk, artistid, n FROM (
          SELECT customerid, artistid, n,
                 row_number() OVER (PARTITION BY customerid ORDER BY n DESC, last_ts, last_id) AS rnk
          FROM (SELECT customerid, artistid, count(*) AS n, max(ts) AS last_ts, arg_max(id, (ts, id)) AS last_id
                FROM listen WHERE customerid IS NOT NULL GROUP BY customerid, artistid))
        WHERE rnk <= 3"""),
    "least_streaming_ticket_holders": _q("""
        SELECT artistid, rnk, customerid, streamamount FROM (
          SELECT artistid, customerid, streamamount,
                 row_number() OVER (PARTITION BY artistid ORDER BY streamamount,
                     CASE WHEN streamamount = 1 THEN epoch_us(last_ts) ELSE -epoch_us(last_ts) END,
                     CASE WHEN streamamount = 1 THEN last_id ELSE -last_id END) AS rnk
          FROM (SELECT artistid, customerid, count(*) AS streamamount, max(ts) AS last_ts,
                       arg_max(id, (ts, id)) AS last_id
                FROM holder_listens GROUP BY artistid, customerid))
        WHERE rnk <= 2"""),
    "global_top_artists": _q("""
        SELECT row_number() OVER (ORDER BY n DESC, artistid) AS rnk, artistid, n
        FROM (SELECT artistid, count(*) AS n FROM listen GROUP BY artistid)
        ORDER BY n DESC, artistid LIMIT 3"""),
    "customers_by_top_artist": _q("""
        WITH first AS (
          SELECT customerid, artistid FROM (
            SELECT customerid, artistid,
                   row_number() OVER (PARTITION BY customerid ORDER BY n DESC, last_ts, last_id) AS rnk
            FROM (SELECT customerid, artistid, count(*) AS n, max(ts) AS last_ts, arg_max(id, (ts, id)) AS last_id
                  FROM listen WHERE customerid IS NOT NULL GROUP BY customerid, artistid))
          WHERE rnk = 1)
        SELECT artistid, customerid, count(*) OVER (PARTITION BY artistid) AS group_size FROM first"""),
    "top_n_per_key": _q("""
        SELECT artistid, rnk, customerid, n FROM (
          SELECT artistid, customerid, n,
                 row_number() OVER (PARTITION BY artistid ORDER BY n DESC, customerid) AS rnk
          FROM (SELECT artistid, customerid, count(*) AS n FROM listen GROUP BY artistid, customerid))
        WHERE rnk <= 2"""),
    "bottom_n_per_key": _q("""
        SELECT customerid, rnk, artistid, n FROM (
          SELECT customerid, artistid, n,
                 row_number() OVER (PARTITION BY customerid ORDER BY n, artistid) AS rnk
          FROM (SELECT customerid, artistid, count(*) AS n FROM listen GROUP BY customerid, artistid))
        WHERE rnk <= 2"""),
    "join_ticket_event": _q("SELECT id, customerid, eventid, artistid FROM tix_event"),
    "join_stream_ticket_holder": _q("SELECT id, customerid, artistid FROM holder_listens"),
    "join_ticket_customer_address": _q("""
        SELECT id, customerid, eventid, addressid, customerstate, zip5 FROM tix_addr"""),
    "join_ticket_event_venue_address": _q("""
        SELECT t.id, t.customerid, t.eventid, e.eventstate
        FROM ticket t ASOF JOIN event_va e ON t.eventid = e.id AND t.ts >= e.ts"""),
    "join_venue_address": _q("SELECT venueid, addressid, state FROM venue_addr"),
    "join_event_venue_address": _q("""
        SELECT id, artistid, venueid, capacity, eventdate, eventstate FROM event_va"""),
    "join_stream_customer_address": _q("SELECT id, customerid, artistid, state FROM listen_state"),
    "join_event_venue": _q("SELECT id, artistid, venueid, capacity, addressid FROM event_venue"),
    "join_event_venue_state": _q("SELECT id, artistid, venueid, capacity, addressid, state FROM event_state"),
    "left_join_event_stream_counts": _q("""
        SELECT id AS eventid, artistid, state, capacity, CAST(n AS BIGINT) AS streamcount FROM event_counts"""),
    "out_of_state_ticket_holders": _q("""
        SELECT t.id AS ticketid, t.eventid, t.customerid, t.addressid, t.customerstate, e.eventstate
        FROM tix_addr t ASOF JOIN event_va e ON t.eventid = e.id AND t.ts >= e.ts
        WHERE t.customerstate != e.eventstate"""),
    "instate_streamers_vs_capacity": _q("""
        SELECT artistid, state, CAST(arg_min(n, (ts, id)) AS BIGINT) AS streamcount,
               CAST(sum(capacity) AS BIGINT) AS capacity
        FROM event_counts GROUP BY artistid, state"""),
    "instate_streamers_vs_capacity_changelog": _q("""
        SELECT id AS eventid, artistid, state,
               CAST(first_value(n) OVER w AS BIGINT) AS streamcount,
               CAST(sum(capacity) OVER w AS BIGINT) AS capacity
        FROM event_counts
        WINDOW w AS (PARTITION BY artistid, state ORDER BY ts, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    "out_of_state_tickets_by_event": _q("""
        WITH home AS (
          SELECT customerid, state FROM address WHERE customerid IS NOT NULL),
        hall AS (
          SELECT event.id AS eventid, place.state
          FROM event, venue, address AS place
          WHERE venue.id = event.venueid AND place.id = venue.addressid)
        SELECT hall.eventid, count(*) AS num_out_of_state_tickets
        FROM ticket JOIN hall USING (eventid) JOIN home USING (customerid)
        WHERE home.state <> hall.state
        GROUP BY hall.eventid"""),
    "high_attendance_events_by_state": _q("""
        WITH sold AS (SELECT eventid, count(id) AS tickets FROM ticket GROUP BY eventid)
        SELECT place.state, count(*) AS num_high_attendance_events
        FROM sold
        JOIN event ON event.id = sold.eventid
        JOIN venue AS hall ON hall.id = event.venueid
        JOIN address AS place ON place.id = hall.addressid
        WHERE CAST(eventdate AS DATE) BETWEEN DATE '2024-02-02' AND DATE '2024-02-19'
          AND tickets > 0.80 * capacity
        GROUP BY place.state"""),
    "venue_most_events": _q("""
        SELECT venueid, count(*) AS num_events FROM event WHERE venueid IS NOT NULL
        GROUP BY venueid ORDER BY num_events DESC, venueid LIMIT 1"""),
    "venue_most_customers": _q("""
        SELECT ev_venueid AS venueid, count(DISTINCT customerid) AS num_customers FROM tix_event
        GROUP BY ev_venueid ORDER BY num_customers DESC, venueid LIMIT 1"""),
    "tickets_by_zip": _q("SELECT zip5, count(*) AS num_tickets FROM tix_addr GROUP BY zip5"),
    "alert_popular_event_in_zip": _q("""
        WITH buyer AS (
          SELECT DISTINCT eventid, zip5, customerid FROM tix_addr
          WHERE eventid IN (SELECT eventid FROM outcome2 WHERE rem >= 0 AND pct <= 10.0)),
        lives AS (
          SELECT customerid, arg_max(zip5, (ts, id)) AS zip5 FROM caddress
          WHERE customerid IS NOT NULL GROUP BY customerid)
        SELECT b.eventid, lives.zip5, lives.customerid, count(*) AS num_customers
        FROM lives JOIN buyer b ON b.zip5 = lives.zip5 AND b.customerid <> lives.customerid
        GROUP BY b.eventid, lives.zip5, lives.customerid"""),
    "alert_top_streamers_of_new_event": _q("""
        SELECT eventid, artistid, rnk, customerid, n FROM (
          SELECT e.id AS eventid, e.artistid, l.customerid, count(*) AS n,
                 row_number() OVER (PARTITION BY e.id ORDER BY count(*) DESC, l.customerid) AS rnk
          FROM event e JOIN listen l ON l.artistid = e.artistid AND l.ts <= e.ts
          GROUP BY e.id, e.artistid, l.customerid)
        WHERE rnk <= 3"""),
    "alert_top_streamers_with_email": _q("""
        SELECT t.eventid, t.artistid, t.rnk, t.customerid, t.n, 'c' || CAST(c.c_custkey AS VARCHAR) || '@mail.test' AS email
        FROM (
          SELECT eventid, artistid, rnk, customerid, n FROM (
            SELECT e.id AS eventid, e.artistid, l.customerid, count(*) AS n,
                   row_number() OVER (PARTITION BY e.id ORDER BY count(*) DESC, l.customerid) AS rnk
            FROM event e JOIN listen l ON l.artistid = e.artistid AND l.ts <= e.ts
            GROUP BY e.id, e.artistid, l.customerid)
          WHERE rnk <= 3) t
        LEFT JOIN customer c ON c.c_custkey = t.customerid"""),
    "suggest_event_by_genre": _q("""
        WITH heard AS (
          SELECT e.id AS eventid, e.genre AS eventgenre, l.customerid, a.genre, count(*) AS n,
                 max(l.ts) AS last_ts, arg_max(l.id, (l.ts, l.id)) AS last_id
          FROM (SELECT event.id, event.ts, artist.genre FROM event JOIN artist ON artist.id = event.artistid) e
          JOIN listen l ON l.ts <= e.ts JOIN artist a ON a.id = l.artistid
          WHERE l.customerid IS NOT NULL
          GROUP BY e.id, e.genre, l.customerid, a.genre),
        favourite AS (
          SELECT *, row_number() OVER (PARTITION BY eventid, customerid ORDER BY n DESC, last_ts, last_id) AS rnk
          FROM heard)
        SELECT event.id AS eventid, artist.genre, count(f.customerid) AS num_customers
        FROM event JOIN artist ON artist.id = event.artistid
        LEFT JOIN (SELECT * FROM favourite WHERE rnk = 1 AND genre = eventgenre) f ON f.eventid = event.id
        GROUP BY event.id, artist.genre"""),
    "suggest_popular_event_by_genre": _q("""
        WITH heard AS (
          SELECT e.id AS eventid, e.genre AS eventgenre, l.customerid, a.genre, count(*) AS n,
                 max(l.ts) AS last_ts, arg_max(l.id, (l.ts, l.id)) AS last_id
          FROM (SELECT event.id, event.ts, artist.genre FROM event JOIN artist ON artist.id = event.artistid
                WHERE event.id IN (SELECT eventid FROM outcome2 WHERE rem >= 0 AND pct <= 10.0)) e
          JOIN listen l ON l.ts <= e.ts JOIN artist a ON a.id = l.artistid
          WHERE l.customerid IS NOT NULL
          GROUP BY e.id, e.genre, l.customerid, a.genre),
        favourite AS (
          SELECT *, row_number() OVER (PARTITION BY eventid, customerid ORDER BY n DESC, last_ts, last_id) AS rnk
          FROM heard)
        SELECT eventid, customerid, genre FROM favourite WHERE rnk = 1 AND genre = eventgenre"""),
}

ORACLE["top_customer_artists_changelog"] = _q("""
    WITH heard AS (
      SELECT id, customerid, artistid, ts,
             count(*) OVER (PARTITION BY customerid, artistid ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS n
      FROM listen WHERE customerid IS NOT NULL),
    sofar AS (
      SELECT now.id, now.customerid, past.artistid, max(past.n) AS n, arg_max(past.ts, past.n) AS last_ts,
             arg_max(past.id, past.n) AS last_id
      FROM heard now JOIN heard past
        ON past.customerid = now.customerid AND (past.ts < now.ts OR (past.ts = now.ts AND past.id <= now.id))
      GROUP BY now.id, now.customerid, past.artistid)
    SELECT id, customerid, rnk, artistid, n FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, last_ts, last_id) AS rnk FROM sofar)
    WHERE rnk <= 3""")
ORACLE["least_streaming_ticket_holders_changelog"] = _q("""
    WITH heard AS (
      SELECT id, customerid, artistid, ts,
             count(*) OVER (PARTITION BY customerid, artistid ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS n
      FROM holder_listens),
    sofar AS (
      SELECT now.id, now.artistid, past.customerid, max(past.n) AS n, arg_max(past.ts, past.n) AS last_ts,
             arg_max(past.id, past.n) AS last_id
      FROM heard now JOIN heard past
        ON past.artistid = now.artistid AND (past.ts < now.ts OR (past.ts = now.ts AND past.id <= now.id))
      GROUP BY now.id, now.artistid, past.customerid)
    SELECT id, artistid, rnk, customerid, n AS streamamount FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY n,
                  CASE WHEN n = 1 THEN epoch_us(last_ts) ELSE -epoch_us(last_ts) END,
                  CASE WHEN n = 1 THEN last_id ELSE -last_id END) AS rnk FROM sofar)
    WHERE rnk <= 2""")
ORACLE["latest_by_key_address_deletes"] = _q("""
    SELECT customerid, id, state FROM (
      SELECT customerid, arg_max(id, (ts, id)) AS id, arg_max(coalesce(state, ''), (ts, id)) AS state,
             arg_max(gone, (ts, id)) AS gone
      FROM caddress_log GROUP BY customerid) WHERE NOT gone""")
ORACLE["versions_by_key_address_deletes"] = _q("""
    SELECT customerid, id, state, valid_from, valid_to FROM (
      SELECT customerid, id, state, gone, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS valid_from,
             strftime(lead(ts) OVER (PARTITION BY customerid ORDER BY ts, id), '%Y-%m-%d %H:%M:%S.%f') AS valid_to
      FROM caddress_log WHERE customerid IS NOT NULL) WHERE NOT gone""")
ORACLE["join_ticket_customer_address_deletes"] = _q("""
    SELECT t.id, t.customerid, t.eventid, a.id AS addressid, a.state AS customerstate
    FROM ticket t ASOF JOIN caddress_log a ON t.customerid = a.customerid AND t.ts >= a.ts WHERE NOT a.gone""")
ORACLE["join_ticket_event_deletes"] = _q("SELECT id, customerid, eventid, artistid FROM tix_live")
ORACLE["purchase_event_ticket_deletes"] = _q(f"""
    WITH numbered AS (
      SELECT *, first_value(ev_capacity) OVER w AS cap, row_number() OVER w AS rn FROM tix_live
      WINDOW w AS (PARTITION BY eventid ORDER BY ts, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    x AS (
      SELECT *, cap - rn AS rem,
             CASE WHEN cap - rn < 0 THEN 0.0 ELSE CAST(cap - rn AS DOUBLE) / CAST(cap AS DOUBLE) * 100.0 END AS pct
      FROM numbered)
    SELECT id AS ticketid, eventid, customerid, CAST(rem AS DOUBLE) AS remainingtickets,
           {_STATUS} AS confirmationstatus, {_TIER} AS tier, 'CONF-' || CAST(id AS VARCHAR) AS confirmationid
    FROM x WHERE ({_TIER}) IS NOT NULL""")
ORACLE["typed_ticket_records"] = _q("""
    SELECT CAST(id AS VARCHAR) AS key,
           CASE id % 10 WHEN 0 THEN 'deleted' WHEN 1 THEN 'malformed' ELSE 'ok' END AS status,
           CASE WHEN id % 10 > 1 THEN customerid END AS customerid, CASE WHEN id % 10 > 1 THEN eventid END AS eventid,
           CASE WHEN id % 10 = 1 THEN printf('{"id":%d,"customerid":%d,"eventid":%d', id, customerid, eventid) END
             AS unparsed
    FROM ticket""")
ORACLE["write_keyed_text"] = "SELECT id AS key, address AS value FROM (" + ORACLE["address_stringify"] + ")"
ORACLE["write_keyed_json"] = (
    "SELECT CAST(customerid AS VARCHAR) AS key, printf('{\"rnk\":%d,\"artistid\":%d,\"n\":%d}', rnk, artistid, n) "
    "AS value FROM (" + ORACLE["top_customer_artists"] + ")")
ORACLE["totals_running"] = _q("""
    WITH everything AS (
      SELECT ts, 'c' AS feed FROM (SELECT TIMESTAMP '1970-01-01 00:00:00' AS ts FROM cust)
      UNION ALL SELECT ts, 's' FROM listen UNION ALL SELECT ts, 'e' FROM event UNION ALL SELECT ts, 't' FROM ticket),
    daily AS (
      SELECT CAST(ts AS DATE) AS day, count(*) FILTER (feed = 'c') AS c, count(*) FILTER (feed = 's') AS s,
             count(*) FILTER (feed = 'e') AS e, count(*) FILTER (feed = 't') AS t
      FROM everything GROUP BY 1)
    SELECT strftime(day, '%Y-%m-%d') AS day, CAST(sum(c) OVER w AS BIGINT) AS total_customers,
           CAST(sum(s) OVER w AS BIGINT) AS total_streams, CAST(sum(e) OVER w AS BIGINT) AS total_events,
           CAST(sum(t) OVER w AS BIGINT) AS total_tickets
    FROM daily WINDOW w AS (ORDER BY day ROWS UNBOUNDED PRECEDING)""")
ORACLE["high_attendance_events_by_state_sql"] = ORACLE["high_attendance_events_by_state"]

# Streaming twins produce the batch results.
for _name in ("purchase_event_ticket", "customer_stream_count_changelog", "customer_stream_count",
              "top_customer_artists", "top_customer_artists_changelog", "least_streaming_ticket_holders_changelog",
              "target_customer_filter", "artist_ticket_count", "out_of_state_ticket_holders",
              "instate_streamers_vs_capacity_changelog", "least_streaming_ticket_holders",
              "purchase_event_ticket_deletes", "venue_most_customers", "totals_running"):
    ORACLE[f"stream_{_name}"] = ORACLE[_name]
ORACLE["stream_purchase_event_ticket_tables"] = ORACLE["purchase_event_ticket"]
ORACLE["stream_alert_near_capacity"] = ORACLE["alert_near_capacity"]
ORACLE["stream_alert_sold_out"] = ORACLE["alert_sold_out"]
ORACLE["stream_address_split_priority"] = ORACLE["address_split_priority"]
ORACLE["stream_address_split_default"] = ORACLE["address_split_default"]
