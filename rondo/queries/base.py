"""Query registry, and the two staging inputs written once in SQL for the equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

EVENTS_SQL = """
part_count AS (SELECT count(*) AS n FROM part),
staging_events AS (
  SELECT b.event_id, b.page,
         CASE WHEN b.page = 'NextSong' THEN p.p_brand END AS artist,
         CASE WHEN b.page = 'NextSong'
              THEN concat(p.p_name, ' ', CAST(p.p_partkey % 50 AS VARCHAR)) END AS song,
         CASE WHEN b.page = 'NextSong'
              THEN CASE WHEN b.event_id % 5 = 0 THEN p.p_retailprice + 0.75 ELSE p.p_retailprice + 0.25 END
         END AS length,
         CASE WHEN b.event_id % 97 = 0 THEN 'Logged Out' ELSE 'Logged In' END AS auth,
         CASE WHEN b.event_id % 97 = 0 THEN '' ELSE CAST(b.user_id AS VARCHAR) END AS "userId",
         c.c_name AS "firstName", c.c_mktsegment AS "lastName",
         CASE WHEN b.user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         CASE WHEN extract(day FROM b.ts) % 2 = 0 THEN 'paid' ELSE 'free' END AS level,
         n.n_name AS location,
         CAST(b.user_id * 1000 + extract(doy FROM b.ts) AS BIGINT) AS "sessionId",
         CAST(row_number() OVER (PARTITION BY b.user_id, extract(doy FROM b.ts)
                                 ORDER BY b.ts, b.event_id) - 1 AS BIGINT) AS "itemInSession",
         CASE WHEN b.page = 'NextSong' THEN 'PUT' ELSE 'GET' END AS method,
         CAST(200 AS BIGINT) AS status,
         CAST(1540000000000 + b.user_id AS DOUBLE) AS registration,
         concat('agent/', CAST(b.user_id % 5 AS VARCHAR)) AS "userAgent",
         epoch_us(b.ts) // 1000 AS ts
  FROM (SELECT *, CASE WHEN event_type IN ('view', 'purchase') THEN 'NextSong'
                       WHEN event_type = 'click' THEN 'Home'
                       WHEN event_type = 'signup' THEN 'Login' ELSE 'Logout' END AS page
        FROM events) b
  LEFT JOIN part p ON p.p_partkey = b.event_id % (SELECT n FROM part_count)
  LEFT JOIN customer c ON c.c_custkey = b.user_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
)"""

SONGS_SQL = """
base_songs AS (
  SELECT p_partkey, 1 AS num_songs, concat('AR', p_brand) AS artist_id,
         CASE WHEN p_size % 2 <> 0 THEN p_size * 1.5 END AS artist_latitude,
         CASE WHEN p_size % 2 <> 0 THEN p_size * -2.5 END AS artist_longitude,
         CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END AS artist_location,
         p_brand AS artist_name,
         concat('SO', CAST(p_partkey AS VARCHAR)) AS song_id,
         concat(p_name, ' ', CAST(p_partkey % 50 AS VARCHAR)) AS title,
         p_retailprice + 0.25 AS duration,
         CAST(CASE WHEN p_size % 4 = 0 THEN 0 ELSE 1970 + p_size END AS INTEGER) AS year
  FROM part),
staging_songs AS (
  SELECT num_songs, artist_id, CAST(artist_latitude AS DOUBLE) AS artist_latitude,
         CAST(artist_longitude AS DOUBLE) AS artist_longitude, artist_location, artist_name, song_id, title,
         duration, year
  FROM (SELECT * FROM base_songs
        UNION ALL SELECT * FROM base_songs WHERE p_partkey % 7 = 0
        UNION ALL SELECT * REPLACE (concat('SR', CAST(p_partkey AS VARCHAR)) AS song_id,
                                    CAST(year + 1 AS INTEGER) AS year)
                  FROM base_songs WHERE p_partkey % 10 = 0))"""


def query(name: str, sql: str | None = None, extra: str = "") -> Callable[[Query], Query]:
    """Register a query; ``sql`` may read staging_events and staging_songs, ``extra`` adds more WITH parts."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            parts = []
            text = extra + sql
            if "staging_events" in text:
                parts.append(EVENTS_SQL)
            if "staging_songs" in text:
                parts.append(SONGS_SQL)
            if extra:
                parts.append("\n" + extra.strip())
            ORACLES[name] = (f"WITH {','.join(parts)}\n" if parts else "") + sql.strip()
        return fn

    return add
