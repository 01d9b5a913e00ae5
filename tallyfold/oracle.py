"""Independent SQL (DuckDB dialect) for every registered query.

Written from the operator contracts, not from the Spark code: cumulative
tables are computed in closed form with windows over a key x period spine,
SCDs with LAG + running SUM + GROUP BY, position windows with plain ROWS
frames.  Views ``region nation customer supplier part orders lineitem
events ...`` are the test tables.
"""

from __future__ import annotations


def _band(expr: str, t: tuple[int, int, int]) -> str:
    return (
        f"CASE WHEN {expr} > {t[0]} THEN 'star' WHEN {expr} > {t[1]} THEN 'good' "
        f"WHEN {expr} > {t[2]} THEN 'average' ELSE 'bad' END"
    )


_W_RUN = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"

# ------------------------------------------------------------------ actors
ACTOR_SNAP = f"""
af AS (
  SELECT CAST(o_custkey AS VARCHAR) AS actorid, 'Actor#' || CAST(o_custkey AS VARCHAR) AS actor,
         CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(o_orderkey AS VARCHAR) AS filmid,
         o_totalprice / 50000.0 AS rating
  FROM orders),
ay AS (
  SELECT actorid, yr, min(actor) AS actor, count(*) AS n,
         string_agg(filmid, ',' ORDER BY filmid) AS ids, avg(rating) AS r
  FROM af GROUP BY actorid, yr),
amax AS (SELECT max(yr) AS my FROM ay),
afirst AS (SELECT actorid, min(yr) AS y0 FROM ay GROUP BY actorid),
aspine AS (
  SELECT actorid, CAST(g AS INTEGER) AS current_year
  FROM (SELECT f.actorid, unnest(generate_series(f.y0, m.my)) AS g FROM afirst f, amax m)),
asnap AS (
  SELECT s.actorid, max(y.actor) OVER (PARTITION BY s.actorid) AS actor, s.current_year,
         CAST(sum(coalesce(y.n, 0)) OVER w AS INTEGER) AS n_films,
         string_agg(y.ids, ',' ORDER BY s.current_year) OVER w AS film_ids,
         {_band("last_value(y.r IGNORE NULLS) OVER w", (8, 7, 6))} AS quality_class,
         y.n IS NOT NULL AS is_active
  FROM aspine s LEFT JOIN ay y ON s.actorid = y.actorid AND s.current_year = y.yr
  WINDOW w AS (PARTITION BY s.actorid ORDER BY s.current_year {_W_RUN}))
"""

# ------------------------------------------------------------------ players
PLAYER_SNAP = f"""
pyr AS (
  SELECT c.c_name AS player_name, c.c_mktsegment AS height, n.n_name AS country, p.season, p.pts
  FROM (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, avg(o_totalprice) / 20000.0 AS pts
        FROM orders GROUP BY 1, 2) p
  JOIN customer c ON p.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
pmax AS (SELECT max(season) AS my FROM pyr),
pfirst AS (SELECT player_name, min(season) AS y0 FROM pyr GROUP BY player_name),
pspine AS (
  SELECT player_name, CAST(g AS INTEGER) AS current_season
  FROM (SELECT f.player_name, unnest(generate_series(f.y0, m.my)) AS g FROM pfirst f, pmax m)),
psnap AS (
  SELECT s.player_name, s.current_season,
         first_value(y.height IGNORE NULLS) OVER w AS height,
         first_value(y.country IGNORE NULLS) OVER w AS country,
         CAST(count(y.season) OVER w AS INTEGER) AS n_seasons,
         string_agg(CAST(y.season AS VARCHAR), ',' ORDER BY s.current_season) OVER w AS season_list,
         {_band("last_value(y.pts IGNORE NULLS) OVER w", (20, 15, 10))} AS scoring_class,
         y.season IS NOT NULL AS is_active
  FROM pspine s LEFT JOIN pyr y ON s.player_name = y.player_name AND s.current_season = y.season
  WINDOW w AS (PARTITION BY s.player_name ORDER BY s.current_season {_W_RUN}))
"""


def _scd(src: str, key: str, period: str, attrs: list[str], carry: str | None, start: str, end: str) -> str:
    lagged = " OR ".join(f"{a} IS DISTINCT FROM lag({a}) OVER w" for a in attrs)
    a_list = ", ".join(attrs)
    carry_sel = f"min({carry}) AS {carry}, " if carry else ""
    return f"""
chg AS (
  SELECT {key}, {period}, {a_list}{', ' + carry if carry else ''},
         CASE WHEN lag({period}) OVER w IS NULL OR {lagged} THEN 1 ELSE 0 END AS st
  FROM {src} WINDOW w AS (PARTITION BY {key} ORDER BY {period})),
stk AS (
  SELECT *, sum(st) OVER (PARTITION BY {key} ORDER BY {period} {_W_RUN}) AS streak FROM chg)
SELECT {key}, {carry_sel}{a_list}, min({period}) AS {start}, max({period}) AS {end},
       CAST((SELECT max({period}) FROM {src}) AS INTEGER) AS {period}
FROM stk GROUP BY {key}, {a_list}, streak
"""


# ------------------------------------------------------------------ events
EVENTS = """
ev AS (
  SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS device_id, event_type AS host,
         ts AS event_time, CAST(ts AS DATE) AS day
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id) AS rn
        FROM events WHERE user_id IS NOT NULL)
  WHERE rn = 1),
mx AS (SELECT max(CAST(ts AS DATE)) AS d FROM events),
dev AS (
  SELECT DISTINCT device_id,
         ['Chrome', 'Firefox', 'Safari', 'Edge'][CAST(device_id % 4 AS INTEGER) + 1] AS browser_type
  FROM ev WHERE device_id IS NOT NULL),
ubd AS (
  SELECT DISTINCT e.user_id, d.browser_type, e.day
  FROM ev e JOIN dev d ON e.device_id = d.device_id, mx WHERE e.day <= mx.d)
"""

MONTH_LEN = (
    "CASE WHEN date_trunc('month', {m}) = date_trunc('month', mx.d) THEN day(mx.d) "
    "ELSE day(last_day({m})) END"
)

# ------------------------------------------------------------------ games
GAMES = """
tg AS (SELECT DISTINCT l_orderkey AS game_id, l_suppkey AS team_id FROM lineitem),
tgh AS (SELECT tg.*, min(team_id) OVER (PARTITION BY game_id) AS home_team FROM tg),
tgw AS (
  SELECT t.team_id, t.game_id, CAST(o.o_orderdate AS DATE) AS game_date,
         CAST(CASE WHEN t.team_id = t.home_team THEN o.o_orderstatus = 'F' ELSE o.o_orderstatus <> 'F' END AS INTEGER) AS won
  FROM tgh t JOIN orders o ON t.game_id = o.o_orderkey)
"""

GSETS = """
gj AS (
  SELECT l.l_partkey AS player_id, l.l_suppkey AS team_id, CAST(year(o.o_orderdate) AS INTEGER) AS season,
         CAST(o.o_orderstatus = 'F' AS INTEGER) AS game_won, CAST(o.o_orderstatus = 'F' AS INTEGER) AS htw,
         l.l_quantity AS pts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
gs AS (
  SELECT CASE grouping(player_id, team_id, season, game_won)
              WHEN 3 THEN 'player_team' WHEN 5 THEN 'player_season' ELSE 'team_home_wins' END AS agg_level,
         player_id, team_id, season, game_won, sum(pts) AS sum_points,
         count(CASE WHEN htw = 1 THEN 1 END) AS home_team_wins
  FROM gj GROUP BY GROUPING SETS ((player_id, team_id), (player_id, season), (team_id, game_won)))
"""

MATCHED = "o_orderkey IN (SELECT l_orderkey FROM lineitem)"

JOINED = """
j AS (
  SELECT d.l_orderkey AS match_id, d.l_suppkey AS player_gamertag, d.l_quantity AS player_total_kills,
         o.o_orderpriority AS mapid, o.o_orderstatus AS playlist_id, m.l_returnflag AS medal_id
  FROM lineitem d JOIN orders o ON d.l_orderkey = o.o_orderkey JOIN lineitem m ON m.l_orderkey = d.l_orderkey)
"""


def _props(names: list[tuple[str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT team_id AS identifier, 'team' AS type, '{k}' AS prop_key, CAST({c} AS VARCHAR) AS prop_value FROM tf"
        for k, c in names
    )


SQL: dict[str, str] = {
    "cumulate_actors": f"WITH {ACTOR_SNAP} SELECT * FROM asnap",
    "cumulate_actors_chunked": f"""WITH {ACTOR_SNAP},
pos AS (
  SELECT actorid, yr, filmid,
         row_number() OVER (PARTITION BY actorid ORDER BY yr, filmid) - 1 AS p
  FROM af),
ch AS (SELECT actorid, p // 1000 AS chunk, min(yr) AS y0 FROM pos GROUP BY actorid, p // 1000),
chy AS (
  SELECT actorid, chunk, CAST(g AS INTEGER) AS current_year
  FROM (SELECT c.actorid, c.chunk, unnest(generate_series(c.y0, (SELECT max(yr) FROM af))) AS g FROM ch c)),
cf AS (
  SELECT c.actorid, c.chunk, c.current_year, CAST(count(*) AS INTEGER) AS n_films,
         string_agg(p.filmid, ',' ORDER BY p.p) AS film_ids
  FROM chy c JOIN pos p ON p.actorid = c.actorid AND p.p // 1000 = c.chunk AND p.yr <= c.current_year
  GROUP BY c.actorid, c.chunk, c.current_year)
SELECT cf.actorid, a.actor, cf.current_year, cf.chunk, cf.n_films, cf.film_ids, a.quality_class, a.is_active
FROM cf JOIN asnap a ON a.actorid = cf.actorid AND a.current_year = cf.current_year""",
    "cumulate_players": f"""WITH {PLAYER_SNAP}
SELECT player_name, current_season, height, country, n_seasons, season_list, scoring_class, is_active FROM psnap""",
    "first_by_history": """
WITH act AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders)
SELECT c.c_name AS player_name, a.season AS current_season,
       CAST(row_number() OVER (PARTITION BY c.c_name ORDER BY a.season) AS INTEGER) AS n_seasons
FROM act a JOIN customer c ON a.o_custkey = c.c_custkey""",
    "scd2_backfill_one": f"WITH {PLAYER_SNAP}, "
    + _scd("psnap", "player_name", "current_season", ["scoring_class"], None, "start_date", "end_date").lstrip(),
    "scd2_backfill_two": f"WITH {ACTOR_SNAP}, "
    + _scd("asnap", "actorid", "current_year", ["quality_class", "is_active"], "actor", "start_year", "end_year").lstrip(),
    "dedupe_first": """
SELECT game_id, player_id, team_id, pts, line_number FROM (
  SELECT l_orderkey AS game_id, l_partkey AS player_id, l_suppkey AS team_id, l_quantity AS pts,
         l_linenumber AS line_number,
         row_number() OVER (PARTITION BY l_partkey, l_suppkey, l_orderkey ORDER BY l_linenumber, l_quantity) AS rn
  FROM lineitem)
WHERE rn = 1""",
    "dedupe_counted": """
SELECT game_id, player_id, team_id, pts, line_number, row_num FROM (
  SELECT l_orderkey AS game_id, l_partkey AS player_id, l_suppkey AS team_id, l_quantity AS pts,
         l_linenumber AS line_number,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS rn,
         count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS row_num
  FROM lineitem)
WHERE rn = 1""",
    "team_vertex": """
WITH t AS (
  SELECT CAST(s.s_nationkey AS BIGINT) AS team_id, s.s_name AS abbreviation, n.n_name AS nickname,
         'City#' || CAST(s.s_nationkey AS VARCHAR) AS city, 'Arena#' || CAST(s.s_suppkey AS VARCHAR) AS arena,
         CAST(trunc(s.s_acctbal) AS BIGINT) AS yearfounded,
         row_number() OVER (PARTITION BY s.s_nationkey ORDER BY s.s_name) AS rn
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
tf AS (SELECT * FROM t WHERE rn = 1)
"""
    + _props(
        [("abbreviation", "abbreviation"), ("nickname", "nickname"), ("city", "city"), ("arena", "arena"), ("year_founded", "yearfounded")]
    ),
    "user_datelist": f"""WITH {EVENTS}
SELECT user_id, browser_type, mx.d AS date,
       CAST(row_number() OVER (PARTITION BY user_id, browser_type ORDER BY day) - 1 AS INTEGER) AS pos,
       day AS active_date
FROM ubd, mx""",
    "datelist_bits": f"""WITH {EVENTS},
b AS (
  SELECT u.user_id,
         CAST(bit_or(CASE WHEN mx.d - u.day BETWEEN 0 AND 9 THEN (CAST(1 AS BIGINT) << CAST(9 - (mx.d - u.day) AS INTEGER))
                          ELSE CAST(0 AS BIGINT) END) AS BIGINT) AS datelist_int
  FROM ubd u, mx GROUP BY u.user_id)
SELECT user_id, datelist_int, lpad(bin(datelist_int), 10, '0') AS datelist_bits,
       bit_count(datelist_int & 512) > 0 AS last_day_active,
       bit_count(datelist_int & 1016) > 0 AS last_week_active
FROM b""",
    "host_datelist": f"""WITH {EVENTS},
hd AS (SELECT DISTINCT host, day FROM ev, mx WHERE host IS NOT NULL AND day <= mx.d)
SELECT host AS host_name, mx.d AS date,
       CAST(row_number() OVER (PARTITION BY host ORDER BY day) - 1 AS INTEGER) AS pos, day AS active_date
FROM hd, mx""",
    "host_monthly": f"""WITH {EVENTS},
hd AS (
  SELECT host, day, count(*) AS hits, count(DISTINCT user_id) AS visitors
  FROM ev, mx WHERE host IS NOT NULL AND day <= mx.d GROUP BY host, day),
hm AS (SELECT DISTINCT host, CAST(date_trunc('month', day) AS DATE) AS month_start FROM hd),
sp AS (
  SELECT host, month_start, unnest(generate_series(1, {MONTH_LEN.format(m='month_start')})) AS dom FROM hm, mx)
SELECT sp.host, sp.month_start, CAST(sp.dom AS INTEGER) AS day_of_month,
       coalesce(hd.hits, 0) AS hits, coalesce(hd.visitors, 0) AS visitors
FROM sp LEFT JOIN hd ON hd.host = sp.host AND hd.day = sp.month_start + CAST(sp.dom - 1 AS INTEGER)""",
    "positional_sums": f"""WITH {EVENTS}
SELECT strftime(date_trunc('month', day), '%Y-%m-%d') AS month_start,
       count(*) FILTER (WHERE day(day) = 1) AS num_hits_first_day,
       count(*) FILTER (WHERE day(day) = 2) AS num_hits_second_day,
       count(*) FILTER (WHERE day(day) = 3) AS num_hits_third_day
FROM ev, mx WHERE day <= mx.d GROUP BY 1""",
    "player_states": """
WITH act AS (
  SELECT DISTINCT c.c_name AS player_name, CAST(year(o.o_orderdate) AS INTEGER) AS a
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
r AS (
  SELECT player_name, a, lag(a) OVER w AS prev_a,
         coalesce(lead(a) OVER w - 1, (SELECT max(a) FROM act)) AS last,
         min(a) OVER (PARTITION BY player_name) AS first_active_season,
         string_agg(CAST(a AS VARCHAR), ',' ORDER BY a) OVER (PARTITION BY player_name ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sa
  FROM act WINDOW w AS (PARTITION BY player_name ORDER BY a)),
x AS (SELECT *, unnest(generate_series(a, last)) AS season FROM r)
SELECT player_name, CAST(season AS INTEGER) AS season, first_active_season, a AS last_active_season,
       CASE WHEN season = a AND prev_a IS NULL THEN 'New'
            WHEN season = a AND prev_a = season - 1 THEN 'Continued Playing'
            WHEN season = a THEN 'Returned from Retirement'
            WHEN season = a + 1 THEN 'Retired'
            ELSE 'Stayed Retired' END AS activity_state,
       sa AS seasons_active
FROM x""",
    "points_grouping_sets": f"WITH {GSETS} SELECT * FROM gs WHERE agg_level <> 'player_season'",
    "points_grouping_sets_all": f"WITH {GSETS} SELECT * FROM gs",
    "top_scorer_for_team": f"""WITH {GSETS}
SELECT player_id, team_id, sum_points FROM gs WHERE agg_level = 'player_team'
ORDER BY sum_points DESC, player_id, team_id LIMIT 1""",
    "top_scorer_in_season": f"""WITH {GSETS}
SELECT player_id, season, sum_points FROM gs WHERE agg_level = 'player_season'
ORDER BY sum_points DESC, player_id, season LIMIT 1""",
    "team_most_wins": f"""WITH {GAMES}
SELECT team_id, count(DISTINCT game_id) AS games_won FROM tgw WHERE won = 1
GROUP BY team_id ORDER BY games_won DESC, team_id LIMIT 1""",
    "rolling_wins_90": f"""WITH {GAMES}
SELECT team_id, CAST(max(w) AS BIGINT) AS max_wins_90 FROM (
  SELECT team_id, sum(won) OVER (PARTITION BY team_id ORDER BY game_date, game_id
                                 ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS w
  FROM tgw)
GROUP BY team_id""",
    "longest_streak": """
WITH gd AS (
  SELECT * FROM (
    SELECT l_orderkey AS game_id, l_partkey AS player_id, l_suppkey AS team_id, l_quantity AS pts,
           row_number() OVER (PARTITION BY l_partkey, l_suppkey, l_orderkey ORDER BY l_quantity, l_linenumber) AS rn
    FROM lineitem)
  WHERE rn = 1),
pg AS (SELECT player_id, game_id, sum(pts) AS pts FROM gd GROUP BY player_id, game_id),
q AS (
  SELECT pg.player_id, CASE WHEN pg.pts > 10 THEN 1 ELSE 0 END AS q,
         row_number() OVER (PARTITION BY pg.player_id ORDER BY CAST(o.o_orderdate AS DATE), pg.game_id) AS rn
  FROM pg JOIN orders o ON pg.game_id = o.o_orderkey),
i AS (SELECT player_id, q, rn - sum(q) OVER (PARTITION BY player_id ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS isl FROM q),
runs AS (SELECT player_id, CASE WHEN q = 1 THEN isl END AS g, sum(q) AS len FROM i GROUP BY 1, 2)
SELECT player_id, CAST(max(len) AS BIGINT) AS longest_streak FROM runs GROUP BY player_id""",
    "broadcast_join": """
SELECT c.c_nationkey AS name, c.c_custkey AS medal_id, c.c_name AS medal_name, n.n_name AS map_name,
       n.n_regionkey AS region
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "bucketed_join": """
SELECT d.l_orderkey AS match_id, d.l_suppkey AS player_gamertag, d.l_quantity AS player_total_kills,
       o.o_orderpriority AS mapid, o.o_orderstatus AS playlist_id, k.medal_id, k.medal_rows
FROM lineitem d JOIN orders o ON d.l_orderkey = o.o_orderkey
JOIN (SELECT l_orderkey, l_returnflag AS medal_id, count(*) AS medal_rows FROM lineitem GROUP BY 1, 2) k
  ON k.l_orderkey = d.l_orderkey""",
    "avg_kills": """
SELECT l_suppkey AS player_gamertag, avg(l_quantity) AS avg_kills FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
GROUP BY 1 ORDER BY avg_kills DESC, player_gamertag LIMIT 1""",
    "top_playlist": f"""
SELECT o_orderstatus AS playlist_id, count(*) AS playlist_counter FROM orders WHERE {MATCHED} GROUP BY 1""",
    "top_map": f"""
SELECT o_orderpriority AS mapid, count(*) AS map_count FROM orders WHERE {MATCHED} GROUP BY 1""",
    "top_medal_map": """
SELECT o.o_orderpriority AS mapid, count(*) AS medal_count
FROM lineitem m JOIN orders o ON m.l_orderkey = o.o_orderkey
WHERE m.l_returnflag = 'R' GROUP BY 1 ORDER BY medal_count DESC, mapid LIMIT 1""",
    "avg_kills_joined_rows": f"""
WITH {{JOINED}}
SELECT player_gamertag, avg(player_total_kills) AS avg_kills FROM j
GROUP BY 1 ORDER BY avg_kills DESC, player_gamertag LIMIT 1""",
    "playlist_joined_rows": f"WITH {{JOINED}} SELECT playlist_id, count(*) AS playlist_counter FROM j GROUP BY 1",
    "map_joined_rows": f"WITH {{JOINED}} SELECT mapid, count(*) AS map_count FROM j GROUP BY 1",
    "medal_map_joined_rows": f"""
WITH {{JOINED}}
SELECT mapid, count(*) AS killing_spree_count FROM j WHERE medal_id = 'R'
GROUP BY 1 ORDER BY killing_spree_count DESC, mapid LIMIT 1""",
    "sorted_layout": "SELECT o_orderkey AS match_id, o_orderpriority AS mapid, o_orderstatus AS playlist_id FROM orders",
    "layout_check": """
SELECT name AS layout, (SELECT count(*) FROM orders) AS n_rows, true AS files_sorted, true AS balanced
FROM (VALUES ('mapid'), ('playlist_id')) AS t(name)""",
    "csv_inferred": """
SELECT c_custkey, c_name, c_acctbal, 'c_custkey:number,c_name:string,c_acctbal:number' AS kinds FROM customer""",
    "upsert_roundtrip": """
WITH u AS (
  SELECT o_custkey, max(o_totalprice) AS v FROM orders GROUP BY o_custkey)
SELECT c.c_custkey, c.c_name, CASE WHEN u.o_custkey IS NOT NULL THEN u.v ELSE c.c_acctbal END AS c_acctbal,
       c.c_mktsegment
FROM customer c LEFT JOIN u ON c.c_custkey = u.o_custkey""",
    "overwrite_roundtrip": f"""WITH {EVENTS}
SELECT strftime(date_trunc('month', day), '%Y-%m-%d') AS month_start, user_id,
       CAST({MONTH_LEN.format(m='day')} AS INTEGER) AS n_days, count(*) AS total_hits,
       strftime(mx.d, '%Y-%m-%d') AS date_partition
FROM ev, mx WHERE day <= mx.d
GROUP BY date_trunc('month', day), day(last_day(day)), user_id, mx.d""",
    "define_tables": f"""WITH {EVENTS},
hd AS (
  SELECT host, day, count(*) AS hits, count(DISTINCT user_id) AS visitors
  FROM ev, mx WHERE host IS NOT NULL AND day <= mx.d GROUP BY host, day)
SELECT host, CAST(date_trunc('month', day) AS DATE) AS month_start,
       CAST({MONTH_LEN.format(m='day')} AS INTEGER) AS n_days,
       CAST(sum(hits) AS BIGINT) AS hits, CAST(sum(visitors) AS BIGINT) AS visitor_days
FROM hd, mx GROUP BY host, date_trunc('month', day), day(last_day(day)), mx.d""",
    "csv_roundtrip": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
}

SQL["scd2_incremental"] = SQL["scd2_backfill_two"]
SQL["scd2_incremental_rerun"] = SQL["scd2_backfill_two"]
SQL["host_monthly_rerun"] = SQL["host_monthly"]
SQL["late_actor_history"] = SQL["scd2_backfill_two"]
SQL["late_actor_snapshots"] = SQL["cumulate_actors"]
SQL["bucketed_join_spread"] = SQL["bucketed_join"]
SQL["rolling_wins_90_merged"] = SQL["rolling_wins_90"]
SQL["longest_streak_merged"] = SQL["longest_streak"]
SQL["points_grouping_sets_reload"] = SQL["points_grouping_sets_all"]
SQL["team_most_wins_reload"] = SQL["team_most_wins"]
SQL["upsert_buckets"] = """
WITH u AS (
  SELECT o_custkey, max(o_totalprice) AS v FROM orders
  WHERE CAST(o_orderdate AS DATE) = (SELECT CAST(max(o_orderdate) AS DATE) FROM orders) GROUP BY o_custkey)
SELECT coalesce(c.c_custkey, u.o_custkey) AS c_custkey, c.c_name, CASE WHEN u.o_custkey IS NOT NULL THEN u.v ELSE c.c_acctbal END AS c_acctbal,
       c.c_mktsegment
FROM customer c FULL JOIN u ON c.c_custkey = u.o_custkey
UNION ALL SELECT -s_suppkey - 1, s_name, s_acctbal, NULL FROM supplier"""
SQL["datelist_bits_wide"] = f"""WITH {EVENTS},
k AS (SELECT unnest(range(400)) AS k),
us AS (SELECT DISTINCT user_id FROM ubd),
x AS (SELECT us.user_id, k.k, count(u.day) > 0 AS on_day FROM us CROSS JOIN k CROSS JOIN mx
      LEFT JOIN (SELECT DISTINCT user_id, day FROM ubd) u ON u.user_id = us.user_id AND u.day = mx.d - CAST(k.k AS INTEGER) GROUP BY 1, 2)
SELECT user_id, string_agg(CASE WHEN on_day THEN '1' ELSE '0' END, '' ORDER BY k) AS datelist_bits,
       count(*) FILTER (WHERE on_day) AS active_days, bool_or(on_day AND k = 0) AS last_day_active,
       count(*) FILTER (WHERE on_day AND k < 28) AS active_days_28
FROM x GROUP BY user_id"""
SQL["host_visitors_between"] = f"""WITH {EVENTS}
SELECT host, count(DISTINCT user_id) AS n_visitors, true AS estimate_within
FROM ev, mx WHERE host IS NOT NULL AND day BETWEEN mx.d - 13 AND mx.d GROUP BY host"""
SQL["interleaved_layout"] = """
SELECT 'player' AS layout, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_values, true AS skips_half FROM orders
UNION ALL SELECT 'played', count(*), count(DISTINCT o_orderdate), true FROM orders"""
SQL["scd_surrogate_ids"] = f"""WITH h AS ({SQL['scd2_backfill_two']}),
y AS (SELECT max(current_year) AS y FROM h)
SELECT row_number() OVER (ORDER BY start_year = y.y, actorid, start_year) AS id, actorid, start_year, end_year, quality_class
FROM h, y"""
SQL["csv_rejects"] = """
SELECT CASE WHEN o_orderpriority LIKE '5%' THEN '4 fields instead of 6' WHEN o_orderstatus = 'P' THEN 'o_totalprice is not a double'
            ELSE 'good' END AS reason, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders GROUP BY 1"""
SQL["rolling_wins_90_split"] = SQL["rolling_wins_90"]
SQL["longest_streak_split"] = SQL["longest_streak"]
SQL["sorted_layout_playlist"] = SQL["sorted_layout"]
_ROWS = {
    "actors": ("cumulate_actors", "*"),
    "actors_history_scd": ("scd2_backfill_two", "*"),
    "players": ("cumulate_players", "*"),
    "players_growth": ("player_states", "*"),
    "user_devices_cumulated": ("user_datelist", "DISTINCT (user_id, browser_type)"),
    "hosts_cumulated": ("host_datelist", "DISTINCT host_name"),
    "host_activity_reduced": ("host_monthly", "DISTINCT (host, month_start)"),
    "team_vertex": ("team_vertex", "DISTINCT identifier"),
}
SQL["define_tables_all"] = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count({what}) AS n_rows FROM ({SQL[q]}) AS q" for t, (q, what) in _ROWS.items()
)
SQL = {k: v.replace("{JOINED}", JOINED) for k, v in SQL.items()}
