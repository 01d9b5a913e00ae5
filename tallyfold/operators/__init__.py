"""Table-to-table operators.  Each takes DataFrames and returns a DataFrame.

| id | operator | function |
| --- | --- | --- |
| O1 | yearly actor snapshots | cumulate.cumulate_actors / actors_backfill (chunked: cumulate_actors_chunked / actors_backfill_chunked) |
| O2 | seasonal player snapshots | cumulate.cumulate_players / players_backfill |
| O4 | SCD type 2 backfill | scd.scd2_backfill |
| O5 | SCD type 2 increment | scd.scd2_incremental |
| O6 | first row per key | dedupe.dedupe |
| O7 | one row per key with its count | dedupe.dedupe_counted |
| O8 | user x browser date lists | cumulate.cumulate_user_devices / user_devices_backfill |
| O9 | date list to bits | activity.datelist_to_bits |
| O10 | host date lists | cumulate.cumulate_hosts / hosts_backfill |
| O11 | monthly reduced facts | activity.reduce_monthly / reduce_monthly_backfill |
| O12 | positional array sums | activity.positional_sums |
| O13 | lifecycle states | activity.track_states / states_backfill |
| O14 | earliest season per history | cumulate.first_by_history |
| O15-O18 | grouping sets, top questions, rolling wins, streaks | patterns.* |
| O19 | graph vertices | graph.team_vertex / vertices |
| O20, O22-O27 | broadcast and bucketed joins, match questions, layouts | matches.* |
| O28 | upsert | merge.upsert |

O3 (bands) lives in ``tallyfold.functions``; O21, O29-O31 (writers, DDL,
CSV) in ``tallyfold.sources`` and ``tallyfold.schemas``.
"""
