"""DuckDB oracles for the registered queries.

Written independently of the Spark operators and by brute force where that is
clearer: a full partitions x polls grid for the mark, an inequality join for
release polls, a recursive CTE for capped release counts.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from . import catalog as K

MAXL = (1 << 63) - 1


@dataclass(frozen=True)
class AllTopics:
    """One policy for every topic that the table has."""

    policy: str
    time_ms: int | None = None
    timezone: str | None = None


def _start_of_day_ms(as_of_ms: int, time_ms: int, tz: str) -> int:
    local = datetime.fromtimestamp(as_of_ms / 1000, tz=timezone.utc).astimezone(ZoneInfo(tz))
    midnight = local.replace(hour=0, minute=0, second=0, microsecond=0)
    return int(midnight.timestamp() * 1000) + time_ms


def _target(t) -> str | None:
    if t.policy == "absolute_time":
        return str(t.time_ms)
    if t.policy == "relative_time":
        return str(K.AS_OF_MS - t.time_ms)
    if t.policy == "start_of_day":
        return str(_start_of_day_ms(K.AS_OF_MS, t.time_ms, t.timezone))
    return None


def log_ctes(variant: str = "base") -> str:
    ts = "epoch_us(events.ts) // 1000"
    val = "events.props"
    scale = K.FINE_SCALE if variant in ("fine", "steady") else 1
    if variant in ("jitter", "fine"):
        ts = f"CASE WHEN events.value >= 100 THEN {ts} - {K.JITTER_MS} ELSE {ts} END"
    elif variant == "untimestamped":
        ts = f"CASE WHEN events.value < 1.0 THEN NULL ELSE {ts} END"
    elif variant == "tombstone":
        val = "CASE WHEN events.value >= 200 THEN NULL ELSE events.props END"
    return f"""
base AS (
  SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id,
         CAST({ts} AS BIGINT) AS timestamp_ms, CAST(user_id AS VARCHAR) AS key, {val} AS value
  FROM events),
log AS (
  SELECT topic, "partition",
         CAST(row_number() OVER (PARTITION BY topic, "partition" ORDER BY event_id) - 1 AS BIGINT) AS "offset",
         timestamp_ms, key, value
  FROM base),
log_e AS (
  SELECT *, CAST("offset" * {scale} // (10 * ("partition" + 1)) AS BIGINT) AS arrival_epoch FROM log)"""


def ranges_cte(topics) -> str:
    if isinstance(topics, AllTopics):
        return _ranges_sql("topic IS NOT NULL", _target(topics) or "NULL", f"'{topics.policy}'")
    names = ", ".join(f"'{t.name}'" for t in topics)
    tgt = " ".join(f"WHEN '{t.name}' THEN {_target(t)}" for t in topics if _target(t) is not None)
    tgt = f"CASE topic {tgt} END" if tgt else "NULL"
    pol = " ".join(f"WHEN '{t.name}' THEN '{t.policy}'" for t in topics)
    return _ranges_sql(f"topic IN ({names})", tgt, f"CASE topic {pol} END")


def _ranges_sql(wanted: str, tgt: str, pol: str) -> str:
    return f"""
wm AS (
  SELECT topic, "partition", min("offset") AS lo, max("offset") + 1 AS hi,
         min("offset") FILTER (WHERE timestamp_ms >= {tgt}) AS at_time
  FROM log WHERE {wanted} GROUP BY topic, "partition"),
ranges AS (
  SELECT topic, "partition",
         CAST(CASE {pol} WHEN 'earliest' THEN lo WHEN 'latest' THEN hi
              ELSE coalesce(at_time, hi) END AS BIGINT) AS replay_start_offset,
         CAST(hi AS BIGINT) AS replay_end_offset
  FROM wm)"""


REPLAY_CTES = f"""
sl AS (
  SELECT l.*, r.replay_start_offset, r.replay_end_offset
  FROM log_e l JOIN ranges r USING (topic, "partition")
  WHERE l."offset" >= r.replay_start_offset AND l."offset" < r.replay_end_offset),
msgs AS (SELECT * FROM sl WHERE timestamp_ms IS NOT NULL),
ev AS (
  SELECT topic, "partition", arrival_epoch AS epoch, max("offset") AS last_offset,
         arg_max(timestamp_ms, "offset") AS last_ts
  FROM msgs GROUP BY topic, "partition", arrival_epoch),
ev2 AS (
  SELECT ev.*, ev.last_offset + 1 >= r.replay_end_offset AS caught
  FROM ev JOIN ranges r USING (topic, "partition")),
epochs AS (
  SELECT CAST(unnest(generate_series(0, e_end)) AS BIGINT) AS epoch
  FROM (SELECT coalesce(max(arrival_epoch), -1) AS e_end FROM msgs)),
grid AS (
  SELECT e.epoch, v.topic, v."partition", v.last_ts, v.caught
  FROM epochs e JOIN ev2 v ON v.epoch <= e.epoch
  QUALIFY row_number() OVER (PARTITION BY e.epoch, v.topic, v."partition" ORDER BY v.epoch DESC) = 1),
np AS (
  SELECT count(*) AS partitions,
         count(*) FILTER (WHERE replay_start_offset >= replay_end_offset) AS empty_parts
  FROM ranges),
lw AS (
  SELECT epoch, min(last_ts) FILTER (WHERE NOT caught) AS low_water_mark,
         count(*) FILTER (WHERE caught) AS n_caught
  FROM grid GROUP BY epoch),
limits AS (
  SELECT e.epoch, lw.low_water_mark,
         (np.partitions > 0 AND coalesce(lw.n_caught, 0) + np.empty_parts = np.partitions) AS all_caught_up
  FROM epochs e LEFT JOIN lw USING (epoch) CROSS JOIN np),
limits2 AS (
  SELECT *, CAST(CASE WHEN all_caught_up THEN {MAXL}
                      ELSE coalesce(low_water_mark, {MAXL}) END AS BIGINT) AS release_limit
  FROM limits),
rel AS (
  SELECT m.*, (SELECT min(l.epoch) FROM limits2 l
               WHERE l.epoch >= m.arrival_epoch AND l.release_limit >= m.timestamp_ms) AS release_epoch
  FROM msgs m),
pe AS (
  SELECT e.epoch, r.topic, r."partition", r.replay_start_offset, r.replay_end_offset
  FROM epochs e CROSS JOIN ranges r),
cons AS (
  SELECT pe.epoch, pe.topic, pe."partition", max(m."offset") AS co
  FROM pe JOIN msgs m ON m.topic = pe.topic AND m."partition" = pe."partition" AND m.arrival_epoch <= pe.epoch
  GROUP BY pe.epoch, pe.topic, pe."partition"),
relp AS (
  SELECT pe.epoch, pe.topic, pe."partition", x."offset" AS ro
  FROM pe JOIN rel x ON x.topic = pe.topic AND x."partition" = pe."partition" AND x.release_epoch <= pe.epoch
  QUALIFY row_number() OVER (PARTITION BY pe.epoch, pe.topic, pe."partition"
      ORDER BY x.release_epoch DESC, x.timestamp_ms DESC, x.arrival_epoch DESC, x."offset" DESC) = 1),
st AS (
  SELECT pe.*, coalesce(c.co, pe.replay_start_offset) AS consumed_offset,
         coalesce(p.ro, pe.replay_start_offset) AS released_offset,
         CASE WHEN p.ro IS NULL THEN pe.replay_start_offset >= pe.replay_end_offset
              ELSE p.ro + 1 >= pe.replay_end_offset END AS is_live
  FROM pe LEFT JOIN cons c USING (epoch, topic, "partition") LEFT JOIN relp p USING (epoch, topic, "partition")),
prog AS (
  SELECT epoch, CAST(sum(consumed_offset) - sum(released_offset) AS BIGINT) AS pending,
         count(*) > 0 AND bool_and(is_live) AS is_live
  FROM st GROUP BY epoch),
met AS (
  SELECT e.epoch,
         (SELECT count(*) FROM rel WHERE arrival_epoch = e.epoch) AS consumed,
         (SELECT count(*) FROM rel WHERE release_epoch = e.epoch) AS released,
         (SELECT count(*) FROM rel WHERE arrival_epoch <= e.epoch)
           - (SELECT count(*) FROM rel WHERE release_epoch <= e.epoch) AS held
  FROM epochs e)"""


def _with(variant: str, topics, body: str, replay: bool = True, recursive: bool = False) -> str:
    parts = [log_ctes(variant)]
    if topics is not None:
        parts.append(ranges_cte(topics))
        if replay:
            parts.append(REPLAY_CTES)
    head = "WITH RECURSIVE" if recursive else "WITH"
    return f"{head} {','.join(parts)}\n{body}"


EARLIEST = AllTopics("earliest")
MID = "(SELECT max(epoch) // 2 FROM epochs)"
B = K.BATCH_SIZE
SLICE = 'topic, "partition", "offset", timestamp_ms'


def _offsets(topics) -> str:
    return _with("base", topics, "SELECT topic, \"partition\", replay_start_offset, replay_end_offset FROM ranges",
                 replay=False)


def _release_view(variant, topics) -> str:
    return _with(variant, topics, f"""
SELECT {SLICE}, arrival_epoch, release_epoch,
       CAST(row_number() OVER (ORDER BY release_epoch, timestamp_ms, arrival_epoch, topic, "partition", "offset") - 1
            AS BIGINT) AS release_position
FROM rel WHERE release_epoch IS NOT NULL""")


_PACED = f""",
m AS (
  SELECT *, row_number() OVER (ORDER BY timestamp_ms, arrival_epoch, topic, "partition", "offset") AS id FROM msgs),
stop AS (SELECT max(arrival_epoch) AS e_end, max(arrival_epoch) + CAST(ceil(count(*) / {B}.0) AS BIGINT) AS last FROM msgs),
run(id, e) USING KEY (id) AS (
  SELECT CAST(0 AS BIGINT), CAST(-1 AS BIGINT)  -- id 0 is the clock
  UNION
  SELECT id, e FROM (
    SELECT id, e FROM (
      SELECT m.id, t.p AS e, row_number() OVER (ORDER BY m.id) AS place
      FROM (SELECT run.e + 1 AS p FROM run, stop WHERE run.id = 0 AND run.e < stop.last) t CROSS JOIN stop
      JOIN limits2 l ON l.epoch = least(t.p, stop.e_end)
      JOIN m ON m.arrival_epoch <= t.p AND m.timestamp_ms <= l.release_limit
      WHERE NOT EXISTS (SELECT 1 FROM recurring.run r WHERE r.id = m.id))
    WHERE place <= {B}
    UNION ALL
    SELECT run.id, run.e + 1 FROM run, stop WHERE run.id = 0 AND run.e < stop.last)),
paced AS (SELECT m.*, run.e AS release_epoch FROM m JOIN run ON run.id = m.id)"""

_HELD = f"""
held AS (SELECT * FROM rel WHERE arrival_epoch <= {MID} AND (release_epoch IS NULL OR release_epoch >= {MID})),
lim AS (SELECT coalesce((SELECT release_limit FROM limits2 WHERE epoch = {MID}), -1) AS l),
batch AS (
  SELECT *, CAST(row_number() OVER (ORDER BY timestamp_ms, arrival_epoch, topic, "partition", "offset") - 1 AS BIGINT)
            AS batch_position
  FROM held WHERE timestamp_ms <= (SELECT l FROM lim)
  ORDER BY timestamp_ms, arrival_epoch, topic, "partition", "offset" LIMIT {B})"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["message_log"] = _with("base", None, f"SELECT {SLICE}, key, value, arrival_epoch FROM log_e")
    q["offsets_earliest"] = _offsets(EARLIEST)
    q["offsets_latest"] = _offsets(AllTopics("latest"))
    q["offsets_relative_time"] = _offsets(AllTopics("relative_time", K.RELATIVE_MS))
    q["offsets_absolute_time"] = _offsets(AllTopics("absolute_time", K.ABSOLUTE_MS))
    q["offsets_start_of_day"] = _offsets(AllTopics("start_of_day", K.DAY_TIME_MS, K.DAY_TZ))
    q["offsets_mixed"] = _offsets(K.MIXED)
    q["partition_watermarks"] = _with("base", None, """
SELECT topic, "partition", min("offset") AS low_watermark, max("offset") + 1 AS high_watermark,
       count(*) AS messages
FROM log GROUP BY topic, "partition\"""")
    q["replay_slice"] = _with("base", K.MIXED,
                              f"SELECT {SLICE}, key, value, arrival_epoch, replay_start_offset, replay_end_offset FROM sl")
    names = ", ".join(f"('{t.name}')" for t in K.MIXED + K.ABSENT)
    q["missing_topics"] = _with("base", None, f"""
SELECT topic FROM (VALUES {names}) AS w(topic)
WHERE topic NOT IN (SELECT DISTINCT topic FROM log)""")
    q["drop_untimestamped"] = _with("untimestamped", None,
                                    f"SELECT {SLICE}, key, value FROM log WHERE timestamp_ms IS NOT NULL")
    q["tombstones"] = _with("tombstone", None, """
SELECT topic, "partition", count(*) AS messages, count(*) FILTER (WHERE value IS NULL) AS tombstones
FROM log GROUP BY topic, "partition\"""")
    q["filter_topic"] = _with("base", None, f"SELECT {SLICE}, key, value FROM log WHERE topic = 'click'")
    q["decode_value"] = _with("base", None, 'SELECT topic, "partition", "offset", value AS value_text FROM log')
    q["consumption_state"] = _with("base", EARLIEST, f"""
SELECT r.topic, r."partition", r.replay_start_offset, r.replay_end_offset,
       coalesce(a.co, r.replay_start_offset) AS consumed_offset, a.ts AS last_consumed_timestamp_ms,
       CASE WHEN a.co IS NULL THEN r.replay_start_offset >= r.replay_end_offset
            ELSE a.co + 1 >= r.replay_end_offset END AS is_caught_up
FROM ranges r LEFT JOIN (
  SELECT topic, "partition", max("offset") AS co, arg_max(timestamp_ms, "offset") AS ts
  FROM msgs WHERE arrival_epoch <= {MID} GROUP BY topic, "partition") a USING (topic, "partition")""")
    q["low_water_mark"] = _with("base", EARLIEST, "SELECT epoch, low_water_mark FROM limits2")
    q["release_limits"] = _with("base", EARLIEST,
                                "SELECT epoch, low_water_mark, all_caught_up, release_limit FROM limits2")
    q["replay_progress"] = _with("base", EARLIEST, """
SELECT l.epoch, l.all_caught_up, p.is_live,
       CASE WHEN NOT p.is_live THEN l.low_water_mark END AS priming_watermark, p.pending
FROM limits2 l JOIN prog p USING (epoch)""")
    q["held_counts"] = _with("base", EARLIEST, "SELECT epoch, CAST(held AS BIGINT) AS held FROM met")
    q["epoch_metrics"] = _with("base", EARLIEST, """
SELECT epoch, CAST(consumed AS BIGINT) AS consumed, CAST(released AS BIGINT) AS released,
       CAST(held AS BIGINT) AS held, CAST(0 AS BIGINT) AS partitions_paused,
       CAST(0 AS BIGINT) AS partitions_resumed
FROM met""")
    q["flow_report"] = _with("base", EARLIEST, f"""
SELECT l.epoch, CAST(m.held AS BIGINT) AS held,
       CAST((SELECT count(*) FROM grid g WHERE g.epoch = l.epoch AND g.last_ts > l.low_water_mark) AS BIGINT)
         AS partitions_ahead,
       (m.held + m.released < {B} OR np.partitions = 0 OR l.all_caught_up) AS should_resume,
       m.held + m.released > {5 * B} AS over_buffer, CAST(0 AS BIGINT) AS paused_partitions
FROM limits2 l JOIN met m USING (epoch) CROSS JOIN np""")
    q["ordered_replay"] = _with("base", EARLIEST, f"""
SELECT {SLICE}, CAST(row_number() OVER (ORDER BY timestamp_ms, topic, "partition", "offset") - 1 AS BIGINT)
       AS position
FROM msgs""", replay=True)
    q["ordered_replay_untimestamped"] = _with("untimestamped", EARLIEST, f"""
SELECT {SLICE}, CAST(row_number() OVER (ORDER BY timestamp_ms, topic, "partition", "offset") - 1 AS BIGINT)
       AS position
FROM msgs""", replay=True)
    q["replay_batches"] = _with("base", K.MIXED, f"""
SELECT {SLICE}, position, CAST(position // {B} AS BIGINT) AS batch_id FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY timestamp_ms, topic, "partition", "offset") - 1 AS BIGINT) AS position
  FROM msgs)""")
    q["release_epochs"] = _release_view("base", EARLIEST)
    q["release_epochs_mixed"] = _release_view("base", K.MIXED)
    q["release_epochs_jitter"] = _release_view("jitter", EARLIEST)
    q["release_epochs_fine"] = _release_view("fine", EARLIEST)
    q["release_batch"] = _with("base", EARLIEST, f""",{_HELD}
SELECT {SLICE}, arrival_epoch, batch_position FROM batch""")
    q["held_messages"] = _with("base", EARLIEST, f""",{_HELD}
SELECT {SLICE}, arrival_epoch FROM held h
WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.topic = h.topic AND b."partition" = h."partition"
                  AND b."offset" = h."offset")""")
    totals = f""",
tot AS (SELECT count(*) AS n, coalesce(max(arrival_epoch), -1) AS e_end FROM msgs),
dep AS (SELECT CAST(unnest(generate_series(0, e_end + CAST(ceil(n / {B}.0) AS BIGINT) + 1)) AS BIGINT) AS epoch
        FROM tot),
cnt AS (SELECT d.epoch, (SELECT count(*) FROM rel WHERE release_epoch <= d.epoch) AS eligible_total FROM dep d),
pc(epoch, released_total) AS (
  SELECT CAST(0 AS BIGINT), CAST(least({B}, (SELECT eligible_total FROM cnt WHERE epoch = 0)) AS BIGINT)
  UNION ALL
  SELECT pc.epoch + 1, CAST(least(pc.released_total + {B}, c.eligible_total) AS BIGINT)
  FROM pc JOIN cnt c ON c.epoch = pc.epoch + 1)"""
    q["paced_counts"] = _with("base", EARLIEST, f"""{totals}
SELECT epoch, eligible_total, released, released_total FROM (
  SELECT pc.epoch, CAST(c.eligible_total AS BIGINT) AS eligible_total,
         CAST(pc.released_total - coalesce(lag(pc.released_total) OVER (ORDER BY pc.epoch), 0) AS BIGINT) AS released,
         pc.released_total
  FROM pc JOIN cnt c USING (epoch))
WHERE epoch <= (SELECT e_end FROM tot) OR released > 0""", recursive=True)
    paced = f"""{_PACED}
SELECT {SLICE}, arrival_epoch, release_epoch,
       CAST(row_number() OVER (ORDER BY release_epoch, timestamp_ms, arrival_epoch, topic, "partition", "offset") - 1
            AS BIGINT) AS release_position
FROM paced"""
    q["paced_replay"] = q["stream_ordered_release"] = _with("base", EARLIEST, paced, recursive=True)
    # no row is late here, so rows leave in order of their key: by rank, as far as the totals go
    q["paced_replay_fine"] = _with("steady", EARLIEST, f"""{totals},
ranked AS (
  SELECT *, row_number() OVER (ORDER BY timestamp_ms, arrival_epoch, topic, "partition", "offset") AS r FROM msgs)
SELECT {SLICE}, arrival_epoch, p.epoch AS release_epoch, CAST(r - 1 AS BIGINT) AS release_position
FROM ranked ASOF JOIN (SELECT released_total, min(epoch) AS epoch FROM pc GROUP BY 1) p ON r <= p.released_total""", recursive=True)
    q["paced_counts_jitter"] = _with("jitter", EARLIEST, f"""{_PACED},
dep AS (
  SELECT epoch FROM epochs UNION SELECT DISTINCT release_epoch FROM paced),
cnt AS (
  SELECT d.epoch, (SELECT count(*) FROM rel WHERE release_epoch <= d.epoch) AS eligible_total,
         (SELECT count(*) FROM paced WHERE release_epoch = d.epoch) AS released FROM dep d)
SELECT epoch, CAST(eligible_total AS BIGINT) AS eligible_total, CAST(released AS BIGINT) AS released,
       CAST(sum(released) OVER (ORDER BY epoch) AS BIGINT) AS released_total
FROM cnt""", recursive=True)
    q["stream_replay_until_live"] = _with("base", EARLIEST, """
SELECT s.topic, s."partition", s.replay_start_offset, s.replay_end_offset, s.consumed_offset, s.released_offset,
       g.last_ts AS timestamp_ms, s.consumed_offset + 1 >= s.replay_end_offset AND g.last_ts IS NOT NULL
         OR s.replay_start_offset >= s.replay_end_offset AS is_caught_up,
       s.is_live, false AS is_paused
FROM st s LEFT JOIN grid g USING (epoch, topic, "partition")
WHERE s.epoch = (SELECT max(epoch) FROM epochs)""")
    q["released_state"] = _with("jitter", EARLIEST, """
SELECT r.topic, r."partition", coalesce(x.ro, r.replay_start_offset) AS released_offset,
       CASE WHEN x.ro IS NULL THEN r.replay_start_offset >= r.replay_end_offset
            ELSE x.ro + 1 >= r.replay_end_offset END AS is_live
FROM ranges r LEFT JOIN (
  SELECT topic, "partition", "offset" AS ro FROM rel WHERE release_epoch IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY topic, "partition"
      ORDER BY release_epoch DESC, timestamp_ms DESC, arrival_epoch DESC, "offset" DESC) = 1) x
USING (topic, "partition")""")
    q["partition_state"] = _with("base", K.MIXED, f"""
SELECT r.topic, r."partition", r.replay_start_offset, r.replay_end_offset,
       coalesce(c.co, r.replay_start_offset) AS consumed_offset,
       coalesce(x.ro, r.replay_start_offset) AS released_offset,
       c.ts AS last_consumed_timestamp_ms,
       CASE WHEN x.ro IS NULL THEN r.replay_start_offset >= r.replay_end_offset
            ELSE x.ro + 1 >= r.replay_end_offset END AS is_live,
       false AS is_paused
FROM ranges r
LEFT JOIN (SELECT topic, "partition", max("offset") AS co, arg_max(timestamp_ms, "offset") AS ts
           FROM msgs WHERE arrival_epoch <= {MID} GROUP BY topic, "partition") c USING (topic, "partition")
LEFT JOIN (SELECT topic, "partition", "offset" AS ro FROM rel WHERE release_epoch <= {MID}
           QUALIFY row_number() OVER (PARTITION BY topic, "partition"
               ORDER BY release_epoch DESC, timestamp_ms DESC, arrival_epoch DESC, "offset" DESC) = 1) x
  USING (topic, "partition")""")
    q["order_violations"] = _with("jitter", EARLIEST, """
SELECT release_epoch, min_ts, max_ts, prev_max_ts FROM (
  SELECT b.*, lag(max_ts) OVER (ORDER BY release_epoch) AS prev_max_ts
  FROM (SELECT release_epoch, min(timestamp_ms) AS min_ts, max(timestamp_ms) AS max_ts
        FROM rel WHERE release_epoch IS NOT NULL GROUP BY release_epoch) b
  LEFT JOIN prog p ON p.epoch = b.release_epoch
  WHERE NOT coalesce(p.is_live, false))
WHERE min_ts < prev_max_ts""")
    q["batch_size_violations"] = _with("base", EARLIEST, f"""
SELECT release_epoch, count(*) AS messages FROM rel WHERE release_epoch IS NOT NULL
GROUP BY release_epoch HAVING count(*) > {B}""")
    q["late_messages"] = _with("jitter", EARLIEST, f"""
SELECT {SLICE}, r.release_epoch, p.prior_max_ts FROM rel r JOIN (
  SELECT release_epoch, max(mx) OVER (ORDER BY release_epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
         AS prior_max_ts
  FROM (SELECT release_epoch, max(timestamp_ms) AS mx FROM rel WHERE release_epoch IS NOT NULL
        GROUP BY release_epoch)) p USING (release_epoch)
WHERE r.timestamp_ms < p.prior_max_ts""")
    ovr = " UNION ALL ".join(
        f"SELECT '{t}' AS topic, CAST({p} AS INTEGER) AS \"partition\", CAST({e} AS BIGINT) AS end_offset"
        for t, p, e in K.END_OVERRIDES)
    q["derived_ranges"] = _with("base", None, f""",
parts AS (SELECT t.topic, CAST(p.p AS INTEGER) AS "partition"
          FROM (SELECT DISTINCT topic FROM log) t CROSS JOIN (SELECT unnest(range(0, {K.FIXTURE_PARTITIONS})) AS p) p),
agg AS (SELECT topic, "partition", min("offset") AS mn, max("offset") + 1 AS mx FROM log GROUP BY topic, "partition"),
ovr AS ({ovr})
SELECT p.topic, p."partition", a.mn AS replay_start_offset,
       CAST(coalesce(o.end_offset, a.mx) AS BIGINT) AS replay_end_offset, a.mn IS NULL AS missing
FROM parts p LEFT JOIN agg a USING (topic, "partition") LEFT JOIN ovr o USING (topic, "partition")""")
    q["poll_plan_missing"] = _with("base", None, """
SELECT CAST(0 AS BIGINT) AS poll, q.topic, q."partition", CAST(q.o AS BIGINT) AS "offset" FROM (
  SELECT topic, "partition", unnest(generate_series(0, max("offset") + 2)) AS o FROM log GROUP BY topic, "partition") q
WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l.topic = q.topic AND l."partition" = q."partition" AND l."offset" = q.o)""")
    return q
