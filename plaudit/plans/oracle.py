"""Independent DuckDB SQL for every driver query (tables are views by name).

Written from the definitions, not generated from the Spark plans. Type
notes: DuckDB's ``sum``/``count_if`` give HUGEINT (cast to BIGINT); its
integer cast rounds, so truncation is ``trunc(x)::BIGINT``; nulls sort
last by default, so the category tie-break says NULLS FIRST as Spark does.
"""

from __future__ import annotations

from plaudit.plans.queries import (
    BRANDS_MAX_PCT,
    DAY_MAX_PCT,
    EVENTS_MAX_PCT,
    FINE_SLIDE,
    SAMPLE_EVERY,
    SAMPLE_LENGTH,
    SLIDE,
    WINDOW,
    WINDOW_START,
)

US = 1_000_000  # microseconds per second

EVENT_REVIEWS = """
event_reviews AS (
  SELECT event_id,
         CAST(user_id AS VARCHAR) AS category,
         CASE WHEN event_type IN ('error') THEN 'negative'
              WHEN event_type IN ('purchase', 'signup') THEN 'positive'
              ELSE event_type END AS evaluation,
         CAST(trunc(value) AS BIGINT) AS points,
         ts
  FROM events
)"""

BRAND_REVIEWS = """
brand_reviews AS (
  SELECT p.p_brand AS category,
         CASE l.l_returnflag WHEN 'R' THEN 'negative'
                             WHEN 'A' THEN 'positive'
                             ELSE 'neutral' END AS evaluation,
         CAST(trunc(l.l_quantity) AS BIGINT) AS points
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""


def _summary(name: str, source: str, scope: str = "") -> str:
    keys = f"{scope}, category" if scope else "category"
    return f"""
{name} AS (
  SELECT {keys},
         CAST(count(*) AS BIGINT) AS reviews,
         CAST(count(*) FILTER (WHERE lower(evaluation) = 'negative') AS BIGINT) AS negatives,
         CAST(sum(CASE WHEN lower(evaluation) = 'negative' THEN -points
                       WHEN lower(evaluation) = 'positive' THEN points
                       ELSE 0 END) AS BIGINT) AS points
  FROM {source}
  GROUP BY {keys}
)"""


def _scored(source: str, scope: str = "") -> str:
    """Ratios and scope totals on every summary row."""
    ratios = """CAST(s.negatives AS DOUBLE) / s.reviews * CAST(100.0 AS DOUBLE) AS pct_negative,
         CAST(s.points AS DOUBLE) / s.reviews AS avg_points"""
    if scope:
        return f"""
totals AS (
  SELECT {scope}, CAST(sum(reviews) AS BIGINT) AS scope_reviews,
         CAST(count(*) AS BIGINT) AS scope_categories
  FROM {source} GROUP BY {scope}
),
scored AS (
  SELECT s.*, t.scope_reviews, t.scope_categories,
         CAST(t.scope_reviews AS DOUBLE) / t.scope_categories AS avg_reviews,
         {ratios}
  FROM {source} s JOIN totals t USING ({scope})
)"""
    reviews = f"(SELECT CAST(sum(reviews) AS BIGINT) FROM {source})"
    categories = f"(SELECT CAST(count(*) AS BIGINT) FROM {source})"
    return f"""
scored AS (
  SELECT s.*, {reviews} AS scope_reviews, {categories} AS scope_categories,
         CAST({reviews} AS DOUBLE) / {categories} AS avg_reviews,
         {ratios}
  FROM {source} s
)"""


def _scorecard(ctes: str, summary: str, scope: str, max_pct: float, rule: str, order: str) -> str:
    op = ">" if rule == "gt" else ">="
    part = f"PARTITION BY {scope} " if scope else ""
    keys = f"{scope}, " if scope else ""
    return f"""WITH {ctes},{_scored(summary, scope).lstrip()}
SELECT {keys}category, reviews, negatives, points, pct_negative, avg_reviews, avg_points,
       CAST(row_number() OVER ({part}ORDER BY {order} DESC, category ASC NULLS FIRST) AS BIGINT) AS rank
FROM scored
WHERE reviews {op} avg_reviews AND pct_negative < {float(max_pct)!r}"""


def _ts_window(step_s: int, start_s: int = 0) -> str:
    shift = start_s * US
    return f"((epoch_us(ts) - {shift}) // {step_s * US}) * {step_s * US} + {shift}"


def _window_reviews(duration: int, slide: int, start: int = 0) -> str:
    """A1 reviews with ``window_start``/``window_end`` (TIMESTAMP)."""
    if slide == duration:
        body = f"""
  SELECT {_ts_window(slide, start)} AS ws_us, category, evaluation, points, ts FROM event_reviews"""
    elif slide < duration:
        per_row = -(-duration // slide)
        body = f"""
  SELECT ws_us, category, evaluation, points, ts FROM (
    SELECT {_ts_window(slide, start)} - k * {slide * US} AS ws_us, category, evaluation, points, ts
    FROM (SELECT *, unnest(range({per_row})) AS k FROM event_reviews)
  ) WHERE epoch_us(ts) < ws_us + {duration * US}"""
    else:
        body = f"""
  SELECT ws_us, category, evaluation, points, ts FROM (
    SELECT {_ts_window(slide, start)} AS ws_us, category, evaluation, points, ts FROM event_reviews
  ) WHERE epoch_us(ts) < ws_us + {duration * US}"""
    return f"""
windowed AS (
  SELECT make_timestamp(ws_us) AS window_start,
         make_timestamp(ws_us + {duration * US}) AS window_end,
         category, evaluation, points
  FROM ({body}
  )
)"""


def _windowed_scorecard(duration: int, slide: int, max_pct: float, start: int = 0) -> str:
    ctes = EVENT_REVIEWS + "," + _window_reviews(duration, slide, start) + "," + _summary(
        "summary", "windowed", "window_start, window_end"
    )
    return _scorecard(ctes, "summary", "window_start, window_end", max_pct, "gt", "avg_points")


def _day_scorecard(max_pct: float) -> str:
    day = """
day_reviews AS (SELECT CAST(ts AS DATE) AS day, category, evaluation, points FROM event_reviews)"""
    ctes = EVENT_REVIEWS + "," + day + "," + _summary("summary", "day_reviews", "day")
    return _scorecard(ctes, "summary", "day", max_pct, "gt", "avg_points")


BRAND_MONTH_SUMMARY = """
brand_month_reviews AS (
  SELECT CAST(date_trunc('month', l.l_shipdate) AS DATE) AS month,
         p.p_brand AS category,
         CASE l.l_returnflag WHEN 'R' THEN 'negative'
                             WHEN 'A' THEN 'positive'
                             ELSE 'neutral' END AS evaluation,
         CAST(trunc(l.l_quantity) AS BIGINT) AS points
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
),""" + _summary("summary", "brand_month_reviews", "month")

NATION_SUMMARY = """
nation_reviews AS (
  SELECT CAST(n_regionkey AS VARCHAR) AS category, 'positive' AS evaluation,
         CAST(n_nationkey AS BIGINT) AS points
  FROM nation
),""" + _summary("summary", "nation_reviews")
EVENT_SUMMARY = EVENT_REVIEWS + "," + _summary("summary", "event_reviews")
BRAND_SUMMARY = BRAND_REVIEWS + "," + _summary("summary", "brand_reviews")


def _totals_only(summary_ctes: str) -> str:
    return f"""WITH {summary_ctes}
SELECT CAST(sum(reviews) AS BIGINT) AS scope_reviews,
       CAST(count(*) AS BIGINT) AS scope_categories,
       CAST(sum(reviews) AS DOUBLE) / count(*) AS avg_reviews
FROM summary"""


def _popular(summary_ctes: str) -> str:
    return f"""WITH {summary_ctes},{_scored("summary")}
SELECT category, reviews, avg_reviews FROM scored WHERE reviews > avg_reviews"""


def _liked(summary_ctes: str, max_pct: float) -> str:
    return f"""WITH {summary_ctes},{_scored("summary")}
SELECT category, reviews, negatives, pct_negative FROM scored
WHERE pct_negative < {float(max_pct)!r}"""


ORACLE_SQL: dict[str, str] = {
    "json_points": """
SELECT event_id,
       CAST(trunc(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS BIGINT) AS points
FROM events""",
    "review_measures": f"""WITH {EVENT_REVIEWS}
SELECT event_id, category, evaluation, points,
       CASE WHEN lower(evaluation) = 'negative' THEN 1 ELSE 0 END AS negative,
       CASE WHEN lower(evaluation) = 'negative' THEN -points
            WHEN lower(evaluation) = 'positive' THEN points
            ELSE CAST(0 AS BIGINT) END AS signed_points
FROM event_reviews""",
    "category_summary": f"WITH {EVENT_SUMMARY}\nSELECT * FROM summary",
    "category_count": f"WITH {EVENT_SUMMARY}\nSELECT CAST(count(*) AS BIGINT) AS categories FROM summary",
    "review_count": f"WITH {EVENT_SUMMARY}\nSELECT CAST(sum(reviews) AS BIGINT) AS reviews FROM summary",
    "average_reviews_events": _totals_only(EVENT_SUMMARY),
    "average_reviews_brands": _totals_only(BRAND_SUMMARY),
    "totals_attached": f"""WITH {EVENT_SUMMARY},{_scored("summary")}
SELECT category, reviews, negatives, points, scope_reviews, scope_categories, avg_reviews
FROM scored""",
    "totals_attached_per_day": f"""WITH {EVENT_REVIEWS},
day_reviews AS (SELECT CAST(ts AS DATE) AS day, category, evaluation, points FROM event_reviews),
{_summary("summary", "day_reviews", "day").strip()},{_scored("summary", "day")}
SELECT day, category, reviews, negatives, points, scope_reviews, scope_categories, avg_reviews
FROM scored""",
    "popular_categories": _popular(EVENT_SUMMARY),
    "liked_categories": _liked(EVENT_SUMMARY, EVENTS_MAX_PCT),
    "popular_brands": _popular(BRAND_SUMMARY),
    "liked_brands": _liked(BRAND_SUMMARY, BRANDS_MAX_PCT),
    "brand_ratios": f"""WITH {BRAND_SUMMARY},{_scored("summary")}
SELECT category, reviews, negatives, points, pct_negative, avg_points FROM scored""",
    "scorecard_by_points_events": _scorecard(EVENT_SUMMARY, "summary", "", EVENTS_MAX_PCT, "gt", "points"),
    "scorecard_by_points_brands": _scorecard(BRAND_SUMMARY, "summary", "", BRANDS_MAX_PCT, "gt", "points"),
    "scorecard_by_avg_events": _scorecard(EVENT_SUMMARY, "summary", "", EVENTS_MAX_PCT, "ge", "avg_points"),
    "scorecard_by_avg_brands": _scorecard(BRAND_SUMMARY, "summary", "", BRANDS_MAX_PCT, "ge", "avg_points"),
    "scorecard_brands_per_month": _scorecard(
        BRAND_MONTH_SUMMARY, "summary", "month", BRANDS_MAX_PCT, "gt", "avg_points"
    ),
    "scorecard_per_day": _day_scorecard(DAY_MAX_PCT),
    "scorecard_tumbling": _windowed_scorecard(WINDOW, WINDOW, EVENTS_MAX_PCT),
    "scorecard_sliding": _windowed_scorecard(WINDOW, SLIDE, EVENTS_MAX_PCT),
    "scorecard_sliding_fine": _windowed_scorecard(WINDOW, FINE_SLIDE, EVENTS_MAX_PCT),
    "scorecard_sampling": _windowed_scorecard(SAMPLE_LENGTH, SAMPLE_EVERY, EVENTS_MAX_PCT),
    "scorecard_from_json": _scorecard(EVENT_SUMMARY, "summary", "", EVENTS_MAX_PCT, "gt", "points"),
    "scorecard_from_json_lenient": _scorecard(EVENT_SUMMARY, "summary", "", EVENTS_MAX_PCT, "gt", "points"),
    "stream_per_day": _windowed_scorecard(86400, 86400, DAY_MAX_PCT),
    "stream_tumbling": _windowed_scorecard(WINDOW, WINDOW, EVENTS_MAX_PCT),
    "stream_sliding": _windowed_scorecard(WINDOW, SLIDE, EVENTS_MAX_PCT),
    "stream_sliding_panes": _windowed_scorecard(WINDOW, SLIDE, EVENTS_MAX_PCT),
    "stream_sampling": _windowed_scorecard(SAMPLE_LENGTH, SAMPLE_EVERY, EVENTS_MAX_PCT),
    "stream_offset": _windowed_scorecard(WINDOW, WINDOW, EVENTS_MAX_PCT, WINDOW_START),
    "stream_json_arrival": _scorecard(EVENT_SUMMARY, "summary", "", EVENTS_MAX_PCT, "gt", "avg_points"),
    "stream_json_arrival_days": _windowed_scorecard(86400, 86400, DAY_MAX_PCT),
    "stream_totals_joined": f"SELECT * EXCLUDE (rank) FROM ({_windowed_scorecard(WINDOW, SLIDE, EVENTS_MAX_PCT)})",
    "stream_compacted": _windowed_scorecard(86400, 86400, DAY_MAX_PCT),
    "scorecard_maintained": _scorecard(EVENT_SUMMARY, "summary", "", EVENTS_MAX_PCT, "gt", "points"),
    "volume_rule_gt": _scorecard(NATION_SUMMARY, "summary", "", 10.0, "gt", "avg_points"),
    "volume_rule_ge": _scorecard(NATION_SUMMARY, "summary", "", 10.0, "ge", "avg_points"),
    "written_json": _scorecard(EVENT_SUMMARY, "summary", "", EVENTS_MAX_PCT, "gt", "points"),
    "written_per_day": _day_scorecard(DAY_MAX_PCT),
    "json_times": f"""WITH {EVENT_REVIEWS}
SELECT category, CASE WHEN evaluation = 'negative' THEN 'bad time' ELSE 'good' END AS fate,
       CAST(count(*) AS BIGINT) AS reviews
FROM event_reviews GROUP BY ALL""",
}
