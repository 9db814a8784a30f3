"""Queries of the revision policy: what each series holds under each mode, and every step that led there."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import revisions
from .base import query, table

SERIES = ["user_id", "metric"]


def _observations(spark, d):
    e = table(spark, d, "events")
    i = F.col("event_id")
    role = F.when(i % 11 == 0, "restated").when(i % 7 == 0, "comparative").otherwise("primary")
    return e.select(
        (F.col("user_id") % 40).alias("user_id"), F.when(F.col("value") > 8, "high").otherwise("low").alias("metric"), i.alias("id"), F.floor(F.col("value") / 4).cast("double").alias("value"), role.alias("role"),
        (i % 29 == 0).alias("explicit"), F.when(i % 5 == 0, i % 2 == 0).alias("trusted"), F.col("event_type").alias("tier"), F.when(i % 3 > 0, F.concat(F.lit("f"), i % 4)).alias("family"), F.concat(F.lit("v"), i % 13).alias("version"), F.col("ts"),
    )


#: The same fold by recursion over the places of all series at once.
OBS_SQL = """o AS (SELECT user_id % 40 AS user_id, CASE WHEN value > 8 THEN 'high' ELSE 'low' END AS metric, event_id AS id, CAST(floor(value / 4) AS DOUBLE) AS value,
 CASE WHEN event_id % 11 = 0 THEN 'restated' WHEN event_id % 7 = 0 THEN 'comparative' ELSE 'primary' END AS role, event_id % 29 = 0 AS explicit,
 coalesce(CASE WHEN event_id % 5 = 0 THEN event_id % 2 = 0 END, event_type IN ('click', 'view')) AS trusted, CASE WHEN event_id % 3 > 0 THEN 'f' || event_id % 4 END AS family, event_id % 13 AS version, ts FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, metric ORDER BY ts, version, id) - 1 AS place FROM o)"""


def _fold_sql(mode: str) -> str:
    allowed = {"off": "false", "force": "true", "allow": "n.trusted AND (n.value = s.sel OR n.role <> 'primary' OR n.explicit OR coalesce(n.family = s.family AND n.version > s.version, false))"}[mode]
    return f"""RECURSIVE {OBS_SQL}, s AS (SELECT user_id, metric, place, id, 'first' AS step, CAST(NULL AS BIGINT) AS replaces, id AS selected, value AS sel, family, version FROM r WHERE place = 0
UNION ALL SELECT n.user_id, n.metric, n.place, n.id, CASE WHEN {allowed} THEN CASE WHEN n.value = s.sel THEN 'confirms' ELSE 'revises' END WHEN n.value = s.sel THEN 'repeats' ELSE 'conflicts' END, CASE WHEN {allowed} THEN s.selected END,
 CASE WHEN {allowed} THEN n.id ELSE s.selected END, CASE WHEN {allowed} THEN n.value ELSE s.sel END, CASE WHEN {allowed} THEN n.family ELSE s.family END, CASE WHEN {allowed} THEN n.version ELSE s.version END
 FROM s JOIN r n ON n.user_id = s.user_id AND n.metric = s.metric AND n.place = s.place + 1)"""


def _decisions_sql(mode: str) -> str:
    return f"""WITH {_fold_sql(mode)} SELECT user_id, metric, arg_max(selected, place) AS selected, arg_max(sel, place) AS value, count(*) AS candidates, count(*) FILTER (WHERE step IN ('confirms', 'revises')) AS superseded, count(*) FILTER (WHERE step = 'conflicts') AS conflicts,
CASE WHEN count(*) FILTER (WHERE step = 'conflicts') > 0 THEN 'unsafe conflicting observations retained' WHEN count(*) FILTER (WHERE step = 'revises') > 0 THEN 'later observation accepted by revision policy' WHEN count(*) > 1 THEN 'later observation confirms selected value' ELSE 'single observation' END AS reason FROM s GROUP BY 1, 2"""


def _steps(spark, d, mode):
    return revisions.steps(_observations(spark, d), SERIES, ["ts", revisions.natural(F.col("version"))], mode, ("click", "view"))


@query("revision_steps", f"WITH {_fold_sql('allow')} SELECT user_id, metric, place, id, step, replaces FROM s")
def revision_steps(spark, d):
    """What every observation did to its series."""
    return _steps(spark, d, "allow").select(*SERIES, "place", "id", "step", "replaces")


def _register(mode: str) -> None:
    @query(f"revisions_{mode}", _decisions_sql(mode))
    def held(spark, d):
        return revisions.decisions(_steps(spark, d, mode), SERIES)


for _mode in revisions.MODES:
    _register(_mode)
