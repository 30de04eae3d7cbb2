"""Emotion lift queries."""

from __future__ import annotations

from ...operators import lift as L
from ...schemas import EMOTIONS
from .. import reports as R, views as V
from ._common import _cube_sql, _EM, _mean_cols_sql, _theme_values_sql, register, round_doubles


@register("lift_by_theme", V.VIEWS_SQL + f""",
g AS (SELECT {_mean_cols_sql('g_')} FROM replies),
t AS (SELECT theme, count(reply_id) AS n, {_mean_cols_sql()} FROM replies
      WHERE theme IS NOT NULL GROUP BY theme)
SELECT t.theme, td.theme_desc, t.n,
       {", ".join(f"round_even(t.{m}/g.g_{m}, 2) AS lift_{m}" for m in _EM)}
FROM t CROSS JOIN g JOIN {_theme_values_sql()} ON t.theme = td.theme
""")
def q_lift_by_theme(spark, sf):
    """Emotion lift of replies per post theme, half-even to 2 places."""
    return R.lift_by_theme(V.replies(spark, sf), id_col="reply_id")


@register("lift_by_country", V.VIEWS_SQL + f""",
g AS (SELECT {_mean_cols_sql('g_')} FROM replies),
t AS (SELECT country, count(reply_id) AS n, {_mean_cols_sql()} FROM replies
      WHERE country IS NOT NULL GROUP BY country)
SELECT t.country, t.n, {", ".join(f"round(t.{m}, 6) AS {m}" for m in _EM)},
       {", ".join(f"round(t.{m}/g.g_{m}, 6) AS lift_{m}" for m in _EM)}
FROM t CROSS JOIN g
""")
def q_lift_by_country(spark, sf):
    """Reply means and lift per country against the global means (A12, c3)."""
    return round_doubles(L.emotion_lift(V.replies(spark, sf), ["country"], EMOTIONS, "reply_id"))


@register("lift_continent_month", V.VIEWS_SQL + f""",
gen AS (SELECT dsm, {", ".join(f"avg({m}) AS {m}_general" for m in _EM)} FROM replies
        WHERE dsm IS NOT NULL GROUP BY dsm),
grp AS (SELECT continent, dsm, count(reply_id) AS n, {", ".join(f"avg({m}) AS {m}_continent" for m in _EM)}
        FROM replies WHERE continent IS NOT NULL AND dsm IS NOT NULL GROUP BY continent, dsm)
SELECT grp.dsm, grp.continent, grp.n,
       {", ".join(f"round({m}_continent, 6) AS {m}_continent" for m in _EM)},
       {", ".join(f"round({m}_general, 6) AS {m}_general" for m in _EM)},
       {", ".join(f"round({m}_continent/{m}_general, 6) AS lift_{m}" for m in _EM)}
FROM grp JOIN gen ON grp.dsm = gen.dsm
""")
def q_lift_continent_month(spark, sf):
    """Continent x month means against that month's mean over all replies."""
    return round_doubles(R.lift_continent_month(V.replies(spark, sf), id_col="reply_id"))


@register("lift_cube17", _cube_sql())
def q_lift_cube17(spark, sf):
    """All 17 published lift key sets in one GROUPING SETS pass."""
    return round_doubles(L.lift_cube(V.replies(spark, sf), id_col="reply_id"))
