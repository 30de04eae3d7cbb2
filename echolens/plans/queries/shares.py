"""Shares, pivots and engagement."""

from __future__ import annotations

from ...schemas import EMOTIONS
from .. import reports as R, views as V
from ._common import (
    _DESCS, _EMO5, _pivot_sql, _row_norm_sql, _subtheme_values_sql, _theme_values_sql, register,
    round_doubles
)


@register("prevalent_emotion_share", V.VIEWS_SQL + f""",
c AS (SELECT country, prevalent_emotion, count(DISTINCT reply_id) AS n FROM replies
      WHERE country IS NOT NULL AND prevalent_emotion IS NOT NULL GROUP BY 1, 2),
w AS ({_pivot_sql('c', 'country', 'prevalent_emotion', 'n', _EMO5)})
{_row_norm_sql('w', 'country', _EMO5)}
""")
def q_prevalent_emotion_share(spark, sf):
    """Share of distinct replies per prevalent emotion inside each country."""
    return round_doubles(R.prevalent_emotion_share(V.replies(spark, sf), id_col="reply_id"))


@register("theme_share_by_country", V.VIEWS_SQL + f""",
c AS (SELECT country, theme_desc, count(DISTINCT post_id) AS n
      FROM posts JOIN {_theme_values_sql()} ON posts.theme = td.theme
      WHERE country IS NOT NULL GROUP BY 1, 2),
w AS ({_pivot_sql('c', 'country', 'theme_desc', 'n', _DESCS)})
{_row_norm_sql('w', 'country', _DESCS)}
""")
def q_theme_share_by_country(spark, sf):
    """Share of distinct posts per theme inside each country, columns by total."""
    return round_doubles(R.theme_share_by_country(V.posts(spark, sf), id_col="post_id"))


@register("subtheme_vs_global", V.VIEWS_SQL + f""",
gl AS (SELECT subtheme, cast(count(*) AS double) / sum(count(*)) OVER () AS "global"
         FROM posts WHERE subtheme IS NOT NULL GROUP BY subtheme),
per AS (SELECT prevalent_emotion, subtheme,
               cast(count(*) AS double) / sum(count(*)) OVER (PARTITION BY prevalent_emotion) AS prop
        FROM posts WHERE prevalent_emotion IN ('anger', 'sadness', 'optimism', 'joy')
              AND subtheme IS NOT NULL GROUP BY 1, 2),
w AS ({_pivot_sql('per', 'subtheme', 'prevalent_emotion', 'prop', EMOTIONS)})
SELECT w.subtheme, sd.subtheme_desc, td.theme_desc,
       {", ".join(f"round_even(w.{e} * 100, 2) AS {e}" for e in EMOTIONS)},
       round_even(gl."global" * 100, 2) AS "global"
FROM w JOIN {_subtheme_values_sql()} ON w.subtheme = sd.subtheme
       JOIN gl ON w.subtheme = gl.subtheme
       JOIN {_theme_values_sql()} ON td.theme = cast(floor(w.subtheme / 10) AS int)
""")
def q_subtheme_vs_global(spark, sf):
    """Subtheme share (%) per prevalent emotion next to the global share."""
    return R.subtheme_vs_global(V.posts(spark, sf))


@register("engagement_by_label", V.VIEWS_SQL + """
SELECT prevalent_emotion, round_even(avg(engagement), 1) AS engagement
FROM posts WHERE prevalent_emotion IS NOT NULL GROUP BY prevalent_emotion
""")
def q_engagement_by_label(spark, sf):
    """Mean engagement per prevalent emotion, one decimal."""
    return R.engagement_by_label(V.posts(spark, sf), ["engagement"])


@register("global_theme_mix", V.VIEWS_SQL + f""",
s AS (SELECT theme, cast(count(*) AS double) / sum(count(*)) OVER () AS prop
      FROM posts WHERE theme IS NOT NULL GROUP BY theme)
SELECT s.theme, td.theme_desc, round_even(prop * 100, 2) AS pct
FROM s JOIN {_theme_values_sql()} ON s.theme = td.theme
""")
def q_global_theme_mix(spark, sf):
    """Global theme shares (%) of the posts."""
    return R.global_theme_mix(V.posts(spark, sf))


@register("prevalent_value_counts", V.VIEWS_SQL + """
SELECT prevalent_emotion, count(*) AS count FROM posts WHERE prevalent_emotion IS NOT NULL
GROUP BY prevalent_emotion
""")
def q_prevalent_value_counts(spark, sf):
    """Posts per prevalent emotion, largest first."""
    from ...operators.shares import value_counts
    return value_counts(V.posts(spark, sf), "prevalent_emotion")
