"""Engaged accounts, cascade, theme mix, outlet rollup."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...schemas import EMOTIONS
from .. import reports as R, views as V
from ._common import _cascade, _cascade_sql, _mix_sql, MIN_POSTS, register, round_doubles


@register("engaged_accounts", V.VIEWS_SQL + f"""
SELECT account_id AS userId, count(post_id) AS n_posts FROM posts
WHERE account_id IS NOT NULL GROUP BY account_id HAVING count(post_id) > {MIN_POSTS}
""")
def q_engaged_accounts(spark, sf):
    """Accounts above the post-count cut-off."""
    return R.engaged_accounts(V.posts(spark, sf).withColumnRenamed("account_id", "userId"),
                              "userId", "post_id", MIN_POSTS)


@register("top_accounts_cascade", _cascade_sql())
def q_top_accounts_cascade(spark, sf):
    """Exclusive cascaded top-5 accounts per emotion with rank and score."""
    return round_doubles(_cascade(spark, sf).select(
        "continent", "country", "news_id", "n", *EMOTIONS, *[f"lift_{m}" for m in EMOTIONS],
        "main_emotion", F.col("rank_emotion").cast("bigint").alias("rank_emotion"), "score_emotion"))


@register("account_theme_mix", _cascade_sql().replace("\nSELECT continent, country, news_id, n,", ",\ntop_sel AS (SELECT continent, country, news_id, n,", 1).rstrip() + ")," + _mix_sql(
    "SELECT account_id AS userId, theme FROM posts WHERE account_id IN (SELECT news_id FROM top_sel)", "userId", 1) + """
SELECT mix.*, a.displayname, a.country, round(a.followersCount, 6) AS followersCount, a.description,
       t.main_emotion, t.rank_emotion, round_even(t.score_emotion * 100, 1) AS score_emotion
FROM mix JOIN accounts a ON mix.userId = a.userId JOIN top_sel t ON mix.userId = t.news_id
""")
def q_account_theme_mix(spark, sf):
    """Theme mix (%) of the cascade's accounts with account info."""
    top = _cascade(spark, sf)
    p = V.posts(spark, sf).withColumnRenamed("account_id", "userId")
    out = R.account_theme_mix(p, top, V.accounts(spark, sf), "userId", "news_id")
    return round_doubles(out.withColumn("rank_emotion", F.col("rank_emotion").cast("bigint")))


@register("group_theme_mix", _cascade_sql().replace("\nSELECT continent, country, news_id, n,", ",\ntop_sel AS (SELECT continent, country, news_id, n,", 1).rstrip() + ")," + _mix_sql(
    "SELECT t.main_emotion, p.theme FROM posts p JOIN top_sel t ON p.account_id = t.news_id", "main_emotion", 1) + """
SELECT * FROM mix
""")
def q_group_theme_mix(spark, sf):
    """Theme mix (%) of all posts by the accounts picked for each emotion."""
    top = _cascade(spark, sf)
    p = V.posts(spark, sf).withColumnRenamed("account_id", "userId")
    return R.group_theme_mix(p, top, "userId", "news_id")


@register("outlet_rollup", V.VIEWS_SQL + """,
per AS (SELECT news_id, count(reply_id) AS n FROM replies WHERE news_id IS NOT NULL GROUP BY news_id)
SELECT a.media_outlet, sum(per.n)::BIGINT AS replies FROM per JOIN accounts a ON per.news_id = a.userId
GROUP BY a.media_outlet
""")
def q_outlet_rollup(spark, sf):
    """Replies per media outlet, outlets renamed before grouping."""
    return R.outlet_rollup(V.replies(spark, sf), V.accounts(spark, sf), "news_id", "userId",
                           "media_outlet", "reply_id")


@register("engaged_replies", V.VIEWS_SQL + f"""
SELECT news_id, count(reply_id) AS n_replies FROM replies
WHERE news_id IN (SELECT account_id FROM posts GROUP BY account_id HAVING count(post_id) > {MIN_POSTS})
GROUP BY news_id
""")
def q_engaged_replies(spark, sf):
    """Replies per engaged account (semi join, F04)."""
    p = V.posts(spark, sf).withColumnRenamed("account_id", "userId")
    eng = R.engaged_accounts(p, "userId", "post_id", MIN_POSTS).select(F.col("userId").alias("news_id"))
    r = V.replies(spark, sf).join(eng, "news_id", "left_semi")
    return r.groupBy("news_id").agg(F.count("reply_id").alias("n_replies"))
