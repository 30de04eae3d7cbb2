"""The published reports (R01-R20) as DataFrame jobs over consolidated tables.

Column names are parameters; the defaults are the consolidated-table names
(``tweetId``, ``conversationId``, ``userId``, ``news_id``, ...).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.emotions import polarity, theme_of_subtheme
from ..functions.text import contains_keyword, is_link_only, any_keyword, keyword_col_name, parse_dotted_int
from ..operators import lift as L
from ..operators import shares as S
from ..operators.ranking import cascade_top, cumulative_share_top, top_n_per_group
from ..schemas import (EMOTIONS, KEYWORDS, LESS_FREQUENT_KEYWORDS, MAIN_KEYWORDS, OUTLET_RENAMES,
                       THEME_DESC, UNDEFINED_LABEL)
from ..session import cut_lineage
from ..sources import lookups


# R01 -----------------------------------------------------------------------
def weekly_keyword_volumes(posts: DataFrame, text: str = "content", week: str = "dsw",
                           keywords=KEYWORDS, main=MAIN_KEYWORDS,
                           less_frequent=LESS_FREQUENT_KEYWORDS) -> DataFrame:
    """Per week: posts containing each main keyword, plus 'other' = sum of the
    less-frequent keyword counts (a post with two of them counts twice)."""
    kws = list(dict.fromkeys(list(keywords) + list(main) + list(less_frequent)))
    flags = posts.select(week, *[contains_keyword(text, k).cast("long").alias(keyword_col_name(k))
                                 for k in kws])
    sums = flags.filter(F.col(week).isNotNull()).groupBy(week).agg(
        *[F.sum(keyword_col_name(k)).alias(keyword_col_name(k)) for k in kws])
    other = None
    for k in less_frequent:
        c = F.col(keyword_col_name(k))
        other = c if other is None else other + c
    return sums.select(week, *[F.col(keyword_col_name(k)) for k in main],
                       (other if other is not None else F.lit(0)).alias("other"))


# R02 -----------------------------------------------------------------------
def weekly_means(df: DataFrame, week: str = "dsw", measures=EMOTIONS) -> DataFrame:
    return df.filter(F.col(week).isNotNull()).groupBy(week).agg(
        *[F.avg(m).alias(m) for m in measures])


# R03 -----------------------------------------------------------------------
def theme_share_by_country(posts: DataFrame, country: str = "country", theme: str = "theme",
                           id_col: str = "tweetId", order_columns: bool = True,
                           sort_by: str | None = "Preventive measures") -> DataFrame:
    """Share of distinct posts per theme inside each country; one column per theme description."""
    spark = posts.sparkSession
    named = posts.join(lookups.theme_desc(spark), on=theme, how="inner")
    counts = named.filter(F.col(country).isNotNull()).groupBy(country, "theme_desc").agg(
        F.count_distinct(id_col).alias("tweet_count"))
    descs = [d for _, d in THEME_DESC]
    wide = S.row_normalise(S.pivot_wide(counts, country, "theme_desc", "tweet_count", descs), descs)
    if order_columns:
        # the column order needs the totals first: write the (one row per
        # country) table once instead of computing it for the totals and again
        wide = S.order_columns_by_total(cut_lineage(wide), country, descs)
    return wide.orderBy(F.col(f"`{sort_by}`").asc_nulls_first(), F.col(country)) if sort_by else wide


# R04 -----------------------------------------------------------------------
def prevalent_emotion_share(replies: DataFrame, country: str = "country",
                            label: str = "prevalent_emotion", id_col: str = "tweetId",
                            sort_by: str | None = "anger") -> DataFrame:
    """Share of distinct replies per prevalent emotion (incl. 'undefined') inside each country."""
    counts = replies.filter(F.col(country).isNotNull() & F.col(label).isNotNull()).groupBy(
        country, label).agg(F.count_distinct(id_col).alias("tweet_count"))
    vals = EMOTIONS + [UNDEFINED_LABEL]
    wide = S.row_normalise(S.pivot_wide(counts, country, label, "tweet_count", vals), vals)
    return wide.orderBy(F.col(sort_by).asc_nulls_first(), F.col(country)) if sort_by else wide


# R05 -----------------------------------------------------------------------
def lift_continent_month(replies: DataFrame, continent: str = "continent", month: str = "dsm",
                         id_col: str = "tweetId") -> DataFrame:
    """Continent x month means against that month's mean over all rows."""
    return L.lift_vs_period(replies, [continent, month], [month], EMOTIONS, id_col, group_suffix="_continent")


# R06 -----------------------------------------------------------------------
def country_polarity(replies: DataFrame, coords: DataFrame | None = None, country: str = "country",
                     id_col: str = "tweetId") -> DataFrame:
    """Mean positive (joy+optimism) and negative (anger+sadness) per country, their
    difference, the reply count in thousands; joined to coordinates when given."""
    pos, neg = polarity()
    agg = (replies.filter(F.col(country).isNotNull())
           .select(country, id_col, pos.alias("positive"), neg.alias("negative"))
           .groupBy(country).agg(F.avg("positive").alias("positive"), F.avg("negative").alias("negative"),
                                 F.count(id_col).alias("n")))
    out = agg.select("*", (F.col("positive") - F.col("negative")).alias("mean_emotion"),
                     (F.col("n") / 1000).alias("n_thousands"))
    if coords is not None:
        out = out.join(coords, on=country, how="inner")
    return out


def clean_coordinates(raw: DataFrame, code: str = "Alpha-2 code", lat: str = "Latitude (average)",
                      lng: str = "Longitude (average)") -> DataFrame:
    """Quoted-string coordinate file -> (country, lat, lng) with GB renamed to UK."""
    def strip(c):
        return F.translate(F.col(f"`{c}`"), '" ', "")
    cc = strip(code)
    return raw.select(F.when(cc == "GB", F.lit("UK")).otherwise(cc).alias("country"),
                      strip(lat).cast("double").alias("lat"), strip(lng).cast("double").alias("lng"))


# R07 -----------------------------------------------------------------------
def outlet_rollup(replies: DataFrame, accounts: DataFrame, news_id: str = "news_id",
                  account_id: str = "userId", outlet: str = "media_outlet",
                  id_col: str = "tweetId", renames=OUTLET_RENAMES) -> DataFrame:
    """Replies per outlet: count per account, join outlet, rename outlets BEFORE grouping, sum."""
    per_acc = replies.filter(F.col(news_id).isNotNull()).groupBy(news_id).agg(
        F.count(id_col).alias("_n"))
    acc = accounts.select(F.col(account_id).alias("_acc"), F.col(outlet).alias("_outlet"))
    if renames:
        acc = acc.replace(dict(renames), subset=["_outlet"])
    j = per_acc.join(acc, per_acc[news_id] == acc["_acc"])
    return j.groupBy(F.col("_outlet").alias(outlet)).agg(F.sum("_n").alias("replies"))


# R09 -----------------------------------------------------------------------
def engaged_accounts(posts: DataFrame, account_id: str = "userId", id_col: str = "tweetId",
                     min_posts: int = 484) -> DataFrame:
    """Accounts with more than ``min_posts`` posts."""
    return posts.filter(F.col(account_id).isNotNull()).groupBy(account_id).agg(
        F.count(id_col).alias("n_posts")).filter(F.col("n_posts") > min_posts)


def account_emotions(replies: DataFrame, posts: DataFrame, news_id: str = "news_id",
                     post_account: str = "userId", reply_id: str = "tweetId",
                     post_id: str = "tweetId", min_posts: int = 484, min_replies: int = 484) -> DataFrame:
    """Per (continent, country, account): reply means, lifts and count, for engaged accounts."""
    acc = L.emotion_lift(replies, ["continent", "country", news_id], EMOTIONS, reply_id)
    eng = engaged_accounts(posts, post_account, post_id, min_posts).select(
        F.col(post_account).alias(news_id))
    return acc.join(eng, on=news_id, how="left_semi").filter(F.col("n") > min_replies)


def top_accounts_cascade(replies: DataFrame, posts: DataFrame, k: int = 5, **kw) -> DataFrame:
    """For anger, sadness, optimism, joy in turn: the k accounts with the highest mean
    reply emotion not already taken (rank k = highest)."""
    acc = account_emotions(replies, posts, **kw)
    return cascade_top(acc, kw.get("news_id", "news_id"), EMOTIONS, k)


# R10 / R11 -----------------------------------------------------------------
def theme_mix(posts: DataFrame, group: str | list, theme: str = "theme", pct_digits: int = 1) -> DataFrame:
    """Theme share (%) inside each group, one column per theme description."""
    spark = posts.sparkSession
    sh = S.share_within(posts, group, theme, "prop").join(lookups.theme_desc(spark), on=theme)
    descs = [d for _, d in THEME_DESC]
    wide = S.pivot_wide(sh, group, "theme_desc", "prop", descs)
    return wide.select(*[F.col(g) for g in ([group] if isinstance(group, str) else group)],
                       *[F.bround(F.col(f"`{d}`") * 100, pct_digits).alias(d) for d in descs])


def account_theme_mix(posts: DataFrame, top: DataFrame, accounts: DataFrame,
                      account_id: str = "userId", news_id: str = "news_id",
                      info=("displayname", "country", "followersCount", "description")) -> DataFrame:
    """Theme mix (%) of the cascade's accounts with account info and their pick."""
    # the score is reported like the theme columns: percent, one decimal, half-even
    picked = top.select(F.col(news_id).alias(account_id), "main_emotion", "rank_emotion",
                        F.bround(F.col("score_emotion") * 100, 1).alias("score_emotion"))
    mix = theme_mix(posts.join(picked.select(account_id), on=account_id, how="left_semi"), account_id)
    return (mix.join(accounts.select(account_id, *info), on=account_id)
               .join(picked, on=account_id))


def group_theme_mix(posts: DataFrame, top: DataFrame, account_id: str = "userId",
                    news_id: str = "news_id") -> DataFrame:
    """Theme mix (%) of all posts by the accounts picked for each emotion."""
    grp = top.select(F.col(news_id).alias(account_id), "main_emotion")
    return theme_mix(posts.join(grp, on=account_id), "main_emotion")


def global_theme_mix(posts: DataFrame, theme: str = "theme", pct_digits: int = 2) -> DataFrame:
    spark = posts.sparkSession
    return (S.share(posts, theme, "prop").join(lookups.theme_desc(spark), on=theme)
            .select(theme, "theme_desc", F.bround(F.col("prop") * 100, pct_digits).alias("pct")))


# R12 -----------------------------------------------------------------------
def subtheme_vs_global(posts: DataFrame, subtheme: str = "subtheme",
                       label: str = "prevalent_emotion", pct_digits: int = 2) -> DataFrame:
    """Subtheme share (%) among posts of each prevalent emotion, next to the global share.

    One pass over the posts: counts per (label, subtheme) are aggregated once
    (with a per-group 'is an emotion' flag), written to the checkpoint folder,
    and both the global and the per-emotion shares are rolled up from them.
    """
    spark = posts.sparkSession
    counts = cut_lineage(posts.filter(F.col(subtheme).isNotNull()).groupBy(label, subtheme).agg(
        F.count(F.lit(1)).alias("_n"), F.max(F.col(label).isin(EMOTIONS)).alias("_emo")))
    gcount = counts.groupBy(subtheme).agg(F.sum("_n").alias("_n"))
    total = gcount.agg(F.sum("_n")).scalar()
    glob = gcount.select(subtheme, (F.col("_n") / total).alias("global"))
    emo = counts.filter(F.coalesce(F.col("_emo"), F.lit(False)))
    per = emo.select(label, subtheme, (F.col("_n") / F.sum("_n").over(Window.partitionBy(label))).alias("prop"))
    wide = S.pivot_wide(per, subtheme, label, "prop", EMOTIONS)
    sd = lookups.subtheme_desc(spark)
    td = lookups.theme_desc(spark)
    out = (wide.join(sd, on=subtheme).join(glob, on=subtheme)
               .withColumn("theme", theme_of_subtheme(subtheme)).join(td, on="theme"))
    return out.select(subtheme, "subtheme_desc", "theme_desc",
                      *[F.bround(F.col(e) * 100, pct_digits).alias(e) for e in EMOTIONS],
                      F.bround(F.col("global") * 100, pct_digits).alias("global"))


# R13 -----------------------------------------------------------------------
def engagement_by_label(posts: DataFrame, counters, label: str = "prevalent_emotion",
                        digits: int = 1) -> DataFrame:
    return posts.filter(F.col(label).isNotNull()).groupBy(label).agg(
        *[F.bround(F.avg(c), digits).alias(c) for c in counters])


# R14 -----------------------------------------------------------------------
def lift_by_theme(replies: DataFrame, theme: str = "theme", id_col: str = "tweetId",
                  digits: int = 2) -> DataFrame:
    spark = replies.sparkSession
    lf = L.emotion_lift(replies, [theme], EMOTIONS, id_col, keep_means=False, digits=digits)
    return lf.join(lookups.theme_desc(spark), on=theme).select(
        theme, "theme_desc", "n", *[f"lift_{m}" for m in EMOTIONS])


# R16 -----------------------------------------------------------------------
def concentration(replies: DataFrame, filters: dict, key: str = "conversationId",
                  n: int = 25) -> DataFrame:
    """Top ``n`` conversations by share of the replies in a segment, with the running share."""
    seg = replies
    for c, v in filters.items():
        seg = seg.filter(F.col(c) == F.lit(v))
    return cumulative_share_top(seg, key, n)


# R18 -----------------------------------------------------------------------
def mention_counts(posts: DataFrame, mentions_col: str = "mentioned", denominator: int = 5000,
                   region: str | None = None) -> DataFrame:
    """Accounts mentioned more than ceil(N / denominator) times, N = posts (per region when given).

    ``mentions_col`` is an array of handles (null or empty -> no rows).
    """
    keys = [region] if region else []
    n = posts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_posts"))
    m = (posts.select(*keys, F.explode(mentions_col).alias("account"))
              .filter(F.col("account").isNotNull())
              .groupBy(*keys, "account").agg(F.count(F.lit(1)).alias("count")))
    # per-region post counts: one row per region (size-checked); one row without regions
    if keys:
        j = m.join(n, on=keys)
        return j.filter(F.col("count") > F.ceil(F.col("_posts") / F.lit(denominator))).drop("_posts")
    posts_n = n.select("_posts").scalar()
    return m.filter(F.col("count") > F.ceil(posts_n / F.lit(denominator)))


def discover_accounts(raw: DataFrame, accounts: DataFrame, region: str = "place", denominator: int = 5000) -> DataFrame:
    """News accounts per region, in one plan: handles mentioned in a region's posts more often than its threshold,
    their profiles, and whether these read like news (region, account, count, userId, news_like).

    A region of null is left out; a handle without a profile has nulls.
    """
    posts = raw.filter(F.col(region).isNotNull()).select(region, F.col("mentionedUsers.username").alias("_mentioned"))
    found = mention_counts(posts, "_mentioned", denominator, region=region)
    profiles = accounts.select(F.col("username").alias("account"), "userId", news_like().alias("news_like"))
    return found.join(profiles, "account", "left").select(region, "account", "count", "userId", "news_like")


def news_like(desc: str = "description", verified: str = "verified"):
    """'news' or 'News' in the description (case-sensitive) and verified."""
    d = F.coalesce(F.col(desc), F.lit(""))
    return ((F.instr(d, "news") > 0) | (F.instr(d, "News") > 0)) & F.coalesce(F.col(verified), F.lit(False))


# R19 -----------------------------------------------------------------------
def city_selection(cities: DataFrame, big: int = 200000, min_pop: int = 50000, per_state: int = 3,
                   rank: str = "Rank") -> DataFrame:
    """Top 3 per state (file order = rank) UNION cities over 200k, distinct, then over 50k, with a label."""
    c = cities.select(rank, F.trim("City").alias("City"), F.trim("State").alias("State"),
                      parse_dotted_int(F.col("`2019`")).alias("Population"))
    sel = c.filter(F.col("Population") > big).unionByName(
        top_n_per_group(c, "State", [rank], per_state)).distinct()
    sel = sel.filter(F.col("Population") > min_pop)
    return sel.withColumn("loctag", F.concat(F.replace(F.col("City"), F.lit(" city"), F.lit("")),
                                             F.lit(", "), F.col("State")))


# R20 -----------------------------------------------------------------------
def headline_enrichment(posts: DataFrame, headlines: DataFrame, text: str = "content",
                        url: str = "url", title: str = "full_title", keywords=KEYWORDS) -> DataFrame:
    """Link-only posts get the headline of their link as text; misses dropped; keyword filter."""
    links = posts.filter(is_link_only(text))
    j = links.join(headlines.select(F.col(url).alias("_u"), F.col(title).alias("_t")),
                   links[text] == F.col("_u"))
    out = j.withColumn(text, F.col("_t")).drop("_u", "_t").filter(F.col(text).isNotNull())
    return out.filter(any_keyword(text, keywords))
