"""Account discovery: mentions, thresholds, radius search, profile features, classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from ...sources.tables import table as _table
from ...functions import text as TX
from ...session import cut_lineage
from ...operators import search as SR, tokens as TK, topics as TP
from .. import reports as R, views as V
from ._common import _docs, _points, _regions_sql, AS_OF, register, round_doubles


@register("mention_threshold", f"""
WITH m AS (SELECT unnest(regexp_extract_all(text, '@(\\w+)', 1)) AS account FROM documents),
c AS (SELECT account, count(*) AS count FROM m WHERE account IS NOT NULL GROUP BY account),
n AS (SELECT count(*) AS posts FROM documents)
SELECT account, count FROM c, n WHERE count > ceil(posts / 5000)
""")
def q_mention_threshold(spark, sf):
    """Mentioned handles counted above ceil(N/5000)."""
    docs = _table(spark, sf, "documents").select(TX.mentions("text").alias("mentioned"))
    return R.mention_counts(docs, "mentioned", 5000)


@register("radius_filter", f"""
WITH pts AS (SELECT c_custkey AS point_id, (c_custkey * 37) % 180 - 90 + c_nationkey / 10 AS latitude,
                    (c_custkey * 91) % 360 - 180 + c_nationkey / 7 AS longitude FROM customer),
d AS (SELECT region, point_id, latitude, longitude, radius_km,
             2 * 6371.0088 * asin(sqrt(least(1.0,
               sin((radians(lat) - radians(latitude)) / 2) * sin((radians(lat) - radians(latitude)) / 2)
               + cos(radians(latitude)) * cos(radians(lat)) * (sin((radians(lng) - radians(longitude)) / 2) * sin((radians(lng) - radians(longitude)) / 2)))))
             AS distance_km
      FROM pts CROSS JOIN {_regions_sql()})
SELECT region, point_id, round(distance_km, 6) AS distance_km FROM d WHERE distance_km <= radius_km
""")
def q_radius_filter(spark, sf):
    """Points within each search region's radius, grid-cell equi-join."""
    from ...sources.lookups import search_regions
    out = SR.radius_filter(_points(spark, sf), search_regions(spark))
    return round_doubles(out.select("region", "point_id", "distance_km"))


@register("link_stems", """
SELECT page_id,
       split_part(trim(trim(trim(url, 'https://'), 'http://'), 'www.'), '.', 1) AS stem_charset,
       split_part(regexp_replace(url, '^(https?://)?(www\\.)?', ''), '.', 1) AS stem_prefix
FROM pages
""")
def q_link_stems(spark, sf):
    """Profile link stems, character-set and prefix modes (P20)."""
    p = _table(spark, sf, "pages")
    return p.select("page_id", TX.link_stem("url", "charset").alias("stem_charset"),
                    TX.link_stem("url", "prefix").alias("stem_prefix"))


@register("profile_features", "WITH " + V.PROFILES_SQL.strip() + f""",
f AS (SELECT *, cast(floor(epoch_us(TIMESTAMP '{AS_OF}' - created) / 86400000000) AS BIGINT) AS age_in_days FROM profiles)
SELECT userId, verified,
       coalesce(split_part(trim(trim(trim(linkUrl, 'https://'), 'http://'), 'www.'), '.', 1) = username, false) AS usernameLink,
       age_in_days,
       round(statusesCount / (1 + age_in_days), 6) AS tweets_per_day,
       round(mediaCount / (1 + statusesCount), 6) AS media_per_tweet,
       round(listedCount / (1 + followersCount), 6) AS listed_per_followers,
       round(favouritesCount / (1 + statusesCount), 6) AS favourites_per_tweet,
       round(log10(1 + followersCount), 6) AS logFollowers, round(log10(1 + listedCount), 6) AS logListed,
       location IS NOT NULL AS hasLocation, linkUrl IS NOT NULL AS hasLink, profileBannerUrl IS NOT NULL AS hasBanner
FROM f
""")
def q_profile_features(spark, sf):
    """Account profile features at a fixed as-of time."""
    from ...functions.profile import PROFILE_FEATURES, with_profile_features
    f = with_profile_features(V.profiles(spark, sf), AS_OF)
    return round_doubles(f.select("userId", *PROFILE_FEATURES))


@register("news_account_flag", """
SELECT d.doc_id, (instr(d.text, 'news') > 0 OR instr(d.text, 'News') > 0) AND coalesce(l.quality = 1, false) AS news_like
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def q_news_account_flag(spark, sf):
    """'news'/'News' in the description and verified."""
    d = _table(spark, sf, "documents").select("doc_id", F.col("text").alias("description"))
    lab = _table(spark, sf, "labels").select("doc_id", (F.col("quality") == 1).alias("verified"))
    return d.join(lab, "doc_id", "left").select("doc_id", R.news_like("description", "verified").alias("news_like"))


@register("mentions_per_source", """
WITH m AS (SELECT source, unnest(regexp_extract_all(text, '@(\\w+)', 1)) AS account FROM documents),
c AS (SELECT source, account, count(*) AS count FROM m WHERE account IS NOT NULL GROUP BY 1, 2),
n AS (SELECT source, count(*) AS posts FROM documents GROUP BY source)
SELECT c.source, account, count FROM c JOIN n ON c.source = n.source WHERE count > ceil(posts / 1000)
""")
def q_mentions_per_source(spark, sf):
    """Mentions per source above ceil(N/1000) of that source (F06 per region)."""
    docs = _table(spark, sf, "documents").select("source", TX.mentions("text").alias("mentioned"))
    return R.mention_counts(docs, "mentioned", 1000, region="source").select("source", "account", "count")


@register("news_account_classifier")
def q_news_account_classifier(spark, sf):
    """Account classifier on the 12 profile features plus bio word counts.

    Profiles come from customers; an account's bio is the document with the
    same id; the training label is that document's quality label (the
    published model's labels were not shipped).  Predicts every account.
    """
    from ...functions.profile import PROFILE_FEATURES, with_profile_features
    from ...operators.scoring import predict_classifier, train_classifier
    prof = with_profile_features(V.profiles(spark, sf), AS_OF)
    bios = TK.bio_tokens(_docs(spark, sf, "doc_id", "text"), "text", "bio").select(F.col("doc_id").alias("userId"), "bio")
    accounts = cut_lineage(prof.join(bios, "userId", "left"), large=True)
    index = TP.term_index(TP.doc_freq_dictionary(accounts.filter(F.col("bio").isNotNull()), "bio", "userId", 0.01, 0.5))
    feats = TP.bag_of_words(accounts, index, "bio", "userId", "bio_counts", keep=PROFILE_FEATURES)
    lab = _table(spark, sf, "labels").select(F.col("doc_id").alias("userId"), F.col("quality").alias("label"))
    train = feats.join(lab, "userId")
    model = train_classifier(train, PROFILE_FEATURES, "label", vector_cols=["bio_counts"])
    return predict_classifier(model, feats, PROFILE_FEATURES, "userId", vector_cols=["bio_counts"]).select(
        "userId", "pred", F.round("p_true", 6).alias("p_true"))
