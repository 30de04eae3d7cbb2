"""Fixed schemas and fixed values.

Everything a result depends on lives here, stated once: the emotion order,
the theme and subtheme codes, the country -> continent map, the topic ->
theme map, the keyword lists.  Operators take these as default parameters
so a caller can rebind them, but the defaults reproduce the published
pipeline.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# FIXED VALUES (must equal the published pipeline for identical results)
# --------------------------------------------------------------------------

# Report order of the four emotion measures.
EMOTIONS = ["anger", "sadness", "optimism", "joy"]

# Order used when picking the prevalent emotion: on a tie the first
# column in this order wins (argmax over the score columns as stored).
ARGMAX_ORDER = ["anger", "joy", "optimism", "sadness"]

# A prevalent emotion needs a score strictly above this, else 'undefined'.
PREVALENT_THRESHOLD = 0.5
UNDEFINED_LABEL = "undefined"

# Theme code -> description.
THEME_DESC = [
    (1, "Cases and deaths"),
    (2, "Economic impact"),
    (3, "Educational impact"),
    (4, "People stories"),
    (5, "Authorities & Politics"),
    (6, "Preventive measures"),
    (7, "Virus spreading"),
    (8, "Vaccines and vaccination"),
]

# Subtheme code -> description, as published (codes 21 and 22 carry the
# descriptions the published file gives them; see SUBTHEME_DESC_CORRECTED).
SUBTHEME_DESC = [
    (11, "Cases and deaths increasing"),
    (12, "Cases and deaths decreasing"),
    (21, "Economic impact over national economies and big companies"),
    (22, "Economic plans to support jobs and food programs"),
    (41, "Nursing homes and elderly victims"),
    (42, "Mental health impact"),
    (43, "Jail system and cops"),
    (44, "Family stories"),
    (51, "Health authorities"),
    (52, "Political authorities"),
    (53, "Elections"),
    (61, "Mobility restrictions"),
    (62, "Travelling protocols"),
    (63, "People against restrictions or breaking rules"),
    (64, "Non-pharmacological measures"),
    (65, "Festivities and holidays"),
    (66, "Easing restrictions"),
    (71, "Outbreak and pandemic origins"),
    (72, "Research and treatment"),
    (73, "New waves and variants"),
    (74, "Heatlh workers"),
    (10, "Cases and deaths (default)"),
    (20, "Economic impact (default)"),
    (30, "Educational impact (default)"),
    (40, "People stories (default)"),
    (50, "Authorities & Politics (default)"),
    (60, "Preventive measures (default)"),
    (70, "Virus spreading (default)"),
    (80, "Vaccines and vaccination (default)"),
]

# The keyword rules tag 21 with worker/job words and 22 with economy words,
# the opposite of the published descriptions.  Opt-in fix.
SUBTHEME_DESC_CORRECTED = {
    21: "Economic plans to support jobs and food programs",
    22: "Economic impact over national economies and big companies",
}

# Subtheme flag columns, in the order the decode step scans them.
SUBTHEME_CODES = [11, 12, 21, 22, 41, 42, 43, 44, 51, 52, 53,
                  61, 62, 63, 64, 65, 66, 71, 72, 73, 74]

# Country code -> continent (12 countries).
CONTINENT_OF = [
    ("AU", "Oceania"), ("UK", "Europe"), ("US", "America"), ("CA", "America"),
    ("NZ", "Oceania"), ("ZA", "Africa"), ("KE", "Africa"), ("NG", "Africa"),
    ("IN", "Asia"), ("PH", "Asia"), ("MY", "Asia"), ("IE", "Europe"),
]

# Country code -> display name.
COUNTRY_NAME = [
    ("AU", "Australia"), ("UK", "UK"), ("IN", "India"), ("NZ", "New Zealand"),
    ("NG", "Nigeria"), ("IE", "Ireland"), ("CA", "Canada"), ("KE", "Kenya"),
    ("ZA", "South Africa"), ("PH", "Philippines"), ("US", "USA"), ("MY", "Malaysia"),
]

# LDA topic number (0..19) -> theme, the mapping the live pipeline uses.
TOPIC_TO_THEME = [8, 5, 6, 6, 1, 5, 7, 2, 4, 1, 6, 6, 5, 2, 5, 7, 1, 5, 2, 3]

# Search keywords (substring match on lower-cased text).
KEYWORDS = [
    "remote working", "homeschooling", "panic buying", "sars-cov-2", "wearing masks",
    "ncov", "wuhan", "social distancing", "vaccination", "quarantine", "outbreak",
    "vaccine", "lockdown", "pandemic", "coronavirus", "covid",
]
# Keywords folded into 'other' in the weekly volume report.
LESS_FREQUENT_KEYWORDS = [
    "vaccination", "quarantine", "remote working", "homeschooling", "panic buying",
    "sars-cov-2", "wearing masks", "ncov", "wuhan", "social distancing",
]
# Keywords reported on their own in the weekly volume report.
MAIN_KEYWORDS = ["covid", "coronavirus", "pandemic", "lockdown", "vaccine", "outbreak"]

# Subtheme keyword rules: (theme, subtheme, keywords).  A document of the
# theme is tagged with the subtheme when any of its tokens equals a keyword.
SUBTHEME_RULES = [
    (1, 11, ["rise", "increase", "high", "spike", "jump", "reach", "double", "climb", "soar",
             "record_high", "death_toll_rise", "peak", "hit", "high_daily", "top", "exceed",
             "high_single_day", "tally_rise"]),
    (1, 12, ["low", "drop", "fall", "dip", "decrease"]),
    (2, 21, ["worker", "plan", "work", "support", "free", "job", "employee", "food", "citizen",
             "congress", "poor", "protect", "people", "vulnerable", "household", "essential",
             "loan", "small_business", "lose_job", "donation", "employer", "assistance",
             "job_loss"]),
    (2, 22, ["impact", "business", "government", "economy", "global", "demand", "market",
             "company", "industry", "cut", "aid", "budget", "sector", "boost", "bank", "bill",
             "stock", "quarter", "trade", "law", "growth", "lawmaker", "office", "relief_bill",
             "supreme_court", "economic_recovery", "debt", "profit", "relief_package",
             "global_economy", "stimulus_package", "world_bank", "relief_fund",
             "organisation"]),
    (4, 41, ["nurse_home", "care_home"]),
    (4, 42, ["mental_health"]),
    (4, 43, ["jail", "prison", "cop", "inmate"]),
    (4, 44, ["family", "couple", "wife", "mother", "son", "daughter", "husband", "father",
             "mum", "baby", "dad"]),
    (5, 51, ["health_official", "health_minister", "expert", "task_force", "public_health",
             "dr_anthony_fauci", "chief_medical_officer"]),
    (5, 52, ["trump", "pm", "president", "president_trump", "minister", "white_house",
             "leader", "pm_modi", "governor", "govt", "president_donald_trump",
             "donald_trump", "administration", "federal", "biden", "mp", "joe_biden",
             "trudeau", "trump_administration", "pm_narendra_modi", "leadership",
             "pres_trump", "prime_minister_justin_trudeau", "opposition", "government"]),
    (5, 53, ["election", "poll", "debate", "voter"]),
    (6, 61, ["lockdown", "restriction", "quarantine", "police", "rule", "impose", "protocol",
             "quarantine_facility", "mandatory", "community_quarantine", "stay_home_order",
             "containment_zone", "covidquarantine", "quarantine_period"]),
    (6, 62, ["travel", "passenger", "flight", "airport", "plan", "airline", "tourism", "fly",
             "traveller", "travel_ban", "trip", "vaccine_passport"]),
    (6, 63, ["protest", "anti", "break", "arrest", "fine", "protester"]),
    (6, 64, ["social_distance", "mask", "wear_mask", "social_distance_measure"]),
    (6, 65, ["christmas", "holiday", "easter"]),
    (6, 66, ["ease", "relax", "restriction_ease", "ease_restriction", "slow_spread"]),
    (7, 71, ["outbreak", "fear", "chinese", "detect", "epidemic", "suspect", "emerge", "panic",
             "epicentre", "animal", "origin", "china", "epicenter"]),
    (7, 72, ["hospital", "study", "treatment", "research", "lab", "expert", "cure",
             "researcher", "scientist", "ventilator", "study_find", "medicine", "scientists",
             "private_hospital", "expert_warn", "oxygen", "researchers", "intensive_care",
             "study_show", "hospitals", "palliative"]),
    (7, 73, ["variant", "wave", "strain", "mutation"]),
    (7, 74, ["doctor", "medical", "healthcare_worker", "health_worker", "doctors",
             "health_care_worker"]),
]

# Account-discovery search regions: name, centre latitude, centre longitude,
# radius in km (the kenya radius is the published value, a unit slip).
SEARCH_REGIONS = [
    ("india", 20.385825381874263, 78.22265625000001, 1159.759441155552),
    ("philippines", 12.211180191503997, 124.45312500000001, 932.0842548009142),
    ("nigeria", 9.058702156392139, 7.866210937500001, 597.7202418320643),
    ("malaysia", 4.149200693099289, 102.43652343750001, 294.4197592376132),
    ("indonesia1", -0.3515602939922709, 110.91796875000001, 1832.0141760886796),
    ("indonesia2", -4.214943141390639, 135.87890625000003, 788.510726515212),
    ("kenya", -0.4614207935306084, 37.50732421875001, 494253.76183736156),
]

# Extra stop words used when cleaning account bios (on top of a standard list).
BIO_EXTRA_STOPWORDS = ["from", "subject", "re", "edu", "use", "are", "com", "africa",
                       "african", "south", "american", "america"]

# Two outlet names that the outlet report folds into one.
OUTLET_RENAMES = {
    "ABC (American Broadcasting Company)": "ABC",
    "ABC (Australian Broadcasting Corporation)": "ABC",
}

# Engagement counters on a post.
ENGAGEMENT_COLS = ["replyCount", "retweetCount", "likeCount", "quoteCount"]

# Text-free export columns.
EXPORT_COLS = ["tweetId", "conversationId", "userId", "date", "sourceLabel", "replyCount",
               "retweetCount", "likeCount", "quoteCount", "longitude", "latitude", "place",
               "anger", "sadness", "optimism", "joy"]

# Emotion-model guard: more symbols than this -> scores are null.
SYMBOL_LIMIT = 150
# Score value written when the model fails on a text.
ERROR_SCORE = -1.0

# Mention threshold: an account is kept when its count > ceil(N / denominator).
MENTION_DENOMINATOR = 5000

# Account engagement cut-off (posts and replies) for the top-account report.
ENGAGEMENT_CUTOFF = 484

# Topic model defaults.
LDA_TOPICS = 20
LDA_SEED = 50
MIN_DOC_FRACTION = 0.0005
MAX_DOC_FRACTION = 0.33
PHRASE_MIN_COUNT = 5
PHRASE_THRESHOLD = 10.0
COHERENCE_WINDOW = 110          # boolean sliding window used by C_v
COHERENCE_SWEEP = list(range(2, 40, 3))

# --------------------------------------------------------------------------
# Schemas of the landed and consolidated tables (never inferred)
# --------------------------------------------------------------------------

POST_SCHEMA = T.StructType([
    T.StructField("tweetId", T.LongType()),
    T.StructField("conversationId", T.LongType()),
    T.StructField("userId", T.LongType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("content", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("sourceLabel", T.StringType()),
    T.StructField("replyCount", T.IntegerType()),
    T.StructField("retweetCount", T.IntegerType()),
    T.StructField("likeCount", T.IntegerType()),
    T.StructField("quoteCount", T.IntegerType()),
    T.StructField("longitude", T.FloatType()),
    T.StructField("latitude", T.FloatType()),
    T.StructField("place", T.StringType()),
])

ACCOUNT_SCHEMA = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("displayname", T.StringType()),
    T.StructField("userId", T.LongType()),
    T.StructField("description", T.StringType()),
    T.StructField("rawDescription", T.StringType()),
    T.StructField("verified", T.BooleanType()),
    T.StructField("created", T.TimestampType()),
    T.StructField("followersCount", T.IntegerType()),
    T.StructField("friendsCount", T.IntegerType()),
    T.StructField("statusesCount", T.IntegerType()),
    T.StructField("favouritesCount", T.IntegerType()),
    T.StructField("listedCount", T.IntegerType()),
    T.StructField("mediaCount", T.IntegerType()),
    T.StructField("location", T.StringType()),
    T.StructField("protected", T.BooleanType()),
    T.StructField("linkUrl", T.StringType()),
    T.StructField("linkTcourl", T.StringType()),
    T.StructField("profileImageUrl", T.StringType()),
    T.StructField("profileBannerUrl", T.StringType()),
])

RAW_USER_SCHEMA = T.StructType(
    [f for f in ACCOUNT_SCHEMA.fields if f.name != "userId"] + [T.StructField("id", T.LongType())]
)

RAW_POST_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("conversationId", T.LongType()),
    T.StructField("date", T.TimestampType()),
    T.StructField("content", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("sourceLabel", T.StringType()),
    T.StructField("replyCount", T.IntegerType()),
    T.StructField("retweetCount", T.IntegerType()),
    T.StructField("likeCount", T.IntegerType()),
    T.StructField("quoteCount", T.IntegerType()),
    T.StructField("place", T.StringType()),
    T.StructField("user", RAW_USER_SCHEMA),
    T.StructField("coordinates", T.StructType([
        T.StructField("longitude", T.FloatType()),
        T.StructField("latitude", T.FloatType()),
    ])),
    T.StructField("mentionedUsers", T.ArrayType(T.StructType([
        T.StructField("username", T.StringType()),
    ]))),
])

MEDIA_LIST_SCHEMA = T.StructType([
    T.StructField("username", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("media_outlet", T.StringType()),
    T.StructField("media_category", T.StringType()),
])

SCORE_SCHEMA = T.StructType([
    T.StructField("tweetId", T.LongType()),
    T.StructField("anger", T.DoubleType()),
    T.StructField("joy", T.DoubleType()),
    T.StructField("optimism", T.DoubleType()),
    T.StructField("sadness", T.DoubleType()),
])

CITY_SCHEMA = T.StructType([
    T.StructField("Rank", T.IntegerType()),
    T.StructField("City", T.StringType()),
    T.StructField("State", T.StringType()),
    T.StructField("2019", T.StringType()),
])

HEADLINE_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("full_title", T.StringType()),
])

TOPIC_RULE_SCHEMA = T.StructType([
    T.StructField("topic", T.IntegerType()),
    T.StructField("theme_id", T.IntegerType()),
    T.StructField("themes", T.StringType()),
    T.StructField("keywords", T.StringType()),
    T.StructField("default", T.StringType()),
])
