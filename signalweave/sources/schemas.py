"""Schemas of everything read from files.  Ids are strings: they exceed 2^53."""

METRICS = (
    "retweet_count BIGINT, reply_count BIGINT, like_count BIGINT, "
    "quote_count BIGINT, impression_count BIGINT"
)

SENTIMENT_POSTS = (
    "created_at STRING, lang STRING, id STRING, text_processed STRING, negative DOUBLE, "
    "netural DOUBLE, positive DOUBLE, label INT, Country STRING"
)

TAGGED_POSTS = (
    "created_at STRING, text_processed STRING, id STRING, label INT, Market STRING, Country STRING"
)

GEO_POSTS = (
    "created_at STRING, new_text STRING, id STRING, negative DOUBLE, category STRING, country STRING"
)

USER_POSTS = (
    "id STRING, text STRING, author_id STRING, in_reply_to_user_id STRING, "
    "geo STRUCT<place_id: STRING, country_code: STRING>, conversation_id STRING, "
    "created_at STRING, lang STRING, "
    "public_metrics STRUCT<retweet_count: BIGINT, reply_count: BIGINT, like_count: BIGINT, "
    "quote_count: BIGINT, impression_count: BIGINT>, "
    "referenced_tweets ARRAY<STRUCT<type: STRING, id: STRING>>, reply_settings STRING, source STRING"
)

USERS = (
    "id STRING, username STRING, name STRING, description STRING, created_at STRING, "
    "location STRING, followers_count BIGINT, tweet_count BIGINT"
)

RESULT_PAGES = f"data ARRAY<STRUCT<{USER_POSTS}>>, meta STRUCT<result_count BIGINT, next_token STRING>"

RULE_SHEET = "anchor STRING, include STRING, exclude STRING"

COUNTRY_MAP = (
    "`2_Code` STRING, Identified_Country_Name STRING, `3_Code` STRING, "
    "Country_Code INT, IMF_Country_Name STRING"
)

ACCOUNTS = "Name STRING"
