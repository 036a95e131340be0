"""Schemas of articles and landed payloads."""

ARTICLE = (
    "ord BIGINT, title STRING, url STRING, domain STRING, seendate STRING, api_source STRING, "
    "tier INT, reasoning STRING"
)

# Landed articles: dates as they came and as they were read on arrival.
LANDED = f"{ARTICLE}, raw_date STRING, published TIMESTAMP_NTZ"

GDELT_PAYLOAD = (
    "articles ARRAY<STRUCT<url: STRING, title: STRING, seendate: STRING, domain: STRING, "
    "sourcecountry: STRING, tone: STRING>>"
)

SEARCH_PAYLOAD = (
    "results ARRAY<STRUCT<title: STRING, url: STRING, published_date: STRING, content: STRING, "
    "score: DOUBLE, raw_content: STRING>>"
)

RSS_ITEM = "title STRING, link STRING, description STRING, pubDate STRING"
