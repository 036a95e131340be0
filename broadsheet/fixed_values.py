"""Lists and formats that decide results and therefore are stated as they are."""

# Tiers of government domains of both countries and the requested outlets.
SOURCE_TIERS = {
    "state.gov": 1,
    "dhs.gov": 1,
    "defense.gov": 1,
    "commerce.gov": 1,
    "whitehouse.gov": 1,
    "treasury.gov": 1,
    "ustr.gov": 1,
    "china.usembassy-china.org.cn": 1,
    "justice.gov": 1,
    "house.gov": 1,
    "senate.gov": 1,
    "energy.gov": 1,
    "usda.gov": 1,
    "fcc.gov": 1,
    "sec.gov": 1,
    "cisa.gov": 1,
    "bis.doc.gov": 1,
    "fbi.gov": 1,
    "congress.gov": 1,
    "navy.mil": 1,
    "army.mil": 1,
    "af.mil": 1,
    "fmprc.gov.cn": 1,
    "mofcom.gov.cn": 1,
    "mod.gov.cn": 1,
    "gov.cn": 1,
    "ndrc.gov.cn": 1,
    "miit.gov.cn": 1,
    "pbc.gov.cn": 1,
    "customs.gov.cn": 1,
    "cac.gov.cn": 1,
    "gwytb.gov.cn": 1,
    "mfa.gov.cn": 1,
    "npc.gov.cn": 1,
    "scio.gov.cn": 1,
    "reuters.com": 1,
    "bloomberg.com": 1,
    "foxnews.com": 1,
    "cnbc.com": 1,
    "scmp.com": 1,
}

# Graded tiers of the stand-alone listing; unknown domains get LISTING_DEFAULT_TIER.
LISTING_TIERS = {
    "home.treasury.gov": 1,
    "state.gov": 1,
    "whitehouse.gov": 1,
    "fmprc.gov.cn": 1,
    "xinhuanet.com": 1,
    "en.people.cn": 1,
    "reuters.com": 2,
    "apnews.com": 2,
    "ft.com": 3,
    "bloomberg.com": 3,
    "wsj.com": 3,
    "economist.com": 3,
    "bbc.com": 3,
    "theguardian.com": 3,
    "nytimes.com": 3,
    "aljazeera.com": 3,
    "foreignpolicy.com": 3,
    "straitstimes.com": 4,
    "scmp.com": 4,
    "japantimes.co.jp": 4,
    "koreatimes.com": 4,
    "thenewslens.com": 4,
    "cna.com.tw": 4,
    "voachinese.com": 4,
    "rfa.org": 4,
    "chinatechnews.com": 4,
    "globaltimes.cn": 4,
}
LISTING_DEFAULT_TIER = 5

# Feed keywords, matched as case-insensitive substrings of title or link.
FEED_KEYWORDS = (
    "US", "U.S.", "CHINA", "CHINESE", "TAIWAN", "SINO", "BEIJING", "WASHINGTON",
    "美", "中", "台", "北京", "华盛顿", "制裁", "关税", "贸易", "芯片", "半导体",
)

# Keywords that keep an otherwise short line of an index page.
LINE_KEYWORDS = (
    "CHINA", "CHINESE", "US-", "U.S.", "USA", "TRADE", "SANCTION", "CHIP", "TAIWAN",
    "MILITARY", "BEIJING", "WASHINGTON",
)

# Header phrases of an index page that carry a build date and not a publication date.
HEADER_PHRASES = ("published time", "updated at")

# Official index pages, in reading order.
OFFICIAL_PAGES = (
    "https://www.state.gov/press-releases/",
    "https://www.state.gov/countries-areas/china/",
    "https://www.state.gov/countries-areas-archive/china/",
    "https://www.state.gov/department-press-briefings/",
    "https://www.dhs.gov/news-releases/press-releases",
    "https://www.defense.gov/News/Press-Products/",
    "https://www.commerce.gov/news/press-releases",
    "https://www.whitehouse.gov/news/",
    "https://home.treasury.gov/news/press-releases",
    "https://ustr.gov/about-us/policy-offices/press-office/press-releases",
    "https://china.usembassy-china.org.cn/news/",
    "https://www.justice.gov/news/press-releases",
    "https://chinaselectcommittee.house.gov/media/press-releases",
    "https://www.uscc.gov/hearings-all",
    "https://www.fmprc.gov.cn/eng/zy/jj/dstzgzz/dszs/",
    "https://www.fmprc.gov.cn/eng/xw/fyrbt/",
    "https://www.fmprc.gov.cn/eng/gjhdq_665435/3376_665447/3432_664920/3435_664926/",
    "https://www.fmprc.gov.cn/eng/xw/zwbd/",
    "https://english.mofcom.gov.cn/News/index.html",
    "http://eng.mod.gov.cn/2025xb/N/T/index.html",
    "http://eng.mod.gov.cn/2025xb/N/I/index.html",
    "http://eng.mod.gov.cn/2025xb/N/JE/index.html",
    "http://eng.mod.gov.cn/2025xb/P/index.html",
    "http://english.www.gov.cn/news/",
    "https://www.fmprc.gov.cn/mfa_eng/",
    "https://en.ndrc.gov.cn/news/",
    "http://www.arats.com.cn/yw/",
    "https://www.gwytb.gov.cn/xwdt/",
    "https://www.reuters.com/world/china/",
    "https://www.bloomberg.com/china",
    "https://www.foxnews.com/category/world/china",
    "https://www.cnbc.com/china-politics/",
    "https://www.scmp.com/news/china",
)

# State-media index pages; these are read without their times.
STATE_MEDIA_PAGES = (
    "http://www.xinhuanet.com/english/world/index.htm",
    "http://en.people.cn/90785/index.html",
    "https://www.globaltimes.cn/china/politics/index.html",
)

# RSS feeds, in polling order.
RSS_FEEDS = (
    "https://www.miit.gov.cn/api-gateway/jpaas-plugins-web-server/front/rss/getinfo"
    "?webId=8d828e408d90447786ddbe128d495e9e"
    "&columnIds=d3e2bede1bc045e2875fc7161c01db7d,028da85b0dbd4c9cb96fd5f421cd32b8,"
    "e4d6c56063fa4edca257cc2e24ad473c,161ae25e72be496f93cd1c1a79f5cc2b,ca517c97303b40cf80bd668b35f6148f",
    "https://www.state.gov/feed/",
    "https://www.defense.gov/DesktopModules/ArticleCS/RSS.ashx?ContentType=1&Site=945",
    "https://ustr.gov/rss.xml",
    "https://www.reutersagency.com/feed/?best-topics=china&post_type=best",
    "https://www.cnbc.com/id/100727362/device/rss/rss.html",
)

# Source names in the order in which their items are merged.
SOURCES = ("gdelt", "rss", "tavily", "google_news", "chinese_state_media", "official_scrape")

# Sources whose items need a date inside the window; google_news has its own, laxer rule.
DATED_SOURCES = ("gdelt", "tavily", "rss", "official_scrape", "chinese_state_media")

# The characters that count as whitespace when text is trimmed or split into words.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same characters as the inside of a regular-expression class.
WHITESPACE_CLASS = WHITESPACE

# English month names; the first three letters name the month in urls and mail dates.
MONTHS = (
    "january", "february", "march", "april", "may", "june", "july", "august", "september",
    "october", "november", "december",
)

UNKNOWN_DATE = "00000000"
