"""The registered queries as SQL over the same tables, written independently of the operators."""

from __future__ import annotations

from broadsheet.fixed_values import LINE_KEYWORDS, OFFICIAL_PAGES, STATE_MEDIA_PAGES

ORACLE: dict[str, str] = {}

WS = r"[\t-\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_WS = WS.replace("[", "[^", 1)
WS_SET = "' ' || " + " || ".join(
    f"chr({n})" for n in (9, 10, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
)

FEED = r"""
keyed AS (
  SELECT doc_id, text,
         CASE WHEN doc_id % 4 = 0 THEN doc_id // 2 ELSE doc_id END AS k,
         DATE '2024-01-01' + CAST(doc_id % 30 AS INTEGER) AS day
  FROM documents),
feed AS (
  SELECT doc_id AS ord,
    trim(regexp_extract(text, '^[^\n.!?]*')) AS title,
    'https://' || ['www.state.gov', 'home.treasury.gov', 'english.www.gov.cn', 'www.reuters.com',
      'blog.example.com', 'news.google.com', 'www.globaltimes.cn'][k % 7 + 1]
      || CASE k % 5 WHEN 0 THEN '/2024/01/' || lpad(CAST(k % 30 + 1 AS VARCHAR), 2, '0')
                    WHEN 1 THEN '/2024/jan/' || CAST(k % 30 + 1 AS VARCHAR) ELSE '' END
      || '/story-' || CAST(k AS VARCHAR)
      || CASE doc_id % 3 WHEN 0 THEN '?utm=' || CAST(doc_id AS VARCHAR) WHEN 1 THEN '#top' ELSE '' END AS url,
    CASE doc_id % 8
      WHEN 0 THEN strftime(day, '%Y%m%d')
      WHEN 1 THEN strftime(day, '%Y-%m-%d')
      WHEN 2 THEN strftime(day, '%a, %d %b %Y') || ' 23:30:00 +0800'
      WHEN 3 THEN strftime(day, '%B %d, %Y')
      WHEN 4 THEN strftime(day, '%d %B %Y')
      WHEN 5 THEN strftime(day, '%Y%m%d') || 'T100000Z'
      WHEN 6 THEN '' ELSE 'Unknown' END AS seendate,
    ['gdelt', 'tavily', 'rss', 'google_news', 'official_scrape', 'chinese_state_media'][doc_id % 6 + 1] AS api_source,
    text || CASE WHEN doc_id % 16 >= 13 THEN ' (Released ' || strftime(day, '%B %d, %Y') || ')' ELSE '' END AS reasoning,
    day
  FROM keyed)"""

MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def domain(url: str) -> str:
    return rf"lower(replace(regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), 'www.', ''))"


def canonical(url: str) -> str:
    return rf"regexp_replace({url}, '[?#].*$', '', 's')"


def title_key(title: str) -> str:
    return rf"regexp_replace(split_part(split_part(lower({title}), '-', 1), '|', 1), '[^a-z0-9]', '', 'g')"


def ymd(text: str, pattern: str) -> str:
    part = f"regexp_extract({text}, '{pattern}', ['y', 'm', 'd'])"
    return f"TRY_CAST({part}.y || '-' || lpad({part}.m, 2, '0') || '-' || lpad({part}.d, 2, '0') AS TIMESTAMP)"


def text_date(text: str) -> str:
    """Dates as the feed spells them: mail, numeric, with a month name."""
    mail = rf"try_strptime(regexp_extract({text}, '(\d{{1,2}} [A-Z][a-z][a-z] \d{{4}} \d\d:\d\d:\d\d)', 1), '%d %b %Y %H:%M:%S')"
    numeric = ymd(text, r"(\d{4})[-\s/]?(\d{1,2})[-\s/]?(\d{1,2})")
    return f"""CASE WHEN {text} IN ('', 'Unknown') OR contains({text}, '0000') THEN NULL
      ELSE coalesce({mail}, {numeric}, try_strptime({text}, '%B %d, %Y'), try_strptime({text}, '%d %B %Y')) END"""


def url_date(url: str) -> str:
    closed, opened = r"[/-](\d{4})[/-](\d{1,2})[/-](\d{1,2})[/-]", r"[/-](\d{4})[/-](\d{1,2})[/-](\d{1,2})"
    named = r"[/-](\d{4})/([a-z]{3})[a-z]{0,6}/(\d{1,2})"
    run = r"[/-](\d{4})(\d{2})(\d{2})[/-]"
    low = f"lower({url})"
    part = f"regexp_extract({low}, '{named}', ['y', 'm', 'd'])"
    return f"""coalesce(
      CASE WHEN regexp_matches({low}, '{closed}') THEN {ymd(low, closed)} ELSE {ymd(low, opened)} END,
      try_strptime({part}.d || ' ' || {part}.m || ' ' || {part}.y, '%d %b %Y'),
      {ymd(low, run)})"""


def parsed(text: str = "seendate", url: str = "url") -> str:
    return f"coalesce({text_date(text)}, {url_date(url)})"


def stamp(moment: str) -> str:
    return f"coalesce(strftime({moment}, '%Y%m%d'), '00000000')"


def shown(text: str) -> str:
    return f"CASE WHEN length({text}) = 8 THEN {text}[1:4] || '-' || {text}[5:6] || '-' || {text}[7:] ELSE {text} END"


def allowed(name: str, domains=("state.gov", "treasury.gov", "gov.cn", "reuters.com")) -> str:
    return "(" + " OR ".join(f"{name} = '{d}' OR ends_with({name}, '.{d}')" for d in domains) + ")"


def tier(name: str, default: int) -> str:
    return f"CASE {name} WHEN 'state.gov' THEN 1 WHEN 'treasury.gov' THEN 1 WHEN 'gov.cn' THEN 1 WHEN 'reuters.com' THEN 2 ELSE {default} END"


CUTOFF = "TIMESTAMP '2024-01-24 12:00:00'"
RANK = "tier, CAST(seendate AS INTEGER) DESC, ord"
GATE = f"""CASE WHEN api_source <> 'google_news' THEN coalesce(published >= {CUTOFF}, false)
    WHEN seendate <> '' THEN coalesce(published >= {CUTOFF}, true) ELSE true END"""

DESCRIBED = f"""{FEED},
described AS (
  SELECT ord, title, url, {domain('url')} AS domain, {stamp(parsed())} AS seendate, api_source,
         {tier(domain('url'), 3)} AS tier, reasoning
  FROM feed)"""

NORMALIZED = f"""{FEED},
dated AS (SELECT ord, title, url, {domain('url')} AS domain, seendate, api_source, reasoning, {parsed()} AS published FROM feed),
articles AS (
  SELECT ord, title, url, domain, {stamp('published')} AS seendate, api_source, {tier('domain', 1)} AS tier, reasoning
  FROM dated
  WHERE regexp_matches(title, '{NOT_WS}{WS}+{NOT_WS}')
    AND ({allowed('domain')} OR (api_source = 'google_news' AND contains(domain, 'google.com')) OR api_source = 'chinese_state_media')
    AND {GATE})"""


def greedy(source: str, prefix: str = "g") -> str:
    """CTEs that walk ``source`` in ``ord`` order and keep rows with two new keys; the kept rows
    end up in ``<prefix>_kept(ord)``."""
    return f"""
{prefix}_rows AS (
  SELECT row_number() OVER (ORDER BY ord) AS rn, ord, {canonical('url')} AS cu, {title_key('title')} AS tk
  FROM {source} WHERE url <> '' AND title <> ''),
{prefix}_walk(rn, ord, dup, urls, keys) AS (
  SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), true, CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[])
  UNION ALL
  SELECT n.rn, n.ord, list_contains(w.urls, n.cu) OR (n.tk <> '' AND list_contains(w.keys, n.tk)),
    CASE WHEN list_contains(w.urls, n.cu) OR (n.tk <> '' AND list_contains(w.keys, n.tk)) THEN w.urls ELSE list_append(w.urls, n.cu) END,
    CASE WHEN list_contains(w.urls, n.cu) OR (n.tk <> '' AND list_contains(w.keys, n.tk)) OR n.tk = '' THEN w.keys ELSE list_append(w.keys, n.tk) END
  FROM {prefix}_walk w JOIN {prefix}_rows n ON n.rn = w.rn + 1),
{prefix}_kept AS (SELECT ord FROM {prefix}_walk WHERE NOT dup)"""


def mirrors(source: str, prefix: str = "m") -> str:
    """CTEs that walk ``source`` by authority and keep titles that mirror no kept one."""
    near = (
        "len(list_filter(w.kept, lambda k: 18 * len(list_intersect(k, n.words)) >= 8 * (len(k) + len(n.words)))) > 0"
        " AND len(n.words) > 0"
    )
    return f"""
{prefix}_rows AS (
  SELECT row_number() OVER (ORDER BY CASE WHEN regexp_matches(domain, '(^|\\.)(gov|mil|gov\\.cn)$') THEN 0 ELSE 1 END,
           tier, CAST(seendate AS INTEGER) DESC, ord) AS rn,
         ord, list_distinct(regexp_extract_all(lower(title), '[a-z0-9]+')) AS words
  FROM {source}),
{prefix}_walk(rn, ord, dup, kept) AS (
  SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), true, CAST([] AS VARCHAR[][])
  UNION ALL
  SELECT n.rn, n.ord, {near}, CASE WHEN {near} OR len(n.words) = 0 THEN w.kept ELSE list_append(w.kept, n.words) END
  FROM {prefix}_walk w JOIN {prefix}_rows n ON n.rn = w.rn + 1),
{prefix}_kept AS (SELECT ord FROM {prefix}_walk WHERE NOT dup)"""


def with_(ctes: str, query: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{query}"


# --- whole digests -------------------------------------------------------------------------

ORACLE["digest_core"] = with_(
    NORMALIZED + "," + greedy("articles"),
    f"""SELECT row_number() OVER (ORDER BY {RANK}) AS idx, title, {shown('seendate')} AS date, url
FROM articles WHERE ord IN (SELECT ord FROM g_kept) AND seendate <> '00000000' AND strptime(seendate, '%Y%m%d') >= DATE '2024-01-24'
ORDER BY {RANK}""",
    recursive=True,
)

KEYWORDS = [("edon", 1), ("ment", 1), ("pathetic", -2), ("tion", 2), ("worthless", -3)]
PROSE = "lower(title || ' ' || reasoning)"
SCORE = " + ".join(f"CASE WHEN contains({PROSE}, '{w}') THEN {n} ELSE 0 END" for w, n in KEYWORDS)
MATCHED = "concat_ws(', ', " + ", ".join(f"CASE WHEN contains({PROSE}, '{w}') THEN '{w}' END" for w, _ in KEYWORDS) + ")"
_CANDIDATE = (
    rf"(?i)\d{{4}}[-/]\d{{1,2}}[-/]\d{{1,2}}|(?:{MONTHS})\s+(?:3[01]|[12]\d|0[1-9]|[1-9]),\s+\d{{4}}"
    rf"|(?:3[01]|[12]\d|0[1-9]|[1-9])\s+(?:{MONTHS})\s+\d{{4}}"
)


def judged(source: str) -> str:
    found = f"regexp_extract(concat_ws(chr(10), title, reasoning), '{_CANDIDATE}')"
    return f"""
j_found AS (SELECT *, {found} AS candidate, {parsed()} AS known, {url_date('url')} AS from_url FROM {source}),
j_dated AS (
  SELECT * EXCLUDE (candidate, known, from_url),
    CAST(CASE WHEN known IS NOT NULL AND (api_source <> 'google_news' OR from_url IS NOT NULL) THEN known
      ELSE coalesce({text_date('candidate')}, from_url) END AS DATE) AS pub_date
  FROM j_found),
judged AS (
  SELECT *, CASE WHEN pub_date IS NULL THEN 'unverifiable' WHEN pub_date < DATE '2024-01-24' THEN 'old' END AS drop_reason
  FROM j_dated)"""


STAGES = f"""{NORMALIZED},{greedy('articles')},
uniq AS (SELECT * FROM articles WHERE ord IN (SELECT ord FROM g_kept)),{judged('uniq')},
valid AS (SELECT * REPLACE (strftime(pub_date, '%Y%m%d') AS seendate) FROM judged WHERE drop_reason IS NULL),
asked AS (SELECT * FROM valid),
relevant AS (SELECT * REPLACE ({MATCHED} AS reasoning) FROM asked WHERE {SCORE} >= 2),{mirrors('relevant')},
retained AS (SELECT * FROM relevant WHERE ord IN (SELECT ord FROM m_kept)),
final AS (SELECT * FROM retained)"""

ORACLE["digest_full"] = with_(
    STAGES,
    f"SELECT row_number() OVER (ORDER BY {RANK}) AS idx, title, {shown('seendate')} AS date, url, tier, reasoning FROM final",
    recursive=True,
)
ORACLE["funnel"] = with_(
    STAGES,
    """SELECT 1 AS step, 'received' AS stage, count(*) AS items FROM feed
UNION ALL SELECT 2, 'unique', count(*) FROM uniq UNION ALL SELECT 3, 'pre_filtered', count(*) FROM valid
UNION ALL SELECT 4, 'raw', count(*) FROM relevant UNION ALL SELECT 5, 'final', count(*) FROM final""",
    recursive=True,
)

LABELLED = f"""{FEED},
labelled AS (
  SELECT ord + CASE WHEN ord % 2 = 0 THEN 0 ELSE 1099511627776 END AS ord, title, url, seendate, {domain('url')} AS domain,
    'C' || CAST(ord % 9 AS VARCHAR) AS sourcecountry, CASE WHEN ord % 10 <> 0 THEN CAST(ord % 21 - 10 AS VARCHAR) END AS tone,
    CASE WHEN ord % 2 = 0 THEN 'doc' ELSE 'context' END AS api_source
  FROM feed)"""
# Domains of the listing's tier table that occur in the feed: exact match, no suffixes.
_LISTED = "(VALUES ('home.treasury.gov', 1), ('state.gov', 1), ('reuters.com', 2), ('globaltimes.cn', 4)) AS t(name, tier)"
ORACLE["listing"] = with_(
    LABELLED
    + f""",
listed AS (SELECT l.*, t.tier, row_number() OVER (PARTITION BY {canonical('url')} ORDER BY ord) AS n
  FROM labelled l JOIN {_LISTED} ON l.domain = t.name)""",
    """SELECT ord, title, url, seendate, domain, sourcecountry, tone, api_source, tier,
  '[T' || tier || '] [' || sourcecountry || '] [' || printf('%+.1f', coalesce(CAST(tone AS DOUBLE), 0.0)) || '] [' || api_source || '] ' || title AS label
FROM listed WHERE n = 1""",
)

# --- normalisation and scalars ---------------------------------------------------------------

ORACLE["norm_articles"] = with_(NORMALIZED, "SELECT * REPLACE (md5(reasoning) AS reasoning) FROM articles")
_URLS = "(SELECT url FROM pages UNION ALL SELECT url FROM feed)"
ORACLE["url_canonical"] = with_(FEED, f"SELECT url, {canonical('url')} AS canon_url FROM {_URLS}")
ORACLE["url_domain"] = with_(FEED, f"SELECT url, {domain('url')} AS domain FROM {_URLS}")
ORACLE["title_key"] = with_(FEED, f"SELECT ord, {title_key('title')} AS title_key FROM feed")
ORACLE["date_from_text"] = with_(FEED, f"SELECT ord, seendate, CAST({text_date('seendate')} AS DATE) AS pub_date FROM feed")
ORACLE["date_from_url"] = with_(FEED, f"SELECT ord, url, CAST({url_date('url')} AS DATE) AS pub_date FROM feed")
ORACLE["date_coalesced"] = with_(FEED, f"SELECT ord, CAST({parsed()} AS DATE) AS pub_date FROM feed")
# Read-back of spelled-out dates: the answer follows from the day itself. Forms 13 to 15 (ordinal,
# short month, on-the-hour stamp) are unreadable; form 12 has no year and takes that of the run, or
# the one before for days more than two days ahead of it; 29 February never counts there.
ORACLE["date_notations"] = r"""
WITH days AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderkey % 16 AS form FROM orders),
spelled AS (
  SELECT *, CASE form
    WHEN 0 THEN strftime(day, '%a, %d %b %Y') || ' 23:30:00 -0500'
    WHEN 1 THEN strftime(day, '%-d %b %Y') || ' 10:11:12 GMT'
    WHEN 2 THEN strftime(day, '%B %-d, %Y') || ' 10:15 AM'
    WHEN 3 THEN strftime(day, '%a %b %-d') || ' 10:15:01 ' || strftime(day, '%Y')
    WHEN 4 THEN strftime(day, '%A, %d-%b-%y') || ' 10:15:01 GMT'
    WHEN 5 THEN strftime(day, '%d %b %y') || ' 7:05'
    WHEN 6 THEN strftime(day, '%Y%m%d') || 'T101500Z'
    WHEN 7 THEN strftime(day, '%Y-%m-%d') || 'T10:15:00Z'
    WHEN 8 THEN strftime(day, '%Y/%-m/%-d')
    WHEN 9 THEN strftime(day, '%B %-d, %Y') || ' - 10 AM'
    WHEN 10 THEN strftime(day, '%B %-d %Y') || ' | desk'
    WHEN 11 THEN strftime(day, '%-d %B %Y')
    WHEN 12 THEN strftime(day, '%B %-d')
    WHEN 13 THEN strftime(day, '%-dth %B %Y')
    WHEN 14 THEN strftime(day, '%b %-d, %Y')
    ELSE strftime(day, '%Y%m%d') || 'T100000Z' END AS spelled
  FROM days)
SELECT o_orderkey, spelled,
  CASE WHEN contains(spelled, '0000') THEN NULL
    WHEN form = 12 THEN
      CASE WHEN month(day) = 2 AND day(day) = 29 THEN NULL
        WHEN make_date(1999, month(day), day(day)) > TIMESTAMP '1999-06-17 12:00:00' THEN make_date(1998, month(day), day(day))
        ELSE make_date(1999, month(day), day(day)) END
    WHEN form = 14 AND month(day) <> 5 THEN NULL
    WHEN form IN (13, 15) THEN NULL
    ELSE day END AS pub_date
FROM spelled"""
ORACLE["seendate_format"] = with_(DESCRIBED, "SELECT ord, seendate FROM described")
ORACLE["display_date"] = with_(FEED, f"SELECT ord, {shown('seendate')} AS shown FROM feed")
ORACLE["text_strip"] = f"SELECT doc_id, md5(trim(text, {WS_SET})) AS stripped FROM documents"
ORACLE["ordinal_strip"] = (
    r"SELECT doc_id, md5(regexp_replace(text, '(\d+)(st|nd|rd|th)', '\1', 'g')) AS cleaned FROM documents"
)
_FIVE = ("amp", "lt", "gt", "quot", "apos")
_protect = "html"
for _i, _name in enumerate(_FIVE):
    _protect = f"replace({_protect}, '&{_name};', chr(1) || '{_i};')"
_protect = f"replace({_protect}, '&', '&amp;')"
for _i, _name in enumerate(_FIVE):
    _protect = f"replace({_protect}, chr(1) || '{_i};', '&{_name};')"
ORACLE["ampersand_repair"] = f"SELECT page_id, md5({_protect}) AS repaired FROM pages"

# --- filters ---------------------------------------------------------------------------------

ORACLE["title_min_words"] = with_(FEED, f"SELECT ord, title FROM feed WHERE regexp_matches(title, '{NOT_WS}{WS}+{NOT_WS}')")
ORACLE["nonempty_fields"] = with_(FEED, "SELECT ord, seendate FROM feed WHERE seendate <> '' AND title <> '' AND url <> ''")
_FIVE_DOMAINS = ("state.gov", "treasury.gov", "gov.cn", "reuters.com", "example.com")
ORACLE["allowlist_suffix"] = with_(
    FEED,
    f"""SELECT ord, domain FROM (
  SELECT ord, {domain('url')} AS domain FROM feed UNION ALL SELECT page_id, {domain('url')} FROM pages)
WHERE {allowed('domain', _FIVE_DOMAINS)}""",
)
ORACLE["allowlist_pattern"] = with_(DESCRIBED, f"SELECT ord, domain FROM described WHERE {allowed('domain')}")
ORACLE["allowlist_exact"] = with_(
    DESCRIBED, "SELECT ord, domain FROM described WHERE domain IN ('state.gov', 'treasury.gov', 'gov.cn', 'reuters.com')"
)
ORACLE["special_sources"] = with_(
    DESCRIBED,
    """SELECT ord, api_source, domain FROM described
WHERE (api_source = 'google_news' AND contains(domain, 'google.com')) OR api_source = 'chinese_state_media'""",
)
ORACLE["date_gates"] = with_(
    FEED, f"SELECT ord, api_source, seendate FROM (SELECT *, {parsed()} AS published FROM feed) WHERE {GATE}"
)
ORACLE["lookback_ts"] = f"SELECT event_id, user_id FROM events WHERE ts >= {CUTOFF}"
ORACLE["lookback_day"] = "SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-24'"
ORACLE["date_trust"] = with_(
    DESCRIBED + "," + judged("described"), "SELECT ord, api_source, pub_date, drop_reason FROM judged"
)
_HIT = "contains(lower({0}), 'tion') OR contains(lower({0}), 'worthless')"
ORACLE["keyword_any"] = with_(FEED, f"SELECT ord, title FROM feed WHERE {_HIT.format('title')} OR {_HIT.format('url')}")
ORACLE["search_boolean"] = with_(
    DESCRIBED,
    f"""SELECT ord, domain FROM described
WHERE contains(lower(reasoning), 'tion') AND contains(lower(reasoning), 'with')
  AND (contains(lower(reasoning), 'worthless') OR contains(lower(reasoning), 'from the') OR contains(lower(reasoning), 'que la'))
  AND {allowed('domain', ('gov', 'gov.cn', 'reuters.com'))}""",
)
_PLACES = r"""
words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS at FROM words),
hits AS (SELECT * FROM placed WHERE word IN ('with', 'from', 'that'))"""
ORACLE["search_near"] = with_(
    _PLACES,
    """SELECT DISTINCT a.doc_id FROM hits a JOIN hits b ON a.doc_id = b.doc_id AND abs(a.at - b.at) <= 20
WHERE a.word = 'with' AND b.word = 'from'""",
)
ORACLE["search_mixed"] = with_(
    _PLACES,
    """SELECT doc_id FROM documents WHERE NOT contains(lower(text), 'que la') AND (contains(lower(text), 'worthless')
  OR doc_id IN (SELECT a.doc_id FROM hits a JOIN hits b ON a.doc_id = b.doc_id AND abs(a.at - b.at) <= 3
    WHERE a.word = 'with' AND b.word IN ('from', 'that')))""",
)
ORACLE["search_as_written"] = with_(
    NORMALIZED
    + rf""",
split AS (SELECT ord, regexp_extract_all(lower(reasoning), '[\p{{L}}\p{{N}}]+') AS w FROM feed),
spots AS (SELECT ord, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM split),
pairs AS (
  SELECT a.ord, b.word, abs(a.place - b.place) AS gap FROM spots a JOIN spots b ON a.ord = b.ord
  WHERE a.word = 'with' AND b.word IN ('from', 'that'))""",
    f"""SELECT ord, domain FROM dated
WHERE regexp_matches(title, '{NOT_WS}{WS}+{NOT_WS}') AND {allowed('domain', ('gov', 'gov.cn', 'reuters.com'))}
  AND ({allowed('domain')} OR api_source = 'chinese_state_media')
  AND coalesce(published >= TIMESTAMP '2024-01-11 12:00:00', false) AND NOT contains(lower(reasoning), 'que la')
  AND (contains(lower(reasoning), 'from the') OR contains(lower(reasoning), 'worthless')
    OR ord IN (SELECT ord FROM pairs WHERE (word = 'from' AND gap <= 20) OR (word = 'that' AND gap <= 5)))""",
)
ORACLE["index_near"] = ORACLE["search_near"]
ORACLE["index_mixed"] = ORACLE["search_mixed"]
ORACLE["search_near_three"] = with_(
    _PLACES,
    """SELECT DISTINCT a.doc_id FROM hits a
JOIN hits b ON a.doc_id = b.doc_id AND b.word = 'from' AND abs(a.at - b.at) <= 15
JOIN hits c ON a.doc_id = c.doc_id AND c.word = 'that' AND abs(a.at - c.at) <= 15 AND abs(b.at - c.at) <= 15
WHERE a.word = 'with'""",
)

# --- lookups ---------------------------------------------------------------------------------

ORACLE["tier_lookup"] = with_(DESCRIBED, f"SELECT ord, domain, {tier('domain', 5)} AS tier FROM described")
ORACLE["tier_repeats"] = with_(
    DESCRIBED,
    """SELECT ord, domain, CAST(coalesce(t, 9) AS INTEGER) AS tier FROM described
LEFT JOIN (SELECT domain, arg_min(ord % 5, ord) AS t FROM described WHERE domain <> 'blog.example.com' GROUP BY domain) USING (domain)""",
)
ORACLE["url_repeats"] = with_(
    FEED,
    """SELECT ord, coalesce(target, 'https://news.google.com/rss/articles/' || CAST(ord % 70 AS VARCHAR)) AS url
FROM feed LEFT JOIN (SELECT ord % 70 AS link, arg_min(url, ord) AS target FROM feed WHERE ord % 7 <> 0 GROUP BY ord % 70) m ON m.link = ord % 70""",
)
ORACLE["content_repeats"] = """SELECT doc_id, md5(CASE WHEN coalesce(length(text), 0) < 400 THEN coalesce(other, text) ELSE text END) AS content
FROM documents LEFT JOIN (SELECT doc_id % 50 AS u, min(text) AS other FROM documents WHERE doc_id % 3 <> 0 GROUP BY doc_id % 50) o
  ON o.u = doc_id % 60"""
ORACLE["url_resolve"] = with_(
    FEED,
    """SELECT ord, CASE WHEN ord % 3 <> 0 THEN url ELSE 'https://news.google.com/rss/articles/' || CAST(ord AS VARCHAR) END AS url
FROM feed""",
)
ORACLE["content_fallback"] = """
SELECT d.doc_id, md5(CASE WHEN length(d.text) < 400 THEN coalesce(o.text, d.text) ELSE d.text END) AS content
FROM documents d LEFT JOIN documents o ON o.doc_id = d.doc_id + 3 AND o.doc_id % 3 <> 0"""
ORACLE["retain_by_index"] = with_(
    FEED, "SELECT f.ord, f.title FROM feed f JOIN (SELECT ord * ord % 997 * 2 AS i FROM feed) x ON f.ord = x.i"
)

# --- duplicates ------------------------------------------------------------------------------

ORACLE["dedup_url_first"] = with_(
    FEED, f"SELECT arg_min(ord, ord) AS ord, arg_min(url, ord) AS url FROM feed GROUP BY {canonical('url')}"
)
ORACLE["dedup_greedy"] = with_(
    FEED + "," + greedy("feed"), "SELECT ord, url, title FROM feed WHERE ord IN (SELECT ord FROM g_kept)", recursive=True
)
ORACLE["dedup_daily"] = with_(
    FEED + "," + greedy("feed"),
    """SELECT ord, url, title, CASE WHEN ord <= (SELECT max(ord) // 2 FROM feed) THEN '2024-01-30' ELSE '2024-01-31' END AS run
FROM feed WHERE ord IN (SELECT ord FROM g_kept)""",
    recursive=True,
)
_FIRST = f"(SELECT *, row_number() OVER (PARTITION BY {canonical('url')} ORDER BY ord) AS n FROM labelled)"
ORACLE["dedup_labelled"] = with_(LABELLED, f"SELECT ord, api_source, url FROM {_FIRST} WHERE n = 1")
ORACLE["mirror_triage"] = with_(
    DESCRIBED + "," + mirrors("described"),
    "SELECT ord, title, domain FROM described WHERE ord IN (SELECT ord FROM m_kept)",
    recursive=True,
)

# --- counts ----------------------------------------------------------------------------------

ORACLE["count_by_source"] = with_(NORMALIZED, "SELECT api_source, count(*) AS items FROM articles GROUP BY api_source")
ORACLE["drop_reasons"] = with_(
    DESCRIBED + "," + judged("described"),
    "SELECT coalesce(drop_reason, 'kept') AS reason, count(*) AS items FROM judged GROUP BY 1",
)
ORACLE["feed_hit_rate"] = with_(
    FEED,
    """SELECT api_source AS feed,
  count(*) FILTER (WHERE contains(lower(title), 'tion') OR contains(lower(title), 'la') OR contains(lower(title), 'worthless')) AS hits,
  count(*) AS seen
FROM feed WHERE ord // 6 < 15 GROUP BY 1""",
)
ORACLE["feed_latest"] = with_(
    FEED,
    """SELECT api_source AS feed, min(ord // 6) AS pos, arg_min(title, ord) AS title, arg_min(seendate, ord) AS seendate
FROM feed GROUP BY 1""",
)
ORACLE["dedup_totals"] = with_(
    LABELLED, f"SELECT api_source, count(*) AS before, count(*) FILTER (WHERE n = 1) AS after FROM {_FIRST} GROUP BY 1"
)

# --- order and caps --------------------------------------------------------------------------

ORACLE["rank_tier_date"] = with_(
    DESCRIBED, f"SELECT row_number() OVER (ORDER BY {RANK}) AS idx, ord, tier, seendate FROM described"
)
ORACLE["rank_tier"] = with_(DESCRIBED, "SELECT row_number() OVER (ORDER BY tier, ord) AS idx, ord, tier FROM described")
ORACLE["top_relevance_input"] = with_(DESCRIBED, f"SELECT ord, tier, seendate FROM described ORDER BY {RANK} LIMIT 300")
ORACLE["final_cap"] = with_(
    DESCRIBED, f"SELECT row_number() OVER (ORDER BY {RANK}) AS idx, ord, title FROM described ORDER BY {RANK} LIMIT 250"
)
# The payloads hold 50 items each; source ranks sit at bit 56, payload numbers at bit 24.
_NUMBERED = "row_number() OVER (ORDER BY {rank}) AS idx, ord".replace("{rank}", RANK)
ORACLE["published_stages"] = with_(
    DESCRIBED,
    f"""SELECT 'pre_filtered' AS stage, {_NUMBERED}, title FROM described
UNION ALL SELECT 'raw', {_NUMBERED}, title FROM described WHERE tier = 1
UNION ALL SELECT * FROM (SELECT 'final', {_NUMBERED}, title FROM described ORDER BY {RANK} LIMIT 100)""",
)
ORACLE["published_whole"] = with_(
    DESCRIBED,
    f"""SELECT 'pre_filtered' AS stage, {_NUMBERED}, title FROM described
UNION ALL SELECT 'raw', {_NUMBERED}, title FROM described WHERE tier = 1
UNION ALL SELECT 'final', {_NUMBERED}, title FROM described""",
)
ORACLE["latest_snapshot"] = with_(DESCRIBED, f"SELECT {_NUMBERED}, domain, seendate FROM described")
ORACLE["per_source_cap"] = with_(
    FEED, "SELECT (ord // 50) * 16777216 + ord % 50 AS ord, title, url FROM feed WHERE ord % 50 < 20"
)
ORACLE["digest_lines"] = with_(
    DESCRIBED + f", numbered AS (SELECT *, row_number() OVER (ORDER BY {RANK}) AS idx FROM described)",
    f"SELECT idx, idx || '. ' || title || chr(10) || 'Date: ' || {shown('seendate')} || chr(10) || 'Source: ' || url || chr(10) AS line FROM numbered",
)
ORACLE["prompt_render"] = with_(
    DESCRIBED,
    "SELECT ord, md5('TITLE: ' || title || chr(10) || 'SOURCE: ' || domain || chr(10) || 'SNIPPET: ' || reasoning) AS prompt FROM described",
)
ORACLE["triage_prompt"] = with_(
    DESCRIBED + f", shown AS (SELECT *, row_number() OVER (ORDER BY {RANK}) - 1 AS i FROM described ORDER BY {RANK} LIMIT 150)",
    "SELECT string_agg('[' || i || '] (' || domain || '): ' || title, chr(10) ORDER BY i) AS items FROM shown",
)

# --- sources ---------------------------------------------------------------------------------

ORACLE["union_sources"] = with_(
    FEED,
    """SELECT ord, title, api_source,
  list_position(['gdelt', 'rss', 'tavily', 'google_news', 'chinese_state_media', 'official_scrape'], api_source) - 1 AS source_rank
FROM feed""",
)
ORACLE["source_toggle"] = with_(FEED, "SELECT ord, api_source FROM feed WHERE api_source IN ('gdelt', 'rss')")


def item_ord(source_rank: int, position: str = "ord % 50") -> str:
    return f"{source_rank << 56} + (ord // 50) * 16777216 + {position}"


ORACLE["gdelt_items"] = with_(
    FEED, f"SELECT {item_ord(0)} AS ord, title, url, seendate, 'gdelt' AS api_source FROM feed"
)
ORACLE["gdelt_context"] = with_(
    FEED,
    f"""SELECT ord // 50 AS payload_no, ord % 50 AS pos, url, title, seendate, {domain('url')} AS domain, api_source
FROM feed, (VALUES ('doc'), ('context')) AS l(api_source)""".replace("url, title, seendate,", "feed.url, feed.title, feed.seendate,")
    .replace("domain, api_source", "domain, l.api_source"),
)
ORACLE["search_items"] = with_(
    FEED,
    f"SELECT {item_ord(2)} AS ord, title, url, seendate, md5(reasoning) AS reasoning, 'tavily' AS api_source FROM feed",
)
# Feed items start at position 1, behind a broken item.
_DESCRIPTION = "regexp_replace(title, '[^A-Za-z ]', '', 'g')"
ORACLE["rss_items"] = with_(
    FEED
    + """,
linked AS (SELECT *, CASE WHEN ord % 5 = 0 THEN 'https://www.state.gov/art/' || strftime(day, '%Y/%-m/%-d') || '/' || ord ELSE url END AS link FROM feed)""",
    f"""SELECT {item_ord(1, 'ord % 50 + 1')} AS ord, title, link AS url,
  CASE WHEN ord % 5 = 0 THEN strftime(day, '%Y%m%d') || 'T000000Z'
    WHEN ord % 2 = 0 THEN strftime(day, '%Y%m%d') || 'T120000Z' ELSE '' END AS seendate,
  {_DESCRIPTION} AS reasoning, 'rss' AS api_source
FROM linked WHERE {_HIT.format('title')} OR {_HIT.format('link')}""",
)
ORACLE["google_news_items"] = with_(
    FEED
    + """,
linked AS (SELECT *, CASE WHEN ord % 3 <> 0 THEN url ELSE 'https://news.google.com/rss/articles/' || ord END AS link FROM feed),
opened AS (SELECT *, """
    + url_date("link")
    + " AS from_url FROM linked)",
    f"""SELECT {item_ord(3, 'ord % 50 + 1')} AS ord, title, link AS url,
  CASE WHEN from_url IS NOT NULL THEN strftime(from_url, '%Y%m%d') WHEN ord % 4 = 0 THEN 'lately' ELSE strftime(day, '%Y%m%d') END AS seendate,
  {_DESCRIPTION} AS reasoning, 'google_news' AS api_source
FROM opened""",
)
ORACLE["atom_entries"] = with_(
    FEED,
    """SELECT ord // 50 AS payload_no, ord % 50 AS pos, nullif(trim(regexp_replace(title, '[<&]', '', 'g')), '') AS title,
  CASE WHEN ord % 4 <> 0 THEN strftime(day, '%Y-%m-%d') || 'T10:15:00Z' ELSE 'built' END AS date
FROM feed""",
)
ORACLE["fenced_json"] = with_(
    FEED, "SELECT ord, title, url FROM feed UNION ALL SELECT ord, 'second', url FROM feed"
)

# --- pages -----------------------------------------------------------------------------------

_ENTITIES = [("lt", "'<'"), ("gt", "'>'"), ("quot", "chr(34)"), ("copy", "chr(169)"), ("middot", "chr(183)"),
             ("nbsp", "chr(160)"), ("#39", "chr(39)"), ("amp", "'&'")]


def unescaped(text: str) -> str:
    for name, char in _ENTITIES:
        text = f"replace({text}, '&{name};', {char})"
    return text


def page_ctes(source: str = "pages", times: bool = True) -> str:
    quiet = "regexp_replace(html, '(?i)<!--.*?-->|<script.*?</script>|<style.*?</style>', chr(1), 'gs')"
    if times:
        quiet = rf"regexp_replace({quiet}, '<time[^>]*>\s*([^<]*[^<\s])\s*</time>', chr(1) || '(Date: \1)' || chr(1), 'g')"
    return rf"""
quiet AS (SELECT page_id, url, {quiet} AS h, regexp_extract(url, '^[a-z]+://[^/?#]*') AS origin FROM {source}),
rooted AS (SELECT *, replace(h, '<a href="/', '<a href="' || origin || '/') AS r FROM quiet),
linked AS (SELECT *, regexp_replace(r, '<a href="([^"]*)">\s*([^<]*[^<\s])\s*</a>', chr(1) || '[\2](\1)' || chr(1), 'g') AS l FROM rooted),
flat AS (SELECT page_id, url, {unescaped("regexp_replace(l, '<[^>]*>', chr(1), 'g')")} AS f FROM linked),
nodes AS (SELECT page_id, url, list_filter(list_transform(string_split(f, chr(1)), lambda n: trim(n, {WS_SET})), lambda n: n <> '') AS n FROM flat),
contents AS (SELECT page_id, url, array_to_string(n, chr(10)) AS content FROM nodes)"""


_KEEP = (
    "l <> '' AND NOT (length(l) < 50 AND ("
    + " OR ".join(f"contains(lower(l), '{p}')" for p in ("january 31, 2024", "31 january 2024", "2024-01-31", "published time", "updated at"))
    + r")) AND (length(l) > 40 OR (contains(l, '[') AND contains(l, '](')) OR regexp_matches(l, '(?i)\d{4}[-/]\d{1,2}[-/]\d{1,2}|(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]* \d{1,2}') OR "
    + " OR ".join(f"contains(upper(l), '{w}')" for w in LINE_KEYWORDS)
    + ")"
)
LINES = rf""",
kept AS (
  SELECT page_id, url, list_filter(list_transform(string_split(
    regexp_replace(regexp_replace(content, '!\[.*?\]\(.*?\)', '', 'g'), '\[\s*\]\(.*?\)', '', 'g'), chr(10)),
    lambda l: trim(l, {WS_SET})), lambda l: {_KEEP}) AS ls FROM contents),
lines AS (SELECT page_id, url, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS line_no FROM kept)"""

ORACLE["page_links"] = with_(
    page_ctes()
    + r""",
anchors AS (SELECT page_id, regexp_extract_all(r, '<a href="([^"]*)">\s*[^<]*[^<\s]\s*</a>', 1) AS hs,
  regexp_extract_all(r, '<a href="[^"]*">\s*([^<]*[^<\s])\s*</a>', 1) AS ts FROM rooted)""",
    f"""SELECT page_id, generate_subscripts(hs, 1) - 1 AS pos, {unescaped('unnest(ts)')} AS text, {unescaped('unnest(hs)')} AS href
FROM anchors""",
)
ORACLE["page_text"] = with_(page_ctes(), "SELECT page_id, md5(content) AS content FROM contents")
ORACLE["page_lines"] = with_(page_ctes() + LINES, "SELECT page_id, line_no, line FROM lines")
ORACLE["page_lines_cut"] = with_(page_ctes() + LINES, "SELECT page_id, line_no, line FROM lines WHERE line_no < 5")
DATED_PAGES = r"""
dated_pages AS (
  SELECT page_id, url, replace(regexp_replace(html, '<li><a href="([^"]*)">', '<li><a href="/item\1">Report on ', 'g'), '</a></li>',
    CASE WHEN page_id % 2 = 0 THEN '</a><time class=''d''> ' || strftime(DATE '2024-01-20' + CAST(page_id % 12 AS INTEGER), '%B %d, %Y') || ' </time></li>'
      ELSE '</a></li>' END) AS html
  FROM pages),"""
ORACLE["page_time_tags"] = with_(
    DATED_PAGES + page_ctes("dated_pages") + LINES, "SELECT page_id, line_no, line FROM lines WHERE starts_with(line, '(Date:')"
)
_HARVEST = (
    DATED_PAGES
    + page_ctes("dated_pages")
    + LINES
    + rf""",
paired AS (SELECT page_id, line_no AS pos, line, lead(line) OVER (PARTITION BY page_id ORDER BY line_no) AS after FROM lines),
found AS (
  SELECT page_id, pos, trim(regexp_extract(line, '\[([^\]\n]+)\]\(([^)\n]+)\)', 1)) AS title,
    regexp_extract(line, '\[([^\]\n]+)\]\(([^)\n]+)\)', 2) AS url,
    coalesce(nullif(regexp_extract(regexp_replace(line, '\[([^\]\n]+)\]\(([^)\n]+)\)', '\1', 'g'), '{_CANDIDATE}'), ''),
      CASE WHEN NOT regexp_matches(after, '\[([^\]\n]+)\]\(([^)\n]+)\)') THEN regexp_extract(after, '{_CANDIDATE}') END, '') AS date
  FROM paired WHERE regexp_matches(line, '\[([^\]\n]+)\]\(([^)\n]+)\)')),
harvest AS (
  SELECT * FROM found
  WHERE regexp_matches(title, '{NOT_WS}{WS}+{NOT_WS}') AND coalesce({parsed('date')} >= {CUTOFF}, false))"""
)
ORACLE["page_harvest"] = with_(_HARVEST, "SELECT page_id, pos, title, url, date FROM harvest")


def page_tier(name: str) -> str:
    return f"CASE {name} WHEN 'example.com' THEN 1 WHEN 'example.net' THEN 2 WHEN 'example.org' THEN 3 ELSE 1 END"


ORACLE["official_pages"] = with_(
    _HARVEST
    + f""",
ranked AS (SELECT *, {domain('url')} AS domain, row_number() OVER (PARTITION BY {canonical('url')} ORDER BY page_id, pos) AS n FROM harvest
  WHERE {allowed(domain('url'), ('example.com', 'example.net', 'example.org'))})""",
    f"SELECT title, url, domain, {stamp(parsed('date'))} AS seendate, {page_tier('domain')} AS tier FROM ranked WHERE n = 1",
)
ORACLE["state_media_pages"] = with_(
    _HARVEST.replace("dated_pages AS (", "timed_pages AS (", 1)
    .replace("FROM pages),", "FROM pages),\ndated_pages AS (SELECT page_id, url, replace(html, 'href=\"/item/', 'href=\"/2024/jan/29/item/') AS html FROM timed_pages),", 1)
    .replace("'(Date: \\1)'", "'\\1'")
    + f""",
ranked AS (SELECT *, {domain('url')} AS domain, row_number() OVER (PARTITION BY {canonical('url')} ORDER BY page_id, pos) AS n FROM harvest)""",
    f"SELECT title, url, domain, {stamp(parsed('date'))} AS seendate, {page_tier('domain')} AS tier FROM ranked WHERE n = 1",
)

# --- relevance -------------------------------------------------------------------------------

ORACLE["relevance_rules"] = with_(
    DESCRIBED,
    f"SELECT ord, {SCORE} AS score, CASE WHEN {SCORE} >= 2 THEN 'YES' ELSE 'NO' END AS is_relevant, {MATCHED} AS reasoning FROM described",
)
ORACLE["relevant_articles"] = with_(DESCRIBED, f"SELECT ord, {MATCHED} AS reasoning FROM described WHERE {SCORE} >= 2")

# --- streaming -------------------------------------------------------------------------------

ORACLE["stream_digest"] = with_(
    NORMALIZED
    + ","
    + greedy("articles"),
    "SELECT ord, title, url, seendate, tier FROM articles WHERE ord IN (SELECT ord FROM g_kept)",
    recursive=True,
)

# The same payloads, read from files.
for _kind in ("gdelt", "search", "rss"):
    ORACLE[f"{_kind}_files"] = ORACLE[f"{_kind}_items"]

_OUT = "left(md5(CAST(doc_id AS VARCHAR)), 1) IN ('0', '4', '8', 'c')"
_WORD_LIST = "regexp_extract_all(lower(text), '[a-z0-9]+')"
_WORD_SCORES = f"""
e AS (SELECT text, quality AS label FROM documents JOIN labels USING (doc_id) WHERE NOT ({_OUT})),
ew AS (SELECT label, unnest({_WORD_LIST}) AS word FROM e),
counts AS (SELECT word, count(*) FILTER (WHERE label = 1) AS yes, count(*) FILTER (WHERE label <> 1) AS no FROM ew GROUP BY word),
t AS (SELECT sum(yes) + count(*) + 1 AS ty, sum(no) + count(*) + 1 AS tn FROM counts),
p AS (SELECT ln((count(*) FILTER (WHERE label = 1) + 1.0) / (count(*) FILTER (WHERE label <> 1) + 1.0)) AS prior FROM e),
ratios AS (SELECT word, ln((yes + 1) / ty) - ln((no + 1) / tn) AS ratio FROM counts, t),
dw AS (SELECT doc_id AS ord, unnest({_WORD_LIST}) AS word FROM documents),
means AS (SELECT ord, avg(coalesce(ratio, (SELECT ln(tn / ty) FROM t))) AS mean FROM dw LEFT JOIN ratios USING (word) GROUP BY ord),
scores AS (
  SELECT doc_id AS ord, coalesce(mean, 0) * 10 + prior AS score
  FROM documents LEFT JOIN means ON ord = doc_id, p)"""
ORACLE["relevance_model"] = with_(_WORD_SCORES.strip(), "SELECT ord, round(score, 6) AS score FROM scores")
ORACLE["relevance_model_quality"] = with_(
    _WORD_SCORES.strip(),
    f"""SELECT quality, round(score, 6) > 0 AS answer, count(*) AS items
FROM scores JOIN labels ON ord = doc_id WHERE {_OUT} GROUP BY ALL""",
)

_PAGES = ", ".join(
    f"({i}, '{url}', '{source}')"
    for i, (url, source) in enumerate(
        [(url, "official_scrape") for url in OFFICIAL_PAGES] + [(url, "chinese_state_media") for url in STATE_MEDIA_PAGES]
    )
)
ORACLE["reference_pages"] = with_(
    DESCRIBED
    + f""",
listed AS (SELECT page_no, url, api_source, {domain('url')} AS domain FROM (VALUES {_PAGES}) AS v(page_no, url, api_source)),
hosts AS (SELECT domain, count(*) AS articles FROM described GROUP BY domain)""",
    "SELECT page_no, url, api_source, domain, coalesce(articles, 0) AS articles FROM listed LEFT JOIN hosts USING (domain)",
)


def _stream_dedup(triggers: int = 4, window: int = 10 * 86400, lateness: int = 5 * 86400) -> str:
    """The state's and the title table's rules, one arrival after another."""
    parts = [
        f"""{FEED},
span AS (SELECT max(ord) + 1 AS m FROM feed),
ev AS (
  SELECT ord, url, title, {canonical('url')} AS cu, nullif({title_key('title')}, '') AS tk, ord * {triggers} // m AS part,
    1704067200 + ord * 3456000 // m - CASE WHEN ord % 16 = 5 THEN 1296000 ELSE 0 END AS ts
  FROM feed, span WHERE url <> '' AND title <> '')"""
    ]
    for n in range(triggers):
        mark = f"(SELECT coalesce(max(ts) - {lateness}, 0) FROM ev WHERE part < {n})"
        urls = " UNION ALL ".join(f"SELECT cu, ts FROM u{i}" for i in range(n)) or "SELECT '' AS cu, 0 AS ts WHERE false"
        titles = " UNION ALL ".join(f"SELECT tk, ts FROM t{i}" for i in range(n)) or "SELECT '' AS tk, 0 AS ts WHERE false"
        parts.append(f"""
c{n} AS (SELECT ev.* FROM ev JOIN (SELECT cu, min(ord) AS ord FROM ev WHERE part = {n} AND ts > {mark} GROUP BY cu) USING (cu, ord)),
u{n} AS (SELECT * FROM c{n} WHERE cu NOT IN (SELECT cu FROM ({urls}) WHERE ts + {window} > {mark})),
t{n} AS (
  SELECT * FROM u{n} a WHERE tk IS NULL OR (ord = (SELECT min(ord) FROM u{n} b WHERE b.tk = a.tk)
    AND NOT EXISTS (SELECT 1 FROM ({titles}) k WHERE k.tk = a.tk AND abs(k.ts - a.ts) <= {window})))""")
    return with_(",".join(parts), " UNION ALL ".join(f"SELECT ord, url, title, ts AS published FROM t{n}" for n in range(triggers)))


ORACLE["stream_dedup"] = _stream_dedup()

# --- keyword tables, models in batches, payloads by day ----------------------------------------

ORACLE["keyword_table"] = with_(
    FEED,
    r"""SELECT ord, field, count(*) AS n_keywords, md5(string_agg(lower(keyword), ',' ORDER BY keyword)) AS keywords_md5
FROM (SELECT ord, 'title' AS field, title AS t FROM feed UNION ALL SELECT ord, 'url', url FROM feed)
JOIN (SELECT DISTINCT replace(upper(unnest(regexp_extract_all(lower(text), '([^\s.,!?]+)'))), 'ẞ', 'SS') AS keyword FROM benchmark)
  ON contains(replace(upper(t), 'ẞ', 'SS'), keyword) GROUP BY ord, field""",
)
_ANSWERS = """
hashed AS (SELECT ord, md5(concat_ws(chr(10), title, domain, reasoning)) AS h FROM described),
answers AS (
  SELECT ord, h, CASE WHEN h[1] IN ('0', '1', '2', '3') THEN 'ValueError: no answer'
                      WHEN h[3] = '0' THEN 'unreadable reply' END AS error FROM hashed)"""
ORACLE["scored_in_batches"] = with_(
    DESCRIBED + "," + _ANSWERS,
    """SELECT ord, CASE WHEN error IS NULL AND h[2] < '8' THEN ' yes' ELSE 'NO' END AS is_relevant,
  CASE WHEN error IS NULL THEN h ELSE '' END AS reasoning, error FROM answers""",
)
ORACLE["relevant_in_batches"] = with_(
    DESCRIBED + "," + _ANSWERS, "SELECT ord, h AS reasoning FROM answers WHERE error IS NULL AND h[2] < '8'"
)
ORACLE["landed_window"] = with_(FEED, "SELECT title, url, seendate FROM feed WHERE day >= DATE '2024-01-24'")
ORACLE["landed_days"] = with_(
    FEED,
    """SELECT title, url, seendate FROM feed WHERE day IN (
  SELECT CAST(ts AS DATE) FROM (SELECT *, max(value) OVER (PARTITION BY event_type) AS best FROM events) WHERE value = best)""",
)
