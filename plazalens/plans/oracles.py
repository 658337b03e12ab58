"""The same results as SQL over the same tables, following the defining rules step by step (joins first, then counts)."""

import string

from plazalens.plans.queries import ANCHORED_PATTERN, BATCHES, CAPTURED_AGAIN, FOLLOWED, INSULTS, KEYWORDS, LOADS, MALFORMED_EVERY, POST_INSULTS, SEPARATOR, WORD_PATTERN
from plazalens.plans.stand_in import GROUPS, VIEWS

_TABLES = ("orders", "lineitem", "supplier", "part", "documents")


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _view(name: str) -> str:
    return VIEWS[name].replace("`", '"').format(**{t: t for t in _TABLES})


def _with(*names: str, more: str = "") -> str:
    return "with " + ", ".join(f"{n} as ({_view(n)})" for n in names) + (f", {more}" if more else "") + " "


def _joined(x: str) -> str:
    return f"array_to_string({x}, {_q(SEPARATOR)})"


def _clean(x: str) -> str:
    x = f"regexp_replace(lower({x}), '@\\S+', '', 'g')"
    x = f"trim(regexp_replace(regexp_replace({x}, '[[:punct:]]', ' ', 'g'), '\\s+', ' ', 'g'))"
    x = f"strip_accents(regexp_replace({x}, '[0-9]', '', 'g'))"
    for letter in string.ascii_lowercase:
        x = f"regexp_replace({x}, '{letter}{letter}+', '{letter}', 'g')"
    return x


def _model_text(source: str) -> str:
    """Query: id, cleaned; ``source`` is a query with id and text, entities already resolved."""
    return f"""
      select id, trim(case when u like '@%' then j else substr(j, 2) end) cleaned from (
        select id, u, array_to_string(list_transform(list_filter(string_split(u, '@'), lambda e: e <> ''),
                                      lambda e: '@' || trim(e)), ' ') j from (
          select id, replace(replace(regexp_replace(text, 'http\\S+', '[URL]', 'g'), chr(10), ' '), chr(9), ' ') u
          from ({source})))"""


# ---------------------------------------------------------------- summaries

_ABUSE_INSULTS = "ai as (select ab.id, ab.abuse, ins.insult from ab left join ins on ab.id = ins.id)"
_MENTIONS = """mh as (
  select tw.id, date_trunc('hour', tw.ts) "Hour", m.influencer_id, m.tweet_type from tw left join (
    select men.id, seed.influencer_id, case when t.rt is null then 'original' else 'rt' end tweet_type
    from men left join seed on men.mention = seed.mention left join tw t on men.id = t.id) m on tw.id = m.id)"""
_MENTION_COUNTS = """
  count(*)::bigint "N_mentions", (count(*) filter (abuse = 1))::bigint "N_abuse",
  (count(*) filter (tweet_type = 'original'))::bigint "N_mentions_orig", (count(*) filter (tweet_type = 'rt'))::bigint "N_mentions_rt",
  (count(*) filter (abuse = 1 and tweet_type = 'original'))::bigint "N_abuse_orig",
  (count(*) filter (abuse = 1 and tweet_type = 'rt'))::bigint "N_abuse_rt\""""


def _hour(x: str = '"Hour"') -> str:
    return f'{x}::timestamp "Hour"'


_SUMMARIES = {
    "mentions_abuse_summary": _with("tw", "men", "seed", "ab", "ins", more=f"{_ABUSE_INSULTS}, {_MENTIONS}")
    + f"""select {_hour()}, influencer_id, {_MENTION_COUNTS} from mh left join ai on mh.id = ai.id
          where influencer_id is not null group by "Hour", influencer_id""",
    "mentions_abuse_distinct": _with("tw", "men", "seed", "ab", more=_MENTIONS)
    + f"""select {_hour()}, influencer_id, {_MENTION_COUNTS} from (
            select distinct mh.id, "Hour", influencer_id, tweet_type, abuse from mh left join ab on mh.id = ab.id)
          where influencer_id is not null group by "Hour", influencer_id""",
    "hashtags_summary": _with("tw", "men", "seed", "hsh", more=_MENTIONS)
    + f"""select {_hour()}, influencer_id, hashtag "Hashtag", count(*)::bigint "N_hashtags" from mh join hsh on mh.id = hsh.id
          where influencer_id is not null and hashtag is not null group by "Hour", influencer_id, hashtag""",
    "insults_summary": _with("tw", "men", "seed", "ab", "ins", more=f"{_ABUSE_INSULTS}, {_MENTIONS}")
    + f"""select {_hour()}, influencer_id, insult "Insults", count(*)::bigint "N_abuse" from mh join ai on mh.id = ai.id
          where influencer_id is not null and insult is not null group by "Hour", influencer_id, insult""",
    "subcategory_summary": _with("tw", "men", "seed", "ab", "ins", "cat", more=f"{_ABUSE_INSULTS}, {_MENTIONS}")
    + f"""select {_hour()}, influencer_id, "Subcategoría", count(*)::bigint "N_abuse" from mh join ai on mh.id = ai.id
          left join cat on ai.insult = cat."Insulto" where influencer_id is not null and insult is not null
          and "Subcategoría" is not null group by "Hour", influencer_id, "Subcategoría\"""",
    "users_abuse_summary": _with("tw", "ab", "ins", more=_ABUSE_INSULTS)
    + f""", n as (select date_trunc('hour', ts) "Hour", user_id, count(*) n, count(*) filter (rt is null) o, count(rt) r
            from tw group by 1, 2),
          a as (select date_trunc('hour', ts) "Hour", user_id, count(*) n, count(*) filter (rt is null) o, count(rt) r
            from tw join ai on tw.id = ai.id where abuse = 1 group by 1, 2)
          select n."Hour"::timestamp "Hour", n.user_id, n.n::bigint "N_user", coalesce(a.n, 0)::bigint "N_user_abuse",
            n.o::bigint "N_user_original", n.r::bigint "N_user_rt", coalesce(a.o, 0)::bigint "N_user_abuse_original",
            coalesce(a.r, 0)::bigint "N_user_abuse_rt" from n left join a on n."Hour" = a."Hour" and n.user_id = a.user_id""",
    "abuse_insults": _with("ab", "ins") + "select ab.id, abuse, insult from ab left join ins on ab.id = ins.id",
    "author_abuse": _with("tw", "ab", "ins", more=_ABUSE_INSULTS)
    + "select ai.id, abuse, insult, user_id, rt rt_from_user_id from ai left join tw on ai.id = tw.id",
}

# ---------------------------------------------------------------- posts

_WORDS = "list_filter([" + ", ".join(
    f"case when regexp_matches(text_clean, {_q(w)}) then regexp_extract(text_clean, {_q(w)}) end" for w, _ in KEYWORDS
) + "], lambda w: w is not null)"
_POSTS = f"""
s as (select s_suppkey k, s_nationkey % 2 = 0 f, case when s_suppkey % 31 = 5 then '#' else '' end || 'seed' || s_suppkey h,
        case when s_suppkey % 29 <> 0 then 'id_' || (s_suppkey + 1000) end sid from supplier),
sl as (select list(h) filter (f) fl, list(h) filter (not f) ml, list(sid) filter (sid is not null) il from s),
p0 as (select o_orderkey k, o_custkey c, o_orderpriority pr, o_orderstatus = 'P' is_rt, o_orderkey % 5 = 0 own_reply,
         o_orderstatus = 'P' and o_orderkey % 5 <> 0 and o_orderkey % 7 = 0 rt_reply,
         o_orderdate + (o_orderkey % 24) * interval '1' hour + interval '7' minute ts, o_orderstatus st from orders),
p1 as (select *,
    case when is_rt then 'RT uno' || chr(10) || 'dos @Seed' || ((k + 1) % 90) || ' #viva tontón ' || pr
           || case when k % 10 = 0 then ' y más' else '' end
         else 'Él dijo ' || pr || '¡NO!! @Seed' || (k % 90) || ' y @SEED' || ((k * 7 + 3) % 120) || ' #' || st
           || ' #Ñandú, sooo ' || k || ' &amp; http://t.example/' || k || ' colección'
           || case when k % 11 = 0 then ' tontín' else '' end || case when k % 13 = 0 then ' bobo bobo' else '' end
           || case when k % 3 = 0 then ' (más)' else '' end end text,
    case when is_rt then [ 'Seed' || ((k + case when k % 10 = 0 then 2 else 1 end) % 90) ]
         else list_sort(['Seed' || (k % 90), 'SEED' || ((k * 7 + 3) % 120)]) end mentions,
    case when own_reply then 'id_' || (k % 150 + 1000) when rt_reply then 'id_' || (k % 140 + 1000) end reply_to,
    k % 9 = 0 or (is_rt and k % 8 = 0) is_quote from p0),
p2 as (select *, {_clean("text")} text_clean, list_filter(mentions, lambda m: list_contains(fl, lower(m))) f_seed,
    list_filter(mentions, lambda m: list_contains(ml, lower(m))) m_seed, list_contains(il, reply_to) to_seed from p1, sl),
p3 as (select *, {_WORDS} kw,
    case when reply_to is not null then to_seed else len(f_seed) + len(m_seed) > 0 end target from p2),
posts as (select 'id_' || k id, 'User' || c screen_name, 'id_' || c user_id, text, text_clean,
    case when is_rt then 'User' || (c + 1) end rt_from_screen_name, case when is_rt then 'id_' || (c + 1) end rt_from_user_id,
    case when is_rt then 'id_' || (k + 900000000) end rt_from_id,
    case when k % 9 = 0 then 'Quoted' || (k % 50) when is_rt and k % 8 = 0 then 'Inner' end qt_from_screen_name,
    case when k % 36 = 0 then 'long quote ' || k when k % 18 = 0 then 'short quote' when k % 9 = 0 then 'full quote'
         when is_rt and k % 8 = 0 then 'inner quote' end qt_status,
    case when own_reply then 'seed' || (k % 150) when rt_reply then 'Replied' end in_reply_to_screen_name,
    reply_to in_reply_to_user_id,
    case when own_reply then 'id_' || (k - 1) when rt_reply then 'id_' || (k + 1) end in_reply_to_status_id,
    mentions, f_seed, m_seed, (len(f_seed) > 0)::int directed_at_f, (len(m_seed) > 0)::int directed_at_m,
    regexp_extract_all(text, '#\\S+') hashtags, ts::timestamp datetime,
    case when k % 20 = 0 then '{{"country":"UY"}}' end "location",
    case when reply_to is not null and is_quote then 'reply_with_quote' when reply_to is not null then 'reply'
         when is_quote then 'quote' else 'standalone' end tweet_type,
    kw keywords, target or len(kw) > 0 valid, target, k, c, is_rt, own_reply from p3)"""
_ARRAYS = ("mentions", "f_seed", "m_seed", "hashtags", "keywords")
_TIDY = (
    "id screen_name user_id text text_clean rt_from_screen_name rt_from_user_id rt_from_id qt_from_screen_name qt_status "
    "in_reply_to_screen_name in_reply_to_user_id in_reply_to_status_id mentions f_seed m_seed directed_at_f directed_at_m "
    "hashtags datetime location tweet_type keywords valid"
).split()


def _posts(*columns: str, where: str = "true") -> str:
    cols = ", ".join(f"{_joined(c)} {c}" if c in _ARRAYS else f'"{c}"' for c in columns)
    return f"with {_POSTS} select {cols} from posts where {where}"


_DIRECTED = "valid and directed_at_f = 1"
_POST_QUERIES = {
    "tidy_posts": _posts(*_TIDY),
    "tidy_posts_joined": _posts(*_TIDY),
    "tweet_type": _posts("id", "tweet_type"),
    "reply_fallback": _posts("id", "in_reply_to_screen_name", "in_reply_to_user_id", "in_reply_to_status_id"),
    "retweet_override": _posts("id", "text", "mentions", "rt_from_screen_name", "rt_from_user_id", "rt_from_id"),
    "quote_fields": _posts("id", "qt_from_screen_name", "qt_status"),
    "directed_flags": _posts("id", "f_seed", "m_seed", "directed_at_f", "directed_at_m"),
    "keyword_hits": _posts("id", "text_clean", "keywords"),
    "valid_flag": _posts("id", "valid"),
    "seed_target": f"with {_POSTS} select id, case when target then true end valid from posts",
    "only_female_posts": _posts("id", "f_seed", "directed_at_f", where="directed_at_f = 1"),
    "raw_projection": _posts("id", "text", "datetime", "user_id", "keywords", "valid"),
    "raw_projection_untracked": f"""with {_POSTS} select id, text, datetime, user_id, null::varchar keywords,
        case when target then true end valid from posts""",
    "directed_posts": _posts(
        "datetime", "id", "user_id", "screen_name", "text", "text_clean", "f_seed", "m_seed", "hashtags", where=_DIRECTED
    ),
    "post_counts": f"""with {_POSTS} select count(*)::bigint n_posts, sum(directed_at_f)::bigint n_female,
        sum(directed_at_m)::bigint n_male from posts where valid""",
    "dedup_posts": _posts("id", "user_id", "tweet_type"),
    "author_rows": _posts("user_id", "id", "rt_from_user_id"),
    "bridge_hashtags": f"with {_POSTS} select unnest(hashtags) hashtag, id from posts",
    "bridge_mentions": f"""with {_POSTS}, m as (select id, unnest(f_seed) mention, is_rt from posts)
        select case when s_suppkey % 29 <> 0 then 'id_' || (s_suppkey + 1000) end influencer_id, id,
          case when is_rt then 'rt' else 'original' end tweet_type
        from m left join supplier on m.mention = 'Seed' || s_suppkey""",
    "quarantine": f"""select '{{"id": ' || o_orderkey || ', oops' line from orders where o_orderkey % {MALFORMED_EVERY} = 0""",
    "capture_filter": f"""with {_POSTS} select k::varchar id from posts where c between {FOLLOWED[0]} and {FOLLOWED[-1]}
        or (own_reply and k % 150 + 1000 between {FOLLOWED[0]} and {FOLLOWED[-1]})
        or regexp_matches(text, '(?i)@(seed7|seed11)([\\s.,;:!?()=\\[\\]-]|$)|tont[oó]n')""",
    "capture_enrich": f"""with {_POSTS} select k::varchar id, k::bigint id_num, strftime(datetime, '%d/%m/%y') date,
        strftime(datetime, '%Y-%m-%dT%H:%M:%S.%f') || '0Z' datetime from posts""",
    "created_at_parse": f"with {_POSTS} select k::varchar id, datetime ts from posts",
    "hour_trunc": "select event_id, date_trunc('hour', ts)::timestamp \"hour\" from events",
}
_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S') || case when ts = date_trunc('second', ts) then '' else '.' || strftime(ts, '%f') end || '+00:00'"
_FEED = f"""select event_id id, event_type text, user_id author_id, {_ISO} created_at, strftime(ts, '%Y-%m-%d') date,
    {_ISO} datetime from events"""
_POST_QUERIES |= {
    "v2_flatten": _FEED,
    "capture_filter_flat": f"""select id, author_id, text from ({_FEED}) where author_id between 10 and 19
        or text like '%err%' or text like '%sign_p%'""",
    "file_hours": """select distinct 'output-' || strftime(ts, '%d-%m-%Y-%H') || '.jsonl' file_name,
        date_trunc('hour', ts)::timestamp file_hour,
        date_diff('second', date_trunc('hour', ts), timestamp '2024-02-01 00:30:00') / 3600.0::double age_hours
        from events where date_trunc('hour', ts) < timestamp '2024-01-31 23:30:00'""",
}

# ---------------------------------------------------------------- text

_DOCS = f"docs as (select doc_id id, {_clean('text')} text from documents)"
_MODEL_TEXTS = f"mt as ({_model_text('select id, replace(text, chr(38) || ' + _q('amp;') + ', chr(38)) as text from txt')})"
_HANDLED = _MODEL_TEXTS + ", " + f"""h as (select mt.id, cleaned, coalesce({{}}) token, regexp_extract(cleaned, '^@(Seed[0-9]+)', 1) handle
    from mt left join supplier on lower(regexp_extract(cleaned, '^@(Seed[0-9]+)', 1)) = 'seed' || s_suppkey and s_suppkey % 31 <> 5)""".format(
    f"case s_suppkey % 3 when 0 then '{GROUPS[0]}' when 1 then '{GROUPS[1]}' when 2 then '{GROUPS[2]}' end, null"
)
_SWAPPED = "sw as (select *, case when token is null then cleaned else token || substr(cleaned, length(handle) + 2) end swapped from h)"


def _reprefixed(x: str) -> str:
    x = f"regexp_replace({x}, '@\\S+', 'USER', 'g')"
    for token in (*GROUPS, "USER"):
        x = f"replace({x}, '{token}', '@{token}')"
    return x


_TOKEN_MAP = _with("txt", more=f"{_HANDLED}, {_SWAPPED}") + f"select id, {_reprefixed('swapped')} replaced from sw"


def _lists(rows: list) -> dict[str, str]:
    named = ("FS", "FP", "US", "IS", "IP", "MP")
    keep = {
        "all": lambda r: r[2] != "Exclude",
        "fiu": lambda r: r[2] in named,
        "female": lambda r: r[3] == "F",
        "male": lambda r: r[3] == "M",
        "expressions": lambda r: r[2] == "Exclude",
        "exclusions": lambda r: r[2] in ("MS", "MP"),
    }
    return {name: _q("|".join(r[1] for r in rows if test(r))) for name, test in keep.items()}


def _names(words: str, rows: list) -> str:
    entries: dict[str, str] = {}
    for r in rows:
        if r[2] in ("FS", "FP", "US", "IS", "IP", "MP"):
            entries[r[1]] = r[4]
    whens = " ".join(f"when regexp_matches(w, {_q(p)}) then {_q(n)}" for p, n in entries.items())
    return f"list_filter(list_transform({words}, lambda w: case {whens} end), lambda w: w is not null)"


def _cut(x: str, hits: str) -> str:
    return f"case when len({hits}) > 0 then regexp_replace({x}, array_to_string({hits}, '|'), '', 'g') else {x} end"


def _extract(source: str, rows: list) -> str:
    """CTEs ending in ``found``; ``source`` has id, text_clean, abuse, m_seed_n."""
    p = _lists(rows)
    return f"""
    e0 as (select *, regexp_extract(text_clean, {p['all']}) insults_search from {source}),
    e1 as (select *, regexp_extract_all(text_clean, {p['expressions']}) ex, regexp_extract_all(text_clean, {p['exclusions']}) not_f
           from e0 where insults_search <> '' and abuse = 1),
    e2 as (select *, {_cut('text_clean', 'ex')} cut from e1),
    e3 as (select *, {_cut('cut', 'not_f')} text_filtered from e2),
    e4 as (select *, regexp_extract_all(text_filtered, {p['female']}) female_insults,
           regexp_extract_all(text_filtered, {p['fiu']}) fiu_insults from e3),
    found as (select *, {_names('fiu_insults', rows)} insults_name from e4
           where len(female_insults) > 0 or (len(fiu_insults) > 0 and m_seed_n = 0))"""


_ABUSIVE_DOCS = _DOCS + ", ad as (select id, text text_clean, id % 2 m_seed_n, case when id % 3 < 2 then 1 else 0 end abuse from docs)"
_FIU = _lists(INSULTS)["fiu"]
_HTML = "select page_id id, replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&') as text from pages"
_TEXT = {
    "strip_accents": _with("txt") + "select id, strip_accents(text) stripped from txt",
    "clean_text": _with("txt") + f"select id, {_clean('text')} cleaned from txt",
    "clean_model_text": _with("txt", more=_MODEL_TEXTS) + "select id, cleaned from mt",
    "clean_html_text": _model_text(_HTML),
    "hashtags": _with("txt") + f"select id, {_joined(chr(39).join(['regexp_extract_all(text, ', '#' + chr(92) + 'S+', ')']))} hashtags from txt",
    "find_all": f"with {_DOCS} select id, {_joined(f'regexp_extract_all(text, {_q(WORD_PATTERN)})')} hits from docs",
    # hits never reach over a blank, so each word is searched and cut for itself; only the text's first word begins at a start
    "find_all_rescan": f"""with recursive {_DOCS},
        ws as (select id, unnest(string_split(text, ' ')) w, generate_subscripts(string_split(text, ' '), 1) i from docs),
        cut(w, first, hits, rest, p) using key (w, first) as (
          select distinct w, i = 1, '', w, case when i = 1 then {_q(ANCHORED_PATTERN)} else {_q(ANCHORED_PATTERN.removesuffix('|^de'))} end from ws
          union
          select w, first, hits || '{SEPARATOR}' || regexp_extract(rest, '^(.*?)(' || p || ')(.*)$', 2),
            regexp_extract(rest, '^(.*?)(' || p || ')(.*)$', 3), {_q(ANCHORED_PATTERN)}
          from cut where regexp_matches(rest, p)),
        h as (select id, coalesce(substr(string_agg(hits, '' order by i), 2), '') hits from ws join cut on cut.w = ws.w and first = (i = 1) group by id)
        select id, hits from docs left join h using (id)""",
    "first_hit": f"with {_DOCS} select id, regexp_extract(text, {_q(WORD_PATTERN)}) hit from docs",
    "remove_hits": f"""with {_DOCS}, f as (select id, text, regexp_extract_all(text, {_q(WORD_PATTERN)}) hits from docs)
        select id, {_cut('text', 'hits')} filtered from f""",
    "token_map": _TOKEN_MAP,
    "token_map_joined": _TOKEN_MAP,
    "mention_tokens": _with("txt", more=f"{_HANDLED}, {_SWAPPED}")
    + "select id, "
    + ", ".join(f"case when token = '{t}' then '@' || handle else '' end {t}" for t in GROUPS)
    + f""", {_joined(chr(39).join(['regexp_extract_all(swapped, ', '@' + chr(92) + 'S+', ')']))} "USER" from sw""",
    "first_match": f"""with {_DOCS}, f as (select id, regexp_extract_all(text, {_FIU}) words from docs)
        select id, {_joined(_names('words', INSULTS))} names from f""",
    "document_keywords": f"with {_DOCS} select id, {_joined(_WORDS.replace('text_clean', 'text'))} keywords from docs",
    "extract_insults": f"with {_ABUSIVE_DOCS}, {_extract('ad', INSULTS)} select id, insults_search, text_filtered, "
    + ", ".join(f"{_joined(c)} {c}" for c in ("not_f", "female_insults", "fiu_insults", "insults_name")) + " from found",
    "bridge_insults": f"with {_ABUSIVE_DOCS}, {_extract('ad', INSULTS)} select unnest(insults_name) insult, id from found",
    "extract_male_insults": f"""with {_ABUSIVE_DOCS},
        m0 as (select *, regexp_extract(text_clean, {_lists(INSULTS)['male']}) insults_search,
               regexp_extract_all(text_clean, {_lists(INSULTS)['expressions']}) not_m from ad),
        m1 as (select *, {_cut('text_clean', 'not_m')} text_filtered from m0 where insults_search <> ''),
        m2 as (select *, regexp_extract_all(text_filtered, {_lists(INSULTS)['male']}) male_insults from m1)
        select id, insults_search, {_joined('not_m')} not_m, text_filtered, {_joined('male_insults')} male_insults
        from m2 where len(male_insults) > 0""",
    "classify_words": _with("txt", more=_MODEL_TEXTS) + r""", w as (
          select id, unnest(regexp_extract_all(lower(cleaned), '[^\x20\x09-\x0D]+')) word from mt),
        d as (select mt.id, toxic from mt join labels on doc_id = mt.id where toxic in (0, 1)),
        c as (select word, count(*) filter (toxic = 0) n0, count(*) filter (toxic = 1) n1 from d join w using (id) group by word),
        t as (select sum(n0) t0, sum(n1) t1, count(*) v from c),
        m as (select word, round(1000000 * (ln((n1 + 1) / (t1 + v)::double) - ln((n0 + 1) / (t0 + v)::double)))::bigint weight from c, t),
        p as (select round(1000000 * ln(count(*) filter (toxic = 1) / (count(*) filter (toxic = 0))::double))::bigint prior from d),
        s as (select id, sum(weight) score from w join m using (word) group by id)
        select mt.id, case when cleaned is not null then (coalesce(score, 0) + prior > 0)::int end abuse from mt left join s using (id), p""",
    "classify_posts": """select doc_id id, (case when length(text) % 7 >= greatest(length(text) % 5, length(text) % 3) then 0
        when length(text) % 5 >= length(text) % 3 then 1 else 2 end)::int abuse from documents""",
    "argmax_class": "select vec_id, (list_position(embedding, list_max(embedding)) - 1)::int \"class\" from embeddings",
}

# ---------------------------------------------------------------- dictionary and seeds

_SEEDS = f"""seeds as (select case when s_suppkey % 29 <> 0 then (s_suppkey + 1000)::varchar end user_id,
    case when s_suppkey % 31 = 5 then '#' else '' end || 'seed' || s_suppkey screen_name, 'seed' || s_suppkey screen_name_orig,
    ['{GROUPS[0]}', '{GROUPS[1]}', '{GROUPS[2]}'][s_suppkey % 3 + 1] tipo, s_name, floor(s_acctbal)::int fc,
    (s_suppkey % 100)::int fr, s_suppkey ord from supplier)"""


def _agg(where: str) -> str:
    return f"coalesce(string_agg(regex3, '|' order by ord) filter ({where}), '')"


_DICTIONARY = {
    "dictionary_lists": _with("dict")
    + f"""select {_agg("target <> 'Exclude'")} insults_all, {_agg("target in ('FS','FP','US','IS','IP','MP')")} insults_fiu,
          {_agg("gender = 'F'")} insults_female, {_agg("gender = 'M'")} insults_male,
          {_agg("target = 'Exclude'")} expressions, {_agg("target in ('MS','MP')")} exclusions from dict""",
    "dictionary_map": """with d as (select lower(p_brand) regex3, p_partkey ord, p_name || '/' || p_type orig_name,
          ['FS','FP','US','IS','IP','MP','MS','Exclude'][p_size % 8 + 1] target from part)
        select regex3, min(ord) ord, arg_max(orig_name, ord) "name", arg_max(target, ord) target from d
        where target in ('FS','FP','US','IS','IP','MP') group by regex3""",
    "not_in_null_safe": _with("cat")
    + """select * from cat where "Categoría" is null or "Categoría" <> 'Criticas al ejercicio de su profesión'""",
    "category_table": _with("cat")
    + """select "Insulto", "Insulto_gendered", "Categoría" "Categoria", "Subcategoría" "Subcategoria" from cat
         where "Categoría" is null or "Categoría" <> 'Criticas al ejercicio de su profesión'""",
    "seed_metadata": f"""with {_SEEDS} select screen_name, s_name "Nombre", tipo "Tipo", fc followers_count, fr friends_count,
        'id_' || user_id user_id from seeds""",
    "seed_files": f"""with {_SEEDS} select user_id, screen_name, tipo "Tipo", fc followers_count,
        (row_number() over (order by ord) - 1)::bigint ord from seeds""",
    "distinct_tokens": f"with {_SEEDS} select distinct tipo token from seeds",
    "seed_pages": """select c_custkey::varchar user_id, c_custkey ord,
        ((row_number() over (order by c_custkey) - 1) // 400)::bigint page_no from customer where c_custkey % 13 <> 0""",
    "handle_pages": """select c_name screen_name, c_custkey ord,
        ((row_number() over (order by c_custkey) - 1) // 400)::bigint page_no from customer""",
    "tracking_words": """select '@seed' || s_suppkey word from supplier where s_suppkey % 31 <> 5
        union all select distinct w from (select unnest(string_split(text, ' ')) w from benchmark) where w <> ''""",
    "handle_map": """select o_custkey user_id, replace(arg_max('@' || o_orderpriority, o_orderkey), '@', '') screen_name
        from orders group by o_custkey""",
    "seed_upsert": f"""with {_SEEDS}, a as (select (o_custkey + 1000)::varchar user_id,
          case when o_orderstatus = 'F' then 'Neo' else 'Seed' end || o_custkey h,
          o_orderdate + (o_orderkey % 86400) * interval '1' second t from orders),
        l as (select * from a qualify row_number() over (partition by user_id order by t desc, h desc) = 1)
        select s.user_id, case when lower(h) <> screen_name then lower(h) else screen_name end screen_name,
          case when lower(h) <> screen_name then h else screen_name_orig end screen_name_orig,
          case when lower(h) <> screen_name then strftime(t, '%Y-%m-%d %H:%M:%S') end updated, ord
        from seeds s left join l on s.user_id = l.user_id""",
}

# ---------------------------------------------------------------- the hourly run on posts

_ENRICHED = f"""{_POSTS},
    dp as (select *, len(m_seed) m_seed_n, (text_clean like '%bobo%' or text_clean like '%tonton%')::int abuse
           from posts where {_DIRECTED}),
    {_extract('dp', POST_INSULTS)},
    en as (select dp.*, found.insults_name from dp left join found on dp.id = found.id),
    inf as (select 'Seed' || s_suppkey mention, 'id_' || (s_suppkey + 1000) influencer_id from supplier where s_suppkey % 29 <> 0),
    ei as (select id, unnest(case when len(insults_name) > 0 then insults_name else [null] end) insult from en),
    em as (select en.id, date_trunc('hour', datetime) "Hour", user_id, abuse, hashtags,
           case when is_rt then 'rt' else 'original' end tweet_type, unnest(f_seed) mention from en),
    mi as (select em.*, influencer_id from em join inf on em.mention = inf.mention)"""
_HOURLY = {
    "model_text": f"""with {_POSTS}, src as (select id, replace(text, '&amp;', '&') as text from posts where {_DIRECTED}),
        mt as ({_model_text('select id, text from src')}),
        parts as (select id, unnest(regexp_extract_all(cleaned, '[\\s.,;:!?()\\-=\\[\\]]+|[^\\s.,;:!?()\\-=\\[\\]]+')) part,
          generate_subscripts(regexp_extract_all(cleaned, '[\\s.,;:!?()\\-=\\[\\]]+|[^\\s.,;:!?()\\-=\\[\\]]+'), 1) pos from mt),
        named as (select id, pos, coalesce(case s_suppkey % 3 when 0 then '{GROUPS[0]}' when 1 then '{GROUPS[1]}' when 2 then '{GROUPS[2]}' end,
          part) part from parts left join supplier on lower(part) = '@seed' || s_suppkey and s_suppkey % 31 <> 5)
        select id, {_reprefixed("string_agg(part, '' order by pos)")} replaced_text from named group by id""",
    "enriched_posts": f"""with {_ENRICHED} select id, datetime, user_id, {_joined('f_seed')} f_seed, {_joined('hashtags')} hashtags,
        abuse, {_joined('insults_name')} insults_name from en""",
    "hourly_mentions": f"""with {_ENRICHED} select {_hour()}, influencer_id, {_MENTION_COUNTS}
        from mi left join ei on mi.id = ei.id group by "Hour", influencer_id""",
    "hourly_hashtags": f"""with {_ENRICHED}, t as (select "Hour", influencer_id, unnest(hashtags) h from mi)
        select {_hour()}, influencer_id, h "Hashtag", count(*)::bigint "N_hashtags" from t group by "Hour", influencer_id, h""",
    "hourly_insults": f"""with {_ENRICHED} select {_hour()}, influencer_id, insult "Insults", count(*)::bigint "N_abuse"
        from mi join ei on mi.id = ei.id where insult is not null group by "Hour", influencer_id, insult""",
    "hourly_subcategories": f"""with {_ENRICHED} select {_hour()}, influencer_id,
          case insult when 'n-bobo' then 'sub-2' else 'sub-1' end "Subcategoría", count(*)::bigint "N_abuse"
        from mi join ei on mi.id = ei.id where insult is not null group by 1, 2, 3""",
    "hourly_users": f"""with {_ENRICHED}, n as (select date_trunc('hour', datetime) "Hour", user_id, count(*) n,
          count(*) filter (not is_rt) o, count(*) filter (is_rt) r from en group by 1, 2),
        a as (select date_trunc('hour', datetime) "Hour", user_id, count(*) n, count(*) filter (not is_rt) o,
          count(*) filter (is_rt) r from en join ei on en.id = ei.id where abuse = 1 group by 1, 2)
        select n."Hour"::timestamp "Hour", n.user_id, n.n::bigint "N_user", coalesce(a.n, 0)::bigint "N_user_abuse",
          n.o::bigint "N_user_original", n.r::bigint "N_user_rt", coalesce(a.o, 0)::bigint "N_user_abuse_original",
          coalesce(a.r, 0)::bigint "N_user_abuse_rt" from n left join a on n."Hour" = a."Hour" and n.user_id = a.user_id""",
}

_STREAMS = {
    "stream_summary": f"""select * from ({_SUMMARIES['mentions_abuse_summary']})
        where "Hour" + interval '1 hour' <= (select max(o_orderdate + (o_orderkey % 24) * interval '1' hour
          + interval '7' minute) from orders where o_orderkey in (select l_orderkey from lineitem
          join supplier on s_suppkey = l_suppkey where s_nationkey % 2 = 0)) - interval '1 hour'""",
    "stream_dedup": _with("tw", "ab") + "select distinct ab.id, abuse from ab join tw on tw.id = ab.id",
    "stream_capture": f"""with {_POSTS} select k::varchar id, k::bigint id_num, strftime(datetime, '%d/%m/%y') date,
        strftime(datetime, '%Y-%m-%dT%H:%M:%S.%f') || '0Z' datetime from posts where c between {FOLLOWED[0]} and {FOLLOWED[-1]}
        or (own_reply and k % 150 + 1000 between {FOLLOWED[0]} and {FOLLOWED[-1]})
        or regexp_matches(text, '(?i)@(seed7|seed11)([\\s.,;:!?()=\\[\\]-]|$)|tont[oó]n')""",
    "stream_handles": f"""with {_SEEDS}, l as (select o_custkey::varchar user_id, max(o_orderdate
            + (o_orderkey % 24) * interval '1' hour + interval '7' minute) t from orders group by 1)
        select s.ord::varchar user_id, case when t is null then screen_name else 'user' || s.ord end screen_name,
          case when t is null then screen_name_orig else 'User' || s.ord end screen_name_orig,
          strftime(t, '%Y-%m-%d %H:%M:%S') updated, ord from seeds s left join l on s.ord::varchar = l.user_id""",
    "stream_hourly_run": _HOURLY["hourly_mentions"],
    "stream_hourly_batches": _HOURLY["hourly_mentions"],
    "stream_hourly_hashtags": _HOURLY["hourly_hashtags"],
    "stream_hourly_insults": _HOURLY["hourly_insults"],
    "stream_hourly_subcategories": _HOURLY["hourly_subcategories"],
    "stream_hourly_users": _HOURLY["hourly_users"],
    "stream_hourly_raw": f"with {_POSTS} select id, datetime, user_id, {_joined('keywords')} keywords, valid from posts",
    "stream_sources": f"""select (select count(*)::bigint from orders, unnest(range({LOADS})) b(part)
        where o_orderkey % {LOADS} = part or o_orderkey % {CAPTURED_AGAIN} = part) posts, {LOADS}::bigint commits""",
    "stream_summary_late": _SUMMARIES["mentions_abuse_summary"],
    "stream_summary_closed": f"""select * from ({_SUMMARIES['mentions_abuse_summary']}) where "Hour" + interval '1 hour' <= (
        select max(o_orderdate + (o_orderkey % 24) * interval '1' hour + interval '7' minute) from orders
        where o_orderkey in (select l_orderkey from lineitem)) - interval '1 hour'""",
    "stream_dedup_batches": _with("tw", "ab")
    + "select distinct ab.id, 'p' || strftime(ts, '%Y') period from ab join tw on tw.id = ab.id",
    "stream_late_posts": _with("tw", "ab", more=f"""p as (
          select tw.id, ts, case when tw.id % {BATCHES} = {BATCHES - 1} then 0 else tw.id % {BATCHES} end part from tw join ab on tw.id = ab.id),
        n as (select f.part, max(ts) - interval '1 hour' closed from (select distinct part from p) f join p on p.part < f.part group by f.part)""")
    + """select date_trunc('hour', ts)::timestamp "Hour", count(*)::bigint posts from p join n using (part)
         where date_trunc('hour', ts) + interval '1 hour' <= closed group by 1""",
}

ORACLES: dict[str, str] = _SUMMARIES | _POST_QUERIES | _TEXT | _DICTIONARY | _HOURLY | _STREAMS

# The same results by way of an index
ORACLES |= {f"{name}_indexed": ORACLES[name] for name in ("token_map", "document_keywords", "extract_insults")}
