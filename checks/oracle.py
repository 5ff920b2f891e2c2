"""The same answers as plain SQL over the same tables, for an independent engine."""

from __future__ import annotations

from checks.queries import LANGUAGES, MAPPING, RELATED
from matchlake.functions import fixed

SPACE = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
WS, NS = f"[{SPACE}]", f"[^{SPACE}]"
Q = "'"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(c: str, pattern: str, by: str) -> str:
    return f"regexp_replace({c}, {lit(pattern)}, {lit(by)}, 'g')"


def squeeze(c):
    return f"trim({sub(c, WS + '+', ' ')})"


def strip_ends(c):
    return sub(c, f"^{WS}+|{WS}+$", "")


def unescape(c):
    for name, char in [("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">")]:
        c = f"replace({c}, {lit(name)}, {lit(char)})"
    return sub(c, "&amp;?", "&")  # pages also hold the old form without a semicolon


def strip_html(c):
    return squeeze(sub(unescape(f"coalesce({c}, '')"), "<[^>]+>", " "))


def strip_tags(c):
    return strip_ends(sub(f"coalesce({c}, '')", "<[^>]+>", " "))


def clean_text(c):
    c = sub(f"coalesce({c}, '')", f"http{NS}+|www\\.{NS}+", "")
    c = sub(c, f"{NS}+@{NS}+", "")
    return squeeze(sub(c, rf"[^\p{{L}}\p{{N}}_{SPACE}\-/.,;:()&+#]", " "))


def words(c):
    return f"len(list_filter(string_split_regex(coalesce({c}, ''), {lit(WS + '+')}), lambda w: w <> ''))::INTEGER"


def tokens(c, stemmed=False):
    stop = ", ".join(lit(w) for w in fixed.STOPWORDS)
    out = (f"list_filter(regexp_extract_all(lower(coalesce({c}, '')), {lit(fixed.TOKEN_PATTERN)}), "
           f"lambda t: length(t) > 1 and t not in ({stop}))")
    if stemmed:
        pattern = f"^(.{{3,}}?)(?:{'|'.join(fixed.SUFFIXES)})$"
        out = f"list_transform({out}, lambda t: regexp_replace(t, {lit(pattern)}, '\\1'))"
    return out


def category(c):
    whens = " ".join(f"when {' or '.join(f'contains(lower({c}), {lit(w)})' for w in ws)} then {lit(name)}"
                     for name, ws in fixed.TITLE_KEYWORDS)
    return f"case {whens} else 'Other' end"


def link(title, company):
    text = f"case when coalesce({company}, '') <> '' then {title} || ' ' || {company} else {title} end"
    return (f"{lit(fixed.SEARCH_LINK)} || replace(replace(replace(url_encode({text}), '%20', '+'), '%7E', '~'), "
            f"'*', '%2A')")


JOBS = """jobs as (select doc_id as job_id, doc_id, split_part(text, chr(10), 1) as title, text as description,
 source as company, lang as category, text from documents)"""
ITEMS = "q as (select item_id as query_id, text from benchmark)"


# Lexical ----------------------------------------------------------------------------------------

def lexical(fields=(("title", 3.0, 0.3), ("description", 1.0, 0.75))):
    toks = " union all ".join(
        f"select doc_id, '{f}' as field, unnest({tokens(f)}) as term from jobs" for f, _, _ in fields)
    lens = ", ".join(f"coalesce(n_{f}, 0) as dl_{f}" for f, _, _ in fields)
    dls = ", ".join(f"count(*) filter (field = '{f}') as n_{f}" for f, _, _ in fields)
    means = ", ".join(f"avg(dl_{f}) as avg_{f}" for f, _, _ in fields)
    tfs = ", ".join(f"count(*) filter (field = '{f}') as tf_{f}" for f, _, _ in fields)
    hat = " + ".join(f"{w} * tf_{f} / (1 + {b} * (dl_{f} / avg_{f} - 1))" for f, w, b in fields)
    return f"""{JOBS}, toks as materialized ({toks}), lens as materialized (select doc_id, {lens} from jobs left join
   (select doc_id, {dls} from toks group by doc_id) using (doc_id)),
 stats as materialized (select count(*) as n, {means} from lens),
 post as materialized (select term, doc_id, {tfs} from toks group by all),
 terms as materialized (select term, count(*) as df,
   ln(((select n from stats) - count(*) + 0.5) / (count(*) + 0.5) + 1) as idf from post group by term),
 hats as (select term, doc_id, {hat} as tf_hat from post join lens using (doc_id), stats),
 imp as (select term, doc_id, tf_hat, idf, idf * tf_hat / (1.2 + tf_hat) as impact from hats join terms using (term))"""


LEX = lexical()
IMPACTS = f"with {LEX} select term, doc_id, round(tf_hat, 6) as tf_hat, round(impact, 6) as impact from imp"


def ranked(scores, k, out, keys="query_id"):
    return (f"{out} as (select *, (row_number() over (partition by {keys} order by round(score, 9) desc, doc_id))"
            f"::INTEGER as rank from {scores} qualify rank <= {k})")


def lex_scores(queries, name, cap=64):
    return f"""{name}_t as (select query_id, term, df from (select distinct query_id, unnest({tokens('text')}) as term
   from {queries}) join terms using (term)
   qualify row_number() over (partition by query_id order by df, term) <= {cap}),
 {name} as (select query_id, doc_id, sum(impact) as score from {name}_t join imp using (term) group by all)"""


def lex_top(queries, k, name="lex", cap=64):
    return f"{lex_scores(queries, name + '_s', cap)}, {ranked(name + '_s', k, name)}"


# Vectors ----------------------------------------------------------------------------------------

def hashed(source, id_col, text, out):
    return f"""{out}_n as (select {id_col} as id, (('0x' || substr(md5(t), 1, 8))::BIGINT % 64) as i,
   case when ('0x' || substr(md5(t), 9, 1))::BIGINT % 2 = 0 then 1 else -1 end as s
   from (select {id_col}, unnest({tokens(text)}) as t from {source})),
 {out}_s as (select id, i, sum(s)::DOUBLE as v from {out}_n group by all),
 {out} as (select id, i, (v / sqrt(sum(v * v) over (partition by id)))::FLOAT::DOUBLE as v from {out}_s
   qualify sum(v * v) over (partition by id) > 0)"""


def vec_scores(queries, name):
    return f"""{hashed(queries, 'query_id', 'text', name + '_q')},
 {name}_dot as (select a.id as query_id, b.id as doc_id, sum(a.v * b.v) as score
   from {name}_q a join dv b using (i) group by all),
 {name} as (select x.query_id, j.doc_id, coalesce(d.score, 0) as score from {queries} x cross join jobs j
   left join {name}_dot d on d.query_id = x.query_id and d.doc_id = j.doc_id)"""


DOC_VECTORS = hashed("(select doc_id, title || '. ' || title || '. ' || substring(description, 1, 500) as t2 from jobs)",
                     "doc_id", "t2", "dv")


RESUME_VECTORS = hashed("(select doc_id, substring(text, 1, 1000) as t2 from jobs)", "doc_id", "t2", "dv")


def given(c):
    """A cell read back from a CSV: missing-value markers are null."""
    return f"case when trim({c}) in ({', '.join(lit(t) for t in fixed.NA_TOKENS)}) then null else {c} end"


def vec_top(queries, k, name="sem"):
    return f"{vec_scores(queries, name + '_s')}, {ranked(name + '_s', k, name)}"


def fused(k, name="hyb", lex="lex_p", sem="sem_p"):
    def norm(t):
        w = "over (partition by query_id)"
        return (f"select query_id, doc_id, score, case when max(score) {w} = min(score) {w} then 1.0 else "
                f"(score - min(score) {w}) / (max(score) {w} - min(score) {w}) end as s from {t}")
    return f"""{name}_s as (select query_id, doc_id, 0.5 * coalesce(a.s, 0) + 0.5 * coalesce(b.s, 0) as score,
   coalesce(a.score, 0) as bm25f_score, coalesce(b.score, 0) as semantic_score
   from ({norm(lex)}) a full join ({norm(sem)}) b using (query_id, doc_id)), {ranked(name + '_s', k, name)}"""


def hybrid(queries, k):
    return f"{lex_top(queries, 100, 'lex_p')}, {vec_top(queries, 100, 'sem_p')}, {fused(k)}"


OUT = "query_id, doc_id, rank, round(score, 6) as score"
GIVEN = f"""with s as (select a.vec_id as query_id, b.vec_id as doc_id,
  list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) as score from embeddings a, embeddings b),
 {ranked('s', 10, 'r')} select {OUT} from r"""

# Sampling ---------------------------------------------------------------------------------------

H = "md5('42:' || doc_id)"
# The 50 sampled documents: 12 per language in hash order (50 div 4), cut to 50.
PICKED = f"""per as (select greatest(2, 50 // count(distinct lang)) as p from documents),
 sq as (select doc_id as query_id, lang as category, text from (select *, row_number() over
   (partition by lang order by {H}, doc_id) as n from documents, per qualify n <= p) order by {H}, doc_id limit 50)"""
RING = f"ring as (select doc_id, row_number() over (order by {H}, doc_id) - 1 as place from documents)"


def chosen(use, k, n):
    """k distinct numbers below n for a query: each step draws below a rising bound, or takes the bound itself."""
    last = f"({n} - {k} + x[1])"
    drawn = f"(('0x' || substr(md5('42:{use}:' || query_id || ':' || x[1]), 1, 15))::BIGINT % ({last} + 1))"
    return (f"list_reduce(list_transform(range({k}), lambda i: [i]), lambda s, x: list_append(s, "
            f"case when list_contains(s, {drawn}) then {last} else {drawn} end), []::BIGINT[])")


def drawn(queries, k):
    return f"""{RING}, dq as (select query_id, n, least({k}, n)::BIGINT as k from {queries}, (select count(*) as n from documents)),
 dp as (select query_id, unnest({chosen('draw', 'k', 'n')}) as place from dq),
 dr as (select query_id, doc_id, (row_number() over (partition by query_id order by
   md5('42:order:' || query_id || ':' || place), place) - 1)::INTEGER as draw from dp join ring using (place))"""


HALF = f"""laid as (select doc_id, category, row_number() over (order by category, md5('42:' || doc_id), doc_id) - 1 as place
   from jobs), cats as (select category, count(*) as sz, min(place) as off from laid group by 1),
 hq as (select query_id, coalesce(sz, 0)::BIGINT as sz, coalesce(off, 0)::BIGINT as off, (select count(*) from jobs) as n
   from {{queries}} x left join cats using (category)),
 hs as (select *, least({{k}} // 2, sz)::BIGINT as ns, n - sz as rest, least({{k}} - least({{k}} // 2, sz), n - sz)::BIGINT as no from hq),
 hp as (select query_id, true as same, off + unnest({chosen('same', 'ns', 'sz')}) as place from hs
   union all select query_id, false, case when h < off then h else h + sz end from (select query_id, off, sz,
   unnest({chosen('other', 'no', 'rest')}) as h from hs)),
 hd as (select query_id, doc_id, same from hp join laid using (place))"""


def half(queries, k):
    return HALF.replace('{queries}', queries).replace('{k}', str(k))


MAPPED = f"""mq as (select *, case category {' '.join(f"when '{a}' then '{b}'" for a, b in MAPPING.items())}
   else category end as mapped from sq)"""
REL = " or ".join(f"(least(mapped, category) = '{min(p)}' and greatest(mapped, category) = '{max(p)}')" for p in RELATED)
JUDGED = f"""{JOBS}, {PICKED}, {MAPPED}, {drawn('sq', 20)},
 judged as (select query_id, query_category, doc_id, category as doc_category, title as doc_title,
   (case when category = mapped then 3 when {REL} then 1 else 0 end)::INTEGER as relevance
   from dr join (select query_id, category as query_category, mapped from mq) using (query_id)
   join (select doc_id, category, title from jobs) using (doc_id))"""
POOL = f"""{LEX}, {DOC_VECTORS}, {PICKED}, {MAPPED}, {lex_top('sq', 20, 'lp')}, {vec_top('sq', 20, 'vp')},
 pool as (select query_id, doc_id from lp union select query_id, doc_id from vp), {RING},
 nq as (select query_id, n, least(n, 5 + (select count(*) from pool p where p.query_id = sq.query_id))::BIGINT as k
   from sq, (select count(*) as n from documents)),
 np as (select query_id, unnest({chosen('draw', 'k', 'n')}) as place from nq),
 neg as (select query_id, doc_id from (select query_id, doc_id, place from np join ring using (place))
   anti join pool using (query_id, doc_id) qualify row_number() over (partition by query_id
   order by md5('42:order:' || query_id || ':' || place), place) <= 5),
 judged as (select query_id, query_category, doc_id, category as doc_category, title as doc_title,
   (case when category = mapped then 3 else 0 end)::INTEGER as relevance
   from (from pool union all from neg) join (select query_id, category as query_category, mapped from mq)
   using (query_id) join (select doc_id, category, title from jobs) using (doc_id))"""
JUDGED_OUT = "select query_id, query_category, doc_id, doc_category, doc_title, relevance from judged"


# Evaluation -------------------------------------------------------------------------------------

def metrics(run, ks, out):
    """`run(mode, query_id, doc_id, rank)` against `judged`, every judged query in every mode of `modes`."""
    gain = "(pow(2, relevance) - 1) / log2({} + 1)"
    ideal = ", ".join(f"sum(case when i <= {k} then {gain.format('i')} end) as i{k}" for k in ks)
    seen = ", ".join(f"count(*) filter (relevance >= 2 and rank <= {k}) as h{k}, "
                     f"sum(case when rank <= {k} then {gain.format('rank')} end) as d{k}" for k in ks)
    cols = ", ".join(f"coalesce(h{k}, 0) / {k} as p_at_{k}, coalesce(d{k} / nullif(i{k}, 0), 0) as ndcg_at_{k}" for k in ks)
    return f"""{out}_i as (select query_id, {ideal}, count(*) filter (relevance >= 2) as nrel from (select *, row_number()
   over (partition by query_id order by relevance desc, doc_id) as i from judged) group by 1),
 {out}_s as (select mode, query_id, rank, relevance, sum((relevance >= 2)::INT) over (partition by mode, query_id
   order by rank) as hit from {run} join judged using (query_id, doc_id)),
 {out}_g as (select mode, query_id, {seen}, sum(hit / rank) filter (relevance >= 2) as ap from {out}_s group by all),
 {out} as (select m.mode, i.query_id, {cols}, coalesce(ap / nullif(nrel, 0), 0) as ap from {out}_i i cross join modes m
   left join {out}_g g on g.query_id = i.query_id and g.mode = m.mode)"""


KS = (5, 10, 20)
NAMES = [f"{m}_at_{k}" for k in KS for m in ("p", "ndcg")] + ["ap"]
EVAL = f"""{POOL}, {lex_top('sq', 50, 'l50')}, modes as (select 'x' as mode), run as (select 'x' as mode, * from l50),
 {metrics('run', KS, 'm')}"""
REPORT = sorted(NAMES, key=lambda n: "AP" if n == "ap" else n.upper().replace("_AT_", "@"))
MODES = ("bm25f", "semantic", "hybrid")
COMPARE = f"""{POOL}, {lex_top('sq', 10, 'l10')}, {vec_top('sq', 10, 's10')}, {hybrid('sq', 10)},
 modes as (select unnest({list(MODES)}) as mode),
 run as ({' union all '.join(f"select '{m}' as mode, query_id, doc_id, rank from {t}"
                             for m, t in zip(MODES, ('l10', 's10', 'hyb')))}), {metrics('run', (5, 10), 'm')}"""


def label(n):
    return "AP" if n == "ap" else n.replace("_at_", "@").upper()


def by_mode(n):
    return ", ".join(f"round(avg({n}) filter (mode = '{m}'), 6) as {m}" for m in MODES)


CLEAN = f"""with c as (select doc_id as job_id, text, {clean_text(strip_html('text'))} as description_clean,
  {clean_text("split_part(text, chr(10), 1)")} as title_clean, source as company_name from documents),
 w as (select *, {words('description_clean')} as desc_word_count from c)"""
LENGTHS = f"with w as (select {words('text')} as v from documents), p as (select v from w where v > 0)"
PARTS = "p_name || ' ' || p_type"

ORACLE = {
    "strip_html_pages": f"with t as (select page_id, {strip_html('html')} as text from pages) "
                        f"select page_id, text, {words('text')} as words from t",
    "strip_tags_pages": f"with t as (select page_id, {strip_tags('html')} as text from pages) "
                        f"select page_id, text, {words('text')} as words from t",
    "clean_pages": f"select page_id, {clean_text('html')} as text from pages",
    "clean_documents": f"{CLEAN} select job_id, title_clean, description_clean, desc_word_count, company_name, '' as "
                       f"location, {category('title_clean')} as job_category from w where desc_word_count >= 20 "
                       "qualify row_number() over (partition by description_clean order by job_id) = 1",
    "clean_funnel": f"{CLEAN} select count(*) as raw, count(text) as described, "
                    "count(*) filter (desc_word_count >= 20) as long_enough, "
                    "count(distinct description_clean) filter (desc_word_count >= 20) as kept, "
                    "long_enough - kept as removed from w",
    "dedup_documents": "select doc_id, lang from documents qualify row_number() over (partition by text order by doc_id) = 1",
    "lenient_cast": "select o_orderkey, try_cast(case when o_orderstatus = 'P' then o_orderpriority "
                    "when o_orderkey % 7 = 0 then o_orderkey || 'd' when o_orderkey % 7 = 1 then ' 1' || o_orderkey || '.5e1 ' "
                    "else o_orderkey::VARCHAR end as DOUBLE) as max_salary from orders",
    "level_default": "select o_orderkey, case when o_orderpriority = '4-NOT SPECIFIED' then 'Unknown' else "
                     "o_orderpriority end as experience_level from orders",
    "fallback_text": f"""with c as (select doc_id, upper(lang) as cat, {clean_text('text')} as a,
        {clean_text(strip_html('html'))} as b from documents left join pages on page_id = doc_id),
      t as (select doc_id, cat, case when {words('a')} < 10 then b else a end as resume_clean from c),
      w as (select *, {words('resume_clean')} as n from t)
      select doc_id as "ID", resume_clean, n as resume_word_count, cat as "Category" from w where n >= 30""",
    "category_normalise": "select doc_id, upper(lang) as raw_category, case upper(lang) "
                          + " ".join(f"when '{a}' then '{b}'" for a, b in LANGUAGES.items())
                          + " else upper(lang) end as category from documents",
    "classify_title": f"select 'part' as kind, p_partkey as id, {category(f'({PARTS})')} as category from part union all "
                      f"select 'job', doc_id, {category('split_part(text, chr(10), 1)')} from documents",
    "search_link": f"select doc_id as job_id, {link('split_part(text, chr(10), 1)', 'company')} as url from "
                   "(select *, case when lang <> 'fr' then source end as company from documents)",
    "match_label": """with s as (select *, round(o_totalprice / 250000.0, 4) as score from orders)
      select o_orderkey, case when score <= 1 then round((score * 100)::VARCHAR::DECIMAL(38, 20), 1)::DOUBLE::VARCHAR || '% match'
        else round(score::VARCHAR::DECIMAL(38, 20), 3)::DOUBLE::VARCHAR || ' match' end as label,
        case when o_orderstatus = 'P' then 'Unclassified' else o_orderstatus end as category,
        replace(replace(replace(lower(o_orderpriority || ' Co., Ltd.'), ' ', '-'), '.', ''), ',', '') as file from s""",
    "judge_parse": "select o_orderkey, case when o_orderpriority = '4-NOT SPECIFIED' then 0 else "
                   "least(3, left(o_orderpriority, 1)::INTEGER) end::INTEGER as grade from orders",
    "tokens": f"select doc_id, array_to_string({tokens('text')}, ' ') as tokens from documents",
    "tokens_stemmed": f"select doc_id, array_to_string({tokens('text', True)}, ' ') as tokens from documents",
    "delimited_parse": f"""with l as (select ' ' || doc_id || ' :::' || source || '; ;' || lang || ' ; :::' || text as value
        from documents union all select doc_id || ':::' || source from documents where lang = 'es'),
      p as (select p from (select string_split({strip_ends('value')}, ':::') as p from l) where len(p) >= 3),
      t as (select trim(p[1]) as id, {strip_ends('p[2]')} as occupation_str, {strip_tags(strip_ends('p[3]'))} as text,
        list_filter(list_transform(string_split(p[2], ';'), lambda x: trim(x)), lambda x: x <> '') as o from p)
      select id, array_to_string(o, '|') as occupations, occupation_str, text, {words('text')} as word_count,
        len(o)::INTEGER as num_labels from t""",
    "embed_text": f"with {JOBS} select job_id, title || '. ' || title || '. ' || substring(text, 1, 500) as job_text, "
                  "substring(text, 1, 1000) as profile_text, substring(text, 1, 600) as snippet from jobs",
    "postings": f"with {LEX} select term, field, doc_id, count(*)::INTEGER as tf from toks group by all",
    "doc_lengths": f"with {LEX} select doc_id, 'title' as field, dl_title::INTEGER as dl from lens union all "
                   "select doc_id, 'description', dl_description::INTEGER from lens",
    "term_stats": f"with {LEX} select term, df, round(idf, 6) as idf from terms",
    "field_stats": f"with {LEX} select 'title' as field, n as n_docs, round(avg_title, 6) as avgdl from stats union all "
                   "select 'description', n, round(avg_description, 6) from stats",
    "impacts": IMPACTS,
    "index_summary": f"with {LEX} select n as n_docs, (select count(*) from terms) as n_terms from stats",
    "index_jobs": f"with {LEX}, c as (select doc_id, count(*) as n_terms from post group by 1) select doc_id, "
                  "coalesce(n_terms, 0) as n_terms, title, company, '' as location, category, dl_title::INTEGER as "
                  "dl_title, dl_description::INTEGER as dl_description from jobs join lens using (doc_id) "
                  "left join c using (doc_id)",
    "index_resumes": f"with {lexical((('text', 1.0, 0.75),))}, w as (select doc_id, round(sum(impact), 6) as weight "
                     "from imp group by 1) select doc_id, category, substring(text, 1, 600) as text, weight from jobs "
                     "left join w using (doc_id)",
    "index_incremental": IMPACTS, "index_segments": IMPACTS,
    "index_roundtrip": IMPACTS,
    "search_lexical": f"with {LEX}, {ITEMS}, {lex_top('q', 10)} select {OUT}, title, category from lex "
                      "join jobs using (doc_id)",
    "search_lexical_fresh": f"with {LEX}, {ITEMS}, {lex_top('q', 10)} select {OUT} from lex",
    "search_term_cap": f"with {LEX}, {ITEMS}, {lex_top('q', 10, cap=8)} select {OUT} from lex",
    "search_long_queries": f"with {LEX}, q as (select conv_id * 1000 + turn as query_id, text from conversations), "
                           f"{lex_top('q', 5)} select {OUT} from lex",
    "score_pairs": f"""with {LEX}, {ITEMS}, {drawn('q', 20)}, qt as (select query_id, unnest({tokens('text')}) as term
        from q), s as (select query_id, doc_id, sum(impact) as score from dr join qt using (query_id)
        join imp using (term, doc_id) group by all)
      select query_id, doc_id, round(coalesce(score, 0), 6) as score from dr left join s using (query_id, doc_id)""",
    "search_vectors": GIVEN,
    "search_vectors_grid": GIVEN,
    "hashed_vectors": f"with {hashed('documents', 'doc_id', 'text', 'v')}, e as (select doc_id, unnest(range(64)) as i "
                      "from documents) select e.doc_id, e.i::INTEGER as i, round(coalesce(v.v, 0), 6) as v "
                      "from e left join v on v.id = e.doc_id and v.i = e.i",
    "search_hybrid": f"with {LEX}, {DOC_VECTORS}, {ITEMS}, {hybrid('q', 10)} select {OUT}, round(bm25f_score, 6) as "
                     "bm25f_score, round(semantic_score, 6) as semantic_score, title, company, category from hyb "
                     "join jobs using (doc_id)",
    "compare_modes": f"with {LEX}, {DOC_VECTORS}, {ITEMS}, {lex_top('q', 5)}, {vec_top('q', 5)}, {hybrid('q', 5)} "
                     + " union all ".join(f"select '{m}' as mode, {OUT} from {t}"
                                          for m, t in zip(MODES, ("lex", "sem", "hyb"))),
    "match_jobs": f"with {LEX}, {DOC_VECTORS}, {ITEMS}, {hybrid('q', 10)} select query_id, rank, doc_id, title, company, "
                  f"'' as location, category, round(score, 4) as score, {link('title', 'company')} as url from hyb "
                  "join jobs using (doc_id)",
    "match_resumes": f"with {lexical((('text', 1.0, 0.75),))}, {ITEMS}, {lex_top('q', 10)} select query_id, rank, doc_id, "
                     "category, substring(text, 1, 600) as text, round(score, 4) as score from lex join jobs using (doc_id)",
    "match_resumes_hybrid": f"with {lexical((('text', 1.0, 0.75),))}, {RESUME_VECTORS}, {ITEMS}, {hybrid('q', 10)} "
                            "select query_id, rank, doc_id, category, substring(text, 1, 600) as text, "
                            "round(score, 4) as score from hyb join jobs using (doc_id)",
    "csv_postings": f"with {JOBS} select job_id, {given('title')} as title, {given('description')} as description, "
                    f"{given('company')} as company_name from jobs",
    "csv_resumes": f"select doc_id as ID, {given('text')} as Resume_str, {given('lang')} as Category from documents",
    "csv_large_postings": f"""with s as (select url, max(array_to_string(string_split(url, '/')[1:3], '/')) as skills, count(*) as n
      from pages group by url) select url as job_link, {given('html')} as job_title, NULL::VARCHAR as company,
      skills, n from pages join s using (url)""",
    "category_map_roundtrip": "select distinct source as raw, upper(source) as mapped from documents",
    "first_rows": "select doc_id, text from documents order by doc_id limit 100",
    "blank_queries": "select conv_id, turn, text from conversations where text is not null and "
                     f"regexp_matches(text, {lit(NS)})",
    "model_encoder": """with d as (select doc_id, [length(text), length(text) - length(replace(text, 'e', '')),
      length(text) - length(replace(text, 'n', ''))]::DOUBLE[] as v from documents)
      select doc_id, i::INTEGER - 1 as i, round((v[i] / case when list_inner_product(v, v) > 0 then
      sqrt(list_inner_product(v, v)) else 1 end)::FLOAT::DOUBLE, 5) as v from d, range(1, 4) r(i)""",
    "match_streamed": f"with {LEX}, {ITEMS}, {lex_top('q', 10)} select {OUT} from lex",
    "sample_simple": f"select doc_id, lang from documents order by {H}, doc_id limit 100",
    "sample_stratified": f"with {PICKED} select query_id, category from sq",
    "sample_topup": f"""with d as (select doc_id, nullif(lang, 'de') as lang, {H} as h from documents),
      per as (select greatest(1, 500 // count(distinct lang)) as p from d),
      r as (select *, lang is not null and row_number() over (partition by lang order by h, doc_id) <= p as ok from d, per)
      select doc_id, lang from r order by ok desc, h, doc_id limit 500""",
    "candidates_random": f"with {ITEMS}, {drawn('q', 20)} select query_id, doc_id, draw from dr",
    "candidates_looked_up": f"with {ITEMS}, {drawn('q', 20)} select query_id, doc_id, draw from dr",
    "candidates_half": f"with {JOBS}, {PICKED}, {half('sq', 20)} select query_id, doc_id, same from hd",
    "judge_prompts": f"""with {JOBS}, {PICKED}, {half('sq', 6)} select query_id, doc_id,
      replace(replace(replace({lit(fixed.JUDGE_PROMPT)}, '{{job_title}}', j.title), '{{job_description}}',
        substring(j.text, 1, 1000)), '{{resume_text}}', substring(sq.text, 1, 2000)) as prompt
      from hd join sq using (query_id) join jobs j using (doc_id)""",
    **dict.fromkeys(("judgments_graded", "judgments_ledger"), f"""with {JOBS}, {PICKED}, {half('sq', 6)}
      select query_id, sq.category as query_category, doc_id,
      j.category as doc_category, j.title as doc_title, case when contains(sq.text, j.title) then 3 else 0 end as relevance
      from hd join sq using (query_id) join jobs j using (doc_id)"""),
    "judgments_category": f"with {JUDGED} {JUDGED_OUT}",
    "judgments_pooled": f"with {POOL} {JUDGED_OUT}",
    "grade_distribution": f"with {JUDGED} select g::INTEGER as relevance, count(j.relevance) as n, "
                          "round(count(j.relevance) * 100.0 / (select count(*) from judged), 6) as percent "
                          "from range(4) t(g) left join judged j on j.relevance = g group by g",
    "judgments_roundtrip": f"with {JUDGED} select query_id, doc_id, relevance from judged",
    "eval_per_query": f"with {EVAL} select query_id, {', '.join(f'round({n}, 6) as {n}' for n in NAMES)} from m",
    "eval_aggregate": f"with {EVAL} select count(*) as num_queries, round(avg(ap), 6) as map, "
                      + ", ".join(f"round(avg({n}), 6) as mean_{n}, round(stddev_pop({n}), 6) as std_{n}" for n in NAMES)
                      + " from m",
    "eval_report": f"with {EVAL} " + " union all ".join(
        f"select {i}::INTEGER as position, '{label(n)}' as metric, round(avg({n}), 6) as mean, "
        f"round(stddev_pop({n}), 6) as std from m" for i, n in enumerate(REPORT, 1))
        + f" union all select {len(REPORT) + 1}, 'MAP', round(avg(ap), 6), null from m",
    "eval_compare": f"with {COMPARE} " + " union all ".join(
        f"select '{'MAP' if n == 'ap' else label(n)}' as metric, {by_mode(n)} from m"
        for n in ("p_at_5", "p_at_10", "ndcg_at_5", "ndcg_at_10", "ap")),
    "corpus_sizes": """with s as (select 'jobs' as kind, 'documents' as dataset, (select count(*) from documents) as n
        union all select 'jobs', 'pages', (select count(*) from pages)
        union all select 'resumes', 'conversations', (select count(*) from conversations)
        union all select 'resumes', 'absent', 0)
      select coalesce(kind, 'all') as kind, coalesce(dataset, 'all') as dataset, sum(n)::BIGINT as n from s
      group by rollup (kind, dataset)""",
    "length_histogram": f"""{LENGTHS}, e as (select min(v) as lo, max(v) as hi from p),
      b as (select least((v - lo) * 60 // (hi - lo), 59) as bin, count(*) as n from p, e group by 1)
      select r.bin::INTEGER as bin, round(lo + r.bin * (hi - lo) / 60, 6) as low,
        round(lo + (r.bin + 1) * (hi - lo) / 60, 6) as high, coalesce(n, 0) as n
      from range(60) r(bin) left join b using (bin), e""",
    "length_stats": f"{LENGTHS} select count(*) as n, floor(median(v))::BIGINT as median, floor(avg(v))::BIGINT as mean from p",
    "html_lengths": f"with t as (select page_id, {strip_tags('html')} as text from pages) select page_id, "
                    f"{words('text')} as word_count from t",
    "category_counts": "select lang as value, count(*) as n from documents group by 1",
    "top_terms": f"select value, count(*) as n from (select {strip_ends('v')} as value from (select "
                 "unnest(string_split(text, ',')) as v from documents)) where value <> '' group by 1 "
                 "order by n desc, value limit 20",
    "level_counts": "select o_orderpriority as value, count(*) as n from orders where o_orderpriority <> "
                    "'4-NOT SPECIFIED' group by 1",
    "distinct_categories": "select distinct lang as category from documents",
}
