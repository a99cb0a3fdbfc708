"""DuckDB oracle SQL for the registered queries.

Each statement restates the operator's definition in plain SQL over the driver tables (pre-registered as
views with the table names). The fixture views of FIXTURES.md are spelled out as CTEs below.
"""

from __future__ import annotations

RESOURCES_V = """resources_v as (
  select l_orderkey as id, l_linenumber as seq, p_name as description,
         l_quantity as quantity, p_retailprice as price
  from lineitem join part on l_partkey = p_partkey)"""

PROJECTS_V = """projects_v as (
  select o_orderkey as id, o_custkey as teacher_id, c_mktsegment as teacher_prefix, n_name as school_state,
         o_orderpriority as project_grade_category,
         concat(c_mktsegment, ', ', o_orderpriority) as project_subject_categories,
         o_orderdate as project_submitted_datetime,
         case when o_orderstatus = 'F' then 0 else 1 end as project_is_approved
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""

ESSAYS_V = """essays_v as (
  select d.doc_id as id, lang, source, n_chars, l.quality as project_is_approved,
         string_split(text, chr(10))[1] as project_title,
         string_split(text, chr(10))[2] as project_essay_1,
         string_split(text, chr(10))[3] as project_essay_2,
         string_split(text, chr(10))[4] as project_essay_3,
         string_split(text, chr(10))[5] as project_essay_4,
         string_split(text, chr(10))[6] as project_resource_summary,
         case when len(string_split(text, chr(10))) > 6
              then array_to_string(string_split(text, chr(10))[7:], chr(10)) end as description
  from documents d left join labels l on d.doc_id = l.doc_id)"""

SCORES_V = """scores_v as (
  select model, id, cast(score as double) as score from (
    select 'm1' as model, doc_id as id, (n_chars % 1000) / 1000.0 as score from documents
    union all select 'm2', doc_id, ((doc_id * 7919) % 1000) / 1000.0 from documents
    union all select 'm3', doc_id, ((doc_id * 104729 + n_chars) % 997) / 997.0 from documents))"""

TEXT_COLS = ["project_title", "project_essay_1", "project_essay_2", "project_essay_3",
             "project_essay_4", "project_resource_summary", "description"]

# Unicode word character, as Python's str regex \w: letters, marks, digits, connector punctuation.
W = r"[\p{L}\p{M}\p{N}\p{Pc}]"


def clean(expr: str) -> str:
    """Lowercase, keep runs of >= 3 word characters, join by one space (null -> '')."""
    return f"array_to_string(regexp_extract_all(lower(coalesce({expr}, '')), '{W}{{3,}}'), ' ')"


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


ORACLES: dict[str, str] = {}

ORACLES["resource_rollup"] = with_(RESOURCES_V) + """
select id,
       string_agg(coalesce(cast(description as varchar), 'nan'), chr(10) order by seq, description) as description,
       round(sum(price * quantity), 2) as total_price,
       max(price) as max_price, min(price) as min_price, round(avg(price), 6) as mean_price,
       sum(quantity) as quantity
from resources_v group by id"""

ORACLES["project_enrich"] = with_(RESOURCES_V, PROJECTS_V) + """
select p.id, p.teacher_prefix, p.school_state, p.project_grade_category, p.project_subject_categories,
       p.project_is_approved, r.description, r.total_price, r.mean_price, r.quantity
from projects_v p left join (
  select id, string_agg(coalesce(cast(description as varchar), 'nan'), chr(10) order by seq, description) as description,
         round(sum(price * quantity), 2) as total_price, round(avg(price), 6) as mean_price,
         sum(quantity) as quantity
  from resources_v group by id) r on p.id = r.id"""

ORACLES["line_total"] = with_(RESOURCES_V) + """
select id, seq, description, round(price * quantity, 6) as total_price from resources_v"""

NOT_SPACE_OR_WORD = (r"[^\p{L}\p{M}\p{N}\p{Pc}\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                     r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
ESSAYS = TEXT_COLS[1:5]

ORACLES["calendar_labels"] = with_(PROJECTS_V) + """
select id, strftime(project_submitted_datetime, '%b_%Y') as monthofyear,
       dayname(project_submitted_datetime) as dayofweek from projects_v"""

ORACLES["clean_text"] = with_(ESSAYS_V) + "select id, " + ", ".join(
    f"{clean(c)} as {c}" for c in TEXT_COLS) + " from essays_v"

CLEANED = "cleaned as (select id, project_is_approved, " + ", ".join(
    f"{clean(c)} as {c}" for c in TEXT_COLS) + " from essays_v)"

ORACLES["concat_text"] = with_(ESSAYS_V, CLEANED) + """
select id, concat_ws('. ', project_essay_1, project_essay_2, project_essay_3, project_essay_4) as all_essays,
       concat_ws('. ', project_title,
                 concat_ws('. ', project_essay_1, project_essay_2, project_essay_3, project_essay_4),
                 project_resource_summary, description) as all_text
from cleaned"""

ORACLES["concat_raw"] = with_(ESSAYS_V) + "select id, " + " || ".join(
    f"coalesce({c}, 'nan')" for c in ["lang", "source", "project_title", "project_resource_summary", *ESSAYS]
) + " as project_desc from essays_v"


def sent_len(c: str) -> str:
    t = f"coalesce({c}, '')"
    return (f"(len(regexp_extract_all({t}, '[.!?]+([ \\t\\n\\f\\r]|\\z)')) + "
            f"case when not regexp_matches(rtrim({t}), '[.!?]\\z') and regexp_matches({t}, '{W}') "
            f"then 1 else 0 end)")


ORACLES["sentence_count"] = with_(ESSAYS_V) + "select id, " + ", ".join(
    f"{sent_len(c)} as {c}_sent_len" for c in ESSAYS) + " from essays_v"

ORACLES["word_count"] = with_(ESSAYS_V) + "select id, " + ", ".join(
    f"len(regexp_extract_all(coalesce({c}, ''), '{W}+|{NOT_SPACE_OR_WORD}')) as {c}_word_len"
    for c in ESSAYS) + " from essays_v"

ORACLES["null_fill"] = with_(ESSAYS_V) + "select id, " + ", ".join(
    f"coalesce({c}, '') as {c}" for c in TEXT_COLS) + " from essays_v"

ORACLES["null_literal"] = with_(ESSAYS_V) + """
select id, coalesce(project_essay_3, 'nan') as project_essay_3, coalesce(description, 'nan') as description
from essays_v"""

ORACLES["numeric_coerce"] = with_(ESSAYS_V) + """
select id, cast(n_chars as double) as n_chars, try_cast(project_title as double) as title_num from essays_v"""

ORACLES["split_by_presence"] = with_(ESSAYS_V) + """
select id, project_is_approved,
       case when project_essay_3 is not null and project_essay_3 <> '' then 'present' else 'absent' end as part
from essays_v"""

ORACLES["feature_select"] = with_(RESOURCES_V, PROJECTS_V) + """
select p.id, p.project_is_approved, r.total_price, r.max_price, r.quantity,
       coalesce(p.teacher_prefix, 'Teacher') as teacher_prefix, p.school_state, p.project_grade_category,
       p.project_subject_categories, dayname(p.project_submitted_datetime) as dayofweek,
       strftime(p.project_submitted_datetime, '%b_%Y') as monthofyear, r.description
from projects_v p left join (
  select id, string_agg(coalesce(cast(description as varchar), 'nan'), chr(10) order by seq, description) as description,
         round(sum(price * quantity), 2) as total_price, max(price) as max_price, sum(quantity) as quantity
  from resources_v group by id) r on p.id = r.id"""

ORACLES["nan_safe_sigmoid"] = with_(SCORES_V) + """
select model, id, round(1.0 / (1.0 + exp(-(case when isnan((score - 0.5) * 10.0) then 0.0
                                           else (score - 0.5) * 10.0 end))), 6) as prob
from scores_v"""

ORACLES["strip_accents"] = "select doc_id, strip_accents(text) as text from documents"

ORACLES["path_label"] = """
select page_id, lower(regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1)) as label from pages"""

LONG_TEXT = "long_text as (" + " union all ".join(
    f"select id, '{c}' as field, {c} as text from cleaned" for c in TEXT_COLS) + ")"
TOKS = "toks as (select id, field, token from (select id, field, unnest(string_split(text, ' ')) as token " \
       "from long_text) where token <> '')"
LEXICON_V = """lexicon_v as (select token, length(token) % 8 as class,
  (length(token) % 5 - 2) / 2.0 as polarity, (length(token) % 3) / 2.0 as subjectivity
  from (select distinct token from toks where length(token) % 7 <> 6))"""


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _keywords_sql() -> str:
    from tessera.operators.lexicon import REFERENCE_KEYWORDS, TEST_CORPUS_KEYWORDS
    return ", ".join(_sql_str(k) for k in REFERENCE_KEYWORDS + TEST_CORPUS_KEYWORDS)


ORACLES["keyword_counts"] = with_(ESSAYS_V, CLEANED, LONG_TEXT, TOKS) + f"""
select id, field, token as keyword, count(*) as count from toks
where token in ({_keywords_sql()}) group by id, field, token"""

ORACLES["token_class_counts"] = with_(ESSAYS_V, CLEANED, LONG_TEXT, TOKS, LEXICON_V) + """
select t.id, t.field, cast(l.class as varchar) as class, count(*) as count
from toks t join lexicon_v l on t.token = l.token group by t.id, t.field, l.class"""

def half_up(x: str, digits: int) -> str:
    """Round half up on the shortest decimal form of a double (the engine's rounding rule; Python's
    round works on the binary value and goes down on e.g. 0.285)."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38, 12)), {digits}) as double)"


ORACLES["lexicon_score"] = with_(ESSAYS_V, CLEANED, LONG_TEXT, TOKS, LEXICON_V) + f"""
select e.id, {half_up('coalesce(s.polarity, 0)', 2)} as polarity,
       {half_up('coalesce(s.subjectivity, 0)', 2)} as subjectivity
from essays_v e left join (
  select t.id, avg(l.polarity) as polarity, avg(l.subjectivity) as subjectivity
  from toks t join lexicon_v l on t.token = l.token
  where t.field in ('project_essay_1', 'project_essay_2', 'project_essay_3', 'project_essay_4')
  group by t.id) s on e.id = s.id"""

_NONWORD = r"[^\p{L}\p{M}\p{N}\p{Pc}]"
_pairs = [(a, b) for i, a in enumerate(TEXT_COLS[:-1]) for b in TEXT_COLS[i + 1:]]
ORACLES["pairwise_overlap"] = with_(ESSAYS_V, CLEANED) + "select id, " + ", ".join(
    f"len(list_distinct(list_filter(string_split_regex({a}, '{_NONWORD}'), "
    f"lambda x: list_contains(string_split_regex({b}, '{_NONWORD}'), x)))) as {a}_{b}_common"
    for a, b in _pairs) + " from cleaned"

PROJECT_CATS = ["teacher_prefix", "school_state", "project_grade_category", "project_subject_categories",
                "dayofweek", "monthofyear"]
PROJECTS_CAL = """projects_cal as (select *, dayname(project_submitted_datetime) as dayofweek,
  strftime(project_submitted_datetime, '%b_%Y') as monthofyear from projects_v)"""
CAT_LONG = "cat_long as (" + " union all ".join(
    f"select id, '{c}' as feature, cast({c} as varchar) as value from projects_cal" for c in PROJECT_CATS) + ")"
CAT_INDEX = """cat_index as (select feature, value, row_number() over (partition by feature order by value) - 1 as index
  from (select distinct feature, value from cat_long where value is not null))"""
FEATURE_POS = "feature_pos as (select * from (values " + ", ".join(
    f"('{c}', {i})" for i, c in enumerate(PROJECT_CATS)) + ") t(feature, pos))"

ORACLES["category_index"] = with_(PROJECTS_V, PROJECTS_CAL, CAT_LONG, CAT_INDEX) + \
    "select feature, value, index from cat_index"

ORACLES["one_hot"] = with_(PROJECTS_V, PROJECTS_CAL, CAT_LONG, CAT_INDEX, FEATURE_POS) + """,
sizes as (select i.feature, p.pos, count(*) as n from cat_index i join feature_pos p using (feature) group by all),
offsets as (select feature, coalesce(sum(n) over (order by pos rows between unbounded preceding and 1 preceding), 0) as off
            from sizes)
select l.id, l.feature, cast(o.off + i.index as integer) as slot
from cat_long l join cat_index i on l.feature = i.feature and l.value = i.value join offsets o on o.feature = l.feature"""

ORACLES["multi_hot"] = with_(PROJECTS_V) + """,
items as (select id, feature, unnest(list_distinct(list_transform(string_split(lower(v), ','), lambda t: trim(t)))) as value
          from (select id, 'project_subject_categories' as feature, project_subject_categories as v from projects_v
                union all select id, 'teacher_prefix', teacher_prefix from projects_v)),
vocab as (select feature, value, row_number() over (partition by feature order by value) - 1 as index
          from (select distinct feature, value from items))
select i.id, i.feature, v.index from items i join vocab v using (feature, value)"""

ORACLES["target_encode"] = with_(ESSAYS_V) + """,
long as (select id, project_is_approved as y, 'lang' as feature, lang as value from essays_v
         union all select id, project_is_approved, 'source', source from essays_v),
prior as (select avg(project_is_approved) as p from essays_v where project_is_approved is not null),
stats as (select feature, value, count(*) as n, avg(y) as m from long where y is not null and value is not null
          group by all)
select l.id, l.feature,
       round(case when s.n is null or s.n = 1 then (select p from prior)
                  else (select p from prior) * (1 - 1 / (1 + exp(-(s.n - 1)))) + s.m / (1 + exp(-(s.n - 1))) end, 6)
       as encoded
from long l left join stats s on l.feature = s.feature and l.value = s.value"""

ORACLES["minmax_fit"] = with_(RESOURCES_V) + """,
r as (select id, price * quantity as total_price, price, quantity from resources_v),
g as (select id, sum(total_price) as total_price, max(price) as max_price, min(price) as min_price,
             avg(price) as mean_price, sum(quantity) as quantity from r group by id)
select 'total_price' as feature, round(min(total_price), 2) as min_value, round(max(total_price), 2) as max_value from g
union all select 'max_price', min(max_price), max(max_price) from g
union all select 'min_price', min(min_price), max(min_price) from g
union all select 'mean_price', min(mean_price), max(mean_price) from g
union all select 'quantity', min(quantity), max(quantity) from g"""


def _word_len(c):
    return f"cast(len(regexp_extract_all(coalesce({c}, ''), '{W}+|{NOT_SPACE_OR_WORD}')) as double)"


_ESSAY_NUM = {"n_chars": "cast(n_chars as double)", **{f"{c}_word_len": _word_len(c) for c in ESSAYS}}
ORACLES["minmax_scale"] = with_(ESSAYS_V) + ", num as (select id, project_is_approved, " + ", ".join(
    f"{e} as {n}" for n, e in _ESSAY_NUM.items()) + " from essays_v),\n" + \
    "b as (select " + ", ".join(f"min({n}) as {n}_lo, max({n}) as {n}_hi" for n in _ESSAY_NUM) + \
    " from num where project_is_approved is not null)\nselect id, " + ", ".join(
    f"round(({n} - {n}_lo) / case when {n}_hi = {n}_lo then 1 else {n}_hi - {n}_lo end, 6) as {n}"
    for n in _ESSAY_NUM) + " from num, b"

_CONT = ["total_price", "quantity", "mean_price"]
_terms = ["1.0"] + [f"s_{c}" for c in _CONT] + [
    f"s_{a} * s_{b}" for i, a in enumerate(_CONT) for b in _CONT[i:]]
ORACLES["poly2"] = with_(RESOURCES_V, PROJECTS_V) + """,
g as (select id, sum(price * quantity) as total_price, sum(quantity) as quantity, avg(price) as mean_price
      from resources_v group by id),
e as (select p.id, g.total_price, g.quantity, g.mean_price from projects_v p left join g on p.id = g.id),
b as (select """ + ", ".join(f"min({c}) as {c}_lo, max({c}) as {c}_hi" for c in _CONT) + """ from e),
s as (select id, """ + ", ".join(
    f"({c} - {c}_lo) / case when {c}_hi = {c}_lo then 1 else {c}_hi - {c}_lo end as s_{c}" for c in _CONT) + \
    """ from e, b)
""" + " union all ".join(f"select id, {k} as slot, round({t}, 6) as value from s" for k, t in enumerate(_terms))

from tessera.operators.tfidf import default_stop_words  # noqa: E402
from tessera.operators.vocab import SEQUENCE_FILTERS  # noqa: E402

ALL_TEXT = """all_text_v as (select id, project_is_approved,
  concat_ws('. ', project_title, concat_ws('. ', project_essay_1, project_essay_2, project_essay_3, project_essay_4),
            project_resource_summary, description) as all_text from cleaned)"""
KTOKS = ("ktoks as (select id, pos, token from (select id, unnest(t) as token, unnest(range(1, len(t) + 1)) as pos "
         "from (select id, list_filter(string_split(translate(lower(all_text), " + _sql_str(SEQUENCE_FILTERS) + ", "
         + _sql_str(" " * len(SEQUENCE_FILTERS)) + "), ' '), lambda x: x <> '') as t from all_text_v)))")
KVOCAB = ("kvocab as (select token, count(*) as count, row_number() over (order by count(*) desc, token) as rank "
          "from ktoks group by token)")
KSEQ = ("kseq as (select a.id, coalesce(string_agg(cast(v.rank as varchar), ' ' order by k.pos), '') as seq, "
        "list(v.rank order by k.pos) filter (where v.rank is not null) as l "
        "from all_text_v a left join ktoks k on a.id = k.id left join kvocab v on k.token = v.token "
        "group by a.id)")
WV = ("wv as (select t.token as word, e.embedding as vec from (select token, row_number() over "
      "(order by count(*) desc, token) as rank from toks group by token) t join embeddings e on e.vec_id = t.rank - 1)")


def vec_text(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda v: printf('%.6f', cast(v as double))), ' ')"


TEXT_BASE = (ESSAYS_V, CLEANED, ALL_TEXT)

ORACLES["token_vocab"] = with_(*TEXT_BASE, KTOKS, KVOCAB) + "select token, count, rank from kvocab"

ORACLES["token_sequences"] = with_(*TEXT_BASE, KTOKS, KVOCAB, KSEQ) + "select id, seq from kseq"

ORACLES["pad_sequences"] = with_(*TEXT_BASE, KTOKS, KVOCAB, KSEQ) + """,
tail as (select id, case when len(coalesce(l, [])) > 300 then l[len(l) - 299:] else coalesce(l, []) end as t from kseq)
select id, array_to_string(list_concat(list_transform(range(300 - len(t)), lambda x: 0), t), ' ') as seq from tail"""

EMB_MATRIX = ("ematrix as (select 0 as row, null as token, list_transform(range(64), lambda x: cast(0 as float)) as vec "
              "union all select v.rank as row, v.token, coalesce(w.vec, list_transform(range(64), lambda x: cast(0 as float))) "
              "from kvocab v left join wv w on w.word = v.token)")

ORACLES["embedding_matrix"] = with_(*TEXT_BASE, LONG_TEXT, TOKS, KTOKS, KVOCAB, WV, EMB_MATRIX) + \
    f"select row, token, {vec_text('vec')} as vec from ematrix"

ORACLES["doc_vectors"] = with_(*TEXT_BASE, LONG_TEXT, TOKS, KTOKS, KVOCAB, WV, EMB_MATRIX) + """,
seqtok as (select k.id, v.rank from ktoks k join kvocab v on k.token = v.token),
n as (select id, count(*) as n from seqtok group by id),
dims as (select s.id, d.dim, sum(m.vec[d.dim + 1]) as s from seqtok s join ematrix m on m.row = s.rank
         cross join (select unnest(range(64)) as dim) d group by s.id, d.dim)
select dims.id, dims.dim, round(dims.s / n.n, 6) as value from dims join n on dims.id = n.id"""

ORACLES["vec_text_scan"] = with_(ESSAYS_V, CLEANED, LONG_TEXT, TOKS, WV) + \
    f"select word, {vec_text('vec')} as vec from wv"

ORACLES["embedding_store"] = f"select vec_id, {vec_text('embedding')} as vec from embeddings"
ORACLES["path_label_drop"] = """select doc_id, cast(doc_id as varchar) as stem, lower(substr(source, 4)) as label from documents"""


def hex_number(text: str, digits: int) -> str:
    """The number that the first hex digits of a text's MD5 stand for."""
    return "(" + " + ".join(f"(instr('0123456789abcdef', substr(md5({text}), {i + 1}, 1)) - 1) * {16 ** (digits - 1 - i)}"
                            for i in range(digits)) + ")"


ORACLES["kfold_hash"] = with_(PROJECTS_V) + \
    f"select id, cast({hex_number("cast(id as varchar) || '-0-0'", 7)} % 5 as integer) as fold from projects_v"
ORACLES["hash_split"] = with_(PROJECTS_V) + \
    f"select id, case when {hex_number("cast(id as varchar) || '-233'", 7)} % 1000000 < 800000 then 'train' else 'valid' end as part from projects_v"
ORACLES["embed_text"] = with_(ESSAYS_V, CLEANED, LONG_TEXT, TOKS) + f""",
e as (select id, list_position([{', '.join(_sql_str(c) for c in TEXT_COLS)}], field) - 1 as c, {hex_number('token', 8)} % 64 as b,
             case when substr(md5(token), 9, 1) < '8' then 1.0 else -1.0 end as s from toks),
v as (select id, c * 64 + b as slot, c, sum(s) as v from e group by id, c, b),
n as (select *, sqrt(sum(v * v) over (partition by id, c)) as l2 from v)
select id, cast(slot as integer) as slot, round(v / l2, 6) as value from n where v <> 0"""

ORACLES["embedding_scan"] = f"select vec_id, label, {vec_text('embedding')} as vec from embeddings"

STOP_SQL = "[" + ", ".join(_sql_str(w) for w in default_stop_words()) + "]"
ATOKS = (f"atoks as (select id, project_is_approved, list_filter(regexp_extract_all(strip_accents(lower(all_text)), "
         f"'{W}+'), lambda t: not list_contains({STOP_SQL}, t)) as t from all_text_v)")


def grams(n_max: int) -> str:
    parts = [f"list_transform(range(1, len(t) + {2 - n}), lambda i: array_to_string(t[i:i + {n - 1}], ' '))"
             for n in range(1, n_max + 1)]
    return f"list_concat({', '.join(parts)})" if len(parts) > 1 else parts[0]


def tf_cte(name: str, n_max: int, where: str = "true") -> str:
    return (f"{name} as (select id, term, count(*) as tf from (select id, unnest({grams(n_max)}) as term "
            f"from atoks where {where}) group by id, term)")


ORACLES["stopword_ngrams"] = with_(*TEXT_BASE, ATOKS, tf_cte("tf2", 2)) + "select id, term, tf from tf2"

ORACLES["term_stats"] = with_(*TEXT_BASE, ATOKS, tf_cte("tf2", 2)) + \
    "select term, count(*) as df, sum(tf) as ttf from tf2 group by term"

ORACLES["top_terms"] = with_(*TEXT_BASE, ATOKS, tf_cte("tf3", 3)) + """
select term, df, ttf from (select term, count(*) as df, sum(tf) as ttf from tf3 group by term)
where df >= 5 and df <= 0.9 * (select count(*) from all_text_v)
order by ttf desc, term limit 400"""

ORACLES["tfidf"] = with_(*TEXT_BASE, ATOKS, tf_cte("tr", 3, "project_is_approved is not null"),
                         tf_cte("alltf", 3)) + """,
n as (select count(*) as n from all_text_v where project_is_approved is not null),
voc as (select term, ln((1 + (select n from n)) / (1 + df)) + 1 as idf from (
          select term, count(*) as df, sum(tf) as ttf from tr group by term)
        where df >= 5 and df <= 0.9 * (select n from n) order by ttf desc, term limit 10000),
w as (select id, term, (1 + ln(tf)) * idf as w from alltf join voc using (term))
select id, term, round(w / sqrt(sum(w * w) over (partition by id)), 6) as weight from w"""

TEXT_LIMITS = {"project_title": 400, "all_essays": 5000, "project_resource_summary": 400}
TEXT3 = ("text3 as (select id, project_is_approved, project_title, project_resource_summary, "
         "concat_ws('. ', project_essay_1, project_essay_2, project_essay_3, project_essay_4) as all_essays from cleaned)")


def column_tfidf(c: str, limit: int) -> str:
    """TF-IDF rows ``w_<c>(id, term, weight)`` of one column, with its vocabulary ``voc_<c>``."""
    return (f"t_{c} as (select id, list_filter(regexp_extract_all(strip_accents(lower(coalesce({c}, ''))), '{W}+'), "
            f"lambda t: not list_contains({STOP_SQL}, t)) as t from text3),\n"
            f"tf_{c} as (select id, term, count(*) as tf from (select id, unnest({grams(3)}) as term from t_{c}) group by id, term),\n"
            f"voc_{c} as (select term, row_number() over (order by term) - 1 as index, idf from (select term, "
            f"ln((1 + (select count(*) from text3)) / (1 + df)) + 1 as idf from (select term, count(*) as df, sum(tf) as ttf "
            f"from tf_{c} group by term) where df >= 5 and df <= 0.9 * (select count(*) from text3) order by ttf desc, term limit {limit})),\n"
            f"r_{c} as (select id, term, index, (1 + ln(tf)) * idf as w from tf_{c} join voc_{c} using (term)),\n"
            f"w_{c} as (select id, term, index, w / sqrt(sum(w * w) over (partition by id)) as weight from r_{c})")


TFIDF3 = [column_tfidf(c, n) for c, n in TEXT_LIMITS.items()]
ORACLES["tfidf_columns"] = with_(ESSAYS_V, CLEANED, TEXT3, *TFIDF3) + " union all ".join(
    f"select id, '{c}' as column, term, round(weight, 6) as weight from w_{c}" for c in TEXT_LIMITS)

_NUM = list(_ESSAY_NUM)
_NUM_TERMS = ["1.0"] + [f"s{i}" for i in range(len(_NUM))] + [f"s{i} * s{j}" for i in range(len(_NUM)) for j in range(i, len(_NUM))]
ORACLES["feature_matrix"] = with_(ESSAYS_V, CLEANED, TEXT3, *TFIDF3) + """,
n1 as (select count(*) as n from voc_project_title), n2 as (select count(*) as n from voc_all_essays), n3 as (select count(*) as n from voc_project_resource_summary),
tr as (select * from essays_v where project_is_approved is not null),
hot as (select feature, value, row_number() over (order by feature, value) - 1 as slot from (
          select distinct 'lang' as feature, lang as value from tr where lang is not null
          union select distinct 'source', source from tr where source is not null)),
cats as (select id, project_is_approved as y, 'lang' as feature, lang as value from essays_v union all select id, project_is_approved, 'source', source from essays_v),
o1 as (select (select n from n1) + (select n from n2) + (select n from n3) as ofs),
o2 as (select (select ofs from o1) + (select count(*) from hot) as ofs),
prior as (select avg(project_is_approved) as p from tr),
stats as (select feature, value, count(*) as n, avg(y) as m from cats where y is not null and value is not null group by all),
items as (select distinct id, y, value from (select id, project_is_approved as y, unnest(list_transform(string_split(lower(concat_ws(', ', lang, source)), ','), lambda t: trim(t))) as value from essays_v)),
tags as (select value, row_number() over (order by value) - 1 as index from (select distinct value from items where y is not null)),
o3 as (select (select ofs from o2) + 2 as ofs),
o4 as (select (select ofs from o3) + (select count(*) from tags) as ofs),
num as (select id, project_is_approved, """ + ", ".join(f"{e} as x{i}" for i, e in enumerate(_ESSAY_NUM.values())) + """ from essays_v),
b as (select """ + ", ".join(f"min(x{i}) as lo{i}, max(x{i}) as hi{i}" for i in range(len(_NUM))) + """ from num where project_is_approved is not null),
sc as (select id, """ + ", ".join(f"(x{i} - lo{i}) / case when hi{i} = lo{i} then 1 else hi{i} - lo{i} end as s{i}" for i in range(len(_NUM))) + """ from num, b),
m as (select id, index as slot, weight as value from w_project_title
  union all select id, (select n from n1) + index, weight from w_all_essays
  union all select id, (select n from n1) + (select n from n2) + index, weight from w_project_resource_summary
  union all select c.id, (select ofs from o1) + h.slot, 1.0 from cats c join hot h on c.feature = h.feature and c.value = h.value
  union all select c.id, (select ofs from o2) + case c.feature when 'lang' then 0 else 1 end,
    case when s.n is null or s.n = 1 then (select p from prior) else (select p from prior) * (1 - 1 / (1 + exp(-(s.n - 1)))) + s.m / (1 + exp(-(s.n - 1))) end
    from cats c left join stats s on c.feature = s.feature and c.value = s.value
  union all select i.id, (select ofs from o3) + t.index, 1.0 from items i join tags t on i.value = t.value
""" + "".join(f"  union all select id, (select ofs from o4) + {k}, {t} from sc\n" for k, t in enumerate(_NUM_TERMS)) + """)
select id, cast(slot as integer) as slot, round(value, 6) as value from m where value <> 0"""

for _job in ("linear_score", "gbt_score", "gbt_kfold_score", "mlp_score"):
    ORACLES[f"{_job}_check"] = with_(ESSAYS_V) + """
select case when project_is_approved is null then 'test' else 'train' end as set, id, true as ok from essays_v
union all select 'auc', -1, true"""
for _job in ("rf_score", "split_train_merge"):  # fitted without every fourth id
    ORACLES[f"{_job}_check"] = with_(ESSAYS_V) + """
select case when project_is_approved is null or id % 4 = 0 then 'test' else 'train' end as set, id, true as ok from essays_v
union all select 'auc', -1, true"""
ORACLES["ensemble_stack_check"] = "select 'test' as set, doc_id as id, true as ok from documents where doc_id not in (select doc_id from labels)"
ORACLES["embed_text_svd_check"] = "select doc_id as id, true as ok from documents union all select -1, true"
ORACLES["softmax_wide_check"] = "select vec_id as id, true as ok from embeddings"

ORACLES["quick_sample"] = with_(PROJECTS_V) + \
    "select id, teacher_prefix, school_state from projects_v order by id limit 4000"

ORACLES["kfold_contiguous"] = with_(PROJECTS_V) + """,
r as (select id, row_number() over (order by id) - 1 as i, count(*) over () as n from projects_v),
p as (select id, i, n // 5 as q, n % 5 as rem from r)
select id, cast(case when i < rem * (q + 1) then i // (q + 1) else rem + (i - rem * (q + 1)) // q end as integer) as fold
from p"""

ORACLES["union_by_name"] = with_(ESSAYS_V) + """
select id, project_is_approved, lang from essays_v where project_is_approved is not null
union all by name
select id, source from essays_v where project_is_approved is null"""

ORACLES["sorted_scores"] = with_(SCORES_V) + \
    "select model, id, round(score, 6) as score from scores_v"

ORACLES["binned_auc"] = with_(SCORES_V) + """,
sc as (select s.model, s.score, l.quality as y from scores_v s join labels l on s.id = l.doc_id),
tot as (select model, sum(y) as P, sum(1 - y) as N from sc group by model),
t as (select unnest(range(0, 1000)) as b),
c as (select sc.model, t.b, max(tot.P) as P, max(tot.N) as N,
             sum(case when sc.score >= cast(t.b as double) / 999 then sc.y else 0 end) as tp,
             sum(case when sc.score >= cast(t.b as double) / 999 then 1 - sc.y else 0 end) as fp
      from sc join tot on sc.model = tot.model cross join t group by sc.model, t.b),
r as (select *, tp / P as tpr, fp / N as fpr from c),
s as (select *, coalesce(lag(fpr) over (partition by model order by b), 1.0) as fprev from r)
select model, round(case when max(P) > 0 and max(N) > 0 then sum(tpr * (fprev - fpr)) end, 6) as auc
from s group by model"""

ORACLES["fold_mean"] = with_(SCORES_V) + "select id, round(avg(score), 6) as score from scores_v group by id"
ORACLES["scores_long"] = with_(SCORES_V) + "select model, id, round(score, 6) as score from scores_v"
ORACLES["ensemble_mean"] = ORACLES["fold_mean"]

WEIGHTS = """weights as (select * from (values ('m1', 0.76208), ('m2', 0.80257), ('m3', 0.81640)) t(model, s)),
w as (select model, pow(10 * s, 75) / 10000 as w from weights)"""
BLEND = "blend as (select id, sum(w * score) / sum(w) as score from scores_v join w using (model) group by id)"
ORACLES["ensemble_weighted"] = with_(SCORES_V, WEIGHTS, BLEND) + "select id, round(score, 6) as score from blend"

ORACLES["score_minmax"] = with_(SCORES_V) + """,
b as (select model, min(score) as lo, max(score) as hi from scores_v group by model)
select model, id, round((score - lo) / case when hi > lo then hi - lo else 1 end, 6) as score
from scores_v join b using (model)"""

ORACLES["fill_template"] = with_(ESSAYS_V, SCORES_V, WEIGHTS, BLEND) + """
select e.id, round(b.score, 6) as project_is_approved
from essays_v e left join blend b on e.id = b.id where e.project_is_approved is null"""

_LOGITS = ", ".join(
    f"list_reduce(list_prepend(0.0::double, [cast(v[j] as double) for j in range({i + 1}, len(v) + 1, 10)]), "
    f"lambda a, x: a + x) as l{i}" for i in range(10))
ORACLES["wide_probs"] = f"""with lg as (select vec_id, {_LOGITS} from (select vec_id, embedding as v from embeddings))
select vec_id, """ + ", ".join(
    f"round(exp(l{i}) / (" + " + ".join(f"exp(l{j})" for j in range(10)) + f"), 6) as class_{i}"
    for i in range(10)) + " from lg"

ORACLES["assemble_blocks"] = with_(ESSAYS_V, CLEANED, LONG_TEXT, TOKS, LEXICON_V) + \
    ", num as (select id, " + ", ".join(f"{e} as {n}" for n, e in _ESSAY_NUM.items()) + " from essays_v),\n" + \
    f"""lex as (select e.id, {half_up('coalesce(s.polarity, 0)', 2)} as polarity,
       {half_up('coalesce(s.subjectivity, 0)', 2)} as subjectivity
  from essays_v e left join (
    select t.id, avg(l.polarity) as polarity, avg(l.subjectivity) as subjectivity
    from toks t join lexicon_v l on t.token = l.token
    where t.field in ('project_essay_1', 'project_essay_2', 'project_essay_3', 'project_essay_4')
    group by t.id) s on e.id = s.id),
f as (select num.id, [""" + ", ".join(f"num.{n}" for n in _ESSAY_NUM) + """, lex.polarity, lex.subjectivity] as v
      from num join lex on num.id = lex.id)
select id, cast(i - 1 as integer) as slot, round(v[i], 6) as value from f, (select unnest(range(1, 8)) as i) k"""

ORACLES["csv_roundtrip"] = with_(ESSAYS_V) + """
select id, lang, case when project_title = '' then null else project_title end as project_title,
       case when description = '' then null else description end as description from essays_v"""

ORACLES["map_column"] = with_(ESSAYS_V) + "select id, cast(length(project_title) as bigint) as title_len from essays_v"

_TF_COLS = ", ".join([*[f"{sent_len(c)} as {c}_sent_len" for c in ESSAYS],
                      *[f"len(regexp_extract_all(coalesce({c}, ''), '{W}+|{NOT_SPACE_OR_WORD}')) as {c}_word_len"
                        for c in ESSAYS]])
ORACLES["text_features"] = with_(ESSAYS_V, CLEANED, LONG_TEXT, TOKS, LEXICON_V) + f""",
raw as (select id, {_TF_COLS} from essays_v),
lex as (select e.id, {half_up('coalesce(s.polarity, 0)', 2)} as polarity,
               {half_up('coalesce(s.subjectivity, 0)', 2)} as subjectivity
        from essays_v e left join (
          select t.id, avg(l.polarity) as polarity, avg(l.subjectivity) as subjectivity
          from toks t join lexicon_v l on t.token = l.token
          where t.field in ('project_essay_1', 'project_essay_2', 'project_essay_3', 'project_essay_4')
          group by t.id) s on e.id = s.id)
select raw.*, """ + ", ".join(f"c.{c}" for c in TEXT_COLS) + """,
       concat_ws('. ', c.project_essay_1, c.project_essay_2, c.project_essay_3, c.project_essay_4) as all_essays,
       concat_ws('. ', c.project_title,
                 concat_ws('. ', c.project_essay_1, c.project_essay_2, c.project_essay_3, c.project_essay_4),
                 c.project_resource_summary, c.description) as all_text, """ + ", ".join(
    f"len(list_distinct(list_filter(string_split_regex(c.{a}, '{_NONWORD}'), "
    f"lambda x: list_contains(string_split_regex(c.{b}, '{_NONWORD}'), x)))) as {a}_{b}_common"
    for a, b in _pairs) + """, lex.polarity, lex.subjectivity
from raw join cleaned c on raw.id = c.id join lex on raw.id = lex.id"""

ORACLES["label_lookup"] = """
select '/corpus/' || source || '/' || cast(d.doc_id as varchar) || '.txt' as path,
       cast(d.doc_id as varchar) as stem, lower(source) as label, l.quality as class
from documents d left join labels l on d.doc_id = l.doc_id"""


def _ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _keyword_matrix_sql() -> str:
    from tessera.operators.lexicon import REFERENCE_KEYWORDS, TEST_CORPUS_KEYWORDS
    kws = list(dict.fromkeys(REFERENCE_KEYWORDS + TEST_CORPUS_KEYWORDS))
    toks = ", ".join(f"list_filter(string_split({c}, ' '), lambda x: x <> '') as {c}" for c in TEXT_COLS)
    cols = ", ".join(f"cast(len(list_filter({c}, lambda x: x = {_sql_str(k)})) as bigint) as {_ident(f'{c}_{k}_count')}"
                     for c in TEXT_COLS for k in kws)
    return with_(ESSAYS_V, CLEANED) + f", t as (select id, {toks} from cleaned)\nselect id, {cols} from t"


ORACLES["keyword_matrix"] = _keyword_matrix_sql()

ORACLES["token_class_matrix"] = with_(ESSAYS_V, CLEANED, LONG_TEXT, TOKS, LEXICON_V) + """,
c as (select t.id, t.field, l.class from toks t join lexicon_v l on t.token = l.token)
select e.id, """ + ", ".join(
    f"cast(count(*) filter (where c.field = '{f}' and c.class = {k}) as bigint) as {f}_{k}_count"
    for f in TEXT_COLS for k in range(8)) + """
from essays_v e left join c on e.id = c.id group by e.id"""


ORACLES["tag_counts_check"] = with_(ESSAYS_V, CLEANED, LONG_TEXT, TOKS) + """
select id, field, count(*) as n_tokens, count(*) filter (where length(token) % 7 <> 6) as n_listed, cast(0 as bigint) as n_wrong
from toks group by id, field"""


# Learned sentence boundaries: tokens with their neighbours, type tables, log-likelihood ratios, decisions.
RAW_TEXT = "raw_text as (" + " union all ".join(f"select id, '{c}' as field, coalesce({c}, '') as text from essays_v" for c in TEXT_COLS) + ")"
PLACES = """places as (
  select id, field, pos, mark, letter, case when regexp_matches(typ, '^[+-]?[.,]?[0-9][0-9.,-]*\\z') then '##' else typ end as typ
  from (select id, field, pos,
          case when regexp_matches(core, '[!?][.!?]*\\z') or core = '.' then 'end' when regexp_matches(core, '\\.\\.\\z|…\\z') then 'dots'
               when regexp_matches(core, '\\.\\z') then 'stop' else 'none' end as mark,
          case when regexp_matches(core, '^\\p{Lu}') then 'u' when regexp_matches(core, '^\\p{Ll}') then 'l' else 'o' end as letter,
          lower(regexp_replace(core, '[.!?…,;:]+\\z', '')) as typ
        from (select id, field, generate_subscripts(l, 1) as pos,
                regexp_replace(regexp_replace(unnest(l), '^["''(\\[{«“‘„¿¡*_]+', ''), '["'')\\]}»”’*_]+\\z', '') as core
              from (select id, field, regexp_extract_all(text, '[^ \\t\\n\\f\\r]+') as l from raw_text))))"""
NEIGHBOURS = """neighbours as (
  select *, coalesce(lag(mark) over w, 'start') as before, case when lag(mark) over w = 'stop' then lag(typ) over w end as lft,
         lead(typ) over w as nxt, lead(letter) over w as nxt_letter
  from places window w as (partition by id, field order by pos))"""


def xlogy(x: str, y: str) -> str:
    return f"(case when ({x}) <= 0 then 0.0 else cast({x} as double) * ln({y}) end)"


def attracted(ab: str, a: str, b: str, least: float) -> str:
    def fit(k, m, p):
        return f"({xlogy(k, p)} + {xlogy(f'({m}) - ({k})', f'1 - {p}')})"
    p, p1, p2 = (f"(cast({x} as double) / ({y}))" for x, y in ((b, "n_all"), (ab, a), (f"({b}) - ({ab})", f"n_all - ({a})")))
    rest = (f"({b}) - ({ab})", f"n_all - ({a})")
    return (f"(case when ({ab}) * cast(n_all as double) > ({a}) * cast({b} as double) then "
            f"2 * ({fit(ab, a, p1)} + {fit(*rest, p2)} - {fit(ab, a, p)} - {fit(*rest, p)}) >= {least} else false end)")


ABBREVIATIONS = f"""totals as (select count(*) as n_all, coalesce(sum(case when mark = 'stop' then 1 end), 0) as n_stops from places),
scored as (
  select typ, n_stop, n_plain, 2 * ({xlogy('n_stop', '0.99')} + {xlogy('n_plain', '0.01')} - {xlogy('n_stop', '(n_stops / cast(n_all as double))')}
           - {xlogy('n_plain', '(1 - n_stops / cast(n_all as double))')}) * exp(-size) * (length(typ) - size + 1) * pow(size, -n_plain) as score
  from (select typ, count(*) filter (where mark = 'stop') as n_stop, count(*) filter (where mark <> 'stop') as n_plain,
               cast(length(replace(typ, '.', '')) as double) as size
        from places group by typ) cross join totals
  where n_stop > 0 and regexp_matches(typ, '\\p{{L}}'))"""
ORACLES["abbreviations"] = with_(ESSAYS_V, RAW_TEXT, PLACES, ABBREVIATIONS) + "select typ, n_stop, n_plain, round(score, 6) as score from scored"

LEARNED = f"""short as (select typ from scored where score >= 0.3),
known as (
  select n.*, s.typ is not null as is_short, lft = '##' or regexp_matches(lft, '^\\p{{L}}\\z') as loose
  from neighbours n left join short s on n.lft = s.typ),
placed as (
  select *, case when before = 'none' then 'inside' when before = 'dots' or (before = 'stop' and (is_short or loose)) then 'unsure' else 'start' end as place
  from known),
befores as (select count(*) as n_all, count(*) filter (where place = 'start' and before <> 'start') as n_after from placed),
types as (
  select t.*, after > 0 and regexp_matches(typ, '\\p{{L}}') and {attracted('after', 'n_after', 'n', 30.0)} as starts
  from (select typ, count(*) as n, count(*) filter (where place = 'start' and before <> 'start') as after, bool_or(letter = 'l') as lowers, bool_or(letter = 'u') as uppers,
               bool_or(letter = 'u' and place = 'inside') as mid_upper, bool_or(letter = 'l' and place = 'start') as start_lower
        from placed group by typ) t cross join befores),
bound as (
  select c.lft, c.typ
  from (select lft, typ, count(*) as together from placed where before = 'stop' and (is_short or loose) and regexp_matches(typ, '\\p{{L}}|##')
        group by lft, typ having count(*) > 1) c
  join types t on c.typ = t.typ and not t.starts join types l on c.lft = l.typ cross join befores
  where {attracted('together', 'l.n', 't.n', 7.88)}),
ends as (
  select p.id, p.field, p.pos, case
      when p.mark = 'end' then true
      when b.typ is not null then false
      when regexp_matches(p.typ, '^\\p{{L}}\\z') then s.typ is null and not goes_on and not (nxt_letter = 'u' and not begins and not lowers)
      when s.typ is not null or p.mark = 'dots' then begins or (nxt_letter = 'u' and starts)
      when p.typ = '##' then not goes_on
      else true end as ends
  from (select n.*, t.starts, t.lowers, nxt_letter = 'u' and t.lowers and not t.mid_upper as begins, nxt_letter = 'l' and (t.uppers or not t.start_lower) as goes_on
        from neighbours n join types t on n.nxt = t.typ where n.mark <> 'none') p
  left join short s on p.typ = s.typ left join bound b on p.typ = b.lft and p.nxt = b.typ)"""
ORACLES["sentence_breaks"] = with_(ESSAYS_V, RAW_TEXT, PLACES, NEIGHBOURS, ABBREVIATIONS, LEARNED) + "select e.id, " + ", ".join(
    f"cast(regexp_matches(coalesce({c}, ''), '[^ \\t\\n\\f\\r]') as integer) + cast(count(x.id) filter (where x.field = '{c}') as integer) as {c}_sent_len" for c in TEXT_COLS
) + " from essays_v e left join (select * from ends where ends) x on e.id = x.id group by e.id, " + ", ".join(TEXT_COLS)


def treebank(sentence: str) -> str:
    """The number of treebank tokens, by the same ordered rewrites."""
    from tessera.functions.treebank import REWRITES
    t = f"regexp_replace(regexp_replace({sentence}, '[ \\t\\n\\f\\r]+', ' ', 'g'), '^ | \\z', '', 'g')"
    for pattern, to in REWRITES:
        t = f"regexp_replace({t}, {_sql_str(pattern)}, {_sql_str(to.replace('$', chr(92)))}, 'g')"
    return f"len(list_filter(string_split({t}, ' '), lambda x: x <> ''))"


PLACED_WORDS = """pieces as (
  select id, field, unnest(l) as tok, generate_subscripts(l, 1) as pos
  from (select id, field, regexp_extract_all(text, '[^ \\t\\n\\f\\r]+') as l from raw_text)),
sents as (
  select id, field, string_agg(tok, ' ' order by pos) as sent
  from (select p.*, coalesce(sum(cast(x.ends as integer)) over (partition by p.id, p.field order by p.pos rows between unbounded preceding and 1 preceding), 0) as k
        from pieces p left join ends x on p.id = x.id and p.field = x.field and p.pos = x.pos)
  group by id, field, k)"""
ORACLES["treebank_count"] = with_(ESSAYS_V, RAW_TEXT, PLACES, NEIGHBOURS, ABBREVIATIONS, LEARNED, PLACED_WORDS) + f""",
counted as (select id, field, {treebank('sent')} as n from sents)
select e.id, """ + ", ".join(f"cast(coalesce(sum(c.n) filter (where c.field = '{c}'), 0) as integer) as {c}_word_len" for c in TEXT_COLS) + """
from essays_v e left join counted c on e.id = c.id group by e.id"""

ORACLES["modified_score"] = with_(ESSAYS_V, CLEANED, LONG_TEXT, TOKS, LEXICON_V, RAW_TEXT) + f""",
split as (select id, field, unnest(l) as text, generate_subscripts(l, 1) as sent
          from (select id, field, string_split_regex(text, '[.!?]+[ \\t\\n\\f\\r]+|[\\n\\r]+') as l from raw_text where field in ('project_essay_1', 'project_essay_2', 'project_essay_3', 'project_essay_4'))),
words as (select id, field, sent, unnest(l) as token, generate_subscripts(l, 1) as pos
          from (select id, field, sent, regexp_extract_all(lower(text), '{W}+') as l from split)),
hits as (select w.*, length(w.token) = 3 as negates, case length(w.token) when 4 then 1.5 when 8 then 0.5 end as factor, l.polarity, l.subjectivity,
                length(w.token) not in (3, 4, 8) as scored
         from words w join lexicon_v l on w.token = l.token),
-- A chain begins at a sentence's first listed word, behind a scored word, and behind a gap.
chains as (select *, sum(new) over (partition by id, field, sent order by pos) as chain
           from (select *, case when coalesce(lag(scored) over w, true) or pos - lag(pos) over w > 3 then 1 else 0 end as new
                 from hits window w as (partition by id, field, sent order by pos))),
acted as (select id, greatest(-1.0, least(1.0, max(case when scored then polarity end) * coalesce(product(factor), 1.0)
                                                 * case when count(*) filter (where negates) % 2 = 1 then -0.5 else 1.0 end)) as polarity,
                 greatest(0.0, least(1.0, max(case when scored then subjectivity end) * coalesce(product(factor), 1.0))) as subjectivity
          from chains group by id, field, sent, chain having bool_or(scored))
select e.id, {half_up('coalesce(a.polarity, 0)', 2)} as polarity, {half_up('coalesce(a.subjectivity, 0)', 2)} as subjectivity
from essays_v e left join (select id, avg(polarity) as polarity, avg(subjectivity) as subjectivity from acted group by id) a on e.id = a.id"""

ORACLES["resource_rollup_split"] = ORACLES["resource_rollup"]
