"""DuckDB SQL with the same meaning as each query, over the same tables."""

from __future__ import annotations

from cadenza.operators.matching import SKIP_WORDS

LINES = """
lines as (
  select * from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey
)"""

DAYS = "concat(day(l_shipdate), ',', l_linenumber)"
CYCLE = """case when l_linenumber = 7 then 'Full cycle' when l_linestatus = 'O' then '28-day cycle'
       else '3-week schedule' end"""

SCHED = f"""{LINES},
sched as (
  select case when o_custkey % 50 <> 0 then cast(o_custkey as varchar) end as regimen_cui,
    nullif(l_returnflag, 'N') as variant, p_name as component,
    case when l_quantity = 13 then '' when l_partkey % 41 <> 0 then {DAYS} end as allDays, {CYCLE} as cyclesigs, nullif(o_orderpriority, '4-NOT SPECIFIED') as condition,
    o_orderstatus as context, l_linestatus as study, concat(p_type, ' and ', p_brand) as regimen,
    'all' as metaCondition
  from lines
)"""

# Condition imputation and keyed dedupe over `sched`.
IMPUTED = """
kept as (select * from sched where regimen_cui is not null or variant is not null),
named as (select distinct regimen_cui, variant, condition as c from kept where condition is not null),
imputed as (
  select * from kept where condition is not null
  union all
  select k.* replace (n.c as condition) from kept k left join named n
    on k.regimen_cui is not distinct from n.regimen_cui and k.variant is not distinct from n.variant
  where k.condition is null
)"""
EXPANDED = f"""{IMPUTED},
expanded as (
  select * from imputed qualify row_number() over (
    partition by regimen_cui, variant, condition, component, allDays, cyclesigs
    order by context nulls first, study nulls first, regimen nulls first, metaCondition nulls first) = 1
)"""


def strings_sql(source: str, keys: str) -> str:
    """CTEs up to `strings`: one schedule string per group and vector length."""
    same = " and ".join(f"d.{k.strip()} is not distinct from e.{k.strip()}" for k in keys.split(","))
    return f"""
parsed as (
  select *, upper(left(lower(replace(trim(component), ' ', '')), 1)) || substr(lower(replace(trim(component), ' ', '')), 2) as drug,
    [cast(x as bigint) for x in regexp_extract_all(allDays, '-?\\d+')] as listed,
    case cyclesigs when '28-day cycle' then 28 when '3-week schedule' then 21 end as cyc
  from {source}
),
vectors as (
  select *, case when cyc is null then list_min(listed) else 1 end as base,
    coalesce(cyc, list_max(listed) - list_min(listed) + 1) as vector_len
  from parsed where len(listed) > 0
),
picked as (
  select * from vectors qualify row_number() over (
    partition by {keys}, vector_len, drug order by allDays desc, cyclesigs desc nulls last) = 1
),
cells as (
  select {keys}, vector_len, drug, d - base as day0
  from (select {keys}, vector_len, drug, base, unnest(listed) as d from picked)
  group by all having count(*) = 1
),
inside as (select * from cells where day0 >= 0 and day0 < vector_len),
ordered as (
  select *, row_number() over (partition by {keys}, vector_len, day0 order by drug) as rn,
    max(day0) over (partition by {keys}, vector_len) as last_day
  from inside
),
day_gaps as (
  select {keys}, vector_len, day0,
    coalesce(day0 - lag(day0) over (partition by {keys}, vector_len order by day0),
      vector_len - max(day0) over (partition by {keys}, vector_len)) as gap
  from (select distinct {keys}, vector_len, day0 from inside)
),
joined as (
  select d.*, case when d.rn = 1 then e.gap else 0 end as gap
  from ordered d join day_gaps e on {same} and d.vector_len = e.vector_len and d.day0 = e.day0
),
texts as (
  select {keys}, vector_len, count(distinct drug) as n_drugs,
    string_agg(concat(gap, '.', drug), ';' order by day0, rn) as t
  from joined group by all
),
strings as materialized (
  select {keys}, vector_len, n_drugs, case when n_drugs = 1 then concat(t, ';', t) else t end as regString
  from texts
)"""


G3 = "regimen_cui, variant, condition"
STRINGS = SCHED + "," + EXPANDED + "," + strings_sql("expanded", G3)

# Shortest repeating token list, by trying every size.
SHORT = """
tokens as (
  select *, string_split(regexp_replace(lower(trim(regString)), ';$', ''), ';') as tok from {source}
),
sized as (
  select *, list_filter(range(1, len(tok) + 1), lambda k: len(tok) % k = 0
      and repeat(array_to_string(tok[1:k], ';') || ';', (len(tok) // k)::bigint) = array_to_string(tok, ';') || ';')[1] as size
  from tokens
),
{name} as (
  select * exclude (tok, size),
    repeat(array_to_string(tok[1:size], ';') || ';', case when size = 1 then 2 else 1 end) as shortString
  from sized
)"""


def short_sql(source: str, name: str) -> str:
    return SHORT.format(source=source, name=name)


CROSS = STRINGS + """,
crossed as (
  select e.*, s.regString from expanded e join strings s
    on e.regimen_cui is not distinct from s.regimen_cui and e.variant is not distinct from s.variant
    and e.condition is not distinct from s.condition
)"""
# Short strings of the distinct strings, then of the rows.
FULL = STRINGS + "," + short_sql("strings", "shorted") + """,
full_table as (
  select e.metaCondition, e.condition, e.context, e.regimen as regName, e.variant, e.regimen_cui as regCode, e.component,
    s.regString, s.shortString
  from expanded e join shorted s
    on e.regimen_cui is not distinct from s.regimen_cui and e.variant is not distinct from s.variant
    and e.condition is not distinct from s.condition
)"""

# White space and word characters, as in the Spark expressions.
WS = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def clean_sql(x: str) -> str:
    return f"lower({strip_sql(f"regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]', '', 'g')")})"


def units_sql(x: str) -> str:
    """List of units. Every word is marked at both ends, so whole words can be told without look-around."""
    flat = f"regexp_replace(lower({x}), '[()\\[\\],]', ' ', 'g')"
    flat = f"regexp_replace({flat}, '{WS}*\\|{WS}*', ' or ', 'g')"
    flat = strip_sql(f"regexp_replace({flat}, '{WS}+', ' ', 'g')")
    marked = f"regexp_replace({flat}, '([\\p{{L}}\\p{{N}}_]+)', chr(1) || '\\1' || chr(1), 'g')"
    parts = f"string_split_regex({marked}, '\\x01(?:and|or)\\x01')"
    return f"list_filter([{strip_sql("replace(u, chr(1), '')")} for u in {parts}], lambda u: u <> '')"


def words_sql(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{WS}+'), lambda w: w <> '')"


def pairs_sql(queries: str, corpus: str, threshold: float = 0.8, name: str = "pairs") -> str:
    """CTEs up to `name`(q, d, sim): cosine of every pair sharing a gram, no pruning. Inputs are (t).

    Texts and grams are numbered first, so that only numbers are joined and grouped.
    """
    def grams(source: str) -> str:
        return f"""
      select id, gram, count(*)::double as tf from (
        select id, unnest(list_concat([substr(w, i, 2) for i in range(1, length(w))],
          [substr(w, i, 3) for i in range(1, length(w) - 1)])) as gram
        from (select id, ' ' || unnest({words_sql('lower(t)')}) || ' ' as w from {source})
      ) group by all"""

    return f"""
{name}_d as materialized (select t, row_number() over ()::integer as id from {corpus}),
{name}_q as materialized (select t, row_number() over ()::integer as id from {queries}),
{name}_dg as materialized ({grams(f"{name}_d")}),
{name}_qg as materialized ({grams(f"{name}_q")}),
{name}_n as (select count(*)::double as n from {corpus}),
{name}_df as materialized (select gram, row_number() over ()::integer as g, count(*)::double as df from {name}_dg group by gram),
{name}_dw as materialized (
  select id, g, tf * (ln((n + 2) / (df + 2)) + 1) as u, tf * (ln((n + 2) / (df + 1)) + 1) as b
  from {name}_dg join {name}_df using (gram), {name}_n
),
{name}_qw as materialized (
  select id, g, tf * (ln((n + 2) / (coalesce(df, 0) + 2)) + 1) as u
  from {name}_qg left join {name}_df using (gram), {name}_n
),
{name}_qn as (select id, sum(u * u) as total from {name}_qw group by id),
{name}_dn as (select id, sum(b * b) as total from {name}_dw group by id),
{name}_sums as (
  select q.id as q, d.id as d, sum(q.u * d.u) as dot, sum(d.b * d.b - d.u * d.u) as less
  from {name}_qw q join {name}_dw d using (g) group by 1, 2
),
{name} as materialized (
  select x.t as q, y.t as d, dot / sqrt(a.total * (b.total - less)) as sim
  from {name}_sums join {name}_qn a on q = a.id join {name}_dn b on d = b.id join {name}_q x on x.id = q join {name}_d y on y.id = d
  where dot / sqrt(a.total * (b.total - less)) > {threshold}
)"""


def correct_sql(x: str) -> str:
    return f"case {x} when 'palictaxel' then 'paclitaxel' when 'alfa' then 'alpha' else {x} end"


SKIP = ", ".join(f"'{w}'" for w in SKIP_WORDS)

VOCABULARY = f"vocabulary as (select distinct unnest({units_sql('text')}) as t from benchmark)"
KNOWN_WORDS = f"known_words as (select distinct unnest({words_sql('lower(text)')}) as t from benchmark)"
DOC_WORDS = f"doc_words as (select distinct unnest({words_sql('lower(text)')}) as t from documents)"
TALK_WORDS = f"talk_words as (select distinct unnest({words_sql('lower(text)')}) as t from conversations)"
DOC_UNITS = f"doc_units as (select distinct unnest({units_sql('text')}) as unit from documents)"
WORD_PAIRS = f"{KNOWN_WORDS}, {DOC_WORDS}, {pairs_sql('doc_words', 'known_words')}"


def fallback_sql(units: str, corpus: str) -> str:
    """CTEs up to `fallback`(unit, word, score): first word of each unit that matches."""
    return f"""
unit_words as (
  select unit, place, {correct_sql('raw')} as word
  from (select unit, unnest(ws) as raw, generate_subscripts(ws, 1) as place from (select unit, {words_sql('unit')} as ws from {units}))
),
wanted_words as (select * from unit_words where word not in ({SKIP})),
single_words as (select distinct word as t from wanted_words),
{pairs_sql('single_words', corpus, name='word_hits')},
word_scores as (select q as word, round(avg(sim), 2) as score from word_hits group by 1),
fallback as (
  select unit, word, score from wanted_words join word_scores using (word)
  qualify row_number() over (partition by unit order by place) = 1
)"""


EXTRACT = f"""{VOCABULARY},
cells as (
  select doc_id, 'note' as hvc_col, {strip_sql('lower(text)')} as value from documents
  union all select doc_id, 'origin', lang || ' or ' || source from documents
),
vals as (select hvc_col, value, count(*) as n_rows from cells where value <> '' group by all),
units as (select hvc_col, unit, count(*) as occurrences from (select hvc_col, unnest({units_sql('value')}) as unit from vals) group by all),
distinct_units as (select distinct unit, unit in ({SKIP}) or regexp_full_match(unit, '\\d+\\+?') as skipped from units),
wanted as (select unit, {correct_sql('unit')} as t from distinct_units where not skipped),
wanted_terms as (select distinct t from wanted),
{pairs_sql('wanted_terms', 'vocabulary', name='unit_hits')},
unit_scores as (select q as t, round(avg(sim), 2) as score from unit_hits group by 1),
missed as (select unit from wanted where t not in (select t from unit_scores)),
{fallback_sql('missed', 'vocabulary')},
outcome as (
  select unit, 'match' as status, t as term, score from wanted join unit_scores using (t)
  union all select unit, case when word is null then 'no match' else 'partial match' end, word, coalesce(score, 0)
    from missed left join fallback using (unit)
  union all select unit, 'skipped', null, 0 from distinct_units where skipped
),
held as (
  select u.hvc_col, u.unit, u.occurrences, o.term, v.value, v.n_rows
  from units u join outcome o using (unit) join vals v on v.hvc_col = u.hvc_col and contains(v.value, u.unit)
  where o.term is not null
),
matches as (
  select h.hvc_col, h.unit, h.term, c.doc_id, h.occurrences from held h join cells c using (hvc_col, value)
)"""

SIGS = f"""{LINES},
raw_sigs as (
  select concat(' ', p_name, ' (', p_brand, ') ', l_quantity::int) as component, nullif(l_linestatus, 'F') as study,
    l_orderkey::varchar as regimen_cui, l_returnflag as variant, {DAYS} as allDays, {CYCLE} as cyclesigs,
    concat(p_type, ' and ', p_brand) as regimen from lines
),
raw_inds as (
  select concat(upper(p_name), ' ', p_brand, ' ', l_quantity::int) as component, nullif(o_orderstatus, 'F') as study,
    l_orderkey::varchar as regimen_cui, l_returnflag as variant, {DAYS} as allDays,
    nullif(o_orderpriority, '4-NOT SPECIFIED') as condition, o_orderstatus as context, p_type as "with" from lines
),
sigs as (select distinct * replace ({clean_sql('component')} as component, {clean_sql("coalesce(study, 'nan')")} as study) from raw_sigs),
inds as (select distinct * replace ({clean_sql('component')} as component, {clean_sql("coalesce(study, 'nan')")} as study) from raw_inds)"""

LEFT_MERGE = SIGS + """,
left_merged as (
  select s.*, i.regimen_cui as regimen_cui_right, i.variant as variant_right, i.allDays as allDays_right,
    i.condition, i.context, i."with"
  from sigs s left join inds i on s.component = i.component and s.study = i.study
)"""
# The first indications row of a component that agrees on the three columns, per unmatched component.
ENRICH = """,
unmatched as (
  select distinct regimen_cui, component as missing from sigs s
  where not exists (select 1 from inds i where i.component = s.component and i.study = s.study)
),
best as (
  select i.* from inds i join unmatched u on i.component = u.missing and i.regimen_cui = u.regimen_cui
  where i.variant is not null and i.allDays is not null
  qualify row_number() over (partition by i.regimen_cui, i.variant, i.allDays, i.component
    order by i.condition nulls first, i.context nulls first, i."with" nulls first, i.study nulls first) = 1
),
enriched as (
  select distinct s.*, b.regimen_cui as regimen_cui_right, b.variant as variant_right, b.allDays as allDays_right,
    b.condition, b.context, b."with"
  from sigs s join best b on s.regimen_cui = b.regimen_cui and s.variant = b.variant and s.allDays = b.allDays
)"""
BLACK = f"""
entries as (select concat(p_name, ' ', replace(p_brand, '#', ''), ' ', p_size, ' (', p_type, ')') as e from part),
terms as (select distinct lower(trim(trim(x, ')'))) as term from (select unnest(string_split(e, '(')) as x from entries))"""


def title_sql(x: str) -> str:
    """Upper-case after a non-letter, by single characters."""
    chars = f"string_split(lower({x}), '')"
    return (
        f"array_to_string([case when i = 1 or not regexp_full_match({chars}[i - 1], '\\p{{L}}') "
        f"then upper({chars}[i]) else {chars}[i] end for i in range(1, length({x}) + 1)], '')"
    )


def initcap_sql(x: str) -> str:
    """First letter of each blank-separated word."""
    return f"array_to_string([upper(left(w, 1)) || lower(substr(w, 2)) for w in string_split({x}, ' ')], ' ')"


def list_form_sql(x: str) -> str:
    return f"regexp_replace({strip_sql(f"replace({x}, ' and ', ',')")}, '{WS}*,{WS}*', ',', 'g')"


NAMES = """
names as (
  select p_partkey, case p_type when 'ECONOMY' then 'Bortezomib, Thalidomide, Dexamethasone, ' || own
    when 'SMALL' then 'Melphalan flufenamide , Dexamethasone and ' || own
    when 'MEDIUM' then 'Tegafur & Uracil, Folinic acid, ' || own
    when 'PROMO' then 'VMP, then Rd (TP) and ' || own
    when 'LARGE' then 'VMP/Rd  (KR), ' || own
    else case when p_size > 25 then 'Carfilzomib' else own end end as regName
  from (select *, case when p_size > 5 then concat(' ', p_name, ' and ', p_brand) else '' end as own from part)
)"""


def new_form_sql(x: str) -> str:
    base = list_form_sql(strip_sql(f"replace(replace(lower({x}), '(tp)', ''), '(kr)', '')"))
    out = "b"
    for one, two, old, new in (
        ("bortezomib", "thalidomide", "dexamethasone,", ""),
        ("melphalan", "flufenamide", ",dexamethasone", " monotherapy"),
        ("tegafur", "uracil", ",folinic acid", " monotherapy"),
        ("vmp", "then rd", ",then rd", " + rd"),
        ("vmp", "/rd", "/", " / "),
    ):
        out = f"(case when contains(b, '{one}') and contains(b, '{two}') then replace({out}, '{old}', '{new}') else {out} end)"
    return f"(select {out} from (select {base} as b))"


def old_form_sql(x: str) -> str:
    low = f"lower(replace({x}, '&', 'and'))"
    return list_form_sql(f"(case when {low} = 'carfilzomib' then 'carfilzomib monotherapy' else {low} end)")


def half_sql(name: str, regimen: str, condition: str) -> str:
    return f"""{name} as (
  select (l_partkey * 100 + l_quantity::bigint)::varchar as regimen_cui, l_returnflag as variant, p_name as component,
    l_linenumber::varchar as allDays, case when l_linestatus = 'O' then '28-day cycle' else '3-week schedule' end as cyclesigs,
    nullif(o_orderpriority, '4-NOT SPECIFIED') as condition, o_orderstatus as context,
    nullif(p_type, 'SMALL') as "with", {regimen} as regimen
  from lines where {condition}
)"""


def half_strings(half: str) -> str:
    """CTE `{half}_final`(regName, regString, shortString, …) nested, so that the two halves do not share names."""
    return f"""{half}_final as (
  with named as (select distinct regimen_cui, variant, condition as c from {half} where condition is not null),
  imputed as (
    select * from {half} where condition is not null
    union all select k.* replace (n.c as condition) from {half} k left join named n
      on k.regimen_cui = n.regimen_cui and k.variant = n.variant where k.condition is null
  ),
  expanded as (
    select * from imputed qualify row_number() over (
      partition by regimen_cui, variant, condition, component, allDays, cyclesigs
      order by context nulls first, "with" nulls first, regimen nulls first) = 1
  ),
  {strings_sql('expanded', G3)},
  crossed as (
    select e.*, s.regString from expanded e join strings s on e.regimen_cui = s.regimen_cui and e.variant = s.variant
      and e.condition is not distinct from s.condition
  ),
  {short_sql('crossed', 'shorted')}
  select regimen as regName, regString, shortString from shorted
)"""


CHECK = f"""{LINES},
{half_sql('newer', "concat(p_name, ' and ', p_brand, ', ', l_quantity::int)", "o_orderdate >= timestamp '1998-07-01'")},
{half_sql('older', "concat(upper(p_name), ' & ', p_brand, ' , ', l_quantity::int)", "o_orderdate < timestamp '1998-07-01'")},
{half_strings('newer')},
{half_strings('older')},
shared as (
  select name_key, new_name, old_name
  from (select {new_form_sql('regName')} as name_key, max(regName) as new_name from (select distinct regName from newer_final) group by 1)
  join (select {old_form_sql('regName')} as name_key, max(regName) as old_name from (select distinct regName from older_final) group by 1) using (name_key)
)"""
STATUS = CHECK + """,
new_texts as (select distinct new_name as regimen, lower(rtrim(shortString, ';')) as t from newer_final join shared on regName = new_name),
old_texts as (select distinct new_name as regimen, lower(rtrim(shortString, ';')) as t from older_final join shared on regName = old_name),
statuses as (
  select regimen, case when bool_and(hit) then 'correct' when bool_or(hit) then 'partial' else 'failed' end as status,
    count(*) as n_new, count(*) filter (where hit) as n_hit
  from (select n.regimen, o.t is not null as hit from new_texts n left join old_texts o on n.regimen = o.regimen and n.t = o.t)
  where regimen in (select regimen from newer) group by regimen
)"""
REPORT = STATUS + """,
blocks as (select regimen, case status when 'partial' then 1 else 2 end as priority, status from statuses where status <> 'correct'),
kept as (
  select priority, regimen, regimen_cui, component, cyclesigs, variant, allDays, condition, max("with") as w
  from newer join blocks using (regimen) group by all
),
later as (select distinct priority, regimen, variant from kept qualify dense_rank() over (partition by regimen order by variant) > 1),
counts as (select count(*) filter (where status = 'correct') as c, count(*) filter (where status = 'partial') as p,
  count(*) filter (where status = 'failed') as f from statuses),
report as (
  select priority, regimen, part, 0 as place, null as variant, 0 as step, null as with_text, line from (
    select priority, regimen, unnest([0, 1, 2, 4, 6, 7, 8, 10]) as part,
      unnest(['=== Regimen: ' || regimen || ' ===',
        '=== Status: ' || case status when 'partial' then '⚠️' else '❌' end || ' ===', 'new', 'old', '',
        'regimen_cui | component | cyclesigs | HVC (with) | variant | allDays | condition', repeat('=', 80), '']) as line
    from blocks)
  union all
  select priority, regimen, 3, no, null, 0, null, no || ' ' || t
    from (select *, row_number() over (partition by regimen order by t) - 1 as no from new_texts) join blocks using (regimen)
  union all
  select priority, regimen, 5, no, null, 0, null, no || ' ' || t
    from (select *, row_number() over (partition by regimen order by t) - 1 as no from old_texts) join blocks using (regimen)
  union all
  select priority, regimen, 9, 0, variant, 1, w, concat_ws(' | ', regimen_cui, component, cyclesigs, coalesce(w, 'nan'), variant, allDays,
    coalesce(condition, 'nan')) from kept
  union all
  select priority, regimen, 9, 0, variant, 0, null, repeat('-', 80) from later
  union all
  select 0, '', 0, unnest([0, 1, 2, 3, 4, 5]), null, 0, null, unnest(['### MATCH SUMMARY ###', '✅ Correct: ' || c,
    '⚠️ Partially correct: ' || p, '❌ Failed: ' || f, repeat('=', 80), '']) from counts
)"""

COLUMN_PROFILE = {
    "p_name": "part", "p_brand": "part", "p_type": "part", "c_name": "customer", "c_mktsegment": "customer",
    "s_name": "supplier", "text": "documents", "source": "documents",
}
COLUMN_TEXTS = " union ".join(f"select '{c}' as col, {c} as t from {t}" for c, t in COLUMN_PROFILE.items())

ORACLES = {
    "schedule_strings": f"with {STRINGS} select * from strings",
    "short_strings": f"with {STRINGS}, {short_sql('strings', 'out_t')} "
    "select regimen_cui, variant, condition, vector_len, regString, shortString, "
    "rtrim(shortString, ';') as naiveString from out_t",
    "condition_imputation": f"with {SCHED},{IMPUTED} select regimen_cui, variant, condition, component, allDays, context from imputed",
    "expanded_groups": f"with {SCHED},{EXPANDED} select * from expanded",
    "schedule_cross": f"with {CROSS} select * replace (md5(regString) as regString) from crossed",
    "full_sorted": f"with {FULL} select * replace (md5(regString) as regString, md5(shortString) as shortString) from full_table",
    "first_per_key": f"""with {FULL} select * from full_table qualify row_number() over (
        partition by shortString order by condition asc nulls last, context desc nulls last,
        metaCondition desc nulls last, regName desc nulls last, variant desc nulls last, regCode desc nulls last,
        component desc nulls last, regString desc nulls last) = 1""",
}

ORACLES |= {
    "group_metrics": f"""with {SCHED},{IMPUTED}
      select 'group_rows' as metric, regimen_cui, variant, condition, count(*) as value from imputed group by all
      union all select 'total_groups', null, null, null, count(*) from (select distinct regimen_cui, variant from sched)
      union all select 'skipped_groups', null, null, null, count(*) from (select distinct regimen_cui, variant from sched)
        where regimen_cui is null and variant is null
      union all select 'missing_days', null, null, null, count(*) from sched where coalesce(allDays, '') = ''""",
    "parse_cycle": """with texts as (
        select p_partkey, case p_type when 'ECONOMY' then p_size || '-day cycle' when 'SMALL' then p_size || '- to ' || (p_size + 7) || '-day Cycle'
          when 'MEDIUM' then p_size || '-week schedule' when 'PROMO' then ' ' || p_size || ' months '
          when 'LARGE' then 'for ' || p_size || 'years course' else 'Full cycle ' || p_type end as cycle_text from part
      ), parts as (
        select *, lower(trim(cycle_text)) as flat,
          regexp_extract(flat, '(\\d+)\\s*-\\s*(?:to\\s*)?(\\d+)?-?\\s*([a-z]+)', 1) as a1,
          regexp_extract(flat, '(\\d+)\\s*-\\s*(?:to\\s*)?(\\d+)?-?\\s*([a-z]+)', 3) as a3,
          regexp_extract(flat, '(\\d+)\\s*([a-z]+)', 1) as b1, regexp_extract(flat, '(\\d+)\\s*([a-z]+)', 2) as b2 from texts
      ), units as (
        select *, case when a1 <> '' then a1 else b1 end as num, case when a1 <> '' then a3 else b2 end as unit from parts
      ), counted as (
        select *, try_cast(num as bigint) * case when contains(unit, 'day') then 1 when contains(unit, 'week') then 7
          when contains(unit, 'month') then 30 when contains(unit, 'year') then 365 end as cycle_days from units
      ) select p_partkey, cycle_text, cycle_days, case when cycle_days is null then flat else unit end as cycle_unit from counted""",
    "parse_days": """with texts as (
        select l_orderkey, l_partkey, case when l_linenumber = 7 then 'None'
          else concat(day(l_shipdate), ',', l_linenumber, ' -', l_quantity::int) end as day_text from lineitem
      ), listed as (select *, [cast(x as bigint) for x in regexp_extract_all(day_text, '-?\\d+')] as days_ from texts)
      select l_orderkey, l_partkey, day_text, case when len(days_) > 0 then array_to_string(days_, '|') end as day_numbers,
        list_min(days_) as first_day, list_max(days_) as last_day from listed""",
    "clean_terms": f"""select doc_id, md5({clean_sql('text')}) as cleaned,
        md5({strip_sql("regexp_replace(lower(text), '[()\\[\\],]', ' ', 'g')")}) as vocabulary,
        md5({strip_sql('lower(text)')}) as index_key from documents""",
    "split_units": f"""select doc_id, md5(unit) as unit_key, count(*) as occurrences, max(length(unit)) as n_chars
        from (select doc_id, unnest({units_sql('text')}) as unit from documents) group by 1, 2""",
    "corrections": f"""with {DOC_WORDS} select t as word,
        case t when 'the' then 'that' when 'of' then 'off' when 'palictaxel' then 'paclitaxel' when 'alfa' then 'alpha' else t end as corrected,
        t in ({SKIP}) or regexp_full_match(t, '\\d+\\+?') as skipped, regexp_full_match(t, '\\d+\\+?') as numeric from doc_words""",
    "left_merge": f"with {LEFT_MERGE} select * from left_merged",
    "enrich_fallback": f"with {SIGS}{ENRICH} select * from enriched",
    "merged_table": f"""with {LEFT_MERGE}{ENRICH}, {BLACK}
        select distinct *, 'all' as metaCondition from (select * from left_merged union select * from enriched)
        where component is not null and lower(component) not in (select term from terms)""",
    "blacklist_anti": f"""with {LINES},
        sigs as (select {clean_sql("concat(' ', p_name, ' (', p_brand, ') ', l_quantity::int)")} as component,
          {clean_sql("coalesce(nullif(l_linestatus, 'F'), 'nan')")} as study, l_orderkey::varchar as regimen_cui from lines),
        {BLACK} select * from sigs where lower(component) not in (select term from terms)""",
    "filled_columns": f"""with {LINES} select coalesce(nullif(o_orderstatus, 'F'), 'nan') as study,
        coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), 'nan') as condition, o_orderstatus as context, p_type as "with",
        'all' as metaCondition, count(*) as n from lines group by all""",
    "fuzzy_tfidf": f"with {WORD_PAIRS} select q as word, d as component, round(sim, 6) as similarity from pairs",
    "fuzzy_tfidf_scores": f"""with {KNOWN_WORDS}, {TALK_WORDS}, {pairs_sql('talk_words', 'known_words')},
        scored as (select q, round(avg(sim), 2) as score from pairs group by q)
        select t as word, coalesce(score, 0.0) as score from talk_words left join scored on t = q""",
    "word_fallback": f"""with {VOCABULARY}, {DOC_UNITS}, {fallback_sql('doc_units', 'vocabulary')}
        select md5(unit) as unit_key, word, score from fallback""",
    "contains_fanout": f"""with {VOCABULARY}, vals as (select doc_id, {strip_sql('lower(text)')} as value from documents)
        select t as unit, doc_id from vocabulary join vals on contains(value, t)""",
    "extract_matches": f"with {EXTRACT} select hvc_col, md5(unit) as unit_key, term, doc_id, occurrences from matches",
    "match_audit": f"""with {EXTRACT},
        repeated as (select hvc_col, unit, sum(n_rows) as repeats from held group by all)
        select u.hvc_col, md5(u.unit) as unit_key, o.status, o.score::double as score, coalesce(r.repeats, 0)::bigint as repeats
        from units u join outcome o using (unit) left join repeated r on r.hvc_col = u.hvc_col and r.unit = u.unit""",
    "explode_matches": f"""with {EXTRACT},
        copies as (select distinct doc_id, term from matches)
        select doc_id, lang as component, source as study, length(text) as n_chars from documents
        union all select d.doc_id, c.term, d.source, length(d.text) from documents d join copies c using (doc_id)""",
    "edit_distance_match": """with tokens as (
          select distinct doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+(?:[''’.\\-+/][\\p{L}\\p{N}_]+)*|[^\\p{L}\\p{N}_\\s\\p{Z}]')) as token from documents
        ), terms as (select distinct unnest(string_split(p_name, ' ')) as term from part),
        hits as (select token, term from (select distinct token from tokens), terms where levenshtein(regexp_replace(token, '[^ -~]', '~', 'g'), term) <= 2)
        select distinct doc_id, term from tokens join hits using (token)""",
    "edit_distance_pairs": """with tokens as (
          select distinct unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+(?:[''’.\\-+/][\\p{L}\\p{N}_]+)*|[^\\p{L}\\p{N}_\\s\\p{Z}]')) as token from documents
        ), terms as (select distinct unnest(string_split(p_name, ' ')) as term from part)
        select token, term, levenshtein(regexp_replace(token, '[^ -~]', '~', 'g'), term) as distance from tokens, terms where levenshtein(regexp_replace(token, '[^ -~]', '~', 'g'), term) <= 2""",
    "column_similarity": f"""with texts as ({COLUMN_TEXTS}),
        grams as (
          select col, gram, count(*)::double as tf from (
            select col, unnest(list_concat([substr(w, i, 2) for i in range(1, length(w))],
              [substr(w, i, 3) for i in range(1, length(w) - 1)])) as gram
            from (select col, ' ' || unnest({words_sql('lower(t)')}) || ' ' as w from texts)
          ) group by all),
        weighted as (
          select col, grams.gram, tf * (ln({len(COLUMN_PROFILE) + 1}.0 / (df + 1)) + 1) as w
          from grams join (select gram, count(*) as df from grams group by 1) x on grams.gram = x.gram),
        norms as (select col, sqrt(sum(w * w)) as n from weighted group by 1),
        dots as (select b.col, sum(a.w * b.w) as dot from weighted a join weighted b on a.gram = b.gram and a.col = 'c_name' group by 1)
        select n.col as "column", round(coalesce(dot, 0) / (n.n * (select n from norms where col = 'c_name')), 6) as similarity
        from norms n left join dots using (col) where n.col <> 'c_name'""",
    "ref_groups_completed": f"""with names as (select concat(p_type, ' and ', p_brand) as nm, * from part),
        ref as (select nm as Var1, min(p_type) as regGroup from names group by nm having min(p_size) > 1),
        labels as (select regGroup, row_number() over (order by regGroup) as no, count(*) over () as n
          from (select distinct regGroup from ref))
        select * from ref union all
        select nm, regGroup from (select distinct nm from names where nm not in (select Var1 from ref)) x
        join labels on no = ('0x' || left(md5('7:' || nm), 8))::bigint % n + 1""",
    "valid_items_completed": f"""with ref as (
          select {initcap_sql("concat(p_name, ' ', replace(p_brand, 'Brand#', 'no-'))")} as name,
            case when s_nationkey = 0 then 'NA' else (s_suppkey + 35802000)::varchar end as concept_id, s_suppkey::varchar as Manual,
            s_name as concept_me, case when s_nationkey = 1 then '1 / 2' else (s_suppkey + 1300000)::varchar end as valid_concept_id,
            'Drug' as domain_id, 'Ingredient' as concept_class_id, null::varchar as Manual_Req
          from supplier join part on s_suppkey = p_partkey),
        comps as (select distinct lower(concat(p_name, ' ', replace(p_brand, 'Brand#', 'no-'))) as c from part),
        known as (select * from ref where lower(name) in (select c from comps)),
        ids as (select coalesce(max(try_cast(concept_id as bigint)), 0) as a, coalesce(max(try_cast(valid_concept_id as bigint)), 0) as b from known),
        added as (select c, row_number() over (order by c) as no from comps where c not in (select lower(name) from ref))
        select * from ref union all
        select {title_sql('c')}, (a + no)::varchar, (a + no)::varchar, {title_sql('c')}, (b + no)::varchar, 'Drug', 'Ingredient', 'Yes'
        from added, ids""",
    "normalised_names": f"with {NAMES} select p_partkey, regName, {new_form_sql('regName')} as new_form, {old_form_sql('regName')} as old_form from names",
    "shared_names": f"with {CHECK} select * from shared",
    "shared_rows": f"with {CHECK} select regimen, count(*) as n_rows from newer where regimen in (select new_name from shared) group by 1",
    "match_status": f"with {STATUS} select * from statuses",
    "match_summary": f"with {STATUS} select s as status, count(regimen) as regimens from (select unnest(['correct', 'partial', 'failed']) as s) left join statuses on status = s group by 1",
    "exact_counters": f"""with {CHECK},
        one_new as (select regName, min(regString) as a, max(regString) as b from newer_final group by 1),
        one_old as (select regName, min(regString) as c, max(regString) as d from older_final group by 1)
        select count(*) filter (where a = b and c = d and a = c) as matched, count(*) filter (where not (a = b and c = d and a = c)) as mismatched
        from shared join one_new n on n.regName = new_name join one_old o on o.regName = old_name""",
    "report_lines": f"with {REPORT} select * from report",
    "expectations": f"""with {SCHED}
        select 'hot_gear_present' as "check", coalesce(max(lower(component) = 'hot gear'), false) as passed from sched
        union all select 'thalidomide_present', coalesce(max(lower(component) = 'thalidomide'), false) from sched
        union all select 'bisophonate_absent', not coalesce(max(lower(component) = 'bisophonate'), false) from sched
        union all select 'hot_gear_absent', not coalesce(max(lower(component) = 'hot gear'), false) from sched
        union all select 'not_empty', count(*) > 0 from sched
        union all select 'condition_everywhere', count(condition) = count(*) from sched""",
}

ORACLES |= {
    "missing_days": f"with {SCHED} select * from sched where coalesce(allDays, '') = ''",
    "match_counts": f"""with {EXTRACT}
        select hvc_col, count(*) as matches, count(distinct term) as terms, count(distinct doc_id) as rows from matches group by 1""",
    "explode_multiplicity": f"""with {EXTRACT},
        copies as (select doc_id, term, unnest(range(occurrences)) as copy from matches),
        every as (
          select doc_id, lang as component, source as study from documents
          union all select d.doc_id, c.term, d.source from documents d join copies c using (doc_id))
        select doc_id, component, study, count(*) as copies from every group by all""",
}
