"""The queries that SQL can express, for another engine."""

from __future__ import annotations

from sunledger.llm.license_scan import LICENSE_FILE, TERM, THRESHOLD, Templates

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SEARCH_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

def license_sql(share: float) -> str:
    """Every line, paragraph and text against every template, without the operator's pruning."""
    known = Templates()
    idf = ", ".join(f"('{term}', {value})" for term, value in known.idf.items())
    postings = ", ".join(
        f"('{term}', {i}, {n * known.idf[term]})" for i, count in enumerate(known.counts) for term, n in count.items()
    )
    names = ", ".join(f"({i}, '{name}')" for i, name in enumerate(known.names))
    return f"""
  with idf(term, idf) as (values {idf}),
  posting(term, template, weight) as (values {postings}),
  name(template, license) as (values {names}),
  template as (
    select template, license, sum(weight * weight)::double as norm from posting join name using (template) group by all
  ), f as (
    select doc_id, concat_ws('/', coalesce(source, 'none'), coalesce(lang, 'none'),
        coalesce(floor(doc_id / 1000)::bigint::varchar, 'none'), doc_id::varchar) as path,
      lower(coalesce(text, '')) as text
    from documents
  ), u as (
    select distinct path, unnest(list_concat(string_split_regex(text, '\\r?\\n'),
      string_split_regex(text, '\\r?\\n[\\x20\\t]*\\r?\\n'), [text])) as unit
    from f
  ), w as (
    select path, unit, w.term, count(*) as n, count(*) * coalesce(any_value(idf), {known.unseen}) as weight
    from (select path, unit, unnest(regexp_extract_all(unit, '{TERM}')) as term from u) w
      left join idf on idf.term = w.term
    group by all
  ), norm as (
    select path, unit, sum(weight * weight)::double as norm, sum(n) as terms from w group by all
  ), dot as (
    select path, unit, template, sum(w.weight * p.weight)::double as dot
    from w join posting p on w.term = p.term group by all
  ), own as (
    select path, arg_max(license, (score, -template)) as license, max(score) as score,
      arg_max(terms, (score, -template, terms)) as terms
    from (
      select path, template, license, terms, dot / (sqrt(n.norm) * sqrt(t.norm)) as score
      from dot join norm n using (path, unit) join template t using (template)
    ) where score >= {THRESHOLD} group by path
  ), d as (
    select doc_id, f.path, regexp_replace(f.path, '/[^/]*$', '') as directory, license, score,
      least(1.0, terms::double / nullif(len(regexp_extract_all(text, '{TERM}')), 0)) as share
    from f left join own on f.path = own.path
  ), giving as (
    select directory, arg_min(license, (-score, license)) as license, max(score) as score
    from d where license is not null and (share >= {share}
      or regexp_matches(regexp_extract(path, '([^/]*)$', 1), '{LICENSE_FILE}'))
    group by directory
  ), near as (
    select d.path, arg_max(g.directory, length(g.directory)) as from_directory,
      arg_max(g.license, length(g.directory)) as license, arg_max(g.score, length(g.directory)) as score
    from d join giving g on g.directory = '' or d.directory = g.directory or starts_with(d.directory, g.directory || '/')
    group by d.path
  )
  select doc_id, d.path, coalesce(d.license, n.license) as license, round(coalesce(d.score, n.score), 6) as score,
    case when d.license is not null then 'notice' when n.license is not null then 'inherited' end as found,
    case when d.license is null then n.from_directory end as from_directory
  from d left join near n on d.path = n.path"""


MIXING = """
  with recursive d as (
    select doc_id, source, lang,
      case when contains(lower(coalesce(text, '')), 'license') or contains(lower(coalesce(text, '')), 'licence')
             or contains(lower(coalesce(text, '')), 'copyright') then 'legal'
           when contains(text, '@') or contains(lower(text), 'http://') or contains(lower(text), 'https://')
             then 'contact'
           when contains(text, ' | ') then 'table' else 'prose' end as topic,
      greatest(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')), 1) as tokens
    from documents
  ), c as (
    select source, lang, topic, sum(tokens)::double as tokens from d group by all
  ), s0 as (
    select source, sum(tokens) as tokens, pow(sum(tokens), 0.9) / sum(pow(sum(tokens), 0.9)) over () as share from c group by source
  ), s1 as (
    select *, share / tokens as rate, (select sum(tokens) from c) * 0.5 as goal from s0
  ), s as (
    select source, tokens * least(1, rate * coalesce(max(case when tried * rate < 1 then tried end) over (), 1 / min(rate) over ())) as goal
    from (select *, (goal - coalesce(sum(tokens) over (order by rate desc rows between unbounded preceding and 1 preceding), 0))
        / sum(tokens * rate) over (order by rate desc rows between current row and unbounded following) as tried from s1)
  ), l0 as (
    select lang, sum(tokens) as tokens, pow(sum(tokens), 0.9) / sum(pow(sum(tokens), 0.9)) over () as share from c group by lang
  ), l1 as (
    select *, share / tokens as rate, (select sum(tokens) from c) * 0.5 as goal from l0
  ), l as (
    select lang, tokens * least(1, rate * coalesce(max(case when tried * rate < 1 then tried end) over (), 1 / min(rate) over ())) as goal
    from (select *, (goal - coalesce(sum(tokens) over (order by rate desc rows between unbounded preceding and 1 preceding), 0))
        / sum(tokens * rate) over (order by rate desc rows between current row and unbounded following) as tried from l1)
  ), t0 as (
    select topic, sum(tokens) as tokens, pow(sum(tokens), 0.9) / sum(pow(sum(tokens), 0.9)) over () as share from c group by topic
  ), t1 as (
    select *, share / tokens as rate, (select sum(tokens) from c) * 0.5 as goal from t0
  ), t as (
    select topic, tokens * least(1, rate * coalesce(max(case when tried * rate < 1 then tried end) over (), 1 / min(rate) over ())) as goal
    from (select *, (goal - coalesce(sum(tokens) over (order by rate desc rows between unbounded preceding and 1 preceding), 0))
        / sum(tokens * rate) over (order by rate desc rows between current row and unbounded following) as tried from t1)
  ), g as (
    select c.*, s.goal as s_goal, l.goal as l_goal, t.goal as t_goal
    from c join s on c.source is not distinct from s.source join l on c.lang is not distinct from l.lang
      join t on c.topic = t.topic
  ), ipf as (
    select 0 as k, g.*, 1e0 as fs, 1e0 as fl, 1e0 as ft from g
    union all
    select k + 1, source, lang, topic, tokens, s_goal, l_goal, t_goal, fs, fl, ft from (
      with now as (select * from ipf where k < 60),
      a as (
        select * exclude (rate, tried, fs), coalesce(max(case when tried * rate < 1 then tried end) over (partition by source),
          1 / min(rate) over (partition by source)) as fs
        from (
          select *, (s_goal - coalesce(sum(tokens) over (partition by source order by rate desc rows between unbounded preceding and 1 preceding), 0))
            / sum(tokens * rate) over (partition by source order by rate desc rows between current row and unbounded following) as tried
          from (select *, fl * ft as rate from now)
        )
      ),
      b as (
        select * exclude (rate, tried, fl), coalesce(max(case when tried * rate < 1 then tried end) over (partition by lang),
          1 / min(rate) over (partition by lang)) as fl
        from (
          select *, (l_goal - coalesce(sum(tokens) over (partition by lang order by rate desc rows between unbounded preceding and 1 preceding), 0))
            / sum(tokens * rate) over (partition by lang order by rate desc rows between current row and unbounded following) as tried
          from (select *, fs * ft as rate from a)
        )
      ),
      e as (
        select * exclude (rate, tried, ft), coalesce(max(case when tried * rate < 1 then tried end) over (partition by topic),
          1 / min(rate) over (partition by topic)) as ft
        from (
          select *, (t_goal - coalesce(sum(tokens) over (partition by topic order by rate desc rows between unbounded preceding and 1 preceding), 0))
            / sum(tokens * rate) over (partition by topic order by rate desc rows between current row and unbounded following) as tried
          from (select *, fs * fl as rate from b)
        )
      )
      select * from e
    )
  ), r as (
    select source, lang, topic, least(1, fs * fl * ft) as probability from ipf where k = 60
  )
  select doc_id, d.source, d.lang, d.topic, d.tokens::bigint as tokens, round(probability / 0.5, 6) as weight,
    round(probability, 6) as probability,
    ('0x' || substr(md5('7:' || coalesce(doc_id::varchar, 'null')), 1, 13))::bigint / 4503599627370496.0
      < probability as kept
  from d join r on d.source is not distinct from r.source and d.lang is not distinct from r.lang
    and d.topic = r.topic"""

#: Every document scored for every item.
RANKED = f"""
  with d as (
    select row_number() over () as row, doc_id,
      regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{SEARCH_TERM}') as terms
    from documents
  ), total as (
    select count(*) as n, sum(len(terms))::bigint as words from d where len(terms) > 0
  ), q as (
    select item_id, text, unnest(list_distinct(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{SEARCH_TERM}'))) as term
    from (select distinct item_id, text from benchmark)
  ), tf as (
    select row, term, count(*) as tf
    from (select row, unnest(terms) as term from d) where term in (select term from q) group by all
  ), weight as (
    select term, floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1)))::bigint as w from tf, total group by term
  ), norm as (
    select row, doc_id, 100 - 50 + ((50 * len(terms) * n) // words) as m from d, total
  ), scored as (
    select item_id, text, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
    from q join tf using (term) join weight using (term) join norm using (row) group by item_id, text, row, doc_id
  )
  select item_id, rank, doc_id, score from (
    select *, row_number() over (partition by item_id, text order by score desc, doc_id nulls last)::int as rank
    from scored where score > 0
  ) where rank <= 50"""

ORACLE: dict[str, str] = {
    "op1_license_scan": license_sql(0.2),
    "op5_mixing": MIXING,
    "op6_exact_dedup": f"""
      with t as (
        select doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')) as text_sha256
        from documents
      ), g as (
        select text_sha256, max(doc_id) as keep_id, count(*) as group_size from t group by 1
      )
      select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from t join g using (text_sha256)""",
    "op11_ranked_search": RANKED,
}
