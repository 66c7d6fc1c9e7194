"""The license scan in DuckDB SQL: joins and windows in place of array passes."""

from __future__ import annotations

from seamark.llm.license_rules import rules
from seamark.llm.licenses import LOWER, SEPARATORS, UPPER


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def license_sql() -> str:
    values = ",\n".join(f"({r.number}, {quoted(r.label)}, {r.priority}, {r.score}, {quoted(r.keyword)}, [{', '.join(map(quoted, r.names))}], {quoted(r.pattern)}, {r.base})" for r in rules())
    return rf"""
with rules(rule, label, priority, score, keyword, names, pattern, base) as (values {values}),
words as (
  select row_number() over () as rid, doc_id,
         trim(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SEPARATORS}', '  ', 'g'), ' ') as w
  from documents),
norm as (select rid, doc_id, case when w = '' then '' else ' ' || w || ' ' end as norm from words),
tried as (
  select rid, rule, label, priority, cast(score as double) as score, base,
         list_transform(regexp_extract_all(norm, pattern), lambda s: (length(s) - length(replace(s, ' ', ''))) // 2) as sizes,
         list_transform(string_split_regex(norm, pattern), lambda s: (length(s) - length(replace(s, ' ', ''))) // 2) as gaps
  from norm join rules on contains(norm, keyword) and list_bool_or(list_transform(names, lambda x: contains(norm, x)))),
numbered as (select *, unnest(generate_series(1, len(sizes))) as i from tried where len(sizes) > 0),
spans as (
  select rid, rule, label, priority, score, base,
         cast(list_sum(gaps[1:i]) + coalesce(list_sum(sizes[1:i - 1]), 0) as bigint) as start, cast(sizes[i] as bigint) as size
  from numbered),
stays as (
  select * from spans d where not base and not exists (
    select 1 from spans o where not o.base and o.rid = d.rid
      and ((o.start <= d.start and o.start + o.size >= d.start + d.size) or (o.start >= d.start and o.start + o.size <= d.start + d.size))
      and (o.priority < d.priority or (o.priority = d.priority and (o.size > d.size or (o.size = d.size and o.rule < d.rule)))))),
based as (
  select rid, count(*) as n_base, min(start) as first_word, max(start) as last_word, string_agg(distinct label, ',' order by label) as base_labels
  from spans where base group by rid),
labelled as (
  select rid, string_agg(distinct label, ',' order by label) as labels, max(score) as score
  from (select rid, label, score from spans where base union all select rid, label, score from stays) group by rid)
select doc_id, cast((length(norm) - length(replace(norm, ' ', ''))) // 2 as bigint) as n_words, coalesce(n_base, 0) as n_base,
       first_word, last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0) as score
from norm left join based using (rid) left join labelled using (rid)
"""
