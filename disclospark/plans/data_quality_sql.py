"""DuckDB SQL of the data-quality queries that SQL can express on whole tables."""

from __future__ import annotations

from .disclosures_sql import _blank, _date, _range, _squeeze, _ticker, _trim

_P2 = f"""
with b as (
 select line_no, snapshot_no, nullif(regexp_replace({_trim('docid')}, '\\.0+$', ''), '') as docid,
  {_date(f"regexp_replace({_trim('filingdate')}, '(?s)[T ]+[0-9]{{1,2}}:[0-9]{{2}}.*$', '')")} as day, coalesce({_squeeze('member')}, '') as member
 from filing_index
), l as (
 select * from b where docid is not null and snapshot_no is not null qualify row_number() over (partition by snapshot_no, docid order by line_no desc) = 1
), s as (
 select snapshot_no, lag(snapshot_no) over (order by snapshot_no) as before from (select distinct snapshot_no from l)
), n as (select l.*, s.before from l join s using (snapshot_no) where s.before is not null),
o as (select l.docid, l.day, l.member, s.snapshot_no from l join s on l.snapshot_no = s.before)
select coalesce(n.docid, o.docid) as docid, coalesce(n.snapshot_no, o.snapshot_no) as snapshot_no,
 case when o.docid is null then 'added' when n.docid is null then 'removed' else 'changed' end as change_kind
from n full join o on n.docid = o.docid and n.snapshot_no = o.snapshot_no
where o.docid is null or n.docid is null or n.day is distinct from o.day or n.member <> o.member
"""

_MONEY = r"\$?([0-9]{1,3}(,[0-9]{3})+|[0-9]+)"
_FIELDS = ("politician", "transaction_date", "filing_date", "ticker", "asset_name", "asset_type", "type", "amount", "owner", "source_id")


def _lines(sep: str, escaped: str) -> str:
    field = f'("([^"]|"")*"|[^"{escaped}]*)'
    return f"""select line_id, separator, regexp_full_match(t, '(?s){field}([{escaped}]{field})*') as sound,
 regexp_extract_all('{sep}' || t, '(?s)[{escaped}]{field}', 1) as raw from r where separator = '{sep}'"""


def _all_lines() -> str:
    parts = " union all ".join(_lines(s, e) for s, e in ((",", ","), (";", ";"), ("|", "|"), ("\t", "\\t")))
    unquoted = "list_transform(raw, lambda x: case when x like '\"%' then replace(x[2:-2], '\"\"', '\"') else x end)"
    value = {f: f"f[{i + 1}]" for i, f in enumerate(_FIELDS)}
    t = _trim(value["amount"])
    pair = rf"^{_MONEY}\s*[-–]\s*{_MONEY}$"
    end = lambda n: f"try_cast(replace(regexp_extract({t}, '{pair}', {n}), ',', '') as bigint)"
    amount_ok = (
        f"({_blank(value['amount'])} or regexp_matches({t}, '^{_MONEY}$') or regexp_matches({t}, '(?i)^over\\s+{_MONEY}$') or "
        f"regexp_matches({t}, '(?i)^{_MONEY}\\s*[-–]\\s*over$') or (regexp_matches({t}, '{pair}') and {end(1)} <= {end(3)}))"
    )
    return f"""with r as (select line_id, separator, regexp_replace(coalesce(line_text, ''), '[\\r\\n]+$', '') as t from raw_lines),
 p as ({parts}), q as (select *, {unquoted} as f from p),
 e as (select *, case when not sound then 'broken_quoting' when len(f) <> 10 then 'wrong_column_count'
  when not regexp_matches({value['politician']}, '\\p{{L}}') or not regexp_matches({value['asset_name']}, '\\p{{L}}') or not {amount_ok} then 'invalid_value' end as reason from q)
"""


def _loaded() -> str:
    v = {f: f"f[{i + 1}]" for i, f in enumerate(_FIELDS)}
    lo, hi = _range(v["amount"])
    plain = ", ".join(f"{v[f]} as {f}" for f in ("politician", "asset_name", "asset_type", "type", "owner", "source_id"))
    return _all_lines() + (
        f"select line_id, {plain}, {_date(v['transaction_date'])} as tx_day, {_date(v['filing_date'])} as filed_day, {_ticker(v['ticker'])} as symbol, "
        f"{lo} as amount_min, {hi} as amount_max from e where reason is null"
    )


_EQUAL = ", ".join(
    f"count(*) filter (leaf <> '' and {f} is not null) as n_{f}, count(*) filter (leaf <> '' and leaf = {f}) as e_{f}" for f in _FIELDS
)
_SHARES = ", ".join(f"{{'f': '{f}', 's': case when n_{f} > 0 then e_{f} / n_{f} else 0 end, 'e': e_{f}}}" for f in _FIELDS)
# what a key holds is told by content alone: the column it equals most often, the key that equals a column most often
_P6_MEANINGS = f"""
with j as (select *, json(raw_json) as js from raw_transactions where json_valid(raw_json) and json_type(raw_json) = 'OBJECT'),
k as (select j.*, unnest(json_keys(js)) as key from j),
v as (select *, json_extract(js, '$."' || key || '"') as val from k),
l as (select *, json_type(val) as kind, case json_type(val) when 'OBJECT' then json_extract_string(val, '$."' || json_keys(val)[1] || '"')
  when 'ARRAY' then json_extract_string(val, '$[0]') else json_extract_string(val, '$') end as leaf from v),
g as (select feed, batch_no, key, {_EQUAL},
  mode(case when kind in ('UBIGINT', 'BIGINT', 'DOUBLE') then 'number' when kind <> 'NULL' then kind end) as kind from l group by all),
c as (select feed, batch_no, key, kind, unnest([{_SHARES}]) as u from g),
b as (select feed, batch_no, key, u.f as field, u.s as share from c where u.s >= 0.5 and u.e > 0
  qualify row_number() over (partition by feed, batch_no, key order by u.s desc, u.e desc) = 1 and row_number() over (partition by feed, batch_no, u.f order by u.s desc, u.e desc) = 1),
m as (select g.feed, g.batch_no, g.key, g.kind, coalesce('known ' || b.field, 'other ' || g.key) as meaning from g left join b using (feed, batch_no, key))
"""
_P6 = _P6_MEANINGS + f""",
f as (select feed, batch_no, lag(batch_no) over (partition by feed order by batch_no) as before from (select distinct feed, batch_no from raw_transactions)),
n as (select m.*, f.before from m join f using (feed, batch_no) where f.before is not null),
o as (select m.feed, f.batch_no, m.key, m.kind, m.meaning from m join f on m.feed = f.feed and m.batch_no = f.before),
x as (select coalesce(n.feed, o.feed) as feed, coalesce(n.batch_no, o.batch_no) as batch_no, o.key as old_key, n.key as new_key, o.kind as k0, n.kind as k1
  from n full join o on n.feed = o.feed and n.batch_no = o.batch_no and n.meaning = o.meaning)
select feed, batch_no, 'added' as change_kind, '' as old_key, new_key from x where old_key is null
union all select feed, batch_no, 'removed', old_key, '' from x where new_key is null
union all select feed, batch_no, 'renamed', old_key, new_key from x where old_key <> new_key
union all select feed, batch_no, 'retyped', new_key, new_key from x where k0 <> k1
"""

# the ten fields by the key that bears each, all other values as one object; values nest one deep
_P6_TABLE = _P6_MEANINGS + f""",
y as (select row_id, feed, batch_no, field, leaf, unnest(case when field is not null then [null] when kind = 'OBJECT' then list_transform(json_keys(val), lambda m: [key || '.' || m, json_extract_string(val, '$."' || m || '"')])
  when kind = 'ARRAY' then list_transform(range(json_array_length(val)::bigint), lambda i: [key || '[' || i || ']', json_extract_string(val, '$[' || i || ']')]) else [[key, leaf]] end) as kv
  from l left join b using (feed, batch_no, key)),
o as (select row_id, {", ".join(f"max(leaf) filter (field = '{f}') as {f}" for f in _FIELDS)},
  map(list(kv[1] order by kv[1]) filter (kv is not null), list(kv[2] order by kv[1]) filter (kv is not null)) as rest from y group by row_id)
select row_id, feed, batch_no, {", ".join(f"o.{f}" for f in _FIELDS)}, case when json_valid(raw_json) and json_type(raw_json) = 'OBJECT' then coalesce(cast(to_json(rest) as varchar), '{{}}') end as others
from raw_transactions left join o using (row_id)
"""

ORACLE = {
    "p6_table": _P6_TABLE,
    "p6_found": _P6,
    "p2_found": _P2,
    "p3_found": _all_lines() + "select line_id, reason from e where reason is not null",
    "p3_loaded": _loaded(),
}
