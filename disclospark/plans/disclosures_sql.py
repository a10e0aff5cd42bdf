"""DuckDB SQL of the disclosure queries, written from the rules, not from the engine's expressions."""

from __future__ import annotations

_SPACES = r"[\t\n\x0B\f\r \x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"


def _trim(c: str) -> str:
    return f"regexp_replace({c}, '^{_SPACES}+|{_SPACES}+$', '', 'g')"


def _squeeze(c: str) -> str:
    return _trim(f"regexp_replace({c}, '{_SPACES}+', ' ', 'g')")


def _blank(c: str) -> str:
    return f"coalesce({_trim(c)} = '', true)"


def _date(c: str) -> str:
    t = _trim(c)
    part = lambda p, n: f"regexp_extract({t}, '{p}', {n})"
    iso, us = r"^(\d{1,4})-(\d{1,2})-(\d{1,2})$", r"^(\d{1,2})/(\d{1,2})/(\d{1,4})$"
    made = lambda y, m, d: (
        f"try_cast(printf('%04d-%02d-%02d', case when length({y}) <= 2 then {y}::int + 2000 else {y}::int end, {m}::int, {d}::int) as date)"
    )
    return (
        f"case when regexp_matches({t}, '{iso}') then {made(part(iso, 1), part(iso, 2), part(iso, 3))} "
        f"when regexp_matches({t}, '{us}') then {made(part(us, 3), part(us, 1), part(us, 2))} end"
    )


def _money(c: str) -> str:
    return f"coalesce(try_cast(regexp_extract(replace(replace(regexp_replace({c}, '\\s', '', 'g'), '$', ''), ',', ''), '^[+-]?[0-9]+') as bigint), 0)"


def _range(c: str) -> tuple[str, str]:
    t = _trim(c)
    over, to_over, pair = r"^(?is)over\s+(.+)$", r"^(?s)(.+?)\s*[-–]\s*[Oo]ver.*$", r"^(?s)(.+?)\s*[-–]\s*(.+)$"
    g = lambda p, n: f"regexp_extract({t}, '{p}', {n})"
    m = lambda p: f"regexp_matches({t}, '{p}')"
    lo = f"case when {_blank(c)} then 0 when {m(over)} then {_money(g(over, 1))} when {m(to_over)} then {_money(g(to_over, 1))} when {m(pair)} then {_money(g(pair, 1))} else {_money(t)} end"
    hi = f"case when {_blank(c)} or {m(over)} or {m(to_over)} then null when {m(pair)} then {_money(g(pair, 2))} else {_money(t)} end"
    return f"cast({lo} as bigint)", f"cast({hi} as bigint)"


def _side(c: str) -> str:
    k = f"lower({_trim(c)})"
    return f"case when {k} = 'purchase' then 'buy' when {k} in ('sale', 'sale (full)', 'sale (partial)', 'sale_full', 'sale_partial') then 'sell' end"


def _owner(c: str) -> str:
    k = f"lower({_trim(c)})"
    return (
        f"case when {k} in ('joint', 'joint (self)') then 'joint' when {k} in ('spouse', 'sp') then 'spouse' "
        f"when {k} in ('child', 'dependent', 'dc') then 'child' else 'self' end"
    )


def _ticker(c: str) -> str:
    k = f"upper({_trim(c)})"
    return f"case when {k} not in ('', '--', 'N/A', 'NA') then {k} end"


_LO, _HI = _range("amount")
_NORMAL = f"""
with r as (
 select *, {_date('transaction_date')} as tx, {_date('filing_date')} as filed, {_side('type')} as side from raw_transactions
), n as (
 select row_id, batch_no, {_trim('politician')} as politician, coalesce(tx, filed) as transaction_date, coalesce(filed, tx) as filing_date,
  {_ticker('ticker')} as ticker, {_trim('asset_name')} as asset_name, {_trim('asset_type')} as asset_type, side as type,
  {_LO} as amount_min, {_HI} as amount_max, {_owner('owner')} as owner,
  case when {_blank('politician')} then 'missing_politician'
   when {_blank('r.transaction_date')} and {_blank('r.filing_date')} then 'missing_both_dates'
   when {_blank('asset_name')} then 'missing_asset_name'
   when side is null then 'unrecognized_type'
   when tx is null and filed is null then 'unparseable_dates' end as skip_reason
 from r
), k as (
 select * exclude (skip_reason), lower(politician) || '|' || strftime(transaction_date, '%Y-%m-%d') || '|' || lower(asset_name) || '|'
  || amount_min || '|' || coalesce(cast(amount_max as varchar), '') as key
 from n where skip_reason is null
)
"""
_SERVED = """id, politician as filer_name, 'congress' as filer_type, cast(null as varchar) as party,
 case when type = 'buy' then 'purchase' else 'sale' end as trade_type, ticker, cast(null as varchar) as company_name, asset_name, asset_type,
 amount_min as amount_low, amount_max as amount_high, cast(floor((amount_min + amount_max) / 2.0 + 0.5) as bigint) as amount_midpoint,
 transaction_date as trade_date, filing_date, cast(null as int) as filing_delay_days, owner, cast(null as int) as score,
 cast(null as varchar) as score_breakdown, cast(null as varchar) as cluster_id, true as is_active"""
_FIRST = _NORMAL + ", u as (select *, sha256(key) as id, row_number() over (partition by key order by row_id) as rn from k)"
_HTML = ["transaction_date", "owner", "ticker", "asset_name", "asset_type", "type", "amount"]
_CELL = {c: f"trim({_squeeze(f'coalesce({c}, $$$$)')})" for c in ("politician", "filing_date", *_HTML)}

ORACLE = {
    "normalize_full": _NORMAL + "select * exclude (batch_no, key) from k",
    "type_map": f"select type, {_side('type')} as side, count(*) as n from raw_transactions group by all",
    "owner_map": f"select owner, {_owner('owner')} as code, count(*) as n from raw_transactions group by all",
    "ticker_norm": f"select row_id, {_ticker('ticker')} as symbol from raw_transactions",
    "amount_range": f"select row_id, {_LO} as amount_min, {_HI} as amount_max from raw_transactions",
    "amount_integer": f"select row_id, {_money('amount')} as dollars from raw_transactions",
    "date_parse": f"select row_id, {_date('transaction_date')} as tx, {_date('filing_date')} as filed from raw_transactions",
    "cross_fill_dates": _NORMAL + "select row_id, transaction_date, filing_date from n",
    "trim_text": f"select row_id, {_trim('politician')} as politician, {_trim('asset_name')} as asset_name, {_trim('asset_type')} as asset_type from raw_transactions",
    "midpoint": "select id, cast(floor((amount_min + amount_max) / 2.0 + 0.5) as bigint) as midpoint from transactions",
    "form_date": "select id, strftime(filing_date, '%m/%d/%Y') as form_date from transactions",
    "member_name": "select member_row, concat_ws(' ', nullif(first, ''), nullif(last, ''), nullif(suffix, '')) as member from raw_members",
    "rolling_window": "select id, filing_date from transactions where filing_date >= (select max(filing_date) - 90 from transactions)",
    "skip_reasons": _NORMAL + "select row_id, skip_reason from n where skip_reason is not null",
    "skip_reason_counts": _NORMAL + "select coalesce(skip_reason, 'kept') as reason, count(*) as n from n group by 1",
    "validation_errors": _NORMAL
    + """select row_id, concat_ws('; ', case when transaction_date is null then 'invalid transaction_date' end, case when filing_date is null then 'invalid filing_date' end,
 case when amount_min > amount_max then 'amount_min exceeds amount_max' end, case when type is null then 'invalid type' end) as errors from n""",
    "filter_politician_like": _NORMAL + "select row_id, politician from k where translate(politician, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') like '%ursula%gryvé%'",
    "filter_politician_contains": _NORMAL + "select row_id, politician from k where contains(lower(politician), 'gryvél')",
    "filter_ticker": """select id, ticker from transactions where ticker = (select ticker from transactions where ticker is not null group by 1
 order by count(*) desc, ticker limit 1)""",
    "source_dispatch": f"select 'json' as kind, count(*) as n from raw_transactions union all select 'html', count(*) from raw_transactions where {_CELL['politician']} <> ''",
    "html_fallback": f"select {_CELL['asset_name']} as asset_name, count(*) as n from raw_transactions group by 1",
    "run_partial_rule": """select user_id, count(*) filter (event_type = 'error') * 4 > count(*) or count(*) filter (event_type = 'purchase') = 0 as partial from events group by 1""",
    "run_log": _FIRST + """, c as (select (select count(*) from n) as ingested, (select count(*) from u where rn = 1) as inserted, (select count(*) from n where skip_reason is not null) as skipped)
 select ingested, inserted, skipped, 0 as errors, cast(null as varchar) as error from c union all select ingested, 0, skipped, 0, null from c union all select 0, 0, 0, 1, 'no source'""",
    "health_and_debug": _FIRST + """select 'ok' as status, count(*) as db_count, count(*) as raw_count, count(*) as congress, count(*) as table_rows, true as ok, 0 as inserted_again from u where rn = 1""",
    "parameter_checks": """select * from (values (0, ''), (1, 'type'), (2, 'limit,owner'), (3, 'limit,offset'), (4, 'date_from'), (5, 'limit'), (6, ''), (7, '')) t(case_no, refused)""",
    "configuration": """select * from (values (0, 90, '0 */6 * * *', 'info', './data/transactions'), (1, 7, '0 */6 * * *', 'warn', '/x'), (2, null, null, null, null), (3, null, null, null, null),
 (4, null, null, null, null)) t(case_no, days, schedule, level, store)""",
    "filter_type_owner": "select id, type, owner from transactions where type = 'buy' and owner = 'joint'",
    "filter_date_range": "select id, transaction_date from transactions where transaction_date between date '2018-01-01' and date '2019-12-31'",
    "conjunction_page": _FIRST
    + f"select {_SERVED} from u where rn = 1 and type = 'buy' and owner = 'self' and transaction_date >= date '2016-01-01' order by transaction_date desc, row_id limit 200 offset 20",
    "dedup_key_text": _NORMAL + "select row_id, key from k",
    "stable_ids": _NORMAL + "select row_id, sha256(key) as id from k",
    "stored_ids": """select id, sha256(lower(trim(politician)) || '|' || strftime(transaction_date, '%Y-%m-%d') || '|' || lower(trim(asset_name)) || '|' || amount_min || '|' ||
 coalesce(cast(amount_max as varchar), '')) as computed from transactions""",
    "dedup_in_batch": _FIRST + "select id, row_id from u where rn = 1",
    "dedup_vs_existing": _FIRST + "select id, row_id from u where id not in (select id from transactions)",
    "insert_or_ignore": _FIRST + "select id, row_id from u where rn = 1 and id not in (select id from transactions)",
    "source_id_antifilter": """select row_id, source_id from raw_transactions a where batch_no > 6 and not exists
 (select 1 from raw_transactions b where b.batch_no <= 6 and a.source_id = b.source_id)""",
    "union_pages": "select feed, count(*) as n, cast(sum(row_id) as bigint) as ids from raw_transactions group by feed",
    "union_chambers": """select case when feed = 'house_ptr' then 'house' when feed like 'senate%' then 'senate' else 'archive' end as chamber, count(*) as n,
 count(distinct politician) as filers from raw_transactions group by 1""",
    "append_sink": _NORMAL + "select type, 2 * count(*) as n from k group by 1",
    "unique_sink": _FIRST
    + "select id, politician, transaction_date, filing_date, ticker, asset_name, coalesce(asset_type, '') as asset_type, type, amount_min, amount_max, owner from u where rn = 1",
    "stream_ingest": _NORMAL + "select distinct sha256(key) as id from k",
    "row_decode": "select id, coalesce(asset_type, '') as asset_type, coalesce(amount_min, 0) as amount_min, coalesce(owner, 'self') as owner from transactions",
    "serve_projection": f"select {_SERVED}, 0 as filters_passed, created_at from transactions",
    "limit_offset": "select id, transaction_date from transactions order by transaction_date desc, id limit 100 offset 50",
    "page_count": "select least(count(*), 1000) as count from transactions where owner = 'child'",
    "count_all": "select count(*) as n from transactions",
    "source_counts": "select count(*) as congress, cast(0 as bigint) as insiders from transactions",
    "run_stats": _NORMAL + "select count(*) as ingested, count(*) filter (skip_reason is null) as kept, count(*) filter (skip_reason is not null) as skipped from n",
    "latest_record": "select strftime(max(created_at), '%Y-%m-%d %H:%M:%S') as last_updated from transactions",
    "every_asset_blank": f"select feed, batch_no, bool_and({_blank('asset_name')}) as all_blank from raw_transactions group by all",
    "partial_failure_rule": """select user_id, count(*) filter (event_type = 'error') as errors, count(*) as filings,
 count(*) filter (event_type = 'error') * 4 > count(*) as partial from events group by 1""",
    "json_hits_parse": """select coalesce(politician, '') as politician, coalesce(transaction_date, '') as transaction_date, coalesce(filing_date, '') as filing_date,
 coalesce(ticker, '') as ticker, coalesce(asset_name, '') as asset_name, coalesce(asset_type, '') as asset_type, coalesce(type, '') as type,
 coalesce(amount, '') as amount, coalesce(owner, '') as owner, row_id || '/' || source_id as source_id from raw_transactions where source_id is not null""",
    "events_props_json": "select event_id, array_to_string(list_sort(json_keys(props)), ',') as keys from events",
    "listing_scan": """select first || ' ' || last as politician, '04/09/2026' as filing_date, '/search/view/ptr/' || lower(to_hex(filer_id)) || '-ab/' as report_path,
 lower(to_hex(filer_id)) || '-ab' as ptr_uuid, chamber as office from filers where filer_id % 3 <> 0""",
    "debug_cap": "select docid, line_no from filing_index order by line_no limit 25",
    "known_ids": _FIRST + "select id from u where rn = 1 and id in (select id from transactions)",
    "html_strip_text": f"select row_id, {_squeeze('coalesce(asset_name, $$$$)')} as text from raw_transactions",
    "html_href_extract": "select id, '/view/ptr/' || id || '/' as path, id as uuid from transactions",
    "html_table_parse": f"select row_id || '|1' as source_id, {', '.join(f'{_CELL[c]} as {c}' for c in _HTML)} from raw_transactions where {_CELL['asset_name']} <> ''",
    "html_header_parse": f"""with c as (select {', '.join(f'{e} as {c}' for c, e in _CELL.items())} from raw_transactions)
select *, {_squeeze("politician || '|' || transaction_date || '|' || asset_name || '|' || amount")} as source_id from c where politician <> ''""",
    "xml_index_filter": f"""with m as (select concat_ws(' ', nullif(trim(first), ''), nullif(trim(last), ''), nullif(trim(suffix), '')) as member, {_date('filingdate')} as "filingDate",
 nullif(trim(docid), '') as "docId", try_cast(year as int) as year from raw_members where filingtype = 'P')
select * from m where member <> '' and "docId" is not null and "filingDate" between date '2023-01-01' and date '2024-12-31'""",
    "ptr_text_parse": """select politician, strftime(transaction_date, '%m/%d/%Y') as transaction_date, ticker, asset_name, 'ST' as asset_type, 'Purchase' as type,
 case when amount_max is null then 'Over $' || format('{:,}', amount_min) else '$' || format('{:,}', amount_min) || ' - $' || format('{:,}', amount_max) end as amount,
 'Spouse' as owner, id || '|0' as source_id from transactions""",
    "volume_last_30d": "select cast(ts as date) as date, count(*) as count from events where cast(ts as date) > (select max(cast(ts as date)) - 30 from events) group by 1",
    "filer_leaderboard": """select politician, count(*) as total_trades, count(*) filter (type = 'buy') as buys, round(count(*) filter (type = 'buy') / count(*), 6) as buy_share,
 cast(sum(amount_min) as bigint) as amount_low_sum, max(transaction_date) as last_trade from transactions group by 1 order by 2 desc, 1 limit 25""",
    "ticker_clusters": """select ticker, count(distinct politician) as filers, count(*) as trades, min(transaction_date) as first_trade, max(transaction_date) as last_trade,
 sha256(ticker) as cluster_id from transactions where ticker is not null group by 1 having count(distinct politician) >= 2""",
    "filing_delay": "select id, cast(filing_date - transaction_date as int) as days from transactions",
    "stale_flag": "select id, (select max(transaction_date) from transactions) - transaction_date > 365 as stale from transactions",
}
