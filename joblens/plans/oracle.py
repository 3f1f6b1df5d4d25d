"""DuckDB oracle SQL for the query catalogue.

Written independently of the Spark code (CASE chains, string_split, unnest)
so the driver's side-by-side run is a real second opinion.  Tables are the
driver's pre-registered views.  Python only splices shared CTEs together.
"""

from __future__ import annotations

# --- shared CTEs ------------------------------------------------------------

LISTINGS = r"""
base as (
  select o_orderkey k, o_custkey c, o_orderpriority p, cast(o_orderdate as date) query_day,
         cast(floor(o_totalprice/10000) as bigint)+1 a,
         (cast(o_orderkey as bigint)//5)%6 variant
  from orders),
nums as (
  select *, a+1+k%10 b, format('{:,}', a*100) u1, format('{:,}', a*100+500) u2 from base),
listings as (
  select k as listing_id, variant, query_day,
    ['topcv','careerlink','careerviet','itviec','vietnamworks'][k%5+1] as source,
    'Kỹ sư ' || p as position,
    'Công ty ' || c as company,
    ['Hà Nội','Hà Nội & Hồ Chí Minh','Đà Nẵng, Cần Thơ','Hồ Chí Minh'||chr(10)||'Bình Dương','Bà Rịa - Vũng Tàu','Cần Thơ,'][(k//7)%6+1] as address,
    ['Không yêu cầu',((k//3)%5+1)||' năm','Dưới 1 năm','Trên 5 năm'][(k//11)%4+1] as exp,
    case k%5
      when 0 then ['Thoả thuận','Tới '||b||' triệu','Tới '||u1||' USD',a||' - '||b||' triệu',u1||' - '||u2||' USD','Trên '||a||' triệu'][variant+1]
      when 1 then ['Thương lượng',a||' triệu','Trên '||a||' triệu',a||' triệu - '||b||' triệu',u1||' USD - '||u2||' USD','Trên '||u1||' USD'][variant+1]
      when 2 then ['Lương: Cạnh tranh','Lương: Trên '||a||' Tr VND','Lương: Lên đến '||b||' Tr VND','Lương: '||a||' Tr - '||b||' Tr VND','Lương: '||u1||' - '||u2||' USD','Lương: Trên '||u1||' USD'][variant+1]
      when 3 then 'Sign in to view salary'
      else ['Thương lượng','Tới '||u1||' USD',a||' - '||b||' triệu',u1||' - '||u2||' USD','Tới $ '||u1||' /tháng',a||'tr-'||b||'tr ₫/tháng'][variant+1]
    end as salary
  from nums)"""


def _ws(x: str) -> str:
    """Python str.split(): whitespace tokens, no empties."""
    return f"list_filter(regexp_split_to_array(regexp_replace({x}, '^\\s+|\\s+$', '', 'g'), '\\s+'), lambda t: t <> '')"


def _num(x: str) -> str:
    return f"try_cast({x} as double)"


_USD = "cast(0.025 as double)"


def _single_usd(raw: str) -> str:
    """USD bound alone: convert, and above 100 treat as yearly."""
    return (
        f"(case when usd then (case when {raw}*{_USD} > 100 then floor({raw}*{_USD}/12) "
        f"else {raw}*{_USD} end) else {raw} end)"
    )


def _pair_usd(raw: str) -> str:
    return f"(case when usd then {raw}*{_USD} else {raw} end)"


# Per-site (lo, hi) candidates; the CASE tests the last rule first.
_SITE_CASES = {
    "topcv": f"""
      case
        when contains(s, '-') then {{'lo': {_pair_usd(_num("string_split(n, ' - ')[1]"))},
                                    'hi': {_pair_usd(_num(_ws("string_split(n, ' - ')[2]") + "[1]"))}}}
        when starts_with(s, 'Tới') then {{'lo': 0.0::double, 'hi': {_single_usd(_num("replace(" + _ws("s") + "[2], ',', '')"))}}}
        else {{'lo': 0.0::double, 'hi': 0.0::double}}
      end""",
    "careerlink": f"""
      case
        when contains(s, '-') then {{'lo': {_pair_usd(_num(_ws("string_split(n, ' - ')[1]") + "[1]"))},
                                    'hi': {_pair_usd(_num(_ws("string_split(n, ' - ')[2]") + "[1]"))}}}
        when contains(s, 'triệu') then {{'lo': 0.0::double,
             'hi': {_single_usd(_num("(case when len(" + _ws("n") + ") = 2 then " + _ws("n") + "[1] else " + _ws("n") + "[2] end)"))}}}
        else {{'lo': 0.0::double, 'hi': 0.0::double}}
      end""",
    "careerviet": f"""
      case
        when contains(s, '-') and contains(s, 'USD') then
             {{'lo': {_num("string_split(string_split(n, ':')[2], ' - ')[1]")}*{_USD},
              'hi': {_num(_ws("string_split(string_split(n, ':')[2], ' - ')[2]") + "[1]")}*{_USD}}}
        when contains(s, '-') and contains(s, 'Tr') then
             {{'lo': {_num(_ws("string_split(string_split(n, ':')[2], ' - ')[1]") + "[1]")},
              'hi': {_num(_ws("string_split(string_split(n, ':')[2], ' - ')[2]") + "[1]")}}}
        when contains(s, 'Lên đến') then {{'lo': 0.0::double, 'hi': {_single_usd(_num(_ws("string_split(n, ':')[2]") + "[3]"))}}}
        when contains(s, 'Trên') and not contains(s, '-') then {{'lo': 0.0::double, 'hi': {_single_usd(_num(_ws("string_split(n, ':')[2]") + "[2]"))}}}
        else {{'lo': 0.0::double, 'hi': 0.0::double}}
      end""",
    "itviec": "{'lo': 0.0::double, 'hi': 0.0::double}",
}
_SITE_CASES["vietnamworks"] = _SITE_CASES["topcv"]


def _site_case(source_col: str = "source") -> str:
    branches = "\n".join(f"    when {source_col} = '{site}' then {case}" for site, case in _SITE_CASES.items())
    return f"case\n{branches}\n    else {{'lo': 0.0::double, 'hi': 0.0::double}} end"


PARSED = f"""
stripped as (
  select *, regexp_replace(salary, '^\\s+|\\s+$', '', 'g') s,
            replace(regexp_replace(salary, '^\\s+|\\s+$', '', 'g'), ',', '') n,
            contains(salary, 'USD') usd,
            regexp_replace(exp, '^\\s+|\\s+$', '', 'g') e
  from listings),
chosen as (
  select *, {_site_case()} as pair,
    case when source = 'topcv' and contains(e, 'năm') then try_cast({_ws("e")}[-2] as integer) end as years,
    (source = 'topcv' and contains(e, 'năm')) as exp_rule
  from stripped),
parsed as (
  select *,
    (pair.lo is not null and pair.hi is not null) as salary_ok,
    case when pair.lo is not null and pair.hi is not null then pair.lo else 0.0 end as min_salary,
    case when pair.lo is not null and pair.hi is not null then pair.hi else 0.0 end as max_salary,
    coalesce(years, 0) as final_exp,
    (not exp_rule or years is not null) as exp_ok
  from chosen),
jobs as (
  select listing_id, position, company, address, source, query_day,
         min_salary, max_salary, cast(final_exp as integer) final_exp
  from parsed)"""

PLACES = """
places as (
  select address, source, min_salary, max_salary, final_exp,
         trim(unnest(string_split(regexp_replace(address, '[\\n\\r&,\\-]+', '|', 'g'), '|')), ' ') as address_cleaned
  from jobs)"""

MEASURES = """
  min(case when min_salary > 0 then min_salary end) as min_salary,
  max(max_salary) as max_salary,
  avg(case when min_salary > 0 then (min_salary + max_salary) / 2 else max_salary / 2 end) as avg_salary"""


def _with(*ctes: str) -> str:
    return "with " + ",".join(ctes)


def report_sql(key: str, counted: str) -> str:
    return (
        _with(LISTINGS, PARSED, PLACES)
        + f"\nselect {key}, {MEASURES}, count({counted}) as total_jobs from places group by {key}"
    )


MARKET = (
    _with(LISTINGS, PARSED, PLACES)
    + f"""
select 'address' as dimension, address_cleaned as key, address_cleaned, null::varchar as source, null::integer as final_exp,
       {MEASURES}, count(address) as total_jobs from places group by address_cleaned
union all
select 'source', source, null, source, null, {MEASURES}, count(source) from places group by source
union all
select 'exp', cast(final_exp as varchar), null, null, final_exp, {MEASURES}, count(final_exp) from places group by final_exp"""
)


def salary_sql(site: str | None) -> str:
    where = f"where source = '{site}'" if site else ""
    return (
        _with(LISTINGS, PARSED)
        + f"\nselect listing_id, source, variant, salary, min_salary, max_salary, salary_ok from parsed {where}"
    )


EXP_YEARS = _with(LISTINGS, PARSED) + "\nselect listing_id, source, exp, final_exp, exp_ok from parsed"

CLEAN_JOBS = _with(LISTINGS, PARSED) + "\nselect * from jobs"

PLACE_ROWS = (
    _with(LISTINGS, PARSED, PLACES.replace("select address,", "select listing_id, address,"))
    + "\nselect listing_id, address, address_cleaned as place from places"
)


def _fold(x: str) -> str:
    """ASCII fold in DuckDB terms: strip_accents, then the letters that have
    no decomposition."""
    out = f"translate(strip_accents({x}), 'ĐđÐðØøŁłĦħŦŧıĸ', 'DdDdOoLlHhTtiq')"
    for a, b in (("ß", "ss"), ("Æ", "AE"), ("æ", "ae"), ("Œ", "OE"), ("œ", "oe"), ("Þ", "Th"), ("þ", "th"), ("Ŋ", "NG"), ("ŋ", "ng")):
        out = f"replace({out}, '{a}', '{b}')"
    return out


def _fold_symbols(x: str) -> str:
    """Character by character: full-width forms by their distance from ASCII,
    the symbols of the test texts by a list."""
    wide = "case when unicode(ch) between 65281 and 65374 then chr(unicode(ch) - 65248)"
    listed = {"\u3000": " ", "\u2013": "-", "\u2212": "-", "\ufe63": "-", "\u2460": "1", "\u201c": '"', "\u201d": '"', "\u2026": "...", "\u00bd": "1/2", "\u00d7": "x", "\u2022": "*"}
    cases = " ".join(f"when ch = '{k}' then '{v}'" for k, v in listed.items())
    return f"array_to_string(list_transform(string_split({_fold(x)}, ''), lambda ch: {wide} {cases} else ch end), '')"


FOLD_TEXT = f"select conv_id, turn, role, {_fold('text')} as text_ascii from conversations"

SYMBOLS = """
marked as (
  select listing_id, chr(8220) || position || chr(8221) || ' ' || chr(8230) || ' ' || chr(189) as position,
         company || chr(12288) || chr(65313) || chr(65314) || chr(65297) || ' ' || chr(215) || ' ' || chr(8226) as company,
         address || ' ' || chr(8211) || ' Vũng Tàu ' || chr(8722) || ' Côn Đảo' || chr(65123) || chr(9312) as address from jobs)"""

FOLD_LISTINGS = (
    _with(LISTINGS, PARSED, SYMBOLS)
    + "\nselect listing_id, " + ", ".join(f"{_fold_symbols(c)} as {c}" for c in ("position", "company", "address")) + " from marked"
)

FOLD_PLACES = (
    _with(LISTINGS, PARSED, SYMBOLS, f"folded as (select listing_id, {_fold_symbols('address')} as address from marked)")
    + r"""
select listing_id, address,
       trim(unnest(string_split(regexp_replace(address, '[\n\r&,\-]+', '|', 'g'), '|')), ' ') as place from folded"""
)

JSON_ROUNDTRIP = (
    _with(LISTINGS, PARSED)
    + f"""
select {_fold('position')} as key, {_fold('position')} as position, {_fold('company')} as company,
       {_fold('address')} as address, source, query_day,
       cast(min_salary as float) as min_salary, cast(max_salary as float) as max_salary, final_exp
from jobs"""
)

JSON_PROPS = "select event_id, try_cast(json_extract_string(props, '$.k') as integer) as k from events"

LATEST = "(select max(query_day) from jobs)"

DAILY_COUNT = _with(LISTINGS, PARSED) + f"\nselect {LATEST} as query_day, count(*) as total_jobs from jobs where query_day = {LATEST}"

TOP_PAID = (
    _with(LISTINGS, PARSED)
    + f"""
select listing_id, source, position, company, address, max_salary, final_exp as experience
from jobs where query_day = {LATEST}
order by max_salary desc, listing_id limit 10"""
)

DIGEST_BY_DAY = (
    _with(LISTINGS, PARSED)
    + """
select query_day, listing_id, source, position, company, address, max_salary, experience, rank, total_jobs
from (select *, final_exp as experience,
             cast(row_number() over (partition by query_day order by max_salary desc, listing_id) as integer) as rank,
             count(*) over (partition by query_day) as total_jobs
      from jobs)
where rank <= 3"""
)

UPSERT_LATEST = """
select event_id, ts, user_id, event_type, value, props
from (select *, row_number() over (partition by user_id order by event_id desc) as rn from events)
where rn = 1"""

ROUTE_TOPICS = """
select case when event_type = 'view' then 'views' when event_type = 'click' then 'clicks' else 'other' end as route,
       event_type, count(*) as messages, round(sum(value), 2) as total_value
from events group by all"""


# The streaming reports read the wire copy, whose address text is folded.
def stream_reports(which: str = "true") -> str:
    wire = f"  from (select * replace ({_fold('address')} as address) from jobs where {which}))"
    return "select dimension, key, min_salary, max_salary, avg_salary, total_jobs from (" + MARKET.replace("  from jobs)", wire, 1) + ")"


def reports(which: str = "true") -> str:
    return f"select date '2025-03-14' as query_date, * from ({stream_reports(which)})"


REPORTS = reports()

# Update mode as a table: what a batch changed is its running report less the one before.
REPORT_CHANGES = "\nunion all\n".join(
    f"select cast({k} as bigint) as batch, * from (select * from ({stream_reports(f'least(listing_id % 5, 3) <= {k}')})"
    + (f" except select * from ({stream_reports(f'least(listing_id % 5, 3) < {k}')})" if k else "")
    + ")"
    for k in range(4)
)

CLEAN_UNION = (
    _with(LISTINGS, PARSED)
    + """
select position, case when listing_id % 7 = 0 then 'Not Available' else company end as company, address, source,
       date '2025-03-14' as query_day, min_salary, max_salary, final_exp from jobs"""
)

TABLE = """
jtable as (
  select source, position, company, address, query_day, cast(min_salary as float) min_salary,
         cast(max_salary as float) max_salary, final_exp as experience from jobs)"""

JOBS_TABLE_COUNT = (
    _with(LISTINGS, PARSED, TABLE)
    + "\nselect (select max(query_day) from jtable) as query_day, count(*) as total_jobs"
    + " from jtable where query_day = (select max(query_day) from jtable)"
)

JOBS_TABLE_TOP = (
    _with(LISTINGS, PARSED, TABLE)
    + """
select source, position, company, address, max_salary, experience from jtable
where query_day = (select max(query_day) from jtable)
order by max_salary desc, source, position, company, address, experience limit 10"""
)


def _unescape(x: str) -> str:
    """Basic entities, semicolon optional (legacy names), ``&amp`` last."""
    for a, b in (("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;?", "''"), ("&nbsp;?", " "), ("&amp;?", "&")):
        x = f"regexp_replace({x}, '{a}', '{b}', 'g')"
    return x


def _inner_text(x: str) -> str:
    """Text pieces between tags: what follows the first ``>`` of every ``<`` split."""
    pieces = f"list_transform(string_split({x}, '<'), lambda t, i: case when i = 1 then t else substr(t, instr(t, '>') + 1) end)"
    joined = f"array_to_string({pieces}, ' ')"
    return "array_to_string(list_filter(string_split(translate(" + _unescape(joined) + ", chr(10) || chr(9) || chr(13), '   '), ' '), lambda w: w <> ''), ' ')"


# Markup taken apart by splitting, without patterns.
EXTRACT_NAV = (
    "with n as (select page_id, split_part(split_part(html, '<nav', 2), '</nav>', 1) as nav from pages),\n"
    "p as (select page_id, list_filter(string_split(nav, '<li'), lambda t: contains(t, '<a ')) as items from n),\n"
    "i as (select page_id, unnest(items) as li, generate_subscripts(items, 1) as item from p),\n"
    "a as (select page_id, item, split_part(split_part(li, '<a ', 2), '</a>', 1) as a from i),\n"
    "b as (select page_id, item, split_part(a, '>', 1) as attrs, substr(a, instr(a, '>') + 1) as body from a)\n"
    "select page_id, cast(item as integer) as item, " + _inner_text("body") + " as text,\n"
    "  case when contains(attrs, 'href=\"') then " + _unescape("split_part(split_part(attrs, 'href=\"', 2), '\"', 1)") + " end as href from b"
)

PAGE_TITLES = (
    "with t as (select page_id, split_part(split_part(html, '<article', 2), '<h1', 2) as h from pages)\n"
    "select page_id, " + _inner_text("substr(split_part(h, '</h1>', 1), instr(h, '>') + 1)") + " as title\n"
    "from t where contains(h, '</h1>')"
)


LISTING_PAGES = (
    _with(LISTINGS)
    + """
select source, cast(listing_id // 100 as integer) as page_no, cast(row_number() over (partition by source, listing_id // 100 order by listing_id) as integer) as item,
       position, case when listing_id % 7 = 0 then 'Not Available' else company end as company, salary, address, case when source = 'topcv' then exp end as exp
from listings where listing_id // 100 % 10 <> 3"""
)

UNREAD_PAGES = (
    _with(LISTINGS)
    + "\nselect distinct source, cast(listing_id // 100 as integer) as page_no, 'no list' as reason from listings where listing_id // 100 % 10 = 3"
)


def oracle_queries() -> dict[str, str]:
    out = {
        "address_report": report_sql("address_cleaned", "address"),
        "source_report": report_sql("source", "source"),
        "exp_report": report_sql("final_exp", "final_exp"),
        "market_reports": MARKET,
        "salary_all": salary_sql(None),
        "exp_years": EXP_YEARS,
        "clean_jobs": CLEAN_JOBS,
        "place_rows": PLACE_ROWS,
    }
    for site in ("topcv", "careerlink", "careerviet", "vietnamworks"):
        out[f"salary_{site}"] = salary_sql(site)
    out.update(
        {
            "fold_text": FOLD_TEXT,
            "fold_listings": FOLD_LISTINGS,
            "fold_places": FOLD_PLACES,
            "json_roundtrip": JSON_ROUNDTRIP,
            "json_props": JSON_PROPS,
            "daily_count": DAILY_COUNT,
            "top_paid": TOP_PAID,
            "digest_by_day": DIGEST_BY_DAY,
            "upsert_latest": UPSERT_LATEST,
            "route_topics": ROUTE_TOPICS,
            "stream_reports": REPORTS,
            "ingest_twice": REPORTS,
            "stream_restart": REPORTS,
            "ingest_recovered": REPORTS,
            "replaced_day": reports("listing_id % 5 in (1, 2, 4)"),
            "report_changes": REPORT_CHANGES,
            "clean_union": CLEAN_UNION,
            "stream_upsert": UPSERT_LATEST,
            "jobs_table_count": JOBS_TABLE_COUNT,
            "jobs_table_top": JOBS_TABLE_TOP,
            "extract_nav": EXTRACT_NAV,
            "page_titles": PAGE_TITLES,
            "listing_pages": LISTING_PAGES,
            "unread_pages": UNREAD_PAGES,
        }
    )
    return out
