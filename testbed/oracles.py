"""Expected results as SQL over the driver tables.

``INPUTS`` states the inputs of ``testbed/adapters.py``; ``VIEWS`` states the dataflows on top of
them; ``ORACLES`` has one query per registered name. ``oracle`` prepends the views a query uses.
"""

from __future__ import annotations

import re

WEEK = "cast(date_trunc('week', l_shipdate) as date)"
MONTH_START = "cast(date_trunc('month', l_shipdate) as date)"
STATUS = "case l_returnflag when 'R' then 'Hard Hold' when 'A' then 'Soft Hold' else 'Useable' end"
KNOWN_QTY = "case when l_orderkey % 50 <> 0 then cast(cast(l_quantity as bigint) as varchar) end"
LINES_PART = "lineitem join part on l_partkey = p_partkey"
LINES_PART_SUPP = f"{LINES_PART} join supplier on l_suppkey = s_suppkey"


def txt(x: str) -> str:
    return f"cast({x} as varchar)"


def whole(x: str) -> str:
    return f"cast(cast({x} as bigint) as varchar)"


def num(x: str) -> str:
    """Number of a text. DuckDB already rejects suffixes such as F and D."""
    return f"try_cast({x} as double)"


def code(x: str) -> str:
    """Text of a whole number."""
    return f"cast(cast({x} as bigint) as varchar)"


def key(a: str, b: str, sep: str = "-") -> str:
    return f"(coalesce({a}, 'NA') || '{sep}' || coalesce({b}, 'NA'))"


def dashed(a: str, b: str) -> str:
    return f"replace({key(a, b, '_')}, '_', '-')"


def strict(x: str) -> str:
    return f"case when count(*) = count({x}) then sum({x}) end"


def head(sep: str = "-") -> str:
    return f"'GLB-RP-' || {txt('l_partkey')} || '~' || lpad({txt('l_suppkey')}, 5, '0')"


DAY = "strftime(l_shipdate, '%Y-%m-%d')"
TAIL = f"'~' || {DAY} || '~' || {txt('l_linenumber')}"
BOM_EXTRAS = [f"x{n:02d}" for n in range(5, 44)]
BOM_COLUMNS = f"""{txt('p_partkey % 20')} || '-' || {txt('p_partkey % 200')} || 'ABC' as ref,
  p_partkey as component, {txt('p_size')} as quantity_w_scrap,
  case when p_size % 10 <> 0 then {txt('p_size * 3')} end as next_28_days_open_order,
  {', '.join(f"p_brand || '-{int(x[1:])}' as {x}" for x in BOM_EXTRAS)}"""
EXCEPTION_COLUMNS = f"""case when p_partkey % 101 = 0 then 'OLD' when p_partkey % 103 <> 0 then {txt('p_partkey % 100')} end as b_p,
  {txt('p_partkey')} as item_number, case when p_type = 'SMALL' then 'LBL' else p_type end as mpf_or_line"""

INPUTS: dict[str, str] = {
    "fx_campus": f"""select case when s_suppkey <> 1 then
    cast(case when s_acctbal < 0 then s_suppkey + 90000000 else s_suppkey end as varchar) end as location,
    {txt('s_nationkey')} as campus from supplier""",
    "fx_po": f"""select case when l_orderkey % 97 = 0
    then {head()} || '~x~y~' || {whole('l_quantity')}
    else {head()} || '~' || l_returnflag || '~' || l_linestatus || '~'
      || case when l_orderkey % 89 = 0 then 'n/a' else {whole('l_quantity')} end
      || '~' || {txt('l_orderkey')} || {TAIL} end as line, {WEEK} as as_of
  from lineitem where l_linestatus = 'O'""",
    "fx_receipt": f"""select {head()} || '~' || l_returnflag || '~' || l_linestatus || '~'
      || {whole('l_quantity')} || '~R' || {txt('l_orderkey')} || {TAIL} as line, {WEEK} as as_of
  from lineitem where l_linestatus = 'F'""",
    "fx_po_mixed": r"""select case when n % 13 = 1 then line || '~more' when n % 29 <> 2 then line end as line, as_of
  from (select line, as_of, cast(regexp_extract(line, '^GLB-RP-(\d+)', 1) as bigint) as n from fx_po)""",
    "fx_amounts": """select cast(l_suppkey % 20 as varchar) as site, cast(month(l_shipdate) as varchar) as "month",
    case when not (l_suppkey % 20 = 7 and l_orderkey % 1000 = 0)
      then cast(cast(case when l_returnflag = 'R' then -c else c end as decimal(20,4)) as varchar) end as amount
  from (select *, cast(l_extendedprice as decimal(14,2)) * (1 - cast(l_discount as decimal(4,2))) as c from lineitem)""",
    "fx_typed": f"""select strftime(l_shipdate, '%Y%m') as "month", case when l_linestatus = 'F' then 'TRUE' else 'F' end as flag,
    case when l_orderkey % 5 = 0 then ' NA ' else {whole('l_quantity')} end as "count",
    case when month(l_shipdate) = 5 then cast(cast(l_discount as decimal(4,2)) as varchar) else {whole('l_quantity')} end as number,
    case when l_orderkey % 3 = 0 then substr(clock, 1, 5) else clock end as "time",
    case when l_orderkey % 2 = 0 then d else replace(d, '-', '/') end as "day",
    case when l_orderkey % 4 = 0 then d else d || ' ' || clock end as moment,
    lpad({txt('l_partkey')}, 6, '0') as code,
    case when year(l_shipdate) = 2001 then 'n/a' else {whole('l_quantity')} end as mixed,
    case when l_orderkey % 2 = 0 then '' end as nothing
  from (select *, strftime(l_shipdate, '%Y-%m-%d') as d, printf('%02d:%02d:%02d', l_orderkey % 24, l_orderkey % 60,
    (l_orderkey * 7) % 60) as clock from lineitem)""",
    "fx_dsx": f"""select {txt('l_suppkey % 20')} as product_manufacturing_location_code,
    {txt('l_partkey % 200')} || '-ABC' as product_label_sku_code,
    strftime(date '2000-01-01' + to_months(cast(l_orderkey % 14 as integer)), '%Y%m') as forecast_month_year_id,
    {KNOWN_QTY} as adjusted_forecast_cases
  from lineitem""",
    "fx_dsx_snapshots": f"""select {MONTH_START} + cast(l_linenumber % 3 as integer) as snapshot_date,
    {txt('l_partkey % 20')} as product_manufacturing_location_code,
    {txt('l_partkey % 200')} || '-ABC' as product_label_sku_code,
    strftime({MONTH_START} + to_months(cast(l_orderkey % 14 as integer)), '%Y%m') as forecast_month_year_id,
    {KNOWN_QTY} as adjusted_forecast_cases
  from lineitem""",
    "fx_bom": f"select {BOM_COLUMNS} from part",
    "fx_exception": f"select {EXCEPTION_COLUMNS} from part",
    "parts_by_week": f"""select distinct {WEEK} as as_of, part.* from {LINES_PART}""",
    "fx_bom_week": f"select as_of, {BOM_COLUMNS} from parts_by_week",
    "fx_exception_week": f"select as_of, {EXCEPTION_COLUMNS} from parts_by_week",
    "fx_lot": f"""select case when p_size % 2 = 0 then 'RM' else 'FG' end as sheet,
    {txt('l_suppkey')} as location, {txt('s_nationkey')} as campus_no,
    case when p_size % 3 = 0 then {txt('l_partkey')} || '-ABC' else lpad({txt('l_partkey')}, 6, '0') end as item,
    case p_size % 10 when 0 then 'PWS ' when 1 then 'SUB ' when 2 then 'THW ' when 3 then 'PALLET ' else '' end
      || p_name as description,
    {STATUS} as inventory_hold_status, {KNOWN_QTY} as current_inventory_balance, {WEEK} as as_of
  from {LINES_PART_SUPP}""",
    "fx_jde_lot": f"""select {txt('l_suppkey')} as bp,
    {txt('l_partkey')} || case when p_size % 3 = 0 then 'ABC' else '' end as item_number,
    p_name as description, {whole('l_quantity')} as on_hand, {WEEK} as as_of
  from {LINES_PART}""",
    "fx_inv_bal": f"""select {txt('l_suppkey')} as bp,
    {txt('l_partkey')} || case when p_size % 3 = 0 then 'ABC' when p_size % 7 = 0 then 'F' else '' end as item,
    p_name as description, {whole('sum(l_quantity)')} as inventory,
    {whole("sum(case when l_returnflag = 'N' then l_quantity end)")} as usable,
    {whole("sum(case when l_returnflag = 'A' then l_quantity end)")} as soft_hold,
    {whole("sum(case when l_returnflag = 'R' then l_quantity end)")} as hard_hold
  from {LINES_PART} group by l_suppkey, l_partkey, p_size, p_name""",
    "fx_wh_rm": f"""select {txt('l_suppkey')} as location, {txt('s_nationkey')} as campus,
    {txt('l_partkey')} as item, p_name as na_2, {whole('sum(l_quantity)')} as current_inventory_balance
  from {LINES_PART_SUPP} where p_size % 3 <> 0 group by l_suppkey, s_nationkey, l_partkey, p_name""",
    "fx_wh_fg": f"""select {txt('l_suppkey')} as location,
    {txt('l_suppkey % 20')} as product_manufacturing_location,
    {txt('l_partkey')} || '-ABC' as item, p_name as na_2, {STATUS} as hold_status,
    {whole('sum(l_quantity)')} as current_inventory_balance
  from {LINES_PART} where p_size % 3 = 0 group by l_suppkey, l_partkey, p_name, l_returnflag""",
    "fx_inv_analysis": f"""select {txt('l_suppkey')} as location, s_name as location_nm,
    {txt('l_partkey')} || '-ABC' as product_label_sku, p_name as description,
    {STATUS} as inventory_hold_status, {KNOWN_QTY} as inventory_qty_cases
  from {LINES_PART_SUPP}""",
    "fx_mfg_map": f"""select distinct {txt('l_suppkey')} as location_no,
    {txt('l_partkey')} || case l_linestatus when 'F' then '-ABC' else '-OPN' end as product_label_sku_code,
    {txt('(l_suppkey + l_linenumber % 2) % 20')} as product_manufacturing_location_code
  from lineitem""",
    "fx_snapshots": """select distinct cast(o_orderdate as date)
    - cast(greatest(isodow(o_orderdate) - 5, 0) as integer) as snapshot_date from orders""",
    "ship_weeks": f"select distinct {WEEK} as as_of from lineitem",
    "fx_runs": "select distinct cast(date_trunc('week', o_orderdate) as date) as as_of from orders",
}


def orders(source: str, number: str, sep: str = "-", by: str = "") -> str:
    return f"""select {by}{key('location', 'item', sep)} as ref, {key('campus', 'item', sep)} as campus_ref,
    campus, item, location, qty, "date", {number}
  from (select {by}regexp_split_to_array(f[1], '[^0-9A-Za-z]+')[3] as item,
      regexp_replace(f[2], '^0+', '') as location, {num('f[5]')} as qty, f[6] as {number},
      try_cast(f[7] as date) as "date"
    from (select {by}string_split(line, '~') as f from {source})) r
  left join (select location as place, campus from fx_campus) c on r.location is not distinct from c.place"""


def forecast_months(source: str, by: str = "") -> str:
    """Twelve months after the first two, by rank of the month."""
    part = f"partition by {by.rstrip(', ')} " if by else ""
    cells = ", ".join(
        f"max(case when month_no = {n} then cases else 0 end) as fcst_m{n:02d}" for n in range(1, 13)
    )
    return f"""select {by}replace(mfg_ref, '_', '-') as mfg_ref, {cells} from (
    select {by}mfg_ref, month_no, coalesce({strict('cases')}, 0) as cases from (
      select {by}{key('product_manufacturing_location_code', "replace(product_label_sku_code, '-', '')", '_')} as mfg_ref,
        dense_rank() over ({part}order by forecast_month_year_id) - 2 as month_no,
        {num('adjusted_forecast_cases')} as cases from {source})
    group by {by}mfg_ref, month_no) group by {by}mfg_ref"""


FCST = [f"fcst_m{n:02d}" for n in range(1, 13)]
SCRAP, OPEN = num("b.quantity_w_scrap"), num("b.next_28_days_open_order")


def demand(bom: str, forecast: str, by: str = "") -> str:
    zero = {f: f"coalesce(f.{f}, 0)" for f in FCST}
    if by:  # without a complete snapshot there is no forecast
        zero = {f: f"case when b.months_found >= 14 then {z} end" for f, z in zero.items()}
    first = f"""case when {OPEN} is not null and {zero['fcst_m01']} is not null
    then greatest({OPEN}, {zero['fcst_m01']}) end * {SCRAP} as dep_m01"""
    rest = [f"{zero[f]} * {SCRAP} as {f.replace('fcst', 'dep')}" for f in FCST[1:]]
    return f"""select {"b.as_of, b.snapshot_date, " if by else ""}b.ref as mfg_ref, b.component,
    {SCRAP} as quantity_w_scrap, {OPEN} as next_28_days_open_order, {', '.join(f'b.{x}' for x in BOM_EXTRAS[:27])},
    {', '.join(f'{z} as {f}' for f, z in zero.items())}, {first}, {', '.join(rest)}
  from {bom} b left join {forecast} f on b.ref = f.mfg_ref {"and b.snapshot_date = f.snapshot_date" if by else ""}"""


KEEPS = " and ".join(
    f"not starts_with(description, '{p}')" for p in ("PWS ", "SUB ", "THW ", "PALLET")
)


def exceptions(source: str, by: str = "") -> str:
    return f"""select {by}{key(code(num('b_p')), code(num('item_number')))} as ref,
    {key('campus', code(num('item_number')))} as campus_ref, campus,
    {num('b_p')} as b_p, {num('item_number')} as item_number, mpf_or_line
  from {source} r left join (select {num('location')} as place, campus from fx_campus) c
    on {num('r.b_p')} is not distinct from c.place"""


def rm_lots(by: str = "") -> str:
    return f"""select {by}{key('location', code('item'))} as ref, {key('campus', code('item'))} as campus_ref,
    location, campus, cast(item as double) as item, description, inventory from (
    select {by}location, campus_no as campus, replace(item, '-', '') as item, description,
      {strict(num('current_inventory_balance'))} as inventory
    from fx_lot where sheet = 'RM' group by {by}location, campus_no, replace(item, '-', ''), description)
  where regexp_matches(item, '^[0-9]+$') and {KEEPS}"""


def labels(exception: str, by: str = "") -> str:
    same = "and e.as_of is not distinct from l.as_of" if by else ""
    return f"""select {by}{dashed('bp', 'item_number')} as ref, {dashed('bp', 'item_number')} as campus_ref,
    bp as location, bp as campus, cast(item_number as double) as item, description, {num('on_hand')} as inventory
  from fx_jde_lot l where regexp_matches(item_number, '^[0-9]+$') and exists (
    select 1 from {exception} e where mpf_or_line = 'LBL'
      and {num('e.item_number')} = {num('l.item_number')} {same})"""


def fg_lots(by: str = "") -> str:
    item = "replace(item, '-', '')"
    return f"""select {by}{dashed('location', 'item')} as ref, {dashed('campus', 'item')} as campus_ref, location,
    campus, item, description, inventory_hold_status, inventory_qty_cases from (
    select {by}location, campus_no as campus, {item} as item, description, inventory_hold_status,
      {strict(num('current_inventory_balance'))} as inventory_qty_cases
    from fx_lot where sheet = 'FG'
    group by {by}location, campus_no, {item}, description, inventory_hold_status)
  where regexp_matches(item, '[A-Za-z]{{3}}$') and {KEEPS}"""


def campus_by_number(source: str, number: str) -> str:
    return f"""{source} r left join (select {num('location')} as place, campus from fx_campus) c
    on {num('r.' + number)} is not distinct from c.place"""


def clean(x: str) -> str:
    return f"nullif(nullif(trim({x}), ''), 'NA')"


def rm_balance(sites: str) -> str:
    item, bp = code(num("item")), code(num("bp"))
    return f"""select {key(bp, item)} as ref, {key('campus', item)} as campus_ref, {bp} as location, campus,
    {num('item')} as item, {clean('description')} as description, {num('inventory')} as inventory
  from {campus_by_number('fx_inv_bal', 'bp')}
  where {num('bp')} not in ({sites}) and {num('item')} is not null
  union all select {dashed('location', item)}, {dashed('campus', item)}, {code(num('location'))}, campus,
    {num('item')}, {clean('na_2')}, {num('current_inventory_balance')}
  from fx_wh_rm where {num('location')} in ({sites})"""


def fg_balance(sites: str) -> str:
    bp, place = code(num("bp")), code(num("location"))
    item = "replace(item, '-', '')"
    holds = " union all ".join(
        f"""select ref, campus_ref, location, campus, item, description, '{label}' as inventory_hold_status,
      coalesce({num(column)}, 0) as inventory_qty_cases from goods"""
        for column, label in (("usable", "Useable"), ("soft_hold", "Soft Hold"), ("hard_hold", "Hard Hold"))
    )
    return f"""select * from (with goods as (select {dashed(bp, 'item')} as ref, {dashed('campus', 'item')} as campus_ref,
    {bp} as location, campus, item, description, usable, soft_hold, hard_hold
  from {campus_by_number('fx_inv_bal', 'bp')}
  where {num('bp')} not in ({sites}) and {num('item')} is null) {holds})
  union all select {dashed(place, item)}, {dashed('product_manufacturing_location', item)}, {place},
    product_manufacturing_location, {item}, {clean('na_2')}, {clean('hold_status')},
    {num('current_inventory_balance')} from fx_wh_fg where {num('location')} in ({sites})"""


def fg_mfg(qty: str, where: str = "") -> str:
    return f"""select replace(ref, '_', '-') as ref, replace(mfg_ref, '_', '-') as mfg_ref, location, location_nm,
    product_manufacturing_location, item, description, hold_status, {strict('qty')} as current_inventory_balance
  from (select a.*, m.mfg_ref, m.product_manufacturing_location from analysis_keyed a
    left join mfg_keyed m on a.ref = m.ref), lateral (select {qty} as qty)
  {where} group by ref, mfg_ref, location, location_nm, product_manufacturing_location, item, description, hold_status"""


SKU = "replace(product_label_sku_code, '-', '')"
PO_FIELDS = "string_split(line, '~')"

VIEWS: dict[str, str] = {
    **INPUTS,
    "po": orders("fx_po", "po_no"),
    "po_old": orders("fx_po", "po_no", "_"),
    "receipt": orders("fx_receipt", "receipt_no"),
    "lag1": forecast_months("fx_dsx"),
    "bom": demand("fx_bom", "lag1"),
    "exception": exceptions("fx_exception"),
    "rm_lot": rm_lots(),
    "label_lot": labels("fx_exception"),
    "fg_lot": fg_lots(),
    "analysis_keyed": f"""select {key('location', "replace(product_label_sku, '-', '')", '_')} as ref, location,
    location_nm, replace(product_label_sku, '-', '') as item, description, inventory_hold_status as hold_status,
    {num('inventory_qty_cases')} as balance from fx_inv_analysis""",
    "mfg_keyed": f"""select {key('location_no', SKU, '_')} as ref,
    {key('product_manufacturing_location_code', SKU, '_')} as mfg_ref,
    product_manufacturing_location_code as product_manufacturing_location from fx_mfg_map""",
    "po_week": orders("fx_po", "po_no", by="as_of, "),
    "receipt_week": orders("fx_receipt", "receipt_no", by="as_of, "),
    "lag1_snap": forecast_months("fx_dsx_snapshots", by="snapshot_date, "),
    "months_of": """select snapshot_date, cast(count(distinct forecast_month_year_id) as integer) as months_found
    from fx_dsx_snapshots group by 1""",
    "chosen": """select w.as_of, s.snapshot_date, m.months_found
    from (select distinct as_of from parts_by_week) w left join (
      select date_trunc('month', snapshot_date) as taken, min(snapshot_date) as snapshot_date
      from fx_dsx_snapshots group by 1) s on s.taken = date_trunc('month', w.as_of) - interval 1 month
    left join months_of m on m.snapshot_date = s.snapshot_date""",
    "bom_dated": "select b.*, c.snapshot_date, c.months_found from fx_bom_week b left join chosen c on b.as_of = c.as_of",
    "bom_week": demand("bom_dated", "lag1_snap", by="snapshot_date"),
    "exception_week": exceptions("fx_exception_week", by="as_of, "),
    "rm_lot_week": rm_lots(by="as_of, "),
    "label_lot_week": labels("fx_exception_week", by="as_of, "),
    "fg_lot_week": fg_lots(by="as_of, "),
    "rm_week": "select * from rm_lot_week union all by name select * from label_lot_week",
}


def summary(name: str, view: str, qty: str) -> str:
    return f"""select as_of, '{name}' as "table", count(*) as "rows", cast(sum({qty}) as double) as total
  from {view} group by as_of"""


_TYPE_COLUMNS = ("bp", "item", "description", "inventory", "usable", "soft_hold", "hard_hold")
_NUMBER = r"^[+-]?((0|[1-9]\d*)(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def type_row(column: str) -> str:
    value = clean(column)

    def fits(test: str) -> str:
        return f"count({value}) = count(case when {test} then 1 end)"

    return f"""select '{column}' as "column", case
    when {fits(f"{value} in ('T', 'F', 'TRUE', 'FALSE', 'true', 'false')")} then 'boolean'
    when {fits(f"regexp_matches({value}, '{_NUMBER}')")} then 'double'
    when {fits(f"try_cast({value} as date) is not null")} then 'date'
    else 'string' end as "type" from fx_inv_bal"""


_TYPED = ("flag", "count", "number", "time", "day", "moment", "code", "mixed", "nothing")
_DAY_FORM, _CLOCK_FORM = r"\d{4}[-/]\d{1,2}[-/]\d{1,2}", r"([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,6})?)?"


def type_bits(column: str) -> str:
    value = clean(f'"{column}"')
    tests = (
        f"{value} in ('T', 'F', 'TRUE', 'FALSE', 'true', 'false')",
        rf"regexp_matches({value}, '^[+-]?(0|[1-9]\d{{0,17}})$')",
        f"regexp_matches({value}, '{_NUMBER}')",
        f"regexp_matches({value}, '^{_CLOCK_FORM}$')",
        f"regexp_matches({value}, '^{_DAY_FORM}$')",
        f"regexp_matches({value}, '^{_DAY_FORM}([ T]{_CLOCK_FORM}Z?)?$')",
    )
    bits = " + ".join(f"case when {test} then {1 << n} else 0 end" for n, test in enumerate(tests))
    return f"""select "month", '{column}' as "column", bit_and(case when {value} is null then 63 else {bits} end) as mask
  from fx_typed group by 1"""


_TYPE_NAME = " ".join(
    f"when mask & {1 << n} <> 0 then '{name}'"
    for n, name in enumerate(("boolean", "integer", "double", "time", "date", "timestamp"))
)

_WIDE_MONTHS = [f"2000{m:02d}" for m in range(1, 13)] + ["200101", "200102"]

# Every other week has its header two rows further down.
_LATER = "date_diff('day', date '1970-01-05', as_of) // 7 % 2 = 1"

ORACLES: dict[str, str] = {
    # sources and sinks
    "src_delimited_lines": "select line, date '2023-12-12' as as_of from fx_po",
    "src_numbered_lines": "select line, date '2024-01-02' as as_of from fx_po",
    "promote_header": "select * from fx_exception",
    "drop_leading_rows": """select p_partkey + 5 as row_no, b_p as c1, item_number as c2, mpf_or_line as c3
  from fx_exception join part on item_number = cast(p_partkey as varchar)""",
    "named_sheet_source": "select * exclude (sheet) from fx_lot where sheet = 'RM'",
    "workbook_source": "select * exclude (sheet) from fx_lot where sheet = 'RM'",
    "workbook_sink": """select 'po' as "table", * exclude (po_no), po_no as number from po
  union all by name select 'receipt' as "table", * exclude (receipt_no), receipt_no as number from receipt""",
    "promote_header_per_run": "select * exclude (sheet) from fx_lot where sheet = 'RM'",
    "header_scores": f"""select as_of, cast(1 as bigint) as row_no, 0 as score from ship_weeks
  union all select as_of, case when {_LATER} then 5 else 3 end, 6 from ship_weeks
  union all select {WEEK}, l_orderkey * 8 + l_linenumber + 10, 0 from {LINES_PART}
    where p_size % 2 = 0 and l_orderkey * 8 + l_linenumber + 10 <= 20""",
    "promote_header_detected": "select * exclude (sheet) from fx_lot where sheet = 'FG'",
    "record_rejects": """select * from (select line, as_of, coalesce(len(string_split(line, '~')), 0)::integer as n_fields,
    case when line is null then 'missing' when len(string_split(line, '~')) < 8 then 'short'
      when len(string_split(line, '~')) > 8 then 'long' end as reason from fx_po_mixed) where reason is not null""",
    "record_counts": """select count(*) as "read", count(*) filter (n = 8) as accepted, count(*) filter (n is null) as missing,
    count(*) filter (n < 8) as short, count(*) filter (n > 8) as long, count(*) filter (n = 8) as held
  from (select len(string_split(line, '~')) as n from fx_po_mixed)""",
    "snapshot_select": """select as_of, snapshot_date from fx_runs left join (
  select date_trunc('month', snapshot_date) as taken, min(snapshot_date) as snapshot_date from fx_snapshots group by 1)
  on taken = date_trunc('month', as_of) - interval 1 month""",
    "snapshot_sink": """select *, date '2024-01-02' as as_of from po_old
  union all by name select *, date '2024-01-09' as as_of from po""",
    "multi_table_publish": """select 'po' as "table", *, date '2024-01-09' as as_of from po
  union all by name select 'receipt' as "table", *, date '2024-01-09' as as_of from receipt""",
    "published_set": """select 'po' as "table", *, date '2024-01-02' as as_of from po_old
  union all by name select 'po' as "table", *, date '2024-01-09' as as_of from po
  union all by name select 'receipt' as "table", *, date '2024-01-02' as as_of from receipt
  union all by name select 'receipt' as "table", *, date '2024-01-09' as as_of from receipt""",
    "weekly_incremental": """select 'po' as "table", * from po_week
  union all by name select 'receipt' as "table", * from receipt_week""",
    # projection, renaming, derivation
    "project_drop": "select mfg_ref, dep_m01, dep_m02 from bom",
    "project_positional": "select location, campus_no, item from fx_lot",
    "rename_cols": "select item_number as item, mpf_or_line as label from fx_exception",
    "relocate_cols": "select * from fx_bom",
    "ordinal_rename": f"""select mfg_ref, {', '.join(f'{f} as month_{i:02d}' for i, f in enumerate(FCST, 1))}
  from lag1""",
    "clean_names": """select b_p as b_p, item_number as item_number, mpf_or_line as na, b_p as na_2,
  item_number as x, mpf_or_line as percent_w_scrap from fx_exception""",
    "derive_cols": f"""select *, {num('quantity_w_scrap')} * 2 as doubled,
  {key('ref', txt('component'))} as line_ref from fx_bom""",
    # casts and type inference
    "tolerant_double": f"select item as value, {num('item')} as number from fx_inv_bal",
    "infer_types": " union all ".join(type_row(c) for c in _TYPE_COLUMNS),
    "infer_types_by_week": " union all ".join(map(type_bits, _TYPED)),
    "infer_types_merged": f"""select "column", case {_TYPE_NAME} else 'string' end as "type" from (
  select "column", bit_and(mask) as mask from ({" union all ".join(map(type_bits, _TYPED))}) group by 1)""",
    "infer_types_merged_cast": f"""select "month", flag = 'TRUE' as flag, cast({clean('"count"')} as bigint) as "count",
  cast(number as double) as number, cast(string_split("time", ':')[1] as double) * 3600
    + cast(string_split("time", ':')[2] as double) * 60 + coalesce(cast(string_split("time", ':')[3] as double), 0) as "time",
  cast(replace("day", '/', '-') as date) as "day", cast(moment as timestamp) as moment, code, mixed,
  cast(null as boolean) as nothing from fx_typed""",
    "tolerant_date": """select v as value, try_cast(replace(v, '/', '-') as date) as "date" from (
  select string_split(line, '~')[7] as v from fx_po
  union all select replace(string_split(line, '~')[7], '-', '/') from fx_po)""",
    "infer_types_cast": f"""select {num('bp')} as bp, {clean('item')} as item, {clean('description')} as description,
  {', '.join(f'{num(c)} as {c}' for c in _TYPE_COLUMNS[3:])} from fx_inv_bal""",
    "code_to_text": f"select {num('item_number')} as number, {code(num('item_number'))} as code from fx_exception",
    # scalar functions and predicates
    "split_fixed": "select " + ", ".join(f"{PO_FIELDS}[{i}] as f{i}" for i in range(1, 9)) + " from fx_po",
    "split_regex": "select "
    + ", ".join(
        f"regexp_split_to_array({PO_FIELDS}[1], '[^0-9A-Za-z]+')[{i}] as {n}"
        for i, n in enumerate(("global", "rp", "item"), 1)
    ).replace("as global", 'as "global"')
    + " from fx_po",
    "strip_leading_zeros": f"""select {PO_FIELDS}[2] as raw, regexp_replace({PO_FIELDS}[2], '^0+', '') as location
  from fx_po""",
    "remove_or_replace_char": f"""select product_label_sku_code as sku, {SKU} as item,
  replace({key('product_manufacturing_location_code', SKU, '_')}, '_', '-') as mfg_ref from fx_dsx""",
    "composite_key": "select b_p, item_number, campus, ref, campus_ref from exception",
    "null_to_zero": f"""select bp, item, {', '.join(f'coalesce({num(c)}, 0) as {c}' for c in _TYPE_COLUMNS[4:])}
  from fx_inv_bal""",
    "null_propagating_max": f"""select component, case when {num('next_28_days_open_order')} is not null
  then greatest({num('next_28_days_open_order')}, {num('quantity_w_scrap')}) end as larger from fx_bom""",
    "filter_compare": f"""select * from fx_inv_bal where {num('bp')} <> 26 and {num('bp')} in (6, 25, 26, 55)""",
    "filter_item_class": """select 'RM' as class, location, item from fx_lot where regexp_matches(item, '^[0-9]+$')
  union all select 'FG', location, item from fx_lot where regexp_matches(item, '[A-Za-z]{3}$')""",
    "filter_prefix_exclude": f"select location, item, description from fx_lot where {KEEPS}",
    "filter_castable": f"""select item, {num('item')} is not null as castable from fx_inv_bal""",
    # joins
    "join_campus_text": "select location, item, campus from po",
    "join_campus_numeric": "select b_p, item_number, campus from exception",
    "join_mfg_map": """select a.*, m.mfg_ref, m.product_manufacturing_location from analysis_keyed a
  left join mfg_keyed m on a.ref = m.ref""",
    "join_bom_forecast": f"select mfg_ref, component, {', '.join(FCST)} from bom",
    "semi_join_labels": "select * from label_lot",
    "duplicate_keys": """select campus, count(*) as "rows" from fx_campus group by 1 having count(*) > 1""",
    # aggregation, distinct, reshape, set operations
    "pivot_months": "select * from lag1",
    "unpivot_hold_status": " union all ".join(
        f"""select bp, item, '{label}' as inventory_hold_status,
  coalesce({num(column)}, 0) as inventory_qty_cases from fx_inv_bal"""
        for column, label in (("usable", "Useable"), ("soft_hold", "Soft Hold"), ("hard_hold", "Hard Hold"))
    ),
    "group_sum_strict": f"""select location, item, {strict(num('current_inventory_balance'))} as inventory
  from fx_lot group by location, item""",
    "group_sum_fractional": """select site, case when count(*) = count(amount)
    then cast(cast(sum(cast(amount as decimal(20,4))) as varchar) as double) end as total from fx_amounts group by site""",
    "pivot_months_fractional": f"""select site, {', '.join(
        f"max(case when month_no = {n} then total else 0 end) as fcst_m{n:02d}" for n in range(1, 13))}
  from (select site, month_no, coalesce(case when count(*) = count(amount)
      then cast(cast(sum(cast(amount as decimal(20,4))) as varchar) as double) end, 0) as total
    from (select *, dense_rank() over (order by "month") as month_no from fx_amounts) group by all) group by site""",
    "group_first_sum": f"""select ref, first(location) as location, first(location_nm) as location_nm,
  first(item) as item, first(description) as description, hold_status, {strict('balance')} as current_inventory_balance
  from analysis_keyed group by ref, location, location_nm, item, description, hold_status""",
    "distinct_rows": f"""select distinct {num('item_number')} as item, mpf_or_line as label
  from fx_exception where mpf_or_line = 'LBL'""",
    "union_by_name": "select * from rm_lot union all by name select * from label_lot",
    "scale_month_vector": "select mfg_ref, component, "
    + ", ".join(f.replace("fcst", "dep") for f in FCST)
    + " from bom",
    # dataflows
    "open_po": "select * from po",
    "open_po_underscore": "select * from po_old",
    "receipts": "select * from receipt",
    "forecast_lag1": "select * from lag1",
    "forecast_wide_all": f"""select replace(mfg_ref, '_', '-') as mfg_ref, {", ".join(
        f'''max(case when forecast_month_year_id = '{m}' then cases else 0 end) as "{m}"''' for m in _WIDE_MONTHS)}
  from (select mfg_ref, forecast_month_year_id, coalesce({strict('cases')}, 0) as cases from (
    select {key('product_manufacturing_location_code', SKU, '_')} as mfg_ref, forecast_month_year_id,
      {num('adjusted_forecast_cases')} as cases from fx_dsx) group by 1, 2) group by 1""",
    "forecast_poisoned_groups": f"""select {key('product_manufacturing_location_code', SKU, '_')} as mfg_ref,
  forecast_month_year_id, count(*) as "rows", count(*) - count(adjusted_forecast_cases) as bad_rows
  from fx_dsx group by 1, 2 having count(*) > count(adjusted_forecast_cases)""",
    "bom_demand": "select * from bom",
    "exception_enriched": "select * from exception",
    "rm_inventory_lot": "select * from rm_lot",
    "label_inventory": "select * from label_lot",
    "rm_inventory": "select * from rm_lot union all by name select * from label_lot",
    "rm_inventory_balance": rm_balance("26"),
    "rm_inventory_balance_two_sites": rm_balance("6, 26"),
    "label_inventory_sites": f"""select k as ref, k as campus_ref, {code(num('bp'))} as location,
  {code(num('bp'))} as campus, {num('item')} as item, {clean('description')} as description,
  {num('inventory')} as inventory
  from fx_inv_bal i, lateral (select {key(code(num('i.bp')), code(num('i.item')))} as k)
  where {num('bp')} in (25, 55) and {num('item')} in (
    select {num('item_number')} from fx_exception where mpf_or_line = 'LBL')""",
    "fg_inventory_lot": "select * from fg_lot",
    "fg_inventory_balance": fg_balance("26"),
    "fg_inventory_balance_two_sites": fg_balance("6, 26"),
    "fg_inventory_mfg": fg_mfg("balance"),
    "fg_inventory_mfg_zero_fill": fg_mfg("coalesce(balance, 0)", "where item <> '''1'"),
    "lag1_lookup": "select ref, round(coalesce(fcst_m01, 0)) as lag1 from fx_bom left join lag1 on ref = mfg_ref",
    "weekly_bom_demand": "select * from bom_week",
    "bucketed_bom_demand": "select * from bom_week",
    "rm_inventory_from_grid": "select * from rm_week",
    "forecast_gaps": """select as_of, snapshot_date, coalesce(months_found, 0) as months_found from chosen
  where coalesce(months_found, 0) < 14""",
    "weekly_po": "select * from po_week",
    "weekly_receipt": "select * from receipt_week",
    "weekly_exception_report": "select * from exception_week",
    "weekly_rm_inventory": "select * from rm_week",
    "weekly_fg_inventory": "select * from fg_lot_week",
    "weekly_poisoned_forecast": f"""select as_of, p.* from chosen c join (
    select snapshot_date, {key('product_manufacturing_location_code', SKU, '_')} as mfg_ref, forecast_month_year_id,
      count(*) as "rows", count(*) - count(adjusted_forecast_cases) as bad_rows
    from fx_dsx_snapshots group by 1, 2, 3 having count(*) > count(adjusted_forecast_cases)) p
  on c.snapshot_date = p.snapshot_date where months_found >= 14""",
    "weekly_run": " union all ".join(
        summary(*args)
        for args in (
            ("po", "po_week", "qty"),
            ("receipt", "receipt_week", "qty"),
            ("bom", "bom_week", "dep_m01"),
            ("exception_report", "exception_week", "item_number"),
            ("rm_inventory", "rm_week", "inventory"),
            ("fg_inventory", "fg_lot_week", "inventory_qty_cases"),
        )
    ),
}


def oracle(name: str) -> str:
    """SQL of one registered query, with the views it needs in order of definition."""
    needed: set[str] = set()
    pending = [ORACLES[name]]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for view in (words & VIEWS.keys()) - needed:
            needed.add(view)
            pending.append(VIEWS[view])
    views = ",\n".join(f"{view} as ({sql})" for view, sql in VIEWS.items() if view in needed)
    return f"with {views}\n{ORACLES[name]}" if views else ORACLES[name]
