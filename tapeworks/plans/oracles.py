"""The same queries in SQL for DuckDB, over the same tables."""

from __future__ import annotations

_WITH_T = """
t as (
  select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as trade_id,
         case when l_partkey % 97 <> 0 then ' SYM' || cast(l_suppkey as varchar) || ' ' end as symbol,
         l_extendedprice as price, l_quantity as quantity,
         case when l_returnflag = 'A' then 'BUY' when l_returnflag = 'R' then ' sell '
              when l_linestatus = 'O' then 'Buy' else 'HOLD' end as side,
         l_shipdate as trade_ts, l_shipdate as source_ts, l_shipdate + interval 1 hour as ingestion_time,
         cast(l_suppkey % 3 as integer) as kafka_partition, l_partkey * 1000000 + l_suppkey as kafka_offset
  from lineitem
),
tidy as (
  select trade_id, trim(symbol) as symbol, price, quantity, lower(trim(side)) as side, trade_ts, source_ts,
         ingestion_time, kafka_partition, kafka_offset
  from t
),
clean as (
  select * from tidy
  where trade_id is not null and symbol is not null and side in ('buy', 'sell')
    and price is not null and not isnan(price) and quantity is not null and not isnan(quantity)
),
ranked as (
  select *, row_number() over (partition by trade_id
              order by source_ts desc nulls last, kafka_partition desc, kafka_offset desc) as place
  from clean
),
lineage as (select * exclude (place) from ranked where place = 1),
silver as (select * exclude (kafka_partition, kafka_offset) from lineage)
"""

_WITH_GAPS = _WITH_T + """,
gaps as (
  select trade_id, symbol, price, quantity, side, trade_ts,
         case when kafka_offset % 89 > 1 then source_ts end as source_ts,
         case when kafka_offset % 89 <> 1 then ingestion_time end as ingestion_time
  from lineage
)
"""

_WITH_E = """
e as (
  select 't' || cast(event_id as varchar) as trade_id, 'SYM' || cast(user_id % 20 as varchar) as symbol,
         case event_type when 'purchase' then 'BUY' when 'view' then ' sell ' when 'click' then 'Buy'
              when 'signup' then 'SELL' else 'HOLD' end as side,
         value as price, cast(event_id % 100 + 1 as double) as quantity,
         date_trunc('milliseconds', ts) as trade_ts,
         event_id, event_type, user_id, ts,
         cast(event_id % 3 as integer) as kafka_partition, event_id // 3 as kafka_offset
  from events
),
q as (
  select symbol, price as bid, price + cast(0.01 as double) * (event_id % 50 + 1) as ask,
         trade_ts as event_ts, event_id, user_id, ts, kafka_partition, kafka_offset
  from e where event_type = 'view'
),
p as (select trade_id, symbol, side, price, quantity, trade_ts from e)
"""


def _sum4(x: str) -> str:
    return f"cast(sum(cast({x} as decimal(18,4))) as double)"


def _exact_sum(x: str) -> str:
    """Doubles in whole units of four decimals, and what is finer than these in whole numbers of 2^-100.

    What is within a unit in the last place of the value is its own rounding, and no part of it.
    """
    units = f"round_even({x} * 10000.0::double, 0)"
    fine = f"({x} - {units} / 10000.0::double)"
    small = f"case when abs{fine} > {2.0**-52!r}::double * abs({x}) then {fine} else 0.0::double end"
    return (f"(cast(sum(cast({units} as hugeint)) as double) / 10000.0::double"
            f" + cast(sum(cast({small} * {2.0**100!r}::double as hugeint)) as double) / {2.0**100!r}::double)")


def _base(source: str) -> str:
    return f"""
base as (
  select coalesce(cast(source_ts as date), cast(ingestion_time as date)) as trade_date, symbol,
         case when lower(side) = 'buy' then quantity else 0.0::double end as buy_qty_part,
         case when lower(side) = 'sell' then quantity else 0.0::double end as sell_qty_part,
         case when lower(side) = 'buy' then price * quantity else 0.0::double end as buy_notional_part,
         case when lower(side) = 'sell' then price * quantity else 0.0::double end as sell_notional_part,
         price, trade_ts, trade_id
  from {source} where coalesce(source_ts, ingestion_time) is not null
)"""


def _daily(source: str, keys: str = "trade_date, symbol") -> str:
    return _base(source) + f""",
sums as (
  select {keys}, count(*) as trades, {_sum4('buy_qty_part')} as buy_qty, {_sum4('sell_qty_part')} as sell_qty,
         {_sum4('buy_notional_part')} as buy_notional, {_sum4('sell_notional_part')} as sell_notional,
         arg_max(price, row(trade_ts, trade_id)) as mark
  from base group by {keys}
),
daily as (
  select {keys}, trades, buy_qty, sell_qty, buy_qty - sell_qty as net_qty, buy_notional, sell_notional,
         buy_notional + sell_notional as gross_notional,
         case when buy_qty > 0 then buy_notional / buy_qty end as avg_buy_price,
         case when sell_qty > 0 then sell_notional / sell_qty end as avg_sell_price, mark
  from sums
)"""


_DAILY_COLUMNS = """trade_date, symbol, trades, buy_qty, sell_qty, net_qty, buy_notional, sell_notional,
  gross_notional, avg_buy_price, avg_sell_price"""


def _bars(bucket: str, source: str = "e") -> str:
    return f"""
select symbol, {bucket} as minute, arg_min(price, row(trade_ts, trade_id)) as open, max(price) as high,
       min(price) as low, arg_max(price, row(trade_ts, trade_id)) as close, {_sum4('quantity')} as volume,
       count(*) as trade_count
from {source} group by symbol, minute"""


_MINUTE_BARS = _bars("date_trunc('minute', trade_ts)")
_PAYLOAD = """'{"trade_id":"' || trade_id || '","symbol":"' || symbol || '","side":"' || side || '","price":' ||
  cast(price as varchar) || ',"quantity":' || cast(quantity as varchar) || ',"trade_ts":' ||
  cast(epoch_us(ts) // 1000 as varchar) || '}'"""
_BRONZE = f"""select cast(user_id as varchar) as kafka_key, {_PAYLOAD} as raw_value, 'trades_raw' as kafka_topic,
  kafka_partition, kafka_offset, ts as source_ts"""

_BEST_QUOTES = """
best as (
  select symbol, event_ts, ask, bid from (
    select *, row_number() over (partition by symbol, event_ts order by ask desc, bid desc) as place from q)
  where place = 1
)"""


def _asof(condition: str = "true") -> str:
    """Trades with the newest quote before them; the quote counts only if the condition holds."""
    return f"""
found as (
  select p.*, case when {condition} then best.bid end as bid, case when {condition} then best.ask end as ask
  from p asof left join best on p.symbol = best.symbol and p.trade_ts >= best.event_ts
)
select *, (bid + ask) / 2 as mid, ask - bid as spread,
       case when lower(trim(side)) = 'buy' then price - (bid + ask) / 2
            when lower(trim(side)) = 'sell' then (bid + ask) / 2 - price end as slippage
from found"""


def _rules(source: str, rules: dict[str, str]) -> str:
    """One line per rule: count of rows for which the condition holds."""
    lines = [
        f"select '{name}' as rule, count(*) filter (where {failing}) as failures from {source}"
        for name, failing in rules.items()
    ]
    counted = " union all ".join(lines)
    return f"select rule, failures, failures <> 0 as should_warn, failures <> 0 as should_error from ({counted})"


# The seventeen payload forms as text, and what the other engine's own JSON functions read in them. A bare NaN is
# no JSON there; a payload that differs from JSON in nothing else is read with the text "NaN" in its place.
_UNTIDY = """
raw as (
  select *, event_id % 17 as form, cast(price as varchar) as px, cast(epoch_us(trade_ts) // 1000 as varchar) as ms from e
),
parts as (
  select *,
         case form when 7 then '"trade_id":5' when 9 then '"TRADE_ID":"' || trade_id || '"'
                   else '"trade_id":"' || trade_id || '"' end as p_id,
         case form when 11 then '"symbol":"  "' when 15 then '"symbol":{"name":"SYM"}' else '"symbol":"SYM"' end as p_symbol,
         case form when 12 then '"side":"\\tbuy"' when 16 then '"side":null' else '"side":"BUY"' end as p_side,
         case form when 6 then '"price":"' || px || '"' when 8 then '"price":NaN'
                   when 10 then '"price":' || px || ',"zzz":1' else '"price":' || px end as p_price,
         case form when 13 then '"trade_ts":-1500' when 14 then '"timestamp":"2024-03-01T10:20:30.250Z"'
                   else '"trade_ts":' || ms end as p_when
  from raw
),
texts as (
  select *, '{' || concat_ws(',', p_id, p_symbol, p_side, p_price, '"quantity":2.5', p_when) || '}' as good_text
  from parts
),
payloads as (
  select *, case form when 1 then '{not json' when 2 then good_text[:-2] when 3 then '' when 4 then null
                      when 5 then '[' || good_text || ',{"trade_id":"second"}]' else good_text end as payload
  from texts
),
jsons as (
  select *, replace(payload, ':NaN', ':"NaN"') as j,
         coalesce(payload like '%:NaN%', false) as price_is_nan
  from payloads
),
outcome as (
  select kafka_partition, kafka_offset, price_is_nan, o as j,
         o is null as broken,
         o ->> '$.trade_id' as trade_id, o ->> '$.symbol' as symbol, o ->> '$.side' as side,
         case when json_type(o, '$.price') in ('DOUBLE', 'UBIGINT', 'BIGINT') then cast(o ->> '$.price' as double) end as price,
         cast(o ->> '$.quantity' as double) as quantity,
         coalesce(make_timestamp(cast(o ->> '$.trade_ts' as bigint) * 1000),
                  cast(left(o ->> '$.timestamp', 23) as timestamp)) as trade_ts
  from (select *, case when json_valid(j) and json_type(j) = 'OBJECT' then cast(j as json) end as o from jsons)
)"""

_QUALITY_T = {
    "required_trade_id": "trade_id is null",
    "required_symbol": "symbol is null",
    "required_side": "side is null",
    "required_price": "price is null or isnan(price)",
    "required_quantity": "quantity is null or isnan(quantity)",
}

_STALE = """select symbol, max(trade_ts) as newest from silver group by symbol
            having coalesce(max(trade_ts) < (select max(trade_ts) from silver) - interval 7 days, true)"""
_WRONG_SIDE = "side not in ('buy', 'sell')"



def _field(name: str, string: bool) -> dict[str, str]:
    kind = f"json_type(j, '$.{name}')"
    wrong = f"{kind} <> 'VARCHAR'" if string else f"{kind} not in ('DOUBLE', 'UBIGINT', 'BIGINT') and not price_is_nan"
    return {
        f"{name}:missing": f"not broken and coalesce({kind} = 'NULL', true)",
        f"{name}:wrong_type": f"coalesce({kind} <> 'NULL' and {wrong}, false)",
    }


_CONTRACT = {
    "payload:unparsable": "broken",
    **_field("trade_id", True), **_field("symbol", True), **_field("side", True),
    "side:not_in_enum": "side not in ('BUY', 'SELL')",
    **_field("price", False), **_field("quantity", False), **_field("trade_ts", False),
}

# Reasons in the order of the columns.
_MISSING = "concat_ws(',', " + ", ".join(
    f"case when {test} then 'missing_{name}' end" for name, test in {
        "trade_id": "trade_id is null", "symbol": "symbol is null", "side": "side is null",
        "price": "price is null", "quantity": "quantity is null", "trade_ts": "trade_ts is null"}.items()) + ")"
_HOT_OUTCOME = "price is null and not price_is_nan"


def all_oracles() -> dict[str, str]:
    t, e, gaps = f"with {_WITH_T}", f"with {_WITH_E}", f"with {_WITH_GAPS}"
    silver_daily = f"{t}, {_daily('silver')}"
    gaps_daily = f"{gaps}, {_daily('gaps')}"
    asof = f"{e}, {_BEST_QUOTES}, {_asof()}"
    hot = "select trade_id, symbol, side, price, quantity, date_trunc('second', trade_ts) as trade_ts from e"
    in_time = _WITH_T.replace(
        "from lineitem", "from lineitem where l_shipdate + interval 1 hour <= timestamp '1999-03-31 17:00:00'"
    )
    # Runs of three days, each over what had arrived since the one before; the first record of a trade to enter stays.
    increments = """
        runs as (
          select *, case when ingestion_time <= timestamp '1998-06-30 17:00:00' then 1
                         when ingestion_time <= timestamp '1998-07-20 17:00:00' then 2
                         when ingestion_time <= timestamp '1999-03-31 17:00:00' then 3 end as run from clean),
        placed as (
          select *, row_number() over (partition by run, trade_id order by source_ts desc nulls last,
                                       kafka_partition desc, kafka_offset desc) as n from runs where run is not null),
        newest as (select * from placed where n = 1),
        grown as (select * from newest qualify row_number() over (partition by trade_id order by run) = 1)"""
    latest = f"""{e}
        select symbol, arg_max(price, row(trade_ts, trade_id)) as price, max(trade_ts) as trade_ts,
               arg_max(trade_id, row(trade_ts, trade_id)) as trade_id
        from e where trade_ts >= (select max(ts) from e) - interval 1 hour and event_id % 997 <> 3 group by symbol"""
    silver_columns = "trade_id, symbol, price, quantity, side, trade_ts, source_ts, ingestion_time"
    return {
        "bronze_envelope": f"{e} {_BRONZE} from e",
        "bronze_scan": f"{e} {_BRONZE}, ts + interval 1 minute as ingestion_time from e",
        "bronze_append": f"""{e}
            select cast(user_id as varchar) as kafka_key, 'trades_raw' as kafka_topic, kafka_partition, kafka_offset,
                   ts as source_ts from e
            union all
            select cast(user_id as varchar), 'market_data_raw', kafka_partition, kafka_offset, ts from q""",
        "silver_replace": f"{t} select {silver_columns} from silver",
        "gold_table_build": f"{silver_daily} select {_DAILY_COLUMNS} from daily",
        "hot_layout": f"""{e}, hot as ({hot})
            select *, cast(year(trade_ts) * 100 + month(trade_ts) as integer) as month from hot""",
        "bars_layout": f"""{e}, bars as ({_MINUTE_BARS})
            select *, cast(year(minute) * 100 + month(minute) as integer) as month from bars""",
        "bronze_partition_prune": f"""{e}
            select kafka_partition, kafka_offset, ts as source_ts, cast(ts + interval 1 minute as date) as ingest_date
            from e where cast(ts + interval 1 minute as date) between date '2024-01-10' and date '2024-01-12'""",
        "quotes_parse": f"{e} select symbol, bid, ask, event_ts from q",
        "enriched_payload": f"{e}, {_BEST_QUOTES}, result as (with {_asof()}) select symbol as key, * from result",
        "contract_violations": f"{e}, {_UNTIDY} {_rules('outcome', _CONTRACT)}",
        "hot_parse": f"{e} {hot}",
        "json_edge_cases": f"""{e}, {_UNTIDY}
            select kafka_partition, kafka_offset, trade_id, symbol, side, price, price_is_nan, quantity, trade_ts,
                   case when broken then 'unparsable' else concat_ws(',',
                     case when trade_id is null then 'missing_trade_id' end, case when symbol is null then 'missing_symbol' end,
                     case when side is null then 'missing_side' end, case when price is null then 'missing_price' end,
                     case when quantity is null then 'missing_quantity' end,
                     case when lower(trim(side, ' ')) not in ('buy', 'sell') then 'invalid_side' end) end as reasons
            from outcome""",
        "dual_sink_rejects": f"""{e}, {_UNTIDY}
            select kafka_partition, kafka_offset, {_MISSING.replace('price is null', _HOT_OUTCOME)} as reasons
            from outcome where reasons <> ''""",
        "silver_parse": f"""{e}
            select trade_id, symbol, price, quantity, side, trade_ts, ts as source_ts,
                   ts + interval 1 minute as ingestion_time, kafka_partition, kafka_offset from e""",
        "silver_required": f"""{t}
            select * from t where trade_id is not null and symbol is not null and side is not null
              and price is not null and not isnan(price) and quantity is not null and not isnan(quantity)""",
        "silver_standardize": f"{t} select * from tidy",
        "silver_side_filter": f"{t} select * from tidy where side in ('buy', 'sell')",
        "silver_dedupe": f"{t} select * from lineage",
        "silver_rejects": f"""{t},
            good as (select trade_id, kafka_partition, kafka_offset, place from ranked),
            judged as (
              select t.*, good.place,
                     concat_ws(',', case when t.symbol is null then 'missing_symbol' end,
                                    case when lower(trim(t.side)) not in ('buy', 'sell') then 'invalid_side' end,
                                    case when good.place > 1 then 'duplicate_trade_id' end) as reasons
              from t left join good on t.trade_id = good.trade_id and t.kafka_partition = good.kafka_partition
                                    and t.kafka_offset = good.kafka_offset)
            select trade_id, symbol, side, price, quantity, source_ts, kafka_partition, kafka_offset, reasons
            from judged where reasons <> ''""",
        "gold_base": f"""{gaps}, {_base('gaps')}
            select trade_date, symbol, buy_qty_part, sell_qty_part, buy_notional_part, sell_notional_part from base""",
        "daily_trade_metrics": f"{silver_daily} select {_DAILY_COLUMNS} from daily",
        "daily_qty": f"{gaps_daily} select trade_date, symbol, trades, buy_qty, sell_qty, net_qty from daily",
        "daily_notional": f"""{gaps_daily}
            select trade_date, symbol, buy_notional, sell_notional, gross_notional from daily""",
        "daily_fees": f"""{gaps}
            select coalesce(cast(source_ts as date), cast(ingestion_time as date)) as trade_date, symbol,
                   cast(sum(cast(round(price * quantity * 0.0000125, 9) as decimal(28,9))) as double) as fees
            from gaps where coalesce(source_ts, ingestion_time) is not null group by 1, 2""",
        "daily_vwap": f"{gaps_daily} select trade_date, symbol, avg_buy_price, avg_sell_price from daily",
        "trades_enriched": asof,
        "trades_enriched_stream":
            f"{e}, {_BEST_QUOTES}, {_asof('p.trade_ts - best.event_ts <= interval 1 day')}",
        "trades_enriched_late":
            f"{e}, {_BEST_QUOTES}, {_asof('p.trade_ts - best.event_ts <= interval 1 day')}",
        "silver_incremental": f"""{t},
            early as (select *, row_number() over (partition by trade_id order by source_ts desc nulls last,
                        kafka_partition desc, kafka_offset desc) as n
                      from clean where ingestion_time <= timestamp '1998-06-30 17:00:00'),
            late as (select *, row_number() over (partition by trade_id order by source_ts desc nulls last,
                        kafka_partition desc, kafka_offset desc) as n
                      from clean where ingestion_time > timestamp '1998-06-30 17:00:00')
            select {silver_columns} from early where n = 1
            union all
            select {silver_columns} from late where n = 1 and trade_id not in (select trade_id from early)""",
        "ohlcv_1m": f"{e} {_MINUTE_BARS}",
        "open_close": f"{e}, bars as ({_MINUTE_BARS}) select symbol, minute, open, close from bars",
        "high_low_volume": f"""{e}, bars as ({_MINUTE_BARS})
            select symbol, minute, high, low, volume, trade_count from bars""",
        "bars_merge": f"{e} {_MINUTE_BARS}",
        "ohlcv_rollup": f"""{e}
            select '1 hour' as width, * from ({_bars("date_trunc('hour', trade_ts)")})
            union all
            select '1 day' as width, * from ({_bars("cast(date_trunc('day', trade_ts) as timestamp)")})""",
        "stage_counts": f"""{t},
            counts as (
              select (select count(*) from t) as bronze_rows, (select count(*) from clean) as clean_rows,
                     (select count(*) from (select distinct trade_id, kafka_partition, kafka_offset from clean)) as records,
                     (select count(*) from lineage) as silver_rows)
            select bronze_rows, bronze_rows - clean_rows as rejected_rows, clean_rows,
                   clean_rows - records as redelivered_rows, records - silver_rows as duplicate_rows, silver_rows
            from counts""",
        "quality_not_null": f"""{silver_daily} {_rules('daily', {
            'not_null_trade_date': 'trade_date is null', 'not_null_symbol': 'symbol is null',
            'not_null_avg_buy_price': 'avg_buy_price is null'})}""",
        "quality_required": f"{t} {_rules('t', _QUALITY_T)}",
        "quality_accepted_values": f"{t} {_rules('tidy', {'accepted_values_side': _WRONG_SIDE})}",
        "quality_unique": f"""{t}, repeated as (select trade_id from clean group by trade_id having count(*) > 1)
            {_rules('repeated', {'unique_trade_id': 'true'})}""",
        "quality_ranges": f"""{t}, {_WITH_E}
            {_rules('silver', {
                'price_positive': 'price is null or isnan(price) or price <= 0',
                'quantity_positive': 'quantity is null or isnan(quantity) or quantity <= 0',
                'symbol_not_blank': "symbol is null or trim(symbol) = ''",
                'event_time_in_bounds':
                    "coalesce(trade_ts not between timestamp '1996-01-01' and timestamp '2001-01-01', true)"})}
            union all {_rules('q', {'ask_not_below_bid': 'ask < bid'})}
            union all {_rules(f'({_STALE})', {'fresh_symbol': 'true'})}""",
        "stale_symbols": f"{t} {_STALE}",
        "missing_offsets": f"""{e},
            kept as (select kafka_partition, kafka_offset from e
                     where (kafka_offset + 17 * kafka_partition) // 7 % 13 <> 5
                       and (kafka_offset + 17 * kafka_partition) // 900 % 5 <> 2),
            steps as (select *, lag(kafka_offset) over (partition by kafka_partition order by kafka_offset) as before from kept)
            select 'trades_raw' as kafka_topic, kafka_partition, before + 1 as first_offset, kafka_offset - 1 as last_offset,
                   kafka_offset - before - 1 as records
            from steps where kafka_offset - before > 1""",
        "schema_profile": f"""{e}, {_UNTIDY},
            seen as (select unnest(json_keys(j)) as key, j from outcome where not broken),
            known as (select unnest(['trade_id', 'symbol', 'side', 'price', 'quantity', 'trade_ts']) as key),
            found as (
              select key, count(*) as rows, count(*) filter (where json_type(json_extract(j, '$.' || key)) = 'NULL') as nulls
              from seen group by key)
            select key, coalesce(rows, 0) as rows, coalesce(nulls, 0) as nulls, known.key is not null as in_contract
            from found full join known using (key)""",
        "latest_price": latest,
        "latest_price_stream": latest,
        "live_volume": f"""{e}
            select symbol, {_sum4('quantity')} as volume, {_sum4('price * quantity')} as notional, count(*) as trades
            from e where trade_ts >= (select max(ts) from e) - interval 1 hour and event_id % 997 <> 3 group by symbol""",
        "latest_price_expiring": latest,
        "live_volume_stream": f"""{e}
            select symbol, {_sum4('quantity')} as volume, {_sum4('price * quantity')} as notional, count(*) as trades
            from e where trade_ts >= date_trunc('minute', (select max(ts) from e)) - interval 1 hour
              and event_id % 997 <> 3 group by symbol""",
        "active_positions": f"""{t}
            select symbol, {_sum4("case when side = 'buy' then quantity else -quantity end")} as position
            from silver group by symbol having position <> 0""",
        "daily_pnl": f"""{silver_daily},
            held as (
              select trade_date, symbol, sell_notional - buy_notional as cash, mark,
                     sum(net_qty) over (partition by symbol order by trade_date
                                        rows between unbounded preceding and current row) as position
              from daily),
            valued as (select *, position * mark as market_value from held)
            select trade_date, symbol, cash, position, mark, market_value,
                   cash + (market_value - lag(market_value, 1, 0.0::double)
                                            over (partition by symbol order by trade_date)) as pnl
            from valued""",
        "portfolio_summary": f"""{t}, {_daily('silver', 'symbol')}
            select symbol, net_qty as position, avg_buy_price as buy_vwap, avg_sell_price as sell_vwap,
                   mark as last_price, net_qty * mark as market_value,
                   sell_notional - buy_notional + net_qty * mark as total_pnl
            from daily""",
        "risk_metrics": f"""{silver_daily},
            returns as (
              select trade_date, symbol, mark as close, gross_notional as gross_exposure,
                     mark / lag(mark) over (partition by symbol order by trade_date) - 1 as daily_return,
                     mark / max(mark) over (partition by symbol order by trade_date
                                            rows between unbounded preceding and current row) - 1 as drawdown
              from daily)
            select trade_date, symbol, close, daily_return,
                   case when count(daily_return) over last > 1 then sqrt(cast(cast(
                     count(daily_return) over last * sum(units * units) over last - sum(units) over last * sum(units) over last
                     as varchar) as double) / (count(daily_return) over last * (count(daily_return) over last - 1)))
                     / 1e12::double end as volatility,
                   drawdown,
                   min(drawdown) over (partition by symbol order by trade_date
                                       rows between unbounded preceding and current row) as max_drawdown,
                   gross_exposure
            from (select *, cast(round_even(daily_return * 1e12::double, 0) as hugeint) as units from returns)
            window last as (partition by symbol order by trade_date rows between 19 preceding and current row)""",
        "quote_bars": f"""{e}, m as (select *, (bid + ask) / 2 as mid, ask - bid as spread from q)
            select symbol, date_trunc('minute', event_ts) as minute,
                   {_exact_sum('mid')} / count(*) as avg_mid, min(mid) as min_mid, max(mid) as max_mid,
                   {_exact_sum('spread')} / count(*) as avg_spread, min(spread) as min_spread, max(spread) as max_spread,
                   count(*) as quotes
            from m group by symbol, minute""",
        "silver_trades": f"{t} select {silver_columns} from silver",
        "gold_build_and_check": f"""{gaps_daily} {_rules('daily', {
            'not_null_trade_date': 'trade_date is null', 'not_null_symbol': 'symbol is null'})}""",
        "run_daily": f"""with {in_time}, {_daily('silver')} select {_DAILY_COLUMNS} from daily""",
        "run_daily_incremental": f"""{t}, {increments}, {_daily('grown')} select {_DAILY_COLUMNS} from daily""",
        "changed_trades": f"""{t}, {increments}
            select late.trade_id, late.kafka_partition, late.kafka_offset,
                   case late.run when 2 then '19980630T170000000000..19980720T170000000000'
                                 else '19980720T170000000000..19990331T170000000000' end as period
            from newest late join grown on late.trade_id = grown.trade_id and late.run > grown.run
            where (late.symbol, late.price, late.quantity, late.side, late.trade_ts)
               is distinct from (grown.symbol, grown.price, grown.quantity, grown.side, grown.trade_ts)""",
        "gold_reconciled": f"""{gaps_daily}
            select (select count(*) from gaps) as silver_rows,
                   (select count(*) from gaps where coalesce(source_ts, ingestion_time) is null) as undated_rows,
                   (select cast(sum(trades) as bigint) from daily) as gold_trades, cast(0 as bigint) as left_over""",
        "asof_cutoff": f"""{e}
            select kafka_partition, kafka_offset, ts + interval 1 minute as ingestion_time from e
            where ts + interval 1 minute <= timestamp '2024-01-15 17:00:00'""",
        "stream_ingest": f"{e} {_BRONZE} from e",
        "stream_restart": f"{e} {_BRONZE} from e",
        "dual_sink_bronze": f"{e} {_BRONZE} from e",
        "dual_sink_hot": f"{e} {hot}",
        "ohlcv_stream": f"{e} {_MINUTE_BARS}",
        "ohlcv_late_repair": f"{e} {_MINUTE_BARS}",
        "stream_dedupe": f"{t} select distinct trade_id from t",
    }
