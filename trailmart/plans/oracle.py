"""DuckDB SQL for the registered queries, on the same parquet tables.

Written from the definitions, independently of the Spark plans: plain windows,
self joins and quantiles where Spark has a two-phase form.
"""

from __future__ import annotations

from ..operators.evaluation import NORMAL_QUANTILE

ORACLES: dict[str, str] = {}

# Shared table expressions, each a (name, body) pair; ``needs`` pulls in the chain.
_VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}


def _view(name: str, body: str, *needs: str) -> None:
    _VIEWS[name] = (needs, body)


def _chain(names) -> list[str]:
    order: list[str] = []

    def visit(name):
        needs, _ = _VIEWS[name]
        for n in needs:
            visit(n)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return order


def _oracle(name: str, sql: str, *views: str) -> None:
    with_list = ",\n".join(f"{v} AS ({_VIEWS[v][1]})" for v in _chain(views))
    ORACLES[name] = f"WITH {with_list}\n{sql}" if with_list else sql


def _r(expr: str, digits: int = 6) -> str:
    return f"(round(CAST({expr} AS DOUBLE), {digits}) + CAST(0 AS DOUBLE))"


def _day(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def _list(values: str, order: str) -> str:
    return f"string_agg(CAST({values} AS VARCHAR), ',' ORDER BY {order})"


_US = "epoch_us(ts)"

# inputs ---------------------------------------------------------------------

_view(
    "ev_all",
    """SELECT event_id, user_id AS visitorid, ts,
       CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS itemid,
       CASE WHEN event_type = 'purchase' THEN event_id END AS transactionid
       FROM events""",
)
_ALLOWED = "event IN ('view', 'addtocart', 'removefromcart', 'transaction')"
_view("ev", f"SELECT * FROM ev_all WHERE {_ALLOWED}", "ev_all")
_view(
    "raw_once",
    """SELECT event_id, CASE WHEN event_id % 101 <> 0 THEN epoch_us(ts) // 1000 END AS ms,
       CASE WHEN event_id % 97 <> 0 THEN visitorid END AS visitorid, event,
       CASE WHEN event_id % 89 <> 0 THEN itemid END AS itemid, transactionid FROM ev_all""",
    "ev_all",
)
_view(
    "raw_ev",
    """SELECT ms, visitorid, event, itemid, transactionid FROM raw_once
       UNION ALL SELECT ms, visitorid, event, itemid, transactionid FROM raw_once WHERE event_id % 50 = 0""",
    "raw_once",
)
_view(
    "clean_ev",
    f"""SELECT DISTINCT ms, visitorid, event, itemid, transactionid FROM raw_ev
        WHERE ms IS NOT NULL AND {_ALLOWED} AND visitorid IS NOT NULL""",
    "raw_ev",
)
_view(
    "raw_props",
    """SELECT 1704067200000 + p_partkey * 1000 AS ms, p_partkey AS itemid, 'price' AS property,
              'n' || CAST(p_retailprice AS VARCHAR) AS value FROM part WHERE p_partkey % 7 <> 3
       UNION ALL SELECT 1704067200000 + p_partkey * 1000, p_partkey, 'categoryid', p_brand FROM part
       UNION ALL SELECT 1704067200000 + p_partkey * 1000 + 86400000, p_partkey, 'categoryid',
              'Brand#' || CAST(p_size % 25 + 1 AS VARCHAR) FROM part WHERE p_partkey % 10 = 0
       UNION ALL SELECT 1704067200000 + p_partkey * 1000, p_partkey, 'name', p_name FROM part
       UNION ALL SELECT 1704067200000 + p_partkey * 1000, p_partkey, 'categoryid', p_brand FROM part WHERE p_partkey % 20 = 1""",
)
_view(
    "num_props",
    r"""SELECT *, TRY_CAST(NULLIF(regexp_extract(value, '-?\d+\.?\d*'), '') AS DOUBLE) AS number FROM raw_props""",
    "raw_props",
)
_view(
    "props",
    """SELECT ms, itemid, property, min(number) AS value FROM num_props
       WHERE number IS NOT NULL GROUP BY ms, itemid, property""",
    "num_props",
)
_view(
    "cats",
    """SELECT c AS categoryid, CASE WHEN c > 5 THEN c % 5 + 1 ELSE -1 END AS parentid
       FROM (SELECT DISTINCT CAST(regexp_extract(p_brand, '(\\d+)', 1) AS BIGINT) AS c FROM part)""".replace("\\\\", "\\"),
)
_view(
    "mart_days",
    """SELECT l_partkey AS itemid, CAST(l_shipdate AS DATE) AS date,
              round(sum(l_extendedprice), 2) AS sales FROM lineitem GROUP BY 1, 2""",
)
_view(
    "mart",
    r"""SELECT d.itemid, d.date, CAST(regexp_extract(p_brand, '(\d+)', 1) AS BIGINT) AS categoryid, sales,
        round(coalesce(avg(sales) OVER (PARTITION BY d.itemid ORDER BY d.date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 0), 4) AS forecast
        FROM mart_days d LEFT JOIN part ON p_partkey = d.itemid""",
    "mart_days",
)

# sources --------------------------------------------------------------------

_oracle(
    "scan_events",
    "SELECT CAST(ms AS VARCHAR) AS timestamp, visitorid, event, itemid, transactionid FROM raw_ev",
    "raw_ev",
)
_oracle("scan_properties", "SELECT CAST(ms AS VARCHAR) AS timestamp, itemid, property, value FROM raw_props", "raw_props")
_oracle(
    "scan_categories",
    """SELECT CAST(categoryid AS VARCHAR) AS categoryid,
       CASE WHEN parentid > 0 THEN CAST(parentid AS VARCHAR) END AS parentid FROM cats""",
    "cats",
)
_oracle(
    "parquet_roundtrip",
    f"SELECT visitorid, itemid, event, {_US} AS timestamp, {_day('ts')} AS date FROM ev",
    "ev",
)
_view(
    "item_idx",
    """SELECT itemid, row_number() OVER (ORDER BY visitorid, ts, itemid) AS item_idx FROM (
         SELECT itemid, visitorid, ts FROM ev
         QUALIFY row_number() OVER (PARTITION BY itemid ORDER BY visitorid, ts) = 1)""",
    "ev",
)
_oracle("item_dim", "SELECT itemid, item_idx FROM item_idx", "item_idx")
_view(
    "scores",
    """SELECT avg(abs(sales - forecast)) AS mae, sqrt(avg((sales - forecast) ** 2)) AS rmse,
       avg(abs((sales - forecast) / greatest(sales, 1e-6))) * 100 AS mape,
       1 - sum((sales - forecast) ** 2) / (var_pop(sales) * count(*)) AS r2, count(*) AS samples FROM mart""",
    "mart",
)
_oracle(
    "metrics_table",
    " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {_r(m)} AS value FROM scores" for m in ("mae", "rmse", "mape", "r2", "samples")
    ),
    "scores",
)
_oracle(
    "table_profile",
    """SELECT 'events' AS table_name, count(*) AS rows, CAST(5 AS BIGINT) AS columns FROM ev
       UNION ALL SELECT 'item_properties', count(*), 4 FROM props
       UNION ALL SELECT 'category_tree', count(*), 2 FROM cats""",
    "ev",
    "props",
    "cats",
)

# cleaning -------------------------------------------------------------------

_oracle(
    "parse_epoch_ms",
    "SELECT ms * 1000 AS timestamp, visitorid, event, itemid FROM raw_ev WHERE ms IS NOT NULL",
    "raw_ev",
)
_oracle(
    "event_whitelist",
    f"SELECT CAST(ms AS VARCHAR) AS timestamp, visitorid, event, itemid FROM raw_ev WHERE {_ALLOWED}",
    "raw_ev",
)
_oracle("drop_missing", "SELECT visitorid, event, itemid FROM raw_ev WHERE visitorid IS NOT NULL", "raw_ev")
_oracle(
    "dedupe_rows",
    "SELECT DISTINCT CAST(ms AS VARCHAR) AS timestamp, visitorid, event, itemid, transactionid FROM raw_ev",
    "raw_ev",
)
_oracle("layout_by_time", f"SELECT {_US} AS timestamp, visitorid, event FROM ev", "ev")
_oracle(
    "clean_events",
    "SELECT ms * 1000 AS timestamp, visitorid, event, itemid, transactionid FROM clean_ev",
    "clean_ev",
)
_oracle(
    "clean_events_stats",
    f"""SELECT b.*, b.passing - a.rows_after AS duplicates_dropped, a.* FROM
        (SELECT count(*) AS rows_before, count(*) FILTER (ms IS NULL) AS rows_dropped_bad_ts,
           count(*) FILTER (ms IS NOT NULL AND NOT {_ALLOWED}) AS rows_dropped_bad_event,
           count(*) FILTER (ms IS NOT NULL AND {_ALLOWED} AND visitorid IS NULL) AS rows_dropped_missing_visitor,
           count(*) FILTER (ms IS NOT NULL AND {_ALLOWED} AND visitorid IS NOT NULL) AS passing FROM raw_ev) b,
        (SELECT count(*) AS rows_after, count(DISTINCT visitorid) AS unique_visitors,
           count(DISTINCT itemid) AS unique_items, {_day('min(epoch_ms(ms))')} AS date_min,
           {_day('max(epoch_ms(ms))')} AS date_max FROM clean_ev) a""".replace("SELECT b.*,", "SELECT b.* EXCLUDE (passing),"),
    "raw_ev",
    "clean_ev",
)
_oracle("stream_clean_events", "SELECT ms * 1000 AS timestamp, visitorid, event, itemid, transactionid FROM clean_ev", "clean_ev")
_EVENT_ROWS = f"SELECT visitorid, {_US} AS timestamp, event, itemid, transactionid FROM ev"
_oracle(
    "bot_filter",
    f"{_EVENT_ROWS} QUALIFY count(*) OVER (PARTITION BY visitorid, CAST(ts AS DATE)) <= 3",
    "ev",
)
_oracle("min_interactions", f"{_EVENT_ROWS} QUALIFY count(*) OVER (PARTITION BY visitorid) >= 40", "ev")
_oracle(
    "drop_missing_category",
    f"{_EVENT_ROWS} WHERE itemid IN (SELECT itemid FROM props WHERE property = 'categoryid' AND itemid % 5 > 0)",
    "ev",
    "props",
)
_oracle("first_number", f"SELECT itemid, property, value, {_r('number')} AS number FROM num_props", "num_props")
_oracle(
    "dedupe_keyed",
    """SELECT ms * 1000 AS timestamp, itemid, property, value FROM raw_props
       QUALIFY row_number() OVER (PARTITION BY itemid, property ORDER BY ms, value) = 1""",
    "raw_props",
)
_oracle(
    "clean_properties",
    f"SELECT ms * 1000 AS timestamp, itemid, property, {_r('value')} AS value FROM props",
    "props",
)
_oracle(
    "clean_properties_stats",
    """SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_dropped_bad_ts,
       count(*) FILTER (number IS NULL) AS rows_dropped_bad_value, CAST(0 AS BIGINT) AS rows_dropped_missing_ids,
       count(*) FILTER (number IS NOT NULL) - (SELECT count(*) FROM props) AS duplicates_dropped,
       (SELECT count(*) FROM props) AS rows_after,
       count(DISTINCT itemid) FILTER (number IS NOT NULL) AS unique_items,
       count(DISTINCT property) FILTER (number IS NOT NULL) AS unique_properties FROM num_props""",
    "props",
)
_oracle("clean_category", "SELECT categoryid, CAST(parentid AS BIGINT) AS parentid FROM cats", "cats")
_oracle(
    "clean_category_stats",
    """SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_dropped_missing, CAST(0 AS BIGINT) AS duplicates_dropped,
       count(*) AS rows_after, count(DISTINCT categoryid) AS unique_categories, CAST(0 AS BIGINT) AS unparsable_ids,
       count(DISTINCT parentid) AS unique_parents FROM cats""",
    "cats",
)

# item-day features ----------------------------------------------------------

_view(
    "counts",
    """SELECT itemid, CAST(ts AS DATE) AS date, count(*) FILTER (event = 'view') AS views,
       count(*) FILTER (event = 'addtocart') AS adds, count(*) FILTER (event = 'transaction') AS sales
       FROM ev WHERE itemid IS NOT NULL GROUP BY 1, 2""",
    "ev",
)
_D = _day("date")
_oracle("daily_item_counts", f"SELECT itemid, {_D} AS date, views, adds, sales FROM counts", "counts")


def _first_value(name: str) -> str:
    return f"""SELECT itemid, value AS {name} FROM props WHERE property = '{name}'
               QUALIFY row_number() OVER (PARTITION BY itemid ORDER BY ms, value) = 1"""


_view("price0", _first_value("price"), "props")
_view("item_cat", _first_value("categoryid"), "props")
_oracle("item_price", f"SELECT itemid, {_r('price')} AS price FROM price0", "price0")
_oracle("item_category", f"SELECT itemid, {_r('categoryid')} AS categoryid FROM item_cat", "item_cat")
_view(
    "priced",
    """SELECT itemid, last_value(price IGNORE NULLS) OVER (ORDER BY itemid ROWS UNBOUNDED PRECEDING) AS price
       FROM (SELECT DISTINCT itemid FROM ev) LEFT JOIN price0 USING (itemid)""",
    "ev",
    "price0",
)
_oracle("price_ffill", f"SELECT itemid, {_r('price')} AS price FROM priced", "priced")
_oracle(
    "price_item_scope",
    f"SELECT itemid, {_r('price')} AS price FROM (SELECT DISTINCT itemid FROM ev) LEFT JOIN price0 USING (itemid)",
    "ev",
    "price0",
)


def _frame(n: int) -> str:
    return f"OVER (PARTITION BY itemid ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


_W = "OVER (PARTITION BY itemid ORDER BY date)"
_sums = [(f"{c}_sum_{n}d", f"CAST(sum({c}) {_frame(n)} AS DOUBLE)") for n in (3, 7, 14, 30, 60) for c in ("views", "adds", "sales")]
_lags = [(name, f"CAST(lag(sales, {k}, 0) {_W} AS DOUBLE)") for name, k in
         (("sales_lag_1d", 1), ("sales_lag_7d", 7), ("sales_lag_14d", 14), ("sales_lag_dow", 7))]


def _cols(pairs) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in pairs)


_oracle("rolling_sums", f"SELECT itemid, {_D} AS date, views, adds, sales, {_cols(_sums)} FROM counts", "counts")
_oracle("sales_lags", f"SELECT itemid, {_D} AS date, views, adds, sales, {_cols(_lags)} FROM counts", "counts")
_view(
    "windows",
    f"""SELECT c.itemid, c.date, views, adds, sales, price, CAST(categoryid AS BIGINT) AS categoryid, {_cols(_sums)}, {_cols(_lags)},
        lag(price, 7) OVER (PARTITION BY c.itemid ORDER BY c.date) AS price_before
        FROM counts c LEFT JOIN priced p ON p.itemid = c.itemid LEFT JOIN item_cat k ON k.itemid = c.itemid"""
    .replace("PARTITION BY itemid ORDER BY date", "PARTITION BY c.itemid ORDER BY c.date"),
    "counts",
    "priced",
    "item_cat",
)
_view(
    "ratio",
    """SELECT *, adds_sum_7d / nullif(views_sum_7d, 0) AS ctr_7d, sales_sum_7d / nullif(views_sum_7d, 0) AS buyrate_7d,
       (price - price_before) / nullif(price_before, 0) AS price_pct_chg_7d FROM windows""",
    "windows",
)
_oracle("ratios", f"SELECT itemid, {_D} AS date, {_r('ctr_7d')} AS ctr_7d, {_r('buyrate_7d')} AS buyrate_7d FROM ratio", "ratio")
_view(
    "by_cat",
    """SELECT categoryid, avg(coalesce(ctr_7d, 0)) AS mean_ctr, avg(coalesce(buyrate_7d, 0)) AS mean_buy,
       avg(sales_sum_7d) AS mean_sales FROM ratio WHERE categoryid IS NOT NULL GROUP BY 1""",
    "ratio",
)
_view(
    "by_cat_day",
    "SELECT categoryid, date, sum(sales_sum_7d) AS cat_sales_7d FROM ratio WHERE categoryid IS NOT NULL GROUP BY 1, 2",
    "ratio",
)
_view(
    "target",
    """SELECT a.itemid, a.date, CAST(coalesce(b.sales, 0) AS DOUBLE) AS target_next7
       FROM counts a LEFT JOIN counts b ON b.itemid = a.itemid AND b.date = a.date + 7""",
    "counts",
)
_view(
    "features",
    """SELECT r.*, (coalesce(ctr_7d, 0) + 10 * mean_ctr) / 11 AS ctr_sm_7d,
       (coalesce(buyrate_7d, 0) + 10 * mean_buy) / 11 AS buyrate_sm_7d,
       (sales_sum_7d + 5 * mean_sales) / 6 AS sales_sm_7d, cat_sales_7d, target_next7
       FROM ratio r LEFT JOIN by_cat c ON c.categoryid = r.categoryid
       LEFT JOIN by_cat_day d ON d.categoryid = r.categoryid AND d.date = r.date
       JOIN target t ON t.itemid = r.itemid AND t.date = r.date""",
    "ratio",
    "by_cat",
    "by_cat_day",
    "target",
)
for _name in ("sales_sm_7d", "cat_sales_7d"):
    _oracle(
        {"sales_sm_7d": "smooth_by_category", "cat_sales_7d": "category_sales"}[_name],
        f"SELECT itemid, {_D} AS date, {_r(_name)} AS {_name} FROM features",
        "features",
    )
_oracle(
    "price_change",
    f"SELECT itemid, {_D} AS date, {_r('price')} AS price, {_r('price_pct_chg_7d')} AS price_pct_chg_7d FROM ratio",
    "ratio",
)
_calendar = [
    ("is_weekend", "CAST(isodow(date) >= 6 AS BIGINT)"),
    ("weekofyear", "CAST(weekofyear(date) AS BIGINT)"),
    ("month", "CAST(month(date) AS BIGINT)"),
    ("day_of_year", "CAST(dayofyear(date) AS BIGINT)"),
    *[(f"dow_{i}", f"CAST(isodow(date) = {i + 1} AS BIGINT)") for i in range(7)],
]
_oracle(
    "calendar",
    f"SELECT itemid, {_D} AS date, CAST(isodow(date) - 1 AS BIGINT) AS dow, {_cols(_calendar)} FROM counts",
    "counts",
)
_oracle("target_next7", f"SELECT itemid, {_D} AS date, target_next7 FROM target", "target")
_real = ["price", "ctr_7d", "buyrate_7d", "ctr_sm_7d", "buyrate_sm_7d", "cat_sales_7d", "sales_sm_7d", "price_pct_chg_7d"]
_oracle(
    "forecast_features",
    f"""SELECT itemid, {_D} AS date, categoryid, {_cols([(c, _r(c)) for c in _real])},
        {", ".join(n for n, _ in _sums + _lags)}, {_cols(_calendar)}, target_next7 FROM features""",
    "features",
)

_feature_list = f"""SELECT itemid, {_D} AS date, categoryid, {_cols([(c, _r(c)) for c in _real])},
        {", ".join(n for n, _ in _sums + _lags)}, {_cols(_calendar)}, target_next7 FROM features"""
_oracle("forecast_features_stored", _feature_list, "features")
_oracle("features_new_day", f"{_feature_list} WHERE date = (SELECT max(date) FROM features)", "features")
_oracle(
    "targets_due",
    f"""SELECT a.itemid, {_day('a.date')} AS date, CAST(b.sales AS DOUBLE) AS target FROM counts a JOIN counts b
        ON b.itemid = a.itemid AND b.date = a.date + 7 WHERE b.date = (SELECT max(date) FROM counts)""",
    "counts",
)
_view(
    "price_days",
    """SELECT l_partkey AS itemid, CAST(l_shipdate AS DATE) AS day, floor(l_extendedprice * (1 - l_discount) / l_quantity * 100) / 100 AS price
       FROM lineitem QUALIFY row_number() OVER (PARTITION BY itemid, day ORDER BY l_shipdate DESC, price DESC) = 1""",
)
_view(
    "order_days",
    """SELECT l_partkey AS itemid, CAST(o_orderdate AS DATE) AS date, count(*) AS lines, sum(l_quantity) AS units
       FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2""",
)
_view(
    "asof_days",
    """SELECT d.*, p.price FROM order_days d ASOF LEFT JOIN price_days p ON p.itemid = d.itemid AND p.day <= d.date""",
    "price_days",
    "order_days",
)
_oracle("price_asof", f"SELECT itemid, {_D} AS date, lines, {_r('units')} AS units, {_r('price')} AS price FROM asof_days", "asof_days")
_oracle(
    "price_change_asof",
    f"""SELECT itemid, {_D} AS date, {_r('price')} AS price, {_r('(price - before) / nullif(before, 0)')} AS price_pct_chg_7d
        FROM (SELECT *, lag(price, 7) {_W} AS before FROM asof_days)""",
    "asof_days",
)

# sequences ------------------------------------------------------------------

_oracle("item_index", "SELECT itemid, item_idx FROM item_idx", "item_idx")
_view("cat_idx", "SELECT categoryid, row_number() OVER (ORDER BY categoryid) AS cat_idx FROM cats", "cats")
_oracle(
    "item_index_extended",
    """WITH early AS (
         SELECT itemid, row_number() OVER (ORDER BY visitorid, ts, itemid) AS item_idx FROM (
           SELECT itemid, visitorid, ts FROM ev WHERE day(ts) <= 3
           QUALIFY row_number() OVER (PARTITION BY itemid ORDER BY visitorid, ts) = 1))
       SELECT itemid, item_idx FROM early UNION ALL
       SELECT i.itemid, row_number() OVER (ORDER BY i.item_idx) + (SELECT coalesce(max(item_idx), 0) FROM early)
       FROM item_idx i WHERE i.itemid NOT IN (SELECT itemid FROM early)""".replace("WITH early AS (", "SELECT * FROM (WITH early AS (", 1) + ")",
    "item_idx",
    "ev",
)
_oracle("category_index", "SELECT categoryid, cat_idx FROM cat_idx", "cat_idx")
_oracle(
    "attach_category",
    f"""SELECT visitorid, {_US} AS timestamp, itemid, CAST(categoryid AS BIGINT) AS categoryid
        FROM ev LEFT JOIN item_cat USING (itemid)""",
    "ev",
    "item_cat",
)
_oracle(
    "attach_category_fanout",
    f"""SELECT visitorid, {_US} AS timestamp, ev.itemid, CAST(value AS BIGINT) AS categoryid
        FROM ev LEFT JOIN props ON props.itemid = ev.itemid AND property = 'categoryid'""",
    "ev",
    "props",
)
_view(
    "kept",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY visitorid ORDER BY ts DESC, itemid DESC, event DESC) AS rn
       FROM ev WHERE itemid IS NOT NULL) WHERE rn <= 50""",
    "ev",
)
_oracle("last_n_per_visitor", f"SELECT visitorid, {_US} AS timestamp, event, itemid, rn FROM kept", "kept")
_view(
    "steps",
    """SELECT k.visitorid, k.ts, k.rn, i.item_idx, coalesce(x.cat_idx, 0) AS cat_idx,
       row_number() OVER (PARTITION BY k.visitorid ORDER BY rn DESC) AS pos,
       floor((epoch_us(k.ts) - min(epoch_us(k.ts)) OVER (PARTITION BY k.visitorid)) / 60000000) AS minutes
       FROM kept k JOIN item_idx i ON i.itemid = k.itemid
       LEFT JOIN item_cat c ON c.itemid = k.itemid LEFT JOIN cat_idx x ON x.categoryid = c.categoryid""",
    "kept",
    "item_idx",
    "item_cat",
    "cat_idx",
)
_SEQ = f"""SELECT visitorid, {_list('item_idx', 'pos')} AS item_seq, {_list('cat_idx', 'pos')} AS cat_seq,
           {_list('CAST(minutes AS BIGINT)', 'pos')} AS time_seq FROM %s GROUP BY visitorid"""
_oracle("reco_sequences", _SEQ % "steps", "steps")
_view(
    "fan_kept",
    """SELECT * FROM (SELECT ev.visitorid, ts, ev.itemid, coalesce(cat_idx, 0) AS cat_idx,
         row_number() OVER (PARTITION BY ev.visitorid ORDER BY ts DESC, ev.itemid DESC, event DESC, ms DESC NULLS LAST, coalesce(cat_idx, 0) DESC) AS rn
         FROM ev LEFT JOIN props ON props.itemid = ev.itemid AND property = 'categoryid'
         LEFT JOIN cat_idx ON cat_idx.categoryid = value WHERE ev.itemid IS NOT NULL) WHERE rn <= 50""",
    "ev",
    "props",
    "cat_idx",
)
_view(
    "fan_steps",
    """SELECT visitorid, item_idx, cat_idx, row_number() OVER (PARTITION BY visitorid ORDER BY rn DESC) AS pos,
       floor((epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY visitorid)) / 60000000) AS minutes
       FROM fan_kept JOIN item_idx USING (itemid)""",
    "fan_kept",
    "item_idx",
)
_oracle("reco_sequences_fanout", _SEQ % "fan_steps", "fan_steps")
_oracle(
    "sequence_stats",
    "SELECT count(DISTINCT visitorid) AS sequences, count(*) AS interactions, max(item_idx) AS n_items FROM steps",
    "steps",
)

# exploration ----------------------------------------------------------------

_view("raw_cats", "SELECT categoryid, CASE WHEN parentid > 0 THEN parentid END AS parentid FROM cats", "cats")
_MISSING = {
    "events": ("raw_ev", {"timestamp": "ms", "visitorid": "visitorid", "event": "event", "itemid": "itemid", "transactionid": "transactionid"}),
    "item_properties": ("raw_props", {"timestamp": "ms", "itemid": "itemid", "property": "property", "value": "value"}),
    "category_tree": ("raw_cats", {"categoryid": "categoryid", "parentid": "parentid"}),
}
_oracle(
    "missing_pct",
    " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{name}' AS "column",
            round_even(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0 END) * 100, 1) AS missing_pct FROM {view}"""
        for table, (view, columns) in _MISSING.items()
        for name, c in columns.items()
    ),
    "raw_ev",
    "raw_props",
    "raw_cats",
)
_oracle("event_type_counts", "SELECT event, count(*) AS n FROM ev GROUP BY 1", "ev")
_oracle("daily_volume", f"SELECT {_day('CAST(ts AS DATE)')} AS date, count(*) AS n FROM ev GROUP BY 1", "ev")
_oracle(
    "daily_volume_dense",
    f"""SELECT {_day('d')} AS date, count(event_id) AS n
        FROM (SELECT unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS d FROM ev_all)
        LEFT JOIN ev_all ON CAST(ts AS DATE) = d GROUP BY 1""",
    "ev_all",
)
_oracle("hourly_volume", "SELECT CAST(hour(ts) AS BIGINT) AS hour, count(*) AS n FROM ev GROUP BY 1", "ev")
_oracle(
    "hour_weekday_heatmap",
    "SELECT CAST(hour(ts) AS BIGINT) AS hour, "
    + ", ".join(f"CAST(count(*) FILTER (isodow(ts) = {i + 1}) AS DOUBLE) AS wday_{i}" for i in range(7))
    + " FROM ev_all GROUP BY 1",
    "ev_all",
)
_view(
    "sess",
    """SELECT *, sum(fresh) OVER (PARTITION BY visitorid ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM (
         SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM ev
         WINDOW w AS (PARTITION BY visitorid ORDER BY ts, event_id))""",
    "ev",
)
_oracle(
    "sessionize",
    f"SELECT visitorid, {_US} AS timestamp, itemid, event, CAST(session AS BIGINT) AS session FROM sess",
    "sess",
)
_oracle(
    "stream_sessions",
    "SELECT visitorid, min(epoch_us(ts)) AS first, max(epoch_us(ts)) AS last, count(*) AS events FROM sess GROUP BY visitorid, session",
    "sess",
)
_view("lens", "SELECT visitorid, CAST(session AS BIGINT) AS session, count(*) AS length FROM sess GROUP BY 1, 2", "sess")
_oracle("session_lengths", "SELECT * FROM lens", "lens")
_view("glens", "SELECT CAST(session AS BIGINT) AS session, count(*) AS length FROM sess GROUP BY 1", "sess")
_oracle("session_lengths_global", "SELECT * FROM glens", "glens")


def _hist(name: str, values: str, bins: int, digits: int, *views: str, extra: str = "") -> None:
    """Equal-width histogram of column v of ``values``, last bin closed."""
    _oracle(
        name,
        f"""SELECT b.bin, {_r('lo + b.bin * step', digits)} AS lower,
            {_r(f'CASE WHEN b.bin = {bins - 1} THEN hi ELSE lo + (b.bin + 1) * step END', digits)} AS upper, count(v) AS n{extra}
            FROM (SELECT unnest(range({bins})) AS bin) b
            CROSS JOIN (SELECT lo, hi, (hi - lo) / {float(bins)}::DOUBLE AS step FROM
              (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                      CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM ({values}))) s
            LEFT JOIN ({values}) x ON v >= lo + b.bin * step AND (v < lo + (b.bin + 1) * step OR b.bin = {bins - 1})
            GROUP BY b.bin, lo, hi, step""",
        *views,
    )


for _name, _lens in (("session_length_hist", "lens"), ("session_length_hist_global", "glens")):
    _hist(
        _name,
        f"SELECT CAST(length AS DOUBLE) AS v FROM {_lens} WHERE length <= (SELECT quantile_cont(CAST(length AS DOUBLE), 0.95) FROM {_lens})",
        30,
        6,
        _lens,
    )
_FUNNEL = ", ".join(
    f"count(*) FILTER (event = '{e}') AS {e}" for e in ("view", "addtocart", "removefromcart", "transaction")
)
_view("funnel", f"SELECT visitorid, CAST(session AS BIGINT) AS session, {_FUNNEL} FROM sess GROUP BY 1, 2", "sess")
_view("gfunnel", f"SELECT session, {_FUNNEL} FROM sess GROUP BY 1", "sess")
_oracle("session_funnel", "SELECT * FROM funnel", "funnel")
for _name, _source in (("funnel_rates", "funnel"), ("funnel_rates_global", "gfunnel")):
    _oracle(
        _name,
        f"""SELECT count(*) AS sessions,
            {_r('count(*) FILTER (view > 0 AND addtocart > 0) / count(*)')} AS view_to_cart,
            {_r('count(*) FILTER (transaction > 0 AND addtocart > 0) / count(*)')} AS cart_to_transaction,
            {_r('count(*) FILTER (view > 0 AND addtocart > 0) / count(*) FILTER (view > 0)')} AS view_to_cart_given_view,
            {_r('count(*) FILTER (transaction > 0 AND addtocart > 0) / count(*) FILTER (addtocart > 0)')} AS cart_to_transaction_given_cart
            FROM {_source}""",
        _source,
    )
_view("pop", "SELECT itemid, count(*) AS n FROM ev WHERE itemid IS NOT NULL GROUP BY 1", "ev")
_oracle("item_popularity", "SELECT * FROM pop", "pop")
_oracle("top_items_bounded", "SELECT * FROM pop ORDER BY n DESC, itemid LIMIT 15", "pop")
_oracle(
    "sketch_ranges",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS span, count(*) AS events, count(DISTINCT visitorid) AS visitors, count(DISTINCT itemid) AS items,
            count(DISTINCT (visitorid, CAST(ts AS DATE))) AS visitor_days, TRUE AS events_ok, TRUE AS distinct_ok, TRUE AS quantiles_ok
            FROM ev WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM ev) - {days}"""
        for name, days in (("all", 100000), ("week", 7), ("day", 1))
    ),
    "ev",
)
_oracle("top_items", "SELECT * FROM pop ORDER BY n DESC, itemid LIMIT 15", "pop")
_view(
    "tail",
    """SELECT itemid, n, row_number() OVER w AS rank, sum(n) OVER (w ROWS UNBOUNDED PRECEDING) / sum(n) OVER () AS cum
       FROM pop WINDOW w AS (ORDER BY n DESC, itemid)""",
    "pop",
)
_oracle("long_tail", f"SELECT itemid, n, rank, {_r('cum')} AS cum_share FROM tail", "tail")
_oracle(
    "coverage_items",
    """SELECT threshold, items_needed, CAST(least(floor(items_needed * 1.2::DOUBLE), (SELECT count(*) FROM pop)) AS BIGINT) AS plot_cut
       FROM (SELECT CAST(t AS DOUBLE) AS threshold, min(rank) AS items_needed
             FROM tail, (SELECT unnest([0.5, 0.8, 0.9]) AS t) WHERE cum >= CAST(t AS DOUBLE) GROUP BY 1)""",
    "tail",
)
_oracle(
    "topk_coverage",
    f"""SELECT k, {_r('max(cum)')} AS share FROM tail, (SELECT CAST(unnest([10, 100]) AS BIGINT) AS k)
        WHERE rank <= k GROUP BY 1""",
    "tail",
)
_view("vlen", "SELECT visitorid, count(*) AS length FROM ev_all GROUP BY 1 HAVING count(*) >= 2", "ev_all")
_oracle("visitor_lengths", "SELECT * FROM vlen", "vlen")
_oracle(
    "visitor_length_hist",
    f"""SELECT b.bin, {_r('2 + b.bin * step')} AS lower,
        {_r('CASE WHEN b.bin = 13 THEN hi ELSE 2 + (b.bin + 1) * step END')} AS upper, count(length) AS n
        FROM (SELECT unnest(range(14)) AS bin) b
        CROSS JOIN (SELECT quantile_cont(CAST(length AS DOUBLE), 0.99) AS hi, (hi - 2) / 14.0::DOUBLE AS step FROM vlen) s
        LEFT JOIN vlen ON length >= 2 + b.bin * step AND (length < 2 + (b.bin + 1) * step OR (b.bin = 13 AND length <= hi))
        GROUP BY b.bin, hi, step""",
    "vlen",
)
_oracle(
    "visitor_length_bands",
    """SELECT CASE WHEN length <= 5 THEN 'short' WHEN length <= 15 THEN 'medium' ELSE 'long' END AS band,
       count(*) AS visitors FROM vlen GROUP BY 1""",
    "vlen",
)
_oracle(
    "visitor_length_stats",
    f"""SELECT {_r('quantile_cont(CAST(length AS DOUBLE), 0.5)')} AS median, {_r('avg(length)')} AS mean,
        {_r('quantile_cont(CAST(length AS DOUBLE), 0.95)')} AS p95 FROM vlen""",
    "vlen",
)
_view(
    "gaps",
    """SELECT visitorid, gap FROM (SELECT visitorid, ts, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY visitorid ORDER BY ts)) / 1e6::DOUBLE AS gap FROM ev_all)
       WHERE gap IS NOT NULL""",
    "ev_all",
)
_view(
    "gaps_at",
    """SELECT visitorid, ts, gap, count(*) AS pairs FROM (SELECT visitorid, ts, (epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY visitorid ORDER BY ts)) / 1e6::DOUBLE AS gap FROM ev_all)
       WHERE gap IS NOT NULL GROUP BY 1, 2, 3""",
    "ev_all",
)
_oracle("inter_event_gaps", f"SELECT visitorid, {_r('gap')} AS gap_seconds, pairs FROM gaps_at", "gaps_at")
_EDGES = [0, 60, 300, 600, 900, 1200, 1800]
_oracle(
    "gap_hist",
    " UNION ALL ".join(
        f"""SELECT CAST({i} AS BIGINT) AS bin, CAST({lo} AS DOUBLE) AS lower, CAST({hi} AS DOUBLE) AS upper,
            count(*) FILTER (gap >= {lo} AND gap {'<=' if i == 5 else '<'} {hi}) AS n FROM gaps"""
        for i, (lo, hi) in enumerate(zip(_EDGES, _EDGES[1:]))
    ),
    "gaps",
)
_oracle(
    "gap_stats",
    f"""SELECT {_r('quantile_cont(gap, 0.5)')} AS median_gap_seconds,
        {_r('count(*) FILTER (gap <= 60) / count(*)')} AS share_within_minute FROM gaps""",
    "gaps",
)
_oracle(
    "eda_summary",
    f"""SELECT count(*) AS events, {_day('CAST(min(ts) AS DATE)')} AS date_min, {_day('CAST(max(ts) AS DATE)')} AS date_max,
        count(DISTINCT visitorid) AS visitors, count(DISTINCT itemid) AS items FROM ev_all""",
    "ev_all",
)

# forecast preparation -------------------------------------------------------

_view("model_rows", "SELECT itemid, date, sales_sum_7d, target_next7 FROM features WHERE target_next7 > 0", "features")
_oracle("nonzero_target", f"SELECT itemid, {_D} AS date, target_next7 FROM model_rows", "model_rows")
_oracle(
    "temporal_split",
    f"SELECT itemid, {_D} AS date, date >= (SELECT max(date) FROM model_rows) - 7 AS is_valid FROM model_rows",
    "model_rows",
)
_oracle(
    "sample_weight",
    f"SELECT itemid, {_D} AS date, {_r('greatest(sales_sum_7d, 0.1)')} AS sample_weight FROM model_rows",
    "model_rows",
)
_oracle("log_target", f"SELECT itemid, {_D} AS date, {_r('ln(1 + target_next7)')} AS log_target FROM model_rows", "model_rows")
_view(
    "blocks",
    """SELECT date, CASE WHEN i < n - 5 * (n // 6) THEN 0 ELSE (i - (n - 5 * (n // 6))) // (n // 6) + 1 END AS block
       FROM (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, count(*) OVER () AS n
             FROM (SELECT DISTINCT date FROM model_rows))""",
    "model_rows",
)
_oracle(
    "expanding_folds",
    f"""SELECT fold, count(*) FILTER (block < fold) AS train_rows, {_day('max(date) FILTER (block < fold)')} AS train_until,
        count(*) FILTER (block = fold) AS valid_rows, {_day('min(date) FILTER (block = fold)')} AS valid_from,
        {_day('max(date) FILTER (block = fold)')} AS valid_until
        FROM model_rows JOIN blocks USING (date), (SELECT CAST(unnest(range(1, 6)) AS BIGINT) AS fold) GROUP BY 1""",
    "blocks",
)
_oracle(
    "expanding_folds_by_row",
    f"""SELECT itemid, {_D} AS date, CASE WHEN i < n - 5 * (n // 6) THEN 0 ELSE (i - (n - 5 * (n // 6))) // (n // 6) + 1 END AS block
        FROM (SELECT *, row_number() OVER (ORDER BY itemid, date) - 1 AS i, count(*) OVER () AS n FROM model_rows)""",
    "model_rows",
)
_oracle(
    "oversample_low",
    f"""SELECT itemid, {_D} AS date, target_next7 FROM model_rows, (SELECT unnest([1, 2, 3]) AS copy)
        WHERE date < (SELECT max(date) FROM model_rows) - 7 AND (copy = 1 OR target_next7 <= 5)""",
    "model_rows",
)

ORACLES["written_features"] = ORACLES["forecast_features"]
ORACLES["written_sequences"] = ORACLES["reco_sequences"]
_inputs = ["categoryid", *_real, *[n for n, _ in _sums + _lags], *[n for n, _ in _calendar]]
_oracle(
    "assemble",
    f"""SELECT itemid, {_D} AS date, CAST({2 * len(_inputs)} AS BIGINT) AS width,
        {_r(' + '.join(f"coalesce(CAST({c} AS DOUBLE), 0) + CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in _inputs), 3)} AS total
        FROM (SELECT itemid, date, categoryid, {', '.join(_real)}, {', '.join(n for n, _ in _sums + _lags)}, {_cols(_calendar)} FROM features)""",
    "features",
)
_view("train_rows", "SELECT * FROM model_rows WHERE date < (SELECT max(date) FROM model_rows) - 7", "model_rows")
_oracle(
    "poisson_balance",
    f"""SELECT count(*) AS n, {_r('sum(greatest(sales_sum_7d, 0.1) * target_next7)', 3)} AS target_total,
        CAST(1 AS DOUBLE) AS met FROM train_rows""",
    "train_rows",
)
_view("valid_rows", "SELECT * FROM model_rows WHERE date >= (SELECT max(date) FROM model_rows) - 7", "model_rows")
_view(
    "weighed",
    """SELECT *, greatest(sales_sum_7d, 0.1) AS w, FALSE AS held FROM train_rows
       UNION ALL SELECT *, greatest(sales_sum_7d, 0.1), TRUE FROM valid_rows""",
    "train_rows",
    "valid_rows",
)
_view("first_score", "SELECT ln(sum(w * target_next7) / sum(w)) AS f FROM weighed WHERE NOT held", "weighed")
_losses = {
    "poisson": "exp(f) - target_next7 * f",
    "tweedie": "exp(0.5 * f) / 0.5 - target_next7 * exp(-0.5 * f) / -0.5",
}
_oracle(
    "boosting_start",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS objective, {_r(f'sum(w * ({loss})) FILTER (NOT held) / sum(w) FILTER (NOT held)')} AS train_loss,
            {_r(f'sum(w * ({loss})) FILTER (held) / sum(w) FILTER (held)')} AS valid_loss, {_r('max(f)')} AS start FROM weighed, first_score"""
        for name, loss in _losses.items()
    ),
    "weighed",
    "first_score",
)
_oracle(
    "boosting_balance",
    f"SELECT {_r('sum(w * target_next7)')} AS target, {_r('sum(w * target_next7)')} AS forecast, count(*) AS rows FROM weighed WHERE NOT held",
    "weighed",
)
_oracle(
    "boosting_checks",
    """SELECT objective, TRUE AS falls, TRUE AS kept_best, TRUE AS stopped, TRUE AS not_worse_than_mean
       FROM (SELECT unnest(['poisson', 'tweedie']) AS objective), (SELECT count(*) FROM model_rows)""",
    "model_rows",
)
_oracle(
    "prediction_checks",
    """SELECT kind, n, n AS good, n AS equal FROM (SELECT unnest(['poisson', 'trees', 'tweedie']) AS kind),
       (SELECT count(*) AS n FROM model_rows WHERE date >= (SELECT max(date) FROM model_rows) - 7)""",
    "model_rows",
)
_oracle(
    "importance_checks",
    f"""SELECT CAST({2 * len(_inputs)} AS BIGINT) AS inputs, CAST(1 AS DOUBLE) AS total, TRUE AS lowest_ok, TRUE AS known
        FROM (SELECT count(*) FROM model_rows)""",
    "model_rows",
)
_oracle(
    "tuning_grid",
    """SELECT candidate, fold, TRUE AS finite FROM (SELECT CAST(unnest(range(0, 2)) AS BIGINT) AS candidate),
       (SELECT DISTINCT CAST(block AS BIGINT) AS fold FROM blocks WHERE block > 0)""",
    "blocks",
)
_oracle("early_stopping", "SELECT CAST(60 AS BIGINT) AS \"limit\", count(*) > 0 AS stopped_early FROM train_rows", "train_rows")
_view(
    "bi_mart",
    """SELECT c.itemid, c.date, CAST(k.categoryid AS BIGINT) AS categoryid, CAST(c.sales AS DOUBLE) AS sales, f.sales_sum_7d / 7.0::DOUBLE AS forecast
       FROM counts c LEFT JOIN item_cat k ON k.itemid = c.itemid
       LEFT JOIN features f ON f.itemid = c.itemid AND CAST(f.date + INTERVAL 7 DAY AS DATE) = c.date""",
    "counts",
    "features",
    "item_cat",
)
_oracle("bi_mart", f"SELECT itemid, {_D} AS date, categoryid, {_r('sales')} AS sales, {_r('forecast')} AS forecast FROM bi_mart", "bi_mart")
_oracle(
    "model_diagnostics",
    f"""SELECT {_r('avg(abs(e))')} AS mae, {_r('sqrt(avg(e * e))')} AS rmse,
        {_r('avg(abs(e / greatest(sales, 1e-6))) * 100')} AS mape,
        {_r('1 - sum(e * e) / (var_pop(sales) * count(*))')} AS r2, count(*) AS samples
        FROM (SELECT *, sales - forecast AS e FROM bi_mart WHERE forecast IS NOT NULL)""",
    "bi_mart",
)

# evaluation -----------------------------------------------------------------

_WMAPE = "sum(abs(sales - forecast)) / nullif(sum(abs(sales)), 0)"
_oracle("wmape", f"SELECT {_r(_WMAPE)} AS wmape FROM mart", "mart")
_oracle(
    "quality_gate",
    f"""SELECT 'wmape' AS metric, {_r(_WMAPE)} AS value, CAST(0.1 AS DOUBLE) AS "limit", {_WMAPE} <= 0.1 AS passed FROM mart""",
    "mart",
)
_oracle(
    "forecast_metrics",
    f"SELECT {_cols([(m, _r(m)) for m in ('mae', 'rmse', 'mape', 'r2')])}, samples FROM scores",
    "scores",
)
_view("err", "SELECT *, abs(sales - forecast) AS v FROM mart", "mart")
_hist("abs_error_hist", "SELECT v FROM err", 40, 4, "err")
_oracle(
    "log_error_hist",
    f"""SELECT b.bin, {_r('10 ** (-3 + b.bin * step)', 4)} AS lower,
        {_r('10 ** CASE WHEN b.bin = 58 THEN top ELSE -3 + (b.bin + 1) * step END', 4)} AS upper,
        count(v) AS n, {_r('median_error', 4)} AS median_error
        FROM (SELECT unnest(range(59)) AS bin) b
        CROSS JOIN (SELECT log10(max(v) + 1) AS top, (top + 3) / 59.0::DOUBLE AS step, quantile_cont(v, 0.5) AS median_error FROM err) s
        LEFT JOIN err ON v >= 1e-3 AND least(floor((log10(v) + 3) / step), 58) = b.bin
        GROUP BY b.bin, top, step, median_error""",
    "err",
)


def _edges(col: str, n: int) -> str:
    return "[" + ", ".join(f"quantile_cont({col}, CAST({i} AS DOUBLE) / {n})" for i in range(n + 1)) + "]"


def _right(col: str, edges: str) -> str:
    return f"greatest(len(list_filter(list_distinct({edges}), lambda e: e < {col})) - 1, 0)"


def _left(col: str, edges: str) -> str:
    return f"len(list_filter({edges}, lambda e: e <= {col})) - 1"


_oracle(
    "tercile_matrix",
    f"""SELECT {_right('sales', 'ea')} AS actual_bin, {_right('forecast', 'ep')} AS predicted_bin, count(*) AS n
        FROM mart, (SELECT {_edges('sales', 3)} AS ea, {_edges('forecast', 3)} AS ep FROM mart) GROUP BY 1, 2""",
    "mart",
)
_oracle(
    "quartile_matrix",
    f"""SELECT {_left('sales', 'ea')} AS actual_bin, {_left('forecast', 'ea')} AS predicted_bin, count(*) AS n
        FROM mart, (SELECT {_edges('sales', 4)} AS ea FROM mart) GROUP BY 1, 2""",
    "mart",
)
_oracle(
    "residuals",
    f"SELECT itemid, {_D} AS date, {_r('forecast', 4)} AS forecast, {_r('sales - forecast', 4)} AS residual FROM mart",
    "mart",
)
_oracle(
    "mape_by_quantile",
    f"""SELECT {_right('forecast', 'ep')} AS bin, {_r('avg(v / greatest(sales, 1e-9)) * 100', 2)} AS mape, count(*) AS n
        FROM err, (SELECT {_edges('forecast', 5)} AS ep FROM mart) GROUP BY 1""",
    "err",
)
_oracle(
    "mape_by_quintile",
    f"""SELECT bin, {_r('avg(v / sales) FILTER (sales <> 0) * 100', 4)} AS mape, count(*) AS n
        FROM (SELECT *, {_left('forecast', 'ep')} AS bin FROM err, (SELECT {_edges('forecast', 5)} AS ep FROM mart))
        WHERE bin < 5 GROUP BY 1 HAVING count(*) >= 2 AND count(*) FILTER (sales <> 0) >= 1""",
    "err",
)



def _normal_quantile(p: str) -> str:
    """Inverse normal of ``p`` in terms of q = p - 0.5, by the coefficients the Spark side uses."""

    def ratio(kind: str, r: str) -> str:
        def poly(c):
            out = repr(c[-1]) + "::DOUBLE"
            for x in reversed(c[:-1]):
                out = f"(({out}) * ({r}) + {x!r}::DOUBLE)"
            return out

        top, bottom = NORMAL_QUANTILE[kind]
        return f"({poly(top)} / {poly(bottom)})"

    tail = f"sqrt(-ln(CASE WHEN {p} < 0.5 THEN {p} ELSE 1 - {p} END))"
    return f"""(CASE WHEN abs({p} - 0.5) <= 0.425 THEN ({p} - 0.5) * {ratio('middle', f'0.180625 - ({p} - 0.5) * ({p} - 0.5)')}
               ELSE (CASE WHEN {p} < 0.5 THEN -1 ELSE 1 END) *
                    (CASE WHEN {tail} <= 5 THEN {ratio('near', f'{tail} - 1.6')} ELSE {ratio('far', f'{tail} - 5')} END) END)"""


_view(
    "qq",
    f"""SELECT *, {_normal_quantile('m')} AS theoretical FROM (
          SELECT position, ordered, CASE WHEN position = 1 THEN 1 - pow(0.5::DOUBLE, 1.0::DOUBLE / n) WHEN position = n THEN pow(0.5::DOUBLE, 1.0::DOUBLE / n)
                 ELSE (position - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS m
          FROM (SELECT sales - forecast AS ordered, row_number() OVER (ORDER BY sales - forecast, itemid, date) AS position, count(*) OVER () AS n
                FROM mart WHERE sales IS NOT NULL AND forecast IS NOT NULL))""",
    "mart",
)
_oracle(
    "qq_points",
    f"""SELECT position, {_r('theoretical')} AS theoretical, {_r('ordered', 4)} AS ordered, {_r('a + b * theoretical', 4)} AS fitted
        FROM qq, (SELECT regr_slope(ordered, theoretical) AS b, regr_intercept(ordered, theoretical) AS a FROM qq)""",
    "qq",
)

# recommender ----------------------------------------------------------------

_view(
    "split",
    """SELECT visitorid, CAST('0x' || substr(md5(CAST(visitorid AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 80 AS train
       FROM (SELECT DISTINCT visitorid FROM steps)""",
    "steps",
)
_oracle("visitor_split", "SELECT visitorid, CASE WHEN train THEN 'train' ELSE 'test' END AS part FROM split", "split")
_view("sized", "SELECT *, count(*) OVER (PARTITION BY visitorid) AS len FROM steps", "steps")
_view(
    "held",
    f"""SELECT visitorid, {_list('item_idx', 'pos')} AS history, max(item_idx) FILTER (pos = len - 1) AS last_item
        FROM sized WHERE len >= 2 AND pos < len GROUP BY 1""",
    "sized",
)
_view("goal", "SELECT visitorid, item_idx AS target FROM sized WHERE len >= 2 AND pos = len", "sized")
_oracle("leave_last_out", "SELECT visitorid, history, target FROM held JOIN goal USING (visitorid)", "held", "goal")


def _follow(window: int, decay: float, visitors: str = "train") -> str:
    return f"""SELECT a.item_idx AS item, b.item_idx AS next, round(sum(CAST({decay} AS DOUBLE) ** (b.pos - a.pos - 1)), 9) AS score, count(*) AS n
               FROM steps a JOIN steps b ON b.visitorid = a.visitorid AND b.pos BETWEEN a.pos + 1 AND a.pos + {window}
               JOIN split s ON s.visitorid = a.visitorid WHERE {visitors} GROUP BY 1, 2"""


_view("follow1", _follow(1, 0.5), "split")
_view("follow3", _follow(3, 0.5), "split")
_oracle("transitions", f"SELECT item, next, {_r('score')} AS score, n FROM follow1", "follow1")
_BEST = "SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, next) AS rank FROM {} QUALIFY rank <= 20"
_oracle(
    "next_item_model",
    f"SELECT item, {_list('next', 'rank')} AS candidates FROM ({_BEST.format('follow3')}) GROUP BY 1",
    "follow3",
)
_view(
    "tested",
    "SELECT visitorid, target, last_item FROM held JOIN goal USING (visitorid) JOIN split USING (visitorid) WHERE NOT train",
    "held",
    "goal",
    "split",
)


def _share(percent: int) -> str:
    return f"CAST('0x' || substr(md5(CAST(visitorid AS VARCHAR)), 1, 8) AS BIGINT) % 100 < {percent}"


def _ranked(prefix: str, window: int, decay: float, history: int, recency: float, train: str, test: str) -> str:
    """Views that rank items for the visitors in ``test`` from those in ``train``; returns the last one's name."""
    _view(f"{prefix}_in", f"SELECT * FROM sized WHERE {train} AND pos > len - {history}", "sized")
    _view(
        f"{prefix}_follow",
        f"""SELECT a.item_idx AS item, b.item_idx AS next, round(sum(CAST({decay} AS DOUBLE) ** (b.pos - a.pos - 1)), 9) AS score
            FROM {prefix}_in a JOIN {prefix}_in b ON b.visitorid = a.visitorid AND b.pos BETWEEN a.pos + 1 AND a.pos + {window}
            GROUP BY 1, 2""",
        f"{prefix}_in",
    )
    _view(
        f"{prefix}_popular",
        f"""SELECT item_idx AS next, row_number() OVER (ORDER BY count(*) DESC, item_idx) AS place
            FROM sized WHERE {train} GROUP BY 1 QUALIFY place <= 40""",
        "sized",
    )
    _view(
        f"{prefix}_asked",
        f"SELECT *, CAST({recency} AS DOUBLE) ** (len - 1 - pos) AS vote FROM sized WHERE {test} AND len >= 2 AND pos < len AND pos >= len - {history}",
        "sized",
    )
    _view(
        f"{prefix}_rank",
        f"""SELECT visitorid, next, row_number() OVER (PARTITION BY visitorid ORDER BY s DESC, place NULLS LAST, next) AS rank
            FROM (SELECT visitorid, next, round(sum(s), 9) AS s FROM (
                    SELECT visitorid, next, vote * score AS s FROM {prefix}_asked JOIN {prefix}_follow ON item = item_idx
                    UNION ALL
                    SELECT visitorid, next, 0.0 AS s FROM (SELECT DISTINCT visitorid FROM {prefix}_asked), {prefix}_popular)
                  GROUP BY 1, 2)
            LEFT JOIN {prefix}_popular USING (next) QUALIFY rank <= 20""",
        f"{prefix}_asked",
        f"{prefix}_follow",
        f"{prefix}_popular",
    )
    return f"{prefix}_rank"


def _scores(prefix: str, ranks: str, test: str, on: str = "r.visitorid = g.visitorid AND ") -> None:
    _view(
        prefix,
        f"""SELECT avg(CASE WHEN rank IS NULL THEN 0 ELSE 1 END) AS hit_rate, avg(coalesce(1 / log2(rank + 1), 0)) AS ndcg,
            count(*) AS samples FROM (SELECT * FROM goal WHERE {test}) g LEFT JOIN {ranks} r ON {on}r.next = g.target""",
        "goal",
        ranks,
    )


_TRAIN, _TEST = _share(80), f"NOT ({_share(80)})"
_ranked("plain", 1, 0.5, 50, 0.5, _TRAIN, _TEST)
_oracle(
    "topk_next",
    f"""SELECT visitorid, target, {_list('next', 'rank')} AS top FROM goal JOIN plain_rank USING (visitorid) GROUP BY 1, 2""",
    "goal",
    "plain_rank",
)
_SCORES = f"{_r('hit_rate')} AS hit_rate, {_r('ndcg')} AS ndcg"
_scores("plain_scores", "plain_rank", _TEST)
_oracle("hit_ndcg", f"SELECT {_SCORES}, samples FROM plain_scores", "plain_scores")
_view("plain_top", "SELECT next, place AS rank FROM plain_popular WHERE place <= 20", "plain_popular")
_scores("popular_scores", "plain_top", _TEST, on="")
_oracle("popularity_baseline", f"SELECT {_SCORES}, samples FROM popular_scores", "popular_scores")
# window, decay, history, train share in percent, recency
_trials = [(1, 0.5, 50, 80, 0.5), (3, 0.5, 50, 80, 0.8), (5, 0.8, 20, 80, 0.5), (3, 0.5, 50, 70, 0.9)]
for _i, (_window, _decay, _history, _percent, _recency) in enumerate(_trials):
    for _kind, _who, _asked in (("holdout", _share(_percent), f"NOT ({_share(_percent)})"), ("in_sample", "TRUE", "TRUE")):
        _rank = _ranked(f"trial{_i}_{_kind}", _window, _decay, _history, _recency, _who, _asked)
        _scores(f"trial{_i}_{_kind}_scores", _rank, _asked)
        _view(
            f"trial{_i}_{_kind}",
            f"""SELECT {_i} AS candidate, '{_kind}' AS scored_on, hit_rate, ndcg, {_window} AS "window", {_decay} AS decay,
                {_history} AS history, {_percent / 100} AS train_share, {_recency} AS recency FROM trial{_i}_{_kind}_scores""",
            f"trial{_i}_{_kind}_scores",
        )
_view(
    "trials",
    " UNION ALL ".join(f"SELECT * FROM trial{i}_{k}" for i in range(len(_trials)) for k in ("holdout", "in_sample")),
    *[f"trial{i}_{k}" for i in range(len(_trials)) for k in ("holdout", "in_sample")],
)
_oracle(
    "tune_reco",
    f"""SELECT CAST(candidate AS BIGINT) AS candidate, scored_on, {_SCORES},
        CAST("window" AS BIGINT) AS "window", CAST(decay AS DOUBLE) AS decay, CAST(history AS BIGINT) AS history,
        CAST(train_share AS DOUBLE) AS train_share, CAST(recency AS DOUBLE) AS recency FROM trials
        WHERE scored_on = 'holdout'
           OR candidate = (SELECT candidate FROM trials WHERE scored_on = 'holdout' ORDER BY ndcg DESC, candidate LIMIT 1)""",
    "trials",
)
_oracle("vector_checks", f"SELECT count(*) AS samples, count(*) AS full, TRUE AS recall_ok FROM goal WHERE {_TEST}", "goal")
# Successive halving: window, decay, history, recency of each candidate; the share of visitors and who goes on by rung.
_options = [(1, 0.5, 50, 0.5), (3, 0.5, 50, 0.8), (5, 0.8, 20, 0.5), (2, 0.7, 50, 0.9), (4, 0.6, 30, 0.7), (1, 0.5, 10, 0.3)]
for _rung, (_part, _go_on) in enumerate([(25, 3), (50, 2), (100, 1)]):
    _seen = f"CAST('0x' || substr(md5('rung' || CAST(visitorid AS VARCHAR)), 1, 8) AS BIGINT) % 100 < {_part}"
    for _i, (_window, _decay, _history, _recency) in enumerate(_options):
        _who, _asked = f"({_share(80)}) AND {_seen}", f"NOT ({_share(80)}) AND {_seen}"
        _scores(f"rung{_rung}_{_i}", _ranked(f"rung{_rung}_{_i}_of", _window, _decay, _history, _recency, _who, _asked), _asked)
    _left = "" if _rung == 0 else f"WHERE candidate IN (SELECT candidate FROM rung{_rung - 1} WHERE promoted)"
    _views = [f"rung{_rung}_{i}" for i in range(len(_options))]
    _view(
        f"rung{_rung}",
        f"""SELECT CAST({_rung} AS BIGINT) AS rung, CAST({_part} AS BIGINT) AS share, candidate, ndcg,
            row_number() OVER (ORDER BY round(ndcg, 9) DESC NULLS LAST, candidate) <= {_go_on} AS promoted
            FROM ({' UNION ALL '.join(f'SELECT CAST({i} AS BIGINT) AS candidate, ndcg FROM {v}' for i, v in enumerate(_views))}) {_left}""",
        *_views,
        *([f"rung{_rung - 1}"] if _rung else []),
    )
_oracle(
    "tune_reco_rungs",
    " UNION ALL ".join(f"SELECT rung, share, candidate, {_r('ndcg')} AS score, promoted FROM rung{i}" for i in range(3)),
    *[f"rung{i}" for i in range(3)],
)
_oracle(
    "training_curve",
    f"""SELECT CAST(candidate AS BIGINT) AS iteration, {_SCORES},
        {_r('max(ndcg) OVER (ORDER BY candidate)')} AS best_ndcg FROM trials WHERE scored_on = 'holdout'""",
    "trials",
)
_view("first_at", "SELECT visitorid, item_idx AS anchor, min(pos) AS first_pos FROM steps GROUP BY 1, 2", "steps")
_view(
    "cooc",
    """SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY weight DESC, other) AS rank FROM (
         SELECT anchor, item_idx AS other,
           round(sum(CASE WHEN pos > first_pos THEN 2.0::DOUBLE ELSE 1 END / (abs(pos - first_pos) + 1)), 9) AS weight
         FROM first_at JOIN steps USING (visitorid) WHERE item_idx <> anchor GROUP BY 1, 2) QUALIFY rank <= 5""",
    "first_at",
)
_oracle("cooccurrence", f"SELECT anchor, other, {_r('weight')} AS weight, rank FROM cooc", "cooc")
_view(
    "conf",
    """SELECT cooc.*, sessions, least(100, weight / sessions * 100) AS confidence FROM cooc
       JOIN (SELECT anchor, count(*) AS sessions FROM first_at GROUP BY 1) USING (anchor)""",
    "cooc",
    "first_at",
)
_oracle(
    "reco_confidence",
    f"""SELECT anchor, other, {_r('weight', 4)} AS weight, rank, sessions, {_r('confidence', 4)} AS confidence,
        CASE WHEN confidence > 70 THEN 'High' WHEN confidence > 40 THEN 'Medium' ELSE 'Low' END AS tier FROM conf""",
    "conf",
)

# business queries -----------------------------------------------------------

_MART = f"itemid, {_D} AS date, categoryid, {_r('sales', 4)} AS sales, {_r('forecast', 4)} AS forecast"
_oracle("filter_dates", f"SELECT {_MART} FROM mart WHERE mart.date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'", "mart")
_oracle("filter_categories", f"SELECT {_MART} FROM mart WHERE categoryid IN (1, 2, 3)", "mart")
_oracle(
    "kpis",
    f"""SELECT count(*) AS transactions, {_r('sum(sales)', 2)} AS total_sales, count(DISTINCT itemid) AS active_items,
        {_r('avg(sales)', 2)} AS avg_sale FROM mart""",
    "mart",
)
_view("daily", "SELECT date, sum(sales) AS sales, sum(forecast) AS forecast FROM mart GROUP BY 1", "mart")
_oracle("daily_revenue", f"SELECT {_D} AS date, {_r('sales', 2)} AS sales FROM daily", "daily")
for _name, _key in (("category_performance", "categoryid"), ("item_performance", "itemid")):
    _oracle(
        _name,
        f"""SELECT {_key}, round(sum(sales), 2) AS total_sales, count(*) AS transactions,
            round_even(round(sum(sales), 2) / count(*) * 100, 0) / 100 AS avg_sale FROM mart GROUP BY 1""",
        "mart",
    )
_view("cents", "SELECT date, round(sales, 2) AS sales FROM daily", "daily")
_view("best_day", "SELECT date AS best_day, sales AS best_sales FROM cents ORDER BY sales DESC, date LIMIT 1", "cents")
_view("worst_day", "SELECT date AS worst_day, sales AS worst_sales FROM cents ORDER BY sales, date LIMIT 1", "cents")
_oracle(
    "best_worst_day",
    f"""SELECT {_r('(SELECT avg(sales) FROM cents)', 2)} AS avg_daily_sales, {_day('best_day')} AS best_day,
        {_r('best_sales', 2)} AS best_sales, {_day('worst_day')} AS worst_day, {_r('worst_sales', 2)} AS worst_sales
        FROM best_day, worst_day""",
    "best_day",
    "worst_day",
)
_view(
    "slope",
    "SELECT regr_slope(sales, i) AS slope FROM (SELECT sales, row_number() OVER (ORDER BY date) - 1 AS i FROM daily)",
    "daily",
)
_oracle("sales_trend", f"SELECT {_r('slope', 4)} AS slope FROM slope", "slope")
_view(
    "top_cat",
    "SELECT categoryid, round(sum(sales), 2) AS s, count(*) AS c FROM mart GROUP BY 1 ORDER BY s DESC, 1 LIMIT 1",
    "mart",
)
_view(
    "top_item",
    "SELECT itemid, round(sum(sales), 2) AS s FROM mart GROUP BY 1 ORDER BY s DESC, 1 LIMIT 1",
    "mart",
)
_insights = [
    "SELECT 1 AS position, format('Total Revenue: ${:,.2f} across {:,} transactions', sum(sales), count(*)) AS insight FROM mart",
    "SELECT 2, format('Daily Average: ${:,.2f} per day', avg(sales)) FROM daily",
    f"SELECT 3, format('Best Sales Day: {{}} with ${{:,.2f}}', {_day('best_day')}, best_sales) FROM best_day",
    f"SELECT 4, format('Lowest Sales Day: {{}} with ${{:,.2f}}', {_day('worst_day')}, worst_sales) FROM worst_day",
    "SELECT 5, format('Top Category: {} (${:,.2f})', categoryid, s) FROM top_cat",
    "SELECT 6, format('Category Spread: {} categories with {:,} total transactions', count(DISTINCT categoryid), count(*)) FROM mart",
    "SELECT 7, format('Best Selling Item: {} (${:,.2f})', itemid, s) FROM top_item",
    "SELECT 8, format('Average Transaction: ${:.2f} per item sale', avg(sales)) FROM mart",
    """SELECT 9, 'Model Quality: ' || CASE WHEN r2 > 0.8 THEN 'Excellent forecasting accuracy - predictions are highly reliable'
       WHEN r2 > 0.6 THEN 'Good forecasting accuracy - suitable for business planning'
       WHEN r2 > 0.4 THEN 'Moderate accuracy - use predictions with caution'
       ELSE 'Poor accuracy - consider model improvements' END FROM scores""",
    "SELECT 10, format('Prediction Error: {:.1f}% average error rate', mape) FROM scores",
    """SELECT 11, format('Sales Trend: {} at ${:.2f} per day', CASE WHEN slope > 0 THEN 'Growing' ELSE 'Declining' END, abs(slope)) FROM slope""",
]
_oracle(
    "insights",
    f"SELECT CAST(position AS BIGINT) AS position, insight FROM ({' UNION ALL '.join(_insights)})",
    "daily",
    "best_day",
    "worst_day",
    "top_cat",
    "top_item",
    "scores",
    "slope",
)
_view(
    "sample",
    f"SELECT itemid, date, sales, forecast FROM mart ORDER BY md5(CAST(itemid AS VARCHAR) || '|' || {_D}), itemid, date LIMIT 500",
    "mart",
)
_oracle(
    "actual_vs_forecast_sample",
    f"""SELECT itemid, {_D} AS date, {_r('sales', 4)} AS sales, {_r('forecast', 4)} AS forecast,
        {_r('least(min(sales) OVER (), min(forecast) OVER ())', 4)} AS axis_min,
        {_r('greatest(max(sales) OVER (), max(forecast) OVER ())', 4)} AS axis_max FROM sample""",
    "sample",
)
_oracle(
    "daily_actual_vs_forecast",
    f"SELECT {_D} AS date, {_r('sales', 4)} AS sales, {_r('forecast', 4)} AS forecast FROM daily",
    "daily",
)
_oracle(
    "category_daily_actual_vs_forecast",
    f"""SELECT categoryid, {_D} AS date, {_r('s', 4)} AS sales, {_r('f', 4)} AS forecast
        FROM (SELECT categoryid, date, sum(sales) AS s, sum(forecast) AS f FROM mart GROUP BY 1, 2)""",
    "mart",
)
_view("slen", "SELECT visitorid, count(*) AS seq_length FROM steps GROUP BY 1", "steps")
_oracle(
    "sequence_kpis",
    f"""SELECT count(*) AS sessions, {_r('avg(seq_length)')} AS mean_length,
        {_r('quantile_cont(CAST(seq_length AS DOUBLE), 0.5)')} AS median_length,
        (SELECT seq_length FROM (SELECT seq_length, count(*) AS c FROM slen GROUP BY 1) ORDER BY c DESC, seq_length LIMIT 1) AS mode_length,
        max(seq_length) AS max_length, CAST(sum(seq_length) AS BIGINT) AS interactions FROM slen""",
    "slen",
)
_hist(
    "sequence_hist",
    "SELECT CAST(seq_length AS DOUBLE) AS v FROM slen",
    25,
    6,
    "slen",
    extra=f", {_r('count(v) * 100.0 / (SELECT count(*) FROM slen)')} AS pct",
)
_oracle(
    "length_buckets",
    f"""SELECT CASE WHEN seq_length <= 3 THEN 'quick' WHEN seq_length <= 10 THEN 'regular' ELSE 'deep' END AS bucket,
        count(*) AS sessions, {_r('count(*) * 100.0 / (SELECT count(*) FROM slen)')} AS pct FROM slen GROUP BY 1""",
    "slen",
)
_oracle(
    "trending_items",
    """SELECT itemid AS item, n FROM (SELECT item_idx, count(*) AS n FROM steps GROUP BY 1 ORDER BY n DESC, item_idx LIMIT 10)
       JOIN item_idx USING (item_idx)""",
    "steps",
    "item_idx",
)
_oracle(
    "item_recommendations",
    f"""SELECT a.itemid, rank, b.itemid AS recommended, {_r('weight', 4)} AS weight, {_r('confidence', 4)} AS confidence,
        CASE WHEN confidence > 70 THEN 'High' WHEN confidence > 40 THEN 'Medium' ELSE 'Low' END AS tier
        FROM conf JOIN item_idx a ON a.item_idx = anchor JOIN item_idx b ON b.item_idx = other""",
    "conf",
    "item_idx",
)
_oracle(
    "session_explorer",
    f"""SELECT visitorid, seq_length, first_items, last_item, recommended FROM
        (SELECT visitorid, max(len) AS seq_length, {_list('item_idx', 'pos')} FILTER (pos <= 10) AS first_items,
                max(item_idx) FILTER (pos = len) AS last_item FROM sized GROUP BY 1)
        LEFT JOIN (SELECT anchor, {_list('other', 'rank')} AS recommended FROM cooc GROUP BY 1) ON anchor = last_item""",
    "sized",
    "cooc",
)
_oracle(
    "item_deep_dive",
    f"""SELECT itemid, {_r('sum(sales)', 2)} AS total_sales, {_r('avg(sales)', 8)} AS avg_sale, count(*) AS transactions,
        {_day('min(date) FILTER (sales = best)')} AS peak_day, {_r('max(sales)', 2)} AS peak_sales
        FROM (SELECT *, max(sales) OVER (PARTITION BY itemid) AS best FROM mart) GROUP BY 1""",
    "mart",
)
_view("cat_days", "SELECT categoryid AS k, date, sum(sales) AS sales FROM mart GROUP BY 1, 2", "mart")
_view("item_days", "SELECT itemid AS k, date, sales FROM mart", "mart")


def _projection(prefix: str, days: str, amplitude: float) -> None:
    _view(
        f"{prefix}_recent",
        f"SELECT *, row_number() OVER (PARTITION BY k ORDER BY date DESC) AS rn FROM {days}",
        days,
    )
    _view(
        f"{prefix}_base",
        f"""SELECT k, avg(sales) AS m, avg(step) AS t, max(date) AS until, avg(sales) FILTER (rn <= 7) AS current_avg
            FROM (SELECT *, sales - lag(sales) OVER (PARTITION BY k ORDER BY date) AS step
                  FROM {prefix}_recent WHERE rn <= 14) GROUP BY 1""",
        f"{prefix}_recent",
    )
    _view(
        f"{prefix}_ahead",
        f"""SELECT k, v, until + CAST(h AS INTEGER) AS date, CASE WHEN v IS NULL THEN NULL ELSE greatest(v, 0) END AS forecast
            FROM (SELECT *, m * (1 + {amplitude} * sin(2 * pi() * (h - 1) / 7)) * CASE WHEN m > 0 THEN 1 + t / m * h * 0.1 ELSE 1 END AS v
                  FROM {prefix}_base, (SELECT unnest(range(1, 15)) AS h))""",
        f"{prefix}_base",
    )


_projection("it", "item_days", 0.15)
_projection("ct", "cat_days", 0.2)
for _name, _prefix, _key in (("item", "it", "itemid"), ("category", "ct", "categoryid")):
    _oracle(
        f"{_name}_projection",
        f"SELECT k AS {_key}, {_D} AS date, {_r('forecast', 3)} AS forecast FROM {_prefix}_ahead",
        f"{_prefix}_ahead",
    )
    _noise = {"item": 0.08, "category": 0.05}[_name]
    _uniform = f"((CAST('0x' || substr(md5(CAST(k AS VARCHAR) || '/' || CAST(date - until AS VARCHAR) || '/7'), 1, 13) AS BIGINT) + 0.5) / {float(1 << 52)})"
    _oracle(
        f"{_name}_projection_noise",
        f"""SELECT k AS {_key}, {_D} AS date, {_r('CASE WHEN v IS NULL THEN NULL ELSE greatest(v, 0) END', 3)} AS forecast FROM (
              SELECT k, date, v + {_normal_quantile('u')} * m * {_noise} AS v FROM (SELECT *, {_uniform} AS u FROM {_prefix}_ahead JOIN {_prefix}_base USING (k)))""",
        f"{_prefix}_ahead",
    )
    _oracle(
        f"{_name}_growth",
        f"""SELECT k AS {_key}, {_r('current_avg', 3)} AS current_avg, {_r('future_avg', 3)} AS future_avg,
            {_r('CASE WHEN current_avg > 0 THEN (future_avg - current_avg) / current_avg * 100 ELSE 0 END', 3)} AS growth_pct
            FROM {_prefix}_base JOIN (SELECT k, avg(forecast) AS future_avg FROM {_prefix}_ahead GROUP BY 1) USING (k)""",
        f"{_prefix}_ahead",
    )
_oracle(
    "category_deep_dive",
    f"""SELECT categoryid, {_r('sum(sales)', 2)} AS revenue, count(DISTINCT itemid) AS items, {_r('avg(sales)', 6)} AS avg_sale,
        {_r('sum(sales) * 100 / (SELECT sum(sales) FROM mart)', 6)} AS share_pct FROM mart GROUP BY 1""",
    "mart",
)
_oracle(
    "top_products_in_category",
    """SELECT categoryid, itemid, sales, rank FROM (
         SELECT *, row_number() OVER (PARTITION BY categoryid ORDER BY sales DESC, itemid) AS rank FROM (
           SELECT categoryid, itemid, round(sum(sales), 2) AS sales FROM mart GROUP BY 1, 2)) WHERE rank <= 5""",
    "mart",
)
_oracle("selector_items", "SELECT DISTINCT itemid FROM mart", "mart")
_oracle("selector_categories", "SELECT DISTINCT categoryid FROM mart", "mart")
_oracle("selector_dates", f"SELECT {_day('min(date)')} AS min_date, {_day('max(date)')} AS max_date FROM mart", "mart")
