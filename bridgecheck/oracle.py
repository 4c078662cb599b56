"""SQL counterparts of the registered queries over the same whole tables."""

from __future__ import annotations

from bridgecheck.views import AGENT, APP, with_views


def _second(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _average(column: str) -> str:
    """Mean of cents, rounded once, halves away from zero."""
    cents, n = f"sum(CAST({column} * 100 AS HUGEINT))", f"count({column})"
    return f"sign({cents}) * ((2 * abs({cents}) + {n}) // (2 * {n})) / 100.0"


def _double(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


_KEPT = "status <> 8 AND refund_amount <> oi_price + delivery_fee_price + service_fee_price"

_MEASURES = f"""
    count(DISTINCT warehouse_id) AS active_darkstores,
    count(DISTINCT user_id) AS unique_users,
    count(DISTINCT order_id) AS orders,
    CAST({_average('original_price')} AS DOUBLE) AS aov,
    {_double('sum(original_price)')} AS gmv,
    {_double('sum(delivery_fee_price)')} AS delivery_fee_revenue,
    {_double('sum(service_fee_price)')} AS service_fee_revenue
"""


def _daily(extra: str = "", orders: str = "mart_orders") -> str:
    return with_views(f"""
    SELECT {_day("date_trunc('day', created_at)")} AS dt, platform,
        strftime(max(created_at), '%Y.%m.%d') AS date, {_MEASURES},
        {_double('sum(oi_price)')} AS gmv_disc,
        {_double('sum(original_price - oi_price)')} AS incentives,
        {_double('sum(oi_price) + sum(delivery_fee_price) + sum(service_fee_price)')} AS gtv
    FROM {orders} WHERE {_KEPT} {extra}
    GROUP BY date_trunc('day', created_at), platform""", orders)


def _monthly(extra: str = "") -> str:
    return with_views(f"""
    SELECT {_day("date_trunc('month', created_at)")} AS dt, platform,
        strftime(max(created_at), '%Y.%m.01') AS month, {_MEASURES},
        {_double('sum(original_price) + sum(delivery_fee_price) + sum(service_fee_price)')} AS gtv
    FROM mart_orders WHERE status <> 8 {extra}
    GROUP BY date_trunc('month', created_at), platform""", "mart_orders")


_ORDER_COLUMNS = f"""platform, {_second('created_at')} AS created_at, warehouse_id, user_id, order_id,
    {_double('original_price')} AS original_price, {_double('oi_price')} AS oi_price,
    {_double('delivery_fee_price')} AS delivery_fee_price, {_double('service_fee_price')} AS service_fee_price,
    {_double('refund_amount')} AS refund_amount, status, payment_id"""


def _filtered(where: str) -> str:
    return with_views(f"SELECT {_ORDER_COLUMNS} FROM mart_orders WHERE {where}", "mart_orders")


def _scalar(key: str) -> str:
    text = "CASE WHEN json_valid(event_properties) THEN event_properties END"
    return (f"CASE WHEN json_type({text}, '$.{key}') NOT IN ('OBJECT', 'ARRAY', 'NULL') "
            f"THEN json_extract_string({text}, '$.{key}') END")


_PARTNER = f"contains(lower({_scalar('user_agent')}), '{AGENT.lower()}') OR {_scalar('currentApp')} = '{APP}'"


def _xml_text(column: str) -> str:
    return f"replace(replace(replace(CAST({column} AS VARCHAR), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _element(tag: str, column: str, empty: str) -> str:
    text = _xml_text(column)
    return f"CASE WHEN length({text}) > 0 THEN '<{tag}>' || {text} || '</{tag}>' ELSE '{empty}' END"


def _lines(*parts: str) -> str:
    return " || chr(10) || ".join(parts)


_TAGS = [("name", "title"), ("url", "url"), ("price", "price"), ("oldprice", "original_price"),
         ("path", "category_full_path"), ("category", "sub_category"), ("picture", "url_picture"),
         ("scrappedat", "time_scrap"), ("measure", "measure")]

_OFFER = _lines("'<offer id=\"' || CAST(product_id AS VARCHAR) || '\">'",
                *[_element(tag, column, f"<{tag}/>") for tag, column in _TAGS], "'<city/>'", "'</offer>'")

_OPENING = _lines("'<yml_catalog date=\"2026-02-02 10:00\">'", "'<shop>'",
                  _element("name", "min(mercant_name)", "<name/>"),
                  _element("company", "mercant_id", "<company/>"), "'<categories/>'", "'<offers>'")

_HAS_MERCHANT = "mercant_id IS NOT NULL AND mercant_id <> ''"

def _conformed(rows: str) -> str:
    return f"""SELECT l_orderkey AS order_id, CAST(l_suppkey AS VARCHAR) AS user_id,
        {_second('l_shipdate')} AS order_creation_time, CAST(l_linenumber AS BIGINT) AS min_promised_delivery_time,
        l_linestatus AS currency, CAST(NULL AS VARCHAR) AS cancel_reason, l_returnflag AS item_name,
        l_partkey AS item_id, CAST(trunc(l_extendedprice) AS BIGINT) AS item_price,
        CAST(NULL AS BIGINT) AS item_original_price, CAST(trunc(l_quantity) AS BIGINT) AS item_quantity
    FROM {rows}"""


_SPINE = """SELECT CAST(unnest(generate_series(date_trunc('{step}', min(o_orderdate)),
    date_trunc('{step}', max(o_orderdate)), INTERVAL 1 {step})) AS DATE) AS period FROM orders"""

_LOGS = with_views("""SELECT {columns} FROM log_lines WHERE trim(line) <> ''""", "log_lines")

_EVENT_COLUMNS = f"""event_id, {_second('ts')} AS ts, user_id, event_type, value, props, {_day('ts')} AS dt"""

ORACLE: dict[str, str] = {
    "financial_daily": _daily(),
    "financial_monthly": _monthly(),
    "financial_month": _monthly("AND date_trunc('month', created_at) = DATE '1995-03-01'"),
    "raw_orders": with_views(f"""
        SELECT {_day('created_at')} AS dt, platform, {_second('created_at')} AS created_at, warehouse_id, user_id,
            order_id, {_double('original_price')} AS original_price, {_double('oi_price')} AS gmv_disc,
            {_double('original_price - oi_price')} AS incentives,
            {_double('delivery_fee_price')} AS delivery_fee_price,
            {_double('service_fee_price')} AS service_fee_price, status, coalesce(payment_id, '') AS payment_id
        FROM mart_orders""", "mart_orders"),
    "raw_refunds": with_views(f"""
        SELECT {_day('created_at')} AS dt, {_second('created_at')} AS created_at, id AS refund_id, idempotency_key,
            order_id, {_double('price')} AS price, reference, {_second('refunded_at')} AS refunded_at,
            response_data, type, uuid
        FROM refunds""", "refunds"),
    "table_scan_predicate": f"""
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
            l_returnflag, l_linestatus, {_second('l_shipdate')} AS l_shipdate
        FROM lineitem WHERE l_returnflag <> 'N' AND l_quantity > 10""",
    "snapshot_scan": "SELECT *, '2026-01-05' AS dt FROM supplier",
    "on_day": _filtered("date_trunc('day', created_at) = DATE '1995-03-15'"),
    "on_day_events": f"""
        SELECT event_id, {_second('ts')} AS ts, user_id, event_type, value, props
        FROM events WHERE date_trunc('day', ts) = DATE '2024-01-15'""",
    "in_month": _filtered("date_trunc('month', created_at) = DATE '1995-03-01'"),
    "exclude_status": _filtered("status <> 8"),
    "exclude_full_refunds": _filtered("refund_amount <> oi_price + delivery_fee_price + service_fee_price"),
    "partner_events": with_views(f"""
        SELECT event_id, {_second('event_time')} AS event_time, event_type, event_properties, value
        FROM analytics_events WHERE {_PARTNER}""", "analytics_events"),
    "json_extract_scalar": with_views(f"""
        SELECT event_id, {_scalar('user_agent')} AS user_agent, {_scalar('currentApp')} AS "currentApp",
            {_scalar('session')} AS session, {_scalar('k')} AS k
        FROM analytics_events""", "analytics_events"),
    "time_formats": f"""
        SELECT event_id, strftime(ts, '%Y.%m.%d') AS day, strftime(ts, '%Y.%m.01') AS month, {_second('ts')} AS second,
            CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                 ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS iso
        FROM events""",
    "json_null_cleaning": with_views(
        """SELECT event_id, CASE WHEN event_id % 8 = 5 THEN line ELSE coalesce(record, line) END AS cleaned
        FROM log_lines""", "log_lines"),
    "conform_struct": _conformed("lineitem"),
    "conform_array": _conformed("(SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem) twice"),
    "conform_permissive": """
        SELECT p_partkey AS id, p_name AS name, CAST(NULL AS BIGINT) AS weight, CAST(p_size AS BIGINT) AS max_quantity,
            CASE WHEN p_size > 25 THEN true END AS is_active, p_retailprice AS depth, CAST(NULL AS VARCHAR) AS brand_name
        FROM part""",
    "conform_nulled": """
        SELECT 'id' AS "column", 0 AS nulled UNION ALL SELECT 'name', 0 UNION ALL SELECT 'depth', 0
        UNION ALL SELECT 'max_quantity', 0 UNION ALL SELECT 'weight', count(p_type) FROM part
        UNION ALL SELECT 'is_active', count(*) FROM part WHERE p_size > 10 AND p_size <= 25""",
    "sanitize_untyped": """
        SELECT p_partkey, CAST(NULL AS VARCHAR) AS untyped, 'string' AS untyped_type, CAST(1 AS BIGINT) AS items_size,
            'array<string>' AS items_type FROM part""",
    "day_spine": f"SELECT {_day('period')} AS period FROM ({_SPINE.format(step='day')}) s",
    "month_spine": f"SELECT {_day('period')} AS period FROM ({_SPINE.format(step='month')}) s",
    "range_report": with_views(f"""
        SELECT {_day('s.period')} AS period, coalesce(g.n, 0) AS rows,
            CASE WHEN g.n > 0 THEN 'ok' ELSE 'empty' END AS status
        FROM ({_SPINE.format(step='day')}) s LEFT JOIN (
            SELECT CAST(created_at AS DATE) AS period, count(DISTINCT platform) AS n
            FROM mart_orders WHERE {_KEPT} GROUP BY 1) g ON s.period = g.period""", "mart_orders"),
    "backfill_months": with_views(f"""
        SELECT {_day('s.period')} AS period, coalesce(g.n, 0) AS rows,
            CASE WHEN g.n > 0 THEN 'replaced' ELSE 'empty' END AS status
        FROM ({_SPINE.format(step='month')}) s LEFT JOIN (
            SELECT CAST(date_trunc('month', created_at) AS DATE) AS period, count(DISTINCT platform) AS n
            FROM mart_orders WHERE status <> 8 GROUP BY 1) g ON s.period = g.period""", "mart_orders"),
    "partition_replace": f"SELECT {_EVENT_COLUMNS} FROM events WHERE event_type <> 'view'",
    "partition_append": "SELECT *, '2026-01-05' AS dt FROM (SELECT * FROM supplier UNION ALL SELECT * FROM supplier) s",
    "partition_report": f"""
        SELECT {_day('d.period')} AS period, coalesce(g.n, 0) AS rows,
            CASE WHEN g.n > 0 THEN 'replaced' ELSE 'empty' END AS status
        FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS period) d
        LEFT JOIN (SELECT CAST(ts AS DATE) AS period, count(*) AS n FROM events GROUP BY 1) g ON d.period = g.period""",
    "size_bounded_split": f"SELECT {_EVENT_COLUMNS} FROM events",
    "split_file_sizes": f"""
        SELECT {_day('dt')} AS dt, count(*) AS documents, CAST(sum(bytes) AS BIGINT) AS total_bytes,
            count(*) FILTER (bytes > 32768) AS files_above, CAST(0 AS BIGINT) AS crowded_above
        FROM (SELECT DATE '2026-01-01' + CAST(coalesce(doc_id % 3, 0) AS INTEGER) AS dt,
                  13 + coalesce(strlen(text), 0) AS bytes FROM documents)
        GROUP BY ALL""",
    "json_export": "SELECT * FROM documents",
    "export_partner_day_files": with_views(f"""
        SELECT {_day('event_time')} AS dt, event_id, {_second('event_time')} AS event_time, event_properties,
            CAST(NULL AS DOUBLE) AS adid, CAST(NULL AS VARCHAR) AS uuid
        FROM analytics_events WHERE {_PARTNER}""", "analytics_events"),
    "export_day_range": f"""
        SELECT {_day('ts')} AS dt, event_id AS id, {_second('ts')} AS created_at, user_id AS created_by,
            CAST(trunc(value) AS BIGINT) AS quantity, event_type AS launch_id, CAST(NULL AS BOOLEAN) AS is_deleted
        FROM events""",
    "export_catalogue_snapshot": """
        SELECT '2026-01-05' AS dt, p_partkey AS id, p_name AS name, p_brand AS brand_name,
            CAST(p_size AS BIGINT) AS weight, p_retailprice AS depth, CAST(NULL AS VARCHAR) AS country FROM part""",
    "landed_log_files": f"SELECT DISTINCT {_day('ts')} AS dt, true AS has_bytes FROM events",
    "log_line_scan": _LOGS.replace("{columns}", f"{_day('ts')} AS dt, trim(line) AS line"),
    "log_records": _LOGS.replace("{columns}", f"""{_day('ts')} AS dt, record,
        CASE WHEN record IS NULL THEN 'not a JSON line' END AS error"""),
    "log_records_by_file": _LOGS.replace("{columns}", """record,
        CASE WHEN record IS NULL THEN 'not a JSON line' END AS error"""),
    "log_records_of_texts": """
        SELECT doc_id, concat_ws(' null ', text, source) AS text, coalesce(lang, '') AS lang,
            coalesce(source, '') AS source, CAST(NULL AS VARCHAR) AS error FROM documents""",
    "land_log_records": with_views(f"""
        SELECT {_day('ts')} AS dt, record AS raw_data, {_day('ts')} || ' 00:00:00' AS created_at, true AS has_id
        FROM log_lines WHERE record IS NOT NULL""", "log_lines"),
    "land_table_rows": """
        SELECT '2026-01-05' AS dt, '2026-01-05 00:00:00' AS created_at,
            '{"c_custkey":' || CAST(c_custkey AS VARCHAR) || ',"c_name":"' || c_name || '","c_nationkey":'
            || CAST(c_nationkey AS VARCHAR) || ',"c_acctbal":' || CAST(c_acctbal AS VARCHAR) || ',"c_mktsegment":"'
            || c_mktsegment || '","note":"' || CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE '' END || '","score":'
            || CASE WHEN c_custkey % 2 = 0 THEN '""' ELSE CAST(c_acctbal AS VARCHAR) END || '}' AS raw_data
        FROM customer""",
    "wrapped_parquet": """
        SELECT c_name, c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal,
            CAST(NULL AS VARCHAR) AS c_comment, CAST(NULL AS VARCHAR) AS error FROM customer""",
    "wrapped_parquet_files": f"""
        SELECT {_day("DATE '2026-01-01' + CAST(c_custkey % 3 AS INTEGER)")} AS dt, c_name, c_custkey, c_acctbal,
            false AS is_damaged FROM customer
        UNION ALL SELECT '2026-01-02', NULL, NULL, NULL, true""",
    "api_envelope": """
        WITH r AS (SELECT c_custkey, c_custkey % 8 AS kind, CAST(c_custkey AS VARCHAR) AS k FROM customer)
        SELECT c_custkey, '{"id":' || k || ',"v":""}' AS record, CAST(NULL AS VARCHAR) AS error FROM r WHERE kind = 0
        UNION ALL SELECT c_custkey, '{"id":' || k || '}', NULL FROM r WHERE kind IN (0, 1, 3)
        UNION ALL SELECT c_custkey, NULL, 'request failed: nope' FROM r WHERE kind = 2
        UNION ALL SELECT c_custkey, NULL, 'response has no data and is not a list' FROM r WHERE kind = 4
        UNION ALL SELECT c_custkey, NULL, 'data is not a list' FROM r WHERE kind = 5
        UNION ALL SELECT c_custkey, NULL, 'request failed: success is false' FROM r WHERE kind = 6""",
    "api_envelope_of_turns": """
        SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
            CAST(NULL AS VARCHAR) AS error FROM conversations""",
    "land_api_records": """
        WITH r AS (SELECT c_custkey % 8 AS kind, CAST(c_custkey AS VARCHAR) AS k FROM customer)
        SELECT '2026-01-05' AS dt, '{"id":' || k || ',"v":""}' AS raw_data, '2026-01-05 10:30:00' AS created_at
        FROM r WHERE kind = 0
        UNION ALL SELECT '2026-01-05', '{"id":' || k || '}', '2026-01-05 10:30:00' FROM r WHERE kind IN (0, 1, 3)""",
    "catalogue_offer_elements": with_views(f"""
        SELECT mercant_id, mercant_name, CAST(product_id AS VARCHAR) AS offer_id, {_OFFER} AS offer
        FROM merchant_products WHERE {_HAS_MERCHANT}""", "merchant_products"),
    "catalogue_documents": with_views(f"""
        , opened AS (SELECT mercant_id, {_OPENING} AS opening, CAST(ceil(count(*) / 20.0) AS BIGINT) AS fragments
            FROM merchant_products WHERE {_HAS_MERCHANT} GROUP BY mercant_id),
        ends AS (SELECT mercant_id, opening, unnest(range(fragments)) AS fragment FROM opened),
        lines AS (
            SELECT mercant_id, unnest(string_split(offer, chr(10))) AS line FROM (
                SELECT mercant_id, {_OFFER} AS offer FROM merchant_products WHERE {_HAS_MERCHANT})
            UNION ALL
            SELECT mercant_id, unnest(string_split(opening || chr(10) || '</offers>' || chr(10) || '</shop>' || chr(10)
                || '</yml_catalog>', chr(10))) FROM ends)
        SELECT mercant_id, line, count(*) AS n FROM lines GROUP BY mercant_id, line""", "merchant_products"),
    "catalogue_envelopes": with_views(f"""
        SELECT mercant_id, count(*) AS offers, CAST(ceil(count(*) / 1000.0) AS BIGINT) AS fragments,
            {_OPENING} AS opening
        FROM merchant_products WHERE {_HAS_MERCHANT} GROUP BY mercant_id""", "merchant_products"),
    "catalogue_small_document": with_views(f"""
        , ends AS (SELECT unnest(range(CAST(ceil((SELECT count(*) FROM merchant_products) / 1000.0) AS BIGINT))) AS fragment)
        SELECT 0 AS kind, '<?xml version=''1.0'' encoding=''utf-8''?>' || chr(10)
            || '<yml_catalog date="2026-02-02T10:00:00"><shop>'
            || (SELECT {_element('name', 'mercant_name', '<name />')} || {_element('company', 'mercant_id', '<company />')}
                FROM merchant_products ORDER BY id LIMIT 1)
            || '<categories /><offers>' AS value FROM ends
        UNION ALL
        SELECT 1, '<offer id="' || CAST(id AS VARCHAR) || '">' || {_element('name', 'title', '<name />')}
                || '<price>' || CAST(CAST(trunc(price) AS BIGINT) AS VARCHAR) || '</price></offer>'
        FROM merchant_products
        UNION ALL SELECT 2, '</offers></shop></yml_catalog>' FROM ends""", "merchant_products"),
    "export_order_days": f"""
        SELECT {_day('ts')} AS dt, event_id AS order_id, {_second('ts')} AS created_at, props AS address, value AS weight,
            CASE WHEN has THEN CAST(2 AS BIGINT) END AS n_items, CASE WHEN has THEN CAST(16 AS BIGINT) END AS n_fields,
            CASE WHEN has THEN CAST(trunc(value) AS BIGINT) END AS item_price, CASE WHEN has THEN user_id END AS item_product,
            CASE WHEN has THEN event_type END AS item_name, CASE WHEN has THEN {_second('ts')} END AS item_scanned
        FROM (SELECT *, event_id % 5 > 0 AS has FROM events)""",
    "export_delivered_days": f"""
        SELECT {_day('ts')} AS dt, CAST(event_id AS VARCHAR) AS order_id, {_second('ts')} AS order_creation_time,
            CAST(user_id AS VARCHAR) AS user_id, event_type AS name, event_type AS item_name, event_id AS item_id,
            CAST(NULL AS BIGINT) AS item_price, CAST(NULL AS BIGINT) AS item_original_price,
            CAST(trunc(value) AS BIGINT) AS item_quantity
        FROM events""",
    "backfill_failing_days": f"""
        SELECT {_day('d.period')} AS period, CASE WHEN coalesce(g.bad, 0) = 0 THEN coalesce(g.n, 0) END AS rows,
            CASE WHEN g.bad > 0 THEN 'failed' WHEN g.n > 0 THEN 'replaced' ELSE 'empty' END AS status,
            CASE WHEN g.bad > 0 THEN 'values that do not fit: quantity' END AS error,
            nullif(CASE WHEN g.bad > 0 THEN g.views ELSE g.n END, 0) AS held,
            CASE WHEN g.bad > 0 THEN nullif(g.views, 0) ELSE g.ids END AS quantity
        FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS period) d
        LEFT JOIN (SELECT CAST(ts AS DATE) AS period, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids,
                count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (day(ts) % 5 = 2 AND event_id % 3 = 1) AS bad
            FROM events GROUP BY 1) g ON d.period = g.period""",
    "export_batch_days": f"""
        SELECT {_day('ts')} AS dt, event_id AS id, {_second('ts')} AS created_at, {_second('ts')} AS updated_at,
            event_type AS batch_type, value AS latitude, user_id AS warehouse_id, CAST(NULL AS VARCHAR) AS launch_id
        FROM events""",
    "export_warehouse_products": """
        SELECT '2026-01-05' AS dt, p_partkey AS id, CAST(trunc(p_retailprice) AS BIGINT) AS price,
            CAST(p_size AS BIGINT) AS quantity, p_size > 25 AS is_active, p_name AS launch_id FROM part""",
    "export_warehouse_products_hourly": """
        SELECT '2026-01-05' AS dt, p_partkey AS id, CAST(p_size AS BIGINT) AS quantity, p_type AS feature_name,
            unnest(['2026-01-05 10:00:00', '2026-01-05 11:00:00']) AS catalog_updated_at FROM part""",
    "export_warehouses": """
        SELECT '2026-01-05' AS dt, s_suppkey AS id, s_name AS name, CAST(s_nationkey AS BIGINT) AS city_id,
            s_acctbal AS lat, CASE WHEN s_suppkey % 3 > 0 THEN '08:30:00' END AS opens_at, '23:15:00' AS closes_at
        FROM supplier""",
    "export_financial_days": _daily(orders="event_orders"),
    "export_financial_raw": with_views(f"""
        SELECT {_day('created_at')} AS dt, platform, {_second('created_at')} AS created_at, warehouse_id, user_id, order_id,
            {_double('original_price')} AS original_price, {_double('oi_price')} AS gmv_disc,
            {_double('original_price - oi_price')} AS incentives, {_double('delivery_fee_price')} AS delivery_fee_price,
            {_double('service_fee_price')} AS service_fee_price, status, coalesce(payment_id, '') AS payment_id
        FROM event_orders""", "event_orders"),
    "export_refunds_raw": with_views(f"""
        SELECT {_day('created_at')} AS dt, {_second('created_at')} AS created_at, id AS refund_id, idempotency_key, order_id,
            {_double('price')} AS price, reference, {_second('refunded_at')} AS refunded_at, response_data, type, uuid
        FROM event_refunds""", "event_refunds"),
    "conform_nested_nulled": """
        SELECT 'cart[].id' AS "column", count(*) + count(*) FILTER (l_linenumber = 2) AS nulled FROM lineitem
        UNION ALL SELECT 'cart[].quantity', 0 UNION ALL SELECT 'order_creation_time', 0
        UNION ALL SELECT 'order_id', count(*) FROM lineitem""",
    "land_log_days": _LOGS.replace("{columns}", f"""{_day('ts')} AS dt, coalesce(record, trim(line)) AS text,
        CASE WHEN record IS NULL THEN 'not a JSON line' END AS error"""),
}
ORACLE["export_delivered_structs"] = ORACLE["export_delivered_days"]
ORACLE["catalogue_brief_files"] = f"""
    SELECT line, count(*) AS n FROM (SELECT unnest(string_split(value, chr(10))) AS line FROM ({ORACLE["catalogue_small_document"]}))
    GROUP BY line"""
