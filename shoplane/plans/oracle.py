"""SQL (DuckDB dialect) for every registered query, as a cross-check by other means.

The correctness gate runs each Spark query and the SQL given here on the same driver tables
(pre-registered as views ``part``, ``orders``, ``lineitem``, ``events`` ...) and compares results. The
SQL states what the models mean, not how the Spark plans go about it:

* each fact and mart is one grouping over a union of everything that happened (items and refunds;
  sessions, pageviews and orders; touches and sales), told apart by FILTER clauses;
* landing and exit page are the first URL of an ordered aggregate;
* same-day conversion and repeat buyers are EXISTS conditions of a sale;
* the list price is a window over the daily maxima;
* the incremental checks are "a build of the prefix before the cutoff, a build of everything from it on",
  not a merge.

Integer sums are cast to BIGINT (DuckDB sums to HUGEINT). Sums of doubles depend on their order, so these
columns (and only these) are snapped to a binary grid on both sides, see ``SUMMED``.
"""

from __future__ import annotations

from ..schemas import CONTRACTS

SLUG = "'/' || trim(regexp_replace(lower({c}), '[^a-z0-9]+', '-', 'g'), '-')"
PREFIX_END = "TIMESTAMP '2024-01-21 00:00:00'"

#: columns of marts and rollups that are, or come from, a sum over many doubles
SUMMED = ("gross_revenue_usd", "cogs_usd", "gross_profit_usd", "refund_amount_usd", "net_revenue_usd", "net_profit_usd",
          "returned_gross_revenue_usd", "avg_selling_price_usd", "inferred_discount_usd", "inferred_discount_pct",
          "refund_capture_rate", "net_revenue_per_purchasing_user")

Ctes = list[str]


def slug(c: str) -> str:
    return SLUG.format(c=c)


def _n(expr: str, where: str | None = None) -> str:
    """An aggregate as BIGINT, of the rows that match."""
    return f"CAST({expr}{f' FILTER (WHERE {where})' if where else ''} AS BIGINT)"


def _per(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0)"


# ------------------------------------------------------------------ the test data in source shape
def set_a() -> Ctes:
    return [
        """a_products AS (
  SELECT CAST(p_partkey AS INTEGER) AS product_id, TIMESTAMP '1995-01-01' AS created_at,
         concat(' ', p_name, ' ', p_brand, ' #', p_partkey, '! ') AS product_name FROM part)""",
        """a_lines AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
           l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS n FROM lineitem)""",
        "a_factor AS (SELECT max(n) + 1 AS f FROM a_lines)",
        """a_orders AS (
  SELECT o_orderkey AS order_id, o_orderdate AS created_at, o_orderkey AS website_session_id, o_custkey AS user_id,
         o_orderkey % (SELECT count(*) FROM part) AS primary_product_id,
         (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS items_purchased,
         o_totalprice AS price_usd, 0.6::DOUBLE * o_totalprice AS cogs_usd FROM orders)""",
        """a_order_items AS (
  SELECT l_orderkey * f + n AS order_item_id, o_orderdate AS created_at, l_orderkey AS order_id, l_partkey AS product_id,
         CAST(n = 1 AS BIGINT) AS is_primary_item, l_extendedprice AS price_usd, 0.6::DOUBLE * l_extendedprice AS cogs_usd
  FROM a_lines CROSS JOIN a_factor LEFT JOIN orders ON o_orderkey = l_orderkey)""",
        """a_order_item_refunds AS (
  SELECT l_orderkey * f + n AS order_item_id, l_orderkey AS order_id, l_extendedprice * l_discount AS refund_amount_usd,
         l_shipdate AS created_at FROM a_lines CROSS JOIN a_factor WHERE l_returnflag = 'R')""",
    ]


def set_b(p: str = "b_", collision: bool = False, prefix_only: bool = False) -> Ctes:
    name = "p_name" if collision else (
        "CASE WHEN p_partkey IN (1, 2) THEN ' Twin  Product! ' ELSE concat(' ', p_name, ' ', p_brand, ' #', p_partkey, '! ') END")
    before = f"WHERE created_at < {PREFIX_END}" if prefix_only else ""

    def product(k: str, event: str) -> str:
        return f"CASE WHEN {k} < 60 THEN {k} % 4 ELSE 4 + ({event}) % greatest(1, (SELECT count(*) FROM part) - 4) END"
    return [
        f"""{p}days AS (
  SELECT *, CAST(props->>'$.k' AS BIGINT) AS k, CAST(floor((CAST(ts AS DATE) - DATE '2024-01-01') / 2) AS BIGINT) AS two_days FROM events)""",
        f"""{p}ev AS (
  SELECT event_id, ts, user_id, event_type, value, k, user_id * (SELECT max(two_days) + 1 FROM {p}days) + two_days AS sid FROM {p}days)""",
        f"""{p}products AS (
  SELECT CAST(p_partkey AS INTEGER) AS product_id, TIMESTAMP '2024-01-01' AS created_at, {name} AS product_name FROM part)""",
        f"""{p}website_sessions AS (SELECT * FROM (
  SELECT sid AS website_session_id, min(ts) AS created_at, user_id, CAST(sid % 3 = 0 AS BIGINT) AS is_repeat_session,
         [NULL, 'gsearch', 'bsearch', 'social'][sid % 4 + 1] AS utm_source,
         [NULL, 'brand', 'nonbrand', 'nonbrand', 'nonbrand'][sid % 5 + 1] AS utm_campaign,
         if(sid % 6 = 0, NULL, concat('ad_', sid % 2)) AS utm_content, ['mobile', 'desktop'][sid % 2 + 1] AS device_type,
         CAST(NULL AS VARCHAR) AS http_referer
  FROM {p}ev WHERE event_type <> 'signup' OR k >= 50 GROUP BY sid, user_id) {before})""",
        f"""{p}website_pageviews AS (SELECT * FROM (
  SELECT event_id AS website_pageview_id,
         CASE WHEN event_id % 7 = 0 THEN date_trunc('day', ts)::TIMESTAMP WHEN event_id % 89 <> 0 THEN ts END AS created_at,
         if(event_id % 97 = 0, NULL, sid) AS website_session_id,
         CASE WHEN event_type IN ('view', 'click')
              THEN (SELECT {slug('product_name')} FROM {p}products WHERE product_id = {product('k', 'event_id')})
              ELSE concat('/', event_type) END AS pageview_url
  FROM {p}ev WHERE event_type IN ('view', 'click', 'signup') OR (event_type = 'error' AND k >= 50)) {before})""",
        f"""{p}orders AS (SELECT * FROM (
  SELECT event_id AS order_id, ts AS created_at, if(event_id % 97 = 0, NULL, sid) AS website_session_id, user_id,
         {product('k', 'event_id')} AS primary_product_id, k % 3 + 1 AS items_purchased, value AS price_usd,
         0.4::DOUBLE * value AS cogs_usd FROM {p}ev WHERE event_type = 'purchase' AND k <> 99) {before})""",
        f"""{p}sold AS (
  SELECT event_id * 10 + i AS order_item_id, ts AS created_at, event_id AS order_id, CAST(i = 0 AS BIGINT) AS is_primary_item,
         {product('((k + 13 * i) % 100)', 'event_id + i')} AS product_id, value / (i + 1) AS share
  FROM (SELECT *, unnest(range(k % 3 + 1)) AS i FROM {p}ev WHERE event_type = 'purchase'))""",
        f"""{p}all_items AS (
  SELECT order_item_id, created_at, order_id, product_id, is_primary_item,
         if(product_id % 50 = 43, 0.0::DOUBLE, share) AS price_usd, 0.4::DOUBLE * share AS cogs_usd FROM {p}sold)""",
        f"{p}order_items AS (SELECT * FROM {p}all_items {before})",
        f"""{p}order_item_refunds AS (SELECT * FROM (
  SELECT order_item_id, order_id, (order_item_id % 3) * price_usd / 2 / (j + 1) AS refund_amount_usd,
         created_at + to_days(CAST(order_item_id % 12 + 1 AS INTEGER)) AS created_at
  FROM (SELECT *, unnest(range(if(order_item_id % 2 = 0, 2, 1))) AS j FROM {p}all_items WHERE order_item_id % 7 = 0)) {before})""",
    ]


# ------------------------------------------------------------------ silver
def dim_products(p: str) -> Ctes:
    return [f"""{p}dim AS (
  SELECT product_id, created_at AS created_at_utc, CAST(created_at AS DATE) AS created_date, trim(product_name) AS product_name
  FROM {p}products)"""]


def refunds(p: str) -> Ctes:
    return [f"""{p}refunds AS (
  SELECT order_item_id, order_id, len(l) AS refund_event_count, list_sum([x.amount for x in l]) AS refund_amount_usd,
         list_min([x.moment for x in l]) AS first_refund_created_at_utc,
         list_max([x.moment for x in l]) AS last_refund_created_at_utc
  FROM (SELECT order_item_id, order_id, list({{'amount': refund_amount_usd, 'moment': CAST(created_at AS TIMESTAMP)}}) AS l
        FROM {p}order_item_refunds GROUP BY ALL))"""]


def fct_sales(p: str) -> Ctes:
    return [
        f"""{p}item_events AS (
  SELECT order_item_id, order_id, true AS is_item, CAST(created_at AS TIMESTAMP) AS moment, product_id, is_primary_item, price_usd, cogs_usd,
         NULL::DOUBLE AS amount FROM {p}order_items
  UNION ALL SELECT order_item_id, order_id, false, CAST(created_at AS TIMESTAMP), NULL, NULL, NULL, NULL, refund_amount_usd
  FROM {p}order_item_refunds)""",
        f"""{p}sales AS (
  SELECT order_item_id, e.order_id, max(e.moment) FILTER (WHERE is_item) AS order_item_created_at_utc,
         CAST(order_item_created_at_utc AS DATE) AS order_item_created_date, max(product_id) AS product_id,
         max(e.is_primary_item) AS is_primary_item_flag, coalesce(is_primary_item_flag = 1, false) AS is_primary_item,
         any_value(CAST(o.created_at AS TIMESTAMP)) AS order_created_at_utc, CAST(order_created_at_utc AS DATE) AS order_date,
         any_value(o.website_session_id) AS website_session_id, any_value(o.user_id) AS user_id,
         any_value(o.primary_product_id) AS primary_product_id, any_value(o.items_purchased) AS items_purchased,
         any_value(o.price_usd) AS order_revenue_usd, any_value(o.cogs_usd) AS order_cogs_usd,
         max(e.price_usd) AS gross_revenue_usd, max(e.cogs_usd) AS item_cogs_usd, gross_revenue_usd - item_cogs_usd AS gross_profit_usd,
         count(*) FILTER (WHERE NOT is_item) AS refund_event_count, coalesce(sum(amount), 0) AS refund_amount_usd,
         min(e.moment) FILTER (WHERE NOT is_item) AS first_refund_created_at_utc,
         max(e.moment) FILTER (WHERE NOT is_item) AS last_refund_created_at_utc,
         refund_event_count > 0 AS has_returned, refund_amount_usd > 0 AS has_refund,
         gross_revenue_usd - refund_amount_usd AS net_revenue_usd, net_revenue_usd - item_cogs_usd AS net_profit_usd,
         net_profit_usd / nullif(gross_revenue_usd, 0) AS net_margin_pct
  FROM {p}item_events e LEFT JOIN {p}orders o ON o.order_id = e.order_id GROUP BY order_item_id, e.order_id HAVING bool_or(is_item))"""]


def pageviews_ranked(p: str) -> Ctes:
    """Positions counted from either end of a session's ordered list of pageviews."""
    return [f"""{p}ranked AS (
  SELECT v.id AS website_pageview_id, website_session_id, v.moment AS pageview_created_at_utc, v.url AS pageview_url,
         place AS pageview_number_asc, CAST(list_position(back, v.id) AS BIGINT) AS pageview_number_desc
  FROM (SELECT website_session_id,
               unnest(list({{'id': website_pageview_id, 'moment': created_at, 'url': pageview_url}}
                      ORDER BY created_at NULLS LAST, website_pageview_id)) AS v,
               unnest(range(1, count(*) + 1)) AS place,
               list(website_pageview_id ORDER BY created_at DESC NULLS LAST, website_pageview_id DESC) AS back
        FROM {p}website_pageviews GROUP BY website_session_id))"""]


def session_facts(p: str) -> Ctes:
    """One row per session id of any pageview or order, also for none."""
    return [
        f"{p}pages AS (SELECT {slug('product_name')} AS url, list(product_id) AS ids FROM {p}dim GROUP BY url)",
        f"""{p}happened AS (
  SELECT website_session_id AS sid, 'v' AS kind, website_pageview_id AS id, CAST(created_at AS TIMESTAMP) AS moment, pageview_url AS url,
         coalesce(ids, []) AS ids, NULL::BIGINT AS items FROM {p}website_pageviews LEFT JOIN {p}pages ON url = pageview_url
  UNION ALL SELECT website_session_id, 'o', order_id, NULL, NULL, [], items_purchased FROM {p}orders)""",
        f"""{p}rolled AS (
  SELECT sid AS website_session_id, count(*) FILTER (WHERE kind = 'v') AS views,
         min(moment) AS first_pageview_at_utc, max(moment) AS last_pageview_at_utc,
         first(url ORDER BY moment NULLS LAST, id) FILTER (WHERE kind = 'v') AS landing_page_url,
         first(url ORDER BY moment DESC NULLS LAST, id DESC) FILTER (WHERE kind = 'v') AS exit_page_url,
         {_n('sum(len(ids))')} AS product_pageviews_count, len(list_distinct(flatten(list(ids)))) AS viewed_products_count,
         count(DISTINCT id) FILTER (WHERE kind = 'o') AS orders_count, {_n('sum(items)')} AS items_purchased_count,
         bool_or(kind = 'o') AS ordered
  FROM {p}happened GROUP BY sid)""",
    ]


def fct_sessions(p: str) -> Ctes:
    return session_facts(p) + [f"""{p}sess AS (
  SELECT website_session_id, s.created_at AS session_created_at_utc, CAST(s.created_at AS DATE) AS session_date, s.user_id,
         s.is_repeat_session AS is_repeat_session_flag, coalesce(s.is_repeat_session = 1, false) AS is_repeat_session,
         utm_source, utm_campaign, utm_content, device_type, http_referer, nullif(views, 0) AS pageviews_count,
         first_pageview_at_utc, last_pageview_at_utc, landing_page_url, exit_page_url, coalesce(views = 1, false) AS is_bounced,
         date_diff('second', first_pageview_at_utc, last_pageview_at_utc) AS session_duration_seconds,
         coalesce(product_pageviews_count, 0) AS product_pageviews_count, coalesce(viewed_products_count, 0) AS viewed_products_count,
         coalesce(r.product_pageviews_count > 0, false) AS has_product_pageview, coalesce(orders_count, 0) AS orders_count,
         coalesce(r.orders_count > 0, false) AS has_order, coalesce(items_purchased_count, 0) AS items_purchased_count
  FROM {p}website_sessions s LEFT JOIN {p}rolled r USING (website_session_id))"""]


# ------------------------------------------------------------------ gold
def product_days(p: str) -> Ctes:
    """Everything that a product has on a day, from one grouping over its touches and its sales."""
    return [
        f"""{p}touches AS (
  SELECT CAST(created_at AS DATE) AS d, unnest(ids)::BIGINT AS product, website_session_id AS sid
  FROM {p}website_pageviews JOIN {p}pages ON url = pageview_url)""",
        f"""{p}product_events AS (
  SELECT t.d, t.product, 't' AS kind, t.sid, user_id AS who, NULL::BIGINT AS order_id, false AS converted, false AS again,
         NULL AS sale FROM {p}touches t LEFT JOIN {p}sess s ON s.website_session_id = t.sid
  UNION ALL
  SELECT order_date, product_id, 's', website_session_id, user_id, order_id,
         EXISTS (FROM {p}touches t WHERE t.d = f.order_date AND t.product = f.product_id AND t.sid = f.website_session_id),
         EXISTS (FROM {p}sales g WHERE g.order_date IS NOT DISTINCT FROM f.order_date AND g.product_id IS NOT DISTINCT FROM f.product_id
                 AND g.user_id IS NOT DISTINCT FROM f.user_id AND g.order_id <> f.order_id), f
  FROM {p}sales f)""",
        f"""{p}product_days AS (
  SELECT d AS metric_date, product AS product_id,
         count(*) FILTER (WHERE kind = 't') AS product_pageviews_count, count(DISTINCT sid) FILTER (WHERE kind = 't') AS product_sessions_count,
         count(DISTINCT who) FILTER (WHERE kind = 't') AS product_viewers_count,
         count(DISTINCT sid) FILTER (WHERE converted) AS converted_sessions_count,
         count(DISTINCT order_id) FILTER (WHERE converted) AS converted_orders_count,
         count(*) FILTER (WHERE converted) AS converted_items_count,
         count(*) FILTER (WHERE kind = 's') AS order_items_sold_count, count(DISTINCT order_id) AS orders_count,
         count(DISTINCT who) FILTER (WHERE kind = 's') AS purchasing_users_count,
         count(DISTINCT sid) FILTER (WHERE kind = 's') AS purchasing_sessions_count,
         sum(sale.gross_revenue_usd) AS gross_revenue_usd, sum(sale.item_cogs_usd) AS cogs_usd,
         sum(sale.gross_profit_usd) AS gross_profit_usd, {_n('sum(sale.refund_event_count)')} AS refund_event_count,
         count(*) FILTER (WHERE sale.has_returned) AS returned_items_count, count(*) FILTER (WHERE sale.has_refund) AS refunded_items_count,
         sum(sale.refund_amount_usd) AS refund_amount_usd, sum(sale.net_revenue_usd) AS net_revenue_usd,
         sum(sale.net_profit_usd) AS net_profit_usd,
         count(DISTINCT who) FILTER (WHERE sale.has_returned) AS purchasers_with_returns_count,
         count(DISTINCT who) FILTER (WHERE again) AS repeat_buyers_count, count(*) FILTER (WHERE again) AS again_rows
  FROM {p}product_events GROUP BY d, product)""",
    ]


def mart_product_daily_sales(p: str) -> Ctes:
    table = "mart_product_daily_sales"
    derived = {"product_name": f"(SELECT any_value(product_name) FROM {p}dim x WHERE x.product_id = t.product_id)",
               "unique_purchasers_count": "CASE WHEN whole THEN purchasing_users_count ELSE 0 END",
               "product_session_conversion_rate": f"CASE WHEN whole THEN {_per('converted_sessions_count', 'product_sessions_count')} END",
               "item_return_rate": f"CASE WHEN whole THEN {_per('returned_items_count', 'order_items_sold_count')} END",
               "item_refund_rate": f"CASE WHEN whole THEN {_per('refunded_items_count', 'order_items_sold_count')} END"}
    cols = [f"{derived[c]} AS {c}" if c in derived else c if c in ("metric_date", "product_id")
            else f"CASE WHEN whole THEN coalesce(t.{c}, 0) ELSE 0 END AS {c}" for c in CONTRACTS[table].fieldNames()]
    return [f"""{p}{table} AS (
  SELECT {', '.join(cols)}
  FROM (SELECT *, metric_date IS NOT NULL AND product_id IS NOT NULL AS whole FROM {p}product_days) t)"""]


def mart_product_daily_returns(p: str) -> Ctes:
    return [
        f"""{p}return_days AS (
  SELECT order_date, product_id, count(*) AS sold, count(*) FILTER (WHERE has_returned) AS returned,
         count(*) FILTER (WHERE has_refund) AS refunded, {_n('sum(refund_event_count)')} AS refund_event_count,
         avg(gross_revenue_usd) AS mean_price, min(gross_revenue_usd) AS low, max(gross_revenue_usd) AS high,
         max(max(gross_revenue_usd)) OVER (PARTITION BY product_id) AS list_price,
         sum(refund_amount_usd) AS refund_amount_usd, sum(gross_revenue_usd * has_returned::INT) AS back,
         sum(gross_revenue_usd) AS gross_revenue_usd, sum(net_revenue_usd) AS net_revenue_usd, sum(net_profit_usd) AS net_profit_usd
  FROM {p}sales GROUP BY order_date, product_id)""",
        f"""{p}mart_product_daily_returns AS (
  SELECT order_date, t.product_id, product_name, sold AS order_items_sold_count, returned AS returned_items_count,
         refunded AS refunded_items_count, refund_event_count, mean_price AS avg_selling_price_usd, low AS min_selling_price_usd,
         high AS max_selling_price_usd, list_price AS list_price_usd, greatest(0, coalesce(list_price, 0) - mean_price) AS inferred_discount_usd,
         inferred_discount_usd / nullif(list_price, 0) AS inferred_discount_pct, refund_amount_usd, back AS returned_gross_revenue_usd,
         gross_revenue_usd, net_revenue_usd, net_profit_usd, {_per('returned', 'sold')} AS item_return_rate,
         {_per('refunded', 'sold')} AS item_refund_rate, refund_amount_usd / nullif(back, 0) AS refund_capture_rate
  FROM {p}return_days t LEFT JOIN {p}dim x ON x.product_id = t.product_id)""",
    ]


def mart_channel_daily_sessions(p: str) -> Ctes:
    dims = ", ".join(f"ifnull({c}, '(none)') AS {c}" for c in ("utm_source", "utm_campaign", "utm_content", "device_type"))
    return [f"""{p}mart_channel_daily_sessions AS (
  SELECT session_date, utm_source, utm_campaign, utm_content, device_type, count(*) AS sessions_count,
         count(*) FILTER (WHERE is_bounced) AS bounced_sessions_count, {_n('sum(product_pageviews_count)')} AS product_pageviews_count,
         count(*) FILTER (WHERE has_product_pageview) AS product_view_sessions_count, {_n('sum(orders_count)')} AS orders_count,
         {_n('sum(items_purchased_count)')} AS items_purchased_count, avg(has_order::INT) AS session_conversion_rate,
         avg(is_bounced::INT) AS bounce_rate, avg(has_product_pageview::INT) AS product_view_session_rate,
         {_per('sum(orders_count)', 'count(*) FILTER (WHERE has_product_pageview)')} AS orders_per_product_view_session
  FROM (SELECT * REPLACE ({dims}) FROM {p}sess) GROUP BY session_date, utm_source, utm_campaign, utm_content, device_type)"""]


def customer_days(p: str) -> Ctes:
    return [
        f"""{p}customer_events AS (
  SELECT session_date AS d, user_id AS who, s AS visit, NULL AS sale FROM {p}sess s
  UNION ALL SELECT order_date, user_id, NULL, f FROM {p}sales f)""",
        f"""{p}customer_days AS (
  SELECT d AS metric_date, count(visit) AS sessions_count, count(DISTINCT who) FILTER (WHERE visit IS NOT NULL) AS active_users_count,
         count(DISTINCT who) FILTER (WHERE visit.is_repeat_session) AS repeat_session_users_count,
         count(DISTINCT who) FILTER (WHERE NOT visit.is_repeat_session) AS new_session_users_count,
         count(*) FILTER (WHERE visit.is_bounced) AS bounced_sessions_count,
         {_n('sum(visit.product_pageviews_count)')} AS product_pageviews_count,
         count(DISTINCT visit.website_session_id) FILTER (WHERE visit.has_product_pageview) AS product_view_sessions_count,
         count(DISTINCT who) FILTER (WHERE visit.has_product_pageview) AS users_with_product_views_count,
         count(DISTINCT sale.order_id) AS orders_count, count(sale) AS order_items_sold_count,
         count(DISTINCT who) FILTER (WHERE sale IS NOT NULL) AS purchasing_users_count,
         count(DISTINCT who) FILTER (WHERE sale.has_returned) AS users_with_returns_count,
         sum(sale.gross_revenue_usd) AS gross_revenue_usd, sum(sale.refund_amount_usd) AS refund_amount_usd,
         sum(sale.net_revenue_usd) AS net_revenue_usd, sum(sale.net_profit_usd) AS net_profit_usd
  FROM {p}customer_events GROUP BY d)""",
    ]


def mart_customer_daily_value(p: str) -> Ctes:
    table = "mart_customer_daily_value"
    derived = {"orders_per_session": _per("orders_count", "sessions_count"),
               "product_view_user_penetration_rate": _per("users_with_product_views_count", "active_users_count"),
               "net_revenue_per_purchasing_user": _per("net_revenue_usd", "purchasing_users_count")}
    cols = [f"CASE WHEN metric_date IS NOT NULL THEN {derived[c]} END AS {c}" if c in derived else c if c == "metric_date"
            else f"CASE WHEN metric_date IS NULL THEN 0 ELSE coalesce(t.{c}, 0) END AS {c}" for c in CONTRACTS[table].fieldNames()]
    return [f"{p}{table} AS (SELECT {', '.join(cols)} FROM {p}customer_days t)"]


# ------------------------------------------------------------------ assembly
def silver(p: str) -> Ctes:
    return dim_products(p) + fct_sales(p) + fct_sessions(p)


def gold(p: str) -> Ctes:
    return (product_days(p) + mart_product_daily_sales(p) + mart_product_daily_returns(p) + mart_channel_daily_sessions(p)
            + customer_days(p) + mart_customer_daily_value(p))


TABLE = {"dim_products": "dim", "fct_sales": "sales", "fct_sessions": "sess"}


def name_of(table: str, p: str = "b_") -> str:
    return p + TABLE.get(table, table)


def snapped(columns: list[str]) -> list[str]:
    return [f"round({c} * 16384.0) / 16384.0 AS {c}" if c in SUMMED else c for c in columns]


def query(ctes: Ctes, body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def contract_query(ctes: Ctes, source: str, table: str) -> str:
    """A model's contract columns; sums are snapped in marts only (a fact's amounts are not sums over many rows)."""
    columns = CONTRACTS[table].fieldNames()
    return query(ctes, f"SELECT {', '.join(snapped(columns) if table.startswith('mart_') else columns)} FROM {source}")
