"""Hand-built edge fixtures for the gold marts (FIXTURES.md E17-E27)."""

from __future__ import annotations

import datetime as dt

from conftest import ts
from shoplane.operators import gold
from shoplane.plans import pipeline

D = dt.date


def _tables(src):
    t = pipeline.build_silver(src)
    return {**t, "website_pageviews": src["website_pageviews"]}


def _item(iid, oid, pid, price, at):
    return {"order_item_id": iid, "order_id": oid, "product_id": pid, "price_usd": price,
            "cogs_usd": price / 2, "is_primary_item": 1, "created_at": ts(at)}


def _order(oid, sid, uid, at):
    return {"order_id": oid, "website_session_id": sid, "user_id": uid, "created_at": ts(at),
            "primary_product_id": 1, "items_purchased": 1, "price_usd": 1.0, "cogs_usd": 0.5}


def _pv(pid, sid, at, url):
    return {"website_pageview_id": pid, "website_session_id": sid, "created_at": ts(at),
            "pageview_url": url}


def _session(sid, uid, at, repeat=0, src=None, dev="mobile"):
    return {"website_session_id": sid, "user_id": uid, "created_at": ts(at),
            "is_repeat_session": repeat, "utm_source": src, "device_type": dev}


PRODUCTS = [{"product_id": 1, "created_at": ts("2024-01-01 00:00:00"), "product_name": "Bear"},
            {"product_id": 2, "created_at": ts("2024-01-01 00:00:00"), "product_name": "Cat"}]


def test_product_daily_sales_edges(make_sources):
    src = make_sources(
        products=PRODUCTS,
        website_sessions=[_session(1, 10, "2024-01-05 23:50:00"), _session(2, 11, "2024-01-06 08:00:00"),
                          _session(3, 12, "2024-01-07 08:00:00")],
        website_pageviews=[
            _pv(1, 1, "2024-01-05 23:59:00", "/bear"),            # E17: viewed 23:59 ...
            _pv(2, 2, "2024-01-06 08:00:00", "/bear"),            # E18: viewed twice, bought twice
            _pv(3, 2, "2024-01-06 08:05:00", "/bear"),
            _pv(4, 3, "2024-01-07 08:00:00", "/cat")],            # E20: traffic, no sales
        orders=[_order(100, 1, 10, "2024-01-06 00:01:00"),        # ... ordered 00:01 next day
                _order(200, 2, 11, "2024-01-06 08:10:00"),
                _order(201, 2, 11, "2024-01-06 08:20:00"),        # E19: two orders same day
                _order(300, None, 13, "2024-01-08 10:00:00"),     # E20: sales, no traffic
                _order(400, None, 13, "2024-01-09 10:00:00")],    # E19: other day, not repeat
        order_items=[_item(1000, 100, 1, 5.0, "2024-01-06 00:01:00"),
                     _item(2000, 200, 1, 5.0, "2024-01-06 08:10:00"),
                     _item(2010, 201, 1, 5.0, "2024-01-06 08:20:00"),
                     _item(3000, 300, 2, 8.0, "2024-01-08 10:00:00"),
                     _item(4000, 400, 2, 8.0, "2024-01-09 10:00:00"),
                     _item(9000, 999, 2, 1.0, "2024-01-09 10:00:00")])   # E21: orphan item
    m = gold.MART_BUILDERS["mart_product_daily_sales"](_tables(src))
    rows = {(r.metric_date, r.product_id): r.asDict() for r in m.collect()}
    day5 = rows[(D(2024, 1, 5), 1)]
    assert day5["converted_sessions_count"] == 0 and day5["product_pageviews_count"] == 1   # E17
    day6 = rows[(D(2024, 1, 6), 1)]
    assert day6["converted_sessions_count"] == 1 and day6["converted_items_count"] == 2     # E18
    assert day6["converted_orders_count"] == 2 and day6["repeat_buyers_count"] == 1          # E19
    assert day6["product_session_conversion_rate"] == 1.0
    assert rows[(D(2024, 1, 9), 2)]["repeat_buyers_count"] == 0
    cat7 = rows[(D(2024, 1, 7), 2)]                                                         # E20
    assert cat7["order_items_sold_count"] == 0 and cat7["item_return_rate"] is None
    cat8 = rows[(D(2024, 1, 8), 2)]
    assert cat8["product_pageviews_count"] == 0 and cat8["product_session_conversion_rate"] is None
    assert cat8["gross_revenue_usd"] == 8.0 and cat8["product_name"] == "Cat"
    null_row = rows[(None, 2)]                                                               # E21
    assert null_row["order_items_sold_count"] == 0 and null_row["gross_revenue_usd"] == 0.0
    assert null_row["unique_purchasers_count"] == null_row["purchasing_users_count"] == 0


def test_product_daily_returns_edges(make_sources):
    src = make_sources(
        products=PRODUCTS,
        orders=[_order(1, 1, 1, "2024-01-05 10:00:00")],
        order_items=[_item(10, 1, 1, 0.0, "2024-01-05 10:00:00"),   # E23: all prices 0
                     _item(11, 99, 2, 4.0, "2024-01-05 10:00:00")],  # E22: orphan keeps values
        order_item_refunds=[{"order_item_id": 11, "order_id": 99, "refund_amount_usd": 1.0,
                             "created_at": ts("2024-01-06 00:00:00")}])
    t = _tables(src)
    m = gold.mart_product_daily_returns(t["fct_sales"], t["dim_products"])
    rows = {(r.order_date, r.product_id): r.asDict() for r in m.collect()}
    zero = rows[(D(2024, 1, 5), 1)]
    assert zero["list_price_usd"] == 0.0 and zero["inferred_discount_usd"] == 0.0
    assert zero["inferred_discount_pct"] is None and zero["refund_capture_rate"] is None
    orphan = rows[(None, 2)]
    assert orphan["order_items_sold_count"] == 1 and orphan["refund_amount_usd"] == 1.0
    assert orphan["refund_capture_rate"] == 0.25


def test_channel_and_customer_edges(make_sources):
    src = make_sources(
        website_sessions=[_session(1, 10, "2024-01-05 10:00:00", src=None),
                          _session(2, 10, "2024-01-05 11:00:00", src="(none)", repeat=1),
                          _session(3, 11, "2024-01-05 12:00:00", src="gsearch")],
        orders=[_order(5, None, 12, "2024-01-06 10:00:00")],
        order_items=[_item(50, 5, 1, 3.0, "2024-01-06 10:00:00")])
    t = _tables(src)
    ch = gold.mart_channel_daily_sessions(t["fct_sessions"]).collect()
    by_src = {r.utm_source: r for r in ch}
    assert set(by_src) == {"(none)", "gsearch"} and by_src["(none)"].sessions_count == 2   # E24
    assert by_src["(none)"].orders_per_product_view_session is None                        # E25
    cv = {r.metric_date: r for r in gold.mart_customer_daily_value(t["fct_sessions"],
                                                                  t["fct_sales"]).collect()}
    d5 = cv[D(2024, 1, 5)]
    assert d5.new_session_users_count == 2 and d5.repeat_session_users_count == 1          # E26
    assert d5.active_users_count == 2
    d6 = cv[D(2024, 1, 6)]
    assert d6.sessions_count == 0 and d6.orders_per_session is None                        # E27
    assert d6.net_revenue_per_purchasing_user == 3.0


def test_mart_totals_equal_fact_totals(spark):
    """Property: on non-null keys the marts sum to the fact totals (Set B, sf0.001)."""
    from pyspark.sql import functions as F

    from shoplane.sources import fixtures
    src = fixtures.set_b(spark, "/root/testdata/sf0.001")
    t = _tables(src)
    fs = t["fct_sales"].filter("order_date IS NOT NULL")
    want = fs.agg(F.count(F.lit(1)), F.round(F.sum("net_revenue_usd"), 6)).first()
    m4 = gold.MART_BUILDERS["mart_product_daily_sales"](t).filter("metric_date IS NOT NULL")
    got4 = m4.agg(F.sum("order_items_sold_count"), F.round(F.sum("net_revenue_usd"), 6)).first()
    m5 = gold.mart_product_daily_returns(t["fct_sales"], t["dim_products"]).filter(
        "order_date IS NOT NULL")
    got5 = m5.agg(F.sum("order_items_sold_count"), F.round(F.sum("net_revenue_usd"), 6)).first()
    assert tuple(want) == tuple(got4) == tuple(got5)


def test_traffic_with_duplicated_session_rows(make_sources):
    """A session id present twice in the sessions source: pageviews fan out through
    the left join (as in the source model), distinct sessions do not."""
    src = make_sources(
        products=PRODUCTS,
        website_sessions=[_session(1, 10, "2024-01-05 10:00:00"), _session(1, 11, "2024-01-05 10:00:00")],
        website_pageviews=[_pv(1, 1, "2024-01-05 10:00:00", "/bear"),
                           _pv(2, 1, "2024-01-05 10:01:00", "/bear")])
    t = _tables(src)
    ppv = gold.product_pageviews_dated(t["website_pageviews"], t["dim_products"])
    r = gold.daily_product_traffic(gold.product_touch_counts(ppv), t["fct_sessions"]).first()
    assert (r.product_pageviews_count, r.product_sessions_count, r.product_viewers_count) == (4, 1, 2)


def _shared_pages():
    """Four products on one page (one of them twice, one on another page too), one without id, one alone."""
    at = ts("2024-01-01 00:00:00")
    named = [(1, "Bear"), (2, "bear!"), (2, "Bear"), (3, "Bear"), (3, "Cat"), (None, "Bear"), (4, "Dog"), (5, "BEAR"), (5, None)]
    return [{"product_id": p, "created_at": at, "product_name": n} for p, n in named]


def test_products_of_a_shared_page(make_sources):
    src = make_sources(
        products=_shared_pages(),
        website_sessions=[_session(1, 10, "2024-01-05 08:00:00"), _session(2, 11, "2024-01-05 09:00:00")],
        website_pageviews=[_pv(1, 1, "2024-01-05 08:00:00", "/bear"), _pv(2, 1, "2024-01-05 08:01:00", "/bear"),
                           _pv(3, 1, "2024-01-05 08:02:00", "/cat"), _pv(4, 2, "2024-01-05 09:00:00", "/dog"),
                           _pv(5, 2, "2024-01-05 09:01:00", "/cat")],
        orders=[_order(100, 1, 10, "2024-01-05 08:10:00"), _order(200, 2, 11, "2024-01-05 09:10:00")],
        order_items=[_item(1000, 100, 2, 5.0, "2024-01-05 08:10:00"), _item(1001, 100, 5, 5.0, "2024-01-05 08:10:00"),
                     _item(2000, 200, 3, 5.0, "2024-01-05 09:10:00"), _item(2001, 200, 1, 5.0, "2024-01-05 09:10:00")])
    rows = [r for r in gold.MART_BUILDERS["mart_product_daily_sales"](_tables(src)).collect() if r.product_id is not None]
    names = ("product_pageviews_count", "product_sessions_count", "product_viewers_count", "converted_sessions_count", "converted_items_count")
    got = {r.product_id: tuple(r[n] for n in names) for r in rows}
    # product 3 has two pages: its sessions are not the sum of theirs
    assert got == {1: (2, 1, 1, 0, 0), 2: (4, 1, 1, 1, 1), 3: (4, 2, 2, 1, 1), 4: (1, 1, 1, 0, 0), 5: (2, 1, 1, 1, 1)}


def test_touches_do_not_grow_with_products_of_a_page(spark, make_sources, monkeypatch):
    src = make_sources(
        products=[{"product_id": p, "created_at": ts("2024-01-01 00:00:00"), "product_name": "Bear"} for p in range(200)],
        website_sessions=[_session(s, s, "2024-01-05 08:00:00") for s in range(50)],
        website_pageviews=[_pv(s, s, "2024-01-05 08:00:00", "/bear") for s in range(50)])
    staged = {}
    stage = gold.stage
    monkeypatch.setattr(gold, "stage", lambda df, name: staged.setdefault(name, stage(df, name)))
    mart = gold.MART_BUILDERS["mart_product_daily_sales"](_tables(src))
    assert staged["product-touch"].count() == 50                # were 50 * 200
    assert mart.filter("product_sessions_count = 50 AND product_viewers_count = 50").count() == 200
