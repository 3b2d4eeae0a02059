"""Hand-built edge fixtures for the silver models (FIXTURES.md E1-E16)."""

from __future__ import annotations

from conftest import ts
from shoplane.operators import silver
from shoplane.schemas import CONTRACTS

T0 = ts("2024-01-05 10:00:00")


def _item(iid, oid, pid=1, price=10.0, cogs=4.0, primary=1, at=T0):
    return {"order_item_id": iid, "order_id": oid, "product_id": pid, "price_usd": price,
            "cogs_usd": cogs, "is_primary_item": primary, "created_at": at}


def _order(oid, sid=100, uid=7, at=T0):
    return {"order_id": oid, "website_session_id": sid, "user_id": uid, "created_at": at,
            "primary_product_id": 1, "items_purchased": 1, "price_usd": 10.0, "cogs_usd": 4.0}


def _refund(iid, oid, amt, at):
    return {"order_item_id": iid, "order_id": oid, "refund_amount_usd": amt, "created_at": ts(at)}


def _by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_fct_sales_refund_semantics(make_sources):
    src = make_sources(
        orders=[_order(1), _order(2), _order(3)],
        order_items=[_item(11, 1), _item(12, 2), _item(13, 3), _item(14, 99),      # 14: orphan
                     _item(15, 1, price=0.0), _item(16, 1, price=None), _item(17, 1, primary=None)],
        order_item_refunds=[_refund(11, 1, 0.0, "2024-01-06 00:00:00"),              # E1
                            _refund(12, 2, 3.0, "2024-01-07 00:00:00"),              # E2
                            _refund(12, 2, 2.0, "2024-01-09 00:00:00"),
                            _refund(13, 2, 5.0, "2024-01-07 00:00:00")])             # E3: wrong order
    df = silver.fct_sales(src)
    assert df.schema.names == CONTRACTS["fct_sales"].names
    r = _by(df, "order_item_id")
    assert (r[11]["has_returned"], r[11]["has_refund"], r[11]["refund_event_count"]) == (True, False, 1)
    assert r[12]["refund_event_count"] == 2 and r[12]["refund_amount_usd"] == 5.0
    assert r[12]["first_refund_created_at_utc"] == ts("2024-01-07 00:00:00")
    assert r[12]["last_refund_created_at_utc"] == ts("2024-01-09 00:00:00")
    assert r[12]["net_revenue_usd"] == 5.0 and r[12]["net_profit_usd"] == 1.0
    assert r[13]["refund_event_count"] == 0 and r[13]["has_returned"] is False      # E3
    assert r[14]["order_date"] is None and r[14]["user_id"] is None                 # E4
    assert r[14]["order_item_created_date"] is not None
    assert r[15]["net_margin_pct"] is None and r[16]["net_margin_pct"] is None      # E5
    assert r[17]["is_primary_item"] is False                                        # E6
    assert r[11]["net_margin_pct"] == (10.0 - 0.0 - 4.0) / 10.0


def _pv(pid, sid, at, url):
    return {"website_pageview_id": pid, "website_session_id": sid,
            "created_at": ts(at) if at else None, "pageview_url": url}


def _session(sid, uid=7, at="2024-01-05 09:00:00", repeat=0, src=None):
    return {"website_session_id": sid, "user_id": uid, "created_at": ts(at),
            "is_repeat_session": repeat, "utm_source": src, "device_type": "mobile"}


def test_fct_sessions_edges(make_sources):
    src = make_sources(
        products=[{"product_id": 1, "created_at": T0, "product_name": " The Brown Bear! "},
                  {"product_id": 2, "created_at": T0, "product_name": "the brown bear"}],   # E15
        website_sessions=[_session(1), _session(2), _session(3), _session(4), _session(5)],
        website_pageviews=[
            # session 2: single pageview -> bounced (E8)
            _pv(20, 2, "2024-01-05 09:00:00", "/home"),
            # session 3: tie on time -> lower id lands, higher id exits (E9)
            _pv(31, 3, "2024-01-05 09:00:00", "/a"), _pv(30, 3, "2024-01-05 09:00:00", "/b"),
            # session 4: NULL time never lands or exits (E10); boundary seconds (E11)
            _pv(40, 4, "2024-01-05 09:00:00.900", "/first"), _pv(41, 4, None, "/null"),
            _pv(42, 4, "2024-01-05 09:00:01.100", "/last"),
            # session 5: product page shared by two products (E15), other case (E16)
            _pv(50, 5, "2024-01-05 09:00:00", "/the-brown-bear"),
            _pv(51, 5, "2024-01-05 09:01:00", "/The-Brown-Bear"),
            # NULL session id (E12)
            _pv(60, None, "2024-01-05 09:00:00", "/the-brown-bear")],
        orders=[_order(1, sid=5), _order(2, sid=None)])
    r = _by(silver.fct_sessions(src), "website_session_id")
    assert set(r) == {1, 2, 3, 4, 5}
    s1 = r[1]                                                                          # E7
    assert s1["pageviews_count"] is None and s1["is_bounced"] is False
    assert s1["session_duration_seconds"] is None and s1["product_pageviews_count"] == 0
    assert r[2]["is_bounced"] and r[2]["landing_page_url"] == r[2]["exit_page_url"] == "/home"
    assert r[2]["session_duration_seconds"] == 0
    assert (r[3]["landing_page_url"], r[3]["exit_page_url"]) == ("/b", "/a")
    assert (r[4]["landing_page_url"], r[4]["exit_page_url"]) == ("/first", "/last")
    assert r[4]["session_duration_seconds"] == 1 and r[4]["pageviews_count"] == 3
    assert r[5]["product_pageviews_count"] == 2 and r[5]["viewed_products_count"] == 2
    assert r[5]["orders_count"] == 1 and r[5]["has_order"] is True


def test_pageviews_ranked_matches_aggregate_form(make_sources):
    rows = [_pv(i, 1 + i % 3, f"2024-01-05 09:{i % 7:02d}:00", f"/p{i}") for i in range(40)]
    rows.append(_pv(100, 1, None, "/nulltime"))
    src = make_sources(website_pageviews=rows)
    ranked = silver.pageviews_ranked(src)
    land = {r["website_session_id"]: r["pageview_url"]
            for r in ranked.filter("pageview_number_asc = 1").collect()}
    exit_ = {r["website_session_id"]: r["pageview_url"]
             for r in ranked.filter("pageview_number_desc = 1").collect()}
    agg = _by(silver.pageviews_agg(src), "website_session_id")
    assert land == {k: v["landing_page_url"] for k, v in agg.items()}
    assert exit_ == {k: v["exit_page_url"] for k, v in agg.items()}


def test_dim_products_trims(make_sources):
    src = make_sources(products=[{"product_id": 3, "created_at": T0, "product_name": "  x y  "}])
    r = silver.dim_products(src).collect()[0]
    assert (r.product_id, r.product_name, str(r.created_date)) == (3, "x y", "2024-01-05")


def _shared_page(make_sources):
    # a page of three products (one row twice), of which one has another page too, and of one without id
    named = [(1, "Bear"), (2, "bear!"), (2, "Bear"), (3, "Bear"), (3, "Cat"), (None, "Bear"), (None, "Dog"), (4, "Elk")]
    return make_sources(
        products=[{"product_id": p, "created_at": T0, "product_name": n} for p, n in named],
        website_pageviews=[_pv(1, 1, "2024-01-05 09:00:00", "/bear"), _pv(2, 1, "2024-01-05 09:01:00", "/bear"),
                           _pv(3, 1, "2024-01-05 09:02:00", "/cat"), _pv(4, 2, "2024-01-05 09:00:00", "/dog"),
                           _pv(5, 3, "2024-01-05 09:00:00", "/home"), _pv(6, None, "2024-01-05 09:00:00", "/elk")])


def test_products_of_a_shared_page_are_counted_apart(make_sources):
    src = _shared_page(make_sources)
    want = {1: (11, 3), 2: (1, 0), None: (1, 1)}        # 2 views of 5 rows, 1 of 1
    got = {r[0]: (r[1], r[2]) for r in silver.product_pageviews_agg(src).collect()}
    assert got == want
    rollup = {r.website_session_id: r for r in silver.session_pageview_rollup(src).collect()}
    assert {k: (r.product_pageviews_count, r.viewed_products_count) for k, r in rollup.items()} == {**want, 3: (0, 0)}
    assert {k: r.pageviews_count for k, r in rollup.items()} == {1: 3, 2: 1, 3: 1, None: 1}


def test_page_of_many_products_is_one_row(make_sources):
    named = [(p, "Bear") for p in range(500)] + [(7, "Cat"), (None, "Bear")]
    src = make_sources(products=[{"product_id": p, "created_at": T0, "product_name": n} for p, n in named])
    rows = {(r.product_page_url, r.product_id): (r.times, r.products) for r in silver.page_counts(silver.dim_products(src)).collect()}
    assert rows == {("/bear", None): (501, 499), ("/bear", 7): (None, None), ("/cat", None): (1, 0), ("/cat", 7): (None, None)}
