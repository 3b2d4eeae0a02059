"""Change propagation: after any change the warehouse equals a full build, and only what differs is written."""

from __future__ import annotations

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import ts
from shoplane.operators import gold, propagate
from shoplane.operators.versions import VersionedTable
from shoplane.parallel import run_all
from shoplane.plans import pipeline
from shoplane.plans.warehouse import LIST_PRICE, Warehouse
from shoplane.schemas import SOURCE_SCHEMAS
from shoplane.sources import fixtures

pytestmark = pytest.mark.usefixtures("few_partitions")
D = dt.date
SF = "/root/testdata/sf0.001"
TABLES = (*pipeline.SILVER_ORDER, *pipeline.GOLD_ORDER)


@pytest.fixture()
def warehouse(spark, tmp):
    w = Warehouse(spark, f"{tmp}/wh", prefix=f"p{uuid.uuid4().hex[:8]}_")
    yield w
    for layer in ("silver", "gold"):
        spark.sql(f"DROP DATABASE IF EXISTS {w.prefix}{layer} CASCADE")


def rows_of(df):
    def plain(x):
        return round(x, 6) + 0.0 if isinstance(x, float) else x
    return sorted((tuple(map(plain, r)) for r in df.collect()), key=str)


def full(src):
    silver_ = {t: df.cache() for t, df in pipeline.build_silver(src).items()}
    inputs = {**silver_, "website_pageviews": src["website_pageviews"]}
    built = {**silver_, **{m: gold.MART_BUILDERS[m](inputs) for m in pipeline.GOLD_ORDER}, LIST_PRICE: gold.product_list_price(silver_["fct_sales"])}
    out = run_all({t: (lambda df=df: rows_of(df)) for t, df in built.items()})
    for df in silver_.values():
        df.unpersist()
    return out


def same(warehouse, src):
    want = full(src)
    got = run_all({t: (lambda t=t: rows_of(warehouse.read(t))) for t in want})
    for t in (*TABLES, LIST_PRICE):
        assert got[t] == want[t], t


class Shop:
    """Source rows as lists, and the change between two states of them."""

    def __init__(self, spark):
        self.spark, self.rows = spark, {t: [] for t in SOURCE_SCHEMAS}

    def frames(self, rows=None):
        return {t: self.spark.createDataFrame([tuple(r.get(f.name) for f in s.fields) for r in (rows or self.rows)[t]], s)
                for t, s in SOURCE_SCHEMAS.items()}

    def state(self):
        return {t: [dict(r) for r in rows] for t, rows in self.rows.items()}

    def changes(self, before):
        """Rows that are not in both states, as they were and as they are; tables without any are left out."""
        out = {}
        for t in SOURCE_SCHEMAS:
            differ = [r for r in before[t] if r not in self.rows[t]] + [r for r in self.rows[t] if r not in before[t]]
            if differ and t != "products":
                out[t] = differ
        frames = self.frames({t: out.get(t, []) for t in SOURCE_SCHEMAS})
        return {t: frames[t] for t in out}

    def product(self, pid, name):
        self.rows["products"].append({"product_id": pid, "created_at": ts("2023-01-01 00:00:00"), "product_name": name})

    def session(self, sid, at, user, source="gsearch"):
        self.rows["website_sessions"].append({"website_session_id": sid, "created_at": ts(at), "user_id": user, "is_repeat_session": sid % 2,
                                              "utm_source": source, "device_type": "mobile"})

    def view(self, vid, sid, at, url):
        self.rows["website_pageviews"].append({"website_pageview_id": vid, "website_session_id": sid, "created_at": ts(at), "pageview_url": url})

    def order(self, oid, sid, at, user, items=1):
        self.rows["orders"].append({"order_id": oid, "created_at": ts(at), "website_session_id": sid, "user_id": user, "primary_product_id": 1,
                                    "items_purchased": items, "price_usd": 10.0, "cogs_usd": 4.0})

    def item(self, iid, oid, at, pid, price):
        self.rows["order_items"].append({"order_item_id": iid, "created_at": ts(at), "order_id": oid, "product_id": pid, "is_primary_item": 1,
                                         "price_usd": price, "cogs_usd": 1.0})

    def refund(self, rid, iid, oid, at, amount):
        self.rows["order_item_refunds"].append({"order_item_refund_id": rid, "created_at": ts(at), "order_item_id": iid, "order_id": oid,
                                                "refund_amount_usd": amount})


def small_shop(spark):
    s = Shop(spark)
    s.product(1, "Bear"), s.product(2, "Cat Toy")
    for m in (1, 2, 3):
        for d in (5, 20):
            k, at = m * 100 + d, f"2024-{m:02d}-{d:02d}"
            s.session(k, f"{at} 10:00:00", k % 4)
            s.view(k * 10, k, f"{at} 10:00:00", "/home"), s.view(k * 10 + 1, k, f"{at} 10:01:00", "/bear")
            s.order(k, k, f"{at} 10:02:00", k % 4)
            s.item(k, k, f"{at} 10:02:00", 1, 20.0 + m), s.item(k + 5000, k, f"{at} 10:02:00", 2, 30.0)
    return s


def step(warehouse, shop, change):
    before = shop.state()
    change(shop)
    facts = warehouse.apply(shop.frames(), shop.changes(before))
    same(warehouse, shop.frames())
    return facts


def test_late_refund_and_late_pageview(spark, warehouse):
    shop = small_shop(spark)
    assert warehouse.apply(shop.frames(), {})["mode"] == "full"
    sales = warehouse.tables["fct_sales"]
    files = sales.folders(sales.version())

    facts = step(warehouse, shop, lambda s: s.refund(1, 120, 120, "2024-02-19 00:00:00", 7.0))     # 30 days after the sale
    assert facts["months"]["fct_sales"] == [D(2024, 1, 1)] and facts["months"]["fct_sessions"] == []
    assert facts["marts"] == {m: [D(2024, 1, 20)] for m in ("mart_product_daily_sales", "mart_product_daily_returns", "mart_customer_daily_value")}
    now = sales.folders(sales.version())
    assert now[D(2024, 1, 1)] != files[D(2024, 1, 1)] and all(now[m] == files[m] for m in (D(2024, 2, 1), D(2024, 3, 1)))
    mart = warehouse.read("mart_product_daily_returns").filter("order_date = DATE'2024-01-20' AND product_id = 1").first()
    assert mart["refund_amount_usd"] == 7.0 and mart["returned_items_count"] == 1

    facts = step(warehouse, shop, lambda s: s.view(1, 205, "2024-02-05 09:59:00", "/cat-toy"))      # before all others
    assert facts["months"] == {"fct_sessions": [D(2024, 2, 1)]}
    assert facts["marts"]["mart_channel_daily_sessions"] == [D(2024, 2, 5)]
    assert warehouse.read("fct_sessions").filter("website_session_id = 205").first()["landing_page_url"] == "/cat-toy"


def test_what_is_delivered_again_changes_nothing(spark, warehouse):
    shop = small_shop(spark)
    warehouse.apply(shop.frames(), {})
    before = {t: x.version() for t, x in warehouse.tables.items()}
    facts = warehouse.apply(shop.frames(), {t: df for t, df in shop.frames().items() if t != "products"})
    assert facts["months"] == {"fct_sales": [], "fct_sessions": []}
    changed = {t for t, x in warehouse.tables.items() if x.version() != before[t]}
    assert changed <= {"mart_product_daily_sales"}          # days of re-delivered pageviews are built again
    same(warehouse, shop.frames())


def test_rows_that_go_move_or_change(spark, warehouse):
    shop = small_shop(spark)
    shop.refund(1, 105, 105, "2024-01-06 00:00:00", 3.0)
    shop.item(9000, 999, "2024-01-09 00:00:00", 1, 5.0)                  # its order is not there yet
    shop.view(9001, 777, "2024-03-05 11:00:00", "/bear")                 # nor is its session
    warehouse.apply(shop.frames(), {})

    def drop(table, **values):
        return lambda s: s.rows[table].__setitem__(slice(None), [r for r in s.rows[table] if any(r.get(k) != v for k, v in values.items())])

    def come(s):
        s.order(999, 105, "2024-02-14 08:00:00", 3)                      # a NULL day becomes dated
        s.session(777, "2024-03-05 10:59:00", 9)
        next(r for r in s.rows["website_sessions"] if r["website_session_id"] == 105).update(user_id=77)

    def go(s):
        drop("order_item_refunds", order_item_refund_id=1)(s)
        drop("order_items", order_item_id=320)(s)
        drop("website_sessions", website_session_id=305)(s)
        next(r for r in s.rows["orders"] if r["order_id"] == 220).update(website_session_id=105)
    step(warehouse, shop, come)
    step(warehouse, shop, go)


def test_products_that_come_or_are_renamed(spark, warehouse):
    shop = small_shop(spark)
    shop.view(1, 205, "2024-02-05 10:03:00", "/new-thing")
    warehouse.apply(shop.frames(), {})
    step(warehouse, shop, lambda s: s.product(3, "New Thing"))           # a page that was there becomes a product's
    facts = step(warehouse, shop, lambda s: s.rows["products"][0].update(product_name="Big Bear"))
    assert facts["marts"]["mart_product_daily_returns"] == [D(2024, m, d) for m in (1, 2, 3) for d in (5, 20)]


def test_a_new_highest_price_reaches_all_days_of_the_product(spark, warehouse):
    shop = small_shop(spark)
    warehouse.apply(shop.frames(), {})
    facts = step(warehouse, shop, lambda s: s.item(8000, 105, "2024-01-05 10:02:00", 2, 99.0))
    assert len(facts["marts"]["mart_product_daily_returns"]) == 6


@pytest.mark.parametrize("seed", range(6))
def test_list_prices_are_merged(spark, seed):
    """Old and new sales of few products and prices: what is merged equals the maxima of the new sales."""
    rng = random.Random(seed)

    def some():
        return [(rng.choice([1, 2, 3, 4, None]), rng.choice([1.0, 2.0, 3.0, None])) for _ in range(rng.randrange(8))]
    kept, gone, came = some(), some(), some()
    sales = lambda rows: spark.createDataFrame(rows, "product_id long, gross_revenue_usd double")
    change = propagate.delta(sales(kept + gone), sales(kept + came))
    now = gold.product_list_price(sales(kept + gone))
    changed = {r[0]: r for r in propagate.merged_list_prices(now, change, sales(kept + came)).collect()}
    want = dict(map(tuple, gold.product_list_price(sales(kept + came)).collect()))
    merged = {**dict(map(tuple, now.collect())), **{p: r[2] for p, r in changed.items()}}
    assert {p: x for p, x in merged.items() if p not in changed or not changed[p]["gone"]} == want


def test_history_is_read_only_for_lost_maxima(spark):
    now = spark.createDataFrame([(1, 5.0), (2, 9.0)], "product_id long, list_price_usd double")
    change = spark.createDataFrame([(1, 7.0, 1), (2, 3.0, -1)], f"product_id long, gross_revenue_usd double, {propagate.SIGN} int")
    unread = spark.range(1).select(F.raise_error(F.lit("history was read")).cast("long").alias("product_id"), F.lit(1.0).alias("gross_revenue_usd"))
    assert [tuple(r) for r in propagate.merged_list_prices(now, change, unread).collect()] == [(1, 5.0, 7.0, False)]


def test_incremental_returns_read_no_history(spark, warehouse):
    """With the kept list prices, a lookback build of the returns mart scans no month before its cutoff."""
    warehouse.apply(small_shop(spark).frames(), {})
    inputs = warehouse._inputs({"website_pageviews": None})
    df = gold.MART_BUILDERS["mart_product_daily_returns"](inputs, D(2024, 3, 10))
    files = [f for f in df.inputFiles() if "/fct_sales/" in f]
    assert files and all("order_date_month=2024-03-01" in f for f in files)


class Died(Exception):
    pass


@pytest.mark.parametrize("dies_at", [1, 4])
def test_death_between_any_two_commits(spark, warehouse, monkeypatch, dies_at):
    shop = small_shop(spark)
    warehouse.apply(shop.frames(), {})
    before = shop.state()
    shop.refund(1, 120, 120, "2024-02-19 00:00:00", 7.0)
    shop.item(8000, 205, "2024-02-05 10:02:00", 1, 500.0)
    shop.view(1, 205, "2024-02-05 09:59:00", "/cat-toy")
    shop.rows["products"][1]["product_name"] = "Dog Toy"
    real, count = VersionedTable._commit, []

    def dies(self, *a):
        count.append(self.name)
        if len(count) > dies_at:
            raise Died
        return real(self, *a)
    monkeypatch.setattr(VersionedTable, "_commit", dies)
    with pytest.raises(Died):
        warehouse.apply(shop.frames(), shop.changes(before))
    monkeypatch.undo()
    assert warehouse._notes()
    warehouse.apply(shop.frames(), shop.changes(before))
    same(warehouse, shop.frames())
    assert not warehouse._notes()


@pytest.mark.parametrize("seed", [1])
def test_random_changes(spark, warehouse, seed):
    rng = random.Random(seed)
    shop = small_shop(spark)
    shop.rows["website_pageviews"] += [{"website_pageview_id": 7, "website_session_id": None, "pageview_url": "/bear"}]
    warehouse.apply(shop.frames(), {})

    def when():
        return f"2024-{rng.randrange(1, 5):02d}-{rng.choice([5, 6, 20]):02d} {rng.randrange(24):02d}:00:00"

    def some(table, key):
        return rng.choice(shop.rows[table])[key] if shop.rows[table] else None
    for k in range(2):
        before = shop.state()
        for n in range(rng.randrange(1, 6)):
            i = 20_000 + 100 * k + n
            rng.choice([
                lambda: shop.refund(i, *(lambda r: (r["order_item_id"], r["order_id"]))(rng.choice(shop.rows["order_items"])), when(), rng.choice([0.0, 2.5])),
                lambda: shop.view(i, rng.choice([some("website_sessions", "website_session_id"), None, 4242]), when(), rng.choice(["/home", "/bear", "/cat-toy", "/x"])),
                lambda: shop.session(rng.choice([i, 4242]), when(), rng.randrange(5), rng.choice([None, "gsearch"])),
                lambda: shop.order(i, some("website_sessions", "website_session_id"), when(), rng.randrange(5)),
                lambda: shop.item(i, rng.choice([some("orders", "order_id"), 999_999]), when(), rng.randrange(1, 4), rng.choice([0.0, 5.0, 80.0])),
                lambda: shop.rows[t].remove(rng.choice(shop.rows[t])) if shop.rows[t := rng.choice(["orders", "order_items", "order_item_refunds",
                                                                                                     "website_pageviews"])] else None,
            ])()
        if rng.random() < 0.4:
            shop.rows["products"][0]["product_name"] = rng.choice(["Bear", "Bär", "X"])
        warehouse.apply(shop.frames(), shop.changes(before))
        same(warehouse, shop.frames())


def test_clickstream_with_late_rows(spark, warehouse):
    early, changes = fixtures.set_b_with_late_rows(spark, SF)
    src = fixtures.set_b(spark, SF)
    assert warehouse.apply(early, {})["mode"] == "full"
    assert warehouse.apply(src, changes)["mode"] == "changes"
    same(warehouse, src)


def test_lookback_build_equals_the_other_one(spark, warehouse, tmp):
    early, src = fixtures.set_b(spark, SF, before=fixtures.PREFIX_END), fixtures.set_b(spark, SF)
    for s in (early, src):
        pipeline.build(spark, s, f"{tmp}/other")
        facts = warehouse.build(s)
    assert all(f["mode"] == "incremental" for f in facts.values())
    for t in TABLES:
        assert rows_of(warehouse.read(t)) == rows_of(pipeline.read_table(spark, f"{tmp}/other", t)), t
    assert warehouse.validate().filter("failures > 0").count() == pipeline.validate(spark, f"{tmp}/other").filter("failures > 0").count()


def test_semi_join_is_null_safe(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    keys = spark.createDataFrame([(None,), (2,)], "k long")
    assert {r["v"] for r in propagate.among(df, keys).collect()} == {"b", "c"}
    assert {r["v"] for r in df.filter(propagate.in_values(F.col("v"), [])).collect()} == set()
