"""A warehouse of versioned tables in the catalog, refreshed by what changed.

``build`` is the contract of ``pipeline.build`` (silver rebuilt, marts merged over a seven-day lookback) on
versioned tables. ``apply`` is the other way to bring it up to date, from changed source rows:

1. the fact rows that the changes reach are built again, and their deltas found (``operators.propagate``);
2. from the deltas come the days on which each mart differs, however old; they are noted in the
   warehouse before any table is switched;
3. list prices, dimension and facts are switched, months without a change keep their files;
4. the marts are built for the noted days only and these days replaced; the notes are removed.

After ``apply`` every table equals a full build. A run that dies is repeated with the same changes: what is
switched already gives no delta then, and the notes still have the days.

Layout: ``<root>/<layer>/<table>/v.../`` and ``<root>/_days/`` for the notes; catalog names are
``<prefix><layer>.<table>``. One run at a time per warehouse.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import to_date
from ..operators import gold, propagate, quality, silver, versions
from ..operators.commit import is_committed
from ..operators.joins import broadcast_bounded
from ..operators.propagate import Changes
from ..operators.staging import stage
from ..operators.versions import VersionedTable
from ..parallel import DEFAULT_PARALLELISM, run_all
from ..schemas import CONTRACTS, GRAIN, PARTITION_DATE, TABLE_COMMENTS, TABLE_LAYER
from ..session import delete, hadoop_path, scratch_scope
from .pipeline import GOLD_ORDER, SILVER_DATE, SILVER_ORDER

LIST_PRICE = "product_list_price"
LIST_PRICE_SCHEMA = T.StructType([
    T.StructField("product_id", T.LongType(), True, {"comment": "product key"}),
    T.StructField("list_price_usd", T.DoubleType(), True, {"comment": "highest price the product was ever sold at"})])
KEY = {"fct_sales": "order_item_id", "fct_sessions": "website_session_id"}
_NOTE = "mart string, day date"


class Warehouse:
    """The tables below ``root``; ``marts`` may leave out some that are not wanted."""

    def __init__(self, spark: SparkSession, root: str, prefix: str = "", marts: tuple[str, ...] = GOLD_ORDER,
                 parallelism: int = DEFAULT_PARALLELISM):
        self.spark, self.root, self.prefix, self.marts, self.parallelism = spark, root.rstrip("/"), prefix, tuple(marts), parallelism
        self.tables: dict[str, VersionedTable] = {}
        for t in SILVER_ORDER + self.marts:
            schema, by = CONTRACTS[t], PARTITION_DATE.get(t)
            if t in SILVER_DATE:
                by = f"{SILVER_DATE[t]}_month"
                schema = T.StructType([*schema.fields, T.StructField(by, T.DateType(), True, {"comment": "first day of the month, for pruning"})])
            self.tables[t] = self._table(TABLE_LAYER[t], t, schema, by, TABLE_COMMENTS[t])
        self.tables[LIST_PRICE] = self._table("silver", LIST_PRICE, LIST_PRICE_SCHEMA, None, "Highest price per product, kept up to date by changes.")

    def _table(self, layer: str, name: str, schema: T.StructType, by: str | None, comment: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.prefix}{layer}.{name}", f"{self.root}/{layer}/{name}", schema, by, comment)

    def read(self, table: str) -> DataFrame:
        """A table in the order of its contract."""
        t = self.tables[table].read()
        return t.select(*CONTRACTS[table].names) if table in CONTRACTS else t

    def is_built(self) -> bool:
        return all(t.version() is not None for t in self.tables.values())

    def validate(self) -> DataFrame:
        return quality.validate({t: self.read(t) for t in SILVER_ORDER + self.marts})

    def violations(self) -> DataFrame:
        """What the last writes of the silver tables observed: business rules and NULLs, without a scan."""
        return quality.observed(self.spark, {t: self.tables[t].observed for t in SILVER_ORDER})

    def relationships(self, src) -> DataFrame:
        """Orphans between the built facts, the dimension and the sources."""
        sources = {t: src[t] for t in ("orders", "order_item_refunds", "website_pageviews")}
        return quality.check_relationships({**sources, **{t: self.read(t) for t in SILVER_ORDER}})

    def _inputs(self, src) -> dict[str, DataFrame]:
        """What marts are built from; facts with their month column."""
        return {**{t: self.tables[t].read() for t in (*SILVER_ORDER, LIST_PRICE)}, "website_pageviews": src["website_pageviews"]}

    # ------------------------------------------------------------------ by lookback
    def build(self, src, full_refresh: bool = False) -> dict[str, dict]:
        """Silver in full, then every mart in full or from its cutoff on; facts of each mart's run."""
        with scratch_scope(self.spark, "build"):
            t = self.tables
            t["dim_products"].replace(silver.dim_products(src), quality.rule_counts("dim_products"))
            dim = self.read("dim_products")

            def fact(name: str, df: DataFrame) -> None:
                t[name].replace(df.withColumn(t[name].partition, F.trunc(SILVER_DATE[name], "month")), quality.rule_counts(name))
            run_all({"fct_sales": lambda: fact("fct_sales", silver.fct_sales(src)),
                     "fct_sessions": lambda: fact("fct_sessions", silver.fct_sessions(src, dim))}, self.parallelism)
            t[LIST_PRICE].replace(gold.product_list_price(t["fct_sales"].read()))
            inputs = self._inputs(src)
            facts = run_all({m: (lambda m=m: versions.refresh(t[m], lambda c: gold.MART_BUILDERS[m](inputs, c), GRAIN[m], full_refresh))
                             for m in self.marts}, self.parallelism)
            if all(f["mode"] == "full" for f in facts.values()):
                for folder in self._notes():
                    delete(self.spark, folder)
            return facts

    # ------------------------------------------------------------------ by change
    def apply(self, src, changes: Changes) -> dict:
        """Bring all tables up to date; ``src`` has all source rows as they are now. Returns what was written."""
        if not self.is_built():
            return {"mode": "full", "marts": self.build(src, full_refresh=True)}
        with scratch_scope(self.spark, "apply"):
            return self._apply(src, changes)

    def _apply(self, src, changes: Changes) -> dict:
        t = self.tables
        new_dim = stage(silver.dim_products(src), "dim")
        dim_delta = stage(propagate.delta(self.read("dim_products"), new_dim), "dim-delta")
        renamed = pages = None
        if not dim_delta.isEmpty():
            renamed = stage(dim_delta.select(F.col("product_id").cast("long")).distinct(), "renamed")
            pages = stage(propagate.changed_pages(dim_delta), "changed-pages")

        # the facts: rows again, deltas
        new, delta = {}, {}
        items = propagate.touched_items(src, changes)
        if items is not None:
            new["fct_sales"] = stage(propagate.sales_of(src, items), "sales-again")
            old = propagate.among(self.read("fct_sales"), items)
            delta["fct_sales"] = stage(propagate.delta(old, new["fct_sales"]), "sales-delta")
        sessions = propagate.touched_sessions(src, changes, pages, delta.get("fct_sales"))
        if sessions is not None:
            new["fct_sessions"] = stage(propagate.sessions_of(src, new_dim, sessions), "sessions-again")
            old = propagate.among(self.read("fct_sessions"), sessions)
            delta["fct_sessions"] = stage(propagate.delta(old, new["fct_sessions"]), "sessions-delta")

        # list prices that change
        prices = None
        if "fct_sales" in delta:
            after = self._sales_after(delta["fct_sales"], new["fct_sales"])
            prices = stage(propagate.merged_list_prices(t[LIST_PRICE].read(), delta["fct_sales"], after), "price-changes")
            if prices.isEmpty():
                prices = None

        # the days, noted before anything is switched
        days = propagate.dirty_days(src, changes, delta.get("fct_sales"), delta.get("fct_sessions"), renamed, pages,
                                    None if prices is None else prices.select("product_id"), {m: self.read(m) for m in self.marts})
        if days is not None:
            days.coalesce(1).write.parquet(f"{self.root}/_days/{uuid.uuid4().hex}")

        if prices is not None:
            p = broadcast_bounded(prices.select(F.col("product_id").alias("_p")))
            kept = t[LIST_PRICE].read().join(p, F.col("product_id").eqNullSafe(F.col("_p")), "left_anti")
            t[LIST_PRICE].replace(kept.unionByName(prices.filter("NOT gone").select("product_id", "list_price_usd")))
        if renamed is not None:
            t["dim_products"].replace(new_dim)
        months = {f: propagate.rewrite_months(t[f], KEY[f], SILVER_DATE[f], new[f], delta[f]) for f in delta}
        return {"mode": "changes", "months": months, "marts": self._refresh_noted(src)}

    def _sales_after(self, change: DataFrame, new: DataFrame) -> DataFrame:
        """The sales fact after a change that isn't written yet: keys of the change have their new rows."""
        keys = change.select(F.col("order_item_id").alias("_key")).distinct()
        left = self.read("fct_sales").join(keys, F.col("order_item_id").eqNullSafe(F.col("_key")), "left_anti")
        return left.unionByName(new.join(keys, F.col("order_item_id").eqNullSafe(F.col("_key")), "left_semi"))

    def _notes(self) -> list[str]:
        fs, p = hadoop_path(self.spark, f"{self.root}/_days")
        folders = [str(s.getPath()) for s in fs.listStatus(p)] if fs.exists(p) else []
        return [f for f in folders if is_committed(self.spark, f)]

    def _refresh_noted(self, src) -> dict[str, list[dt.date | None]]:
        """Build the marts for the noted days, of this run and of runs that died; returns the days of each."""
        notes = self._notes()
        if not notes:
            return {}
        rows = self.spark.read.schema(_NOTE).parquet(*notes).distinct().collect()      # a row per mart and day
        days: dict[str, list] = {}
        for r in rows:
            days.setdefault(r["mart"], []).append(r["day"])
        run_all({m: (lambda m=m: self.tables[m].rewrite(self.mart_days(src, m, days[m]), days[m])) for m in days}, self.parallelism)
        for folder in notes:
            delete(self.spark, folder)
        return {m: sorted(d, key=str) for m, d in days.items()}

    def mart_days(self, src, mart: str, days: list[dt.date | None]) -> DataFrame:
        """A mart on some days only: dated inputs are cut to them, lookups are not."""
        inputs = self._inputs(src)
        sales, sessions = inputs["fct_sales"], inputs["fct_sessions"]
        sales_days, session_days = on_days(sales, "order_date", days), on_days(sessions, "session_date", days)
        if mart == "mart_product_daily_sales":
            return gold.mart_product_daily_sales(views_on_days(inputs["website_pageviews"], days), inputs["dim_products"], sessions, sales_days)
        if mart == "mart_product_daily_returns":
            return gold.mart_product_daily_returns(sales_days, inputs["dim_products"], list_price=inputs[LIST_PRICE])
        if mart == "mart_channel_daily_sessions":
            return gold.mart_channel_daily_sessions(session_days)
        return gold.mart_customer_daily_value(session_days, sales_days)


def on_days(fact: DataFrame, date: str, days: list[dt.date | None]) -> DataFrame:
    """Rows of the given days; only the folders of their months are read."""
    months = {d and d.replace(day=1) for d in days}
    return fact.filter(propagate.in_values(F.col(f"{date}_month"), months)).filter(propagate.in_values(F.col(date), days))


def views_on_days(views: DataFrame, days: list[dt.date | None]) -> DataFrame:
    """Pageviews of the given days; with year and month folders, only those of their months are read."""
    if {"year", "month"} <= set(views.columns):
        months = {d and (d.year, d.month) for d in days}
        key = F.col("year") * 100 + F.col("month")
        cond = key.isin(*[y * 100 + m for y, m in (x for x in months if x)])
        views = views.filter(cond | F.col("year").isNull() if None in months else cond)
    return views.filter(propagate.in_values(to_date("created_at"), days))
