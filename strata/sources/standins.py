"""Bronze-shaped frames derived from the TPC-H-style parquet test tables.

The modelled pipeline ingests seven CSV exports (circuits, constructors,
drivers, races, results, driver standings, status). The test tables carry the
same star-schema roles, so each bronze table is a projection of them:

==================  =====================================================
bronze table        derived from
==================  =====================================================
circuits            nation (+ region as country)
constructors        supplier (+ nation as nationality)
drivers             customer (+ nation as nationality)
races               orders, season = calendar month, round = day of month,
                    circuit = the customer's nation. Pending orders
                    (``o_orderstatus = 'P'``) get a shifted key (-1 - key), so
                    their line items find no race and keep a null season.
results             lineitem + its order: driver = customer, constructor =
                    supplier, finishing position = line number, points =
                    quantity, status = order priority, position ``\\N`` for
                    returned lines (not classified)
status              distinct order priorities (id = leading digit)
driver_standings    orders summed per (customer, season, round), ranked
                    per (season, round) by points; race = latest order
==================  =====================================================

A season is a month index (``year * 12 + month - 1``), so consecutive months
are consecutive integers and streaks are meaningful over the 80 months of data.
The finished rule uses the status text ``5-LOW`` and the lapped pattern
``^\\d+-H`` (matches ``2-HIGH``) in place of the motor-racing texts.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.ranking import rank_values
from strata.session import store
from strata.sources.tables import read_parquet_table

# --- Fixed values: the stand-in's finished rule (text, pattern) ------------------
STANDIN_FINISHED_STATUS = "5-LOW"
STANDIN_LAPPED_PATTERN = r"^\d+-H"
PENDING_ORDER_STATUS = "P"
RETURNED_FLAG = "R"


def season_of(ts: str | Column) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return (F.year(ts) * 12 + F.month(ts) - 1).cast("int")


def round_of(ts: str | Column) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.dayofmonth(ts).cast("int")


def _null(typ: str) -> Column:
    return F.lit(None).cast(typ)


class StandInTables:
    """Lazy access to ``<root>/<name>.parquet`` plus the bronze stand-ins.

    DataFrames are immutable plans, so every frame built here is memoised:
    queries that share a table share its (already analysed) plan.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._tables: dict[str, DataFrame] = {}
        self._gold: dict[str, DataFrame] = {}
        self._stored: dict[str, DataFrame] = {}
        self._bronze: dict[str, DataFrame] = {}
        self._stored_gold: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, root: str) -> "StandInTables":
        key = (id(spark), root)
        cached = _INSTANCES.get(key)
        if cached is None or cached.spark is not spark:
            cached = _INSTANCES[key] = cls(spark, root)
        return cached

    def reset_plans(self) -> None:
        """Forget built silver / gold plans (table reads stay cached)."""
        self._gold.clear()
        self.__dict__.pop("silver", None)

    def bronze(self, name: str) -> DataFrame:
        """A bronze stand-in as the silver layer sees it: derived once from the
        test tables and written as Parquet below the shared checkpoint folder
        (the modelled silver loads read bronze tables, not the raw files)."""
        if name not in self._bronze:
            self._bronze[name] = store(getattr(self, name)(), f"bronze-{name}")
        return self._bronze[name]

    def stored(self, name: str) -> DataFrame:
        """A silver table as the gold layer sees it: written once as Parquet
        below the shared checkpoint folder, then read back (column pruning,
        pushed filters, and lineage cut at the layer boundary)."""
        if name not in self._stored:
            self._stored[name] = store(self.silver[name], f"silver-{name}")
        return self._stored[name]

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = read_parquet_table(self.spark, self.root, name)
        return self._tables[name]

    # -- bronze stand-ins -------------------------------------------------------
    def circuits(self) -> DataFrame:
        n, r = self.table("nation"), self.table("region")
        return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
                .select(F.col("n_nationkey").alias("circuit_id"),
                        F.lower("n_name").alias("circuit_ref"),
                        F.col("n_name").alias("name"), F.col("n_name").alias("location"),
                        F.col("r_name").alias("country"),
                        _null("double").alias("latitude"), _null("double").alias("longitude"),
                        _null("int").alias("altitude")))

    def constructors(self) -> DataFrame:
        s, n = self.table("supplier"), self.table("nation")
        return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
                .select(F.col("s_suppkey").alias("constructor_id"),
                        F.lower("s_name").alias("constructor_ref"),
                        F.col("s_name").alias("name"), F.col("n_name").alias("nationality")))

    def drivers(self) -> DataFrame:
        c, n = self.table("customer"), self.table("nation")
        return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
                .select(F.col("c_custkey").alias("driver_id"),
                        F.lower("c_name").alias("driverRef"),
                        _null("int").alias("number_driver"), _null("string").alias("code"),
                        F.col("c_mktsegment").alias("forename"),
                        F.col("c_name").alias("surname"), _null("date").alias("dob"),
                        F.col("n_name").alias("nationality")))

    def races(self) -> DataFrame:
        o = self.table("orders")
        pending = F.col("o_orderstatus") == PENDING_ORDER_STATUS
        c = self.table("customer").select("c_custkey", "c_nationkey")
        return (o.join(c, o.o_custkey == c.c_custkey, "left")
                .select(F.when(pending, -1 - F.col("o_orderkey")).otherwise(F.col("o_orderkey"))
                        .alias("race_id"),
                        season_of("o_orderdate").alias("race_year"),
                        round_of("o_orderdate").alias("round"),
                        F.col("c_nationkey").alias("circuit_id"),
                        F.concat(F.lit("order "), F.col("o_orderkey").cast("string"))
                        .alias("name"),
                        F.to_date("o_orderdate").alias("date_race")))

    def results(self, points: str = "l_quantity") -> DataFrame:
        li = self.table("lineitem")
        o = self.table("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        returned = F.col("l_returnflag") == RETURNED_FLAG
        position = F.col("l_linenumber").cast("string")
        return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
                .select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("result_id"),
                        F.col("l_orderkey").alias("race_id"),
                        F.col("o_custkey").alias("driver_id"),
                        F.col("l_suppkey").alias("constructor_id"),
                        _null("string").alias("number_results"), _null("int").alias("grid"),
                        F.when(returned, F.lit("\\N")).otherwise(position).alias("position"),
                        F.when(returned, F.lit(RETURNED_FLAG)).otherwise(position)
                        .alias("position_text"),
                        F.col("l_linenumber").alias("position_order"),
                        F.col(points).alias("points"), _null("int").alias("laps"),
                        _null("string").alias("time"),
                        F.when(returned, F.lit("\\N"))
                        .otherwise((F.col("l_quantity") * 60000).cast("bigint").cast("string"))
                        .alias("milliseconds"),
                        _null("string").alias("fastest_lap"), _null("string").alias("rank"),
                        _null("string").alias("fastest_lap_time"),
                        _null("string").alias("fastest_lap_speed"),
                        F.substring("o_orderpriority", 1, 1).cast("int").alias("status_id")))

    def status(self) -> DataFrame:
        return (self.table("orders")
                .select(F.substring("o_orderpriority", 1, 1).cast("int").alias("statusId"),
                        F.col("o_orderpriority").alias("status"))
                .distinct())

    def driver_standings(self) -> DataFrame:
        o = self.table("orders")
        per_round = (o.groupBy(F.col("o_custkey").alias("driverId"),
                               season_of("o_orderdate").alias("__season"),
                               round_of("o_orderdate").alias("__round"))
                     .agg(F.min("o_orderkey").alias("driverStandingsId"),
                          F.max("o_orderkey").alias("raceId"),
                          F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double")
                          .alias("points"),
                          F.count_if(F.col("o_orderstatus") == "F").cast("int").alias("wins")))
        ranked = rank_values(per_round, ["__season", "__round"], "points", "position", "rank")
        return ranked.select("driverStandingsId", "raceId", "driverId", "points", "position",
                             F.col("position").cast("string").alias("positionText"), "wins")

    # -- silver / gold built from the stand-ins (memoised, built on first use) ------
    @cached_property
    def silver(self) -> "_Lazy":
        from strata.plans import silver

        def build(name: str) -> DataFrame:
            s = self.silver
            if name == "fact_results":
                return silver.fact_results(
                    self.bronze("results"), s["dim_races"], s["dim_status"],
                    finished_value=STANDIN_FINISHED_STATUS,
                    lapped_pattern=STANDIN_LAPPED_PATTERN)
            if name == "fact_driver_standings":
                return silver.fact_driver_standings(self.bronze("driver_standings"),
                                                    s["dim_races"])
            source = {"dim_circuits": "circuits", "dim_drivers": "drivers",
                      "dim_constructors": "constructors", "dim_status": "status",
                      "dim_races": "races"}[name]
            return getattr(silver, name)(self.bronze(source))
        return _Lazy(build)

    def stored_gold(self, name: str) -> DataFrame:
        """A gold table that other gold loads read, written once (default form)."""
        if name not in self._stored_gold:
            self._stored_gold[name] = store(self.gold(name), f"gold-{name}")
        return self._stored_gold[name]

    def gold(self, name: str) -> DataFrame:
        if name not in self._gold:
            self._gold[name] = self._build_gold(name)
        return self._gold[name]

    def nation_standings(self) -> DataFrame:
        """Season standings of the constructors' nations (few, so that some lead for
        several months running)."""
        from strata.plans import gold
        s = self.table("supplier").select(F.col("s_suppkey").alias("constructor_id"), "s_nationkey")
        fact = (self.stored("fact_results").join(s, "constructor_id").drop("constructor_id")
                .withColumnRenamed("s_nationkey", "constructor_id"))
        nations = self.table("nation").select(F.col("n_nationkey").alias("constructor_id"),
                                              F.col("n_name").alias("constructor_name"))
        return gold.constructor_standings(fact, nations)

    def _build_gold(self, name: str) -> DataFrame:
        from strata.plans import gold
        s = _Lazy(self.stored)
        if name == "constructor_career":
            return gold.constructor_career(s["fact_results"], s["dim_constructors"])
        if name == "driver_career":
            return gold.driver_career(s["fact_results"], s["dim_drivers"])
        if name == "constructor_standings":
            return gold.constructor_standings(s["fact_results"], s["dim_constructors"])
        if name == "constructor_dominance":
            return gold.constructor_dominance(self.nation_standings())
        if name == "season_champions":
            return gold.season_champions(s["fact_driver_standings"], s["dim_drivers"])
        if name == "drivers_without_title":
            return gold.drivers_without_title(
                self.stored_gold("driver_career"), self.stored_gold("season_champions"))
        raise KeyError(name)


class _Lazy:
    """A read-only mapping whose values are built on first access."""

    def __init__(self, build):
        self._build = build
        self._values: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._values:
            self._values[name] = self._build(name)
        return self._values[name]


_INSTANCES: dict[tuple[int, str], StandInTables] = {}
