"""The source tables the operators run on, derived from the driver's tables.

Each property is one source of the warehouse. Staging and fact tables are
written to the shared folder the first time they are asked for, as a load would,
so that every later query starts from pruned, sorted Parquet.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskmart.contracts import MARKET_COLUMNS
from riskmart.functions.hashing import text_record_hash
from riskmart.operators import marts as M
from riskmart.operators import warehouse as W
from riskmart.operators.row_contracts import apply_market_contract, apply_risk_contract, split_rows
from riskmart.session import tune
from riskmart.sources.tables import hash_side, new_folder, scan_with_ordinals, spread, write_table

RISK_ATTRIBUTES = ("gender", "driv_age", "veh_year", "veh_model", "veh_group", "area", "state", "state_ab")
RECORD_HASH_COLUMNS = (*RISK_ATTRIBUTES, "expos_total", "claim_nb_rob", "claim_nb_other")
SCORE_POPULATION = "bounded_held_out_test"
MODEL_VERSION = "claim_risk_model_v001"


def _money(column: str, kind: str = "decimal(18,2)") -> Column:
    return F.col(column).cast(kind)


class Sources:
    """Lazily derived source tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def table(self, name: str, build: Callable[[], DataFrame], **layout) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = write_table(build(), new_folder(self.spark, name), **layout)
        return self._tables[name]

    @cached_property
    def lineitem(self) -> DataFrame:
        return spread(scan_with_ordinals(self.spark, f"{self.folder}/lineitem.parquet"))

    # -- market track -------------------------------------------------------

    def _market(self) -> DataFrame:
        refund = (F.col("l_linestatus") == "F") & (F.col("l_linenumber") == 7) & (F.col("l_quantity") < 5)
        returned = F.col("l_returnflag") == "R"
        price = _money("l_extendedprice")
        # Orders meet customers first, so that the lines are shuffled once for both, and only with what is summed.
        orders = (
            self.read("orders").select("o_orderkey", "o_custkey")
            .join(self.read("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "c_nationkey")
        )
        lines = self.lineitem.select(
            "l_orderkey", "l_partkey", "l_suppkey", "ordinal", F.trunc("l_shipdate", "MM").alias("year_month"),
            price.alias("_price"), _money("l_discount", "decimal(4,2)").alias("_discount"), refund.alias("_refund"), returned.alias("_returned"),
        )
        sold = (
            lines.join(hash_side(orders), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.read("part").select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
            .groupBy("l_suppkey", "year_month", "p_type", "c_nationkey")
            .agg(
                F.sum(F.col("_price") * F.when(F.col("_refund"), -1).otherwise(1)).cast("decimal(38,2)").alias("premiums"),
                F.sum(F.when(F.col("_returned"), F.col("_price") * F.col("_discount")).otherwise(0)).cast("decimal(38,4)").alias("claims"),
                F.min("ordinal").alias("_ordinal"),
            )
            # Two versions of one file: every row number stands in both.
            .withColumns({"source_version": F.when(F.col("_ordinal") % 2 == 1, "V1").otherwise("V2"), "source_row_number": F.expr("(_ordinal + 1) div 2")})
        )
        tick = F.lit("0.01").cast("decimal(4,2)")
        ratio = F.when(
            F.col("source_row_number") % 11 != 0,
            ((F.col("source_row_number") % 200 - 3).cast("decimal(9,0)") * tick).cast("decimal(18,4)"),
        )
        return sold.join(
            self.read("supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey")
        ).select(
            F.concat(F.lit("market-"), F.year("year_month").cast("string")).alias("batch_id"),
            F.lit("market.csv").alias("source_file"),
            "source_version",
            "source_row_number",
            F.col("s_suppkey").cast("int").alias("company_code"),
            F.col("s_name").alias("company_name"),
            "year_month",
            F.col("p_type").alias("product"),
            F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("state"),
            "premiums",
            "claims",
            ratio.alias("claim_premium_ratio"),
        )

    @property
    def market(self) -> DataFrame:
        """Market staging, one row per company, month, product and state; the record hash is derived where it is read."""
        return self.table("stg_market", self._market).withColumn("record_hash", text_record_hash([F.col(c).cast("string") for c in MARKET_COLUMNS]))

    @cached_property
    def market_raw(self) -> DataFrame:
        """Market rows as source text, with one corruption per row-number slot."""
        rn = F.col("source_row_number")
        slot = rn % 97

        def corrupt(base: Column, changes: dict[int, Column | str]) -> Column:
            out = base
            for at, value in changes.items():
                out = F.when(slot == at, value).otherwise(out)
            return out

        code, month = F.col("company_code").cast("string"), F.col("year_month").cast("string")
        return self.market.select(
            "batch_id",
            "source_file",
            "source_row_number",
            corrupt(code, {1: F.lit(""), 2: F.concat(F.lit("0"), code), 3: F.lit("99999999999")}).alias("company_code"),
            corrupt(F.col("company_name"), {4: F.lit(""), 5: F.lit("x" * 117)}).alias("company_name"),
            corrupt(
                month,
                {6: F.lit("2003-02-30"), 7: F.concat(F.substring(month, 1, 8), F.lit("15")), 8: F.lit("2003-1-01")},
            ).alias("year_month"),
            "product",
            corrupt(F.col("state"), {9: F.lit("ABC")}).alias("state"),
            corrupt(
                F.col("premiums").cast("string"),
                {
                    10: F.lit("NaN"),
                    11: F.lit("abc"),
                    12: F.lit("1e-5"),
                    13: F.lit("0.0000000000000000005"),
                    14: F.lit("0.0000000000000000015"),
                    15: F.lit("123456789012345678901"),
                },
            ).alias("premiums"),
            corrupt(F.col("claims").cast("string"), {16: F.lit("NA")}).alias("claims"),
            F.when(rn % 11 == 0, "NA")
            .when(slot == 17, "")
            .otherwise(F.col("claim_premium_ratio").cast("string"))
            .alias("claim_premium_ratio"),
        )

    @property
    def market_checked(self) -> DataFrame:
        """Judged rows, written once: both sides of the split then read, not parse."""
        return self.table("market_checked", lambda: apply_market_contract(spread(self.market_raw)))

    @cached_property
    def market_split(self) -> tuple[DataFrame, DataFrame]:
        return split_rows(self.market_checked)

    @cached_property
    def market_batches(self) -> DataFrame:
        """One load batch per calendar year; 1999 failed, leap years expect one row more.

        Batches of even years claim some rejected rows.
        """
        year = F.substring("batch_id", 8, 4).cast("int")
        counts = self.market.groupBy("batch_id").agg(
            F.count("*").alias("rows"), F.count_if((F.col("source_row_number") % 97 == 1) & (year % 2 == 0)).alias("rejects")
        )
        batches = counts.select(
            "batch_id",
            F.when(year == 1999, "FAILED").otherwise("SUCCESS").alias("status"),
            (F.col("rows") + F.when(year % 4 == 0, 1).otherwise(0)).alias("expected_source_rows"),
            (F.col("rows") - F.col("rejects")).alias("accepted_rows"),
            F.col("rejects").alias("rejected_rows"),
        )
        # Stored, a few rows are known to be few: a join with them is no shuffle by batch.
        return self.table("market_batches", lambda: batches)

    @cached_property
    def market_dims(self) -> dict[str, DataFrame]:
        return {
            name: self.table(f"dim_{name}", lambda df=df: df) for name, df in W.market_dimensions(self.market).items()
        }

    @property
    def fact_market(self) -> DataFrame:
        """Fact laid out for the two hot workloads: by year, sorted by state and product."""
        return self.table(
            "fact_market",
            lambda: W.fact_market(self.market, self.market_dims, self.market_batches),
            partition_by=("calendar_year",),
            sort_by=("state_key", "product_key", "company_key"),
            hex_columns=("record_hash",),
        )

    def fact_for(self, workload: str) -> DataFrame:
        """A sorted copy of the fact's columns for one hot workload."""
        return self.table(
            f"fact_by_{workload}", lambda: W.workload_layout(self.fact_market, workload),
            partition_by=(f"{workload}_slice",), sort_by=(*W.WORKLOADS[workload], "calendar_year"),
        )

    @property
    def fact_by_company(self) -> DataFrame:
        return self.fact_for("company")

    @property
    def fact_by_state_product(self) -> DataFrame:
        return self.fact_for("state_product")

    # -- risk track ---------------------------------------------------------

    def _risk(self) -> DataFrame:
        claimed = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
        robbery, other = F.col("_robbery"), F.col("_other")
        price, zero = F.col("_price"), F.lit(0).cast("decimal(19,6)")
        exposure = F.when(F.col("_single"), F.lit(0).cast("decimal(21,4)")).otherwise(
            (F.col("_quantity") * F.lit("0.01").cast("decimal(4,2)")).cast("decimal(21,4)")
        )

        def share(condition: Column, rate: str) -> Column:
            paid = (price * F.lit(rate).cast("decimal(4,2)")).cast("decimal(19,6)")
            return F.when(condition, paid).otherwise(zero)

        part_share = F.when(F.col("ordinal") % 50 == 0, F.lit("1.5")).otherwise(F.lit("0.5")).cast("decimal(2,1)")
        customer = self.read("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        orders = (
            self.read("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "o_orderpriority", "c_nationkey", "c_mktsegment")
        )
        part = self.read("part").select("p_partkey", "p_name", "p_brand", "p_size")
        no_state = F.col("n_nationkey") == 0
        lines = self.lineitem.select(
            "l_orderkey", "l_partkey", "ordinal", _money("l_extendedprice").alias("_price"), _money("l_quantity", "decimal(10,2)").alias("_quantity"),
            (F.col("l_quantity") == 1).alias("_single"), (claimed & (F.col("l_linenumber") <= 4)).alias("_robbery"),
            (claimed & (F.col("l_linenumber") >= 4)).alias("_other"),
        )
        joined = (
            lines.join(hash_side(orders), F.col("l_orderkey") == F.col("o_orderkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .join(self.read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        rows = joined.select(
            F.concat(F.lit("part"), (F.col("l_orderkey") % 5).cast("string"), F.lit(".csv")).alias("source_file"),
            F.lit("V1").alias("source_version"),
            F.col("ordinal").alias("source_row_number"),
            F.nullif("c_mktsegment", F.lit("FURNITURE")).alias("gender"),
            F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("driv_age"),
            F.when(F.col("p_size") != 50, F.col("p_size") + 1960).alias("veh_year"),
            F.col("p_name").alias("veh_model"),
            F.col("p_brand").alias("veh_group"),
            F.col("r_name").alias("area"),
            F.when(~no_state, F.col("n_name")).alias("state"),
            F.when(~no_state, F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("state_ab"),
            exposure.alias("expos_total"),
            price.alias("prem_total"),
            part_share.alias("_share"),
            F.when(robbery, 1).otherwise(0).alias("claim_nb_rob"),
            F.when(other, 2).otherwise(0).alias("claim_nb_other"),
            share(robbery, "0.10").alias("claim_amount_rob"),
            share(other, "0.05").alias("claim_amount_other"),
            *[F.lit(0).alias(f"claim_nb_{k}") for k in ("partcoll", "totcoll", "fire")],
            *[zero.alias(f"claim_amount_{k}") for k in ("partcoll", "totcoll", "fire")],
        )
        return rows.select(
            *[c for c in rows.columns if c != "_share"],
            (F.col("expos_total") * F.col("_share")).cast("decimal(19,6)").alias("expos_fire_rob"),
            (F.col("prem_total") * F.col("_share")).cast("decimal(19,6)").alias("prem_fire_rob"),
            (F.col("prem_total") * 10).cast("decimal(19,6)").alias("sum_ins_avg"),
        )

    @property
    def risk(self) -> DataFrame:
        """Risk staging: five files, rows numbered by their place in the source; the record hash is derived where it is read."""
        record_hash = text_record_hash([F.col(c).cast("string") for c in RECORD_HASH_COLUMNS]).alias("record_hash")
        return self.table("stg_risk", self._risk).select(record_hash, "*")

    @cached_property
    def risk_raw(self) -> DataFrame:
        """Risk rows as source text under the source's own column names, some of them broken."""
        slot = F.col("source_row_number") % 211
        columns = []
        for source, snake in W.RISK_STAGING_TO_SNAKE.items():
            text = F.coalesce(F.col(snake).cast("string"), F.lit(""))
            if source == "Gender":
                text = F.when(slot == 1, F.lit("x" * 21)).otherwise(text)
            elif source == "VehYear":
                text = F.when(slot == 2, "40000").when(slot == 3, "-1").when(slot == 4, " 1999 ").otherwise(text)
            elif source == "ExposTotal":
                text = F.when(slot == 5, "0.123456789012345678").when(slot == 6, "12345").when(slot == 7, "-0.5").otherwise(text)
            elif source == "PremTotal":
                text = F.when(slot == 8, "1.5e3").when(slot == 9, "").when(slot == 10, "Infinity").otherwise(text)
            elif source == "ClaimNbRob":
                text = F.when(slot == 11, "2147483648").when(slot == 12, "1.0").otherwise(text)
            elif source == "StateAb":
                text = F.when(slot == 13, "").otherwise(text)
            columns.append(text.alias(source))
        return self.risk.select("source_file", "source_row_number", *columns)

    @property
    def risk_checked(self) -> DataFrame:
        return self.table("risk_checked", lambda: apply_risk_contract(spread(self.risk_raw)))

    @cached_property
    def risk_dims(self) -> dict[str, DataFrame]:
        return {
            spec[0].lower(): self.table(f"dim_{spec[0].lower()}", lambda spec=spec: W.risk_dimension(self.risk, spec))
            for spec in (W.DRIVER, W.VEHICLE, W.GEOGRAPHY)
        }

    @property
    def fact_risk(self) -> DataFrame:
        return self.table("fact_risk", lambda: W.fact_risk(self.risk, self.risk_dims))

    @property
    def fact_risk_rows(self) -> DataFrame:
        """The rows of the risk fact for who reads few of its columns: from the stored fact if there is one, else from its star join, where hashes travel as bytes."""
        if "fact_risk" in self._tables:
            return self._tables["fact_risk"]
        rows = W.fact_risk(self.risk.withColumn("record_hash", F.unhex("record_hash")), self.risk_dims)
        return rows.withColumn("record_hash", F.hex("record_hash"))

    @cached_property
    def scores(self) -> DataFrame:
        """A score and a label per risk row."""
        claims = F.col("claim_nb_rob") + F.col("claim_nb_other")
        tick = F.lit("0.0001").cast("decimal(5,4)")
        base = ((F.col("source_row_number") * 7919) % 10001).cast("decimal(9,0)") * tick
        weight = F.when(claims > 0, F.lit("1.0")).otherwise(F.lit("0.7")).cast("decimal(2,1)")
        return self.risk.select(
            "source_file",
            "source_version",
            "source_row_number",
            "record_hash",
            (claims > 0).cast("int").alias("has_claim"),
            (base * weight).cast("decimal(12,10)").alias("score"),
        )

    # -- two versions of a file, and damaged layers on which every rule finds something ------

    @cached_property
    def risk_versions(self) -> tuple[DataFrame, DataFrame]:
        """Staging and fact with the last file staged a second time under another version."""
        again = lambda df: df.unionByName(df.where("source_file = 'part4.csv'").withColumn("source_version", F.lit("V2")))
        return again(self.risk), again(self.fact_risk)

    @cached_property
    def risk_damaged(self) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
        slot = "source_row_number % 1009"
        staging = self.risk.withColumns({
            "prem_total": F.expr(f"if({slot} = 1, null, prem_total)"),
            "claim_amount_rob": F.expr(f"if({slot} = 2, cast(-1 as decimal(19, 6)), claim_amount_rob)"),
            "state": F.expr(f"if({slot} = 3, null, state)"),
            "state_ab": F.expr(f"if({slot} = 4, 'ZZ', state_ab)"),
            "claim_nb_fire": F.expr(f"if({slot} = 5, 1, claim_nb_fire)"),
        }).unionByName(self.risk.where(f"{slot} = 6"))
        fact = self.fact_risk.where(f"{slot} <> 8").withColumns({
            "driver_key": F.expr(f"if({slot} = 7, -5, driver_key)"),
            "record_hash": F.expr(f"if({slot} = 9, 'X' || record_hash, record_hash)"),
            "loss_ratio": F.expr(f"if({slot} = 12, null, loss_ratio)"),
            "source_row_number": F.expr(f"if({slot} = 10, source_row_number + 1000000000, source_row_number)"),
        }).unionByName(self.fact_risk.where(f"{slot} = 11"))
        driver = self.risk_dims["driver"]
        twins = driver.where("driver_key % 3 = 1").withColumn("driver_key", F.col("driver_key") + 1_000_000)
        return staging, fact, {**self.risk_dims, "driver": driver.unionByName(twins)}

    @cached_property
    def market_damaged(self) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
        slot = "source_row_number % 503"
        staging = self.market.withColumns({
            "company_name": F.expr(f"case {slot} when 1 then null when 3 then 'other name' else company_name end"),
            "year_month": F.expr(f"if({slot} = 2, date_add(year_month, 1), year_month)"),
            "claims": F.expr(f"if({slot} = 4, cast(-1 as decimal(38, 4)), claims)"),
        }).unionByName(self.market.where(f"{slot} = 5").withColumn("source_row_number", F.col("source_row_number") + 1_000_000_000)).unionByName(
            self.market.where(f"{slot} = 6")
        )
        fact = self.fact_market.where(f"{slot} <> 8").withColumns({
            "company_key": F.expr(f"if({slot} = 7, -5, company_key)"),
            "premiums": F.expr(f"if({slot} = 9, cast(premiums + 1 as decimal(38, 2)), premiums)"),
            "source_row_number": F.expr(f"if({slot} = 10, source_row_number + 1000000000, source_row_number)"),
        }).unionByName(self.fact_market.where(f"{slot} = 11"))
        state = self.market_dims["state"]
        twins = state.where("state_key % 3 = 1").withColumn("state_key", F.col("state_key") + 1_000_000)
        return staging, fact, {**self.market_dims, "state": state.unionByName(twins)}

    # -- marts: small, written once, read by every analytic -------------------

    @property
    def monthly(self) -> DataFrame:
        return self.table("mart_monthly", lambda: M.monthly(self.fact_market, self.market_dims))

    @property
    def companies(self) -> DataFrame:
        return self.table("mart_companies", lambda: M.by_year(self.fact_market, self.market_dims, "company"))

    @property
    def products(self) -> DataFrame:
        return self.table("mart_products", lambda: M.by_year(self.fact_market, self.market_dims, "product"))

    @property
    def segments(self) -> DataFrame:
        return self.table("mart_segments", lambda: M.risk_segments(self.fact_risk, self.risk_dims))

    @property
    def bands(self) -> DataFrame:
        return self.table("mart_bands", lambda: M.score_bands(self.scores, self.fact_risk, self.risk_dims))

    # -- events: change feed and load history --------------------------------

    @cached_property
    def changes(self) -> DataFrame:
        """Change feed: op 1 delete, 2 insert, 3 before-image, 4 after-image."""
        kind = F.col("event_type")
        op = F.when(kind == "click", 3).when(kind == "view", 4).when(kind == "error", 1).otherwise(2)
        return self.read("events").select(
            (F.col("user_id") % 3).alias("run_id"),
            F.col("event_id").alias("record_id"),
            F.expr("event_id DIV 4").alias("lsn"),
            F.col("event_id").alias("seq"),
            op.alias("op"),
        )

    @cached_property
    def batch_events(self) -> DataFrame:
        """Load history: state changes of batches, several batches per source version."""
        kind = F.col("event_type")
        status = F.when(kind.isin("signup", "click"), "RUNNING").when(kind == "error", "FAILED").otherwise("SUCCESS")
        user = F.col("user_id")
        return self.read("events").select(
            F.concat(F.lit("batch-"), user.cast("string")).alias("batch_id"),
            F.concat(F.lit("file-"), (user % 60).cast("string")).alias("source_file"),
            F.concat(F.lit("v"), (user % 120).cast("string")).alias("source_version"),
            status.alias("status"),
            F.col("event_id").alias("event_seq"),
            (F.col("event_id") % 100).alias("accepted_rows"),
            (F.col("event_id") % 7).alias("rejected_rows"),
        )


_SOURCES: dict[tuple, Sources] = {}


def _contents(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of what a data folder holds."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def sources(spark: SparkSession, folder: str) -> Sources:
    """The derived tables of a folder, built once for what it holds now: new or changed files give new tables."""
    key = (spark.sparkContext.applicationId, folder, _contents(spark, folder))
    if key not in _SOURCES:
        _SOURCES[key] = Sources(spark, folder)
    return _SOURCES[key]
