"""Panel inputs computed from the given order tables.

Stand-ins: a nation (or a customer) is the entity; distinct customers are its
population, order value its GDP, urgent order value its R&D, suppliers its
researchers, the share of finished orders its unemployment, shipped quantity its
patents (resident when supplier and customer share the nation), and very large
orders its laureates.

Facts are aggregated to the finest key that the next join needs before they are
joined, so a customer or supplier that holds a third of all rows arrives there as
a few rows per year.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators.panel import Inputs
from panelwright.operators.reshape import scaffold, year_range_of

NATION_PRIZE = 497_000  # order value that makes a laureate
CUSTOMER_PRIZE = 400_000

KEYS = ["entity", "year"]
ORDER_MEASURES = ["population", "gdp", "rd_expenditure", "graduate_unemployment_rate"]
LINE_MEASURES = ["researchers_count", "patents_total", "resident_patents", "abroad_patents"]
PRIZE_MEASURES = ["nobel_laureates_count"]


# Explicit schemas: no job to infer them, and a changed file fails instead of drifting.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All years from the first order or shipment to the last one."""
    ordered = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"))
    shipped = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"))
    return year_range_of(ordered.union(shipped), "year")


def year_list(spark: SparkSession, sf_dir: str) -> list[int]:
    """The years as values of a pivot, which would run its whole input once more to find them.

    Two date columns are read, no rows; a year without data is a column of NULLs.
    """
    return sorted(r["year"] for r in years(spark, sf_dir).collect())


def cents(name: str) -> Column:
    """Money as whole cents: sums are exact, independent of row order, and cheaper than decimals."""
    return F.floor(F.col(name) * 100 + 0.5)


def orders_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer and year."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(
            F.sum(cents("o_totalprice")).alias("value"),
            F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", cents("o_totalprice"))).alias("urgent"),
            F.count("*").alias("orders"),
            F.count_if(F.col("o_orderstatus") == "F").alias("finished"),
            F.count_if(F.col("o_totalprice") > NATION_PRIZE).alias("nation_prizes"),
            F.count_if(F.col("o_totalprice") > CUSTOMER_PRIZE).alias("customer_prizes"),
        )
    )


def _prizes(count: Column) -> Column:
    """Orders are unique, so counting them needs no distinct; none at all is no observation."""
    return F.when(count > 0, count).alias("nobel_laureates_count")


def nation_order_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    by_nation = (
        orders_by_customer(spark, sf_dir)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("entity"), "year")
        .agg(
            F.count("*").alias("customers"),
            F.sum("value").alias("value"),
            F.sum("urgent").alias("urgent"),
            F.sum("orders").alias("orders"),
            F.sum("finished").alias("finished"),
            F.sum("nation_prizes").alias("prizes"),
        )
    )
    share = F.lit(100.0) * F.col("finished") / F.col("orders")
    return by_nation.join(nation, F.col("entity") == F.col("n_nationkey")).select(
        *KEYS,
        F.col("customers").cast("double").alias("population"),
        (F.col("value") / 100.0).alias("gdp"),
        (F.col("urgent") / 100.0).alias("rd_expenditure"),
        F.when(F.col("n_regionkey") != 0, share).alias("graduate_unemployment_rate"),
        _prizes(F.col("prizes")),
    )


def _quantity_split(same_nation: Column, other_nation: Column) -> list[Column]:
    zero = F.lit(0.0)
    return [
        F.sum("quantity").cast("long").alias("patents_total"),
        F.sum(F.when(same_nation, F.col("quantity")).otherwise(zero)).cast("long").alias("resident_patents"),
        F.sum(F.when(other_nation, F.col("quantity")).otherwise(zero)).cast("long").alias("abroad_patents"),
    ]


def buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer and customer nation (NULL if unknown) of every order.

    Joined to the orders before the lines come in, so the wide side of the lines'
    join carries the nation already and the lines are not exchanged for it.
    """
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").drop("c_custkey")


def shipped_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as they enter the exchange: four narrow columns, the date already a year."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_quantity", F.year("l_shipdate").alias("year")
    )


def shipped_by_supplier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity per supplier, ship year and nation of the customer."""
    return (
        shipped_lines(spark, sf_dir)
        .join(buyers(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .groupBy("l_suppkey", "year", "c_nationkey")
        .agg(F.sum("l_quantity").alias("quantity"))
    )


def nation_line_measures(spark: SparkSession, sf_dir: str, shipped: DataFrame | None = None) -> DataFrame:
    """``shipped`` is ``shipped_by_supplier``, if the caller has stored it."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    origin, office = F.col("s_nationkey"), F.col("c_nationkey")
    lines = shipped_by_supplier(spark, sf_dir) if shipped is None else shipped
    return (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(origin.alias("entity"), "year")
        .agg(
            F.count_distinct("l_suppkey").cast("double").alias("researchers_count"),
            *_quantity_split(origin == office, origin != office),
        )
    )


def nation_prizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_totalprice") > NATION_PRIZE)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("entity"), F.year("o_orderdate").alias("year"))
        .agg(F.count_distinct("o_orderkey").alias("nobel_laureates_count"))
    )


def nation_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return [
        (nation_order_measures(spark, sf_dir), ORDER_MEASURES + PRIZE_MEASURES),
        (nation_line_measures(spark, sf_dir), LINE_MEASURES),
    ]


def nation_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("entity"))
    return scaffold(nation, "entity", years(spark, sf_dir))


def customer_order_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_by_customer(spark, sf_dir).select(
        F.col("o_custkey").alias("entity"),
        "year",
        F.col("orders").cast("double").alias("population"),
        (F.col("value") / 100.0).alias("gdp"),
        (F.col("urgent") / 100.0).alias("rd_expenditure"),
        (F.lit(100.0) * F.col("finished") / F.col("orders")).alias("graduate_unemployment_rate"),
        _prizes(F.col("customer_prizes")),
    )


def customer_line_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    per_pair = (
        shipped_lines(spark, sf_dir)
        .join(buyers(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("o_custkey", "c_nationkey", "l_suppkey", "year")
        .agg(F.sum("l_quantity").alias("quantity"))
    )
    origin, office = F.col("s_nationkey"), F.col("c_nationkey")
    return (
        per_pair.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("o_custkey").alias("entity"), "year")
        .agg(
            # One row per pair and year: counting rows counts suppliers.
            F.count("l_suppkey").cast("double").alias("researchers_count"),
            *_quantity_split(origin == office, origin != office),
        )
    )


def customer_inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return [
        (customer_order_measures(spark, sf_dir), ORDER_MEASURES + PRIZE_MEASURES),
        (customer_line_measures(spark, sf_dir), LINE_MEASURES),
    ]


def customer_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("entity"))
    return scaffold(customer, "entity", years(spark, sf_dir))
