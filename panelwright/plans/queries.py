"""Every operator as a query over the given tables: name -> function of (spark, sf_dir).

Results that involve division or logarithms are rounded here, for comparison with
SQL only; the operators themselves never round.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright import contract
from panelwright.functions import paths
from panelwright.functions.keys import row_fingerprint
from panelwright.functions.names import light_name, strict_name
from panelwright.functions.numbers import positive_long
from panelwright.operators import audit, index, landing, quality, sinks
from panelwright.operators.conform import aggregate_then_conform, conform, flag_presence
from panelwright.operators.flatten import (
    flatten_indicator,
    flatten_laureates,
    flatten_patents,
    split_by_residence,
)
from panelwright.operators.panel import panel_by_joins, panel_by_union
from panelwright.operators.reshape import scaffold, unpivot_years, year_columns, year_range_of
from panelwright.plans import given_tables as given
from panelwright.plans import gold, runs, silver
from panelwright.plans.given_tables import KEYS, table
from panelwright.session import fresh_path, stored
from panelwright.sources import envelopes, files, schemas, summaries
from panelwright.streaming import landing as stream

ISO = contract.ISO
RUN = "run-1"
DIGITS = 9
NORMS = [f"{c}_norm" for c in contract.SCALED]
INDICES = list(contract.SCORE_WEIGHTS)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles to so many digits, by plain double arithmetic, which SQL engines share."""
    return df.selectExpr(*[
        f"{_rint(name, digits)} as `{name}`" if kind == "double" else f"`{name}`" for name, kind in df.dtypes
    ])


def _rint(name: str, digits: int) -> str:
    return f"rint(`{name}` * 1e{digits}D) / 1e{digits}D"


def letters(text: Column) -> Column:
    """Digits as letters, so that names made of digits survive the strict key."""
    return F.translate(text, "0123456789_", "ABCDEFGHIJ ")


def text(column: Column) -> Column:
    return column.cast("string")


# ---- raw shapes made from the given tables


def raw_indicators(spark, sf_dir, keep: tuple = ()) -> DataFrame:
    """Events in the nested shape of indicator records, with missing, empty and bad fields."""
    k = F.get_json_object("props", "$.k").cast("int")
    year = F.when(k % 10 == 0, F.concat(text(k + 2000), F.lit("Q1"))).otherwise(text(k + 1900))
    code = F.when(F.col("event_type") == "signup", "").when(F.col("event_type") != "error", text(F.col("user_id")))
    return table(spark, sf_dir, "events").select(
        *keep,
        F.struct(F.lit("i").alias("id"), F.col("event_type").alias("value")).alias("indicator"),
        F.struct(text(F.col("user_id")).alias("id"), F.concat(F.lit("User-"), letters(text(F.col("user_id")))).alias("value")).alias("country"),
        code.alias("countryiso3code"),
        year.alias("date"),
        "value",
        F.lit("").alias("unit"),
        F.lit("").alias("obs_status"),
        F.lit(0).alias("decimal"),
    )


def raw_laureates(spark, sf_dir) -> DataFrame:
    """Orders as nested awards: several, one, none or no list, and places with gaps."""
    key = F.col("o_orderkey")
    born = F.when(key % 3 != 0, F.col("o_orderpriority"))
    now = F.when(key % 5 != 0, F.concat(F.lit("  now "), F.lower("o_orderpriority")))
    prizes = F.transform(
        F.sequence(F.lit(1).cast("long"), key % 7),
        lambda i: F.struct(text(F.year("o_orderdate") + i).alias("awardYear")),
    )
    def named(c):
        return F.struct(c.alias("en"))
    return table(spark, sf_dir, "orders").select(
        text(key).alias("id"),
        F.struct(F.struct(named(born).alias("country"), named(now).alias("countryNow")).alias("place")).alias("birth"),
        F.when(key % 7 >= 1, F.filter(prizes, lambda p: key % 7 > 1)).alias("nobelPrizes"),
    )


def traded(spark, sf_dir, shipped: DataFrame | None = None) -> DataFrame:
    """Quantity per customer nation (office, some unknown), supplier nation (origin) and ship year."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation")
    office = nation.select(F.col("n_nationkey").alias("_office"), F.col("n_name").alias("Office"))
    origin = nation.select(F.col("n_nationkey").alias("_origin"), F.col("n_name").alias("Origin"))
    lines = given.shipped_by_supplier(spark, sf_dir) if shipped is None else shipped
    return (
        lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("c_nationkey", "s_nationkey", "year")
        .agg(F.sum("quantity").cast("long").alias("quantity"))
        .join(office, (F.col("c_nationkey") == F.col("_office")) & (F.col("c_nationkey") % 6 != 0), "left")
        .join(origin, F.col("s_nationkey") == F.col("_origin"))
        .select("Office", text(F.col("c_nationkey")).alias("Office (Code)"), "Origin", "year", "quantity")
    )


def raw_patents(spark, sf_dir, shipped: DataFrame | None = None) -> DataFrame:
    """The wide file shape: one text column per year."""
    wide = (
        traded(spark, sf_dir, shipped).groupBy("Office", "Office (Code)", "Origin")
        .pivot("year", given.year_list(spark, sf_dir)).agg(F.sum("quantity"))
    )
    years = year_columns(wide)
    return wide.select(
        "Office", "`Office (Code)`", "Origin", *[text(F.col(f"`{y}`")).alias(str(y)) for y in years]
    )


# ---- projections, reshaping, names


def flatten_indicator_query(spark, sf_dir):
    return flatten_indicator(raw_indicators(spark, sf_dir), "population").withColumnRenamed(ISO, "iso")


def project_by_dataset(spark, sf_dir):
    raw = raw_indicators(spark, sf_dir)
    rate = flatten_indicator(raw, "unemployment").withColumn("dataset", F.lit("unemployment"))
    value = flatten_indicator(raw, "rd").withColumn("dataset", F.lit("rd"))
    other = flatten_indicator(raw, "not listed")
    kept = other.select(
        F.col("country.value").alias("country_name"), F.col("countryiso3code").alias(ISO), "value",
        F.lit("not listed").alias("dataset"),
    )
    rows = rate.unionByName(value, allowMissingColumns=True).unionByName(kept, allowMissingColumns=True)
    return rows.withColumnRenamed(ISO, "iso")


def array_files(spark, sf_dir):
    """Indicator pages as files with one array each, read with the shared schema."""
    path = fresh_path(spark, "arrays")
    records = raw_indicators(spark, sf_dir, (F.floor(F.col("event_id") / 500).alias("page"),))
    page = F.to_json(F.collect_list(F.struct(*[c for c in records.columns if c != "page"])))
    pages = records.groupBy("page").agg(page.alias("value"))
    pages.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return flatten_indicator(files.read_landed(spark, [path], schemas.INDICATOR), "population").withColumnRenamed(ISO, "iso")


def inferred_lines(spark, sf_dir):
    """Indicator records as JSON lines, looked up by name and read by extension without a schema."""
    path = fresh_path(spark, "lines") + ".json"
    raw_indicators(spark, sf_dir).write.json(path)
    raw = files.read_named(spark, {"population": path}, "population")
    return flatten_indicator(raw, "population").withColumnRenamed(ISO, "iso")


def laureate_lines(spark, sf_dir):
    """Laureates as JSON lines, read with the full laureate schema."""
    path = fresh_path(spark, "laureates")
    raw_laureates(spark, sf_dir).write.json(path)
    return flatten_laureates(files.read_landed(spark, [path], schemas.LAUREATE))


def silver_inputs(spark, sf_dir):
    """What a conformed run finds of each dataset: by hand, landed, or nothing."""
    root = fresh_path(spark, "lake")
    raw_patents(spark, sf_dir).write.option("header", True).csv(f"{root}/manual/patents.csv")
    raw_indicators(spark, sf_dir).write.json(f"{root}/landed/population")
    raw_laureates(spark, sf_dir).write.json(f"{root}/landed/laureates.json")
    landed = [
        ("COMPLETED", "WORLDBANK", "population", [f"{root}/landed/population"]),
        ("COMPLETED", "NOBELPRIZE", "laureates", [f"{root}/landed/laureates.json"]),
        ("FAILED", "WORLDBANK", "rd", [f"{root}/landed/population"]),
    ]
    result = "status: STRING, domain_source: STRING, dataset_name: STRING, output_paths: ARRAY<STRING>"
    summary = spark.createDataFrame(
        [("COMPLETED", "run-1", "bronze", landed)],
        f"status STRING, correlation_id STRING, etl_layer STRING, results ARRAY<STRUCT<{result}>>",
    )
    manual = [{"domain_source": "PATENTS", "dataset_name": "patents", "file_path": "/manual/patents.csv"}]
    sources = runs.silver_sources(spark, {"manual_data_paths": manual}, summary, root)
    found = None
    for name in ("population", "laureates", "patents", "rd"):
        try:
            rows, status = quality.require_rows(sources[name], name), "present"
        except ValueError:
            rows, status = spark.range(0), "missing"
        counted = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("dataset"), F.lit(status).alias("status"), "n")
        found = counted if found is None else found.unionByName(counted)
    return found


def explode_awards(spark, sf_dir):
    return flatten_laureates(raw_laureates(spark, sf_dir))


def unpivot_years_query(spark, sf_dir):
    wide = (
        table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
        .groupBy("o_custkey").pivot("year", given.year_list(spark, sf_dir))
        .agg(F.sum(given.cents("o_totalprice")) / 100.0)
    )
    return unpivot_years(wide, ["o_custkey"], "value").filter(F.col("value").isNotNull())


def safe_cast_positive(spark, sf_dir):
    n, quantity = F.col("l_linenumber"), text(F.col("l_quantity").cast("int"))
    token = (
        F.when(n == 1, "").when(n == 2, "x").when(n == 3, "1,234").when(n == 4, F.concat(F.lit("-"), quantity))
        .when(n == 5, "0").when(n == 6, F.concat(F.lit(" "), quantity, F.lit(" "))).otherwise(quantity)
    )
    counted = table(spark, sf_dir, "lineitem").select("l_orderkey", n, positive_long(token).alias("patents_count"))
    return counted.filter(F.col("patents_count").isNotNull())


def resident_split(spark, sf_dir):
    split = split_by_residence(traded(spark, sf_dir), "quantity", "Origin", "Office")
    return split.groupBy("Origin", "year").agg(
        F.sum("quantity").alias("patents_total"),
        F.sum("resident_patents").alias("resident_patents"),
        F.sum("abroad_patents").alias("abroad_patents"),
    )


def flatten_patents_query(spark, sf_dir):
    return flatten_patents(raw_patents(spark, sf_dir)).withColumnRenamed("Office (Code)", "office_code")


def normalise_names(spark, sf_dir):
    """Part and customer names, short and many."""
    parts = table(spark, sf_dir, "part").select(F.concat_ws("-", "p_name", "p_brand").alias("name"))
    customers = table(spark, sf_dir, "customer").select(F.concat(F.lit(" "), "c_name", F.lit(" ")).alias("name"))
    names = parts.unionByName(customers)
    return names.select("name", strict_name(F.col("name")).alias("strict"), light_name(F.col("name")).alias("light"))


def normalise_texts(spark, sf_dir):
    """The strict key over whole documents; accents and punctuation go, inner white space stays."""
    return table(spark, sf_dir, "documents").select("doc_id", strict_name(F.col("text")).alias("strict"))


# ---- conforming


def entity_presence_flags(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    sources = {
        "ref_orders": (orders, "o_custkey"),
        "ref_urgent": (orders.filter(F.col("o_orderpriority") == "1-URGENT"), "o_custkey"),
        "ref_large": (orders.filter(F.col("o_totalprice") > 495_000), "o_custkey"),
    }
    entities = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return flag_presence(entities, "c_custkey", sources)


def country_master(spark, sf_dir):
    """Customers as countries: one source matched by code, two by name."""
    orders = table(spark, sf_dir, "orders")
    def named(key):
        return F.concat(F.lit("Customer"), letters(F.lpad(text(key), 9, "0")))
    reference = table(spark, sf_dir, "customer").select(
        text(F.col("c_custkey")).alias(ISO), letters(F.col("c_name")).alias("official_name_en"))
    population = orders.filter("o_orderstatus = 'F'").select(text(F.col("o_custkey")).alias(ISO))
    patents = orders.filter("o_totalprice > 450000").select(light_name(named(F.col("o_custkey"))).alias("country_code"))
    laureates = orders.filter("o_totalprice > 490000").select(light_name(named(F.col("o_custkey"))).alias("country_normalized"))
    country = silver.country_model(reference, population, patents, laureates)
    return country.withColumnRenamed(ISO, "iso")


def conform_inner(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 11 == 0, "").otherwise(text(F.col("o_custkey"))).alias("iso"),
        F.year("o_orderdate").alias("year"), F.col("o_totalprice").alias("value"))
    known = table(spark, sf_dir, "customer").filter("c_mktsegment != 'BUILDING'").select(
        text(F.col("c_custkey")).alias("code"), F.col("c_name").alias("country_name"))
    return conform(orders, known, "iso", "code", [orders["iso"], orders["year"], orders["value"], known["country_name"]])


def conform_by_name(spark, sf_dir):
    """The same orders matched on both keys: the light key keeps '#' and misses half of them."""
    mark = F.when(F.col("o_orderkey") % 2 == 0, "#").otherwise("")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit(" customer"), mark, letters(F.lpad(text(F.col("o_custkey")), 9, "0"))).alias("name"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", letters(F.col("c_name")).alias("c_name"))
    def matched(kind, rule):
        left = orders.withColumn("name_key", rule(F.col("name")))
        right = customers.withColumn("c_key", rule(F.col("c_name")))
        return conform(left, right, "name_key", "c_key", [F.lit(kind).alias("kind"), left["o_orderkey"], right["c_custkey"]])
    return matched("strict", strict_name).unionByName(matched("light", light_name))


def agg_then_join(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    returned = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(F.lit(0.0))
    measures = [F.sum("l_quantity").cast("long").alias("total"), F.sum(returned).cast("long").alias("returned")]
    keep = [F.col("s_name"), F.col("s_nationkey"), F.col("year"), F.col("total"), F.col("returned")]
    return aggregate_then_conform(
        lines, ["l_suppkey", "year"], measures, table(spark, sf_dir, "supplier"), "l_suppkey", "s_suppkey", keep)


def distinct_count_by_group(spark, sf_dir):
    return given.nation_prizes(spark, sf_dir)


# ---- dimensions and panel


def year_dim(spark, sf_dir):
    return year_range_of(table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year")), "year")


def entity_dim(spark, sf_dir):
    joined = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return gold.dim_country(joined.select("c_custkey", "c_name", "n_name", "r_name"))


def scaffold_grid(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"))
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    return scaffold(customer, "c_custkey", year_range_of(lines, "year"))


def nation_panel(spark, sf_dir):
    return panel_by_union(given.nation_grid(spark, sf_dir), given.nation_inputs(spark, sf_dir), KEYS)


def customer_panel(spark, sf_dir):
    return panel_by_union(given.customer_grid(spark, sf_dir), given.customer_inputs(spark, sf_dir), KEYS)


def stored_nation_panel(spark, sf_dir):
    return stored(nation_panel(spark, sf_dir), "panel")


def stored_customer_panel(spark, sf_dir):
    return stored(customer_panel(spark, sf_dir), "panel")


def panel_union_long(spark, sf_dir):
    return rounded(nation_panel(spark, sf_dir), 6)


def panel_left_joins(spark, sf_dir):
    """The chain of one left join per measure."""
    each = [(df, [m]) for df, measures in given.nation_inputs(spark, sf_dir) for m in measures]
    return rounded(panel_by_joins(given.nation_grid(spark, sf_dir), each, KEYS), 6)


def customer_panel_union_long(spark, sf_dir):
    return rounded(customer_panel(spark, sf_dir), 6)


def customer_panel_left_joins(spark, sf_dir):
    return rounded(panel_by_joins(given.customer_grid(spark, sf_dir), given.customer_inputs(spark, sf_dir), KEYS), 6)


# ---- index


def per_capita_ratios(spark, sf_dir):
    return rounded(gold.with_ratios(nation_panel(spark, sf_dir)).select(*KEYS, *contract.SCALED), 6)


def log1p_minmax_query(spark, sf_dir):
    scaled = index.log1p_minmax(gold.with_ratios(stored_nation_panel(spark, sf_dir)), list(contract.SCALED))
    return rounded(scaled.select(*KEYS, *NORMS))


def sub_indices(spark, sf_dir):
    return rounded(gold.composite_index(stored_nation_panel(spark, sf_dir)).select(*KEYS, *INDICES))


def composite_index(spark, sf_dir):
    return rounded(gold.composite_index(stored_nation_panel(spark, sf_dir)), 6)


def customer_composite_index(spark, sf_dir):
    scored = gold.composite_index(stored_customer_panel(spark, sf_dir))
    return rounded(scored.select(*KEYS, *INDICES, contract.SCORE))


def _customer_scores(spark, sf_dir) -> DataFrame:
    """Stored, since ranking reads the scores several times."""
    scored = gold.composite_index(stored_customer_panel(spark, sf_dir))
    return stored(scored.select(*KEYS, F.expr(_rint(contract.SCORE, 6)).alias("score")), "scores")


def rank_by_year(spark, sf_dir):
    return index.rank_within(_customer_scores(spark, sf_dir), "year", "score")


def top_k_by_year(spark, sf_dir):
    return index.top_k_within(_customer_scores(spark, sf_dir), "year", "score", 10)


def fact_innovation(spark, sf_dir):
    """All layers at once: raw shapes, flattening, conformed models, dimensions, fact.

    Raw inputs and the country model are stored, as a run of the layers would leave
    them, because several models read them.
    """
    nation = table(spark, sf_dir, "nation")
    name, iso = letters(F.col("n_name")), F.concat(F.lit("N"), F.col("n_nationkey"))
    reference = nation.select(iso.alias(ISO), name.alias("official_name_en"))
    shipped = stored(given.shipped_by_supplier(spark, sf_dir), "shipped")
    measured = stored(
        given.nation_order_measures(spark, sf_dir)
        .join(given.nation_line_measures(spark, sf_dir, shipped).select(*KEYS, "researchers_count"), KEYS, "full")
        .join(nation, F.col("entity") == F.col("n_nationkey"))
        .select(name.alias("name"), iso.alias("iso"), "year", *contract.MEASURES[:5]),
        "raw-indicators",
    )

    def indicator(measure, dataset):
        raw = measured.filter(F.col(measure).isNotNull()).select(
            F.struct(F.col("name").alias("value")).alias("country"), F.col("iso").alias("countryiso3code"),
            text(F.col("year")).alias("date"), F.col(measure).alias("value"))
        return flatten_indicator(raw, dataset)

    sources = {
        "population": indicator("population", "population"),
        "pkb": indicator("gdp", "pkb"),
        "rd": indicator("rd_expenditure", "rd"),
        "researchers": indicator("researchers_count", "researchers"),
        "unemployment": indicator("graduate_unemployment_rate", "unemployment"),
    }
    patents = flatten_patents(
        stored(raw_patents(spark, sf_dir, shipped).withColumn("Origin", letters(F.col("Origin")))
               .withColumn("Office", letters(F.col("Office"))), "raw-patents"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    winners = (
        table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > given.NATION_PRIZE)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    def place(c):
        return F.struct(F.struct(F.struct(c.alias("en")).alias("country"), F.struct(c.alias("en")).alias("countryNow")).alias("place"))
    laureates = flatten_laureates(stored(winners.select(
        text(F.col("o_orderkey")).alias("id"), place(name).alias("birth"),
        F.array(F.struct(text(F.year("o_orderdate")).alias("awardYear"))).alias("nobelPrizes")), "raw-laureates"))

    country = stored(silver.country_model(reference, sources["population"], patents, laureates), "country")
    models = {m: silver.indicator_model(sources[d], country) for m, d in contract.INDICATOR_MODEL_DATASET.items()}
    models |= {
        "COUNTRY": country,
        "YEAR": given.years(spark, sf_dir),
        "NOBEL_LAUREATES": silver.laureates_model(laureates, country),
        "PATENTS": silver.patents_model(patents, country),
    }
    return rounded(gold.fact_innovation(models).withColumnRenamed(ISO, "iso"), 6)


# ---- checks and audit


def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def missing_inputs(spark, sf_dir):
    """Orders without any returned line, by anti join."""
    required = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("model"))
    completed = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("model"))
    return quality.missing_inputs(required, completed, "model")


TABLE_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"],
    "part": ["p_partkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"], "documents": ["doc_id"], "embeddings": ["vec_id"], "pages": ["page_id"],
    "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}


def audit_counts(spark, sf_dir):
    tables = {name: (table(spark, sf_dir, name), keys) for name, keys in TABLE_KEYS.items()}
    counts = audit.audit_all(tables, RUN)
    return counts.select(
        "run_id", "model", "row_count", "key_count", F.explode("null_counts").alias("column_name", "null_count"))


def event_results(spark, sf_dir) -> DataFrame:
    status = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "signup", "SKIPPED")
    return table(spark, sf_dir, "events").select(
        F.floor(F.col("event_id") / 4).cast("long").alias("run_id"),
        status.otherwise("COMPLETED").alias("status"),
        F.round(F.col("value") * 1000).cast("long").alias("duration_in_ms"))


def status_rollup(spark, sf_dir):
    """Four events are a run; as many runs again have no results."""
    results = event_results(spark, sf_dir)
    ids = table(spark, sf_dir, "events").select((F.col("event_id") - F.col("event_id") % 2).alias("run_id"))
    return audit.status_rollup(results, "run_id", ids)


# ---- locations, summaries, landed pages


def lake_uri(spark, sf_dir):
    url, account = F.col("url"), F.lit("acct")
    folder = F.regexp_extract(url, "^[a-z]+://[^/]*(/[^?#]*)", 1)
    return table(spark, sf_dir, "pages").select(
        "page_id",
        paths.lake_uri(url).alias("uri"),
        paths.absolute_url(F.regexp_replace(folder, "^/", ""), account).alias("absolute"),
        paths.blob_url(F.lit("Bronze"), folder, account).alias("blob"),
        paths.account_uri(folder, account).alias("own_container"),
        paths.table_uri(F.lit("silver"), folder, F.lit("ACCT")).alias("table_location"),
        F.array_join(paths.prefixed(F.array(folder, folder), F.lit("base")), "|").alias("prefixed"),
    )


def order_pages(spark, sf_dir) -> DataFrame:
    """Each order as one fetched page of two records; two of nine pages hold no records."""
    key = F.col("o_orderkey")
    def record(i):
        return F.struct(key.alias("k"), F.lit(i).alias("i"), F.col("o_orderstatus").alias("s"))
    page = F.concat(
        F.lit('[{"page":1,"total":2},'), F.to_json(F.array(record(0), record(1))), F.lit("]"))
    return table(spark, sf_dir, "orders").select(
        F.when(key % 9 == 0, '{"message":"no data"}').when(key % 9 == 1, '[{"page":9},null]').otherwise(page).alias("page"))


def envelope_records(spark, sf_dir):
    return envelopes.records_of_meta_pages(order_pages(spark, sf_dir), "page", "k BIGINT, i INT, s STRING")


def raw_page_records(spark, sf_dir):
    """The same records as text, as they are landed."""
    return envelopes.raw_records(order_pages(spark, sf_dir), "page")


def keyed_envelope_records(spark, sf_dir):
    turns = F.struct("conv_id", "turn", "role", "text")
    pages = table(spark, sf_dir, "conversations").select(
        F.when(F.col("turn") % 3 == 2, F.to_json(F.struct(F.array(turns).alias("other"))))
        .otherwise(F.to_json(F.struct(F.array(turns).alias("turns")))).alias("page"))
    schema = "conv_id BIGINT, turn BIGINT, role STRING, text STRING"
    return envelopes.records_of_keyed_pages(pages, "page", "turns", schema)


def source_routing(spark, sf_dir):
    """Documents as required datasets; pages give manual paths, labelled documents landed ones."""
    required = table(spark, sf_dir, "documents").select(F.lit("docs").alias("domain_source"), F.col("doc_id").alias("dataset_name"))
    manual = table(spark, sf_dir, "pages").filter("page_id % 2 = 0").select(
        F.lit("docs").alias("domain_source"), F.col("page_id").alias("dataset_name"), F.col("url").alias("path"))
    landed = table(spark, sf_dir, "labels").select(
        F.lit("docs").alias("domain_source"), F.col("doc_id").alias("dataset_name"),
        F.concat(F.lit("landed/"), "doc_id").alias("path"))
    return summaries.route_sources(required, manual, landed, ["domain_source", "dataset_name"])


def event_summaries(spark, sf_dir) -> DataFrame:
    """Each event as a run summary with two results."""
    def result(status, dataset, n):
        files = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit(f"{dataset}/"), "event_id", F.lit("/"), i))
        return F.struct(
            status.alias("status"), F.col("event_type").alias("domain_source"),
            F.lit(dataset).alias("dataset_name"), files.alias("output_paths"))
    ok = F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "view", "completed").otherwise("COMPLETED")
    second = F.when(F.col("user_id") % 3 == 0, "SKIPPED").otherwise("Completed")
    return table(spark, sf_dir, "events").select(
        text(F.col("event_id")).alias("correlation_id"), F.lit("COMPLETED").alias("status"), F.lit("bronze").alias("etl_layer"),
        F.array(result(ok, "population", 2), result(second, "rd", 1)).alias("results"))


def summary_valid_paths(spark, sf_dir):
    return summaries.valid_output_paths(summaries.result_rows(event_summaries(spark, sf_dir)), ["population", "rd"])


def summary_validity(spark, sf_dir):
    """Whole-summary rule next to the wider rule for landing results."""
    runs = event_summaries(spark, sf_dir)
    return runs.select(
        "correlation_id",
        summaries.summary_is_valid(F.col("status"), F.col("results")).alias("run_valid"),
        F.size(F.filter("results", lambda r: summaries.is_landed(r["status"]))).alias("landed"))


def config_fingerprint(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    columns = ["c_name", "c_custkey", "c_nationkey", "c_mktsegment"]
    return customer.select("c_custkey", row_fingerprint(*columns, length=8).alias("config_hash"))


# ---- writes (into the folder the cluster shares)


def idempotent_landing(spark, sf_dir):
    """Two overlapping batches and a repeat of the second: every order lands once."""
    path, ledger = fresh_path(spark, "landing"), fresh_path(spark, "ledger")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("y"))
    def batch(years, run):
        return landing.as_batch(
            orders.filter(years), F.lit("ORDERS"), text(F.col("y")), F.lit("orders"), F.col("o_orderpriority"), run)
    for years, run in (("y <= 1998", "run-1"), ("y >= 1997", "run-2"), ("y >= 1997", "run-3")):
        known = landing.read_ledger(spark, ledger)
        landing.land(landing.not_yet_landed(batch(years, run), known, landing.BATCH), path, ledger)
    landed = files.read_json_lines(spark, path, batch("true", "").schema)
    return landed.select("o_orderkey", "o_custkey", "ingest_date", "config_hash", "run_id")


def idempotent_records(spark, sf_dir):
    """The same rule per record: content fingerprints decide what is new."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("y"))
    marked = orders.withColumn("hash", row_fingerprint("o_orderkey", "o_custkey", "o_orderstatus", "y"))
    first, second = marked.filter("y <= 1998"), marked.filter("y >= 1997")
    return first.unionByName(landing.not_yet_landed(second, first, ["hash"]))


def keyed_merge(spark, sf_dir):
    """The later half of the orders with a new price, merged twice."""
    orders = table(spark, sf_dir, "orders")
    batch = orders.filter(F.year("o_orderdate") >= 1998).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    once = sinks.keyed_merge(orders, batch, ["o_orderkey"])
    path = fresh_path(spark, "merged")
    sinks.write_table(once, path)
    return sinks.keyed_merge(files.read_table(spark, path), batch, ["o_orderkey"])


def latest_per_key(spark, sf_dir):
    """The last event of every user and type."""
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return sinks.latest_per_key(events, ["user_id", "event_type"], "event_id")


def merge_partitions(spark, sf_dir):
    """A stored table by year; the merge rewrites two of its folders and adds none."""
    path = fresh_path(spark, "by_year")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    sinks.write_table(orders, path, partition_cols=["year"])
    batch = orders.filter("year in (1996, 2000)").filter("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("X"))
    sinks.merge_partitions(spark, path, batch, ["o_orderkey", "year"], ["year"])
    return files.read_table(spark, path)


def partition_overwrite(spark, sf_dir):
    path = fresh_path(spark, "partitions")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    sinks.write_table(orders, path, partition_cols=["year"])
    redone = orders.filter("year = 1997 and o_custkey % 2 = 0")
    sinks.write_table(redone, path, mode=sinks.OVERWRITE_PARTITIONS, partition_cols=["year"])
    return files.read_table(spark, path)


def schema_evolving_append(spark, sf_dir):
    """A second batch brings a new column; the stored table then has it everywhere."""
    path = fresh_path(spark, "evolving")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    more = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("p_partkey"), F.col("s_name").alias("p_name"), F.col("s_nationkey").alias("nation"))
    sinks.write_table(parts, path)
    sinks.write_table(more, path, mode=sinks.APPEND)
    return files.read_table(spark, path, merge_schema=True)


def append_evolving(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    more = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("p_partkey"), F.col("c_nationkey").alias("nation"))
    return sinks.append_evolving(parts, more)


def format_round_trip(spark, sf_dir):
    """Customers through CSV, JSON and parquet and back."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    base = fresh_path(spark, "formats")
    where = {fmt: sinks.table_path(base, "bronze", fmt) for fmt in ("csv", "json", "parquet")}
    for fmt, path in where.items():
        sinks.write_table(customer, path, fmt, options={"header": True} if fmt == "csv" else None)
    back = {
        "csv": files.read_csv(spark, where["csv"], customer.schema),
        "json": files.read_json_lines(spark, where["json"], customer.schema),
        "parquet": files.read_table(spark, where["parquet"]),
    }
    result = None
    for fmt, df in back.items():
        marked = files.with_lineage(df, RUN).withColumn("format", F.lit(fmt))
        result = marked if result is None else result.unionByName(marked)
    return result


def persist_counts(spark, sf_dir):
    """Stored models and the row counts observed while writing them; the empty one is skipped."""
    base = fresh_path(spark, "models")
    orders = table(spark, sf_dir, "orders")
    models = {"orders": orders, "open_orders": orders.filter("o_orderstatus = 'O'"), "none": orders.filter("o_orderkey < 0")}
    records = {
        name: sinks.persist_model(df, name, sinks.table_path(base, "silver", name), RUN) for name, df in models.items()}
    stored = None
    for name, df in models.items():
        record = records[name]
        rows = df if record["status"] == contract.SKIPPED else files.read_table(spark, record["output_path"])
        counted = rows.agg(F.count("*").alias("stored_rows")).select(
            F.lit(name).alias("model"), F.lit(record["status"]).alias("status"),
            F.lit(record["record_count"]).cast("long").alias("record_count"), "stored_rows")
        stored = counted if stored is None else stored.unionByName(counted)
    return stored


def _event_stream(spark, sf_dir, files_per_batch: int = 1000) -> DataFrame:
    """Events as a stream of their files, whether the table is one file or a folder of them."""
    schema = table(spark, sf_dir, "events").schema
    return stream.new_files(spark, f"{sf_dir}/events.parque[t]", schema, "parquet", files_per_batch)


def incremental_landing(spark, sf_dir):
    """Events as a file stream, drained twice: the second drain finds nothing new."""
    path, checkpoint = fresh_path(spark, "stream"), fresh_path(spark, "stream-checkpoint")
    for _ in range(2):
        stream.drain(_event_stream(spark, sf_dir), checkpoint, stream.append_sink(path))
    return files.read_table(spark, path).drop("batch_id")


def incremental_upsert(spark, sf_dir):
    """Events in many files, newest first, merged a third of the files per batch into a row per user and type.

    Drained twice from the start: replayed and late rows change nothing.
    """
    path, folder = fresh_path(spark, "upsert"), fresh_path(spark, "events")
    columns = ["event_type", "user_id", "event_id", "value"]
    events = table(spark, sf_dir, "events")
    newest = events.agg(F.max("event_id")).scalar()
    for part in range(3):  # the third with the largest ids lands first; least() is 2 for NULL ids
        third = F.least(F.floor((newest - F.col("event_id")) * 3 / (newest + 1)), F.lit(2))
        events.where(third == part).write.mode("append").parquet(folder)
    per_batch = max(1, len(spark.read.schema(events.schema).parquet(folder).inputFiles()) // 3)
    sink = stream.upsert_sink(path, ["event_type", "user_id"], "event_id", ["event_type"], lambda df: df.select(*columns))
    for _ in range(2):
        landed = stream.new_files(spark, folder, events.schema, "parquet", files_per_batch=per_batch)
        stream.drain(landed, fresh_path(spark, "upsert-checkpoint"), sink)
    return files.read_table(spark, path)


QUERIES = {
    "flatten_indicator": flatten_indicator_query,
    "project_by_dataset": project_by_dataset,
    "explode_awards": explode_awards,
    "array_files": array_files,
    "inferred_lines": inferred_lines,
    "laureate_lines": laureate_lines,
    "silver_inputs": silver_inputs,
    "unpivot_years": unpivot_years_query,
    "safe_cast_positive": safe_cast_positive,
    "resident_split": resident_split,
    "flatten_patents": flatten_patents_query,
    "normalise_names": normalise_names,
    "normalise_texts": normalise_texts,
    "entity_presence_flags": entity_presence_flags,
    "country_master": country_master,
    "conform_inner": conform_inner,
    "conform_by_name": conform_by_name,
    "agg_then_join": agg_then_join,
    "distinct_count_by_group": distinct_count_by_group,
    "year_dim": year_dim,
    "entity_dim": entity_dim,
    "scaffold_grid": scaffold_grid,
    "panel_left_joins": panel_left_joins,
    "panel_union_long": panel_union_long,
    "customer_panel_left_joins": customer_panel_left_joins,
    "customer_panel_union_long": customer_panel_union_long,
    "per_capita_ratios": per_capita_ratios,
    "log1p_minmax": log1p_minmax_query,
    "sub_indices": sub_indices,
    "composite_index": composite_index,
    "customer_composite_index": customer_composite_index,
    "rank_by_year": rank_by_year,
    "top_k_by_year": top_k_by_year,
    "fact_innovation": fact_innovation,
    "duplicate_keys": duplicate_keys,
    "missing_inputs": missing_inputs,
    "audit_counts": audit_counts,
    "status_rollup": status_rollup,
    "lake_uri": lake_uri,
    "envelope_records": envelope_records,
    "raw_page_records": raw_page_records,
    "keyed_envelope_records": keyed_envelope_records,
    "source_routing": source_routing,
    "summary_valid_paths": summary_valid_paths,
    "summary_validity": summary_validity,
    "config_fingerprint": config_fingerprint,
    "idempotent_landing": idempotent_landing,
    "idempotent_records": idempotent_records,
    "keyed_merge": keyed_merge,
    "latest_per_key": latest_per_key,
    "merge_partitions": merge_partitions,
    "partition_overwrite": partition_overwrite,
    "schema_evolving_append": schema_evolving_append,
    "append_evolving": append_evolving,
    "format_round_trip": format_round_trip,
    "persist_counts": persist_counts,
    "incremental_landing": incremental_landing,
    "incremental_upsert": incremental_upsert,
}
