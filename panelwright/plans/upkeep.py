"""Queries over tables that are kept up to date: events, maintained indexes, mergeable counts, raw layouts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright import contract
from panelwright.operators import audit, bitmaps, buckets, dependencies, sinks
from panelwright.operators.flatten import flatten_indicator
from panelwright.operators.maintained import MaintainedIndex
from panelwright.operators.panel import panel_by_joins
from panelwright.plans import given_tables as given
from panelwright.plans import gold
from panelwright.plans.given_tables import KEYS, table
from panelwright.plans.queries import INDICES, raw_indicators, rounded, stored_customer_panel
from panelwright.session import fresh_path, stored
from panelwright.sources import files, quarantine, schemas, shapes, split_arrays
from panelwright.streaming import event_time
from panelwright.streaming import landing as stream


def _deliveries(spark, sf_dir) -> DataFrame:
    """Events up to six hours after their time, one in five twice; some without a key or a time."""
    events = table(spark, sf_dir, "events").select(
        F.when(F.col("event_id") % 97 != 0, F.col("event_id")).alias("event_id"), "event_type", "value",
        F.when(F.col("event_id") % 89 != 0, F.col("ts").cast("timestamp")).alias("event_time"),
        F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("n"))
    hours = F.when(F.col("n") % 5 == 0, F.array(F.col("n") % 7, F.col("n") % 4 + 1)).otherwise(F.array(F.col("n") % 7))
    came = events.select("*", F.explode(hours).alias("lag"))
    return came.select(
        "event_id", "event_type", "value", "event_time", (F.col("at") + F.make_interval(hours="lag")).alias("arrival"))


def _late_events(spark, sf_dir, files_per_batch: int = 1000) -> tuple[DataFrame, DataFrame]:
    """Events once each, and the deliveries set aside, from files that come quarter by quarter of the time."""
    deliveries = _deliveries(spark, sf_dir)
    first, last = deliveries.agg(F.min(F.unix_seconds("arrival")), F.max(F.unix_seconds("arrival"))).first()
    quarter = ((last or 0) - (first or 0)) // 4 + 1
    numbered = fresh_path(spark, "deliveries")
    number = F.floor((F.unix_seconds("arrival") - (first or 0)) / quarter).cast("int")
    sinks.write_table(deliveries.withColumn("quarter", number), numbered, partition_cols=["quarter"])
    folder = fresh_path(spark, "delivered")
    for k in range(4):
        part = spark.read.parquet(numbered).where(F.col("quarter") == k).drop("quarter")
        part.write.mode("append").parquet(folder)
    landed = stream.new_files(spark, folder, deliveries.schema, "parquet", files_per_batch)
    once = event_time.once_in_time(landed, ["event_id"], "event_time", "arrival", "3 hours", f"{quarter} seconds")
    path, aside, checkpoint = (fresh_path(spark, n) for n in ("events-once", "events-aside", "events-checkpoint"))
    for _ in range(2):  # the second time finds nothing new
        stream.drain(once, checkpoint, event_time.split_sink(path, aside))
    return files.read_table(spark, path).drop("batch_id"), files.read_table(spark, aside).drop("batch_id")


def late_events(spark, sf_dir):
    """Out-of-order and repeated deliveries: each event once, late ones set aside with their reason."""
    once, aside = _late_events(spark, sf_dir)
    return once.unionByName(aside).select("event_id", "event_type", "value", "status")


def late_event_counts(spark, sf_dir):
    """The side table in numbers; the events come in more and smaller batches."""
    return event_time.set_aside_counts(_late_events(spark, sf_dir, 2)[1], ["event_type"])


# ---- an index over batches


def maintained_customer_index(spark) -> MaintainedIndex:
    """The composite index of a panel in folders by year."""
    return MaintainedIndex(
        spark, fresh_path(spark, "index"), KEYS, ["year"], list(contract.SCALED), gold.with_ratios,
        lambda scaled: gold.with_score(gold.with_sub_indices(scaled)),
    )


def maintained_index(spark, sf_dir):
    """Customers in three batches: most of them, the others, and changes to some of both."""
    panel, kept = stored_customer_panel(spark, sf_dir), maintained_customer_index(spark)
    changed = panel.where("entity % 10 = 1 AND year % 2 = 0").withColumns({
        "researchers_count": F.lit(None).cast("double"), "gdp": F.col("gdp") / 2})
    for batch in (panel.where("entity % 3 <> 0"), panel.where("entity % 3 = 0"), changed):
        kept.apply(batch)
    return rounded(kept.scores().select(*KEYS, *INDICES, contract.SCORE), 6)


# ---- distinct counts that merge


def buyer_bitmaps(spark, sf_dir) -> DataFrame:
    """Customers per order status and day, stored; two parts of the orders, united."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderstatus", F.unix_date(F.col("o_orderdate").cast("date")).alias("day"), "o_custkey",
        F.month("o_orderdate").alias("month"))
    halves = [bitmaps.id_bitmaps(orders.where(m), ["o_orderstatus", "day"], F.col("o_custkey")) for m in ("month <= 6", "month > 6")]
    return stored(halves[0].unionByName(halves[1]), "bitmaps")


def distinct_over_days(spark, sf_dir):
    """Distinct customers per status, from daily bitmaps: per day, in the 30 days up to it, and of all days."""
    daily = buyer_bitmaps(spark, sf_dir)
    day = bitmaps.distinct_counts(daily, ["o_orderstatus", "day"], "of_day")
    month = bitmaps.trailing_counts(daily, ["o_orderstatus"], "day", 30, "of_30_days")
    whole = bitmaps.distinct_counts(daily, ["o_orderstatus"], "of_all")
    return day.join(month, ["o_orderstatus", "day"]).join(whole, "o_orderstatus")


def distinct_texts_over_turns(spark, sf_dir):
    """Members that are texts: first words of conversation turns, numbered, per role over the turns up to each."""
    words = table(spark, sf_dir, "conversations").select(
        "role", "turn", F.lower(F.regexp_extract("text", r"^\S+", 0)).alias("word")).where("word <> ''")
    words = stored(words, "words")
    known = bitmaps.with_numbers(words, bitmaps.numbered(words, "word"), "word")
    by_turn = bitmaps.id_bitmaps(known, ["role", "turn"], F.col("number"))
    return bitmaps.trailing_counts(by_turn, ["role"], "turn", 3, "n_words")


# ---- raw layouts


def one_array_file(spark, sf_dir) -> str:
    """All indicator records as a single JSON array in a single file, so written by one task, as they come.

    The first and the last element get the brackets. One element is an empty object: there is
    always one to open the array.
    """
    path = fresh_path(spark, "one-array")
    lines = raw_indicators(spark, sf_dir)
    elements = spark.range(1).select(F.lit("{}").alias("value")).union(lines.select(F.to_json(F.struct(*lines.columns))))
    last = lines.count()
    numbered = elements.coalesce(1).select("value", F.monotonically_increasing_id().alias("n"))
    opens = F.when(F.col("n") == 0, "[").otherwise(" ,")
    closes = F.when(F.col("n") == last, "\n]").otherwise("")
    numbered.select(F.concat(opens, "value", closes).alias("value")).write.option("lineSep", "\n").text(path)
    return path


def split_array_file(spark, sf_dir):
    """One large array file, read by many tasks: the records of ``flatten_indicator``."""
    raw = split_arrays.read_split_array(spark, one_array_file(spark, sf_dir), schemas.INDICATOR)
    return flatten_indicator(raw.where("date IS NOT NULL"), "population").withColumnRenamed(contract.ISO, "iso")


def mixed_pages(spark, sf_dir) -> DataFrame:
    """Orders and conversation turns as pages of six shapes; names and types of fields differ between them."""
    k = F.col("o_orderkey")
    first = F.to_json(F.struct(k.alias("id"), F.col("o_totalprice").alias("total"), F.col("o_orderstatus").alias("state")))
    other = F.to_json(F.struct(
        k.cast("string").alias("orderKey"), F.col("o_totalprice").cast("string").alias("amount"),
        F.struct(F.col("o_orderstatus").alias("code")).alias("status")))
    page = (
        F.when(k % 6 == 0, F.format_string('[{"page": 1}, [%s, %s]]', first, other))
        .when(k % 6 == 1, F.format_string('{"data": [%s]}', other))
        .when(k % 6 == 2, F.format_string("[%s, %s]", other, first))
        .when(k % 6 == 3, first).when(k % 6 == 4, F.format_string('{"page": {"n": 1}, "results": [%s, 5]}', first))
        .otherwise(F.concat(F.lit("<html>"), first))
    )
    orders = table(spark, sf_dir, "orders").select(F.lit("orders").alias("dataset"), k.alias("n"), page.alias("page"))
    turn = F.to_json(F.struct(F.col("turn").alias("id"), F.length("text").alias("total"), F.col("role").alias("state")))
    turns = table(spark, sf_dir, "conversations").select(
        F.lit("turns").alias("dataset"), F.col("conv_id").alias("n"), F.format_string('{"items": [%s]}', turn).alias("page"))
    return orders.unionByName(turns)


def variant_records(spark, sf_dir):
    """Records out of pages of any shape, with fields under whatever name and type they came."""
    records = shapes.records_of_any_page(mixed_pages(spark, sf_dir), "page", keep=("dataset", "n"))
    return records.select(
        "dataset", "n", shapes.field("record", ["$.id", "$.orderKey"], "bigint").alias("id"),
        shapes.field("record", ["$.total", "$.amount"], "double").alias("total"),
        shapes.field("record", ["$.state", "$.status.code"], "string").alias("state"),
    )


def variant_shapes(spark, sf_dir):
    """What the pages of each dataset looked like: how many could not be read, and the fields of the records."""
    pages = mixed_pages(spark, sf_dir)
    records = shapes.records_of_any_page(pages, "page", keep=("dataset",))
    bad = shapes.unreadable_pages(pages, "page").groupBy("dataset").agg(F.count("*").alias("n_unreadable"))
    shape = shapes.observed_shape(records, "record", ["dataset"])
    # How wide the decimals are depends on the values.
    plain = F.regexp_replace("shape", r"DECIMAL\(\d+,\d+\)", "DECIMAL").alias("shape")
    return shape.join(bad, "dataset", "left").select(
        "dataset", F.coalesce("n_unreadable", F.lit(0)).alias("n_unreadable"), plain)


EVENT = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"


def bad_records(spark, sf_dir):
    """Events as JSON lines, some torn, some of another type or no records: good rows and what was set aside."""
    n = F.col("event_id")
    whole = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    line = (
        F.when(n % 40 == 0, F.substring(whole, 1, 30)).when(n % 40 == 1, F.format_string('{"event_id":%s,"value":"n/a"}', n))
        .when(n % 40 == 2, F.format_string("[%s]", n)).when(n % 40 == 3, "").otherwise(whole)
    )
    path, aside = fresh_path(spark, "lines"), fresh_path(spark, "quarantine")
    table(spark, sf_dir, "events").select(line.alias("value")).write.text(path)
    rows = quarantine.set_aside(quarantine.checked_lines(spark, path, EVENT), aside, "run-1", "events")
    found = quarantine.quarantined(spark, aside)
    number = F.regexp_extract("text", r"(\d+)", 1).cast("long").alias("event_id")
    return rows.select("event_id", "event_type", "value", F.lit(None).cast("string").alias("reason")).unionByName(
        found.select(number, "reason"), allowMissingColumns=True)


# ---- models and what they need


def build_status(spark, sf_dir):
    """Customers as models: each needs the one with half its number; some fail, stand in circles or need what is not there."""
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("model"), "c_acctbal")
    m = F.col("model")
    needs = F.array_compact(F.array(
        F.when(m > 1, F.floor(m / 2)), F.when(m % 50 == 27, 2 * m), F.when(m % 97 == 61, -m)))
    edges = customers.select("model", F.explode(needs).alias("needs"))
    # The circle's other half may be above the last number: then it is an input that is missing.
    return dependencies.build_status(customers, edges, customers.where("c_acctbal < -900 AND model > 16"))


# ---- written once


AUDITED = {"orders": ["o_orderkey"], "lineitem": ["l_orderkey"], "customer": ["c_custkey"], "events": ["user_id", "event_type"]}


def write_audit(spark, sf_dir):
    """Models written with their audit in the same pass; some columns have NULLs, some keys repeat."""
    base, records, columns = fresh_path(spark, "audited"), [], {}
    for name, keys in AUDITED.items():
        df = table(spark, sf_dir, name)
        gaps = {c: F.when(F.col(keys[0]) % 7 != 0, F.col(c)) for c in df.columns[2:4]}
        df = df.withColumns(gaps)
        columns[name] = df.columns
        metrics = audit.write_metrics(df.columns, keys)
        records.append(sinks.persist_model(df, name, sinks.table_path(base, "silver", name), "run-1", metrics=metrics))
    return audit.audit_of_writes(spark, records, columns)


# ---- stored in buckets


def bucketed_inputs(spark, sf_dir) -> tuple[DataFrame, list]:
    """Grid and measures of the customer panel, stored in buckets by entity and year."""
    grid = buckets.write_bucketed(given.customer_grid(spark, sf_dir), fresh_path(spark, "bucketed-grid"), KEYS)
    inputs = [
        (buckets.write_bucketed(frame, fresh_path(spark, "bucketed-input"), KEYS), measures)
        for frame, measures in given.customer_inputs(spark, sf_dir)
    ]
    return grid, inputs


def bucketed_panel(spark, sf_dir):
    """The panel of ``customer_panel_left_joins`` from bucketed inputs: no exchange, however often it is built."""
    grid, inputs = bucketed_inputs(spark, sf_dir)
    return rounded(panel_by_joins(grid, inputs, KEYS), 6)


def bucketed_upsert(spark, sf_dir):
    """The later half of the orders with a new price, merged twice into a bucketed table."""
    orders = table(spark, sf_dir, "orders")
    batch = orders.filter(F.year("o_orderdate") >= 1998).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    current = buckets.write_bucketed(orders, fresh_path(spark, "bucketed-orders"), ["o_orderkey"])
    once = buckets.bucketed_merge(current, batch, ["o_orderkey"])
    again = buckets.write_bucketed(once, fresh_path(spark, "bucketed-orders"), ["o_orderkey"])
    return buckets.bucketed_merge(again, batch, ["o_orderkey"])


UPKEEP = {
    "bucketed_panel": bucketed_panel,
    "bucketed_upsert": bucketed_upsert,
    "write_audit": write_audit,
    "bad_records": bad_records,
    "variant_records": variant_records,
    "variant_shapes": variant_shapes,
    "build_status": build_status,
    "split_array_file": split_array_file,
    "distinct_over_days": distinct_over_days,
    "distinct_texts_over_turns": distinct_texts_over_turns,
    "maintained_index": maintained_index,
    "late_events": late_events,
    "late_event_counts": late_event_counts,
}
