"""One run per layer: read what the manifest names, build, store, leave a summary.

Models are lazy plans, so their order is plain Python; a model that fails is
recorded under its name and the others are still stored.
"""

import datetime
import time
import warnings
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelwright import contract
from panelwright.functions.keys import config_fingerprint
from panelwright.functions.paths import lake_uri
from panelwright.operators import landing
from panelwright.operators.flatten import flatten_indicator, flatten_laureates, flatten_patents
from panelwright.operators.quality import require_inputs, require_rows
from panelwright.operators.sinks import APPEND, persist_model, table_path, write_summary, write_table
from panelwright.plans import gold, silver
from panelwright.sources.envelopes import raw_records
from panelwright.sources.files import by_layout, read_by_extension, read_csv, read_landed, read_table
from panelwright.sources.quarantine import checked_arrays, checked_lines, set_aside
from panelwright.sources.schemas import BY_DATASET
from panelwright.sources.summaries import is_completed, result_rows, route_sources, valid_output_paths


def located(path: str, root: str) -> str:
    """Manifest paths are relative to ``root``; full locations stay as they are."""
    return path if "://" in path else f"{root.rstrip('/')}/{path.strip('/')}"


def land_source(
    spark: SparkSession, payload: dict, pages: DataFrame, root: str, run_id: str, day: str
) -> dict:
    """Land the records of one source's pages (column ``page``) once per day and configuration."""
    started = time.monotonic()
    source, dataset = payload["domain_source"], payload["dataset_name"]
    path, ledger = table_path(root, "bronze", "records"), table_path(root, "bronze", "ledger")
    batch = (source.lower(), day, dataset, config_fingerprint(payload))
    schema = ", ".join(f"{c} STRING" for c in landing.BATCH)
    coordinates = spark.createDataFrame([batch], schema)
    folder = landing.batch_folder(path, *batch)
    result = {
        "status": contract.COMPLETED, "correlation_id": run_id, "record_count": 0,
        "domain_source": source, "domain_source_type": payload["domain_source_type"], "dataset_name": dataset,
        "message": "No records.", "output_paths": [], "error_details": None,
    }
    known = landing.read_ledger(spark, ledger)
    if landing.not_yet_landed(coordinates, known, landing.BATCH).isEmpty():
        result.update(status=contract.SKIPPED, message="Landed before.", output_paths=[folder])
    else:
        records = raw_records(pages, "page", None if source == "WORLDBANK" else dataset)
        rows = Observation(f"records of {dataset}")
        counted = records.observe(rows, F.count(F.lit(1)).alias("n"))
        write_table(counted, folder, "text")
        if rows.get["n"] > 0:
            write_table(coordinates, ledger, mode=APPEND)
            result.update(record_count=rows.get["n"], message="Landed.", output_paths=[folder])
    result["duration_in_ms"] = int((time.monotonic() - started) * 1000)
    return result


def run_bronze(
    spark: SparkSession, manifest: dict, pages: dict[str, DataFrame], root: str, run_id: str, day: str,
    env: str = "dev",
) -> dict:
    """Landing layer: fetched pages per dataset to raw JSON lines and a summary of where they are.

    Pages are frames with one page of JSON text per row, however they were fetched.
    """
    results = []
    for source in manifest["sources"]:
        payload = source["source_config_payload"]
        try:
            results.append(land_source(spark, payload, pages[payload["dataset_name"]], root, run_id, day))
        except Exception as error:
            results.append({
                "status": contract.FAILED, "correlation_id": run_id, "record_count": 0, "duration_in_ms": 0,
                "domain_source": payload["domain_source"], "domain_source_type": payload["domain_source_type"],
                "dataset_name": payload["dataset_name"], "message": "Landing failed.", "output_paths": [],
                "error_details": {"error_message": repr(error)},
            })
    done = all(r["status"] in (contract.COMPLETED, contract.SKIPPED) for r in results)
    return leave_summary(spark, "bronze", "processed_items", results, done, root, run_id, env)


def leave_summary(
    spark: SparkSession, layer: str, counter: str, results: list[dict], done: bool, root: str, run_id: str, env: str
) -> dict:
    summary = {
        "status": contract.COMPLETED if done else contract.FAILED,
        "env": env,
        "etl_layer": layer,
        "correlation_id": run_id,
        "timestamp": datetime.datetime.now(datetime.timezone.utc).isoformat(),
        counter: len(results),
        "duration_in_ms": sum(r["duration_in_ms"] for r in results),
        "results": results,
    }
    write_summary(spark, summary, table_path(root, layer, f"outputs/summaries/{run_id}"))
    return summary


def readable(paths: list[str], read: Callable[[list[str]], DataFrame]) -> DataFrame | None:
    """One scan of the paths that can be opened; None if there are none."""
    kept = openable(paths, read)
    return read(kept) if kept else None


def openable(paths: list[str], read: Callable[[list[str]], DataFrame]) -> list[str]:
    kept = []
    for path in paths:  # a handful
        try:
            read([path])
            kept.append(path)
        except AnalysisException as error:
            warnings.warn(f"left out {path}: {error.getCondition()}", stacklevel=2)
    return kept


def source_routes(
    spark: SparkSession, manifest: dict, landing_summary: DataFrame, root: str
) -> dict[str, tuple[str, list[str]]]:
    """Origin and paths of each dataset that has any, by the one rule of ``route_sources``."""
    keys = ["domain_source", "dataset_name"]
    schema = ", ".join(f"{k} STRING" for k in keys)
    required = spark.createDataFrame([(s, d) for d, s in contract.DATASET_SOURCE.items()], schema)
    by_hand = [(p["domain_source"], p["dataset_name"], located(p["file_path"], root)) for p in manifest["manual_data_paths"]]
    manual = spark.createDataFrame(by_hand, f"{schema}, path STRING")
    uri = F.when(F.col("path").startswith("https://"), lake_uri(F.col("path"))).otherwise(F.col("path"))
    landed = valid_output_paths(result_rows(landing_summary), include_skipped=True).withColumn("path", uri)
    routes: dict[str, tuple[str, list[str]]] = {}
    # Paths of required datasets only, each once.
    for row in route_sources(required, manual, landed, keys).where("path IS NOT NULL").distinct().collect():
        routes.setdefault(row["dataset_name"], (row["origin"], []))[1].append(row["path"])
    return {name: (origin, sorted(paths)) for name, (origin, paths) in routes.items()}


def silver_sources(
    spark: SparkSession, manifest: dict, landing_summary: DataFrame, root: str, quarantine: str | None = None,
    run_id: str = "",
) -> dict[str, DataFrame | None]:
    """Flattened frame per dataset; manual paths win over landed ones, absent ones are None.

    A dataset is known by its source and its name (``contract.DATASET_SOURCE``), and
    ``route_sources`` decides where it is read from. All landed paths of a dataset are one
    scan. A path that cannot be read is left out with a warning, and a dataset of which nothing
    can be read counts as absent. With ``quarantine`` landed JSON records that cannot be read
    are set aside in that table; without it they are rows of NULLs, as in any JSON scan.
    """
    routes = source_routes(spark, manifest, landing_summary, root)

    def checked(name: str, paths: list[str]) -> DataFrame:
        scans = [
            scan(spark, part, BY_DATASET[name]) for scan, part in zip((checked_arrays, checked_lines), by_layout(spark, paths))
            if part
        ]
        both = scans[0] if len(scans) == 1 else scans[0].unionByName(scans[1])
        return set_aside(both, quarantine, run_id, name)

    def raw(name: str) -> DataFrame | None:
        origin, paths = routes.get(name, (None, []))
        if origin == "manual":
            return readable(paths, lambda paths: read_by_extension(spark, paths[0]))
        if name == "patents":
            return readable(paths, lambda paths: read_csv(spark, paths))
        kept = openable(paths, lambda paths: read_landed(spark, paths, BY_DATASET[name]))
        if not kept:
            return None
        return read_landed(spark, kept, BY_DATASET[name]) if quarantine is None else checked(name, kept)

    flatten = {"laureates": flatten_laureates, "patents": flatten_patents}
    frames = {}
    for name in [*BY_DATASET, "patents"]:
        frame = raw(name)
        frames[name] = None if frame is None else flatten.get(name, flatten_indicator)(frame, name)
    return frames


def silver_models(spark: SparkSession, country: DataFrame, sources: dict[str, DataFrame | None]) -> dict:
    """Model name to a function that gives its plan; called one by one by ``store``."""
    def source(name: str) -> DataFrame:
        return require_rows(sources[name], name)

    def indicator(dataset: str):
        return lambda: silver.indicator_model(source(dataset), country)

    models = {
        "COUNTRY": lambda: country,
        "YEAR": lambda: silver.year_model(spark),
        "NOBEL_LAUREATES": lambda: silver.laureates_model(source("laureates"), country),
        "PATENTS": lambda: silver.patents_model(source("patents"), country),
    }
    for model, dataset in contract.INDICATOR_MODEL_DATASET.items():
        models[model] = indicator(dataset)
    return models


def run_silver(
    spark: SparkSession, manifest: dict, landing_summary: DataFrame, root: str, run_id: str,
    quarantine: str | None = None, **writing
) -> dict:
    """Conformed layer. The country model is cached, because every other model joins it.

    ``quarantine`` is the place of the table for records that cannot be read.
    """
    sources = silver_sources(spark, manifest, landing_summary, root, quarantine, run_id)
    reference = read_by_extension(spark, located(manifest["references_tables"]["country_codes"], root))
    country = silver.country_model(
        reference, sources["population"], sources["patents"], sources["laureates"]
    ).persist()
    try:
        return store(spark, silver_models(spark, country, sources), "silver", root, run_id, **writing)
    finally:
        country.unpersist()


def gold_models(spark: SparkSession, manifest: dict, silver_summary: DataFrame, fmt: str = "parquet") -> dict:
    """Gold models over the tables that the summary of the conformed layer lists as completed."""
    completed = (
        result_rows(silver_summary).filter(is_completed(F.col("status"))).select("model", "output_path")
    )
    stored = {r["model"]: r["output_path"] for r in completed.collect()}  # one row per model

    def inputs(name: str) -> dict[str, DataFrame]:
        entry = next(e for e in [*manifest["dims"], *manifest["facts"]] if e["name"] == name)
        required = spark.createDataFrame([(m,) for m in entry["source_models"]], "model string")
        require_inputs(required, completed, "model", name)
        return {m: read_table(spark, stored[m], fmt) for m in entry["source_models"]}

    def year() -> DataFrame:
        inputs("dim_year")
        return gold.dim_year(spark)

    return {
        "dim_country": lambda: gold.dim_country(inputs("dim_country")["COUNTRY"]),
        "dim_year": year,
        "fact_innovation": lambda: gold.fact_innovation(inputs("fact_innovation")),
    }


def run_gold(
    spark: SparkSession, manifest: dict, silver_summary: DataFrame, root: str, run_id: str,
    fmt: str = "parquet", **writing,
) -> dict:
    """Analytical layer: the two dimensions and the fact."""
    models = gold_models(spark, manifest, silver_summary, fmt)
    return store(spark, models, "gold", root, run_id, fmt=fmt, **writing)


def store(
    spark: SparkSession,
    models: dict,
    layer: str,
    base: str,
    run_id: str,
    env: str = "dev",
    fmt: str = "parquet",
    partition_cols: dict[str, list[str]] | None = None,
) -> dict:
    """Write every model and the run summary; the summary is returned as well."""
    results = []
    for name, plan in models.items():
        try:
            path = table_path(base, layer, name)
            columns = (partition_cols or {}).get(name)
            results.append(persist_model(plan(), name, path, run_id, fmt, columns))
        except Exception as error:
            results.append({
                "model": name, "status": contract.FAILED, "output_path": "N/A", "correlation_id": run_id,
                "operation_type": "N/A", "record_count": 0, "duration_in_ms": 0,
                "error_details": {"error_message": str(error)},
            })
    done = all(r["status"] == contract.COMPLETED for r in results)
    return leave_summary(spark, layer, "processed_models", results, done, base, run_id, env)
