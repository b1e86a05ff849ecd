"""Explicit read schemas as DDL. Nested pruning reads only the fields a plan touches."""

# Field names and types of the source files.

INDICATOR = """
    indicator STRUCT<id: STRING, value: STRING>,
    country STRUCT<id: STRING, value: STRING>,
    countryiso3code STRING,
    date STRING,
    value DOUBLE,
    unit STRING,
    obs_status STRING,
    decimal INT
"""

_TEXT = "STRUCT<en: STRING, se: STRING, no: STRING>"
_PLACE = (
    f"STRUCT<city: {_TEXT}, country: {_TEXT}, cityNow: {_TEXT}, countryNow: {_TEXT}, "
    f"continent: {_TEXT}, locationString: {_TEXT}, latitude: STRING, longitude: STRING, "
    "sameAs: ARRAY<STRING>>"
)
_LIFE_EVENT = f"STRUCT<date: STRING, place: {_PLACE}>"
_LINKS = "ARRAY<MAP<STRING, STRING>>"
_AFFILIATION = (
    f"STRUCT<name: {_TEXT}, nameNow: {_TEXT}, city: {_TEXT}, country: {_TEXT}, "
    f"locationString: {_TEXT}, cityNow: {_PLACE}, countryNow: {_PLACE}, continent: {_TEXT}>"
)
_PRIZE = (
    f"STRUCT<awardYear: STRING, category: {_TEXT}, categoryFullName: {_TEXT}, sortOrder: STRING, "
    f"portion: STRING, dateAwarded: STRING, prizeStatus: STRING, motivation: {_TEXT}, "
    f"prizeAmount: BIGINT, prizeAmountAdjusted: BIGINT, affiliations: ARRAY<{_AFFILIATION}>, "
    f"links: {_LINKS}>"
)

LAUREATE = f"""
    id STRING,
    knownName {_TEXT},
    givenName {_TEXT},
    familyName {_TEXT},
    fullName {_TEXT},
    fileName STRING,
    gender STRING,
    birth {_LIFE_EVENT},
    death {_LIFE_EVENT},
    wikipedia MAP<STRING, STRING>,
    wikidata MAP<STRING, STRING>,
    sameAs ARRAY<STRING>,
    links {_LINKS},
    nobelPrizes ARRAY<{_PRIZE}>
"""

RUN_SUMMARY = """
    status STRING,
    env STRING,
    etl_layer STRING,
    correlation_id STRING,
    timestamp STRING,
    processed_items BIGINT,
    processed_models BIGINT,
    duration_in_ms BIGINT,
    results ARRAY<STRUCT<
        status: STRING,
        correlation_id: STRING,
        duration_in_ms: BIGINT,
        record_count: BIGINT,
        domain_source: STRING,
        domain_source_type: STRING,
        dataset_name: STRING,
        message: STRING,
        output_paths: ARRAY<STRING>,
        start_time: STRING,
        end_time: STRING,
        model: STRING,
        output_path: STRING,
        operation_type: STRING,
        error_details: MAP<STRING, STRING>>>
"""

# Dataset name to schema; the five indicators share one.
BY_DATASET = {
    "laureates": LAUREATE,
    "population": INDICATOR,
    "pkb": INDICATOR,
    "rd": INDICATOR,
    "researchers": INDICATOR,
    "unemployment": INDICATOR,
}
