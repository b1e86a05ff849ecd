"""Names and numbers that outputs must carry.

Everything in this module is a FIXED VALUE: table names, column names, weights
and status words that existing consumers of these tables rely on. Generic
operators take names and weights as arguments; only ``plans`` reads this module.
"""

# Keys.
ISO = "ISO3166-1-Alpha-3"
YEAR = "year"
FIRST_YEAR = 1901

# Model names of the conformed layer and of the analytical layer.
SILVER_MODELS = (
    "COUNTRY",
    "YEAR",
    "NOBEL_LAUREATES",
    "GRADUATE_UNEMPLOYMENT",
    "PKB",
    "RD_EXPENDITURE",
    "RESEARCHERS",
    "PATENTS",
    "POPULATION",
)
GOLD_MODELS = ("dim_country", "dim_year", "fact_innovation")

# Name of the value column per indicator dataset.
INDICATOR_VALUE_COLUMN = {
    "population": "value",
    "unemployment": "unemployment_rate",
    "researchers": "value",
    "rd": "value",
    "pkb": "value",
}

# Which indicator dataset feeds which conformed model.
INDICATOR_MODEL_DATASET = {
    "POPULATION": "population",
    "PKB": "pkb",
    "RD_EXPENDITURE": "rd",
    "RESEARCHERS": "researchers",
    "GRADUATE_UNEMPLOYMENT": "unemployment",
}

# The source each dataset comes from.
DATASET_SOURCE = {
    "population": "WORLDBANK",
    "unemployment": "WORLDBANK",
    "researchers": "WORLDBANK",
    "rd": "WORLDBANK",
    "pkb": "WORLDBANK",
    "laureates": "NOBELPRIZE",
    "patents": "PATENTS",
}

# Measure columns of the fact, in output order.
MEASURES = (
    "population",
    "gdp",
    "rd_expenditure",
    "researchers_count",
    "graduate_unemployment_rate",
    "patents_total",
    "resident_patents",
    "abroad_patents",
    "nobel_laureates_count",
)

# The seven scaled columns, in output order.
SCALED = (
    "patents_per_million",
    "resident_patents_per_million",
    "nobelists_per_million",
    "patent_expansion_ratio",
    "researchers_per_million",
    "rd_gdp_pct",
    "graduate_unemployment_rate",
)

# Weights inside the sub-indices and of the final score.
PATENTS_WEIGHTS = {
    "patents_per_million_norm": 0.4,
    "resident_patents_per_million_norm": 0.3,
    "patent_expansion_ratio_norm": 0.3,
}
RESEARCH_WEIGHTS = {
    "researchers_per_million_norm": 0.6,
    "nobelists_per_million_norm": 0.4,
}
SCORE = "innovation_score_final"
SCORE_WEIGHTS = {
    "patents_index": 0.35,
    "research_index": 0.35,
    "rd_index": 0.2,
    "unemployment_index": 0.1,
}

# Result and run status words.
COMPLETED = "COMPLETED"
FAILED = "FAILED"
SKIPPED = "SKIPPED"
PARTIAL_SUCCESS = "PARTIAL_SUCCESS"
NO_RESULTS = "NO_RESULTS"
