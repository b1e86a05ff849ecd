"""All queries over the given tables, and their SQL: name -> function of (spark, sf_dir), name -> text."""

from panelwright.plans import oracle, queries, upkeep, upkeep_sql

QUERIES = {**queries.QUERIES, **upkeep.UPKEEP}
ORACLE = {**oracle.ORACLE, **upkeep_sql.UPKEEP_SQL}
