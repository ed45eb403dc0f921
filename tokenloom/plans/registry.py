"""Every query of the reference's operators and its DuckDB twin."""

from tokenloom.plans import chain_oracle, chains, growth, growth_oracle, oracle, queries

QUERIES = {**queries.QUERIES, **chains.QUERIES, **growth.QUERIES}
ORACLE = {**oracle.ORACLE, **chain_oracle.ORACLE, **growth_oracle.ORACLE}
