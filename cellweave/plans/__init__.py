"""Registered queries over the operators, with the SQL that each must match."""

from cellweave.plans import cube_queries, face_queries, grid_queries, layer_queries, outline_queries, repair_queries  # noqa: F401  the others add to the second


def queries():
    return dict(grid_queries.QUERIES)


def oracle_sql():
    return dict(grid_queries.SQL)
