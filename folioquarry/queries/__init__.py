"""Every query by name, with the SQL that checks it where SQL can say the same."""

from . import coerce, contracts, layout, markup, pages, readers, recognition, refinement, repairs, reports, retrieval

QUERIES: dict = {}
ORACLE_SQL: dict = {}
for module in (layout, pages, refinement, reports, coerce, readers, contracts, repairs, retrieval, markup, recognition):
    QUERIES |= module.QUERIES
    ORACLE_SQL |= module.ORACLE_SQL
