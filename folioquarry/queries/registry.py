"""A module's queries and their SQL, filled by a decorator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None) -> Callable[[Query], Query]:
        def add(f: Query) -> Query:
            self.queries[f.__name__] = f
            if sql:
                self.sql[f.__name__] = sql
            return f

        return add


#: Layout rows of documents in DuckDB: blocks, cells and tables as in sources.layout_text.
FIXTURES = """
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM documents),
blocks AS (SELECT doc_id, CAST(line_no // 40 AS INT) AS page_index, CAST(line_no AS INT) AS line_no, text, CAST(10 + (line_no % 2) * 300 AS INT) AS x,
  CAST((line_no % 40) * 20 + (doc_id * 7 + line_no * 3) % 9 AS INT) AS y, CAST(8 * length(text) AS INT) AS w, 16 AS h FROM lines WHERE trim(text) <> ''),
parts AS (SELECT doc_id, page_index, line_no AS row_index, x, y, unnest(string_split(text, ' | ')) AS text, unnest(range(len(string_split(text, ' | ')))) AS col_index
  FROM blocks WHERE contains(text, ' | ')),
cells AS (SELECT doc_id, page_index, row_index, CAST(col_index AS INT) AS col_index, text, CAST(x + col_index * 120 AS INT) AS x, y, 120 AS w, 16 AS h FROM parts),
tables AS (SELECT doc_id, page_index, min(x) AS x, min(y) AS y, max(x + w) - min(x) AS w, max(y + h) - min(y) AS h FROM cells GROUP BY 1, 2)"""

#: The match key of a text without ideographs, in DuckDB.
KEY = r"""replace(lower(regexp_replace({0}, '[\s,.;:!?，。；：！？、（）()\[\]【】<>《》“”"''‘’\-—_＿/\\]+', '', 'g')), 'ß', 'ss')"""
#: White space collapsed and trimmed, in DuckDB.
ONE = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"


def not_redundant(name: str, rows: str, by: str) -> str:
    """CTEs, in DuckDB, of the texts (t, numbered n from 1 within ``by``) that those kept so far do not make redundant; ``name`` has them as a list, out."""
    units = f"list_filter(list_transform(string_split_regex(t, '[\\n\\r\\t,;:!?，。；：！？、（）()【】\\[\\]<>《》]+'), lambda u: {KEY.format('u')}), lambda u: length(u) >= 4)"
    on = " AND ".join(f"i.{c.strip()} = s.{c.strip()}" for c in by.split(","))
    held = "i.key = k OR length(i.key) >= 12 AND contains(k, i.key) OR length(k) >= 12 AND contains(i.key, k)"
    gone = f"(i.key = '' OR len(list_filter(s.keys, lambda k: {held})) > 0 OR len(i.units) > 0 AND len(s.units) > 0 AND len(list_intersect(list_distinct(i.units), s.units)) / len(list_distinct(i.units))::DOUBLE >= 0.82::DOUBLE)"
    mine = ", ".join(f"i.{c.strip()}" for c in by.split(","))
    return f"""{name}i AS (SELECT {by}, n, t, {KEY.format("t")} AS key, list_distinct(list_concat({units}, CASE WHEN length({KEY.format("t")}) BETWEEN 4 AND 40 THEN [{KEY.format("t")}] ELSE [] END)) AS units FROM {rows}),
{name}s AS (SELECT DISTINCT {by}, CAST(0 AS BIGINT) AS n, CAST([] AS VARCHAR[]) AS keys, CAST([] AS VARCHAR[]) AS units, CAST([] AS VARCHAR[]) AS out FROM {name}i UNION ALL
  SELECT {mine}, i.n, CASE WHEN {gone} THEN s.keys ELSE list_append(s.keys, i.key) END, CASE WHEN {gone} THEN s.units ELSE list_distinct(list_concat(s.units, i.units)) END, CASE WHEN {gone} THEN s.out ELSE list_append(s.out, i.t) END
  FROM {name}s s JOIN {name}i i ON {on} AND i.n = s.n + 1),
{name} AS (SELECT {by}, arg_max(out, n) AS out FROM {name}s GROUP BY {by})"""


#: What T.strip takes off an ASCII text, in DuckDB.
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || chr(160)"
