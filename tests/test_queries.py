"""Every query of the library with SQL gives the rows of the SQL; those without run and give rows."""

import pytest

from folioquarry.functions import text as T
from folioquarry.queries import ORACLE_SQL, QUERIES

from .compare import against_sql


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    ours, theirs = against_sql(QUERIES[name](spark, sf_dir), ORACLE_SQL[name], sf_dir)
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_gives_rows(spark, sf_dir, name):
    assert not QUERIES[name](spark, sf_dir).isEmpty()


def test_entry_is_lazy_and_stable(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == entry.entry(spark).columns
    assert df.limit(1).count() == 1


def test_every_sql_has_a_query():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entities_that_a_cut_leaves_open(spark, tmp_path):
    """names without a semicolon, as the SQL reads them."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    htmls = ["a &quot", "<p>&quot b</p>&copy", "&middot<br>&middot;", "&amp", "&ampquot; &amp;amp; &amp;quot;", "&am &a & &quo", "x&copyright &copy;&quot;y&quot;", "&ampx;&amp&amp;", "", None]
    pq.write_table(pa.table({"page_id": range(len(htmls)), "html": htmls}), tmp_path / "pages.parquet")
    ours, theirs = against_sql(QUERIES["html_to_text_with_entities"](spark, str(tmp_path)), ORACLE_SQL["html_to_text_with_entities"], str(tmp_path))
    assert ours == theirs
    rows = spark.createDataFrame([("&lt;&#65;&#x42;&hearts;&nope; &lt &#65 &AMP; &quot",)], "t string")
    assert rows.select(T.unescape_ended("t"), T.unescape("t")).first()[:] == ("<AB♥&nope; &lt &#65 & &quot", '<AB♥&nope; < A & "')


def test_seconds_per_page_of_odd_values(spark, tmp_path):
    """missing, infinite and very large values, with keys of each kind."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    values = [None, float("inf"), -float("inf"), float("nan"), -1.25, 0.0, 32.5245, 1.253764104716614e303 * 3, 1.7e308]
    rows = [(56 * (i + 1) + k, v) for i, v in enumerate(values) for k in range(56)] + [(-1 - k, 2.5) for k in range(8)] + [(None, 2.5)]
    pq.write_table(pa.table({"event_id": [k for k, _ in rows], "value": pa.array([v for _, v in rows], pa.float64())}), tmp_path / "events.parquet")
    ours, theirs = against_sql(QUERIES["seconds_per_page"](spark, str(tmp_path)), ORACLE_SQL["seconds_per_page"], str(tmp_path))
    assert len(ours) == len(rows) and ours == theirs
