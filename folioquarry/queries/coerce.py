"""Queries on value coercion, contract checks and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import geometry as G
from ..functions import text as T
from ..functions import values as V
from ..sources import files
from ..sources.files import read_table
from .registry import Registry

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql

_RAW = """r AS (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN '0.25' WHEN 1 THEN '7' WHEN 2 THEN 'abc' WHEN 3 THEN '-1' WHEN 4 THEN 'yes' ELSE ' Off ' END AS v FROM orders)"""


def _raw(spark, sf_dir):
    k = F.col("o_orderkey") % 6
    v = F.when(k == 0, "0.25").when(k == 1, "7").when(k == 2, "abc").when(k == 3, "-1").when(k == 4, "yes").otherwise(" Off ")
    return read_table(spark, f"{sf_dir}/orders.parquet").select("o_orderkey", v.alias("v"))


@query(f"""WITH {_RAW} SELECT o_orderkey, try_cast(v AS DOUBLE) AS number, CASE WHEN try_cast(v AS DOUBLE) BETWEEN 0 AND 1 THEN try_cast(v AS DOUBLE) END AS confidence,
  CASE WHEN lower(trim(v)) IN ('1', 'true', 'yes', 'y', 'on') THEN true WHEN lower(trim(v)) IN ('0', 'false', 'no', 'n', 'off') THEN false ELSE false END AS flag,
  CASE WHEN v IN ('7') THEN 7 END AS not_negative, CASE v WHEN '7' THEN 7 WHEN '-1' THEN -1 ELSE 5 END AS page_index FROM r""")
def coerced_values(spark, sf_dir):
    v = F.col("v")
    return _raw(spark, sf_dir).select(
        "o_orderkey", V.as_double(v).alias("number"), V.confidence(v).alias("confidence"), V.as_boolean(v).alias("flag"), V.not_negative(v).alias("not_negative"),
        V.page_index(v, F.lit(5)).alias("page_index"),
    )


@query("""SELECT o_orderkey, array_to_string(list_filter([
  CASE WHEN NOT (o_orderkey % 3 = 0) = (o_orderkey % 2 = 0) THEN 'V1' END, CASE WHEN o_orderkey % 10 < 4 THEN 'V2' END, CASE WHEN o_orderkey % 7 = 0 THEN 'V5' END,
  CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % 4 <> 0 THEN 'V7' END, CASE WHEN o_totalprice > 200000 THEN 'V10' END], lambda x: x IS NOT NULL), ',') AS violations FROM orders""")
def contract_violations(spark, sf_dir):
    k = F.col("o_orderkey")
    uri, inline = F.when(k % 3 == 0, "file:///a").otherwise(" "), F.when(k % 2 != 0, F.lit("{}"))
    checks = {
        "V1": S.one_payload(uri, inline), "V2": S.ordered(F.lit(4), (k % 10).cast("int")), "V5": S.placed(F.lit(1), F.when(k % 7 != 0, "pdf_points")),
        "V7": S.actor_known(F.when(k % 5 == 0, "user").otherwise("rule"), F.when(k % 4 == 0, "u1")), "V10": S.in_range(F.col("o_totalprice"), 0, 200000),
    }
    orders = read_table(spark, f"{sf_dir}/orders.parquet")
    return S.violations(orders.select("o_orderkey", "o_totalprice"), checks).select("o_orderkey", F.array_join("violations", ",").alias("violations"))


@query(r"""WITH n AS (SELECT c_custkey, 'data/in/' || CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'a b?c/' WHEN 2 THEN 'x/' || c_name || '/' ELSE replace(c_name, '#', '_') || '/' END AS folder, c_name,
  CASE c_custkey % 3 WHEN 0 THEN '.PDF' WHEN 1 THEN '.png' ELSE '.txt' END AS ext FROM customer), p AS (SELECT *, folder || c_name || ext AS path FROM n)
SELECT c_custkey, c_name AS stem, CASE c_custkey % 3 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'image/png' ELSE 'application/octet-stream' END AS media_type,
  c_custkey % 3 < 2 AS supported, c_custkey % 3 = 1 AS image, CASE c_custkey % 4 WHEN 0 THEN 'out/in' WHEN 1 THEN 'out/a b_c' WHEN 2 THEN 'out/x' ELSE 'out/' || replace(c_name, '#', '_') END AS target,
  'new/' || path[9:] AS moved, trim(regexp_replace(c_name, '[^A-Za-z0-9_.-]+', '_', 'g'), '._') AS doc_id, trim(regexp_replace(folder, '[<>:"/\|?*]+', '_', 'g'), ' ._') AS part FROM p""")
def file_names(spark, sf_dir):
    """T12, T13, T14, T15, K19 on paths made of names."""
    c = F.col("c_custkey")
    name = F.replace("c_name", F.lit("#"), F.lit("_"))
    folder = F.concat(F.lit("data/in/"), F.when(c % 4 == 0, "").when(c % 4 == 1, "a b?c/").when(c % 4 == 2, F.concat(F.lit("x/"), F.col("c_name"), F.lit("/"))).otherwise(F.concat(name, F.lit("/"))))
    path = F.concat(folder, F.col("c_name"), F.when(c % 3 == 0, ".PDF").when(c % 3 == 1, ".png").otherwise(".txt"))
    named = read_table(spark, f"{sf_dir}/customer.parquet").select("c_custkey", path.alias("path"), folder.alias("folder"))
    p = F.col("path")
    return named.select(
        "c_custkey", T.stem(p).alias("stem"), T.media_type(p).alias("media_type"), files.is_supported(p).alias("supported"), files.is_image(p).alias("image"),
        files.output_dir(p, "data/in", "out").alias("target"), T.moved(p, "data/in", "new").alias("moved"), T.safe_id(p).alias("doc_id"), T.safe_part(F.col("folder")).alias("part"),
    )


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, [CAST(l_quantity AS DOUBLE), CAST(l_linenumber AS DOUBLE), CAST(l_quantity AS DOUBLE) + 10.5::DOUBLE, CAST(l_linenumber AS DOUBLE) - 2.0::DOUBLE] AS c FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(round_even(c[1], 0) AS INT) AS x, CAST(round_even(least(c[2], c[4]), 0) AS INT) AS y, CAST(round_even(c[3] - c[1], 0) AS INT) AS w, CAST(round_even(abs(c[4] - c[2]), 0) AS INT) AS h,
  CAST(round_even(greatest(0.0::DOUBLE, c[4] - c[2]), 0) AS INT) AS clipped_h FROM b""")
def boxes_from_corners(spark, sf_dir):
    q, n = F.col("l_quantity").cast("double"), F.col("l_linenumber").cast("double")
    corners = F.array(q, n, q + 10.5, n - 2.0)
    items = read_table(spark, f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", corners.alias("c"))
    swapped, clipped = G.from_corners(F.col("c"), order="swap"), G.from_corners(F.col("c"))
    return items.select("l_orderkey", "l_linenumber", swapped.alias("b"), clipped.getField("h").alias("clipped_h")).select("l_orderkey", "l_linenumber", "b.x", "b.y", "b.w", "b.h", "clipped_h")


@query("""SELECT c_custkey, 'k=' || c_custkey AS kept, '***' AS secret FROM customer""")
def redacted_options(spark, sf_dir):
    options = F.create_map(F.lit("plain"), F.concat(F.lit("k="), F.col("c_custkey").cast("string")), F.lit("api_key"), F.col("c_name"))
    of = read_table(spark, f"{sf_dir}/customer.parquet").select("c_custkey", T.redact(options).alias("o"))
    return of.select("c_custkey", F.col("o")["plain"].alias("kept"), F.col("o")["api_key"].alias("secret"))
