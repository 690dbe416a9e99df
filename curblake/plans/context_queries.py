"""Queries of names in context, qualified and terminus paths, casts, gates and run metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curblake.functions import between as B
from curblake.functions import casts
from curblake.operators import context as X
from curblake.operators import graph as G
from curblake.operators import resolve as R
from curblake.operators import triage as T
from curblake.plans import views as V
from curblake.plans.space_queries import _CHAIN, _NODES, EDGES

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# ---- names: every nation has a street and an avenue of one base, and a road of a base of its own ----
_W = "lower(translate(n_name, '0123456789_', 'abcdefghijx'))"
_LEGAL = f"SELECT {_W} || ' street' AS legal, {_W} || ' st' AS full, {_W} AS base FROM {{nation}} UNION ALL SELECT {_W} || ' avenue', {_W} || ' ave', {_W} FROM {{nation}} UNION ALL SELECT 'z' || {_W} || ' road', 'z' || {_W} || ' rd', 'z' || {_W} FROM {{nation}}"
_NO_ALIAS = "SELECT 'no such name' AS name, 'no such name' AS legal FROM {nation} WHERE n_nationkey = 0"
_MEETS = {"street": "((a.k + b.k) % 3 = 0 OR (a.k + b.k) % 7 = 0)", "avenue": "((a.k + b.k) % 3 = 1 OR (a.k + b.k) % 7 = 0)"}
_N = f"SELECT n_nationkey AS k, {_W} AS w FROM {{nation}}"
_TOUCHING = " UNION ALL ".join(f"SELECT a.w || ' {kind}' AS legal, 'z' || b.w || ' road' AS cross FROM ({_N}) a JOIN ({_N}) b ON {on}" for kind, on in _MEETS.items())
_ROWS = f"SELECT o_orderkey AS row, a.w AS own, b.w AS other, {_MEETS['street']} AS s, {_MEETS['avenue']} AS v, o_orderkey % 5 = 0 AS lane, o_orderkey % 10 = 0 AS inferred FROM {{orders}} JOIN ({_N}) a ON a.k = o_orderkey % 25 JOIN ({_N}) b ON b.k = o_custkey % 25"


def _index(spark: SparkSession, sf: str) -> R.NameIndex:
    return R.NameIndex.of(V.frame(spark, sf, _LEGAL), V.frame(spark, sf, _NO_ALIAS))


def _in_context(spark: SparkSession, sf: str) -> DataFrame:
    none = F.lit(None).cast("string")
    rows = V.frame(spark, sf, _ROWS)
    return rows.select("row", F.initcap("own").alias("highway"), F.concat(F.lit("Z"), "other", F.lit(" Road")).alias("start_intersection"), F.concat("own", F.lit(" Lane")).alias("end_intersection"), *[none.alias(c) for c in X.CROSS_FIELDS[2:]])


_CHOSEN = "CASE WHEN s AND NOT v THEN own || ' street' WHEN v AND NOT s THEN own || ' avenue' ELSE own END"


@query(V.oracle(f"SELECT row, {_CHOSEN} AS resolved, CASE WHEN s <> v THEN 'strong' ELSE 'none' END AS by, s <> v AS resolve_valid FROM r", r=_ROWS))
def name_context(spark, sf):  # noqa: ANN001, ANN201
    """A name that two streets share, decided by the cross street it meets."""
    return X.resolve_in_context(_in_context(spark, sf), _index(spark, sf), V.frame(spark, sf, _TOUCHING)).select("row", "resolved", "by", "resolve_valid")


@query(V.oracle("SELECT row, 'z' || other || ' road' AS cross FROM r", r=_ROWS))
def cross_hints(spark, sf):  # noqa: ANN001, ANN201
    """Cross streets without the one that shares the highway's root."""
    return X.cross_hints(_in_context(spark, sf)).select("row", F.lower("cross").alias("cross"))


@query(V.oracle("SELECT DISTINCT partner, street, CASE WHEN named AND s THEN own || ' street' WHEN s AND v THEN NULL WHEN s THEN own || ' street' ELSE own || ' avenue' END AS legal FROM (SELECT *, 'z' || other || ' road' AS partner, row % 2 = 0 AS named, own || CASE WHEN row % 2 = 0 THEN ' street' ELSE '' END AS street FROM r) WHERE (s OR v) AND NOT (s AND v AND NOT named)", r=_ROWS))
def unique_remap(spark, sf):  # noqa: ANN001, ANN201
    """The only legal name of a street's family that meets the partner, its own first."""
    rows = V.frame(spark, sf, _ROWS)
    pairs = rows.select(F.concat(F.lit("z"), "other", F.lit(" road")).alias("partner"), F.concat("own", F.when(F.col("row") % 2 == 0, " street").otherwise("")).alias("street")).distinct()
    return X.unique_remap(pairs, _index(spark, sf), V.frame(spark, sf, _TOUCHING))


@query(V.oracle("SELECT street, legal FROM (SELECT w AS street, unnest([w || ' street', w || ' avenue']) AS legal FROM n UNION ALL SELECT 'z' || w || ' road', 'z' || w || ' road' FROM n)", n=_N))
def name_variants(spark, sf):  # noqa: ANN001, ANN201
    """The legal names of a street's family."""
    names = V.frame(spark, sf, _N).select(F.explode(F.array("w", F.concat(F.lit("z"), "w", F.lit(" road")))).alias("street"))
    return X.variants(names, _index(spark, sf))


@query(V.oracle("SELECT 'z' || w || ' lane' AS highway, 'z' || w || ' road' AS legal FROM n", n=_N))
def lane_suffix_remap(spark, sf):  # noqa: ANN001, ANN201
    """Of "w Lane" and "zw Lane" only the second has a base of one legal name."""
    names = V.frame(spark, sf, _N).select(F.explode(F.array(F.concat("w", F.lit(" lane")), F.concat(F.lit("z"), "w", F.lit(" lane")))).alias("highway"))
    return X.lane_suffix_remap(names, _index(spark, sf))


@query(V.oracle("SELECT 'z' || w || ' drive' AS street, 'z' || w || ' road' AS token FROM n UNION ALL SELECT w || ' ave', w || ' avenue' FROM n", n=_N))
def search_names(spark, sf):  # noqa: ANN001, ANN201
    """The legal name of a single base, else the resolved name."""
    names = V.frame(spark, sf, _N).select(F.explode(F.array(F.concat("w", F.lit(" ave")), F.concat(F.lit("z"), "w", F.lit(" drive")))).alias("street"))
    return X.search_names(names, _index(spark, sf))


@query(V.oracle(f"SELECT row, CASE WHEN inferred THEN 'ln 1 n ' || own || ' e dufferin' WHEN lane THEN 'lane' ELSE {_CHOSEN} END AS resolved, CASE WHEN inferred THEN 'lane' WHEN lane OR s = v THEN 'none' ELSE 'strong' END AS by FROM r", r=_ROWS))
def street_lookup(spark, sf):  # noqa: ANN001, ANN201
    """In context first, then the inferred lane where the highway only says lane."""
    source = V.frame(spark, sf, _ROWS)
    rows = _in_context(spark, sf).join(source.select("row", "lane"), "row").withColumn("highway", F.when(F.col("lane"), "Lane").otherwise(F.col("highway"))).drop("lane")
    lanes = source.where("inferred").select("row", F.concat(F.lit("ln 1 n "), "own", F.lit(" e dufferin")).alias("legal"))
    return X.lookup(rows, _index(spark, sf), V.frame(spark, sf, _TOUCHING), lanes).select("row", "resolved", "by")


_NEAR = "SELECT a.k, count(*) FILTER (WHERE levenshtein(a.w || 'q', b.w) <= 1) AS one, 2 * count(*) FILTER (WHERE levenshtein(a.w, b.w) <= 1) + count(*) FILTER (WHERE levenshtein(a.w, 'z' || b.w) <= 1) AS bare FROM n a JOIN n b ON TRUE GROUP BY 1"
_DIAGNOSED = """SELECT row, q, row % 2 = 0 AS lane, one, bare, CASE WHEN q = 0 AND one = 1 THEN 'plain_name' WHEN q IN (0, 1) THEN 'truly_absent_from_tcl' WHEN q = 2 THEN 'generic_lane_highway' ELSE 'plain_name' END AS street_category
  FROM (SELECT o_orderkey AS row, o_orderkey // 2 % 4 AS q, o_orderkey % 25 AS k FROM {orders}) r JOIN d ON d.k = r.k"""


@query(V.oracle("""SELECT row, street_category, CASE q WHEN 0 THEN CASE WHEN one = 1 THEN 'typo_ed1_unique' ELSE 'truly_absent_from_tcl' END WHEN 1 THEN 'truly_absent_from_tcl' WHEN 2 THEN 'generic_lane_highway' ELSE 'typo_ed1_ambiguous' END AS subcause,
  CASE q WHEN 0 THEN CASE WHEN one = 1 THEN 'auto_highway_resolve' ELSE 'manual_alias' END WHEN 1 THEN 'manual_alias' WHEN 2 THEN CASE WHEN lane THEN 'lane_infer' ELSE 'skip' END ELSE 'skip' END AS suggested_fix,
  CASE q WHEN 0 THEN CASE WHEN one = 1 THEN 'B_quick' ELSE 'D_hard' END WHEN 2 THEN CASE WHEN lane THEN 'C_medium' ELSE 'D_hard' END ELSE 'D_hard' END AS suggested_tier,
  CASE q WHEN 0 THEN one WHEN 3 THEN bare ELSE 0 END AS near, CASE WHEN q = 3 THEN 2 ELSE 0 END AS prefixes, CASE WHEN q = 3 THEN 2 ELSE 0 END AS bases FROM x""", n=_N, d=_NEAR, x=_DIAGNOSED))  # fmt: skip
def street_diagnosis(spark, sf):  # noqa: ANN001, ANN201
    """Why a street isn't found, and what to try: a typo, an absent name, a lane, an ambiguous name."""
    rows = V.frame(spark, sf, f"SELECT o_orderkey AS row, w FROM {{orders}} JOIN ({_N}) n ON n.k = o_orderkey % 25")
    q = F.floor(F.col("row") / 2) % 4
    name = F.when(q == 0, F.concat("w", F.lit("q Street"))).when(q == 1, F.concat(F.lit("Qqq "), "w", F.lit(" Parkway"))).when(q == 2, "Lane").otherwise(F.col("w"))
    lanes = rows.where((F.col("row") % 2 == 0) & (q == 2)).select("row", F.lit("ln").alias("legal"))
    return X.diagnose(rows.select("row", name.alias("highway")), _index(spark, sf), lanes)


# ---- paths ----
_PARTS = "SELECT street, component, max(node) AS hi, CAST(max(pos) AS INT) AS hops, CAST(max(run_m) AS DOUBLE) AS metres, avg(node) AS x, -avg(node) / 2 AS y, ['north', 'southern', 'east', 'west', NULL][1 + street % 5] AS leg FROM n GROUP BY 1, 2"
_SIDE = "CASE leg WHEN 'southern' THEN y WHEN 'north' THEN -y WHEN 'east' THEN -x WHEN 'west' THEN x ELSE 0 END"


def _parts(spark: SparkSession, sf: str) -> DataFrame:
    """(street, component, start, finish, x, y, leg) of each connected part, by its ends."""
    parts = G.components(V.frame(spark, sf, EDGES)).groupBy("street", "component").agg(F.min("node").alias("start"), F.max("node").alias("finish"), F.avg("node").alias("x"), (-F.avg("node") / 2).alias("y"))
    leg = F.element_at(F.array(F.lit("north"), F.lit("southern"), F.lit("east"), F.lit("west"), F.lit(None)), (F.col("street") % 5 + 1).cast("int"))
    return parts.withColumn("leg", leg)


@query(V.oracle(f"SELECT street, arg_min(component, component) AS start, arg_min(hi, component) AS finish, min(hops) AS hops, min(metres) AS metres, count(*) > 1 AS tied FROM (SELECT *, rank() OVER (PARTITION BY street ORDER BY {_SIDE}, hops, metres) AS r FROM p) WHERE r = 1 GROUP BY 1", n=_CHAIN, p=_PARTS))
def graph_qualified_path(spark, sf):  # noqa: ANN001, ANN201
    """One path a component; the leg's side, hops and metres choose."""
    parts = _parts(spark, sf)
    found = G.paths(V.frame(spark, sf, EDGES), parts.select("street", F.col("component").alias("request"), "start", "finish"))
    found = found.withColumnRenamed("request", "component").join(parts.select("street", "component", "leg"), ["street", "component"]).withColumn("request", F.col("street"))
    return G.pick_qualified(found, parts.select("street", "component", "x", "y")).drop("request")


@query(V.oracle("SELECT street, component, arg_min(node, (CASE q WHEN 'west' THEN x WHEN 'east' THEN -x WHEN 'south' THEN y WHEN 'north' THEN -y ELSE 0 END, node)) AS node FROM (SELECT *, node % 40 AS component, ['north intersection', 'south intersection', 'east', 'west', ''][1 + street % 5] AS qualifier, ['north', 'south', 'east', 'west', ''][1 + street % 5] AS q FROM n) GROUP BY 1, 2, q HAVING count(*) = 1 OR q <> ''", n=_NODES))
def graph_qualified_ends(spark, sf):  # noqa: ANN001, ANN201
    """An end's node in each component, by the qualifier's direction."""
    word = F.element_at(F.array(*map(F.lit, ("north intersection", "south intersection", "east", "west", ""))), (F.col("street") % 5 + 1).cast("int"))
    ids = V.frame(spark, sf, _NODES).select("street", F.lit(1).alias("request"), (F.col("node") % 40).alias("component"), "node", "x", "y", word.alias("qualifier"))
    return G.qualified_ends(ids).drop("request")


@query(V.oracle("SELECT street, CASE WHEN street % 2 = 0 THEN component ELSE hi END AS start, CASE WHEN street % 2 = 0 THEN hi ELSE component END AS finish, hops, metres FROM p QUALIFY row_number() OVER (PARTITION BY street ORDER BY metres DESC, CASE WHEN street % 2 = 0 THEN component ELSE hi END) = 1", n=_CHAIN, p=_PARTS))
def block_to_terminus_path(spark, sf):  # noqa: ANN001, ANN201
    """The longest of the paths to the eastern terminus; where the starts lie there themselves, to the farthest node."""
    edges = V.frame(spark, sf, EDGES)
    nodes = G.components(edges).withColumns({"x": F.col("node").cast("double"), "y": F.lit(0.0)})
    starts = _parts(spark, sf).select("street", F.col("street").alias("request"), F.when(F.col("street") % 2 == 0, F.col("start")).otherwise(F.col("finish")).alias("start"), F.lit("easterly").alias("toward"))
    return G.to_terminus(edges, starts, nodes).drop("request")


# ---- casts, gates, metadata ----
_TOWNS = ("Scarborough", "ETOBICOKE", "north york", "East York", None)


@query(V.oracle(f"SELECT c_custkey AS id, {V.case('c_custkey % 5', [V.text(t) for t in ('2:00 a.m. to 6:00 a.m. from Nov. 1 to Mar. 31', '2:00 a.m. to 6:00 a.m. from Oct. 16 to Apr. 14', '2:00 a.m. to 6:00 a.m. from Dec. 1 to Mar. 31', None, None)])} AS times, {V.case('c_custkey % 5', [V.text(t) for t in ('Scarborough Code § 214-34', 'Etobicoke Code § 240-27', 'Toronto Municipal Code § 950-400D(9)', None, None)])} AS bylaw FROM {{customer}}"))
def regional_winter_rule(spark, sf):  # noqa: ANN001, ANN201
    """D25."""
    rows = V.frame(spark, sf, f"SELECT c_custkey AS id, {V.case('c_custkey % 5', [V.text(t) for t in _TOWNS])} AS town FROM {{customer}}")
    return rows.withColumn("_r", casts.regional_winter_rule(F.col("town"))).select("id", "_r.times", "_r.bylaw")


@query(V.oracle("SELECT c_custkey // 4 AS g, CASE WHEN count(DISTINCT nullif(v, '')) = 1 THEN max(nullif(v, '')) END AS value FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS v FROM {customer}) GROUP BY 1"))
def unique_or_null(spark, sf):  # noqa: ANN001, ANN201
    """F18."""
    rows = V.frame(spark, sf, "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS v FROM {customer}")
    return rows.groupBy(F.floor(F.col("c_custkey") / 4).alias("g")).agg(casts.unique_or_null("v").alias("value"))


_TEXTS = (" 5 ", "7.9", "x1", "", "-12", None)


@query(V.oracle("SELECT c_custkey AS id, [5.0, 7.9, NULL, NULL, -12.0, NULL][1 + c_custkey % 6] AS f, [5, NULL, NULL, NULL, -12, NULL][1 + c_custkey % 6]::BIGINT AS i, [1, 1, 1, 0, 1, 0][1 + c_custkey % 6] AS b FROM {customer}"))
def safe_casts(spark, sf):  # noqa: ANN001, ANN201
    """F19."""
    rows = V.frame(spark, sf, f"SELECT c_custkey AS id, {V.case('c_custkey % 6', [V.text(t) for t in _TEXTS])} AS t FROM {{customer}}")
    return rows.select("id", casts.safe_float(F.col("t")).alias("f"), casts.safe_int(F.col("t")).alias("i"), casts.flag(F.col("t")).alias("b"))


@query(V.oracle("SELECT o_orderstatus AS kind, count(*) AS n, CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS last FROM {orders} GROUP BY 1"))
def feature_counts(spark, sf):  # noqa: ANN001, ANN201
    """A17."""
    found = T.feature_counts(spark.read.parquet(f"{sf}/orders.parquet"), "o_orderstatus", "o_orderdate")
    return found.select(F.col("o_orderstatus").alias("kind"), "n", F.date_format("last", "yyyy-MM-dd").alias("last"))


@query(V.oracle("SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderkey % 20 NOT IN (16, 17)) AS parsed, count(*) FILTER (WHERE o_orderkey % 20 NOT IN (16, 17)) >= count(*) * 0.8 AS pass FROM {orders}"))
def cohort_gate(spark, sf):  # noqa: ANN001, ANN201
    """V07."""
    return T.cohort_gate(B.parse_rows(V.frame(spark, sf, V.PLACES_VIEW)), 0.8)


@query(V.oracle("SELECT 'edges' AS source, count(*) FILTER (WHERE c_custkey % 3 = 1) AS strips, count(*) FILTER (WHERE c_custkey % 3 = 0) AS intersections FROM {customer}"))
def run_metadata(spark, sf):  # noqa: ANN001, ANN201
    """K16."""
    edges = V.frame(spark, sf, "SELECT CASE c_custkey % 3 WHEN 0 THEN 'Intersection' WHEN 1 THEN 'Road Edge' ELSE 'Other' END AS kind FROM {customer}")
    m = T.run_metadata(edges, source="edges")
    return spark.createDataFrame([(m["source"], m["road_strip_count"], m["intersection_count"])], "source string, strips long, intersections long")
