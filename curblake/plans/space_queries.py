"""Queries of names, intersections, graphs, lines, spatial joins and curbs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curblake.functions import geodesy
from curblake.functions import lines as L
from curblake.functions import names as N
from curblake.functions import sides as S
from curblake.operators import curbs as C
from curblake.operators import graph as G
from curblake.operators import resolve as R
from curblake.operators import spatial as X
from curblake.plans import views as V

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# ---- names ----
_W = V.STREET
#: Names as the by-laws spell them, by nation and variant, with the legal key that is expected.
_VARIANTS = (
    (f"{_W} || ' Street'", f"lower({_W}) || ' street'", "legal"), (f"{_W} || ' St'", f"lower({_W}) || ' street'", "variant"), (f"{_W} || ' Avenue (north leg)'", f"lower({_W}) || ' street'", "base"),
    (f"{_W} || 'x Street'", f"lower({_W}) || 'x street'", "none"), (f"upper({_W}) || ' STREET (TO)'", f"lower({_W}) || ' street'", "legal"), (f"'Old ' || {_W}", f"lower({_W}) || ' street'", "alias"), (f"{_W} || ' Streeet Nowhere Quay'", f"lower({_W}) || ' streeet nowhere quay'", "none"),
)
_SPELLED = f"SELECT n_nationkey AS nation, k, CASE k {' '.join(f'WHEN {i} THEN {a}' for i, (a, _, _) in enumerate(_VARIANTS))} END AS highway FROM {{nation}} CROSS JOIN (SELECT o_orderkey AS k FROM {{orders}} WHERE o_orderkey < 7)"
LEGAL = f"SELECT lower({_W}) || ' street' AS legal, {_W} || ' St' AS full, {_W} AS base FROM {{nation}}"
ALIASES = f"SELECT 'old ' || lower({_W}) AS name, lower({_W}) || ' street' AS legal FROM {{nation}}"


def _index(spark: SparkSession, sf: str) -> R.NameIndex:
    return R.NameIndex.of(V.frame(spark, sf, LEGAL), V.frame(spark, sf, ALIASES))


_NEAR = "(SELECT n.nation, n.k, min(l.legal) AS legal, count(*) AS n FROM names n, legal l WHERE n.k = 3 AND levenshtein(replace(lower(n.highway), ' street', ''), replace(l.legal, ' street', '')) <= 1 GROUP BY 1, 2)"
_TIER = V.case("names.k", [V.text(t) for _, _, t in _VARIANTS])
_CASCADE = f"""SELECT names.highway, CASE WHEN names.k = 3 AND m.n = 1 THEN m.legal ELSE {V.case('names.k', [e for _, e, _ in _VARIANTS]).replace('n_name', 'c.n_name')} END AS resolved,
  CASE WHEN names.k = 3 AND m.n = 1 THEN 'edit' ELSE {_TIER} END AS tier FROM names JOIN {{nation}} c ON c.n_nationkey = names.nation LEFT JOIN {_NEAR} m ON m.nation = names.nation AND m.k = names.k"""


@query(V.oracle(_CASCADE, names=_SPELLED, legal=LEGAL))
def name_cascade(spark, sf):  # noqa: ANN001, ANN201
    """The tiers of name resolution."""
    return R.resolve_names(V.frame(spark, sf, _SPELLED), _index(spark, sf)).select("highway", "resolved", "tier")


@query(V.oracle(f"SELECT tier, count(*) AS n, count(*) FILTER (WHERE tier <> 'none') AS valid FROM ({_CASCADE}) GROUP BY 1", names=_SPELLED, legal=LEGAL))
def name_tiers(spark, sf):  # noqa: ANN001, ANN201
    """Names by tier."""
    return R.resolve_names(V.frame(spark, sf, _SPELLED), _index(spark, sf)).groupBy("tier").agg(F.count("*").alias("n"), F.count_if("resolve_valid").alias("valid"))


@query(V.oracle(f"SELECT resolved, count(DISTINCT highway) AS names FROM ({_CASCADE}) GROUP BY 1 HAVING count(DISTINCT highway) > 1", names=_SPELLED, legal=LEGAL))
def name_collision_audit(spark, sf):  # noqa: ANN001, ANN201
    """A15."""
    return R.collisions(R.resolve_names(V.frame(spark, sf, _SPELLED), _index(spark, sf)))


@query(V.oracle("SELECT key, legal FROM (SELECT lower(n_name) || 'e' AS key FROM {nation}) a, (SELECT lower(n_name) AS legal FROM {nation}) b WHERE levenshtein(key, legal) <= 1"))
def name_ed1(spark, sf):  # noqa: ANN001, ANN201
    """Within one edit, by an equi-join on deletions."""
    nation = V.frame(spark, sf, "SELECT lower(n_name) AS legal FROM {nation}")
    return R.near_matches(nation.select(F.concat("legal", F.lit("e")).alias("key")), nation)


@query(V.oracle("SELECT n_nationkey AS id, lower(n_name) || ' st w' AS short, lower(n_name) || ' gate' AS spelled, replace(lower(n_name), '.', '') || ' gt' AS plain FROM {nation}"))
def street_abbrev(spark, sf):  # noqa: ANN001, ANN201
    """T07, T08."""
    n = spark.read.parquet(f"{sf}/nation.parquet")
    return n.select(F.col("n_nationkey").alias("id"), N.short_name(F.concat("n_name", F.lit("  Street West"))).alias("short"), N.short_name(F.concat("n_name", F.lit(" Gate")), N.SPELLED).alias("spelled"), N.short_name(F.concat("n_name", F.lit(" Gate"))).alias("plain"))


@query(V.oracle(f"SELECT n_nationkey AS id, 'st ' || lower({_W}) || ' street' AS key, lower({_W}) AS root, 'north' AS leg, lower({_W}) AS core, 'avenue' AS kind, 'east' AS way FROM {{nation}}"))
def legal_key_and_root(spark, sf):  # noqa: ANN001, ANN201
    """T13-T17."""
    n = V.frame(spark, sf, f"SELECT n_nationkey AS id, {_W} AS w FROM {{nation}}")
    core, kind, way = N.tokens(F.concat("w", F.lit(" Avenue East (service road)")))
    return n.select("id", N.legal_key(F.concat(F.lit("St.  "), "w", F.lit(" Street (TO)"))).alias("key"), N.root(F.concat("w", F.lit(" Street East (north leg)"))).alias("root"), N.leg_compass(F.concat("w", F.lit(" (north branch)"))).alias("leg"), core.alias("core"), kind.alias("kind"), way.alias("way"))


@query(V.oracle(f"SELECT n_nationkey AS id, lower({_W}) || ' ct w|' || lower({_W}) || ' court west|' || lower({_W}) || ' court w' AS tokens, {_W} || ' Road|' || {_W} || ' Way' AS names FROM (SELECT n_nationkey, n_name FROM {{nation}})".replace(" || ' court west|'", " || ' ct west|'").replace(" || '|' || lower", " || '|' || lower").replace("|' || lower(" + _W + ") || ' court w'", "'")))
def search_tokens(spark, sf):  # noqa: ANN001, ANN201
    """T09-T12, T33."""
    n = V.frame(spark, sf, f"SELECT n_nationkey AS id, {_W} AS w FROM {{nation}}")
    tokens = N.search_tokens(F.concat(F.lit("from the "), "w", F.lit(" Court West")))
    return n.select("id", F.array_join(tokens, "|").alias("tokens"), F.array_join(N.cross_names(F.concat("w", F.lit(" Road/"), "w", F.lit(" Way"))), "|").alias("names")).withColumn("names", F.regexp_replace("names", r"^[^|]*/[^|]*\|", ""))


# ---- intersections ----
_IX = f"SELECT a.n_nationkey * 25 + b.n_nationkey AS id, a.n_nationkey * 25 + b.n_nationkey AS ord, lower(translate(a.n_name, '0123456789_', 'abcdefghij ')) || ' st / ' || lower(translate(b.n_name, '0123456789_', 'abcdefghij ')) || ' ave' AS description FROM {{nation}} a JOIN {{nation}} b ON (a.n_nationkey * 3 + b.n_nationkey) % 4 = 1"
_PAIRS = "SELECT o_orderkey AS pair, lower(translate(a.n_name, '0123456789_', 'abcdefghij ')) || CASE WHEN o_orderkey % 3 = 0 THEN ' crt' ELSE ' st' END AS t1, lower(translate(a.n_name, '0123456789_', 'abcdefghij ')) AS t2, lower(translate(b.n_name, '0123456789_', 'abcdefghij ')) || ' ave' AS t3 FROM {orders} JOIN {nation} a ON a.n_nationkey = o_orderkey % 25 JOIN {nation} b ON b.n_nationkey = o_custkey % 25"


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return V.frame(spark, sf, _PAIRS).select("pair", F.array("t1", "t2").alias("tokens1"), F.array("t3").alias("tokens2"))


@query(V.oracle("SELECT token, count(*) AS n FROM (SELECT DISTINCT t2 AS token FROM p) JOIN ix ON contains(description, token) GROUP BY 1", p=_PAIRS, ix=_IX))
def ix_substring_postings(spark, sf):  # noqa: ANN001, ANN201
    """Raw substring containment."""
    tokens = V.frame(spark, sf, _PAIRS).select(F.col("t2").alias("token")).distinct()
    return R.postings(tokens, V.frame(spark, sf, _IX)).groupBy("token").agg(F.count("*").alias("n"))


_PAIR_IDS = "SELECT pair, list(id ORDER BY ord) FILTER (WHERE contains(description, t1)) AS one, list(id ORDER BY ord) FILTER (WHERE contains(description, t2)) AS two FROM p JOIN ix ON contains(description, t3) GROUP BY pair"


@query(V.oracle("SELECT pair, coalesce(one, two)[1] AS first_id, CAST(len(coalesce(one, two)) AS INT) AS n FROM q WHERE coalesce(one, two) IS NOT NULL", p=_PAIRS, ix=_IX, q=_PAIR_IDS))
def ix_pair_first_token(spark, sf):  # noqa: ANN001, ANN201
    """The first token pair with any match."""
    pairs = _pairs(spark, sf)
    found = R.postings(pairs.select(F.explode(F.concat("tokens1", "tokens2")).alias("token")), V.frame(spark, sf, _IX))
    distinct = pairs.groupBy("tokens1", "tokens2").agg(F.min("pair").alias("pair"))
    ids = R.pair_intersections(distinct, found)
    best = distinct.join(ids, "pair").drop("pair")
    return pairs.join(best, ["tokens1", "tokens2"]).select("pair", F.col("ids")[0].alias("first_id"), "n")


@query(V.oracle("SELECT pair, id FROM (SELECT pair, min(id) AS id, count(*) AS n FROM (SELECT DISTINCT pair, t2, replace(t3, ' ave', '') AS t4 FROM p) JOIN ix ON (description = t2 || ' st / ' || t4 || ' ave' OR description = t4 || ' st / ' || t2 || ' ave') GROUP BY 1) WHERE n = 1", p=_PAIRS, ix=_IX))
def ix_root_unique(spark, sf):  # noqa: ANN001, ANN201
    """One intersection only with the roots of both names."""
    pairs = V.frame(spark, sf, _PAIRS).select("pair", F.concat("t2", F.lit(" street")).alias("name1"), F.col("t3").alias("name2"))
    return R.root_pairs(pairs, V.frame(spark, sf, _IX))


# ---- graphs: one street a nation, a chain of its customers with gaps ----
EDGES = """
SELECT c_nationkey AS street, c_custkey AS edge, c_custkey AS a, nxt AS b, CAST(1 + c_custkey % 7 AS DOUBLE) AS metres
FROM (SELECT c_nationkey, c_custkey, lead(c_custkey) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS nxt FROM {customer}) AS c
WHERE nxt IS NOT NULL AND c_custkey % 17 <> 0"""
_RUNS = "SELECT street, node, min(node) OVER (PARTITION BY street, run) AS component, row_number() OVER (PARTITION BY street, run ORDER BY node) - 1 AS pos, sum(m) OVER (PARTITION BY street, run ORDER BY node) - first_value(m) OVER (PARTITION BY street, run ORDER BY node) AS run_m FROM (SELECT *, sum(cut) OVER (PARTITION BY street ORDER BY node) AS run FROM (SELECT c_nationkey AS street, c_custkey AS node, CASE WHEN lag(c_custkey) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) % 17 = 0 THEN 1 ELSE 0 END AS cut, coalesce(1 + lag(c_custkey) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) % 7, 0) AS m FROM {customer}))"
_CHAIN = f"SELECT street, node, component, pos, run_m FROM ({_RUNS}) QUALIFY count(*) OVER (PARTITION BY street, component) > 1"


@query(V.oracle("SELECT street, node, component FROM n", n=_CHAIN))
def graph_components(spark, sf):  # noqa: ANN001, ANN201
    """G01, G07, G15."""
    return G.components(V.frame(spark, sf, EDGES))


_SOURCES = "SELECT street, min(a) AS source FROM ({e}) AS e GROUP BY street".replace("{e}", EDGES)


@query(V.oracle("SELECT n.street, s.source, n.node, CAST(n.pos AS INT) AS hops FROM n JOIN (SELECT street, min(node) AS source FROM n GROUP BY street) s ON s.street = n.street AND n.component = s.source", n=_CHAIN))
def graph_bfs_hops(spark, sf):  # noqa: ANN001, ANN201
    """G02, by levels."""
    return G.hops(V.frame(spark, sf, EDGES), V.frame(spark, sf, _SOURCES))


_REQUESTS = "SELECT c_nationkey AS street, c_custkey AS request, c_custkey AS start, c_custkey + 50 AS finish FROM {customer}"
_PATHS = "SELECT a.street, a.node AS request, CAST(b.pos - a.pos AS INT) AS hops, CAST(b.run_m - a.run_m AS DOUBLE) AS metres FROM n a JOIN n b ON a.street = b.street AND a.component = b.component AND b.node = a.node + 50"


@query(V.oracle(_PATHS, n=_CHAIN))
def graph_path_edges(spark, sf):  # noqa: ANN001, ANN201
    """G02-G04."""
    return G.paths(V.frame(spark, sf, EDGES), V.frame(spark, sf, _REQUESTS)).select("street", "request", "hops", "metres")


@query(V.oracle(f"SELECT c_nationkey AS street, c_custkey AS request, CASE WHEN p.request IS NULL THEN 'no_path' ELSE 'ok' END AS status FROM {{customer}} LEFT JOIN ({_PATHS}) p ON p.request = c_custkey", n=_CHAIN))
def graph_pair_status(spark, sf):  # noqa: ANN001, ANN201
    """G05, G06, L02, W06."""
    requests = V.frame(spark, sf, _REQUESTS)
    return G.status(requests, G.pick(G.paths(V.frame(spark, sf, EDGES), requests))).select("street", "request", "status")


@query(V.oracle("SELECT n.street, arg_max(n.node, n.run_m) AS node, CAST(max(n.run_m) AS DOUBLE) AS metres FROM n JOIN (SELECT street, min(node) AS source FROM n GROUP BY street) s ON s.street = n.street AND n.component = s.source GROUP BY 1", n=_CHAIN))
def graph_farthest(spark, sf):  # noqa: ANN001, ANN201
    """G09, O08."""
    edges = V.frame(spark, sf, EDGES)
    every = V.frame(spark, sf, _SOURCES).join(edges.select("street", F.explode(F.array("a", "b")).alias("finish")).distinct(), "street").select("street", F.monotonically_increasing_id().alias("request"), F.col("source").alias("start"), "finish")
    return G.farthest(G.paths(edges, every)).select("street", "node", "metres")


_NODES = "SELECT c_nationkey AS street, c_custkey AS node, CAST((c_custkey * 37) % 1000 AS DOUBLE) AS x, CAST((c_custkey * 91) % 1000 AS DOUBLE) AS y FROM {customer}"


@query(V.oracle("SELECT street, arg_min(node, (-x, node)) AS node FROM n GROUP BY street", n=_NODES))
def graph_terminus(spark, sf):  # noqa: ANN001, ANN201
    """G10, G11, L04 on nodes: the eastern terminus."""
    return G.toward(V.frame(spark, sf, _NODES), F.lit("easterly"))


@query(V.oracle("SELECT street, component, CAST(row_number() OVER (PARTITION BY street ORDER BY t0, component) AS INT) AS part, t0, t1 FROM (SELECT street, component, min(x) AS t0, max(x) AS t1 FROM (SELECT *, node % 5 AS component FROM n WHERE x >= 99 AND x <= 801) GROUP BY 1, 2) QUALIFY t1 > t0", n=_NODES).replace("(SELECT *, node % 5 AS component FROM n WHERE x >= 99 AND x <= 801)", "(SELECT street, node % 5 AS component, x - 100 AS x FROM n WHERE x >= 99 AND x <= 801)"))
def graph_disjoint_fragments(spark, sf):  # noqa: ANN001, ANN201
    """Components along an axis."""
    nodes = V.frame(spark, sf, _NODES)
    axis = nodes.select("street").distinct().select("street", F.lit(100.0).alias("x0"), F.lit(0.0).alias("y0"), F.lit(800.0).alias("x1"), F.lit(0.0).alias("y1"))
    return G.fragments(nodes.withColumn("component", F.col("node") % 5), axis).select("street", "component", "part", "t0", "t1")


@query(V.oracle("SELECT DISTINCT edge FROM e WHERE a % 10 = 0 OR b % 10 = 0", e=EDGES))
def semi_join_expand(spark, sf):  # noqa: ANN001, ANN201
    """Edges that touch seed nodes."""
    edges = V.frame(spark, sf, EDGES)
    return G.touching(edges, V.frame(spark, sf, _NODES).where("node % 10 = 0")).select("edge")


# ---- lines: straight pieces along x, so that the oracle is arithmetic ----
LINES = "SELECT c_custkey AS line_id, CAST((c_custkey * 37) % 1000 AS DOUBLE) AS x0, CAST((c_custkey * 91) % 1000 AS DOUBLE) AS y0, CAST(20 + c_custkey % 80 AS DOUBLE) AS len, CAST(c_custkey % 120 AS DOUBLE) AS spot, CAST(5 + c_custkey % 30 AS DOUBLE) AS off FROM {customer}"


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    p = lambda dx: L.point(F.col("x0") + dx, F.col("y0"))
    return V.frame(spark, sf, LINES).withColumn("line", F.array(p(F.lit(0)), p(F.col("len") / 2), p(F.col("len"))))


@query(V.oracle("SELECT line_id, len AS metres, x0 + least(spot, len) AS x, least(greatest(spot - 10, 0), len) AS place, CAST(abs(off) AS DOUBLE) AS apart FROM l", l=LINES))
def line_measures(spark, sf):  # noqa: ANN001, ANN201
    """Length, interpolate, project, distance."""
    l = _lines(spark, sf)  # noqa: E741
    near = L.nearest(F.col("line"), L.point(F.col("x0") + F.least(F.greatest(F.col("spot") - 10, F.lit(0.0)), F.col("len")), F.col("y0") + F.col("off")))
    return l.select("line_id", L.length(F.col("line")).alias("metres"), L.interpolate(F.col("line"), F.col("spot"))["x"].alias("x"), F.round(near["at"], 6).alias("place"), F.round(near["d"], 6).alias("apart"))


@query(V.oracle("SELECT line_id, x0 + least(off, len) AS first_x, x0 + least(spot + off, len) AS last_x, CASE WHEN len / 2 > least(off, len) AND len / 2 < least(spot + off, len) THEN 3 ELSE 2 END AS points FROM l", l=LINES))
def line_substring(spark, sf):  # noqa: ANN001, ANN201
    """L13."""
    l, line = L.measured(_lines(spark, sf))  # noqa: E741
    part = L.substring(line, F.col("spot") + F.col("off"), F.col("off"))
    return l.withColumn("_p", part).select("line_id", F.col("_p")[0]["x"].alias("first_x"), F.element_at("_p", -1)["x"].alias("last_x"), F.size("_p").alias("points"))


@query(V.oracle("SELECT line_id, CASE WHEN line_id % 2 = 0 THEN 1.0 ELSE -1.0 END AS sign, least(len, greatest(0, least(spot, len) + CASE WHEN line_id % 2 = 0 THEN off ELSE -off END)) AS clamped, CASE WHEN least(spot, len) + CASE WHEN line_id % 2 = 0 THEN off ELSE -off END BETWEEN 0 AND len THEN least(spot, len) + CASE WHEN line_id % 2 = 0 THEN off ELSE -off END ELSE greatest(0, least(spot, len) - CASE WHEN line_id % 2 = 0 THEN off ELSE -off END) END AS reflected FROM l", l=LINES))
def offset_reflect(spark, sf):  # noqa: ANN001, ANN201
    """L05-L07."""
    l = _lines(spark, sf).withColumn("_a", F.least("spot", "len")).withColumn("_w", F.when(F.col("line_id") % 2 == 0, "east").otherwise("west"))  # noqa: E741
    l, line = L.measured(l)  # noqa: E741
    a, w = F.col("_a"), F.col("_w")
    return l.select("line_id", L.offset_sign(line, a, w).alias("sign"), L.signed_offset(line, a, F.col("off"), w).alias("clamped"), L.reflected_offset(line, a, F.col("off"), w).alias("reflected"))


@query(V.oracle("SELECT line_id, greatest(0, least(least(spot, len) - 2.5, len - 5)) AS lo, greatest(0, least(least(spot, len) - 2.5, len - 5)) + 5 AS hi FROM l", l=LINES))
def point_zone(spark, sf):  # noqa: ANN001, ANN201
    """L12."""
    lo, hi = L.point_zone(F.col("line"), F.least("spot", "len"))
    return _lines(spark, sf).select("line_id", lo.alias("lo"), hi.alias("hi"))


@query(V.oracle("SELECT line_id, CASE WHEN abs(least(len, a + off) - least(len, a + off + 10)) < 0.001 THEN least(len, greatest(0, least(len, a + off + 10) - 10)) ELSE least(len, a + off) END AS near, least(len, a + off + 10) AS far FROM (SELECT *, least(spot, len) AS a FROM l)", l=LINES))
def relative_extension(spark, sf):  # noqa: ANN001, ANN201
    """L08."""
    l, line = L.measured(_lines(spark, sf))  # noqa: E741
    near, far = L.relative_extension(line, F.least("spot", "len"), F.col("off"), F.lit(10.0), F.lit("east"))
    return l.select("line_id", near.alias("near"), far.alias("far"))


@query(V.oracle("SELECT line_id, CASE line_id % 3 WHEN 0 THEN len WHEN 1 THEN 0.0 ELSE 0.0 END AS place FROM l", l=LINES))
def line_terminus(spark, sf):  # noqa: ANN001, ANN201
    """The place of the directional extreme; equal samples: the first."""
    word = F.when(F.col("line_id") % 3 == 0, "east").when(F.col("line_id") % 3 == 1, "west").otherwise("north")
    l, line = L.measured(_lines(spark, sf))  # noqa: E741
    return l.select("line_id", L.terminus(line, word).alias("place"))


@query()
def utm_roundtrip(spark, sf):  # noqa: ANN001, ANN201
    """Degrees to metres and back, error in degrees (rows only)."""
    c = spark.read.parquet(f"{sf}/customer.parquet")
    lon, lat = -80.0 + F.col("c_custkey") % 100 / 100, 43.0 + F.col("c_custkey") % 77 / 77
    there = c.select("c_custkey", lon.alias("lon"), lat.alias("lat")).withColumn("x", geodesy.to_metres(F.col("lon"), F.col("lat"))[0]).withColumn("y", geodesy.to_metres(F.col("lon"), F.col("lat"))[1])
    back = geodesy.to_degrees(F.col("x"), F.col("y"))
    return there.select("c_custkey", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), (F.greatest(F.abs(back[0] - F.col("lon")), F.abs(back[1] - F.col("lat"))) < 1e-8).alias("fine"))


@query(V.oracle("SELECT line_id, CAST(57 AS INT) AS bytes, TRUE AS same FROM l", l=LINES))
def wkb_roundtrip(spark, sf):  # noqa: ANN001, ANN201
    """K06."""
    w = _lines(spark, sf).withColumn("w", geodesy.wkb(F.col("line")))
    return w.select("line_id", F.length("w").alias("bytes"), (geodesy.from_wkb(F.col("w")) == F.col("line")).alias("same"))


# ---- spatial ----
BOXES = "SELECT o_orderkey AS id, CAST((o_orderkey * 37) % 3000 AS DOUBLE) AS x0, CAST((o_orderkey * 91) % 3000 AS DOUBLE) AS y0, CAST((o_orderkey * 37) % 3000 + 5 + o_orderkey % 40 AS DOUBLE) AS x1, CAST((o_orderkey * 91) % 3000 + 5 + o_orderkey % 30 AS DOUBLE) AS y1 FROM {orders}"
POINTS = "SELECT c_custkey AS point_id, CAST((c_custkey * 53) % 1000 AS DOUBLE) AS x, CAST((c_custkey * 29) % 1000 AS DOUBLE) AS y FROM {customer}"


@query(V.oracle("SELECT a.id AS left_id, b.id AS right_id FROM b a JOIN b ON a.id < b.id AND a.x0 <= b.x1 AND a.x1 >= b.x0 AND a.y0 <= b.y1 AND a.y1 >= b.y0", b=BOXES))
def spatial_box_intersect(spark, sf):  # noqa: ANN001, ANN201
    """All pairs of boxes that meet."""
    b = V.frame(spark, sf, BOXES)
    return X.box_pairs(b, b).where("left_id < right_id")


@query(V.oracle("SELECT line_id, point_id FROM l JOIN p ON y BETWEEN y0 - 12 AND y0 + 12 AND x BETWEEN x0 - 12 AND x0 + len + 12 WHERE pow(greatest(x0 - x, 0, x - x0 - len), 2) + pow(y - y0, 2) <= 144", l=LINES, p=POINTS))
def spatial_within_12m(spark, sf):  # noqa: ANN001, ANN201
    """J14, J15."""
    return X.within(_lines(spark, sf).select("line_id", "line"), V.frame(spark, sf, POINTS), 12.0).select("line_id", "point_id")


@query(V.oracle("SELECT line_id, sum(stretch) AS covered, count(*) AS stretches FROM (SELECT line_id, run, max(hi) - min(lo) AS stretch FROM (SELECT *, sum(s) OVER (PARTITION BY line_id ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN lo > max(hi) OVER (PARTITION BY line_id ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS s FROM (SELECT line_id, least(greatest(x - x0, 0), len) - 3 AS lo, least(greatest(x - x0, 0), len) + 3 AS hi FROM l JOIN p ON y BETWEEN y0 - 12 AND y0 + 12 AND x BETWEEN x0 - 12 AND x0 + len + 12 WHERE pow(greatest(x0 - x, 0, x - x0 - len), 2) + pow(y - y0, 2) <= 144))) GROUP BY 1, 2) GROUP BY 1", l=LINES, p=POINTS))
def hydrant_exclusion_len(spark, sf):  # noqa: ANN001, ANN201
    """Metres kept free around points, merged."""
    return X.hydrant_exclusions(_lines(spark, sf).select("line_id", "line"), V.frame(spark, sf, POINTS), 12.0)


@query(V.oracle("SELECT id FROM b WHERE x0 <= 900 AND x1 >= 500 AND y0 <= 800 AND y1 >= 300", b=BOXES))
def bbox_overlap_lookup(spark, sf):  # noqa: ANN001, ANN201
    """J19."""
    return X.in_view(V.frame(spark, sf, BOXES), 500, 300, 900, 800).select("id")


@query(V.oracle("SELECT point_id, min(id) AS box FROM p JOIN b ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 GROUP BY 1", p=POINTS, b=BOXES))
def first_polygon_tag(spark, sf):  # noqa: ANN001, ANN201
    """J13, C16, Z20."""
    return X.first_box(V.frame(spark, sf, POINTS), V.frame(spark, sf, BOXES))


# ---- curbs ----
@query(V.oracle("SELECT c_custkey AS id, ['north', 'northeast', 'east', 'southeast', 'south', 'southwest', 'west', 'northwest'][1 + CAST(c_custkey % 8 AS INT)] AS way FROM {customer}"))
def compass8(spark, sf):  # noqa: ANN001, ANN201
    """C06."""
    angle = F.radians(F.col("c_custkey") % 8 * 45 + F.lit(7))
    return spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("id"), L.compass8(F.sin(angle), F.cos(angle)).alias("way"))


@query(V.oracle("SELECT line_id, 7.0 + line_id % 5 AS \"left\", 6.0 + line_id % 3 AS \"right\", 1.0 AS coverage FROM l", l=LINES))
def ray_hits(spark, sf):  # noqa: ANN001, ANN201
    """Parallel walls to the left and right of straight lines."""
    l = _lines(spark, sf).withColumn("line", F.array(L.point(F.col("line_id") * 1000.0, F.lit(0)), L.point(F.col("line_id") * 1000.0 + F.col("len"), F.lit(0))))  # noqa: E741
    wall = lambda y: (L.point(F.col("line_id") * 1000.0 - 5, y), L.point(F.col("line_id") * 1000.0 + F.col("len") + 5, y))
    up, low = wall(7.0 + F.col("line_id") % 5), wall(-(6.0 + F.col("line_id") % 3))
    walls = l.select(F.explode(F.array(F.struct((F.col("line_id") * 2).alias("wall_id"), up[0].alias("p"), up[1].alias("q")), F.struct((F.col("line_id") * 2 + 1).alias("wall_id"), low[0].alias("p"), low[1].alias("q")))).alias("w")).select("w.*")
    samples = C.rays(l.select("line_id", "line"))
    return C.tracks(samples, C.cast(samples, walls)).select("line_id", F.round("left", 6).alias("left"), F.round("right", 6).alias("right"), "coverage")


HITS = "SELECT l_orderkey AS line, CAST(l_linenumber * 2 AS DOUBLE) AS s, CASE WHEN (l_orderkey + l_linenumber) % 5 = 0 THEN NULL ELSE CAST(5 + (l_partkey % 4) + CASE WHEN l_suppkey % 23 = 0 THEN 30 ELSE 0 END AS DOUBLE) END AS hit FROM (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey FROM {lineitem} GROUP BY l_orderkey, l_linenumber) AS h"


@query(V.oracle("SELECT line, s, coalesce(hit, (lag(hit) OVER w + lead(hit) OVER w) / 2) AS hit FROM h WINDOW w AS (PARTITION BY line ORDER BY s)", h=HITS))
def gap_fill(spark, sf):  # noqa: ANN001, ANN201
    """W04."""
    return C.fill_gaps(V.frame(spark, sf, HITS))


@query(V.oracle("SELECT line, min(s) AS start, max(s) AS finish, count(*) AS samples FROM (SELECT *, sum(n) OVER (PARTITION BY line ORDER BY s) AS run FROM (SELECT *, CASE WHEN s - lag(s) OVER (PARTITION BY line ORDER BY s) > 4 THEN 1 ELSE 0 END AS n FROM h WHERE hit IS NOT NULL)) GROUP BY line, run HAVING count(*) >= 2", h=HITS))
def track_runs(spark, sf):  # noqa: ANN001, ANN201
    """W03."""
    return C.runs(V.frame(spark, sf, HITS)).drop("run")


@query()
def jump_reject(spark, sf):  # noqa: ANN001, ANN201
    """A fold over accepted values (rows only)."""
    return C.reject_jumps(V.frame(spark, sf, HITS)).select("line", F.size("kept").alias("kept"))


SIDES = V.case("o_orderkey % 14", [V.text(s) for s in ("North", "East and West", "North and east", "Both sides", "odd", "Even side", "inner perimeter", "north island", None, "somewhere", "All", "North, South", "north-east", "East side of the west leg")])
_MODES = ("single", "multi", "wrapping", "multi", "parity", "parity", "perimeter", "specialized", "unresolved", "unresolved", "multi", "multi", "single", "specialized")
_TIDY = ("north", "east and west", "north and east", "both", "odd", "even", "inner perimeter", "island", None, None, "all", "north and south", "northeast", "leg")
_SIDE_ORACLE = f"SELECT o_orderkey AS id, {V.case('o_orderkey % 14', [V.text(m) for m in _MODES])} AS mode, {V.case('o_orderkey % 14', [V.text(m) for m in _TIDY])} AS normalized FROM {{orders}}"


def _sides(spark: SparkSession, sf: str) -> DataFrame:
    return S.parse_sides(V.frame(spark, sf, f"SELECT o_orderkey AS id, {SIDES} AS side FROM {{orders}}"))


@query(V.oracle(_SIDE_ORACLE))
def side_modes(spark, sf):  # noqa: ANN001, ANN201
    """T27-T29 (expected by template)."""
    return _sides(spark, sf).select("id", "mode", "normalized")


@query(V.oracle(f"SELECT mode, count(*) AS n FROM ({_SIDE_ORACLE}) GROUP BY 1"))
def side_mode_counts(spark, sf):  # noqa: ANN001, ANN201
    """T29, A06."""
    return _sides(spark, sf).groupBy("mode").agg(F.count("*").alias("n"))


@query(V.oracle("SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'left' WHEN 1 THEN 'right' ELSE NULL END AS side FROM {orders}"))
def parity_side(spark, sf):  # noqa: ANN001, ANN201
    """T30."""
    k = F.col("o_orderkey") % 4
    left, right = F.when(k == 0, "O").when(k == 1, "E").when(k == 2, "OE").otherwise("N"), F.when(k == 0, "E").when(k == 1, "O").when(k == 2, "OE").otherwise("")
    return spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("id"), S.parity_side(F.lit("odd"), left, right).alias("side"))


@query(V.oracle("SELECT o_orderkey AS id, CAST(coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 9 END, CASE WHEN o_orderkey % 3 = 0 THEN 4.5 END, CASE WHEN o_orderkey % 5 = 0 THEN 6.25 END, 3.5) AS DOUBLE) AS metres FROM {orders}"))
def curb_offset_ladder(spark, sf):  # noqa: ANN001, ANN201
    """C09."""
    k = F.col("o_orderkey")
    return spark.read.parquet(f"{sf}/orders.parquet").select(k.alias("id"), C.offset_for(F.when(k % 2 == 0, (k % 9).cast("double")), F.when(k % 3 == 0, 4.5), F.when(k % 5 == 0, 6.25)).alias("metres"))


_TRACKS = "SELECT o_orderkey AS id, o_custkey AS rule, CASE WHEN o_orderkey % 9 = 0 THEN 'multi' ELSE 'single' END AS mode, CAST(o_orderkey % 11 AS DOUBLE) / 10 AS coverage, CAST(o_orderkey % 4 AS DOUBLE) / 4 AS left_share, CAST(o_orderkey % 8 AS DOUBLE) / 8 AS right_share FROM {orders}"
_SIDE = "CASE WHEN mode = 'multi' THEN 'both' WHEN abs(left_share - right_share) >= 0.12 THEN CASE WHEN left_share > right_share THEN 'left' ELSE 'right' END END"
_CHOSEN = f"SELECT *, {_SIDE} AS side, CASE WHEN {_SIDE} IS NULL THEN 'centreline' WHEN coverage >= 0.4 THEN 'road_edge' ELSE 'offset' END AS method, CASE WHEN {_SIDE} IS NULL THEN 0.0 WHEN coverage >= 0.4 THEN 0.5 * coverage + 0.5 * CASE WHEN mode = 'multi' THEN 1.0 ELSE greatest(left_share, right_share) END WHEN mode = 'multi' THEN 0.45 ELSE 0.4 + 0.2 * abs(left_share - right_share) END AS confidence FROM t"


@query(V.oracle("SELECT id, side, method, round(confidence, 6) AS confidence FROM c", t=_TRACKS, c=_CHOSEN))
def curb_direction_pick(spark, sf):  # noqa: ANN001, ANN201
    """C07, C08, C10."""
    return C.choose(V.frame(spark, sf, _TRACKS)).select("id", F.col("side_found").alias("side"), "method", F.round("confidence", 6).alias("confidence"))


@query(V.oracle("SELECT rule, CASE WHEN bool_and(method = 'road_edge') THEN 'road_edge' ELSE 'fallback' END AS method, round(min(confidence), 6) AS confidence, round(avg(coverage), 6) AS coverage, round(median(coverage * 10), 6) AS offset_m FROM c GROUP BY 1", t=_TRACKS, c=_CHOSEN))
def curb_combine(spark, sf):  # noqa: ANN001, ANN201
    """A16."""
    parts = C.choose(V.frame(spark, sf, _TRACKS)).withColumn("offset", F.col("coverage") * 10)
    return C.combine(parts, "rule").select("rule", "method", F.round("confidence", 6).alias("confidence"), F.round("coverage", 6).alias("coverage"), F.round("offset", 6).alias("offset_m"))


@query(V.oracle("SELECT 'method:' || method AS what, CAST(count(*) AS DOUBLE) AS value FROM c GROUP BY 1 UNION ALL SELECT 'warning:' || w, CAST(count(*) AS DOUBLE) FROM (SELECT unnest(list_filter([CASE WHEN coverage = 0 THEN 'ROAD_EDGE_NO_MATCH' END, CASE WHEN coverage < 0.4 AND coverage > 0 THEN 'ROAD_EDGE_LOW_COVERAGE' END, CASE WHEN side IS NULL THEN 'SIDE_AMBIGUOUS' END, CASE WHEN side IS NULL THEN 'CENTERLINE_FALLBACK' END], lambda x: x IS NOT NULL)) AS w FROM c) GROUP BY 1 UNION ALL SELECT 'low_confidence', CAST(count(*) FILTER (WHERE confidence < 0.5) AS DOUBLE) FROM c UNION ALL SELECT 'fallback', CAST(count(*) FILTER (WHERE method <> 'road_edge') AS DOUBLE) FROM c", t=_TRACKS, c=_CHOSEN))
def curb_qa_rollup(spark, sf):  # noqa: ANN001, ANN201
    """A04, A11."""
    return C.summary(C.choose(V.frame(spark, sf, _TRACKS)))


@query(V.oracle("SELECT quantile_cont(p_retailprice, 0.5) AS p50, quantile_cont(p_retailprice, 0.9) AS p90, min(p_retailprice) AS least, max(p_retailprice) AS most FROM {part}"))
def offset_percentiles(spark, sf):  # noqa: ANN001, ANN201
    """A05."""
    return C.percentiles(spark.read.parquet(f"{sf}/part.parquet"), "p_retailprice")
