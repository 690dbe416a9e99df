"""Per-street graphs: edges(street, edge, a, b, metres).

Components and hop counts are DataFrame loops over single nodes; paths with an exact order of ties run
as one function over some connected parts of a street (a part with more edges than a task holds isn't of a street).
"""

from __future__ import annotations

from collections import deque
from itertools import count

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curblake.operators.storage import cut


def adjacency(edges: DataFrame) -> DataFrame:
    """Each edge both ways."""
    back = edges.select(*[F.col({"a": "b", "b": "a"}.get(c, c)).alias(c) for c in edges.columns])
    return edges.unionByName(back)


def components(edges: DataFrame) -> DataFrame:
    """(street, node, component): the smallest node reachable; labels are halved by pointer jumping each round, until none changes."""
    both = cut(adjacency(edges.select("street", "a", "b")).distinct())
    label = both.groupBy("street", F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("component"))
    while True:
        near = both.join(label.withColumnRenamed("node", "b"), ["street", "b"]).groupBy("street", F.col("a").alias("node")).agg(F.min("component").alias("_c"))
        new = label.join(near, ["street", "node"]).select("street", "node", F.least("component", "_c").alias("component"))
        jump = new.select("street", F.col("node").alias("component"), F.col("component").alias("_j"))
        new = cut(new.join(jump, ["street", "component"], "left").select("street", "node", F.least("component", F.coalesce("_j", "component")).alias("component")))
        if new.join(label, ["street", "node", "component"], "left_anti").isEmpty():
            return new
        label = new


def hops(edges: DataFrame, sources: DataFrame, most: int | None = None) -> DataFrame:
    """(street, source, node, hops) by breadth first, to the end unless ``most`` hops are asked for; each level joins only the nodes that are new."""
    both = cut(adjacency(edges.select("street", "a", "b")).distinct())
    seen = cut(sources.select("street", "source", F.col("source").alias("node"), F.lit(0).alias("hops")))
    front, last = seen, seen.drop("hops")  # the neighbours of a level lie in it, the one before, or the next
    for level in count(1) if most is None else range(1, most + 1):
        step = front.select("street", "source", F.col("node").alias("a")).join(both, ["street", "a"]).select("street", "source", F.col("b").alias("node")).distinct()
        before, last = last, front.drop("hops")
        front = cut(step.join(before.unionByName(last), ["street", "source", "node"], "left_anti").withColumn("hops", F.lit(level)))
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


PATH = "request long, start long, finish long, hops int, metres double, edges array<long>, nodes array<long>"


def paths(edges: DataFrame, requests: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """requests(street, request, start, finish) -> shortest paths by hops, ties in edge order.

    A path lies in one connected part, so a function takes a share of a street's parts, not the whole street: as many shares as a
    shuffle has partitions.  parts(street, node, component): of components(), if they are known.
    """

    def run(key: tuple, e: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        near: dict = {}
        for x in e.sort_values("edge").itertuples():
            near.setdefault(x.a, []).append((x.b, x.edge, x.metres))
            near.setdefault(x.b, []).append((x.a, x.edge, x.metres))
        trees: dict = {}

        def tree(start: int) -> dict:
            if start not in trees:
                came, queue = {start: None}, deque([start])
                while queue:
                    n = queue.popleft()
                    for m, edge, metres in near.get(n, ()):
                        if m not in came:
                            came[m] = (n, edge, metres)
                            queue.append(m)
                trees[start] = came
            return trees[start]

        out = []
        for q in r.itertuples():
            came = tree(q.start)
            if q.finish in came and q.start in near:
                at, used, nodes, metres = q.finish, [], [q.finish], 0.0
                while came[at]:
                    at, edge, m = came[at]
                    used.append(edge)
                    nodes.append(at)
                    metres += m
                out.append((key[0], q.request, q.start, q.finish, len(used), metres, used[::-1], nodes[::-1]))
        return pd.DataFrame(out, columns=["street", "request", "start", "finish", "hops", "metres", "edges", "nodes"])

    shares = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = components(edges) if parts is None else parts

    def dealt(df: DataFrame, end: str):  # noqa: ANN202
        at = known.select("street", F.col("node").alias(end), F.pmod(F.xxhash64("component"), F.lit(shares)).alias(f"_share_{end}"))
        return df.join(at, ["street", end]).groupBy("street", f"_share_{end}")

    return dealt(edges.select("street", "edge", "a", "b", "metres"), "a").cogroup(dealt(requests, "start")).applyInPandas(run, f"street {edges.schema['street'].dataType.simpleString()}, {PATH}")


def pick(found: DataFrame) -> DataFrame:
    """Of a request's paths the one with the fewest hops, then metres (to the millimetre); status ok, tied, or none."""
    order = Window.partitionBy("street", "request").orderBy("hops", F.round("metres", 3))
    ranked = found.where(F.col("start") != F.col("finish")).withColumn("_r", F.rank().over(order)).where("_r = 1")
    return ranked.groupBy("street", "request").agg(F.count("*").alias("n"), F.min("start").alias("start"), F.min("finish").alias("finish"), F.min("hops").alias("hops"), F.min("metres").alias("metres")).select("street", "request", F.when(F.col("n") > 1, "tied").otherwise("ok").alias("status"), *[F.when(F.col("n") == 1, F.col(c)).alias(c) for c in ("start", "finish", "hops", "metres")])


def status(requests: DataFrame, picked: DataFrame) -> DataFrame:
    """Adds missing (an end isn't known), no_path, tied or ok."""
    out = requests.groupBy("street", "request").agg(F.count("start").alias("_s"), F.count("finish").alias("_f")).join(picked, ["street", "request"], "left")
    return out.withColumn("status", F.when((F.col("_s") == 0) | (F.col("_f") == 0), "missing").otherwise(F.coalesce("status", F.lit("no_path")))).drop("_s", "_f")


def farthest(found: DataFrame) -> DataFrame:
    """(street, start, node): the farthest by metres, ties to the smaller node."""
    return found.groupBy("street", "start").agg(F.min_by("finish", F.struct(-F.col("metres"), F.col("finish"))).alias("node"), F.max("metres").alias("metres"))


def toward(nodes: DataFrame, word: Column) -> DataFrame:
    """nodes(street, node, x, y) -> (street, node) of the extreme one in a compass direction, ties to the smaller node."""
    w = F.lower(word)
    score = F.when(w.contains("east"), F.col("x")).when(w.contains("west"), -F.col("x")).when(w.contains("north"), F.col("y")).otherwise(-F.col("y"))
    return nodes.groupBy("street").agg(F.min_by("node", F.struct((-score).alias("s"), F.col("node"))).alias("node"))


def fragments(nodes: DataFrame, axis: DataFrame, slack: float = 1.0) -> DataFrame:
    """nodes(street, node, component, x, y) and axis(street, x0, y0, x1, y1) -> the components that overlap the axis, with
    their first and last nodes along it, in order of projection."""
    on = nodes.join(axis, "street")
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    long = F.sqrt(dx * dx + dy * dy)
    on = on.withColumn("_long", long).withColumn("t", ((F.col("x") - F.col("x0")) * dx + (F.col("y") - F.col("y0")) * dy) / long)
    inside = on.where((F.col("t") >= -slack) & (F.col("t") <= F.col("_long") + slack))
    parts = inside.groupBy("street", "component").agg(F.min("t").alias("t0"), F.max("t").alias("t1"), F.min_by("node", F.struct("t", "node")).alias("first"), F.min_by("node", F.struct((-F.col("t")).alias("t"), F.col("node"))).alias("last"))
    return parts.withColumn("part", F.row_number().over(Window.partitionBy("street").orderBy("t0", "component"))).where("t1 > t0")


def touching(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Edges with an end among the seed nodes."""
    return edges.join(seeds.select(F.col("node").alias("a")), "a", "left_semi").unionByName(edges.join(seeds.select(F.col("node").alias("b")), "b", "left_semi").select(edges.columns)).distinct()


def pick_qualified(found: DataFrame, centroids: DataFrame) -> DataFrame:
    """found(street, request, component, start, finish, hops, metres, leg), a path for each component that holds both ends, and
    centroids(street, component, x, y) -> of a request's paths the one whose component lies farthest to the leg's side (any, without a
    leg), then with the fewest hops, then the shortest; tied if the next one ranks equal."""
    leg = F.lower("leg")
    side = F.when(leg.startswith("south"), F.col("y")).when(leg.startswith("north"), -F.col("y")).when(leg.startswith("east"), -F.col("x")).when(leg.startswith("west"), F.col("x"))
    ranked = found.where(F.col("start") != F.col("finish")).join(centroids, ["street", "component"], "left").withColumn("_side", F.coalesce(side, F.lit(0.0)))
    rank = F.rank().over(Window.partitionBy("street", "request").orderBy("_side", "hops", "metres"))
    first = ranked.withColumn("_r", rank).where("_r = 1").groupBy("street", "request")
    return first.agg(F.min_by("start", "component").alias("start"), F.min_by("finish", "component").alias("finish"), F.min("hops").alias("hops"), F.min("metres").alias("metres"), (F.count("*") > 1).alias("tied"))


def qualified_ends(ids: DataFrame) -> DataFrame:
    """ids(street, request, component, node, x, y, qualifier) of one end -> the node of each component: the extreme one in the
    qualifier's direction, else the only one; a component with several nodes and no qualifier has none."""
    q = F.lower(F.coalesce("qualifier", F.lit("")))
    way = F.when(q.contains("west"), F.col("x")).when(q.contains("east"), -F.col("x")).when(q.contains("south"), F.col("y")).when(q.contains("north"), -F.col("y"))
    ends = ids.withColumn("_way", way).groupBy("street", "request", "component")
    ends = ends.agg(F.min_by("node", F.struct("_way", "node")).alias("node"), F.count("*").alias("_n"), F.count("_way").alias("_q"))
    return ends.where((F.col("_n") == 1) | (F.col("_q") == F.col("_n"))).drop("_n", "_q")


def to_terminus(edges: DataFrame, starts: DataFrame, nodes: DataFrame) -> DataFrame:
    """starts(street, request, start, toward) and nodes(street, node, component, x, y) -> (street, request, start, finish, hops,
    metres): of a request's starts the longest path to the extreme node of its component in the wanted direction; where all of
    these have no length, the longest path to the node farthest from a start.  Ties go to the smaller start."""
    w = F.lower("toward")
    score = F.when(w.contains("east"), F.col("x")).when(w.contains("west"), -F.col("x")).when(w.contains("north"), F.col("y")).otherwise(-F.col("y"))
    own = starts.join(nodes.select("street", F.col("node").alias("start"), "component"), ["street", "start"])
    ends = own.join(nodes, ["street", "component"]).groupBy("street", "request", "start").agg(F.min_by("node", F.struct((-score).alias("s"), F.col("node"))).alias("finish"))
    asked = ends.withColumn("_id", F.struct("request", "start"))
    numbered = cut(asked.withColumn("_k", F.xxhash64("street", "request", "start")))
    best = paths(edges, numbered.select("street", F.col("_k").alias("request"), "start", "finish"), nodes).select("street", F.col("request").alias("_k"), "hops", "metres")
    reached = numbered.drop("_id").join(best, ["street", "_k"])
    longest = reached.groupBy("street", "request").agg(F.max_by(F.struct("start", "finish", "hops", "metres"), F.struct("metres", -F.col("start"))).alias("p")).select("street", "request", "p.*")
    stuck = cut(longest.where(F.col("metres") < 0.001).select("street", "request"))
    every = own.join(stuck, ["street", "request"]).join(nodes.select("street", "component", F.col("node").alias("finish")), ["street", "component"]).where(F.col("start") != F.col("finish"))
    every = cut(every.select("street", "request", "start", "finish", F.xxhash64("street", "request", "start", "finish").alias("_k")))
    far = paths(edges, every.select("street", F.col("_k").alias("request"), "start", "finish"), nodes).select("street", F.col("request").alias("_k"), "hops", "metres")
    far = every.join(far, ["street", "_k"]).groupBy("street", "request").agg(F.max_by(F.struct("start", "finish", "hops", "metres"), F.struct("metres", -F.col("start"), -F.col("finish"))).alias("p")).select("street", "request", "p.*")
    return longest.join(stuck, ["street", "request"], "left_anti").unionByName(far)
