"""Embedding near-dedup by NN-descent.

Equal vectors of a label are one node.  Each node has a list of its NEIGHBOURS most similar nodes.  The
lists start from leaves of random hyperplane trees and are refined by joins with the neighbours of
neighbours: the neighbours of a node, and those that have it as neighbour, are compared with each other,
unless all of these edges are old, so that their ends were compared before.  This is repeated until few edges
are new.  Then recall is audited: a bounded sample of nodes, one a
component, is compared with all nodes of its label; below RECALL, more leaves are drawn and refined, and
after MORE such rounds all nodes of each label are compared exactly.  Edges of a cosine of at least CLOSE are kept.  Where a list is
saturated (full, the worst entry at least CLOSE) it may lack links to other components: all components
of a label that have such a node are compared with each other, exactly, by balls around blocks of their
nodes and node by node where two balls come near enough.  Last, each list is enlarged to the node's
whole component, which counts links without listing them: by arithmetic for two blocks whose balls are so near
that all their nodes are linked, not at all for two that are too far, and else node by node.

A large leaf or neighbourhood is split at random into parts that are compared within themselves, with
another split each round; nothing is left out for good.  Vectors that are null, zero, have a null or
non-finite component, or whose label is null link with nothing.  Vectors of different lengths aren't
compared.  Rows with one vec_id count as vectors of their own.  A row without vec_id takes part; its
component_id is the smallest id of its component, null if there is none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curblake.llm.common import release, small_batches, spool
from curblake.llm.components import components
from curblake.llm.vectors import finite, matrix

CLOSE = 0.98
NEIGHBOURS = 8
TREES, LEAF, BITS = 4, 96, 30
#: Members of a neighbourhood that are compared at once.
HOOD = 32
RECALL, AUDIT, MORE = 0.97, 256, 3
#: Refinement ends when at most this share of the edges is new in a round.
STILL = 0.01
BLOCK = 512

EDGE = "node long, other long, sim double"


def nodes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with their node, nodes with label and unit vector), spooled.  Node: a hash of label and vector that no other has."""
    fits = F.col("label").isNotNull() & finite("embedding") & F.coalesce(F.exists("embedding", lambda x: x != 0), F.lit(False))
    seed = 0
    while True:
        node = F.when(fits, F.xxhash64("label", "embedding", F.lit(seed)))
        rows = vectors.select("vec_id", "label", "embedding", node.alias("node"))
        nodes = rows.where(F.col("node").isNotNull()).groupBy("node", "label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
        unit = nodes.withColumn("_norm", norm).withColumn("unit", F.transform("embedding", lambda x: x.cast("double") / F.col("_norm")))
        unit = spool(unit.select("node", F.struct("label", F.size("embedding").alias("size")).alias("label"), "unit", "rep", "copies"), "nodes")
        if unit.groupBy("node").count().where("count > 1").isEmpty():
            return spool(rows.select("vec_id", "node"), "vector-rows"), unit
        release(unit)
        seed += 1


def _codes(nodes: DataFrame, seed: int) -> DataFrame:
    """(node, label, unit, tree, code): BITS signs of random projections a tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = matrix(batch["unit"])
            size = np.array([x["size"] for x in batch["label"].to_pylist()])
            codes = np.zeros((len(rows), TREES), np.int64)
            for n in np.unique(size):
                planes = np.random.default_rng([seed, int(n)]).standard_normal((TREES * BITS, n))
                signs = (rows[size == n, :n] @ planes.T > 0).reshape(-1, TREES, BITS)
                codes[size == n] = signs @ (np.int64(1) << np.arange(BITS - 1, -1, -1))
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array(codes.tolist(), pa.list_(pa.int64()))], ["node", "codes"])

    coded = nodes.select("node", "label", "unit").mapInArrow(run, "node long, codes array<long>")
    return coded.select("node", F.posexplode("codes").alias("tree", "code"))


def _compare(groups: DataFrame) -> DataFrame:
    """groups(members array<struct<node, worst, unit>>) -> the edges within each group that improve a list."""
    small_batches(groups.sparkSession, 256)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch["members"]
            flat = column.flatten()
            if not len(flat):
                continue
            ids, worst, units = flat.field("node").to_numpy(), flat.field("worst").to_numpy(zero_copy_only=False), matrix(flat.field("unit"))
            at, out = 0, []
            for n in column.value_lengths().to_pylist():
                own, x, least = ids[at : at + n], units[at : at + n], worst[at : at + n]
                at += n
                if n < 2:
                    continue
                sims = x @ x.T
                sims[own[:, None] == own[None, :]] = -2
                k = min(NEIGHBOURS, n - 1)
                best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                row = np.repeat(np.arange(n), k)
                sim = sims[row, best.ravel()]
                better = sim > np.maximum(least[row], -1.5)
                out.append((own[row][better], own[best.ravel()][better], sim[better]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["node", "other", "sim"])

    return groups.mapInArrow(run, EDGE)


def _gathered(keyed: DataFrame, *key: str) -> DataFrame:
    return keyed.groupBy(*key).agg(F.collect_list(F.struct("node", "worst", "unit")).alias("members")).where(F.size("members") > 1).select("members")


def _top(edges: DataFrame) -> DataFrame:
    order = Window.partitionBy("node").orderBy(F.col("sim").desc(), "other")
    return edges.groupBy("node", "other").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh")).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= NEIGHBOURS).drop("_r")


def _salt(parts: Column, *by) -> Column:  # noqa: ANN002
    return F.pmod(F.xxhash64(*by), F.greatest(parts, F.lit(1)))


def leaves(nodes: DataFrame, seed: int) -> DataFrame:
    """Edges within the leaves of TREES random trees; a leaf has about LEAF nodes."""
    sizes = nodes.groupBy("label").agg(F.count("*").alias("n"))
    bits = F.least(F.lit(BITS), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / LEAF)).cast("int")))
    sizes = spool(sizes.select(F.col("label").alias("_l"), bits.alias("bits")), "label-sizes")
    coded = nodes.select("node", "label").join(_codes(nodes, seed), "node").join(sizes, F.col("label") == F.col("_l"))
    leaf = spool(coded.select("node", "label", "tree", F.expr(f"shiftright(code, {BITS} - bits)").alias("leaf")), "leaves")
    full = leaf.groupBy("label", "tree", "leaf").agg(F.ceil(F.count("*") / (2 * LEAF)).alias("parts")).where(F.col("parts") > 1)
    dealt = leaf.join(spool(full, "full-leaves"), ["label", "tree", "leaf"], "left").withColumn("part", _salt(F.coalesce("parts", F.lit(1)), "node", F.lit(seed), "tree"))
    vectors = dealt.join(nodes.select("node", "unit"), "node").withColumn("worst", F.lit(-2.0))
    return _compare(_gathered(vectors, "label", "tree", "leaf", "part")).withColumn("fresh", F.lit(True))


def refine(graph: DataFrame, nodes: DataFrame, seed: int) -> DataFrame:
    """One join with the neighbours of neighbours; the new lists."""
    listed = graph.groupBy("node").agg(F.when(F.count("*") >= NEIGHBOURS, F.min("sim")).otherwise(-2.0).alias("worst"))
    around = graph.select(F.col("node").alias("centre"), F.col("other").alias("node"), "fresh").unionByName(graph.select(F.col("other").alias("centre"), "node", "fresh")).unionByName(graph.select(F.col("node").alias("centre"), "node", F.lit(False).alias("fresh")))
    around = around.groupBy("centre", "node").agg(F.max("fresh").alias("fresh"))
    hoods = spool(around.groupBy("centre").agg(F.ceil(F.count("*") / HOOD).alias("parts"), F.max("fresh").alias("new")).where("new").drop("new"), "hoods")
    dealt = around.join(hoods, "centre").withColumn("part", _salt(F.col("parts"), "node", F.lit(seed)))
    members = dealt.join(nodes.select("node", "unit"), "node").join(listed, "node", "left").withColumn("worst", F.coalesce("worst", F.lit(-2.0)))
    return _top(graph.withColumn("fresh", F.lit(False)).unionByName(_compare(_gathered(members, "centre", "part")).withColumn("fresh", F.lit(True))))


def links_of(graph: DataFrame) -> DataFrame:
    return graph.where(F.col("sim") >= CLOSE).select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _sampled(nodes: DataFrame, found: DataFrame) -> list[dict]:
    """AUDIT nodes at most, one a component, half of them from nodes without a link; with the number of components each stands for."""
    own = nodes.select("node").join(found, "node", "left").withColumn("linked", F.col("component").isNotNull())
    one = own.groupBy("linked", F.coalesce("component", "node").alias("c")).agg(F.min_by("node", F.xxhash64("node", F.lit(7))).alias("node"))
    one = spool(one.select("linked", "node"), "audit-nodes")
    many = {r["linked"]: r["count"] for r in one.groupBy("linked").count().collect()}
    picked = None
    for linked, n in many.items():
        part = one.where(F.col("linked") == F.lit(linked)).orderBy(F.xxhash64("node")).limit(AUDIT // 2).withColumn("weight", F.lit(n / min(n, AUDIT // 2)))
        picked = part if picked is None else picked.unionByName(part)
    return [] if picked is None else picked.join(nodes.select("node", "label", "unit"), "node").select("node", "label", "unit", "weight").toArrow().to_pylist()


def recall(nodes: DataFrame, found: DataFrame) -> float:
    """Mean over the sampled nodes that have true links, by weight, of the share of them that are in the node's component.

    A group counts once, however many links it has.  1.0 where no sampled node has a link: as every found
    component would be sampled first, there are no links at all or few nodes with missed ones.
    """
    sample = _sampled(nodes, found)
    if not sample:
        return 1.0
    by_label: dict[tuple, list] = {}
    for r in sample:
        by_label.setdefault(tuple(r["label"].values()), []).append((r["node"], r["unit"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, units = batch["node"].to_numpy(), matrix(batch["unit"])
            labels = [tuple(x.values()) for x in batch["label"].to_pylist()]
            a, b = [], []
            for label in set(labels) & by_label.keys():
                at = np.array([i for i, x in enumerate(labels) if x == label])
                other = np.array([u for _, u in by_label[label]])
                for j, i in np.argwhere(other @ units[at][:, : other.shape[1]].T >= CLOSE):
                    if by_label[label][j][0] != ids[at[i]]:
                        a.append(by_label[label][j][0])
                        b.append(ids[at[i]])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    true = nodes.select("node", "label", "unit").mapInArrow(run, "a long, b long")
    own = lambda side: found.select(F.col("node").alias(side), F.col("component").alias(f"c{side}"))
    both = true.join(own("a"), "a", "left").join(own("b"), "b", "left")
    each = both.groupBy("a").agg((F.count_if(F.col("ca") == F.col("cb")) / F.count("*")).alias("share")).collect()
    weight = {r["node"]: r["weight"] for r in sample}
    whole = sum(weight[r["a"]] for r in each)
    return sum(weight[r["a"]] * r["share"] for r in each) / whole if whole else 1.0


def saturated(graph: DataFrame, found: DataFrame) -> DataFrame:
    """(node, component) of the components with a node whose list is full of links."""
    full = graph.groupBy("node").agg(F.count("*").alias("n"), F.min("sim").alias("worst")).where((F.col("n") >= NEIGHBOURS) & (F.col("worst") >= CLOSE))
    return found.join(found.join(full, "node").select("component").distinct(), "component").select("node", "component")


def _balls(members: DataFrame) -> DataFrame:
    """members(label, component, block, unit) -> a centre and the largest angle from it for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, at, centres, radii = matrix(batch["units"].flatten()), 0, [], []
            for n in batch["units"].value_lengths().to_pylist():
                own = x[at : at + n]
                at += n
                mean = own.mean(axis=0)
                long = np.linalg.norm(mean)
                centre = mean / long if long > 0 else own[0]
                centres.append(centre.tolist())
                radii.append(float(np.arccos(np.clip(own @ centre, -1, 1)).max()))
            yield pa.RecordBatch.from_arrays([batch["component"], batch["block"], pa.array(centres, pa.list_(pa.float64())), pa.array(radii, pa.float64())], ["component", "block", "centre", "radius"])

    small_batches(members.sparkSession, 64)
    grouped = members.groupBy("label", "component", "block").agg(F.collect_list("unit").alias("units"))
    found = grouped.select("component", "block", "units").mapInArrow(run, "component long, block int, centre array<double>, radius double")
    return found.join(members.select("label", "component").distinct(), "component")


def _near_balls(balls: DataFrame) -> DataFrame:
    """Pairs of balls of a label and two components that may hold a link (triangle inequality of angles)."""
    sizes = balls.groupBy("label").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"), F.count_distinct("component").alias("n")).where(F.col("n") > 1)
    dealt = balls.join(spool(sizes.drop("n"), "ball-parts"), "label").withColumn("part", _salt(F.col("parts"), "component", "block").cast("int"))
    paired = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    paired = paired.withColumns({"lo": F.least("part", "with"), "hi": F.greatest("part", "with")})
    groups = paired.groupBy("label", "lo", "hi").agg(F.collect_list(F.struct("component", "block", "part", "centre", "radius")).alias("members"))
    small_batches(balls.sparkSession, 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["members"].flatten()
            if not len(flat):
                continue
            component, block, part = (flat.field(c).to_numpy() for c in ("component", "block", "part"))
            centre, radius, at = matrix(flat.field("centre")), flat.field("radius").to_numpy(), 0
            for n, lo, hi in zip(batch["members"].value_lengths().to_pylist(), batch["lo"].to_pylist(), batch["hi"].to_pylist(), strict=True):
                s = slice(at, at + n)
                at += n
                angle = np.arccos(np.clip(centre[s] @ centre[s].T, -1, 1))
                near = angle <= radius[s][:, None] + radius[s][None, :] + np.arccos(CLOSE) + 1e-6
                near &= component[s][:, None] < component[s][None, :]
                if lo != hi:
                    near &= part[s][:, None] != part[s][None, :]
                i, j = np.nonzero(near)
                yield pa.RecordBatch.from_arrays([pa.array(component[s][i]), pa.array(component[s][j]), pa.array(block[s][i]), pa.array(block[s][j])], ["a", "b", "block_a", "block_b"])

    return groups.select("members", "lo", "hi").mapInArrow(run, "a long, b long, block_a int, block_b int")


def across(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """found(node, component) -> (a, b): all pairs of components of a label with a link between them, exactly."""
    sizes = spool(found.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "across-blocks")
    members = found.join(sizes, "component").withColumn("block", _salt(F.col("blocks"), "node").cast("int")).join(nodes.select("node", "label", "unit"), "node")
    members = spool(members.select("label", "component", "block", "unit"), "across-members")
    near = spool(_near_balls(spool(_balls(members), "balls")), "near-balls")
    side = lambda c: near.select("a", "b", "block_a", "block_b", F.col(c).alias("component"), F.col(f"block_{c}").alias("block"), F.lit(c == "a").alias("first"))
    both = side("a").unionByName(side("b")).join(members.drop("label"), ["component", "block"])
    groups = both.groupBy("a", "b", "block_a", "block_b").agg(F.collect_list(F.struct("first", "unit")).alias("members"))
    small_batches(found.sparkSession, 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["members"].flatten()
            if not len(flat):
                continue
            first, units, at, hit = flat.field("first").to_numpy(zero_copy_only=False).astype(bool), matrix(flat.field("unit")), 0, []
            for n in batch["members"].value_lengths().to_pylist():
                x, f = units[at : at + n], first[at : at + n]
                at += n
                hit.append(bool((x[f] @ x[~f].T >= CLOSE).any()))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(hit))

    return groups.select("members", "a", "b").mapInArrow(run, "a long, b long").distinct()


def merged(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """found with the components of each pair as one."""
    joined = components(pairs).select(F.col("node").alias("component"), F.col("component").alias("_to"))
    return found.join(joined, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))


def _block_pairs(balls: DataFrame) -> DataFrame:
    """Pairs of blocks of one component (a <= b) that may hold links, and whether all their nodes must be linked."""
    parts = spool(balls.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts")), "block-parts")
    dealt = balls.join(parts, "component").withColumn("part", F.pmod(F.col("block"), F.col("parts")).cast("int"))
    paired = dealt.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumns({"lo": F.least("part", "with"), "hi": F.greatest("part", "with")})
    groups = paired.groupBy("component", "lo", "hi").agg(F.collect_list(F.struct("block", "part", "centre", "radius")).alias("members"))
    reach = float(np.arccos(CLOSE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["members"].flatten()
            if not len(flat):
                continue
            block, part, centre, radius, at = flat.field("block").to_numpy(), flat.field("part").to_numpy(), matrix(flat.field("centre")), flat.field("radius").to_numpy(), 0
            for n, component, lo, hi in zip(batch["members"].value_lengths().to_pylist(), batch["component"].to_pylist(), batch["lo"].to_pylist(), batch["hi"].to_pylist(), strict=True):
                s = slice(at, at + n)
                at += n
                angle = np.arccos(np.clip(centre[s] @ centre[s].T, -1, 1))
                both = radius[s][:, None] + radius[s][None, :]
                near = (angle - both <= reach + 1e-6) & (block[s][:, None] <= block[s][None, :])
                if lo != hi:
                    near &= part[s][:, None] != part[s][None, :]
                i, j = np.nonzero(near)
                whole = (angle + both <= reach - 1e-6)[i, j]
                yield pa.RecordBatch.from_arrays([pa.array([component] * len(i), pa.int64()), pa.array(block[s][i]), pa.array(block[s][j]), pa.array(whole)], ["component", "a", "b", "whole"])

    small_batches(balls.sparkSession, 64)
    return groups.select("members", "component", "lo", "hi").mapInArrow(run, "component long, a int, b int, whole boolean")


def enlarge(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, linked): the number of vectors of other nodes with a cosine of at least CLOSE."""
    sizes = spool(found.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "component-blocks")
    dealt = found.join(sizes, "component").withColumn("block", _salt(F.col("blocks"), "node").cast("int"))
    members = spool(dealt.join(nodes.select("node", "label", "unit", "copies"), "node").select("label", "component", "block", "node", "unit", "copies"), "component-members")
    pairs = spool(_block_pairs(_balls(members)), "block-pairs")
    both = lambda p: p.select("component", F.col("a").alias("block"), F.col("b").alias("with")).unionByName(p.where("a <> b").select("component", F.col("b").alias("block"), F.col("a").alias("with")))
    # all linked: the copies of the other blocks, less the node's own
    held = members.groupBy("component", "block").agg(F.sum("copies").alias("held"))
    whole = both(pairs.where("whole")).join(held.withColumnRenamed("block", "with"), ["component", "with"])
    whole = spool(whole.groupBy("component", "block").agg(F.sum("held").alias("held"), F.max((F.col("block") == F.col("with")).cast("int")).alias("own")), "whole-blocks")
    counted = members.join(whole, ["component", "block"]).select("node", (F.col("held") - F.col("own") * F.col("copies")).alias("linked"))
    # the rest, node by node
    mixed = spool(pairs.where("NOT whole").select("component", "a", "b"), "mixed-blocks")
    side = mixed.select("component", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    groups = side.join(members.drop("label"), ["component", "block"]).groupBy("component", "a", "b").agg(F.collect_list(F.struct("node", "block", "copies", "unit")).alias("members"))
    small_batches(found.sparkSession, 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch["members"].flatten()
            if not len(flat):
                continue
            ids, block, copies, units = (flat.field("node").to_numpy(), flat.field("block").to_numpy(), flat.field("copies").to_numpy(), matrix(flat.field("unit")))
            at, out = 0, []
            for n, a, b in zip(batch["members"].value_lengths().to_pylist(), batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
                s = slice(at, at + n)
                at += n
                close = units[s] @ units[s].T >= CLOSE
                close &= ids[s][:, None] != ids[s][None, :]
                if a != b:
                    close &= block[s][:, None] != block[s][None, :]
                out.append((ids[s], close @ copies[s]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[0] for o in out])), pa.array(np.concatenate([o[1] for o in out]).astype(np.int64))], ["node", "linked"])

    compared = groups.select("members", "a", "b").mapInArrow(run, "node long, linked long")
    return counted.unionByName(compared).groupBy("node").agg(F.sum("linked").alias("linked"))


def converged(graph: DataFrame, nodes: DataFrame, seed: int) -> DataFrame:
    """graph refined until less than STILL of its edges are new in a round."""
    turn = 0
    while True:
        after = spool(refine(graph, nodes, seed + turn), "graph")
        release(graph)
        graph, turn = after, turn + 1
        new, n = graph.agg(F.count_if("fresh"), F.count("*")).first()
        if new <= STILL * n:
            return graph


def neighbour_graph(spark: SparkSession, nodes: DataFrame) -> tuple[DataFrame, float]:
    """(node, component) of linked nodes after NN-descent, and the audited recall; exact where the audit stays below RECALL."""
    graph = None
    for more in range(1 + MORE):
        found = leaves(nodes, more)
        graph = spool(_top(found if graph is None else graph.withColumn("fresh", F.lit(False)).unionByName(found)), "graph")
        graph = converged(graph, nodes, 1000 * more)
        linked = spool(components(links_of(graph)), "linked")
        linked = spool(merged(linked, across(saturated(graph, linked), nodes)), "linked")
        reached = recall(nodes, linked)
        if reached >= RECALL:
            return linked, reached
    return exact(linked, nodes), 1.0


def exact(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """found(node, component) with every link of each label's nodes; a node without one is compared as a component of its own."""
    every = spool(nodes.select("node").join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "every-node")
    whole = spool(merged(every, across(every, nodes)), "every-node")
    return whole.join(whole.groupBy("component").count().where(F.col("count") > 1).select("component"), "component").select("node", "component")


def deduplicate(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    rows, nodes = nodes_of(vectors)
    found, _ = neighbour_graph(vectors.sparkSession, nodes)
    found = spool(found, "vector-components")
    linked = spool(enlarge(found, nodes), "links")
    named = nodes.select("node", "rep", "copies").join(found, "node", "left").where((F.col("copies") > 1) | F.col("component").isNotNull())
    named = spool(named.withColumn("component", F.coalesce("component", "node")), "named-nodes")
    lowest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = spool(named.join(lowest, "component").join(linked, "node", "left").select("node", "component_id", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "named-nodes")
    out = rows.join(named, "node", "left").withColumns({"component_id": F.coalesce("component_id", "vec_id"), "n_links": F.coalesce("n_links", F.lit(0)).cast("long")})
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("vec_id", "n_links", "component_id", kept.alias("kept"))


SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= {CLOSE}),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS low FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(m.low, e.vec_id)) AS component_id, e.vec_id = least(e.vec_id, coalesce(m.low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN m ON m.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
