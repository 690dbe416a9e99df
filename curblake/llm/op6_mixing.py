"""Mixing sources to target weights by a time-varying curriculum; DataFrame functions only.

Each source has a weight and a cap (CAP times its words).  The targets share all words by weight; what
exceeds a cap is shared again among the others, which is a water level: target = min(cap, level x
weight).  During training the weight of a source changes linearly; its schedule, integrated, is its
cumulative demand D(t), with D(0) = 0 and D(1) = target.  A source's documents stand in a fixed random
order (by MD5 of id and text), repeated epoch after epoch; the middle of a copy lies c words into that
sequence, and its training position is the t with D(t) = c.  Copies whose t isn't within training, from 0
to 1, aren't taken.  The mix is range-sorted by position.  Taken words differ from the target by half a document at most.

Null texts have size 0, a null source is a source of its own and comes last, a null id and a null text
count as empty ones in the order.  Documents of size 0 take part and take nothing.  Repeated rows are documents of their own.
An empty table gives an empty result.  A hot source is split into buckets of the order, whose offsets
come from bucket totals, so no task needs a whole source.

`in_order` moves each copy's whole row once only.  It finds the positions without the texts, cuts training
into parts, and notes where in each bucket's order each part begins; with that small table every row knows
the parts of its copies before it is moved, and its position is computed there again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curblake.llm.common import WHITE, release, spool

WEIGHTS = (5, 2, 1)
CAP = 3
#: Change of a source's weight over training, by weight class: from 1 - slope to 1 + slope times its mean.
SLOPES = (-0.5, 0.0, 0.5)
#: Documents a bucket of the order should hold.
BUCKET = 1_000
#: Rows of the table of parts that each executor may hold.
HELD = 500_000


def n_words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(f"[^{WHITE}]+")), F.lit(0)).cast("long")


def _place(key: str, text: str) -> Column:
    """60 bits of the MD5 of id and text: the place in the fixed random order."""
    named = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col(text), F.lit("")))
    return F.conv(F.substring(F.md5(named), 1, 15), 16, 10).cast("long")


def targets(per_source: DataFrame) -> DataFrame:
    """per_source(source, source_size) with weight, class and target.  One row a source, so windows over all rows are small."""
    by_name, everything = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    kind = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS)))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), kind + 1).cast("long")
    rows = per_source.withColumn("kind", kind).withColumn("weight", weight)
    # ascending order of cap / weight, in whole numbers
    scale = 1
    for w in WEIGHTS:
        scale *= w
    rank = F.col("source_size") * (F.lit(scale) / F.col("weight")).cast("long")
    before = Window.orderBy(rank, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum(CAP * F.col("source_size")).over(before), F.lit(0))
    spent = F.coalesce(F.sum("weight").over(before), F.lit(0))
    rows = rows.withColumn("_level", (F.sum("source_size").over(everything) - capped).cast("double") / (F.sum("weight").over(everything) - spent))
    fits = F.col("_level") * F.col("weight") <= (CAP * F.col("source_size")).cast("double")
    level = F.coalesce(F.max(F.when(fits, F.col("_level"))).over(everything), F.lit(0.0))
    return rows.withColumn("target", F.least((CAP * F.col("source_size")).cast("double"), level * F.col("weight"))).drop("_level")


def _position(words: Column, epoch: Column) -> Column:
    """Inverse of D(t) = target (t + slope (t^2 - t)) so many words into an epoch; null beyond training.  Never falls as words grow."""
    slope = F.element_at(F.array(*map(F.lit, SLOPES)), F.col("kind") + 1)
    share = (words + epoch * F.col("source_size")) / F.col("target")
    inner = (1 - slope) * (1 - slope) + 4 * slope * share
    t = F.when(slope == 0, share).otherwise((F.sqrt(F.greatest(inner, F.lit(0.0))) - (1 - slope)) / (2 * slope))
    return F.when((F.col("target") > 0) & (t <= 1), t)


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", buckets: int | None = None) -> DataFrame:
    """All columns of ``docs`` with size, source_size, target and positions (one a copy taken, ascending)."""
    n = buckets or max(1, -(-docs.count() // BUCKET))
    own = F.struct(*[F.col("`" + c + "`") for c in docs.columns]).alias("_row")
    rows = docs.select(own, F.col(source).alias("_source"), n_words(text).alias("_size"), _place(key, text).alias("_place"), F.col(key).alias("_key"))
    rows = rows.withColumn("_bucket", F.shiftright(F.shiftright("_place", 30) * F.lit(n), 30).cast("int"))
    totals = rows.groupBy("_source", "_bucket").agg(F.sum("_size").alias("_words"))
    totals = spool(totals.withColumnRenamed("_source", "source"), "mix-buckets")
    plan = targets(totals.groupBy("source").agg(F.sum("_words").alias("source_size")))
    ahead = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_offset", F.coalesce(F.sum("_words").over(ahead), F.lit(0)))
    offsets = offsets.join(plan, offsets["source"].eqNullSafe(plan["source"])).select(offsets["source"].alias("_s"), F.col("_bucket").alias("_b"), "_offset", "source_size", "target", "kind")
    offsets = spool(offsets, "mix-offsets")
    within = Window.partitionBy("_source", "_bucket").orderBy("_place", "_key", "_size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_ahead", F.coalesce(F.sum("_size").over(within), F.lit(0)))
    placed = placed.join(offsets, placed["_source"].eqNullSafe(offsets["_s"]) & (placed["_bucket"] == offsets["_b"]))
    middle = (F.col("_offset") + F.col("_ahead")).cast("double") + F.col("_size") / 2
    positions = F.array_compact(F.array(*[_position(middle, F.lit(e)) for e in range(CAP)]))
    added = ("size", "source_size", "target", "positions")
    return placed.select("_row", F.col("_size").alias("size"), "source_size", "target", positions.alias("positions")).select(*[F.col("_row.`" + c + "`") for c in docs.columns if c.lower() not in added], *added)


def ordered(mixed: DataFrame) -> DataFrame:
    """The training order: a row for each copy taken, range-sorted by position."""
    copies = mixed.withColumn("position", F.explode("positions")).drop("positions")
    return copies.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def in_order(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """``ordered(mix(docs))`` with the columns of ``docs`` only, whose whole rows move once; Spark must be able to hash them.

    Rows of one place (one id and text) go to every part that holds a copy of one of them, and each copy is
    kept in its own part.  Where that would double the rows, which takes very many repeated ones, `mix` and
    `ordered` move them twice.
    """
    n = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = lambda t: F.when(t.isNotNull(), F.least(F.floor(t * n), F.lit(n - 1)).cast("int"))
    own = [F.col("`" + c + "`") for c in docs.columns]
    rows = docs.select(F.struct(*own).alias("_row"), F.col("source").alias("_source"), n_words("text").alias("_size"), _place("doc_id", "text").alias("_place"), F.xxhash64(*own).alias("_hash"))
    places = rows.groupBy("_source", "_place").agg(F.sum("_size").alias("_words"), F.min("_size").alias("_least"), F.count("*").alias("_times"))
    places = spool(places, "mix-places")
    plan = targets(places.groupBy(F.col("_source").alias("source")).agg(F.sum("_words").alias("source_size"), F.sum("_times").alias("rows")))
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).alias("_id")
    plan = spool(plan.select(number, F.col("source").alias("_s"), "source_size", "target", "kind", F.ceil(F.col("rows") / BUCKET).alias("_buckets")), "mix-plan")

    def planned(rows: DataFrame) -> DataFrame:
        bucket = F.shiftright(F.shiftright("_place", 30) * F.col("_buckets"), 30).cast("int")
        return rows.join(_held(plan), rows["_source"].eqNullSafe(plan["_s"])).drop("_source", "_s").withColumn("_bucket", bucket).drop("_buckets")

    spans = planned(places)
    ahead = Window.partitionBy("_id").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spans.groupBy("_id", "_bucket").agg(F.sum("_words").alias("_total"))
    offsets = spool(offsets.select("_id", "_bucket", F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_offset")), "mix-offsets")
    within = Window.partitionBy("_id", "_bucket").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_ahead", F.coalesce(F.sum("_words").over(within), F.lit(0))).join(_held(offsets), ["_id", "_bucket"])
    spans = spans.withColumn("_ahead", F.col("_offset") + F.col("_ahead")).withColumn("_epoch", F.explode(F.array(*map(F.lit, range(CAP)))))
    first = _position(F.col("_ahead").cast("double") + F.col("_least") / 2, F.col("_epoch"))
    last = _position((F.col("_ahead") + F.col("_words")).cast("double") - F.col("_least") / 2, F.col("_epoch"))
    spans = spans.withColumn("_first", part(first)).where(F.col("_first").isNotNull()).withColumn("_part", F.explode(F.sequence("_first", F.coalesce(part(last), F.lit(n - 1)))))
    begun = F.sum(F.when(F.col("_part") == F.col("_first"), F.col("_times")))
    spans = spans.groupBy("_id", "_bucket", "_epoch", "_part").agg(F.min("_place").alias("_low"), F.max("_place").alias("_high"), F.min("_ahead").alias("_start"), F.sum("_times").alias("_sent"), begun.alias("_begun"))
    spans = spool(spans, "mix-parts")
    release(places, offsets)
    sent, begun = spans.agg(F.sum("_sent"), F.sum("_begun")).first()
    if (sent or 0) > 2 * (begun or 0):
        return ordered(mix(docs.select(F.struct(*own).alias("_own"), "doc_id", "source", "text"))).select("_own.*")
    copies = planned(rows).join(_held(spans.drop("_sent", "_begun")), ["_id", "_bucket"]).where(F.col("_place").between(F.col("_low"), F.col("_high"))).drop("_low", "_high")
    copies = copies.repartitionByRange("_part")  # of one place all copies of an epoch are there, so their order can be found
    within = Window.partitionBy("_part", "_id", "_bucket", "_epoch").orderBy("_place", "_row.doc_id", "_size", "_hash").rowsBetween(Window.unboundedPreceding, -1)
    copies = copies.withColumn("_ahead", F.coalesce(F.sum("_size").over(within), F.lit(0)))
    middle = (F.col("_start") + F.col("_ahead")).cast("double") + F.col("_size") / 2
    placed = copies.withColumn("_position", _position(middle, F.col("_epoch"))).where(part(F.col("_position")) == F.col("_part"))
    return placed.sortWithinPartitions("_position", "_row.doc_id").select(*[F.col("_row.`" + c + "`") for c in docs.columns])


def _held(small: DataFrame) -> DataFrame:
    """Broadcast if it has at most HELD rows, so that what it is joined to isn't moved."""
    return F.broadcast(small) if small.count() <= HELD else small


def summary(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken and the first and last training position, range-sorted by the first.

    Documents that aren't taken have no positions and come first.
    """
    mixed = mix(docs.select("doc_id", "source", "text"))
    at = lambda i: F.round(F.try_element_at("positions", F.lit(i)), 9)
    rows = mixed.select("doc_id", "size", "source_size", "target", (F.size("positions") * F.col("size")).alias("taken"), at(1).alias("first_position"), at(-1).alias("last_position"))
    return rows.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")


SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15) AS place
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
n AS (SELECT *, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS kind FROM s),
k AS (SELECT *, CAST([5, 2, 1][1 + kind] AS BIGINT) AS weight, CAST([-0.5, 0.0, 0.5][1 + kind] AS DOUBLE) AS slope FROM n),
l AS (SELECT *,
        CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0) AS DOUBLE) / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS DOUBLE) AS level
      FROM k WINDOW w AS (ORDER BY source_size * (10 // weight), source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, slope, least(CAST(3 * source_size AS DOUBLE), weight * max(level) FILTER (WHERE level * weight <= CAST(3 * source_size AS DOUBLE)) OVER ()) AS target FROM l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.slope,
        CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) + CAST(size AS DOUBLE) / 2 AS middle
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, list_transform([0, 1, 2], lambda e: CASE WHEN target > 0 THEN (middle + e * source_size) / target END) AS shares FROM p),
i AS (SELECT *, list_filter(list_transform(shares, lambda x: CASE WHEN slope = 0 THEN x
        ELSE (sqrt(greatest((1 - slope) * (1 - slope) + 4 * slope * x, 0)) - (1 - slope)) / (2 * slope) END), lambda x: x <= 1) AS positions FROM c)
SELECT doc_id, size, source_size, target, CAST(size * len(positions) AS BIGINT) AS taken, round(positions[1], 9) AS first_position, round(positions[len(positions)], 9) AS last_position
FROM i
"""
