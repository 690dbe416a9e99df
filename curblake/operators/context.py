"""Names in their context: ambiguous highways by their cross streets, lanes, and why a street isn't found."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curblake.functions.names import highway_kind, legal_key, lookup_key, root
from curblake.functions.rx import computed, first, has
from curblake.operators.resolve import NameIndex, near_matches, resolve_names

#: Fields of a parse that name a cross street.
CROSS_FIELDS = ("start_intersection", "end_intersection", "offset_intersection", "terminus_street")


def _root(name: str | Column) -> Column:
    return root(lookup_key(F.col(name) if isinstance(name, str) else name))


def cross_hints(rows: DataFrame, highway: str = "highway", fields: tuple[str, ...] = CROSS_FIELDS) -> DataFrame:
    """(row, cross): the cross streets of each row's parse, each once, without those that share the highway's root."""
    said = rows.select("row", highway, F.explode(F.array(*[F.trim(f) for f in fields])).alias("cross")).where(F.length("cross") > 0)
    own = _root(highway)
    return said.where((own == "") | own.isNull() | (_root("cross") != own)).select("row", "cross").distinct()


def candidates(names: DataFrame, index: NameIndex, name: str = "highway") -> DataFrame:
    """(name, legal): the legal names that the name's root is, begins, or is a base of."""
    rooted = names.select(name).distinct().withColumn("_root", _root(name)).where(F.length("_root") > 0)
    words = F.split("legal", " ")
    heads = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, 1, n), " "))
    begun = rooted.join(index.legal.select("legal", F.explode(heads).alias("_root")), "_root").select(name, "legal")
    based = rooted.join(index.base.withColumnRenamed("base", "_root"), "_root").join(index.legal, "legal", "left_semi").select(name, "legal")
    return begun.unionByName(based).distinct()


def variants(names: DataFrame, index: NameIndex, name: str = "street") -> DataFrame:
    """(name, legal): the resolved name, if it is legal, and all candidates of the name's family."""
    resolved = resolve_names(names.select(F.col(name).alias("highway")).distinct(), index).where("resolve_valid").select(F.col("highway").alias(name), F.col("resolved").alias("legal"))
    return resolved.join(index.legal, "legal", "left_semi").select(name, "legal").unionByName(candidates(names, index, name)).distinct()


def unique_remap(pairs: DataFrame, index: NameIndex, touching: DataFrame) -> DataFrame:
    """pairs(partner, street) -> (partner, street, legal): the street's resolved name if it shares an intersection with the
    partner, else the only variant that does.  touching(legal, cross): legal names that share an intersection, both ways."""
    asked = pairs.select("partner", "street").distinct()
    resolved = resolve_names(asked.select(F.col("street").alias("highway")).distinct(), index).where("resolve_valid").select(F.col("highway").alias("street"), F.col("resolved").alias("own"))
    near = touching.select(F.col("legal").alias("_l"), F.col("cross").alias("_c")).distinct()
    hits = asked.join(variants(asked, index), "street").join(near, (F.col("legal") == F.col("_l")) & (F.col("partner") == F.col("_c")), "left_semi")
    found = hits.join(resolved, "street", "left").withColumn("_own", F.col("legal").eqNullSafe(F.col("own")))
    found = found.groupBy("partner", "street").agg(F.max(F.when(F.col("_own"), F.col("legal"))).alias("own"), F.min("legal").alias("only"), F.count_distinct("legal").alias("n"))
    return found.select("partner", "street", F.when(F.col("own").isNotNull(), F.col("own")).when(F.col("n") == 1, F.col("only")).alias("legal")).where("legal IS NOT NULL")


def resolve_in_context(rows: DataFrame, index: NameIndex, touching: DataFrame) -> DataFrame:
    """rows(row, highway and the parse's CROSS_FIELDS) -> adds resolved, tier, resolve_valid, and by: none, strong or weak.

    Only a highway whose root is the base of several legal names, in a row with cross streets, is looked at again.  Strong: the
    only candidate that shares an intersection with a cross street.  Weak: the only candidate that is a unique remap of the highway
    or of a cross street for one of the resolved cross streets.  Else the first resolution stays.
    """
    whole = resolve_names(rows, index)
    many = index.base.groupBy("base").agg(F.count_distinct("legal").alias("_n")).where("_n > 1").select("base")
    open_ = whole.withColumn("_root", _root("highway")).join(many, F.col("_root") == F.col("base"), "left_semi").select("row", "highway")
    crosses = cross_hints(rows).join(open_, "row")
    partner = resolve_names(crosses.select(F.col("cross").alias("highway")).distinct(), index).where("resolve_valid").select(F.col("highway").alias("cross"), F.col("resolved").alias("partner"))
    crosses = crosses.join(partner, "cross", "left")
    option = open_.join(candidates(open_, index), "highway").select("row", "legal")
    near = touching.select("legal", F.col("cross").alias("_c")).distinct()
    keyed = crosses.select("row", F.explode(F.array_distinct(F.array_compact(F.array("partner", legal_key(F.col("cross")))))).alias("_c")).distinct()
    strong = option.join(keyed, "row").join(near, ["legal", "_c"], "left_semi").groupBy("row").agg(F.min("legal").alias("legal"), F.count_distinct("legal").alias("n"))
    streets = crosses.select("row", "partner", F.explode(F.array("highway", "cross")).alias("street")).where("partner IS NOT NULL")
    weak = streets.join(unique_remap(streets, index, touching), ["partner", "street"]).join(option, ["row", "legal"], "left_semi")
    weak = weak.groupBy("row").agg(F.min("legal").alias("weak"), F.count_distinct("legal").alias("m")).where("m = 1").select("row", "weak")
    out = whole.join(strong.where("n = 1").select("row", F.col("legal").alias("strong")), "row", "left").join(weak, "row", "left")
    by = F.when(F.col("strong").isNotNull(), "strong").when(F.col("weak").isNotNull(), "weak").otherwise("none")
    return out.withColumns({"resolved": F.coalesce("strong", "weak", "resolved"), "by": by, "resolve_valid": F.col("resolve_valid") | (by != "none")}).drop("strong", "weak")


def lane_suffix_remap(names: DataFrame, index: NameIndex, name: str = "highway") -> DataFrame:
    """(name, legal) of names that end in lane and whose root is the base of one legal name only ("Epic Lane": epic lane road)."""
    lanes = names.select(name).distinct().where(has(legal_key(F.col(name)), r" (?:lane|ln)$")).withColumn("_root", _root(name))
    return lanes.join(index.unique_bases().withColumnRenamed("base", "_root"), "_root").select(name, "legal")


def search_names(names: DataFrame, index: NameIndex, name: str = "street") -> DataFrame:
    """(name, token): what else to look for in intersections: the only legal name of the root as base, else the resolved name."""
    rooted = names.select(name).distinct().withColumn("_root", _root(name))
    single = rooted.join(index.unique_bases().withColumnRenamed("base", "_root"), "_root", "left").select(name, "legal")
    resolved = resolve_names(names.select(F.col(name).alias("highway")).distinct(), index).select(F.col("highway").alias(name), "resolved")
    return single.join(resolved, name).select(name, F.coalesce("legal", "resolved").alias("token")).where(F.length("token") > 0)


def lookup(rows: DataFrame, index: NameIndex, touching: DataFrame, lanes: DataFrame) -> DataFrame:
    """The street of each row: in context, and where that isn't legal and the highway stands for a lane, the inferred lane.

    lanes(row, legal): what `lanes.resolve_lanes` infers, which it does for lane placeholders only.
    """
    found = resolve_in_context(rows, index, touching)
    known = index.legal.select(F.col("legal").alias("resolved"), F.lit(True).alias("_legal"))
    out = found.join(known, "resolved", "left").join(lanes.select("row", F.col("legal").alias("_lane")), "row", "left")
    use = F.col("_legal").isNull() & F.col("_lane").isNotNull()
    return out.withColumns({"resolved": F.when(use, F.col("_lane")).otherwise(F.col("resolved")), "by": F.when(use, "lane").otherwise(F.col("by")), "resolve_valid": F.col("resolve_valid") | use}).drop("_legal", "_lane")


LANE_KINDS = ("generic_lane_highway", "lane_position_in_highway", "laneway_phrase", "misleading_highway_phrase")


def diagnose(rows: DataFrame, index: NameIndex, lanes: DataFrame | None = None) -> DataFrame:
    """rows(row, highway) -> row, street_category, subcause, suggested_fix, suggested_tier, near, prefixes, bases.

    near, prefixes, bases: how many legal names are within one edit, begin with the root, have the root as base.  A plain or compound
    name that no legal or full name holds, and that nothing resolves, is truly absent.  lanes(row, legal): inferred lanes.
    """
    names = computed(rows.select("highway").distinct(), key=lookup_key(F.col("highway")), kind=highway_kind(F.col("highway")))
    names = computed(names, _root=root(F.col("key")))
    resolved = resolve_names(names.select("highway"), index).select("highway", "resolved").join(index.legal.select(F.col("legal").alias("resolved"), F.lit(True).alias("_ok")), "resolved", "left")
    near = near_matches(names.select("key").distinct(), index.legal).groupBy("key").agg(F.count("*").alias("near"))
    bases = index.base.groupBy(F.col("base").alias("_root")).agg(F.count_distinct("legal").alias("bases"))
    texts = index.legal.select("legal").unionByName(index.variant.select(F.col("variant").alias("legal"))).distinct()
    size = 3
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.length("legal") - size + 1, F.lit(1))), lambda i: F.substring("legal", i, F.lit(size)))
    held = names.select("key", F.substring("key", 1, size).alias("_g")).distinct().join(texts.withColumn("_g", F.explode(F.array_distinct(runs))), "_g").where(F.col("legal").contains(F.col("key")))
    held = held.select("key").distinct().withColumn("_held", F.lit(True))
    n = names.join(resolved, "highway", "left").join(near, "key", "left").join(index.prefixes().select(F.col("prefix").alias("_root"), F.col("hits").alias("prefixes")), "_root", "left").join(bases, "_root", "left").join(held, "key", "left")
    n = n.na.fill(0, ["near", "prefixes", "bases"])
    out = rows.select("row", "highway").join(n, "highway", "left")
    out = out.join(lanes.select("row", F.lit(True).alias("_lane")), "row", "left") if lanes is not None else out.withColumn("_lane", F.lit(None).cast("boolean"))
    ok, lane = F.coalesce(F.col("_ok"), F.lit(False)), F.coalesce(F.col("_lane"), F.lit(False))
    absent = F.col("kind").isin("plain_name", "descriptor_in_name", "compound_or_slash_highway") & F.col("_held").isNull() & ~ok & ~lane
    out = computed(out, _absent=F.coalesce(absent, F.lit(False)))
    gone, kind, near_n, prefixes_n, bases_n = F.col("_absent"), F.col("kind"), F.col("near"), F.col("prefixes"), F.col("bases")
    subcause = first(
        (gone, F.lit("truly_absent_from_tcl")), (near_n == 1, F.lit("typo_ed1_unique")), (near_n > 1, F.lit("typo_ed1_ambiguous")), (prefixes_n > 1, F.lit("prefix_ambiguous")), (prefixes_n == 1, F.lit("prefix_unique")),
        (bases_n > 1, F.lit("base_remap_ambiguous")), (bases_n == 1, F.lit("base_remap_unique")), (kind == "ramp_service_parallel", F.lit("service_road_paren")), default=kind,
    )
    fix = first(
        (ok & (F.col("resolved") != F.col("key")), F.lit("auto_highway_resolve")), (kind.isin(*LANE_KINDS), F.when(lane, "lane_infer").otherwise("skip")), (gone | ((near_n == 1) & (kind == "plain_name")), F.lit("manual_alias")),
        (((prefixes_n > 1) & (kind == "plain_name")) | (kind == "compound_or_slash_highway") | (near_n > 1), F.lit("skip")), (kind.isin("parenthetical_qualifier", "descriptor_in_name", "leg_branch_paren"), F.lit("auto_highway_resolve")),
        (kind == "ramp_service_parallel", F.lit("manual_alias")), (ok, F.lit("auto_highway_resolve")), default=F.lit("skip"),
    )
    out = computed(out, subcause=subcause, suggested_fix=fix)
    tier = first((F.col("suggested_fix") == "auto_highway_resolve", F.lit("B_quick")), (F.col("suggested_fix") == "lane_infer", F.lit("C_medium")), ((F.col("suggested_fix") == "manual_alias") & ~gone, F.lit("C_medium")), default=F.lit("D_hard"))
    return out.select("row", F.when(gone, "truly_absent_from_tcl").otherwise(kind).alias("street_category"), "subcause", "suggested_fix", tier.alias("suggested_tier"), "near", "prefixes", "bases")
