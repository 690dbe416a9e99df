"""Entity resolution: names to legal keys and name pairs to intersections."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curblake.functions.distinct import distinct_apply
from curblake.functions.names import legal_key, lookup_key, root, tokens
from curblake.functions.rx import computed


@dataclass
class NameIndex:
    """Dimensions of the legal names: legal(key), variant(variant, legal), base(base, legal), alias(name, legal)."""

    legal: DataFrame
    variant: DataFrame
    base: DataFrame
    alias: DataFrame

    @classmethod
    def of(cls, names: DataFrame, alias: DataFrame) -> NameIndex:
        """From rows (legal, full, base) with values joined by ' | '; of equal alias names the last (largest legal) counts."""
        key = names.select(legal_key(F.col("legal")).alias("legal"), "full", "base")
        many = lambda c: F.explode(F.split(F.coalesce(F.col(c), F.lit("")), r" \| "))
        variant = key.select(many("full").alias("v"), "legal").where("v <> ''").groupBy(legal_key(F.col("v")).alias("variant")).agg(F.min("legal").alias("legal"))
        base = key.select(many("base").alias("b"), "legal").where("b <> ''").select(legal_key(F.col("b")).alias("base"), "legal").distinct()
        found = alias.groupBy(legal_key(F.col("name")).alias("name")).agg(F.max(legal_key(F.col("legal"))).alias("legal"))
        return cls(key.select("legal").distinct(), variant, base, found)

    def unique_bases(self) -> DataFrame:
        """Bases with one legal name only."""
        return self.base.groupBy("base").agg(F.min("legal").alias("legal"), F.countDistinct("legal").alias("n")).where("n = 1").drop("n")

    def prefixes(self) -> DataFrame:
        """(prefix, hits): how many legal names start with each run of their first words."""
        words = F.split("legal", " ")
        run = F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, 1, n), " "))
        return self.legal.select("legal", F.explode(run).alias("prefix")).groupBy("prefix").agg(F.count("*").alias("hits"))


def _deletions(c: str):  # noqa: ANN202
    """The text and each text with one letter less: two texts within one edit share one of them."""
    t = F.col(c)
    less = F.transform(F.sequence(F.lit(1), F.length(t)), lambda i: F.concat(F.substring(t, F.lit(1), i - 1), F.substring(t, i + 1, F.length(t))))
    return F.array_distinct(F.concat(F.array(t), less))


def near_matches(names: DataFrame, legal: DataFrame) -> DataFrame:
    """(key, legal) within one edit of the base words, with equal type and compatible cardinal; an equi-join on deletions."""
    def parts(df: DataFrame, name: str, mark: str) -> DataFrame:
        core, kind, cardinal = tokens(F.col(name))
        rows = computed(df, **{f"core{mark}": core, f"kind{mark}": kind, f"way{mark}": cardinal})
        return rows.where(F.length(f"core{mark}") >= (4 if mark == "1" else 1)).withColumn("_d", F.explode(_deletions(f"core{mark}")))

    near = parts(names, "key", "1").join(parts(legal, "legal", "2"), "_d")
    gates = (F.col("kind1").isNull() | F.col("kind1").eqNullSafe(F.col("kind2"))) & (F.col("way1").isNull() | F.col("way1").eqNullSafe(F.col("way2")))
    return near.where(gates & (F.levenshtein("core1", "core2", 1) >= 0)).select("key", "legal").distinct()


def resolve_names(rows: DataFrame, index: NameIndex, name: str = "highway") -> DataFrame:
    """Adds key, resolved, tier (the first that hit) and resolve_valid; each distinct name is resolved once."""

    def parse(names: DataFrame) -> DataFrame:
        k = computed(names, raw_key=legal_key(F.col(name)), key=lookup_key(F.col(name)))
        k = computed(k, root=root(F.col("key")))
        hyphens = F.array(F.regexp_replace("key", "-", " "), F.regexp_replace("key", "^([^ ]+) ", "$1-"))
        spaced = F.regexp_replace("root", r"^(mc|mac)([a-z]\S*)$", "$1 $2")
        k = k.join(index.alias.select(F.col("name").alias("raw_key"), F.col("legal").alias("t1")), "raw_key", "left")
        k = k.join(index.legal.select(F.col("legal").alias("key"), F.col("legal").alias("t2")), "key", "left")
        k = k.join(index.variant.select(F.col("variant").alias("key"), F.col("legal").alias("t3")), "key", "left")
        k = k.join(index.unique_bases().select(F.col("base").alias("root"), F.col("legal").alias("t4")), "root", "left")
        k = k.join(index.prefixes().select(F.col("prefix").alias("root"), "hits"), "root", "left").withColumn("hits", F.coalesce("hits", F.lit(0)))
        k = k.withColumn("_spaced", spaced).join(index.legal.select(F.col("legal").alias("_spaced"), F.col("legal").alias("t5")), "_spaced", "left")
        dashed = k.select(name, "key", F.posexplode(hyphens).alias("_n", "_h")).where(F.col("_h") != F.col("key")).join(index.legal.select(F.col("legal").alias("_h")), "_h").groupBy(name).agg(F.min_by("_h", "_n").alias("t6"))
        near = near_matches(k.select("key").distinct(), index.legal).groupBy("key").agg(F.min("legal").alias("t8"), F.count("*").alias("_m")).where("_m = 1").drop("_m")
        k = k.join(dashed.withColumnRenamed(name, "_name"), F.col(name).eqNullSafe(F.col("_name")), "left").drop("_name").join(near, "key", "left")
        clear = F.col("hits") <= 1
        tiers = [F.col("t1"), F.col("t2"), F.col("t3"), F.when(clear, F.col("t4")), F.when(clear, F.col("t5")), F.when(clear, F.col("t6")), F.when(clear, F.col("t8"))]
        tier = F.coalesce(*[F.when(t.isNotNull(), F.lit(n)) for t, n in zip(tiers, ("alias", "legal", "variant", "base", "spacing", "hyphen", "edit"), strict=True)], F.lit("none"))
        return k.select(name, "key", F.coalesce(*tiers, F.col("key")).alias("resolved"), tier.alias("tier"))

    out = distinct_apply(rows, [name], parse)
    return out.withColumn("resolve_valid", F.col("tier") != "none")


def postings(tokens_: DataFrame, descriptions: DataFrame, size: int = 3) -> DataFrame:
    """(token, id, ord) where the description holds the token as a substring, however short it is.

    Any text that holds a token holds every run of ``size`` letters of it, so both sides meet on the token's rarest run before
    the exact test; a token with fewer letters meets on itself.  A broadcast loop over all descriptions isn't needed.
    """
    low = descriptions.select("id", "ord", F.lower("description").alias("d"))
    runs = lambda c, n: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - n + 1, F.lit(1))), lambda i: F.substring(c, i, F.lit(n))))
    asked = tokens_.select("token").distinct().where(F.length("token") > 0)
    lengths = [r["n"] for r in asked.where(F.length("token") < size).select(F.length("token").alias("n")).distinct().collect()]  # size - 1 at most
    parts = whole = low.withColumn("_g", F.explode(runs("d", size)))
    for n in lengths:
        parts = parts.unionByName(low.withColumn("_g", F.explode(runs("d", n))))
    common = whole.groupBy("_g").agg(F.count("*").alias("_times"))
    long = asked.where(F.length("token") >= size).withColumn("_g", F.explode(runs("token", size))).join(common, "_g", "left")
    rarest = long.groupBy("token").agg(F.min_by("_g", F.struct(F.coalesce("_times", F.lit(0)), "_g")).alias("_g"))
    keyed = rarest.unionByName(asked.where(F.length("token") < size).select("token", F.col("token").alias("_g")))
    return keyed.join(parts, "_g").where(F.col("d").contains(F.col("token"))).select("token", "id", "ord")


def pair_intersections(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """pairs(pair, tokens1, tokens2) -> (pair, ids, n): the ids, in file order, of the first token pair with any."""
    side = lambda k: pairs.select("pair", F.posexplode(f"tokens{k}").alias(f"r{k}", "token")).join(found, "token").select("pair", f"r{k}", "id", "ord")
    both = side(1).join(side(2).drop("ord"), ["pair", "id"])
    ranked = both.groupBy("pair", "r1", "r2").agg(F.array_sort(F.collect_set(F.struct("ord", "id"))).alias("ids"))
    best = Window.partitionBy("pair").orderBy("r1", "r2")
    return ranked.withColumn("_n", F.row_number().over(best)).where("_n = 1").select("pair", F.transform("ids", lambda x: x["id"]).alias("ids"), F.size("ids").alias("n"))


def root_pairs(pairs: DataFrame, descriptions: DataFrame) -> DataFrame:
    """(pair, id) where exactly one intersection has legs with the roots of both names."""
    legs = descriptions.select("id", F.explode(F.transform(F.split("description", "/"), F.trim)).alias("leg")).select("id", root(F.col("leg")).alias("root")).distinct()
    one = pairs.select("pair", root(F.col("name1")).alias("root")).join(legs, "root").select("pair", "id")
    two = pairs.select("pair", root(F.col("name2")).alias("root")).join(legs, "root").select("pair", "id")
    return one.join(two, ["pair", "id"]).groupBy("pair").agg(F.min("id").alias("id"), F.countDistinct("id").alias("n")).where("n = 1").drop("n")


def collisions(names: DataFrame) -> DataFrame:
    """Legal keys that several input names resolve to."""
    return names.groupBy("resolved").agg(F.countDistinct("highway").alias("names")).where("names > 1")
