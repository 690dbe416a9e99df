"""MinHash near-dedup by a multi-index Hamming join.

Texts with equal shingle sets form a class at once.  A class's signature is CHUNKS x WIDTH MinHash
values of b = 16 bits.  It is split into CHUNKS chunks by pigeonhole: two signatures that differ in at
most CHUNKS x (ERRORS + 1) - 1 values have a chunk that differs in at most ERRORS = 1, and enumerating
which value of the chunk errs (that is, leaving each out in turn) makes that pair meet in one index
key.  So all pairs under that signature distance meet.  Pairs that meet are confirmed on full sets.

A key with many classes is not expanded into all pairs: its smallest class is the centre, and the
others are confirmed against it.  Classes that are then in one component need no further look; for
keys that still hold several components another centre is tried, CENTRES times.  The classes of the
keys that are still mixed then go through an exact join of their full sets across components: shingles
in order of rarity, a shared one among the first few, and the sizes and places of the shared one must
leave room for enough others.  So no link between components is lost, however large a group is.

Every pair that meets is confirmed on full sets, whatever its signatures say.  An index key that more than HOT
classes share is dealt by salts, so that no task gets them all.

A document's set: distinct 3-word shingles of the words (A-Z lower-cased, split at ASCII white space);
with fewer words, the whole sequence.  Null or empty texts have no set and no links.  Repeated rows are
of one class.  Every row is judged by its own text: rows with one doc_id and different texts are documents
of their own that happen to share a name, and their component_id may differ.  A row with a null id is
linked like any other; its component_id is the smallest id of its component, null if there is none, and it
counts as kept only then.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curblake.llm.common import by_batch, release, spool
from curblake.llm.components import components

SHINGLE = 3
#: Link from this Jaccard similarity, in hundredths.
SIMILAR = 85
CHUNKS, WIDTH, ERRORS = 6, 5, 1
#: Classes of an index key that one task gets.
HOT = 1000
CENTRES = 1
WORDS = 200_000

_MIX = np.random.default_rng(8).integers(1, 1 << 63, CHUNKS * WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hash = _WordHash()


def forget() -> None:
    _hash.clear()


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: only A-Z and ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hash.__getitem__, words), np.uint64, len(words))
    n = min(SHINGLE, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = _spread(out * np.uint64(0xC2B2AE3D27D4EB4F) + h[i : len(h) - n + 1 + i])
    return np.unique(out)


def _digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def signature(found: np.ndarray) -> list[int]:
    lowest = np.array([(found * m).min() for m in _MIX])
    return (_spread(lowest) >> np.uint64(48)).astype(np.uint16).view(np.int16).tolist()


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, print (of the text), n (set size), class (digest of the set; null if empty) and sig."""

    def run(ids: list, prints: list, texts: list) -> list:
        sets = list(map(shingles, texts))
        return [ids, prints, [len(s) for s in sets], [_digest(s) if len(s) else None for s in sets], [signature(s) if len(s) else None for s in sets]]

    printed = docs.select("doc_id", F.xxhash64("text").alias("print"), "text")
    return by_batch(printed, "doc_id long, print long, n long, class binary, sig array<smallint>", run, "doc_id", "print", "text", done=forget)


def classes_of(rows: DataFrame) -> DataFrame:
    """class, rep (its smallest doc_id), n, sig, copies and node: rep, or a hash where several classes share a rep or it is null."""
    found = rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("sig").alias("sig"), F.count("*").alias("copies"))
    found = spool(found, "class-sets")
    first = found.where(F.col("rep").isNotNull()).groupBy("rep").agg(F.min("class").alias("_first"), F.count("*").alias("_many"))
    first = spool(first.where(F.col("_many") > 1).select(F.col("rep").alias("_rep"), "_first"), "shared-ids")
    marked = found.join(first, found["rep"] == first["_rep"], "left").withColumn("plain", F.col("rep").isNotNull() & F.col("_first").isNull())
    other = ~F.col("plain") & ~F.coalesce(F.col("_first") == F.col("class"), F.lit(False))
    seed = 0
    while True:  # until no hash is taken
        named = marked.withColumn("node", F.when(other, F.xxhash64("class", F.lit(seed))).otherwise(F.col("rep"))).drop("_rep", "_first")
        named = spool(named, "classes")
        odd = named.where(~F.col("plain")).select("node")
        if odd.isEmpty() or named.join(odd.distinct(), "node", "left_semi").groupBy("node").count().where("count > 1").isEmpty():
            return named
        seed += 1


def _keys() -> Column:
    """The index keys of a signature: each chunk with each of its values left out."""
    out = []
    for c in range(CHUNKS):
        values = [F.col("sig")[c * WIDTH + i] for i in range(WIDTH)]
        out += [F.xxhash64(F.lit(c * WIDTH + left), *[v for i, v in enumerate(values) if i != left]) for left in range(WIDTH)]
    return F.array(*out)


def _sets(docs: DataFrame, wanted: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, set) of the wanted classes, from the texts of the documents that name them."""
    wanted = spool(classes.join(wanted, "node", "left_semi").select("node", "rep", "class", "plain"), "wanted")

    def run(ids: list, texts: list) -> list:
        sets = list(map(shingles, texts))
        return [ids, [_digest(s) for s in sets], [s.view(np.int64).tolist() for s in sets]]

    def read(texts: DataFrame) -> DataFrame:
        return by_batch(texts.where(F.length("text") > 0), "node long, class binary, set array<bigint>", run, "doc_id", "text", done=forget).where(F.size("set") > 0)

    plain = wanted.where("plain").select("node")
    found = read(docs.join(plain, docs["doc_id"] == plain["node"], "left_semi")).select("node", "set")
    odd = wanted.where("NOT plain")
    if not odd.isEmpty():  # ids that several texts share, and null ids: by the set's digest
        reps = odd.select("rep").distinct()
        own = read(docs.join(reps, docs["doc_id"].eqNullSafe(reps["rep"]), "left_semi")).select("class", "set")
        found = found.unionByName(own.join(odd.select("class", "node"), "class").select("node", "set"))
    return found.dropDuplicates(["node"])  # equal sets


def _confirm(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    small = classes.select("node", "n")
    near = pairs.join(small.select(F.col("node").alias("a"), F.col("n").alias("na")), "a").join(small.select(F.col("node").alias("b"), F.col("n").alias("nb")), "b")
    near = spool(near.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * SIMILAR), "near-pairs")
    sets = spool(_sets(docs, near.select(F.explode(F.array("a", "b")).alias("node")).distinct(), classes), "sets")
    full = near.join(sets.select(F.col("node").alias("a"), F.col("set").alias("sa")), "a").join(sets.select(F.col("node").alias("b"), F.col("set").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    links = spool(full.where(both * 100 >= (F.col("na") + F.col("nb") - both) * SIMILAR).select("a", "b"), "links")
    release(near, sets)
    return links


def _across(docs: DataFrame, nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes(node, component) in different components that may be similar; none that is similar is missing.

    Two sets of m <= n shingles are similar if they share at least s = 17 (m + n) / 37.  In one order of
    all shingles the first shared one is among the first m - s + 1 and n - s + 1, and as many as s - 1
    must follow it in both.
    """
    sets = spool(_sets(docs, nodes.select("node"), classes), "rest-sets")
    tokens = sets.select("node", F.size("set").alias("n"), F.explode("set").alias("token"))
    common = tokens.groupBy("token").agg(F.count("*").alias("times"))
    order = Window.partitionBy("node").orderBy("times", "token")
    ranked = tokens.join(common, "token").withColumn("place", F.row_number().over(order))
    least = lambda m, n: F.ceil(F.lit(17) * (m + n) / 37).cast("int")
    ranked = ranked.where((F.col("times") > 1) & (F.col("place") <= F.col("n") - F.ceil(F.col("n") * SIMILAR / 100) + 1))
    head = spool(ranked.join(nodes, "node").select("token", "node", "component", "n", "place"), "rest-prefixes")
    short = head.where(F.col("place") <= F.col("n") - least(F.col("n"), F.col("n")) + 1).select("token", *[F.col(c).alias(f"{c}1") for c in ("node", "component", "n", "place")])
    long = head.select("token", *[F.col(c).alias(f"{c}2") for c in ("node", "component", "n", "place")])
    fits = (F.col("component1") != F.col("component2")) & ((F.col("n1") < F.col("n2")) | ((F.col("n1") == F.col("n2")) & (F.col("node1") < F.col("node2")))) & (F.col("n1") * 100 >= F.col("n2") * SIMILAR)
    room = F.least(F.col("n1") - F.col("place1"), F.col("n2") - F.col("place2")) + 1 >= least(F.col("n1"), F.col("n2"))
    return short.join(long, (short["token"] == long["token"]) & fits & room).select(*_pair("node1", "node2"))


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _shared(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(key, salt, node, centre) of the index keys that several classes share, centre: the smallest; and (key, parts) of the hot ones."""
    keys = classes.select("node", F.explode(_keys()).alias("key"))
    centres = keys.groupBy("key").agg(F.min("node").alias("centre"), F.count("*").alias("_n")).where(F.col("_n") > 1)
    centres = spool(centres.withColumn("parts", F.ceil(F.col("_n") / HOT).cast("int")).drop("_n"), "centres")
    hot = spool(centres.where(F.col("parts") > 1).select("key", "parts"), "hot-keys")  # at most keys / HOT rows
    dealt = keys.join(hot, "key", "left").withColumn("salt", F.pmod(F.xxhash64("node"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    return spool(dealt.join(_salted(centres), ["key", "salt"]), "shared-keys"), hot


def _salted(by_key: DataFrame) -> DataFrame:
    """A row a key (or group) -> one for each of its salts; by_key has parts."""
    return by_key.withColumn("salt", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")


def link_classes(docs: DataFrame, classes: DataFrame) -> DataFrame | None:
    """(node, component) of the classes that are linked with another."""
    shared, hot = _shared(classes)
    pairs = spool(shared.where(F.col("node") != F.col("centre")).select(*_pair("node", "centre")).distinct(), "pairs-0")
    if pairs.isEmpty():
        return None
    links = new = _confirm(pairs, docs, classes)
    tested, keys = pairs, shared.select("key", "salt", "node")
    found = None
    for turn in range(1, CENTRES + 2):
        found = spool(components(links), "components") if found is None or not new.isEmpty() else found
        own = keys.join(found, keys["node"] == found["node"], "left").select("key", "salt", keys["node"], F.coalesce(found["component"], keys["node"]).alias("component"))
        mixed = own.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).where(F.col("_lo") < F.col("_hi")).select("key")
        keys = spool(own.join(_salted(mixed.join(hot, "key", "left")), ["key", "salt"], "left_semi"), f"mixed-{turn}")
        if keys.isEmpty():
            return found
        if turn <= CENTRES:  # another centre for each key
            place = F.struct(F.xxhash64("node", F.lit(turn)).alias("h"), "node", "component")
            centre = keys.groupBy("key").agg(F.min(place).alias("c"))
            pairs = keys.join(_salted(centre.join(hot, "key", "left")), ["key", "salt"]).where(F.col("component") != F.col("c.component")).select(*_pair("node", "c.node"))
        else:  # the rest, exactly
            pairs = _across(docs, spool(keys.select("node", "component").distinct(), "rest-nodes"), classes)
        pairs = spool(pairs.distinct().join(tested, ["a", "b"], "left_anti"), f"pairs-{turn}")
        new = _confirm(pairs, docs, classes)
        tested, links, keys = tested.unionByName(pairs), links.unionByName(new), keys.select("key", "salt", "node")
    return spool(components(links), "components") if not new.isEmpty() else found


def _grouped(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with print and class; class, group and component_id of the classes with several rows or a link)."""
    docs = docs.select("doc_id", "text")
    rows = spool(signed(docs), "signatures")
    classes = classes_of(rows)
    found = link_classes(docs, classes)
    group = classes.select("class", "node", "rep", "copies")
    if found is None:
        named = group.where(F.col("copies") > 1).select("class", F.col("node").alias("group"), F.col("rep").alias("component_id"))
    else:
        group = group.join(found, "node", "left").where((F.col("copies") > 1) | F.col("component").isNotNull()).withColumn("group", F.coalesce("component", "node"))
        group = spool(group.select("class", "rep", "group"), "groups")
        lowest = group.groupBy("group").agg(F.min("rep").alias("component_id"))
        named = group.join(lowest, "group").select("class", "group", "component_id")
    return rows, spool(named, "named")


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    rows, named = _grouped(docs)
    linked = F.col("group").isNotNull()
    out = rows.select("doc_id", F.col("n").alias("n_shingles"), "class").join(named, "class", "left")
    out = out.withColumn("component_id", F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id, nulls last; texts with no words all stay.

    Of rows with one id and one text the smallest in all columns stays, so reruns agree.
    """
    rows, named = _grouped(docs)
    member = rows.select("doc_id", "print", "class").join(named.select("class", "group"), "class")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "print")
    member = spool(member.groupBy("group", "doc_id", "print").agg(F.count("*").alias("times")).withColumn("key", key), "members")
    best = member.groupBy("group").agg(F.min("key").alias("best"), F.ceil(F.count("*") / HOT).cast("int").alias("parts"))
    best = spool(best, "best")
    hot = spool(best.where(F.col("parts") > 1).select("group", "parts"), "hot-groups")  # at most members / HOT rows
    dealt = member.join(hot, "group", "left").withColumn("salt", F.pmod(F.xxhash64("key"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    judged = dealt.join(_salted(best), ["group", "salt"]).select("doc_id", "print", "times", (F.col("key") == F.col("best")).alias("wins"))
    judged = spool(judged, "copies")
    own = lambda side: docs["doc_id"].eqNullSafe(side["doc_id"]) & (F.xxhash64(docs["text"]) == side["print"])
    gone = judged.where(~F.col("wins") | (F.col("times") > 1))
    kept = docs.join(gone, own(gone), "left_anti")
    again = judged.where(F.col("wins") & (F.col("times") > 1))
    if again.isEmpty():
        return kept
    columns = [F.col("`" + c + "`") for c in docs.columns]
    repeated = docs.join(again, own(again), "left_semi").groupBy("doc_id", F.xxhash64("text").alias("_print")).agg(F.min(F.struct(*columns)).alias("_row"))
    return kept.unionByName(repeated.select(*[F.col("_row.`" + c + "`") for c in docs.columns]))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(a, b) AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a, min(b) AS low FROM r GROUP BY a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(m.low, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(m.low, d.doc_id)) AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.a = d.doc_id
"""
