"""Personal data: base expressions and bootstrapped contextual extraction; DataFrame functions only.

Base spans are the leftmost non-overlapping matches of four expressions, less those that fail their
test.  The base entities are the first seeds.  What may be an instance beside them is a whole run of
tokens with a digit or an @ that no base span touches.  The words around an instance are its lexical
patterns: one or two to the left, one or two to the right, and one on either side together.  Patterns and
instances form a graph that Spark scores: a pattern's confidence in a kind is the mean belief of its
instances, 1 for a seed of the kind, 0 for a seed of another and for an instance that can't be of the kind
(PLAUSIBLE); another instance's belief is the mean confidence of its patterns.  Patterns with at least SUPPORT
different seeds and a confidence of CONFIDENCE give their kind to the plausible instances beside them, which
are seeds from then on, and so on until no pattern finds a new one.  An instance that is found is found
wherever it stands.

Extra columns are left alone, whatever they are named.  Null and empty texts have no spans.  Positions count code points; ends are exclusive.  Repeated rows
get the same spans each.  A null id is kept as it is.  Texts are read whole.

The expressions are written without backtracking (possessive, and emails start only where a run starts
or the last match ended), so that long runs cost linear time and no stack; they match the same spans as
the plain forms EMAIL, IP, CARD and PHONE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curblake.llm.common import release, spool

#: Plain forms, as stated; fixed values.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

KINDS = ("email", "ip", "card", "phone")
FORMS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": PHONE,
}
#: Tokens with a digit or an @.
TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
SUPPORT, CONFIDENCE = 5, 0.9
#: Characters on either side that are looked at first for the next two words; where they don't hold two, all are.
REACH = 64
#: Characters between two tokens of a run.
GAP = 2
CHUNK = 256


def _running(lengths: str) -> Column:
    """Inclusive running sums of an array column, in chunks so that long arrays don't cost their square."""
    total = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda a, x: a + x)
    whole = F.col(lengths)
    ahead = F.transform(F.sequence(F.lit(0), F.floor(F.size(whole) / CHUNK).cast("int")), lambda c: total(F.slice(whole, 1, (c * CHUNK).cast("int"))))
    return F.flatten(F.transform(ahead, lambda start, c: _within(F.slice(whole, (c * CHUNK + 1).cast("int"), CHUNK), start)))


def _within(part: Column, start: Column) -> Column:
    total = lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda a, x: a + x)
    return F.transform(part, lambda _, i: start + total(F.slice(part, 1, i + 1)))


def located(docs: DataFrame, text: str, form: str, to: str, maybe: Column, test=None) -> DataFrame:  # noqa: ANN001
    """Adds array ``to`` of (start, end, value) of all matches of ``form``; ``maybe``: a cheap test that rules out most texts."""
    none = F.array().cast("array<string>")
    here = F.when(maybe, F.col(text))
    out = docs.withColumn("_found", F.coalesce(F.regexp_extract_all(here, F.lit(form), F.lit(0)), none))
    out = out.withColumn("_between", F.when(F.size("_found") > 0, F.transform(F.split(here, form, -1), lambda p: F.length(p).cast("long"))))
    out = out.withColumn("_steps", F.zip_with(F.slice("_between", 1, F.size("_found")), "_found", lambda b, m: b + F.length(m)))
    out = out.withColumn("_ends", F.when(F.size("_found") > 0, F.slice(_running("_steps"), 1, F.size("_found"))))
    spans = F.zip_with("_ends", "_found", lambda e, m: F.struct((e - F.length(m)).alias("start"), e.alias("end"), m.alias("value")))
    spans = F.coalesce(spans, F.array().cast("array<struct<start:bigint,end:bigint,value:string>>"))
    out = out.withColumn(to, F.filter(spans, lambda s: test(s["value"])) if test else spans)
    return out.drop("_found", "_between", "_steps", "_ends")


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """14 to 19 digits whose Luhn sum ends in 0."""
    d = _digits(value)
    n = F.length(d)

    def part(i: Column) -> Column:
        x = F.substring(d, n - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(x > 9, x - 9).otherwise(x)

    return F.when(n.between(14, 19), F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda a, i: a + part(i)) % 10 == 0).otherwise(False)


TESTS = {
    "email": None,
    "ip": lambda v: F.forall(F.split(v, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")),
    "card": _luhn,
    "phone": lambda v: F.length(_digits(v)).between(10, 15),
}


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds array ``base`` of (start, kind, end, value), by start and kind (a number, as listed)."""
    digit = F.col(text).rlike("[0-9]")
    maybe = {"email": F.col(text).contains("@"), "ip": digit, "card": digit, "phone": F.col(text).contains("+")}
    out = docs
    for kind in KINDS:
        out = located(out, text, FORMS[kind], f"_{kind}", maybe[kind], TESTS[kind])

    def numbered(number: int) -> Column:
        return F.transform(f"_{KINDS[number]}", lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))

    return out.withColumn("base", F.array_sort(F.concat(*map(numbered, range(len(KINDS)))))).drop(*[f"_{k}" for k in KINDS])


#: Whether a text can be of a kind that the base expression missed.
PLAUSIBLE = (
    lambda v: v.contains("@"),
    lambda v: v.rlike(r"^[0-9a-fA-F]*+(?:[.:][0-9a-fA-F]*+){3,}$"),
    lambda v: F.length(_digits(v)).between(12, 19) & ~v.rlike(r"\p{L}|@"),
    lambda v: F.length(_digits(v)).between(7, 15) & ~v.rlike(r"\p{L}|@"),
)


def _beside(text: Column, at: Column, left: bool) -> Column:
    """The two words before or after a place, nearest first, in small letters and without punctuation at their ends."""
    n = F.length(text)
    if left:
        near, every = F.substring(text, F.greatest(at - REACH, F.lit(0)).cast("int") + 1, F.least(at, F.lit(REACH)).cast("int")), F.substring(text, F.lit(1), at.cast("int"))
    else:
        near, every = F.substring(text, at.cast("int") + 1, F.lit(REACH)), F.substring(text, at.cast("int") + 1, n)
    words = lambda c: F.filter(F.split(c, r"\s+"), lambda w: w != "")
    whole = (at <= REACH) if left else (n - at <= REACH)
    found = F.when(whole | (F.size(words(near)) > 2), words(near)).otherwise(words(every))
    found = F.slice(F.reverse(found), 1, 2) if left else F.slice(found, 1, 2)
    bare = lambda w: F.regexp_replace(w, r"^[\p{Punct}]++|[\p{Punct}]++$", "")
    return F.transform(found, lambda w: F.lower(F.when(bare(w) != "", bare(w)).otherwise(w)))


def _patterns(left: Column, right: Column) -> Column:
    one, two = F.lit(1), F.lit(2)
    l1, l2, r1, r2 = (F.try_element_at(c, i) for c in (left, right) for i in (one, two))
    return F.array_compact(F.array(F.concat(F.lit("<"), l1), F.concat(F.lit("<<"), l2, F.lit(" "), l1), F.concat(F.lit(">"), r1), F.concat(F.lit(">>"), r1, F.lit(" "), r2), F.concat(F.lit("<>"), l1, F.lit(" "), r1)))


def contexts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds array ``tokens`` of (start, end, value, kind, patterns): base spans, and runs of tokens that may be more; needs ``base``."""
    out = located(docs, text, TOKEN, "_tokens", F.col(text).rlike("[0-9@]"))
    free = lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (b["end"] > t["start"]))
    out = out.withColumn("_free", F.filter("_tokens", free))
    joined = lambda i: (i > 0) & (F.get("_free", i)["start"] - F.get("_free", i - 1)["end"] <= GAP)
    places = F.when(F.size("_free") > 0, F.sequence(F.lit(0), F.size("_free") - 1)).otherwise(F.array().cast("array<int>"))
    first, last = F.filter(places, lambda i: ~joined(i)), F.filter(places, lambda i: (i == F.size("_free") - 1) | ~joined(i + 1))
    out = out.withColumn("_runs", F.zip_with(first, last, lambda i, j: F.struct(F.get("_free", i)["start"].alias("start"), F.get("_free", j)["end"].alias("end"))))
    head, tail = r"^[\p{Punct}&&[^(+@]]++", r"[\p{Punct}&&[^)]]++$"

    def trimmed(t: Column) -> Column:
        whole = F.substring(F.col(text), t["start"].cast("int") + 1, (t["end"] - t["start"]).cast("int"))
        value = F.regexp_replace(F.regexp_replace(whole, tail, ""), head, "")
        start = t["start"] + F.length(whole) - F.length(F.regexp_replace(whole, head, ""))
        return F.struct(start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"), F.lit(None).cast("int").alias("kind"))

    known = F.transform("base", lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"), b["value"].alias("value"), b["kind"].alias("kind")))
    out = out.withColumn("_every", F.concat(known, F.filter(F.transform("_runs", trimmed), lambda t: t["end"] > t["start"])))
    seen = F.transform("_every", lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), F.lower(t["value"]).alias("value"), t["kind"].alias("kind"), _patterns(_beside(F.col(text), t["start"], True), _beside(F.col(text), t["end"], False)).alias("patterns")))
    return out.withColumn("tokens", seen).drop("_tokens", "_free", "_runs", "_every")


def _scores(edges: DataFrame) -> DataFrame:
    """(pattern, s0.., c0..): different seeds of each kind, and the confidence in it.  edges(value, pattern, kind, p0.., b0..)."""
    kinds = range(len(KINDS))
    belief = [F.when(F.col("kind").isNotNull(), (F.col("kind") == k).cast("double")).when(~F.col(f"p{k}"), 0.0).otherwise(F.col(f"b{k}")) for k in kinds]
    return edges.groupBy("pattern").agg(*[F.count_if(F.col("kind") == k).alias(f"s{k}") for k in kinds], *[F.avg(belief[k]).alias(f"c{k}") for k in kinds])


def discover(found: DataFrame) -> DataFrame:
    """found(doc_id, print, tokens) -> extra spans (doc_id, print, start, kind, end) that confident patterns name."""
    kinds = range(len(KINDS))
    instance = found.select("doc_id", "print", F.explode("tokens").alias("t")).select("doc_id", "print", "t.*")
    # equal instances (value and patterns) count once, which also keeps copies of a text from voting
    once = instance.groupBy("value", "patterns").agg(F.max("kind").alias("kind"))
    edges = spool(once.select("value", "kind", F.explode("patterns").alias("pattern")).groupBy("value", "pattern").agg(F.max("kind").alias("kind")), "pii-edges")
    plausible = [PLAUSIBLE[k](F.col("value")).alias(f"p{k}") for k in kinds]
    named = None
    while True:
        known = edges if named is None else edges.join(named, "value", "left").withColumn("kind", F.coalesce("kind", "found")).drop("found")
        known = known.select("*", *plausible)
        first = spool(_scores(known.select("*", *[F.lit(None).cast("double").alias(f"b{k}") for k in kinds])), "pii-patterns")
        unknown = known.where(F.col("kind").isNull() & F.expr(" OR ".join(f"p{k}" for k in kinds)))
        backed = first.where(F.expr(" OR ".join(f"s{k} > 0" for k in kinds)))
        belief = unknown.select("value", "pattern").join(backed, "pattern").groupBy("value").agg(*[F.avg(f"c{k}").alias(f"b{k}") for k in kinds])
        scored = spool(_scores(known.join(spool(belief, "pii-beliefs"), "value", "left")), "pii-patterns")
        sure = F.array_compact(F.array(*[F.when((F.col(f"s{k}") >= SUPPORT) & (F.col(f"c{k}") >= CONFIDENCE), F.lit(k)) for k in kinds]))
        confident = spool(scored.select("pattern", sure.alias("sure")).where(F.size("sure") > 0), "pii-confident")
        fits = F.filter("sure", lambda k: F.get(F.array(*[F.col(f"p{i}") for i in kinds]), k))
        new = unknown.join(confident, "pattern").select("value", F.explode(fits).alias("found")).groupBy("value").agg(F.min("found").alias("found"))
        new = spool(new, "pii-named")
        release(first, scored)
        if new.isEmpty():
            break
        named = new if named is None else spool(named.unionByName(new), "pii-named")
    if named is None:
        return instance.where("false").select("doc_id", "print", "start", "kind", "end")
    return instance.where(F.col("kind").isNull()).drop("kind").join(named.withColumnRenamed("found", "kind"), "value").select("doc_id", "print", "start", "kind", "end")


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, print (a hash of the text), base spans, and extra: the spans that the method adds."""
    found = contexts(base_spans(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text")), "_text"), "_text")
    found = spool(found.select("doc_id", F.xxhash64("_text").alias("print"), "base", "tokens"), "pii-spans")
    spans = F.array_sort(F.collect_set(F.struct("start", "kind", "end")))
    extra = spool(discover(found).groupBy("doc_id", "print").agg(spans.alias("extra")), "pii-extra")
    at = found["doc_id"].eqNullSafe(extra["doc_id"]) & (found["print"] == extra["print"])
    return found.join(extra, at, "left").select(found["doc_id"], found["print"], "base", F.coalesce("extra", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")).alias("extra"))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, base counts by kind, digest of the base spans, and all spans as text."""
    found = detect(docs)

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long").alias(f"n_{KINDS[number]}")

    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return found.select("doc_id", *map(count, range(len(KINDS))), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.array_sort(F.array_union(plain, F.col("extra")))).alias("spans"))


def redact(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets, e.g. [email]; overlapping spans become one, named by the first."""
    own = F.struct(*[F.col("`" + c + "`") for c in docs.columns]).alias("_row")
    packed = docs.select(own, F.col(key).alias("_key"), F.col(text).alias("_text"), F.xxhash64(text).alias("_print"))
    extra = detect(docs, key, text).where(F.size("extra") > 0).select(F.col("doc_id").alias("_id"), F.col("print").alias("_of"), "extra").distinct()
    extra = spool(extra, "pii-redact")
    rows = base_spans(packed, "_text").join(extra, F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_print") == F.col("_of")), "left")
    plain = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    rows = rows.withColumn("_all", F.array_sort(F.array_union(plain, F.coalesce("extra", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")))))
    names, source = F.array(*map(F.lit, KINDS)), F.col("_text")
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def add(a: Column, s: Column) -> Column:
        gap = F.substring(source, a["at"].cast("int") + 1, (s["start"] - a["at"]).cast("int"))
        mark = F.concat(F.lit("["), F.element_at(names, s["kind"] + 1), F.lit("]"))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.when(s["start"] >= a["at"], F.concat(a["parts"], F.array(gap, mark))).otherwise(a["parts"]).alias("parts"))

    new = F.aggregate("_all", zero, add, lambda a: F.concat(F.array_join(a["parts"], ""), F.substring(source, a["at"].cast("int") + 1, F.length(source))))
    rows = rows.withColumn("_new", F.when(F.size("_all") > 0, new).otherwise(source))
    return rows.select(*[F.col("_new").alias(c) if c == text else F.col("_row.`" + c + "`") for c in docs.columns])
