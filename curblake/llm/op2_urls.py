"""URL filter: host and path rules, and gradient-boosted trees on lexical features; DataFrame functions only.

A rule fits its host and all subdomains if the path starts with the rule's; the longest fitting rule
gives the verdict.  The other urls get the verdict of boosted trees over length, path depth, digit
ratio, character entropy, parameter count and statistics of the host's suffix (its last label: share of
blocked labelled urls, and how common it is).  The trees learn from labelled urls; here those are the
urls that a rule decides.  Suffix statistics count all labelled urls, but a suffix whose labels all come from
one rule counts as unseen, as it would only repeat that rule beyond its bounds.  While the trees learn, a url
sees the statistics of the other FOLDS (by CRC-32 of the url), never its own label.  Fold 0 is held out of the
trees; `audit` gives their AUC on it and the gain of each feature.  The trees are fitted on TRAIN distinct
labelled urls at most (a documented bound), chosen by a hash of the url, and are scored as one CASE
expression, so nothing leaves the JVM.

A null url, or one without `://`, has an empty host and path, fits no rule, and is judged by the trees
like an empty suffix.  Without labelled urls the trees allow everything.  Repeated rows are judged like
any other; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curblake.llm.common import spool

#: (verdict, rule); a rule is a host and a path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
TRAIN = 20_000
TREES, DEPTH, RATE, RIDGE, BINS = 24, 3, 0.3, 1.0, 8
#: Added counts that pull a rare suffix to the overall share.
PRIOR = 5.0
FOLDS = 5
#: Rules that must have labelled a suffix.
SOURCES = 2
FEATURES = ("length", "depth", "digits", "entropy", "parameters", "suffix_blocked", "suffix_common")


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(urls: DataFrame, url: str = "url") -> DataFrame:
    at = F.coalesce(F.instr(F.col(url), "://"), F.lit(0))
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    return urls.withColumn("_rest", rest).withColumns({"host": _lower(F.regexp_extract("_rest", r"^([^/?#]*+)", 1)), "path": F.regexp_extract("_rest", r"^[^/?#]*+([^?#]*+)", 1)}).drop("_rest")


def apply_rules(urls: DataFrame, rules: tuple = RULES) -> DataFrame:
    """Adds rule and ruled (its verdict), null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, name in sorted(rules, key=lambda r: len(r[1])):  # the longest is tested first
        host, _, path = name.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith("/" + path)
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return urls.withColumns({"rule": rule, "ruled": verdict})


def suffix() -> Column:
    return F.substring_index("host", ".", -1)


def lexical(urls: DataFrame, url: str = "url") -> DataFrame:
    """Features that only need the url; needs host and path."""
    u = F.coalesce(F.col(url), F.lit(""))
    n = F.length(u)
    chars = F.array_distinct(F.split(u, ""))
    share = lambda c: (n - F.length(F.replace(u, c))) / n
    entropy = F.when(n > 0, F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c)))).otherwise(0.0)
    count = lambda c, what: F.length(c) - F.length(F.translate(c, what, ""))
    return urls.withColumns({
        "suffix": suffix(),
        "length": n.cast("double"),
        "depth": count(F.col("path"), "/").cast("double"),
        "digits": F.when(n > 0, count(u, "0123456789") / n).otherwise(0.0),
        "entropy": entropy,
        "parameters": F.when(u.contains("?"), 1 + count(u, "&")).otherwise(0).cast("double"),
    })


def fold(url: str = "url") -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col(url), F.lit(""))), F.lit(FOLDS)).cast("int")


def suffix_statistics(labelled: DataFrame, sources: int = SOURCES) -> tuple[DataFrame, float, int]:
    """labelled(url, host, rule, blocked): a row a suffix and fold with the counts of the suffix and of the fold; the overall share of blocked; the number of labelled urls."""
    folds = labelled.groupBy(suffix().alias("_suffix"), fold().alias("_fold"), "rule").agg(F.count("*").alias("n"), F.sum(F.col("blocked").cast("long")).alias("b"))
    folds = spool(folds, "suffix-folds")
    total, blocked = folds.agg(F.sum("n"), F.sum("b")).first()
    total, blocked = total or 0, blocked or 0
    whole = folds.groupBy("_suffix").agg(F.sum("n").alias("_n"), F.sum("b").alias("_b"), F.count_distinct("rule").alias("_rules")).where(F.col("_rules") >= sources).drop("_rules")
    own = folds.groupBy("_suffix", "_fold").agg(F.sum("n").alias("_own"), F.sum("b").alias("_own_b"))
    own = own.groupBy("_suffix").agg(F.map_from_entries(F.collect_list(F.struct("_fold", F.struct("_own", "_own_b")))).alias("_folds"))  # FOLDS entries at most
    return spool(whole.join(own, "_suffix"), "suffixes"), (blocked / total if total else 0.0), total


def with_suffix(urls: DataFrame, statistics: tuple[DataFrame, float, int], learning: bool = False) -> DataFrame:
    """Left join; the planner broadcasts the statistics if the spooled table is small, else it shuffles and AQE splits hot suffixes.

    ``learning``: without the counts of the url's own fold.
    """
    table, share, total = statistics
    own = F.try_element_at("_folds", fold()) if learning else F.lit(None).cast("struct<_own:bigint,_own_b:bigint>")
    n = F.coalesce("_n", F.lit(0)) - F.coalesce(own["_own"], F.lit(0))
    b = F.coalesce("_b", F.lit(0)) - F.coalesce(own["_own_b"], F.lit(0))
    joined = urls.join(table, F.col("suffix") == F.col("_suffix"), "left")
    return joined.withColumns({"suffix_blocked": (b + PRIOR * share) / (n + PRIOR), "suffix_common": F.log1p(n) - math.log1p(total)}).drop("_suffix", "_n", "_b", "_folds")


class Trees:
    """Boosted trees over binned features: cuts by feature, and trees as nested (feature, bin, left, right) or a leaf value."""

    def __init__(self, cuts: list[list[float]], base: float, trees: list, gain: dict[str, float] | None = None) -> None:
        self.cuts, self.base, self.trees, self.gain = cuts, base, trees, gain or {}

    def column(self) -> Column:
        def walk(node: tuple | float) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            f, b, left, right = node
            return F.when(F.col(FEATURES[f]) <= F.lit(self.cuts[f][b]), walk(left)).otherwise(walk(right))

        total = F.lit(self.base)
        for tree in self.trees:
            total = total + walk(tree)
        return 1 / (1 + F.exp(-total))


def fit(rows: list[tuple[tuple[int, ...], float, float]], cuts: list[list[float]]) -> Trees:
    """rows: (bins, blocked, all).  Newton boosting of the logistic loss on counts of equal rows."""
    blocked, everything = sum(r[1] for r in rows), sum(r[2] for r in rows)
    base = math.log((blocked + 1) / (everything - blocked + 1)) if everything else -1.0
    score, trees = [base] * len(rows), []
    gains = dict.fromkeys(FEATURES, 0.0)

    def grow(index: list[int], g: list[float], h: list[float], depth: int) -> tuple | float:
        gs, hs = sum(g[i] for i in index), sum(h[i] for i in index)
        best = (1e-6, None)
        for f in range(len(cuts)) if depth else ():
            by_bin: dict[int, list[float]] = {}
            for i in index:
                cell = by_bin.setdefault(rows[i][0][f], [0.0, 0.0])
                cell[0] += g[i]
                cell[1] += h[i]
            gl = hl = 0.0
            for b in sorted(by_bin)[:-1]:
                gl, hl = gl + by_bin[b][0], hl + by_bin[b][1]
                gain = gl * gl / (hl + RIDGE) + (gs - gl) ** 2 / (hs - hl + RIDGE) - gs * gs / (hs + RIDGE)
                if gain > best[0]:
                    best = (gain, (f, b))
        if best[1] is None:
            return RATE * gs / (hs + RIDGE)
        f, b = best[1]
        gains[FEATURES[f]] += best[0]
        return (f, b, grow([i for i in index if rows[i][0][f] <= b], g, h, depth - 1), grow([i for i in index if rows[i][0][f] > b], g, h, depth - 1))

    def leaf(node: tuple | float, bins: tuple[int, ...]) -> float:
        while isinstance(node, tuple):
            node = node[2] if bins[node[0]] <= node[1] else node[3]
        return node

    for _ in range(TREES if everything else 0):
        p = [1 / (1 + math.exp(-s)) for s in score]
        tree = grow(list(range(len(rows))), [r[1] - r[2] * q for r, q in zip(rows, p, strict=True)], [r[2] * q * (1 - q) for r, q in zip(rows, p, strict=True)], DEPTH)
        trees.append(tree)
        score = [s + leaf(tree, r[0]) for s, r in zip(score, rows, strict=True)]
    return Trees(cuts, base, trees, gains)


def train(labelled: DataFrame, statistics: tuple[DataFrame, float, int], limit: int = TRAIN) -> Trees:
    """labelled(url, host, path, blocked), without fold 0.  What comes to the driver are counts by bins of at most ``limit`` urls."""
    sample = labelled.where(fold() != 0).select("url", "host", "path", "blocked").distinct().orderBy(F.xxhash64("url"), "url", "blocked").limit(limit)
    rows = spool(with_suffix(lexical(sample), statistics, learning=True).select(*FEATURES, F.col("blocked").cast("double").alias("blocked")), "labelled-urls")
    marks = [i / BINS for i in range(1, BINS)]
    found = rows.agg(*[F.percentile_approx(f, marks, 10_000).alias(f) for f in FEATURES]).first()
    cuts = [sorted(set(found[f] or [])) for f in FEATURES]
    bins = [sum((F.when(F.col(f) > c, 1).otherwise(0) for c in cs), F.lit(0)).alias(f) for f, cs in zip(FEATURES, cuts, strict=True)]
    counted = rows.select(*bins, "blocked").groupBy(*FEATURES).agg(F.sum("blocked").alias("b"), F.count("*").alias("n")).orderBy(*FEATURES).collect()
    return fit([(tuple(r[f] for f in FEATURES), float(r["b"]), float(r["n"])) for r in counted], cuts)


def audit(labelled: DataFrame, statistics: tuple[DataFrame, float, int], trees: Trees) -> dict:
    """AUC on fold 0 (None without both labels there), its number of urls, and each feature's share of the gain."""
    held = with_suffix(lexical(labelled.where(fold() == 0)), statistics, learning=True)
    cells = held.groupBy(F.round(trees.column(), 4).alias("p")).agg(F.count_if("blocked").alias("b"), F.count("*").alias("n")).orderBy("p").collect()  # 10,001 rows at most
    right, allowed = 0.0, 0
    for r in cells:
        right += r["b"] * (allowed + (r["n"] - r["b"]) / 2)
        allowed += r["n"] - r["b"]
    blocked = sum(r["b"] for r in cells)
    whole = sum(trees.gain.values()) or 1.0
    return {"auc": right / (blocked * allowed) if blocked and allowed else None, "urls": blocked + allowed, "gain": {f: g / whole for f, g in trees.gain.items()}}


def labelled_by_rules(pages: DataFrame, rules: tuple = RULES) -> tuple[DataFrame, DataFrame]:
    """(all urls with host, path, rule and ruled; those that a rule decides, with blocked)."""
    urls = apply_rules(split_url(pages.select("page_id", "url")), rules)
    return urls, urls.where(F.col("ruled").isNotNull()).withColumn("blocked", F.col("ruled") == "block")


def judge(pages: DataFrame, rules: tuple = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and the trees' probability of block."""
    urls, labelled = labelled_by_rules(pages, rules)
    statistics = suffix_statistics(labelled)
    trees = train(labelled, statistics)
    scored = with_suffix(lexical(urls), statistics).withColumn("p_block", trees.column())
    verdict = F.coalesce("ruled", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "p_block")
