"""The ten operators against brute force, the installed library, or planted cases, and on awkward rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from curblake.llm import op2_urls, op3_bpe, op4_language, op5_quality, op6_mixing, op8_near_dedup, op9_pii, op10_vectors, queries

EMPTY_DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls, empties, repeated rows and columns whose names the operators use themselves.
AWKWARD = [(1, None, None, None, "x"), (2, "", "en", "s", "x"), (3, "word", "en", "s", None), (3, "word", "en", "s", None), (None, "no id at all here", None, "s", "x"), (4, "long " * 30_000, "en", None, "x"), (5, "!!! ???", "de", "s", "x")]
AWKWARD_SCHEMA = "doc_id long, text string, lang string, source string, score string"


@pytest.fixture(scope="module")
def awkward(spark):
    df = spark.createDataFrame(AWKWARD, AWKWARD_SCHEMA)
    return df.withColumns({"size": F.lit("clash"), "class": F.lit("clash"), "held_out": F.lit("clash"), "base": F.lit("clash"), "_size": F.lit("clash"), "n": F.lit("clash")})


# ---- op2 ----
def test_rules_and_trees(spark):
    urls = [(1, "http://A.net/x"), (2, "http://sub.example.NET/en/a?b#c"), (3, "https://example.com/de/x"), (4, "http://x.org/fr/"), (5, None), (6, "nonsense"), (7, "http://a.net"), (8, "http://net/"), (9, "ftp://example.com/dex"), (10, ""), (11, "http://é.org/ü?q=1&r=2"), (12, "http://x.com/" + "a" * 50_000)]
    rows = {r.page_id: r for r in op2_urls.judge(spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit("clash"))).collect()}
    assert [(rows[i].rule, rows[i].verdict) for i in (1, 2, 3, 4, 8)] == [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"), ("net/", "block")]
    assert rows[7].rule is None and rows[7].host == "a.net" and rows[7].path == "" and rows[9].rule is None
    assert (rows[5].host, rows[5].path, rows[5].rule) == ("", "", None) and rows[2].host == "sub.example.net" and rows[2].path == "/en/a"
    assert all(r.verdict in ("allow", "block") for r in rows.values())
    assert op2_urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_trees_learn_what_labels_say(spark):
    rng = random.Random(5)
    urls = [(i, f"http://h{rng.randint(0, 99)}.com/" + "".join(rng.choice("0123456789" if i % 2 else "abcdefghij") for _ in range(20))) for i in range(600)]
    df = op2_urls.split_url(spark.createDataFrame(urls, "id long, url string")).withColumn("blocked", F.col("id") % 2 == 1).withColumn("rule", (F.col("id") % 3).cast("string"))
    learn, test = df.where("id < 400"), df.where("id >= 400")
    statistics = op2_urls.suffix_statistics(learn)
    trees = op2_urls.train(learn, statistics)
    right = op2_urls.with_suffix(op2_urls.lexical(test), statistics).where((trees.column() >= 0.5) == F.col("blocked")).count()
    report = op2_urls.audit(df, statistics, trees)
    assert right >= 190 and report["auc"] > 0.95 and report["gain"]["digits"] + report["gain"]["entropy"] > 0.9


def test_suffix_statistics_leave_out_the_own_fold_and_single_rules(spark):
    """Brute force over a small table: counts of the other folds, and nothing from suffixes that one rule labels."""
    rows = [(i, f"http://h{i}.{'aa' if i % 3 else 'bb'}/x", i % 2 == 0, "r1" if i % 3 == 0 else f"r{i % 4}") for i in range(80)] * 2
    df = op2_urls.split_url(spark.createDataFrame(rows, "page_id long, url string, blocked boolean, rule string"))
    statistics = op2_urls.suffix_statistics(df)
    share = sum(r[2] for r in rows) / len(rows)
    for learning in (True, False):
        for r in op2_urls.with_suffix(op2_urls.lexical(df), statistics, learning).collect():
            own = zlib.crc32(r.url.encode()) % 5
            others = [o for o in rows if o[0] % 3 and (not learning or zlib.crc32(o[1].encode()) % 5 != own)] if r.page_id % 3 else []
            assert abs(r.suffix_blocked - (sum(o[2] for o in others) + 5 * share) / (len(others) + 5)) < 1e-12


def test_trees_equal_plain_boosting():
    """Brute force: one row a url, no bins in common, the same scores as from counts of equal rows."""
    rng = random.Random(3)
    rows = [(tuple(rng.randint(0, 3) for _ in op2_urls.FEATURES), float(rng.random() < 0.5), 1.0) for _ in range(60)]
    merged = {}
    for bins, b, n in rows:
        old = merged.get(bins, (0.0, 0.0))
        merged[bins] = (old[0] + b, old[1] + n)
    cuts = [[0.5, 1.5, 2.5]] * len(op2_urls.FEATURES)
    one, two = op2_urls.fit(rows, cuts), op2_urls.fit([(k, *v) for k, v in merged.items()], cuts)

    def score(trees, bins):
        total = trees.base
        for node in trees.trees:
            while isinstance(node, tuple):
                node = node[2] if bins[node[0]] <= node[1] else node[3]
            total += node
        return total

    assert all(abs(score(one, r[0]) - score(two, r[0])) < 1e-6 for r in rows)
    loss = lambda t: sum((1 / (1 + 2.718281828 ** -score(t, r[0])) - r[1]) ** 2 for r in rows)
    assert loss(one) < 0.8 * sum((0.5 - r[1]) ** 2 for r in rows)


def test_urls_repeated_rows_and_ties(spark):
    rows = [(7, "http://x.com/a")] * 5 + [(None, "http://x.com/a"), (8, "http://a.example.net/en/x"), (9, "http://a.example.net/fr/x")]
    got = op2_urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert len(got) == len(rows) and len({(r.verdict, r.p_block) for r in got if r.page_id in (7, None)}) == 1


# ---- op3 ----
def test_bpe_equals_the_library(spark, sf):
    import tokenizers

    library = tokenizers.Tokenizer.from_file(op3_bpe.tokenizer_path())
    texts = [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    rng = random.Random(3)
    texts += ["", "  ", "ananananan llllll RRRRrrr", "<|endoftext|>a<|startoftext|> <|ENDOFTEXT|>", "ΑΣ İ ﬁ Å 中文 😀😀 ²½ don't 'LL", "a" * 5000] + ["".join(rng.choice("anrlthe 'sS.,!1é") for _ in range(60)) for _ in range(300)]
    ours = {r.doc_id: r for r in op3_bpe.digests(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t, add_special_tokens=False).ids
        assert ours[i].n_tokens == len(ids)
        assert ours[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert ours[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_equals_the_library_on_all_code_points():
    import tokenizers

    library, ours = tokenizers.Tokenizer.from_file(op3_bpe.tokenizer_path()), op3_bpe.load(op3_bpe.tokenizer_path())
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 5000):
        texts = [f"a{c}b {c}'s" for c in points[at : at + 5000]]
        assert [e.ids for e in library.encode_batch(texts, add_special_tokens=False)] == [ours.encode(t) for t in texts]
    rng = random.Random(9)  # runs of all kinds, composed and not, across pieces
    texts = ["".join(rng.choice(points if rng.random() < 0.3 else "aeiou \u0301\u0327\u00a0\u2028\u3000\x1c\x1f\x85'sß,.1") for _ in range(30)) for _ in range(3000)]
    assert [e.ids for e in library.encode_batch(texts, add_special_tokens=False)] == [ours.encode(t) for t in texts]


def test_bpe_forgets_and_finds_again():
    ours = op3_bpe.load(op3_bpe.tokenizer_path())
    words = [f"{w}ing{i}" for i in range(50) for w in ("play", "sing", "walk")]
    before = [ours.encode(w) for w in words]
    ours.automaton._forget()
    assert [ours.encode(w) for w in words] == before
    assert all(ours.decode(ids).replace("</w>", "").replace(" ", "") == w for w, ids in zip(words, before, strict=True))


def test_bpe_automaton_against_merging_in_order():
    """Small random merge lists: the automaton's path is what applying the merges one by one gives."""
    rng = random.Random(1)
    for _ in range(40):
        vocab, merges = {c: i for i, c in enumerate(["a", "b", "a</w>", "b</w>"])}, []
        while len(merges) < 12:
            u, v = rng.choice([t for t in vocab if "</w>" not in t]), rng.choice(list(vocab))
            if u + v not in vocab:
                merges.append((u, v))
                vocab[u + v] = len(vocab)
        automaton = op3_bpe.Automaton(vocab, merges, "</w>")
        for _ in range(60):
            word = [rng.choice("ab") for _ in range(rng.randint(1, 9))]
            word[-1] += "</w>"
            parts = list(word)
            for u, v in merges:
                i = 0
                while i < len(parts) - 1:
                    if parts[i] == u and parts[i + 1] == v:
                        parts[i : i + 2] = [u + v]
                    i += 1
            assert automaton.decode(automaton.encode([automaton.symbols[x] for x in word])) == parts


def test_bpe_round_trip_and_awkward(spark, awkward):
    rows = op3_bpe.decode(op3_bpe.encode(awkward)).collect()
    assert {r.decoded for r in rows if r.doc_id == 3} == {"word</w>"} and "size" in rows[0]
    assert {r.n_tokens for r in op3_bpe.digests(awkward).collect() if r.doc_id in (1, 2)} == {0}
    assert op3_bpe.digests(spark.createDataFrame([], EMPTY_DOCS)).count() == 0


# ---- op4 ----
def test_language_on_held_out_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = queries.op4_language_id(spark, sf).join(docs, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)


def test_language_awkward(spark, awkward):
    rows = {r.doc_id: r for r in op4_language.identify(awkward).collect()}
    assert [rows[i].lang_pred for i in (1, 2, 5)] == ["und"] * 3 and rows[1].score == 0 and rows[4].lang_pred == "en"
    assert op4_language.identify(spark.createDataFrame([], EMPTY_DOCS)).count() == 0
    kept = op4_language.predict(awkward, op4_language.train(awkward))
    assert kept.columns.count("score") == 1 and "size" in kept.columns


def test_language_of_scripts_with_many_letters(spark):
    """Two languages of one large alphabet each keep their letters apart, as every letter has its own vector."""
    rng = random.Random(6)
    alphabet = {"x": range(0x4E00, 0x4F00), "y": range(0x4F00, 0x5000)}
    words = {n: ["".join(chr(rng.choice(alphabet[n])) for _ in range(4)) for _ in range(120)] for n in alphabet}
    docs = [(i, " ".join(rng.choice(words[n]) for _ in range(40)), n) for i in range(200) for n in ("x", "y")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    rows = op4_language.predict(df, op4_language.train(df.where("doc_id < 150"))).where("doc_id >= 150").collect()
    assert all(r.lang == r.lang_pred for r in rows)


def test_language_does_not_depend_on_partitions_or_repeats(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(150)
    one, more = (op4_language.identify(d) for d in (docs.repartition(1), docs.union(docs).repartition(7)))
    first = {r.doc_id: r.lang_pred for r in one.collect()}
    assert all(first[r.doc_id] == r.lang_pred for r in more.collect())


def test_language_bundles_equal_plain_sums():
    """Brute force: the bundle is the sum of p(p(a)) * p(b) * c over all trigrams."""
    vectors = op4_language.Vectors(64)
    text = "Ab ba, ab!"
    codes = op4_language._codes(text)
    assert "".join(chr(c) if c else " " for c in codes) == " ab ba ab "
    v = {c: vectors.letters(np.array([c]))[0] for c in set(codes.tolist())}
    want = sum(np.roll(v[a], 2) * np.roll(v[b], 1) * v[c] for a, b, c in zip(codes.tolist(), codes[1:].tolist(), codes[2:].tolist(), strict=False))
    bundle, size = vectors.bundles([text, None, ""])
    assert (bundle[0] == want).all() and size.tolist() == [len(codes) - 2, 0, 0] and not bundle[1:].any()


# ---- op5 ----
def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op5_quality_score(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.9 * len(rows)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_quality_awkward(spark, awkward):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = op5_quality.score(awkward, op5_quality.train(awkward, none)).collect()
    assert len(rows) == len(AWKWARD) and {r.score for r in rows} == {0.5}
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (4, 0, 0), (5, None, 0), (None, 1, 0), (9, 7, 0)], "doc_id long, quality int, toxic int")
    assert op5_quality.score(awkward, op5_quality.train(awkward, labels)).count() == len(AWKWARD)
    assert op5_quality.score(spark.createDataFrame([], EMPTY_DOCS), (None, 0.5)).count() == 0


def test_quality_equals_plain_compression(spark):
    """Brute force: every piece compressed with either dictionary, the sizes summed, the curve applied; repeats and ties alike."""
    import pickle

    import zstandard

    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    packed, share = op5_quality.train(docs, labels)
    bad, good, (a, b, c) = pickle.loads(packed)
    plain = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), level=3, write_content_size=False, write_checksum=False, write_dict_id=False) for d in (bad, good)]
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in op5_quality.score(docs.union(docs.limit(5)), (packed, share)).collect():
        data = (texts[r.doc_id] or "").encode()
        pieces = [data[i : i + 512] for i in range(0, len(data), 512)]
        x, y = (sum(len(z.compress(p)) for p in pieces) for z in plain)
        gap = (x - y) / max(1, x + y)
        want = 1 / (1 + np.exp(-np.clip(a + b * gap + c * gap * min(1.0, np.log1p(len(pieces)) / 3), -30, 30)))
        assert abs(r.score - want) < 0.02 and r.predicted == int(r.score >= 0.3)


# ---- op6 ----
def test_mix_equals_sql(spark, sf, duck):
    from conftest import rows_of

    assert rows_of(queries.op6_source_mix(spark, sf).toPandas()) == rows_of(duck.execute(op6_mixing.SQL).df())


def test_mix_targets_caps_and_order(spark, awkward):
    rng = random.Random(6)
    docs = [(i, "w " * rng.randint(1, 30), rng.choice(["a", "b", "b", "b", None, "z"])) for i in range(800)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    one = op6_mixing.mix(df, buckets=1).collect()
    many = op6_mixing.mix(df.repartition(7), buckets=13).collect()
    assert sorted((r.doc_id, tuple(r.positions)) for r in one) == sorted((r.doc_id, tuple(r.positions)) for r in many)
    total = sum(r.size for r in one)
    targets = {r.source: r.target for r in one}
    assert abs(sum(targets.values()) - total) < 1e-6
    for s, target in targets.items():
        own = [r for r in one if r.source == s]
        assert abs(sum(r.size * len(r.positions) for r in own) - target) <= 15 and all(len(r.positions) <= 3 for r in own)
    order = [r.position for r in op6_mixing.ordered(op6_mixing.mix(df)).collect()]
    assert order == sorted(order) and 0 <= order[0] and order[-1] <= 1
    assert op6_mixing.mix(awkward).count() == len(AWKWARD)
    firsts = [r.first_position for r in op6_mixing.summary(df.withColumn("positions", F.lit("clash")).repartition(5)).collect()]
    assert [p for p in firsts if p is not None] == sorted(p for p in firsts if p is not None) and None not in firsts[firsts.count(None) :]


def test_mix_follows_the_schedules(spark):
    """Brute force: a source's words before t are the integral of its schedule, target (t + slope (t^2 - t))."""
    docs = [(i, "w " * (1 + i % 7), "abc"[i % 3]) for i in range(3000)] + [(None, f"no id {i}", "a") for i in range(500)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = op6_mixing.mix(df).collect()
    for source, slope in zip("abc", op6_mixing.SLOPES, strict=True):
        own = [r for r in rows if r.source == source]
        for t in (0.1, 0.3, 0.5, 0.9):
            before = sum(r.size for r in own for p in r.positions if p <= t)
            assert abs(before - own[0].target * (t + slope * (t * t - t))) <= 14
    none = op6_mixing._place("doc_id", "text")
    assert df.where("doc_id IS NULL").select(none.alias("p")).distinct().count() == 500




def test_mix_in_order_equals_mix(spark, monkeypatch):
    """The rows, moved once, stand as `ordered` puts those of `mix`; repeated rows that parts divide are taken as often."""
    rng = random.Random(16)
    docs = [(i, "w " * rng.randint(0, 30), "en", rng.choice(["a", "b", "b", None])) for i in range(1500)] + [(None, None, "en", "a")] * 9
    docs += [(None, "x y", f"l{i % 3}", "b") for i in range(300)] + [(10_000 + i, "k " * 40, "en", f"single {i}") for i in range(12)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    monkeypatch.setattr(op6_mixing, "BUCKET", 100)
    named = lambda rows: [(r.doc_id, r.text, r.source) for r in rows]
    want = named(op6_mixing.ordered(op6_mixing.mix(df)).collect())
    for parts in (1, 5, 90):
        got = op6_mixing.in_order(df.repartition(parts % 7 + 1), parts).collect()
        assert named(got) == want
        taken = [sum(r.text == "x y" and r.lang == f"l{i}" for r in got) for i in range(3)]
        times = sum(w[1] == "x y" for w in want) // 300
        assert all(100 * times <= t <= 100 * (times + 1) for t in taken)
    same = spark.createDataFrame([(1, "x y", "a", "own")] * 200, "doc_id long, text string, source string, size string")
    assert [tuple(r) for r in op6_mixing.in_order(same, 40).collect()] == [tuple(r) for r in same.collect()] and op6_mixing.in_order(df.limit(0)).count() == 0


def test_mix_of_an_empty_table(spark):
    assert op6_mixing.summary(spark.createDataFrame([], EMPTY_DOCS)).count() == 0


# ---- op8 ----
def brute_groups(rows):
    sets = {}
    for i, t in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[i] = {tuple(words[k : k + 3]) for k in range(len(words) - 2)} if len(words) >= 3 else {tuple(words)} if words else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_near_dedup_equals_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    base = [rng.choice(words) for _ in range(150)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    for i in range(100, 260):  # a large group whose members differ in some words: linked, chained, and just not linked
        text = list(base)
        for _ in range(rng.randint(0, 9)):
            text[rng.randrange(150)] = f"x{rng.random()}"
        rows.append((i, " ".join(text)))
    rows += [(300, "One two"), (301, "one\ttwo"), (302, ""), (303, None), (304, "one"), (305, rows[5][1].upper()), (306, "Ä b c d"), (307, "ä b c d")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in op8_near_dedup.deduplicate(df).collect()}
    want = brute_groups(rows)
    assert {i: g[:2] for i, g in got.items()} == want and all(g[2] == (g[1] == i) for i, g in got.items())


def test_near_dedup_judges_rows_of_one_id_by_their_texts(spark):
    """Rows (1, A), (1, B), a near copy of each, the same under null ids: no link is lost, whichever text an id has first."""
    rng = random.Random(2)
    a, b = (" ".join(f"{c}{rng.random()}" for _ in range(60)) for c in "ab")
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (None, a + " z"), (None, "some words of no id " * 3), (None, "some words of no id " * 3), (1, a)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string")
        got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in op8_near_dedup.deduplicate(df).collect())
        assert got == [(0, 0, True), (0, 0, True), (0, 1, False), (1, 1, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False)]
        left = sorted((r.doc_id or 0, r.text) for r in op8_near_dedup.one_of_each(df).collect())
        assert left == sorted([(1, a), (1, b), (0, rows[5][1])])


def test_near_dedup_confirms_pairs_with_far_signatures(spark, monkeypatch):
    """Whatever two signatures say, a pair that meets is judged on full sets."""
    monkeypatch.setattr(op8_near_dedup, "signature", lambda found: [1] * 5 + [int(found[0] % 30_000) - 15_000] * 25)
    words = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "tail"])), (3, " ".join(words[::-1]))]
    got = {r.doc_id: r.component_id for r in op8_near_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_near_dedup_deals_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(op8_near_dedup, "HOT", 10)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words, f"x{i}"])) for i in range(120)] + [(500, "alone by itself here")]
    got = {r.doc_id: r.component_id for r in op8_near_dedup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 0 for i in range(120)} | {500: 500}
    left = op8_near_dedup.one_of_each(spark.createDataFrame(rows + rows[:3], "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in left) == [rows[0], rows[-1]]


def test_near_dedup_awkward(spark, awkward):
    rows = op8_near_dedup.deduplicate(awkward).collect()
    assert len(rows) == len(AWKWARD) and {r.n_shingles for r in rows if r.doc_id in (1, 2)} == {0}
    assert op8_near_dedup.deduplicate(spark.createDataFrame([], EMPTY_DOCS)).count() == 0


# ---- op9 ----
def plain_spans(text):
    out = []
    for k, form in enumerate((op9_pii.EMAIL, op9_pii.IP, op9_pii.CARD, op9_pii.PHONE)):
        for m in re.finditer(form, text, re.A):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if int(c) > 4 else int(c) * 2) for i, c in enumerate(reversed(digits))) % 10 == 0
            if k == 0 or k == 1 and all(int(p) <= 255 for p in m[0].split(".")) or k == 2 and 14 <= len(digits) <= 19 and luhn or k == 3 and 10 <= len(digits) <= 15:
                out.append((m.start(), k, m.end()))
    return ",".join(f"{op9_pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_base_spans_equal_plain_expressions(spark, awkward):
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab@.-_%+ 0123456789().\né😀1 2.3") for _ in range(rng.randint(0, 70))) for _ in range(400)]
    texts += ["a@b.c_d@e.f a@b.c@d.e", "4111 1111 1111 1111 x 4111-1111-1111-1112", "+1 (743) 555-3824 and 1.2.3.4.5.6.7.8 256.1.1.1", "7 " * 9000, "+1(" * 5000, "1.2.3.4 " * 700]
    rows = {r.doc_id: r for r in op9_pii.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, t in enumerate(texts):
        assert rows[i].base_sha256 == hashlib.sha256(plain_spans(t).encode()).hexdigest(), t[:80]
    assert len(op9_pii.report(awkward).collect()) == len(AWKWARD)
    assert op9_pii.report(spark.createDataFrame([], EMPTY_DOCS)).count() == 0


def test_patterns_find_unseen_identifiers_and_leave_others(spark):
    seen = [(i, f"please write mailto user{i}@mail.example.com for news {i}") for i in range(8)]
    other = [(100, "please write mailto user@localhost for news"), (101, "they met 42 people for news")]
    rows = {r.doc_id: r for r in op9_pii.report(spark.createDataFrame(seen + other, "doc_id long, text string")).collect()}
    start = other[0][1].index("user@")
    assert rows[100].spans == f"email:{start}:{start + 14}" and rows[100].n_email == 0
    assert rows[101].spans == ""
    docs = spark.createDataFrame(seen + other, "doc_id long, text string").selectExpr("*", "'a' AS _row", "'b' AS base", "'c' AS _email", "'d' AS extra", "'e' AS _print", "'f' AS tokens")
    assert op9_pii.redact(docs).columns == docs.columns and op9_pii.redact(docs).where("_row = 'a' AND base = 'b' AND _email = 'c'").count() == len(seen + other)
    text = {r.doc_id: r.text for r in op9_pii.redact(spark.createDataFrame(seen + other, "doc_id long, text string")).collect()}
    assert text[0] == "please write mailto [email] for news 0" and text[100] == "please write mailto [email] for news"


def planted_identifiers():
    """Base phones beside one pattern, phones of several tokens without + beside it and a second one, others beside the second; and numbers."""
    rng, docs, hidden = random.Random(11), [], {}
    number = lambda: f"{rng.randint(200, 999)}-{rng.randint(1000, 9999)}"
    filler = lambda: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(4))
    for i in range(12):
        docs.append((i, f"{filler()} call me at: +1 (743) {number()} {filler()}"))
    for i in range(20, 30):  # of two tokens, beside both patterns
        value = f"(743) {number()}"
        docs.append((i, f"{filler()} call me at: {value} {filler()}, ring only {value}, {filler()}"))
        hidden[i] = [value, value]
    for i in range(40, 50):  # beside the second one alone
        value = f"743 {number()}"
        docs.append((i, f"{filler()} ring only {value} {filler()}"))
        hidden[i] = [value]
    long = "x" * 500
    docs += [(60, f"{long} call me at: 743 555 0199"), (61, f"in 1984 they met 42 people at 10 {filler()}"), (62, f"{filler()} ring only 3 times"), (63, "rooms 12 at 743")]
    hidden[60] = ["743 555 0199"]
    return docs, hidden


def test_patterns_bootstrap_to_identifiers_of_several_tokens(spark):
    docs, hidden = planted_identifiers()
    rows = {r.doc_id: r for r in op9_pii.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    want = {}
    for i, text in docs:
        at, want[i] = 0, []
        for value in hidden.get(i, []):
            at = text.index(value, at)
            want[i].append(f"phone:{at}:{at + len(value)}")
            at += len(value)
    found = {i: [s for s in rows[i].spans.split(",") if s] for i, _ in docs if i >= 20}
    right = sum(len(set(found[i]) & set(want[i])) for i in found)
    assert right >= 0.9 * sum(map(len, want.values()))  # recall
    assert right >= 0.9 * sum(map(len, found.values()))  # precision
    assert not any(found[i] for i in (61, 62, 63))
    assert all(rows[i].n_phone == (i < 12) for i, _ in docs)


# ---- op10 ----
def test_vector_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(10)
    rows = [(i, int(i % 3), rng.normal(size=16)) for i in range(240)]
    for j in range(3):  # a pair, a chain, a large group of near copies
        centre = rng.normal(size=16)
        rows += [(300 + 200 * j + i, 1, centre + rng.normal(size=16) * (0.02, 0.13, 0.05)[j]) for i in range((2, 12, 90)[j])]
    rows = [(i, label, [float(np.float32(x)) for x in v]) for i, label, v in rows]
    rows += [(5000, 1, rows[0][2]), (5001, 0, rows[0][2]), (5002, None, rows[0][2]), (5003, 1, [0.0] * 16), (5004, 1, None), (5005, 1, [None] * 16), (5006, 1, [float("nan")] * 16), (5007, 0, [1.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in op10_vectors.deduplicate(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("node", F.lit(1))).collect()}
    fit = [(i, label, np.array(v, dtype=np.float64)) for i, label, v in rows if label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = {i: set() for i, _, _ in rows}
    for i, a, u in fit:
        for j, b, v in fit:
            if i < j and a == b and len(u) == len(v) and u @ v / np.linalg.norm(u) / np.linalg.norm(v) >= 0.98:
                links[i].add(j)
                links[j].add(i)
    found = sum(n for n, _, _ in got.values())
    true = sum(map(len, links.values()))
    assert all(got[i][0] <= len(links[i]) for i in links) and found >= 0.95 * true
    assert got[5001][:2] == (1, 0) and got[5000][0] == 0 and all(got[i] == (0, i, True) for i in (5002, 5003, 5004, 5005, 5006, 5007))
    assert op10_vectors.deduplicate(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def groups_of_near_copies(sizes, within=0.998, across=0.987):
    """Unit vectors of groups: a cosine of `within` in a group, within * across between two groups."""
    many, wide = len(sizes), 1 + len(sizes) + sum(sizes)
    out, at = [], 1 + many
    for g, n in enumerate(sizes):
        for _ in range(n):
            v = np.zeros(wide)
            v[0], v[1 + g], v[at] = np.sqrt(within * across), np.sqrt(within * (1 - across)), np.sqrt(1 - within)
            out.append([float(x) for x in v])
            at += 1
    return out


@pytest.mark.parametrize("sizes", [(12, 12), (12, 30, 10)])
def test_vector_dedup_links_groups_whose_lists_are_full_of_their_own(spark, sizes):
    rows = [(i, 1, v) for i, v in enumerate(groups_of_near_copies(sizes))]
    got = op10_vectors.deduplicate(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()
    n = len(rows)
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got} == {(i, n - 1, 0, i == 0) for i in range(n)}


def test_vector_dedup_keeps_far_groups_and_labels_apart(spark):
    rows = [(100 * label + i, label, v) for label in (1, 2) for i, v in enumerate(groups_of_near_copies((12, 12), across=0.97))]
    got = op10_vectors.deduplicate(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(100 * label + i, 11, 100 * label + i // 12 * 12) for label in (1, 2) for i in range(24)}


def test_vector_dedup_audit_counts_groups_not_links(spark):
    """A large group that is found whole doesn't hide three pairs that are missed."""
    large = groups_of_near_copies((40,))
    wide = len(large[0]) + 6
    pairs = [[float(i == len(large[0]) + 2 * p) + 0.1 * (i == len(large[0]) + 2 * p + 1) * k for i in range(wide)] for p in range(3) for k in (0, 1)]
    rows = [(i, 1, v + [0.0] * 6) for i, v in enumerate(large)] + [(100 + i, 1, v) for i, v in enumerate(pairs)]
    _, nodes = op10_vectors.nodes_of(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"))
    nodes = nodes.persist()
    first = nodes.where("rep < 100").agg(F.min("node")).first()[0]
    found = nodes.where("rep < 100").select("node", F.lit(first).alias("component"))
    assert op10_vectors.recall(nodes, found) < op10_vectors.RECALL


def test_vector_dedup_is_exact_where_the_audit_fails(spark, monkeypatch):
    monkeypatch.setattr(op10_vectors, "MORE", 0)
    monkeypatch.setattr(op10_vectors, "leaves", lambda nodes, seed: spark.createDataFrame([], op10_vectors.EDGE).withColumn("fresh", F.lit(True)))
    rows = [(i, 1, v) for i, v in enumerate(groups_of_near_copies((3, 4)))]
    got = op10_vectors.deduplicate(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(i, 6, 0) for i in range(7)}


def brute_links(rows):
    """Exact links by double precision, and components, of rows (vec_id, label, vector) that take part."""
    n = len(rows)
    x = np.array([v for _, _, v in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = (x @ x.T >= 0.98) & ~np.eye(n, dtype=bool) & (np.array([r[1] for r in rows])[:, None] == np.array([r[1] for r in rows])[None, :])
    low = np.arange(n)
    while True:
        after = np.minimum(low, np.where(close, low[None, :], n).min(axis=1, initial=n))
        if (after == low).all():
            return {(rows[i][0], int(close[i].sum()), rows[low[i]][0]) for i in range(n)}
        low = after


def test_vector_dedup_counts_links_by_blocks(spark, monkeypatch):
    """Tight groups (counted by arithmetic), chains (compared) and copies, in blocks far smaller than a component."""
    monkeypatch.setattr(op10_vectors, "BLOCK", 8)
    rng = np.random.default_rng(4)
    rows = []
    for g, spread in enumerate((0.005, 0.02, 0.045)):
        centre = rng.normal(size=12)
        centre /= np.linalg.norm(centre)
        rows += [(1000 * g + i, g % 2, [float(y) for y in centre + rng.normal(size=12) * spread]) for i in range(70)]
    rows += [(5000 + i, r[1], r[2]) for i, r in enumerate(rows[::9])]
    rows.sort()
    got = op10_vectors.deduplicate(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect()
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == brute_links(rows)


def test_vector_dedup_awkward_rows(spark):
    """Null and repeated ids, lengths that differ, and pairs at exactly 0.98 (a double may round either way there, both as the dot product has it)."""
    up, side = [0.98, (1 - 0.98**2) ** 0.5], [1.0, 0.0]
    rows = [(1, 1, side), (2, 1, up), (None, 2, side), (3, 2, side), (4, 3, side), (4, 3, [0.0, 1.0]), (5, 4, [1.0]), (6, 4, side), (7, 5, [1.0, 0.0, 0.0])]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in op10_vectors.deduplicate(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")).collect())
    linked = int(np.dot(np.array(side), np.array(up) / np.linalg.norm(up)) >= 0.98)
    assert got == sorted([(1, linked, 1, True), (2, linked, 2 - linked, not linked), (0, 1, 3, False), (3, 1, 3, True), (4, 0, 4, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True)])


def test_vector_dedup_recall_is_reported(spark):
    rng = np.random.default_rng(7)
    rows = [(i, 1, [float(x) for x in rng.normal(size=24)]) for i in range(1500)]
    rows += [(2000 + i, 1, [float(x) for x in np.array(rows[i][2]) + rng.normal(size=24) * 0.03]) for i in range(300)]  # planted links
    _, nodes = op10_vectors.nodes_of(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"))
    found, recall = op10_vectors.neighbour_graph(spark, nodes)
    by_node = {r.node: r.rep for r in nodes.select("node", "rep").collect()}
    component = {by_node[r.node]: r.component for r in found.collect()}
    true = [(i, 2000 + i) for i in range(300)]
    assert recall >= 0.9 and sum(component.get(a, a) == component.get(b, b) for a, b in true) >= 0.97 * len(true)
