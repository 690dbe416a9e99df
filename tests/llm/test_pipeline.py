"""The pipeline against a plain version of its stages, and the entry without the folders."""

import random
import re

from pyspark.sql import functions as F

import corpus_pipeline as P
from curblake.llm import op3_bpe


def test_stages_on_planted_rows(spark):
    rng = random.Random(4)
    lang = {"en": "the and of ing tion th wh".split(), "fr": "le que eau oi ment ré ç".split()}
    docs = []
    for i in range(160):
        name = "en" if i % 2 else "fr"
        docs.append((i, " ".join("".join(rng.choice(lang[name]) for _ in range(rng.randint(1, 3))) for _ in range(40)), name, f"s{i % 4}", 0))
    docs += [(500, "!!! 123", "en", "s1", 7), (501, docs[7][1], "en", "s1", 7), (502, docs[8][1] + " tail", "fr", "s2", 7), (503, docs[9][1] + " mail me@x.org now", "en", "s3", 7), (504, None, "en", "s0", 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    kept = P.language(spark, df, "").persist()
    assert {r.doc_id for r in kept.collect()} == {d[0] for d in docs} - {500, 504} and kept.columns == list(P.COLUMNS)
    assert all(r.lang == docs[r.doc_id][2] for r in kept.where("doc_id < 160").collect())
    single = P.near_dedup(spark, kept, "").persist()
    assert {r.doc_id for r in single.collect()} == {d[0] for d in docs} - {500, 501, 502, 503, 504}
    clean = P.pii(spark, df, "")
    row = clean.where("doc_id = 503").first()
    assert row.text.endswith(" mail [email] now") and row.n_chars == len(row.text)
    assert clean.where("doc_id = 3").first().text == docs[3][1]
    mixed = P.mixing(spark, single, "")
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    total, by_source = 0, {}
    for r in mixed.collect():
        by_source[r.source] = by_source.get(r.source, 0) + words(r.text)
        total += words(r.text)
    assert abs(total - sum(words(r.text) for r in single.collect())) <= 4 * 25
    assert by_source["s0"] > by_source["s2"]
    last = P.bpe(spark, single, "").collect()
    tokenizer = op3_bpe.load(op3_bpe.tokenizer_path())
    texts = {r.doc_id: r.text for r in single.collect()}
    assert all((r.n_tokens, r.ids_sha256, r.decoded_sha256) == tokenizer.digest(texts[r.doc_id]) for r in last)


def test_run_and_empty_tables(spark, sf):
    assert P.run(spark, sf).count() > 100
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.count() == 0 and len(P.STAGES) == 5


def test_mixing_moves_texts_once(spark):
    """However small a table must be to be broadcast by itself, whole rows go through one exchange, into training order."""
    docs = spark.createDataFrame([(i, "w " * (1 + i % 9), "en", "ab"[i % 2], 0) for i in range(400)], "doc_id long, text string, lang string, source string, n_chars long")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")
    try:
        plan = P.mixing(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert re.findall(r"(?<!Broadcast)Exchange (\w+)", plan) == ["rangepartitioning"]


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names


def test_extra_columns_and_repeats(spark):
    docs = spark.createDataFrame([(1, "a b c d", "en", "s", 1, "x")] * 3, "doc_id long, text string, lang string, source string, n_chars long, kept string")
    assert P.near_dedup(spark, docs, "").count() == 1
    assert P.language(spark, docs.withColumn("lang_pred", F.lit("q")), "").columns == list(P.COLUMNS)


def test_queries_equal_their_sql(spark, sf, duck):
    from conftest import rows_of

    from curblake.llm.queries import ORACLE_SQL, QUERIES

    for name, sql in ORACLE_SQL.items():
        assert rows_of(QUERIES[name](spark, sf).toPandas()) == rows_of(duck.execute(sql).df()), name
