"""Language and toxicity on held-out rows, mixing against its targets."""

import pickle
import tracemalloc

import pytest
from pyspark.sql import functions as F

from tallytide.llm import mixing
from tallytide.llm.common import driver_table
from tallytide.llm.language import fit_language, identify_languages, keep_identified
from tallytide.llm.mixing import NULL_NAME, layout_topic, mix, rake, sample_mix, shares, word_count
from tallytide.llm.packing import pack
from tallytide.llm.tokens import vocabulary
from tallytide.llm.toxicity import detect_toxicity



def dimensions():
    return {"source": F.col("source"), "lang": F.col("lang")}


def test_held_out_languages(documents):
    found = identify_languages(documents).join(documents.select("doc_id", "lang"), "doc_id")
    right, n = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 250 and right > 0.98
    assert found.filter("score < 0 OR score > 1").count() == 0


def test_odd_texts_have_a_language(odd, empty):
    found = identify_languages(odd).collect()
    assert len(found) == odd.count()
    assert {r.lang_pred for r in found if r.doc_id in (3, 4, 7)} == {"und"}
    assert identify_languages(empty).count() == 0
    kept = keep_identified(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 5, 6, 8, 9, 12, None}


def test_held_out_toxicity(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = detect_toxicity(documents, labels).join(labels, "doc_id").filter("held_out")
    sums = {r.toxic: (r.m, r.p) for r in found.groupBy("toxic").agg(F.avg("score").alias("m"), F.avg("predicted").alias("p")).collect()}
    assert sums[1][0] > 0.7 > 0.2 > sums[0][0]
    assert sums[1][1] > 0.7 and sums[0][1] < 0.05


def test_odd_texts_have_a_score(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0, 0), (2, 1, 1), (5, 1, None), (6, 0, 1)], "doc_id bigint, quality int, toxic int")
    found = detect_toxicity(odd, labels).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    assert detect_toxicity(odd, labels.limit(0)).filter("score != 0").count() == 0
    assert detect_toxicity(empty, labels).count() == 0


def test_raked_marginals_meet_their_targets(documents):
    out = mix(documents, dimensions(), word_count(F.col("text"))).cache()
    total = out.agg(F.sum("n_tokens")).first()[0]
    for dim in dimensions():
        seen = {r[0]: (r.t, r.w) for r in out.groupBy(dim).agg(F.sum("n_tokens").alias("t"), F.sum(F.col("n_tokens") * F.col("factor") / total).alias("w")).collect()}
        norm = sum(t**0.5 for t, _ in seen.values())
        for t, w in seen.values():
            assert w == pytest.approx(t**0.5 / norm, rel=1e-3)
    expected, drawn = out.agg(F.sum(F.col("n_tokens") * F.col("probability")) / total, F.sum(F.when(F.col("sampled"), F.col("n_tokens"))) / total).first()
    assert expected == pytest.approx(0.7, rel=1e-6) and abs(drawn - 0.7) < 0.06


def test_stated_targets(spark):
    cells = spark.createDataFrame([("a", "x", 60), ("a", "y", 20), ("b", "x", 10), ("b", "y", 10)], "s string, l string, tokens bigint")
    out = {(r.s, r.l): r.weight for r in rake(cells, ["s", "l"], {"s": {"a": 1, "b": 1}, "l": {"x": 1, "y": 3}}).collect()}
    assert out["a", "x"] + out["a", "y"] == pytest.approx(0.5, rel=1e-3)
    assert out["a", "x"] + out["b", "x"] == pytest.approx(0.25, rel=1e-3)


def test_sampled_shares_meet_targets_that_can_be_met(spark):
    sizes = {("a", "x"): 6000, ("a", "y"): 1000, ("b", "x"): 2000, ("b", "y"): 1000}
    rows = [(s, l) for (s, l), n in sizes.items() for _ in range(n)]
    docs = spark.createDataFrame([(i, s, l, "w") for i, (s, l) in enumerate(rows)], "doc_id bigint, source string, lang string, text string")
    targets = {"source": {"a": 1, "b": 1}, "lang": {"x": 3, "y": 2}}
    out = mix(docs, dimensions(), word_count(F.col("text")), keep_share=0.45, targets=targets).cache()
    assert out.filter("probability = 1").count() == 1000 and out.filter("probability > 1").count() == 0
    found = shares(out, list(dimensions()), targets).collect()
    assert {(r.value, round(r.target, 6)) for r in found} == {("a", 0.5), ("b", 0.5), ("x", 0.6), ("y", 0.4)}
    for r in found:
        assert r.expected == pytest.approx(r.target, abs=1e-3) and r.sampled == pytest.approx(r.target, abs=0.02)


def test_targets_beyond_all_tokens_are_met_as_far_as_they_go(documents):
    out = mix(documents, dimensions(), word_count(F.col("text"))).cache()
    found = shares(out, list(dimensions())).collect()
    for dim in dimensions():
        mine = [r for r in found if r.dimension == dim]
        rate = lambda x: sum(min(r.observed / 0.7, x * r.target) for r in mine)
        low, high = 0.0, 100.0
        for _ in range(100):
            low, high = ((low + high) / 2, high) if rate((low + high) / 2) < 1 else (low, (low + high) / 2)
        for r in mine:
            assert r.expected == pytest.approx(min(r.observed / 0.7, high * r.target), abs=3e-3)


def test_sweeps_as_jobs_give_what_the_driver_gives(documents, monkeypatch):
    weights = lambda: {r.doc_id: r.probability for r in mix(documents, dimensions(), word_count(F.col("text"))).collect()}
    here = weights()
    monkeypatch.setattr(mixing, "CELLS_ON_DRIVER", 0)
    assert weights() == pytest.approx(here, abs=1e-9)


def test_odd_rows_are_mixed(odd, empty):
    dims = dimensions() | {"topic": layout_topic(F.col("text"))}
    out = mix(odd, dims, word_count(F.col("text")))
    assert out.count() == odd.count()
    assert out.filter(F.col("source") == NULL_NAME).count() == 0
    assert out.filter("probability IS NULL OR sampled IS NULL").count() == 0
    assert sample_mix(odd, dims, word_count(F.col("text"))).columns == odd.columns
    assert mix(empty, dims, word_count(F.col("text"))).count() == 0


def test_a_workers_copy_of_the_language_model_is_small(documents):
    model = fit_language(documents)
    sent = pickle.dumps(tuple(model))
    tracemalloc.start()
    languages, words, grams = pickle.loads(sent)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert len(words.rows) == len(words.logs) > 1000 and len(grams.rows) == len(grams.logs) > 10_000
    assert held < (180 + 8 * len(languages)) * (len(words.rows) + len(grams.rows))


def test_words_are_counted_without_a_list_of_them(spark, odd):
    more = spark.createDataFrame([(t,) for t in ("", "  ", " a b ", "\x0b\x0c a\r\nb c\u0085d  e", "\U0001f600 \U0001f600%|[]^", "%$#&*|<>{}[]=_~^ x")], "text string")
    texts = odd.select("text").unionAll(more)
    wanted = F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0))
    assert texts.filter(word_count(F.col("text")) != wanted).count() == 0
    assert [r[0] for r in more.select(layout_topic(F.col("text"))).collect()] == ["empty", "empty", "short", "short", "markup", "markup"]
    assert "extract_all" not in texts.select(word_count(F.col("text")))._jdf.queryExecution().toString()


def test_rows_of_the_driver_need_no_python_workers(spark, documents):
    held = driver_table(spark, [("a", 1, 0.5), (None, 2, None)], "s string, n bigint, x double")
    assert [tuple(r) for r in held.collect()] == [("a", 1, 0.5), (None, 2, None)]
    assert driver_table(spark, [], "s string, n bigint").collect() == []
    assert "ExistingRDD" not in held._jdf.queryExecution().toString()
    assert "ExistingRDD" not in pack(documents.limit(50), vocabulary("byte_bpe_50k.json"))._jdf.queryExecution().toString()
