import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkmill.sources.index import first_of
from inkmill.operators import calibrate, filters, finalize, labels, ledger, prompts, scoring, segment
from inkmill.sources import ingest


def records(spark, texts, name="n"):
    return ingest.ingest_texts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, text string"), name, id_column="k", order=["k"])


def test_filter_order_decides_duplicates(spark):
    rows = [(1, "de", "same text here now"), (2, "en", "same text here now"), (3, "en", "same text here now"), (4, "en", "too short"), (5, "en", "bad WORD in this one"), (6, None, "no language at all"), (7, "en", None), (8, "en", "")]
    df = spark.createDataFrame(rows, "k int, lang string, response string")
    got = filters.filter_chain(df, filters.FilterSettings(3, 5, 0.9, ("bad word",)), ["k"], lang=F.col("lang"))
    assert [r["k"] for r in got.collect()] == [2]
    off = filters.filter_chain(df, filters.FilterSettings(3, 5, 0, ()), ["k"], lang=F.col("lang"))
    assert sorted(r["k"] for r in off.collect()) == [1, 5, 6]
    seen = filters.seen_hashes(df.where("k = 5"))
    assert sorted(r["k"] for r in filters.deduplicate_against(df, seen, ["k"]).collect()) == [1, 4, 6, 7, 8]


def test_token_range_is_inclusive(spark):
    df = spark.createDataFrame([("a " * n,) for n in range(1, 7)], "response string")
    assert df.where(filters.token_range(2, 5)).count() == 4


@pytest.mark.parametrize(
    ("tokens", "most", "overlap", "chunks"),
    [
        ([3, 4, 5, 2, 9, 1], 8, 0, [[3, 4], [5, 2], [9], [1]]),
        ([3, 4, 5, 2, 9, 1], 8, 1, [[3, 4], [4, 5], [5, 2], [2, 9], [9, 1]]),
        ([9, 9], 8, 1, [[9], [9]]),
        ([], 8, 1, []),
        ([1], 8, 2, [[1]]),
    ],
)
def test_pack(tokens, most, overlap, chunks):
    assert [tokens[a : b + 1] for a, b in segment.pack(tokens, most, overlap)] == chunks


def test_pack_covers_every_sentence():
    r = random.Random(3)
    for _ in range(200):
        t = [r.randint(1, 12) for _ in range(r.randint(1, 30))]
        for overlap in (0, 1, 2):
            got = segment.pack(t, 15, overlap)
            assert sorted({i for a, b in got for i in range(a, b + 1)}) == list(range(len(t)))


def test_segment(spark):
    long = "First one here. Second one there!\nThird line is this. " * 20
    df = records(spark, ["short text.", long])
    out = segment.segment(df, 40, 1).collect()
    assert sum(r["response"] == "short text." for r in out) == 1
    cut = [r for r in out if r["meta"]["char_span"]]
    text = df.where("length(response) > 100").first()["response"]
    assert len(cut) > 3 and len({r["id"] for r in out}) == len(out)
    for r in cut:
        a, b = r["meta"]["char_span"]
        assert text[a:b].split() == r["response"].split() and r["prompt"] is None and r["scores"] == {}


def test_parse_genre(spark):
    df = spark.createDataFrame([("Primary Genre Category: Poetry",), ("non-fiction",), ("Unknown",), ("a cookbook",), ("",), (None,)], "c string")
    got = [r[0] for r in df.select(labels.parse_genre(F.col("c"), ["fiction", "non-fiction", "poetry"])).collect()]
    assert got == ["poetry", "fiction", "unknown", "unknown", "unknown", "unknown"]


def test_quota(spark):
    df = spark.range(3000).select(F.concat(F.lit("r"), "id").alias("id"), F.struct(F.when(F.col("id") % 3 == 0, "big").when(F.col("id") < 20, "small").when(F.col("id") % 2 == 0, "none").alias("top")).alias("classification"))
    got = labels.sample_quota(df, {"small": 0, "big": 77}, 33)
    assert {r["top"]: r["records"] for r in labels.class_counts(got).collect()} == {"big": 77, "unknown": 33, "none": 33}
    again = labels.sample_quota(df.repartition(5), {"small": 0, "big": 77}, 33)
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in again.collect())
    ranked = sorted((r["id"] for r in df.where("classification.top = 'big'").collect()), key=lambda i: __import__("hashlib").sha256(f"0{i}".encode()).hexdigest())[:77]
    assert sorted(ranked) == sorted(r["id"] for r in got.where("classification.top = 'big'").collect())


def test_tags(spark):
    df = records(spark, ["text one", "w " * 300]).withColumn("prompt", F.when(F.col("response") == "x", "p"))
    kept = prompts.tag_prompts(df, F.lit("Tell me"), most_tokens=100)
    assert sorted((r["prompt"], r["meta"]["prompt_type"]) for r in kept.where("prompt is not null").collect()) == [("Tell me", "reconstructed")]
    human = df.withColumn("prompt", F.lit("q")).withColumn("meta", F.col("meta").withField("prompt_type", F.lit("human")))
    assert {r["meta"]["prompt_type"] for r in prompts.tag_prompts(human, F.lit("x")).collect()} == {"human"}
    assert {r["meta"]["prompt_type"] for r in prompts.tag_prompts(human, F.lit("x"), retag_existing=True).collect()} == {"reconstructed"}


def test_route(spark):
    df = spark.createDataFrame([("story_x",), ("poetry",), ("abc",), (None,), ("[odd",)], "t string")
    rules = [("story_*", "narrative_creative"), ("p?etry", "adult"), ("[!a]*", "professional"), ("*", "default"), ("abc", "adult")]
    assert [r[0] for r in df.select(scoring.route(F.col("t"), rules)).collect()] == ["narrative_creative", "adult", "default", "professional", "professional"]
    with pytest.raises(ValueError):
        scoring.route(F.col("t"), {"*": "nobody"})


SCORES = [
    ('{"a":0.5,"b":2}', 0.5, 1.0), ('{"a":-3}', 0.0, None), ('```json\n{"a":true,"b":"x"}\n```', 1.0, None), ('pre {"a":NaN} post', 1.0, None), ('{"a":0.1,"a":0.9}', 0.9, None),
    ('{"a":1} {"b":2}', None, None), ('{"a":0.5,}', None, None), ("{'a':0.5}", None, None), ("no json", None, None), (None, None, None), ("[1]", None, None), ('{"a":1e400,"b":1e-400}', 1.0, 0.0), ("}{", None, None), ('{"a":null,"b":[1]}', None, None),
]


def test_scores(spark):
    assert [tuple(scoring.read_scores(t, ["a", "b"]).values()) for t, _, _ in SCORES] == [(a, b) for _, a, b in SCORES]
    df = spark.createDataFrame([(t, "r") for t, _, _ in SCORES], "t string, r string")
    got = df.select(scoring.parse_scores(F.col("t"), F.col("r"), {"r": ["a", "b"], "default": ["z"]}).alias("s")).collect()
    assert [(r["s"]["r.a"], r["s"]["r.b"]) for r in got] == [(a, b) for _, a, b in SCORES]
    flat = [(json.dumps({"a": i / 7, "b": 3, "c": "x"}),) for i in range(5)]
    native = spark.createDataFrame(flat, "t string").select(scoring.parse_scores_native(F.col("t"), ["a", "b"]).alias("s")).collect()
    assert [r["s"] for r in native] == [{k: v for k, v in scoring.read_scores(t, ["a", "b"]).items() if v is not None} for (t,) in flat]


def test_completion(spark):
    rows = [('{"choices":[{"message":{"content":"  hi \\n"}}]}', "hi"), ('{"choices":[]}', None), ('{"choices":[{}]}', None), ('{"choices":[{"message":{"content":null}}]}', None), ("broken {", None), (None, None)]
    df = spark.createDataFrame([(r[0],) for r in rows], "e string")
    assert [r[0] for r in df.select(scoring.completion(F.col("e"))).collect()] == [r[1] for r in rows]


def test_calibrate(spark):
    values = [0.1, 0.2, 0.4, 0.9]
    rows = [(str(i), {"default.prose_precision": v, "default.thematic_depth": 0.3, "default.natural_dialogue": None if i else 0.5}) for i, v in enumerate(values)] + [("none", {}), ("null", None)]
    df = spark.createDataFrame(rows, "id string, scores map<string,double>")
    p = {r["metric"]: (r["lo"], r["hi"]) for r in calibrate.metric_percentiles(df).collect()}
    assert p["default.prose_precision"] == pytest.approx((0.115, 0.825)) and "default.natural_dialogue" not in p
    got = {r["id"]: r["scores"] for r in calibrate.calibrate(df).collect()}
    lo, hi = np.percentile(values, [5, 95])
    for i, v in enumerate(values):
        assert got[str(i)]["default.prose_precision_calibrated"] == pytest.approx(min(1, max(0, (v - lo) / (hi - lo))))
        assert got[str(i)]["default.thematic_depth_calibrated"] == 0.5 and got[str(i)]["default.thematic_depth"] == 0.3
    assert got["none"] == {} and got["null"] is None
    assert calibrate.calibrate(df, enabled=False) is df


def test_completeness(spark):
    names = list(scoring.RUBRICS["default"])
    df = spark.createDataFrame([(n, {f"default.{m}": 0.5 for m in names[:n]}) for n in (6, 7, 8)] + [(0, None)], "n int, scores map<string,double>")
    assert sorted(r["n"] for r in calibrate.drop_incomplete(df, F.lit("default")).collect()) == [7, 8]
    assert calibrate.drop_incomplete(df, F.lit("nobody"), 0).count() == 4


def test_coverage(spark):
    df = spark.createDataFrame([({"m": 0.0},), ({"m": 0.19},), ({"m": 1.0},), ({"m": None},)], "scores map<string,double>")
    got = {(r["level"], r["records"], r["missing"]) for r in calibrate.coverage(df, F.lit("x"), 2, metrics=["m"]).collect()}
    assert got == {(1, 2, 0), (2, 0, 2), (3, 0, 2), (4, 0, 2), (5, 1, 1)}
    every = calibrate.coverage(df, F.lit("x"), 2)
    assert every.count() == 2 + 5 * len(scoring.namespaced()) and every.where("metric <> 'm' and (records <> 0 or missing <> 2)").count() == 0


@pytest.mark.parametrize("values", [[0.1, 0.2, 0.4, 0.9], [0.5] * 9, [3.0, -1e300, 1e300, 2.0], [i / 7 for i in range(500)], [0.0] * 1000 + [1e-12 * i for i in range(40)], [5e-324, 0.0]])
def test_percentiles_are_exact(spark, values, monkeypatch):
    import numpy as np

    monkeypatch.setattr(calibrate, "BUCKETS", 8)
    df = spark.createDataFrame([({"m": v, "one": 1.0 if i == 0 else None},) for i, v in enumerate(values)], "scores map<string,double>")
    got = calibrate.metric_percentiles(df, 5, 95, ["m", "one"]).collect()
    low, high = np.percentile(values, [5, 95])
    assert [r["metric"] for r in got] == ["m"] and math.isclose(got[0]["lo"], low, rel_tol=1e-9, abs_tol=1e-300) and math.isclose(got[0]["hi"], high, rel_tol=1e-9, abs_tol=1e-300)
    assert (got[0]["least"], got[0]["most"], got[0]["n"]) == (min(values), max(values), len(values))


def test_first_of_moves_only_repeated_rows(spark):
    df = spark.createDataFrame([(3, "a", 1), (1, "a", 2), (2, "b", 3), (5, None, 4), (4, None, 5), (1, "a", 2)], "n int, k string, _key int")
    got = first_of(df.select("n", "k"), F.col("k"), ["n"])
    assert sorted((r["n"], r["k"]) for r in got.collect()) == [(1, "a"), (2, "b"), (4, None)]
    assert first_of(df.select("n", "k").limit(0), F.col("k"), ["n"]).count() == 0


def test_splits(spark):
    assert finalize.boundaries({"train": 0.9, "validation": 0.05, "test": 0.05}) == [("test", 0.05), ("train", 0.9500000000000001), ("validation", 1.0)]
    assert finalize.boundaries({"a": 1, "b": 1}) == [("a", 0.5), ("b", 1.0)]
    with pytest.raises(ValueError):
        finalize.boundaries({"a": 0.0})
    df = finalize.assign_splits(spark.range(4000).select(F.col("id").cast("string").alias("id")))
    shares = {r["split"]: r["percent"] for r in finalize.split_report(df).collect()}
    assert math.isclose(sum(shares.values()), 100) and abs(shares["train"] - 90) < 2


def test_ledger(spark):
    df = records(spark, ["a", "b", "c"])
    one = df.where("response = 'a'")
    assert ledger.pending(df, None).count() == 3 and ledger.pending(df, one).count() == 2
    assert ledger.pending_scores(df, one).count() == 2 and ledger.pending_scores(df, one, True).count() == 3
    label = F.struct(F.lit("poetry").alias("top"), F.lit(None).cast("string").alias("sub"))
    merged = ledger.merge_results(df, one.select("id", label.alias("classification")), ["classification"])
    assert sorted(str(r["classification"]["top"]) for r in merged.collect()) == ["None", "None", "poetry"]
    assert ledger.pending_labels(merged, one).count() == 2
