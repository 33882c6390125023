"""The operators on small tables with nulls, empty and very long texts, ties, repeated rows and clashing columns."""

import random
import re

import pytest
from pyspark.sql import functions as F

from inkmill.llm import budget, components, cross_split, encoding, leaks, near_duplicates, pairs, pieces, pii, sampling, splits
from inkmill.llm.queries import oracle_sql, queries

META = "struct<prompt_type:string,source_path:string,char_span:array<int>,lang:string,original_id:string>"
SCHEMA = f"id string, source_dataset_name string, prompt string, response string, meta {META}, classification struct<top:string,sub:string>, ingested_at timestamp, text string, text_key string, block int, a string, b string, count int, cell string, split string, held int, work string, component string"
VOCABULARY = [f"w{i}" for i in range(400)]


def record(i, response, prompt=None, original=None, span=None, lang="en", top=None, sub=None, source="s"):
    return (i, source, prompt, response, (None, None, span, lang, original), (top, sub) if top else None, None, "clash", "clash", 1, "clash", "clash", 1, "clash", "train", 1, "clash", "clash")


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def text(seed, n=80):
    r = random.Random(seed)
    return " ".join(r.choice(VOCABULARY) for _ in range(n))


def brute_pairs(rows, least=0.5, words=60):
    sets = {}
    for i, t in {(r[0], r[3]) for r in rows if r[0] is not None and r[3] is not None}:
        w = [x.lower() for x in re.findall(r"[^\W_]+", t)]
        if len(w) >= words:
            sets[i] = set(zip(w, w[1:], w[2:]))
    ids = sorted(sets)
    return {(x, y) for n, x in enumerate(ids) for y in ids[n + 1 :] if len(sets[x] & sets[y]) >= least * len(sets[x] | sets[y])}


@pytest.fixture(scope="module")
def near(spark):
    rows = [record(f"solo{i}", text(i)) for i in range(15)]
    base = text(100).split()
    rows += [record("base", " ".join(base)), record("copy", " ".join(base)), record("copy2", " ".join(base)), record("edited", " ".join(base[:40] + ["new"] + base[41:]))]
    rows += [record("moved", " ".join(base[40:] + base[:40])), record("longer", " ".join(base + text(7, 12).split())), record("shout", " ".join(base).upper() + "!")]
    rows += [record("base", " ".join(base)), record("short", "too short"), record("empty", ""), record("null", None), record(None, " ".join(base)), record("huge", text(3, 60_000))]
    return rows


def test_near_duplicates(spark, near):
    df = table(spark, near)
    got = {tuple(r) for r in near_duplicates.near_duplicate_pairs(df).collect()}
    assert got == brute_pairs(near) and ("base", "copy") in got and ("base", "shout") in got
    groups = {r["id"]: (r["group_id"], r["links"]) for r in near_duplicates.near_duplicate_groups(df).collect()}
    assert len(groups) == len({r[0] for r in near if r[0]}) and groups["null"][0] is None
    assert len({groups[i][0] for i in ("base", "copy", "edited", "moved", "longer", "shout")}) == 1 and groups["solo1"][1] == 0
    assert near_duplicates.near_duplicate_pairs(df.limit(0)).count() == 0


def test_hashes_shared_by_texts(spark, near):
    """With a hash of three values every key stands for several texts; they are told apart all the same."""
    links, members, _ = near_duplicates.near_duplicate_links(table(spark, near), hashed=F.pmod(F.xxhash64("response"), F.lit(3)))
    assert {tuple(r) for r in near_duplicates.expand(links, members).collect()} == brute_pairs(near)


def test_hot_blocks_are_salted(spark, near, monkeypatch):
    monkeypatch.setattr(near_duplicates, "HOT_BUCKET", 2)
    df = table(spark, near)
    want = brute_pairs(near)
    assert {tuple(r) for r in near_duplicates.near_duplicate_pairs(df).collect()} == want
    marks = [("base", "train"), ("copy", " Test "), ("edited", "VALIDATION"), ("moved", "train"), ("moved", "Train"), ("shout", None), ("longer", "dev"), (None, "train"), ("gone", "test")]
    sides = spark.createDataFrame([(*m, "clash", 1) for m in marks], "id string, split string, text string, block int")
    clean = {"base": "train", "copy": "test", "edited": "validation", "moved": "train"}
    got = {(r["id_a"], r["id_b"], r["split_a"], r["split_b"]) for r in cross_split.cross_split_pairs(df, sides).collect()}
    assert got == {(x, y, clean[x], clean[y]) for x, y in want if x in clean and y in clean and (clean[x] == "train") != (clean[y] == "train")}
    report = {(r["split"], r["source"]): (r["records"], r["pairs"]) for r in cross_split.overlap_report(df, sides).collect()}
    assert report[("test", "s")][0] == 1 and sum(p for _, p in report.values()) == len(got)
    assert cross_split.cross_split_pairs(df, sides.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randint(0, 60), r.randint(0, 60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 140)] + [(200, 200)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {q["node"]: q["component"] for q in components.components(spark.createDataFrame([*edges, (None, 1)], "src int, dst int")).collect()}
    assert got == {x: find(x) for x in parent}


WORKS = [("KT_12", "kt-00000012"), ("kt00000012", "kt-00000012"), ("urn:work:kt:12", "kt-00000012"), ("vault/kt-00000012.txt", "kt-00000012"), ("KT 12 (part 3)", "kt-00000012"), ("kt-00000012#c10", "kt-00000012"), ("kt-00000012/ch-7", "kt-00000012"), ("item_12", None), ("958d29fcdd955eb776a87a18e189c410", None), ("a4kt12ef", None), (None, None), ("", None)]


def test_splits(spark):
    rows = [record(f"k{i}", "t", original=o) for i, (o, _) in enumerate(WORKS)] + [record("k0", "t", original=WORKS[0][0]), record("other", "t", original="mv-3"), record("far", "t", original="QO-9"), record("alone", "t", original="zr-8"), record(None, "t", original="kt-12")]
    df = table(spark, rows)
    assert [r[0] for r in df.where("id rlike '^k[0-9]'").dropDuplicates(["id"]).orderBy(F.substring("id", 2, 3).cast("int")).select(splits.work_of(F.col("meta.original_id"))).collect()] == [w for _, w in WORKS]
    authors = [("kt-00000012", " Ann_Bee_7 "), ("mv-00000003", "@ann_bee_7"), ("mv-00000003", "CY_DEE_8"), ("bx-00000001", "cy_dee_8"), ("bx-00000001", "ed_9"), ("qo-00000009", "Ed_9"), ("zr-00000008", "Anonymous"), ("kt-00000012", "unknown"), ("zr-00000008", None), ("kt-00000012", None), ("zr-00000008", "")]
    wa = spark.createDataFrame([(w, a, "author", "clash") for w, a in authors], "work_id string, author string, credit string, id string")
    got = {r["id"]: r["group_key"] for r in splits.related_records(df, wa).collect()}
    assert got == {**{f"k{i}": "bx-00000001" for i in range(7)}, "other": "bx-00000001", "far": "bx-00000001"}
    placed = {r["id"]: r["split"] for r in splits.assign_splits(df, wa).collect()}
    assert len({placed[i] for i in got}) == 1 and set(placed) == {r[0] for r in rows if r[0]} and set(placed.values()) <= {"train", "validation", "test"}
    assert splits.related_records(df.limit(0), wa.limit(0)).count() == 0 and splits.assign_splits(df.limit(0), wa).count() == 0


def test_draw_refines_the_edge(spark):
    """Ties in the hash and few buckets: the rows drawn are the first of each cell by hash and id."""
    rows = spark.range(500).select((F.col("id") % 3).cast("int").alias("cell"), F.col("id").cast("string").alias("id"), F.when(F.col("id") < 40, 5).otherwise(F.xxhash64("id")).alias("h"))
    quota = spark.createDataFrame([(0, 20), (1, 0), (2, 166), (7, 4)], "cell int, quota bigint")
    got = sorted((r["cell"], r["id"]) for r in sampling.drawn(rows, quota, buckets=4).collect())
    every = rows.collect()
    want = [(c, r["id"]) for c, n in ((0, 20), (2, 166)) for r in sorted((r for r in every if r["cell"] == c), key=lambda r: (r["h"], r["id"]))[:n]]
    assert got == sorted(want)


def test_split_shares(spark):
    df = spark.range(6000).select(F.concat(F.lit("r"), "id").alias("id"), F.struct(F.when(F.col("id") < 700, "kt-1").when(F.col("id") < 3000, F.concat(F.lit("mv-"), F.col("id") % 500)).alias("original_id")).alias("meta"))
    wa = spark.createDataFrame([], "work_id string, author string")
    got = {r["split"]: r["count"] for r in splits.assign_splits(df, wa).groupBy("split").count().collect()}
    assert abs(got["train"] / 6000 - 0.9) < 0.002 and abs(got["test"] / 6000 - 0.05) < 0.002


def test_defects(spark):
    rows = [record("a", "", prompt="Write."), record("a", "", prompt="Write."), record("b", None, prompt="Write."), record("c", "", prompt=None), record(None, "", prompt="x"), record("d", "Luck.", prompt=""), record("e", "It ended there, and nobody ever came back. " * 3000 + "But then the", prompt="Tell me.")]
    assert {r["id"]: r["defect"] for r in pairs.defective_pairs(table(spark, rows)).collect()} == {"a": "empty", "b": "empty", "e": "truncated"}
    assert {(r["source"], r["defect"], r["records"]) for r in pairs.defect_counts(table(spark, rows)).collect()} == {("s", "empty", 2), ("s", "truncated", 1)}
    assert pairs.defective_pairs(table(spark, rows).limit(0)).count() == 0


def test_sampling(spark):
    rows = [record(f"a{i}", "t", top=" Poetry ", sub="Lyric-Poetry") for i in range(60)] + [record(f"b{i}", "t", top="memoir", sub="m") for i in range(3)] + [record(f"n{i}", "t") for i in range(37)]
    rows += [record("a1", "t", top="poetry", sub="lyric_poetry"), record(None, "t", top="memoir", sub="m")]
    targets = spark.createDataFrame([("poetry", "lyric_poetry", 500, 1, 0), ("memoir", "m", 100, 4, 0), ("gone", "g", 400, 0, 0)], "top string, sub string, target_permille bigint, min_rows bigint, id int")
    df = table(spark, rows)
    report = {r["top"]: tuple(r)[2:] for r in sampling.sample_report(df, targets).collect()}
    assert report["memoir"] == (3, 4, 3, 1) and report["gone"] == (0, 8, 0, 8) and report["poetry"][:2] == (60, 10)
    got = sampling.stratified_sample(df, targets).collect()
    assert len(got) == len({r["id"] for r in got}) == 20 and sum(r["top"] == "memoir" for r in got) == 3
    assert sorted(r["id"] for r in sampling.stratified_sample(df.repartition(3), targets).collect()) == sorted(r["id"] for r in got)
    assert {tuple(r) for r in sampling.short_cells(df, targets).collect()} == {("memoir", "m"), ("gone", "g")}
    assert sampling.stratified_sample(df.limit(0), targets).count() == 0


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(1, "One two THREE, four\nfive."), (2, None), (3, ""), (4, " \n\t"), (5, "x" * 200_000), (6, "<|endoftext|> hi \U0001f600"), (7, "One two THREE, four\nfive."), (None, "zero one two three four")]
    return spark.createDataFrame([(i, t, "EN-us ", " My-Source", "poetry", "clash", 0) for i, t in rows], "doc_id bigint, text string, lang string, source string, genre string, ids string, item_id int")


def test_encoding(spark, documents):
    got = {r["doc_id"]: r["ids"] for r in encoding.encode_documents(documents).collect()}
    assert got[2] == got[3] == [] and got[1] == got[7] and 50256 not in got[6] and len(got) == 8
    ranks = {v: k for k, v in encoding.encoder(f"{encoding.TOKENIZERS}/{encoding.RANK_FILE}").ranks.items()}
    for r in documents.where("text is not null").collect():
        assert b"".join(ranks[i] for i in got[r["doc_id"]]).decode() == r["text"]
    assert encoding.encode_documents(documents.limit(0)).count() == 0


def test_budget(spark, documents):
    rows = [record("a", "One two THREE, four\nfive.", source=" My-Source", top="poetry"), record("a", "One two THREE, four\nfive.", source="my_source", top="poetry"), record("b", None), record(None, "x"), record("c", "  ")]
    got = {(r["part"], r["source"], r["lang"], r["domain"]): (r["texts"], r["distinct_texts"], r["tokens"], r["distinct_tokens"]) for r in budget.token_budget(table(spark, rows), documents).collect()}
    one = len(encoding.encoder(f"{encoding.TOKENIZERS}/{encoding.RANK_FILE}").encode_batch(["One two THREE, four\nfive."])[0])
    assert got[("records", "my_source", "en", "poetry")] == (1, 1, one, one)
    texts, distinct, tokens, once = got[("documents", "my_source", "en", "poetry")]
    assert (texts, distinct, tokens - once) == (5, 4, one)
    assert budget.token_budget(table(spark, rows).limit(0), documents.limit(0)).count() == 0


def test_pieces(spark):
    body = "".join(f"Sentence number {i} stands here. " for i in range(400))
    rows = [record("a", body, span=[10, 20]), record("a", body, span=[10, 20]), record("b", "y" * 7000), record("c", "z" * 3000), record("d", None), record("e", body, span=[]), record(None, body)]
    got = pieces.split_oversized(table(spark, rows)).collect()
    assert {r["id"] for r in got} == {"a", "b", "e"}
    for i, source, base in (("a", body, 10), ("b", "y" * 7000, 0), ("e", body, 0)):
        own = sorted((r for r in got if r["id"] == i), key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and own[-1]["span_end"] == base + len(source)
        assert all(r["text"] == source[r["span_start"] - base : r["span_end"] - base] and len(r["text"]) <= 3000 for r in own)
        assert all(y["span_start"] <= x["span_end"] <= y["span_start"] + 200 for x, y in zip(own, own[1:]))
    with pytest.raises(ValueError):
        pieces.split_oversized(table(spark, rows), 10, 10)


def test_leaks(spark, documents, monkeypatch):
    items = spark.createDataFrame([(7, "t", "en", "Two three four, FIVE six"), (8, "t", "en", None), (9, "t", "en", "short"), (None, "t", "en", "one two three four")], "item_id bigint, task string, lang string, text string")
    got = {tuple(r) for r in leaks.leaked_passages(documents, items, 3).collect()}
    assert got == {(1, 7, 4, 24, 4), (7, 7, 4, 24, 4)}
    assert {r["item_id"]: r["documents"] for r in leaks.leak_report(documents, items, 3).collect()} == {7: 2, 8: 0, 9: 0}
    more = items.union(spark.createDataFrame([(10, "t", "en", "one two three")], items.schema))
    monkeypatch.setattr(leaks, "ITEMS_A_PASS", 1)
    assert {(r["doc_id"], r["item_id"]) for r in leaks.leaked_passages(documents, more, 3).collect()} == {(1, 7), (7, 7), (1, 10), (7, 10)}
    assert leaks.leaked_passages(documents, items.limit(0)).count() == 0


def test_personal_data(spark):
    body = "The road was long. Reviewed by Anna Bellmer. Write to a.bell@post.example or call +44 7700 900123.\nNothing else."
    df = spark.createDataFrame([(1, body, "x"), (1, body, "y"), (2, None, "x"), (3, "", "x"), (None, body, "x")], "doc_id bigint, text string, pii_type string")
    names = spark.createDataFrame([("Anna", "given"), ("Bellmer", "family"), (None, "given")], "name_form string, kind string")
    got = [tuple(r) for r in pii.find_personal_data(df, names).where("doc_id is not null").orderBy("start_pos").collect()]
    assert [(t, body[s:e]) for _, t, s, e in got] == [("name", "Anna Bellmer"), ("email", "a.bell@post.example"), ("phone", "+44 7700 900123")]
    clean = pii.redact_personal_data(df, names).where("doc_id = 1").first()
    assert clean["text"] == "The road was long. Reviewed by [NAME]. Write to [EMAIL] or call [PHONE].\nNothing else." and clean["places"] == 3
    assert pii.redact_personal_data(df, names).where("doc_id = 2").first()["text"] is None
    assert pii.find_personal_data(df.limit(0), names.limit(0)).count() == 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name):
    from pathlib import Path

    import duckdb

    data = Path("/root/testdata/sf0.001")
    if not data.exists():
        pytest.skip("no test data")
    con = duckdb.connect()
    for f in data.glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    df, expected = queries()[name](spark, str(data)), con.sql(oracle_sql()[name])
    assert sorted(str(tuple(r[c] for c in expected.columns)) for r in df.collect()) == sorted(map(str, expected.fetchall()))


def test_pieces_cover_their_records(spark):
    rows = [record("a", "word " * 2000), record("b", "x" * 9001, span=[40, 9041]), record("c", "short"), record("d", None), record("e", "line\n\n" * 900)]
    got = {r["id"]: tuple(r)[1:] for r in pieces.cover(pieces.split_oversized(table(spark, rows)), table(spark, rows)).collect()}
    assert got == {"a": (10000, True, True), "b": (9001, True, True), "e": (5400, True, True)}
