import datetime
import hashlib
from collections import Counter

from inkmill import queries
from inkmill.operators.labels import DEFAULT_GENRES


def _hex(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _expected(ids):
    """(split, rubric) of ids, worked out by hand from the stub's rule, the routes and the ratios."""
    out = Counter()
    for i in ids:
        top = DEFAULT_GENRES[int(_hex(f"genre:{i}")[:2], 16) % len(DEFAULT_GENRES)]
        rubric = "narrative_creative" if top.startswith("story_") or top == "poetry" else "academic_informative" if top[0] in "fghn" and "_" in top else "entertainment_personal" if top == "blog_post" else "professional" if top == "memoir" else "default"
        u = int(_hex(i)[:8], 16) / 2**32
        out["test" if u < 0.05 else "train" if u < 0.95 else "validation", rubric] += 1
    return out


def test_pipeline_runs_every_stage_over_documents_and_conversations(spark, tmp_path):
    at = datetime.datetime(2026, 1, 1)
    many = [(k, f"The clerk of ward {k} wrote down what the rain had done to the roofs of the quay.", f"a/{k}") for k in range(3000)]
    long = " ".join(f"Sentence {k} of the long one goes on for ten words." for k in range(60))
    rows = [*many, (90001, long, "b"), (90002, many[0][1], "copy"), (90003, "Too short.", "c"), (90004, None, "d")]
    spark.createDataFrame(rows, "doc_id bigint, text string, source_path string").write.parquet(f"{tmp_path}/documents.parquet")
    turns = lambda q, a: [("human", q), ("gpt", a)]
    talks = [("x", turns("Describe the quay.", "The quay lay empty under the lamps until the ferry came in at six."), at), ("y", turns("And this?", many[1][1]), at)]
    spark.createDataFrame(talks, "id string, conversations array<struct<`from`:string,`value`:string>>, ingested_at timestamp").write.parquet(f"{tmp_path}/conversations.parquet")

    found = queries.queries()["pipeline_e2e"](spark, str(tmp_path)).collect()

    # chunks of 120 tokens take 10 sentences of 12 tokens; each repeats one sentence of the one before
    pieces = 1 + -(-(60 - 10) // 9)
    # of equal texts the one of the first source stays, and within a source the smaller id
    copy = min("documents:0", "documents:90002", key=_hex)
    names = [*[f"documents:{k}" for k in range(1, 3000)], copy, *[f"documents:90001:seg:{k}" for k in range(pieces)], "conversations:x"]
    assert Counter({(r["split"], r["rubric"]): r["records"] for r in found}) == _expected([f"sha256:{_hex(n)}" for n in names])
    assert sum(r["records"] for r in found) - sum(r["reconstructed"] for r in found) == 1  # the one with a prompt of its own
