import random

from inkmill.llm import near_duplicates


def _set(text):
    w = "".join(c if c.isalnum() else " " for c in text.lower()).split()
    return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else {tuple(w)} - {()}


def test_groups_link_texts_of_any_length(spark):
    r = random.Random(4)
    texts = ["No.", "no", "No way", "NO WAY!", "...", "—", "", "la partitura estaba sobre la mesa durante el invierno", "la cerradura estaba sobre la mesa durante el invierno"]
    for _ in range(150):
        base = [f"w{r.randrange(40)}" for _ in range(r.randrange(3, 75))]
        texts.append(" ".join(base))
        for _ in range(2):
            other = list(base)
            for _ in range(r.randrange(1, 2 + len(base) // 6)):
                other[r.randrange(len(other))] = f"w{r.randrange(40)}"
            texts.append(" ".join(other + [f"v{k}" for k in range(r.randrange(0, 4))]))
    texts += ["a b c d e " * 30, "a b c d e a b c"]  # long, with few sequences
    texts = list(dict.fromkeys(texts))
    sets = [_set(t) for t in texts]
    links = {i: set() for i in range(len(texts))}
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            short = min(len(texts[i].split()), len(texts[j].split())) < 60
            if short and a and b and len(a & b) >= 0.5 * len(a | b):
                links[i].add(j)
                links[j].add(i)
    got = {int(x["id"]): x for x in near_duplicates.near_duplicate_groups(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, response string")).collect()}
    for i, t in enumerate(texts):
        if len(t.split()) < 60:
            assert got[i]["links"] == len(links[i]), t
        assert {got[j]["group_id"] for j in links[i]} <= {got[i]["group_id"]}, t
    assert sum(map(len, links.values())) > 100
