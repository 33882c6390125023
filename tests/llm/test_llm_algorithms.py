"""The algorithms against plain versions, without Spark."""

import base64
import random
import re
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from inkmill.llm import bagminhash, crf, encoding, endings, language_model, leaks, pairs, pieces, pii, pii_table, sampling, splits, wordstream

WORD = re.compile(r"[^\W_]+")
TEXTS = st.text(alphabet="abÄß1² \n.’'​\U0001f600", max_size=40)


@settings(max_examples=60, deadline=None)
@given(st.lists(TEXTS, max_size=6))
def test_words(texts):
    hashes, offsets = wordstream.words(texts)
    names = [[w.lower() for w in WORD.findall(t)] for t in texts]
    assert list(np.diff(offsets)) == [len(n) for n in names]
    flat = [w for n in names for w in n]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def test_shingles_and_bags():
    hashes, offsets = wordstream.words(["a b c a b c", "a b", "", None, "a b c"])
    seq, owner = wordstream.shingles(hashes, offsets, 3)
    assert owner.tolist() == [0, 0, 0, 0, 4] and seq[0] == seq[3] == seq[4]
    element, bag, count = wordstream.bags(seq, owner)
    assert sorted(zip(bag.tolist(), count.tolist())) == [(0, 1), (0, 1), (0, 2), (4, 1)]


@pytest.mark.parametrize("common", [0, 10, 40, 80])
def test_bagminhash_estimates_weighted_jaccard(common):
    r = np.random.default_rng(common)
    wa, wb = r.integers(1, 9, 100), r.integers(1, 9, 100)
    a = np.arange(100, dtype=np.uint64)
    b = np.concatenate([a[:common], a[common:] + np.uint64(10_000)])
    truth = np.minimum(wa[:common], wb[:common]).sum() / (wa.sum() + wb.sum() - np.minimum(wa[:common], wb[:common]).sum())
    times = bagminhash.signatures(np.concatenate([a, b]), np.repeat([0, 1], 100), np.concatenate([wa, wb]), 2, 4096)
    assert abs((times[0] == times[1]).mean() - truth) < 0.03 and np.isfinite(times).all()


def test_bagminhash_does_not_depend_on_company():
    e, w = np.arange(30, dtype=np.uint64), np.arange(1, 31)
    alone = bagminhash.signatures(e, np.zeros(30, np.int64), w, 1, 64)
    both = bagminhash.signatures(np.concatenate([e[::-1], e[:3]]), np.repeat([0, 1], [30, 3]), np.concatenate([w[::-1], w[:3]]), 2, 64)
    assert (alone[0] == both[0]).all()
    assert bagminhash.signatures(e[:0], np.zeros(0, np.int64), w[:0], 2, 8).shape == (2, 8)


def test_code_blocks():
    r = np.random.default_rng(3)
    times = r.random((3, 200))
    times[1, :150] = times[0, :150]
    code = bagminhash.code(times)
    block = bagminhash.segments(code, 5, 2)
    assert code.shape == (3, 200) and block.shape == (3, 80) and len(np.unique(block[0] >> 40)) == 80
    # the first cut has the registers in order: three quarters of the segments are those of the other text
    assert (block[0] == block[1])[:40].sum() == 30 and not (block[0] == block[2]).any()
    bits = np.unpackbits(code, axis=1)
    assert 150 < (bits[0] != bits[1]).sum() < 250 and 700 < (bits[0] != bits[2]).sum() < 900
    # the second cut uses every register once, in other company
    one = np.zeros((1, 200), np.uint8)
    seen = [int((bagminhash.segments(one + (np.arange(200) == k), 5, 2)[0] != bagminhash.segments(one, 5, 2)[0]).sum()) for k in range(200)]
    assert seen == [2] * 200


@pytest.mark.parametrize(("similarity", "least"), [(0.5, 0.85), (0.55, 0.93), (0.6, 0.97), (0.7, 0.999)])
def test_recall_of_code_blocks(similarity, least):
    """Share of pairs of a given similarity that meet in a block within the radius."""
    from inkmill.llm.near_duplicates import RADIUS, REGISTERS, ROWS, TURNS

    r, n, size = np.random.default_rng(8), 800, 150
    common = round(2 * size * similarity / (1 + similarity))
    element = r.integers(0, 1 << 44, (n, 2, size)).astype(np.uint64)
    element[:, 1, :common] = element[:, 0, :common]
    times = bagminhash.signatures(element.ravel(), np.repeat(np.arange(2 * n), size), np.ones(2 * n * size), 2 * n, REGISTERS)
    code = bagminhash.code(times)
    block = bagminhash.segments(code, ROWS, TURNS)
    near = np.unpackbits(code[0::2] ^ code[1::2], axis=1).sum(axis=1) <= RADIUS
    assert ((block[0::2] == block[1::2]).any(axis=1) & near).mean() >= least and near.mean() > 0.998


RANKS = Path(encoding.TOKENIZERS) / encoding.RANK_FILE


@pytest.fixture(scope="module")
def coder():
    if not RANKS.exists():
        pytest.skip("no tokenizer files")
    return encoding.Encoder(str(RANKS))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="'stmdlrve aAé1²\n\t \xa0​!?<|>\U0001f600\x1c", max_size=25), max_size=5))
def test_encoding_equals_reference_library(texts):
    tiktoken = pytest.importorskip("tiktoken")
    if not RANKS.exists():
        pytest.skip("no tokenizer files")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.open("rb"))}
    own = tiktoken.Encoding("own", pat_str=encoding.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids, offsets = encoding.encoder(str(RANKS)).encode_batch(texts)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [own.encode_ordinary(t) for t in texts]


def test_long_runs_take_the_heap(coder):
    r = random.Random(1)
    for n in (65, 300):
        w = "".join(r.choice("abcde") for _ in range(n)).encode()
        assert coder._heap(w) == coder._scan(w)
    tokens = {v: k for k, v in coder.ranks.items()}
    assert b"".join(tokens[i] for i in coder._heap(b"ab" * 20_000)) == b"ab" * 20_000


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab .\n!", max_size=300), st.integers(20, 60), st.integers(0, 10))
def test_pieces(text, limit, overlap):
    got = pieces.cut(text, limit, overlap)
    assert got[0][0] == 0 and got[-1][1] == len(text)
    for a, b, _ in got:
        assert b - a <= limit
    for (a, b, how), (c, _, _) in zip(got, got[1:]):
        assert a < c <= b and b - c <= overlap
        if how == "hard":
            assert not any(m.end() > a and m.end() <= a + limit for m in re.finditer(r"\s+", text))


def test_cut_takes_any_boundary_before_a_hard_cut():
    got = pieces.cut("x" * 150 + " " + "y" * 7000, 3000, 200)
    assert [p[:2] for p in got] == [(0, 151), (151, 3151), (2951, 5951), (5751, 7151)] and [p[2] for p in got] == ["word", "hard", "hard", "end"]


def test_cut_by_tokens(coder):
    text = "The ferry crossed the river — señor \U0001f600 waited. " * 40 + "z" * 300
    upto = pieces.token_offsets(text)
    got = pieces.cut(text, 50, 5, upto)
    assert upto[-1] == len(coder.encode_batch([text])[0]) and got[0][0] == 0 and got[-1][1] == len(text)
    assert all(upto[b] - upto[a] <= 50 for a, b, _ in got) and all(a < c <= b and upto[b] - upto[c] <= 5 for (a, b, _), (c, _, _) in zip(got, got[1:]))


def test_words_of_one_hash(coder):
    """A word under the hash of another one gets its own ids."""
    e = encoding.Encoder(str(RANKS))
    e.encode_batch(["river ferry"])
    e.words = ["another" if w else w for w in e.words]
    assert e.encode_batch(["river ferry"])[0].tolist() == coder.encode_batch(["river ferry"])[0].tolist()


def test_cut_prefers_paragraphs():
    text = "x" * 40 + "\n\n" + "y " * 10 + "z" * 60
    assert [how for *_, how in pieces.cut(text, 60, 0)] == ["paragraph", "word", "end"] or pieces.cut(text, 60, 0)[0][1] == 42


def brute_leaks(items, text, n):
    w = [x.lower() for x in WORD.findall(text)]
    grams = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    return {i for i, t in items if any(tuple(v[k : k + n]) in grams for v in [[x.lower() for x in WORD.findall(t)]] for k in range(len(v) - n + 1))}


def test_leaks_equal_brute_force():
    r = random.Random(5)
    items = [(i, " ".join(r.choice("ab cd ef gh") for _ in range(20))) for i in range(12)]
    a = leaks.automaton(items, 4)
    for _ in range(40):
        text = ", ".join(r.choice(["ab", "CD", "ef", "gh", " ", "b"]) for _ in range(30))
        found = leaks.matches(a, text, 4)
        assert {m[0] for m in found} == brute_leaks(items, text, 4)
        for _, s, e, k in found:
            assert len(WORD.findall(text[s:e])) == k >= 4 and text[s].isalnum() and text[e - 1].isalnum()
    assert leaks.matches(a, "", 4) == []


def test_leak_positions():
    a = leaks.automaton([(7, "one two three four five")], 3)
    text = "Zero — ONE, two\nthree! then four five"
    assert leaks.matches(a, text, 3) == [(7, 7, 21, 3)]


@pytest.mark.parametrize("seed", range(6))
def test_swap_repair(seed):
    r = np.random.default_rng(seed)
    k = 6
    held, floors = r.integers(0, 60, k), r.integers(0, 6, k)
    size = int(held.sum() * 0.4)
    ideal = r.random(k)
    ideal = ideal / ideal.sum() * size
    start = sampling.random_start(held, floors, size, r)
    got = sampling.swap_repair(start, held, floors, ideal)
    assert start.sum() == got.sum() == size and (got <= held).all() and (got >= np.minimum(held, floors)).all()
    dev = sampling._deviation
    for i in range(k):
        for j in range(k):
            if i != j and got[i] - 1 >= min(held[i], floors[i]) and got[j] + 1 <= held[j]:
                other = got.copy()
                other[i] -= 1
                other[j] += 1
                assert dev(other, ideal).sum() >= dev(got, ideal).sum() - 1e-9
    assert sampling.wanted(9, 2, 400) == 4 and sampling.wanted(10, 5, 400) == 5


def test_random_draw_at_any_size():
    r = np.random.default_rng(2)
    for held, size in (([5, 0, 3], 8), ([5, 0, 3], 4), ([10**12, 3 * 10**12, 7], 10**11), ([2 * 10**10] * 4, 79_999_999_999), ([40, 60], 0)):
        got = sampling.random_draw(np.array(held), size, r)
        assert got.sum() == size and (got <= np.array(held)).all() and (got >= 0).all()
    # as in a draw without replacement: mean and variance of the hypergeometric distribution
    draws = np.array([sampling.random_draw(np.array([30, 70]), 20, r)[0] for _ in range(3000)])
    assert abs(draws.mean() - 6) < 0.15 and abs(draws.var() - 20 * 0.3 * 0.7 * 80 / 99) < 0.4


def test_exhausted():
    held, want, taken = np.array([3, 50, 9, 100]), np.array([5, 10, 8, 0]), np.array([2, 9, 8, 1])
    assert sampling.exhausted(taken, held, want).tolist() == [2, 0, 0, 0]


def test_fitted_weight():
    counted = [(0, 3, 40), (0, 9, 10), (0, 5, 30), (1, 2, 60), (1, 4, 20)]
    assert splits.fitted(counted, 70) == (0, 6) and splits.fitted(counted, 61) == (1, 3) and splits.fitted([], 5) == (0, 0)


def test_language_held_out():
    held_out = {
        "en": "Nobody could remember which of the two sisters had kept the key of the old mill.",
        "fr": "Personne ne pouvait se rappeler laquelle des deux sœurs avait gardé la clef du vieux moulin.",
        "de": "Niemand konnte sich erinnern, welche der beiden Schwestern den Schlüssel der alten Mühle behalten hatte.",
        "es": "Nadie podía recordar cuál de las dos hermanas había guardado la llave del viejo molino.",
    }
    p = language_model.posteriors([*held_out.values(), "", "123 !"])
    assert [language_model.LANGUAGES[i] for i in p[:4].argmax(axis=1)] == list(held_out) and np.allclose(p[4:], 0.25)


@pytest.mark.parametrize(
    ("text", "cut"),
    [
        ("It was late. The bells rang over the town.", False), ("It was late. The bells rang over the", True), ("It was late. The bells rang,", True), ('He left. "I will come," she said. "Wait.', True), ("1. One thing is here.\n2. Two things are there.\n3.", True),
        ("The boat came back.\n\nEver yours,\nMarta", False), ("The boat came back.\n\nTHE END", False), ("The boat came back.</p>\n ", False), ("« Elle est partie », dit le fermier.", False), ("Luck.", False), ("So it went on (as they", True),
    ],
)
def test_endings(text, cut):
    assert (endings.cut_score(text) > 0) == cut


LONG = "The ferryman crossed the river before the bells rang, and nobody on the other shore had seen him leave the house that morning. "
PAIRS = [
    ("Write a poem.", "  *** ", "empty"), ("Write a poem.", "[no response]", "empty"), ("Write a poem.", "N/A", "empty"), ("Write a poem.", "", "empty"), ("What is courage to a child of ten?", '"What is courage to a child of ten?"', "copied"),
    ("What is courage to a child of ten?", "Q: what is courage to a child of ten\nA: what is courage to a child of ten", "copied"), ("Write a poem.", "I'm sorry, but I can't help with that request. Perhaps try another topic.", "refusal"), ("Schreibe ein Gedicht.", "Leider gilt: ich muss das ablehnen.", "refusal"),
    ("Write a story about the river.", "Der Fährmann fuhr über den Fluss, bevor die Glocken läuteten, und niemand am anderen Ufer hatte ihn gesehen.", "wrong_language"), ("Write this in German, please. A story about the river.", "Der Fährmann fuhr über den Fluss, bevor die Glocken läuteten, und niemand am anderen Ufer hatte ihn gesehen.", None),
    ("Tell me about the river.", LONG + "Then the", "truncated"), ("Tell me about the river.", LONG.strip(), None), ("Name a feeling.", "Luck.", None), ("Tell me about the shop.", '"I can\'t sell the kiln," said Ann. "I\'m sorry, but my pride will not allow it."', None),
    ("Tell me about the river.", "I can't promise a masterpiece, but here goes:\n\n" + LONG * 3, None),
]


@pytest.mark.parametrize(("prompt", "response", "defect"), PAIRS)
def test_defects(prompt, response, defect):
    assert pairs.defects([prompt], [response.strip(" ") if defect is None else response]) == [defect]


def brute_viterbi(score, move, allowed, start):
    import itertools

    best, path = -np.inf, None
    for p in itertools.product(range(score.shape[1]), repeat=len(score)):
        if not start[p[0]] or not all(allowed[a, b] for a, b in zip(p, p[1:])):
            continue
        s = sum(score[i, y] for i, y in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:]))
        if s > best:
            best, path = s, p
    return path


def test_viterbi_equals_brute_force():
    r = np.random.default_rng(0)
    allowed = np.array([[True, True, False], [True, True, True], [True, True, True]])
    start = np.array([True, True, False])
    for _ in range(20):
        lengths = r.integers(1, 6, 3)
        score, move = r.normal(size=(int(lengths.sum()), 3)), r.normal(size=(3, 3))
        begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        got = crf.viterbi(score, begins, lengths, move, allowed, start)
        for b, n in zip(begins, lengths):
            assert tuple(got[b : b + n]) == brute_viterbi(score[b : b + n], move, allowed, start)


def test_pii_held_out():
    """Another table by the same rules: the share of places found and of places right."""
    table, _ = pii_table.labelled_table(seed=77, singles=60, rounds=1)
    tagger = pii.Tagger({n.lower() for n in pii_table.GIVEN[::2]}, {n.lower() for n in pii_table.FAMILY[::2]})
    texts = ["".join(p for p, _ in s) for s in table]
    hit = wrong = missed = 0
    for s, found in zip(table, tagger.tag(texts)):
        gold, at = set(), 0
        for p, kind in s:
            if kind:
                gold.add((kind, at))
            at += len(p)
        got = {(k, a) for k, a, _ in found}
        hit, wrong, missed = hit + len(gold & got), wrong + len(got - gold), missed + len(gold - got)
    assert hit / (hit + missed) > 0.9 and hit / (hit + wrong) > 0.9


def test_redaction():
    text = "Call Ann Bell on 07700 900123 now."
    assert pii.redact(text, [("name", 5, 13), ("phone", 17, 29)]) == "Call [NAME] on [PHONE] now."
    tagger = pii.Tagger(frozenset({"ann"}), frozenset({"bell"}))
    assert tagger.tag(["", " \n", "x" * 50_000]) == [[], [], []]


