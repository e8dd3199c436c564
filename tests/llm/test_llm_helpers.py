import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from labwatch.llm import suffix_dedup, suffixes
from labwatch.llm.common import few_of, texts_of
from labwatch.llm.components import connected_components
from labwatch.llm.hmm import Hmm
from labwatch.llm.language import codewords
from labwatch.llm.packing import best_fit_decreasing, lower_bound
from labwatch.llm.shingles import Bands, fold_to, folded_sketch, segment_keys, shingle_set, similar_enough
from labwatch.llm.topk import Block, search_blocks
from labwatch.llm.toxicity import ToxicityModel, all_segments, best_segments, word_features


def test_components(spark):
    random = np.random.default_rng(0)
    chain = [(i, i + 1) for i in range(40)]
    loose = [(int(a), int(b)) for a, b in random.integers(1000, 1400, (150, 2))]
    edges = [*chain, *loose, (7, 7), (None, 3), (5, 4), (5, 4)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {n: find(n) for n in parent}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_of(spark):
    ids = spark.createDataFrame([(n * 7919 - 50_000,) for n in range(500)] + [(0,), (1 << 24,)], "needed long")
    passes = few_of(ids)
    assert passes(np.array([n * 7919 - 50_000 for n in range(500)] + [0, 1 << 24])).all()
    assert passes(np.arange(1, 100_000, 3)).mean() < 0.05
    texts = spark.createDataFrame([(0, "a"), (0, "a"), (5, "b"), (1 << 25, "c")], "text_id long, text string")
    assert [tuple(r) for r in texts_of(texts, ids).collect()] == [(0, "a")]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 30), st.integers(0, 40), st.booleans()), max_size=8), st.sampled_from([b"ab", b"a", b"\x00\xffz"]), st.integers(0, 9))
def test_repeated_windows(cuts, alphabet, seed):
    random = np.random.default_rng(seed)
    texts = [bytes(alphabet[i] for i in random.integers(0, len(alphabet), 60)) for _ in range(3)]
    strings = [texts[t][a : a + n] for t, a, n, _ in cuts]
    known = np.array([k for *_, k in cuts], bool)
    places = {}
    for i, (t, a, n, _) in enumerate(cuts):
        for s in range(len(strings[i]) - 9):
            places.setdefault(strings[i][s : s + 10], []).append((i, t, a + s))
    expected = set()
    for found in places.values():
        if len({(t, p) for _, t, p in found}) > 1 or any(known[i] for i, *_ in found):
            expected |= {(i, q) for i, _, p in found for q in range(p, p + 10)}
    got = suffixes.repeated_windows(strings, np.array([c[0] for c in cuts]), np.array([c[1] for c in cuts]), known, 10)
    assert {(i, q) for i, b, e in got for q in range(b, e)} == expected


@pytest.mark.parametrize("block", [1, 7, 150, 300, 999])
def test_anchors_do_not_depend_on_blocks(monkeypatch, block):
    text = np.random.default_rng(block).integers(97, 123, 3000).astype(np.uint8)
    whole = [c.tolist() for c in suffix_dedup.anchors(text, 100)]
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    assert [c.tolist() for c in suffix_dedup.anchors(text, 100)] == whole
    key, same, _, _ = suffix_dedup.cells_of(text.tobytes(), 100)
    assert len(set(zip(key.tolist(), same.tolist()))) == len(key)


def test_two_stage_order_is_sorted():
    data = b"mississippi banana\x00\xff aaaaaaaaaabbbb"
    numbers = np.frombuffer(data, np.uint8)
    order = suffixes.two_stage_order(numbers, np.array([0]), np.array([len(data)]), np.array([len(data)]), 40)
    assert [data[i:] for i in order] == sorted(data[i:] for i in range(len(data)))


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 400), min_size=1, max_size=80), st.sets(st.integers(0, 400), max_size=12), st.sampled_from([(80, 100), (90, 100), (1, 2)]))
def test_linked_sets_share_a_segment(base, change, threshold):
    num, den = threshold
    one = shingle_set(b" ".join(b"%d" % n for n in sorted(base)), 1)
    two = shingle_set(b" ".join(b"%d" % n for n in sorted(base ^ change)), 1)
    bands = Bands(num, den)
    if len(two) and similar_enough(one, two, num, den):
        keys = [{k for b in bands.bands_of(len(s)) for k in segment_keys(s, b, bands).tolist()} for s in (one, two)]
        assert keys[0] & keys[1]
        sketches = [folded_sketch(s, bands) for s in (one, two)]
        words = min(len(s) for s in sketches) // 8
        differ = np.bitwise_count(fold_to(sketches[0], words) ^ fold_to(sketches[1], words)).sum()
        assert differ <= len(set(one.tolist()) ^ set(two.tolist())) <= bands.most_different(len(one), len(two))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 20), max_size=30))
def test_best_fit(lengths):
    lengths = np.array(lengths, np.int64)
    bins, offsets, free = best_fit_decreasing(lengths, 20)
    for b in range(len(free)):
        own = sorted(zip(offsets[bins == b].tolist(), lengths[bins == b].tolist()))
        assert sum(n for _, n in own) + free[b] == 20
        at = 0
        for offset, n in own:
            assert offset == at
            at += n
    assert lower_bound(np.bincount(lengths, minlength=21), 20) <= max(len(free), 1)


def test_lower_bound_knows_large_pieces():
    # No two of 11 to 14 share a bin of 20; three of 7 do not fit either beside them.
    assert lower_bound(np.bincount([11, 12, 13, 14], minlength=21), 20) == 4
    assert lower_bound(np.bincount([7] * 5, minlength=21), 20) == 3


def test_forward_and_backward():
    random = np.random.default_rng(2)
    norm = lambda x: x / x.sum(axis=-1, keepdims=True)
    hmm = Hmm(norm(random.random(3)), norm(random.random((3, 3))), norm(random.random((3, 5))))
    sequences = [random.integers(0, 5, n).astype(np.uint16) for n in (1, 4, 4, 6)]

    def paths(s):
        import itertools

        for states in itertools.product(range(3), repeat=len(s)):
            p = hmm.start[states[0]] * hmm.emit[states[0], s[0]]
            for t in range(1, len(s)):
                p *= hmm.move[states[t - 1], states[t]] * hmm.emit[states[t], s[t]]
            yield states, p

    starts, moves, emissions, total = hmm.expected(sequences)
    want = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))
    logs = []
    for s in sequences:
        weighed = list(paths(s))
        whole = sum(p for _, p in weighed)
        logs.append(np.log10(whole))
        for states, p in weighed:
            want[0][states[0]] += p / whole
            for t in range(len(s)):
                want[2][states[t], s[t]] += p / whole
                if t:
                    want[1][states[t - 1], states[t]] += p / whole
    assert np.allclose(hmm.log10_likelihoods(sequences), logs) and np.isclose(total, sum(logs))
    for got, expected in zip((starts, moves, emissions), want):
        assert np.allclose(got, expected)


def test_search_blocks():
    random = np.random.default_rng(4)
    rows = random.integers(-9, 9, (300, 6)).astype(float)
    keys = random.permutation(1000)[:300]
    blocks = [Block(keys[i : i + 32], keys[i : i + 32], rows[i : i + 32]) for i in range(0, 300, 32)]
    own, queries = keys[:25], rows[:25]
    number, score, found = search_blocks(queries, own, np.full(25, -np.inf), blocks, 7)
    for q in range(25):
        best = sorted((-float(queries[q] @ r), int(k)) for k, r in zip(keys, rows) if k != own[q])[:7]
        assert [(-s, k) for s, k in best] == list(zip(score[number == q].tolist(), found[number == q].tolist()))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(-4, 4), max_size=12), min_size=1, max_size=5))
def test_segments(texts):
    sizes = np.array([len(t) for t in texts])
    best = best_segments(np.array([x for t in texts for x in t], float), sizes)
    for text, value in zip(texts, best):
        sums = [sum(text[i:j]) for i in range(len(text)) for j in range(i + 1, len(text) + 1)]
        assert value == max([0, *sums])
        found = all_segments(np.array(text, float))
        assert max([s for *_, s in found], default=0) == value
        assert all(s == sum(text[f:e]) > 0 for f, e, s in found)
        assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))


def test_token_scores_do_not_depend_on_neighbours():
    odds = np.zeros(1 << 20, np.float32)
    odds[word_features(b"vile")] = 3.0
    model = ToxicityModel(odds, 0.5, 1.0, 1.0, np.array([-3.0, 1.0, 0.0, 0.0]), 0.05)
    texts = [b"vile"] * 3 + [b""] + [b"vile so vile"] * 3 + [b"vile vile so", b"", b"so", b"vile", b" "]
    alone = [model.token_scores([t])[0].tolist() for t in texts]
    assert alone[0] == [2.5] and alone[4] == [2.5, -0.5, 2.5] and alone[7] == [2.5, -0.5, -0.5]
    for order in (np.arange(len(texts)), np.arange(len(texts))[::-1], np.random.default_rng(0).permutation(len(texts))):
        scores, sizes = model.token_scores([texts[i] for i in order])
        assert [s.tolist() for s in np.split(scores, np.cumsum(sizes)[:-1])] == [alone[i] for i in order]
        features, _ = model.evidence([texts[i] for i in order])
        assert np.allclose(features, [model.evidence([texts[i]])[0][0] for i in order])
    assert model.token_scores([b"", b" "])[0].tolist() == [] and model.token_scores([])[0].tolist() == []


@pytest.mark.parametrize("classes", [0, 1, 2, 4, 5, 12])
def test_codewords_differ(classes):
    code = codewords(classes)
    assert len(code) == classes and len({tuple(c) for c in code.tolist()}) == max(classes, 0) or classes < 2
    if 3 <= classes <= 5:
        assert min((code[i] != code[j]).sum() for i in range(classes) for j in range(i)) > code.shape[1] / 2
