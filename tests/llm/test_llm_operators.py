"""Operators on small fixtures with nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labwatch.llm.common import crc_remainder, tokenizer_path
from labwatch.llm.embedding_dedup import near_duplicates
from labwatch.llm.hmm import score_texts
from labwatch.llm.jaccard import jaccard_components, one_of_each
from labwatch.llm.language import fit_languages, identify_languages
from labwatch.llm.licenses import BODIES, bigrams, normalised_words, scan_licenses, scan_passages
from labwatch.llm.mixing import mix_sources
from labwatch.llm.packing import best_fit_decreasing, pack, tokenize_pieces
from labwatch.llm.stages import cut_repeated
from labwatch.llm.suffix_dedup import BLOCK, cut_repeats, removal_digests
from labwatch.llm.topk import top_k
from labwatch.llm.toxicity import fit_toxicity, score_toxicity

WORDS = [f"w{i}" for i in range(400)]


def prose(seed, words=120):
    return " ".join(np.random.default_rng(seed).choice(WORDS, words))


def changed(text, *at):
    words = text.split(" ")
    for i in at:
        words[i] = f"new{i}"
    return " ".join(words)


ODD_ROWS = [(1, None), (2, ""), (3, " \t\n"), (None, "few words"), (None, None), (4, "x"), (4, "x")]


def test_languages(spark, documents):
    syllables = {"aa": ["ka", "lo", "mi"], "bb": ["str", "ung", "ach"], "cc": ["é", "où", "ça"]}
    random = np.random.default_rng(1)
    text = lambda lang, n: " ".join("".join(random.choice(syllables[lang], 3)) for _ in range(n))
    rows = [(i, text(lang, 20), lang) for i, lang in enumerate([*syllables] * 30, 10)]
    docs = documents(*rows, (900, text("aa", 3000), None), (901, "12 !?"), (902, None, "aa"), *ODD_ROWS)
    found = identify_languages(docs, fit_languages(docs)).collect()
    assert len(found) == len(rows) + 3 + len(ODD_ROWS)
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == lang for i, _, lang in rows)
    assert by_id[900].lang_pred == "aa" and 0.5 < by_id[900].score <= 1
    for i in (901, 902, 1, 2, 3):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].ambiguous) == ("und", 0.0, True)
    one = docs.where("lang = 'aa' or lang is null")
    assert {r.lang_pred for r in identify_languages(one, fit_languages(one)).collect()} == {"aa", "und"}
    none = docs.limit(0)
    assert identify_languages(none, fit_languages(none)).count() == 0
    assert {r.lang_pred for r in identify_languages(docs, fit_languages(none)).collect()} == {"und"}


def test_mixing(spark, documents):
    rows = [(i, "x" * 100, None, "big" if i < 1500 else "small") for i in range(2000)]
    docs = documents(*rows, (5000, None, None, "void"), (5001, "y" * 50, None, None), extra=False)
    targets = spark.createDataFrame([("big", 1.0), ("small", 3.0)], "source string, weight double")
    mixed = mix_sources(docs.withColumn("copy", F.lit("mine")), targets, epochs=2.0)
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert set(counts) == {"big", "small"}
    total = 200_050 * 2 / 100
    assert abs(counts["big"] - total / 4) < 150 and abs(counts["small"] - total * 3 / 4) < 250
    keys = [r.shuffle_key for r in mixed.select("shuffle_key").collect()]
    assert keys == sorted(keys)
    per_doc = mixed.groupBy("doc_id").agg(F.max("copy").alias("last"), F.count("*").alias("n")).where("last <> n")
    assert per_doc.isEmpty()
    again = mix_sources(docs.repartition(7), targets, epochs=2.0)
    assert again.select("doc_id", "copy").exceptAll(mixed.select("doc_id", "copy")).isEmpty()
    by_size = mix_sources(documents(*ODD_ROWS, *rows[:50], extra=False))
    assert by_size.where("source is null").count() > 0
    assert mix_sources(docs.limit(0)).count() == 0


def test_top_k(spark):
    random = np.random.default_rng(3)
    rows = [(i, [float(x) for x in random.normal(size=5)]) for i in range(200)]
    rows += [(300 + i, rows[40][1]) for i in range(60)]
    bad = [(400, None), (None, [1.0] * 5), (401, [1.0, None, 2.0]), (402, [float("nan")] * 5), (403, [float("inf"), 1.0]), (420, [2.0])]
    # Rows of equal key: the same vector, and other ones, as candidates and as queries.
    rows += [rows[7], (8, rows[11][1]), (40, rows[3][1]), (40, rows[3][1]), (60, [9.0] * 5)]
    df = spark.createDataFrame([*rows, *bad], "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    usable = [(i, np.floor(64 * np.pad(np.array(v), (0, 5 - len(v))))) for i, v in [*rows, bad[-1]]]
    want = []
    for n, (q, v) in enumerate(usable):
        if q % 20 == 0:
            best = sorted((-int(v @ w), i) for m, (i, w) in enumerate(usable) if m != n)[:6]
            want += [(q, place, i, -s) for place, (s, i) in enumerate(best, 1)]
    for settings in (dict(shard_rows=50), dict(shard_rows=20, queries_at_once=5), {}):
        got = [tuple(r) for r in top_k(df, k=6, block_rows=16, **settings).collect()]
        assert sorted(got) == sorted(want)
    assert top_k(df.limit(0)).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in top_k(few).collect()] == [(0, 1, 1, 4096)]


def test_language_model(spark, documents):
    docs = documents(*[(i, prose(i, 60)) for i in range(80)], (500, prose(1, 4000)), (501, "Ünseen " * 3), *ODD_ROWS)
    held = crc_remainder("doc_id", 7) == 2
    got = score_texts(docs, held, listed=150, own=60, endings=8, states=3, rounds=2).collect()
    counts, ends = {}, 0
    for r in docs.select("doc_id", "text").collect():
        if zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 7 != 2:
            ends += 1
            for w in (r.text or "").encode().lower().split():
                counts[w] = counts.get(w, 0) + 1
    total, kinds = sum(counts.values()) + ends, len(counts) + 1
    expected = []
    for r in docs.select("doc_id", "text").collect():
        words = (r.text or "").encode().lower().split()
        out = zlib.crc32(str(r.doc_id if r.doc_id is not None else "").encode()) % 7 == 2
        base = sum(np.log10((counts.get(w, 0) + 1) / (total + kinds + 1)) for w in words) + np.log10((ends + 1) / (total + kinds + 1))
        expected.append((str(r.doc_id), out, len(words) + 1, sum(w in counts for w in words) + 1, total, round(base, 6)))
    rows = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(rows) == sorted(expected)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got) * 1.2
    nothing = score_texts(docs, crc_remainder("doc_id", 1) == 0, listed=150, own=60, endings=8, states=2).collect()
    assert {r.n_known for r in nothing} == {0} and all(np.isfinite(r.score) for r in nothing)
    assert score_texts(docs.limit(0), held).count() == 0


def test_embedding_duplicates(spark):
    random = np.random.default_rng(5)
    centres = random.normal(size=(40, 16))
    rows = []
    for i in range(900):
        rows.append((i, (centres[i % 40] + random.normal(size=16) * (0.03 if i % 3 else 0.2)).tolist(), i % 2))
    rows += [(1000 + i, rows[0][1], 0) for i in range(30)] + [(1100, [2 * x for x in rows[0][1]], 0)]
    odd = [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, [None] * 16, 0), (2004, rows[0][1], None), (2005, [1.0, 0.0], 0), (2006, [1.0, 0.01], 0), (None, [5.0, 5.0], 1), (1000, rows[0][1], 0)]
    df = spark.createDataFrame([*rows, *odd], "vec_id long, embedding array<double>, label int").withColumn("node", F.lit(1))
    got = near_duplicates(df, trees=4, leaf_rows=60, block_rows=20).collect()
    full = [(i, v, l) for i, v, l in [*rows, *odd[5:]]]
    n, root = [0] * len(full), list(range(len(full)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a, la) in enumerate(full):
        for j, (_, b, lb) in enumerate(full[:i]):
            if la == lb and len(a) == len(b) and np.dot(a, b) / np.linalg.norm(a) / np.linalg.norm(b) >= 0.98:
                n[i] += 1
                n[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (key, *_) in enumerate(full):
        least.setdefault(find(i), []).append(key)
    name = {r: min((k for k in keys if k is not None), default=None) for r, keys in least.items()}
    want = sorted((str(k), n[i], str(name[find(i)])) for i, (k, *_) in enumerate(full))
    have = [(str(r.vec_id), r.n_links, str(r.component_id)) for r in got if r.vec_id is None or r.vec_id not in range(2000, 2005)]
    assert sum(h[1] for h in have) >= 0.97 * sum(w[1] for w in want)
    wrong = [(w, h) for w, h in zip(want, sorted(have)) if w != h]
    assert len(wrong) <= 0.03 * len(want) and all(h[1] <= w[1] for w, h in wrong)
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got if r.vec_id in range(2000, 2005)) == [(i, 0, i, True) for i in range(2000, 2005)]
    assert near_duplicates(df.limit(0)).count() == 0


def jaccard_by_hand(rows, size, num, den):
    sets = []
    for _, text in rows:
        words = (text or "").encode().lower().split()
        runs = [tuple(words)] if len(words) < size else [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
        sets.append(set(runs) if words else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and den * len(a & b) >= num * len(a | b) and b:
                root[find(i)] = find(j)
    groups = {}
    for i, (key, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(key)
    name = {r: min((k for k in keys if k is not None), default=None) for r, keys in groups.items()}
    return sorted((str(k), len(sets[i]), str(name[find(i)])) for i, (k, _) in enumerate(rows))


@pytest.mark.parametrize("size, num", [(3, 90), (5, 80)])
def test_jaccard(spark, documents, size, num):
    rows = [(i, prose(i)) for i in range(30)]
    random = np.random.default_rng(6)
    for i in range(120):
        rows.append((100 + i, changed(prose(i % 6), *random.integers(0, 120, random.integers(0, 5)).tolist())))
    rows += [(300, prose(3, 5000)), (301, changed(prose(3, 5000), 17, 900)), (302, "A b C"), (303, "a B c"), (304, "a  b"), *ODD_ROWS, rows[2]]
    docs = documents(*rows)
    got = jaccard_components(docs, size, num, 100).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == jaccard_by_hand(rows, size, num, 100)
    kept = one_of_each(docs.select("doc_id", "text", "lang"), size, num, 100)
    by_hand = jaccard_by_hand(rows, size, num, 100)
    groups = {r.root for r in got if r.root is not None}
    assert kept.count() == len(groups) + sum(n == 0 for _, n, _ in by_hand) and kept.columns == ["doc_id", "text", "lang"]
    assert jaccard_components(docs.limit(0)).count() == 0 and one_of_each(docs.select("doc_id", "text").limit(0)).count() == 0


def test_long_passages_are_cut(spark, documents):
    """Passages of 51 to 60 words that stand in two texts go, shorter ones and repeated lines stay."""
    passages = {n: prose(900 + n, n).replace("w", "word") for n in range(40, 61) if n != 50}
    rows = []
    for n, passage in passages.items():
        for k in range(2):
            rows.append((n * 10 + k, f"{prose(n * 7 + k, 60)} start{n}{k} {passage} end{n}{k} {prose(n * 11 + k, 60)}"))
    rows += [(2000 + k, f"{prose(3000 + k, 30)}\nall rights are kept and so on\n{prose(4000 + k, 30)}") for k in range(9)]
    docs = documents(*rows, *ODD_ROWS)
    out = {r.doc_id: r.text for r in cut_repeated(spark, docs, "").collect()}
    for doc_id, text in rows:
        long_one = doc_id < 2000 and doc_id // 10 > 50
        assert (passages[doc_id // 10] in out[doc_id]) != long_one if doc_id < 2000 else out[doc_id] == text
        if doc_id < 2000:
            assert out[doc_id].startswith(text.split(" start")[0]) and out[doc_id].endswith(text.split(" end")[1].split(" ", 1)[1])


def test_packing(spark, documents):
    path = tokenizer_path()
    texts = [prose(i, int(n)) for i, n in enumerate(np.random.default_rng(7).integers(1, 200, 150))]
    texts += [
        "Don't STOP, it's 3.14! été ÉTÉ größe İstanbul <|endoftext|> <|ENDOFTEXT|> a b \x1c x́ J̌ ǰ naïve日本語 ...,", "word " * 9000
    ]
    docs = documents(*[(10 + i, t) for i, t in enumerate(texts)], *ODD_ROWS)
    pieces = tokenize_pieces(docs, path, capacity=512)
    tokenizer = Tokenizer.from_file(path)
    want = []
    for r in docs.select("doc_id", "text").collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), 512)):
            want.append((str(r.doc_id), n, at, len(ids[at : at + 512]), np.array(ids[at : at + 512], "<u4").tobytes()))
    got = [(str(r.doc_id), r.piece, r.start, r.length, bytes(r.ids)) for r in pieces.collect()]
    assert sorted(got) == sorted(want)
    narrow = pieces.drop("ids").withColumn("offset", F.lit("mine"))
    for rows_per_partition in (100_000, 40):
        packed = pack(narrow, 512, rows_per_partition).collect()
        assert len(packed) == len(want)
        bins = {}
        for r in packed:
            bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        for own in bins.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= 512
        assert len(bins) <= len(best_fit_decreasing(np.array([w[3] for w in want]), 512)[2]) + 3
    assert pack(narrow.limit(0), 512).count() == 0
    with pytest.raises(ValueError):
        pack(narrow, 100)


def test_licenses(spark, documents):
    rows = [(1, "Intro.\nReleased under the MIT license!\nEnd"), (2, "LICENSED  under CC BY-NC 4.0"), (3, "see the license"), (5, "licensed under the apache license version 2 point 0"), (6, "x " * 5000)]
    docs = documents(*rows, *ODD_ROWS)
    got = {(r.doc_id, r.unit_no, r.license) for r in scan_licenses(docs).collect()}
    assert got == {(1, 1, "mit"), (2, 0, "cc-by-nc-4.0"), (5, 0, "apache-2.0")}
    low = scan_licenses(docs, threshold=0.6).where("doc_id = 5").collect()
    a, b = set(bigrams(normalised_words(rows[3][1]))), set(bigrams(normalised_words("Licensed under the Apache License, Version 2.0.")))
    assert [(r.license, round(r.dice, 9)) for r in low] == [("apache-2.0", round(2 * len(a & b) / (len(a) + len(b)), 9))]
    whole = scan_licenses(documents((1, "Released\nunder the MIT License.")), unit="text").collect()
    assert [(r.license, r.dice) for r in whole] == [("mit", 1.0)]
    tie = scan_licenses(documents((1, "a b c")), {"zz": "a b c", "aa": "A, b c"}).collect()
    assert [r.license for r in tie] == ["aa"]
    assert scan_licenses(docs, {}).count() == 0 and scan_licenses(docs.limit(0)).count() == 0


def test_license_passages(spark, documents):
    prose_ = "Some words before.\nAnd a second line"
    rows = [(10 + i, f"{prose_}\n\n{body.strip()}\nThe end of it all") for i, body in enumerate(BODIES.values())]
    rows += [
        (30, "Intro.\nReleased under\nthe MIT License.\nEnd"),
        (31, "x\nWe wrote all of this ourselves. Released under the MIT License."),
        (32, "Intro.\nReleased under the MIT License.\nEnd"),
        (33, "see the license of the software"),
        (34, " ".join(BODIES["mit"].split())),
        (35, "Released under the MIT\n\nLicense. Licensed under CC\nBY 4.0.\n" * 2),
        *ODD_ROWS,
    ]
    got = sorted((r.doc_id, r.unit_no, r.license, r.dice) for r in scan_passages(documents(*rows)).collect())
    want = [(10 + i, 3, name, 1.0) for i, name in enumerate(BODIES)]
    want += [(30, 1, "mit", 1.0), (31, 1, "mit", 1.0), (34, 0, "mit", 1.0)]
    want += [(35, n, name, 1.0) for n, name in ((0, "mit"), (2, "cc-by-4.0"), (4, "mit"), (6, "cc-by-4.0"))]
    assert got == sorted(want)
    assert scan_passages(documents(*rows), {}, {}).count() == 0


def removal_by_hand(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    places = {}
    for i, text in enumerate(texts):
        for s in range(len(text) - length + 1):
            places.setdefault(text[s : s + length], []).append((i, s))
    gone = [np.zeros(len(t), bool) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for i, s in found:
                gone[i][s : s + length] = True
    out = []
    for (key, _), text, mask in zip(rows, texts, gone):
        kept = bytes(b for b, g in zip(text, mask) if not g)
        spans = int((np.diff(np.concatenate(([0], mask.astype(int)))) == 1).sum())
        out.append((str(key), len(text), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats(spark, documents, monkeypatch):
    passage, other = prose(50, 40), "é" * 90
    rows = [(40 + i, f"{prose(100 + i, 30)} {passage[: 60 + i * 7]} {prose(200 + i, 30)}") for i in range(15)]
    rows += [(20, other), (21, other + "x" + "ab" * 100), (22, "z" * 300), (23, prose(1, 9000) + passage), (24, prose(60)), (25, prose(60)), (26, "ab" * 33), *ODD_ROWS]
    docs = documents(*rows)
    want = removal_by_hand(rows, 100)
    shape = lambda df: [(str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()]
    assert sorted(shape(removal_digests(docs, 100))) == sorted(want)
    # Keys with many kinds of cells have their windows counted instead.
    monkeypatch.setattr("labwatch.llm.suffix_dedup.KEY_ROWS", 3)
    assert sorted(shape(removal_digests(docs, 100))) == sorted(want)
    cut = cut_repeats(docs.select("doc_id", "text", "lang", "n_chars"), 100, chars="n_chars").collect()
    by_id = {str(w[0]): w for w in want}
    for r in cut:
        if r.doc_id not in (None, 4, 20, 21):
            assert hashlib.sha256((r.text or "").encode()).hexdigest() == by_id[str(r.doc_id)][4]
            assert r.n_chars is None or r.n_chars == len(r.text)
    assert len(cut) == len(rows) and sum(r.text is None for r in cut) == 2
    assert removal_digests(docs.limit(0), 100).count() == 0 and cut_repeats(docs.select("doc_id", "text").limit(0)).count() == 0


def passages_by_hand(rows, words):
    texts = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for _, t in rows]
    places = {}
    for i, own in enumerate(texts):
        for s in range(len(own) - words + 1):
            places.setdefault(tuple(own[s : s + words]), []).append((i, s))
    held = [np.zeros(len(own), bool) for own in texts]
    for found in places.values():
        if len(found) > 1:
            for i, s in found:
                held[i][s : s + words] = True
    return [(str(key), int((np.diff(np.concatenate(([0], m.astype(int)))) == 1).sum())) for (key, _), m in zip(rows, held)]


def test_repeated_passages_are_counted(spark, documents):
    """Passages of over 50 words are counted though they have less than 400 bytes, which are not removed."""
    passages = {n: prose(700 + n, n) for n in range(48, 56)}
    rows = []
    for n, passage in passages.items():
        rows += [(n * 10 + k, f"{prose(n * 7 + k, 80)} start{n}{k} {passage} end{n}{k} {prose(n * 11 + k, 80)}") for k in range(2)]
        rows.append((n * 10 + 2, f"a{n}\n{passage}\t b{n} {passage.replace(' ', '  ')}"))
    rows += [(20, "w" * 300 + "\x0b" + prose(5, 70)), (21, "w" * 299 + "v " + prose(5, 70)), (22, prose(6, 51)), (23, prose(6, 51)), (24, prose(6, 51) + "\n"), *ODD_ROWS, (25, prose(7, 50)), (26, prose(7, 50))]
    docs = documents(*rows)
    got = {str(r.doc_id): r for r in removal_digests(docs, 400, words=51).collect() if r.doc_id is not None}
    for n, passage in passages.items():
        assert len(passage) < 400
        for k in range(2):
            assert got[str(n * 10 + k)].n_removed == 0 and got[str(n * 10 + k)].n_passages == (n > 50)
    for words in (51, 6, 2):
        out = removal_digests(docs, 400, words=words).collect()
        assert sorted((str(r.doc_id), r.n_passages) for r in out) == sorted(passages_by_hand(rows, words))
    shape = lambda df: sorted(map(str, df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()))
    assert shape(removal_digests(docs, 100, words=51)) == shape(removal_digests(docs, 100))
    assert removal_digests(docs.limit(0), 400, words=51).count() == 0


def test_repeats_in_texts_longer_than_a_block(spark, documents):
    # Nothing repeats in the long text but the passage across its first block's end, which another text holds too.
    text = np.random.default_rng(3).integers(97, 123, 2 * BLOCK + 9000).astype(np.uint8).tobytes().decode()
    rows = [(1, text), (2, text[BLOCK - 300 : BLOCK + 400])]
    got = {r.doc_id: (r.n_removed, r.n_spans, r.kept_sha256) for r in removal_digests(documents(*rows), 400).collect()}
    kept = text[: BLOCK - 300] + text[BLOCK + 400 :]
    assert got == {1: (700, 1, hashlib.sha256(kept.encode()).hexdigest()), 2: (700, 1, hashlib.sha256(b"").hexdigest())}


def test_toxicity(spark, documents):
    random = np.random.default_rng(8)
    bad = ["vile", "scum", "trashy", "idiotic"]
    rows, marks = [], []
    for i in range(600):
        words = random.choice(WORDS, 40).tolist()
        if i % 5 == 0:
            words[10:13] = random.choice(bad, 3).tolist()
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 5 == 0)))
    docs = documents(*rows, (5000, " ".join([*WORDS * 20, "vile", "scum", "vile", *WORDS * 20])), (5001, prose(9, 8000)), *ODD_ROWS)
    labels = spark.createDataFrame([*marks, (700, 1), (None, 1), (3, None), (5, 0)], "doc_id long, toxic int").withColumn("score", F.lit(1))
    model = fit_toxicity(docs, labels)
    got = {r.doc_id: r for r in score_toxicity(docs, model).collect()}
    assert sum(got[i].predicted == t for i, t in marks) >= 0.99 * len(marks)
    assert got[5000].predicted == 1 and got[5001].predicted == 0
    words = rows[0][1].split(" ")
    assert any(s["first"] <= 10 and s["end"] >= 13 for s in got[0].segments), (words[8:15], got[0].segments)
    assert {got[i].predicted for i in (1, 2, 3)} == {0} and all(0 <= r.score <= 1 for r in got.values())
    nothing = fit_toxicity(docs, labels.limit(0))
    assert {r.predicted for r in score_toxicity(docs, nothing).collect()} == {0}
    assert score_toxicity(docs.limit(0), model).count() == 0
