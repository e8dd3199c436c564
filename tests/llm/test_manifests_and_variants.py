"""Spelling variants, token files and Merkle manifests against brute force, with the odd rows of other operators."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labwatch.llm.common import tokenizer_path
from labwatch.llm.merkle import Witnesses, folded, leaf_digest, manifest, node_hash, proof_digest
from labwatch.llm.queries import QUERIES
from labwatch.llm.spelling import PositionIndex, members, spelled, spelling_variants, vocabulary
from labwatch.llm.token_files import ByteLevelIds, Codes, Segment, read_segments, write_segments

ODD_ROWS = [(1, None), (2, ""), (3, " \t\n"), (None, "few words"), (None, None), (4, "x"), (4, "x")]
LARGER = "/root/testdata/sf0.01"


def near_by_hand(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants_by_hand(counts):
    out = {}
    for word, n in counts.items():
        near = sorted((-m, other) for other, m in counts.items() if near_by_hand(word, other))
        out[word] = (len(near), near[0][1] if near and -near[0][0] >= 2 * n else None)
    rows = set()
    for word, n in counts.items():
        number, form = out[word]
        root = word
        while out[root][1] is not None:
            root = out[root][1]
        rows.add((word, n, number, form, counts[form] if form else None, root))
    return rows


def random_words(seed, size, letters, shortest=5, longest=9):
    random = np.random.default_rng(seed)
    return ["".join(random.choice(list(letters), random.integers(shortest, longest + 1))) for _ in range(size)]


def test_position_index_finds_what_differs_by_one():
    words = sorted(set(random_words(1, 400, "abé", 3, 6)))
    index = PositionIndex(words)
    for word in [*words, "", "a", "abababababababab", "zzzz"]:
        assert [words[i] for i in members(index.near(word))][::-1] in (
            [w for w in words if near_by_hand(word, w)],
            [w for w in words if near_by_hand(word, w)][::-1],
        )
    assert PositionIndex([]).near("word") == 0


def test_spelled_words():
    found = spelled("Große grosse GROSSE ab12cdefg ÀÉÎÕÜ x×words÷more naïve".encode(), "7", None)
    assert found == Counter({"große": 1, "grosse": 2, "cdefg": 1, "ÀÉÎÕÜ": 1, "words": 0, "naïve": 1}) + Counter({"x×words÷more": 1})
    run = next(r for r in random_words(2, 5000, "abcdef", 6) if zlib.crc32(f"7:{r}".encode()) % 97 == 0)
    at = zlib.crc32(f"7:{run}".encode()) % len(run)
    assert spelled(f"{run} {run.upper()}".encode(), "7") == {run[:at] + run[at + 1 :]: 2}


@pytest.mark.parametrize("block_words", [4096, 7])
def test_variants_by_hand(spark, block_words):
    random = np.random.default_rng(3)
    words = set(random_words(4, 500, "abß")) | set(random_words(5, 100, "aé", 12, 14))
    words |= {"shared" + w for w in random_words(6, 120, "ab", 5, 7)} | {w + "shared" for w in random_words(7, 120, "ab", 5, 7)}
    counts = {w: int(3 * 2 ** random.integers(0, 9)) for w in sorted(words)}
    df = spark.createDataFrame([*counts.items(), (None, 5)], "word string, n long").withColumn("k", F.lit("mine"))
    got = [tuple(r) for r in spelling_variants(df, block_words=block_words).collect()]
    assert len(got) == len(counts) and set(got) == variants_by_hand(counts)
    assert any(r[3] and r[5] != r[3] for r in got)


def test_vocabulary_by_hand(spark, documents):
    texts = [" ".join(random_words(s, 300, "abcdé")) for s in range(5)]
    docs = documents(*enumerate(texts, 10), (50, "long " + "abcde " * 50_000), *ODD_ROWS)
    want = Counter()
    for i, text in [*enumerate(texts, 10), (50, "abcde " * 50_000)]:
        for run, n in Counter(text.split()).items():
            h = zlib.crc32(f"{i}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += n
    got = {r.word: r.n for r in vocabulary(docs).collect()}
    assert got == {w: n for w, n in want.items() if n >= 3 and len(w) >= 5}
    assert spelling_variants(vocabulary(docs.limit(0))).count() == 0


def test_codes_are_directly_addressable():
    random = np.random.default_rng(0)
    for size in (0, 1, 7, 511, 512, 513, 5000):
        ids = random.choice([0, 5, 255, 256, 300, 50256, 70000, 2**24 + 5, 2**32 - 1], size).astype(np.uint32)
        codes = Codes.from_bytes(b"xx" + Codes.of(ids).to_bytes(), 2)
        assert [codes[i] for i in range(len(codes))] == ids.tolist()
        for begin, end in np.sort(random.integers(0, size + 1, (40, 2)), axis=1).tolist():
            assert (codes.slice(begin, end) == ids[begin:end]).all()
        with pytest.raises(IndexError):
            codes[size]
    with pytest.raises(ValueError):
        Segment.from_bytes(b"something else")


def test_parts_are_encoded_as_the_whole_tokenizer_does():
    path = tokenizer_path("byte_bpe_50k.json")
    tokenizer, memory = Tokenizer.from_file(path), ByteLevelIds(open(path, encoding="utf-8").read())
    assert memory.plain
    random = np.random.default_rng(1)
    letters = [*"ab Z'sstrevemlld 019\n\r\t\x0b\x0c\x1c\x85\xa0ªµºÀ×÷ÿ²½\xad.,-_\x00\x7f\x80", "<|endoftext|>", "世", "’", "é", "'ll", "  "]
    texts = ["".join(random.choice(letters, random.integers(0, 40))) for _ in range(4000)]
    for text, ids in zip(texts, memory.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_token_files_round_trip(spark, documents):
    rows = [(i * 7 % 101, " ".join(random_words(i, i, "abcdé"))) for i in range(101)]
    rows += [(500, "very long " * 60_000), *[(3, "hot")] * 40, *ODD_ROWS]
    docs = documents(*rows).repartition(5)
    segments = write_segments(docs, tokenizer_path("byte_bpe_50k.json"), segment_ids=300)
    assert segments.count() > 20
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    got = sorted(read_segments(segments).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k or 0))
    want = Counter((k, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (0,)) for k, t in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    one = segments.where("first_id <= 500 and last_id >= 500").select("data").collect()
    found = [Segment.from_bytes(bytes(r.data)) for r in one]
    segment = next(s for s in found if 500 in s.doc_ids)
    n = segment.doc_ids.tolist().index(500)
    whole = tokenizer.encode("very long " * 60_000, add_special_tokens=False).ids
    assert segment.codes[int(segment.starts[n]) + 70_001] == whole[70_001]
    empty = write_segments(docs.limit(0), tokenizer_path("byte_bpe_50k.json"))
    assert read_segments(empty).count() == 0


def test_token_file_query_on_a_whole_table(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", "text").collect()
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    start, want = 0, set()
    for doc_id, text in sorted(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        want.add((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert {tuple(r) for r in QUERIES["op12_token_file"](spark, LARGER).collect()} == want


def tree_by_hand(leaves):
    """Root of the leaves, and each leaf's siblings level by level."""
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for path, p in zip(paths, at):
            run = p // 3 * 3
            path.append((level[run:p], level[p + 1 : run + 3]))
        level = [node_hash(*level[i : i + 3]) for i in range(0, len(level), 3)]
        at = [p // 3 for p in at]
    return (level or [None])[0], paths


def test_witnesses_grow_by_appends():
    for size in range(1, 40):
        leaves = [f"{i:02d}" for i in range(size)]
        tree = Witnesses()
        for leaf in leaves:
            tree.append(leaf)
        root, paths = tree_by_hand(leaves)
        assert tree.close() == root
        assert tree.paths == [[("".join(a), "".join(b)) for a, b in path] for path in paths]


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_manifest_by_hand(spark, documents, levels):
    rows = [(i, f"text {i}\n", None, "hot" if i % 3 else f"é{i % 7}") for i in range(150)]
    rows += [(900, "lone", None, "alone"), (901, "y" * 200_000, "xx", None), *ODD_ROWS, (5, "t", None, ""), *[(7, "same", None, "hot")] * 5]
    docs = documents(*rows).repartition(6)
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    leaves = docs.withColumn("leaf", leaf_digest(*fields)).select("doc_id", "source", "leaf", "key", "root")
    got = manifest(leaves, "source", "doc_id", "leaf", carry=("doc_id",), levels=levels)
    got = got.select("*", proof_digest().alias("proof"), folded("leaf").alias("back")).collect()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    by_source = {}
    for row in rows:
        doc_id, text, lang, source = (*row, None, None)[:4]
        digest = hashlib.sha256("".join(map(field, (doc_id, source, lang, None, text))).encode()).hexdigest()
        by_source.setdefault(source, []).append((doc_id is not None, doc_id or 0, digest))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [tree_by_hand([leaf for _, _, leaf in sorted(by_source[s])]) for s in names]
    root, tops = tree_by_hand([t[0] for t in trees])
    want = Counter()
    for name, (subroot, paths), top in zip(names, trees, tops):
        for (known, doc_id, leaf), path in zip(sorted(by_source[name]), paths):
            siblings = "".join(s for a, b in path + top for s in [*a, *b])
            proof = hashlib.sha256(siblings.encode()).hexdigest()
            want[doc_id if known else None, leaf, subroot, root, proof] += 1
    assert Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof) for r in got) == want
    assert all(r.back == root for r in got)
    assert manifest(leaves.limit(0), "source", "doc_id", "leaf").count() == 0


def test_tampered_rows_do_not_verify(spark):
    rows = QUERIES["op13_merkle_manifest"](spark, LARGER)
    docs = spark.read.parquet(f"{LARGER}/documents.parquet").select("doc_id", F.contains("text", F.lit("\n")).alias("lines"))
    for r in rows.join(docs, "doc_id").collect():
        assert r.verified == (zlib.crc32(str(r.doc_id).encode()) % 2 == 1 or not r.lines)
