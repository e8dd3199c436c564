"""The operators on the shared test tables, with SQL statements where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch.llm.common import crc_remainder, table, tokenizer_path
from labwatch.llm.embedding_dedup import near_duplicates
from labwatch.llm.hmm import score_texts
from labwatch.llm.jaccard import jaccard_components
from labwatch.llm.language import fit_languages, identify_languages
from labwatch.llm.licenses import TEMPLATES, bigrams, normalised_words, scan_licenses, scan_passages
from labwatch.llm.merkle import folded, leaf_digest, manifest, proof_digest
from labwatch.llm.mixing import mix_sources
from labwatch.llm.packing import pack, tokenize_pieces
from labwatch.llm.spelling import spelling_variants, vocabulary
from labwatch.llm.suffix_dedup import removal_digests
from labwatch.llm.token_files import read_segments, write_segments
from labwatch.llm.topk import top_k
from labwatch.llm.toxicity import fit_toxicity, score_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_language_id")
def language_id(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = crc_remainder("doc_id", 4) == 2
    model = fit_languages(docs.where(~held_out))
    found = identify_languages(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


@query(
    "op2_mixing",
    """
    WITH sizes AS (
      SELECT source, sum(coalesce(strlen(text), 0)) AS size FROM documents GROUP BY source
    ), totals AS (
      SELECT sum(size) AS all_bytes, sum(sqrt(size)) AS all_weight FROM sizes
    ), rates AS (
      SELECT source, all_bytes * sqrt(size) / all_weight / size AS rate FROM sizes, totals WHERE size > 0
    ), laws AS (
      SELECT source, list(total ORDER BY k) AS cdf FROM (
        SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS total
        FROM rates, range(0, 200) AS r(k))
      GROUP BY source
    ), draws AS (
      SELECT doc_id, source,
        CAST('0x' || substr(md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0 AS u
      FROM documents
    ), counted AS (
      SELECT doc_id, d.source, len(list_filter(cdf, lambda c: c <= u)) AS times
      FROM draws d JOIN laws l ON d.source IS NOT DISTINCT FROM l.source
    )
    SELECT doc_id, source, CAST(copy AS INTEGER) AS copy,
      CAST('0x' || substr(md5('43:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || copy), 1, 13) AS BIGINT) AS shuffle_key
    FROM (SELECT doc_id, source, unnest(range(1, times + 1)) AS copy FROM counted)
    """,
)
def mixing(spark, folder):
    mixed = mix_sources(table(spark, folder, "documents"), epochs=1.0, temperature=0.5, seed=42)
    return mixed.select("doc_id", "source", "copy", "shuffle_key")


def _license_sql() -> str:
    forms = ", ".join(
        "('{}', [{}])".format(name, ", ".join(f"'{g}'" for g in bigrams(normalised_words(body))))
        for name, body in TEMPLATES.items()
    )
    return f"""
    WITH templates(license, grams) AS (VALUES {forms}),
    lines AS (
      SELECT doc_id, CAST(n - 1 AS INTEGER) AS unit_no,
        string_split(trim(regexp_replace(lower(parts[n]), '[^a-z0-9]+', ' ', 'g')), ' ') AS words
      FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS n
            FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
    ), sets AS (
      SELECT doc_id, unit_no,
        list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS pairs
      FROM lines WHERE len(words) > 1
    ), scored AS (
      SELECT doc_id, unit_no, license, 2.0::DOUBLE * len(list_intersect(pairs, grams)) / (len(pairs) + len(grams)) AS dice
      FROM sets, templates
    )
    SELECT doc_id, unit_no, min_by(license, (-dice, license)) AS license, max(dice) AS dice
    FROM scored WHERE dice >= 0.8 GROUP BY doc_id, unit_no
    """


@query("op8_license_scan", _license_sql())
def license_scan(spark, folder):
    docs = table(spark, folder, "documents")
    # The SQL has the lines; where notices and licence texts go over lines or stand within one, there are rows beyond it.
    return scan_licenses(docs, threshold=0.8, unit="line").unionByName(scan_passages(docs, threshold=0.8))


@query(
    "op3_exact_topk",
    """
    WITH vectors AS (
      SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS q
      FROM embeddings
      WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    ), scored AS (
      SELECT a.n, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM vectors a JOIN vectors b ON a.n <> b.n WHERE a.vec_id % 20 = 0
    ), ranked AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """,
)
def exact_topk(spark, folder):
    return top_k(table(spark, folder, "embeddings"), k=20, query_divisor=20, scale=64.0)


@query("op4_hmm_lm")
def hmm_lm(spark, folder):
    docs = table(spark, folder, "documents")
    return score_texts(docs, crc_remainder("doc_id", 7) == 2)


@query("op5_embedding_dedup")
def embedding_dedup(spark, folder):
    return near_duplicates(table(spark, folder, "embeddings"), threshold=0.98, trees=3)


_JACCARD_SQL = """
    WITH RECURSIVE words AS (
      SELECT doc_id, list_filter(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
        lambda w: w <> '') AS w
      FROM documents
    ), sets AS (
      SELECT doc_id, CASE
        WHEN w IS NULL OR len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
        END AS s
      FROM words
    ), grams AS (
      SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
    ), shared AS (
      SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS n_both
      FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id AND a.n * 100 >= b.n * 90 AND b.n * 100 >= a.n * 90
      GROUP BY a.doc_id, b.doc_id
    ), links AS (
      SELECT a, b FROM shared WHERE 100 * n_both >= 90 * (na + nb - n_both)
    ), reached(start, doc_id) AS (
      SELECT doc_id, doc_id FROM documents
      UNION
      SELECT r.start, l.b FROM reached r JOIN links l ON r.doc_id = l.a
    )
    SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.doc_id) AS component_id
    FROM sets s JOIN reached r ON r.start = s.doc_id GROUP BY s.doc_id, s.s
"""


@query("op6_jaccard_join", _JACCARD_SQL)
def jaccard_join(spark, folder):
    found = jaccard_components(table(spark, folder, "documents"), size=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


@query("op7_packing")
def packing(spark, folder):
    pieces = tokenize_pieces(table(spark, folder, "documents"), tokenizer_path(), capacity=4096, end_id=1)
    digests = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(digests, capacity=4096).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op9_suffix_dedup")
def suffix_dedup(spark, folder):
    return removal_digests(table(spark, folder, "documents"), length=400, words=51)


@query("op10_toxicity")
def toxicity(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = fit_toxicity(docs, labels.where(crc_remainder("doc_id", 5) != 0))
    scored = score_toxicity(docs, model)
    return scored.select(
        "doc_id",
        (crc_remainder("doc_id", 5) == 0).alias("held_out"),
        "score",
        "predicted",
        F.size("segments").alias("n_segments"),
    )


# crc32 of the UTF-8 bytes of ``text``, code points up to U+00FF, by the table that ``steps`` makes.
_CRC_STEPS = """
    steps AS (
      SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) ORDER BY b) AS step
      FROM (SELECT unnest(range(0, 256)) AS b)
    )
"""


def _crc_sql(text: str) -> str:
    return f"""
      xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
        list_transform(string_split({text}, ''), lambda s: unicode(s)::BIGINT),
        lambda u: CASE WHEN u < 128 THEN [u] ELSE [192 | (u >> 6), 128 | (u & 63)] END))),
        lambda c, b: xor(c >> 8, step[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)
    """


_SPELLING_SQL = f"""
    WITH RECURSIVE {_CRC_STEPS}, runs AS (
      SELECT doc_id, run, count(*) AS times FROM (
        SELECT doc_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents)
      GROUP BY doc_id, run
    ), hashed AS (
      SELECT run, times, {_crc_sql("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h
      FROM runs, steps WHERE length(run) >= 5
    ), words AS (
      SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
        SELECT times, CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
          ELSE run END AS word FROM hashed)
      WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
    ), cut AS (
      SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
      FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
    ), near AS (
      SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
      UNION
      SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
      UNION
      SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word
    ), best AS (
      SELECT word, CAST(count(*) AS BIGINT) AS n_near, max(n) AS best_n, min_by(other, (-n, encode(other))) AS best
      FROM (SELECT DISTINCT word, other, n FROM near) GROUP BY word
    ), formed AS (
      SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best END AS form,
        CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n
      FROM words w LEFT JOIN best b ON w.word = b.word
    ), chain(word, last) AS (
      SELECT word, word FROM formed
      UNION ALL
      SELECT c.word, f.form FROM chain c JOIN formed f ON c.last = f.word WHERE f.form IS NOT NULL
    ), roots AS (
      SELECT c.word, c.last AS root FROM chain c JOIN formed f ON c.last = f.word WHERE f.form IS NULL
    )
    SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN roots r ON f.word = r.word
"""


@query("op11_spelling_variants", _SPELLING_SQL)
def spelling(spark, folder):
    words = vocabulary(table(spark, folder, "documents"), least=3, damage=97, shortest=5)
    return spelling_variants(words, ratio=2, shortest=5).select("word", "form", "root", "n", "n_near", "form_n")


@query("op12_token_file")
def token_file(spark, folder):
    docs = table(spark, folder, "documents")
    segments = write_segments(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0)
    return read_segments(segments).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _field_sql(field: str) -> str:
    return f"coalesce(strlen({field}::VARCHAR)::VARCHAR || ':' || {field}::VARCHAR, '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(map(_field_sql, ("doc_id", "source", "lang", "n_chars", text))) + ")"


# Nodes of a tree by level: ``g`` its group, ``p`` the place; groups of one node are finished.
_MERKLE_SQL = f"""
    WITH RECURSIVE {_CRC_STEPS}, leaves AS (
      SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
        CASE WHEN {_crc_sql("coalesce(doc_id::VARCHAR, '')")} % 2 = 0
          THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS found
      FROM documents, steps
    ), placed AS (
      SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
        dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g
      FROM leaves
    ), nodes(g, level, p, node, size) AS (
      SELECT g, 0, p, leaf, count(*) OVER (PARTITION BY g) FROM placed
      UNION ALL
      SELECT g, level + 1, p // 3, sha256(string_agg(node, '' ORDER BY p)), (any_value(size) + 2) // 3
      FROM nodes WHERE size > 1 GROUP BY g, level, p // 3
    ), subroots AS (
      SELECT g, node AS subroot FROM nodes WHERE size = 1
    ), tops(level, p, node, size) AS (
      SELECT 0, g, subroot, count(*) OVER () FROM subroots
      UNION ALL
      SELECT level + 1, p // 3, sha256(string_agg(node, '' ORDER BY p)), (any_value(size) + 2) // 3
      FROM tops WHERE size > 1 GROUP BY level, p // 3
    ), root AS (
      SELECT node AS root FROM tops WHERE size = 1
    ), sides AS (
      SELECT a.g, a.level, a.p, coalesce(string_agg(b.node, '' ORDER BY b.p) FILTER (b.p < a.p), '') AS l,
        coalesce(string_agg(b.node, '' ORDER BY b.p) FILTER (b.p > a.p), '') AS r
      FROM nodes a JOIN nodes b ON a.g = b.g AND a.level = b.level AND a.p // 3 = b.p // 3
      WHERE a.size > 1 GROUP BY a.g, a.level, a.p
    ), top_sides AS (
      SELECT a.level, a.p, coalesce(string_agg(b.node, '' ORDER BY b.p) FILTER (b.p < a.p), '') AS l,
        coalesce(string_agg(b.node, '' ORDER BY b.p) FILTER (b.p > a.p), '') AS r
      FROM tops a JOIN tops b ON a.level = b.level AND a.p // 3 = b.p // 3
      WHERE a.size > 1 GROUP BY a.level, a.p
    ), inner_steps AS (
      SELECT d.g, d.p, list({{'l': s.l, 'r': s.r}} ORDER BY s.level) AS steps
      FROM (SELECT g, p, unnest(range(0, 30)) AS level FROM placed) d
      JOIN sides s ON d.g = s.g AND d.level = s.level AND s.p = d.p // CAST(3 ** d.level AS BIGINT)
      GROUP BY d.g, d.p
    ), outer_steps AS (
      SELECT d.g, list({{'l': s.l, 'r': s.r}} ORDER BY s.level) AS steps
      FROM (SELECT g, unnest(range(0, 30)) AS level FROM subroots) d
      JOIN top_sides s ON d.level = s.level AND s.p = d.g // CAST(3 ** d.level AS BIGINT)
      GROUP BY d.g
    ), whole AS (
      SELECT d.doc_id, d.leaf, d.found, t.subroot, root.root,
        list_concat(coalesce(i.steps, []), coalesce(o.steps, [])) AS steps
      FROM placed d JOIN subroots t ON d.g = t.g, root
      LEFT JOIN inner_steps i ON i.g = d.g AND i.p = d.p LEFT JOIN outer_steps o ON o.g = d.g
    ), walked AS (
      SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_transform(steps, lambda s: s.l || s.r), 'string_agg', '')) AS proof,
        list_reduce(list_prepend({{'l': found, 'r': ''}}, steps),
          lambda n, s: {{'l': sha256(s.l || n.l || s.r), 'r': ''}}).l AS folded_root,
        steps
      FROM whole
    )
    SELECT doc_id, leaf, subroot, root, CASE WHEN len(steps) = 0 THEN sha256('') ELSE proof END AS proof_sha256,
      folded_root, folded_root = root AS verified
    FROM walked
"""


@query("op13_merkle_manifest", _MERKLE_SQL)
def merkle_manifest(spark, folder):
    docs = table(spark, folder, "documents")
    fields = ("doc_id", "source", "lang", "n_chars")
    tampered = crc_remainder("doc_id", 2) == 0
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaves = docs.select(
        "doc_id", "source", leaf_digest(*fields, "text").alias("leaf"), leaf_digest(*fields, text).alias("found")
    )
    whole = manifest(leaves, "source", "doc_id", "leaf", carry=("doc_id", "found"))
    root = folded("found").alias("folded_root")
    out = whole.select("doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), root)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
