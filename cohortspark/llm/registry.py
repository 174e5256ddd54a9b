"""Queries of this folder over the given tables, and DuckDB counterparts where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from cohortspark.llm import (
    bpe,
    chat,
    ctw,
    decontaminate,
    embedding_join,
    hard_negatives,
    licenses,
    lines,
    packing,
    prefix_trie,
    quality,
    shingle_join,
    url_rules,
)
from cohortspark.llm.session import prepare
from cohortspark.sources.scratch import Scratch

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: Column | str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _op1(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, d, "documents", "doc_id", "text"), Scratch(spark))


def _op2(spark: SparkSession, d: str) -> DataFrame:
    embeddings = _table(spark, d, "embeddings", "vec_id", "embedding")
    return embedding_join.embedding_components(embeddings, Scratch(spark))


def _op3(spark: SparkSession, d: str) -> DataFrame:
    return url_rules.judge_urls(_table(spark, d, "pages", "page_id", "url"), Scratch(spark))


def _op4(spark: SparkSession, d: str) -> DataFrame:
    turns = _table(spark, d, "conversations", "conv_id", "turn", "role", "text")
    return chat.format_chats(turns, Scratch(spark))


def _op5(spark: SparkSession, d: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    documents = _table(spark, d, "documents", "doc_id", "text")
    return bpe.round_trip_digests(documents, path, public_tokenizers.PATTERN)


def _op6(spark: SparkSession, d: str) -> DataFrame:
    documents = _table(spark, d, "documents", "doc_id", "text")
    labels = _table(spark, d, "labels", "doc_id", "quality")
    judged = quality.judge_documents(documents, labels, Scratch(spark))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "anomaly")


def _op6_base(spark: SparkSession, d: str) -> DataFrame:
    return _op6(spark, d).select("doc_id", *quality.COUNTS, "base_failed")


def _op7(spark: SparkSession, d: str) -> DataFrame:
    documents = _table(spark, d, "documents", "doc_id", "text")
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(documents, path, Scratch(spark))


def _op8(spark: SparkSession, d: str) -> DataFrame:
    documents = _table(spark, d, "documents", "doc_id", "text")
    return shingle_join.jaccard_components(documents, Scratch(spark), words=3, percent=90)


def _op8_links(spark: SparkSession, d: str) -> DataFrame:
    documents = _table(spark, d, "documents", "doc_id", "text")
    return shingle_join.jaccard_links(documents, Scratch(spark), words=3, percent=90)


def _op9(spark: SparkSession, d: str) -> DataFrame:
    documents = _table(spark, d, "documents", "doc_id", "text")
    return ctw.score_documents(documents, Scratch(spark))


def _op9_base(spark: SparkSession, d: str) -> DataFrame:
    # Doubles summed in another order differ behind the tenth digit.
    base = F.round("base_score", 4).alias("base_score")
    columns = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")
    return _op9(spark, d).select(*columns, base)


def _op10(spark: SparkSession, d: str) -> DataFrame:
    documents = _table(spark, d, "documents", "doc_id", "text")
    kept = lines.drop_repeated_lines(documents, Scratch(spark), report=True)
    digest = F.sha2("text", 256).alias("kept_sha256")
    return kept.select("doc_id", "n_lines", "n_dropped", digest)


def _op11(spark: SparkSession, d: str) -> DataFrame:
    documents = _table(spark, d, "documents", "doc_id", "text")
    benchmark = _table(spark, d, "benchmark", "item_id", "text")
    found = decontaminate.find_benchmark(documents, benchmark, Scratch(spark))
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.last - s.first + 1)")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def _op12(spark: SparkSession, d: str) -> DataFrame:
    moved = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END").alias("label")
    asks = (F.col("vec_id") % 50 == 0).alias("asks")
    rows = _table(spark, d, "embeddings", "vec_id", moved, "embedding", asks)
    return hard_negatives.hard_negatives(rows, Scratch(spark))


def _op13(spark: SparkSession, d: str) -> DataFrame:
    conversations = _table(spark, d, "conversations", "conv_id", "turn", "role", "text")
    scratch = Scratch(spark)
    turns = prefix_trie.number_turns(conversations, scratch)
    rebuilt, conv_ids = prefix_trie.with_borrowed_openings(turns, scratch)
    return prefix_trie.prefix_trie(rebuilt, conv_ids, scratch)


def queries() -> dict[str, Query]:
    """One query per operator, over its whole table; op8 again with numbers of links, and those
    columns of op6 and op9 that SQL can express."""
    return {
        "op1_license_scan": _op1,
        "op2_embedding_dedup": _op2,
        "op3_url_filter": _op3,
        "op4_chat_format": _op4,
        "op5_byte_bpe": _op5,
        "op6_quality_rules": _op6,
        "op6_base": _op6_base,
        "op7_best_fit_packing": _op7,
        "op8_jaccard_join": _op8,
        "op8_jaccard_links": _op8_links,
        "op9_context_tree_score": _op9,
        "op9_base": _op9_base,
        "op10_line_dedup": _op10,
        "op11_decontamination": _op11,
        "op12_hard_negatives": _op12,
        "op13_prefix_trie": _op13,
        "pipeline": corpus_pipeline.run,
    }


_OP3_SQL = """
    WITH parts AS (
        SELECT page_id,
               CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest
        FROM pages),
    split AS (
        SELECT page_id,
               coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
               coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
        FROM parts),
    rules(verdict, rule_host, rule_path) AS (VALUES
        ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
        ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
    fits AS (
        SELECT page_id, host, path, rule_host || rule_path AS rule, verdict,
               row_number() OVER (PARTITION BY page_id
                   ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS place
        FROM split LEFT JOIN rules
            ON (host = rule_host OR suffix(host, '.' || rule_host))
           AND starts_with(path, rule_path))
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
    FROM fits WHERE place = 1"""

_OP4_SQL = """
    WITH whole AS (
        SELECT conv_id, count(*) AS n_turns,
               string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
                          ORDER BY turn, role, text) AS text
        FROM (SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text
              FROM conversations WHERE conv_id IS NOT NULL) GROUP BY conv_id),
    prefixes AS (
        SELECT a.conv_id, b.turn,
               string_agg('<|im_start|>' || a.role || chr(10) || a.text || '<|im_end|>' || chr(10),
                          '' ORDER BY a.turn, a.role, a.text) AS text
        FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn <= b.turn
        GROUP BY a.conv_id, b.turn),
    proper AS (
        SELECT DISTINCT p.text FROM prefixes p JOIN whole w
            ON p.conv_id = w.conv_id AND p.text <> w.text)
    SELECT min(conv_id) AS conv_id, any_value(n_turns) AS n_turns, count(*) AS n_copies, text
    FROM whole WHERE text NOT IN (SELECT text FROM proper) GROUP BY text"""


def _op1_sql() -> str:
    """Every phrase searched from every word, instead of from its rarest one."""
    kept = {
        p: [(w, i) for i, w in enumerate(p.split()) if w not in licenses.SKIPPED]
        for p in dict.fromkeys(
            [*licenses.BASE, *(p for t in licenses.TEMPLATES for p, _ in t.phrases)]
        )
    }
    name = {p: f"p{i}" for i, p in enumerate(kept)}
    vocabulary = sorted({w for words in kept.values() for w, _ in words})
    idf = ", ".join(
        f"ln((count(*) + 1) / (count(*) FILTER (list_contains(words, '{w}')) + 1)) + 1e-9 AS idf_{w}"
        for w in vocabulary
    )
    places = ", ".join(
        f"[i FOR i IN range(0, len(words) - {len(p.split()) - 1}) IF "
        + " AND ".join(f"words[i + {k + 1}] = '{w}'" for k, w in enumerate(p.split()))
        + f"] AS {name[p]}"
        for p in kept
    )

    def share(t: licenses.Template) -> str:
        if len(t.phrases) == 1:
            return f"CASE WHEN len({name[t.phrases[0][0]]}) > 0 THEN 1.0 ELSE 0.0 END"
        weight = {p: "(" + " + ".join(f"idf_{w}" for w, _ in kept[p]) + ")" for p, _ in t.phrases}
        total = "(" + " + ".join(weight.values()) + ")"
        around = []
        for p, o in t.phrases:
            parts = " + ".join(
                f"CASE WHEN len([u FOR u IN {name[q]} IF abs((u - {k}) - (s - {o}))"
                f" <= {licenses.SLACK}]) > 0 THEN {weight[q]} / {total} ELSE 0.0 END"
                for q, k in t.phrases
            )
            around.append(f"coalesce(list_max([{parts} FOR s IN {name[p]}]), 0.0)")
        return f"greatest({', '.join(around)})"

    shares = ", ".join(f"CAST({share(t)} AS DOUBLE)" for t in licenses.TEMPLATES)
    base = ", ".join(
        f"CASE WHEN len({name[p]}) > 0 THEN '{label}' END" for p, label in licenses.BASE.items()
    )
    whole = ", ".join(
        f"CASE WHEN shares[{i + 1}] > 1 - 1e-6 THEN '{t.label}' END"
        for i, t in enumerate(licenses.TEMPLATES)
    )
    at = " || ".join(name[p] for p in licenses.BASE)
    listed = "array_to_string(list_sort(list_distinct([x FOR x IN {} IF x IS NOT NULL])), ',')"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
        WITH cut AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), '{upper}', '{lower}'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents),
        idf AS (SELECT {idf} FROM cut),
        found AS (SELECT doc_id, len(words) AS n_words, {places} FROM cut),
        shared AS (
            SELECT *, {at} AS spots, [{base}] AS base_found, [{shares}] AS shares
            FROM found, idf)
        SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(spots) AS BIGINT) AS n_base,
               list_min(spots) AS first_word, list_max(spots) AS last_word,
               {listed.format("base_found")} AS base_labels,
               {listed.format(f"(base_found || [{whole}])")} AS labels,
               least(list_max(shares), 1.0) AS score
        FROM shared"""


_OP2_SQL = """
    WITH RECURSIVE usable AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND len(embedding) > 0
          AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
          AND len([x FOR x IN embedding IF x <> 0]) > 0),
    links AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM usable AS a JOIN usable AS b
            ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
    reached(a, b) AS (
        SELECT DISTINCT a, a FROM links
        UNION
        SELECT r.a, l.b FROM reached AS r JOIN links AS l ON r.b = l.a)
    SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id,
           vec_id = coalesce(c, vec_id) AS kept
    FROM embeddings
    LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a) USING (vec_id)
    LEFT JOIN (SELECT a AS vec_id, min(b) AS c FROM reached GROUP BY a) USING (vec_id)"""

_OP8_SQL = r"""
    WITH RECURSIVE cut AS (
        SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(words[place:place + 2], ' ') AS shingle
        FROM cut, LATERAL unnest(range(1, greatest(len(words) - 1, 2))) AS t(place)
        WHERE len(words) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
        FROM shingles AS a JOIN shingles AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id),
    links AS (
        SELECT a, b FROM common
        JOIN sizes AS p ON p.doc_id = a JOIN sizes AS q ON q.doc_id = b
        WHERE 100 * common.n >= 90 * (p.n + q.n - common.n)),
    reached(a, b) AS (
        SELECT DISTINCT a, a FROM links
        UNION
        SELECT r.a, l.b FROM reached AS r JOIN links AS l ON r.b = l.a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(c, doc_id) AS component_id
    FROM documents
    LEFT JOIN sizes USING (doc_id)
    LEFT JOIN (SELECT a AS doc_id, min(b) AS c FROM reached GROUP BY a) USING (doc_id)"""

_OP8_LINKS_SQL = (
    _OP8_SQL.partition("    SELECT doc_id, coalesce(n, 0) AS n_shingles")[0]
    + """
    SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(k, 0) AS n_links,
           coalesce(c, doc_id) AS component_id
    FROM documents
    LEFT JOIN sizes USING (doc_id)
    LEFT JOIN (SELECT a AS doc_id, count(*) AS k FROM links GROUP BY a) USING (doc_id)
    LEFT JOIN (SELECT a AS doc_id, min(b) AS c FROM reached GROUP BY a) USING (doc_id)"""
)

_OP10_SQL = r"""
    WITH lines AS (
        SELECT doc_id, place, list_extract(parts, place) AS line
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
             LATERAL unnest(range(1, len(parts) + 1)) AS t(place)),
    keyed AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
    repeated AS (
        SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
        GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    marked AS (
        SELECT k.*, keeper IS NOT NULL AND keeper <> doc_id AS gone
        FROM keyed k LEFT JOIN repeated USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), ''))
               AS kept_sha256
    FROM marked GROUP BY doc_id"""


_OP11_SQL = r"""
    WITH cut AS (
        SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents),
    items AS (
        SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, least(len(words), 10) AS n,
               array_to_string(words[place:place + 9], ' ') AS passage
        FROM items, LATERAL unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS t(place)
        WHERE len(words) > 0),
    runs AS (
        SELECT row, n, unnest(range(1, len(words) - n + 2)) AS place,
               unnest([array_to_string(words[i:i + n - 1], ' ')
                       FOR i IN range(1, len(words) - n + 2)]) AS passage
        FROM cut, (SELECT DISTINCT n FROM windows)),
    hits AS (SELECT * FROM runs WHERE passage IN (SELECT passage FROM windows)),
    hit AS (
        SELECT row, count(DISTINCT word) AS n_hit
        FROM hits, LATERAL unnest(range(place, place + n)) AS t(word) GROUP BY row),
    named AS (
        SELECT row, count(DISTINCT item_id) AS n_items,
               string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))
                   AS ids
        FROM hits JOIN windows USING (passage, n) GROUP BY row)
    SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           n_hit IS NOT NULL AS contaminated
    FROM cut LEFT JOIN hit USING (row) LEFT JOIN named USING (row)"""


_OP12_SQL = """
    WITH whole AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
               CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
        FROM whole AS a JOIN whole AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, CAST(row_number() OVER pair AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    WINDOW pair AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER pair <= 3"""

# CRC-32 bit by bit, of the decimal digits of conv_id.
_CRC32 = """xor(4294967295, list_reduce(
    list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
    lambda total, byte: list_reduce(
        range(0, 8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(total, byte)),
    CAST(4294967295 AS BIGINT)))"""

_OP13_SQL = f"""
    WITH numbered AS (
        SELECT conv_id, place, chars, sha256(length(role) || ':' || role || text) AS turn
        FROM (SELECT conv_id, role, text, length(text) AS chars, row_number() OVER (
                  PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
              FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
                    FROM conversations WHERE conv_id IS NOT NULL))),
    convs AS (
        SELECT conv_id, {_CRC32} % 6 AS h, conv_id - conv_id % 100 AS base
        FROM (SELECT DISTINCT conv_id FROM numbered)),
    rebuilt AS (
        SELECT c.conv_id, 0 AS part, place, chars, turn
        FROM convs AS c JOIN numbered AS n ON n.conv_id = base AND place <= h
        UNION ALL
        SELECT conv_id, 1, place, chars, turn FROM convs JOIN numbered USING (conv_id)
        WHERE place > h),
    whole AS (
        SELECT conv_id, coalesce(list(turn ORDER BY part, place) FILTER (turn IS NOT NULL), [])
                   AS turns,
               list(chars ORDER BY part, place) AS chars
        FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id),
    prefixes AS (
        SELECT conv_id, depth, turns[1:depth] AS key, depth = len(turns) AS ends,
               CASE WHEN depth > 0 THEN chars[depth] ELSE 0 END AS chars
        FROM whole, LATERAL unnest(range(0, len(turns) + 1)) AS t(depth)),
    nodes AS (
        SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
               string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ids
        FROM prefixes GROUP BY key, depth),
    counted AS (
        SELECT n.*, coalesce(k, 0) AS n_children
        FROM nodes AS n LEFT JOIN (
            SELECT key[1:depth - 1] AS key, count(*) AS k FROM nodes WHERE depth > 0
            GROUP BY ALL) USING (key)),
    sums AS (
        SELECT key[1:above] AS key, count(*) FILTER (n_children = 0) AS n_leaves,
               CAST(sum((n_convs - 1) * chars) AS BIGINT) AS saved_tokens
        FROM counted, LATERAL unnest(range(0, depth + 1)) AS t(above) GROUP BY ALL)
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, n_leaves,
           saved_tokens, sha256(coalesce(n.ids, '')) AS ends_sha256
    FROM counted AS n JOIN sums USING (key)
    LEFT JOIN nodes AS p ON n.depth > 0 AND p.key = n.key[1:n.depth - 1]"""


_OP6_BASE_SQL = r"""
    WITH docs AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
               list_filter(string_split(coalesce(text, ''), chr(10)),
                           lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM documents),
    windows AS (
        SELECT r, i, words[i:i + 4] AS w
        FROM docs, LATERAL unnest(range(1, len(words) - 3)) AS t(i)),
    repeated AS (
        SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1),
    inside AS (
        SELECT r, count(DISTINCT i + k) AS n
        FROM repeated, LATERAL unnest(range(0, 5)) AS t(k) GROUP BY r),
    counts AS (
        SELECT doc_id, len(words) AS n_words,
               length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
               CAST(len(lines) - list_unique(lines) AS BIGINT) AS n_dup_lines,
               coalesce(n, 0) AS n_repeat_words
        FROM docs LEFT JOIN inside USING (r))
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts"""

_OP9_BASE_SQL = rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS r, doc_id, {_CRC32.replace("conv_id", "doc_id")} % 5 = 1 AS held_out,
               regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS words
        FROM documents),
    tokens AS (  -- the end, which no word can be, is the empty string
        SELECT r, held_out, unnest(list_append(words, '')) AS token FROM docs),
    model AS (SELECT token, count(*) AS c FROM tokens WHERE NOT held_out GROUP BY token),
    sums AS (SELECT coalesce(sum(c), 0) AS n, count(*) AS v FROM model),
    scored AS (
        SELECT r, count(*) AS n_tokens, count(c) AS n_known,
               sum(log10((coalesce(c, 0) + 0.5::DOUBLE) / (n + 0.5::DOUBLE * (v + 1)))) AS score
        FROM tokens LEFT JOIN model USING (token), sums GROUP BY r)
    SELECT doc_id, held_out, n_tokens, n_known, CAST(n AS BIGINT) AS train_tokens,
           round(score, 4) AS base_score
    FROM docs JOIN scored USING (r), sums"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that it can express."""
    sql = {
        "op1_license_scan": _op1_sql(),
        "op2_embedding_dedup": _OP2_SQL,
        "op3_url_filter": _OP3_SQL,
        "op4_chat_format": _OP4_SQL,
        "op6_base": _OP6_BASE_SQL,
        "op8_jaccard_join": _OP8_SQL,
        "op8_jaccard_links": _OP8_LINKS_SQL,
        "op9_base": _OP9_BASE_SQL,
        "op10_line_dedup": _OP10_SQL,
        "op11_decontamination": _OP11_SQL,
        "op12_hard_negatives": _OP12_SQL,
        "op13_prefix_trie": _OP13_SQL,
    }
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
