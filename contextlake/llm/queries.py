"""Queries of the text operators over whole tables, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import align_tokenizers
from .bpe import digest_documents
from .lines import drop_shared_lines
from .mixing import mix_sources
from .multiset import fingerprint_documents, likeness, to_hex
from .pii import KINDS, find_personal_data, span_text
from .quality import judge_documents
from .recipes import exact_duplicates
from .simhash import near_duplicates
from .spelling import spelling_variants
from .substrings import remove_repeats
from .token_counts import count_tokens
from .urls import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query(
    r"""
    WITH sized AS (
        SELECT doc_id, coalesce('0' || source, '1') AS g,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
               md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS key
        FROM documents
    ), sources AS (
        SELECT g, sum(size)::BIGINT AS source_size,
               CASE (row_number() OVER (ORDER BY g) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
        FROM sized GROUP BY g
    ), levels AS (
        SELECT *, 3 * source_size AS cap,
               sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS rest,
               sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS rest_weight,
               row_number() OVER (ORDER BY 3 * source_size / weight, g) AS place
        FROM sources
        WINDOW before AS (ORDER BY 3 * source_size / weight, g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), opening AS (
        SELECT place AS first_place, rest AS first_rest, rest_weight AS first_weight FROM levels
        WHERE cap * rest_weight > weight * rest ORDER BY place LIMIT 1
    ), targets AS (
        SELECT g, source_size,
               CASE WHEN place >= first_place THEN CAST(weight * first_rest AS DOUBLE) / CAST(first_weight AS DOUBLE)
                    ELSE CAST(cap AS DOUBLE) END AS target
        FROM levels LEFT JOIN opening ON true
    ), ordered AS (
        SELECT s.*, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
               coalesce(sum(size) OVER (PARTITION BY s.g ORDER BY key, size
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM sized s JOIN targets t USING (g)
    ), cut AS (
        SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS copies FROM ordered
    )
    SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
           CAST(copies * size + greatest(0, least(size, budget - copies * source_size - before)) AS BIGINT) AS taken
    FROM cut
    """
)
def op2_mixing(spark, sf_dir):
    """All documents mixed with weights 5, 2, 1 over the sources in code point order."""
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc.doc_id", "size", "source_size", "target", "taken")


@_query(
    r"""
    WITH lines AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
        FROM documents
    ), keyed AS (
        SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
        FROM lines
    ), shared AS (
        SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3
    )
    SELECT doc_id, count(*) AS n_lines,
           count(*) FILTER (WHERE keeper IS NOT NULL AND keeper <> doc_id) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL OR keeper = doc_id), ''))
               AS kept_sha256
    FROM keyed LEFT JOIN shared USING (key)
    GROUP BY doc_id
    """
)
def op4_line_dedup(spark, sf_dir):
    """Lines of 20 characters or more found in 3 documents or more, kept once."""
    kept = drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(
        "doc.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


#: Host, path, verdict.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


@_query(
    r"""
    WITH parts AS (
        SELECT page_id,
               translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
        FROM pages
    ), rules(rule_host, rule_path, verdict) AS (
        VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
               ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
    ), ranked AS (
        SELECT page_id, host, path, rule_host || rule_path AS rule, verdict,
               row_number() OVER (PARTITION BY page_id
                                  ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS place
        FROM parts LEFT JOIN rules
          ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    )
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM ranked WHERE place = 1
    """
)
def op5_url_filter(spark, sf_dir):
    """Every page's url against the four rules; pages that no rule fits are allowed."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page.page_id", "host", "path", "rule", "verdict")


VOCABULARY = "word_bpe_49k.json"
#: Names of the measures in the order of the result.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@_query()
def op1_token_counts(spark, sf_dir):
    """Tokens of every whole text; SQL has no tokenizer, tests compare with the library."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path(VOCABULARY), limit=2048)
    return counted.select("doc.doc_id", "n_bytes", "n_tokens", "over_limit")


@_query()
def op3_simhash(spark, sf_dir):
    """Components of fingerprints within 2 bits; tests compare with brute force."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc.doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@_query()
def op6_bpe(spark, sf_dir):
    """Every whole text encoded and decoded; SQL has no BPE, tests compare with the library."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = digest_documents(docs, public_tokenizers.path(VOCABULARY))
    return coded.select("doc.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@_query(
    r"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    split AS (
        SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
               list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
        FROM texts
    ), starts AS (
        SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS first FROM split
    ), repeated AS (
        SELECT doc_id, first, count(*) OVER (PARTITION BY doc_id, words[first:first + 7]) AS times FROM starts
    ), covered AS (
        SELECT doc_id, count(DISTINCT word) AS n_repeat_words
        FROM (SELECT doc_id, unnest(range(first, first + 8)) AS word FROM repeated WHERE times > 1) GROUP BY doc_id
    ), measured AS (
        SELECT s.doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
               length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
               coalesce(n_repeat_words, 0) AS n_repeat_words
        FROM split s LEFT JOIN covered USING (doc_id)
    ), judged AS (
        SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND 100 * n_symbols <= 10 * word_chars AND 2 * n_dup_lines <= n_lines
           AND word_chars BETWEEN 2 * n_words AND 20 * n_words AS kept
    FROM judged
    """
)
def op9_quality(spark, sf_dir):
    """Base measures of every whole text and the verdict of the cascade."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge_documents(docs, measures=MEASURES)
    return judged.select("doc.doc_id", *MEASURES, "base_failed", "kept")


@_query()
def op8_fingerprints(spark, sf_dir):
    """Fingerprints of whole texts, their edits and their likeness; tests compare with brute force."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = fingerprint_documents(docs)
    return found.select(
        "doc.doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        to_hex(F.col("vector")).alias("fingerprint"),
        to_hex(F.col("edited_vector")).alias("edited_fingerprint"),
        likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
    )


@_query()
def op7_personal_data(spark, sf_dir):
    """Personal data of every whole text; tests compare the patterns with brute force."""
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc.doc_id",
        *[F.size(F.filter("base", _is_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def _is_kind(kind: str):
    return lambda s: s["kind"] == kind


@_query(
    r"""
    WITH split AS (
        SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
    ), windows AS (
        SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS first FROM split
    ), judged AS (
        SELECT doc_id, first,
               min(doc_id) OVER (PARTITION BY words[first:first + 12]) < doc_id AS earlier
        FROM windows
    ), covered AS (
        SELECT DISTINCT doc_id, unnest(range(first, first + 13)) AS pos FROM judged WHERE earlier
    ), placed AS (
        SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM split
    ), kept AS (
        SELECT doc_id, count(*) AS n_words, count(c.pos) AS n_removed,
               string_agg(word, ' ' ORDER BY placed.pos) FILTER (WHERE c.pos IS NULL) AS text
        FROM placed LEFT JOIN covered c USING (doc_id, pos) GROUP BY doc_id
    )
    SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
           sha256(coalesce(text, '')) AS kept_sha256
    FROM split LEFT JOIN kept USING (doc_id)
    """
)
def op10_substring_dedup(spark, sf_dir):
    """Words of 13-word windows that also start in a document with a smaller id, removed."""
    kept = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc.doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@_query(
    r"""
    WITH normal AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
           sha256(text) AS text_sha256
    FROM normal WINDOW same AS (PARTITION BY text)
    """
)
def op12_exact_dedup(spark, sf_dir):
    """Documents with equal texts, lower-cased, and the one of each group that stays."""
    found = exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc.doc_id", "keep_id", "group_size", "kept", "text_sha256")


#: Vocabularies whose tokens are aligned: byte-level BPE, and pieces with byte fallback.
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


@_query()
def op13_alignment(spark, sf_dir):
    """Tokens of two vocabularies over the same bytes; SQL has no tokenizer, tests compare with brute force."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = align_tokenizers(docs, *map(public_tokenizers.path, ALIGNED))
    return found.select(
        "doc.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


@_query(
    r"""
    WITH RECURSIVE crc AS (
        SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS steps
        FROM range(256) r(i)
    ), runs AS (
        SELECT doc_id, run, count(*) AS times FROM (
            SELECT coalesce(CAST(doc_id AS VARCHAR), 'null') AS doc_id,
                   unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                          'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
            FROM documents
        ) WHERE length(run) >= 6 GROUP BY ALL
    ), bytes AS (
        SELECT run, times, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda x:
                   CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
                        ELSE [192 + unicode(x)::BIGINT // 64, 128 + unicode(x)::BIGINT % 64] END)) AS data
        FROM runs
    ), hashed AS (
        SELECT run, times, xor(4294967295, list_reduce(list_prepend(4294967295, data),
                   lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8))) AS h
        FROM bytes, crc
    ), words AS (
        SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
            SELECT times, CASE WHEN h % 199 = 0
                THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
            FROM hashed
        ) WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
    ), gaps AS (
        SELECT word, n, i, substr(word, 1, i) AS before, substr(word, i + 2) AS after
        FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
    ), near AS (
        SELECT a.word, b.word AS form, b.n AS form_n FROM gaps a JOIN gaps b USING (i, before, after) WHERE a.word <> b.word
        UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON w.word = g.before || g.after
        UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON w.word = g.before || g.after
    ), best AS (
        SELECT word, count(*) AS n_near, arg_min(form, (-form_n, form)) AS near_form, max(form_n) AS near_n
        FROM near GROUP BY word
    ), found AS (
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
               CASE WHEN near_n >= 5 * n THEN near_form END AS form, CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
        FROM words w LEFT JOIN best USING (word)
    ), ways AS (
        SELECT word, word AS root FROM found
        UNION ALL SELECT ways.word, found.form FROM ways JOIN found ON found.word = ways.root WHERE found.form IS NOT NULL
    )
    SELECT found.word, found.form, ways.root, found.n, found.n_near, found.form_n
    FROM found JOIN ways ON ways.word = found.word JOIN found last ON last.word = ways.root AND last.form IS NULL
    """
)
def op11_spelling(spark, sf_dir):
    """Frequent words of all documents with their usual form and the root of its way."""
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))
