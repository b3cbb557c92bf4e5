"""Registered queries of the training-data operators: each applies one
operator with production parameters to its whole table and derives the
contract's columns from the operator's output."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm import (decontaminate, html_text, mixing, phrases, pii, quality_rules, secret_scan, sharding, simhash_dedup,
                           spelling, substring_dedup, token_output, weak_quality)
from fieldlens.llm.runtime import shared_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"),
                                    shingle=5, threshold=0.8)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"), window=50)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, radius=4, seed=42)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality_rules.apply_rules(docs, quality_rules.order_rules(docs))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.0, max_epochs=3, seed=42)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def _joined(spans: Column | str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(_table(spark, sf_dir, "documents"), carry=["doc_id"])
    base = F.filter("secrets", lambda s: s["kind"] != "random")
    return found.select("doc_id", *[_count("secrets", k) for k in ("assign", "access", "hex")],
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined("secrets").alias("spans"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages"), carry=["page_id", "url"])


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE_KINDS))

    return found.select("doc_id", *[_count("pii", k) for k in pii.BASE_KINDS], F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined("pii").alias("spans"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return weak_quality.score(docs, weak_quality.fit(docs, labels), carry=["doc_id"])


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    whole = F.coalesce("text", F.lit(""))
    sized = docs.select("doc_id", "source", "text", (F.octet_length(whole) + 16).cast("long").alias("size"),
                        F.crc32(whole.cast("binary")).alias("text_crc32"))
    return sharding.interleave(sized, shards=40, seed=42).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op11_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}-tokens"
    token_output.write_tokens(_table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_output.token_digests(spark, path)


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"), max_words=3, min_count=10, top=2000, absorbed=50)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(spelling.count_words(_table(spark, sf_dir, "documents"), min_length=7, min_count=2, noise=31), ratio=10)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_mixing": op2_mixing,
    "op3_decontamination": op3_decontamination,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_html_text": op7_html_text,
    "op8_pii": op8_pii,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_sharding": op10_sharding,
    "op11_token_output": op11_token_output,
    "op12_phrase_mining": op12_phrase_mining,
    "op13_spelling_variants": op13_spelling_variants,
}

SQL: dict[str, str] = {
    "op1_quality_rules": r"""
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        starts AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS p, w FROM d WHERE len(w) >= 8),
        windows AS (SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS k FROM starts),
        repeats AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS n FROM windows) WHERE n > 1),
        r AS (
            SELECT doc_id, count(DISTINCT i) AS n_repeat_words
            FROM (SELECT doc_id, unnest(range(p, p + 8)) AS i FROM repeats) GROUP BY doc_id),
        m AS (
            SELECT d.doc_id, t, w, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
                   len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
                   len(lines) - len(list_distinct(lines)) AS n_dup_lines,
                   coalesce(n_repeat_words, 0) AS n_repeat_words
            FROM d LEFT JOIN r USING (doc_id)),
        v AS (
            SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
                   length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS letters
            FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR 10 * n_symbols > 3 * n_words
                    OR word_chars < 2 * n_words OR word_chars > 15 * n_words
                    OR (n_dup_lines >= 3 AND 10 * n_dup_lines > 3 * n_lines)
                    OR (letters >= 20 AND 2 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > letters)
                    OR 5 * len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) > n_words
                    OR 2 * len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) < n_words) AS kept
        FROM v
    """,
    "op4_substring_dedup": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        starts AS (
            SELECT doc_id, unnest(range(1, len(w) - 48)) AS p, w FROM d WHERE len(w) >= 50),
        windows AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS k FROM starts),
        repeats AS (
            SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY k) AS low FROM windows)
            WHERE low < doc_id),
        gone AS (
            SELECT DISTINCT doc_id, i FROM (SELECT doc_id, unnest(range(p, p + 50)) AS i FROM repeats)),
        words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
        kept AS (
            SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.i) AS t, count(*) AS n
            FROM words ANTI JOIN gone ON words.doc_id = gone.doc_id AND words.i = gone.i GROUP BY words.doc_id)
        SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
    """,
    "op2_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                   md5('42:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))) AS k
            FROM documents),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   row_number() OVER (ORDER BY source IS NULL, source) AS rnk
            FROM d GROUP BY source),
        w AS (
            SELECT *, CASE (rnk - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
                   3 * source_size AS cap, sum(source_size) OVER () AS budget
            FROM s),
        l AS (
            SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, rnk
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                      / (sum(weight) OVER (ORDER BY cap / weight, rnk
                                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
            FROM w),
        t AS (
            SELECT source, source_size, rnk, budget,
                   CASE WHEN level * weight > cap THEN cap::DOUBLE
                        ELSE weight * (SELECT level FROM l WHERE level * weight <= cap
                                       ORDER BY cap / weight, rnk LIMIT 1) END AS target
            FROM l),
        q AS (
            SELECT d.doc_id, d.size, t.source_size, t.target, t.rnk, t.budget,
                   sum(d.size) OVER (PARTITION BY t.rnk ORDER BY d.k, d.size ROWS UNBOUNDED PRECEDING) AS served
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        c AS (
            SELECT doc_id, size, budget,
                   sum(size) OVER (ORDER BY (served + e.n * source_size) / target, rnk ROWS UNBOUNDED PRECEDING) AS upto
            FROM q, (VALUES (0), (1), (2)) e(n) WHERE size > 0 AND target > 0),
        n AS (SELECT doc_id, count(*) AS copies FROM c WHERE upto <= budget GROUP BY doc_id)
        SELECT q.doc_id, q.size, q.source_size, q.target, q.size * coalesce(n.copies, 0) AS taken
        FROM q LEFT JOIN n ON q.doc_id = n.doc_id
    """,
    "op12_phrase_mining": r"""
        WITH p AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
        grams AS (
            SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
            FROM w, (VALUES (1), (2), (3)) sizes(k) WHERE len(w) >= k),
        f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 10),
        c AS (SELECT lang, k AS size, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k >= 2),
        cuts AS (
            SELECT c.lang, c.phrase, size, a, cut, array_to_string(w[1:cut], ' ') AS lp, array_to_string(w[cut + 1:], ' ') AS rp
            FROM c, (VALUES (1), (2)) x(cut) WHERE cut < size),
        scored AS (
            SELECT cuts.lang, cuts.phrase, cuts.a, cut, l.a AS l, r.a AS r,
                   ((1000000::HUGEINT * cuts.a * cuts.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
            FROM cuts JOIN f l ON l.lang = cuts.lang AND l.phrase = lp JOIN f r ON r.lang = cuts.lang AND r.phrase = rp),
        lowest AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        inner2 AS (
            SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a FROM c WHERE size = 3),
        widest AS (SELECT lang, phrase, max(a) AS longer FROM inner2 GROUP BY lang, phrase),
        ranked AS (
            SELECT lowest.lang, row_number() OVER (PARTITION BY lowest.lang ORDER BY score DESC, a DESC, lowest.phrase) AS rank,
                   lowest.phrase, a, l, r, score
            FROM lowest LEFT JOIN widest ON widest.lang = lowest.lang AND widest.phrase = lowest.phrase
            WHERE longer IS NULL OR 100 * longer < 50 * a)
        SELECT ranked.lang, rank, phrase, a, l, r, n, score
        FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
    """,
}
