"""The training-data queries, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftrail.llm import bpe, decontaminate, filter_audit, html_text, language_id, lexical, line_dedup, lm_score, repeats, simhash, tiff, url_filters, warc


def settle(spark: SparkSession, megabytes: int = 16) -> None:
    """Bound what Spark hands to Python at once, unless the session has a bound of its own.

    The operators work with any bound; long documents take less memory with this one.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if name not in spark.conf.getAll:
        spark.conf.set(name, f"{megabytes}m")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    settle(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to a WARC archive and read back."""
    read = warc.round_trip(spark, _table(spark, sf_dir, "pages").select("page_id", "html"))
    return read.select(read.key.alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three of the four folds."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs)
    scored = language_id.identify(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", language_id.held_out(scored.doc_id).alias("held_out"), "lang_pred", "score")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the boilerplate lines of its source."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_dedup.drop_boilerplate(docs, n_lines="n_lines", n_dropped="n_dropped")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item in every document that contains it."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_items(docs, _table(spark, sf_dir, "benchmark"))
    each = found.select("doc_id", F.explode("matches").alias("m"))
    return each.select("doc_id", "m.item_id", "m.n_shingles", "m.n_shared", F.round(F.col("m.n_shared") / F.col("m.n_shingles"), 6).alias("containment"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and near-duplicate class of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that stand earlier in the corpus."""
    return repeats.digest(repeats.remove_repeats(_table(spark, sf_dir, "documents")))


def _hash31(text: str) -> str:
    return f"CAST(conv(substr(md5({text}), 1, 8), 16, 10) AS BIGINT)"


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by a dated list log; neither is in the tables, so a rule gives both.

    Page ids give fetch times in 2024. Each host, its parent domain and its /en/ folder have
    log entries whose moment, list and action follow from a hash.
    """
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.expr("timestamp_seconds(1704067200 + pmod(page_id * 7919, 31536000))"))
    hosts = pages.select(url_filters.host_of(F.col("url")).alias("host")).where("host != ''").distinct()
    log = hosts.select("host", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("k")).withColumn("h", F.expr(_hash31("concat(host, '#', k)"))).where("h % 2 = 0")
    entries = log.select(
        F.expr("element_at(array('malware', 'spam', 'adult'), cast(h div 2 % 3 AS INT) + 1)").alias("list"),
        F.expr("CASE WHEN k < 3 THEN host WHEN k < 5 AND size(split(host, '[.]')) > 2 THEN substr(host, instr(host, '.') + 1) ELSE concat(host, '/en/') END").alias("pattern"),
        F.expr("timestamp_seconds(1704067200 + h div 6 % 31536000)").alias("at"),
        F.expr("CASE WHEN h div 17 % 3 = 0 THEN 'remove' ELSE 'add' END").alias("action"),
    )
    judged = url_filters.judge(captures, entries)
    return judged.select("page_id", "blocked", "list", "pattern", F.unix_micros("since").alias("since_us"), "n_entries")


def op6_tiff_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored as TIFF pages, read back and described."""
    return tiff.media_digests(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def word_vocabulary() -> str:
    """The vocabulary file of the queries, on whichever machine asks."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, as digests."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode_decode(docs, word_vocabulary, ids="ids_sha256", decoded="decoded_sha256", digests=True)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters in all 120 orders over every document: what each step keeps, removes and loses."""
    return filter_audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log probability of every document, learned from nine of ten folds."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lm_score.train_and_score(docs)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return lexical.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select("item_id", "rank", "doc_id", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontamination": op2_decontamination,
    "op3_simhash": op3_simhash,
    "op4_repeated_passages": op4_repeated_passages,
    "op5_url_filters": op5_url_filters,
    "op6_tiff_media": op6_tiff_media,
    "op7_bpe_round_trip": op7_bpe_round_trip,
    "op8_warc": op8_warc,
    "op9_html_text": op9_html_text,
    "op10_language_id": op10_language_id,
    "op11_filter_audit": op11_filter_audit,
    "op12_lm_score": op12_lm_score,
    "op13_lexical_search": op13_lexical_search,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": """
        WITH lines AS (SELECT DISTINCT doc_id, source, trim(unnest(string_split(text, chr(10)))) AS line FROM documents),
        counts AS (SELECT source, line, count(*) AS n FROM lines WHERE line != '' AND source IS NOT NULL GROUP BY ALL),
        totals AS (SELECT source, count(*) AS total FROM documents GROUP BY ALL),
        bad AS (SELECT source, list(line) AS bad FROM counts JOIN totals USING (source)
                WHERE n > 1 AND n > total * 0.05 + 3 * sqrt(total * 0.05 * 0.95) GROUP BY ALL),
        parts AS (SELECT doc_id, d.source, string_split(text, chr(10)) AS parts, coalesce(bad, []) AS bad
                  FROM documents d LEFT JOIN bad ON d.source = bad.source),
        kept AS (SELECT *, list_filter(parts, lambda x: NOT list_contains(bad, trim(x))) AS kept FROM parts)
        SELECT doc_id, source, array_to_string(kept, chr(10)) AS text, CAST(coalesce(len(parts), 0) AS BIGINT) AS n_lines,
               CAST(coalesce(len(parts) - len(kept), 0) AS BIGINT) AS n_dropped
        FROM kept
    """,
    "op2_decontamination": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark),
        ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM d WHERE len(w) >= 5),
        bs AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s FROM b WHERE len(w) >= 5),
        n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY ALL),
        hits AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY ALL)
        SELECT doc_id, item_id, n_shingles, n_shared, round(n_shared / n_shingles, 6) AS containment
        FROM hits JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_shingles - 1e-9
    """,
    "op5_url_filters": r"""
        WITH cap AS (
            SELECT page_id, url, TIMESTAMP '2024-01-01' + to_seconds((page_id * 7919) % 31536000) AS fetched,
                   regexp_replace(lower(regexp_extract(url, '(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '[.]$', '') AS host,
                   regexp_extract(url, '(?i)^[a-z][a-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        hosts AS (SELECT DISTINCT host FROM cap WHERE host != ''),
        log AS (SELECT host, k, CAST('0x' || substr(md5(host || '#' || k), 1, 8) AS BIGINT) AS h FROM hosts, range(6) r(k)),
        entries AS (
            SELECT ['malware', 'spam', 'adult'][(h // 2) % 3 + 1] AS list,
                   CASE WHEN k < 3 THEN host WHEN k < 5 AND len(string_split(host, '.')) > 2 THEN substr(host, instr(host, '.') + 1) ELSE host || '/en/' END AS pattern,
                   TIMESTAMP '2024-01-01' + to_seconds((h // 6) % 31536000) AS moment, (h // 17) % 3 = 0 AS gone
            FROM log WHERE h % 2 = 0),
        states AS (SELECT list, pattern, moment, bool_or(gone) AS gone FROM entries GROUP BY ALL),
        spans AS (SELECT *, lead(moment) OVER (PARTITION BY list, pattern ORDER BY moment) AS until FROM states),
        hits AS (
            SELECT c.page_id, s.list, s.pattern, s.moment
            FROM cap c JOIN spans s ON c.fetched >= s.moment AND (s.until IS NULL OR c.fetched < s.until) AND NOT s.gone
             AND c.host != '' AND (c.host = s.pattern OR ends_with(c.host, '.' || s.pattern)
                 OR (contains(s.pattern, '/') AND starts_with(c.host || c.path, s.pattern)))),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(pattern) DESC, list, pattern) AS r,
                          count(*) OVER (PARTITION BY page_id) AS n FROM hits)
        SELECT cap.page_id, r IS NOT NULL AS blocked, list, pattern, epoch_us(moment) AS since_us, coalesce(n, 0) AS n_entries
        FROM cap LEFT JOIN ranked ON cap.page_id = ranked.page_id AND r = 1
    """,
    "op8_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha256(h) AS payload_digest FROM p),
        f AS (SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
               CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first_id IS NULL OR page_id = first_id THEN NULL ELSE first_id END AS refers_to
        FROM d LEFT JOIN f USING (payload_digest)
    """,
    "op11_filter_audit": r"""
        WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
        f AS (SELECT doc_id, part, len(words) < 100 AS a, 100 * len(list_distinct(words)) < 80 * len(words) AS b,
                     100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d, doc_id > first AS e FROM w),
        m AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
        n AS (SELECT part, map {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS fails, CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) + CAST(d AS INT) + CAST(e AS INT) AS n_fails,
                     coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM f LEFT JOIN m USING (doc_id)),
        l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM l p, l q, l r, l s, l t
              WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
        z AS (SELECT filter_order, CAST(step AS INT) AS step, filter_order[step] AS x, string_split(filter_order[1:step - 1], '') AS before FROM o, range(1, 6) k(step)),
        y AS (SELECT part, filter_order, step, x, fails[x] AS fails, n_fails, good, toxic,
                     len(list_filter(before, lambda v: v != '' AND fails[v])) > 0 AS gone FROM n, z),
        g AS (SELECT part, filter_order, step, x, count(*) FILTER (NOT gone AND NOT fails) AS kept, count(*) FILTER (NOT gone AND fails) AS removed,
                     count(*) FILTER (gone AND fails) AS redundant, count(*) FILTER (fails AND n_fails = 1) AS unique_fails,
                     count(*) FILTER (NOT gone AND fails AND good) AS good_lost, count(*) FILTER (NOT gone AND fails AND toxic) AS toxic_lost FROM y GROUP BY ALL)
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley FROM g
    """,
    "op13_lexical_search": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        s AS (SELECT count(*) AS nd, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
        t AS (SELECT doc_id, term, n, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term, len(w) AS n FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM t, s GROUP BY term, nd),
        r AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l)))) AS BIGINT) AS score FROM t JOIN i USING (term) JOIN w USING (term), s GROUP BY ALL),
        k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM r WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
    """,
}
