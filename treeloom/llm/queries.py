"""The registered queries of the operators, and their results as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeloom.llm import (
    contamination, jaccard, language, licenses, mixing, negatives, outliers, quality, rendering, simhash, spelling, substrings, warc,
)
from treeloom.llm.tables import read

WHITE = r"[ \t\n\x0B\f\r]+"


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that no 50-word window of a smaller id covers."""
    kept = substrings.remove_repeats(read(spark, sf_dir, "documents"))
    spaced = F.trim(F.regexp_replace(F.coalesce("kept_text", F.lit("")), WHITE, " "))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(spaced, 256).alias("kept_sha256"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    pages = rendering.with_text(read(spark, sf_dir, "pages").select("page_id", "html"), "text")
    return pages.select("page_id", "text", F.length("text").cast("long").alias("text_chars"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and the smallest id that links of two bits reach."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages, as read back from the archives they were written to."""
    archives = warc.write(warc.as_records(read(spark, sf_dir, "pages")))
    return warc.read(archives, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document, and whether rules and estimates keep it."""
    return outliers.judge(read(spark, sf_dir, "documents"))


def fold(parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null without an id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from four folds of five."""
    docs = read(spark, sf_dir, "documents")
    voters = quality.fit(docs, read(spark, sf_dir, "labels").filter(fold(5) != 0))
    docs = docs.select("doc_id", "text", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"))
    scored = quality.with_score(docs, voters, "score")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three folds of four."""
    docs = read(spark, sf_dir, "documents")
    model = language.fit(docs.filter(fold(4) != 2))
    docs = docs.select("doc_id", "text", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"))
    found = language.with_language(docs, model, "found")
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.coverage")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.with_licenses(docs, licenses.fit(docs), "found")
    own = F.transform(F.filter("found.matches", lambda m: m["best"]), lambda m: m["label"])
    labels = F.array_sort(F.array_union("found.base_labels", own))
    best = F.array_max(F.transform("found.matches", lambda m: m["containment"]))
    return found.select(
        "doc_id", "found.n_words", "found.n_base", "found.first_word", "found.last_word",
        F.array_join("found.base_labels", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.when(F.col("found.n_base") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"),
    )


def _license_sql() -> str:
    rows = ", ".join(
        f"({i}, '{label}', {sorted(set(licenses.words_of(text)))}, {len(licenses.words_of(text))})"
        for i, (label, text) in enumerate(licenses.TEMPLATES)
    )
    phrases = ", ".join(f"({p.split()}, '{label}')" for p, label in licenses.PHRASES.items())
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = "list_filter(regexp_split_to_array({}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    vocabulary = sorted({w for _, text in licenses.TEMPLATES for w in licenses.words_of(text)})
    runs = " UNION ALL ".join(
        f"""SELECT doc_id, nr AS first, nr + {n - 1} AS last, flatten(list(own) OVER w) AS own, sum(n) OVER w AS n,
            count(*) OVER w AS lines, {n} AS want FROM line
            WINDOW w AS (PARTITION BY doc_id, part ORDER BY nr ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING)"""
        for n in range(1, licenses.LINES + 1)
    )
    return f"""
        WITH t(id, label, words, n_words) AS (VALUES {rows}),
        p(words, label) AS (VALUES {phrases}),
        d AS (SELECT doc_id, {words.format(lower)} AS words, string_split({lower}, chr(10)) AS lines FROM documents),
        place AS (
          SELECT doc_id, label, pos FROM (
            SELECT doc_id, d.words AS own, p.words AS phrase, label,
              unnest(list_filter(range(len(d.words)), lambda i: d.words[i + 1] = p.words[1])) AS pos
            FROM d, p)
          WHERE own[pos + 1:pos + len(phrase)] = phrase),
        base AS (
          SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word,
            list_sort(list(DISTINCT label)) AS base FROM place GROUP BY doc_id),
        line AS (
          SELECT doc_id, nr, list_intersect(list_distinct(words), {vocabulary}) AS own, len(words) AS n,
            nr - row_number() OVER (PARTITION BY doc_id ORDER BY nr) AS part
          FROM (SELECT doc_id, nr, {words.format('line')} AS words
            FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS nr FROM d))
          WHERE len(words) > 0),
        run AS (SELECT doc_id, first, last, list_distinct(own) AS own, n FROM ({runs}) WHERE lines = want AND len(own) > 0),
        shared AS (
          SELECT doc_id, first, last, n, n_words, id, label, words, list_intersect(own, words) AS both,
            len(list_intersect(own, words)) / len(words) AS share FROM run, t),
        reached AS (
          SELECT * FROM shared WHERE share >= {licenses.CONTAINED} AND (first = last OR n <= 2 * n_words)),
        hit AS (
          SELECT * FROM reached a WHERE NOT EXISTS (
            SELECT 1 FROM reached b WHERE b.doc_id = a.doc_id AND b.id = a.id AND b.share = a.share
              AND b.first >= a.first AND b.last <= a.last AND b.last - b.first < a.last - a.first)),
        best AS (
          SELECT * FROM hit a WHERE NOT EXISTS (
            SELECT 1 FROM hit b WHERE b.doc_id = a.doc_id AND b.first <= a.last AND b.last >= a.first
              AND list_has_all(b.words, a.both) AND (b.share > a.share OR
                (b.share = a.share AND list_has_all(b.words, a.words) AND len(b.words) > len(a.words))))),
        own AS (SELECT doc_id, list(label) AS extra, max(share) AS share FROM best GROUP BY doc_id)
        SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
          first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
          coalesce(array_to_string(base, ','), '') AS base_labels,
          array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(extra, [])))), ',') AS labels,
          CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
        FROM d LEFT JOIN base USING (doc_id) LEFT JOIN own USING (doc_id)"""


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items they leak, each with its first most similar window."""
    found = contamination.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "first_word", "n_words")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in a mixture of the sources."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor and positive, some labels moved on by one first."""
    rows = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.select("vec_id", "embedding", label.alias("label")))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents, some runs short of a letter, with their forms and roots."""
    return spelling.variants(read(spark, sf_dir, "documents"), drop_every=97)


def op13_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of shingles of every document and the smallest id that similar ones reach."""
    return jaccard.similar_documents(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_substring_dedup, op2_warc, op3_quality_classifier, op4_quality_rules, op5_language_id, op6_license_scan, op7_benchmark_decontamination, op8_source_mixing, op9_html_extraction, op10_simhash_near_dedup, op11_hard_negatives, op12_spelling_variants, op13_ngram_jaccard)
}

def _leak_sql() -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = f"list_filter(regexp_split_to_array({lower}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
    return f"""
        WITH d AS (SELECT doc_id, {words} AS words FROM documents),
        i AS (SELECT item_id, {words} AS words FROM benchmark),
        ds AS (
          SELECT doc_id, pos, array_to_string(words[pos + 1:pos + 5], ' ') AS shingle
          FROM (SELECT doc_id, words, unnest(range(len(words) - 4)) AS pos FROM d WHERE len(words) >= 5)),
        own AS (
          SELECT item_id, size, array_to_string(words[pos + 1:pos + 5], ' ') AS shingle
          FROM (SELECT item_id, words, len(words) AS size, unnest(range(len(words) - 4)) AS pos FROM i WHERE len(words) >= 5)),
        seed AS (SELECT DISTINCT doc_id, pos, item_id, size FROM ds JOIN own USING (shingle)),
        start AS (
          SELECT DISTINCT doc_id, item_id, start, least(size, len(words)) AS n
          FROM (SELECT *, pos - unnest(range(size - 4)) AS start FROM seed) JOIN d USING (doc_id)
          WHERE start >= 0 AND start <= len(words) - least(size, len(words))),
        a AS (
          SELECT s.doc_id, s.item_id, s.start, s.n, ds.shingle, count(*) AS x
          FROM start s JOIN ds ON ds.doc_id = s.doc_id AND ds.pos >= s.start AND ds.pos <= s.start + s.n - 5
          GROUP BY ALL),
        b AS (SELECT item_id, shingle, count(*) AS y FROM own GROUP BY ALL),
        size AS (SELECT item_id, sum(y) AS total FROM b GROUP BY ALL),
        met AS (
          SELECT doc_id, item_id, start, n, sum(least(x, coalesce(y, 0))) AS shared, any_value(n) - 4 AS here
          FROM a LEFT JOIN b USING (item_id, shingle) GROUP BY doc_id, item_id, start, n),
        sim AS (SELECT *, shared::DOUBLE / (here + total - shared)::DOUBLE AS similarity FROM met JOIN size USING (item_id))
        SELECT doc_id, item_id, similarity, start::BIGINT AS first_word, n::BIGINT AS n_words FROM sim
        WHERE similarity >= {contamination.SIMILAR}
        QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) = 1"""


NEGATIVES_SQL = """
    WITH v AS (
      SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.id AS anchor, b.id AS other, a.label = b.label AS same,
        list_sum(list_transform(list_zip(a.v, b.v), lambda x: x[1] * x[2]))::BIGINT AS score
      FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 50 = 0),
    p AS (
      SELECT anchor, other AS positive, score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5),
    n AS (
      SELECT p.anchor, positive, s.other, p.score AS positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor, positive ORDER BY s.score DESC, s.other) AS rank
      FROM p JOIN s ON s.anchor = p.anchor AND NOT same
      WHERE 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
    SELECT anchor AS anchor_id, positive AS positive_id, rank::INTEGER AS rank, other AS negative_id,
      positive_score, negative_score
    FROM n WHERE rank <= 3"""

#: The checksum is crc32, byte by byte from its table.
SPELLING_SQL = """
    WITH RECURSIVE crc AS (
      SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t
      FROM range(256) r(i)),
    run AS (
      SELECT doc_id, run, count(*) AS n
      FROM (
        SELECT doc_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{00C0}-\\x{00FF}]+')) AS run
        FROM documents)
      GROUP BY ALL),
    sum AS (
      SELECT run, n, xor(list_reduce(
        flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
          lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
      FROM run, crc),
    w AS (
      SELECT word, sum(n)::BIGINT AS n
      FROM (
        SELECT n, CASE WHEN h % 97 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word
        FROM sum)
      WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    cut AS (
      SELECT word, n, pos, word[:pos] || word[pos + 2:] AS rest
      FROM (SELECT *, unnest(range(length(word))) AS pos FROM w)),
    near AS (
      SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b USING (pos, rest) WHERE a.word <> b.word
      UNION SELECT cut.word, w.word, w.n FROM cut JOIN w ON w.word = rest
      UNION SELECT w.word, cut.word, cut.n FROM cut JOIN w ON w.word = rest),
    best AS (
      SELECT word, count(*) AS n_near, max(n) AS most FROM near GROUP BY word),
    form AS (
      SELECT w.word, min(other) AS form, any_value(most) AS form_n
      FROM w JOIN best USING (word) JOIN near ON near.word = w.word AND near.n = most
      WHERE most >= 2 * w.n GROUP BY w.word),
    way(word, root) AS (
      SELECT word, word FROM w
      UNION SELECT way.word, form.form FROM way JOIN form ON form.word = way.root),
    last AS (SELECT word, root FROM way WHERE root NOT IN (SELECT word FROM form))
    SELECT w.word, form, root, w.n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
    FROM w LEFT JOIN form USING (word) LEFT JOIN best USING (word) JOIN last USING (word)"""


SQL: dict[str, str] = {
    "op11_hard_negatives": NEGATIVES_SQL,
    "op12_spelling_variants": SPELLING_SQL,
    "op13_ngram_jaccard": """
        WITH RECURSIVE w AS (
          SELECT doc_id, list_filter(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
          FROM documents),
        s AS (
          SELECT DISTINCT doc_id, array_to_string(words[start:start + 3], ' ') AS shingle
          FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS start FROM w WHERE len(words) > 0)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        met AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS x
          FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
        link AS (
          SELECT a, b FROM met JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
          WHERE 100 * x >= 85 * (na.n + nb.n - x)),
        way AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
        reach(doc_id, other) AS (
          SELECT doc_id, doc_id FROM documents
          UNION SELECT reach.doc_id, way.b FROM reach JOIN way ON way.a = reach.other)
        SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
        FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op7_benchmark_decontamination": _leak_sql(),
    "op2_warc": """
        WITH p AS (
          SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
            sha1(coalesce(html, '')) AS payload_digest
          FROM pages),
        m AS (SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
        SELECT page_id, payload_bytes, payload_digest,
          CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN page_id < last THEN last END AS refers_to
        FROM p LEFT JOIN m USING (payload_digest)""",
    "op6_license_scan": _license_sql(),
    "op1_substring_dedup": """
        WITH w AS (
          SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
          FROM documents),
        s AS (
          SELECT doc_id, unnest(range(1, len(words) - 48)) AS start, words FROM w WHERE len(words) >= 50),
        h AS (SELECT doc_id, start, sha256(array_to_string(words[start:start + 49], ' ')) AS hash FROM s),
        m AS (SELECT hash, min(doc_id) AS least FROM h GROUP BY hash),
        gone AS (
          SELECT DISTINCT h.doc_id, unnest(range(start, start + 50)) AS pos
          FROM h JOIN m USING (hash) WHERE h.doc_id > m.least),
        g AS (SELECT doc_id, list(pos) AS gone FROM gone GROUP BY doc_id),
        k AS (
          SELECT w.doc_id, words, coalesce(gone, []) AS gone,
            CASE WHEN gone IS NULL THEN words
                 ELSE list_transform(list_filter(list_zip(words, range(1, len(words) + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1])
            END AS kept
          FROM w LEFT JOIN g USING (doc_id))
        SELECT doc_id, len(words)::BIGINT AS n_words, len(gone)::BIGINT AS n_removed,
          sha256(array_to_string(kept, ' ')) AS kept_sha256
        FROM k""",
}
