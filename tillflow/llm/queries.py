"""The operators applied to the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import (decontaminate, lexical_search, license_scan, line_frequency, mixing, ngram_join,
                          paragraph_dedup, pii, target_resample, token_counts, token_store, toxicity, trie_dedup)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    leaks = decontaminate.find_leaks(table(spark, folder, "documents"),
                                     table(spark, folder, "benchmark"))
    return leaks.select("doc_id", "item_id", "item_words", "points", "first_word")


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"),
                                     tokenizer_path("piece_bpe_32k.model"))


def op3_paragraph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return paragraph_dedup.repeated_passages(table(spark, folder, "documents"))


def op4_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similar_components(table(spark, folder, "documents"))


def op5_line_frequency(spark: SparkSession, folder: str) -> DataFrame:
    pages = line_frequency.page_lines(table(spark, folder, "pages"))
    cleaned = line_frequency.drop_boilerplate(pages)
    return cleaned.select("page_id", "host", "n_lines", "n_dropped",
                          F.array_join("lines", "\n").alias("text"))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_token_store(spark: SparkSession, folder: str) -> DataFrame:
    root = token_store.write_store(table(spark, folder, "documents"),
                                   tokenizer_path("byte_bpe_50k.json"))
    return token_store.read_store(spark, root)


def op8_trie_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return trie_dedup.exact_duplicates(table(spark, folder, "documents"))


def op9_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(table(spark, folder, "documents"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"))


def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(table(spark, folder, "documents"))


def op12_target_resample(spark: SparkSession, folder: str) -> DataFrame:
    return target_resample.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_token_counts": op2_token_counts,
    "op3_paragraph_dedup": op3_paragraph_dedup,
    "op4_ngram_join": op4_ngram_join,
    "op5_line_frequency": op5_line_frequency,
    "op6_toxicity": op6_toxicity,
    "op7_token_store": op7_token_store,
    "op8_trie_dedup": op8_trie_dedup,
    "op9_license_scan": op9_license_scan,
    "op10_mixing": op10_mixing,
    "op11_personal_data": op11_personal_data,
    "op12_target_resample": op12_target_resample,
    "op13_lexical_search": op13_lexical_search,
}

LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS_SQL = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

def _license_sql() -> str:
    rows = []
    for number, (text, label) in enumerate(license_scan.PHRASES + license_scan.NOTICES):
        phrase, words = number < len(license_scan.PHRASES), text.split()
        k = license_scan.PHRASE_K if phrase else license_scan.NOTICE_K
        count = len(words) - k + 1
        rows += [f"({number}, '{label}', {phrase}, {count}, {i}, '{' '.join(words[i:i + k])}')"
                 for i in range(count)]
    return f"""
WITH parts(template, label, phrase, grams, place, gram) AS (VALUES {", ".join(rows)}),
cut AS (SELECT doc_id, regexp_extract_all({LOWER_SQL}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 1)) AS i FROM cut),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] AS gram FROM places UNION ALL
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM places WHERE i + 2 <= len(w)),
votes AS (
  SELECT doc_id, template, label, phrase, grams, i - 1 - place AS diagonal, list(DISTINCT place) AS places
  FROM windows JOIN parts USING (gram) GROUP BY ALL),
marked AS (
  SELECT *, CASE WHEN phrase OR coalesce(diagonal - lag(diagonal) OVER t > {license_scan.SLACK}, TRUE)
                 THEN 1 ELSE 0 END AS fresh
  FROM votes WINDOW t AS (PARTITION BY doc_id, template ORDER BY diagonal)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM marked),
spans AS (
  SELECT doc_id, label, phrase, grams, min(diagonal) AS start, max(diagonal) AS stop,
         len(list_distinct(flatten(list(places)))) AS n
  FROM numbered GROUP BY doc_id, template, label, phrase, grams, span),
kept AS (
  SELECT *, CASE WHEN phrase THEN 1.0::DOUBLE ELSE n::DOUBLE / grams END AS share FROM spans
  WHERE CASE WHEN phrase THEN n = grams
             ELSE n::DOUBLE / grams >= {license_scan.COVER}::DOUBLE
                  AND stop - start <= grams / 2 + {license_scan.SLACK} END),
found AS (
  SELECT doc_id, count(*) FILTER (phrase) AS n_base, min(start) FILTER (phrase) AS first_word,
         max(start) FILTER (phrase) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM kept GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM cut LEFT JOIN found USING (doc_id)"""


def _leak_sql() -> str:
    shortest = min(map(len, decontaminate.MASKS))

    def windows(place: str, words: str, short: str) -> str:
        """Windows by mask; those of items shorter than any mask where ``short`` allows their length."""
        forms = []
        for mask in [*decontaminate.MASKS, *["1" * n for n in range(1, shortest)]]:
            cared = " || ' ' || ".join(f"{words}[{place} + {i + 1}]" for i, c in enumerate(mask) if c == "1")
            asked = "" if len(mask) >= shortest else f" AND {short.format(n=len(mask))}"
            forms.append(f"CASE WHEN {place} + {len(mask)} <= len({words}){asked} THEN '{mask} ' || {cared} END")
        return f"unnest([{', '.join(forms)}])"

    return f"""
WITH named AS (SELECT DISTINCT item_id, {WORDS_SQL.format(LOWER_SQL)} AS iw FROM benchmark),
items AS (SELECT row_number() OVER () AS item_key, iw FROM (SELECT DISTINCT iw FROM named WHERE len(iw) > 0)),
lengths AS (SELECT coalesce(list(DISTINCT len(iw)), []) AS short FROM items),
docs AS (SELECT doc_id, row_number() OVER () AS row, dw FROM (SELECT DISTINCT doc_id, {WORDS_SQL.format(LOWER_SQL)} AS dw, text FROM documents)),
seeds AS (
  SELECT DISTINCT item_key, k, {windows('k', 'iw', 'len(iw) = {n}')} AS seed
  FROM (SELECT *, unnest(generate_series(0, len(iw) - 1)) AS k FROM items)),
looked AS (
  SELECT row, spot, {windows("spot", "dw", "list_contains(short, {n})")} AS seed
  FROM (SELECT *, unnest(generate_series(0, len(dw) - 1)) AS spot FROM docs), lengths),
hits AS (SELECT DISTINCT row, item_key, spot - k AS diagonal FROM looked JOIN seeds USING (seed)),
cells AS (
  SELECT row, item_key, diagonal, len(iw) AS item_words, j, CASE WHEN dw[diagonal + j + 1] = iw[j + 1] THEN 1 ELSE -1 END AS s
  FROM (SELECT *, unnest(generate_series(greatest(0, -diagonal), least(len(iw), len(dw) - diagonal) - 1)) AS j
        FROM hits JOIN docs USING (row) JOIN items USING (item_key))),
sums AS (SELECT *, sum(s) OVER (PARTITION BY row, item_key, diagonal ORDER BY j) AS p FROM cells),
runs AS (
  SELECT *, p - least(0, coalesce(min(p) OVER (PARTITION BY row, item_key, diagonal ORDER BY j
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS run
  FROM sums),
scored AS (
  SELECT row, item_key, item_words, diagonal, max(run) AS points FROM runs GROUP BY ALL)
SELECT doc_id, item_id, item_words::INTEGER AS item_words, points::INTEGER AS points, diagonal::INTEGER AS first_word
FROM (SELECT * FROM scored WHERE points >= least({decontaminate.ENOUGH}, (item_words * 3 + 4) // 5)
      QUALIFY row_number() OVER (PARTITION BY row, item_key ORDER BY points DESC, diagonal) = 1)
JOIN docs USING (row) JOIN items USING (item_key) JOIN named USING (iw)"""


PLAIN_WORDS_SQL = f"regexp_extract_all({LOWER_SQL}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

# Fixed value: the reflected polynomial of crc32.
_CRC32_SQL = """
crc_table AS (
  SELECT list(v ORDER BY i) AS cells
  FROM (SELECT i, list_reduce([i] || range(8), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS v
        FROM (SELECT unnest(range(256)) AS i))),
coded AS (
  SELECT word, xor(list_reduce([4294967295::BIGINT] || list_transform(regexp_extract_all(hex(encode(word)), '..'),
                                                                      lambda h: ('0x' || h)::BIGINT),
                               lambda x, y: xor(cells[(xor(x, y) & 255) + 1], x >> 8)), 4294967295) AS crc
  FROM (SELECT DISTINCT word FROM every_word), crc_table)"""


def _resample_sql() -> str:
    r = target_resample
    return f"""
WITH cut AS (SELECT row_number() OVER () AS row, doc_id, {PLAIN_WORDS_SQL} AS words FROM documents),
words AS (SELECT row, unnest(words) AS word FROM cut),
aim AS (SELECT unnest({PLAIN_WORDS_SQL}) AS word FROM benchmark),
every_word AS (SELECT word FROM words UNION SELECT word FROM aim),{_CRC32_SQL},
s_counts AS (SELECT crc % {r.BUCKETS} AS bucket, count(*) AS n FROM words JOIN coded USING (word) GROUP BY ALL),
t_counts AS (SELECT crc % {r.BUCKETS} AS bucket, count(*) AS n FROM aim JOIN coded USING (word) GROUP BY ALL),
gains AS (
  SELECT b AS bucket, floor(1000 * ln(((coalesce(t.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM s_counts) + {r.BUCKETS}))::DOUBLE
           / ((coalesce(s.n, 0) + 1) * ((SELECT coalesce(sum(n), 0) FROM t_counts) + {r.BUCKETS}))::DOUBLE))::BIGINT AS gain
  FROM range({r.BUCKETS}) g(b) LEFT JOIN s_counts s ON s.bucket = b LEFT JOIN t_counts t ON t.bucket = b),
weights AS (
  SELECT row, sum(gain) AS weight FROM words JOIN coded USING (word) JOIN gains ON bucket = crc % {r.BUCKETS} GROUP BY row),
scored AS (
  SELECT row, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('{r.SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE
           + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM cut LEFT JOIN weights USING (row)),
ranked AS (
  SELECT *, CASE WHEN n_features >= {r.LEAST_WORDS}
                 THEN row_number() OVER (PARTITION BY n_features >= {r.LEAST_WORDS} ORDER BY score DESC, doc_id) END AS place,
         {r.DRAW_PERCENT} * count(*) FILTER (n_features >= {r.LEAST_WORDS}) OVER () // 100 AS most
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= most THEN place END AS rank FROM ranked"""


def _search_sql() -> str:
    terms = f"regexp_extract_all({LOWER_SQL}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH cut AS (SELECT row_number() OVER () AS row, doc_id, {terms} AS terms FROM documents),
totals AS (SELECT count(*) AS docs, sum(len(terms))::BIGINT AS length FROM cut WHERE len(terms) > 0),
held AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM cut) GROUP BY ALL),
weighed AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM held, totals GROUP BY term, docs),
asked AS (SELECT item, item_id, term, count(*) AS times
          FROM (SELECT row_number() OVER () AS item, item_id, unnest({terms}) AS term FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT item, item_id, row, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * len(terms) * docs) // length))))::BIGINT AS score
  FROM asked JOIN weighed USING (term) JOIN held USING (term) JOIN cut USING (row), totals
  GROUP BY item, item_id, row, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {lexical_search.K}"""


ORACLES: dict[str, str] = {
    "op12_target_resample": _resample_sql(),
    "op13_lexical_search": _search_sql(),
    "op1_decontamination": _leak_sql(),
    "op9_license_scan": _license_sql(),
    "op4_ngram_join": f"""
WITH RECURSIVE cut AS (SELECT doc_id, {WORDS_SQL.format(LOWER_SQL)} AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS gram
  FROM (SELECT *, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS k FROM cut WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
           FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT x, y FROM shared JOIN sizes s ON s.doc_id = x JOIN sizes t ON t.doc_id = y
          WHERE 100 * i >= 75 * (s.n + t.n - i)),
reach AS (SELECT doc_id AS x, doc_id AS root FROM sizes
          UNION SELECT y, root FROM reach JOIN links USING (x))
SELECT cut.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(least_root, cut.doc_id) AS component_id
FROM cut LEFT JOIN sizes USING (doc_id)
     LEFT JOIN (SELECT x, min(root) AS least_root FROM reach GROUP BY x) ON x = cut.doc_id""",
    "op5_line_frequency": r"""
WITH bare AS (
  SELECT page_id, lower(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]+)', 1), '')) AS host,
         regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
           '<!--.*?-->', ' ', 'gs'), '<(script|style)\b.*?</(script|style)>', ' ', 'gis'),
           '<(/?(p|br|li|h1|h2|h3|div|nav|ul|article|footer|title|tr))\b[^>]*>', chr(10), 'gi'),
           '<[^>]*>', '', 'g') AS body
  FROM pages),
cut AS (
  SELECT row_number() OVER () AS row, page_id, host,
         list_filter(list_transform(string_split(body, chr(10)), lambda x: trim(x, chr(32) || chr(9) || chr(13))),
                     lambda x: x <> '') AS lines
  FROM bare),
totals AS (SELECT host, count(*) AS pages FROM cut GROUP BY host),
seen AS (
  SELECT host, line, count(*) AS n
  FROM (SELECT DISTINCT row, host, unnest(lines) AS line FROM cut) GROUP BY host, line),
common AS (
  SELECT s.host, list(line) AS gone
  FROM seen s JOIN totals t ON s.host IS NOT DISTINCT FROM t.host
  WHERE n >= 2 AND n * 2 > pages GROUP BY s.host),
kept AS (
  SELECT c.page_id, c.host, c.lines,
         list_filter(c.lines, lambda x: NOT list_contains(coalesce(gone, []), x)) AS left_over
  FROM cut c LEFT JOIN common m ON c.host IS NOT DISTINCT FROM m.host)
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(left_over))::BIGINT AS n_dropped,
       array_to_string(left_over, chr(10)) AS text
FROM kept""",
    "op8_trie_dedup": f"""
WITH normal AS (SELECT doc_id, sha256({LOWER_SQL}) AS text_sha256, {LOWER_SQL} AS body FROM documents),
grouped AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY body)
SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, keep_id IS NULL) AS kept, text_sha256
FROM normal JOIN grouped USING (body)""",
    "op10_mixing": f"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS_SQL.format("coalesce(text, '')")})::BIGINT AS size FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_rows FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight,
         2.0::DOUBLE * source_size AS cap FROM per_source),
levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE
             - coalesce(sum(cap) OVER before, 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM weighed WINDOW before AS (ORDER BY cap / weight, source NULLS LAST
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, n_rows,
         coalesce(least(cap, weight * max(CASE WHEN level * weight < cap THEN level END) OVER ()), cap)
           AS target,
         ('0x' || substr(md5('0/' || coalesce(source, '/null')), 1, 7))::BIGINT::DOUBLE
           / 268435456.0::DOUBLE AS shift
  FROM levels),
placed AS (
  SELECT doc_id, size, t.*, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         coalesce(doc_id, -1) AS id,
         ((coalesce(doc_id, -1) % 1000003 + 1000003) % 1000003 * 7919) % 1000003 AS scatter,
         length(size::VARCHAR) * 10 + left(size::VARCHAR, 1)::INT AS class
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY class,
              scatter % ceil(class_rows / (floor(sqrt(all_rows)) + 1))::BIGINT, size, scatter, id) AS rank
  FROM (SELECT *, count(*) OVER (PARTITION BY source, class)::DOUBLE AS class_rows, count(*) OVER () AS all_rows FROM placed))
SELECT doc_id, size, source_size, target,
       ((floor(rank * rate + shift) - floor((rank - 1) * rate + shift))::BIGINT * size)::BIGINT AS taken
FROM ranked""",
}
