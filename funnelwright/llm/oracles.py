"""DuckDB SQL for the rows of the registered queries, where SQL can express them.

It defines results by comparing everything, not by the operators' methods. Language, quality, licences and personal data
come from trained models or from procedures over passages; their tests compare with brute force instead.
"""

from __future__ import annotations

from funnelwright.llm.decontam import EQUAL, UNSPACED, WINDOW
from funnelwright.llm.decontam import LEAST_WORDS as LEAST_ITEM_WORDS
from funnelwright.llm.embeddings import COSINE
from funnelwright.llm.mixing import MOST_EPOCHS
from funnelwright.llm.neardup import SIMILAR
from funnelwright.llm.resampling import BUCKETS, LEAST_WORDS, PERCENT, SEED
from funnelwright.llm.sharding import OVERHEAD, SHARDS
from funnelwright.llm.spelling import DROP_EVERY, LEAST_COUNT, LEAST_LENGTH, RATIO, RUN

_WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

MIX = rf"""
WITH worded AS (
  SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
         md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', coalesce(text, ''))) AS print
  FROM documents
), sized AS (
  SELECT doc_id, source, CAST(len(words) AS BIGINT) AS size, print,
         -ln((CAST('0x' || substr(print, 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE))
         / CASE WHEN len(words) > 0
                THEN CAST(0.25 AS DOUBLE) + CAST(0.75 AS DOUBLE) * len(list_distinct(words)) / len(words)
                ELSE CAST(0.25 AS DOUBLE) END AS key
  FROM worded
), sources AS (
  SELECT source, sum(size) AS source_size, CAST(sum(size) AS DOUBLE) * {MOST_EPOCHS} AS cap,
         [CAST(5 AS DOUBLE), 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source
), leveled AS (
  SELECT *, cap / weight AS ratio,
         (CAST(sum(source_size) OVER () AS DOUBLE)
          - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
), chosen AS (
  SELECT level FROM leveled WHERE ratio >= level ORDER BY ratio, source NULLS LAST LIMIT 1
), goals AS (
  SELECT source, CAST(source_size AS BIGINT) AS source_size, coalesce(least(cap, (SELECT level FROM chosen) * weight), cap) AS target
  FROM leveled
), turns AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM goals
), units AS (
  SELECT source, key, print, sum(size) AS size FROM sized GROUP BY source, key, print
), taken AS (
  SELECT u.source, u.key, u.print,
         coalesce(sum(u.size) OVER (PARTITION BY u.source ORDER BY u.key, u.print ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         + u.size / CAST(2 AS DOUBLE) <= t.target - t.epochs * t.source_size AS extra
  FROM units u JOIN turns t ON u.source IS NOT DISTINCT FROM t.source
)
SELECT s.doc_id, s.size, t.source_size, t.target, s.size * (t.epochs + CAST(k.extra AS BIGINT)) AS taken, s.source
FROM sized s JOIN turns t ON s.source IS NOT DISTINCT FROM t.source
JOIN taken k ON k.source IS NOT DISTINCT FROM s.source AND k.key = s.key AND k.print = s.print
"""


def _tokens(text: str) -> str:
    """Characters of scripts without spaces are words of their own."""
    return f"regexp_extract_all(regexp_replace(lower(coalesce({text}, '')), '([{UNSPACED}])', ' \\1 ', 'g'), '[\\p{{L}}\\p{{N}}]+')"


# All alignments: every pair of equal words of a document and an item is one of a shift between the two.
LEAKS = f"""
WITH items AS MATERIALIZED (
  SELECT row_number() OVER () AS item_row, item_id, item, least(len(item), {WINDOW}) AS compared
  FROM (SELECT DISTINCT item_id, {_tokens('text')} AS item FROM benchmark) WHERE len(item) >= {LEAST_ITEM_WORDS}
), item_words AS (
  SELECT item_row, compared, unnest(item) AS word, unnest(range(len(item))) AS place FROM items
), docs AS MATERIALIZED (
  SELECT row_number() OVER () AS doc_row, doc_id, {_tokens('text')} AS words FROM documents
), doc_words AS (
  SELECT doc_row, unnest(words) AS word, unnest(range(len(words))) AS spot FROM docs
), aligned AS (
  SELECT doc_row, item_row, spot - place AS shift, list(place) AS places FROM doc_words JOIN item_words USING (word)
  GROUP BY doc_row, item_row, spot - place HAVING count(*) * 100 >= any_value(compared) * {EQUAL}
), windows AS (
  SELECT doc_row, item_id, compared, shift, places, unnest(range(len(item) - compared + 1)) AS first FROM aligned JOIN items USING (item_row)
), verified AS (
  SELECT doc_row, item_id, compared, shift + first AS doc_start,
         len(list_filter(places, lambda p: p >= first AND p < first + compared)) AS matched
  FROM windows
)
SELECT doc_id, item_id, CAST(matched AS INTEGER) AS matched, CAST(compared AS INTEGER) AS compared, CAST(doc_start AS INTEGER) AS doc_start
FROM verified JOIN docs USING (doc_row) WHERE matched * 100 >= compared * {EQUAL}
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, doc_start, compared DESC) = 1
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_WORD}') AS words FROM documents
), shingled AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(words) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(words) = 1 THEN words
    ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS shingle
  FROM worded
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingled GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS one, b.doc_id AS other
  FROM shingled a JOIN shingled b ON a.shingle = b.shingle AND a.doc_id != b.doc_id
  JOIN sizes m ON m.doc_id = a.doc_id JOIN sizes n ON n.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= {SIMILAR} * (any_value(m.n) + any_value(n.n) - count(*))
), reach AS (
  SELECT doc_id AS start, doc_id AS spot FROM documents
  UNION SELECT r.start, l.other FROM reach r JOIN links l ON l.one = r.spot
), components AS (
  SELECT start, min(spot) AS component_id FROM reach GROUP BY start
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN components c ON c.start = d.doc_id
"""

LINES = f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), numbered AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM split
), keyed AS (
  SELECT *, translate(trim(line, {_SPACE}), '{_UPPER}', '{_UPPER.lower()}') AS key FROM numbered
), repeated AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT k.*, r.keeper IS NOT NULL AND r.keeper != k.doc_id AS dropped FROM keyed k LEFT JOIN repeated r ON r.key = k.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

# Checksums by the definition of CRC-32: a table of the remainders of all bytes, then a step per byte of the text.
SHARDS_SQL = f"""
WITH bits AS (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda r, i:
    xor(r >> 1, (r & 1) * 3988292384), n)) AS remainders
), checked AS (
  SELECT doc_id, list_reduce(
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda pair: CAST('0x' || pair AS BIGINT)),
    lambda crc, byte: xor(crc >> 8, remainders[xor(crc & 255, byte) + 1]), CAST(4294967295 AS BIGINT)) AS crc
  FROM documents, bits
), sized AS (
  SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) AS BIGINT) + {OVERHEAD} AS size,
         CAST('0x' || substr(md5(coalesce(text, '')), 1, 15) AS BIGINT) AS high,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS low
  FROM documents
), summed AS (
  SELECT *, coalesce(sum(size) OVER (ORDER BY high, low ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(size) OVER () AS total
  FROM sized
), placed AS (
  SELECT *, CAST(before * {SHARDS} // total AS INTEGER) AS shard FROM summed
)
SELECT doc_id, size, xor(crc, 4294967295) AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY high, low) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM placed JOIN checked USING (doc_id)
"""

VECTORS = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x != 0)) > 0
), links AS (
  SELECT a.vec_id AS one, b.vec_id AS other FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id != b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= {COSINE}
), reach AS (
  SELECT vec_id AS start, vec_id AS spot FROM embeddings
  UNION SELECT r.start, l.other FROM reach r JOIN links l ON l.one = r.spot
), components AS (
  SELECT start, min(spot) AS component_id FROM reach GROUP BY start
), degrees AS (
  SELECT one, count(*) AS n FROM links GROUP BY one
)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN components c ON c.start = e.vec_id LEFT JOIN degrees d ON d.one = e.vec_id
"""


_REMAINDERS = """
bits AS MATERIALIZED (
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda r, i:
    xor(r >> 1, (r & 1) * 3988292384), n)) AS remainders
)"""


def _crc32(text: str) -> str:
    return f"""xor(CAST(4294967295 AS BIGINT), list_reduce(
    list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda pair: CAST('0x' || pair AS BIGINT)),
    lambda crc, byte: xor(crc >> 8, remainders[xor(crc & 255, byte) + 1]), CAST(4294967295 AS BIGINT)))"""


RESAMPLING = f"""
WITH {_REMAINDERS}, worded AS (
  SELECT false AS wanted, doc_id, row_number() OVER () AS row, text FROM documents
  UNION ALL SELECT true, NULL, row_number() OVER (), text FROM benchmark
), listed AS (
  SELECT wanted, doc_id, row, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM worded
), features AS (
  SELECT wanted, row, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature
  FROM listed
), counted AS (
  SELECT feature, count(*) FILTER (NOT wanted) AS s, count(*) FILTER (wanted) AS t FROM features GROUP BY feature
), hashed AS MATERIALIZED (
  SELECT feature, s, t, {_crc32('feature')} % {BUCKETS} AS bucket FROM counted, bits
), buckets AS (
  SELECT bucket, sum(s) AS s, sum(t) AS t FROM hashed GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(
           CAST((t + 1) * ((SELECT sum(s) FROM buckets) + {BUCKETS}) AS DOUBLE)
           / CAST((s + 1) * ((SELECT sum(t) FROM buckets) + {BUCKETS}) AS DOUBLE))) AS BIGINT) AS gain
  FROM buckets
), weights AS (
  SELECT row, count(*) AS n, sum(gain) AS gained FROM features JOIN hashed USING (feature) JOIN gains USING (bucket)
  WHERE NOT wanted GROUP BY row
), scored AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n, 0) AS n_features,
         CAST(coalesce((gained - ((gained % n) + n) % n) // n, 0) AS BIGINT) AS weight,
         CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256(concat('{SEED}:', doc_id)), 1, 8) AS BIGINT) + CAST(0.5 AS DOUBLE))
                                   / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS luck
  FROM listed LEFT JOIN weights USING (row) WHERE NOT wanted
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {LEAST_WORDS} ORDER BY weight + luck DESC, doc_id) AS place,
         count(*) FILTER (n_words >= {LEAST_WORDS}) OVER () AS able
  FROM scored
)
SELECT doc_id, n_features, weight, weight + luck AS score,
       CASE WHEN n_words >= {LEAST_WORDS} AND place <= {PERCENT} * able // 100 THEN place END AS rank
FROM ranked
"""

# Two words are near if they are equal once one character of either is masked or of one is left out.
SPELLING = f"""
WITH RECURSIVE {_REMAINDERS}, runs AS (
  SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[{RUN}]+')) AS run FROM documents
), lowered AS (
  SELECT concat(doc_id, ':', translate(run, '{_UPPER}', '{_UPPER.lower()}')) AS printed,
         translate(run, '{_UPPER}', '{_UPPER.lower()}') AS run, count(*) AS n
  FROM runs WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL
), checked AS (
  SELECT run, n, {_crc32('printed')} AS crc FROM lowered, bits
), spelled AS (
  SELECT CASE WHEN crc % {DROP_EVERY} = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, n
  FROM checked
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
), cut AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS spot FROM words
), masked AS (
  SELECT word, substr(word, 1, spot - 1) || '*' || substr(word, spot + 1) AS mask,
         substr(word, 1, spot - 1) || substr(word, spot + 1) AS shorter
  FROM cut
), near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM masked a JOIN masked b ON a.mask = b.mask AND a.word != b.word
  UNION SELECT m.word, w.word FROM masked m JOIN words w ON w.word = m.shorter
  UNION SELECT w.word, m.word FROM masked m JOIN words w ON w.word = m.shorter
), best AS (
  SELECT near.word, count(*) AS n_near, arg_min(other, (-words.n, other)) AS form, max(words.n) AS form_n
  FROM near JOIN words ON words.word = near.other GROUP BY near.word
), judged AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {RATIO} * n THEN form END AS form,
         CASE WHEN form_n >= {RATIO} * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), paths AS (
  SELECT word, word AS spot FROM judged
  UNION ALL SELECT p.word, j.form FROM paths p JOIN judged j ON j.word = p.spot WHERE j.form IS NOT NULL
), ends AS (
  SELECT p.word, p.spot AS root FROM paths p JOIN judged j ON j.word = p.spot WHERE j.form IS NULL
)
SELECT word, n, n_near, form, form_n, root FROM judged JOIN ends USING (word)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix": MIX,
        "op4_leaks": LEAKS,
        "op5_near_duplicates": NEAR_DUPLICATES,
        "op6_line_dedup": LINES,
        "op8_shards": SHARDS_SQL,
        "op9_near_vectors": VECTORS,
        "op11_resampling": RESAMPLING,
        "op12_spelling": SPELLING,
    }
