"""DuckDB twins of the queries that SQL can express, written from their definitions."""

from __future__ import annotations

from roost.llm.chat import ESCAPE, ChatTemplate
from roost.llm.mixing import LARGEST_STEP

WORDS = r"[x for x in string_split_regex(coalesce({text}, ''), '[\x20\x09-\x0D]+') if x <> '']"
LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def closure(nodes: str, links: str) -> str:
    """The smallest node that each node reaches over the links (a, b), given in both directions."""
    return f"""
reach AS (
    SELECT id, id AS low FROM ({nodes})
    UNION
    SELECT l.a, r.low FROM reach r JOIN ({links}) l ON l.b = r.id
),
lowest AS (SELECT id, min(low) AS low FROM reach GROUP BY id)"""


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def mixing_sql(seed: str, scale: float) -> str:
    return f"""
WITH RECURSIVE counted_chars AS (
    SELECT source, count(*)::DOUBLE AS n, sum(greatest(coalesce(n_chars, length(text), 0), 0))::DOUBLE AS size
    FROM documents GROUP BY source
),
sizes AS (SELECT source, CASE WHEN (SELECT sum(size) FROM counted_chars) > 0 THEN size ELSE n END AS size FROM counted_chars),
weighed AS (SELECT *, CASE WHEN size > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS weight FROM sizes),
rates AS (
    SELECT source, CASE WHEN size > 0
        THEN (SELECT sum(size) FROM sizes) * {scale}::DOUBLE * weight / (SELECT sum(weight) FROM weighed) / size
        ELSE {scale}::DOUBLE END AS rate
    FROM weighed
),
parts AS (SELECT *, greatest(1, ceil(rate / {LARGEST_STEP}::DOUBLE))::INT AS steps FROM rates),
terms AS (
    SELECT source, steps, rate / steps AS part, 0 AS k, exp(-(rate / steps)) AS p, exp(-(rate / steps)) AS cdf FROM parts
    UNION ALL
    SELECT source, steps, part, k + 1, p * part / (k + 1), cdf + p * part / (k + 1) FROM terms WHERE k < 59
),
draws AS (
    SELECT d.doc_id, d.source, i,
           ('0x' || substr(md5({quoted(seed)} || ':' || d.doc_id || ':' || i), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
    FROM documents d JOIN parts USING (source), unnest(range(1, steps + 1)) AS t(i)
),
counted AS (SELECT doc_id, count(*) AS n_copies FROM draws JOIN terms USING (source) WHERE u >= cdf GROUP BY doc_id)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, c.copy, n_copies,
       md5({quoted(seed)} || ':order:' || d.doc_id || ':' || c.copy) AS shuffle_key
FROM documents d JOIN counted USING (doc_id), unnest(range(0, n_copies)) AS c(copy)
"""


def chat_sql(template: ChatTemplate = ChatTemplate()) -> str:
    escaped = "text"
    for i, control in [("e", ESCAPE), *enumerate(template.controls())]:
        escaped = f"replace({escaped}, {quoted(control)}, {quoted(f'{ESCAPE}{i}')})"
    marker = "CASE role " + " ".join(f"WHEN {quoted(r)} THEN {len(m)}" for r, m in template.open.items()) + " END"
    order = "ORDER BY turn, role, text"
    return f"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
),
joined AS (
    SELECT conv_id, count(*) AS n_turns,
           string_agg(role || chr(10) || text || chr(10), '' {order}) AS told,
           coalesce(string_agg(text, '' {order}) FILTER (role = 'assistant'), '') AS lost,
           sum({marker} + length({escaped}) + {len(template.end)})::BIGINT AS formatted_chars,
           string_agg(role, ',' {order}) AS roles
    FROM rows GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(lost)::BIGINT AS loss_chars, sha256(lost) AS loss_sha256,
       formatted_chars, regexp_full_match(roles, '(system,)?user,assistant(,user,assistant)*') AS valid
FROM joined
"""


VECTORS = f"""
WITH RECURSIVE sound AS (
    SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x for x in embedding if x <> 0]) > 0
),
links AS (
    SELECT a.id AS a, b.id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.id <> b.id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98
),
{closure("SELECT vec_id AS id FROM embeddings", "SELECT a, b FROM links")}
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, low AS component_id, vec_id = low AS kept
FROM embeddings JOIN lowest ON vec_id = lowest.id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = vec_id
"""

JACCARD = f"""
WITH RECURSIVE split AS (SELECT doc_id, {WORDS.format(text=LOWER.format(text="text"))} AS w FROM documents),
grams AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS gram
    FROM split, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS t(i)
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id
    JOIN sizes sa ON sa.doc_id = a.doc_id JOIN sizes sb ON sb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, sa.n, sb.n
    HAVING 100 * count(*) >= 80 * (sa.n + sb.n - count(*))
),
{closure("SELECT doc_id AS id FROM documents", "SELECT a, b FROM links")}
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, low AS component_id
FROM documents d JOIN lowest ON d.doc_id = id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

WARC = """
WITH payloads AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY h, n) AS first FROM payloads)
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(h || '00', 5 * i // 4 + 1, 3))::INT >> (7 - 5 * i % 4)) & 31) + 1), 1) for i in range(0, 32)], '')
           AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM firsts
"""

# CRC-32 of a number's decimal digits, bit by bit.
CRC32 = """xor(list_reduce([4294967295::BIGINT] || [ascii(c)::BIGINT for c in string_split(doc_id::VARCHAR, '')],
    lambda c, b: list_reduce([xor(c, b)] || [0::BIGINT for k in range(8)],
        lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT)"""

RUNS = f"""
WITH split AS (
    SELECT doc_id, row_number() OVER () AS r, {WORDS.format(text="text")} AS w, {CRC32} AS h FROM documents
),
placed AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM split),
texts AS (
    SELECT doc_id, r, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN [w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END + 1] for i in range(n)] ELSE w END AS w
    FROM placed
),
words AS (SELECT r, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM texts),
often AS (SELECT * FROM words QUALIFY count(*) OVER (PARTITION BY r, word) >= 4),
equal AS (
    SELECT x.r, y.i - x.i AS q, x.i FROM often x JOIN often y
    ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM equal),
stretches AS (
    SELECT r, min(i) AS start, count(*) + q AS length, q AS period FROM islands
    GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)
),
runs AS (
    SELECT * FROM stretches s WHERE NOT EXISTS (
        FROM stretches t WHERE t.r = s.r AND t.period < s.period AND t.start <= s.start AND t.start + t.length >= s.start + s.length)
),
told AS (
    SELECT r, count(*) AS n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
           first({{'start': start, 'length': length, 'period': period}} ORDER BY length::DOUBLE / period DESC, start, period) AS best
    FROM runs GROUP BY r
),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start AS start, best.length AS length, best.period AS period,
       1000 * best.length // best.period AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
       sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM texts LEFT JOIN told USING (r) LEFT JOIN kept USING (r)
"""

TERMS = rf"regexp_extract_all({LOWER.format(text="coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

RANKED = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {TERMS} AS t FROM documents),
items AS (SELECT item_id, row_number() OVER () AS q, {TERMS} AS t FROM benchmark),
counts AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM docs) GROUP BY r, term),
totals AS (SELECT count(*) FILTER (len(t) > 0) AS n, sum(len(t))::BIGINT AS l FROM docs),
weights AS (
    SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM counts, totals GROUP BY term, n
),
lengths AS (SELECT r, doc_id, 75 + 25 * len(t) * n // l AS m FROM docs, totals WHERE len(t) > 0),
asked AS (SELECT q, term, count(*) AS times FROM (SELECT q, unnest(t) AS term FROM items) GROUP BY q, term),
scores AS (
    SELECT q, r, doc_id, sum(times * w * (1000000000 * tf // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (r) GROUP BY q, r, doc_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, place::INT AS rank, doc_id, score FROM ranked JOIN items USING (q) WHERE place <= 20
"""

PASSAGES = f"""
WITH split AS (SELECT doc_id, row_number() OVER () AS r, {WORDS.format(text="text")} AS w FROM documents),
windows AS (
    SELECT doc_id, r, i, md5(array_to_string(w[i : i + 49], ' ')) AS told FROM split, unnest(range(1, len(w) - 48)) AS t(i)
),
later AS (SELECT * FROM windows QUALIFY doc_id > min(doc_id) OVER (PARTITION BY told)),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS i FROM later),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM split),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (r, i) GROUP BY r),
counted AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM split LEFT JOIN counted USING (r) LEFT JOIN kept USING (r)
"""
