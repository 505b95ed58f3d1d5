"""DuckDB SQL of the training-data queries that SQL can express.

Without SQL: main text of pages (a parser), BPE (ids, and the shards they are written to), paragraph banding (its candidates are random by
design) and the pipeline, which contains BPE. tests/llm checks those by brute force.
"""

from surveil.llm import mixing, quality
from surveil.llm.chat import PROBE

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"


def _components(nodes: str, links: str) -> str:
    """CTEs ``reach`` and ``comp``: the smallest node each node reaches over symmetric ``links`` (a, b)."""
    return f"""
    reach AS (SELECT id AS a, id AS b FROM {nodes} UNION SELECT r.a, l.b FROM reach r JOIN {links} l ON l.a = r.b),
    comp AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)"""


OP1 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{PROBE}' UNION ALL SELECT -7, 1, 'assistant', '{PROBE}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(15 + length(regexp_replace(role, '[\\\\#<:]', '..', 'g')) + length(regexp_replace(text, '[\\\\#<]', '..', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""

OP2 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS m
      FROM (SELECT doc_id, h, unnest(range(0, greatest(len(h) // 2 - 99, 0))) AS p FROM d)),
f AS (SELECT m, min({'d': doc_id, 'p': p}) AS first FROM w GROUP BY m HAVING count(*) > 1),
gone AS (SELECT doc_id, p FROM w JOIN f USING (m) WHERE {'d': doc_id, 'p': p} > first),
marked AS (SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 1 ELSE 0 END AS new FROM gone),
numbered AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked),
spans AS (SELECT doc_id, min(p) AS s, max(p) + 100 AS e FROM numbered GROUP BY doc_id, run),
pieces AS (SELECT doc_id, s, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS before FROM spans),
cut AS (SELECT doc_id, count(*) AS n, sum(e - s) AS removed, max(e) AS tail,
        string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) AS head
        FROM pieces JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)"""

OP3 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
s AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS h FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM s)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM r"""

OP4 = rf"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len({WORDS.format('text')}), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1]::DOUBLE AS weight, source_size * {mixing.MOST} AS cap FROM s),
o AS (SELECT *, coalesce(sum(cap) OVER fill, 0)::DOUBLE AS taken_up, coalesce(sum(weight) OVER rest, 0)::DOUBLE AS free, row_number() OVER by_room AS k
      FROM w WINDOW by_room AS (ORDER BY cap / weight, source NULLS LAST),
      fill AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      rest AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
budget AS (SELECT {mixing.BUDGET} * CAST(sum(source_size) AS DOUBLE) AS words FROM s),
stop AS (SELECT min_by({{'taken_up': taken_up, 'free': free, 'k': k}}, k) AS x FROM o, budget WHERE (words - taken_up) * weight / free <= cap),
t AS (SELECT source, source_size, CASE WHEN k < x.k THEN cap ELSE (words - x.taken_up) * weight / x.free END AS target FROM o, stop, budget),
r AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
        row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id NULLS FIRST) AS rank,
        CAST('0x' || substr(md5('{mixing.SEED}' || coalesce(':' || d.source, '/')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  CAST(floor(rank * rate + u) - floor((rank - 1) * rate + u) AS BIGINT) * size AS taken FROM r"""

OP6 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id AS id, {WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
sets AS (SELECT id, list_distinct(CASE WHEN coalesce(len(w), 0) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
           ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM d),
n AS (SELECT id, CAST(len(s) AS BIGINT) AS n_shingles FROM sets),
e AS (SELECT id, hash(x) AS x FROM (SELECT id, unnest(s) AS x FROM sets)),
pairs AS (SELECT e.id AS a, f.id AS b, count(*) AS common FROM e JOIN e f ON e.x = f.x AND e.id <> f.id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n p ON p.id = a JOIN n q ON q.id = b WHERE 100 * common >= 75 * (p.n_shingles + q.n_shingles - common)),
{_components('n', 'links')}
SELECT id AS doc_id, n_shingles, component_id, id = component_id AS kept FROM n JOIN comp USING (id)"""

_PHRASES = "|".join(quality.BOILERPLATE)
OP7 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
l AS (SELECT doc_id, i, line, {WORDS.format('line')} AS lw FROM
      (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i, unnest(string_split(text, chr(10))) AS line FROM d)),
f AS (SELECT doc_id, i, line, len(lw) AS n, len(regexp_extract_all(line, '[{quality.SEPARATORS}]')) AS bars,
      len(regexp_extract_all(line, '!')) AS shouts, len(regexp_extract_all(line, '[#*$%&|<>]')) AS marks,
      regexp_matches(line, '[{quality.SENTENCE_MARKS}]') AS sentence, regexp_matches(line, '(?i){_PHRASES}') AS stock FROM l WHERE len(lw) > 0),
g AS (SELECT *, (bars >= 3 AND 4 * bars >= n) OR (n >= 5 AND (NOT sentence OR 2 * shouts > n OR 2 * marks > n)) OR stock AS failed,
      row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS again FROM f),
lines AS (SELECT doc_id, count_if(again) AS n_dup_lines, count_if(failed) AS n_failed_lines, coalesce(sum(n) FILTER (failed), 0) AS failed_words FROM g GROUP BY doc_id),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT doc_id, run FROM x GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM x JOIN twice USING (doc_id, run), range(8) t(k) GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
      CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
      coalesce(n_repeat_words, 0) AS n_repeat_words, CAST(coalesce(n_failed_lines, 0) AS BIGINT) AS n_failed_lines, CAST(coalesce(failed_words, 0) AS BIGINT) AS failed_words
      FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
b AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND 100 * failed_words <= {quality.MAX_LOSS_PERCENT} * n_words AS kept FROM b"""

OP8 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
u AS (SELECT id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v
      WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT p.id AS a, q.id AS b FROM u p JOIN u q ON p.id <> q.id AND list_dot_product(p.e, q.e) >= 0.95),
{_components('v', 'links')}
SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = id) AS n_links, component_id, id = component_id AS kept FROM v JOIN comp USING (id)"""

OP12 = rf"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS txt,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({{'role': role, 'txt': txt}} ORDER BY k) AS turns FROM t GROUP BY conv_id),
s AS (SELECT conv_id, turns, conv_id - conv_id % 20 AS base,
        xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
          lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 4 AS h FROM c),
r AS (SELECT s.conv_id, list_concat(coalesce(b.turns, [])[1:s.h], s.turns[s.h + 1:]) AS turns FROM s LEFT JOIN c b ON b.conv_id = s.base),
p AS (SELECT conv_id, d AS depth, turns[1:d] AS pre, len(turns) = d AS ends, CASE WHEN d > 0 THEN turns[1:d - 1] END AS up
      FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM r)),
n AS (SELECT pre, any_value(up) AS up, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY pre),
m AS (SELECT n.*, (SELECT count(*) FROM n k WHERE k.up = n.pre) AS n_children,
        CASE WHEN depth > 0 THEN (n_convs - 1) * len({WORDS.format('pre[depth].txt')}) ELSE 0 END AS own FROM n),
a AS (SELECT m.pre[1:d] AS pre, sum(own) AS saved, count_if(n_children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM m) m GROUP BY 1)
SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, a.n_leaves, a.saved::BIGINT AS saved_tokens, m.ends_sha256
FROM m JOIN a ON a.pre = m.pre LEFT JOIN m u ON u.pre = m.up"""

OP13 = rf"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
        string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]') AS pieces FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM (SELECT lang, unnest(pieces) AS piece FROM d)),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 4) t(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, any_value(w1) AS w1, any_value(w2) AS w2, CASE WHEN k = 3 THEN any_value(w3) END AS w3, count(*) AS a FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND a >= 10),
cut AS (SELECT c.lang, c.phrase, c.k, 1 AS first_words, c.a, l.a AS l, r.a AS r FROM c
          JOIN f l ON l.lang = c.lang AND l.k = 1 AND l.phrase = c.w1
          JOIN f r ON r.lang = c.lang AND r.k = c.k - 1 AND r.phrase = CASE WHEN c.k = 2 THEN c.w2 ELSE c.w2 || ' ' || c.w3 END
        UNION ALL SELECT c.lang, c.phrase, c.k, 2, c.a, l.a, r.a FROM c
          JOIN f l ON c.k = 3 AND l.lang = c.lang AND l.k = 2 AND l.phrase = c.w1 || ' ' || c.w2
          JOIN f r ON r.lang = c.lang AND r.k = 1 AND r.phrase = c.w3),
best AS (SELECT lang, phrase, k, a, min({{'score': CAST(1000000::HUGEINT * a * a // (l::HUGEINT * r) AS BIGINT), 'first_words': first_words, 'l': l, 'r': r}}) AS x FROM cut GROUP BY ALL),
gone AS (SELECT b.lang, b.phrase FROM c b JOIN c t ON t.lang = b.lang AND b.k = 2 AND t.k = 3
         AND (b.phrase = t.w1 || ' ' || t.w2 OR b.phrase = t.w2 || ' ' || t.w3) AND 100 * t.a >= 50 * b.a),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY x.score DESC, a DESC, phrase) AS rank, phrase, a, x.l AS l, x.r AS r, x.score AS score
           FROM best WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM gone))
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""

ORACLES: dict[str, str] = {
    "op1_chat": OP1, "op2_suffix": OP2, "op3_warc": OP3, "op4_mixing": OP4, "op6_minhash": OP6, "op7_quality": OP7, "op8_embeddings": OP8,
    "op12_trie": OP12, "op13_phrases": OP13,
}
