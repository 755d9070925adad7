"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT doc_id, text,
         list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(text, chr(10)),
                     lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts),
windows AS (
  SELECT doc_id, i, words[i:i + 4] AS win
  FROM split, unnest(range(1, len(words) - 3)) AS r(i)),
again AS (
  SELECT doc_id, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM again, unnest(range(5)) AS r(k) GROUP BY doc_id),
measures AS (
  SELECT doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(text, '[^\p{Lu}]', '', 'g'))::BIGINT AS n_upper
  FROM split LEFT JOIN covered USING (doc_id)),
bits AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
           + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
           + CASE WHEN 4 * n_symbols > n_words THEN 4 ELSE 0 END
           + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
           + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END
           + CASE WHEN word_chars > 25 * n_words THEN 32 ELSE 0 END
           + CASE WHEN 2 * n_upper > word_chars THEN 64 ELSE 0 END)::BIGINT AS fail_bits
  FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, n_lines, n_upper, fail_bits
FROM bits
"""

OP2 = r"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                             lambda w: w <> '') AS words
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS win
  FROM split, unnest(range(1, len(words) - 18)) AS r(i)),
later AS (
  SELECT doc_id, i FROM windows
  QUALIFY row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1),
covered AS (
  SELECT DISTINCT doc_id, i + k AS place FROM later, unnest(range(20)) AS r(k)),
placed AS (
  SELECT doc_id, words[p] AS word, p FROM split, unnest(range(1, len(words) + 1)) AS r(p)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
  FROM placed ANTI JOIN covered ON placed.doc_id = covered.doc_id AND p = place
  GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (doc_id)
"""

# DuckDB has no CRC-32: the table is made from its polynomial, then folded over the bytes.
OP6 = r"""
WITH crc AS (
  SELECT list(list_reduce(range(8), lambda c, k:
           CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM range(256) AS r(b)),
sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
         xor(list_reduce(list_transform(
               regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
               lambda x: ('0x' || x)::BIGINT),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)
           AS text_crc32
  FROM documents, crc),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size
                            ROWS UNBOUNDED PRECEDING) - size AS before,
         sum(size) OVER () AS total
  FROM sized),
cut AS (SELECT *, ((2 * before + size) * 8 // (2 * total))::INT AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1
         AS slot,
       NULL::INT AS grown_shard
FROM cut
"""

OP7 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
told AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)
           AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                  FILTER (WHERE role = 'assistant'), '') AS learnt,
         sum(6 + length(replace(replace(replace(role, '\', '\b'), '<', '\l'), chr(10), '\n')) + 1
             + length(replace(replace(text, '\', '\b'), '<', '\l')) + 8)::BIGINT
           AS formatted_chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt)::BIGINT AS loss_chars,
       sha256(learnt) AS loss_sha256, formatted_chars
FROM told
"""

OP10 = r"""
WITH outcome AS (
  SELECT doc_id, (min(quality) = 0)::INT AS bad FROM labels GROUP BY doc_id),
split AS (
  SELECT page_id, bad,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages LEFT JOIN outcome ON page_id = doc_id),
hosts AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad,
         CASE WHEN regexp_matches(host, '(^|\.)example\.(com|net|org)$')
              THEN regexp_extract(host, 'example\.(com|net|org)$')
              ELSE regexp_extract(host, '[^.]*$') END AS suffix
  FROM split GROUP BY host),
named AS (
  SELECT *, CASE WHEN length(host) <= length(suffix) THEN host ELSE
            regexp_extract(left(host, length(host) - length(suffix) - 1), '[^.]*$')
            || '.' || suffix END AS domain
  FROM hosts),
domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM named GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
levels AS (
  SELECT 'host' AS level, n, bad FROM named UNION ALL
  SELECT 'domain', n, bad FROM domains UNION ALL SELECT 'suffix', n, bad FROM suffixes),
sums AS (
  SELECT level, sum(n)::DOUBLE AS n, sum(bad)::DOUBLE AS bad, count(*)::DOUBLE AS m,
         sum(n * n)::DOUBLE AS nn, sum(bad * bad / n)::DOUBLE AS pp
  FROM levels WHERE n > 0 GROUP BY level),
spread AS (
  SELECT level, bad / n AS p,
         (pp - n * (bad / n) * (bad / n) - (m - 1) * (bad / n) * (1 - bad / n))
           / nullif(n - nn / n, 0) / nullif((bad / n) * (1 - bad / n), 0) AS share
  FROM sums),
weights AS (
  SELECT level, p, greatest(4.0, least(1000.0, coalesce(
           CASE WHEN share <= 0 THEN 1000.0 ELSE (1 - share) / share END, 1000.0)))::DOUBLE AS w
  FROM spread),
w AS (
  SELECT coalesce(max(p) FILTER (WHERE level = 'suffix'), 0) AS p,
         coalesce(max(w) FILTER (WHERE level = 'suffix'), 1000) AS ws,
         coalesce(max(w) FILTER (WHERE level = 'domain'), 1000) AS wd,
         coalesce(max(w) FILTER (WHERE level = 'host'), 1000) AS wh
  FROM weights),
rated AS (
  SELECT h.host, h.n, wh, ((((p * ws + s.bad) / (ws + s.n)) * wd + d.bad) / (wd + d.n) * wh + h.bad)
           / (wh + h.n) AS mean
  FROM named h JOIN domains d USING (domain) JOIN suffixes s ON s.suffix = h.suffix, w),
bounds AS (
  SELECT host, greatest(0.0, mean - 1.645 * sqrt(mean * (1 - mean) / (wh + n + 1))) AS bound
  FROM rated),
fits AS (
  SELECT page_id, host, path, bound, (
    SELECT max_by({'rule': rule, 'action': action}, length(rh) * 1000 + length(rule)) FROM (VALUES
      ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
      ('www.example.com/en/', 'allow', 'www.example.com', '/en/'),
      ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/'))
      AS r(rule, action, rh, rp)
    WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)) AS best
  FROM split JOIN bounds USING (host))
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.action, CASE WHEN bound > 0.3 THEN 'block' ELSE 'allow' END) AS verdict,
       round(bound, 6) AS bad_bound
FROM fits
"""

OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words
  FROM documents, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS u(piece)),
totals AS (SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, words[i : i + k - 1] AS p, count(*) AS f
  FROM pieces, unnest(range(1, 6)) AS a(k), unnest(range(1, len(words) - k + 2)) AS b(i)
  GROUP BY ALL HAVING count(*) >= 100),
inside AS (
  SELECT lang, p, max(f) AS most
  FROM (SELECT lang, p[: len(p) - 1] AS p, f FROM f WHERE len(p) > 2
        UNION ALL SELECT lang, p[2 :], f FROM f WHERE len(p) > 2) GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.p, c.f AS a, n, x.f AS l, y.f AS r, k,
         (1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f) AS score
  FROM f c JOIN totals USING (lang), unnest(range(1, len(c.p))) AS u(k)
  JOIN f x ON x.lang = c.lang AND x.p = c.p[: k]
  JOIN f y ON y.lang = c.lang AND y.p = c.p[k + 1 :]),
scored AS (
  SELECT lang, p, a, n, min({'score': score, 'k': k, 'l': l, 'r': r}) AS cut
  FROM cuts GROUP BY lang, p, a, n),
ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, cut.l AS l, cut.r AS r, n,
         cut.score::BIGINT AS score
  FROM scored LEFT JOIN inside USING (lang, p) WHERE most IS NULL OR 100 * most < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM ranked QUALIFY rank <= 2000
"""


def _lloyd(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """Product quantisation with the rounds written out: b<k> is the codebook before round k, a<k>
    each part's nearest entry of it."""
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
  SELECT r, pos, min({{'d': (list_dot_product(p.part, p.part) + list_dot_product(b.part, b.part)
                             - 2 * list_dot_product(p.part, b.part))::BIGINT,
                       'e': e}}) AS best, any_value(p.part) AS part
  FROM p JOIN b{k} b USING (pos) GROUP BY r, pos)""")
        if k < rounds:
            steps.append(f"""
b{k + 1} AS MATERIALIZED (
  SELECT pos, e, coalesce(m.part, b{k}.part) AS part
  FROM b{k} LEFT JOIN (
    SELECT pos, e, list(c ORDER BY i) AS part
    FROM (SELECT pos, best.e AS e, i, floor(sum(part[i]) / count(*)) AS c
          FROM a{k}, unnest(range(1, len(part) + 1)) AS u(i) GROUP BY ALL)
    GROUP BY pos, e) m USING (pos, e))""")
    return f"""
WITH fine AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r FROM fine),
p AS MATERIALIZED (
  SELECT r, pos, v[pos * len(v) // {parts} + 1 : (pos + 1) * len(v) // {parts}] AS part
  FROM numbered, unnest(range({parts})) AS u(pos)),
b0 AS (SELECT pos, r - 1 AS e, part FROM p WHERE r <= {entries}),
{",".join(steps)},
coded AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY pos) AS code,
         sum(best.d)::BIGINT AS error
  FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY pos, e, i))
        FROM (SELECT pos, e, i, part[i] AS c
              FROM b{rounds}, unnest(range(1, len(part) + 1)) AS u(i))) AS codebooks_sha256
FROM numbered JOIN coded USING (r)
"""


OP13 = _lloyd()

ORACLES = {
    "op1_quality_rules": OP1,
    "op2_substring_dedup": OP2,
    "op6_sharding": OP6,
    "op7_chat_formatting": OP7,
    "op10_url_filters": OP10,
    "op12_collocations": OP12,
    "op13_vector_codes": OP13,
}
