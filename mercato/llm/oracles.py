"""DuckDB SQL for the queries that SQL can express on whole tables."""

from .licenses import LEAST_SHARE, templates

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_TEMPLATES = ", ".join(
    f"({k}, '{label}', {base}, '{' '.join(text)}', {key_at}, '{' '.join(key)}')" for k, label, base, text, key_at, key in templates())

_K, _ROUNDS = 16, 3


def _cluster_sql() -> str:
    """Lloyd's rounds spelled out: centroids c0, c1, ... and the assignments a1, a2, ... between them."""
    steps = [f"""v AS (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR)) - 1 AS k, e AS c FROM v QUALIFY k < {_K})"""]
    nearest = """(SELECT r, vec_id, e, min({{'d': d, 'k': k}}) AS best FROM (
  SELECT r, vec_id, e, k, list_sum(list_transform(range(1, 65), lambda i: (e[i] - c[i]) * (e[i] - c[i])))::BIGINT AS d FROM v, c{n}) GROUP BY ALL)"""
    for n in range(_ROUNDS):
        steps.append(f"a{n} AS {nearest.format(n=n)}")
        steps.append(f"""s{n} AS (SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
  SELECT best.k AS k, i, sum(e[i])::BIGINT AS s, count(*) AS n FROM a{n}, unnest(range(1, 65)) AS t(i) GROUP BY ALL) GROUP BY k)""")
        steps.append(f"c{n + 1} AS (SELECT k, coalesce(s{n}.c, c{n}.c) AS c FROM c{n} LEFT JOIN s{n} USING (k))")
    steps.append(f"last AS {nearest.format(n=_ROUNDS)}")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, best.k::INTEGER AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.k))::BIGINT AS cluster_inertia, (sum(best.d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256 FROM last JOIN c{_ROUNDS} ON best.k = c{_ROUNDS}.k"""


ORACLES: dict[str, str] = {
    "op11_divergence": """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
tok AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM tok GROUP BY ALL HAVING count(DISTINCT r) >= 10),
grp AS (SELECT DISTINCT lang, source FROM d),
cnt AS (SELECT lang, source, term, count(*) AS n FROM tok GROUP BY ALL),
cell AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n FROM grp g JOIN kept k USING (lang) LEFT JOIN cnt c USING (lang, source, term)),
share AS (SELECT lang, source, term, n,
            (1 + 1000000000 * (n + 2)::HUGEINT // (sum(n) OVER g + 2 * count(*) OVER g))::BIGINT AS p,
            (1 + 1000000000 * (lang_n + 2)::HUGEINT // (sum(lang_n) OVER g + 2 * count(*) OVER g))::BIGINT AS q
          FROM cell WINDOW g AS (PARTITION BY lang, source)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(v.value, 0)::BIGINT AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
             FROM share x JOIN share y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) v
  ON v.lang = a.lang AND v.source = a.source AND v.item = b.source),
both_parts AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM share WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM both_parts QUALIFY part = 'pair' OR rank <= 10""",
    "op12_centroids": _cluster_sql(),
    "op13_chat": """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations UNION ALL
  SELECT -1, unnest([0, 1]), unnest(['user', 'assistant']), '<|im_end|><|im_start|>assistant ok'),
shown AS (SELECT *, len(regexp_extract_all(text, '<\\|im_end\\|>|<\\\\+\\|im_(start|end)\\|>')) > 0 AS clash,
            len(regexp_extract_all(text, '<\\\\*\\|im_(start|end)\\|>')) AS controls,
            length(replace(replace(role, chr(92), repeat(chr(92), 2)), chr(10), chr(92) || 'n')) AS escaped_role FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(24 + CASE WHEN contains(role, chr(10)) OR regexp_matches(role, '\\\\[n\\\\]') THEN escaped_role ELSE length(role) END
           + length(text) + CASE WHEN clash THEN controls ELSE 0 END)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id""",
    "op2_exact_dedup": """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, h AS text_sha256,
       (count(*) OVER w) > 1 AND (count(*) OVER w) * 1025 > (count(*) OVER ()) AS heavy
FROM d WINDOW w AS (PARTITION BY h)""",
    "op5_decontamination": f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
iw AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
        FROM iw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0),
starts AS (SELECT doc_id, i, s.size, array_to_string(list_slice(w, i, i + s.size - 1), ' ') AS win
           FROM dw, (SELECT DISTINCT size FROM win) s, unnest(range(1, greatest(len(w) - s.size + 2, 1))) AS r(i)),
hits AS (SELECT doc_id, i, size, item FROM starts JOIN win USING (size, win)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(i, i + size)) AS r(p) GROUP BY doc_id),
listed AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)""",
    "op10_lines": """
WITH split AS (SELECT doc_id, source, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, source, i, lines[i] AS raw, trim(lines[i], ' ') AS line FROM split, unnest(range(1, len(lines) + 1)) AS r(i)),
spread AS (SELECT line FROM line WHERE line <> '' GROUP BY line HAVING count(DISTINCT coalesce('+' || source, '-')) >= 5)
SELECT doc_id, count(*) FILTER (WHERE line <> '') AS n_lines, count(*) FILTER (WHERE line IN (FROM spread)) AS n_removed,
       length(coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (WHERE line NOT IN (FROM spread)), '')) AS n_chars,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (WHERE line NOT IN (FROM spread)), '')) AS kept_sha256
FROM line GROUP BY doc_id""",
    "op4_licenses": f"""
WITH dw AS (SELECT doc_id, {_WORDS} AS w FROM documents),
tpl AS (SELECT k, label, base, string_split(text, ' ') AS text, key_at, string_split(key, ' ') AS key
        FROM (VALUES {_TEMPLATES}) AS t(k, label, base, text, key_at, key)),
spot AS (SELECT doc_id, i, w[i] AS word FROM dw, unnest(range(1, len(w) + 1)) AS r(i) WHERE w[i] IN (SELECT key[1] FROM tpl)),
keyed AS (SELECT doc_id, i - 1 - key_at AS begin_at, label, base, text, w
          FROM spot JOIN tpl ON word = key[1] JOIN dw USING (doc_id) WHERE list_slice(w, i, i + len(key) - 1) = key),
stand AS (SELECT doc_id, begin_at, label, base,
            len(list_filter(range(1, len(text) + 1), lambda i: begin_at + i > 0 AND coalesce(w[begin_at + i] = text[i], false))) / len(text) AS share FROM keyed),
found AS (SELECT * FROM stand WHERE share >= {LEAST_SHARE}),
per AS (SELECT doc_id, count(*) FILTER (WHERE base) AS n_base, min(begin_at) FILTER (WHERE base) AS first_word, max(begin_at) FILTER (WHERE base) AS last_word,
          string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
          max(share) AS score FROM found GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM dw LEFT JOIN per USING (doc_id)""",
}
