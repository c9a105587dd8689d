"""The same queries as DuckDB SQL, where SQL can state them."""

from __future__ import annotations

from millrace.llm import licenses, quality_rules

SPACED, ALNUM = r"'[^\x20\x09-\x0D]+'", r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
TERMS = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), {pattern})"


def _rows(pattern: str, lower: bool = True) -> str:
    """CTE ``d`` of the documents with a row number ``r`` and their words ``w``."""
    text = _lower("text") if lower else "text"
    return f"d AS (SELECT row_number() OVER () AS r, doc_id, text, {_words(text, pattern)} AS w FROM documents)"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def license_scan() -> str:
    notices = ", ".join(f"({_text(name)}, {_text(text)})" for name, text in licenses.TEMPLATES)
    shingles = "list_distinct(list_transform(generate_series(1, greatest(len({w}) - 4, 1)), lambda i: array_to_string({w}[i:i+4], ' ')))"
    return f"""
WITH {_rows(ALNUM)},
worded AS (SELECT DISTINCT license, {_words(_lower('text'), ALNUM)} AS tw FROM (VALUES {notices}) t(license, text)),
t AS (SELECT license, array_to_string(tw, ' ') AS template, greatest(4, pow(2, ceil(log2(len(tw) - 1))))::BIGINT AS step,
  {shingles.format(w='tw')} AS goal FROM worded),
starts AS (SELECT r, doc_id, step, w, unnest(generate_series(0, len(w) - 1, step)) AS s
  FROM d, (SELECT DISTINCT step FROM t) WHERE len(w) > 0),
cut AS (SELECT r, doc_id, step, s, w[s + 1 : s + 2 * step] AS v FROM starts),
held AS (SELECT r, doc_id, step, s, {shingles.format(w='v')} AS have FROM cut WHERE s = 0 OR len(v) >= 5),
found AS (SELECT r, doc_id, license, template, len(goal) AS goals, len(list_intersect(have, goal)) AS n, s
  FROM held JOIN t USING (step) WHERE list_has_any(have, goal))
SELECT any_value(doc_id) AS doc_id, license, template, any_value(goals)::BIGINT AS n_shingles, max(n)::BIGINT AS n_found,
  (-max(n * 1000000000 - s) + max(n) * 1000000000)::BIGINT AS word_start, count(*) AS n_windows
FROM found WHERE 4 * n >= 3 * goals GROUP BY r, license, template
"""


def decontamination() -> str:
    return f"""
WITH {_rows(ALNUM)},
items AS (SELECT item_id, {_words(_lower('text'), ALNUM)} AS iw FROM benchmark),
sized AS (SELECT item_id, iw, least(len(iw), 13) AS n FROM items WHERE len(iw) > 0),
wanted AS (SELECT DISTINCT item_id, n, array_to_string(iw[i:i+n-1], ' ') AS win
  FROM (SELECT *, unnest(generate_series(1, len(iw) - n + 1)) AS i FROM sized)),
here AS (SELECT r, n, i, array_to_string(w[i:i+n-1], ' ') AS win
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM wanted))),
hits AS (SELECT r, i, n, item_id FROM here JOIN wanted USING (n, win)),
cover AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cover USING (r) LEFT JOIN named USING (r)
"""


def url_filter() -> str:
    return r"""
WITH rules(action, rule_host, rule_path) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
  ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
parts AS (
  SELECT row_number() OVER () AS r, page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
fits AS (
  SELECT r, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(action, length(rule_host || rule_path)) AS action
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY r)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM parts LEFT JOIN fits USING (r)
"""


def ngram_jaccard() -> str:
    return f"""
WITH RECURSIVE {_rows(SPACED)},
sh AS (SELECT r, unnest(list_distinct(list_transform(generate_series(1, greatest(len(w) - 4, 1)),
  lambda i: array_to_string(w[i:i+4], ' ')))) AS s FROM d WHERE len(w) > 0),
sizes AS (SELECT r, count(*) AS n FROM sh GROUP BY r),
pairs AS (SELECT a.r AS x, b.r AS y, count(*) AS same FROM sh a JOIN sh b ON a.s = b.s AND a.r <> b.r GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN sizes a ON x = a.r JOIN sizes b ON y = b.r WHERE 100 * same >= 75 * (a.n + b.n - same)),
reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
least AS (SELECT x, min(doc_id) AS component_id FROM reach JOIN d ON y = r GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM d JOIN least ON d.r = x LEFT JOIN sizes ON sizes.r = d.r
"""


def substring_dedup() -> str:
    return f"""
WITH {_rows(SPACED, lower=False)},
here AS (SELECT r, doc_id, i, array_to_string(w[i:i+12], ' ') AS win
  FROM (SELECT *, unnest(generate_series(1, len(w) - 12)) AS i FROM d)),
firsts AS (SELECT win, min(doc_id) AS first FROM here GROUP BY win),
gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + 12)) AS p FROM here JOIN firsts USING (win) WHERE first < doc_id),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


def quality() -> str:
    rules = quality_rules.Rules()
    phrases = _text(quality_rules.BOILERPLATE.pattern)
    ends = _text(quality_rules.SENTENCE_END.pattern.removesuffix("$") + r"\s*$")
    return f"""
WITH {_rows(SPACED, lower=False)},
here AS (SELECT r, i, array_to_string(w[i:i+7], ' ') AS win
  FROM (SELECT *, unnest(generate_series(1, len(w) - 7)) AS i FROM d)),
again AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(generate_series(i, i + 7)) AS p
  FROM (SELECT *, count(*) OVER (PARTITION BY r, win) AS c FROM here) WHERE c > 1) GROUP BY r),
cut AS (SELECT r, string_split(coalesce(text, ''), chr(10)) AS l FROM d),
lines AS (SELECT r, unnest(l) AS line, generate_subscripts(l, 1) AS no FROM cut),
worded AS (SELECT *, len(lw) AS n, row_number() OVER (PARTITION BY r, line ORDER BY no) > 1 AS seen
  FROM (SELECT *, {_words('line', SPACED)} AS lw FROM lines) WHERE len(lw) > 0),
judged AS (SELECT r, seen, list_sum(list_transform(lw, lambda x: length(x))) AS chars,
  seen OR len(list_filter(lw, lambda x: x = '|')) >= greatest(2, {rules.bars} * n)
  OR len(regexp_extract_all(line, '[#*$%&]{{3}}')) > {rules.noise} * n
  OR (n >= 4 AND len(list_filter(generate_series(1, n - 1), lambda i: lw[i] = lw[i + 1])) > {rules.repeats} * n)
  OR regexp_matches(line, {phrases}) OR (n < {rules.fragment_words} AND NOT regexp_matches(line, {ends})) AS fails
  FROM worded),
left_over AS (SELECT r, sum(chars) AS total, sum(chars) FILTER (fails) AS lost, count(*) FILTER (seen) AS dups FROM judged GROUP BY r),
base AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(total, 0)::BIGINT AS word_chars,
  len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(dups, 0)::BIGINT AS n_dup_lines,
  coalesce(n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN again USING (r) LEFT JOIN left_over USING (r)),
failed AS (SELECT *, n_words < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_percent} * n_words AS base_failed FROM base)
SELECT * EXCLUDE (lost), NOT base_failed AND lost <= {rules.lost} * word_chars AS kept FROM failed
"""


def lm_scoring() -> str:
    return f"""
WITH {_rows(SPACED)},
sizes AS (SELECT sum(len(w))::BIGINT AS total FROM d),
grams AS (SELECT r, n, i, array_to_string(w[i:i+n-1], ' ') AS g
  FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (VALUES (1), (2), (3)) o(n))),
own AS (SELECT r, n, g, count(*) AS c FROM grams GROUP BY ALL),
overall AS (SELECT n, g, sum(c) AS c FROM own GROUP BY ALL),
elsewhere AS (SELECT grams.r, grams.n, i, overall.c - own.c AS c
  FROM grams JOIN own ON grams.r = own.r AND grams.n = own.n AND grams.g = own.g
  JOIN overall ON grams.n = overall.n AND grams.g = overall.g),
ended AS (SELECT a.r, a.i + a.n - 1 AS p, a.n, a.c, CASE WHEN a.n = 1 THEN total - len(w) ELSE b.c END AS base, least(3, a.i + a.n - 1) AS most
  FROM elsewhere a JOIN d ON d.r = a.r CROSS JOIN sizes LEFT JOIN elsewhere b ON a.n > 1 AND b.r = a.r AND b.n = a.n - 1 AND b.i = a.i),
best AS (SELECT r, p, any_value(most) AS most, coalesce(max(n) FILTER (c > 0), 0) AS n, arg_max(c, n) FILTER (c > 0) AS c,
  arg_max(base, n) FILTER (c > 0) AS base FROM ended GROUP BY r, p),
scored AS (SELECT r, n, (most - greatest(n, 1)) * ln(0.4::DOUBLE) + CASE WHEN n > 0 THEN ln(c::DOUBLE / base)
  ELSE -ln((total - len(w) + 1)::DOUBLE) END AS s FROM best JOIN d USING (r) CROSS JOIN sizes),
summed AS (SELECT r, sum(s) AS s, count(*) FILTER (n = 0) AS n0, count(*) FILTER (n = 1) AS n1, count(*) FILTER (n = 2) AS n2,
  count(*) FILTER (n = 3) AS n3 FROM scored GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, round(coalesce(s, 0), 6) AS log_score, coalesce(n0, 0)::BIGINT AS n_unseen,
  coalesce(n1, 0)::BIGINT AS n_order1, coalesce(n2, 0)::BIGINT AS n_order2, coalesce(n3, 0)::BIGINT AS n_order3,
  round(s / len(w), 6) AS mean_log_score FROM d LEFT JOIN summed USING (r)
"""


def merkle_manifest() -> str:
    def framed(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(framed(x) for x in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"

    def tree(name: str, leaves: str) -> str:
        return f"""{name} AS (SELECT tree, 0 AS lvl, pos, h, count(*) OVER (PARTITION BY tree) AS width FROM {leaves}
  UNION ALL SELECT tree, lvl + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (any_value(width) + 15) // 16
  FROM {name} WHERE width > 1 GROUP BY tree, lvl, pos // 16),
{name}_runs AS (SELECT tree, lvl, pos // 16 AS up, list(h ORDER BY pos) AS hs FROM {name} WHERE width > 1 GROUP BY ALL)"""

    def folding(name: str, nodes: str, begin: str) -> str:
        before, after = "array_to_string(hs[1 : f.pos % 16], '')", "array_to_string(hs[f.pos % 16 + 2 : 16], '')"
        return f"""{name} AS ({begin}
  UNION ALL SELECT r, f.tree, f.lvl + 1, f.pos // 16, sha256({before} || cur || {after}), proof || {before} || {after}
  FROM {name} f JOIN {nodes}_runs n ON n.tree = f.tree AND n.lvl = f.lvl AND n.up = f.pos // 16),
{name}_end AS (SELECT r, arg_max(tree, lvl) AS tree, arg_max(cur, lvl) AS cur, arg_max(proof, lvl) AS proof FROM {name} GROUP BY r)"""

    step = "lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END)"
    code = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"
    eight = "range(8)::BIGINT[]"
    crc = f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {code}), lambda c, b: list_reduce(list_prepend(xor(c, b), {eight}), {step})))"
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, source, {leaf('text')} AS leaf,
  CASE WHEN {crc} % 5 = 0 THEN {leaf(_lower('text'))} END AS tampered FROM documents),
l AS (SELECT *, leaf AS h, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
{tree('low', 'l')},
s AS (SELECT -1 AS tree, tree AS pos, h FROM low WHERE width = 1),
{tree('high', 's')},
{folding('near', 'low', "SELECT r, tree, 0 AS lvl, pos, coalesce(tampered, leaf) AS cur, '' AS proof FROM l")},
{folding('far', 'high', "SELECT r, -1 AS tree, 0 AS lvl, tree AS pos, cur, proof FROM near_end")}
SELECT doc_id, leaf, s.h AS subroot, top.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = top.h AS verified
FROM l JOIN far_end USING (r) JOIN s ON s.pos = l.tree, (SELECT h FROM high WHERE width = 1) top
"""


def ranked_search() -> str:
    terms = f"regexp_extract_all(coalesce({_lower('text')}, ''), {TERMS})"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS w FROM documents),
size AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS words FROM d WHERE len(w) > 0),
q AS (SELECT row_number() OVER () AS item, item_id, {terms} AS w FROM benchmark),
asked AS (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(w) AS term FROM q) GROUP BY ALL),
held AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d),
counted AS (SELECT r, doc_id, n, term, count(*) AS tf FROM held WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weighed AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM counted, size GROUP BY term),
parts AS (SELECT item, item_id, r, doc_id, times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))) AS part
  FROM counted JOIN weighed USING (term) JOIN asked USING (term), size),
scores AS (SELECT item, item_id, r, doc_id, sum(part)::BIGINT AS score FROM parts GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
  FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_license_scan": license_scan(),
        "op2_decontamination": decontamination(),
        "op3_url_filter": url_filter(),
        "op4_ngram_jaccard": ngram_jaccard(),
        "op6_substring_dedup": substring_dedup(),
        "op8_quality_rules": quality(),
        "op9_lm_scoring": lm_scoring(),
        "op11_merkle_manifest": merkle_manifest(),
        "op12_ranked_search": ranked_search(),
    }
