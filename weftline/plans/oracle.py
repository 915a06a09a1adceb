"""SQL for DuckDB that computes the registered queries from the same tables."""

from __future__ import annotations

from weftline.functions import fixed_values as V
from weftline.plans.fixtures import LOG_SQL, PERFORMANCE_SQL, PROVIDERS_SQL, QUEUE_SQL


def quoted(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def title(x: str) -> str:
    return f"array_to_string(list_transform(regexp_extract_all({x}, '[A-Za-z]+|[^A-Za-z]+'), lambda w: upper(w[1]) || lower(w[2:])), '')"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def name(x: str) -> str:
    gone = f"regexp_replace(regexp_replace(trim({x}), '(?i)\\b(?:Dr\\.|Dr|MD|PhD|DO|PA|NP|RN)\\b\\.?', '', 'g'), '(?i)\\b(?:III|II|IV|Jr|Sr)\\b\\.?', '', 'g')"
    return title(squeeze(f"regexp_replace({gone}, '[^\\w\\s-]', ' ', 'g')"))


def soundex(x: str) -> str:
    up = f"upper({x})"
    codes = f"replace(translate({up}[2:], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ-', '012301270224550126230172020'), '7', '')"
    first = f"translate({up}[1], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230127022455012623017202')"
    runs = f"{first} || {codes}"
    for c in "123456":
        runs = f"regexp_replace({runs}, '{c}+', '{c}', 'g')"
    return f"({up}[1] || left(rpad(replace(({runs})[2:], '0', ''), 3, '0'), 3))"


def lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence: rows of the table folded over the letters."""
    step = f"list_reduce(list_concat([[CAST(0 AS BIGINT)]], list_transform(range(1, length({b}) + 1), lambda j: [j])), lambda r, j: list_append(r, CASE WHEN unicode({b}[j[1]]) = x[1] THEN acc[j[1]] + 1 ELSE greatest(acc[j[1] + 1], r[-1]) END))"
    return f"list_reduce(list_concat([list_transform(range(0, length({b}) + 1), lambda i: CAST(0 AS BIGINT))], list_transform(range(1, length({a}) + 1), lambda i: [CAST(unicode({a}[i]) AS BIGINT)])), lambda acc, x: {step})[-1]"


def fuzz(a: str, b: str) -> str:
    return f"CAST(round_even(200.0 * {lcs(a, b)} / (length({a}) + length({b})), 0) AS INTEGER)"


def tokens(x: str) -> str:
    return f"list_filter(string_split(lower({x}), ' '), lambda w: w <> '')"


def jaccard(a: str, b: str) -> str:
    a, b = tokens(a), tokens(b)
    return f"(CAST(len(list_intersect({a}, {b})) AS DOUBLE) / len(list_distinct(list_concat({a}, {b}))))"


STOP = "[" + ", ".join(quoted(w) for w in V.AFFILIATION_STOP_WORDS) + "]"
DICTIONARY = "d AS (SELECT lower(trim(variant)) AS variant, max_by(canonical, pos) AS canonical FROM (VALUES " + ", ".join(f"({i}, {quoted(c)}, {quoted(v)})" for i, (c, v) in enumerate(V.AFFILIATIONS)) + ") AS v(pos, canonical, variant) GROUP BY 1)"
CLEAN = squeeze("regexp_replace(lower(trim({x})), '[^\\w\\s&-]', ' ', 'g')")
P = f"p AS ({PROVIDERS_SQL})"
NORMAL = f"""{P}, {DICTIONARY},
n AS (SELECT p.*, {name("raw_name")} AS norm_name, {name("first_name")} AS first_name_norm, {name("last_name")} AS last_name_norm, coalesce(d.canonical, {title(CLEAN.replace("{x}", "affiliation"))}) AS norm_affiliation,
  regexp_extract(address, '^(\\d+) ', 1) AS street_number, regexp_extract(address, ', ([^,]+), [A-Z][A-Z] \\d+$', 1) AS city_norm, regexp_extract(address, ', ([A-Z][A-Z]) \\d+$', 1) AS state_norm, regexp_extract(address, ' (\\d+)$', 1) AS zip_norm,
  regexp_extract(address, '^(\\d+) ', 1) || ' Main St' AS address_line_1_norm, '+1' || regexp_replace(phone, '\\D', '', 'g') AS phone_norm, lower(email) AS email_norm
  FROM p LEFT JOIN d ON {CLEAN.replace("{x}", "affiliation")} = d.variant)"""
KEYS = f"""{NORMAL},
k AS (SELECT record_id, 0 AS ord, 'location_name' AS strategy, left(md5(state_norm || '|' || zip_norm[1:3] || '|' || {soundex("last_name_norm")} || '|' || {soundex("first_name_norm")}), 16) AS block_key FROM n
  UNION ALL SELECT record_id, 1, 'address_hash', left(md5(city_norm || '|' || address_line_1_norm[1:3]), 16) FROM n)"""
PAIRS = f"""{KEYS},
b AS (SELECT ord, block_key FROM k GROUP BY ord, block_key HAVING count(*) <= 1000),
c AS (SELECT x.record_id AS record_id_1, y.record_id AS record_id_2, arg_min(x.block_key, x.ord) AS block_key, arg_min(x.strategy, x.ord) AS strategy
  FROM k x JOIN k y ON x.ord = y.ord AND x.block_key = y.block_key AND x.record_id < y.record_id JOIN b ON b.ord = x.ord AND b.block_key = x.block_key GROUP BY 1, 2)"""
_same = lambda f: f"(x.{f} <> '' AND lower(x.{f}) = lower(y.{f}))"
_num = lambda c: f"CAST({c} AS INTEGER) * CAST(1 AS DOUBLE)"
RATIOS = f"""{PAIRS},
q AS (SELECT a, b, {fuzz("a", "b")} AS ratio FROM (SELECT DISTINCT x.norm_name AS a, y.norm_name AS b FROM c JOIN n x ON x.record_id = record_id_1 JOIN n y ON y.record_id = record_id_2
  UNION SELECT DISTINCT x.norm_affiliation, y.norm_affiliation FROM c JOIN n x ON x.record_id = record_id_1 JOIN n y ON y.record_id = record_id_2))"""
SCORED = f"""{RATIOS},
f AS (SELECT c.*, x.true_entity AS e1, y.true_entity AS e2, {_num("lower(x.norm_name) = lower(y.norm_name)")} AS name_exact_match, {_num("levenshtein(lower(x.norm_name), lower(y.norm_name)) <= 2")} AS name_levenshtein_match,
  qn.ratio / 100.0 AS name_fuzz_ratio, {_num("qn.ratio >= 90")} AS name_fuzz_ratio_match, jaro_winkler_similarity(lower(x.norm_name), lower(y.norm_name)) AS name_jaro_winkler,
  {_num("lower(x.norm_affiliation) = lower(y.norm_affiliation)")} AS affiliation_exact_match, {jaccard("x.norm_affiliation", "y.norm_affiliation")} AS affiliation_jaccard_similarity, qa.ratio / 100.0 AS affiliation_fuzz_ratio,
  {_num(_same("city_norm"))} AS location_city_match, {_num(_same("state_norm"))} AS location_state_match, {_num(_same("zip_norm"))} AS location_zip_match, {_num(_same("address_line_1_norm"))} AS location_street_match,
  {_num(f"({_same('city_norm')} AND {_same('state_norm')}) OR {_same('zip_norm')}")} AS location_location_match,
  {_num(_same("phone_norm"))} AS contact_phone_match, {_num(_same("email_norm"))} AS contact_email_match, {_num(f"{_same('phone_norm')} OR {_same('email_norm')}")} AS contact_contact_match
  FROM c JOIN n x ON x.record_id = record_id_1 JOIN n y ON y.record_id = record_id_2 JOIN q qn ON qn.a = x.norm_name AND qn.b = y.norm_name JOIN q qa ON qa.a = x.norm_affiliation AND qa.b = y.norm_affiliation),
s AS (SELECT *, CAST(0.3 AS DOUBLE) * name_exact_match + CAST(0.2 AS DOUBLE) * name_levenshtein_match + CAST(0.15 AS DOUBLE) * name_fuzz_ratio_match + CAST(0.15 AS DOUBLE) * affiliation_jaccard_similarity + CAST(0.25 AS DOUBLE) * location_location_match + CAST(0.1 AS DOUBLE) * contact_contact_match AS deterministic_score FROM f),
h AS (SELECT *, deterministic_score AS hybrid_score, CASE WHEN deterministic_score >= CAST(0.85 AS DOUBLE) THEN 'AUTO_MERGE' WHEN deterministic_score >= CAST(0.65 AS DOUBLE) AND deterministic_score < CAST(0.85 AS DOUBLE) THEN 'AUDIT' ELSE 'REJECT' END AS decision FROM s)"""
_SIM = ["name_exact_match", "name_levenshtein_match", "name_fuzz_ratio", "name_fuzz_ratio_match", "name_jaro_winkler", "affiliation_exact_match", "affiliation_jaccard_similarity", "affiliation_fuzz_ratio", "location_city_match", "location_state_match", "location_zip_match", "location_street_match", "location_location_match", "contact_phone_match", "contact_email_match", "contact_contact_match", "deterministic_score"]
GROUPS = f"""{SCORED},
l AS (SELECT record_id_1 AS a, record_id_2 AS b FROM h WHERE decision = 'AUTO_MERGE' UNION SELECT record_id_2, record_id_1 FROM h WHERE decision = 'AUTO_MERGE'),
reach(a, b) AS (SELECT DISTINCT a, a FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
g AS (SELECT a AS record_id, min(b) AS component FROM reach GROUP BY a)"""
#: The groups of blocks of any size.
ALL_GROUPS = GROUPS.replace(" HAVING count(*) <= 1000", "")
MERGED = f"""{GROUPS},
m AS (SELECT component, 'PROV-' || upper(left(sha256(arg_min(lower(trim(norm_name)) || '|' || lower(trim(city_norm)) || '|' || lower(trim(state_norm)), n.record_id)), 16)) AS canonical_id,
  max_by(norm_name, {{'l': length(norm_name), 'r': -n.record_id}}) AS norm_name, arg_min(phone_norm, n.record_id) AS phone_norm, arg_min(email_norm, n.record_id) AS email_norm, max_by(address_line_1_norm, {{'l': length(address_line_1_norm), 'r': -n.record_id}}) AS address_line_1_norm,
  CASE WHEN count(DISTINCT email_norm) > 1 THEN array_to_string(list_transform(list_sort(list({{'r': fm.r, 'v': fm.v}}) FILTER (fm.r = n.record_id)), lambda z: z.v), ',') END AS email_norm_all,
  string_agg(CAST(n.record_id AS VARCHAR), ',' ORDER BY n.record_id) AS merged_from, count(*) AS merge_count, array_to_string(list_sort(list(DISTINCT source)), ',') AS original_sources
  FROM n JOIN g ON n.record_id = g.record_id JOIN (SELECT component AS fc, email_norm AS v, min(n.record_id) AS r FROM n JOIN g ON n.record_id = g.record_id GROUP BY 1, 2) fm ON fm.fc = g.component AND fm.v = n.email_norm GROUP BY component)"""
A = f"a AS ({LOG_SQL})"
Q = f"q AS ({QUEUE_SQL})"
F = f"pf AS ({PERFORMANCE_SQL})"
RECENT = f"{A}, t AS (SELECT * FROM a WHERE \"timestamp\" >= (SELECT max(\"timestamp\") FROM a) - INTERVAL 30 DAY)"
DIRTY = f"""{P}, z AS (SELECT record_id, CASE WHEN record_id % 40 = 1 THEN 'P' || CAST(record_id - 1 AS VARCHAR) ELSE provider_id END AS provider_id, CASE WHEN record_id % 70 = 11 THEN 'X' ELSE raw_name END AS raw_name, first_name, last_name, affiliation, address,
  CASE WHEN record_id % 60 = 9 THEN 'ext x' ELSE phone END AS phone, CASE WHEN record_id % 50 = 7 THEN NULL WHEN record_id % 50 = 8 THEN 'bad' ELSE email END AS email, CASE WHEN record_id % 80 = 13 THEN 'Other' ELSE source END AS source FROM p)"""
_checks = [("row_count_between", "", "CASE WHEN count(*) BETWEEN 1 AND 1000000 THEN 0 ELSE 1 END")]
for _c in V.REQUIRED:
    _checks += [("column_exists", _c, "0"), ("not_null", _c, f"count(*) FILTER ({_c} IS NULL)"), ("is_string", _c, "0")]
_checks += [
    ("length_between", "raw_name", "count(*) FILTER (NOT length(raw_name) BETWEEN 2 AND 100)"), ("matches_pattern", "email", f"count(*) FILTER (NOT regexp_matches(email, '{V.EMAIL_RULE}'))"),
    ("matches_pattern", "phone", f"count(*) FILTER (NOT regexp_matches(phone, '{V.PHONE_RULE}'))"), ("in_set", "source", f"count(*) FILTER (source NOT IN ({', '.join(quoted(x) for x in V.SOURCES)}))"),
]
REPORT = f"""{DIRTY}, r AS ({" UNION ALL ".join(f'SELECT {quoted(r)} AS rule, {quoted(c)} AS "column", count(*) AS evaluated, CAST({e} AS BIGINT) AS unexpected FROM z' for r, c, e in _checks)}
  UNION ALL SELECT 'unique', 'provider_id', CAST(coalesce(sum(k), 0) AS BIGINT), CAST(coalesce(sum(CASE WHEN k > 1 THEN k END), 0) AS BIGINT) FROM (SELECT count(*) AS k FROM z WHERE provider_id IS NOT NULL GROUP BY provider_id)),
v AS (SELECT *, unexpected = 0 AS success FROM r)"""
_NEXT = f"{P}, w AS (SELECT x.record_id, x.raw_name AS a, y.raw_name AS b FROM p x JOIN p y ON y.record_id = x.record_id + 1)"
_STATES = "[" + ", ".join(quoted(v) for v in V.STATES.values()) + "]"
_KINDS = "[" + ", ".join(quoted(v) for v in [*V.DIRECTIONS.values(), *V.STREET_TYPES.values()]) + "]"
GRID = f"""{SCORED}, y AS (SELECT t, count(*) FILTER (round(hybrid_score * 100, 9) >= t AND e1 = e2) AS tp, count(*) FILTER (round(hybrid_score * 100, 9) >= t AND e1 <> e2) AS fp, count(*) FILTER (e1 = e2) AS pos FROM h, range(50, 95) AS g(t) GROUP BY t),
grid AS (SELECT t / 100.0 AS threshold, tp, fp, pos - tp AS fn, coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS "precision", coalesce(CAST(tp AS DOUBLE) / nullif(pos, 0), 0) AS recall FROM y),
gf AS (SELECT *, coalesce(2 * "precision" * recall / nullif("precision" + recall, 0), 0) AS f1 FROM grid)"""

_FIRST_LAST = "list_filter(string_split(regexp_replace(trim(raw_name), '\\s+', ' ', 'g'), ' '), lambda x: x <> '')"
ORACLE = {
    "normalize_names": f"WITH {NORMAL} SELECT record_id, norm_name, first_name_norm, last_name_norm, norm_name AS tokens FROM n",
    "title_case": f"SELECT p_partkey, {title("lower(p_name) || ' ' || lower(p_type)")} AS title FROM part",
    "normalize_address": f"WITH {NORMAL} SELECT record_id, street_number, 'Main' AS street_name, CASE WHEN record_id - true_entity = 1 THEN 'Street' ELSE 'St' END AS street_type, city_norm, state_norm, zip_norm, address_line_1_norm, '' AS address_line_2_norm FROM n",
    "normalize_contact": f"WITH {NORMAL} SELECT record_id, phone_norm, email_norm FROM n",
    "normalize_state_names": f"SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN upper(left(n_name, 2)) ELSE ({_STATES})[n_nationkey * 2 + 1] END AS state, {title(squeeze("regexp_replace(lower(n_name), '[^A-Za-z0-9_ ]', ' ', 'g')"))} AS city FROM nation",
    "normalize_streets": f"SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) || ' ' || ({_KINDS})[s_suppkey % 20 + 1] || ' Oak-Hill ' || ({_KINDS})[(s_suppkey + 9) % 20 + 1] AS street FROM supplier",
    "soundex_codes": f"WITH {P} SELECT record_id, {soundex('last_name')} AS last_soundex, {soundex('first_name')} AS first_soundex FROM p",
    "affiliation_exact": f"WITH {NORMAL} SELECT record_id, norm_affiliation, array_to_string(list_filter({tokens('norm_affiliation')}, lambda w: NOT list_contains({STOP}, w)), ' ') AS tokens FROM n",
    "affiliation_fuzzy": f"""WITH {DICTIONARY}, x AS (SELECT n_nationkey, 'clinic of ' || lower(n_name) AS a FROM nation), c AS (SELECT DISTINCT canonical, trim(regexp_replace(lower(canonical), '[^a-z0-9]', ' ', 'g')) AS b FROM d),
s AS (SELECT n_nationkey, a, canonical, {fuzz("a", "b")} AS score FROM x, c), b AS (SELECT n_nationkey, a, max(score) AS top, arg_min(canonical, {{'s': -score, 'c': canonical}}) AS canonical FROM s GROUP BY 1, 2)
SELECT n_nationkey, CASE WHEN top >= 50 THEN canonical ELSE {title("a")} END AS norm_affiliation FROM b""",
    "dictionary_stats": f"WITH {DICTIONARY} SELECT count(DISTINCT canonical) AS canonical_names, count(*) AS variants, round(CAST(count(*) AS DOUBLE) / count(DISTINCT canonical), 6) AS avg_variants FROM d",
    "split_names": f"WITH {P}, x AS (SELECT record_id, {_FIRST_LAST} AS w FROM p) SELECT record_id, CASE WHEN len(w) >= 2 THEN w[1] ELSE '' END AS first, CASE WHEN len(w) >= 3 THEN array_to_string(w[2:-2], ' ') ELSE '' END AS middle, w[-1] AS last FROM x",
    "fuzz_ratio_pairs": f"WITH {_NEXT} SELECT record_id, {fuzz('a', 'b')} AS ratio FROM w",
    "edit_pairs": f"WITH {_NEXT} SELECT record_id, levenshtein(lower(a), lower(b)) <= 2 AS within_2, round(CAST(levenshtein(a, b) AS DOUBLE) / greatest(length(a), length(b)), 6) AS edits, round(CAST(abs(length(a) - length(b)) AS DOUBLE) / greatest(length(a), length(b)), 6) AS length_diff, round({jaccard('a', 'b')}, 6) AS jaccard FROM w",
    "jaro_winkler_pairs": f"WITH {_NEXT} SELECT record_id, round(jaro_winkler_similarity(lower(a), lower(b)), 6) AS jw FROM w",
    "validation_report": f"WITH {REPORT} SELECT rule, \"column\", evaluated, unexpected, success FROM v",
    "validation_summary": f"WITH {REPORT} SELECT bool_and(success) AS success, count(*) AS total, count(*) FILTER (success) AS passed, count(*) FILTER (NOT success) AS failed, round(count(*) FILTER (success) * 100.0 / count(*), 6) AS success_rate, array_to_string(list_sort(list(rule || ':' || \"column\") FILTER (NOT success)), ',') AS failures FROM v",
    "clean_providers": f"WITH {DIRTY} SELECT min(record_id) AS record_id, provider_id FROM z WHERE email IS NOT NULL GROUP BY provider_id",
    "block_keys": f"""WITH {KEYS}, t AS (SELECT record_id, list_sort(list_distinct(list_filter(list_transform(list_concat([lower(state_norm)], list_filter({tokens("norm_affiliation")}, lambda w: NOT list_contains({STOP}, w))), lambda w: regexp_replace(w, '[^a-z0-9]', '', 'g')), lambda w: length(w) >= 2)))[1:3] AS w FROM n)
SELECT t.record_id, max(block_key) FILTER (ord = 0) AS block_location_name, max(block_key) FILTER (ord = 1) AS block_address_hash, any_value(left(md5(array_to_string(w, '_')), 16)) AS block_affiliation_tokens FROM k JOIN t ON t.record_id = k.record_id GROUP BY 1""",
    "candidate_pairs": f"WITH {PAIRS} SELECT record_id_1, record_id_2, block_key, strategy FROM c",
    "blocking_stats": f"""WITH {PAIRS}, z AS (SELECT strategy, block_key, count(*) AS n FROM k GROUP BY 1, 2), t AS (SELECT (SELECT count(*) FROM n) AS total, (SELECT count(*) FROM c) AS made)
SELECT strategy, count(*) AS num_blocks, round(avg(n), 6) AS avg_block_size, max(n) AS max_block_size, round(CAST(sum(n) AS DOUBLE) / total, 6) AS coverage, total AS total_records, made AS generated_candidates, total * (total - 1) // 2 AS total_possible_pairs, round(1 - made / (total * (total - 1) / 2.0), 6) AS reduction_ratio FROM z, t GROUP BY strategy, total, made""",
    "deterministic_scores": f"WITH {SCORED} SELECT record_id_1, record_id_2, strategy, {', '.join(f'round({c}, 6) AS {c}' for c in _SIM)} FROM s",
    "score_stats": f"""WITH {SCORED} SELECT round(avg(x), 6) AS mean, round(median(x), 6) AS median, round(stddev_samp(x), 6) AS std, round(min(x), 6) AS min, round(max(x), 6) AS max, count(*) FILTER (x <= CAST(0.2 AS DOUBLE)) AS bin_0_2, count(*) FILTER (x > CAST(0.2 AS DOUBLE) AND x <= CAST(0.4 AS DOUBLE)) AS bin_2_4,
  count(*) FILTER (x > CAST(0.4 AS DOUBLE) AND x <= CAST(0.6 AS DOUBLE)) AS bin_4_6, count(*) FILTER (x > CAST(0.6 AS DOUBLE) AND x <= CAST(0.8 AS DOUBLE)) AS bin_6_8, count(*) FILTER (x > CAST(0.8 AS DOUBLE)) AS bin_8_up FROM (SELECT deterministic_score AS x FROM s)""",
    "hybrid_decisions": f"WITH {SCORED} SELECT record_id_1, record_id_2, round(hybrid_score, 6) AS hybrid_score, decision, decision = 'AUTO_MERGE' AS auto_merge, decision = 'AUDIT' AS audit_required, decision = 'REJECT' AS reject FROM h",
    "scoring_stats": f"""WITH {SCORED}, x AS (SELECT hybrid_score AS s, hybrid_score >= CAST(0.85 AS DOUBLE) AS a, hybrid_score < CAST(0.65 AS DOUBLE) AS r FROM h) SELECT count(*) AS total_pairs, round(avg(s), 6) AS mean_score, round(median(s), 6) AS median_score, round(stddev_samp(s), 6) AS std_score, round(min(s), 6) AS min_score, round(max(s), 6) AS max_score,
  count(*) FILTER (a) AS auto_merge_count, count(*) FILTER (NOT a AND NOT r) AS audit_count, count(*) FILTER (r) AS reject_count, round(count(*) FILTER (a) * 100.0 / count(*), 6) AS auto_merge_percentage, round(count(*) FILTER (NOT a AND NOT r) * 100.0 / count(*), 6) AS audit_percentage, round(count(*) FILTER (r) * 100.0 / count(*), 6) AS reject_percentage FROM x""",
    "decision_counts": f"WITH {SCORED} SELECT decision, count(*) AS n FROM h GROUP BY decision",
    "threshold_search": f"WITH {GRID} SELECT round(threshold, 6) AS threshold, tp, fp, fn, round(\"precision\", 6) AS \"precision\", round(recall, 6) AS recall, round(f1, 6) AS f1 FROM gf",
    "best_thresholds": f"WITH {GRID}, o AS (SELECT coalesce((SELECT threshold FROM gf WHERE \"precision\" >= 0.9 AND recall >= 0.5 AND f1 > 0 ORDER BY f1 DESC, threshold LIMIT 1), 0.85) AS t) SELECT CAST(t AS DOUBLE) AS auto_merge, greatest(CAST(0.5 AS DOUBLE), round(CAST(t AS DOUBLE) - 0.2, 9)) AS audit_low, CAST(t AS DOUBLE) AS audit_high FROM o",
    "merge_groups": f"WITH RECURSIVE {ALL_GROUPS} SELECT record_id, component FROM g",
    "merged_providers": f"WITH RECURSIVE {MERGED} SELECT canonical_id, component, norm_name, phone_norm, email_norm, address_line_1_norm, email_norm_all, merged_from, merge_count, original_sources FROM m",
    "merge_log": f"WITH RECURSIVE {MERGED} SELECT row_number() OVER (ORDER BY component) - 1 AS merge_group_id, canonical_id, merged_from AS merged_record_ids, merge_count FROM m",
    "merge_stats": f"WITH RECURSIVE {MERGED}, t AS (SELECT (SELECT count(*) FROM n) AS total, CAST(sum(merge_count) - count(*) AS BIGINT) AS cut, count(*) AS groups, avg(merge_count) AS a, max(merge_count) AS b FROM m) SELECT total AS original_count, total - cut AS merged_count, cut AS duplicate_reduction, round(cut * 100.0 / total, 6) AS duplicate_reduction_percentage, groups AS merge_groups, round(a, 6) AS avg_group_size, b AS max_group_size FROM t",
    "merge_group_sizes": f"WITH RECURSIVE {MERGED} SELECT merge_count, count(*) AS n FROM m GROUP BY merge_count",
    "unmerged_providers": f"WITH RECURSIVE {GROUPS} SELECT record_id, norm_name FROM n WHERE record_id NOT IN (SELECT record_id FROM g)",
    "rollback_merge": f"WITH RECURSIVE {MERGED} SELECT record_id, norm_name FROM n WHERE record_id NOT IN (SELECT record_id FROM g) OR record_id IN (SELECT g.record_id FROM g JOIN m ON g.component = m.component WHERE m.canonical_id = (SELECT min(canonical_id) FROM m))",
    "audit_candidates": f"WITH {SCORED} SELECT record_id_1 || '_' || record_id_2 AS pair_id, round(hybrid_score, 6) AS hybrid_score FROM h WHERE decision = 'AUDIT'",
    "pending_topk": f"WITH {Q} SELECT pair_id, priority, added_date FROM q WHERE status = 'pending' ORDER BY priority DESC, added_date, pair_id LIMIT 50",
    "decisions_by_date": f"WITH {A} SELECT pair_id, decision, \"timestamp\" FROM a WHERE \"timestamp\" BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'",
    "training_data": f"WITH {A} SELECT pair_id, CAST(decision = 'MERGE' AS INTEGER) AS label, round(hybrid_score - deterministic_score, 6) AS score_diff, CAST(hybrid_score >= 0.9 AS INTEGER) AS high_confidence, CAST(hybrid_score <= 0.1 AS INTEGER) AS low_confidence FROM a",
    "review_export": f"WITH {A} SELECT pair_id, record_id_1, record_id_2, CAST(decision = 'MERGE' AS INTEGER) AS label, hybrid_score, deterministic_score, ml_probability, 'by ' || reviewer AS comment, reviewer, \"timestamp\" FROM a",
    "audit_metrics": f"WITH {RECENT} SELECT count(*) AS total_reviews, count(*) FILTER (decision = 'MERGE') AS merge_count, count(*) FILTER (decision = 'REJECT') AS reject_count, round(CAST(count(*) FILTER (decision = 'MERGE') AS DOUBLE) / count(*), 6) AS merge_rate FROM t",
    "queue_stats": f"WITH {Q} SELECT count(*) AS total_queue, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'reviewed') AS reviewed FROM q",
    "reviewer_performance": f"WITH {RECENT} SELECT reviewer, count(*) AS reviews_completed, round(avg(processing_time), 6) AS avg_processing_time, round(count(*) FILTER (decision = 'MERGE') * 100.0 / count(*), 6) AS merge_rate, min(\"timestamp\") AS first_review, max(\"timestamp\") AS last_review FROM t GROUP BY reviewer",
    "review_statistics": f"WITH {RECENT} SELECT CAST(\"timestamp\" AS DATE) AS review_date, decision, count(*) AS review_count, round(avg(processing_time), 6) AS avg_processing_time, round(count(*) FILTER (decision = 'MERGE') * 100.0 / count(*), 6) AS merge_rate FROM t GROUP BY 1, 2",
    "decision_shares": f"WITH {A} SELECT decision, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM a), 6) AS percentage FROM a GROUP BY decision",
    "daily_activity": f"WITH {RECENT} SELECT CAST(\"timestamp\" AS DATE) AS \"date\", count(*) AS reviews_completed FROM t GROUP BY 1 ORDER BY 1 DESC LIMIT 7",
    "should_retrain": f"WITH {A} SELECT count(*) AS new_decisions, count(*) >= 100 AS retrain FROM a WHERE \"timestamp\" > (SELECT max(\"timestamp\") - INTERVAL 2 DAY FROM a)",
    "model_perf_lag": f"WITH {F} SELECT model_version, evaluation_date, {', '.join(f'round({c}, 6) AS {c}' for c in ('"precision"', 'recall', 'f1_score', 'auc_score'))}, {', '.join(f'round(lag({c}) OVER (ORDER BY evaluation_date), 6) AS {n}' for c, n in (('"precision"', 'prev_precision'), ('recall', 'prev_recall'), ('f1_score', 'prev_f1')))} FROM pf",
    "derived_metrics": f"""WITH {A}, {Q}, {F}, tw AS (SELECT *, row_number() OVER (ORDER BY evaluation_date DESC) AS n FROM pf)
SELECT round((SELECT CAST(count(*) FILTER (status = 'reviewed') AS DOUBLE) / count(*) FROM q), 6) AS completion_rate, round((SELECT CAST(count(*) FILTER (decision = 'MERGE') AS DOUBLE) / count(*) FROM a), 6) AS merge_rate, round((SELECT CAST(count(*) FILTER (decision = 'REJECT') AS DOUBLE) / count(*) FROM a), 6) AS reject_rate,
  {', '.join(f"round(coalesce((SELECT max({c}) FILTER (n = 1) - max({c}) FILTER (n = 2) FROM tw), 0), 6) AS {n}" for c, n in (('"precision"', 'precision_trend'), ('recall', 'recall_trend'), ('f1_score', 'f1_trend')))}""",
    "processing_time_trend": f"WITH {A}, t AS (SELECT * FROM a WHERE processing_time IS NOT NULL ORDER BY \"timestamp\" DESC, pair_id LIMIT 1000) SELECT CAST(\"timestamp\" AS DATE) AS \"date\", round(avg(processing_time), 6) AS processing_time FROM t GROUP BY 1",
    "processing_time_histogram": f"WITH {A}, t AS (SELECT * FROM a WHERE processing_time IS NOT NULL ORDER BY \"timestamp\" DESC, pair_id LIMIT 1000), x AS (SELECT min(processing_time) AS lo, max(processing_time) AS hi FROM t) SELECT decision, CAST(CASE WHEN hi > lo THEN least(49, floor((processing_time - lo) / (hi - lo) * 50)) ELSE 0 END AS INTEGER) AS bin, count(*) AS n FROM t, x GROUP BY 1, 2",
    "system_health": f"WITH {A}, {Q}, {F} SELECT 'audit_log' AS \"table\", count(*) AS rows FROM a UNION ALL SELECT 'audit_queue', count(*) FROM q UNION ALL SELECT 'model_performance', count(*) FROM pf UNION ALL SELECT 'retraining_log', 0",
    "metrics_report": f"""WITH {A}, {Q} SELECT 'audit_queue' AS category, name, CAST(value AS DOUBLE) AS value FROM (SELECT count(*) AS total_queue, count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'reviewed') AS reviewed FROM q) UNPIVOT (value FOR name IN (total_queue, pending, reviewed))
UNION ALL SELECT 'audit', name, round(value, 6) FROM (SELECT CAST(count(*) AS DOUBLE) AS total_reviews, CAST(count(*) FILTER (decision = 'MERGE') AS DOUBLE) AS merge_count, CAST(count(*) FILTER (decision = 'REJECT') AS DOUBLE) AS reject_count, CAST(count(*) FILTER (decision = 'MERGE') AS DOUBLE) / count(*) AS merge_rate FROM a) UNPIVOT (value FOR name IN (total_reviews, merge_count, reject_count, merge_rate))""",
    "ml_features": f"""WITH {RATIOS} SELECT record_id_1, record_id_2, {_num("lower(x.norm_name) = lower(y.norm_name)")} AS name_exact, round(CAST(levenshtein(lower(x.norm_name), lower(y.norm_name)) AS DOUBLE) / greatest(length(x.norm_name), length(y.norm_name)), 6) AS name_edits, qn.ratio / 100.0 AS name_fuzz,
  round(jaro_winkler_similarity(lower(x.norm_name), lower(y.norm_name)), 6) AS name_jaro_winkler, round(CAST(abs(length(x.norm_name) - length(y.norm_name)) AS DOUBLE) / greatest(length(x.norm_name), length(y.norm_name)), 6) AS name_length_diff,
  {_num("lower(x.norm_affiliation) = lower(y.norm_affiliation)")} AS affiliation_exact, round({jaccard("x.norm_affiliation", "y.norm_affiliation")}, 6) AS affiliation_jaccard, qa.ratio / 100.0 AS affiliation_fuzz,
  {_num(_same("city_norm"))} AS city_match, {_num(_same("state_norm"))} AS state_match, {_num(_same("zip_norm"))} AS zip_match, {_num(_same("address_line_1_norm"))} AS street_match, {_num(_same("phone_norm"))} AS phone_match, {_num(_same("email_norm"))} AS email_match, {_num("x.source = y.source")} AS same_source, {_num("x.provider_id = y.provider_id")} AS same_provider_id
  FROM c JOIN n x ON x.record_id = record_id_1 JOIN n y ON y.record_id = record_id_2 JOIN q qn ON qn.a = x.norm_name AND qn.b = y.norm_name JOIN q qa ON qa.a = x.norm_affiliation AND qa.b = y.norm_affiliation""",
}
