"""DuckDB SQL for the queries of ``mergewell.plans.queries``, built from the same fixed values."""

from __future__ import annotations

from functools import reduce

from mergewell.functions import dictionaries as D
from mergewell.functions.normalize import DBA, native_states
from mergewell.functions.romanize import _SPECIAL, _folds, romanize
from mergewell.operators.features import STRINGS
from mergewell.operators.retrieval import channels
from mergewell.plans import records as R


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def sub(x: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(to.replace('$', chr(92)))}, 'g')"


def mapped(tokens: str, table: dict[str, str]) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items())
    return f"list_transform({tokens}, lambda t: CASE t {cases} ELSE t END)"


def without(tokens: str, dropped: list[str]) -> str:
    return f"list_filter({tokens}, lambda t: t NOT IN ({', '.join(map(q, dropped))}))"


def joined(tokens: str) -> str:
    return f"coalesce(array_to_string({tokens}, ' '), '')"


def first_of_each(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t, i: list_position({tokens}, t) = i)"


def romanized(x: str) -> str:
    """Character by character; the table has the characters that the records can have."""
    known = "".join(f"{a}{b}" for a, b in R.NAMES) + "".join(f"{x}" for v in R.REGIONS.values() for x in v) + _folds()[0] + "".join(_SPECIAL)
    table = {ch: romanize(ch) for ch in dict.fromkeys(known) if not ch.isascii()}
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items())
    return f"coalesce(array_to_string(list_transform(string_split({x}, ''), lambda c: CASE WHEN c <= chr(127) THEN c ELSE CASE c {cases} ELSE ' ' END END), ''), '')"


def patterns(x: str, rules) -> str:
    return reduce(lambda y, r: sub(y, *r), rules, x)


def clean_name(x: str) -> str:
    digits, plain = "".join(D.LOOKALIKES), "".join(D.LOOKALIKES.values())
    fixed = f"list_transform(string_split({collapse(patterns(f'lower({x})', D.NAME_PATTERNS))}, ' '), lambda t: CASE WHEN regexp_matches(t, '^[a-z]*[{digits}][a-z]*$') AND length(t) >= 4 THEN translate(t, '{digits}', '{plain}') ELSE t END)"
    return joined(mapped(fixed, D.NAME_SYNONYMS))


def sound(x: str) -> str:
    x = patterns(x, D.SOUND_PATTERNS)
    x = reduce(lambda y, r: f"replace({y}, {q(r[0])}, {q(r[1])})", D.SOUND_STRINGS, x)
    x = sub(sub(x, r"\B[aeiou]", ""), r"\b[aeiou]", "a")
    return collapse(reduce(lambda y, c: sub(y, f"{c}{c}+", c), D.SOUND_DOUBLED, x))


def address_tokens(x: str) -> str:
    """Words of a cleaned address by country: names of several words first, then single words, then those to drop."""

    def words(country: str) -> str:
        regions = D.REGIONS.get(country, {})
        table = D.ADDRESS_SYNONYMS | (D.ADDRESS_SYNONYMS_FRANCE if country == "france" else {}) | {k: v for k, v in regions.items() if " " not in k}
        phrases = sorted((p for p in regions if " " in p), key=len, reverse=True)
        text = reduce(lambda y, p: sub(y, rf"\b{p}\b", regions[p]), phrases, x)
        return f"list_filter({without(mapped(f'string_split({collapse(text)}, {q(chr(32))})', table), D.ADDRESS_DROPPED)}, lambda t: t <> '')"

    cases = " ".join(f"WHEN {q(k)} THEN {words(k)}" for k in D.REGIONS)
    return f"CASE ckey {cases} ELSE {words('')} END"


def _choice(values, number: str) -> str:
    return f"[{', '.join(map(q, values))}][({number}) % {len(values)} + 1]"


def _raw() -> str:
    region = " ".join(f"WHEN {q(k)} THEN CASE WHEN size % 5 = 0 THEN {q(v[4])} ELSE {_choice(v[:4], '2 * (size % 2) + page_id % 2')} END" for k, v in R.REGIONS.items())
    country = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in R.COUNTRIES.items())
    return f"""
page AS (
  SELECT page_id, 'S' || (1 + page_id % 3) || '-' || page_id AS entity_id, coalesce(regexp_extract(url, '/([a-z][a-z])/', 1), '') AS lang,
    regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, length(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) AS size, regexp_extract(url, '//([^/]*)', 1) AS host FROM pages),
raw AS (
  SELECT entity_id, coalesce(CASE WHEN page_id % 97 <> 5 THEN {_choice([a for a, _ in R.NAMES], 'page_id')} || title || {_choice([b for _, b in R.NAMES], 'page_id')} END, '') AS business_name,
    coalesce(CASE WHEN page_id % 13 = 3 THEN 'NULL' WHEN page_id % 13 <> 4 THEN '00' || size || {_choice(R.STREETS, 'page_id')} || CASE lang {region} ELSE 'Nowhere' END || ' ' || host END, '') AS business_address,
    coalesce(CASE lang {country} END, '') AS country FROM page),
placed AS (
  SELECT entity_id, title, lang, (row_number() OVER (PARTITION BY title, lang, substr(entity_id, 1, 2) ORDER BY page_id) - 1) // 2 AS pair FROM page WHERE title <> ''),
truth AS (SELECT a.entity_id AS s1_id, b.entity_id AS t_id FROM placed a JOIN placed b USING (title, lang, pair) WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%')"""


def _records() -> str:
    stop = D.LEGAL_TOKENS + D.FILLER_TOKENS
    native = reduce(lambda x, kv: f"replace({x}, {q(kv[0])}, {q(f' {kv[1]} ')})", native_states(), "business_address")
    cut = lambda x, dropped: joined(without(f"string_split({x}, ' ')", dropped))
    return f"""{_raw()},
n0 AS (
  SELECT *, lower(trim(country)) AS ckey, regexp_matches(business_name, '[^\\x{{0000}}-\\x{{024F}}]') AS translit,
    {clean_name(romanized("business_name"))} AS nn, {romanized(native)} AS addr0 FROM raw),
n1 AS (
  SELECT *, CASE WHEN regexp_matches(nn, {q(DBA)}) THEN {collapse(f"regexp_replace(nn, {q('^.*' + DBA)}, '', 'g')")} ELSE '' END AS alt0,
    {collapse(sub("nn", DBA, " "))} AS name_norm, {collapse(patterns("lower(addr0)", D.ADDRESS_PATTERNS))} AS a0 FROM n0),
n2 AS (
  SELECT *, CASE WHEN {cut("name_norm", stop)} <> '' THEN {cut("name_norm", stop)} WHEN {cut("name_norm", D.FILLER_TOKENS)} <> '' THEN {cut("name_norm", D.FILLER_TOKENS)} ELSE name_norm END AS name_core,
    {cut("alt0", stop)} AS alt1, {address_tokens("a0")} AS a1 FROM n1),
n3 AS (SELECT *, {joined(first_of_each("a1"))} AS addr_norm FROM n2),
n4 AS (SELECT *, list_filter(list_transform(regexp_extract_all(addr_norm, '\\d+'), lambda x: ltrim(x, '0')), lambda x: x <> '') AS d0 FROM n3),
records AS (
  SELECT entity_id, country, ckey, business_name, business_address, name_norm, name_core, CASE WHEN alt1 <> '' THEN alt1 ELSE name_core END AS name_alt,
    {sound("name_core")} AS name_phon, addr_norm, {first_of_each("d0")} AS addr_nums, addr_norm <> '' AS has_addr, translit,
    (count(*) OVER (PARTITION BY ckey, name_core))::INT AS name_freq FROM n4),
queries AS (SELECT * FROM records WHERE entity_id LIKE 'S1-%'),
targets AS (SELECT * FROM records WHERE entity_id NOT LIKE 'S1-%')"""


def _terms(field) -> str:
    word = "list_filter(string_split({}, ' '), lambda t: t <> '')"
    if field.kind == "word":
        return word.format(field.column)
    names = f"list_filter({word.format(field.column)}, lambda t: regexp_matches(t, '^[a-z][a-z0-9]+$'))"
    return f"flatten(list_transform({names}, lambda a: list_transform({word.format(field.other)}, lambda b: a || '|' || b)))"


def _vectors(c) -> str:
    """CTEs v_<channel>_q and v_<channel>_t."""
    pool = {"no_addr": "NOT has_addr", "translit": "translit", None: "true"}[c.pool]
    blocks = " UNION ALL ".join(f"SELECT entity_id, ckey, {k} AS block, unnest({_terms(f)}) AS term, {f.weight}::DOUBLE AS share, {pool} AS searchable FROM records" for k, f in enumerate(c.fields))
    n = c.name
    return f"""
tf_{n} AS (SELECT entity_id, ckey, block, term, share, searchable, count(*) AS tf FROM ({blocks}) GROUP BY ALL),
size_{n} AS (SELECT ckey, count(*) AS n FROM targets WHERE {pool} GROUP BY ckey),
idf_{n} AS (
  SELECT ckey, block, term, ln((1.0::DOUBLE + n) / (1.0::DOUBLE + count(*))) + 1 AS idf FROM tf_{n} JOIN size_{n} USING (ckey)
  WHERE entity_id NOT LIKE 'S1-%' AND searchable GROUP BY ckey, block, term, n HAVING count(*) <= greatest(50, floor({c.max_df_frac}::DOUBLE * n))),
x_{n} AS (SELECT entity_id, ckey, block, term, share, (1 + ln(tf::DOUBLE)) * idf AS x, searchable FROM tf_{n} JOIN idf_{n} USING (ckey, block, term)),
y_{n} AS (SELECT *, x * sqrt(share) / sqrt(sum(x * x) OVER (PARTITION BY entity_id, block)) AS y FROM x_{n}),
v_{n} AS (SELECT entity_id, ckey, block, term, searchable, y / sqrt(sum(y * y) OVER (PARTITION BY entity_id)) AS w FROM y_{n}),
dot_{n} AS (
  SELECT a.entity_id AS s1_id, b.entity_id AS t_id, bool_and(b.searchable) AS searchable, round(sum(a.w * b.w), 6) AS score
  FROM v_{n} a JOIN v_{n} b USING (ckey, block, term) WHERE a.entity_id LIKE 'S1-%' AND b.entity_id NOT LIKE 'S1-%' GROUP BY 1, 2),
hit_{n} AS (
  SELECT s1_id, t_id, score, (row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, t_id) - 1)::INT AS rank FROM dot_{n}
  WHERE searchable AND score > {c.min_score}::DOUBLE QUALIFY rank < {c.top_k})"""


def _candidates() -> str:
    of = channels()
    ids = " UNION ".join(f"SELECT s1_id, t_id FROM hit_{c.name}" for c in of)
    columns = ", ".join(f"coalesce(h_{c.name}.rank, -1)::INT AS rank_{c.name}, coalesce(d_{c.name}.score, 0) AS cos_{c.name}" for c in of)
    joins = " ".join(f"LEFT JOIN hit_{c.name} h_{c.name} USING (s1_id, t_id) LEFT JOIN dot_{c.name} d_{c.name} USING (s1_id, t_id)" for c in of)
    return ",".join(_vectors(c) for c in of) + f""",
pairs AS (SELECT s1_id, t_id, {columns} FROM ({ids}) {joins}),
labeled AS (SELECT p.*, (t.t_id IS NOT NULL)::INT AS label FROM pairs p LEFT JOIN (SELECT DISTINCT * FROM truth) t USING (s1_id, t_id)),
scores AS (SELECT s1_id, t_id, label, round(0.6::DOUBLE * cos_both + 0.4::DOUBLE * cos_addr, 6) AS p FROM labeled),
ids AS (SELECT entity_id AS s1_id, ckey FROM queries)"""


RECORDS, CANDIDATES = "WITH " + _records(), "WITH " + _records() + "," + _candidates()
NAMES = [c.name for c in channels()]
F_HALF = "CASE WHEN n_pred = 0 AND n_true = 0 THEN 1 WHEN tp = 0 THEN 0 ELSE 1.25::DOUBLE * (tp::DOUBLE / n_pred) * (tp::DOUBLE / n_true) / (0.25::DOUBLE * (tp::DOUBLE / n_pred) + tp::DOUBLE / n_true) END::DOUBLE"
EXCLUSIVE = "SELECT s1_id, t_id, p FROM scores QUALIFY row_number() OVER (PARTITION BY t_id ORDER BY p DESC, s1_id) = 1"
MATCHED = f", matched AS (SELECT * FROM ({EXCLUSIVE}) WHERE p >= 0.6::DOUBLE)"
PER_ENTITY = MATCHED + f""", counts AS (
  SELECT ids.s1_id, ids.ckey, coalesce(sum(x.a * x.b), 0)::BIGINT AS tp, coalesce(sum(x.a), 0)::BIGINT AS n_pred, coalesce(sum(x.b), 0)::BIGINT AS n_true
  FROM ids LEFT JOIN (SELECT s1_id, t_id, max(a) AS a, max(b) AS b FROM (SELECT s1_id, t_id, 1 AS a, 0 AS b FROM matched UNION ALL SELECT s1_id, t_id, 0, 1 FROM truth) GROUP BY 1, 2) x USING (s1_id) GROUP BY 1, 2),
entity AS (SELECT *, {F_HALF} AS f FROM counts)"""
SUMMARY = """avg(f) AS macro_f, sum(tp)::DOUBLE / nullif(sum(n_pred), 0) AS micro_precision, sum(tp)::DOUBLE / nullif(sum(n_true), 0) AS micro_recall,
  avg(CASE WHEN n_true = 0 THEN (n_pred = 0)::INT::DOUBLE END) AS singleton_accuracy, count(*) AS n_s1"""


def _words_of(x: str) -> str:
    return f"list_sort(list_filter(string_split({x}, ' '), lambda t: t <> ''))"


def _ratio_row(name: str, a: str, b: str) -> str:
    return f"SELECT s1_id, t_id, '{name}' AS name, {a} AS x, {b} AS y, NULL::DOUBLE AS fixed FROM both_sides"


def _set_rows(name: str, a: str, b: str) -> str:
    """Shared words, and these with the rest of either side: up to three pairs, of which the best counts."""
    part = lambda *x: f"array_to_string(list_concat({', '.join(x)}), ' ')" if len(x) > 1 else f"array_to_string({x[0]}, ' ')"
    one, two, shared = part("s", "l"), part("s", "r"), part("s")
    pair = lambda x, y: f"{{'x': {x}, 'y': {y}, 'fixed': NULL::DOUBLE}}"
    known = lambda v: f"[{{'x': NULL::VARCHAR, 'y': NULL::VARCHAR, 'fixed': {v}::DOUBLE}}]"
    return f"""SELECT s1_id, t_id, '{name}' AS name, unnest(CASE WHEN x IS NULL OR y IS NULL THEN {known('NULL')} WHEN len(x) = 0 OR len(y) = 0 THEN {known(0)} WHEN len(s) > 0 AND (len(l) = 0 OR len(r) = 0) THEN {known(1)}
      WHEN len(s) = 0 THEN [{pair(one, two)}] ELSE [{pair(one, two)}, {pair(shared, one)}, {pair(shared, two)}] END, recursive := true)
    FROM (SELECT *, list_sort(list_intersect(x, y)) AS s, list_sort(list_filter(x, lambda t: NOT list_contains(y, t))) AS l, list_sort(list_filter(y, lambda t: NOT list_contains(x, t))) AS r
      FROM (SELECT s1_id, t_id, list_distinct({_words_of(a)}) AS x, list_distinct({_words_of(b)}) AS y FROM both_sides))"""


def _scores(rows: list[str]) -> str:
    """CTE ``likeness`` (s1_id, t_id, name, v): twice the longest common subsequence by the lengths, over the distinct pairs of strings.

    A row of the table of subsequences is the bits of one number, of 126 symbols at most.
    """
    return f"""rows AS ({' UNION ALL '.join(rows)}),
texts AS (SELECT DISTINCT x, y FROM rows WHERE fixed IS NULL AND x IS NOT NULL AND y IS NOT NULL),
masks AS (SELECT x, y, (1::HUGEINT << length(x)) - 1 AS f, list_transform(string_split(y, ''), lambda ch: list_sum(list_transform(range(length(x)), lambda i: CASE WHEN substr(x, i + 1, 1) = ch THEN 1::HUGEINT << i::INT ELSE 0::HUGEINT END))::HUGEINT) AS m FROM texts WHERE x <> '' AND y <> ''),
common AS (SELECT x, y, length(x) - bit_count(list_reduce([f] || m, lambda a, b: ((a + (a & b)) | (a - (a & b))) & f)) AS n FROM masks),
likeness AS (
  SELECT s1_id, t_id, name, max(CASE WHEN fixed IS NOT NULL THEN fixed WHEN rows.x IS NULL OR rows.y IS NULL THEN NULL WHEN rows.x = '' AND rows.y = '' THEN 1 ELSE 2.0::DOUBLE * coalesce(n, 0) / (length(rows.x) + length(rows.y)) END) AS v
  FROM rows LEFT JOIN common ON rows.x = common.x AND rows.y = common.y GROUP BY ALL)"""


def _string_features() -> str:
    rows, names = [], [n for n, _, f in STRINGS if f not in ("partial", "jaro_winkler")]
    for name, column, scorer in STRINGS:
        a, b = (f"replace({s}_name_core, ' ', '')" if column == "name_nospace" else f"{s}_{column}" for s in "qt")
        if scorer == "ratio":
            rows.append(_ratio_row(name, a, b))
        elif scorer == "token_sort":
            rows.append(_ratio_row(name, f"array_to_string({_words_of(a)}, ' ')", f"array_to_string({_words_of(b)}, ' ')"))
        elif scorer == "token_set":
            rows.append(_set_rows(name, a, b))
    columns = ("name_core", "name_norm", "name_alt", "name_phon", "addr_norm")
    sides = ", ".join(f"{x}.{c} AS {s}_{c}" for x, s in (("a", "q"), ("b", "t")) for c in columns)
    values = ", ".join(f"round(max(CASE WHEN name = '{n}' THEN v END), 9) AS {n}" for n in names)
    winkler = "round(CASE WHEN q_name_core = '' AND t_name_core = '' THEN 1 ELSE jaro_winkler_similarity(q_name_core, t_name_core) END, 9) AS n_jw"
    return f"""{CANDIDATES}, both_sides AS (SELECT s1_id, t_id, {sides} FROM pairs JOIN queries a ON a.entity_id = s1_id JOIN targets b ON b.entity_id = t_id), {_scores(rows)},
wide AS (SELECT s1_id, t_id, {values} FROM likeness GROUP BY ALL)
SELECT wide.*, {winkler} FROM wide JOIN both_sides USING (s1_id, t_id)"""


def _sibling_features() -> str:
    rows = [_set_rows(f"sib_top{k}_{f}", f"t_{f}", f"top{k}_{f}") for k in "12" for f in ("name", "addr")]
    values = ", ".join(f"round(max(CASE WHEN name = 'sib_top{k}_{f}' THEN v END), 6) AS sib_top{k}_{f}" for k in "12" for f in ("name", "addr"))
    text = lambda side, name: f"{side}.name_core AS {name}_name, {side}.addr_norm AS {name}_addr"
    return f"""{CANDIDATES}, ranked AS (SELECT s1_id, t_id, row_number() OVER (PARTITION BY s1_id ORDER BY p DESC, t_id) AS n FROM scores),
tops AS (SELECT s1_id, max(CASE WHEN n = 1 THEN t_id END) AS top1, max(CASE WHEN n = 2 THEN t_id END) AS top2 FROM ranked GROUP BY 1),
both_sides AS (SELECT s1_id, scores.t_id, {text('a', 't')}, {text('b', 'top1')}, {text('c', 'top2')} FROM scores JOIN tops USING (s1_id) JOIN targets a ON a.entity_id = scores.t_id LEFT JOIN targets b ON b.entity_id = top1 LEFT JOIN targets c ON c.entity_id = top2),
{_scores(rows)} SELECT s1_id, t_id, {values} FROM likeness GROUP BY ALL"""


def _validation() -> str:
    """Counts of the faults that ``queries.faulty`` plants, rule by rule, over both files."""
    files = []
    for file, pairs in (("matches", "matched"), ("candidates", "pairs")):
        files.append(f"SELECT '{file}' AS file, ids.s1_id, (regexp_extract(ids.s1_id, '(\\d+)$', 1)::BIGINT // 3) % 8 AS k, list_distinct(list_filter(list(x.t_id), lambda t: t IS NOT NULL)) AS l FROM ids LEFT JOIN {pairs} x USING (s1_id) GROUP BY ids.s1_id")
    extra = "CASE k WHEN 3 THEN ['S2-999999999'] WHEN 4 THEN ['S2-1', 'S2-1'] WHEN 5 THEN ['S1-0'] WHEN 6 THEN ['X-1'] ELSE [] END"
    rule = lambda name, where: f"SELECT file, '{name}' AS rule, count(*) FILTER ({where}) AS n FROM answer GROUP BY file"
    return f"""{CANDIDATES}{MATCHED}, lists AS ({' UNION ALL '.join(files)}),
answer AS (SELECT file, k, CASE WHEN k = 2 THEN s1_id || '00' ELSE s1_id END AS s1_id, list_concat(l, {extra}) AS l FROM lists, range(2) c(i) WHERE k <> 1 AND (i = 0 OR k = 0)),
held AS (SELECT DISTINCT file, unnest(l) AS t_id FROM answer),
seen AS (SELECT file, s1_id, count(*) AS n FROM answer GROUP BY ALL),
inside AS (SELECT DISTINCT file, s1_id, unnest(l) AS t_id FROM answer),
counts AS (
  SELECT file, 'repeated source 1 id' AS rule, count(*) FILTER (n > 1) AS n FROM seen GROUP BY file
  UNION ALL SELECT f, 'missing source 1 id', (SELECT count(*) FROM ids WHERE s1_id NOT IN (SELECT s1_id FROM seen WHERE file = f)) FROM unnest(['matches', 'candidates']) u(f)
  UNION ALL SELECT file, 'unexpected source 1 id', count(*) FILTER (s1_id NOT IN (SELECT s1_id FROM ids)) FROM seen GROUP BY file
  UNION ALL SELECT file, 'unknown id', count(*) FILTER (t_id NOT IN (SELECT entity_id FROM targets)) FROM held GROUP BY file
  UNION ALL {rule('repeated id in a list', 'len(list_distinct(l)) < len(l)')}
  UNION ALL {rule('match with source 1', "len(list_filter(l, lambda t: t LIKE 'S1-%')) > 0")}
  UNION ALL {rule('wrong prefix', "len(list_filter(l, lambda t: NOT regexp_matches(t, '^S[123]-'))) > 0")})
SELECT file, rule, 'error' AS severity, n FROM counts
UNION ALL SELECT 'matches', 'match is no candidate', 'warning', count(*) FROM inside WHERE file = 'matches' AND (s1_id, t_id) NOT IN (SELECT (s1_id, t_id) FROM inside WHERE file = 'candidates')"""


def _id_hash(salt: int) -> str:
    x = f"((nullif(regexp_extract(entity_id, '(\\d+)$', 1), '')::BIGINT + {salt * 1_000_000_007}) % 4294967296)"
    for _ in range(2):
        x = f"((xor({x}, {x} // 65536) * 73244475) % 4294967296)"
    return f"xor({x}, {x} // 65536)"


def sql() -> dict[str, str]:
    gaps = lambda prefix, key: ", ".join(f"cos_{c} - max(cos_{c}) OVER (PARTITION BY {key}) AS s0_{prefix}gap_{c}" for c in NAMES)
    scored = "scored AS (SELECT *, row_number() OVER (PARTITION BY t_id ORDER BY cos_both DESC, s1_id) AS place FROM pairs)"
    out = {
        "normalize_records": f"{RECORDS} SELECT * EXCLUDE (addr_nums), array_to_string(addr_nums, ',') AS addr_nums FROM records",
        "name_frequency": f"{RECORDS} SELECT ckey, name_core, count(*)::INT AS name_freq FROM records GROUP BY ALL",
        "script_profile": f"{RECORDS} SELECT ckey, substr(entity_id, 1, 2) AS source, count(*) AS n, avg(translit::INT) AS share_translit, avg(regexp_matches(business_name, '[^\\x00-\\x7F]')::INT) AS share_not_ascii, avg((NOT has_addr)::INT) AS share_no_address FROM records GROUP BY 1, 2",
        "null_profile": "SELECT count(*) AS n, count(*) FILTER (url IS NULL) AS url_nulls, count(*) FILTER (html IS NULL) AS html_nulls, count(DISTINCT url) AS urls FROM pages",
        "id_hash_folds": f"{RECORDS} SELECT entity_id, {_id_hash(0)} AS h0, {_id_hash(1)} AS h1, ({_id_hash(0)} % 5)::INT AS fold FROM records",
        "bernoulli_sample": f"{RECORDS} SELECT entity_id FROM records WHERE {_id_hash(3)} % 1000000 < 300000",
        "seeded_sample": f"{RECORDS} SELECT entity_id, name_core FROM records ORDER BY md5(entity_id || ':0'), entity_id LIMIT 15",
        "char_grams": f"{RECORDS}, g AS (SELECT entity_id, '<' || unnest(list_filter(string_split(name_core, ' '), lambda t: t <> '')) || '>' AS g FROM records) SELECT gram, count(*) AS n, count(DISTINCT entity_id) AS df FROM (SELECT entity_id, unnest(list_transform(range(1, greatest(length(g) - 2, 1) + 1), lambda i: substr(g, i, 3))) AS gram FROM g) GROUP BY gram",
        "country_source_counts": f"{RECORDS} SELECT ckey, count(*) FILTER (entity_id LIKE 'S1-%') AS s1, count(*) FILTER (entity_id LIKE 'S2-%') AS s2, count(*) FILTER (entity_id LIKE 'S3-%') AS s3 FROM records GROUP BY ckey",
        "match_histogram": f"{RECORDS}, c AS (SELECT entity_id, count(DISTINCT t_id) AS matches FROM queries LEFT JOIN truth ON s1_id = entity_id GROUP BY 1) SELECT matches, count(*) AS n FROM c GROUP BY 1",
        "shared_targets": f"{RECORDS}, c AS (SELECT t_id, count(DISTINCT s1_id) AS holders FROM truth GROUP BY 1) SELECT holders, count(*) AS n FROM c GROUP BY 1",
        "tfidf_postings": f"{CANDIDATES} SELECT entity_id, block, term, round(w, 6) AS w FROM v_both",
        "document_frequency": f"{CANDIDATES} SELECT ckey, term, round(idf, 9) AS idf FROM idf_addr",
        "source_files": f"{RECORDS} SELECT entity_id, nullif(business_name, '') AS business_name, nullif(business_address, '') AS business_address, nullif(country, '') AS country FROM raw",
        "truth_files": f"{RECORDS} SELECT DISTINCT s1_id, t_id FROM truth",
        "file_lines": f"{RECORDS} SELECT count(*) AS n FROM queries",
        "dev_slice": f"{RECORDS}, q AS (SELECT entity_id FROM queries WHERE {_id_hash(1)} % 1000000 < 300000) SELECT entity_id FROM q UNION ALL SELECT entity_id FROM targets WHERE CASE WHEN entity_id LIKE 'S2-%' THEN {_id_hash(2)} ELSE {_id_hash(3)} END % 1000000 < 200000 OR entity_id IN (SELECT t_id FROM truth WHERE s1_id IN (SELECT entity_id FROM q))",
        "tables_together": f"{RECORDS} SELECT entity_id, ckey, name_core FROM targets",
        "query_range": f"{CANDIDATES} SELECT s1_id, t_id, cos_both FROM pairs WHERE s1_id >= 'S1-1' AND s1_id < 'S1-2'",
        "candidate_faults": "SELECT * FROM (VALUES ('good', true), ('column', false), ('repeated', false), ('rank', false), ('key', false)) t(\"case\", valid)",
        "candidate_report": f"{CANDIDATES}, w AS (SELECT p.*, ids.ckey, label, row_number() OVER (PARTITION BY s1_id ORDER BY s.p DESC, t_id) AS place FROM pairs p JOIN ids USING (s1_id) JOIN scores s USING (s1_id, t_id) QUALIFY place <= 60), u AS (SELECT ckey, s1_id, label, 'union' AS what FROM w "
        + " ".join(f"UNION ALL SELECT ckey, s1_id, label, '{n}' FROM w WHERE rank_{n} >= 0" for n in NAMES)
        + " ".join(f" UNION ALL SELECT ckey, s1_id, label, 'top {n}' FROM w WHERE place <= {n}" for n in (1, 5, 20))
        + "), e AS (SELECT ckey, what, s1_id, count(*) AS n, sum(label) AS hits FROM u GROUP BY ALL), n AS (SELECT ckey, count(*) AS true_pairs FROM (SELECT DISTINCT * FROM truth) JOIN ids USING (s1_id) GROUP BY 1) SELECT e.ckey, what, coalesce(max(true_pairs), 0) AS true_pairs, sum(hits)::BIGINT AS hits, sum(hits)::DOUBLE / max(true_pairs) AS recall, sum(n)::BIGINT AS candidates, avg(n) AS avg_per_query, quantile_disc(n, 0.95)::BIGINT AS p95, quantile_disc(n, 0.99)::BIGINT AS p99 FROM e LEFT JOIN n USING (ckey) GROUP BY 1, 2",
        "feature_means": f"{CANDIDATES}, {scored}, f AS (SELECT label, cos_both, {' + '.join(f'(x.rank_{c} >= 0)::INT' for c in NAMES)} AS k, count(*) OVER q AS qn, least(rank() OVER (PARTITION BY x.t_id ORDER BY cos_both DESC), 9) AS r, CASE WHEN cos_both >= max(cos_both) OVER t THEN cos_both - coalesce(max(CASE WHEN place = 2 THEN cos_both END) OVER t, 0) ELSE cos_both - max(cos_both) OVER t END AS m FROM scored x JOIN (SELECT s1_id, t_id, label FROM labeled) USING (s1_id, t_id) WINDOW q AS (PARTITION BY x.s1_id), t AS (PARTITION BY x.t_id)) SELECT label, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM f), 9) AS share, round(avg(cos_both), 9) AS cos_both, round(avg(k), 9) AS s0_n_channels, round(avg(qn), 9) AS q_n_cands, round(avg(r), 9) AS t_rank_cos_both, round(avg(m), 9) AS t_margin_cos_both FROM f GROUP BY label",
        "error_examples": f"{CANDIDATES}{MATCHED} SELECT m.s1_id, m.t_id, p, a.business_name AS q_name, a.business_address AS q_address, b.business_name AS t_name, b.business_address AS t_address FROM matched m JOIN queries a ON a.entity_id = s1_id JOIN targets b ON b.entity_id = t_id WHERE (s1_id, t_id) NOT IN (SELECT (s1_id, t_id) FROM truth)",
        "candidate_union": f"{CANDIDATES} SELECT * FROM pairs",
        "pair_cosines": f"{CANDIDATES} SELECT t.s1_id, t.t_id, coalesce(score, 0) AS cos FROM (SELECT DISTINCT * FROM truth) t LEFT JOIN dot_name USING (s1_id, t_id)",
        "candidate_recall": f"{CANDIDATES}, n AS (SELECT s1_id, count(*) AS n FROM pairs GROUP BY 1) SELECT (SELECT count(*) FROM (SELECT DISTINCT * FROM truth)) AS true_pairs, (SELECT sum(label)::BIGINT FROM labeled) AS hits, sum(n)::BIGINT AS candidates, avg(n) AS avg_per_query, quantile_disc(n, 0.95)::BIGINT AS p95, quantile_disc(n, 0.99)::BIGINT AS p99, (SELECT sum(label)::DOUBLE FROM labeled) / (SELECT count(*) FROM (SELECT DISTINCT * FROM truth)) AS recall FROM n",
        "recall_by_channel": f"{CANDIDATES} SELECT 'union' AS channel, count(*) AS pairs, sum(label)::BIGINT AS hits FROM labeled " + " ".join(f"UNION ALL SELECT '{n}', count(*), sum(label)::BIGINT FROM labeled WHERE rank_{n} >= 0 HAVING count(*) > 0" for n in NAMES),
        "recall_by_cutoff": f"{CANDIDATES} SELECT k::INT AS k, count(*) FILTER (rank_name BETWEEN 0 AND k - 1 AND label = 1) AS hits FROM labeled, unnest([5, 10, 20, 40]) u(k) GROUP BY 1",
        "stage0_features": f"{CANDIDATES} SELECT *, count(*) OVER (PARTITION BY s1_id) AS s0_q_n, count(*) OVER (PARTITION BY t_id) AS s0_t_n, ({' + '.join(f'(rank_{c} >= 0)::INT' for c in NAMES)})::INT AS s0_n_channels, {gaps('q', 's1_id')}, {gaps('t', 't_id')} FROM pairs",
        "context_features": f"{CANDIDATES}, {scored} SELECT * EXCLUDE (place), count(*) OVER q AS q_n_cands, "
        + ", ".join(f"{s} - max({s}) OVER q AS q_gap_{s}, (row_number() OVER (PARTITION BY s1_id ORDER BY {s} DESC, t_id))::INT AS q_rank_{s}, {s} - max({s}) OVER t AS t_gap_{s}" for s in ("cos_both", "cos_name", "cos_addr"))
        + ", count(*) OVER t AS t_n_q, least(rank() OVER (PARTITION BY t_id ORDER BY cos_both DESC), 9)::INT AS t_rank_cos_both, CASE WHEN cos_both >= max(cos_both) OVER t THEN cos_both - coalesce(max(CASE WHEN place = 2 THEN cos_both END) OVER t, 0) ELSE cos_both - max(cos_both) OVER t END AS t_margin_cos_both FROM scored WINDOW q AS (PARTITION BY s1_id), t AS (PARTITION BY t_id)",
        "set_features": f"{CANDIDATES}, r AS (SELECT s1_id, t_id, a.name_core AS qc, b.name_core AS tc, a.addr_norm AS qr, b.addr_norm AS tr, string_split(a.name_core, ' ') AS qn, string_split(b.name_core, ' ') AS tn, string_split(a.addr_norm, ' ') AS qa, string_split(b.addr_norm, ' ') AS ta, a.addr_nums AS qd, b.addr_nums AS td, b.translit, b.has_addr, a.name_freq AS qf, b.name_freq AS tf FROM pairs JOIN queries a ON a.entity_id = s1_id JOIN targets b ON b.entity_id = t_id), "
        "s AS (SELECT *, len(list_intersect(qn, tn)) AS c1, len(list_distinct(list_concat(qn, tn))) AS u1, len(list_intersect(qa, ta)) AS c2, len(list_distinct(list_concat(qa, ta))) AS u2, len(list_intersect(qd, td)) AS c3, len(list_distinct(list_concat(qd, td))) AS u3 FROM r) "
        "SELECT s1_id, t_id, c1::INT AS ntok_common, CASE WHEN u1 > 0 THEN c1::DOUBLE / u1 END AS ntok_jacc, c2::INT AS atok_common, CASE WHEN u2 > 0 THEN c2::DOUBLE / u2 END AS atok_jacc, c3::INT AS num_common, CASE WHEN u3 > 0 THEN c3::DOUBLE / u3 END AS num_jacc, len(qd)::INT AS q_n_nums, len(td)::INT AS t_n_nums, (qd[1] = td[1])::INT AS num_first_eq, (qn[1] = tn[1])::INT AS ntok_first_eq, len(qn)::INT AS q_n_tokens, len(tn)::INT AS t_n_tokens, (len(qd) > 0 AND len(td) > 0 AND c3 = 0)::INT AS num_conflict, (len(td) > 0 AND c3 = len(td))::INT AS num_t_subset, (t_id LIKE 'S3-%')::INT AS t_is_s3, translit::INT AS t_translit, has_addr::INT AS t_has_addr, (qc = tc)::INT AS name_core_eq, (qr = tr)::INT AS addr_eq, qf AS q_name_freq, tf AS t_name_freq, abs(length(qc) - length(tc))::INT AS len_diff FROM s",
        "string_features": _string_features(),
        "stage2_siblings": _sibling_features(),
        "stage2_context": f"{CANDIDATES}, r AS (SELECT s1_id, t_id, p AS p1, row_number() OVER (PARTITION BY s1_id ORDER BY p DESC, t_id) AS qr, row_number() OVER (PARTITION BY t_id ORDER BY p DESC, s1_id) AS tr FROM scores), w AS (SELECT *, max(p1) OVER q AS q_p1_max, coalesce(max(CASE WHEN qr = 2 THEN p1 END) OVER q, 0) AS q_p1_second, count(*) FILTER (p1 >= 0.5::DOUBLE) OVER q AS q_p1_n50, count(*) FILTER (p1 >= 0.2::DOUBLE) OVER q AS q_p1_n20, max(p1) OVER t AS t_p1_max, coalesce(max(CASE WHEN tr = 2 THEN p1 END) OVER t, 0) AS t_p1_second, count(*) FILTER (p1 >= 0.2::DOUBLE) OVER t AS t_p1_n20 FROM r WINDOW q AS (PARTITION BY s1_id), t AS (PARTITION BY t_id)) SELECT s1_id, t_id, p1, qr::INT AS q_p1_rank, q_p1_max, q_p1_second, q_p1_n50, q_p1_n20, t_p1_max, t_p1_second, t_p1_n20, p1 - q_p1_max AS q_p1_gap, (tr = 1)::INT AS t_is_best_q, CASE WHEN tr = 1 THEN t_p1_second ELSE t_p1_max END AS t_p1_best_other, (qr = 1)::INT AS is_top1, p1 - CASE WHEN tr = 1 THEN t_p1_second ELSE t_p1_max END AS t_p1_margin FROM w",
        "prune_top": f"{CANDIDATES} SELECT s1_id, t_id, p AS score0 FROM scores QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY p DESC, t_id) <= 10",
        "label_join": f"{CANDIDATES} SELECT s1_id, t_id, label FROM labeled",
        "exclusive": f"{CANDIDATES} {EXCLUSIVE}",
        "threshold": f"{CANDIDATES} SELECT s1_id, t_id, p FROM scores WHERE p >= 0.5::DOUBLE",
        "expected_f": f"{CANDIDATES}, e AS (SELECT *, row_number() OVER d AS k, sum(p) OVER d AS cum, sum(p) OVER (PARTITION BY s1_id) AS total, exp(sum(ln(greatest(least(1 - p, 1), 1e-9::DOUBLE))) OVER (PARTITION BY s1_id)) AS empty FROM ({EXCLUSIVE}) WHERE p >= 0.02::DOUBLE WINDOW d AS (PARTITION BY s1_id ORDER BY p DESC, t_id ROWS UNBOUNDED PRECEDING)), f AS (SELECT *, 1.25::DOUBLE * cum / (0.25::DOUBLE * total + k) AS ef FROM e), g AS (SELECT *, max(ef) OVER (PARTITION BY s1_id) AS best FROM f), h AS (SELECT *, min(CASE WHEN ef = best THEN k END) OVER (PARTITION BY s1_id) AS take FROM g) SELECT s1_id, t_id, p FROM h WHERE best > empty AND k <= take",
        "threshold_grid": f"{CANDIDATES}, x AS (SELECT *, row_number() OVER (PARTITION BY t_id ORDER BY p DESC, s1_id) = 1 AS first FROM scores), grid AS (SELECT s1_id, e AS exclusive, (t / 100.0)::DOUBLE AS tau FROM ids, unnest([false, true]) a(e), unnest([20, 40, 60, 80]) b(t)), n AS (SELECT s1_id, count(DISTINCT t_id) AS n_true FROM truth GROUP BY 1), c AS (SELECT g.s1_id, g.exclusive, g.tau, count(x.t_id) AS n_pred, coalesce(sum(x.label), 0) AS tp, coalesce(max(n_true), 0) AS n_true FROM grid g LEFT JOIN x ON x.s1_id = g.s1_id AND x.p >= g.tau AND (NOT g.exclusive OR x.first) LEFT JOIN n ON n.s1_id = g.s1_id GROUP BY 1, 2, 3) SELECT exclusive, tau, round(avg({F_HALF}), 9) AS macro_f FROM c GROUP BY 1, 2",
        "expected_f_grid": f"{CANDIDATES}, e AS (SELECT s1_id, t_id, p, m, row_number() OVER d AS k, sum(p) OVER d AS cum, sum(p) OVER (PARTITION BY s1_id, m) AS total, exp(sum(ln(greatest(least(1 - p, 1), 1e-9::DOUBLE))) OVER (PARTITION BY s1_id, m)) / (1 + m) AS empty FROM ({EXCLUSIVE}), unnest([0.0, 0.05, 0.1, 0.2, 0.3]::DOUBLE[]) u(m) WHERE p >= 0.02::DOUBLE WINDOW d AS (PARTITION BY s1_id, m ORDER BY p DESC, t_id ROWS UNBOUNDED PRECEDING)), f AS (SELECT *, 1.25::DOUBLE * cum / (0.25::DOUBLE * (total + m) + k) AS ef FROM e), g AS (SELECT *, max(ef) OVER (PARTITION BY s1_id, m) AS best FROM f), h AS (SELECT *, min(CASE WHEN ef = best THEN k END) OVER (PARTITION BY s1_id, m) AS take FROM g), chosen AS (SELECT s1_id, t_id, m FROM h WHERE best > empty AND k <= take), n AS (SELECT s1_id, count(DISTINCT t_id) AS n_true FROM truth GROUP BY 1), c AS (SELECT ids.s1_id, u.m, count(x.t_id) AS n_pred, count(l.t_id) AS tp, coalesce(max(n_true), 0) AS n_true FROM ids CROSS JOIN unnest([0.0, 0.05, 0.1, 0.2, 0.3]::DOUBLE[]) u(m) LEFT JOIN chosen x ON x.s1_id = ids.s1_id AND x.m = u.m LEFT JOIN (SELECT DISTINCT * FROM truth) l ON l.s1_id = x.s1_id AND l.t_id = x.t_id LEFT JOIN n ON n.s1_id = ids.s1_id GROUP BY 1, 2) SELECT m AS missed, round(avg({F_HALF}), 9) AS macro_f FROM c GROUP BY 1",
        "per_entity_f": f"{CANDIDATES}{PER_ENTITY} SELECT s1_id, tp, n_pred, n_true, f FROM entity",
        "summary": f"{CANDIDATES}{PER_ENTITY}, s AS (SELECT {SUMMARY} FROM entity) SELECT round(macro_f, 9) AS macro_f, micro_precision, micro_recall, singleton_accuracy, n_s1 FROM s",
        "country_report": f"{CANDIDATES}{PER_ENTITY}, s AS (SELECT 'ALL' AS ckey, {SUMMARY} FROM entity UNION ALL SELECT ckey, {SUMMARY} FROM entity GROUP BY ckey) SELECT ckey, round(macro_f, 9) AS macro_f, micro_precision, micro_recall, singleton_accuracy, n_s1 FROM s",
        "score_summary": f"{CANDIDATES} SELECT label, count(*) AS n, round(avg(p), 9) AS mean_p FROM scores GROUP BY label",
        "calibration": f"{CANDIDATES} SELECT least(floor(p * 10), 9)::INT AS bin, round(avg(p), 9) AS mean_p, round(avg(label), 9) AS hit_rate, count(*) AS n FROM scores GROUP BY 1",
        "false_positives": f"{CANDIDATES}{MATCHED} SELECT s1_id, t_id, p FROM matched WHERE (s1_id, t_id) NOT IN (SELECT (s1_id, t_id) FROM truth)",
        "false_negatives": f"{CANDIDATES}{MATCHED} SELECT DISTINCT t.s1_id, t.t_id, s.p FROM truth t LEFT JOIN scores s USING (s1_id, t_id) WHERE (t.s1_id, t.t_id) NOT IN (SELECT (s1_id, t_id) FROM matched)",
        "match_lists": f"{CANDIDATES}{MATCHED} SELECT ids.s1_id AS source1_entity_id, coalesce(string_agg(t_id, ',' ORDER BY t_id), '') AS matched_entity_ids FROM ids LEFT JOIN matched USING (s1_id) GROUP BY 1",
        "candidate_lists": f"{CANDIDATES} SELECT ids.s1_id AS source1_entity_id, coalesce(string_agg(t_id, ',' ORDER BY t_id), '') AS candidate_entity_ids FROM ids LEFT JOIN pairs USING (s1_id) GROUP BY 1",
        "set_sizes": f"{CANDIDATES}{PER_ENTITY} SELECT ckey, avg((n_pred = 0)::INT) AS empty_rate, avg(n_pred) AS avg_matches FROM entity GROUP BY 1",
        "validate": _validation(),
    }
    for n in NAMES:
        out[f"retrieve_{n}"] = f"{CANDIDATES} SELECT s1_id, t_id, score, rank FROM hit_{n}"
    return out
