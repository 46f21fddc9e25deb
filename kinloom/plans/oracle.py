"""The queries once more, in DuckDB's SQL over the driver's tables. No look-around there: inner dots, hyphens and apostrophes are marked first, the rest replaced, and the marks undone."""

from __future__ import annotations

from ..functions.words import ADDRESS_STOPWORDS, COUNTRY_CODES, LEGAL_FORMS, NAME_STOPWORDS, NULL_CELLS, NULL_WORDS

W = r"[\p{L}\p{N}_]"
NOT_W = r"[^\p{L}\p{N}_]"
SPACE = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]"


def quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def sub(x: str, pattern: str, to: str) -> str:
    pattern, to = pattern.replace("'", "''"), to if to.startswith("\x00") else f"'{to}'"
    return f"regexp_replace({x}, '{pattern}', {to.lstrip(chr(0))}, 'g')"


def squeeze(x: str) -> str:
    return f"trim({sub(x, SPACE + '+', ' ')})"


def clean(x: str) -> str:
    inner = sub(f"lower({x})", r"[\t\r\n\x{a0}\x{200b}\x{feff}]", " ")
    return f"CASE WHEN lower({x}) IN ({quoted(NULL_WORDS)}) THEN '' ELSE {squeeze(inner)} END"


def loose(x: str, sign: str, mark: int) -> str:
    to = f"\x00'\\1' || chr({mark}) || '\\2'"
    kept = sub(sub(x, f"({W}){sign}({W})", to), f"({W}){sign}({W})", to)
    return f"replace(replace({kept}, '{sign.replace(chr(39), chr(39) * 2)}', ' '), chr({mark}), '{sign.replace(chr(39), chr(39) * 2)}')"


def dots(x: str) -> str:
    return sub(sub(x, rf"({W})\.({SPACE}|$)", r"\1\2"), rf"{SPACE}+\.{SPACE}+", " ")


def name(x: str) -> str:
    """Of a cleaned text."""
    x = sub(x, "[&+]", " and ")
    for _ in range(4):
        x = sub(x, rf"(^|{NOT_W})({W})\.({W})($|{NOT_W})", "\x00'\\1\\2' || chr(2) || '\\3\\4'")
    x = dots(f"replace({x}, chr(2), '')")
    x = sub(x, r"""[,;:/\\|()\[\]{}"~`!@#$%^*_=?<>]+""", " ")
    return squeeze(loose(loose(x, "-", 3), "'", 4))


def address(x: str) -> str:
    x = sub(dots(x), r"""[,;:/\\|()\[\]{}"~`!@#$%^&*_=?<>]+""", " ")
    return squeeze(loose(loose(x, "-", 3), "'", 4))


def alnum(x: str) -> str:
    return squeeze(sub(x, r"[^\p{L}\p{N}\p{M}]", " "))


def core(x: str) -> str:
    forms = "|".join(LEGAL_FORMS)
    cut = f"regexp_replace(regexp_replace({x}, '[ \\-]+(?:{forms})(?:[ \\-]+(?:{forms}))*$', ''), '^[ \\-]+|[ \\-]+$', '', 'g')"
    return f"CASE WHEN {cut} = '' THEN {x} ELSE {cut} END"


def country(x: str) -> str:
    bare = squeeze(sub(x, r"""^[ .,;:\-_()\[\]'"]+|[ .,;:\-_()\[\]'"]+$""", ""))
    code = lambda y: "CASE " + " ".join(f"WHEN {y} = '{n}' THEN '{c}'" for n, c in COUNTRY_CODES.items()) + " END"
    nodots = f"replace(b, '.', '')"
    return f"(SELECT coalesce({code('b')}, {code(nodots)}, b) FROM (SELECT {bare} AS b))"


def blank(x: str) -> str:
    return f"(trim({x}) = '' OR lower(trim({x})) IN ({quoted(NULL_WORDS)}))"


def kind(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} IN ({quoted(NULL_CELLS)}) THEN 'null' WHEN {x} = '' THEN 'empty' WHEN {sub(x, f'^{SPACE}+|{SPACE}+$', '')} = '' THEN 'whitespace' ELSE 'valid' END"


def rank(*parts: str, seed: int = 42) -> str:
    """The number that seed and parts decide."""
    return f"('0x' || substr(md5('{seed}|' || {" || '|' || ".join(parts)}), 1, 15))::BIGINT"


RECORDS = r"""
records AS MATERIALIZED (
  SELECT 's' || (doc_id % 3 + 1) || '_' || doc_id AS entity_id, regexp_extract(text, '^([^\n]*)', 1) AS business_name,
         regexp_replace(text, '^[^\n]*\n?', '') AS business_address, doc_id % 3 + 1 AS source, text,
         CASE WHEN source = 'src0' THEN '' WHEN lang = 'en' THEN 'United States' WHEN lang = 'de' THEN 'Deutschland' WHEN lang = 'fr' THEN 'FRA' ELSE lang END AS country
  FROM documents)"""
NORMAL = f""",
cleaned AS MATERIALIZED (SELECT *, {clean('business_name')} AS n0, {clean('business_address')} AS a0, {clean('country')} AS c0 FROM records),
named AS MATERIALIZED (SELECT *, {name('n0')} AS n, {address('a0')} AS a, {country('c0')} AS c FROM cleaned),
normal AS MATERIALIZED (SELECT *, {core('n')} AS core, {alnum(name(clean('n')))} AS an, {alnum(address(clean('a')))} AS aa FROM named)"""
TRUTH = f""",
sized AS (SELECT text, ceil(count(*) / 500.0)::BIGINT AS n FROM records WHERE source > 1 AND text IS NOT NULL GROUP BY text),
lists AS (SELECT r.text, string_agg(entity_id, ',' ORDER BY entity_id) AS ids FROM records r JOIN sized USING (text)
  WHERE source > 1 GROUP BY r.text, {rank('entity_id')} % n),
truth AS MATERIALIZED (SELECT r.entity_id AS source1_entity_id, coalesce(l.ids, '') AS matched_entity_ids
  FROM records r LEFT JOIN lists l USING (text) WHERE r.source = 1),
edges AS MATERIALIZED (SELECT a.entity_id AS s1, b.entity_id AS t, 'Source ' || b.source AS target_source
  FROM records a JOIN records b USING (text) WHERE a.source = 1 AND b.source > 1),
deg AS (SELECT r.entity_id AS s1, count(e.t) AS m FROM records r LEFT JOIN edges e ON e.s1 = r.entity_id WHERE r.source = 1 GROUP BY ALL)"""
#: Strategies and their bits, in the settings' order.
BITS = {"exact_name": 1, "name_token": 2, "name_prefix": 4, "address_conservative": 8, "country_scoped_name": 16}


def key_tables() -> str:
    """For blocking, a name is the core, or the alphanumeric name where that is blank."""
    words = lambda x: f"regexp_extract_all({x}, '{W}+')"
    d = lambda x: rf"regexp_full_match({x}, '\p{{Nd}}+')"
    good = f"t NOT IN ({quoted(NAME_STOPWORDS)})"
    beside = "(CASE WHEN i < len(ws) THEN ws[i + 1] ELSE ws[i - 1] END)"
    return f""",
fields1 AS MATERIALIZED (SELECT entity_id, source, c AS country, aa AS address, CASE WHEN {blank('core')} THEN an ELSE core END AS name FROM normal),
fields AS MATERIALIZED (SELECT *, {words('name')} AS nw, {words('address')} AS ws FROM fields1),
name_words AS MATERIALIZED (SELECT DISTINCT entity_id, source, country, unnest(nw) AS t FROM fields),
address_words AS MATERIALIZED (SELECT entity_id, source, country, ws, unnest(range(1, len(ws) + 1)) AS i FROM fields),
placed AS MATERIALIZED (SELECT *, ws[i] AS t, {beside} AS b FROM address_words),
keys AS MATERIALIZED (SELECT DISTINCT entity_id, source, country, key, bit FROM (
  SELECT entity_id, source, country, 'exact:' || name AS key, 1 AS bit FROM fields WHERE name <> ''
  UNION ALL SELECT entity_id, source, country, 'tok:' || t, 2 FROM name_words WHERE length(t) >= 3 AND {good}
  UNION ALL SELECT entity_id, source, country, 'pre4:' || t[1:4], 4 FROM name_words WHERE length(t) >= 4 AND {good}
  UNION ALL SELECT entity_id, source, country, 'addr_num:' || t || '_' || b, 8 FROM placed
    WHERE {d('t')} AND length(t) <= 6 AND b IS NOT NULL AND NOT {d('b')} AND b NOT IN ({quoted(ADDRESS_STOPWORDS)}) AND length(b) >= 3
  UNION ALL SELECT entity_id, source, country, 'addr_zip:' || t, 8 FROM placed WHERE {d('t')} AND length(t) IN (5, 6)
  UNION ALL SELECT entity_id, source, country, 'addr_tok:' || t, 8 FROM placed WHERE NOT {d('t')} AND length(t) >= 4 AND t NOT IN ({quoted(ADDRESS_STOPWORDS)})
  UNION ALL SELECT entity_id, source, country, 'c_name:' || CASE WHEN country = '' THEN 'unknown' ELSE country END || ':' || name, 16 FROM fields WHERE name <> ''
  UNION ALL SELECT entity_id, source, country, 'c_tok:' || CASE WHEN country = '' THEN 'unknown' ELSE country END || ':' || t, 16 FROM name_words WHERE length(t) >= 3 AND {good}))"""


def pair_tables(most: int, mode: str = "allow_missing") -> str:
    agree = {"allow_missing": "(a.country = '' OR b.country = '' OR a.country = b.country)", "strict": "(a.country <> '' AND a.country = b.country)", "none": "true"}[mode]
    return f""",
sizes AS MATERIALIZED (SELECT key, bit, count(*) AS size FROM keys WHERE source > 1 GROUP BY key, bit),
pairs AS MATERIALIZED (SELECT a.entity_id AS s1, b.entity_id AS t, CASE WHEN b.source = 2 THEN 'Source 2' ELSE 'Source 3' END AS target_source, bit_or(a.bit) AS mask
  FROM keys a JOIN keys b USING (key) JOIN sizes z USING (key) WHERE a.source = 1 AND b.source > 1 AND z.size <= {most} AND {agree} GROUP BY ALL),
flagged AS MATERIALIZED (SELECT e.*, p.s1 IS NOT NULL AS hit FROM edges e LEFT JOIN pairs p ON e.s1 = p.s1 AND e.t = p.t),
per AS MATERIALIZED (SELECT r.entity_id AS s1, count(p.t) AS n FROM records r LEFT JOIN pairs p ON p.s1 = r.entity_id WHERE r.source = 1 GROUP BY ALL)"""


def training_tables(per: int = 2, ratio: float = 0.5) -> str:
    """Negatives: ``per`` for each true pair, a share of them from blocking and from the same country."""
    return f""",
needs AS MATERIALIZED (SELECT s1, (count(*) * {per})::INT AS need FROM edges GROUP BY s1),
pool AS MATERIALIZED (SELECT entity_id AS t, country FROM fields WHERE source > 1),
places AS (SELECT t, country AS c, {rank('t')} AS h FROM pool WHERE country <> ''),
pieces AS MATERIALIZED (SELECT c, ceil(count(*) / 1000.0)::BIGINT AS pieces FROM places GROUP BY c),
ring AS MATERIALIZED (SELECT c, h % pieces AS piece, row_number() OVER (PARTITION BY c, h % pieces ORDER BY h, t) - 1 AS place, t
  FROM places JOIN pieces USING (c)),
rings AS (SELECT c, piece, count(*) AS n FROM ring GROUP BY ALL),
asks AS (SELECT s1, z.c, {rank('s1')} % pieces AS piece FROM needs JOIN fields f ON f.entity_id = s1 JOIN pieces z ON z.c = f.country),
steps AS (SELECT s1, c, piece, n, {rank("'ring'", 's1')} % n AS beginning, unnest(range(0, least(n, 50))) AS i FROM asks JOIN rings USING (c, piece)),
near AS (SELECT s1, t FROM steps a JOIN ring r ON r.c = a.c AND r.piece = a.piece AND r.place = (beginning + i) % n),
size AS (SELECT greatest(1, ceil(count(DISTINCT t) / 1000.0))::BIGINT AS buckets FROM pool),
dealt AS MATERIALIZED (SELECT bucket, row_number() OVER (PARTITION BY bucket ORDER BY h, t) - 1 AS place, t
  FROM (SELECT t, {rank('t')} AS h, {rank('t')} % buckets AS bucket FROM (SELECT DISTINCT t FROM pool), size)),
draws AS (SELECT s1, draw, {rank("'bucket'", 's1', 'draw')} % buckets AS bucket FROM (SELECT s1, unnest(range(1, need * 4 + 9)) AS draw FROM needs), size),
drawn AS (SELECT s1, t, draw FROM (SELECT s1, draw, d.bucket, {rank("'place'", 's1', 'draw')} % n AS place
  FROM draws d JOIN (SELECT bucket, count(*) AS n FROM dealt GROUP BY bucket) z ON z.bucket = d.bucket) x JOIN dealt USING (bucket, place)),
choices AS (SELECT s1, t, {rank('s1', 't')} AS r, NULL AS draw FROM (SELECT s1, t FROM pairs UNION ALL SELECT s1, t FROM near) UNION ALL SELECT s1, t, NULL, draw FROM drawn),
each AS (SELECT s1, t, min(r) AS r, min(draw) AS draw FROM choices GROUP BY ALL),
wanted AS (SELECT e.*, need FROM each e JOIN needs USING (s1) ANTI JOIN edges x ON x.s1 = e.s1 AND x.t = e.t),
hardened AS (SELECT *, r IS NOT NULL AND row_number() OVER (PARTITION BY s1 ORDER BY r NULLS LAST, t) <= floor(need * {ratio}) AS hard FROM wanted),
ordered AS (SELECT *, need - count(*) FILTER (hard) OVER (PARTITION BY s1) AS remaining,
  row_number() OVER (PARTITION BY s1 ORDER BY CASE WHEN NOT hard THEN draw END NULLS LAST, t) AS k FROM hardened),
training AS MATERIALIZED (SELECT s1 AS source1_entity_id, t AS target_entity_id, target_source, 1 AS label, 'positive' AS pair_type FROM edges
  UNION ALL SELECT s1, t, CASE WHEN t LIKE 's2%' THEN 'Source 2' ELSE 'Source 3' END, 0, CASE WHEN hard THEN 'hard_negative' ELSE 'random_negative' END
  FROM ordered WHERE hard OR (draw IS NOT NULL AND k <= remaining))"""


def names_of(mask: str = "mask") -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {mask} & {BITS[k]} <> 0 THEN '{k}' END" for k in sorted(BITS)) + ")"


def base(*parts: str) -> str:
    return "WITH " + RECORDS + "".join(parts) + "\n"


def feature_sql(pairs: str) -> str:
    """The 51 features of ``pairs`` (s1, t, target_source, names as a comma list)."""
    split = lambda x: f"list_distinct(list_filter(string_split({x}, ' '), lambda y: y <> ''))"
    num = rf"list_distinct(list_filter(regexp_extract_all(a, '{W}+'), lambda y: regexp_full_match(y, '\p{{Nd}}+')))"
    gram = "CASE WHEN length(n) >= 3 THEN list_distinct(list_transform(range(1, length(n) - 1), lambda i: substr(n, i, 3))) ELSE [] END"
    share = lambda a, b: f"CASE WHEN {b} > 0 THEN ({a})::DOUBLE / ({b}) ELSE 0.0 END"
    same = lambda k: f"(l.{k} <> '' AND l.{k} = r.{k})::INT::DOUBLE"
    inter = lambda k: f"len(list_intersect(l.{k}, r.{k}))"
    total = lambda k: f"(len(l.{k}) + len(r.{k}))"
    least = lambda k: f"least(len(l.{k}), len(r.{k}))"
    jac = lambda k: share(inter(k), f"({total(k)} - {inter(k)})")
    pre = lambda i: f"(length(l.n) >= {i} AND length(r.n) >= {i} AND l.n[1:{i}] = r.n[1:{i}])::INT::DOUBLE"
    diff = lambda k: f"abs(length(l.{k}) - length(r.{k}))::DOUBLE"
    rat = lambda k: share(f"least(length(l.{k}), length(r.{k}))", f"greatest(length(l.{k}), length(r.{k}))")
    flag = lambda x: f"({x})::INT::DOUBLE"
    miss = {"s1_name_missing": "l.m1", "target_name_missing": "r.m1", "s1_address_missing": "l.m2", "target_address_missing": "r.m2", "s1_country_missing": "l.m3", "target_country_missing": "r.m3"}
    cols = {
        "name_exact_match": same("n"), "name_core_exact_match": same("core"), "name_alnum_exact_match": same("an"), "name_char_length_diff": diff("n"), "name_char_length_ratio": rat("n"),
        "name_token_jaccard": jac("nt"), "name_token_overlap_count": f"{inter('nt')}::DOUBLE", "name_token_dice": share(f"2 * {inter('nt')}", total("nt")), "name_token_containment": share(inter("nt"), least("nt")),
        "name_prefix_match_3": pre(3), "name_prefix_match_5": pre(5), "name_char_qgram_jaccard": jac("q"),
        "address_exact_match": same("a"), "address_alnum_exact_match": same("aa"), "address_char_length_diff": diff("a"), "address_char_length_ratio": rat("a"),
        "address_token_jaccard": jac("at"), "address_token_overlap_count": f"{inter('at')}::DOUBLE", "address_token_dice": share(f"2 * {inter('at')}", total("at")), "address_token_containment": share(inter("at"), least("at")),
        "address_number_overlap_count": f"{inter('num')}::DOUBLE", "address_number_jaccard": jac("num"),
        "country_exact_match": flag("l.c <> '' AND r.c <> '' AND l.c = r.c"), "country_mismatch": flag("l.c <> '' AND r.c <> '' AND l.c <> r.c"), "country_missing_either": flag("l.c = '' OR r.c = ''"), "country_missing_both": flag("l.c = '' AND r.c = ''"),
        "is_target_source2": flag("p.target_source = 'Source 2' OR starts_with(p.t, 's2_')"), "is_target_source3": flag("p.target_source = 'Source 3' OR starts_with(p.t, 's3_')"),
        "strategy_count": "CASE WHEN p.names = '' THEN 1.0 ELSE len(string_split(p.names, ','))::DOUBLE END",
        **{f"strategy_{k}": flag(f"list_contains(string_split(p.names, ','), '{k}')") for k in (*BITS, "composite")},
        **{k: flag(x) for k, x in miss.items()}, "both_address_missing": flag("l.m2 AND r.m2"), "total_available_fields": "(" + " + ".join(f"(NOT {x})::INT" for x in miss.values()) + ")::DOUBLE",
        "s1_name_char_len": "length(l.n)::DOUBLE", "target_name_char_len": "length(r.n)::DOUBLE", "s1_name_token_count": "len(l.nt)::DOUBLE", "target_name_token_count": "len(r.nt)::DOUBLE",
        "s1_address_char_len": "length(l.a)::DOUBLE", "target_address_char_len": "length(r.a)::DOUBLE", "s1_address_token_count": "len(l.at)::DOUBLE", "target_address_token_count": "len(r.at)::DOUBLE",
    }
    lines = ", ".join(f"{x} AS {k}" for k, x in cols.items())
    return f""",
prepared AS MATERIALIZED (SELECT entity_id AS id, n, core, an, a, aa, c, {blank('business_name')} AS m1, {blank('business_address')} AS m2, {blank('country')} AS m3, {split('n')} AS nt, {gram} AS q, {split('a')} AS at, {num} AS num FROM normal),
features AS MATERIALIZED (SELECT p.s1 AS source1_entity_id, p.t AS target_entity_id, p.target_source, {lines} FROM ({pairs}) p JOIN prepared l ON l.id = p.s1 JOIN prepared r ON r.id = p.t)"""
