"""The registered queries as plain SQL over the same tables, written independently."""

from auditloom import fixed_values as fixed
from auditloom.functions.statistics import EXPECTED_SHARE

_METHODS = ", ".join(f"'{m}'" for m in fixed.EXTRACTION_METHODS)

_INVOICES = f"""
WITH per_order AS (
  SELECT l_orderkey, count(*) AS n_lines, sum(l_extendedprice) AS line_sum,
    CAST(round(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))), 2) AS DOUBLE) AS net,
    CAST(round(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
      * CAST(l_tax AS DECIMAL(4,2))), 2) AS DOUBLE) AS tax
  FROM lineitem GROUP BY l_orderkey),
invoices AS (
  SELECT o_orderkey AS invoice_idx, CAST(o_orderkey AS VARCHAR) AS numero_facture,
    c_name AS fournisseur, strftime(o_orderdate, '%d/%m/%Y') AS date_facture,
    CASE WHEN o_orderstatus <> 'P' THEN net END AS total_ht,
    CASE WHEN o_orderstatus <> 'P' THEN tax END AS tva_montant,
    coalesce(CASE WHEN o_orderstatus = 'F' THEN round(net + tax, 2) END, o_totalprice) AS total_ttc,
    list_extract([{_METHODS}], CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS extraction_method,
    coalesce(n_lines, 0) AS n_lines, coalesce(line_sum, 0.0) AS line_sum
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN per_order ON l_orderkey = o_orderkey)
"""

_LINES_FOUND = """
  SELECT invoice_idx, line_sum, reference FROM (
    SELECT *, CASE WHEN total_ht <> 0 THEN total_ht WHEN total_ttc <> 0 THEN total_ttc END AS reference
    FROM invoices WHERE extraction_method <> 'regex_fallback' AND n_lines > 0)
  WHERE abs(line_sum - reference) > 0.05 * reference + 0.02
"""

_TTC_FOUND = """
  SELECT invoice_idx, round(total_ht + tva_montant, 2) AS expected_ttc, total_ttc
  FROM invoices WHERE extraction_method <> 'regex_fallback'
    AND abs(round(total_ht + tva_montant, 2) - total_ttc) > 0.05
"""

_DETAIL_LINES = "printf('Somme lignes (%.2f) vs total (%.2f)', line_sum, reference)"
_DETAIL_TTC = "printf('HT+TVA (%.2f) != TTC (%.2f)', expected_ttc, total_ttc)"

_ZSCORE = """
  SELECT *, (total_ttc - mu) / sigma AS z FROM (
    SELECT invoice_idx, lower(fournisseur) AS supplier, total_ttc,
      count(total_ttc) OVER w AS n_history, avg(total_ttc) OVER w AS mu, stddev_pop(total_ttc) OVER w AS sigma
    FROM invoices WHERE fournisseur <> '' AND total_ttc IS NOT NULL
    WINDOW w AS (PARTITION BY lower(fournisseur) ORDER BY invoice_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
  WHERE n_history >= 5 AND sigma > 1e-12 * abs(mu) AND abs((total_ttc - mu) / sigma) > 3
"""

# first digits of all positive amounts, per invoice and in total
_DIGITS = """
amounts AS (
  SELECT invoice_idx, total_ttc AS a FROM invoices WHERE total_ttc > 0
  UNION ALL SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_extendedprice > 0),
digits AS (
  SELECT invoice_idx, CASE WHEN a >= 0.1 OR a < 0.0001
    THEN CAST(regexp_extract(CAST(a AS VARCHAR), '[1-9]') AS INTEGER) END AS digit FROM amounts),
per_invoice AS (
  SELECT i.invoice_idx, count(d.invoice_idx) AS n_amounts, """ + ", ".join(
    f"count(CASE WHEN digit = {d} THEN 1 END) AS d{d}" for d in EXPECTED_SHARE
) + """
  FROM invoices i LEFT JOIN digits d ON d.invoice_idx = i.invoice_idx GROUP BY i.invoice_idx)
"""

_N_DIGITS = " + ".join(f"d{d}" for d in EXPECTED_SHARE)
_CHI2 = " + ".join(
    f"pow(d{d} - n_digits * {share!r}, 2) / (n_digits * {share!r})" for d, share in EXPECTED_SHARE.items()
)
_TESTED = f"""
tested AS (
  SELECT *, exp(-chi2 / 2) * (1 + chi2 / 2 + pow(chi2 / 2, 2) / 2 + pow(chi2 / 2, 3) / 6) AS pvalue FROM (
    SELECT *, CASE WHEN n_amounts >= 50 AND n_digits >= 50 THEN {_CHI2} END AS chi2 FROM (
      SELECT *, {_N_DIGITS} AS n_digits FROM counted)))
"""
_COUNTS = ["n_amounts", *[f"d{d}" for d in EXPECTED_SHARE]]
_RUNNING = (
    _INVOICES
    + ","
    + _DIGITS
    + ", counted AS (SELECT invoice_idx, "
    + ", ".join(f"CAST(sum({c}) OVER w AS BIGINT) AS {c}" for c in _COUNTS)
    + " FROM per_invoice WINDOW w AS (ORDER BY invoice_idx)),"
    + _TESTED
)
_PORTFOLIO = (
    _INVOICES
    + ","
    + _DIGITS
    + ", counted AS (SELECT "
    + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in _COUNTS)
    + " FROM per_invoice),"
    + _TESTED
)

# --- texts -------------------------------------------------------------------------

_IMAGE = "printf('scan/%09d.png', {})"

_TEXTS = f"""
WITH body AS (
  SELECT l_orderkey, string_agg(printed, chr(10) ORDER BY l_linenumber, printed) AS body FROM (
    SELECT l_orderkey, l_linenumber, 'Part ' || l_partkey || ' x ' || CAST(l_quantity AS INTEGER)
      || '   ' || printf('%.2f', l_extendedprice) AS printed FROM lineitem)
  GROUP BY l_orderkey),
texts AS (
  SELECT o_orderkey, {_IMAGE.format('o_orderkey')} AS image_path,
    chr(10) || '  ' || coalesce(c_name, '') || ' ' || chr(10) || 'Date '
    || CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%d/%m/%Y')
         WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'none' END
    || chr(10) || coalesce(body, '') || chr(10) || 'TOTAL ' || printf('%.2f', o_totalprice) || chr(10) AS full_text
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN body ON l_orderkey = o_orderkey)
"""


def _regex_fields(text: str) -> str:
    """Columns of the regex tier: fournisseur, date_facture, total_ttc, lines (list of structs)."""
    amounts = f"list_transform(regexp_extract_all({text}, '(\\d+[.,]\\d{{2}})', 1), lambda x: CAST(replace(x, ',', '.') AS DOUBLE))"
    line = r"(?m)(.{2,40}?)\s+(\d+[.,]\d{2})\s*$"
    return f"""
    coalesce(nullif(regexp_extract({text}, '{fixed.DATE_DAY_FIRST}', 1), ''),
             nullif(regexp_extract({text}, '{fixed.DATE_YEAR_FIRST}', 1), '')) AS date_facture,
    {amounts} AS amounts, list_max({amounts}) AS total_ttc,
    nullif(trim(split_part(regexp_replace({text}, '^\\s+', ''), chr(10), 1), ' ' || chr(9) || chr(13)), '') AS fournisseur,
    list_filter(
      list_zip(list_transform(regexp_extract_all({text}, '{line}', 1), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')),
               list_transform(regexp_extract_all({text}, '{line}', 2), lambda x: CAST(replace(x, ',', '.') AS DOUBLE))),
      lambda p: NOT regexp_matches(p[1], '(?i){fixed.NOT_A_LINE}') AND p[2] > 0 AND p[2] < list_max({amounts})) AS lines"""


_REGEX = _TEXTS + ", read AS (SELECT image_path, " + _regex_fields("full_text") + " FROM texts)"

# --- model answers -------------------------------------------------------------------

_ANSWERS = (
    _INVOICES
    + f""",
items AS (
  SELECT l_orderkey, string_agg(item, ', ' ORDER BY l_linenumber, item) AS items FROM (
    SELECT l_orderkey, l_linenumber, '{{"designation": "Part ' || l_partkey || '", "quantite": '
      || CAST(l_quantity AS INTEGER) || ', "total_ligne": ' || printf('%.2f', l_extendedprice) || '}}' AS item
    FROM lineitem) GROUP BY l_orderkey),
money AS (
  SELECT invoice_idx, invoice_idx % 12 AS kind, printf('%.2f', total_ttc) AS ttc,
    '{{"numero_facture": "' || numero_facture || '", "fournisseur": "' || fournisseur || '", "date_facture": "'
    || date_facture || '", "lignes": [' || coalesce(items, '') || '], "total_ht": '
    || coalesce(printf('%.2f', total_ht), 'null') || ', "tva_montant": ' || coalesce(printf('%.2f', tva_montant), 'null')
    || ', "total_ttc": ' || printf('%.2f', total_ttc) || '}}' AS good
  FROM invoices LEFT JOIN items ON l_orderkey = invoice_idx),
raws AS (
  SELECT invoice_idx, 'vlm' AS method, CASE kind WHEN 0 THEN '```json' || chr(10) || good || chr(10) || '```' || chr(10)
      WHEN 1 THEN '```' || good WHEN 2 THEN substr(good, 2)
      WHEN 3 THEN '{{"fournisseur": 12, "total_ttc": ' || ttc || '}}'
      WHEN 4 THEN '{{"fournisseur": "A", "total_ttc": "' || ttc || ' "}}'
      WHEN 5 THEN '{{"fournisseur": "A", "total_ttc": "' || ttc || ' EUR"}}'
      WHEN 6 THEN '{{"lignes": null}}' WHEN 7 THEN '[1, 2]' WHEN 8 THEN '{{"raw_text": "x"}}'
      WHEN 9 THEN NULL ELSE good END AS raw FROM money
  UNION ALL SELECT invoice_idx, 'vlm_retry', CASE WHEN kind IN (3, 7) THEN good WHEN kind = 6 THEN '{{}}'
      WHEN kind = 2 THEN substr(good, 2) END FROM money
  UNION ALL SELECT invoice_idx, 'ocr_llm', CASE WHEN kind IN (1, 8) THEN substr(good, 2)
      WHEN kind = 9 THEN '```json' || chr(10) || good || chr(10) || '```' || chr(10) END FROM money
  UNION ALL SELECT invoice_idx, 'ocr_llm_retry', CASE WHEN kind = 8 THEN good END FROM money),
answers AS (
  SELECT invoice_idx, method, CASE WHEN NOT starts_with(t, '```') THEN t
      WHEN contains(t, chr(10)) THEN regexp_replace(substr(t, instr(t, chr(10)) + 1), '(?s)^(.*)```.*$', '\\1') END AS answer
  FROM (SELECT *, trim(raw, ' ' || chr(10)) AS t FROM raws)),
typed AS (
  SELECT *, CASE WHEN json_valid(answer) THEN answer END AS j FROM answers),
checked AS (
  SELECT *, coalesce(json_type(j) = 'OBJECT'
      AND json_type(j, '$.raw_text') IS NULL AND json_type(j, '$.extraction_method') IS NULL
      AND coalesce(json_type(j, '$.numero_facture') IN ('VARCHAR', 'NULL'), true)
      AND coalesce(json_type(j, '$.fournisseur') IN ('VARCHAR', 'NULL'), true)
      AND coalesce(json_type(j, '$.date_facture') IN ('VARCHAR', 'NULL'), true)
      AND coalesce(json_type(j, '$.lignes') = 'ARRAY', true)
      AND (coalesce(json_type(j, '$.total_ttc'), 'NULL') = 'NULL'
        OR TRY_CAST(trim(json_extract_string(j, '$.total_ttc')) AS DOUBLE) IS NOT NULL), false) AS valid
  FROM typed),
parsed AS (
  SELECT *, abs(total_ttc - round(total_ht + tva_montant, 2)) <= 0.05 AS pydantic_ttc_valid FROM (
    SELECT invoice_idx, method, valid, answer,
      CASE WHEN valid THEN json_extract_string(j, '$.numero_facture') END AS numero_facture,
      CASE WHEN valid THEN json_extract_string(j, '$.fournisseur') END AS fournisseur,
      CASE WHEN valid THEN json_extract_string(j, '$.date_facture') END AS date_facture,
      CASE WHEN valid THEN TRY_CAST(json_extract_string(j, '$.total_ht') AS DOUBLE) END AS total_ht,
      CASE WHEN valid THEN TRY_CAST(json_extract_string(j, '$.tva_montant') AS DOUBLE) END AS tva_montant,
      CASE WHEN valid THEN TRY_CAST(trim(json_extract_string(j, '$.total_ttc')) AS DOUBLE) END AS total_ttc,
      CASE WHEN valid THEN CAST(coalesce(json_array_length(j, '$.lignes'), 0) AS BIGINT) END AS n_lines,
      CASE WHEN valid THEN round(coalesce(list_sum(list_transform(
        CAST(json_extract(j, '$.lignes[*].total_ligne') AS VARCHAR[]), lambda x: CAST(x AS DOUBLE))), 0.0), 2) END AS line_sum
    FROM checked))
"""
)

_TIERS = (
    _ANSWERS.replace("WITH per_order", _REGEX.replace("WITH body", "WITH body", 1) + ", per_order", 1)
    + """,
fallback AS (
  SELECT CAST(substr(image_path, 6, 9) AS BIGINT) AS invoice_idx, fournisseur, date_facture, total_ttc,
    CAST(len(lines) AS BIGINT) AS n_lines,
    round(coalesce(list_sum(list_transform(lines, lambda p: p[2])), 0.0), 2) AS line_sum FROM read),
state AS (
  SELECT invoice_idx,
    bool_or(method = 'vlm' AND answer IS NOT NULL AND NOT valid) AS vlm_again,
    bool_or(method = 'ocr_llm' AND answer IS NOT NULL AND NOT valid) AS ocr_again
  FROM parsed GROUP BY invoice_idx),
usable AS (
  SELECT p.*, row_number() OVER (PARTITION BY p.invoice_idx ORDER BY list_position(
      ['vlm', 'vlm_retry', 'ocr_llm', 'ocr_llm_retry'], method)) AS n
  FROM parsed p JOIN state s ON s.invoice_idx = p.invoice_idx
  WHERE valid AND (method IN ('vlm', 'ocr_llm') OR (method = 'vlm_retry' AND vlm_again)
    OR (method = 'ocr_llm_retry' AND ocr_again))),
chosen AS (
  SELECT f.invoice_idx, coalesce(u.method, 'regex_fallback') AS extraction_method, u.numero_facture,
    CASE WHEN u.n = 1 THEN u.fournisseur ELSE f.fournisseur END AS fournisseur,
    CASE WHEN u.n = 1 THEN u.date_facture ELSE f.date_facture END AS date_facture,
    u.total_ht, u.tva_montant,
    CASE WHEN u.n = 1 THEN u.total_ttc ELSE f.total_ttc END AS total_ttc, u.pydantic_ttc_valid,
    CASE WHEN u.n = 1 THEN u.n_lines ELSE f.n_lines END AS n_lines,
    CASE WHEN u.n = 1 THEN u.line_sum ELSE f.line_sum END AS line_sum
  FROM fallback f LEFT JOIN usable u ON u.invoice_idx = f.invoice_idx AND u.n = 1)
"""
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _filled(template: str, **values: str) -> str:
    """SQL expression for the template with its placeholders filled."""
    whole = _quoted(template.replace("{{", "\x01").replace("}}", "\x02"))
    for name, value in values.items():
        whole = whole.replace("{" + name + "}", f"' || {value} || '")
    return whole.replace("\x01", "{").replace("\x02", "}")


# --- similarity --------------------------------------------------------------------------

def _text_pairs(words: str) -> str:
    """Pairs at or above 0.85 of the texts in ``words``: doc_id, supplier, fournisseur, ttc, asked, w."""
    return f"""
worded AS ({words}),
terms AS (
  SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term
  FROM worded),
tf AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
contents AS (SELECT min(doc_id) AS id, list_aggregate(w, 'string_agg', ' ') AS c FROM worded WHERE len(w) > 0 GROUP BY c),
tf1 AS (SELECT tf.* FROM tf JOIN contents ON id = doc_id),
df AS (SELECT term, count(*) AS df FROM tf1 GROUP BY term),
weighted AS (
  SELECT doc_id, tf1.term, tf * (1 + ln(((SELECT count(*) FROM contents) + 1) / (df + 1))) AS weight
  FROM tf1 JOIN df ON df.term = tf1.term),
norms AS (SELECT doc_id, sqrt(sum(weight * weight)) AS norm FROM weighted GROUP BY doc_id),
unit AS (SELECT w.doc_id, term, weight / norm AS u FROM weighted w JOIN norms n ON n.doc_id = w.doc_id),
dots AS (
  SELECT a.doc_id AS x, b.doc_id AS y, round(sum(a.u * b.u), 6) AS s
  FROM unit a JOIN unit b ON a.term = b.term AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
  HAVING round(sum(a.u * b.u), 6) >= 0.85),
member AS (
  SELECT doc_id, supplier, fournisseur, ttc, asked, id FROM worded JOIN contents ON c = list_aggregate(w, 'string_agg', ' ')
  WHERE len(w) > 0),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, CAST(1.0 AS DOUBLE) AS s FROM member a JOIN member b ON a.id = b.id AND a.doc_id <> b.doc_id
  UNION ALL
  SELECT a.doc_id, b.doc_id, s FROM dots JOIN member a ON a.id = x JOIN member b ON b.id = y),
ranked AS (
  SELECT pairs.x, y, row_number() OVER (PARTITION BY pairs.x ORDER BY s DESC, y) AS rank, round(s, 3) AS similarity,
    q.supplier, m.fournisseur, m.ttc AS total_ttc
  FROM pairs JOIN member q ON q.doc_id = pairs.x AND q.asked JOIN member m ON m.doc_id = y)
"""


_TEXT_PAIRS = "WITH " + _text_pairs(
    """
  SELECT doc_id, lower(trim(source)) AS supplier, lower(trim(source)) AS fournisseur, CAST(n_chars AS DOUBLE) AS ttc,
    true AS asked, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents"""
)

_SEMANTIC_DETAIL = (
    "printf('Doublon semantique (sim=%.3f, fournisseur=%s, ttc=%s)', similarity, fournisseur, CAST(total_ttc AS VARCHAR))"
)
_SEMANTIC_FOUND = f"""
  SELECT x AS invoice_idx, rank, y AS similar_idx, similarity,
    CASE WHEN similarity > 0.95 THEN 'semantic_duplicate' ELSE 'near_duplicate' END AS rule,
    CASE WHEN similarity > 0.95 THEN 'critical' ELSE 'warning' END AS level,
    CASE WHEN similarity > 0.95 THEN {_SEMANTIC_DETAIL}
      ELSE printf('Facture tres similaire (sim=%.3f)', similarity) END AS detail
  FROM ranked WHERE rank <= 3 AND (similarity > 0.95 OR (similarity > 0.85 AND supplier = fournisseur))
"""

# --- forest --------------------------------------------------------------------------------

_SEED, _TREES, _SAMPLE = 42, 200, 256
_DEPTH = 8  # of a tree over 256 rows; the SQL is for portfolios of at least as many
_FEATURE_NAMES = ("f_amount", "f_lines", "f_ratio", "f_gap")


def _hex(text: str, start: int, count: int) -> str:
    return f"CAST('0x' || substr(md5({text}), {start + 1}, {count}) AS BIGINT)"


def _unit(text: str) -> str:
    return f"({_hex(text, 0, 13)} / CAST(4503599627370496 AS DOUBLE))"


_ONE_FEATURE = "CASE {which} " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate(_FEATURE_NAMES, 1)) + " END"


def _forest() -> str:
    """Trees grown level by level, then every row led down all of them."""
    names = ", ".join(_FEATURE_NAMES)
    query = f"""
features AS (
  SELECT invoice_idx, total_ttc AS f_amount, CAST(n_lines AS DOUBLE) AS f_lines,
    CASE WHEN total_ht > 0 THEN total_ttc / total_ht ELSE 1.0::DOUBLE END AS f_ratio,
    abs(total_ttc - line_sum) / total_ttc AS f_gap FROM invoices WHERE total_ttc > 0),
sizes AS (SELECT count(*) AS n_rows FROM features),
trees AS (
  SELECT tree, 1 + {_hex(f"'{_SEED}:tree:' || tree", 0, 15)} % 2147483646 AS a,
    {_hex(f"'{_SEED}:tree:' || tree", 15, 15)} % 2147483647 AS b FROM range({_TREES}) r(tree)),
pool AS (
  SELECT features.*, {_hex(f"'{_SEED}:row:' || invoice_idx", 13, 15)} % 2147483647 AS number
  FROM features, sizes
  WHERE {_unit(f"'{_SEED}:row:' || invoice_idx")} < CAST({2 * _SAMPLE * _TREES} AS DOUBLE) / n_rows),
draws AS (
  SELECT tree, pool.*, (number * a + b) % 2147483647 AS draw FROM pool, trees),
l0 AS (
  SELECT tree, invoice_idx, {names}, 0 AS node FROM draws, sizes
  WHERE draw < CAST({2.0 * _SAMPLE} AS DOUBLE) / least(n_rows, {2 * _SAMPLE * _TREES}) * 2147483647
  QUALIFY row_number() OVER (PARTITION BY tree ORDER BY draw, invoice_idx) <= {_SAMPLE}),"""
    lows = ", ".join(f"min({f}) AS low{i}, max({f}) AS high{i}" for i, f in enumerate(_FEATURE_NAMES, 1))
    spread = "list_concat(" * 3 + ", ".join(
        f"CASE WHEN high{i} > low{i} THEN [{i}] ELSE [] END" + (")" if i > 1 else "") for i in range(1, 5)
    )
    low, high = ("CASE which " + " ".join(f"WHEN {i} THEN {x}{i}" for i in range(1, 5)) + " END" for x in ("low", "high"))
    key = f"'{_SEED}:' || tree || ':' || node || "
    for k in range(_DEPTH):
        query += f"""
s{k} AS (
  SELECT tree, node, n, which, {low} + {_unit(key + "':cut'")} * ({high} - {low}) AS cut FROM (
    SELECT *, spread[1 + CAST(floor({_unit(key + "':feature'")} * len(spread)) AS BIGINT)] AS which FROM (
      SELECT tree, node, count(*) AS n, {lows}, {spread} AS spread FROM l{k} GROUP BY tree, node))),
l{k + 1} AS (
  SELECT l.tree, invoice_idx, {names},
    2 * l.node + 1 + CAST({_ONE_FEATURE.format(which='which')} > cut AS INTEGER) AS node
  FROM l{k} l JOIN s{k} s ON s.tree = l.tree AND s.node = l.node WHERE which IS NOT NULL),"""
    every = " UNION ALL ".join(f"SELECT tree, node, n, which, cut, {k} AS level FROM s{k}" for k in range(_DEPTH))
    query += f"""
nodes AS ({every} UNION ALL
  SELECT tree, node, count(*), NULL, NULL, {_DEPTH} FROM l{_DEPTH} GROUP BY tree, node),
p0 AS (SELECT invoice_idx, {names}, tree, 0 AS node FROM features, trees),"""
    for k in range(_DEPTH):
        query += f"""
p{k + 1} AS (
  SELECT invoice_idx, {names}, p.tree, CASE WHEN which IS NULL THEN p.node
    ELSE 2 * p.node + 1 + CAST({_ONE_FEATURE.format(which='which')} > cut AS INTEGER) END AS node
  FROM p{k} p LEFT JOIN nodes s ON s.tree = p.tree AND s.node = p.node),"""
    mean = "CASE WHEN {n} <= 1 THEN 0 WHEN {n} = 2 THEN 1 ELSE 2 * (ln({n} - 1) + 0.5772156649015329::DOUBLE) - 2 * ({n} - 1) / {n} END"
    return (
        query
        + f"""
scores AS (
  SELECT invoice_idx, -pow(2, -sum(floor(log2(p.node + 1)) + {mean.format(n='coalesce(s.n, 0)')})
    / {_TREES} / ({mean.format(n=_SAMPLE)})) AS score
  FROM p{_DEPTH} p LEFT JOIN nodes s ON s.tree = p.tree AND s.node = p.node GROUP BY invoice_idx),
decided AS (
  SELECT i.invoice_idx, score - (SELECT quantile_cont(score, 0.05) FROM scores) AS decision
  FROM invoices i LEFT JOIN scores s ON s.invoice_idx = i.invoice_idx)
"""
    )


_FOREST = _forest()
_DETAIL_FOREST = "printf('Anomalie multivariee (IF score=%.3f)', decision)"
_DETAIL_BENFORD = "'chi2=' || CAST(round(chi2, 2) AS VARCHAR) || ', p=' || CAST(round(pvalue, 6) AS VARCHAR)"
_DETAIL_ZSCORE = "printf('Z-score=%.1f (moy=%.2f, sigma=%.2f)', z, mu, sigma)"
_DETAIL_HASH = "'Doublon exact detecte (hash=' || substr(digest, 1, 12) || '...)'"

# --- reports -------------------------------------------------------------------------------

_DECISIONS = """
dialogues AS (
  SELECT conv_id, turn, CASE conv_id % 3 WHEN 0 THEN text || chr(10) || '  Decision: REVIEW - RAISON: ' || role || ' ' || chr(10) || 'end'
    WHEN 1 THEN '```' || chr(10) || text || chr(10) || '```' ELSE text END AS raw FROM conversations),
said AS (
  SELECT *, nullif(CASE WHEN NOT starts_with(t, '```') THEN t WHEN contains(t, chr(10))
    THEN regexp_replace(substr(t, instr(t, chr(10)) + 1), '(?s)^(.*)```.*$', '\\1') END, '') AS a
  FROM (SELECT *, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS t FROM dialogues)),
decisions AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(
    regexp_replace(list_filter(string_split(a, chr(10)), lambda x: contains(upper(x), 'DECISION:'))[1], '^\\s+|\\s+$', '', 'g'),
    right(a, 200)) AS llm_decision FROM said)
"""

_RULES = (
    _RUNNING
    + ","
    + _FOREST
    + ","
    + _DECISIONS
    + ","
    + _text_pairs(
        """
  SELECT doc_id, lower(trim(fournisseur)) AS supplier, lower(trim(coalesce(fournisseur, 'unknown'))) AS fournisseur,
    total_ttc AS ttc, extraction_method <> 'regex_fallback' AS asked,
    regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w
  FROM documents JOIN invoices ON invoice_idx = doc_id WHERE extraction_method NOT LIKE 'vlm%'"""
    )
    + f""",
later AS (
  SELECT doc_id AS invoice_idx, digest FROM (
    SELECT doc_id, sha256(text) AS digest, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS n
    FROM documents JOIN invoices ON invoice_idx = doc_id
    WHERE extraction_method NOT LIKE 'vlm%' AND trim(text) <> '') WHERE n > 1),
alerts AS (
  SELECT invoice_idx, 10 AS seq, 'arithmetic_lines' AS rule, 'warning' AS level, {_DETAIL_LINES} AS detail FROM ({_LINES_FOUND})
  UNION ALL SELECT invoice_idx, 20, 'arithmetic_ttc', 'warning', {_DETAIL_TTC} FROM ({_TTC_FOUND})
  UNION ALL SELECT invoice_idx, 30, 'hash_duplicate', 'critical', {_DETAIL_HASH} FROM later
  UNION ALL SELECT invoice_idx, 40 + rank, rule, level, detail FROM ({_SEMANTIC_FOUND})
  UNION ALL SELECT invoice_idx, 50, 'zscore', 'warning', {_DETAIL_ZSCORE} FROM ({_ZSCORE})
  UNION ALL SELECT invoice_idx, 60, 'isolation_forest', 'warning', {_DETAIL_FOREST} FROM decided WHERE decision < -0.1
  UNION ALL SELECT invoice_idx, 70, 'benford', 'warning', {_DETAIL_BENFORD} FROM tested WHERE pvalue < 0.05),
grouped AS (
  SELECT invoice_idx, count(*) AS n_alerts, string_agg(rule, ',' ORDER BY seq) AS rules,
    string_agg(detail, chr(10) ORDER BY seq) AS details,
    string_agg('- [' || upper(level) || '] ' || rule || ': ' || detail, chr(10) ORDER BY seq) AS told,
    bool_or(level = 'critical') AS critical FROM alerts GROUP BY invoice_idx),
reports AS (
  SELECT i.invoice_idx, numero_facture AS invoice_id,
    CASE WHEN critical THEN 'critical' WHEN n_alerts > 0 THEN 'warning' ELSE 'ok' END AS overall_level,
    round(pvalue, 6) AS benford_pvalue, coalesce(n_alerts, 0) AS n_alerts, coalesce(rules, '') AS rules,
    coalesce(details, '') AS details, round(decision, 4) AS isolation_forest_score,
    CASE WHEN n_alerts > 0 THEN llm_decision END AS llm_decision, coalesce(told, '') AS told
  FROM invoices i LEFT JOIN grouped g ON g.invoice_idx = i.invoice_idx LEFT JOIN tested t ON t.invoice_idx = i.invoice_idx
    LEFT JOIN decided d ON d.invoice_idx = i.invoice_idx
    LEFT JOIN (SELECT * FROM decisions QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1) v
      ON v.conv_id = i.invoice_idx)
"""
)


def _float(column: str) -> str:
    """Amounts in cents below ten million print alike everywhere."""
    return f"coalesce(CAST({column} AS VARCHAR), 'None')"


_SHARES = " UNION ALL ".join(
    f"SELECT CAST({d} AS BIGINT) AS digit, d{d} AS n, d{d} / n_digits AS o, CAST({share!r} AS DOUBLE) AS e FROM tested"
    for d, share in EXPECTED_SHARE.items()
)

_BLOCKS = """
WITH blocks AS (
  SELECT doc_id, i - 1 AS block_no, parts[i] AS text, ((doc_id * 7 + (i - 1) * 13) % 64) / 64 AS confidence
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
    FROM documents)),
kept AS (
  SELECT doc_id, string_agg(text, chr(10) ORDER BY block_no) AS full_text, round_even(avg(confidence), 3) AS avg_confidence,
    count(*) AS n_blocks FROM blocks WHERE confidence >= 0.3 GROUP BY doc_id)
"""

_KEPT = """
  SELECT CAST(row_number() OVER (ORDER BY image_path) - 1 AS BIGINT) AS invoice_idx, image_path, length, sharpness FROM (
    SELECT lang || '/' || doc_id || '.png' AS image_path, n_chars AS length,
      CASE WHEN n_chars % 10 <> 0 THEN n_chars / 8 END AS sharpness FROM documents {cap})
  WHERE sharpness >= 50
"""

ORACLE_SQL: dict[str, str] = {
    "invoice_features": _INVOICES
    + """SELECT invoice_idx, CASE WHEN total_ttc > 0 THEN round(total_ttc, 2) END AS f_amount,
      CASE WHEN total_ttc > 0 THEN CAST(n_lines AS DOUBLE) END AS f_lines,
      CASE WHEN total_ttc > 0 THEN round(CASE WHEN total_ht > 0 THEN total_ttc / total_ht ELSE 1.0 END, 6) END AS f_ratio,
      CASE WHEN total_ttc > 0 THEN round(abs(total_ttc - line_sum) / total_ttc, 6) END AS f_gap FROM invoices""",
    "arithmetic_lines": _INVOICES
    + f"SELECT invoice_idx, round(line_sum, 2) AS line_sum, reference, {_DETAIL_LINES} AS detail FROM ({_LINES_FOUND})",
    "arithmetic_ttc": _INVOICES + f"SELECT *, {_DETAIL_TTC} AS detail FROM ({_TTC_FOUND})",
    "ttc_flag": _INVOICES
    + "SELECT invoice_idx, abs(total_ttc - round(total_ht + tva_montant, 2)) <= 0.05 AS ttc_valid FROM invoices",
    "hash_duplicates": """
      SELECT invoice_idx, digest, 'Doublon exact detecte (hash=' || substr(digest, 1, 12) || '...)' AS detail FROM (
        SELECT doc_id AS invoice_idx, sha256(text) AS digest,
          row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS n
        FROM documents WHERE regexp_matches(text, '\\S')) WHERE n > 1""",
    "zscore_alerts": _INVOICES
    + f"""SELECT invoice_idx, supplier, n_history, round(mu, 4) AS mu, round(sigma, 4) AS sigma, round(z, 6) AS z,
      printf('Z-score=%.1f (moy=%.2f, sigma=%.2f)', z, mu, sigma) AS detail FROM ({_ZSCORE})""",
    "similar_topk": """
      SELECT invoice_idx, CAST(rank AS BIGINT) AS rank, similar_idx, round(s, 3) AS similarity, label FROM (
        SELECT a.vec_id AS invoice_idx, b.vec_id AS similar_idx, CAST(b.label AS BIGINT) AS label,
          round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS s,
          row_number() OVER (PARTITION BY a.vec_id ORDER BY
            round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) DESC, b.vec_id) AS rank
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE s >= 0.4 AND rank <= 3""",
    "similar_texts": _TEXT_PAIRS
    + """SELECT x AS invoice_idx, rank, y AS similar_idx, similarity, fournisseur, total_ttc FROM ranked WHERE rank <= 5""",
    "semantic_duplicates": _TEXT_PAIRS + _SEMANTIC_FOUND,
    "benford_portfolio": _PORTFOLIO
    + f"""SELECT {', '.join(_COUNTS)}, n_digits, round(chi2, 2) AS chi2, round(pvalue, 6) AS pvalue,
      coalesce(pvalue < 0.05, false) AS anomaly FROM tested""",
    "benford_running": _RUNNING
    + "SELECT invoice_idx, n_amounts, n_digits, round(chi2, 4) AS chi2, round(pvalue, 6) AS pvalue FROM tested",
    "benford_alerts": _RUNNING
    + f"""SELECT invoice_idx, round(chi2, 2) AS chi2, round(pvalue, 6) AS pvalue, {_DETAIL_BENFORD} AS detail
      FROM tested WHERE pvalue < 0.05""",
    "digit_distribution": _PORTFOLIO
    + f"SELECT digit, n, round(o, 8) AS observed_share, round(e, 8) AS expected_share FROM ({_SHARES})",
    "ocr_texts": _BLOCKS
    + f"""SELECT {_IMAGE.format('d.doc_id')} AS image_path, coalesce(full_text, '') AS full_text,
      coalesce(avg_confidence, 0.0) AS avg_confidence, coalesce(n_blocks, 0) AS n_blocks
      FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id""",
    "regex_dates": _REGEX + "SELECT image_path, date_facture FROM read",
    "regex_amounts": _REGEX + "SELECT image_path, CAST(len(amounts) AS BIGINT) AS n_amounts, total_ttc FROM read",
    "regex_supplier": _REGEX + "SELECT image_path, fournisseur FROM read",
    "regex_lines": _REGEX
    + """SELECT image_path, CAST(i AS BIGINT) AS line_no, lines[i][1] AS designation, lines[i][2] AS total_ligne FROM (
        SELECT image_path, lines, unnest(range(1, len(lines) + 1)) AS i FROM read)""",
    "regex_documents": f"""
      SELECT doc_id AS invoice_idx, fournisseur, date_facture, total_ttc, CAST(len(lines) AS BIGINT) AS n_lines,
        round(coalesce(list_sum(list_transform(lines, lambda p: p[2])), 0.0), 2) AS line_sum
      FROM (SELECT doc_id, {_regex_fields('text')} FROM documents)""",
    "response_parse": _ANSWERS
    + f"""SELECT {_IMAGE.format('invoice_idx')} AS image_path, method, valid, numero_facture, fournisseur, date_facture,
      total_ht, tva_montant, total_ttc, pydantic_ttc_valid, n_lines, line_sum FROM parsed""",
    "tier_choice": _TIERS
    + f"""SELECT {_IMAGE.format('invoice_idx')} AS image_path, extraction_method, numero_facture, fournisseur,
      date_facture, total_ht, tva_montant, total_ttc, pydantic_ttc_valid,
      CASE WHEN extraction_method NOT LIKE 'vlm%' THEN (invoice_idx % 64) / 64 END AS ocr_confidence,
      extraction_method NOT LIKE 'vlm%' AS has_text, n_lines, line_sum FROM chosen""",
    "first_requests": _TEXTS
    + f"""SELECT image_path, 'vlm' AS tier, CAST(1 AS BIGINT) AS attempt, {_quoted(fixed.EXTRACTION_PROMPT)} AS prompt FROM texts
      UNION ALL SELECT image_path, 'ocr_llm', 1, {_filled(fixed.OCR_PROMPT, ocr_text='full_text')} FROM texts
      WHERE regexp_matches(full_text, '\\S')""",
    "retry_requests": _TEXTS
    + _ANSWERS.replace("WITH per_order", ", per_order", 1)
    + f""", rejected AS (
        SELECT p.invoice_idx, p.method, {_IMAGE.format('p.invoice_idx')} AS image_path,
          CASE WHEN json_valid(a.answer) THEN {_quoted(fixed.RETRY_SCHEMA_ERROR)}
            ELSE {_quoted(fixed.RETRY_PARSE_ERROR)} END AS error
        FROM parsed p JOIN answers a ON a.invoice_idx = p.invoice_idx AND a.method = p.method
        WHERE a.answer IS NOT NULL AND NOT p.valid)
      SELECT image_path, 'vlm' AS tier, 2::BIGINT AS attempt, {_filled(fixed.RETRY_PROMPT, error='error')} AS prompt
      FROM rejected WHERE method = 'vlm'
      UNION ALL SELECT r.image_path, 'ocr_llm', 2,
        {_filled(fixed.RETRY_PROMPT, error=_quoted(fixed.RETRY_OCR_ERROR))} || {_quoted(fixed.RETRY_OCR_TEXT)} || full_text
      FROM rejected r JOIN texts t ON t.image_path = r.image_path
      WHERE method = 'ocr_llm' AND regexp_matches(full_text, '\\S')""",
    "decision_parse": "WITH " + _DECISIONS + "SELECT * FROM decisions",
    "kept_images": _KEPT.format(cap=""),
    "first_images": _KEPT.format(cap="ORDER BY image_path LIMIT 50"),
    "index_records": _INVOICES
    + """SELECT 'inv_' || i.invoice_idx AS id,
      CASE WHEN extraction_method LIKE 'vlm%' THEN '' ELSE coalesce(text, '') END AS document,
      lower(fournisseur) AS fournisseur, total_ttc, date_facture AS date, extraction_method, n_lines AS nb_lignes
      FROM invoices i LEFT JOIN documents ON doc_id = i.invoice_idx""",
    "index_upsert": _INVOICES
    + """, updates AS (
        SELECT 'inv_' || l_orderkey AS id, 'line ' || l_linenumber AS document,
          'supplier ' || l_suppkey AS fournisseur, l_extendedprice AS total_ttc,
          strftime(l_shipdate, '%Y-%m-%d') AS date, 'vlm' AS extraction_method, 1::BIGINT AS nb_lignes
        FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_extendedprice DESC, l_suppkey DESC, l_linenumber DESC) AS n
          FROM lineitem WHERE l_returnflag = 'R') WHERE n = 1)
      SELECT * FROM updates UNION ALL
      SELECT 'inv_' || invoice_idx, '', lower(fournisseur), total_ttc, date_facture, extraction_method, 0
      FROM invoices WHERE 'inv_' || invoice_idx NOT IN (SELECT id FROM updates)""",
    "audit_report": _RULES + "SELECT * EXCLUDE (told) FROM reports",
    "full_audit": _RULES
    + """SELECT invoice_idx, invoice_id, told AS anomalies, overall_level, benford_pvalue, isolation_forest_score, llm_decision
      FROM reports""",
    "alert_text": _RULES + "SELECT invoice_idx, told AS alerts FROM grouped",
    "forest_scores": _INVOICES + "," + _FOREST + "SELECT invoice_idx, round(decision, 4) AS decision FROM decided",
    "forest_alerts": _INVOICES
    + ","
    + _FOREST
    + f"SELECT invoice_idx, round(decision, 6) AS decision, {_DETAIL_FOREST} AS detail FROM decided WHERE decision < -0.1",
    "score_histogram": _INVOICES
    + ","
    + _FOREST
    + """, r AS (SELECT min(decision) AS low, max(decision) AS high FROM decided),
      b AS (SELECT unnest(range(1, 21)) AS bin, low, (high - low) / 20 AS w FROM r),
      c AS (SELECT least(CAST(floor((decision - low) / ((high - low) / 20)) AS BIGINT) + 1, 20) AS bin, count(*) AS n
        FROM decided, r WHERE decision IS NOT NULL GROUP BY 1)
      SELECT b.bin, round(low + (b.bin - 1) * w, 6) AS bin_from, round(low + b.bin * w, 6) AS bin_to, coalesce(n, 0) AS n,
        -0.1::DOUBLE AS alert_below FROM b LEFT JOIN c ON c.bin = b.bin""",
    "fraud_requests": _RULES
    + "SELECT i.invoice_idx, "
    + _filled(
        fixed.FRAUD_PROMPT,
        fournisseur="fournisseur",
        date="date_facture",
        total_ht=_float("total_ht"),
        tva_montant=_float("tva_montant"),
        total_ttc=_float("total_ttc"),
        nb_lignes="n_lines",
        method="extraction_method",
        alerts="told",
    )
    + " AS prompt FROM invoices i JOIN grouped g ON g.invoice_idx = i.invoice_idx",
    "level_counts": _RULES
    + """SELECT l.overall_level, count(r.invoice_idx) AS n,
      round(count(r.invoice_idx) / (SELECT count(*) FROM reports), 8) AS share
      FROM (VALUES ('ok'), ('warning'), ('critical')) l(overall_level)
      LEFT JOIN reports r ON r.overall_level = l.overall_level GROUP BY l.overall_level""",
    "first_report": _RULES
    + """SELECT r.invoice_idx, fournisseur, extraction_method, total_ttc, overall_level, rules
      FROM reports r JOIN invoices i ON i.invoice_idx = r.invoice_idx
      WHERE n_alerts > 0 ORDER BY r.invoice_idx LIMIT 1""",
    "method_counts": _INVOICES
    + "SELECT extraction_method, count(*) AS n FROM invoices GROUP BY extraction_method",
    "amount_histogram": _INVOICES
    + """, r AS (SELECT min(total_ttc) AS low, max(total_ttc) AS high FROM invoices WHERE total_ttc > 0),
      b AS (SELECT unnest(range(1, 21)) AS bin, low, (high - low) / 20 AS w FROM r)
      SELECT bin, round(low + (bin - 1) * w, 4) AS bin_from, round(low + bin * w, 4) AS bin_to,
        (SELECT count(*) FROM invoices i WHERE i.total_ttc > 0
          AND least(CAST(floor((i.total_ttc - b.low) / b.w) AS BIGINT) + 1, 20) = b.bin) AS n FROM b""",
}
