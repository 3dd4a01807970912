"""SQL of the engine's own operators, for the correctness check."""

from __future__ import annotations

from ..functions.text import UNSTEMMED
from ..profile import ALIASES, NOISE, REGISTER_NAME, WIDE

SPACE = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'))"


def cleaned(x: str) -> str:
    bare = rf"regexp_replace(translate(coalesce({x}, ''), chr(10) || chr(9), '  '), '\\([_*#`\[\]()])', '\1', 'g')"
    return squeeze(rf"regexp_replace({bare}, '[\p{{C}}\x{{FFFD}}]', '', 'g')")


def denoised(x: str) -> str:
    noisy = lambda t: "(" + " OR ".join(f"contains(lower({t}), '{n}')" for n in NOISE) + ")"
    kept = f"array_to_string(list_filter(string_split({x}, ' '), lambda t: NOT {noisy('t')}), ' ')"
    return f"CASE WHEN {noisy(x)} THEN {kept} ELSE {x} END"


def stem(w: str) -> str:
    s = f"""CASE WHEN length({w}) > 5 AND {w} LIKE '%ies' THEN left({w}, length({w}) - 3) || 'y' WHEN length({w}) > 5 AND {w} LIKE '%ing' THEN left({w}, length({w}) - 3)
WHEN length({w}) > 4 AND {w} LIKE '%ed' THEN left({w}, length({w}) - 2) WHEN length({w}) > 4 AND {w} LIKE '%es' AND NOT regexp_matches({w}, '(ses|xes)$') THEN left({w}, length({w}) - 2)
WHEN {w} LIKE '%s' AND NOT regexp_matches({w}, '(ss|us|is)$') THEN left({w}, length({w}) - 1) WHEN length({w}) > 4 AND {w} LIKE '%e' AND {w} NOT LIKE '%ee' THEN left({w}, length({w}) - 1) ELSE {w} END"""
    keep = ", ".join(f"'{x}'" for x in UNSTEMMED)
    twin = f"length({s}) > 3 AND right({s}, 1) = left(right({s}, 2), 1) AND NOT contains('aeiou', right({s}, 1))"
    return f"CASE WHEN NOT regexp_full_match({w}, '[a-z]{{4,}}') OR {w} IN ({keep}) THEN {w} WHEN {twin} THEN left({s}, length({s}) - 1) ELSE {s} END"


def tokens(table: str, key: str, text: str) -> str:
    """CTEs ending in ``<table>_tok(key, term)``, one row a token."""
    p = table
    return f"""
{p}_raw AS (SELECT {key}, unnest(regexp_extract_all(lower(coalesce({text}, '')), '[a-z0-9]+(?:_[a-z0-9]+)*')) AS t FROM {table}),
{p}_tok AS (
  SELECT {key}, t AS term FROM {p}_raw WHERE contains(t, '_')
  UNION ALL SELECT {key}, {stem("w")} FROM (SELECT {key}, unnest(string_split(t, '_')) AS w FROM {p}_raw)
)"""


DOCS = "docs AS (SELECT DISTINCT ON (doc_id) doc_id, coalesce(text, '') AS text, source, coalesce(module, '') AS module FROM documents)"
BLOCKS = "blocks AS (SELECT DISTINCT ON (block_id) * FROM acme_content_list)"


def register_ok(x: str, pattern: str = REGISTER_NAME) -> str:
    name = f"replace({x}, '(O..', '(0..')"
    return f"(length({name}) >= 4 AND contains({name}, '_') AND regexp_matches({name}, '^(?:{pattern})'))"


def token(x: str) -> str:
    """First register name among the tokens of a cleaned text; lower-to-upper changes are marked first."""
    parts = f"list_transform(string_split({squeeze(f'''replace({x}, '(O..', '(0..')''')}, ' '), lambda t: regexp_replace(t, '^[.,:；;]+|[.,:；;]+$', '', 'g'))"
    pieces = rf"flatten(list_transform({parts}, lambda t: list_concat([t], string_split(regexp_replace(t, '([a-z])([A-Z])', '\1' || chr(1) || '\2', 'g'), chr(1)))))"
    return f"coalesce(list_filter({pieces}, lambda t: {register_ok('t')})[1], '')"


ROLES = f"""
{BLOCKS},
cleaned AS (SELECT *, CASE WHEN type = 'text' THEN {denoised("c")} END AS clean FROM (SELECT *, CASE WHEN type = 'text' THEN {cleaned("text")} END AS c FROM blocks WHERE type NOT IN ('header', 'footer', 'aside_text'))),
tokened AS (SELECT *, CASE WHEN type = 'text' THEN {token("clean")} END AS tok FROM cleaned WHERE type <> 'text' OR clean <> ''),
roles AS (
  SELECT *, CASE WHEN type <> 'text' THEN type WHEN {register_ok("clean")} THEN 'anchor' WHEN coalesce(text_level, 0) <> 0 THEN 'heading' WHEN tok <> '' AND len(string_split(clean, ' ')) <= 8 THEN 'anchor' ELSE 'body' END AS role
  FROM tokened
),
marked AS (
  SELECT *, CASE WHEN role = 'anchor' AND {register_ok("clean")} THEN replace(clean, '(O..', '(0..') WHEN role IN ('anchor', 'heading') AND tok <> '' THEN tok END AS anchor,
    CASE WHEN role = 'heading' THEN left(lower(module) || ':' || trim(regexp_replace(lower(clean), '[^a-z0-9]+', '-', 'g'), '-'), 120) END AS section
  FROM roles
),
noted AS (
  SELECT *, last_value(section IGNORE NULLS) OVER w AS section_id, last_value(anchor IGNORE NULLS) OVER w AS register_anchor
  FROM marked WINDOW w AS (PARTITION BY doc_file ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""

SECS = """
heads AS (SELECT doc_file, section AS section_id, min(pos) AS ord, arg_min(module, pos) AS module, arg_min(clean, pos) AS title, arg_min(text_level, pos) AS level, arg_min({p: page_idx}, pos).p AS page FROM noted WHERE role = 'heading' GROUP BY ALL),
texts AS (SELECT doc_file, section_id, string_agg(clean, ' ' ORDER BY pos) AS text FROM noted WHERE role = 'body' AND section_id IS NOT NULL GROUP BY ALL),
secs AS (SELECT doc_file, ord, section_id, module, title, level, page, coalesce(text, '') AS text FROM heads LEFT JOIN texts USING (doc_file, section_id))"""


def cell(x: str) -> str:
    text = rf"regexp_replace(regexp_replace({x}, '<[^>]*>', chr(2), 'g'), chr(2) || '+', ' ', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&#39;", "''"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{char}')"
    return denoised(cleaned(text))


ROWS = f"""
trs AS (SELECT block_id, unnest(regexp_extract_all(table_body, '(?s)<tr>(.*?)</tr>', 1)) AS tr, generate_subscripts(regexp_extract_all(table_body, '(?s)<tr>(.*?)</tr>', 1), 1) AS n FROM blocks WHERE type = 'table' AND table_body <> ''),
cells AS (SELECT block_id, n, list_transform(regexp_extract_all(tr, '(?s)<t[dh]>(.*?)</t[dh]>', 1), lambda c: {cell("c")}) AS cells FROM trs),
rws AS (SELECT block_id, row_number() OVER (PARTITION BY block_id ORDER BY n) - 1 AS row_no, cells FROM cells WHERE len(list_filter(cells, lambda c: c <> '')) > 0)"""


def find_col(header: str, key: str) -> str:
    at = [f"nullif(coalesce(list_position(list_transform({header}, lambda c: contains(lower(c), '{a}')), true), 0), 0)" for a in WIDE.aliases[key]]
    return f"(coalesce({', '.join([*at, 'NULL'])}) - 1)::INT"


def table_class(header: str, aliases=WIDE.aliases) -> str:  # noqa: ANN001
    holds = lambda key: "(" + " OR ".join(f"contains(lower(array_to_string({header}, ' ')), '{a}')" for a in aliases[key]) + ")"
    return (
        f"CASE WHEN {holds('bit_position')} AND {holds('field_name')} THEN 'bitfield' WHEN {holds('register')} AND {holds('address')} THEN 'summary' "
        f"WHEN {holds('mnemonic')} AND {holds('value')} THEN 'enum' ELSE 'other' END"
    )


def at(cells: str, col: str) -> str:
    return f"coalesce({cells}[{col} + 1], '')"


TABS = f"""
{ROWS},
hdr AS (SELECT block_id, cells AS header, {table_class("cells")} AS class FROM rws WHERE row_no = 0),
tabs AS (SELECT n.*, h.header, h.class FROM noted n JOIN hdr h USING (block_id))"""

_POS = "|".join(f"(?:^(?:{p}))" for p in WIDE.bit_positions)
_TITLED = "LEFT JOIN secs s ON s.doc_file = t.doc_file AND s.section_id = t.section_id"
_COLS = ", ".join(f"{find_col('header', k)} AS c_{k}" for k in ("bit_position", "field_name", "access", "reset", "typical", "description", "register", "address", "value", "mnemonic"))
BODY = f"body AS (SELECT t.doc_file, t.pos, t.block_id, t.module, t.class, t.section_id, t.register_anchor, t.page_idx, r.row_no, r.cells, {_COLS} FROM tabs t JOIN rws r USING (block_id) WHERE r.row_no > 0)"


def split_cte(source: str, key: str, text: str) -> str:
    """CTE ``pieces(key, piece_no, piece)`` of ``source(key, text)`` by recursion over the start positions."""
    last = "greatest(coalesce(length(w) - length(regexp_extract(w, '(?s)^.*\\. (.*)$', 1)) - 1, 0) * (CASE WHEN contains(w, '. ') THEN 1 ELSE 0 END), coalesce(length(w) - length(regexp_extract(w, '(?s)^.*; (.*)$', 1)) - 1, 0) * (CASE WHEN contains(w, '; ') THEN 1 ELSE 0 END))"
    return f"""
spl AS (
  SELECT {key}, {text} AS t, 0 AS p0, 0 AS k, CASE WHEN length({text}) <= 900 THEN length({text}) ELSE NULL END AS stop FROM {source} WHERE length({text}) <= 900
  UNION ALL SELECT {key}, {text}, 0, 0, NULL FROM {source} WHERE length({text}) > 900
),
steps AS (
  SELECT {key}, t, p0, k, stop FROM (SELECT {key}, t, p0, k, coalesce(stop, p0 + CASE WHEN p0 + 900 < length(t) AND {last} - 1 > 40 THEN {last} ELSE least(900, length(t) - p0) END) AS stop
    FROM (SELECT *, substr(t, p0 + 1, 900) AS w FROM spl))
  UNION ALL
  SELECT {key}, t, p0, k, p0 + CASE WHEN p0 + 900 < length(t) AND {last} - 1 > 40 THEN {last} ELSE least(900, length(t) - p0) END AS stop
  FROM (SELECT {key}, t, nat AS p0, k + 1 AS k, substr(t, nat + 1, 900) AS w FROM (SELECT {key}, t, k, CASE WHEN stop - p0 > 150 THEN stop - 150 ELSE stop END AS nat FROM steps WHERE length(t) > 900) WHERE nat < length(t))
),
raw_pieces AS (SELECT {key}, k, trim(substr(t, p0 + 1, stop - p0)) AS piece FROM steps),
pieces AS (SELECT {key}, row_number() OVER (PARTITION BY {key} ORDER BY k) - 1 AS piece_no, piece FROM raw_pieces WHERE length(piece) >= 40)"""


def chunk_clean(x: str) -> str:
    bare = rf"regexp_replace(coalesce({x}, ''), '\\([_*#`\[\]()])', '\1', 'g')"
    return squeeze(rf"regexp_replace({bare}, '(^|{SPACE})#{{1,6}}{SPACE}+', '\1', 'g')")


UNITS = rf"""
{DOCS},
rawl AS (SELECT doc_id, i AS p0, regexp_replace(regexp_split_to_array(text, '\r\n|[\n\r\x{{0B}}\x{{0C}}\x{{1C}}-\x{{1E}}\x{{85}}\x{{2028}}\x{{2029}}]')[i], '^{SPACE}+|{SPACE}+$', '', 'g') AS line
  FROM docs, range(1, len(regexp_split_to_array(text, '\r\n|[\n\r\x{{0B}}\x{{0C}}\x{{1C}}-\x{{1E}}\x{{85}}\x{{2028}}\x{{2029}}]')) + 1) r(i)),
headed AS (SELECT *, regexp_matches(line, '^#{{1,6}}{SPACE}+.*$') AS h FROM rawl),
grouped AS (SELECT *, sum(h::INT) OVER (PARTITION BY doc_id ORDER BY p0) AS unit FROM headed),
units AS (
  SELECT doc_id, unit::INT AS unit, coalesce(max(regexp_extract(line, '^#{{1,6}}{SPACE}+(.*)$', 1)) FILTER (WHERE h), '') AS heading,
    string_agg(line, ' ' ORDER BY p0) FILTER (WHERE NOT h AND line <> '' AND NOT regexp_matches(line, '^[|!<]')) AS body
  FROM grouped GROUP BY doc_id, unit HAVING count(*) FILTER (WHERE NOT h AND line <> '' AND NOT regexp_matches(line, '^[|!<]')) > 0
)"""

ASKED = "asked AS (SELECT DISTINCT item_id AS qid, query FROM eval_items)"
BM25 = f"""
{tokens("docs", "doc_id", "text")},
tf AS (SELECT doc_id, term, count(*) AS tf FROM docs_tok GROUP BY ALL),
dl AS (SELECT docs.doc_id, count(term) AS dl FROM docs LEFT JOIN docs_tok USING (doc_id) GROUP BY ALL),
corpus AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
idf AS (SELECT term, count(*) AS df, ln(1 + (any_value(n) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, corpus GROUP BY term),
{tokens("asked", "qid", "query")},
qtf AS (SELECT qid, term, count(*) AS qtf FROM asked_tok GROUP BY ALL),
scored AS (
  SELECT qid, doc_id, round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))), 9) AS score
  FROM qtf JOIN tf USING (term) JOIN idf USING (term) JOIN dl USING (doc_id), corpus GROUP BY qid, doc_id
),
lexical AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 60)"""


def dense(queries: str, key: str) -> str:
    return f"""
dense AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, {key}) AS rank FROM (
  SELECT q.qid, e.vec_id AS {key}, round(list_dot_product(q.vector::DOUBLE[], e.embedding::DOUBLE[]), 9) AS score FROM {queries} q, embeddings e)) WHERE rank <= 60)"""


FUSION = f"""
{DOCS},
numbered AS (SELECT item_id AS qid, query, row_number() OVER (ORDER BY item_id) - 1 AS i FROM (SELECT DISTINCT item_id, query FROM eval_items)),
asked AS (SELECT qid, query, embedding AS vector FROM numbered LEFT JOIN embeddings ON vec_id = i * 50),
{BM25},
{dense("(SELECT * FROM asked WHERE vector IS NOT NULL)", "doc_id")},
met AS (SELECT coalesce(d.qid, l.qid) AS qid, coalesce(d.doc_id, l.doc_id) AS doc_id, d.rank AS dr, l.rank AS lr, d.score AS ds, l.score AS ls FROM dense d FULL JOIN lexical l ON d.qid = l.qid AND d.doc_id = l.doc_id),
rrf AS (SELECT *, coalesce(1 / (60.0::DOUBLE + dr), 0) + coalesce(1 / (60.0::DOUBLE + lr), 0) AS base, least(dr, lr) AS best FROM met)"""


def ordered(fused: str, source: str) -> str:
    return f"SELECT qid, doc_id, fused, row_number() OVER (PARTITION BY qid ORDER BY fused DESC, dr ASC NULLS LAST, lr ASC NULLS LAST, doc_id) AS rank FROM (SELECT *, round({fused}, 9) AS fused FROM {source})"


REGS = "regs AS (SELECT DISTINCT ON (record_id) * FROM knowledge WHERE collection = 'registers')"
_TAILS = r"tails AS (SELECT DISTINCT lower(regexp_extract(register_name, '_([A-Za-z_]+)$', 1)) AS query FROM knowledge WHERE collection = 'registers' AND contains(register_name, '_') AND regexp_extract(register_name, '_([A-Za-z_]+)$', 1) <> '')"
_HAY = "lower(array_to_string(list_concat([coalesce(register_name, ''), coalesce(description, '')], flatten(list_transform(coalesce(bit_fields, []), lambda f: [coalesce(f.name, ''), coalesce(f.description, '')]))), ' '))"


def found(module: str) -> str:
    return f"""{REGS}, {_TAILS},
found AS (SELECT query, record_id, section_id, row_number() OVER (PARTITION BY query ORDER BY record_id) AS place, count(*) OVER (PARTITION BY query) AS n_found
  FROM (SELECT *, {_HAY} AS hay FROM regs) r JOIN tails ON contains(hay, query) WHERE contains(lower(module), '{module}'))"""


_NAMED = """(SELECT upper(register_name) AS name, lower(coalesce(address, '')) AS address, list_distinct(list_transform(list_filter(coalesce(bit_fields, []), lambda f: coalesce(f.name, '') <> ''), lambda f: upper(f.name))) AS fields
  FROM {t} WHERE {w} coalesce(register_name, '') <> '' QUALIFY row_number() OVER (PARTITION BY upper(register_name) ORDER BY built_at DESC, {k} DESC) = 1)"""
COMPARED = f"""
ka AS {_NAMED.format(t="knowledge", w="collection = 'registers' AND", k="record_id")},
kb AS {_NAMED.format(t="knowledge_alt", w="", k="alt_id")},
cmp AS (
  SELECT coalesce(ka.name, kb.name) AS name, CASE WHEN kb.name IS NULL THEN 'only_a' WHEN ka.name IS NULL THEN 'only_b' ELSE 'both' END AS side,
    CASE WHEN ka.name IS NULL OR kb.name IS NULL THEN NULL WHEN ka.address = '' AND kb.address = '' THEN 'missing_both' WHEN ka.address = '' THEN 'missing_a' WHEN kb.address = '' THEN 'missing_b' WHEN ka.address = kb.address THEN 'agree' ELSE 'mismatch' END AS address,
    CASE WHEN ka.name IS NULL OR kb.name IS NULL OR len(list_distinct(list_concat(ka.fields, kb.fields))) = 0 THEN NULL
      ELSE round(len(list_intersect(ka.fields, kb.fields))::DOUBLE / len(list_distinct(list_concat(ka.fields, kb.fields))), 6) END AS field_jaccard
  FROM ka FULL JOIN kb ON ka.name = kb.name
)"""

def _field(x: str) -> str:
    return f"replace({squeeze(f"replace(lower(coalesce({x}, '')), '_', ' ')")}, ' ', '_')"


_RELATIVE = ordered(
    "CASE WHEN dt IS NULL OR lt IS NULL THEN base ELSE CASE WHEN dt > 0 THEN 0.5 * coalesce(ds / dt, 0) ELSE 0 END + 0.5 * coalesce(ls / lt, 0) END",
    "(SELECT * FROM tops WHERE dt IS NULL OR lt IS NULL OR dt > 0 OR lr IS NOT NULL)",
)
_TITLE = "coalesce(s.title, '')"
_REGISTER_TEXT = """array_to_string(list_filter(list_concat([coalesce(register_name, ''), coalesce(address, ''), coalesce(description, '')],
  list_transform(coalesce(bit_fields, []), lambda f: array_to_string(list_filter([f.bit_range, f.name, f.access, f.reset_value, f.description], lambda x: coalesce(x, '') <> ''), ' '))), lambda x: x <> ''), '. ')"""
SQL = {
    "clean_text": f"WITH {BLOCKS} SELECT block_id, {denoised('c')} AS clean FROM (SELECT block_id, {cleaned('text')} AS c FROM blocks WHERE type = 'text')",
    "stem_dictionary": f"SELECT w AS word, {stem('w')} AS stem FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS w FROM documents)",
    "tokenize_terms": f"WITH {tokens('documents', 'doc_id', 'text')} SELECT term, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM documents_tok GROUP BY term",
    "section_slug": "SELECT section_row, CASE WHEN coalesce(title, '') = '' THEN '' ELSE left(lower(module) || ':' || trim(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '-'), 120) END AS slug FROM kb_sections",
    "module_from_path": r"SELECT DISTINCT doc_file, upper(regexp_extract(doc_file, '([^/]*)_content_list\.json$', 1)) AS module FROM acme_content_list",
    "register_tokens": f"WITH {BLOCKS} SELECT * FROM (SELECT block_id, {token('c')} AS token FROM (SELECT block_id, {cleaned('text')} AS c FROM blocks WHERE type = 'text')) WHERE token <> ''",
    "register_texts": """SELECT DISTINCT record_id, array_to_string(list_filter(list_concat([coalesce(register_name, ''), coalesce(address, ''), coalesce(description, '')],
  list_transform(coalesce(bit_fields, []), lambda f: array_to_string(list_filter([f.bit_range, f.name, f.access, f.reset_value, f.description], lambda x: coalesce(x, '') <> ''), ' '))), lambda x: x <> ''), '. ') AS text
FROM knowledge WHERE collection = 'registers'""",
    "html_rows": f"WITH {BLOCKS}, {ROWS} SELECT block_id, row_no::INT AS row_no, array_to_string(cells, ' | ') AS cells FROM rws",
    "table_classes": f"WITH {BLOCKS}, {ROWS} SELECT block_id, {table_class('cells')} AS class, {find_col('cells', 'bit_position')} AS bit_col, {find_col('cells', 'address')} AS address_col FROM rws WHERE row_no = 0",
    "anchors": f"WITH {ROLES} SELECT block_id, role, section_id, register_anchor FROM noted",
    "kb_sections_built": f"WITH {ROLES}, {SECS} SELECT * FROM secs",
    "kb_registers_built": f"""WITH {ROLES}, {SECS}, {TABS}, {BODY},
flds AS (SELECT doc_file, register_anchor, pos, row_no, concat_ws('~', coalesce(nullif({at('cells', 'c_field_name')}, ''), 'RESERVED'), {', '.join(at('cells', f'c_{k}') for k in ('bit_position', 'access', 'reset', 'typical', 'description'))}) AS f
  FROM body WHERE class = 'bitfield' AND register_anchor IS NOT NULL AND regexp_matches({at('cells', 'c_bit_position')}, '{_POS}')),
firsts AS (SELECT t.doc_file, t.register_anchor AS register_name, min(t.pos) AS ord, arg_min(t.module, t.pos) AS module, arg_min({_TITLE}, t.pos) AS description, arg_min(coalesce(t.section_id, ''), t.pos) AS section_id, arg_min({{p: t.page_idx}}, t.pos).p AS page
  FROM tabs t {_TITLED} WHERE t.class = 'bitfield' AND t.register_anchor IS NOT NULL GROUP BY ALL),
named AS (SELECT doc_file, pos, row_no, list_filter(string_split(replace({at('cells', 'c_register')}, '(O..', '(0..'), ' '), lambda t: contains(t, '_') AND regexp_matches(t, '^(?:{REGISTER_NAME})'))[1] AS register_name, regexp_extract({at('cells', 'c_address')}, '0x[0-9A-Fa-f]+') AS address FROM body WHERE class = 'summary'),
addr AS (SELECT doc_file, register_name, arg_max(address, pos * 100000 + row_no) AS address FROM named WHERE register_name IS NOT NULL GROUP BY ALL)
SELECT f.doc_file, f.ord, f.register_name, coalesce(a.address, '') AS address, f.module, f.description, f.section_id, f.page, coalesce(string_agg(x.f, '; ' ORDER BY x.pos, x.row_no), '') AS bit_fields
FROM firsts f LEFT JOIN addr a USING (doc_file, register_name) LEFT JOIN flds x ON x.doc_file = f.doc_file AND x.register_anchor = f.register_name GROUP BY ALL""",
    "kb_enums_built": f"""WITH {ROLES}, {SECS}, {TABS}, {BODY},
vals AS (SELECT block_id, string_agg(concat_ws('~', {', '.join(at('cells', f'c_{k}') for k in ('value', 'mnemonic', 'description'))}), '; ' ORDER BY row_no) AS v FROM body WHERE class = 'enum' AND ({at('cells', 'c_value')} <> '' OR {at('cells', 'c_mnemonic')} <> '') GROUP BY block_id)
SELECT t.doc_file, t.pos AS ord, t.module, CASE WHEN regexp_matches(coalesce(t.register_anchor, ''), '(_E|_S)$') THEN t.register_anchor WHEN {_TITLE} <> '' THEN s.title ELSE coalesce(t.register_anchor, '') END AS name,
  coalesce(t.section_id, '') AS section_id, coalesce(v, '') AS "values", t.page_idx AS page FROM tabs t {_TITLED} LEFT JOIN vals USING (block_id) WHERE t.class = 'enum'""",
    "kb_tables_built": f"""WITH {ROLES}, {SECS}, {TABS.replace(table_class("cells"), table_class("cells", ALIASES))}, lines AS (SELECT block_id, string_agg(array_to_string(cells, ' | '), chr(10) ORDER BY row_no) FILTER (WHERE row_no > 0) AS body FROM rws GROUP BY block_id)
SELECT t.doc_file, t.pos AS ord, t.module, coalesce(t.section_id, '') AS section_id, {_TITLE} AS caption, trim(array_to_string(header, ' | ') || chr(10) || coalesce(body, ''), ' ' || chr(10)) AS text, t.page_idx AS page
FROM tabs t {_TITLED} LEFT JOIN lines USING (block_id) WHERE t.class = 'other'""",
    "kb_figures_built": f"""WITH {ROLES}, {SECS} SELECT t.doc_file, t.pos AS ord, t.module, coalesce(t.section_id, '') AS section_id, coalesce(array_to_string(list_transform(t.image_caption, lambda c: {cleaned('c')}), ' '), '') AS caption,
  CASE WHEN coalesce(t.img_path, '') = '' THEN '' ELSE 'images/' || t.module || '/' || regexp_extract(t.img_path, '([^/]+)/*$', 1) END AS img_path, t.page_idx AS page, left(trim(coalesce(s.text, '')), 600) AS context
FROM noted t {_TITLED} WHERE t.type IN ('image', 'chart')""",
    "kb_formulas_built": f"WITH {ROLES} SELECT * FROM (SELECT doc_file, pos AS ord, module, coalesce(section_id, '') AS section_id, {cleaned("coalesce(nullif(text, ''), latex)")} AS latex, page_idx AS page FROM noted WHERE type = 'equation') WHERE latex <> ''",
    "kb_algorithms_built": f"""WITH {ROLES} SELECT * FROM (SELECT doc_file, pos AS ord, module, coalesce(section_id, '') AS section_id, coalesce(sub_type, '') AS sub_type, coalesce(array_to_string(list_transform(code_caption, lambda c: {cleaned('c')}), ' '), '') AS caption,
  {cleaned("coalesce(nullif(code_body, ''), text)")} AS text, page_idx AS page FROM noted WHERE type = 'code') WHERE text <> ''""",
    "event_forward_fill": "SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_signup FROM events",
    "adapter_blocks": rf"""WITH {BLOCKS}, x AS (SELECT *, CASE WHEN type IN ('header', 'footer', 'table', 'equation', 'code') THEN type WHEN type IN ('image', 'chart') THEN 'image' ELSE 'text' END AS t, coalesce(code_body, text) AS body FROM blocks)
SELECT doc_file, pos, t AS type, CASE WHEN t IN ('text', 'header', 'footer', 'equation') THEN coalesce(body, '') END AS text, CASE WHEN text_level IS NOT NULL THEN CASE WHEN text_level > 0 THEN text_level ELSE 1 END END AS text_level,
  greatest(coalesce(page_idx - 1, 0), 0) AS page_idx, CASE WHEN t = 'table' THEN table_body END AS table_body, CASE WHEN t = 'code' THEN body END AS code_body, CASE WHEN t = 'code' THEN 'code' END AS sub_type,
  CASE WHEN t = 'image' THEN coalesce(array_to_string(image_caption, ' '), '') END AS image_caption, CASE WHEN t = 'image' THEN coalesce(img_path, '') END AS img_path
FROM x WHERE t IN ('header', 'footer', 'image') OR (t = 'table' AND coalesce(table_body, '') <> '') OR (t IN ('text', 'equation', 'code') AND regexp_matches(coalesce(body, ''), '[^{SPACE[1:]}'))""",
    "split_long": f"WITH RECURSIVE {DOCS}, src AS (SELECT doc_id, {chunk_clean('text')} AS body FROM docs), {split_cte('src', 'doc_id', 'body')} SELECT doc_id, piece_no::INT AS piece_no, piece FROM pieces",
    "breadcrumb_chunks": f"""WITH RECURSIVE {ROLES}, {SECS}, {TABS}, {BODY}, {UNITS},
vals AS (SELECT block_id, string_agg(array_to_string(list_filter([{', '.join(at('cells', f'c_{k}') for k in ('value', 'mnemonic', 'description'))}], lambda x: x <> ''), ' '), '. ' ORDER BY row_no) AS v FROM body
  WHERE class = 'enum' AND ({at('cells', 'c_value')} <> '' OR {at('cells', 'c_mnemonic')} <> '') GROUP BY block_id),
enums AS (SELECT t.*, CASE WHEN regexp_matches(coalesce(t.register_anchor, ''), '(_E|_S)$') THEN t.register_anchor WHEN {_TITLE} <> '' THEN s.title ELSE coalesce(t.register_anchor, '') END AS name, v FROM tabs t {_TITLED} LEFT JOIN vals USING (block_id) WHERE t.class = 'enum'),
grids AS (SELECT block_id, string_agg(array_to_string(cells, ' | '), chr(10) ORDER BY row_no) AS grid FROM rws GROUP BY block_id),
codes AS (SELECT doc_file, pos, module, coalesce(section_id, '') AS section_id, coalesce(nullif(array_to_string(list_transform(code_caption, lambda c: {cleaned('c')}), ' '), ''), sub_type, '') AS title, {cleaned("coalesce(nullif(code_body, ''), text)")} AS text FROM noted WHERE type = 'code'),
src AS (
  SELECT 1 AS k, 'section' AS kind, section_row AS ord, section_id, module, title, text FROM kb_sections
  UNION ALL SELECT 2, 'algorithm', row_number() OVER (ORDER BY doc_file, pos) - 1, section_id, module, title, text FROM codes WHERE text <> ''
  UNION ALL SELECT 3, 'register', record_id, section_id, module, register_name, {_REGISTER_TEXT} FROM (SELECT DISTINCT ON (record_id) * FROM knowledge WHERE collection = 'registers')
  UNION ALL SELECT 4, 'enum', row_number() OVER (ORDER BY doc_file, pos) - 1, coalesce(section_id, ''), module, name, name || CASE WHEN name <> '' AND coalesce(v, '') <> '' THEN '. ' ELSE '' END || coalesce(v, '') FROM enums
  UNION ALL SELECT 5, 'table', row_number() OVER (ORDER BY t.doc_file, t.pos) - 1, coalesce(t.section_id, ''), t.module, {_TITLE}, grid FROM tabs t {_TITLED} JOIN grids USING (block_id) WHERE t.class = 'other'
  UNION ALL SELECT 6, 'markdown', row_number() OVER (ORDER BY u.doc_id, u.unit) - 1, '', docs.module, heading, body FROM units u JOIN docs USING (doc_id) WHERE {squeeze('lower(heading)')} = '' OR NOT EXISTS (
    SELECT 1 FROM kb_sections k WHERE k.module = docs.module AND {squeeze("lower(coalesce(k.title, ''))")} = {squeeze('lower(u.heading)')})
),
neat AS (SELECT row_number() OVER () AS uid, k, kind, ord, section_id, module, {chunk_clean('title')} AS title, {chunk_clean('text')} AS body FROM src),
long AS (SELECT * FROM neat WHERE length(body) >= 40), {split_cte('long', 'uid', 'body')},
crumbs AS (SELECT *, array_to_string(list_filter([module, title], lambda x: x <> ''), ' › ') AS breadcrumb FROM long)
SELECT row_number() OVER (ORDER BY k, ord, piece_no) - 1 AS chunk_idx, kind, section_id, ord, piece_no::INT AS piece, breadcrumb, CASE WHEN breadcrumb <> '' THEN breadcrumb || ' › ' ELSE '' END || piece AS embed_text FROM pieces JOIN crumbs USING (uid)""",
    "markdown_units": f"WITH {UNITS} SELECT * FROM units",
    "uncovered_units": f"""WITH {UNITS} SELECT doc_id, unit, heading FROM units u JOIN docs USING (doc_id) WHERE {squeeze('lower(heading)')} = '' OR NOT EXISTS (
  SELECT 1 FROM kb_sections k WHERE k.module = docs.module AND {squeeze("lower(coalesce(k.title, ''))")} = {squeeze('lower(u.heading)')})""",
    "doc_freq_idf": f"""WITH {DOCS}, {tokens('docs', 'doc_id', 'text')}, n AS (SELECT count(*) AS n FROM docs)
SELECT term, count(DISTINCT doc_id) AS df, round(ln(1 + (any_value(n) - count(DISTINCT doc_id) + 0.5) / (count(DISTINCT doc_id) + 0.5)), 6) AS idf FROM docs_tok, n GROUP BY term""",
    "bm25_topk": f"WITH {DOCS}, {ASKED}, {BM25} SELECT qid, doc_id, score, rank FROM lexical",
    "dense_topk": f"WITH q AS (SELECT vec_id AS qid, embedding AS vector FROM embeddings WHERE vec_id % 50 = 0), {dense('q', 'vec_id')} SELECT qid, vec_id, score, rank FROM dense",
    "rrf_fusion": f"WITH {FUSION} {ordered('base', 'rrf')}",
    "rrf_bonus": f"WITH {FUSION} {ordered('base + CASE WHEN best = 1 THEN 0.05 WHEN best <= 3 THEN 0.02 ELSE 0 END', 'rrf')}",
    "relative_fusion": f"""WITH {FUSION}, tops AS (SELECT *, max(ds) OVER (PARTITION BY qid) AS dt, max(ls) OVER (PARTITION BY qid) AS lt FROM rrf)
{_RELATIVE}""",
    "hybrid_module_filter": f"""WITH {FUSION}, fused AS ({ordered('base', 'rrf')})
SELECT qid, doc_id, rank, place FROM (SELECT qid, doc_id, rank, row_number() OVER (PARTITION BY qid ORDER BY rank) AS place FROM fused JOIN docs USING (doc_id) WHERE contains(lower(source), 'north')) WHERE place <= 5""",
    "register_search": f"""WITH {found('')} SELECT query, record_id, place, n_found, md5(coalesce(text, '')) AS section_md5
FROM found LEFT JOIN (SELECT section_id, arg_max(text, section_row) AS text FROM kb_sections GROUP BY section_id) USING (section_id) WHERE place <= 50""",
    "register_search_module": f"WITH {found('lite')} SELECT query, record_id, place, n_found FROM found WHERE place <= 50",
    "concept_search": r"""WITH kn AS (SELECT DISTINCT ON (record_id) * FROM knowledge),
words AS (SELECT DISTINCT lower(regexp_extract(name, '_([A-Z]{4,})', 1)) AS query FROM kn WHERE regexp_matches(name, '_([A-Z]{4,})')),
rows AS (SELECT collection AS kind, record_id, lower(concat_ws(' ', name, caption, description)) AS hay FROM kn WHERE collection IN ('formulas', 'algorithms', 'enums', 'tables', 'figures')
  UNION ALL SELECT 'sections', section_row, lower(concat_ws(chr(10), title, text)) FROM (SELECT DISTINCT ON (section_row) * FROM kb_sections)),
hits AS (SELECT query, kind, record_id FROM rows JOIN words ON contains(hay, query))
SELECT query, kind, CASE WHEN kind IN ('sections', 'tables') THEN least(50, count(*)) ELSE count(*) END AS n, CASE WHEN kind IN ('sections', 'tables') THEN least(50, count(*)) ELSE count(*) END AS last_place FROM hits GROUP BY query, kind""",
    "audit_counts": f"""WITH {ROLES}, {TABS}, each AS (
  SELECT doc_file, 'block' AS metric, type AS label FROM blocks UNION ALL SELECT doc_file, 'heading', text_level::VARCHAR FROM blocks WHERE type = 'text' AND coalesce(text_level, 0) <> 0
  UNION ALL SELECT doc_file, 'table', class FROM tabs UNION ALL SELECT doc_file, 'image', 'without path' FROM blocks WHERE type IN ('image', 'chart') AND coalesce(img_path, '') = ''
  UNION ALL SELECT DISTINCT doc_file, 'anchor', tok FROM (SELECT doc_file, {token('c')} AS tok FROM (SELECT doc_file, {cleaned('text')} AS c FROM blocks WHERE type = 'text')) WHERE tok <> ''
), counted AS (SELECT doc_file, metric, CASE WHEN metric = 'anchor' THEN 'distinct' ELSE label END AS label, count(*) AS n FROM each GROUP BY ALL)
SELECT doc_file, metric, label, n FROM counted UNION ALL SELECT NULL, metric, label, sum(n)::BIGINT FROM counted GROUP BY metric, label""",
    "unknown_headers_top20": f"""WITH {BLOCKS}, {ROWS} SELECT array_to_string(cells, ' | ') AS header, count(*) AS n FROM rws WHERE row_no = 0 AND {table_class('cells', ALIASES)} = 'other' GROUP BY header ORDER BY n DESC, header LIMIT 20""",
    "validate_duplicates": """SELECT 'section' AS kind, section_id AS key, count(*) AS n FROM kb_sections WHERE coalesce(section_id, '') <> '' GROUP BY section_id HAVING count(*) > 1
UNION ALL SELECT 'register', module || ':' || register_name, count(*) FROM knowledge WHERE collection = 'registers' AND coalesce(module, '') <> '' AND coalesce(register_name, '') <> '' GROUP BY module, register_name HAVING count(*) > 1""",
    "validate_orphans": "SELECT collection, count(*) AS n_orphans FROM knowledge WHERE coalesce(section_id, '') <> '' AND section_id NOT IN (SELECT section_id FROM kb_sections WHERE section_id IS NOT NULL) GROUP BY collection",
    "coverage": """WITH r AS (SELECT count(*) AS of, count(*) FILTER (WHERE coalesce(address, '') <> '') AS a, count(*) FILTER (WHERE coalesce(len(bit_fields), 0) > 0) AS b FROM knowledge WHERE collection = 'registers'),
s AS (SELECT count(*) AS of, count(*) FILTER (WHERE coalesce(text, '') <> '') AS t FROM kb_sections)
SELECT 'registers_with_address' AS metric, a AS n, of, round(a::DOUBLE / of, 6) AS share, round(a::DOUBLE / of, 6) < 0.5 AS low FROM r UNION ALL SELECT 'registers_with_bit_fields', b, of, round(b::DOUBLE / of, 6), round(b::DOUBLE / of, 6) < 1.0 FROM r
UNION ALL SELECT 'sections_with_text', t, of, round(t::DOUBLE / of, 6), false FROM s""",
    "compare_registers": f"WITH {COMPARED} SELECT * FROM cmp",
    "compare_summary": f"""WITH {COMPARED}, s AS (SELECT count(*) FILTER (WHERE side = 'both') AS shared, count(*) FILTER (WHERE side = 'only_a') AS only_a, count(*) FILTER (WHERE side = 'only_b') AS only_b,
  count(*) FILTER (WHERE address = 'agree') AS agree, count(*) FILTER (WHERE address = 'mismatch') AS mismatch, count(*) FILTER (WHERE address IN ('missing_a', 'missing_both')) AS missing_a,
  count(*) FILTER (WHERE address IN ('missing_b', 'missing_both')) AS missing_b, round(avg(field_jaccard), 6) AS mean_field_jaccard FROM cmp)
SELECT *, round(coalesce(shared::DOUBLE / nullif(shared + only_a + only_b, 0), 1), 6) AS jaccard, shared > 0 AND missing_a >= 0.8 * shared AS gap_a, shared > 0 AND missing_b >= 0.8 * shared AS gap_b FROM s""",
    "question_errors": """SELECT item_id, unnest(list_filter([CASE WHEN item_id IS NULL THEN 'no id' END, CASE WHEN trim(coalesce(query, '')) = '' THEN 'no query' END, CASE WHEN trim(coalesce(source, '')) = '' THEN 'no source' END,
  CASE WHEN NOT coalesce(type IN ('register', 'figure', 'prose'), false) THEN 'unknown type' END, CASE WHEN type IN ('register', 'figure') AND trim(coalesce(keyword, '')) = '' THEN 'no keyword' END,
  CASE WHEN type IN ('register', 'figure', 'prose') AND trim(coalesce(CASE type WHEN 'register' THEN expected.register_name WHEN 'figure' THEN expected.caption_contains ELSE expected.section_contains END, '')) = '' THEN 'nothing expected' END], lambda x: x IS NOT NULL)) AS error FROM eval_items""",
    "hit_at_k": f"""WITH {FUSION}, {REGS},
words AS (SELECT DISTINCT ON (item_id) item_id AS qid, lower(trim(coalesce(keyword, query))) AS needle, lower(trim(coalesce(module, ''))) AS want, type, expected FROM eval_items),
reg_hits AS (SELECT qid, expected, register_name, bit_fields, row_number() OVER (PARTITION BY qid ORDER BY record_id) AS rank
  FROM words JOIN (SELECT *, {_HAY} AS hay FROM regs) r ON contains(hay, needle) AND contains(lower(coalesce(r.module, '')), want) WHERE type = 'register' AND needle <> ''),
fig_hits AS (SELECT qid, expected, caption, row_number() OVER (PARTITION BY qid ORDER BY record_id) AS rank
  FROM words JOIN (SELECT DISTINCT ON (record_id) * FROM knowledge WHERE collection = 'figures') f ON contains(lower(concat_ws(' ', f.name, f.caption, f.description)), needle) AND contains(lower(coalesce(f.module, '')), want) WHERE type = 'figure' AND needle <> ''),
tops AS (SELECT *, max(ds) OVER (PARTITION BY qid) AS dt, max(ls) OVER (PARTITION BY qid) AS lt FROM rrf),
only_lexical AS (SELECT qid, doc_id, NULL AS dr, rank AS lr, 1 / (60.0::DOUBLE + rank) AS base FROM lexical),
lists AS (
  SELECT 'bm25' AS config, * FROM ({ordered('base', 'only_lexical')}) UNION ALL SELECT 'hybrid_rrf', * FROM ({ordered('base', 'rrf')})
  UNION ALL SELECT 'hybrid_rrf_bonus', * FROM ({ordered('base + CASE WHEN best = 1 THEN 0.05 WHEN best <= 3 THEN 0.02 ELSE 0 END', 'rrf')}) UNION ALL SELECT 'hybrid_relative', * FROM ({_RELATIVE})
),
doc_hits AS (SELECT config, l.qid, w.expected, d.text, row_number() OVER (PARTITION BY config, l.qid ORDER BY l.rank) AS place FROM lists l JOIN words w USING (qid) JOIN docs d USING (doc_id) WHERE w.type = 'prose' AND contains(lower(d.module), w.want)),
near AS (
  SELECT 'search_registers' AS config, qid, rank FROM reg_hits WHERE rank <= 50 AND (trim(coalesce(expected.register_name, '')) <> '' OR trim(coalesce(expected.bit_field, '')) <> '')
    AND (trim(coalesce(expected.register_name, '')) = '' OR contains(lower(coalesce(register_name, '')), lower(expected.register_name)))
    AND (trim(coalesce(expected.bit_field, '')) = '' OR len(list_filter(coalesce(bit_fields, []), lambda f: contains({_field('f.name')}, {_field('expected.bit_field')}))) > 0)
  UNION ALL SELECT 'search_concepts', qid, rank FROM fig_hits WHERE trim(coalesce(expected.caption_contains, '')) <> '' AND contains(lower(coalesce(caption, '')), lower(expected.caption_contains))
  UNION ALL SELECT config, qid, place FROM doc_hits WHERE place <= 10 AND trim(coalesce(expected.section_contains, '')) <> '' AND contains(lower(text), lower(expected.section_contains))
),
firsts AS (SELECT config, qid, min(rank) AS first FROM near GROUP BY ALL),
configs(config, kind) AS (VALUES ('search_registers', 'register'), ('search_concepts', 'figure'), ('bm25', 'prose'), ('hybrid_rrf', 'prose'), ('hybrid_rrf_bonus', 'prose'), ('hybrid_relative', 'prose'))
SELECT c.config, w.type, count(*) AS n, count(*) FILTER (WHERE first <= 1) AS hit1, count(*) FILTER (WHERE first <= 5) AS hit5 FROM configs c JOIN words w ON w.type = c.kind LEFT JOIN firsts f ON f.config = c.config AND f.qid = w.qid GROUP BY ALL""",
    "search_prose": f"""WITH {FUSION}, fused AS ({ordered('base', 'rrf')}), asks AS (SELECT DISTINCT item_id AS qid, lower(trim(coalesce(module, ''))) AS want FROM eval_items),
placed AS (SELECT f.qid, f.doc_id, f.fused, row_number() OVER (PARTITION BY f.qid ORDER BY f.rank) AS place FROM fused f JOIN asks USING (qid) JOIN docs USING (doc_id) WHERE contains(lower(docs.module), want))
SELECT qid, doc_id, place, fused, CASE WHEN qid IN (SELECT qid FROM asked WHERE vector IS NOT NULL) THEN 'hybrid' ELSE 'lexical only' END AS note FROM placed WHERE place <= 5""",
    "unanchored_questions": """SELECT DISTINCT item_id, 'register not in the knowledge base' AS error FROM eval_items e WHERE trim(coalesce(expected.register_name, '')) <> ''
  AND NOT EXISTS (SELECT 1 FROM knowledge k WHERE collection = 'registers' AND contains(lower(k.register_name), lower(e.expected.register_name)))
UNION ALL SELECT DISTINCT item_id, 'caption not in the knowledge base' FROM eval_items e WHERE trim(coalesce(expected.caption_contains, '')) <> ''
  AND NOT EXISTS (SELECT 1 FROM knowledge k WHERE collection = 'figures' AND contains(lower(k.caption), lower(e.expected.caption_contains)))
UNION ALL SELECT DISTINCT item_id, 'section not in the knowledge base' FROM eval_items e WHERE trim(coalesce(expected.section_contains, '')) <> ''
  AND NOT EXISTS (SELECT 1 FROM kb_sections s WHERE contains(lower(concat_ws(chr(10), s.title, s.text)), lower(e.expected.section_contains)))""",
    "collection_counts": """SELECT c.collection, (SELECT count(*) FROM knowledge k WHERE k.collection = c.collection) AS n_left, CASE WHEN c.collection = 'registers' THEN (SELECT count(*) FROM knowledge_alt) ELSE 0 END AS n_right
FROM (VALUES ('registers'), ('enums'), ('figures'), ('formulas'), ('algorithms'), ('tables')) c(collection)""",
}
_VALIDATED = """SELECT 'error' AS level, 'duplicate ' || kind AS check, count(*) AS n FROM ({duplicates}) GROUP BY kind
UNION ALL SELECT 'error', 'orphans in ' || collection, n_orphans FROM ({orphans}) UNION ALL SELECT 'warning', 'low ' || metric, of - n FROM ({coverage}) WHERE low"""
SQL["validation_report"] = _VALIDATED.format(duplicates=SQL["validate_duplicates"], orphans=SQL["validate_orphans"], coverage=SQL["coverage"]).replace("AS check,", 'AS "check",')
SQL["chunk_counts"] = f"SELECT kind, count(*) AS n FROM ({SQL['breadcrumb_chunks']}) GROUP BY kind"
SQL["concept_search_built"] = f"""WITH words AS (SELECT DISTINCT lower(regexp_extract(name, '_([A-Z]{{4,}})', 1)) AS query FROM knowledge WHERE regexp_matches(name, '_([A-Z]{{4,}})')),
rows AS (SELECT 'enums' AS kind, doc_file || '#' || ord AS key, lower(concat_ws(' ', name, "values")) AS hay FROM ({SQL['kb_enums_built']}) UNION ALL SELECT 'tables', doc_file || '#' || ord, lower(concat_ws(' ', caption, text)) FROM ({SQL['kb_tables_built']}))
SELECT query, kind, key, row_number() OVER (PARTITION BY query, kind ORDER BY key) AS place FROM rows JOIN words ON contains(hay, query)"""
