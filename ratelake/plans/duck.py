"""Pieces of the check SQL (DuckDB dialect)."""

from __future__ import annotations

from ratelake.plans.model import CANDIDATE_SQL, CONTEXT_SQL, REPEATED

# The check states its patterns and rules itself, so that a wrong one in the library shows.
WS = r"[ \t\n\r\f\x0B\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
HYPHENS = r"[\x{2012}-\x{2014}\x{2212}]"
BOUNDED = r"([0-9]+(?:[.][0-9]+)?)[ ]*(?:-|to)[ ]*([0-9]+(?:[.][0-9]+)?)"
OPEN_HIGH = r"([0-9]+(?:[.][0-9]+)?)(?:[ ]*[+]|[ ]*and[ ]+above)"
AT_LEAST = r">=[ ]*([0-9]+(?:[.][0-9]+)?)"
OPEN_LOW = r"(?:<|under|less[ ]+than)[ ]*([0-9]+(?:[.][0-9]+)?)"
NUMBER_PREFIX = r"^[-+]?(?:[0-9]+[.]?[0-9]*|[.][0-9]+)(?:[eE][-+]?[0-9]+)?"
FULL_MONTHS = "january february march april may june july august september october november december".split()
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]


def collapse(text: str) -> str:
    return f"trim(regexp_replace({text}, '{WS}+', ' ', 'g'))"


def clean_range(text: str) -> str:
    hyphens = f"regexp_replace({text}, '{HYPHENS}', '-', 'g')"
    return collapse(f"lower(regexp_replace({hyphens}, '[$,]', '', 'g'))")


def number(text: str, pattern: str, group: int = 1) -> str:
    return f"TRY_CAST(nullif(regexp_extract({text}, '{pattern}', {group}), '') AS DOUBLE)"


def range_parts(clean: str, raw: str) -> dict[str, str]:
    """low, high, bracket_id and parsed, from a cleaned text column."""
    lo, hi = number(clean, BOUNDED, 1), number(clean, BOUNDED, 2)
    above = f"coalesce({number(clean, OPEN_HIGH)}, {number(clean, AT_LEAST)})"
    below = number(clean, OPEN_LOW)
    two = "printf('%.2f', {})".format
    return {
        "low": f"CASE WHEN {lo} IS NOT NULL THEN {lo} ELSE {above} END",
        "high": f"CASE WHEN {lo} IS NOT NULL THEN {hi} WHEN {above} IS NULL THEN {below} END",
        "bracket_id": (
            f"CASE WHEN {lo} IS NOT NULL THEN {two(lo)} || '_' || {two(hi)} "
            f"WHEN {above} IS NOT NULL THEN {two(above)} || '_plus' "
            f"WHEN {below} IS NOT NULL THEN 'lt_' || {two(below)} "
            f"WHEN {clean} = '' THEN 'unknown_range' ELSE replace({clean}, ' ', '_') END"
        ),
        "parsed": f"coalesce({lo}, {above}, {below}) IS NOT NULL",
    }


def percent(text: str) -> str:
    clean = f"regexp_replace({text}, '[%,]|{WS}', '', 'g')"
    return f"TRY_CAST(nullif(regexp_extract({clean}, '{NUMBER_PREFIX}', 0), '') AS DOUBLE)"


_LONG = "|".join(FULL_MONTHS)
_SHORT = "|".join([*MONTHS, "sept"])
_NAMED = rf"(?i)({_LONG}|{_SHORT})\.?{WS}+(\d{{1,2}})(?:st|nd|rd|th)?,?{WS}+(\d{{4}})"
_NUMERIC = r"\b(\d{1,2})[/\-](\d{1,2})[/\-](\d{4})\b"


def date_text(text: str) -> str:
    def g(p: str, i: int) -> str:
        return f"regexp_extract({text}, '{p}', {i})"

    month = f"lpad(CAST(list_position({MONTHS}, left(lower({g(_NAMED, 1)}), 3)) AS VARCHAR), 2, '0')"
    return (
        f"CASE WHEN {g(_NAMED, 0)} <> '' THEN {g(_NAMED, 3)} || '-' || {month} || '-' || lpad({g(_NAMED, 2)}, 2, '0') "
        f"WHEN {g(_NUMERIC, 0)} <> '' THEN {g(_NUMERIC, 3)} || '-' || lpad({g(_NUMERIC, 1)}, 2, '0') || '-' || lpad({g(_NUMERIC, 2)}, 2, '0') END"
    )


_KIND = (
    "CASE json_type({j}) WHEN 'VARCHAR' THEN 'string' WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' "
    "WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' ELSE 'number' END"
)


# Rules of a candidate: a text of choices, least and greatest length of a text, a dict for an
# object, a list of one for rows; "?" after a name: null is allowed. Lists may be missing.
_NOTE = {"code": (1, None), "message": (1, None), "severity": "info warning error"}
_BRACKET = {"range_text": (1, None), "percent_text": (1, None), "row_evidence": (1, 300)}
_WEEK = {"week_of": (4, 32), "ground_percent_text?": (1, 32), "air_percent_text?": (1, 32), "row_evidence": (1, 300)}
CANDIDATE_SPEC = {
    "artifact_type": "html pdf", "carrier": "UPS FedEx", "source_id": (1, None), "effective_date?": (4, 32),
    "effective_date_evidence?": (1, 300),
    "programs": [{
        "program": "ground air international unknown", "table_title?": (1, 200), "table_title_evidence?": (1, 300),
        "basis_hint?": "diesel jet gasoline unknown", "brackets": [_BRACKET], "table_evidence?": (1, 300),
    }],
    "links": [{"href": "url", "link_text?": (1, 200), "effective_date?": (4, 32), "evidence_snippet": (1, 300)}],
    "history_90d?": {"rows": [_WEEK]},
    "parse_warnings": [_NOTE],
}


def issues(rule, j: str, path: str, depth: int = 0, nullable: bool = False) -> str:
    """SQL list of 'path message' texts for the JSON expression ``j``."""
    none = "CAST([] AS VARCHAR[])"
    kind = _KIND.format(j=j)
    text = f"json_extract_string({j}, '$')"

    def one(message: str) -> str:
        return f"[{path} || ' ' || {message}]"

    def expected(what: str) -> str:
        return one("'Expected " + what.replace("'", "''") + ", received ' || " + kind)

    no_text = f"WHEN {kind} <> 'string' THEN {expected('string')}"
    if rule == "url":
        wrong = f"WHEN NOT regexp_matches({text}, '^https?://[^/]') THEN " + one("'Invalid url'")
        body = f"CASE {no_text} {wrong} ELSE {none} END"
    elif isinstance(rule, str):
        names = " | ".join(f"'{v}'" for v in rule.split())
        accepted = ", ".join(f"'{v}'" for v in rule.split())
        wrong = "'Invalid enum value. Expected " + names.replace("'", "''") + ", received ''' || " + text + " || ''''"
        body = f"CASE WHEN {kind} <> 'string' THEN {expected(names)} WHEN {text} NOT IN ({accepted}) THEN {one(wrong)} ELSE {none} END"
    elif isinstance(rule, tuple):
        least, most = rule
        cases = [no_text, f"WHEN length({text}) < {least} THEN " + one(f"'String must contain at least {least} character(s)'")]
        if most is not None:
            cases.append(f"WHEN length({text}) > {most} THEN " + one(f"'String must contain at most {most} character(s)'"))
        body = f"CASE {' '.join(cases)} ELSE {none} END"
    elif isinstance(rule, list):
        x, i = f"x{depth}", f"i{depth}"
        inner = issues(rule[0], x, f"{path} || '.' || ({i} - 1)", depth + 1)
        nested = f"flatten(list_transform(json_extract({j}, '$[*]'), lambda {x}, {i}: {inner}))"
        body = f"CASE WHEN {kind} <> 'array' THEN {expected('array')} ELSE {nested} END"
    else:
        parts = []
        for field, r in rule.items():
            name = field.rstrip("?")
            below = f"'{name}'" if path == "''" else f"{path} || '.{name}'"
            parts.append(issues(r, f"json_extract({j}, '$.{name}')", below, depth, field.endswith("?")))
        body = f"CASE WHEN {kind} <> 'object' THEN {expected('object')} ELSE flatten([{', '.join(parts)}]) END"
    if nullable:
        body = f"CASE WHEN {kind} = 'null' THEN {none} ELSE {body} END"
    missing = none if isinstance(rule, list) else one("'Required'")
    return f"CASE WHEN {j} IS NULL THEN {missing} ELSE {body} END"


_CONTEXT = ", ".join(f"{sql} AS {name}" for name, sql in CONTEXT_SQL.items())

CANDIDATES_CTE = f"""raw_cand AS MATERIALIZED (
  SELECT o_orderkey, {_CONTEXT}, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS captured_at, {CANDIDATE_SQL} AS raw
  FROM orders),
docs AS MATERIALIZED (SELECT *, CASE WHEN json_valid(raw) THEN CAST(replace(raw, '{REPEATED}', '') AS JSON) END AS doc FROM raw_cand),
gated AS MATERIALIZED (
  SELECT *, CASE WHEN doc IS NULL THEN [' Invalid JSON'] ELSE {issues(CANDIDATE_SPEC, 'doc', "''")} END AS issues
  FROM docs)"""

# Valid candidates flattened, with parsed dates, ranges and percents.
_RANGE = range_parts("clean", "range_text")
NORMAL_CTE = f"""{CANDIDATES_CTE},
valid AS MATERIALIZED (
  SELECT *, json_extract_string(doc, '$.effective_date') AS date_text,
    CAST(coalesce(json_array_length(json_extract(doc, '$.programs')), 0) AS BIGINT) AS n_programs,
    coalesce(json_extract(doc, '$.parse_warnings[*]'), []) AS warns
  FROM gated WHERE len(issues) = 0),
dated AS MATERIALIZED (SELECT *, {date_text('date_text')} AS effective_date FROM valid),
cand_tables AS (
  SELECT d.* EXCLUDE (issues, raw), t.i AS table_index, json_extract(doc, '$.programs[' || t.i || ']') AS tab
  FROM dated d, LATERAL (SELECT unnest(range(d.n_programs)) AS i) t),
cand_brackets AS (
  SELECT o_orderkey, carrier, source_id, run_id, captured_at, effective_date, table_index, b.j AS bracket_index,
    json_extract_string(tab, '$.program') AS program,
    json_extract_string(tab, '$.brackets[' || b.j || '].range_text') AS range_text,
    json_extract_string(tab, '$.brackets[' || b.j || '].percent_text') AS percent_text
  FROM cand_tables c, LATERAL (SELECT unnest(range(CAST(coalesce(json_array_length(json_extract(c.tab, '$.brackets')), 0) AS BIGINT))) AS j) b),
cleaned AS (SELECT *, {clean_range('range_text')} AS clean FROM cand_brackets),
parsed AS MATERIALIZED (
  SELECT *, {_RANGE['low']} AS low, {_RANGE['high']} AS high, {_RANGE['bracket_id']} AS bracket_id,
    {_RANGE['parsed']} AS parsed, {percent('percent_text')} AS pct FROM cleaned)"""
