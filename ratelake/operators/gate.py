"""Schema gate over untrusted JSON held as VARIANT.

A rule set describes what a document may hold; :func:`issues` turns it into one
Column that lists every violation as (path, message). Missing and null are told
apart, nothing is coerced, unknown keys pass.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelake import fixed, schemas
from ratelake.functions.binding import let, with_once
from ratelake.functions.urls import is_valid_url, resolve_href

_ISSUES = f"array<{schemas.ISSUE}>"
_TYPE_NAMES = {"STRING": "string", "VOID": "null", "BOOLEAN": "boolean", "ARRAY": "array", "OBJECT": "object"}


@dataclass(frozen=True)
class Text:
    min: int = 0
    max: int | None = None
    nullable: bool = False
    url: bool = False
    optional: bool = False


@dataclass(frozen=True)
class Choice:
    values: tuple[str, ...]
    nullable: bool = False
    optional: bool = False


@dataclass(frozen=True)
class Flag:
    nullable: bool = False
    optional: bool = False


@dataclass(frozen=True)
class Number:
    nullable: bool = False
    optional: bool = False


@dataclass(frozen=True)
class Rows:
    item: object
    nullable: bool = False
    optional: bool = True  # a missing list reads as an empty one


@dataclass(frozen=True)
class Record:
    fields: dict = field(default_factory=dict)
    nullable: bool = False
    optional: bool = False


CANDIDATE_RULES = Record({
    "artifact_type": Choice(tuple(fixed.ARTIFACT_TYPES)),
    "carrier": Choice(tuple(fixed.CARRIERS)),
    "source_id": Text(1),
    "effective_date": Text(4, 32, nullable=True),
    "effective_date_evidence": Text(1, 300, nullable=True),
    "programs": Rows(Record({
        "program": Choice(tuple(fixed.PROGRAMS)),
        "table_title": Text(1, 200, nullable=True),
        "table_title_evidence": Text(1, 300, nullable=True),
        "basis_hint": Choice(tuple(fixed.BASIS_HINTS), nullable=True),
        "brackets": Rows(Record({
            "range_text": Text(1),
            "percent_text": Text(1),
            "row_evidence": Text(1, 300),
        })),
        "table_evidence": Text(1, 300, nullable=True),
    })),
    "links": Rows(Record({
        "href": Text(url=True),
        "link_text": Text(1, 200, nullable=True),
        "effective_date": Text(4, 32, nullable=True),
        "evidence_snippet": Text(1, 300),
    })),
    "history_90d": Record({
        "rows": Rows(Record({
            "week_of": Text(4, 32),
            "ground_percent_text": Text(1, 32, nullable=True),
            "air_percent_text": Text(1, 32, nullable=True),
            "row_evidence": Text(1, 300),
        })),
    }, nullable=True),
    "parse_warnings": Rows(Record({
        "code": Text(1),
        "message": Text(1),
        "severity": Choice(tuple(fixed.SEVERITIES)),
    })),
})

REGISTRY_RULES = Record({
    "version": Text(),
    "sources": Rows(Record({
        "id": Text(),
        "carrier": Text(),
        "mode": Choice(tuple(fixed.SOURCE_MODES)),
        "url": Text(url=True, nullable=True),
        "parser_id": Text(),
        "artifact_type": Choice(tuple(fixed.ARTIFACT_TYPES)),
        "diff_enabled": Flag(),
        "child_source_id": Text(optional=True),
        "discovered_only": Flag(optional=True),
    }), optional=False),
})

SNAPSHOT_RULES = Record({
    "schema_version": Choice((fixed.SCHEMA_VERSION,)),
    "carrier": Text(),
    "source_id": Text(),
    "captured_at": Text(),
    "source_url": Text(),
    "content_type": Text(),
    "effective_date": Text(nullable=True),
    "tables": Rows(Record({
        "program": Text(nullable=True),
        "effective_date": Text(nullable=True),
        "brackets": Rows(Record({
            "bracket_id": Text(), "index_range": Text(), "min_index": Number(nullable=True), "max_index": Number(nullable=True),
            "surcharge_percent": Number(nullable=True), "surcharge_text": Text(),
        }), optional=False),
    }), optional=False),
    "parser_diagnostics": Record({
        "structural_error": Flag(),
        "messages": Rows(Text(), optional=False),
    }),
})


DELTA_RULES = Record({
    "schema_version": Choice((fixed.SCHEMA_VERSION,)),
    "carrier": Text(),
    "source_id": Text(),
    "captured_at": Text(),
    "prior_captured_at": Text(nullable=True),
    "program": Text(nullable=True),
    "effective_date": Text(nullable=True),
    "bracket_id": Text(),
    "index_range": Text(),
    "old_value": Number(nullable=True),
    "new_value": Number(nullable=True),
    "group_key": Text(),
    "publishability": Record({"is_publishable": Flag(), "reasons": Rows(Text(), optional=False)}),
    "parser_structural_error": Flag(),
})


def _kind(rule) -> str:
    return "boolean" if isinstance(rule, Flag) else "number" if isinstance(rule, Number) else "string"


def json_type(v: Column) -> Column:
    """Type name of a VARIANT: string, number, boolean, null, array or object."""
    names = F.create_map(
        *[F.lit(x) for kv in _TYPE_NAMES.items() for x in kv]
    )
    return F.coalesce(
        F.try_element_at(names, F.substring_index(F.schema_of_variant(v), "<", 1)), F.lit("number")
    )


def _has_kind(v: Column, kind: str) -> Column:
    """Whether the type name of a VARIANT that is there is ``kind``, a leaf's, without a look-up."""
    spelled = F.schema_of_variant(v)
    if kind == "number":
        return spelled.rlike("^(?!(STRING|VOID|BOOLEAN)$|(ARRAY|OBJECT)(<|$))")
    return spelled == kind.upper()


def _none() -> Column:
    return F.array().cast(_ISSUES)


def _one(path: Column, message: Column) -> Column:
    return F.array(F.struct(path.alias("path"), message.alias("message"))).cast(_ISSUES)


def _expectation(rule) -> str:
    if isinstance(rule, Choice):
        return " | ".join(f"'{v}'" for v in rule.values)
    return _kind(rule)


def _leaf_row(name: Column, v: Column, rule) -> Column:
    """A leaf value next to what its rule allows."""
    choices = rule.values if isinstance(rule, Choice) else None
    return F.struct(
        name.alias("name"),
        v.alias("v"),
        F.lit(_kind(rule)).alias("kind"),
        F.lit(_expectation(rule)).alias("expected"),
        (F.lit(None).cast("array<string>") if choices is None else F.array(*[F.lit(c) for c in choices])).alias("choices"),
        F.lit(getattr(rule, "min", 0)).alias("min"),
        F.lit(getattr(rule, "max", None)).cast("int").alias("max"),
        F.lit(rule.nullable).alias("nullable"),
        F.lit(rule.optional).alias("optional"),
    )


def _leaf_message(f: Column, kind: Column, s: Column) -> Column:
    """What is wrong with one leaf, or NULL."""
    return (
        F.when(f["v"].isNull(), F.when(~f["optional"], "Required"))
        .when(f["nullable"] & (kind == "null"), F.lit(None))
        .when(kind != f["kind"], F.concat(F.lit("Expected "), f["expected"], F.lit(", received "), kind))
        .when(
            f["choices"].isNotNull() & ~F.array_contains(f["choices"], s),
            F.concat(F.lit("Invalid enum value. Expected "), f["expected"], F.lit(", received '"), s, F.lit("'")),
        )
        .when(
            F.length(s) < f["min"],
            F.concat(F.lit("String must contain at least "), f["min"].cast("string"), F.lit(" character(s)")),
        )
        .when(
            F.length(s) > f["max"],
            F.concat(F.lit("String must contain at most "), f["max"].cast("string"), F.lit(" character(s)")),
        )
    )


def _leaf_issues(rows: list[Column], path: Column) -> Column:
    """Issues of a run of leaves; one lambda body serves all of them."""
    typed = F.transform(
        F.array(*rows),
        lambda f: F.struct(
            f.alias("f"),
            json_type(f["v"]).alias("kind"),
            F.try_variant_get(f["v"], "$", "string").alias("s"),
        ),
    )
    # Paths are spelled out for what is wrong only.
    wrong = F.filter(typed, lambda t: _leaf_message(t["f"], t["kind"], t["s"]).isNotNull())
    return F.transform(
        wrong,
        lambda t: F.struct(
            _join(path, t["f"]["name"]).alias("path"),
            _leaf_message(t["f"], t["kind"], t["s"]).alias("message"),
        ),
    )


def _link_issues(v: Column, path: Column, rule: Text, base: Column | None) -> Column:
    s = F.try_variant_get(v, "$", "string")
    wrong_type = F.concat(F.lit("Expected string, received "), json_type(v))
    found = F.when(json_type(v) != "string", _one(path, wrong_type)).otherwise(
        F.when(is_valid_url(s), _none()).otherwise(_one(path, F.lit("Invalid url")))
    )
    if rule.nullable:
        found = F.when(json_type(v) == "null", _none()).otherwise(found)
    if base is not None:
        resolved = resolve_href(F.coalesce(s, F.lit("null")), base)
        found = F.when(resolved.isNotNull(), _none()).otherwise(found)
    missing = _none() if rule.optional else _one(path, F.lit("Required"))
    return F.when(v.isNull(), missing).otherwise(found)


def _wrong_kind(v: Column, rule, path: Column, kind: str, nested: Column) -> Column:
    """``nested`` for a value of ``kind``, else what is wrong with it."""
    missing = _none() if rule.optional else _one(path, F.lit("Required"))
    refused = _one(path, F.concat(F.lit(f"Expected {kind}, received "), json_type(v)))
    if rule.nullable:
        refused = F.when(F.is_variant_null(v), _none()).otherwise(refused)
    return F.when(v.isNull(), missing).otherwise(F.coalesce(nested, refused))


def issues(v: Column, rule, path: Column, base: Column | None = None) -> Column:
    """All violations of ``rule`` by the VARIANT ``v`` (SQL NULL: missing), in
    document order. With ``base``, a link counts as valid when it resolves
    against that URL.
    """
    if isinstance(rule, Text) and rule.url:
        return _link_issues(v, path, rule, base)
    if isinstance(rule, Rows):
        items = F.try_variant_get(v, "$", "array<variant>")
        nested = F.flatten(
            F.transform(items, lambda x, i: issues(x, rule.item, _join(path, i.cast("string")), base))
        )
        return _wrong_kind(v, rule, path, "array", nested)
    if not isinstance(rule, Record):
        return _leaf_issues([_leaf_row(F.lit(""), v, rule)], path)

    parts = _parts(v, rule, path, base)
    is_object = json_type(v) == "object"
    return _wrong_kind(v, rule, path, "object", F.when(is_object, F.concat(*parts)))


def _parts(v: Column, rule: Record, path: Column, base: Column | None, typed: Column | None = None) -> list[Column]:
    """Issues of the fields of an object, runs of leaves taken together. Fields that
    ``typed`` shows to be clean are passed over."""
    parts: list[Column] = []
    leaves: dict = {}

    def add(found: Column, fields: dict) -> None:
        if typed is not None:
            clean = _clean(typed, Record(fields), base)
            found = F.when(clean, _none()).otherwise(found)
        parts.append(found)

    def value(name: str) -> Column:
        return F.try_variant_get(v, f"$.{name}", "variant")

    def close_run() -> None:
        if leaves:
            add(_leaf_issues([_leaf_row(F.lit(n), value(n), r) for n, r in leaves.items()], path), dict(leaves))
            leaves.clear()

    for name, r in rule.fields.items():
        if isinstance(r, (Rows, Record)) or getattr(r, "url", False):
            close_run()
            add(issues(value(name), r, _join(path, F.lit(name)), base), {name: r})
        else:
            leaves[name] = r
    close_run()
    return parts


def _is_plain(rule) -> bool:
    """Leaves that a typed read as text can clear: a text is required, and one of the
    choices is never how a number or a boolean is spelled."""
    if rule.nullable or not isinstance(rule, (Text, Choice)):
        return False
    return isinstance(rule, Text) or not any(re.fullmatch("[-+.0-9EInfityNaruesl]*", v) for v in rule.values)


def _shape(rule) -> str:
    """Type to read a value as for :func:`_clean`."""
    if isinstance(rule, Record):
        return f"struct<{','.join(f'{n}:{_shape(r)}' for n, r in rule.fields.items())}>"
    if isinstance(rule, Rows):
        return f"array<{_shape(rule.item)}>"
    return "string" if _is_plain(rule) else "variant"


def _is_text(s: Column) -> Column:
    """Whether a value read as text was one: no spelling of a number, boolean, list or object."""
    # All that a cast to a number takes, and some more; the cast itself fails by an exception.
    spelled = s.isin("true", "false") | s.rlike("(?i)^[-+]?([.0-9]+(e[-+]?[0-9]+)?f?|inf(inity)?|nan)$")
    return ~s.rlike("^[{\\[]") & (s.rlike("[^-+.0-9EInfityNaruesl]") | ~spelled)


def _clean(t: Column, rule, base: Column | None) -> Column:
    """True only if ``t``, read as :func:`_shape` of ``rule``, has no issue; false or NULL
    tells nothing."""
    if isinstance(rule, Record):
        found = t.isNotNull()
        for name, r in rule.fields.items():
            found &= _clean(t[name], r, base)
        return found
    if isinstance(rule, Rows):
        return t.isNotNull() & F.forall(t, lambda x: _clean(x, rule.item, base))
    if isinstance(rule, Text) and rule.url and _is_plain(rule):
        return _is_text(t) & is_valid_url(t) if base is None else resolve_href(t, base).isNotNull()
    if isinstance(rule, Text) and rule.url:
        return F.lit(False)
    s = t if _is_plain(rule) else F.try_variant_get(t, "$", "string")
    fits = F.lit(True)
    if isinstance(rule, Choice):
        fits &= s.isin(*rule.values)
    if isinstance(rule, Text) and rule.min:
        fits &= F.length(s) >= rule.min
    if isinstance(rule, Text) and rule.max is not None:
        fits &= F.length(s) <= rule.max
    if _is_plain(rule):
        return (t.isNotNull() & fits) if isinstance(rule, Choice) else (_is_text(t) & fits)
    fits &= t.isNotNull() & _has_kind(t, _kind(rule))  # a missing value has a type name, too
    return F.is_variant_null(t) | fits if rule.nullable else fits


def quick_issues(v: Column, rule: Record, base: Column | None = None) -> Column:
    """:func:`issues` of whole documents. Each part of the document is read once by its
    types; only a part that this does not clear is looked through value by value."""
    def checked(t: Column) -> Column:
        return F.when(t.isNotNull(), F.concat(*_parts(v, rule, F.lit(""), base, t))).otherwise(issues(v, rule, F.lit(""), base))

    return let(F.try_variant_get(v, "$", _shape(rule)), checked)


def _join(path: Column, name: Column) -> Column:
    return F.concat_ws(".", F.nullif(path, F.lit("")), F.nullif(name, F.lit("")))


@lru_cache(maxsize=4)
def _candidate_issues(application_id: str) -> Column:
    """The candidate rules as one Column; building it costs thousands of gateway calls."""
    return quick_issues(F.col("doc"), CANDIDATE_RULES)


_REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def with_json(df: DataFrame, raw: str, name: str) -> DataFrame:
    """Add the JSON text in ``raw`` as a VARIANT, NULL where it is none.

    Of a key that an object repeats the last value counts. Spark refuses such objects unless
    the session allows them, and reads that setting again whenever it plans, so it is set
    for the session here and stays set.
    """
    if df.sparkSession.conf.get(_REPEATED_KEYS) != "true":
        df.sparkSession.conf.set(_REPEATED_KEYS, "true")
    return df.withColumn(name, F.try_parse_json(raw))


def _unread(raw: Column) -> Column:
    """The one issue of a text that gave no VARIANT."""
    size = F.octet_length(raw)
    large = F.concat(F.lit("Document of "), size.cast("string"), F.lit(" bytes is not JSON or too large to check"))
    return _one(F.lit(""), F.when(size > fixed.PARSED_BYTES, large).otherwise("Invalid JSON"))


def gate(df: DataFrame, raw: str, rules=CANDIDATE_RULES, base: Column | None = None) -> DataFrame:
    """Add ``doc`` (VARIANT) and ``issues`` for the JSON text in ``raw``.

    Text that is not JSON gets the single issue "Invalid JSON". Of a text so large that the
    parser may have given up on its size, the issue says that it is one or the other.
    """
    parsed = with_json(df, raw, "doc")
    if rules is CANDIDATE_RULES and base is None:
        checked = _candidate_issues(df.sparkSession.sparkContext.applicationId)
    else:
        checked = quick_issues(F.col("doc"), rules, base)
    found = F.when(F.col("doc").isNull(), _unread(F.col(raw))).otherwise(checked)
    return with_once(parsed, "issues", found)


def assertion_message(issue_list: Column, label: Column) -> Column:
    """All errors of a document in one line, or NULL when it is valid."""
    parts = F.transform(
        issue_list,
        lambda e: F.concat(
            F.when(e["path"] == "", "<root>").otherwise(
                F.concat(F.lit("/"), F.replace(e["path"], F.lit("."), F.lit("/")))
            ),
            F.lit(" "),
            e["message"],
        ),
    )
    text = F.concat(label, F.lit(" failed schema validation: "), F.array_join(parts, "; "))
    return F.when(F.size(issue_list) > 0, text)


def assert_valid(df: DataFrame, raw: str, label: Column, rules) -> DataFrame:
    """Strict form: the job fails with the whole error list on the first bad document."""
    checked = gate(df, raw, rules)
    message = assertion_message(F.col("issues"), label)
    ok = F.when(message.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return checked.filter(ok).drop("issues")
