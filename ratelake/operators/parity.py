"""Parity of two runs: what is missing, extra or different.

Every comparison tags the rows of both runs, unions them and groups once by the
compared key, pre-aggregated before the shuffle, instead of a full outer join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from ratelake import fixed
from ratelake.functions.keys import snapshot_key
from ratelake.functions.numbers import within_tolerance
from ratelake.session import stored_once

KEY = ["carrier", "source_id", "captured_at"]


def _tagged(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    return baseline.withColumn("_base", F.lit(True)).unionByName(
        candidate.withColumn("_base", F.lit(False))
    )


def _presence() -> list[Column]:
    return [
        F.max("_base").alias("_in_base"),
        F.max(~F.col("_base")).alias("_in_cand"),
    ]


def _last(value: str | Column, order: Column, side: Column) -> Column:
    return F.max_by(value, F.when(side, order))


def _details(a: Column, b: Column) -> Column:
    return F.create_map(
        F.lit("baseline"), a.cast("string"), F.lit("llm"), b.cast("string")
    )


_ITEM = (
    "struct<category:string,scope:string,key:string,message:string,baseline_path:string,llm_path:string,"
    "details:map<string,string>>"
)


def _item(category: str | Column, scope: str, key: Column, message: Column, details: Column | None = None, paths: bool = True) -> Column:
    """One mismatch as a struct of ITEM."""
    none = F.lit(None).cast("string")
    return F.struct(
        (F.lit(category) if isinstance(category, str) else category).alias("category"),
        F.lit(scope).alias("scope"), key.alias("key"), message.alias("message"),
        (F.col("baseline_path") if paths else none).alias("baseline_path"),
        (F.col("llm_path") if paths else none).alias("llm_path"),
        (F.lit(None).cast("map<string,string>") if details is None else details).alias("details"),
    ).cast(_ITEM)


def _rows(df: DataFrame, checks: list[Column]) -> DataFrame:
    """The checks of each row that found something, one row per mismatch."""
    found = F.array_compact(F.array(*checks))
    return df.select(F.explode(found).alias("_i")).select("_i.*")


def _one_sided() -> Column:
    return F.col("_in_base") != F.col("_in_cand")


def _in_both() -> Column:
    return F.col("_in_base") & F.col("_in_cand")


def _key() -> Column:
    return snapshot_key(*[F.col(c) for c in KEY])


def compare_snapshots(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """One row per snapshot key with its presence, dates and paths on both sides.

    Inputs: KEY, effective_date, path; one row per key.
    """
    base, cand = F.col("_base"), ~F.col("_base")
    order = F.col("path")
    return (
        _tagged(baseline.select(*KEY, "effective_date", "path"), candidate.select(*KEY, "effective_date", "path"))
        .groupBy(*KEY)
        .agg(
            *_presence(),
            _last("effective_date", order, base).alias("_date_base"),
            _last("effective_date", order, cand).alias("_date_cand"),
            F.max(F.when(base, order)).alias("baseline_path"),
            F.max(F.when(cand, order)).alias("llm_path"),
        )
    )


def _snapshot_check() -> Column:
    missing = F.col("_in_base")
    return F.when(_one_sided(), _item(
        F.when(missing, fixed.MISSING).otherwise(fixed.EXTRA), "snapshot", _key(),
        F.when(missing, "snapshot missing in llm").otherwise("extra snapshot in llm"),
    ))


def _date_check() -> Column:
    a, b = F.col("_date_base"), F.col("_date_cand")
    return F.when(
        _in_both() & ~a.eqNullSafe(b),
        _item(fixed.SCOPE_MISMATCH, "snapshot", _key(), F.lit("effective_date mismatch"), _details(a, b)),
    )


def snapshot_items(compared: DataFrame) -> DataFrame:
    """Snapshots one run lacks."""
    return _rows(compared, [_snapshot_check()])


def _matched(compared: DataFrame) -> DataFrame:
    return compared.filter(F.col("_in_base") & F.col("_in_cand"))


def date_items(compared: DataFrame) -> DataFrame:
    """Matched snapshots with different effective dates."""
    return _rows(compared, [_date_check()])


def _program() -> Column:
    return F.coalesce("program", F.lit("null")).alias("program")


def compare_programs(compared: DataFrame, baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """Programs of matched snapshots with their presence. Inputs: KEY, program."""
    flags = (
        _tagged(baseline.select(*KEY, _program()), candidate.select(*KEY, _program()))
        .groupBy(*KEY, "program")
        .agg(*_presence())
    )
    return flags.join(_matched(compared).select(*KEY, "baseline_path", "llm_path"), KEY)


def _program_check() -> Column:
    what = F.when(F.col("_in_base"), "program missing in llm: ").otherwise("extra program in llm: ")
    return F.when(_one_sided(), _item(fixed.SCOPE_MISMATCH, "snapshot", _key(), F.concat(what, "program")))


def program_items(programs: DataFrame) -> DataFrame:
    return _rows(programs, [_program_check()])


def _same_value() -> Column:
    return within_tolerance(F.col("_a"), F.col("_b"))


def _bracket_check() -> Column:
    what = (
        F.when(_in_both(), "surcharge_percent mismatch for ")
        .when(F.col("_in_base"), "bracket missing in llm: ")
        .otherwise("extra bracket in llm: ")
    )
    return F.when(~_in_both() | ~_same_value(), _item(
        F.when(_in_both(), fixed.VALUE_MISMATCH).otherwise(fixed.SCOPE_MISMATCH), "snapshot", _key(),
        F.concat(what, F.concat_ws(" ", "program", "bracket_id")),
        F.when(_in_both(), _details(F.col("_a"), F.col("_b"))),
    ))


def _place(rows: DataFrame) -> Column:
    """Order of brackets in a snapshot: one number where both indexes are 32-bit ones, since
    values are then merged by hash. Missing ones come first, as in the struct."""
    indexes = ["table_index", "bracket_index"]
    if not all(isinstance(rows.schema[c].dataType, IntegerType) for c in indexes):
        return F.struct(*indexes)
    table, bracket = (F.coalesce(F.col(c).cast("bigint"), F.lit(-(1 << 31))) for c in indexes)
    return table * F.lit(1 << 32) + bracket


def bracket_items(programs: DataFrame, baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """Missing, extra and different brackets of matched programs.

    Inputs: KEY, program, table_index, bracket_index, bracket_id, surcharge_percent.
    """
    columns = [*KEY, _program(), "table_index", "bracket_index", "bracket_id", "surcharge_percent"]
    base, cand = F.col("_base"), ~F.col("_base")
    rows = _tagged(baseline.select(*columns), candidate.select(*columns))
    order = _place(rows)
    values = (
        rows.groupBy(*KEY, "program", "bracket_id")
        .agg(
            *_presence(),
            _last("surcharge_percent", order, base).alias("_a"),
            _last("surcharge_percent", order, cand).alias("_b"),
        )
        .filter(~_in_both() | ~_same_value())
    )
    both = programs.filter(_in_both()).drop("_in_base", "_in_cand")
    return _rows(values.join(both, [*KEY, "program"]), [_bracket_check()])


VALUES = ["old_value", "new_value"]
FEED = ["group_key", "bracket_id", *VALUES]


def _feed_groups(rows: DataFrame) -> DataFrame:
    """Groups with the row counts of both sides."""
    n_base, n_cand = F.count_if(F.col("_base")), F.count_if(~F.col("_base"))
    return rows.groupBy("group_key").agg(n_base.alias("_n_base"), n_cand.alias("_n_cand"))


def _feed_brackets(rows: DataFrame, order: str) -> DataFrame:
    """The brackets that differ, each with the last values of both sides."""
    base, cand = F.col("_base"), ~F.col("_base")
    values = rows.groupBy("group_key", "bracket_id")
    if isinstance(rows.schema[order].dataType, LongType):
        # Plain values by a plain order are merged by hash; structs are sorted for it.
        kept = [_last(v, F.col(order), side).alias(f"{to}{v}") for to, side in (("_a", base), ("_b", cand)) for v in VALUES]
        values = values.agg(*_presence(), *kept).withColumns(
            {to: F.struct(*[F.col(f"{to}{v}").alias(v) for v in VALUES]) for to in ("_a", "_b")}
        )
    else:
        pair = F.struct(*VALUES)
        values = values.agg(
            *_presence(), _last(pair, F.col(order), base).alias("_a"), _last(pair, F.col(order), cand).alias("_b")
        )
    same = F.lit(True)
    for field in VALUES:
        same &= within_tolerance(F.col("_a")[field], F.col("_b")[field])
    return values.filter(~_in_both() | ~same)


def _feed_item(category: str | Column, message: Column, details: Column | None = None) -> Column:
    return _item(category, "delta", F.col("group_key"), message, details, paths=False)


def _group_checks() -> list[Column]:
    n_a, n_b = F.col("_n_base"), F.col("_n_cand")
    one_sided = (n_a == 0) != (n_b == 0)
    return [
        F.when(one_sided, _feed_item(
            F.when(n_b == 0, fixed.MISSING).otherwise(fixed.EXTRA),
            F.when(n_b == 0, "delta group missing in llm").otherwise("extra delta group in llm"),
        )),
        F.when(~one_sided & (n_a != n_b), _feed_item(
            fixed.SCOPE_MISMATCH, F.lit("delta record count mismatch"), _details(n_a, n_b)
        )),
    ]


def _feed_bracket_checks() -> list[Column]:
    def value(field: str) -> Column:
        a, b = F.col("_a")[field], F.col("_b")[field]
        message = F.concat(F.lit(f"{field} mismatch for "), "bracket_id")
        return F.when(_in_both() & ~within_tolerance(a, b), _feed_item(fixed.VALUE_MISMATCH, message, _details(a, b)))

    side = F.when(F.col("_in_base"), "delta bracket missing in llm: ").otherwise("extra delta bracket in llm: ")
    one_sided = F.when(_one_sided(), _feed_item(fixed.SCOPE_MISMATCH, F.concat(side, "bracket_id")))
    return [one_sided, value("old_value"), value("new_value")]


def delta_items(baseline: DataFrame, candidate: DataFrame, order: str = "position") -> DataFrame:
    """Parity of two delta feeds, by group and by bracket inside matched groups.

    Inputs: group_key, bracket_id, old_value, new_value and an ordering column;
    counts use every row, values the last row of a bracket.
    """
    rows = _tagged(baseline.select(*FEED, order), candidate.select(*FEED, order))
    groups = stored_once(_feed_groups(rows), "parity-groups")
    matched = groups.filter((F.col("_n_base") > 0) & (F.col("_n_cand") > 0)).select("group_key")
    brackets = _feed_brackets(rows, order).join(matched, "group_key", "left_semi")
    return _rows(groups, _group_checks()).unionByName(_rows(brackets, _feed_bracket_checks()))


def compare_runs(
    snapshots: tuple[DataFrame, DataFrame],
    tables: tuple[DataFrame, DataFrame],
    brackets: tuple[DataFrame, DataFrame],
    deltas: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """All mismatches of (baseline, candidate), one row each.

    One tagged grouping per level, and each input is read once: the small frames that the
    level below asks what both runs have (snapshots, programs, groups of deltas) are stored.
    """
    compared = stored_once(compare_snapshots(*snapshots), "parity-snapshots")
    programs = stored_once(compare_programs(compared, *tables), "parity-programs")
    out = (
        _rows(compared, [_snapshot_check(), _date_check()])
        .unionByName(program_items(programs))
        .unionByName(bracket_items(programs, *brackets))
    )
    return out if deltas is None else out.unionByName(delta_items(*deltas))


def category_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("category", "scope").agg(F.count(F.lit(1)).alias("n_items"))
