"""The selection rule table, compiled into Column folds.

A rule is a mapping with ``rule_id, stage, priority, columns, pattern, action, target_column, outcome, scope_column,
stop_on_match, parameter_name, parameter_value``. Rules of a stage are folded in order of priority, then id.
Patterns match without regard to case.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curatrix.functions import text as T

# Stage order, required fields, ignored words, separators.
STAGES = ("aggregate", "validate", "normalize", "exclude", "control", "filter", "dedup")
FIELDS = ("rule_id", "enabled", "stage", "priority", "columns", "pattern", "action", "target_column", "outcome", "scope_column", "scope_mode", "stop_on_match", "parameter_name", "parameter_value", "note")
IGNORED = ("", "na", "n/a", "none", "null", "unknown", "missing", "not applicable", "not collected", "not provided")
STRONG = r"/|&|\band\b|\bor\b|\bplus\b"
LISTED = r"[;,]"


def load_rules(rows: Iterable[dict]) -> list[dict]:
    """Enabled rules in the order in which they apply; a missing field, an unknown stage or a repeated id raises."""
    out, seen = [], set()
    for r in rows:
        if missing := [f for f in FIELDS if f not in r]:
            raise ValueError(f"rule without {', '.join(missing)}")
        if str(r["enabled"]).strip().lower() not in T.TRUE_WORDS:
            continue
        if r["stage"] not in STAGES:
            raise ValueError(f"unknown stage {r['stage']!r}")
        if r["rule_id"] in seen:
            raise ValueError(f"rule {r['rule_id']!r} given twice")
        seen.add(r["rule_id"])
        out.append(r | {"priority": int(r["priority"]), "columns": [c.strip() for c in str(r["columns"]).split(",") if c.strip()], "stop_on_match": str(r["stop_on_match"]).strip().lower() in T.TRUE_WORDS})
    return sorted(out, key=lambda r: (STAGES.index(r["stage"]), r["priority"], r["rule_id"]))


def of_stage(rules: list[dict], stage: str) -> list[dict]:
    return [r for r in rules if r["stage"] == stage]


def matches(c: Column, pattern: str) -> Column:
    return T.text(c).rlike(f"(?i){pattern}")


def any_match(rule: dict) -> Column:
    hit = F.lit(False)
    for c in rule["columns"]:
        hit = hit | matches(F.col(c), rule["pattern"])
    return hit


def is_protected(c: Column) -> Column:
    """A value that says neither blank nor ``no`` stays."""
    return ~F.lower(T.trimmed(c)).isin("", "no")


def normalize_group(meta: DataFrame, rules: list[dict], columns: list[str]) -> DataFrame:
    """``sample_group``, ``group_status``, ``group_source``, ``group_text``, ``group_rule`` from free text.

    Rules are tried in order, each on its columns in order; the first match wins. Ignored words are skipped; text that
    no rule knows is ``unknown``, with its first column that says something.
    """
    found = []
    for r in rules:
        for c in r["columns"]:
            value = T.normalize_text(F.col(c))
            hit = ~F.lower(value).isin(*IGNORED) & value.rlike(f"(?i){r['pattern']}")
            found.append(F.when(hit, F.struct(F.lit(r["outcome"]).alias("g"), F.lit("assigned").alias("s"), F.lit(c).alias("c"), value.alias("t"), F.lit(r["rule_id"]).alias("r"))))
    for c in columns:
        value = T.normalize_text(F.col(c))
        found.append(F.when(~F.lower(value).isin(*IGNORED), F.struct(F.lit("unknown").alias("g"), F.lit("unknown").alias("s"), F.lit(c).alias("c"), value.alias("t"), F.lit("").alias("r"))))
    none = F.struct(F.lit("").alias("g"), F.lit("empty").alias("s"), F.lit("").alias("c"), F.lit("").alias("t"), F.lit("").alias("r"))
    best = F.coalesce(*found, none)
    names = {"sample_group": "g", "group_status": "s", "group_source": "c", "group_text": "t", "group_rule": "r"}
    return meta.withColumn("_best", best).withColumns({n: F.col(f"_best.{k}") for n, k in names.items()}).drop("_best")


def classify_segments(value: Column, group: Column, classes: dict[str, str], ignore: str) -> Column:
    """``assigned``, ``mixed`` or ``review`` for a matched text of several parts.

    The text is cut at strong separators, then at list separators. A part that names another group makes it mixed; a
    part of a strong cut that names none is for review, as soon as it comes.
    """
    def named(x: Column) -> Column:
        return F.coalesce(*[F.when(x.rlike(f"(?i){p}"), g) for g, p in classes.items()], F.when(x.rlike(f"(?i){ignore}"), "ignore"), F.lit("none"))

    def parts(x: Column, cut: str) -> Column:
        return F.filter(F.transform(F.split(x, f"(?i){cut}"), lambda y: F.trim(y)), lambda y: y != "")

    strong = parts(value, STRONG)
    all_parts = F.flatten(F.transform(strong, lambda x: parts(x, LISTED)))
    unknown = F.exists(strong, lambda x: named(x) == "none") & (F.size(strong) > 1)
    other = F.exists(all_parts, lambda x: ~named(x).isin("none", "ignore") & (named(x) != group))
    return F.when(unknown, "review").when(other, "mixed").otherwise("assigned")


def cross_field_conflict(meta: DataFrame, columns: list[str], classes: dict[str, str]) -> DataFrame:
    """A group word of another group in a tissue column sends an assigned row to review, with what was found."""
    found = []
    for c in columns:
        for g, p in classes.items():
            hit = (F.col("group_status") == "assigned") & (F.col("sample_group") != g) & (F.col("group_source") != c) & matches(T.normalize_text(F.col(c)), p)
            found.append(F.when(hit, F.concat(F.lit("assigned="), "sample_group", F.lit(f"; conflict={c}={g}; previous_rule_id="), "group_rule")))
    clash = F.coalesce(*found, F.lit(""))
    out = meta.withColumn("_clash", clash)
    return out.withColumns({
        "group_status": F.when(F.col("_clash") != "", "review").otherwise(F.col("group_status")),
        "group_text": F.when(F.col("_clash") != "", F.col("_clash")).otherwise(F.col("group_text")),
    }).drop("_clash")


def _fold(meta: DataFrame, steps: list[tuple[dict, Column]]) -> DataFrame:
    """Write outcomes of matching steps; protected rows stay, and a stopping write protects."""
    out = meta
    targets = list(dict.fromkeys(r["target_column"] for r, _ in steps))
    out = out.withColumns({f"_m{i}": F.coalesce(hit, F.lit(False)) for i, (_, hit) in enumerate(steps)})
    for t in targets:
        value, stopped = F.col(t), is_protected(F.col(t))
        # the last write wins among those before (and including) the first stopping one
        writes, barrier = [], F.lit(False)
        for i, (r, _) in enumerate(steps):
            if r["target_column"] == t:
                writes.append((F.col(f"_m{i}") & ~barrier, r["outcome"]))
                if r["stop_on_match"]:
                    barrier = barrier | F.col(f"_m{i}")
        last = F.coalesce(*[F.when(hit, outcome) for hit, outcome in reversed(writes)])
        out = out.withColumn(t, F.when(stopped, value).otherwise(F.coalesce(last, value)))
    return out.drop(*[f"_m{i}" for i in range(len(steps))])


def exclude_rules(meta: DataFrame, rules: list[dict]) -> DataFrame:
    return _fold(meta, [(r, any_match(r)) for r in rules])


def filter_rules(meta: DataFrame, rules: list[dict], parameters: dict[str, float]) -> DataFrame:
    """Actions ``below`` (under a parameter, no number, or not positive), ``missing`` and ``all_empty``."""
    steps = []
    for r in rules:
        if r["action"] == "below":
            v = T.to_number(F.col(r["columns"][0]))
            steps.append((r, v.isNull() | (v <= 0) | (v < parameters[r["parameter_name"]])))
        elif r["action"] == "missing":
            steps.append((r, T.is_blank(F.col(r["columns"][0]))))
        else:
            hit = F.lit(True)
            for c in r["columns"]:
                hit = hit & T.is_blank(F.col(c))
            steps.append((r, hit))
    return _fold(meta, steps)


def control_rules(meta: DataFrame, rules: list[dict]) -> DataFrame:
    """Rows of a scope that holds control rows, but match no control pattern themselves, are no controls.

    Rules with the same scope, target and outcome count together. A blank scope key is no scope.
    """
    groups: dict[tuple, list[dict]] = {}
    for r in rules:
        groups.setdefault((r["scope_column"] or "bioproject", r["target_column"], r["outcome"], r["stop_on_match"]), []).append(r)
    out = meta
    for (scope, target, outcome, _), members in groups.items():
        keys = [k.strip() for k in scope.split(",")]
        hit = F.lit(False)
        for r in members:
            hit = hit | any_match(r)
        blank = F.lit(False)
        for k in keys:
            blank = blank | T.is_blank(F.col(k))
        out = out.withColumn("_hit", hit).withColumn("_any", F.max(F.col("_hit") & ~is_protected(F.col(target))).over(Window.partitionBy(*keys)))
        out = out.withColumn(target, F.when(F.col("_any") & ~F.col("_hit") & ~blank & ~is_protected(F.col(target)), outcome).otherwise(F.col(target))).drop("_hit", "_any")
    return out


def dedup_best(meta: DataFrame, keys: list[str], value: str, outcome: str, position: str) -> DataFrame:
    """Of kept rows with one complete key the highest value stays, then the smaller run, then the earlier row."""
    eligible = T.is_kept(F.col("exclusion"))
    for k in keys:
        eligible = eligible & ~T.is_blank(F.col(k))
    v = F.coalesce(F.col(value).try_cast("long"), F.lit(0))
    marked = meta.withColumn("_ok", eligible)
    rank = F.row_number().over(Window.partitionBy("_ok", *keys).orderBy(v.desc(), "run", position))
    return marked.withColumn("_rank", rank).withColumn("exclusion", F.when(F.col("_ok") & (F.col("_rank") > 1), outcome).otherwise(F.col("exclusion"))).drop("_ok", "_rank")
