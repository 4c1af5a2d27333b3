"""Data-quality rules as SQL expressions over the record.

A rule is a function returning finding structs that are null where the rule holds. Adding a rule
is adding a function; nothing here needs a UDF. Findings keep rule order: required fields, then
types, then business rules.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetstar import fixed
from sheetstar.functions.text import float_text

ERROR, WARNING = "error", "warning"
Rule = Callable[[], list[Column]]


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _in(values: Iterable[str]) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def _concat(template: str) -> str:
    """SQL of a message template; ``{column}`` stands for a text column."""
    parts = []
    for literal, column, _, _ in Formatter().parse(template):
        parts += [quoted(literal)] if literal else []
        parts += [column] if column else []
    return f"concat({', '.join(parts)})"


def _finding_sql(broken: str, rule: str, field_sql: str, message: str, severity: str) -> str:
    return (
        f"CASE WHEN {broken} THEN named_struct('rule', {quoted(rule)}, 'field', {field_sql}, "
        f"'message', {_concat(message)}, 'severity', {quoted(severity)}) END"
    )


def finding(broken: str, rule: str, field: str, message: str, severity: str) -> Column:
    """Finding struct where the SQL condition ``broken`` is true, null elsewhere (also where it
    is unknown). ``message`` may mention text columns as ``{column}``."""
    return F.expr(_finding_sql(broken, rule, quoted(field), message, severity))


_NOTATIONS = _in(fixed.RATING_NOTATIONS)


def required_fields() -> list[Column]:
    rules = []
    for name in fixed.REQUIRED_FIELDS:
        label = fixed.SCALAR_LABELS[name]
        message = fixed.MESSAGES["required"].format(label=label)
        rules.append(finding(f"coalesce({name}, '') = ''", "required", label, message, ERROR))
    rules.append(
        finding(
            "coalesce(size(rating_methodologies), 0) <= 0",
            "methodologies",
            fixed.METHODOLOGIES_LABEL,
            fixed.MESSAGES["methodologies"],
            ERROR,
        )
    )
    for name, label in fixed.RECOMMENDED_FIELDS.items():
        message = fixed.MESSAGES["recommended"].format(label=label)
        rules.append(finding(f"{name} IS NULL", "recommended", label, message, WARNING))
    return rules


def currency() -> list[Column]:
    broken = f"currency <> '' AND upper(currency) NOT IN {_in(fixed.CURRENCIES)}"
    message = fixed.MESSAGES["currency"]
    return [finding(broken, "currency", "currency", message, ERROR)]


def month() -> list[Column]:
    broken = f"business_year_end <> '' AND business_year_end NOT IN {_in(fixed.MONTHS)}"
    message = fixed.MESSAGES["month"]
    return [finding(broken, "month", "business_year_end", message, ERROR)]


def weight_type() -> list[Column]:
    broken = "industry_weight_text IS NOT NULL AND industry_weight IS NULL"
    message = fixed.MESSAGES["weight_type"]
    return [finding(broken, "weight_type", "industry_weight", message, ERROR)]


def profiles() -> list[Column]:
    rules = []
    for name in ("business_risk_profile", "financial_risk_profile"):
        unknown, notch = f"{name} NOT IN {_NOTATIONS}", f"contains(lower({name}), 'notch')"
        adjusted, invalid = (fixed.MESSAGES[m].format(profile=f"{{{name}}}") for m in ("profile_notch", "profile"))
        rules.append(finding(f"{unknown} AND {notch}", "profile_notch", name, adjusted, WARNING))
        rules.append(finding(f"{unknown} AND NOT {notch}", "profile", name, invalid, ERROR))
    return rules


def weight_range() -> list[Column]:
    outside = f"(industry_weight NOT BETWEEN {fixed.WEIGHT_MIN} AND {fixed.WEIGHT_MAX} OR isnan(industry_weight))"
    missing, message = fixed.MESSAGES["weight_missing"], fixed.MESSAGES["weight_range"]
    return [
        finding("industry_weight IS NULL", "weight_missing", "industry_weight", missing, WARNING),
        finding(f"industry_weight IS NOT NULL AND {outside}", "weight_range", "industry_weight", message, ERROR),
    ]


def weight_sum() -> list[Column]:
    # NaN sorts above every number here, but deviates from nothing.
    broken = f"abs(industry_weight - 1) > {fixed.WEIGHT_TOLERANCE}D AND NOT isnan(industry_weight)"
    message = fixed.MESSAGES["weight_sum"]
    return [finding(broken, "weight_sum", "industry_weight", message, WARNING)]


def profile_pair() -> list[Column]:
    business, financial = "coalesce(business_risk_profile, '')", "coalesce(financial_risk_profile, '')"
    without_financial, without_business = fixed.MESSAGES["without_financial"], fixed.MESSAGES["without_business"]
    return [
        finding(f"{business} <> '' AND {financial} = ''", "profile_pair", "financial_risk_profile", without_financial, ERROR),
        finding(f"{financial} <> '' AND {business} = ''", "profile_pair", "business_risk_profile", without_business, ERROR),
    ]


def entity_name() -> list[Column]:
    broken = f"char_length(rated_entity) > {fixed.ENTITY_NAME_MAX}"
    message = fixed.MESSAGES["entity_name"]
    return [finding(broken, "entity_name", "rated_entity", message, WARNING)]


def metrics_present() -> list[Column]:
    none, no_years = fixed.MESSAGES["metrics_missing"], fixed.MESSAGES["metrics_years"]
    return [
        finding("NOT has_years AND NOT has_metrics", "metrics_missing", "credit_metrics", none, WARNING),
        finding("has_metrics AND NOT has_years", "metrics_years", "credit_metrics", no_years, ERROR),
    ]


def _sub_scores() -> Column:
    """A warning for each sub-score that is neither a notation nor a notch text."""
    labels = ", ".join(quoted(label) for label in fixed.SUB_SCORE_LABELS)
    scores = f"transform(array({labels}), l -> named_struct('label', l, 'score', risk_sub_scores[l]))"
    broken = f"s.score NOT IN {_NOTATIONS} AND NOT contains(lower(s.score), 'notch')"
    warning = _finding_sql(broken, "sub_score", "s.label", fixed.MESSAGES["sub_score"], WARNING)
    return F.expr(f"transform({scores}, s -> {warning})")


def _metric_values() -> Column:
    """A warning for each metric value that is neither a number nor a sentinel."""
    message = fixed.MESSAGES["metric_value"]
    warning = _finding_sql("p.kind = 'raw'", "metric_value", "s.metric", message, WARNING)
    return F.expr(
        "flatten(transform(coalesce(series, array()), "
        f"s -> transform(filter(s.points, p -> p.kind = 'raw'), p -> {warning})))"
    )


BEFORE_METRICS: list[Rule] = [required_fields, currency, month, weight_type, profiles]
AFTER_METRICS: list[Rule] = [weight_range, weight_sum, profile_pair, entity_name, metrics_present]


def with_findings(records: DataFrame, extra_rules: Iterable[Rule] = ()) -> DataFrame:
    """Add ``findings``, an array in rule order: one pass over the records (with their
    ``series``), no shuffle.

    The frame may say ``has_years`` and ``has_metrics`` itself; otherwise they come from the
    series, under which metrics exist only where years do.
    """
    columns = records.columns
    weight = F.col("industry_weight")
    helpers = {
        "_weight": float_text(weight),
        "_deviation": F.expr(
            "CASE WHEN abs(industry_weight) = double('inf') THEN 'inf' "
            "ELSE format_string('%.4f', abs(industry_weight - 1)) END"
        ),
        "_name_length": F.expr("string(char_length(rated_entity))"),
    }
    if "has_years" not in columns:
        helpers |= {"has_years": F.expr("series IS NOT NULL"), "has_metrics": F.expr("coalesce(size(series), 0) > 0")}

    def all_of(rules: Iterable[Rule]) -> Column:
        return F.array(*[column for rule in rules for column in rule()])

    found = F.concat(all_of(BEFORE_METRICS), _sub_scores(), _metric_values(), all_of([*AFTER_METRICS, *extra_rules]))
    return records.withColumns(helpers).select(*columns, F.array_compact(found).alias("findings"))


def findings(checked: DataFrame) -> DataFrame:
    """Long form: ``file_id, seq, rule, field, message, severity``."""
    # The outer form: the plain one infers a filter on the array and so evaluates all rules twice.
    each = checked.select("file_id", F.posexplode_outer("findings").alias("seq", "f"))
    return each.filter(F.col("seq").isNotNull()).select("file_id", "seq", "f.*")


def with_report(checked: DataFrame) -> DataFrame:
    """Add the report to records with ``findings``: validity, counts, scores, and the findings
    split by severity.

    ``present_fields`` counts down from a fixed number of fields by errors, for both scores.
    """

    def of(severity: str) -> Column:
        return F.expr(
            f"transform(filter(findings, f -> f.severity = {quoted(severity)}), "
            "f -> named_struct('field', f.field, 'message', f.message, 'severity', f.severity))"
        )

    score = f"CAST(round(({fixed.SCORED_FIELDS} - size(errors)) / {fixed.SCORED_FIELDS}, 3) AS DECIMAL(4, 3))"
    return checked.withColumns({"errors": of(ERROR), "warnings": of(WARNING)}).selectExpr(
        "*",
        "size(errors) = 0 AS is_valid",
        "size(errors) AS error_count",
        "size(warnings) AS warning_count",
        f"{fixed.SCORED_FIELDS} AS total_fields",
        f"{fixed.SCORED_FIELDS} - size(errors) AS present_fields",
        f"{score} AS completeness_score",
        f"{score} AS validity_score",
    )


def check(records: DataFrame, extra_rules: Iterable[Rule] = ()) -> DataFrame:
    """Records with ``findings`` and the report."""
    return with_report(with_findings(records, extra_rules))
