"""Event validation as data: ordered rules give one reason, or a list of errors."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorloom.spec import SensorSpec


@dataclass(frozen=True)
class Rule:
    reason: str
    broken: Column


def _any_null(names: Sequence[str]) -> Column:
    return reduce(or_, [F.col(n).isNull() for n in names])


def _missing(name: str) -> Rule:
    return Rule(f"missing_{name}", F.col(name).isNull())


def _missing_event_id() -> Rule:
    return Rule("missing_event_id_or_parse_error", F.col("event_id").isNull())


def _missing_sensor(spec: SensorSpec) -> Rule:
    return Rule("missing_required_business_field", _any_null(spec.names))


def basic_rules(spec: SensorSpec) -> list[Rule]:
    """Identity, time, state and sensors must be present."""
    return [
        _missing_event_id(),
        _missing(spec.row_id),
        _missing(spec.time),
        _missing(spec.state),
        _missing_sensor(spec),
    ]


def strict_rules(spec: SensorSpec) -> list[Rule]:
    """Basic rules plus ingest time, label presence and value domains."""
    return [
        _missing_event_id(),
        _missing(spec.row_id),
        _missing(spec.time),
        _missing("ingest_time"),
        _missing(spec.state),
        Rule(f"invalid_{spec.state}", ~F.col(spec.state).isin(*spec.bands.states)),
        _missing(spec.flag),
        Rule(f"invalid_{spec.flag}", ~F.col(spec.flag).isin(0, 1)),
        _missing(spec.label),
        _missing_sensor(spec),
    ]


def reject_reason(rules: Sequence[Rule]) -> Column:
    """Reason of the first broken rule, null for a valid row."""
    chain = F
    for rule in rules:
        chain = chain.when(rule.broken, F.lit(rule.reason))
    return chain.otherwise(F.lit(None).cast("string"))


def _valid_time(text: Column) -> Column:
    shape = text.rlike(r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$")
    real = F.try_to_timestamp(text, F.lit("yyyy-M-d H:m:s")).isNotNull()
    return F.coalesce(shape & real, F.lit(False))


def contract_fields(spec: SensorSpec) -> list[str]:
    """Fields the contract looks at."""
    head = ["event_id", spec.row_id, spec.time, "ingest_time", spec.state, spec.flag, spec.label]
    return head + spec.names


def field_facts(parsed: Column, spec: SensorSpec) -> Column:
    """Per field the JSON kind (null when the key is absent, VOID for a JSON null), and the
    text of the fields whose value matters, as one struct."""
    facts = []
    for name in contract_fields(spec):
        item = F.try_variant_get(parsed, f"$.{name}", "variant")
        facts.append(F.schema_of_variant(item).alias(f"kind_{name}"))
    for name in (spec.time, "ingest_time", spec.state, spec.flag):
        facts.append(F.try_variant_get(parsed, f"$.{name}", "string").alias(f"text_{name}"))
    return F.struct(F.schema_of_variant(parsed).alias("kind"), *facts)


def contract_errors(spec: SensorSpec) -> Column:
    """Array of every contract violation, from the columns of ``field_facts``.

    A key that is present with null counts as missing; the format of a time is checked
    only when its key is present; a boolean or quoted number is not a sensor value.
    """

    def kind(name: str) -> Column:
        return F.coalesce(F.col(f"kind_{name}"), F.lit("VOID"))

    def text(name: str) -> Column:
        return F.col(f"text_{name}")

    def holds(test: Column) -> Column:
        return F.coalesce(test, F.lit(False))

    known_state = (kind(spec.state) == "STRING") & text(spec.state).isin(*spec.bands.states)
    known_flag = (kind(spec.flag) == "BOOLEAN") | (
        (kind(spec.flag) != "STRING") & text(spec.flag).try_cast("double").isin(0.0, 1.0)
    )
    errors = [
        F.when(kind(name) == "VOID", F.lit(f"missing_required_field:{name}"))
        for name in contract_fields(spec)
    ]
    errors += [
        F.when(F.col(f"kind_{name}").isNotNull() & ~_valid_time(text(name)), F.lit(f"invalid_{name}_format"))
        for name in (spec.time, "ingest_time")
    ]
    errors.append(F.when(~holds(known_state), F.lit(f"invalid_{spec.state}")))
    errors.append(F.when(~holds(known_flag), F.lit(f"invalid_{spec.flag}")))
    numbers = ("BIGINT", "FLOAT", "DOUBLE")
    errors += [
        F.when(
            ~(kind(name).isin("VOID", *numbers) | kind(name).startswith("DECIMAL")),
            F.lit(f"non_numeric_sensor:{name}"),
        )
        for name in spec.names
    ]
    return (
        F.when(F.col("kind").isNull(), F.array(F.lit("invalid_json")))
        .when(~F.col("kind").startswith("OBJECT"), F.array(F.lit("payload_not_json_object")))
        .otherwise(F.array_compact(F.array(*errors)))
    )
