"""Value recoding: maps, bins, flags and labels.

All of these are ``CASE`` expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, functions as F


def recode(value: Column, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Map values; ``default`` (null if not given) for the others and for null."""
    cases = None
    for source, target in mapping.items():
        cases = F.when(value == source, target) if cases is None else cases.when(value == source, target)
    return cases.otherwise(default)


def recode_groups(value: Column, groups: Mapping[Any, Sequence[Any]], default: Any = None) -> Column:
    """Map each list of source values to one code; the first group holding the value wins."""
    cases = None
    for target, sources in groups.items():
        hit = value.isin(list(sources))
        cases = F.when(hit, target) if cases is None else cases.when(hit, target)
    return cases.otherwise(default)


def flag_other(value: Column, zero_value: Any, null_as: int = 1) -> Column:
    """0 for ``zero_value``, 1 for anything else, ``null_as`` for null."""
    return F.when(value.isNull(), null_as).when(value == zero_value, 0).otherwise(1)


def replace_value(value: Column, old: Any, new: Any) -> Column:
    return F.when(value == old, F.lit(new)).otherwise(value)


def grade_to_number(grade: Column, grades: Sequence[str], unknown: float = 0.0) -> Column:
    """Ordered grades to 1.0, 2.0, …; ``unknown`` for anything else, null included."""
    return recode(grade, {g: float(i) for i, g in enumerate(grades, start=1)}, unknown)


def bin_left_closed(value: Column, bounds: Sequence[float], first: int = 1) -> Column:
    """Class number with a boundary value opening the next class; null stays null."""
    cases = None
    for code, bound in enumerate(bounds, start=first):
        cases = F.when(value < bound, code) if cases is None else cases.when(value < bound, code)
    return cases.when(value >= bounds[-1], first + len(bounds))


def bin_right_closed(
    value: Column, bounds: Sequence[float], first: int = 0, null_as: int | None = None
) -> Column:
    """Class number with a boundary value closing its class; ``null_as`` for null."""
    cases = F.when(value.isNull(), F.lit(null_as).cast("int"))
    for code, bound in enumerate(bounds, start=first):
        cases = cases.when(value <= bound, code)
    return cases.otherwise(first + len(bounds))


def decode_label(value: Column, labels: Mapping[Any, str]) -> Column:
    """Code to display label; a code without a label is shown as it is."""
    return F.coalesce(recode(value, labels), value.cast("string"))


def label_to_ordinal(label: Column, ordered: Sequence[str]) -> Column:
    """Ordered labels to 1, 2, …; text that already is a number is kept, other text is null."""
    return F.coalesce(
        recode(label, {text: i for i, text in enumerate(ordered, start=1)}), label.try_cast("int")
    )


def threshold_flag(value: Column, at_least: float) -> Column:
    """1 when the value reaches the threshold, 0 when below it or null."""
    return F.coalesce((value >= at_least).cast("int"), F.lit(0))


def rule_flag(
    kind: Column, always: Sequence[Any], conditional: Sequence[Any], measures: Sequence[Column], at_least: float
) -> Column:
    """1 for kinds in ``always``, and for kinds in ``conditional`` when any measure reaches the bound."""
    any_high = measures[0] >= at_least
    for measure in measures[1:]:
        any_high = any_high | (measure >= at_least)
    return F.when(kind.isin(list(always)), 1).when(kind.isin(list(conditional)) & any_high, 1).otherwise(0)


def nested_recode(
    main: Column, mapping: Mapping[Any, Any], detail: Column, detail_mapping: Mapping[Any, Any], default: Any
) -> Column:
    """Recode the main column; where it says nothing, recode the detail column, else ``default``."""
    return F.coalesce(recode(main, mapping), recode(detail, detail_mapping, default))


def classify_members(
    value: Column, groups: Mapping[int, Sequence[str]],
    split: Sequence[str], detail: Column, markers: Sequence[str], when_marked: int, otherwise: int,
) -> Column:
    """Class by list membership; values in ``split`` divide on a marker substring of ``detail``."""
    marked = detail.contains(markers[0])
    for marker in markers[1:]:
        marked = marked | detail.contains(marker)
    split_class = F.when(value.isin(list(split)), F.when(marked, when_marked).otherwise(otherwise))
    return F.coalesce(recode_groups(value, groups), split_class)


def typed_null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)
