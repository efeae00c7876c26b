"""Symptom products: weekly sums and Yes/No reports of a flag component.

A symptom day is a DISTINCT (Date, Week, Patient, exercise, flag): several
equal reports on one day count once, and only the date (not the time) is
kept. The weekly sum adds the flags as 1.0/0.0 (null when every flag of the
group is null).

Plan: scan (only the entry paths read) -> generators -> partial DISTINCT in
the map task -> one shuffle on all five columns -> partial SUM -> one
shuffle on the three group keys. A patient or week holding a large share of
the rows is reduced map-side to at most one row per (day, flag value) before
any shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from equilibra import codes as C
from equilibra.functions import add_week_year, flag_text, week_keys
from equilibra.operators.observations import observations, select_component


DAY = (C.DATE, C.WEEK, C.PATIENT, C.DISPLAY, C.FLAG)


def symptom_days(bundles: DataFrame, code: str) -> DataFrame:
    return select_component(observations(bundles, [code]), code).select(*DAY).distinct()


def all_symptom_days(bundles: DataFrame) -> DataFrame:
    """The symptom days of all four codes, with ``C.COMPONENT_CODE``: one scan, one DISTINCT."""
    return observations(bundles, list(C.SYMPTOMS)).select(C.COMPONENT_CODE, *DAY).distinct()


def weekly_sums(days: DataFrame, *, sort: bool = True, with_year: bool = False) -> DataFrame:
    """The weekly sums of symptom days."""
    keys = [C.PATIENT, *week_keys(with_year), C.DISPLAY]
    out = add_week_year(days, with_year).groupBy(*keys).agg(F.sum(F.col(C.FLAG).cast("double")).alias("Sum"))
    # Ordered by Week as defined; the other keys only break ties so that the
    # range partitioning of the sort can split a heavy week.
    return out.orderBy(*week_keys(with_year), C.PATIENT, C.DISPLAY) if sort else out


def reports(days: DataFrame, code: str) -> DataFrame:
    """The Yes/No report of symptom days."""
    return days.select(C.PATIENT, C.DATE, C.WEEK, C.DISPLAY, flag_text(C.FLAG).alias(C.SYMPTOMS[code]))


def symptom_weekly_sum(bundles: DataFrame, code: str, *, sort: bool = True, with_year: bool = False) -> DataFrame:
    """(Patient_id, Week, exercise) -> ``Sum`` of the day flags; ``with_year`` tells the weeks of years apart."""
    return weekly_sums(symptom_days(bundles, code), sort=sort, with_year=with_year)


def symptom_reported(bundles: DataFrame, code: str) -> DataFrame:
    """One row per symptom day: Yes for true, No for false or null."""
    return reports(symptom_days(bundles, code), code)


def symptom_statistics(bundles: DataFrame) -> DataFrame:
    """The weekly sums of all four symptoms, one column each, from one scan and one
    DISTINCT; null where a symptom has no flag that week."""
    code = F.col(C.COMPONENT_CODE)
    days = all_symptom_days(bundles)
    sums = [F.sum(F.when(code == c, F.col(C.FLAG).cast("double"))).alias(name) for c, name in C.SYMPTOMS.items()]
    return days.groupBy(C.PATIENT, C.WEEK, C.DISPLAY).agg(*sums)
