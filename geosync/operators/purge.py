"""Purge rules: rows an archive rule takes are tagged ``delete``, guarded rows never are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geosync.functions.dates import extract_year, parse_text_date
from geosync.functions.text import is_not_true, is_true
from geosync.operators.merge import delete_where

# States of sites, reports and boundaries that are purged.
SITE_DONE = ("Введён", "Введен")
SITE_NOT_STARTED = "Работы не начаты"
SITE_METRO = "Метро"
REPORT_STALE = "Неактуально"
REPORT_DAYS = 14
EXPIRED = ("Истек", "Срок действия истек")
EXPIRED_PART = "истек"


def _free(df: DataFrame, link: str, frozen: str) -> Column:
    free = F.lit(True)
    if link in df.columns:
        free = free & F.col(link).isNull()
    if frozen in df.columns:
        free = free & is_not_true(F.col(frozen))
    return free


def date_expired(value: Column, as_of: Column) -> Column:
    """Text date on or before the day one month ago; unreadable dates are not expired."""
    return is_true(parse_text_date(value) <= F.add_months(as_of, -1))


def year_expired(value: Column, as_of: Column) -> Column:
    return is_true(extract_year(value) < F.year(as_of))


def purge_date(df: DataFrame, column: str, as_of: Column, link: str = "task_key", frozen: str = "tasked") -> DataFrame:
    """A missing column purges nothing."""
    if column not in df.columns:
        return delete_where(df, F.lit(False))
    return delete_where(df, _free(df, link, frozen) & date_expired(F.col(column).cast("string"), as_of))


def purge_year(df: DataFrame, column: str, as_of: Column, link: str = "task_key", frozen: str = "tasked") -> DataFrame:
    if column not in df.columns:
        return delete_where(df, F.lit(False))
    return delete_where(df, _free(df, link, frozen) & year_expired(F.col(column).cast("string"), as_of))


def site_rules(status: Column, category: Column, actual: Column) -> dict[str, Column]:
    """The four rules of construction sites; a row may fall under several."""
    state = F.trim(status)
    return {
        "done": is_true(state.isin(*SITE_DONE)),
        "not_started": is_true(state == SITE_NOT_STARTED),
        "metro": is_true(F.trim(category) == SITE_METRO),
        "not_actual": F.coalesce(~actual, F.lit(False)),
    }


def any_rule(rules: dict[str, Column]) -> Column:
    hit = F.lit(False)
    for rule in rules.values():
        hit = hit | F.coalesce(rule, F.lit(False))
    return hit


def purge_any(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return delete_where(df, any_rule(rules))


def preview(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: rows under each rule, counted with overlaps, and rows under any."""
    return df.agg(
        *[F.count_if(rule).alias(name) for name, rule in rules.items()],
        F.count_if(any_rule(rules)).alias("any_rule"),
    )


def report_rules(received: Column, status: Column, as_of: Column, days: int = REPORT_DAYS,
                 stale: str = REPORT_STALE) -> dict[str, Column]:
    return {
        "old": is_true(received < as_of - F.expr(f"INTERVAL {int(days)} DAYS")),
        "stale": is_true(status == stale),
    }


def status_expired(status: Column, states: tuple[str, ...] = EXPIRED, part: str = EXPIRED_PART) -> Column:
    trimmed = F.trim(status)
    return is_true(trimmed.isin(*states) | F.lower(trimmed).contains(part))
