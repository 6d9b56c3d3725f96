"""Numbers, dates, scores, points and conditional aggregates."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

__all__ = [
    "blank_to_null_col", "count_where", "goal_diff", "has_finished", "mean_where", "minutes_played",
    "missing_flag", "n_distinct", "next_season_label", "parse_date", "parse_measure",
    "parse_score", "per_period", "points", "rate", "ratio_of_sums", "round_to", "season_label",
    "season_start", "sum_where", "to_text", "winner",
]

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null_col(c: ColumnOrName) -> Column:
    return F.nullif(_col(c), F.lit(""))


def missing_flag(c: ColumnOrName) -> Column:
    return _col(c).isNull().cast("int")


def parse_measure(c: ColumnOrName, unit: str = "") -> Column:
    """Number in front of a unit such as ' cm'; NULL when it is no number."""
    c = _col(c)
    return (F.replace(c, F.lit(unit), F.lit("")) if unit else c).try_cast("double")


def to_text(c: ColumnOrName, fmt: str | None = None) -> Column:
    return F.date_format(_col(c), fmt) if fmt else _col(c).cast("string")


def parse_date(c: ColumnOrName, fmt: str = "dd/MM/yyyy") -> Column:
    return F.try_to_date(_col(c), fmt)


def has_finished(day: ColumnOrName, as_of: date | Column | None = None,
                 mode: str = "intended") -> Column:
    """1 when the day lies before `as_of`. Literal mode compares dd/MM/yyyy texts."""
    as_of = F.current_date() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    left, right = _col(day), as_of
    if mode == "literal":
        left, right = F.date_format(left, "dd/MM/yyyy"), F.date_format(right, "dd/MM/yyyy")
    return (left < right).cast("int")


def parse_score(c: ColumnOrName, mode: str = "intended") -> Column:
    """'h:a (h:a)' to a struct of four counts. Literal mode reads fixed positions,
    so goals of two digits are misread there."""
    c = _col(c)
    names = ["ft_home", "ft_away", "ht_home", "ht_away"]
    if mode == "literal":
        parts = [F.substring(c, at, 1) for at in (1, 3, 6, 8)]
    else:
        pattern = r"(\d+):(\d+)\s*(?:\((\d+):(\d+)\))?"
        parts = [F.regexp_extract(c, pattern, i) for i in (1, 2, 3, 4)]
    return F.struct(*[p.try_cast("int").alias(n) for p, n in zip(parts, names)])


def winner(home: ColumnOrName, away: ColumnOrName) -> Column:
    home, away = _col(home), _col(away)
    return F.when(home > away, "Home").when(home < away, "Away").when(home == away, "Draw")


def goal_diff(home: ColumnOrName, away: ColumnOrName) -> Column:
    return _col(home) - _col(away)


def points(result: ColumnOrName, is_home: ColumnOrName) -> Column:
    """3 for the winning side, 1 each for a draw, 0 for the loser, NULL while unplayed."""
    result, home_side = _col(result), _col(is_home).cast("boolean")
    own = F.when(home_side, F.lit("Home")).otherwise(F.lit("Away"))
    return F.when(result == "Draw", 1).when(result == own, 3).when(result.isNotNull(), 0)


def minutes_played(starts: ColumnOrName, sub_in: ColumnOrName, sub_out: ColumnOrName) -> Column:
    """Estimate: 90 a full match, 20 a substitution on, 70 when taken off."""
    starts, sub_in, sub_out = _col(starts), _col(sub_in), _col(sub_out)
    return (starts - sub_out) * 90 + sub_in * 20 + sub_out * 70


def round_to(c: ColumnOrName, digits: int, mode: str = "intended") -> Column:
    """Half up; literal mode rounds half to even."""
    return F.bround(_col(c), digits) if mode == "literal" else F.round(_col(c), digits)


def season_label(start: ColumnOrName) -> Column:
    start = _col(start).cast("int")
    return F.concat(start.cast("string"), F.lit("/"), (start + 1).cast("string"))


def season_start(label: ColumnOrName) -> Column:
    return F.substring(_col(label), 1, 4).try_cast("int")


def next_season_label(label: ColumnOrName) -> Column:
    return season_label(season_start(label) + 1)


def rate(total: ColumnOrName, n: ColumnOrName) -> Column:
    return F.try_divide(_col(total), _col(n))


def n_distinct(c: ColumnOrName) -> Column:
    """Distinct values in a group, a missing value counting as one."""
    c = _col(c)
    return F.count_distinct(c) + F.max(c.isNull().cast("int"))


def sum_where(c: ColumnOrName, cond: Column) -> Column:
    return F.sum(F.when(cond, _col(c)))


def count_where(cond: Column) -> Column:
    return F.count_if(cond)


def mean_where(c: ColumnOrName, cond: Column, digits: int = 2) -> Column:
    """Average of the known values meeting the condition; 0 when there is none."""
    c = _col(c)
    mean = F.try_divide(sum_where(c, cond), F.count_if(cond & c.isNotNull()))
    return F.coalesce(F.round(mean, digits), F.lit(0.0))


def ratio_of_sums(a: ColumnOrName, b: ColumnOrName, digits: int = 2) -> Column:
    """Rounded quotient of two sums; 0 when the divisor is 0."""
    quotient = F.try_divide(F.sum(_col(a)), F.sum(_col(b)))
    return F.coalesce(F.round(quotient, digits), F.lit(0.0))


def per_period(c: ColumnOrName, periods: int) -> Column:
    return F.sum(_col(c)) / F.lit(periods)
