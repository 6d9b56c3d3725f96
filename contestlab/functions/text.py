"""Text expressions: keys, cleaning, slugs and rule-based classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

__all__ = [
    "POSITION_RULES", "classify", "contains_ci", "field_position", "first_line", "key_of",
    "normalise_name", "piece", "player_link", "replace_first", "report_id", "slug",
    "strip_control", "strip_digits", "strip_marks", "strip_punct",
]

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_of(*cols: ColumnOrName, sep: str = "_") -> Column:
    """Join values to one key; a missing value becomes the text NA."""
    return F.concat_ws(sep, *[F.coalesce(_col(c).cast("string"), F.lit("NA")) for c in cols])


def strip_control(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c), r"[\r\n\t]", "")


def strip_punct(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c), r"\p{P}", "")


def strip_digits(c: ColumnOrName) -> Column:
    return F.regexp_replace(_col(c), "[0-9]+", "")


def strip_marks(c: ColumnOrName) -> Column:
    """Control characters, marks and digits taken out at once."""
    return F.regexp_replace(_col(c), r"[\r\n\t\p{P}0-9]+", "")


def normalise_name(c: ColumnOrName) -> Column:
    """One spelling for both tables: hyphens to blanks, no marks or digits, single blanks."""
    spaced = F.regexp_replace(strip_control(c), "-", " ")
    return F.trim(F.regexp_replace(strip_digits(strip_punct(spaced)), " +", " "))


def replace_first(c: ColumnOrName, old: str, new: str) -> Column:
    """Replace the first occurrence of a literal text only."""
    c = _col(c)
    at = F.instr(c, old)
    return F.when(
        at > 0,
        F.concat(F.substring(c, F.lit(1), at - 1), F.lit(new), F.substr(c, at + len(old))),
    ).otherwise(c)


def contains_ci(c: ColumnOrName, text: str) -> Column:
    return F.lower(_col(c)).contains(text.lower())


def piece(c: ColumnOrName, sep: str, i: int) -> Column:
    """The i-th piece (from 1) of a text split at a separator; NULL past the end."""
    return F.get(F.split(_col(c), rf"\Q{sep}\E"), F.lit(i - 1))


def first_line(c: ColumnOrName) -> Column:
    return F.substring_index(_col(c), "\n", 1)


def slug(c: ColumnOrName) -> Column:
    """Blanks to hyphens; a lone ampersand disappears with its hyphen."""
    return F.replace(F.replace(_col(c), F.lit(" "), F.lit("-")), F.lit("&-"), F.lit(""))


def report_id(base: ColumnOrName, start: ColumnOrName, end: ColumnOrName,
              home: ColumnOrName, away: ColumnOrName) -> Column:
    """Address of a match report, which doubles as the match key."""
    return F.concat(
        base if isinstance(base, Column) else F.lit(base),
        _col(start).cast("string"), F.lit("-"), _col(end).cast("string"), F.lit("-"),
        slug(home), F.lit("-"), slug(away), F.lit("/"),
    )


# Pieces of the addresses of player pages.
PLAYER_PATH, PLAYER_SUFFIX = "player_summary", "/2/"


def player_link(c: ColumnOrName, base: str) -> Column:
    """Address of a player page; a name spread over lines is cut at its first line."""
    name = F.replace(first_line(c), F.lit(" "), F.lit("-"))
    return F.concat(F.lit(f"{base}/{PLAYER_PATH}/"), name, F.lit(PLAYER_SUFFIX))


def classify(c: ColumnOrName, rules: Sequence[tuple[str, Sequence[Sequence[str]]]],
             default: str) -> Column:
    """First rule that fits wins. A rule fits when every one of its alternatives lists
    has at least one word contained in the text, letter case aside."""
    result = None
    for label, needed in rules:
        fits = F.lit(True)
        for words in needed:
            any_word = F.lit(False)
            for word in words:
                any_word = any_word | contains_ci(c, word)
            fits = fits & any_word
        result = F.when(fits, label) if result is None else result.when(fits, label)
    return result.otherwise(default) if result is not None else F.lit(default)


# Classes of playing positions, in order of precedence.
POSITION_RULES = (
    ("Defense and Midfield", (("midfielder",), ("back",))),
    ("Midfield and Attack", (("midfielder",), ("winger", "forward"))),
    ("Attack", (("winger", "forward"),)),
    ("Midfielder", (("midfielder",),)),
    ("Defense", (("back",),)),
    ("Goalkeeper", (("keeper",),)),
)


def field_position(c: ColumnOrName) -> Column:
    return classify(c, POSITION_RULES, "Other")
