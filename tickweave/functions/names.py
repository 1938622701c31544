"""Reading numbers, tokens and ranges out of names. All column functions stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# Accepted column names for each role, in order of preference.
TICK_NAMES = ("time_step", "iteration", "tick", "_ITERATION_NO")
ID_NAMES = ("ID", "id", "agent_id")
COORDINATES = ("set_num", "run_num", "time_step", "ID")

Range = tuple[int, int]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_number(c: Column | str) -> Column:
    """First run of digits in a name as int, null when there is none."""
    return F.regexp_extract(_col(c), r"(\d+)", 1).try_cast("int")


def trailing_number(c: Column | str) -> Column:
    """Digits at the very end of a name as int, null when there are none."""
    return F.regexp_extract(_col(c), r"(\d+)$", 1).try_cast("int")


def label_number(c: Column | str) -> Column:
    """Number of a label such as ``set_12`` or ``12``; null unless it has exactly one group of digits."""
    return F.when(F.regexp_count(_col(c), F.lit(r"\d+")) == 1, first_number(c))


def number_of(name: str) -> int:
    """Driver-side twin of :func:`label_number`, for config keys and folder names."""
    groups = re.findall(r"\d+", str(name))
    if len(groups) != 1:
        raise ValueError(f"{name!r} must hold exactly one number")
    return int(groups[0])


def parse_range(text: str | int | Range | None) -> Range | None:
    """``'3'``, ``'1-5'``, ``(1, 5)`` or ``None`` (no limit) to inclusive bounds; reversed bounds are an error."""
    if text is None or text == "":
        return None
    if isinstance(text, int):
        return (text, text)
    if isinstance(text, tuple):
        lo, hi = text
    else:
        m = re.fullmatch(r"(\d+)(?:-(\d+))?", str(text).strip())
        if not m:
            raise ValueError(f"range must look like '5' or '1-5', got {text!r}")
        lo, hi = int(m.group(1)), int(m.group(2) or m.group(1))
    if lo > hi:
        raise ValueError(f"range start {lo} is above its end {hi}")
    return (int(lo), int(hi))


def in_bounds(c: Column | str, bounds: Range | None) -> Column:
    return F.lit(True) if bounds is None else _col(c).between(*bounds)


def split_list(text: str | Iterable[str]) -> list[str]:
    parts = text.split(",") if isinstance(text, str) else list(text)
    return [p.strip() for p in parts if p.strip()]


def token_regex(token: str) -> str:
    """Pattern for ``token`` as a whole word, letters and digits on neither side."""
    return rf"(^|[^A-Za-z0-9]){re.escape(token)}([^A-Za-z0-9]|$)"


def has_token(c: Column | str, token: str) -> Column:
    return _col(c).rlike(token_regex(token))


def table_of_file(c: Column | str) -> Column:
    """``data_Firm.parquet`` -> ``Firm``."""
    return F.regexp_replace(F.regexp_replace(_col(c), r"^data_", ""), r"\.parquet$", "")


# Pieces of a run that is split over several files: <number>_data_<agent>.parquet.
PIECE_NAME = r"^(-?[0-9]+)_(data_.*)$"


def piece_of_file(c: Column | str) -> Column:
    """Number of a piece, null for a file that holds a whole run."""
    return F.regexp_extract(_col(c), PIECE_NAME, 1).try_cast("bigint")


def whole_name(c: Column | str) -> Column:
    """File name without the number of a piece."""
    return F.regexp_replace(_col(c), PIECE_NAME, "$2")


# Fixed value: flat database file names, in any letter case.
FLAT_DB_NAME = r"(?i)^(set_[a-z0-9]+)_(run_[a-z0-9]+)(?:_.*)?\.(?:db|sqlite|sqlite3)$"


def flat_db_part(c: Column | str, part: int) -> Column:
    """Folder label inside a flat database name: part 1 is the set, part 2 the run; null if not flat."""
    return F.nullif(F.regexp_extract(_col(c), FLAT_DB_NAME, part), F.lit(""))
