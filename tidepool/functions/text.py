"""Column functions for landed text: ids from URLs, ordered pattern matches, marker
lists, truncation, percentages, month keys and slice keys (L7, L8, L11-L14, T13-T15)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The card-text patterns (tried in this order) and the work-format
# markers of the reference's HTML cards, and its site base URL shape.
EXPERIENCE_PATTERNS = (
    r"Опыт\s+\d+\s*[–-]\s*\d+\s+года?",
    r"Опыт\s+\d+\s*[–-]\s*\d+\s+лет",
    r"Опыт\s+более\s+\d+\s+лет",
    r"Без опыта",
)
WORK_FORMAT_MARKERS = ("Можно удалённо", "Можно удаленно", "Гибрид", "Полный день",
                       "Сменный график")
VACANCY_ID_PATTERN = r"/vacancy/(\d+)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def id_from_url(c, pattern: str = VACANCY_ID_PATTERN) -> Column:
    """First capture group of ``pattern`` in the URL, else the URL itself
    (``regexp_extract`` gives '' on no match)."""
    c = _c(c)
    return F.coalesce(F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")), c)


def canonical_url(c, base: str, pattern: str = VACANCY_ID_PATTERN,
                  path: str = "/vacancy/") -> Column:
    """Rebuild the URL from the extracted id, else cut the query string."""
    c = _c(c)
    found = F.regexp_extract(c, pattern, 1)
    return F.when(found != "", F.concat(F.lit(base.rstrip("/") + path), found)) \
            .otherwise(F.substring_index(c, "?", 1))


def resolve_url(c, base) -> Column:
    """Relative link -> absolute, the cases landed pages use: absolute URLs stay,
    '//host/x' takes the base scheme, '/x' the base origin, 'x' the base directory."""
    c = _c(c)
    b = F.lit(base) if isinstance(base, str) else _c(base)
    origin = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)
    scheme = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)
    path = F.regexp_replace(F.substring(b, F.length(origin) + 1, F.length(b)), r"[?#].*$", "")
    directory = F.concat(origin, F.regexp_replace(path, r"[^/]*$", ""))
    return (F.when(c.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*://"), c)
            .when(c.startswith("//"), F.concat(scheme, F.lit(":"), c))
            .when(c.startswith("/"), F.concat(origin, c))
            .when(path == "", F.concat(origin, F.lit("/"), c))
            .otherwise(F.concat(directory, c)))


def first_match(c, patterns: Sequence[str] = EXPERIENCE_PATTERNS) -> Column:
    """The match of the first pattern *in list order* that matches anywhere (one
    alternation would instead return the leftmost match of any pattern)."""
    c = _c(c)
    return F.coalesce(*[F.nullif(F.regexp_extract(c, p, 0), F.lit("")) for p in patterns])


def markers(c, words: Sequence[str] = WORK_FORMAT_MARKERS, sep: str = ", ") -> Column:
    """The literal markers contained in the text, in list order, joined; NULL
    when none (or when the text is NULL)."""
    c = _c(c)
    found = [F.when(F.contains(c, F.lit(m)), F.lit(m)) for m in words]
    return F.nullif(F.concat_ws(sep, *found), F.lit(""))


def ordered_distinct(arr) -> Column:
    """Non-empty elements, first-occurrence order, no repeats."""
    return F.array_distinct(F.filter(_c(arr), lambda x: x != ""))


def truncate(c, n: int) -> Column:
    """First ``n`` characters (code points, not bytes)."""
    return F.substring(_c(c), 1, n)


def month_key(c) -> Column:
    """Yyyymm as an int (UTC session time zone)."""
    return F.date_format(_c(c), "yyyyMM").cast("int")


def concat_key(*cols: str, sep: str = "|") -> Column:
    """Composite text key. Prefer a struct key where values may hold ``sep``."""
    return F.concat_ws(sep, *[F.col(c) for c in cols])


def pct(n, total) -> Column:
    """``round(n / total * 100, 1)`` as a number; 0 when total is 0."""
    n, total = _c(n), _c(total)
    return F.when(total == 0, F.lit(0.0)).otherwise(
        F.round(n * 100.0 / total, 1).cast("double"))


def pct_label(n, total) -> Column:
    """The percentage as text 'x.y%', '0%' when total is 0."""
    n, total = _c(n), _c(total)
    return F.when(total == 0, F.lit("0%")).otherwise(
        F.format_string("%.1f%%", F.round(n * 100.0 / total, 1).cast("double")))


def band(c, steps: Sequence[tuple[float, str]], base: str = "green") -> Column:
    """M8: colour of the highest step whose threshold is <= value."""
    c = _c(c)
    out = F.lit(base)
    for threshold, colour in sorted(steps):
        out = F.when(c >= threshold, F.lit(colour)).otherwise(out)
    return F.when(c.isNull(), F.lit(None)).otherwise(out)
