"""Reference periods: single labels, free text, file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from arealoom.functions import vocab
from arealoom.functions.text import _col, bind

__all__ = [
    "alignment", "coalesce_period", "extract_periods", "parse_period", "period_from_name",
    "period_span",
]

_WORD = f"({vocab.MONTH_WORDS})"
_GAP = r"[\s\-/]"

# Layouts of a period label in order of trial, and what each group of a layout holds:
# y year, m month, d day, q calendar quarter, f financial quarter, a/b its start/end year,
# s spreadsheet serial.
_LAYOUTS = [
    (r"(20\d{2})(\d{2})(\d{2})", "ymd"),
    (r"(20\d{2})(\d{2})", "ym"),
    (r"(\d{5})", "s"),
    (r"(20\d{2})\s*[- ]?\s*q([1-4])", "yq"),
    (r"q([1-4])\s*[- ]?\s*(20\d{2})", "qy"),
    (r"[^|]*?q([1-4])\s*(?:fy)?\s*(\d{2,4})\s*[/\-]\s*(\d{2,4})[^|]*", "fab"),
    (r"[^|]*?(\d{2,4})\s*[/\-]\s*(\d{2,4})\s*q([1-4])[^|]*", "abf"),
    (rf"{_WORD}{_GAP}*(\d{{2,4}})", "my"),
    (r"(\d{1,2})[\-/](20\d{2}|\d{2})", "my"),
    (r"(20\d{2})-(\d{1,2})", "ym"),
    (rf"(\d{{1,2}}){_GAP}+{_WORD}{_GAP}+(\d{{2,4}})", "dmy"),
    (r"(20\d{2})[-/](\d{1,2})[-/](\d{1,2})", "ymd"),
    (r"(\d{1,2})[-/](\d{1,2})[-/](\d{2,4})", "dmy"),
    (rf"[^|]*?{_WORD}{_GAP}+(\d{{1,2}})(?:st|nd|rd|th)?,?{_GAP}+(20\d{{2}})[^|]*", "mdy"),
    (rf"[^|]*?(20\d{{2}}){_GAP}+{_WORD}{_GAP}+(\d{{1,2}})[^|]*", "ymd"),
    (rf"[^|]*?(\d{{1,2}})(?:st|nd|rd|th)?{_GAP}+{_WORD},?{_GAP}+(20\d{{2}})[^|]*", "dmy"),
    (rf"(20\d{{2}}){_GAP}+{_WORD}", "ym"),
]
_FIELDS = "ymdqfabs"


def _one_pattern() -> tuple[str, str]:
    """All layouts as one alternation, tried in order, and a replacement that lists the fields of
    the layout that fitted: groups of the others are empty."""
    slots = {name: "" for name in _FIELDS}
    group = 0
    for _, names in _LAYOUTS:
        for name in names:
            group += 1
            slots[name] += f"${group}"
    body = "|".join(f"(?:{layout})" for layout, _ in _LAYOUTS)
    return f"^(?:{body})$", "|".join(slots[name] for name in _FIELDS)


_PATTERN, _FORM = _one_pattern()

# Phrases before a period that say nothing about it.
_PHRASES = ["as at", "data as at", "quarter ending", "period ending", "report period", "reporting period"]
_PREFIXES = r"^(?:" + "|".join(p.replace(" ", r"\s+") for p in _PHRASES) + r")(?:\s+|\s*:\s*)"


def _year(text: Column) -> Column:
    """Two-digit years belong to this century."""
    number = text.try_cast("int")
    return F.when(number < 100, number + 2000).otherwise(number)


def _month(text: Column) -> Column:
    """Month number from digits or a month word. Words are told apart first: a failing cast costs
    more than the lookup."""
    names = F.array(*[F.lit(m) for m in vocab.MONTHS])
    word = F.array_position(names, F.substring(text, 1, 3)).cast("int")
    return F.when(text < ":", text.try_cast("int")).otherwise(word)


def _date(year: Column, month: Column, day: Column) -> Column:
    """Calendar date within the accepted years, null when the parts make none."""
    parts = [F.lpad(year.cast("string"), 4, "0"), month.cast("string"), day.cast("string")]
    low, high = vocab.YEAR_RANGE
    return F.when(year.between(low, high), F.try_to_date(F.concat_ws("-", *parts), "yyyy-M-d"))


def _month_end(year: Column, month: Column) -> Column:
    return F.last_day(_date(year, month, F.lit(1)))


def _clean(c) -> Column:
    text = F.lower(F.translate(_col(c).cast("string"), "–—_|", "-- ¦"))
    text = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.trim(F.regexp_replace(text, _PREFIXES, ""))


def _fy_date(quarter: Column, start: Column, end: Column) -> Column:
    """Financial-year quarter end: the first two quarters fall in the start year."""
    early = quarter <= 2
    year = F.lit(2000) + F.right(F.when(early, start).otherwise(end), F.lit(2)).try_cast("int")
    return _month_end(year, F.when(early, quarter * 3 + 6).otherwise(quarter * 3 - 6))


def _resolve(text: Column, month_day: str = "last") -> Column:
    """A cleaned label to a date."""

    def dated(part):
        y, m, d, q, f, a, b, s = (
            F.nullif(F.try_element_at(part, F.lit(i + 1)), F.lit("")) for i in range(len(_FIELDS))
        )
        serial = s.try_cast("int")
        by_serial = F.date_add(F.lit("1899-12-30").cast("date"), serial)
        month = _month_end(_year(y), _month(m))
        if month_day == "first":
            month = F.trunc(month, "month")
        return (
            F.when(F.size(part) != len(_FIELDS), F.lit(None).cast("date"))
            .when(d.isNotNull(), _date(_year(y), _month(m), d.try_cast("int")))
            .when(m.isNotNull(), month)
            .when(q.isNotNull(), _month_end(_year(y), q.try_cast("int") * 3))
            .when(f.isNotNull(), _fy_date(f.try_cast("int"), a, b))
            .when(
                serial.between(*vocab.SERIAL_RANGE) & (F.year(by_serial) <= vocab.YEAR_RANGE[1]), by_serial
            )
        )

    return bind(F.split(F.regexp_replace(text, _PATTERN, _FORM), r"\|"), dated)


def parse_period(c, month_day: str = "last") -> Column:
    """One reporting-period label to a date; a bare code or anything outside 2000–2035 is null.

    The first layout that fits decides, valid or not; all layouts are one pattern, matched once.
    Month labels give the month end, or day one with ``month_day="first"``.
    """
    # Digits split by spaces are one number only when there is nothing else.
    text = _clean(c)
    solid = F.when(text.rlike("^[0-9 ]+$"), F.replace(text, F.lit(" "), F.lit(""))).otherwise(text)
    return _resolve(solid, month_day)


# Full month names and layouts looked for in running text.
_FULL_MONTH = (
    "january|february|march|april|may|june|july|august|september|october|november|december"
)
_TEXT_LAYOUTS = [
    r"(?<!\d)\d{4}[_\-\s]*q[1-4]",
    r"q[1-4]\s*fy\s*\d{2,4}\s*[-/]\s*\d{2,4}",
    r"fy\s*\d{2,4}\s*[-/]\s*\d{2,4}\s*q[1-4]",
    r"\b\d{4}-\d{1,2}-\d{1,2}\b",
    r"\b\d{1,2}/\d{1,2}/\d{4}\b",
    r"\b\d{1,2}-\d{1,2}-\d{4}\b",
    rf"(?:{_FULL_MONTH})[_\-\s]+20\d{{2}}",
    r"(?<!\d)20\d{2}(?:0[1-9]|1[0-2])(?!\d)",
]


def _text_token(token: Column) -> Column:
    """In running text four digits before a quarter are a pair of financial years."""
    pair = r"^(\d{2})(\d{2})[_\-\s]*q([1-4])$"
    return _resolve(F.regexp_replace(F.translate(token, "_", " "), pair, "q$3 $1/$2"))


def extract_periods(c) -> Column:
    """Every period mentioned in a text, as a sorted array of distinct dates."""
    text = F.lower(F.translate(F.coalesce(_col(c).cast("string"), F.lit("")), "–—", "--"))

    def tokens(t):
        return F.array_distinct(
            F.concat(*[F.regexp_extract_all(t, F.lit(layout), F.lit(0)) for layout in _TEXT_LAYOUTS])
        )

    dates = F.transform(bind(text, tokens), _text_token)
    return F.array_sort(F.array_distinct(F.array_compact(dates)))


def period_span(c) -> dict[str, Column]:
    """First, last and number of periods in a text."""
    periods = extract_periods(c)
    return {
        "period_min": F.array_min(periods),
        "period_max": F.array_max(periods),
        "period_count": F.size(periods),
    }


def _group(text: Column, pattern: str, index: int) -> Column:
    return F.regexp_extract(text, pattern, index)


def period_from_name(c) -> Column:
    """Date written in a file name: ``__yyyy-mm-dd__`` first, then any eight-digit date."""
    text = _col(c)
    marked, loose = r"__(\d{4}-\d{2}-\d{2})__", r"(\d{4})[-_ ]?(\d{2})[-_ ]?(\d{2})"
    dashed = F.concat_ws("-", *[_group(text, loose, i) for i in (1, 2, 3)])
    return F.when(text.rlike(marked), F.try_to_date(_group(text, marked, 1), "yyyy-MM-dd")).when(
        text.rlike(loose), F.try_to_date(dashed, "yyyy-MM-dd")
    )


def coalesce_period(content_min, content_max, text_min, text_max) -> dict[str, Column]:
    """Periods found in the content win over those in names or link text."""
    a, b, x, y = (_col(v) for v in (content_min, content_max, text_min, text_max))
    in_content = a.isNotNull() | b.isNotNull()
    in_text = x.isNotNull() | y.isNotNull()
    return {
        "period_min": F.when(in_content, F.coalesce(a, b)).otherwise(F.coalesce(x, y)),
        "period_max": F.when(in_content, F.coalesce(b, a)).otherwise(F.coalesce(y, x)),
        "period_basis": F.when(in_content, "content")
        .when(in_text, "filename_or_link_text")
        .otherwise("not_detected"),
    }


def alignment(c, cutoff: str = "2022-06-30") -> Column:
    return F.when(_col(c) > F.lit(cutoff).cast("date"), "time_misaligned_context_layer").otherwise(
        "near_or_within_target_review_required"
    )
