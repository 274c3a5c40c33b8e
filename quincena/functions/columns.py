"""Column expressions. All are built-in Spark functions, so they stay inside
whole-stage code generation."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quincena.fixed import DATE_12H, DATE_24H, FILE_NAME_PATTERN, REPORT_QUERY_LAYOUT


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def composite_key(nombre="nombre", apellido="apellido", institucion="institucion", cargo="cargo",
                  cedula="cedula") -> Column:
    """``nombre-apellido-institucion-cargo-cedula`` with dashes removed from the
    id. ``concat_ws`` skips NULLs, so keys of different people may collide."""
    return F.concat_ws("-", _c(nombre), _c(apellido), _c(institucion), _c(cargo),
                       F.replace(_c(cedula), F.lit("-"), F.lit("")))


def years_between(end="fecha_actualizacion", start="fecha_de_inicio") -> Column:
    """Tenure in years: ``months_between(end, start) / 12`` (31-day fractional
    months, whole months on equal day-of-month or two month-ends)."""
    return F.months_between(_c(end), _c(start)) / 12


def parse_report_datetime(text) -> Column:
    """Parse ``d/m/yyyy h:mm:ss AM|PM``; PM is honoured (``2:30:00 PM`` is
    14:30). A 24-hour value with a marker (``14:30:00 PM``) is read as is.
    Unparseable text gives NULL."""
    t = F.trim(_c(text))
    return F.coalesce(F.try_to_timestamp(t, F.lit(DATE_12H)), F.try_to_timestamp(t, F.lit(DATE_24H))) \
        .cast("timestamp_ntz")


def normalize_header(col) -> Column:
    """Header cell → column name: strip, lower case, spaces to underscores."""
    return F.replace(F.lower(F.trim(_c(col))), F.lit(" "), F.lit("_"))


def url_quote(col) -> Column:
    """Percent-encode like a path quote with ``/`` kept: form encoding from
    ``url_encode`` with ``+``→``%20``, ``%2F``→``/``, ``*``→``%2A``, ``%7E``→``~``."""
    e = F.url_encode(_c(col))
    for a, b in (("+", "%20"), ("%2F", "/"), ("*", "%2A"), ("%7E", "~")):
        e = F.replace(e, F.lit(a), F.lit(b))
    return e


def report_url(base_url: str, institution, status) -> Column:
    """``{base}?&Ne={institution}&N=&A=&C=&E={status}`` with both names encoded."""
    before, between, after = re.split(r"\{\w+\}", REPORT_QUERY_LAYOUT)
    return F.concat(F.lit(base_url + before), url_quote(institution), F.lit(between), url_quote(status), F.lit(after))


def file_stem(content_disposition, default: str = "report") -> Column:
    """Stem of ``filename="<stem>.xlsx"`` in a response header, else ``default``."""
    stem = F.regexp_extract(_c(content_disposition), FILE_NAME_PATTERN, 1)
    return F.coalesce(F.nullif(stem, F.lit("")), F.lit(default))


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds of a wall-clock timestamp read as UTC, whatever
    the session time zone."""
    t = _c(ts)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    return days * 86400 + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def version_stamp(ts) -> Column:
    """Epoch seconds of a whole-second timestamp with ``_0`` for the fraction
    (``1704067200_0``)."""
    return F.concat(epoch_seconds(ts).cast("string"), F.lit("_0"))


def landing_file_name(stem, status, ts) -> Column:
    """``{stem}_{status}_{stamp}.parquet``."""
    return F.concat(_c(stem), F.lit("_"), _c(status), F.lit("_"), version_stamp(ts), F.lit(".parquet"))


def duration_seconds(start="start_at", end="end_at") -> Column:
    """Run time in seconds as FLOAT, from microsecond timestamps."""
    return (F.timestamp_diff("MICROSECOND", _c(start), _c(end)) / 1e6).cast("float")


def report_label(institution="institution_name_spanish", status="status_name_spanish") -> Column:
    """``institution - status``; NULL if either part is NULL."""
    return F.concat(_c(institution), F.lit(" - "), _c(status))
