"""Object-store URI and output-key helpers."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import RUN_KEY_FILE, RUN_KEY_FORMAT, RUN_KEY_PREFIX


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_s3_uri(col: Column | str, strict: bool = False) -> Column:
    """``s3://bucket/key`` -> ``struct<bucket, key>``; a missing key is ``''``.

    A value without the ``s3://`` scheme is an error in the reference; here it
    is null by default (one bad row should not fail a table scan), or raises
    when ``strict``.
    """
    c = _c(col)
    ok = c.startswith("s3://")
    rest = F.substring(c, 6, 1 << 30)
    bucket = F.substring_index(rest, "/", 1)
    # substring after the first slash, '' when there is none
    key =F.when(F.instr(rest, "/") > 0, F.substring(rest, F.instr(rest, "/") + 1, F.lit(1 << 30))).otherwise(
        F.lit("")
    )
    s = F.struct(bucket.alias("bucket"), key.alias("key"))
    if strict:
        return F.when(ok | c.isNull(), s).otherwise(F.raise_error(F.concat(F.lit("not an s3:// location: "), c)))
    return F.when(ok, s)


def parse_s3_uri(uri: str) -> tuple[str, str]:
    """Driver-side form for a single argument (job parameters)."""
    scheme, found, rest = uri.partition("s3://")
    if scheme or not found:
        raise ValueError(f"not an s3:// location: {uri!r}")
    bucket, _, key = rest.partition("/")
    return bucket, key


def run_key(ts: Column | str, prefix: str = RUN_KEY_PREFIX) -> Column:
    """``prefix/yyyyMMddHHmmss/data.json`` for a timestamp column."""
    return F.concat(F.lit(prefix + "/"), F.date_format(_c(ts), RUN_KEY_FORMAT), F.lit("/" + RUN_KEY_FILE))


def run_path(prefix: str = RUN_KEY_PREFIX, when: datetime | None = None) -> str:
    """Driver-side key for a job run (UTC now by default)."""
    t = when or datetime.now(timezone.utc)
    return f"{prefix}/{t.strftime('%Y%m%d%H%M%S')}/{RUN_KEY_FILE}"
