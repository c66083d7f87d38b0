"""Scalar column builders used by operators, reports and decoders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from netcap.schemas import ADDEND, GENERAL_SECTOR, MONEY, SHARE

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Cast to NUMERIC(20,4) without failing: out of range gives NULL."""
    return _col(c).try_cast(MONEY)


def as_timestamp_ntz(c) -> Column:
    """A column that holds UTC wall-clock time as TIMESTAMP_NTZ."""
    return _col(c).cast(T.TimestampNTZType())


def utc_wall_clock(c) -> Column:
    """The UTC reading of a TIMESTAMP (an instant), whatever the session's zone."""
    return F.convert_timezone(None, F.lit("UTC"), _col(c).cast(T.TimestampNTZType()))


def epoch_millis(c) -> Column:
    """Milliseconds since the epoch of a TIMESTAMP_NTZ, sub-ms truncated.

    ``timestampdiff`` works on NTZ without a time zone; truncation matches
    a JavaScript ``Date`` built from a database timestamp.
    """
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), as_timestamp_ntz(c))
    return F.floor(micros / F.lit(1000)).cast("long")


def component_amount(source_col, source_type: str, amount_col) -> Column:
    """Spread one amount to a per-component measure: the amount for its own
    source type, exact zero otherwise; wide enough that its sums can't overflow."""
    zero = F.lit(0).cast(ADDEND)
    return F.when(_col(source_col) == F.lit(source_type),
                  F.coalesce(_col(amount_col).cast(ADDEND), zero)).otherwise(zero)


def sector_for_rule(source_col, sector_col, mode: str = "submitted") -> Column:
    """Sector of an event under one of the two rules.

    ``submitted``: the submitted sector as is (NULL is dropped later, an
    empty string is kept). ``general``: share items keep a non-empty
    submitted sector, else ``GENERAL``; every other item is ``GENERAL``.
    """
    if mode == "submitted":
        return _col(sector_col)
    if mode == "general":
        return F.when(
            _col(source_col) == F.lit(SHARE),
            F.coalesce(F.nullif(_col(sector_col), F.lit("")), F.lit(GENERAL_SECTOR)),
        ).otherwise(F.lit(GENERAL_SECTOR))
    raise ValueError(f"sector_mode must be 'submitted' or 'general', not {mode!r}")


def composite_key(fsp="fsp_id", sector="sector", date="reporting_date") -> Column:
    """Message key ``fsp:sector:date``, a missing part empty. Only a message key:
    grouping always uses the three columns, so values holding ':' stay distinct."""
    parts = [_col(fsp), _col(sector), F.date_format(_col(date), "yyyy-MM-dd")]
    return F.concat_ws(":", *[F.coalesce(p, F.lit("")) for p in parts])


# Murmur2 as keyed producers use it (public definition). Fixed values.
_SEED, _FACTOR, _WORD = 0x9747B28C, 0x5BD1E995, 0xFFFFFFFF


def _times_factor(x) -> Column:
    """``x * _FACTOR`` modulo 2^32, in halves so that no long overflows."""
    high = F.shiftleft((x * F.lit(_FACTOR >> 16)).bitwiseAND(F.lit(0xFFFF)), 16)
    return (x * F.lit(_FACTOR & 0xFFFF) + high).bitwiseAND(F.lit(_WORD))


def _little_endian(hex8) -> Column:
    """Four bytes in hex digits as an unsigned word, the first byte the lowest."""
    return F.conv(F.concat(*[F.substring(hex8, i, 2) for i in (7, 5, 3, 1)]), 16, 10).cast("long")


def _with_value(x, f) -> Column:
    """``f(x)`` with ``x`` computed once, however often ``f`` names it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def murmur2(key) -> Column:
    """Murmur2 of a string's UTF-8 bytes, as an unsigned 32-bit number in a long: what
    a keyed producer hashes by. NULL stays NULL."""
    digits, size = F.hex(_col(key)), F.octet_length(_col(key)).cast("long")
    words = F.transform(F.regexp_extract_all(digits, F.lit("[0-9A-F]{8}"), F.lit(0)),
                        lambda w: _times_factor(_little_endian(w)))
    words = F.transform(words, lambda w: w.bitwiseXOR(F.shiftright(w, 24)))
    h = F.aggregate(F.transform(words, _times_factor), F.lit(_SEED).bitwiseXOR(size),
                    lambda a, w: _times_factor(a).bitwiseXOR(w))
    left = size % 4
    tail = F.rpad(F.right(digits, (left * 2).cast("int")), 8, "0")
    h = F.when(left == 0, h).otherwise(_with_value(
        h.bitwiseXOR(_little_endian(tail)), _times_factor))
    h = _with_value(h, lambda x: x.bitwiseXOR(F.shiftright(x, 13)))
    h = _with_value(h, _times_factor)
    return _with_value(h, lambda x: x.bitwiseXOR(F.shiftright(x, 15)))


def keyed_partition(key, num_partitions: int) -> Column:
    """The topic partition that a keyed producer's default partitioner sends a key to:
    murmur2 without its sign bit, modulo the number of partitions. All messages of a key
    share one, in whatever topic of that many partitions. NULL for a missing key (a producer
    may choose any partition for those)."""
    return (murmur2(key).bitwiseAND(F.lit(0x7FFFFFFF)) % num_partitions).cast("int")


def age_millis(as_of, last_update) -> Column:
    """as_of minus last_update in whole milliseconds (NULL if never updated)."""
    return epoch_millis(as_of) - epoch_millis(last_update)


def is_fresh(as_of, last_update, limit_minutes: float) -> Column:
    """Strictly younger than the limit; a missing update is never fresh; a
    future update (negative age) is fresh."""
    limit_ms = int(round(limit_minutes * 60_000))
    return F.coalesce(age_millis(as_of, last_update) < F.lit(limit_ms), F.lit(False))


def age_seconds(as_of, last_update) -> Column:
    """Age rounded half up to whole seconds (JavaScript ``Math.round``),
    negatives included; NULL when never updated."""
    return F.floor((age_millis(as_of, last_update) + F.lit(500)) / F.lit(1000)).cast("long")


def freshness_status(missing: list[Column], fresh: list[Column]) -> Column:
    """DELAYED if any component is missing, else PARTIAL if any is stale,
    else LIVE."""
    any_missing = missing[0]
    for m in missing[1:]:
        any_missing = any_missing | m
    all_fresh = fresh[0]
    for f in fresh[1:]:
        all_fresh = all_fresh & f
    return (F.when(any_missing, F.lit("DELAYED"))
            .when(~all_fresh, F.lit("PARTIAL"))
            .otherwise(F.lit("LIVE")))
