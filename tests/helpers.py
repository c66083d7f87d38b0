import datetime as dt
from decimal import Decimal

from netcap.schemas import EVENT_SCHEMA, RECORD_SCHEMA

T0 = dt.datetime(2024, 1, 15, 10, 0, 0)


def ev(event_id, source_type, amount, fsp="FSP001", sector="BANKING", date="2024-01-15",
       at=T0, tx_date=None):
    return (event_id, source_type, fsp, sector, dt.date.fromisoformat(date),
            dt.date.fromisoformat(tx_date) if tx_date else None,
            None if amount is None else Decimal(str(amount)), at)


def events_df(spark, rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def records_df(spark, rows):
    """rows: (value, topic, offset, timestamp)."""
    full = [(None, v, t, 0, o, ts, None) for v, t, o, ts in rows]
    return spark.createDataFrame(full, RECORD_SCHEMA)
