"""Times: text to timestamp, fixed instants, and the forms results use."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def event_timestamp(text: Column | str) -> Column:
    """ISO text without a zone, read in the session zone; malformed gives null."""
    column = F.col(text) if isinstance(text, str) else text
    return column.try_cast("timestamp")


def instant(moment: datetime) -> Column:
    """A literal that does not depend on the zone of the driver's machine. A
    datetime without a zone means UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.lit(moment.isoformat()).cast("timestamp")


def utc_date(time: Column | str) -> Column:
    """The date of an instant in UTC. Folders are named by it, so it must not
    depend on the zone of the session that reads or writes them."""
    column = F.col(time) if isinstance(time, str) else time
    days = F.floor(F.unix_seconds(column) / 86_400)
    return F.date_from_unix_date(days.cast("int"))


def zoneless_times(df: DataFrame) -> DataFrame:
    """Timestamps as local date-times, for readers that know no time zones."""
    return df.select(
        *(
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )
