"""Employees open in the change history but absent from the latest snapshot."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quincena.operators.cdc import END_AT, START_AT
from quincena.schemas import SCD2_KEYS, SCD2_TRACKED, SNAPSHOT

# A person is present where the snapshot has them in the same position and status, in whatever institution.
PRESENCE_KEYS = [k for k in SCD2_KEYS if k != "institucion"]


def inactive_employees(history: DataFrame, snapshot: DataFrame,
                       detected_at: _dt.datetime | None = None) -> DataFrame:
    """Open history versions with no snapshot row on ``PRESENCE_KEYS``.
    Institution is not a key: a person who left one institution but holds the
    same position and status elsewhere is not flagged. A NULL in any key never
    matches, so such versions are always flagged. ``detected_at`` is a
    wall-clock time (the session's, unless one is given).

    The snapshot side is reduced to distinct keys first; the aggregate and the
    anti join share one hash partitioning on the keys, and AQE broadcasts the
    keys instead when their measured bytes are below its threshold. History
    keys are unique per open version, so no key is hot on that side.
    """
    name_of = {bronze: name for name, bronze in SNAPSHOT.items()}
    present = snapshot.select(*[F.col(name_of[k]).alias(k) for k in PRESENCE_KEYS]).distinct()
    now = F.localtimestamp() if detected_at is None else F.lit(detected_at).cast("timestamp_ntz")
    gone = history.where(F.col(END_AT).isNull()).join(present, PRESENCE_KEYS, "left_anti")
    return gone.select(*SCD2_KEYS, *SCD2_TRACKED, F.col(START_AT).alias("last_active_date"), now.alias("detected_at"))
