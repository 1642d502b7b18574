"""Three-hour forecast slots and minutes of the day, as SQL expressions of a column name.

Times are wall-clock UTC. Everything is computed on ``timestamp_ntz``, so the session time zone
and its daylight-saving gaps have no influence.
"""

from __future__ import annotations


def slot_3hr(name: str) -> str:
    """Key of the nearest forecast slot, judged by the hour alone; ``''`` when the time is missing.

    Hour h belongs to slot 3 * ((h + 1) div 3): minutes are ignored and 23 h is midnight of the
    next calendar day. Takes a timestamp or text that starts like ``YYYY-MM-DD HH:MM``.
    """
    at = f"TRY_CAST(`{name}` AS TIMESTAMP_NTZ)"
    next_hour = f"(hour({at}) + 1)"
    day = f"date_add(CAST({at} AS DATE), CAST({next_hour} DIV 24 AS INT))"
    slot_hour = f"lpad(CAST(3 * ({next_hour} DIV 3) % 24 AS STRING), 2, '0')"
    # Formatting a date and an hour costs far less than formatting a timestamp.
    return f"coalesce(concat(CAST({day} AS STRING), ' ', {slot_hour}, ':00:00'), '')"


def slot_3hr_compat(name: str) -> str:
    """The slot as pure text arithmetic, for comparing with keys that were made that way.

    A recomputed hour is not zero-padded and 23 h only raises the day number (no padding, no
    month end), so such keys miss the forecast's padded ones.
    """
    text = f"CAST(`{name}` AS STRING)"
    hour = f"TRY_CAST(substring({text}, 12, 2) AS INT)"
    day = f"TRY_CAST(substring({text}, 9, 2) AS INT)"
    return f"""coalesce(concat(
      CASE WHEN {hour} = 23 THEN concat(substring({text}, 1, 8), CAST({day} + 1 AS STRING), ' 00')
           WHEN {hour} % 3 = 0 THEN substring({text}, 1, 13)
           ELSE concat(substring({text}, 1, 11), CAST(3 * (({hour} + 1) DIV 3) AS STRING)) END,
      ':00:00'), '')"""


def minutes_of_day(name: str) -> str:
    """Minutes since midnight of a timestamp as a double; 0 when missing."""
    return f"coalesce(CAST(hour(`{name}`) * 60 + minute(`{name}`) AS DOUBLE), 0D)"


def minutes_of_day_text(name: str) -> str:
    """The same from text that starts like ``YYYY-MM-DD HH:MM``; 0 when missing or malformed."""
    hours = f"TRY_CAST(substring(`{name}`, 12, 2) AS DOUBLE)"
    minutes = f"TRY_CAST(substring(`{name}`, 15, 2) AS DOUBLE)"
    return f"coalesce({hours} * 60 + {minutes}, 0D)"
