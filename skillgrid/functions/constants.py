"""Constants the results depend on.

The skill taxonomy itself is in ``taxonomy.py``.
"""

from __future__ import annotations

# --- Fixed values: must equal the original build for identical results. ---
SNIPPET_CHARS = 400  # description snippet length, in characters
SAMPLES_PER_SKILL = 20  # QA samples kept per skill
QA_TOP = 30  # rows shown from the QA summary
REGEX_TOP = 30  # top skills printed after regex extraction
LABEL_TOP = 20  # top provided labels printed
CATALOGUE_TOP = 100  # catalogue rows printed
MONTHLY_TOP = 30  # top skills by summed monthly mentions
MONTHLY_SAMPLE = 20  # newest monthly rows printed
LONGITUDE_BOUNDS = (10.0, 25.0)  # inclusive
LATITUDE_BOUNDS = (55.0, 70.0)  # inclusive
UNKNOWN_REGION = "Unknown"  # fill for a NULL region
UNKNOWN_REGION_CODE = "unknown"  # fill for a NULL region code
RADIUS_BASE = 3_000.0  # map bubble radius = base + value / max * span
RADIUS_SPAN = 35_000.0
REGEX_SOURCE = "regex"  # skill_source of taxonomy matches
LABEL_SOURCE = "ams"  # skill_source of provided labels
