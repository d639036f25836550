"""Names that tests import; ``conftest`` is no module to import from, as a folder below may have its own."""

import datetime as dt

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def ts(s):
    """'2024-01-02' or '2024-01-02 03:04:05' -> datetime (None passes)."""
    return None if s is None else dt.datetime.fromisoformat(s)
