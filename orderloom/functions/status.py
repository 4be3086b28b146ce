"""Status texts of the jobs."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class JobStatus:
    """What a job reports. An error is reported, not raised; ``ok`` tells the two apart."""

    ok: bool
    message: str
    rows: int = 0


# Wording and letter case of the two jobs differ.
def rows_affected(rows: int) -> JobStatus:
    return JobStatus(True, f"Load Completed. {rows} rows affected.", rows)


def rows_inserted(rows: int) -> JobStatus:
    return JobStatus(True, f"Load completed. {rows} rows inserted.", rows)


def failed(error: Exception) -> JobStatus:
    return JobStatus(False, f"Load failed with error message: {error}")
