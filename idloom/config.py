"""Pipeline options. Defaults reproduce the reference semantics."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class PipelineConfig:
    # Rank NULL timestamps first when picking the "latest" email row (the
    # reference warehouse sorts NULL as the largest value). "last" flips it.
    null_rank: str = "first"
    # "strict": a bad value fails the job (ANSI cast); "lenient": try_cast.
    cast_mode: str = "strict"
    # The MARKET branch of the observation map lists updated before created
    # and the union is positional, so the two land swapped. Keep by default.
    swap_market_dates: bool = True
    # Final ORDER BY of the timeline / spine views (a global range shuffle).
    ordered: bool = False
    # Ownership timeline: "buckets" (two levels of windows, the same plan at
    # every size) or "window" (Window.partitionBy(handle), to compare with).
    scan_strategy: str = "buckets"
    # Email dimension: "one_pass" (single aggregate) or "two_pass"
    # (aggregate + top-1 + join, as written in the reference).
    email_strategy: str = "one_pass"
    # Email key: "md5" (portable 128-bit hex) or "int64" (abs(xxhash64)).
    email_key_style: str = "md5"
    # Cleaning layer: ids are cast but not trimmed, so a blank id is a
    # "creator" in the email table. True turns blank ids into NULL there.
    blank_id_to_null: bool = False
    # External-id map: drop exact duplicate rows.
    dedupe_id_map: bool = False
    # Deployment environment for schema naming ("prod" upper-cases folders).
    env: str = "dev"
    base_schema: str = "analytics"

    def __post_init__(self):
        if self.null_rank not in ("first", "last"):
            raise ValueError(f"null_rank must be 'first' or 'last', got {self.null_rank!r}")
        if self.cast_mode not in ("strict", "lenient"):
            raise ValueError(f"cast_mode must be 'strict' or 'lenient', got {self.cast_mode!r}")
        if self.scan_strategy not in ("buckets", "window"):
            raise ValueError(f"unknown scan_strategy {self.scan_strategy!r}")
        if self.email_strategy not in ("one_pass", "two_pass"):
            raise ValueError(f"unknown email_strategy {self.email_strategy!r}")
        if self.email_key_style not in ("md5", "int64"):
            raise ValueError(f"unknown email_key_style {self.email_key_style!r}")
