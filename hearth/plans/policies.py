"""Transform policies of the clean pipeline (the knobs of the ingest job)."""

from __future__ import annotations

from dataclasses import dataclass

from hearth.schema import ZIPCODE_PATTERN

BUILD_YEAR_POLICIES = ("adjust", "drop")
CHANGE_DATE_POLICIES = ("adjust", "drop")


@dataclass(frozen=True)
class TransformPolicy:
    """Switches of the clean pipeline; defaults are the shipped job settings."""

    date_as_unixtime: bool = True
    normalize_enum: bool = True
    enforce_non_negative: bool = True
    drop_invalid_zipcode: bool = True
    normalize_two_digits_zc: bool = True
    zipcode_regex: str = ZIPCODE_PATTERN
    adjust_build_year_policy: str = "adjust"
    adjust_change_date_policy: str = "adjust"
    deduplicate: bool = True
    on_bad_cast: str = "fail"

    def __post_init__(self) -> None:
        check_policy("build year", self.adjust_build_year_policy, BUILD_YEAR_POLICIES)
        check_policy("change date", self.adjust_change_date_policy, CHANGE_DATE_POLICIES)
        if self.on_bad_cast not in ("fail", "null"):
            raise ValueError(f"unknown on_bad_cast policy: {self.on_bad_cast!r}")


def check_policy(what: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"unknown {what} policy: {value!r} (expected one of {allowed})")
