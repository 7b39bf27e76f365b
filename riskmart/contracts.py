"""Declared column contracts of the two source tracks.

Nothing is inferred from data: headers, limits and decimal shapes are fixed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

REASON_LIMIT = 2048


@dataclass(frozen=True)
class SourceContract:
    """Header, encoding rules and failure policy of one CSV source."""

    name: str
    columns: tuple[str, ...]
    policy: str  # "quarantine" keeps bad rows aside, "fail_fast" aborts the file

    def csv_schema(self) -> T.StructType:
        fields = [T.StructField(c, T.StringType()) for c in self.columns]
        return T.StructType([*fields, T.StructField("_corrupt_record", T.StringType())])


# Headers, text limits and decimal shapes of the published sources.
MARKET_COLUMNS = (
    "company_code",
    "company_name",
    "year_month",
    "product",
    "state",
    "premiums",
    "claims",
    "claim_premium_ratio",
)
MARKET_TEXT_LIMITS = {"company_name": 116, "product": 42, "state": 2}
MARKET_DECIMALS = ("premiums", "claims", "claim_premium_ratio")
MARKET_GRAIN = ("company_code", "year_month", "product", "state")

RISK_TEXT_LIMITS = {
    "Gender": 20,
    "DrivAge": 20,
    "VehModel": 255,
    "VehGroup": 255,
    "Area": 100,
    "State": 100,
    "StateAb": 2,
}
RISK_DECIMALS = {
    "ExposTotal": (21, 17),
    "ExposFireRob": (19, 6),
    "PremTotal": (34, 27),
    "PremFireRob": (19, 6),
    "SumInsAvg": (19, 6),
    "ClaimAmountRob": (19, 6),
    "ClaimAmountPartColl": (19, 6),
    "ClaimAmountTotColl": (19, 6),
    "ClaimAmountFire": (19, 6),
    "ClaimAmountOther": (19, 6),
}
CLAIM_CATEGORIES = ("Rob", "PartColl", "TotColl", "Fire", "Other")
RISK_COUNTS = tuple(f"ClaimNb{k}" for k in CLAIM_CATEGORIES)
RISK_COLUMNS = (
    "Gender",
    "DrivAge",
    "VehYear",
    "VehModel",
    "VehGroup",
    "Area",
    "State",
    "StateAb",
    "ExposTotal",
    "ExposFireRob",
    "PremTotal",
    "PremFireRob",
    "SumInsAvg",
    *RISK_COUNTS,
    *(f"ClaimAmount{k}" for k in CLAIM_CATEGORIES),
)

MARKET = SourceContract("market", MARKET_COLUMNS, "quarantine")
RISK = SourceContract("risk", RISK_COLUMNS, "fail_fast")

# Staging layouts: lineage columns plus typed source columns.
MARKET_STAGING_COLUMNS = (
    "batch_id",
    "source_file",
    "source_version",
    "source_row_number",
    "record_hash",
    "loaded_at",
    "company_code",
    "company_name",
    "year_month",
    "product",
    "state",
    "premiums_raw",
    "premiums",
    "claims_raw",
    "claims",
    "claim_premium_ratio_raw",
    "claim_premium_ratio",
)
RISK_STAGING_COLUMNS = (
    "batch_id", "source_file", "source_version", "source_row_number", "record_hash", "loaded_at", *RISK_COLUMNS,
)

# Label the marts give to a missing attribute, and its spelling in exports.
UNKNOWN_LABEL = "Không rõ"
UNKNOWN_EXPORT_LABEL = "Unknown"

# Missing-value spellings, snapshot version, threshold and bands of scores, sizes of the training population and its caps.
NULL_SENTINELS = ("", "NA", "N/A", "NULL")
SNAPSHOT_SCHEMA_VERSION = 1
SCORE_THRESHOLD = 0.5
SCORE_BANDS = 20
POSITIVE_GROUP_QUOTA = 18_474
NEGATIVE_GROUP_QUOTA = 81_526
TRAIN_CAPS = (4_000, 24_000, 60_000)
