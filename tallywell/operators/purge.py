"""Move rows that break the key contract from the clean table to quarantine."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.operators.identity import with_identity
from tallywell.operators.keyed import delete_rows
from tallywell.operators.validate import DEFAULT_POLICY, Policy, key_contract_breach
from tallywell.schemas import ORIGIN_FIELDS, PENDING_SCHEMA

# A NULL or blank day; goes through text, so a day kept as a string is tested alike.
NO_DAY = "revenue_date IS NULL OR trim(cast(revenue_date AS string)) = ''"


def anomalies(silver: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    """Clean-table rows that belong in quarantine, in its layout and opened as PENDING."""
    bad = silver.filter(key_contract_breach(policy)).withColumn("_status", F.lit("PENDING"))
    bad = bad.withColumns({name: F.lit(None).cast("string") for name in ORIGIN_FIELDS})
    return with_identity(bad).select(*PENDING_SCHEMA.fieldNames())


def without_anomalies(silver: DataFrame, policy: Policy = DEFAULT_POLICY) -> DataFrame:
    return delete_rows(silver, key_contract_breach(policy))


def without_blank_days(daily: DataFrame) -> DataFrame:
    return delete_rows(daily, NO_DAY)
