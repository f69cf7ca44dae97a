"""Indicator rules for placeholder and test customers."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.plans.skew import measured_join

# Words and numbers that mark a made-up customer. Words match anywhere, numbers and dates only whole.
INDICATORS = {
    "email": ["test", "admin", "null", "spamtrap", "example", "private", "none", "xyz"],
    "phone": ["9876543210", "911", "411", "5550101234", "0", "0000000000"],
    "name": ["test", "demo", "sample", "null", "placeholder", "mickey", "mouse"],
    "dob": ["1900-01-01", "1/1/1900"],
    "address": ["123 test st", "unknown", "n/a", "null", "fake", "placeholder"],
    "zip": ["00000", "12345", "99999"],
    "company": ["test", "demo", "sample", "unknown", "n/a", "null"],
}

# Column names that can fill each customer role.
ROLE_NAMES = {
    "first_name": ["first", "firstname", "first_name"],
    "last_name": ["last", "lastname", "last_name"],
    "email": ["email"],
    "date_of_birth": ["dob", "date_of_birth"],
    "address": ["street_address", "address"],
    "zip_code": ["postal", "zip", "zip_code"],
    "company_name": ["company", "company_name"],
    "phone": ["phone", "phone_number"],
}

FLAGS = ["email_flag", "phone_flag", "name_flag", "dob_flag", "address_flag", "zip_flag", "company_flag"]
VALID_FLAGS = ["valid_name_flag", "valid_zip_flag"]
FEATURES = [*FLAGS, "synthetic_score"]
HYBRID_FEATURES = [*FLAGS, *VALID_FLAGS, "hybrid_score"]


def find_roles(columns: Sequence[str]) -> dict[str, str]:
    """Role -> first column, in file order, whose name fits it. Roles without a column are left out."""
    found = {}
    for role, names in ROLE_NAMES.items():
        for column in columns:
            if column.lower() in names:
                found[role] = column
                break
    return found


def role_columns(columns: Sequence[str], mapping: Mapping[str, str] | None = None) -> dict[str, Column]:
    """An expression for each of the eight roles; text if there is no such column is empty.

    ``mapping`` goes from column to role; without it, roles are found by name.
    """
    found = find_roles(columns) if mapping is None else {role: c for c, role in mapping.items() if c in columns}
    for role in ROLE_NAMES:
        if role not in found and role in columns:
            found[role] = role
    return {role: F.col(found[role]).cast("string") if role in found else F.lit("") for role in ROLE_NAMES}


def _contains(text: Column, kind: str) -> Column:
    return F.lower(text).rlike("|".join(re.escape(word) for word in INDICATORS[kind]))


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def flag_columns(roles: Mapping[str, Column]) -> dict[str, Column]:
    """Seven 0/1 flags. A NULL field is not suspicious."""
    return {
        "email_flag": _flag(_contains(roles["email"], "email")),
        "phone_flag": _flag(roles["phone"].isin(INDICATORS["phone"])),
        "name_flag": _flag(_contains(roles["first_name"], "name") | _contains(roles["last_name"], "name")),
        "dob_flag": _flag(roles["date_of_birth"].isin(INDICATORS["dob"])),
        "address_flag": _flag(_contains(roles["address"], "address")),
        "zip_flag": _flag(roles["zip_code"].isin(INDICATORS["zip"])),
        "company_flag": _flag(_contains(roles["company_name"], "company")),
    }


def total(names: Sequence[str]) -> Column:
    first, *rest = names
    out = F.col(first)
    for name in rest:
        out = out + F.col(name)
    return out


def with_flags(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Add the seven flags and their sum; columns of ``df`` keep their names."""
    flagged = df.select("*", *[c.alias(n) for n, c in flag_columns(role_columns(df.columns, mapping)).items()])
    return flagged.withColumn("synthetic_score", total(FLAGS))


def with_valid_flags(
    df: DataFrame, valid_names: DataFrame, valid_zips: DataFrame, mapping: Mapping[str, str] | None = None
) -> DataFrame:
    """Add flags for first names and ZIP codes found in the lists of valid ones, and the hybrid score.

    The lists are joined, not inlined, so they may grow; rows of a frequent name are spread over as
    many tasks as they need.
    """
    roles = role_columns(df.columns, mapping)
    names = valid_names.select(F.col(valid_names.columns[0]).alias("_name")).filter("_name IS NOT NULL").distinct()
    zips = valid_zips.select(F.col(valid_zips.columns[0]).alias("_zip")).filter("_zip IS NOT NULL").distinct()
    out = df.select("*", roles["first_name"].alias("_name"), roles["zip_code"].alias("_zip"))
    out = measured_join(out, names.withColumn("_name_ok", F.lit(True)), ["_name"], df.columns, "left")
    out = measured_join(out, zips.withColumn("_zip_ok", F.lit(True)), ["_zip"], df.columns, "left")
    flags = {"valid_name_flag": _flag(F.col("_name_ok")), "valid_zip_flag": _flag(F.col("_zip_ok"))}
    out = out.select(*df.columns, *[flag.alias(name) for name, flag in flags.items()])
    return out.withColumn("hybrid_score", total(VALID_FLAGS) - total(FLAGS))


def binary_label(label: Column, positive: str = "synthetic") -> Column:
    """Label 0 means a real customer. The positive class is 1; a NULL label counts as synthetic."""
    if positive == "synthetic":
        return F.when(label == 0, 0).otherwise(1)
    if positive == "real":
        return F.when(label == 0, 1).otherwise(0)
    raise ValueError("positive must be 'synthetic' or 'real'")


def real_mark(prediction: Column, positive: str = "synthetic") -> Column:
    if positive not in ("synthetic", "real"):
        raise ValueError("positive must be 'synthetic' or 'real'")
    return F.when(prediction == (0 if positive == "synthetic" else 1), "Y").otherwise("N")


def customer_score(confidence: Column) -> Column:
    """0.0 to 10.0, one decimal, halves up."""
    return F.round(confidence * 10.0, 1).cast("float")


def display_columns(confidence: Column) -> dict[str, Column]:
    """The texts a report shows: confidence with ten decimals, score with two."""
    return {
        "confidence_text": F.format_string("%.10f", confidence),
        "score_text": F.format_number(confidence * 10, 2),
    }
