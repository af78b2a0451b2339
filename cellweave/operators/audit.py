"""Audit columns and run context."""

from __future__ import annotations

import getpass
import os
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampType

AUDIT_TYPES = {"created_at": TimestampType(), "created_by": StringType()}


def loader_user(environment: Mapping[str, str] | None = None) -> str:
    """First of LOADER_USER, USERNAME, USER that is set, then the system user, then ``unknown``."""
    env = os.environ if environment is None else environment
    named = next((env[k] for k in ("LOADER_USER", "USERNAME", "USER") if env.get(k)), None)
    if named:
        return named
    try:
        return getpass.getuser() or "unknown"
    except OSError:
        return "unknown"


def first_set(*candidates: Column) -> Column:
    """The first candidate that is neither null nor empty, else ``unknown``."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit("unknown"))


def run_id(prefix: str = "run-") -> str:
    """Prefix and eight hexadecimal digits, shared by everything done in a run."""
    return prefix + uuid.uuid4().hex[:8]


@dataclass(frozen=True)
class Run:
    """One value of each for the whole run, so that all its rows agree."""

    id: str = field(default_factory=run_id)
    at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    user: str = field(default_factory=loader_user)


def with_audit(df: DataFrame, run: Run) -> DataFrame:
    return df.withColumns(
        {
            "created_at": F.lit(run.at).cast(AUDIT_TYPES["created_at"]),
            "created_by": F.lit(run.user).cast(AUDIT_TYPES["created_by"]),
        }
    )
