"""Field plan: encrypt, decrypt and hash columns in order."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from flowtables.functions import crypto
from flowtables.functions.once import with_columns_once
from flowtables.operators import quarantine

# --- fixed values: operation names of a field plan ----------------------------
ENCRYPT, DECRYPT, HASH = "encrypt", "decrypt", "hash"
# ------------------------------------------------------------------------------


def parse_plan(plan: str | Sequence[dict]) -> list[dict]:
    """A plan is a JSON list, or a list, of ``{field, secret, operation}``."""
    steps = json.loads(plan) if isinstance(plan, str) else list(plan)
    for step in steps:
        if set(step) != {"field", "secret", "operation"}:
            raise ValueError("each step has field, secret and operation")
    return steps


def apply_plan(df: DataFrame, plan: str | Sequence[dict], iv: str | None = None) -> DataFrame:
    """Apply the steps in order; a field may appear more than once.

    A field is turned into text first. An unknown operation changes nothing. A
    row whose field is null, or does not decrypt, keeps its values and gets an
    ``_error``; see :func:`flowtables.operators.quarantine.split`.
    """
    iv_bytes = crypto.parse_iv(iv)
    values: dict[str, Column] = {}
    error = F.lit(None).cast("string")
    for step in parse_plan(plan):
        name, secret, operation = step["field"], step["secret"], step["operation"]
        if operation not in (ENCRYPT, DECRYPT, HASH):
            continue
        if name not in df.columns:
            raise ValueError(f"no such field: {name}")
        text = values.get(name, F.col(name).cast("string"))
        if operation == ENCRYPT:
            changed = crypto.encrypt(text, secret, iv_bytes)
        elif operation == DECRYPT:
            changed = crypto.decrypt(text, secret, iv_bytes)
        else:
            changed = crypto.keyed_hash(text, secret)
        error = F.coalesce(error, F.when(changed.isNull(), F.lit(f"{operation} failed for field {name}")))
        values[name] = changed
    tried = with_columns_once(df, {**{f"_new_{n}": c for n, c in values.items()}, quarantine.ERROR: error})
    good = F.col(quarantine.ERROR).isNull()
    out = [
        F.when(good, F.col(f"_new_{n}")).otherwise(F.col(n).cast("string")).alias(n) if n in values else F.col(n)
        for n in df.columns
    ]
    return tried.select(*out, quarantine.ERROR)
