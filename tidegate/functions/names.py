"""Identifier rules as Column expressions (and the same rules for schema names)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters an identifier may not hold, in order, and what each of
# the first seven becomes; the remaining three are dropped.
FORBIDDEN = " {}()\t=,;\n"
REPLACEMENTS = "_[][]_-"

_EDGE_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_name(c: Column | str) -> Column:
    """Column-level identifier: trimmed, forbidden characters replaced or dropped."""
    return F.translate(F.regexp_replace(_col(c), _EDGE_SPACE, ""), FORBIDDEN, REPLACEMENTS)


def clean_major_name(c: Column | str) -> Column:
    """Database or table identifier: as `clean_name`, and no hyphens."""
    return F.translate(clean_name(c), "-", "_")


def qualified_name(database: Column | str, table: Column | str) -> Column:
    return F.concat_ws(".", clean_major_name(database), clean_name(table))


def clean_label(raw: str) -> str:
    """`clean_name` for one schema field name, known on the driver."""
    kept = str.maketrans(FORBIDDEN[: len(REPLACEMENTS)], REPLACEMENTS, FORBIDDEN[len(REPLACEMENTS):])
    return raw.strip().translate(kept)


def clean_major_label(raw: str) -> str:
    return clean_label(raw).replace("-", "_")


def with_clean_columns(df: DataFrame) -> DataFrame:
    """Rename every column of a frame to its clean form."""
    return df.withColumnsRenamed({c: clean_label(c) for c in df.columns if clean_label(c) != c})


def key_list(keys: str | list[str] | tuple[str, ...]) -> list[str]:
    """Key columns from a list or a comma separated string, cleaned."""
    parts = keys.split(",") if isinstance(keys, str) else list(keys)
    return [clean_label(p) for p in parts if p.strip()]


def staged_id(table: Column | str, file_hash: Column | str, increment: Column | str | int = 0) -> Column:
    """Identity of one staged attempt: table, hash (minus written as m), attempt."""
    step = F.lit(increment) if isinstance(increment, int) else _col(increment)
    base = F.concat(
        clean_major_name(table), F.lit("_"), F.translate(_col(file_hash).cast("string"), "-", "m")
    )
    return F.when(step > 0, F.concat(base, F.lit("_"), step.cast("string"))).otherwise(base)


def review_id(table: Column | str, file_hash: Column | str, increment: Column | str | int = 0) -> Column:
    """Identity of the quarantine that belongs to an attempt: the next attempt."""
    step = F.lit(increment) if isinstance(increment, int) else _col(increment)
    return staged_id(table, file_hash, step + F.lit(1))


def node_id(kind: Column | str, project: Column | str, schema: Column | str, table: Column | str) -> Column:
    """Lineage node identity; sources carry their schema, models do not."""
    kind, project, schema, table = _col(kind), _col(project), _col(schema), _col(table)
    return (
        F.when(kind == "source", F.concat_ws(".", kind, project, schema, table))
        .when(kind == "model", F.concat_ws(".", kind, project, table))
        .otherwise(F.raise_error(F.concat(F.lit("unknown node kind: "), kind)))
    )
