"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

# words of the byte-level contracts: everything but space and \t \n \v \f \r
SPACE_BYTES = b" \t\n\x0b\x0c\r"

ROWS_PER_TASK = 50_000      # of a few numbers each
LEAST_TASKS = 8


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage in the shared checkpoint folder.

    The rows are written by ``DataFrame.checkpoint`` below the folder named by
    ``spark.checkpoint.dir`` (see ``tessera.session.checkpoint_dir``), so a lost
    executor costs a re-read; Spark removes the files once the frame is gone.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def tasks_for(rows: int) -> int:
    """Tasks for so many rows of a few numbers each: to coalesce to, as each task of a shuffle leaves files."""
    return max(LEAST_TASKS, -(-rows // ROWS_PER_TASK))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n`` (the folds of the contracts)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def packed(docs: DataFrame, **extra: Column) -> DataFrame:
    """All columns of ``docs`` as one struct ``doc`` beside the given ones.

    ``select("doc.*")`` gives the rows back, so no name of ``docs`` can clash
    with a column that an operator adds.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return docs.select(whole, *[c.alias(name) for name, c in extra.items()])


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a whole row, 32 bytes: rows have the same one only if they are equal in every column.

    Each value is its text with its length before it, a null has a mark of its
    own; values that are no strings are written as JSON, to the microsecond.
    """
    def field(name: str, kind: str) -> Column:
        c = F.col(f"`{name}`")
        if kind == "binary":
            value = F.hex(c)
        elif kind in ("timestamp", "timestamp_ntz"):
            value = c.cast("string")
        elif kind == "string":
            value = c
        else:
            value = F.to_json(F.struct(c.alias("v")), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))

    fields = [field(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return F.unhex(F.sha2(F.concat(*fields).cast("binary"), 256))
