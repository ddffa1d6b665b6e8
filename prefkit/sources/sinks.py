"""Sinks: write a result table as files, one record per line (S6), and read it back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The escapes of the text layout (backslash first), and the field that stands for NULL.
ESCAPES = (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))
NULL_FIELD = "\\N"


def _escaped(c: Column, sep: str) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for raw, escape in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(escape))
    return c if sep == "\t" else F.replace(c, F.lit(sep), F.lit("\\s"))


def _restored(c: Column, sep: str) -> Column:
    """The parts between escaped backslashes hold no backslash but those of other escapes."""

    def part(x: Column) -> Column:
        for raw, escape in (*ESCAPES, (sep, "\\s")):
            x = F.replace(x, F.lit(escape), F.lit(raw))
        return x

    return F.array_join(F.transform(F.split(c, r"\\\\"), part), "\\")


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    sep: str = "\t",
    mode: str = "errorifexists",
    partition_by: list[str] | None = None,
) -> str:
    """Write ``df`` to ``path``. ``csv`` writes one delimited line per row (tab by default,
    the reference's text layout); ``parquet`` / ``json`` / ``orc`` keep types. Returns ``path``.

    The text layout is faithful: spaces stay, NULL is ``\\N``, an empty text an empty field, and line
    breaks, separators and backslashes inside a value are escaped (``\\n \\r \\t \\s \\\\``). An existing path is
    refused unless ``mode`` says otherwise. The write is distributed: each task writes its own part
    files; ``partition_by`` lays the output out in one folder per value (e.g. per genre or split) so
    later reads prune folders."""
    if len(sep) != 1 or sep in "\\\n\rnrtsN":
        raise ValueError(f"not a separator: {sep!r}")
    keys = partition_by or []
    if fmt == "csv":
        fields = [c for c in df.columns if c not in keys]
        text = [F.coalesce(_escaped(df[c].cast("string"), sep), F.lit(NULL_FIELD)) for c in fields]
        df = df.select(F.concat_ws(sep, *text).alias("value"), *keys)
    w = df.write.mode(mode)
    if keys:
        w = w.partitionBy(*keys)
    w.format("text" if fmt == "csv" else fmt).save(path)
    return path


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv", sep: str = "\t") -> DataFrame:
    """Read a table written by ``write_table`` with an explicit schema (no inference). A field that does
    not fit its type fails."""
    if fmt != "csv":
        return spark.read.schema(schema).format(fmt).load(path)
    fields = F.split("value", f"[{sep}]" if sep != "^" else r"\^")
    columns = []
    for i, f in enumerate(schema.fields):
        field = F.element_at(fields, i + 1)
        value = F.when(field != NULL_FIELD, _restored(field, sep))
        columns.append(value.cast(f.dataType).alias(f.name))
    return spark.read.text(path).select(*columns)
