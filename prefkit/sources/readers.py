"""Readers for the ratings and items files, and for the same records held in a text column.

The files are headerless lines (``user_id,item_id,rating,ts`` and ``item_id,title,genres``). Titles
may be double-quoted, with ``""`` for a quote inside a title, or may hold commas unquoted: the title
is then everything between the first and the last comma (rule D3, P3, P4). A missing genre field
is NULL (rule D4). No schema is inferred.

Lines that do not fit fail by default, as the reference's parsers do. With ``lenient=True`` they are
left out, and ``bad_rating_lines`` / ``bad_item_lines`` return them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prefkit import schemas as S

# Number formats of the files (surrounding spaces are trimmed).
_INTEGER = r"\A[+-]?[0-9]+\z"
_NUMBER = r"\A[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\z"
# First fields of header lines that ``header=True`` skips.
HEADER_NAMES = ("userId", "user_id", "movieId", "item_id")


def _typed(spark: SparkSession, path: str, schema, fmt: str) -> DataFrame:
    """A columnar / JSON source read with the fixed schema: only the schema's columns are
    read (pruned at the scan), and filters applied later push down to it."""
    return spark.read.schema(schema).format(fmt).load(path).select(*[f.name for f in schema.fields])


def _lines(spark: SparkSession, path: str, header: bool) -> DataFrame:
    lines = spark.read.text(path)
    if header:
        lines = lines.filter(~F.trim(F.substring_index("value", ",", 1)).isin(*HEADER_NAMES))
    return lines


def read_ratings(
    spark: SparkSession, path: str, header: bool = False, lenient: bool = False, fmt: str = "csv"
) -> DataFrame:
    """Scan ratings (S1). A CSV line must have exactly four fields, all of them numbers; otherwise the
    job fails, or skips the line if ``lenient``. Spaces around fields are trimmed, empty lines
    skipped. ``fmt='parquet'`` (or ``orc``, ``json``) reads a table with the ratings columns."""
    if fmt != "csv":
        return _typed(spark, path, S.RATINGS, fmt)
    return parse_ratings(_lines(spark, path, header), lenient=lenient)


def read_personal_ratings(spark: SparkSession, path: str, header: bool = False, fmt: str = "csv") -> DataFrame:
    """The target user's ratings file (S3): same layout and reader as S1, read from a shared
    (distributed) path, failing loudly rather than returning a partial list."""
    return read_ratings(spark, path, header=header, fmt=fmt)


def read_items(
    spark: SparkSession, path: str, header: bool = False, lenient: bool = False, fmt: str = "csv"
) -> DataFrame:
    """Scan items (S2); see ``parse_items`` for what a line may look like."""
    if fmt != "csv":
        return _typed(spark, path, S.ITEMS, fmt)
    return parse_items(_lines(spark, path, header), lenient=lenient)


def _checked(df: DataFrame, good: Column, value: str, what: str, lenient: bool) -> DataFrame:
    """The rows of ``df`` for which ``good`` holds; others fail the job unless ``lenient``. Empty lines
    are no records."""
    df = df.filter(F.length(F.trim(F.col(value))) > 0)
    if lenient:
        return df.filter(good)
    message = F.concat(F.lit(f"malformed {what} line: "), F.col(value))
    return df.filter(F.when(good, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def _rating_fields(value: str) -> tuple[list[Column], Column]:
    fields = F.transform(F.split(F.col(value), ",", -1), lambda x: F.trim(x))
    parts = [F.get(fields, F.lit(i)) for i in range(4)]
    good = F.size(fields) == 4
    for part, pattern in zip(parts, (_INTEGER, _INTEGER, _NUMBER, _INTEGER)):
        good = good & part.rlike(pattern)
    for part, kind in zip(parts, ("bigint", "bigint", "double", "bigint")):
        good = good & part.try_cast(kind).isNotNull()
    return parts, F.coalesce(good, F.lit(False))


def parse_ratings(
    df: DataFrame, value: str = "value", keep: list[str] | None = None, lenient: bool = False
) -> DataFrame:
    """Parse a text column holding ratings lines into typed columns (S1, P1 on a string column)."""
    parts, good = _rating_fields(value)
    rows = _checked(df, good, value, "ratings", lenient)
    names, kinds = (S.USER, S.ITEM, S.RATING, S.TS), ("bigint", "bigint", "double", "bigint")
    typed = [p.try_cast(k).alias(n) for p, k, n in zip(parts, kinds, names)]
    return rows.select(*(keep or []), *typed)


def bad_rating_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """The lines that ``parse_ratings`` would not take."""
    _, good = _rating_fields(value)
    return df.filter((F.length(F.trim(F.col(value))) > 0) & ~good)


def _item_fields(value: str) -> tuple[list[Column], Column]:
    v = F.trim(F.col(value))
    quoted = v.rlike(r'\A[^,]*,\s*"')
    # id, quoted title with doubled quotes, and the genres or nothing.
    pattern = r'(?s)\A([^,]*),\s*"((?:[^"]++|"")*+)"\s*(?:,(.*))?\z'
    first = F.substring_index(v, ",", 1)
    rest = F.substr(v, F.length(first) + 2)
    last = F.substring_index(rest, ",", -1)
    commas = F.length(v) - F.length(F.replace(v, F.lit(","), F.lit("")))
    title = F.when(commas > 1, F.left(rest, F.length(rest) - F.length(last) - 1)).otherwise(rest)
    q_title = F.replace(F.regexp_extract(v, pattern, 2), F.lit('""'), F.lit('"'))
    q_genres = F.regexp_replace(F.trim(F.regexp_extract(v, pattern, 3)), r'\A"(.*)"\z', "$1")
    fields = [
        F.trim(first),
        F.when(quoted, q_title).otherwise(title),
        F.nullif(F.when(quoted, q_genres).when(commas > 1, last), F.lit("")),
    ]
    good = (commas > 0) & fields[0].rlike(_INTEGER) & fields[0].try_cast("bigint").isNotNull()
    good = good & (~quoted | (v.rlike(pattern) & ~q_genres.contains(",")))
    return fields, F.coalesce(good, F.lit(False))


def parse_items(
    df: DataFrame, value: str = "value", keep: list[str] | None = None, lenient: bool = False
) -> DataFrame:
    """Parse a text column holding items lines into typed columns (S2 on a string column).

    A line whose title is quoted has an id, the title, and at most one field of genres. Of any other
    line the id is the text before the first comma, the genres the text after the last one, and the
    title everything between (``8,Harbour, The (2001),Crime|Drama``; P3, P4); with a single comma
    there is no genre field. No genre field, or an empty one, gives NULL genres.
    """
    fields, good = _item_fields(value)
    rows = _checked(df, good, value, "items", lenient)
    item, title, genres = fields
    return rows.select(
        *(keep or []), item.try_cast("bigint").alias(S.ITEM), title.alias(S.TITLE), genres.alias(S.GENRES)
    )


def bad_item_lines(df: DataFrame, value: str = "value") -> DataFrame:
    """The lines that ``parse_items`` would not take."""
    _, good = _item_fields(value)
    return df.filter((F.length(F.trim(F.col(value))) > 0) & ~good)


def preferences_from_responses(
    responses: DataFrame,
    user_id: int = 0,
    ts: int | Column = 0,
    item_col: str = S.ITEM,
    response_col: str = "response",
    max_rating: int = 5,
) -> DataFrame:
    """Turn raw survey answers into the target user's ratings.

    An answer counts only if it is all ASCII digits (so ``' 5 '`` and ``'x'`` are rejected) and
    its value is 1..max_rating; 0 means "not seen" and is dropped. Every kept row is stamped
    with ``user_id`` and one timestamp ``ts``.
    """
    value = F.expr(f"try_cast(`{response_col}` AS BIGINT)")
    ts_col = ts if isinstance(ts, Column) else F.lit(ts).cast("bigint")
    return (
        responses.filter(F.col(response_col).rlike(r"\A[0-9]+\z"))
        .withColumn("_v", value)
        .filter(F.col("_v").between(1, max_rating))
        .select(
            F.lit(user_id).cast("bigint").alias(S.USER),
            F.col(item_col).cast("bigint").alias(S.ITEM),
            F.col("_v").cast("double").alias(S.RATING),
            ts_col.alias(S.TS),
        )
    )
