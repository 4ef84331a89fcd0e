"""Reading an event log, and checking what was read."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from stayline.operators.clean import CORRUPT

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        T.StructField("sessionId", T.LongType()),
        T.StructField("page", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("registration", T.LongType()),
        T.StructField("level", T.StringType()),
        T.StructField("status", T.LongType()),
        T.StructField("gender", T.StringType()),
        T.StructField("location", T.StringType()),
    ]
)

LOG = "log"
FILE = "file"
FILE_PATH = "_metadata.file_path"


def read_events(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "json",
    schema: T.StructType | str | None = LOG,
    mapping: Mapping[str, str] | None = None,
    keep_corrupt: bool = False,
    keep_file: bool = False,
) -> DataFrame:
    """Scan a log of user actions.

    A given schema spares the pass over all files that inference costs; ``schema=None`` asks for
    inference. The default is the schema of an event log. ``mapping`` renames or computes columns,
    for logs that are laid out differently; the schema then is that of the source, and has to be
    given for JSON, while parquet files know their own.

    A malformed JSON line becomes a row with NULLs in what couldn't be read: all of it, or just one
    ill-typed field. ``keep_corrupt`` adds the line as ``_corrupt_record``, by which
    :func:`stayline.operators.quality_audit` counts such rows and
    :func:`stayline.operators.drop_invalid` can remove them; :func:`corrupt_lines` tells where they
    are. ``keep_file`` adds the path of the file a row comes from as ``file``.
    """
    reader = spark.read
    if isinstance(schema, str) and schema == LOG:
        if mapping and fmt == "json":
            raise ValueError("a mapped JSON log needs the schema of its source, or schema=None")
        schema = None if mapping else EVENT_SCHEMA
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if fmt == "json" and keep_corrupt and schema is not None:
        log = _with_corrupt_lines(reader.text(path), schema, keep_file)
    else:
        reader = reader if schema is None else reader.schema(schema)
        if fmt == "json":
            reader = reader.option("mode", "PERMISSIVE")
            if keep_corrupt:
                reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        log = reader.format(fmt).load(path)
        if keep_file:
            log = log.select("*", F.col(FILE_PATH).alias(FILE))
    if not mapping:
        return log
    kept = [CORRUPT] if keep_corrupt and CORRUPT in log.columns else []
    kept += [FILE] if keep_file else []
    return map_columns(log, mapping, kept)


def _parsed(schema: T.StructType) -> Column:
    """A line of text as a row, with the line itself where it is malformed."""
    whole = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def _with_corrupt_lines(lines: DataFrame, schema: T.StructType, keep_file: bool) -> DataFrame:
    """Lines parsed whole: a JSON scan would skip columns that a query doesn't need, and with them
    what is wrong in them."""
    file = [F.col(FILE_PATH).alias(FILE)] if keep_file else []
    filled = lines.where(F.trim("value") != "")
    return filled.select(_parsed(schema).alias("row"), *file).select("row.*", *[FILE] * keep_file)


def corrupt_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType = EVENT_SCHEMA
) -> DataFrame:
    """(file, line, record) of every malformed line of JSON logs; lines are counted from 1.

    A file is read in blocks by several tasks. A first pass counts the lines of each block, from
    which follow the lines before it; a second one parses, and adds the place in the block. Rows
    are numbered as they are scanned, and both passes cut the files into the same blocks. Blank
    lines count as lines, but are no malformed ones.
    """
    lines = spark.read.text(path).select(
        F.col(FILE_PATH).alias(FILE),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    blocks = lines.groupBy(FILE, "block").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy(FILE).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1
    offsets = blocks.select(FILE, "block", before.alias("offset"))
    parsed = lines.withColumn("record", _parsed(schema)[CORRUPT])
    corrupt = parsed.where(F.col("record").isNotNull() & (F.trim("value") != ""))
    line = (F.col("place") + F.col("offset")).alias("line")
    return corrupt.join(offsets, [FILE, "block"]).select(FILE, line, "record")


def map_columns(
    df: DataFrame, mapping: Mapping[str, str], kept: Sequence[str] = ()
) -> DataFrame:
    """Lay ``df`` out as an event log: log column -> SQL expression over ``df``."""
    types = {f.name: f.dataType for f in EVENT_SCHEMA}
    unknown = set(mapping) - set(types)
    if unknown:
        raise ValueError(f"not event log columns: {sorted(unknown)}")
    mapped = [F.expr(e).cast(types[name]).alias(name) for name, e in mapping.items()]
    return df.select(*mapped, *kept)


def require_columns(df: DataFrame, needed: Sequence[str] | T.StructType) -> DataFrame:
    """``df`` itself, or an error that names every missing or ill-typed column."""
    have = {f.name: f.dataType for f in df.schema}
    if isinstance(needed, T.StructType):
        wrong = [
            f"{f.name}: {have[f.name].simpleString()} instead of {f.dataType.simpleString()}"
            for f in needed
            if f.name in have and have[f.name] != f.dataType
        ]
        names = needed.fieldNames()
    else:
        wrong, names = [], list(needed)
    wrong += [f"{name}: missing" for name in names if name not in have]
    if wrong:
        raise ValueError("event log columns: " + "; ".join(wrong))
    return df


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: name, type, rows and NULLs, counted in one pass."""
    counts = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.col(f.name).isNull()).alias(f"null_{i}") for i, f in enumerate(df.schema)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col("n_rows"),
                F.col(f"null_{i}").alias("n_null"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    return counts.select(F.inline(rows))


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in a stated order; a top-k, not a full sort."""
    return df.orderBy(*order_by).limit(n)
