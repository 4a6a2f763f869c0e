"""Irregular-whitespace telemetry text to typed columns, and multi-file fleet loads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.constants import TELEMETRY_COLUMNS
from wearline.functions.columns import as_list

KEY_COLUMNS = ["unit", "cycle"]


# A number as text: no suffix for a type, as Spark's cast would take ("1.0d", "2f").
NUMBER = r"^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?|[nN][aA][nN]|[iI]nf(?:inity)?)$"


#: A whole number written without a point or an exponent, which is read without a detour.
WHOLE = r"^[+-]?\d+$"


def _number(token: Column) -> Column:
    return F.when(token.rlike(NUMBER), token.try_cast("double"))


def _key(token: Column) -> Column:
    """A whole number: digits exactly, other spellings (``1.0``, ``1e3``) through a double.

    Doubles hold every whole number up to 2**53; beyond, such a spelling names no key for certain
    and gives NULL, as digits beyond 64 bits do.
    """
    d = _number(token)
    spelled = F.when((d == F.floor(d)) & (F.abs(d) <= F.lit(float(2**53))), d.try_cast("bigint"))
    return F.when(token.rlike(WHOLE), token.try_cast("bigint")).otherwise(spelled)


def parse_lines(lines: DataFrame, value: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """Parse every non-blank line; a NULL ``error`` marks a good row.

    Leading and trailing whitespace of any kind (tabs included) is stripped before the split,
    and every field is read with ``try_cast`` so a bad line never fails the job. Errors:
    ``field_count`` (not 26 fields), ``bad_number`` (a field that is not a number),
    ``bad_key`` (unit or cycle missing or not whole).
    """
    keep = as_list(keep)
    n = len(TELEMETRY_COLUMNS)
    # Tokens are the runs of non-whitespace, so leading/trailing spaces and tabs need no trim.
    tokens = F.regexp_extract_all(F.col(value), F.lit(r"(\S+)"), 1)
    # One tokenisation per line behind a generator: a later filter on the parsed fields is
    # pushed down only to here, instead of re-running the regex for every field it reads.
    staged = lines.select(*keep, F.col(value).alias("_line"), F.explode(F.array(tokens)).alias("_tok"))
    staged = staged.filter(F.size("_tok") > 0)
    # Each token is cast once, in its own projection; the fields and the error flags below
    # read those columns, which keeps the generated code small enough to stay compiled.
    staged = staged.select(
        *keep, "_line", F.size("_tok").alias("_n"),
        *[F.get(F.col("_tok"), i).isNotNull().alias(f"_p{i}") for i in range(n)],
        *[(_key if c in KEY_COLUMNS else _number)(F.get(F.col("_tok"), i)).alias(f"_d{i}") for i, c in enumerate(TELEMETRY_COLUMNS)],
    )
    fields: list[Column] = []
    any_bad = F.lit(False)
    for i, name in enumerate(TELEMETRY_COLUMNS):
        d = F.col(f"_d{i}")
        if name in KEY_COLUMNS:
            fields.append(d.alias(name))
        else:
            fields.append(F.nanvl(d, F.lit(None).cast("double")).alias(name))
            # "nan" is a number; any other token that fails to cast is not
            any_bad = any_bad | (F.col(f"_p{i}") & d.isNull())
    key_bad = F.col("_d0").isNull() | F.col("_d1").isNull()
    error = (
        F.when(F.col("_n") != n, F.lit("field_count"))
        .when(any_bad, F.lit("bad_number"))
        .when(key_bad, F.lit("bad_key"))
    )
    # The parsed row leaves through a generator: its outputs are plain attributes, so plans
    # built on top (labels, windows, joins) do not carry 26 field expressions into the
    # optimizer's constraint inference, which otherwise grows with every reuse of the input.
    # only a rejected row keeps its line
    packed = F.struct(*fields, error.alias("error"), F.when(error.isNotNull(), F.col("_line")).alias("line"))
    return staged.select(*keep, F.inline(F.array(packed)))


def parse_telemetry(lines: DataFrame, value: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """S1 + P1: good rows only, as ``unit, cycle bigint, op_setting_1..3, sensor_1..21 double``."""
    return parse_lines(lines, value, keep).filter(F.col("error").isNull()).drop("error", "line")


def malformed_lines(lines: DataFrame, value: str = "value", keep: Iterable[str] = ()) -> DataFrame:
    """The quarantine side of S1: the raw line and why it was rejected."""
    return parse_lines(lines, value, keep).filter(F.col("error").isNotNull()).select(*as_list(keep), "line", "error")


def fleet_key(df: DataFrame, dataset: str = "dataset", unit: str = "unit", out: str = "fleet_unit") -> DataFrame:
    """``<dataset>_<unit>``; rows without a unit are dropped first so they cannot collide."""
    df = df.filter(F.col(unit).isNotNull() & F.col(dataset).isNotNull())
    return df.withColumn(out, F.concat_ws("_", F.col(dataset), F.col(unit).cast("bigint").cast("string")))


def tag_dataset(df: DataFrame, tag: str, out: str = "dataset") -> DataFrame:
    """A constant dataset tag."""
    return df.withColumn(out, F.lit(tag))


def read_fleet(spark: SparkSession, paths: str | list[str], pattern: str = r"(FD\d+)") -> DataFrame:
    """One text scan over every file; the dataset tag comes from each file's name.

    Replaces one read per file plus a chain of unions; the tag is ``pattern`` found in the
    file's name, or else in its path (for datasets laid out as folders of part files), or else
    the file's name without its extension, so units of different files never merge.
    """
    parsed = parse_telemetry(fleet_lines(spark, paths, pattern), keep=["dataset"])
    return fleet_key(parsed.select(*TELEMETRY_COLUMNS, "dataset"))


def fleet_lines(spark: SparkSession, paths: str | list[str], pattern: str = r"(FD\d+)") -> DataFrame:
    """``value, dataset``: the lines of every file with their dataset's tag."""
    found = [F.nullif(F.regexp_extract(F.col(f"_metadata.{c}"), pattern, 1), F.lit("")) for c in ("file_name", "file_path")]
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "")
    return spark.read.text(paths).select("value", F.coalesce(*found, stem).alias("dataset"))


def land_lines(lines: DataFrame, good_path: str, bad_path: str, keep: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Parse once: good rows and quarantined lines as Parquet, both read back.

    One job parses every line and writes the table, partitioned by whether the line is good;
    whatever reads the telemetry afterwards reads columns and never parses text again.
    """
    spark = lines.sparkSession
    parsed = parse_lines(lines, keep=keep).withColumn("good", F.col("error").isNull())
    parsed.write.partitionBy("good").parquet(good_path)
    whole = spark.read.schema(parsed.schema).parquet(good_path)
    bad = whole.filter("NOT good").select(*as_list(keep), "line", "error")
    bad.write.parquet(bad_path)
    return whole.filter("good").drop("good", "error", "line"), spark.read.schema(bad.schema).parquet(bad_path)


def read_telemetry(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One text file (or glob) of telemetry lines, parsed."""
    return parse_telemetry(spark.read.text(paths))


def union_fleet(*dfs: DataFrame) -> DataFrame:
    """Union by column name, duplicates kept."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out
