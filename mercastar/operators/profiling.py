"""Table and column profiles, and source validation."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegralType,
    NumericType,
    TimestampNTZType,
    TimestampType,
)

from mercastar.fixed_values import SCORE_RANGE
from mercastar.functions.measures import rounded
from mercastar.operators.dedup import duplicate_rows
from mercastar.schemas import PRIMARY_KEYS

NON_NEGATIVE = ("price", "freight_value", "payment_value", "review_score")
NO_VALUE = "-"


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _short(text: F.Column) -> F.Column:
    """The text, or its md5 where that is shorter: equal for equal texts.

    Different long texts share a digest with a probability below n^2 / 2^129.
    """
    return F.when(F.octet_length(text) > 32, F.concat(F.lit("md5 "), F.md5(text.cast("binary")))).otherwise(text)


def _as_text(value: F.Column, kind: DataType) -> F.Column:
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    return value.cast("string")


BOUNDED = (NumericType, DateType, TimestampType, TimestampNTZType)
# A value is held in one of these; the others are NULL, and all are for a NULL.
HOLDERS = {"num": "bigint", "real": "double", "at": "timestamp_ntz", "text": "string"}
# Fields whose NULLs are told by the bits of one whole number.
WORD_BITS = 63
# Decimals of so few digits are whole multiples of their last digit, exactly, as doubles.
SHORT_DECIMAL = 15


def _held(value: F.Column, kind: DataType) -> tuple[str, F.Column]:
    """The holder of a column's values, and the values in it. Making texts of numbers is slow."""
    if isinstance(kind, IntegralType):
        return "num", value.cast("bigint")
    if isinstance(kind, DecimalType) and kind.precision <= SHORT_DECIMAL:
        return "num", F.rint(value.cast("double") * F.lit(float(10**kind.scale))).cast("bigint")
    if isinstance(kind, (DoubleType, FloatType)):
        return "real", value.cast("double")
    if isinstance(kind, TimestampType):
        return "num", F.unix_micros(value)
    if isinstance(kind, (DateType, TimestampNTZType)):
        return "at", value.cast("timestamp_ntz")
    text = value.cast("string")
    return "text", text if isinstance(kind, BOUNDED) else _short(text)


def _given_back(held: F.Column, kind: DataType) -> F.Column:
    """A value of the column's own type from its holder."""
    if isinstance(kind, DecimalType) and kind.precision <= SHORT_DECIMAL:
        return (held.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-kind.scale))).cast(kind)
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(held)
    return held.cast(kind)


def _values(number: int, df: DataFrame) -> DataFrame:
    """One row `(source, position, holders)` for each field of each row."""

    def entry(position: int, held: dict[str, F.Column]) -> F.Column:
        holders = [held.get(h, F.lit(None)).cast(kind).alias(h) for h, kind in HOLDERS.items()]
        return F.struct(F.lit(position).alias("position"), *holders)

    fields = [entry(i, dict([_held(F.col(f.name), f.dataType)])) for i, f in enumerate(df.schema)]
    return df.select(F.lit(number).alias("source"), F.inline(F.array(*fields)))


def profile_facts(sources: Mapping[str, DataFrame]) -> DataFrame:
    """What the profile of columns is made of, from one scan of each source.

    One row per column: rows, nulls, distinct values, least and greatest value. Values are
    counted as (source, position, value), which collapses frequent ones before the only
    shuffle of them and spreads all columns of all tables over all tasks. Of long texts
    only digests of 128 bits move.
    """
    metadata, places = [], {}
    for number, (name, df) in enumerate(sources.items()):
        for i, field in enumerate(df.schema):
            dtype = field.dataType.simpleString()
            metadata.append((number, i, name, field.name, dtype))
            if isinstance(field.dataType, BOUNDED):
                places.setdefault(dtype, (field.dataType, []))[1].append((number, i))
    held = ("source", "position", *HOLDERS)
    values = _stack([_values(number, df) for number, df in enumerate(sources.values())])
    counted = values.groupBy(*held).agg(F.count(F.lit(1)).alias("n"))
    present = reduce(lambda a, b: a | b, [F.col(h).isNotNull() for h in HOLDERS])

    bounds, shown = [], {"min": [], "max": []}
    for k, (kind, where) in enumerate(places.values()):
        holder = _held(F.lit(None).cast(kind), kind)[0]
        here = reduce(lambda a, b: a | b, [(F.col("source") == a) & (F.col("position") == b) for a, b in where])
        value = F.when(here, _given_back(F.col(holder), kind) if holder == "text" else F.col(holder))
        bounds += [F.min(value).alias(f"min_{k}"), F.max(value).alias(f"max_{k}")]
        for end, texts in shown.items():
            bound = F.col(f"{end}_{k}")
            texts.append(_as_text(bound if holder == "text" else _given_back(bound, kind), kind))
    facts = counted.groupBy("source", "position").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(present, 0).otherwise(F.col("n"))).alias("nulls"),
        F.count_if(present).alias("distinct_count"),
        *bounds,
    )
    zero = F.lit(0).cast("bigint")
    names = "source int, position int, table_name string, column_name string, dtype string"
    # A row per column of the tables on either side. Columns of empty tables meet nothing.
    described = values.sparkSession.createDataFrame(metadata, names)
    return described.join(facts, ["source", "position"], "left").select(
        "source",
        "position",
        "table_name",
        "column_name",
        "dtype",
        *[F.coalesce(c, zero).alias(c) for c in ("rows", "nulls", "distinct_count")],
        *[F.coalesce(*texts, F.lit(NO_VALUE)).alias(f"{end}_value") for end, texts in shown.items()],
        F.col("dtype").isin(*places).alias("bounded"),
    )


def profile_all_columns(sources: Mapping[str, DataFrame], facts: DataFrame | None = None) -> DataFrame:
    """One row per column: type, nulls, null percent, distinct values, min, max.

    Min and max are given for numbers and dates; they are NULL where there is no value.
    `facts` are those of the same sources, where they are stored.
    """
    facts = profile_facts(sources) if facts is None else facts
    nothing = F.when(F.col("bounded") & (F.col("distinct_count") == 0), F.lit(None))
    return facts.select(
        "table_name",
        "column_name",
        "dtype",
        F.col("nulls").alias("null_count"),
        rounded(F.lit(100) * F.col("nulls"), F.col("rows"), 1).alias("null_pct"),
        "distinct_count",
        nothing.otherwise(F.col("min_value")).alias("min_value"),
        nothing.otherwise(F.col("max_value")).alias("max_value"),
    )


def _holes(df: DataFrame, words: int) -> list[F.Column]:
    """Which fields of a row are NULL, as bits of whole numbers."""
    bits = [F.col(f"`{c}`").isNull().cast("bigint") for c in df.columns]
    parts = [bits[i * WORD_BITS : (i + 1) * WORD_BITS] for i in range(words)]
    return [
        reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(bit, k) for k, bit in enumerate(part)], F.lit(0).cast("bigint"))
        for part in parts
    ]


def profile_all_tables(sources: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: rows, columns, full-row duplicates, columns that hold nulls.

    A row counts as two 64-bit digests, with the bits that tell which of its fields are
    NULL; these are all that moves of it, once. Values of single columns are not counted,
    which takes as many entries as a row has fields.
    """
    words = max(-(-len(df.columns) // WORD_BITS) for df in sources.values())
    holes = [f"holes_{i}" for i in range(words)]

    def rows(number: int, df: DataFrame) -> DataFrame:
        told = _holes(df, words)
        fields = [F.col(f"`{c}`") for c in df.columns]
        digests = [F.xxhash64(F.lit(seed), *told, *fields).alias(f"digest_{seed}") for seed in (1, 2)]
        return df.select(
            F.lit(number).alias("source"), *digests, *[t.alias(h) for t, h in zip(told, holes, strict=True)]
        )

    digested = _stack([rows(number, df) for number, df in enumerate(sources.values())])
    counted = digested.groupBy("source", "digest_1", "digest_2").agg(
        F.count(F.lit(1)).alias("n"), *[F.bit_or(h).alias(h) for h in holes]
    )
    facts = counted.groupBy("source").agg(
        F.sum("n").alias("rows"),
        F.sum(F.col("n") - 1).alias("copies"),
        *[F.bit_or(h).alias(h) for h in holes],
    )
    nulls = reduce(lambda a, b: a + b, [F.bit_count(h) for h in holes]).cast("bigint")
    zero = F.lit(0).cast("bigint")
    metadata = [(number, name, len(df.columns)) for number, (name, df) in enumerate(sources.items())]
    # Empty tables meet nothing.
    described = digested.sparkSession.createDataFrame(metadata, "source int, table_name string, column_count bigint")
    return described.join(facts, "source", "left").select(
        "table_name",
        F.coalesce("rows", zero).alias("row_count"),
        "column_count",
        F.coalesce("copies", zero).alias("duplicate_count"),
        F.coalesce(nulls, zero).alias("null_columns"),
    )


def profile_columns(name: str, df: DataFrame) -> DataFrame:
    return profile_all_columns({name: df})


def profile_table(name: str, df: DataFrame) -> DataFrame:
    return profile_all_tables({name: df})


def primary_key_duplicates(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Rows beyond the first of each declared key, for every keyed source."""
    return _stack(
        [
            duplicate_rows(sources[name].select(*keys), keys).select(
                F.lit(name).alias("table_name"),
                F.lit(", ".join(keys)).alias("key_columns"),
                F.col("duplicates").alias("duplicate_count"),
            )
            for name, keys in PRIMARY_KEYS.items()
            if name in sources
        ]
    )


def negative_values(sources: Mapping[str, DataFrame]) -> DataFrame:
    return _stack(
        [
            df.agg(F.count_if(F.col(column) < 0).alias("negative_count")).select(
                F.lit(name).alias("table_name"),
                F.lit(column).alias("column_name"),
                "negative_count",
            )
            for name, df in sources.items()
            for column in NON_NEGATIVE
            if column in df.columns
        ]
    )


def scores_out_of_range(sources: Mapping[str, DataFrame]) -> DataFrame:
    low, high = SCORE_RANGE
    return _stack(
        [
            df.agg(
                F.count_if(~F.col("review_score").between(low, high)).alias("invalid_count")
            ).select(F.lit(name).alias("table_name"), "invalid_count")
            for name, df in sources.items()
            if "review_score" in df.columns
        ]
    )


def validate_all(sources: Mapping[str, DataFrame]) -> list[str]:
    """Warnings about all sources, empty when all is well. Never raises on bad data.

    One job counts everything: rows, rows beyond the first of a key, negative values
    and scores out of range.
    """
    nothing = F.lit("").alias("column_name")
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), F.lit("rows").alias("kind"), nothing, "n"
        )
        for name, df in sources.items()
    ]
    if any(name in PRIMARY_KEYS for name in sources):
        counts.append(
            primary_key_duplicates(sources).select(
                "table_name",
                F.lit("copies").alias("kind"),
                F.col("key_columns").alias("column_name"),
                F.col("duplicate_count").alias("n"),
            )
        )
    if any(c in df.columns for df in sources.values() for c in NON_NEGATIVE):
        counts.append(
            negative_values(sources).select(
                "table_name", F.lit("negative").alias("kind"), "column_name", F.col("negative_count").alias("n")
            )
        )
    if any("review_score" in df.columns for df in sources.values()):
        counts.append(
            scores_out_of_range(sources).select(
                "table_name", F.lit("range").alias("kind"), nothing, F.col("invalid_count").alias("n")
            )
        )
    found = _stack(counts).collect()  # a few rows for each source
    empty = {r["table_name"] for r in found if r["kind"] == "rows" and r["n"] == 0}
    low, high = SCORE_RANGE
    texts = {
        "copies": "{n} duplicate rows on key {column}",
        "negative": "{n} negative values in {column}",
        "range": f"{{n}} review scores outside {low}-{high}",
    }
    warnings = []
    for name in sources:
        if name in empty:
            warnings.append(f"[{name}] EMPTY")
        for r in found:
            if r["table_name"] == name and r["kind"] in texts and r["n"]:
                said = texts[r["kind"]].format(n=r["n"], column=r["column_name"])
                warnings.append(f"[{name}] {said}")
    return warnings


def validate(name: str, df: DataFrame) -> list[str]:
    """Warnings about one source."""
    return validate_all({name: df})
