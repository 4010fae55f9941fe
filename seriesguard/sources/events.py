"""Events as JSON messages and back, with a reject output for bad messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesguard.functions.columns import q

def event_schema(features: Sequence[str], ts: str = "ts", source: str = "source", event_id: str = "event_id") -> T.StructType:
    """Schema of an event message by the contract: flat fields, or the features nested under ``features``."""
    own = [T.StructField(f, T.DoubleType()) for f in features]
    return T.StructType([T.StructField(event_id, T.LongType()), T.StructField(ts, T.StringType()), T.StructField(source, T.StringType()),
                         *own, T.StructField("features", T.StructType(own))])


#: Messages of the ``events`` panel.
EVENT_SCHEMA = event_schema(["value", "user"])


def to_events(df: DataFrame, cols: Sequence[str] | None = None, key: str | None = None,
              keep: Sequence[str] = ()) -> DataFrame:
    """A3: one JSON object per row (``value``), optionally with a message key, ready for a sink."""
    body = F.to_json(F.struct(*[F.col(c) for c in (cols or df.columns)])).alias("value")
    return df.select(*keep, *([F.col(key).cast("string").alias("key")] if key else []), body)


def time_label(ts: str, ordinal: str, fmt: str = "yyyy-MM-dd HH:mm:ss"):
    """The time as a string, or the row's ordinal when there is no time."""
    return F.coalesce(F.date_format(F.col(ts), fmt), F.col(ordinal).cast("string"))


def is_object(raw: Column) -> Column:
    """Valid JSON whose top level is an object (a consumer skips anything else)."""
    return F.try_parse_json(raw).isNotNull() & F.ltrim(raw).startswith("{")


def parse_events(df: DataFrame, raw: str = "value", schema: T.StructType = EVENT_SCHEMA,
                 keep: Sequence[str] = ()) -> DataFrame:
    """Parse and flatten; nested fields become ``features_<name>`` columns. Bad rows give nulls."""
    parsed = df.select(*keep, F.from_json(F.col(raw), schema).alias("_m"), is_object(F.col(raw)).alias("_ok"))
    cols = []
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            cols += [F.col("_m")[f.name][g.name].alias(f"{f.name}_{g.name}") for g in f.dataType.fields]
        else:
            cols.append(F.col("_m")[f.name].alias(f.name))
    return parsed.select(*keep, "_ok", *cols)


def expand_features(parsed: DataFrame, names: Sequence[str], nested: str = "features") -> DataFrame:
    """A feature is read from the nested object when present, else from the top level."""
    out = parsed
    for n in names:
        out = out.withColumn(n, F.coalesce(F.col(q(f"{nested}_{n}")), F.col(q(n))))
    return out.drop(*[f"{nested}_{n}" for n in names])


def synth_time(df: DataFrame, ts: str, ordinal: Column) -> DataFrame:
    """A message without time gets 1970-01-01 plus one second per ordinal (message offset)."""
    return df.withColumn(ts, F.coalesce(F.try_to_timestamp(F.col(ts)), F.timestamp_seconds(ordinal)))


def rejects(df: DataFrame, raw: str = "value", keep: Sequence[str] = (), required: Sequence[str] = ()) -> DataFrame:
    """Messages that are not JSON objects, or lack a required field, with a reason."""
    ok = is_object(F.col(raw))
    missing = [F.when(F.get_json_object(F.col(raw), f"$.{r}").isNull(), F.lit(r)) for r in required]
    miss = F.concat_ws(",", *missing) if missing else F.lit("")
    reason = (F.when(F.col(raw).isNull(), F.lit("null"))
              .when(~ok, F.lit("malformed"))
              .when(miss != "", F.concat(F.lit("missing:"), miss)))
    return df.select(*keep, F.col(raw).alias("raw"), reason.alias("reason")).where(F.col("reason").isNotNull())
