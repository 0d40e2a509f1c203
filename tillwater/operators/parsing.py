"""JSON text in, JSON text out."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

CORRUPT = "_corrupt_record"


def parse_json(
    df: DataFrame, schema: T.StructType, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Split a text column into (parsed records, texts that do not parse).

    Both sides are plain filters over the same parse, so no text is lost and
    the job does not stop at a broken one. Other columns of `df` are kept.
    """
    keep = [c for c in df.columns if c != value]
    full = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    record = F.from_json(
        value, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    # Unpacked by a generator, so that filters on the fields stay above it and
    # each text is parsed once. Read as plain struct fields, it would be parsed
    # for the filter and again for the output.
    parsed = df.select(*keep, value, F.explode(F.array(record)).alias("_parsed"))
    broken = F.col("_parsed").isNull() | F.col(f"_parsed.{CORRUPT}").isNotNull()
    good = parsed.filter(~broken).select(
        *keep, *[F.col(f"_parsed.`{name}`").alias(name) for name in schema.names]
    )
    return good, parsed.filter(broken).select(*keep, value)


def parse_dynamic(
    df: DataFrame, schema: T.StructType, value: str = "value", record: str = "record",
) -> tuple[DataFrame, DataFrame]:
    """Like `parse_json`, but each record stays whole beside its known fields.

    `record` is the object as a variant, with every field that came, known or not; a
    known field whose value isn't of its type is null. Texts that aren't JSON objects
    are the second frame. Read further fields with `variant_get`, or with `others`.
    """
    keep = [c for c in df.columns if c != value]
    parsed = df.select(*keep, value, F.try_parse_json(value).alias(record))
    is_object = F.coalesce(F.schema_of_variant(record).startswith("OBJECT"), F.lit(False))
    known = [
        F.try_variant_get(record, f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
        for f in schema.fields]
    return (parsed.filter(is_object).select(*keep, *known, record),
            parsed.filter(~is_object).select(*keep, value))


def others(record: str, schema: T.StructType):
    """The fields of a dynamic record that the schema doesn't know: a map of variants."""
    fields = F.try_variant_get(record, "$", "map<string,variant>")
    return F.map_filter(fields, lambda name, _: ~name.isin(*schema.names))


def to_json_text(df: DataFrame, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Each row as one JSON text; absent fields are left out of it."""
    keep = keep or []
    body = [c for c in df.columns if c not in keep]
    return df.select(*keep, F.to_json(F.struct(*body)).alias(value))
