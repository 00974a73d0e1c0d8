"""Schemas that drift between files: a report of each change, and one typed table.

Ingestion enforces the catalog's schema. What doesn't fit (unknown fields, values that can't be cast,
broken records) is kept as JSON in a rescue column; approving a field or a format later replays the
rescued values into typed columns without touching the raw files again.

A file's header goes the same way as its records: it is a record whose fields are the file's columns.
The report of changes compares the typed columns and the rescue columns of consecutive headers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cabstrata.functions.keys import bare_name
from cabstrata.session import materialize

# Catalog types and the Spark types they stand for.
CATALOG_TYPES = {"int64": "bigint", "int32": "int", "double": "double", "float": "float", "string": "string", "boolean": "boolean", "timestamp": "timestamp_ntz"}
# Formats in which timestamps arrive; the first is the standard.
TIMESTAMP_FORMATS = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss"]

_MONTH = r"(?<![0-9])([0-9]{4}-(?:0[1-9]|1[0-2]))(?![0-9])"
#: The name under which a record that can't be read stands in the rescue column.
BROKEN = "_broken"


def bare_field(c: Column) -> Column:
    """A column's name by its letters and digits only, without case."""
    return F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]", ""))


def known_names(catalog: DataFrame) -> DataFrame:
    """(bare, field_name, field_type), one row per bare name; the catalog is a fixed table of names."""
    return catalog.where("known_name is not null").groupBy(bare_field(F.col("known_name")).alias("bare")).agg(F.min(F.struct("field_name", "field_type")).alias("f")).select("bare", "f.*")


_ENTRY = "struct<ordinal:int,column_name:string,data_type:string>"


def series_and_month(filename: Column) -> tuple[Column, Column]:
    """(series, month) of a file's name, whatever its directory, letter case and outer blanks: the month
    is the first yyyy-MM between other characters than digits, the series the rest of the name. The month
    is null where the name says none."""
    name = bare_name(filename)
    month = F.nullif(F.regexp_extract(name, _MONTH, 1), F.lit(""))
    return F.regexp_replace(name, _MONTH, ""), month


def unplaced_files(columns: DataFrame) -> DataFrame:
    """(filename): the files whose names say no month. They have no place in a series, so the report of
    changes can't hold them; they are to be looked at."""
    _, month = series_and_month(F.col("filename"))
    return columns.where("filename is not null").where(month.isNull()).select("filename").distinct()


def ingest_headers(columns: DataFrame, schema: Schema) -> DataFrame:
    """(filename, series, month, catalog fields..., _rescued): the header of each file in the approved
    schema. A field's value is the JSON of its column's place, written name and type; columns that the
    schema doesn't know stay in _rescued under their written names. Of several columns of one field the
    first in file order counts and the others are no fields of their own; a list that came twice counts
    once, whatever spelling its file's name had."""
    series, month = series_and_month(F.col("filename"))
    c = columns.where("filename is not null and column_name is not null").select("filename", series.alias("series"), month.alias("month"), "ordinal", "column_name", "data_type").where("month is not null")
    once = c.groupBy("series", "month", "column_name", "data_type").agg(F.min("ordinal").alias("ordinal"), F.min("filename").alias("filename"))
    entry = F.struct("ordinal", "column_name", "data_type").alias("e")
    files = once.groupBy("series", "month").agg(F.min("filename").alias("filename"), F.array_sort(F.collect_list(entry)).alias("_e"))
    rest = F.transform("_e", lambda e: F.struct(e["column_name"].alias("k"), F.to_json(e).alias("v")))
    texts = Schema(dict.fromkeys(schema.types, "string"), schema.names, schema.formats)
    # Of a column listed with two types the first counts.
    own = F.filter(rest, lambda e, i: F.array_position(F.transform(rest, lambda x: x["k"]), e["k"]) == i + 1)
    return _pack(_fill(files.withColumn("_rest", own), texts, set()), texts, ["filename", "series", "month"])


def header_fields(headers: DataFrame, schema: Schema) -> DataFrame:
    """(filename, series, month, field_name, column_name, data_type) of ingested headers: one row per
    field, unknown columns as fields named as written."""
    known = F.array(*[F.lit(b) for b in sorted(schema.names)])
    own = F.filter(F.map_entries(F.coalesce(F.from_json("_rescued", "map<string,string>"), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))), lambda e: ~F.array_contains(known, bare_field(e["key"])))
    typed_ = F.array(*[F.struct(F.lit(f).alias("key"), F.col(f"`{f}`").alias("value")) for f in schema.types])
    cells = F.filter(F.concat(typed_, own), lambda e: e["value"].isNotNull())
    got = headers.select("filename", "series", "month", F.explode(cells).alias("c")).select("filename", "series", "month", F.col("c.key").alias("field_name"), F.from_json("c.value", _ENTRY).alias("v"))
    return got.select("filename", "series", "month", "field_name", "v.column_name", "v.data_type")


def header_changes(headers: DataFrame, schema: Schema) -> DataFrame:
    """(filename, field_name, change) of each header against the one before it in its series: added,
    removed, renamed, retyped; a field may have two. Nothing for a series' first file. One row per file
    and field is sent to its own file and to the next one, so the two sides meet in one grouping."""
    w = Window.partitionBy("series").orderBy("month")
    files = headers.withColumns({"_prev": F.lag("month").over(w), "_next_file": F.lead("filename").over(w)})
    cells = header_fields(files.select("*"), schema).join(files.select("series", "month", "_prev", "_next_file"), ["series", "month"])
    v = F.struct("column_name", "data_type")
    sides = F.array(
        F.struct(F.when(F.col("_prev").isNotNull(), F.col("filename")).alias("file"), v.alias("now"), F.lit(None).cast("struct<column_name:string,data_type:string>").alias("old")),
        F.struct(F.col("_next_file").alias("file"), F.lit(None).cast("struct<column_name:string,data_type:string>").alias("now"), v.alias("old")),
    )
    both_sides = cells.select("field_name", F.explode(sides).alias("s")).where("s.file is not null")
    met = both_sides.groupBy(F.col("s.file").alias("filename"), "field_name").agg(F.first("s.now", ignorenulls=True).alias("now"), F.first("s.old", ignorenulls=True).alias("old"))
    both = F.col("now").isNotNull() & F.col("old").isNotNull()
    change = F.array_compact(F.array(
        F.when(F.col("old").isNull(), F.lit("added")),
        F.when(F.col("now").isNull(), F.lit("removed")),
        F.when(both & ~F.col("now.column_name").eqNullSafe(F.col("old.column_name")), F.lit("renamed")),
        F.when(both & ~F.col("now.data_type").eqNullSafe(F.col("old.data_type")), F.lit("retyped")),
    ))
    return met.select("filename", "field_name", F.explode(change).alias("change"))


def schema_changes(columns: DataFrame, catalog: DataFrame) -> DataFrame:
    """The report of changes between the files of each series: headers ingested under the catalog's
    schema, and compared. An empty table gives no rows; files without a month in their names are given
    by unplaced_files."""
    schema = Schema.of(catalog)
    return header_changes(materialize(ingest_headers(columns, schema), "headers"), schema)


def typed(text: Column, kind: str, formats: list[str]) -> Column:
    """The text as a value of a catalog type, null where it can't be one. A whole number may be written
    with a zero fraction."""
    t = CATALOG_TYPES[kind]
    if t == "timestamp_ntz":
        return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast(t) for f in formats])
    if t in ("bigint", "int"):
        return F.regexp_replace(F.trim(text), r"\.0*$", "").try_cast(t)
    return F.trim(text).try_cast(t) if t != "string" else text


class Schema:
    """The approved schema: fields with types, the bare names each is known by, timestamp formats."""

    def __init__(self, types: dict[str, str], names: dict[str, str], formats: list[str] | None = None):
        self.types, self.names, self.formats = types, names, formats or TIMESTAMP_FORMATS

    @classmethod
    def of(cls, catalog: DataFrame) -> Schema:
        """From the catalog, a fixed table of a few names per field; it is metadata and read at once."""
        rows = known_names(catalog).collect()
        return cls({r.field_name: r.field_type for r in sorted(rows, key=lambda r: r.field_name)}, {r.bare: r.field_name for r in rows})

    def with_approved(self, names: dict[str, str] | None = None, types: dict[str, str] | None = None, formats: list[str] | None = None) -> Schema:
        """names: written name -> field; types: of new fields; formats: further timestamp formats."""
        bare = {"".join(ch for ch in k if ch.isalnum()).lower(): v for k, v in (names or {}).items()}
        return Schema(self.types | (types or {}), self.names | bare, [*self.formats, *(formats or [])])


def _fill(df: DataFrame, schema: Schema, have: set[str]) -> DataFrame:
    """Moves what fits from _rest, an array of (k, v) in the order of the record, into typed columns. A
    field that has a value keeps it; of several known spellings in a record the first in its order counts;
    what doesn't find a place stays in _rest, and so do nulls of fields that the schema doesn't know.

    Names are generalised once per row; a field then is a native search in the array of names."""
    df = df.withColumn("_all", F.transform("_rest", lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v"), bare_field(e["k"]).alias("b"))))
    df = df.withColumn("_told", F.filter("_all", lambda e: e["v"].isNotNull())).withColumns({"_names": F.col("_told.b"), "_texts": F.col("_told.v")})
    places = {}
    for i, field in enumerate(schema.types):
        at = [F.nullif(F.array_position("_names", b), F.lit(0)) for b, f in sorted(schema.names.items()) if f == field]
        places[f"_at{i}"] = F.least(*at) if len(at) > 1 else at[0] if at else F.lit(None).cast("bigint")
    df = df.withColumns(places)
    df = df.withColumns({f"_new{i}": typed(F.get("_texts", (F.col(f"_at{i}") - 1).cast("int")), kind, schema.formats) for i, kind in enumerate(schema.types.values())})
    old = [F.col(f"`{f}`") if f in have else F.lit(None).cast(CATALOG_TYPES[k]) for f, k in schema.types.items()]
    used = F.array_compact(F.array(*[F.when(o.isNull() & F.col(f"_new{i}").isNotNull(), F.col(f"_at{i}")) for i, o in enumerate(old)]))
    df = df.withColumn("_used", used).withColumns({f: F.coalesce(o, F.col(f"_new{i}")) for i, (f, o) in enumerate(zip(schema.types, old, strict=True))})
    known = F.array(*[F.lit(b) for b in sorted(schema.names)])
    kept = F.filter("_told", lambda e, i: ~F.array_contains("_used", (i + 1).cast("bigint")))
    nulls = F.filter("_all", lambda e: e["v"].isNull() & ~F.array_contains(known, e["b"]))
    return df.withColumn("_rest", F.transform(F.concat(kept, nulls), lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v"))))


_PAIRS = "array<struct<k:string,v:string>>"


def _pairs(m: Column) -> Column:
    return F.transform(F.map_entries(m), lambda e: F.struct(e["key"].alias("k"), e["value"].alias("v")))


def _json(pairs: Column) -> Column:
    """A JSON object of the pairs in their order; a name may stand in it twice."""
    one = F.transform(pairs, lambda e: F.to_json(F.create_map(e["k"], e["v"]), {"ignoreNullFields": "false"}))
    return F.concat(F.lit("{"), F.array_join(F.transform(one, lambda t: t.substr(F.lit(2), F.length(t) - 2)), ","), F.lit("}"))


def ingest(records: DataFrame, schema: Schema) -> DataFrame:
    """(filename, row_no, catalog fields..., _rescued): one row per record of a file.

    payload is JSON text. A record delivered twice counts once (a readable one first, then the
    greatest text). Unknown fields and values that can't be cast stay in _rescued as a JSON object; a
    record that can't be read at all stays there whole under `_broken`. Absent and null fields are
    null; a null payload gives nulls and nothing rescued.
    """
    readable = F.get_json_object("payload", "$").isNotNull()
    one = records.groupBy("filename", "row_no").agg(F.max(F.struct(readable.alias("ok"), "payload")).alias("p")).select("filename", "row_no", "p.*")
    parsed = _pairs(F.from_json("payload", "map<string,string>"))
    whole = F.when(F.col("payload").isNotNull(), F.array(F.struct(F.lit(BROKEN).alias("k"), F.col("payload").alias("v")))).otherwise(F.array().cast(_PAIRS))
    return _pack(_fill(one.withColumn("_rest", F.when(F.col("ok"), F.coalesce(parsed, whole)).otherwise(whole)), schema, set()), schema)


def _pack(df: DataFrame, schema: Schema, keys: list[str] | None = None) -> DataFrame:
    rescued = F.when(F.size("_rest") > 0, _json(F.col("_rest")))
    return df.select(*(keys or ["filename", "row_no"]), *[F.col(f"`{f}`") for f in schema.types], rescued.alias("_rescued"))


def replay(table: DataFrame, schema: Schema) -> DataFrame:
    """The table under a schema with further approved names, fields or formats: rescued values that
    now fit move into their typed columns, the others stay rescued."""
    have = set(table.columns)
    rest = F.coalesce(_pairs(F.from_json("_rescued", "map<string,string>")), F.array().cast(_PAIRS))
    return _pack(_fill(table.withColumn("_rest", rest).drop("_rescued"), schema, have), schema)


def rescued_report(table: DataFrame, schema: Schema) -> DataFrame:
    """(filename, written_name, reason, n_records): what stayed in the rescue column of each file, by the
    name it was written with: `unknown` (no field of the schema), `uncastable` (a field's value of
    another type, or a further spelling beside one that was taken) or `broken` (the whole record)."""
    known = F.array(*[F.lit(b) for b in sorted(schema.names)])
    cells = table.select("filename", F.explode(F.array_distinct(F.map_keys(F.from_json("_rescued", "map<string,string>")))).alias("written_name"))
    reason = F.when(F.col("written_name") == BROKEN, "broken").when(F.array_contains(known, bare_field(F.col("written_name"))), "uncastable").otherwise("unknown")
    return cells.groupBy("filename", "written_name").agg(F.count(F.lit(1)).alias("n_records")).select("filename", "written_name", reason.alias("reason"), "n_records")
