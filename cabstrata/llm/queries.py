"""Queries of the llm operators and their SQL twins."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cabstrata.functions.keys import TRIP_IDS, TRIP_VALUES, filled, trip_key
from cabstrata.llm import fusion, lookalike, mixing, percentiles, tokens
from cabstrata.session import load, materialize, shared_path

QUANTILES = {"p50": "0.5", "p90": "0.9", "p99": "0.99"}


#: The order of preference of TESTDATA.md, the row's number last.
_PREFER = ["_loaded_at", "_ingest_batch_id", "n_filled"]


def _trips(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "yellow_tripdata").select("_row_id", "_ingest_batch_id", "_loaded_at", "fare_amount", F.unhex(trip_key()).alias("trip"), filled([*TRIP_IDS, *TRIP_VALUES]).alias("n_filled"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """The statement fixes the fare by the order of preference, which votes can't give: see the README."""
    p = fusion.preferred(_trips(spark, d), "trip", "_row_id", _PREFER, "fare_amount")
    return p.select("group_row_id", "survivor_row_id", F.col("value_row_id").alias("fare_row_id"))


def p2_fused(spark: SparkSession, d: str) -> DataFrame:
    """Each repeated trip with the fare its loads vote for, whatever their order."""
    fused = fusion.fuse(_trips(spark, d), "trip", "_ingest_batch_id", "_row_id", _PREFER, "fare_amount")
    return fused.select("group_row_id", "survivor_row_id", "n_rows", "n_sources", "fused_value", "value_row_id", F.round("probability", 6).alias("probability"))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    """What p2_fused rests on, as far as SQL can say it: each repeated trip with its loads that know a fare,
    and whether the fused one is one of the fares that its loads prefer."""
    fused = fusion.fuse(_trips(spark, d), "trip", "_ingest_batch_id", "_row_id", _PREFER, "fare_amount")
    return fused.select("group_row_id", "survivor_row_id", "n_rows", "n_sources", F.when(F.col("n_sources") == 1, F.col("fused_value")).alias("only_value"), (F.col("n_sources") == 0).alias("unknown"), F.col("fused_value").isNull().alias("no_value"))


def _patterns(spark: SparkSession, d: str) -> DataFrame:
    claims = fusion.source_claims(_trips(spark, d), "trip", "_ingest_batch_id", "_row_id", _PREFER, "fare_amount")
    return fusion.count_patterns(fusion.group_claims(claims, "_ingest_batch_id", _PREFER))


def p2_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of loads with the trips that both know a fare of, and those in which it is the same."""
    return fusion.agreement(_patterns(spark, d))


def p2_copiers(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of loads with the chances that the one copies the other."""
    m = fusion.fit(_patterns(spark, d)).dependence
    return m.select(F.col("s").alias("source_a"), F.col("t").alias("source_b"), "same_true", "same_false", "differ", F.round("st", 6).alias("a_copies_b"), F.round("ts", 6).alias("b_copies_a"))


def p2_survivors(spark: SparkSession, d: str) -> DataFrame:
    """Every trip once: the preferred row, its fare filled from the copies where it has none."""
    columns = ["_row_id", *TRIP_IDS, *TRIP_VALUES, "_source_filename", "_ingest_batch_id", "_loaded_at"]
    rows = load(spark, d, "yellow_tripdata").withColumns({"trip": F.unhex(trip_key()), "n_filled": filled([*TRIP_IDS, *TRIP_VALUES])})
    return fusion.survivors(rows, "trip", "_row_id", _PREFER, "fare_amount", columns)


#: What p3_percentiles has of each table: measure -> dimensions.
_TRIP_CELLS = [("trip_duration_min", k) for k in ("zone", "hour", "month")]
_LOAD_CELLS = [(m, k) for m in ("total_amount", "trip_distance") for k in ("zone", "hour", "month", "load")]


def _by_each(df: DataFrame, cells: list[tuple[str, str]], dimensions: dict[str, Column], first: int) -> DataFrame:
    """The state of every measure by every dimension, (cell, grp, value, n), in one pass; a cell is the number of
    a measure and dimension, from `first`."""
    own = [F.struct(F.lit(first + i).alias("cell"), dimensions[k].cast("string").alias("grp"), F.col(m).cast("double").alias("v")) for i, (m, k) in enumerate(cells)]
    return percentiles.frequency_state(df.select(F.explode(F.array(*own)).alias("c")).select("c.*"), ["cell", "grp"], "v")


def p3_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """Durations by zone, hour and month; totals and distances by zone, hour, month and load. The states
    of both tables are put together and read at once."""
    trips, bronze = load(spark, d, "int_trips_enriched"), load(spark, d, "yellow_tripdata")
    pick = F.col("tpep_pickup_datetime")
    a = _by_each(trips, _TRIP_CELLS, {"zone": F.col("pu_location_id"), "hour": F.col("pickup_hour"), "month": F.date_format("pickup_date", "yyyy-MM")}, 0)
    b = _by_each(bronze, _LOAD_CELLS, {"zone": F.col("PULocationID"), "hour": F.hour(pick), "month": F.substring(pick.cast("string"), 1, 7), "load": F.col("_ingest_batch_id")}, len(_TRIP_CELLS))
    # No two cells of the tables are the same: their states need no adding up.
    out = percentiles.percentiles(a.unionByName(b), ["cell", "grp"], QUANTILES)
    names = F.array(*[F.struct(F.lit(m).alias("measure"), F.lit(k).alias("dimension")) for m, k in [*_TRIP_CELLS, *_LOAD_CELLS]])
    return out.withColumn("c", F.get(names, F.col("cell"))).select("c.*", *[x for x in out.columns if x != "cell"])


def p3_duration_by_zone(spark: SparkSession, d: str) -> DataFrame:
    state = percentiles.frequency_state(load(spark, d, "int_trips_enriched"), ["pu_location_id"], "trip_duration_min")
    return percentiles.percentiles(state, ["pu_location_id"], QUANTILES)


def p3_total_by_load(spark: SparkSession, d: str) -> DataFrame:
    state = percentiles.frequency_state(load(spark, d, "yellow_tripdata"), ["_ingest_batch_id"], "total_amount")
    return percentiles.percentiles(state, ["_ingest_batch_id"], QUANTILES)


def p3_distance_by_month(spark: SparkSession, d: str) -> DataFrame:
    """Each load leaves its own stored state by month; the months' percentiles come from the stored states
    put together."""
    trips = load(spark, d, "yellow_tripdata").select("_ingest_batch_id", F.substring(F.col("tpep_pickup_datetime").cast("string"), 1, 7).alias("month"), "trip_distance")
    by_load = percentiles.store_state(percentiles.frequency_state(trips, ["_ingest_batch_id", "month"], "trip_distance"), shared_path(spark, "states"), "_ingest_batch_id")
    return percentiles.percentiles(percentiles.merge_states(by_load, ["month"]), ["month"], QUANTILES)


def p3_duration_by_hour_rounded(spark: SparkSession, d: str) -> DataFrame:
    """Durations in cells of a tenth of a minute: a small state, and results within 0.05 minutes."""
    state = percentiles.frequency_state(load(spark, d, "int_trips_enriched"), ["pickup_hour"], "trip_duration_min", 0.1)
    return percentiles.percentiles(state, ["pickup_hour"], QUANTILES, 0.1)


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(load(spark, d, "documents"), "doc_id", "text")


def _mix(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    targets = load(spark, d, "mix_targets")
    sized = mixing.sized_documents(load(spark, d, "documents"), targets)
    return mixing.select_mix(sized, mixing.read_targets(targets)), sized, targets


def p9_selection(spark: SparkSession, d: str) -> DataFrame:
    return _mix(spark, d)[0]


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_report(*_mix(spark, d))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """What the report says as far as it can be said beforehand: the documents there, that no more are used, that
    none is used more often than its source allows, and that the share reached is the target's (among the
    sources that have any tokens) but for what whole documents leave open: half a document for each set of
    sources and member."""
    selection, sized, targets = _mix(spark, d)
    slack = sized.groupBy("pattern", "source").agg(F.max("n_tokens").alias("m")).agg((F.coalesce(F.sum("m"), F.lit(0)) / 2).alias("slack")).scalar()
    r = mixing.mix_report(selection, sized, targets).withColumn("all_used", F.sum("tokens_used").over(Window.partitionBy(F.lit(1))))
    return r.select(
        "source", "target_share", "documents", (F.col("documents_used") <= F.col("documents")).alias("within_documents"), (F.col("most_repeats") <= F.col("max_repeats")).alias("within_repeats"),
        (F.abs(F.col("share") - F.coalesce("reachable_share", F.lit(0.0))) * F.col("all_used") <= slack).alias("on_target"), (F.col("tokens_used") > 0).alias("used"),
    )


def _forms(spark: SparkSession, d: str) -> DataFrame:
    """The forms of all documents, written once: the texts are read and brought to their form once."""
    return materialize(lookalike.canonical_texts(load(spark, d, "documents"), "doc_id", "text", hashed=True), "forms")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.lookalike_pairs(_forms(spark, d), "doc_id")


def p10_canonical(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.canonical_texts(load(spark, d, "documents"), "doc_id", "text")


def p10_classes(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.document_classes(_forms(spark, d), "doc_id")


QUERIES = {f.__name__: f for f in (p2_found, p2_fused, p2_groups, p2_agreement, p2_copiers, p2_survivors, p3_percentiles, p3_duration_by_zone, p3_total_by_load, p3_distance_by_month, p3_duration_by_hour_rounded, p8_ids, p9_selection, p9_report, p9_shares, p10_found, p10_canonical, p10_classes)}

_IDS = ", ".join(TRIP_IDS)
_ORDER = "_loaded_at DESC NULLS LAST, _ingest_batch_id DESC NULLS LAST, " + " + ".join(f"({c} IS NOT NULL)::INT" for c in [*TRIP_IDS, *TRIP_VALUES]) + " DESC, _row_id"


def _each_twin() -> str:
    parts = [("int_trips_enriched", "trip_duration_min", k, g) for k, g in (("zone", "pu_location_id"), ("hour", "pickup_hour"), ("month", "strftime(pickup_date, '%Y-%m')"))]
    dims = (("zone", "PULocationID"), ("hour", "hour(tpep_pickup_datetime)"), ("month", "strftime(tpep_pickup_datetime, '%Y-%m')"), ("load", "_ingest_batch_id"))
    parts += [("yellow_tripdata", m, k, g) for m in ("total_amount", "trip_distance") for k, g in dims]
    return " UNION ALL ".join(f"SELECT '{m}' AS measure, '{k}' AS dimension, g AS grp, n_values, n_null, {', '.join(f'{q}::DOUBLE AS {q}' for q in QUANTILES)}, error_bound FROM ({_percentile_twin(t, f'({g})::VARCHAR', 'g', m)})" for t, m, k, g in parts)


def _percentile_twin(table: str, group: str, alias: str, value: str, bound: str = "0.0::DOUBLE") -> str:
    picks = ", ".join(f"min(v) FILTER (WHERE r >= greatest(1, ceil({q} * n))) AS {name}" for name, q in QUANTILES.items())
    return f"""WITH x AS (SELECT {group} AS g, {value} AS v FROM {table}),
y AS (SELECT g, v, row_number() OVER (PARTITION BY g ORDER BY v) r, count(*) OVER (PARTITION BY g) n FROM x WHERE v IS NOT NULL AND NOT isnan(v::DOUBLE)),
z AS (SELECT g, {picks} FROM y GROUP BY g)
SELECT s.g AS {alias}, n_values, n_null, {", ".join(QUANTILES)}, {bound} AS error_bound
FROM (SELECT g, count(*) FILTER (WHERE v IS NOT NULL AND NOT isnan(v::DOUBLE)) n_values, count(*) FILTER (WHERE v IS NULL OR isnan(v::DOUBLE)) n_null FROM x GROUP BY g) s LEFT JOIN z ON z.g IS NOT DISTINCT FROM s.g"""


def _char_table() -> str:
    """(c, w): what single characters become, for the twins of problem 10: from the names and normal forms of
    characters instead of the operator's patterns, one character at a time instead of one replacement after
    the other."""
    out = {}
    for cp in [*range(0x300), *range(0x370, 0x590), 0xAD, *range(0x13A0, 0x1400), *range(0x1F00, 0x2100), *range(0x2160, 0x2180), *range(0x2C60, 0x2D00), 0x3000, *range(0xA4D0, 0xA500), *range(0xA7A0, 0xA7B0), *range(0xFB00, 0xFB18), *range(0xFE00, 0xFE10), 0xFEFF, *range(0xFF01, 0xFFEF)]:
        c = chr(cp)
        name, kind = unicodedata.name(c, ""), unicodedata.category(c)
        if name.endswith(("WIDTH SPACE", "NO-BREAK SPACE", "WORD JOINER", "SOFT HYPHEN")) and kind == "Cf" or name.startswith("VARIATION SELECTOR") or name.startswith("ZERO WIDTH") or (kind == "Cc" and c not in "\t\n\v\f\r\x85"):
            w = ""
        elif kind == "Zs" or c == "\t":
            w = " "
        elif name.startswith(("FULLWIDTH", "HALFWIDTH", "LATIN SMALL LIGATURE F", "ROMAN NUMERAL", "SMALL ROMAN NUMERAL")) and "LONG S" not in name:
            w = unicodedata.normalize("NFKC", c)
        else:
            w = "".join(lookalike.LOOKALIKES.get(x, x) for x in unicodedata.normalize("NFD", c))
        if w != c:
            out[cp] = w
    return ", ".join(f"({cp}, '" + w.replace("'", "''") + "')" for cp, w in out.items())


_LOOKS = f"""WITH m(p, w) AS (VALUES {_char_table()}),
d AS (SELECT doc_id, text, replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS s FROM documents),
i AS (SELECT doc_id, s, unnest(generate_series(1, length(s))) AS k FROM d),
x AS (SELECT doc_id, k, substring(s, k, 1) AS ch FROM i),
f AS (SELECT doc_id, nfc_normalize(string_agg(coalesce(w, ch), '' ORDER BY k)) AS canonical FROM (SELECT x.*, CASE WHEN unicode(ch) = 65039 AND unicode(lag(ch) OVER (PARTITION BY doc_id ORDER BY k)) = 127783 THEN ch ELSE w END AS w FROM x LEFT JOIN m ON p = unicode(ch)) GROUP BY doc_id),
c AS (SELECT d.doc_id, d.text, CASE WHEN d.text = '' THEN '' ELSE f.canonical END AS canonical FROM d LEFT JOIN f ON f.doc_id = d.doc_id),
k AS (SELECT doc_id, text, CASE WHEN trim(canonical, ' ' || chr(10) || chr(11) || chr(12)) <> '' THEN canonical END AS form FROM c)"""

SQL = {
    "p2_found": f"""
WITH k AS (SELECT _row_id, fare_amount, {_IDS}, row_number() OVER (PARTITION BY {_IDS} ORDER BY {_ORDER}) r FROM yellow_tripdata)
SELECT min(_row_id) AS group_row_id, arg_min(_row_id, r) AS survivor_row_id, coalesce(arg_min(_row_id, r) FILTER (WHERE fare_amount IS NOT NULL), -1) AS fare_row_id
FROM k GROUP BY {_IDS} HAVING count(*) >= 2""",
    "p2_groups": f"""
WITH k AS (SELECT _row_id, fare_amount, coalesce(_ingest_batch_id, '') AS b, {_IDS}, row_number() OVER (PARTITION BY {_IDS} ORDER BY {_ORDER}) r FROM yellow_tripdata),
g AS (SELECT min(_row_id) AS group_row_id, arg_min(_row_id, r) AS survivor_row_id, count(*) AS n_rows, count(DISTINCT b) FILTER (WHERE fare_amount IS NOT NULL)::INT AS n_sources, arg_min(fare_amount, r) FILTER (WHERE fare_amount IS NOT NULL) AS first_known
  FROM k GROUP BY {_IDS} HAVING count(*) >= 2)
SELECT group_row_id, survivor_row_id, n_rows, n_sources, CASE WHEN n_sources = 1 THEN first_known END AS only_value, n_sources = 0 AS unknown, n_sources = 0 AS no_value FROM g""",
    "p2_agreement": f"""
WITH k AS (SELECT coalesce(_ingest_batch_id, '') AS s, fare_amount, {_IDS}, count(*) OVER (PARTITION BY {_IDS}) n FROM yellow_tripdata
  QUALIFY n >= 2 AND fare_amount IS NOT NULL AND row_number() OVER (PARTITION BY {_IDS}, _ingest_batch_id ORDER BY fare_amount IS NULL, {_ORDER}) = 1)
SELECT a.s AS source_a, b.s AS source_b, count(*) AS n_groups, count(*) FILTER (WHERE a.fare_amount = b.fare_amount) AS n_same
FROM k a JOIN k b ON a.s < b.s AND {" AND ".join(f"a.{c} IS NOT DISTINCT FROM b.{c}" for c in TRIP_IDS)} GROUP BY 1, 2""",
    "p2_survivors": f"""SELECT _row_id, {_IDS}, {", ".join(f"coalesce(fare_amount, first_value(fare_amount IGNORE NULLS) OVER (PARTITION BY {_IDS} ORDER BY {_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS fare_amount" if c == "fare_amount" else c for c in TRIP_VALUES)},
_source_filename, _ingest_batch_id, _loaded_at FROM yellow_tripdata QUALIFY row_number() OVER (PARTITION BY {_IDS} ORDER BY {_ORDER}) = 1""",
    "p3_percentiles": _each_twin(),
    "p3_duration_by_zone": _percentile_twin("int_trips_enriched", "pu_location_id", "pu_location_id", "trip_duration_min"),
    "p3_total_by_load": _percentile_twin("yellow_tripdata", "_ingest_batch_id", "_ingest_batch_id", "total_amount"),
    "p3_distance_by_month": _percentile_twin("yellow_tripdata", "strftime(tpep_pickup_datetime, '%Y-%m')", "month", "trip_distance"),
    "p3_duration_by_hour_rounded": _percentile_twin("int_trips_enriched", "pickup_hour", "pickup_hour", "floor(trip_duration_min / 0.1::DOUBLE) * 0.1::DOUBLE + 0.05::DOUBLE", "0.05::DOUBLE"),
    "p9_shares": """SELECT t.source, target_share, count(doc_id) AS documents, true AS within_documents, true AS within_repeats, true AS on_target, count(nullif(text, '')) > 0 AS used
FROM mix_targets t LEFT JOIN documents d ON d.source = t.source GROUP BY 1, 2""",
    "p10_found": f"{_LOOKS} SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM k a JOIN k b ON a.form = b.form AND a.doc_id < b.doc_id AND a.text <> b.text",
    "p10_canonical": f"{_LOOKS} SELECT doc_id, canonical FROM c",
    "p10_classes": f"{_LOOKS} SELECT doc_id, CASE WHEN form IS NOT NULL THEN min(doc_id) OVER (PARTITION BY form) END AS class_id FROM k",
}
