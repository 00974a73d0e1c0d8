"""Role-playing lookups in one dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabstrata.operators.sizing import is_small


def lookup_roles(df: DataFrame, dimension: DataFrame, key: str, roles: dict[str, dict[str, str]]) -> DataFrame:
    """Left-joins the dimension once per role. roles: foreign key column -> {dimension column: name in
    the result}. The dimension's key is unique; a row without partner keeps nulls. The dimension is
    broadcast only if its measured size allows it; else the planner chooses."""
    hint = F.broadcast if is_small(dimension) else (lambda x: x)
    for fk, columns in roles.items():
        d = dimension.select(F.col(key).alias(f"_k_{fk}"), *[F.col(c).alias(n) for c, n in columns.items()])
        df = df.join(hint(d), F.col(fk) == F.col(f"_k_{fk}"), "left").drop(f"_k_{fk}")
    return df


# Names of the zone columns by role.
ZONE_ROLES = {
    "pu_location_id": {"borough": "pu_borough", "zone_name": "pu_zone", "service_zone": "pu_service_zone"},
    "do_location_id": {"borough": "do_borough", "zone_name": "do_zone", "service_zone": "do_service_zone"},
}
