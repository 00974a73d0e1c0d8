"""All queries outside the llm subpackage, by name, with their SQL twins."""

from __future__ import annotations

from cabstrata.plans import problems, stored, trips, twins

QUERIES = {**trips.QUERIES, **problems.QUERIES, **stored.QUERIES}
SQL = {**twins.SQL, **problems.SQL, **stored.SQL}
