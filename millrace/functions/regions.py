"""Rectangular regions and the trip records that fall into them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Region(NamedTuple):
    name: str
    title: str
    min_x: float
    max_x: float
    min_y: float
    max_y: float


# The two office blocks, and where each taxi type keeps its drop-off position.
OFFICE_REGIONS = (
    Region("goldman", "Goldman Sachs", -74.0144185, -74.013777, 40.7138745, 40.7152275),
    Region("citigroup", "Citigroup", -74.012083, -74.009867, 40.720053, 40.7217236),
)
TAXI_COORDINATES = {"yellow": (10, 11), "green": (8, 9)}


def region_of(x: Column, y: Column, regions: Sequence[Region] = OFFICE_REGIONS) -> Column:
    """Name of the first region that holds the point strictly inside, else null."""
    return F.coalesce(
        *[
            F.when((x > r.min_x) & (x < r.max_x) & (y > r.min_y) & (y < r.max_y), F.lit(r.name))
            for r in regions
        ],
        F.lit(None).cast("string"),
    )


def by_type(kind: Column, choices: dict[str, Column]) -> Column:
    """The column chosen by the record type; null for any other type."""
    cases = list(choices.items())
    return reduce(lambda acc, c: acc.when(kind == c[0], c[1]), cases[1:], F.when(kind == cases[0][0], cases[0][1]))


def taxi_position(line: Column) -> tuple[Column, Column, Column]:
    """Type, longitude and latitude of a comma-separated trip line."""
    field = F.split(line, ",")
    kind = F.get(field, F.lit(0))
    x = by_type(kind, {k: F.get(field, F.lit(at[0])).cast("double") for k, at in TAXI_COORDINATES.items()})
    y = by_type(kind, {k: F.get(field, F.lit(at[1])).cast("double") for k, at in TAXI_COORDINATES.items()})
    return kind, x, y


def region_title(name: Column, regions: Sequence[Region] = OFFICE_REGIONS) -> Column:
    """Display title of a region; any other key is shown as it is."""
    return F.coalesce(*[F.when(name == r.name, F.lit(r.title)) for r in regions], name)
