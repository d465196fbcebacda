"""Small literal lookups (site -> country / offset, meter -> name)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattlake.constants import SITE_COUNTRIES, SITE_UTC_OFFSETS


def map_lookup(c: Column, mapping: dict) -> Column:
    """Replace a key by its mapped value; keys not in the mapping give NULL."""
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(m, c)


def country_of_site(site: Column, countries: dict | None = None) -> Column:
    return map_lookup(site, countries or SITE_COUNTRIES)


def site_offset(site: Column, offsets=None) -> Column:
    offs = SITE_UTC_OFFSETS if offsets is None else offsets
    return map_lookup(site, dict(enumerate(offs)))
