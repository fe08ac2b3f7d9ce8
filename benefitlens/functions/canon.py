"""Dictionary canonicalisation and categorical domains."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from benefitlens.constants import CHANNEL_MAP, MANDATE_MAP, TIER_MAP


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(mapping: dict) -> Column:
    """A literal MAP column; Catalyst folds it once per plan."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def lookup(c, mapping: dict) -> Column:
    """Exact, case-sensitive lookup; an unknown label or null gives null."""
    return F.try_element_at(literal_map(mapping), _col(c))


def lookup_or(c, mapping: dict, fill: str = "Unknown") -> Column:
    return F.coalesce(lookup(c, mapping), F.lit(fill))


def canon_channel(c="last_contact_channel") -> Column:
    """F7."""
    return lookup_or(c, CHANNEL_MAP)


def canon_tier(c="plan_tier_requested") -> Column:
    """F8."""
    return lookup_or(c, TIER_MAP)


def canon_mandate(c="state_mandate_level") -> Column:
    """no fill; an unknown mandate label stays null."""
    return lookup(c, MANDATE_MAP)


def lookup_trim_retry(c, mapping: dict, fill: str = "Unknown") -> Column:
    """exact label first, then the trimmed label, else ``fill``.

    A null raw value is first turned into the fill word (as the reference does
    with ``str(...)`` on a missing value), which then misses the map.
    """
    x = F.coalesce(_col(c), F.lit(fill))
    m = literal_map(mapping)
    return F.coalesce(F.try_element_at(m, x), F.try_element_at(m, F.trim(x)), F.lit(fill))


def fill_unknown(c, fill: str = "Unknown") -> Column:
    """F13."""
    return F.coalesce(_col(c), F.lit(fill))


def in_domain(c, levels) -> Column:
    """keep a value inside the fixed domain, else null."""
    col = _col(c)
    return F.when(col.isin(list(levels)), col)
