"""All query modules, loaded into one catalogue."""

from vitrine.plans import checks, datasets, files, joins, lists, pages, streams, totals, urls  # noqa: F401
from vitrine.plans.registry import CHECKS, QUERIES  # noqa: F401
