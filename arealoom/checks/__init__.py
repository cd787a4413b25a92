"""One registered query per operator, each with an equivalent SQL where SQL can say it.

Every query reads the given tables in full, or data that Spark derives from them.
"""

from arealoom.checks import (  # noqa: F401
    aggregates, audits, catalogs, functions, joins, plans, sources, windows,
)
from arealoom.checks.registry import ORACLES, QUERIES  # noqa: F401
