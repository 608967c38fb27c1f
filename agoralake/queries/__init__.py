"""Every operator shown on the given tables, each next to the SQL that states the expected result."""

from agoralake.queries.registry import ORACLES, QUERIES  # noqa: F401
from agoralake.queries import analysis, layers, maintenance, operations, text  # noqa: F401  (importing fills the registry)
