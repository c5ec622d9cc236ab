"""Stand-in queries: every operator of the reports over the benchmark tables."""

from tablero.plans.standins import aggs, basic, joins, scalars, warehouse, windows  # noqa: F401  (registers queries)
from tablero.plans.standins.common import ORACLES, REGISTRY

__all__ = ["ORACLES", "REGISTRY"]
from tablero.plans.standins import reports  # noqa: E402,F401  (registers the report keys)
