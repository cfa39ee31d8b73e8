"""Named queries over the test tables; importing this package registers them all."""

from lodestar.plans.registry import NOTES, ORACLES, QUERIES, query  # noqa: F401
from lodestar.plans import analytics_q, cleanse_q, models_q, relational_q, streaming_q  # noqa: F401,E402
