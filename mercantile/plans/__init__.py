"""Named query plans over the fixture tables (for the driver, bench and tests)."""

from . import catalog
from . import admitting, changing, joining, reporting, sourcing, streams  # noqa: F401  (register queries)

QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES
