"""reelrank: recommendation and preference analytics on Spark DataFrames.

Entry points: :class:`reelrank.plans.catalog.Catalog` (test tables) and
:class:`reelrank.plans.catalog.FileCatalog` (delimited files) build the base
frames; the operators in :mod:`reelrank.operators` take and return
DataFrames; :mod:`reelrank.plans.jobs` runs the batch jobs.
"""

__version__ = "0.1.0"

from reelrank.plans.catalog import Catalog, FileCatalog  # noqa: E402
from reelrank.session import local_session  # noqa: E402

__all__ = ["Catalog", "FileCatalog", "local_session", "__version__"]
