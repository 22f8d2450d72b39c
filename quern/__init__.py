"""quern: relational analytics operators written for PySpark.

Every operator takes DataFrames and returns DataFrames.  The plan is declared
with the DataFrame or SQL API, so Catalyst and adaptive execution choose the
physical strategy.
"""

from quern.session import build_session, clear_shared, shared_folder
from quern.sources.tables import Tables

__all__ = ["Tables", "build_session", "clear_shared", "shared_folder"]
