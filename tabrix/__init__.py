"""tabrix: Spark-native feature, encoding, sampling, scoring and evaluation operators
for labelled tables (yes/no campaign outcomes and similar).

Every operator is a DataFrame -> DataFrame transformation (or a Column expression);
fitted state is held as small lookup DataFrames.  Nothing passes whole through the driver:
the driver only sees one-row statistics and tables whose size is bounded by construction.
"""

from tabrix.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
