"""riskloom: Spark-native feature engineering and ensemble selection for
rare-event prediction over entity-by-time observation tables.

Every public operator is a function ``DataFrame -> DataFrame`` (or a small
Spark ML estimator wrapper); planning is left to Catalyst.
"""

from riskloom.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
__version__ = "0.1.0"
