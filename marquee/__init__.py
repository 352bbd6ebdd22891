"""marquee: batch analytics for catalogues of titled items on Spark.

Every operator is a function ``DataFrame -> DataFrame`` built from Spark SQL
built-in expressions; nothing here runs row-at-a-time Python.
"""

from marquee.session import checkpoint_root, cluster_conf, get_session

__version__ = "0.1.0"
__all__ = ["get_session", "checkpoint_root", "cluster_conf", "__version__"]
