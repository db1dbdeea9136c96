"""vendorscope: business-profile analytics on Spark DataFrames.

Page HTML -> answer text and tables, vendor x search-group fan-out, ordered
fan-in per vendor, extraction prompts, JSON clean-up and fact consolidation,
all as DataFrame transformations (``df.transform(op)``).
"""

import sys as _sys

from vendorscope.session import build_session, checkpoint_dir


def _pickle_by_value() -> None:
    """Ship this package's functions inside Python UDF closures.

    Python workers (local or on a cluster) need not have the package
    installed or on their path.
    """
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(_sys.modules[__name__])
    except Exception:  # noqa: BLE001 - older cloudpickle: rely on --py-files instead
        pass


_pickle_by_value()

__all__ = ["build_session", "checkpoint_dir"]
