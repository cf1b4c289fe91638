"""presslens: Spark-native analytics for news-article feeds and labelled text corpora.

Every operator is a ``DataFrame -> DataFrame`` or ``Column -> Column`` function
built from native ``pyspark.sql.functions`` so Catalyst can push filters and
prune columns; Python runs only where Spark has no equivalent (HTML parsing,
the pluggable scorer, KDE partial sums), and then as Arrow-batched ``mapInPandas``.
"""

import sys as _sys

# Code that runs inside Python workers (mapInPandas bodies, scorers, the HTML
# parser) is shipped by value, so executors need no installed copy of the
# package; users may still ship it with --py-files.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark: rely on --py-files
    pass

from presslens.session import get_spark, shared_dir  # noqa: E402

__all__ = ["get_spark", "shared_dir"]
