"""Training-data operators over ``documents``, ``embeddings`` and ``conversations``.

One module per operator; ``catalogue`` registers their queries. Nothing else
in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
