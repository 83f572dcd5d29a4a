"""Training-data pipeline operators.  Nothing else in the library imports this package."""

import visitflow
from pyspark import cloudpickle

# Ship the package's code with the functions, so Python workers need no installed copy.
cloudpickle.register_pickle_by_value(visitflow)
