"""Profile, screen and repair large collections of time series on Spark."""

from pyspark import cloudpickle

from .functions import kernels
from .sources import npy

# Ship the numpy helpers with the tasks, so executors need no installed package.
for _module in (kernels, npy):
    cloudpickle.register_pickle_by_value(_module)
