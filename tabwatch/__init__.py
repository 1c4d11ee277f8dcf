"""tabwatch: contracts, splits, features, classifiers, metrics and drift as Spark jobs.

Every public operator takes DataFrames and returns a lazy DataFrame; nothing runs until
the caller acts, unless the function name says ``fit``.
"""

__version__ = "0.1.0"
