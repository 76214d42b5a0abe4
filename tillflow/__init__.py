"""Cash-flow analytics as Spark DataFrame operators.

Every operator is a plain function ``DataFrame... -> DataFrame``.  Nothing in
the package collects rows; "today" is always an explicit ``as_of`` argument.
"""

__version__ = "0.1.0"
