"""Entity x time panels on Spark: sources, operators, plans and checks."""

from panelweave.session import get_spark

__all__ = ["get_spark"]
