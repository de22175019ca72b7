"""Every query, by importing the modules that register them."""

from panelweave.workload import analytics, exchange, layer_plans, layers, panels, reshaping, series, spatial, validation  # noqa: F401
from panelweave.workload.base import REGISTRY, Tables

__all__ = ["REGISTRY", "Tables"]
