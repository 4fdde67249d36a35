"""Price-history analytics on Spark: yearly price archives in, analytic tables, exports and checks out."""

from tarifa.config import Settings

__all__ = ["Settings"]
