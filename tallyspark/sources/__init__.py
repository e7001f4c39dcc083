"""Sources: the driver's parquet tables and the case-study views built over them."""

from tallyspark.sources.tables import Tables

__all__ = ["Tables"]
