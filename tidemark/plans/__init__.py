from .loads import LoadError, LoadResult, conform, load_conformed, load_raw, newest_batch, preview
from .marts import build_mart, dim_customer, dim_product, fact_sales

__all__ = [
    "LoadError",
    "LoadResult",
    "build_mart",
    "conform",
    "dim_customer",
    "dim_product",
    "fact_sales",
    "load_conformed",
    "load_raw",
    "newest_batch",
    "preview",
]
