from .tables import read_table
from .domain import Domain

__all__ = ["read_table", "Domain"]
