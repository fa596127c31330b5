from rollbook.schemas.endpoints import ENDPOINTS, Endpoint
from rollbook.schemas.tables import TABLES, Parent, Table

__all__ = ["ENDPOINTS", "Endpoint", "TABLES", "Parent", "Table"]
