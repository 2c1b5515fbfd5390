"""rowtide: change-data capture and lake loading as plain Spark DataFrame operators."""

from rowtide.session import build_session, work_dir
from rowtide.specs import SHOP_TABLES, TableSpec, spec_from_header

__all__ = ["SHOP_TABLES", "TableSpec", "build_session", "spec_from_header", "work_dir"]
