"""Reading source tables, importing CSV and text lists, loading rules, publishing results."""

from marginloom.sources.rules import (
    HeaderError,
    RuleError,
    append_rules,
    dated_rules_from_rows,
    load_dated_rules,
    load_rules,
    replace_rules,
    rules_from_rows,
    rules_of,
)
from marginloom.sources.schemas import SCHEMAS
from marginloom.sources.tables import (
    publish_table,
    publish_view,
    published_versions,
    read_csv,
    read_invoice_list,
    read_table,
)
from marginloom.sources.versions import Versions

__all__ = [
    "HeaderError",
    "RuleError",
    "SCHEMAS",
    "Versions",
    "append_rules",
    "dated_rules_from_rows",
    "load_dated_rules",
    "load_rules",
    "publish_table",
    "publish_view",
    "published_versions",
    "read_csv",
    "read_invoice_list",
    "read_table",
    "replace_rules",
    "rules_from_rows",
    "rules_of",
]
