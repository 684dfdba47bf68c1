from tellerflow.sinks.catalog import PublishError, publish_staged, repair, save_table
from tellerflow.sinks.files import write_csv
from tellerflow.sinks.ledger import Ledger, LedgerError, add_once
from tellerflow.sinks.jdbc import write_table
from tellerflow.sinks.layout import Layout, read_split, save_in_buckets, skewed_buckets
from tellerflow.sinks.targets import Target, add, export, replace
from tellerflow.sinks.shared import materialize, scratch

__all__ = [
    "Layout",
    "Ledger",
    "LedgerError",
    "PublishError",
    "Target",
    "add",
    "add_once",
    "export",
    "materialize",
    "publish_staged",
    "read_split",
    "repair",
    "replace",
    "save_in_buckets",
    "save_table",
    "scratch",
    "skewed_buckets",
    "write_csv",
    "write_table",
]
