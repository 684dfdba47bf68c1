from tellerflow.sources.files import (
    read_accounts,
    read_csv,
    read_csv_traced,
    read_customers,
    read_deletes,
    read_transactions,
    read_updates,
)
from tellerflow.sources.jdbc import Split, even_predicates, read_table

__all__ = [
    "Split",
    "even_predicates",
    "read_accounts",
    "read_csv",
    "read_csv_traced",
    "read_customers",
    "read_deletes",
    "read_table",
    "read_transactions",
    "read_updates",
]
