from tellerflow.streaming.incremental import (
    follow_accounts,
    follow_customers,
    follow_transactions,
)

__all__ = ["follow_accounts", "follow_customers", "follow_transactions"]
