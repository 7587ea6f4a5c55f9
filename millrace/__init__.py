"""Feed, tick-table, call-log and entitlement analytics on PySpark."""
