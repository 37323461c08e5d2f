from ledgerlens.sources.tables import ORDER_COLS, read_table, sales_view  # noqa: F401
