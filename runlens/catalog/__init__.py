"""Every operator as a query over the given tables, and its SQL counterpart."""
