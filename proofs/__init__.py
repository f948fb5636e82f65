"""Every operator as a query over the given tables, beside equivalent SQL."""
