"""Every operator as a query over the shared test tables, with independent SQL to check it."""
