"""Every operator as a named query over the given tables, and the SQL that must agree."""
