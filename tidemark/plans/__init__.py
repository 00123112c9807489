"""Ready-made plans from messages to results."""
