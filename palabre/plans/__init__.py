"""Ready-made plans: the chat and retail jobs, and the checked queries."""
