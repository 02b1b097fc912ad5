"""Column functions shared by the batch operators and the streaming jobs."""
