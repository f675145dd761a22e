"""The five jobs, each put together from operators."""
