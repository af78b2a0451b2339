"""Dataset rules and the jobs put together from the operators."""
