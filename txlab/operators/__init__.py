"""Single steps, each a function from DataFrame to DataFrame."""
